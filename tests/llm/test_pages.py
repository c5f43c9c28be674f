"""URL rules and main texts of pages."""

import itertools

import numpy as np
import pytest

from sparkmart.llm import html_text, url_filter
from sparkmart.llm.dom import parse
from sparkmart.llm.queries import URL_RULES


def fits(host, path, rule):
    _, rule_host, rule_path = rule
    return (host == rule_host or host.endswith("." + rule_host)) and path.startswith(rule_path)


URLS = [
    "http://example.com/en/1", "https://WWW.Example.com/en/2?x=/es/", "http://a.www.example.com/en", "http://net/es/", "x://n.net/fr/a#b",
    "http://m.example.com/enx", "http://notexample.com/en/", "ftp://example.org", "example.com/en/", "", None, "http://com", "http://com/",
    "a://b://c.net/es/1", "http://user@x.com:80/en/", "http://example.com?q=/en/", "http://x.net./es/", "http://.com/", "http://x.net//es/",
]


def test_urls_against_a_scan_of_all_rules(spark):
    pages = spark.createDataFrame([(i, u, "h", "p") for i, u in enumerate(URLS)], "page_id long, url string, host string, verdict string")
    got = {r["page_id"]: r for r in url_filter.judge_urls(pages, URL_RULES).collect()}
    assert len(got) == len(URLS)
    for i, url in enumerate(URLS):
        host = path = ""
        if url and "://" in url:
            rest = url.split("://", 1)[1].split("#")[0].split("?")[0]
            host, slash, tail = rest.partition("/")
            host, path = host.lower(), slash + tail
        best = max((r for r in URL_RULES if fits(host, path, r)), key=lambda r: (len(r[1]), len(r[2])), default=None)
        want = (host, path, best and best[1] + best[2], best[0] if best else "allow")
        assert (got[i]["host"], got[i]["path"], got[i]["rule"], got[i]["verdict"]) == want, url
    assert url_filter.judge_urls(pages.limit(0), URL_RULES).collect() == []


def test_trie_prefers_hosts_then_paths():
    trie = url_filter.UrlTrie([("block", "b.com", "/x/y"), ("allow", "b.com", "/x"), ("allow", "a.b.com", "/"), ("block", "", "/z"), ("block", "b.com", "/x")])
    assert trie.match("b.com", "/x/yes") == ("b.com/x/y", "block")
    assert trie.match("b.com", "/xy") == ("b.com/x", "allow")
    assert trie.match("c.a.b.com", "/x/y") == ("a.b.com/", "allow")
    assert trie.match("org", "/zz") == ("/z", "block") and trie.match("org", "/a") is None
    with pytest.raises(ValueError):
        url_filter.UrlTrie([("maybe", "a", "/")])


@pytest.fixture(scope="module")
def trees():
    return html_text.model()


def test_page_parts_are_left_out(trees):
    page = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style></head><body class=x>
    <header><div class="logo">Site</div><nav><ul><li><a href=/>Home</a><li><a href=/b>More</a></ul></nav></header>
    <div class="cookie-notice"><p>We use cookies, and you agree.</p></div>
    <article><h1>Head &amp; line</h1><p>First  <b>bold</b>\n text, it&#39;s here.<p>Second one; with a <a href=x>link</a> inside.
    <script>var a = "</p>not";</script><ul><li>point one of the list<li>point two of the list</ul></article>
    <aside class="sidebar"><h3>Related</h3><ul><li><a href=1>Other</a></li><li><a href=2>Another</a></li></ul></aside>
    <section id="comments"><h3>Comments</h3><div class="comment"><p>I liked this one a lot, thanks.</p></div></section>
    <form class="newsletter"><p>Sign up now</p><input></form><footer>&copy; nobody</footer></body></html>"""
    assert html_text.extract([page], trees) == [
        "Head & line\nFirst bold text, it's here.\nSecond one; with a link inside.\npoint one of the list\npoint two of the list"
    ]


def test_held_out_layouts(trees):
    wrong = total = 0
    for source in html_text.training_pages(60, 77):
        page = parse(source)
        blocks, x, own = html_text.node_features(page)
        kept = html_text.kept_blocks(page, blocks, trees.margin(x), own)
        marks = [int(v) for v in html_text._Y.findall(source)]
        known = [r for r, b in enumerate(blocks) if page.tag[b] not in ("html", "head", "body", "title")]
        for r, y in zip(known, marks):
            if y < 2 and own[r]:
                total += 1
                wrong += (int(blocks[r]) in kept) != bool(y)
    assert wrong <= total * 0.01


def test_decoding_is_the_best_consistent_choice(trees):
    """Against all choices of whole, dropped and open subtrees on small random trees."""
    rng = np.random.default_rng(1)
    sources = ["<div>a<p>b</p><div><p>c</p>d</div></div><p>e</p>", "<section><div><p>a</p><p>b</p></div></section><footer><p>c</p></footer>"]
    for source in sources * 15:
        page = parse(source)
        blocks, _, own = html_text.node_features(page)
        margin = rng.normal(0, 2, len(blocks))
        weight = 1 + np.log1p(own)
        yes, no = -np.logaddexp(0, -margin) * weight, -np.logaddexp(0, margin) * weight
        row = {int(b): r for r, b in enumerate(blocks)}
        below = {b: [c for c in row if page.parent[c] == b] for b in row}

        def whole(b, value):
            return value[row[b]] + sum(whole(c, value) for c in below[b])

        def kept(b):
            return {b}.union(*(kept(c) for c in below[b]))

        def choices(b):
            yield whole(b, yes), kept(b)
            yield whole(b, no), set()
            r = row[b]
            start = (max(yes[r], no[r]), {b} if margin[r] > 0 else set()) if own[r] > 0 else (-0.1, set())
            for parts in itertools.product(*(list(choices(c)) for c in below[b])):
                yield start[0] + sum(v for v, _ in parts), start[1].union(*(k for _, k in parts))

        value, want = max(choices(0), key=lambda c: c[0])
        got = html_text.kept_blocks(page, blocks, margin, own)
        text = {b for b in row if own[row[b]] > 0}
        assert got & text == want & text


def test_extract_text_of_odd_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<p>" + "word " * 50_000), (4, "u", "<a <b> </ <!-- x"), (None, "u", "plain words only"), (3, "u", "<p>" + "word " * 50_000)]
    pages = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, text string")
    out = html_text.extract_text(pages).collect()
    assert len(out) == len(rows) and out[0].asDict().keys() == {"page_id", "url", "text", "n_chars"}
    assert all(r["n_chars"] == len(r["text"]) for r in out)
    assert {r["page_id"]: r["text"] for r in out}[1] == "" and [r["n_chars"] for r in out if r["page_id"] == 3] == [249_999] * 2
    assert html_text.extract_text(pages.limit(0)).collect() == []
