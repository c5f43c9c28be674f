"""Main text of web pages: boosted trees over DOM nodes, decoded from the root down.

Every block element gets features of its tag, its attribute words and those of its ancestors,
text and link density of its subtree, depth and siblings. Gradient-boosted trees give the
probability that it belongs to the article. The decision for a page is the best consistent one:
a subtree is kept whole, dropped whole, or left open for its children to decide, so that no
descendant of a dropped element is kept. The trees learn from pages that are laid out here at
random from known parts (``training_pages``), with a fixed seed.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm import boosting
from sparkmart.llm.common import arrow_schema, prepare, text_of
from sparkmart.llm.dom import BLOCK, Page, parse

#: Words of class, id and role that name parts of a page around the article, and of the article.
AROUND = frozenset(
    "ad ads adv advert advertisement aside banner bar breadcrumb breadcrumbs comment comments consent cookie cookies copyright "
    "dialog disclaimer disqus feedback footer form gdpr header legal links login masthead menu meta modal nav navbar navigation "
    "newsletter notice overlay pager pagination popup promo promotion recommended related replies reply respond rail search share "
    "sharing shop sidebar signup skip social sponsor sponsored subscribe subscription tags teaser toc toolbar tracking trending "
    "widget widgets".split()
)
WITHIN = frozenset("article articlebody blog body content copy entry main page paragraph post prose read story text".split())
#: Elements whose text is never part of an article.
NEVER = frozenset("head script style title textarea noscript iframe select option button input template svg form nav".split())
TAGS = {t: i for i, t in enumerate("p div article main section nav header footer aside ul li form table blockquote body".split())}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_SPACE = re.compile(r"\s+")


def node_features(page: Page) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(block elements, their features, length of text directly in each block)."""
    n = len(page.tag)
    own, linked = np.zeros(n), np.zeros(n)
    marks, before = np.zeros(n), np.zeros(n)
    block_of, in_link = [0] * n, [False] * n
    for i in range(1, n):
        up = page.parent[i]
        block_of[i] = i if page.tag[i] in BLOCK else block_of[up]
        in_link[i] = in_link[up] or page.tag[i] == "a"
    seen = 0.0
    first = np.full(n, -1.0)
    for node, text in page.steps:
        if text is None:
            continue
        size = len(text) if text.strip() else 0
        if not size:
            continue
        b = block_of[node]
        own[b] += size
        if in_link[node]:
            linked[b] += size
        marks[b] += text.count(".") + text.count(",")
        if first[b] < 0:
            first[b] = seen
        seen += size
    total, links, points, below = own.copy(), linked.copy(), marks.copy(), np.zeros(n)
    anchors = np.zeros(n)
    kids: list[list[int]] = [[] for _ in range(n)]
    for i in range(n - 1, 0, -1):
        up = page.parent[i]
        total[up] += total[i]
        links[up] += links[i]
        points[up] += points[i]
        below[up] += below[i] + 1
        anchors[up] += anchors[i] + (page.tag[i] == "a")
        if first[i] >= 0 and (first[up] < 0 or first[i] < first[up]):
            first[up] = first[i]
        if page.tag[i] in BLOCK:
            kids[up].append(i)
    for k in kids:
        k.reverse()
    around, within = np.zeros(n), np.zeros(n)
    up_around, up_within = np.zeros(n), np.zeros(n)
    place, alike, count = np.zeros(n), np.zeros(n), np.zeros(n)
    for i in range(n):
        tag, words = page.tag[i], page.words[i]
        around[i] = len(words & AROUND) + 2 * (tag in ("nav", "footer", "aside", "form")) + (tag == "header")
        within[i] = len(words & WITHIN) + 2 * (tag in ("article", "main"))
        if i:
            up = page.parent[i]
            up_around[i] = up_around[up] + around[up]
            up_within[i] = up_within[up] + within[up]
        names = Counter(page.tag[k] for k in kids[i])
        for at, k in enumerate(kids[i]):
            place[k], count[k], alike[k] = at, len(kids[i]), names[page.tag[k]]
    blocks = np.array([i for i in range(n) if page.tag[i] in BLOCK], np.int64)
    whole = max(1.0, total[0])
    x = np.zeros((len(blocks), len(TAGS) + 18))
    for r, i in enumerate(blocks):
        tag = page.tag[i]
        if tag in TAGS:
            x[r, TAGS[tag]] = 1
    c = len(TAGS)
    at = blocks
    parents = np.array([max(page.parent[i], 0) for i in blocks], np.int64)
    x[:, c] = [page.tag[i] in HEADINGS for i in blocks]
    x[:, c + 1], x[:, c + 2] = around[at], within[at]
    x[:, c + 3], x[:, c + 4] = up_around[at], up_within[at]
    x[:, c + 5] = np.log1p(total[at])
    x[:, c + 6] = links[at] / np.maximum(total[at], 1)
    x[:, c + 7] = total[at] / whole
    x[:, c + 8] = np.log1p(total[at] / (1 + below[at]))
    x[:, c + 9] = np.log1p(anchors[at])
    x[:, c + 10] = [page.depth[i] for i in blocks]
    x[:, c + 11], x[:, c + 12], x[:, c + 13] = place[at], count[at], alike[at]
    x[:, c + 14] = np.maximum(first[at], 0) / whole
    x[:, c + 15] = points[at] / np.maximum(total[at], 1) * 100
    x[:, c + 16] = own[at] / np.maximum(total[at], 1)
    x[:, c + 17] = total[parents] / whole
    return blocks, x, own[at]


def kept_blocks(page: Page, blocks: np.ndarray, margin: np.ndarray, own: np.ndarray) -> set[int]:
    """Blocks whose text is kept, by the best consistent choice of whole, dropped and open subtrees."""
    nearest, up_block = [0] * len(page.tag), {0: -1}
    for i in range(1, len(page.tag)):
        above = nearest[page.parent[i]]
        nearest[i] = i if page.tag[i] in BLOCK else above
        if nearest[i] == i:
            up_block[i] = above
    keep, drop, best = {}, {}, {}
    for r in range(len(blocks) - 1, -1, -1):
        b = int(blocks[r])
        # A text weighs by its length, a container by one.
        weight = 1 + np.log1p(own[r])
        yes, no = -np.logaddexp(0, -margin[r]) * weight, -np.logaddexp(0, margin[r]) * weight
        if page.tag[b] in NEVER:
            yes = -1e9
        keep[b] = keep.get(b, 0.0) + yes
        drop[b] = drop.get(b, 0.0) + no
        # An open container decides on its own text only, and costs a little against a clear choice.
        open_ = best.get(b, 0.0) + (max(yes, no) if own[r] > 0 else -0.1)
        choice = max((drop[b], 0), (keep[b], 1), (open_, 2))
        up = up_block[b]
        if up >= 0:
            keep[up] = keep.get(up, 0.0) + keep[b]
            drop[up] = drop.get(up, 0.0) + drop[b]
            best[up] = best.get(up, 0.0) + choice[0]
        best[b] = choice
    state, out = {}, set()
    for r, b in enumerate(blocks.tolist()):
        above = state.get(up_block[b], 2)
        state[b] = above if above != 2 else best[b][1]
        if state[b] == 1 or (state[b] == 2 and own[r] > 0 and margin[r] > 0 and page.tag[b] not in NEVER):
            out.add(b)
    return out


def blocks_text(page: Page, kept: set[int]) -> str:
    """The texts of kept blocks in page order; white space is one space, blocks are lines."""
    n = len(page.tag)
    block_of, never = [0] * n, [False] * n
    for i in range(1, n):
        up = page.parent[i]
        block_of[i] = i if page.tag[i] in BLOCK else block_of[up]
        never[i] = never[up] or page.tag[i] in NEVER
    lines, line = [], []

    def close() -> None:
        text = _SPACE.sub(" ", "".join(line)).strip()
        if text:
            lines.append(text)
        line.clear()

    for node, text in page.steps:
        if text is None:
            close()
        elif block_of[node] in kept and not never[node]:
            line.append(text)
    close()
    return "\n".join(lines)


def training_pages(count: int, seed: int) -> Iterator[tuple[str, str]]:
    """(html, class of every block by its data-y) of random layouts; 1 marks blocks of the article."""
    rng = np.random.default_rng(seed)

    def pick(*options: str) -> str:
        return options[int(rng.integers(len(options)))]

    def prose(low: int, high: int) -> str:
        words = ["".join(pick("ta", "re", "mi", "lo", "sen", "do", "ka", "ul") for _ in range(int(rng.integers(1, 4)))) for _ in range(int(rng.integers(low, high)))]
        marks = [w + (pick(".", ",") if rng.random() < 0.12 else "") for w in words]
        return " ".join(marks)

    def block(tag: str, inner: str, y: int, names: str = "") -> str:
        return f'<{tag} {f"class={names!r} " if names else ""}data-y="{y}">{inner}</{tag}>'

    def links(n: int, tag: str = "li") -> str:
        return "".join(block(tag, f'<a href="/x">{prose(1, 4)}</a>', 0) for _ in range(n))

    def named(*names: str) -> str:
        # Some sites give no telling names.
        return pick(*names) if rng.random() < 0.75 else pick("", "x1", "c b", "wrap")

    def menu() -> str:
        inner = block("ul", links(int(rng.integers(3, 12))), 0)
        return block("nav", inner, 0) if rng.random() < 0.6 else block("div", inner, 0, named("menu", "navbar", "site-nav", "breadcrumbs"))

    def around() -> str:
        kind = int(rng.integers(7))
        if kind == 0:
            return block("div", prose(3, 25), 0, pick("ad", "ads", "advert", "sponsored", "promo-banner"))
        if kind == 1:
            return block("div", block("p", prose(8, 30), 0), 0, pick("cookie-notice", "consent", "gdpr-banner", "notice"))
        if kind == 2:
            inner = block("h3", prose(1, 3), 0) + block("ul", links(int(rng.integers(2, 8))), 0)
            return block("aside", inner, 0, named("sidebar", "widget")) if rng.random() < 0.5 else block("div", inner, 0, pick("sidebar", "related", "widget", "trending"))
        if kind == 3:
            return block("form", block("p", prose(3, 9), 0) + "<input>", 0, named("newsletter", "search", "login"))
        if kind == 4:
            one = (block("div", block("p", prose(4, 40), 0), 0, named("comment", "reply")) for _ in range(int(rng.integers(1, 6))))
            return block(pick("section", "div"), block("h3", "comments", 0) + "".join(one), 0, pick("comments", "replies", "comment-list"))
        if kind == 5:
            return block("div", "".join(f'<a href="#">{prose(1, 2)}</a> ' for _ in range(int(rng.integers(2, 6)))), 0, pick("share", "social", "tags"))
        return block("aside", prose(5, 40), 0)

    def article() -> str:
        parts = [block("h1", prose(2, 12), 1)] if rng.random() < 0.85 else []
        for _ in range(int(rng.integers(1, 14))):
            kind = rng.random()
            text = prose(1, 120)
            if rng.random() < 0.3:
                text += f' <a href="/y">{prose(1, 4)}</a> ' + prose(0, 20)
            if kind < 0.75:
                parts.append(block("p", text, 1))
            elif kind < 0.82:
                parts.append(block(pick("h2", "h3"), prose(1, 7), 1))
            elif kind < 0.88:
                parts.append(block(pick("ul", "ol"), "".join(block("li", prose(2, 20), 1) for _ in range(int(rng.integers(2, 6)))), 1))
            elif kind < 0.92:
                parts.append(block("blockquote", block("p", prose(5, 40), 1), 1))
            elif kind < 0.95:
                parts.append(block("table", block("tr", block("td", prose(1, 4), 1) + block("td", prose(1, 4), 1), 1), 1))
            else:
                parts.append(block("div", block("p", text, 1), 1))
            if rng.random() < 0.08:
                parts.append(around())
        inner = "".join(parts)
        y = 1 if 'data-y="0"' not in inner else 2
        kind = rng.random()
        if kind < 0.4:
            return block("article", inner, y, named("post", "story", ""))
        if kind < 0.6:
            return block("main", inner, y)
        if kind < 0.9:
            return block("div", inner, y, named("content", "article-body", "post", "entry", "main"))
        return inner

    for _ in range(count):
        parts = []
        if rng.random() < 0.6:
            inner = block(pick("div", "h2", "p"), prose(1, 5), 0) + (menu() if rng.random() < 0.5 else "")
            parts.append(block("header", inner, 0) if rng.random() < 0.6 else block("div", inner, 0, pick("header", "masthead", "banner")))
        if rng.random() < 0.7:
            parts.append(menu())
        parts += [around() for _ in range(int(rng.integers(0, 3)))]
        parts.append(article())
        parts += [around() for _ in range(int(rng.integers(0, 4)))]
        if rng.random() < 0.8:
            inner = "© " + prose(2, 25) if rng.random() < 0.6 else block("p", prose(3, 25), 0) + block("ul", links(3), 0)
            parts.append(block("footer", inner, 0) if rng.random() < 0.7 else block("div", inner, 0, pick("footer", "site-footer", "legal", "copyright")))
        body = "".join(parts)
        if rng.random() < 0.3:
            body = block("div", body, 2, pick("page", "wrapper", "container", "root"))
        yield f"<html><head><title>t</title></head><body>{body}</body></html>"


_Y = re.compile(r'data-y="(\d)"')


@cache
def model(pages: int = 250, seed: int = 5) -> boosting.Trees:
    """Trees over the blocks of random layouts; blocks that hold both kinds are left out."""
    xs, ys = [], []
    for source in training_pages(pages, seed):
        page = parse(source)
        blocks, x, _ = node_features(page)
        marks = [int(v) for v in _Y.findall(source)]
        known = [r for r, b in enumerate(blocks) if page.tag[b] not in ("html", "head", "body", "title")]
        if len(known) != len(marks):
            raise ValueError("a training page was not read as it was written")
        y = np.array(marks)
        rows = np.array(known)[y < 2]
        xs.append(x[rows])
        ys.append(y[y < 2])
    x, y = np.concatenate(xs), np.concatenate(ys).astype(float)
    return boosting.train(x, y, np.ones(len(y)))


def extract(pages: list[str], trees: boosting.Trees) -> list[str]:
    """Main texts of some pages; the trees see the blocks of all of them at once."""
    read = [parse(p) for p in pages]
    parts = [node_features(p) for p in read]
    if not parts:
        return []
    margin = trees.margin(np.concatenate([x for _, x, _ in parts]))
    out, at = [], 0
    for page, (blocks, _, own) in zip(read, parts):
        out.append(blocks_text(page, kept_blocks(page, blocks, margin[at : at + len(blocks)], own)))
        at += len(blocks)
    return out


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row: the id, url, text, n_chars.

    Null html counts as empty and gives an empty text, as does a page without article. Character
    references are decoded, white space within a block is one space, blocks are joined by a line
    break; nothing is cut, however long. Repeated rows are read alike, other columns are ignored,
    an empty table gives no rows.
    """
    spark = prepare(pages.sparkSession)
    trees = spark.sparkContext.broadcast(model())
    kinds = dict(pages.select(id_col, url_col).dtypes)
    ddl = f"`{id_col}` {kinds[id_col]}, `{url_col}` {kinds[url_col]}, text string"
    schema = arrow_schema(ddl)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 100):
                part = batch.slice(start, 100)
                texts = extract(part.column(2).to_pylist(), trees.value)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())], schema=schema)

    rows = pages.select(id_col, url_col, text_of(F.col(html_col)).alias("html")).mapInArrow(work, ddl)
    return rows.withColumn("n_chars", F.length("text").cast("long"))
