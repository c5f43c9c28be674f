"""A forgiving HTML reader: elements with parents, and texts in page order."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|</(?P<end>[a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)"
    r"|<(?P<start>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<broken>[a-zA-Z][^\s/>]*+)(?P<rest>[^>]*+)(?:>|\Z)"
    r"|(?P<text>[^<]++|<)",
    re.S,
)
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_WORD = re.compile(r"[a-z]+")
#: Fixed values of HTML: elements without an end, elements whose content is no markup, block elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "section select summary table tbody td tfoot th thead tr ul".split()
)
#: An open element of the first kind ends where one of the second kind begins.
CLOSED_BY = {
    "p": BLOCK - frozenset("caption legend td th tr tbody thead tfoot option optgroup figcaption summary".split()),
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "option": frozenset(["option", "optgroup"]),
    "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]),
    "head": frozenset(["body"]),
}
#: Looking for an element to close stops at these.
FENCE = {
    "p": frozenset("table td th button li article section div body main aside blockquote form nav header footer".split()),
    "li": frozenset("ul ol menu body".split()),
    "dt": frozenset(["dl"]),
    "dd": frozenset(["dl"]),
    "option": frozenset(["select"]),
    "td": frozenset(["table"]),
    "th": frozenset(["table"]),
    "tr": frozenset(["table"]),
    "head": frozenset(),
}
_ENDS = {kind: tuple(k for k, by in CLOSED_BY.items() if kind in by) for kind in set().union(*CLOSED_BY.values())}


@dataclass
class Page:
    """Elements in page order; ``texts`` are (element, decoded text), ``steps`` mark block borders too."""

    tag: list[str] = field(default_factory=list)
    words: list[frozenset[str]] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    steps: list[tuple[int, str | None]] = field(default_factory=list)


def attribute_words(attrs: str) -> frozenset[str]:
    """Lower-case words of class, id, role and similar attributes."""
    if "=" not in attrs:
        return frozenset()
    out = set()
    for name, a, b, c in _ATTR.findall(attrs):
        if name.lower() in ("class", "id", "role", "aria-label", "itemprop", "data-role"):
            out.update(_WORD.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", a or b or c).lower()))
    return frozenset(out)


def parse(source: str) -> Page:
    """Never fails: unknown, unclosed and misplaced tags are read as browsers roughly do."""
    page = Page()
    open_: list[int] = []

    def push(tag: str, words: frozenset[str]) -> int:
        page.tag.append(tag)
        page.words.append(words)
        page.parent.append(open_[-1] if open_ else -1)
        page.depth.append(len(open_))
        return len(page.tag) - 1

    def border() -> None:
        page.steps.append((open_[-1] if open_ else 0, None))

    open_.append(push("html", frozenset()))
    at, size = 0, len(source)
    match = _TOKEN.match
    while at < size:
        m = match(source, at)
        at = m.end()
        kind = m.lastgroup
        if kind == "text":
            page.steps.append((open_[-1], html.unescape(m["text"])))
        elif kind == "end":
            tag = m["end"].lower()
            for k in range(len(open_) - 1, 0, -1):
                if page.tag[open_[k]] == tag:
                    if any(page.tag[i] in BLOCK for i in open_[k:]):
                        border()
                    del open_[k:]
                    break
            else:
                if tag in BLOCK:
                    border()
        elif kind in ("attrs", "rest"):
            tag = (m["start"] or m["broken"]).lower()
            attrs = m["attrs"] if m["start"] else m["rest"]
            if tag == "html":
                continue
            if tag == "br":
                page.steps.append((open_[-1], " "))
                continue
            for kind_ in _ENDS.get(tag, ()):
                for k in range(len(open_) - 1, 0, -1):
                    name = page.tag[open_[k]]
                    if name == kind_:
                        border()
                        del open_[k:]
                        break
                    if name in FENCE[kind_]:
                        break
            if tag in BLOCK:
                border()
            node = push(tag, attribute_words(attrs))
            if tag in RAW:
                stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(source, at)
                at = stop.start() if stop else size
                end = source.find(">", at)
                at = end + 1 if end >= 0 else size
            elif tag not in VOID and not attrs.rstrip().endswith("/"):
                open_.append(node)
            elif tag in BLOCK and tag not in VOID:
                open_.append(node)
    return page
