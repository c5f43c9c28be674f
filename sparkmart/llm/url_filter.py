"""URL rules in a trie over reversed host labels and path segments.

The rules are a parameter of at most MAX_RULES entries, so the broadcast trie has a known
bound; longer rule lists are refused. A URL walks its host labels from the last to the first
and, at every host node, its path segments; the longest matching rule wins.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import arrow_schema, prepare

MAX_RULES = 1_000_000


@dataclass
class _Node:
    """A place in the trie. ``rests`` are rules that end inside the next segment: (rest, rule, verdict)."""

    below: dict[str, _Node] = field(default_factory=dict)
    paths: _Node | None = None
    rests: list[tuple[str, str, str]] = field(default_factory=list)


class UrlTrie:
    """Rules (verdict, host, path): a rule fits its host, all subdomains, and paths that start with its path.

    The longest rule wins: first more host labels, then the longer path. Of equal rules the
    first given one holds. Hosts are compared in lower case (A-Z).
    """

    def __init__(self, rules: Iterable[tuple[str, str, str]]):
        self.root = _Node()
        for i, (verdict, host, path) in enumerate(rules):
            if i >= MAX_RULES:
                raise ValueError(f"more than {MAX_RULES} rules")
            if verdict not in ("allow", "block"):
                raise ValueError(f"verdict must be allow or block: {verdict}")
            node = self.root
            for label in reversed(lower(host).split(".")) if host else ():
                node = node.below.setdefault(label, _Node())
            if node.paths is None:
                node.paths = _Node()
            node = node.paths
            *whole, rest = path.split("/")
            for segment in whole:
                node = node.below.setdefault(segment, _Node())
            if all(r[0] != rest for r in node.rests):
                node.rests.append((rest, lower(host) + path, verdict))
                node.rests.sort(key=lambda r: -len(r[0]))

    def match(self, host: str, path: str) -> tuple[str, str] | None:
        """(rule, verdict) of the longest rule that fits."""
        node, best, segments = self.root, None, path.split("/")
        labels = host.split(".") if host else []
        for label in [None, *reversed(labels)]:
            if label is not None:
                node = node.below.get(label)
                if node is None:
                    break
            best = _along(node.paths, segments) or best
        return best


def _along(node: _Node | None, segments: list[str]) -> tuple[str, str] | None:
    best = None
    for segment in segments:
        if node is None:
            break
        for rest, rule, verdict in node.rests:
            if segment.startswith(rest):
                best = (rule, verdict)
                break
        node = node.below.get(segment)
    return best


_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def lower(text: str) -> str:
    return text.translate(_LOWER)


def host_of(url: Column) -> Column:
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    upper, small = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(found, upper, small), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


DEFAULT_VERDICT = "allow"


def judge_urls(
    pages: DataFrame,
    rules: Iterable[tuple[str, str, str]],
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = DEFAULT_VERDICT,
) -> DataFrame:
    """Per row: the id, host, path, rule, verdict.

    The host lies after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; the path
    goes on up to ``?``, ``#`` or the end. Null urls, and those without ``://``, have an empty host and path.
    ``rule`` is host and path of the rule that won, null if none fits; the verdict is then ``default``.
    Repeated rows are judged alike, other columns are ignored, an empty table gives no rows.
    """
    spark = prepare(pages.sparkSession)
    trie = spark.sparkContext.broadcast(UrlTrie(rules))
    kind = dict(pages.select(id_col).dtypes)[id_col]
    ddl = f"`{id_col}` {kind}, host string, path string, rule string, verdict string"
    schema = arrow_schema(ddl)
    rows = pages.select(id_col, host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = trie.value.match
        for batch in batches:
            found = [match(h, p) or (None, default) for h, p in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            won = [pa.array([f[i] for f in found], pa.string()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *won], schema=schema)

    return rows.mapInArrow(work, ddl)
