"""Near-duplicate documents: banded MinHash, sequential Bayesian verification, exact links.

Steps, each over all documents:

1. Every text gives its set of distinct word shingles, a MinHash signature and a key of the
   whole set. Documents with equal sets are one node, so copies are never compared.
2. Signature bands put nodes into buckets. A first round compares the members of each
   bucket with its smallest node only, which joins tight groups in one linear pass.
3. Where a bucket still holds several components, its members are compared block against
   block inside tasks, signature batch by signature batch: a pair is dropped once the
   posterior probability that its similarity reaches the threshold falls below
   the batch's share of ``miss_probability``. Documents that share a bucket get ``wide`` more hashes of one byte
   for this, so that few pairs below the threshold are left for the texts to decide. Only pairs of different components with compatible sizes are
   looked at, each in its first common band. Blocks bound the memory of a task.
4. Pairs that survive are verified on their full shingle sets, recomputed from the texts.

Links between nodes that are already connected through other verified links are not
verified again: they cannot change a component.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import arrow_schema, prepare, row_groups, stored, text_of
from sparkmart.llm.components import connected_components
from sparkmart.llm.textbytes import chunks, doc_words, mix, shingles, text_buffers


@dataclass(frozen=True)
class NearDedup:
    """Parameters. ``similarity`` is in hundredths, so that the threshold is exact.

    ``bands`` x ``rows`` hashes make a signature. A pair at the threshold s shares no band with
    probability (1 - s^rows)^bands; there are as many bands as make this ``band_miss`` at most.
    All signature batches together drop a pair at the threshold wrongly with probability
    ``miss_probability`` at most.
    """

    words: int = 5
    similarity: int = 80
    band_miss: float = 1e-5
    rows: int = 6
    batch: int = 16
    wide: int = 512
    wide_batch: int = 64
    miss_probability: float = 1e-4
    block: int = 256

    @property
    def bands(self) -> int:
        apart = 1 - (self.similarity / 100) ** self.rows
        return max(1, math.ceil(math.log(self.band_miss) / math.log(apart))) if apart > 0 else 1

    @property
    def hashes(self) -> int:
        return self.bands * self.rows

    def tests(self) -> list[tuple[int, int, int]]:
        """(from, to, fewest equal hashes so far) of each signature batch, over both signatures."""
        ends = [*range(self.batch, self.hashes, self.batch), self.hashes]
        ends += [*range(self.hashes + self.wide_batch, self.hashes + self.wide, self.wide_batch), self.hashes + self.wide]
        least = (fewest_matches(n, self.similarity / 100, self.miss_probability / len(ends)) for n in ends)
        return list(zip([0, *ends], ends, least))


@cache
def _functions(hashes: int) -> tuple[np.ndarray, np.ndarray]:
    """Factors and summands; those of fewer hashes are the first of more."""
    numbers = np.random.default_rng(7).integers(0, 2**32, (hashes, 2), dtype=np.uint32)
    return numbers[:, :1] | np.uint32(1), numbers[:, 1:]


def signature(items: np.ndarray, hashes: int) -> np.ndarray:
    odd, add = _functions(hashes)
    x = (items >> np.uint64(32)).astype(np.uint32)
    out = np.full(hashes, 0xFFFFFFFF, dtype=np.uint32)
    for i in range(0, len(x), 2048):
        np.minimum(out, (x[None, i : i + 2048] * odd + add).min(axis=1), out=out)
    return out


@cache
def fewest_matches(n: int, threshold: float, miss: float) -> int:
    """With fewer equal hashes of n than this a pair is dropped.

    With a uniform prior the posterior of the similarity is Beta(m + 1, n - m + 1), and
    P(similarity >= t) equals P(Binomial(n + 1, t) <= m). One-byte hashes also agree by
    chance, once in 256, which only makes a drop rarer.
    """
    if threshold >= 1:
        return n
    total, near, far = 0.0, math.log(threshold), math.log1p(-threshold)
    for m in range(n + 1):
        ways = math.lgamma(n + 2) - math.lgamma(m + 1) - math.lgamma(n + 2 - m)
        total += math.exp(ways + m * near + (n + 1 - m) * far)
        if total >= miss:
            return m
    return n


FINGERPRINT = "doc_id long, n_shingles long, set_a long, set_b long, signature binary"


def fingerprints(docs: DataFrame, p: NearDedup, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: size of the shingle set, a 128-bit key of the set, and the signature (null if empty)."""
    schema = arrow_schema(FINGERPRINT)
    twist = np.uint64(0xD6E8FEB86659FD93)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body, bounds = text_buffers(batch.column(1))
            n = batch.num_rows
            size, keys, signs = np.zeros(n, np.int64), np.zeros((2, n), np.uint64), [None] * n
            for lo, hi in chunks(bounds):
                words, first = doc_words(body, bounds[lo : hi + 1])
                for r in range(lo, hi):
                    items = shingles(words[first[r - lo] : first[r - lo + 1]], p.words)
                    size[r] = len(items)
                    if len(items):
                        keys[0, r] = mix(items).sum()
                        keys[1, r] = mix(items ^ twist).sum()
                        signs[r] = signature(items, p.hashes).tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size), *(pa.array(k.view(np.int64)) for k in keys), pa.array(signs, pa.binary())],
                schema=schema,
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(F.col(text_col)).alias("text"))
    return rows.mapInArrow(work, FINGERPRINT)


NODE = "doc_id long, n_shingles long, signature binary, wide binary"


def wide_signatures(texts: DataFrame, p: NearDedup) -> DataFrame:
    """Both signatures of (doc_id, text); the wide one has further hashes, of which one byte is kept."""
    schema = arrow_schema(NODE)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for items in _sets(batch.column(1), p.words):
                every = signature(items, p.hashes + p.wide)
                last = (every[p.hashes :] >> np.uint32(8)).astype(np.uint8)
                rows.append((len(items), every[: p.hashes].tobytes(), last.tobytes()))
            columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(schema.types[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], schema=schema)

    return texts.mapInArrow(work, NODE)


def _sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    body, bounds = text_buffers(column)
    for lo, hi in chunks(bounds):
        words, first = doc_words(body, bounds[lo : hi + 1])
        for r in range(hi - lo):
            yield shingles(words[first[r] : first[r + 1]], width)


def _hashes(column: pa.Array | pa.ChunkedArray, kind: type, n: int) -> np.ndarray:
    """A column of equally long binaries as rows of n numbers."""
    body, bounds = text_buffers(column)
    return body[bounds[0] : bounds[-1]].copy().view(kind).reshape(-1, n)


class _Signatures:
    def __init__(self, signature, wide, p: NearDedup):
        self.narrow, self.wide = _hashes(signature, np.uint32, p.hashes), _hashes(wide, np.uint8, p.wide)

    def batch(self, rows: np.ndarray, start: int, end: int) -> np.ndarray:
        n = self.narrow.shape[1]
        return self.narrow[rows, start:end] if end <= n else self.wide[rows, start - n : end - n]


def _plausible(x: _Signatures, y: _Signatures, alive: np.ndarray, tests: list[tuple[int, int, int]]) -> np.ndarray:
    """Of the index pairs in ``alive``, those no batch of hashes rules out."""
    matches = np.zeros(len(alive), np.int32)
    for start, end, least in tests:
        equal = x.batch(alive[:, 0], start, end) == y.batch(alive[:, 1], start, end)
        matches += equal.sum(axis=1, dtype=np.int32)
        keep = matches >= least
        alive, matches = alive[keep], matches[keep]
        if not len(alive):
            break
    return alive


def _sizes_fit(a: np.ndarray, b: np.ndarray, similarity: int) -> np.ndarray:
    return 100 * np.minimum(a, b) >= similarity * np.maximum(a, b)


def prune_pairs(pairs: DataFrame, nodes: DataFrame, p: NearDedup) -> DataFrame:
    """Of the pairs (x, y), those that the signatures leave plausible."""
    tests = p.tests()
    left = nodes.select(*(F.col(c).alias(f"{c}_x") for c in nodes.columns)).withColumnRenamed("doc_id_x", "x")
    right = nodes.select(*(F.col(c).alias(f"{c}_y") for c in nodes.columns)).withColumnRenamed("doc_id_y", "y")
    both = pairs.join(left, "x").join(right, "y")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (_Signatures(batch.column(f"signature_{s}"), batch.column(f"wide_{s}"), p) for s in "xy")
            sizes = (batch.column(f"n_shingles_{s}").to_numpy() for s in "xy")
            fit = np.flatnonzero(_sizes_fit(*sizes, p.similarity))
            kept = _plausible(x, y, np.stack([fit, fit], axis=1), tests)[:, 0]
            yield batch.select(["x", "y"]).take(pa.array(kept))

    return both.mapInArrow(work, "x long, y long")


def verify_pairs(pairs: DataFrame, texts: DataFrame, p: NearDedup) -> DataFrame:
    """Of the pairs (x, y), those whose full shingle sets are similar enough."""
    left = texts.select(F.col("doc_id").alias("x"), F.col("text").alias("tx"))
    right = texts.select(F.col("doc_id").alias("y"), F.col("text").alias("ty"))
    both = pairs.join(left, "x").join(right, "y").select("x", "y", "tx", "ty")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for r, (a, b) in enumerate(zip(_sets(batch.column(2), p.words), _sets(batch.column(3), p.words))):
                both = len(np.intersect1d(a, b, assume_unique=True))
                if both and 100 * both >= p.similarity * (len(a) + len(b) - both):
                    linked.append(r)
            yield batch.select(["x", "y"]).take(pa.array(linked, pa.int64()))

    return both.mapInArrow(work, "x long, y long")


def compare_blocks(rows: DataFrame, p: NearDedup) -> DataFrame:
    """Plausible pairs (x, y) of different components within the buckets of ``rows``.

    ``rows``: bucket, band, doc_id, center, component, members, n_shingles, signature, wide. A bucket
    of n members is cut into n / block blocks, and each pair of blocks is one group, so no
    task holds more than two blocks however large a bucket is.
    """
    tests = p.tests()
    blocks = F.ceil(F.col("members") / F.lit(p.block)).cast("int")
    own = F.pmod(F.xxhash64("doc_id"), blocks).cast("int")
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    rows = rows.withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other"))
    keys = ["bucket", "low", "high"]
    rows = rows.select(*keys, "own", "band", "doc_id", "center", "component", "n_shingles", "signature", "wide")
    dealt = rows.repartition(*keys).sortWithinPartitions(*keys, "doc_id")
    schema = arrow_schema("x long, y long")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in row_groups(batches, keys):
            if group.num_rows < 2:
                continue
            col = {c: group.column(c).to_numpy() for c in ("own", "doc_id", "component", "n_shingles")}
            low, high = group.column("low")[0].as_py(), group.column("high")[0].as_py()
            band, center = group.column("band")[0].as_py(), group.column("center")[0].as_py()
            signs = _Signatures(group.column("signature"), group.column("wide"), p)
            ids = col["doc_id"]
            for i in range(len(ids)):
                if ids[i] == center:
                    continue
                j = np.arange(i + 1, len(ids))
                if low != high:
                    j = j[col["own"][j] != col["own"][i]]
                j = j[(col["component"][j] != col["component"][i]) & (ids[j] != center)]
                j = j[_sizes_fit(col["n_shingles"][j], col["n_shingles"][i], p.similarity)]
                if not len(j):
                    continue
                pair = _plausible(signs, signs, np.stack([np.full(len(j), i), j], axis=1), tests)
                if len(pair) and band:
                    same = signs.batch(pair[:, 0], 0, band * p.rows) == signs.batch(pair[:, 1], 0, band * p.rows)
                    earlier = same.reshape(len(pair), band, p.rows).all(axis=2).any(axis=1)
                    pair = pair[~earlier]
                if len(pair):
                    a, b = ids[pair[:, 0]], ids[pair[:, 1]]
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], schema=schema)

    return dealt.mapInArrow(work, "x long, y long")


def near_duplicates(docs: DataFrame, p: NearDedup = NearDedup(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest linked doc_id), kept.

    - Null or empty texts have no shingles, are linked with nothing and are kept.
    - A row without an id takes no part in links: component_id is null and it is kept.
    - Rows that repeat an id are one node, linked if any of them is.
    - Other columns are ignored, whatever their names. An empty table gives no rows.
    """
    spark = prepare(docs.sparkSession)
    prints = stored(fingerprints(docs, p, id_col, text_col), "fingerprints")
    known = prints.where("n_shingles > 0 and doc_id is not null")
    sets = known.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("node"))
    nodes = known.join(sets.select(F.col("node").alias("doc_id")).distinct(), "doc_id", "left_semi")
    nodes = stored(nodes.select("doc_id", "n_shingles", "signature"), "nodes")

    width = 4 * p.rows
    keys = F.array(*(F.xxhash64(F.substring("signature", 1 + b * width, width), F.lit(b)) for b in range(p.bands)))
    banded = nodes.select("doc_id", F.posexplode(keys).alias("band", "bucket"))
    heads = banded.groupBy("bucket", "band").agg(F.min("doc_id").alias("center"), F.max("doc_id").alias("last"), F.count(F.lit(1)).alias("members"))
    heads = heads.where("center < last").drop("last")
    buckets = stored(banded.join(heads, ["bucket", "band"]), "buckets")

    near = buckets.select("doc_id").distinct()
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(F.col(text_col)).alias("text"))
    texts = stored(texts.join(near.hint("merge"), "doc_id", "left_semi"), "near-texts")
    near_nodes = stored(wide_signatures(texts, p), "near-nodes")

    first = buckets.where("doc_id <> center").select(F.col("center").alias("x"), F.col("doc_id").alias("y")).distinct()
    links = verify_pairs(prune_pairs(first, near_nodes, p), texts, p)
    joined = stored(connected_components(links.toDF("a", "b"), "star"), "star")

    component = F.coalesce("component", "doc_id")
    placed = buckets.join(joined.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("component", component)
    open_ = placed.groupBy("bucket", "band").agg(F.min("component").alias("least"), F.max("component").alias("most"))
    open_ = open_.where("least < most").select("bucket", "band")
    rows = placed.join(open_, ["bucket", "band"]).join(near_nodes, "doc_id")
    more = verify_pairs(compare_blocks(rows, p).distinct(), texts, p)
    links = more.toDF("a", "b").unionByName(joined.select(F.col("node").alias("a"), F.col("component").alias("b")))
    final = connected_components(links, "all")

    nodes_of = sets.join(final.withColumnRenamed("node", "n"), F.col("n") == F.col("node"), "left")
    nodes_of = nodes_of.select("set_a", "set_b", F.coalesce("component", "node").alias("component"))
    ids = prints.select("doc_id", "n_shingles", "set_a", "set_b")
    found = ids.where("n_shingles > 0 and doc_id is not null").join(nodes_of, ["set_a", "set_b"])
    alone = ids.where("n_shingles = 0 or doc_id is null").withColumn("component", F.col("doc_id"))
    out = found.select("doc_id", "n_shingles", "component").unionByName(alone.select("doc_id", "n_shingles", "component"))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    return out.select("doc_id", "n_shingles", F.col("component").alias("component_id")).withColumn("kept", kept)
