"""Approximate nearest neighbours by largest inner product, with a forest of hash prefixes.

Each tree gives every vector a long hash string and keeps the strings sorted. The first symbol
is the vector's cluster, found on a bounded sample (0: in no dense cluster); the others are
cross-polytope hashes, under random rotations, of what remains when the cluster's centre is
taken away. A query visits every cluster that may hold one of its nearest: cluster 0, and those whose
largest possible inner product (from the angle to the centre and the widest angle of a member)
reaches what the sample alone offers. In each of them it descends to its longest matching prefixes
and then ascends in all trees at once, one symbol at a time, until the trees together hold enough
vectors under its prefixes; past the last symbol it takes the whole cluster. All candidates are
scored exactly.

How many are enough is measured: a bounded number of the queries are scored against all vectors,
and the candidates are raised from ``candidates`` until these find the share ``recall`` of their
nearest, if need be up to whole clusters. So the depth does not shrink as the table grows.

A sorted array is dealt to blocks of at most about ``block`` vectors by the first two symbols and
a hash of the id, so a common prefix is many blocks. Queries go to the blocks their prefix needs.
Candidates are scored where they lie; only the best of each block are sent on. Exact copies are
one vector in the index.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import arrow_schema, prepare, stored
from sparkmart.llm.textbytes import text_buffers


@dataclass(frozen=True)
class Forest:
    trees: int = 20
    digits: int = 4
    axes: int = 12
    #: The fewest candidates of a query and cluster, copies in several trees counted; raised to reach ``recall``.
    candidates: int = 16_000
    recall: float = 0.95
    #: Queries that are scored against all vectors to measure recall, at most about this many.
    probes: int = 256
    nearest: int = 20
    block: int = 4_096
    #: Clusters are looked for in at most about this many distinct vectors.
    sample: int = 20_000
    cluster_cosine: float = 0.8
    cluster_members: int = 50
    cluster_tries: int = 400
    seed: int = 100


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vector) of the rows that take part."""
    v = F.col("vector")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return rows.where(v.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(v, lambda x: x != 0) & F.col("vec_id").isNotNull())


def find_clusters(sample: np.ndarray, p: Forest) -> np.ndarray:
    """Centres of dense clusters: greedy over the sample, each with enough vectors around it."""
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    left, centres = np.ones(len(sample), bool), []
    order = np.random.default_rng(p.seed).permutation(len(sample))
    tries = 0
    for i in order:
        if not left[i]:
            continue
        tries += 1
        if tries > p.cluster_tries or len(centres) >= 4_000:
            break
        near = left & (unit @ unit[i] >= p.cluster_cosine)
        if near.sum() >= p.cluster_members:
            centre = sample[near].mean(axis=0)
            near = left & (unit @ (centre / np.linalg.norm(centre)) >= p.cluster_cosine)
            centres.append(sample[near].mean(axis=0))
            left &= ~near
    return np.array(centres).reshape(-1, sample.shape[1])


@dataclass
class Hasher:
    """Hash strings of vectors: two bytes of cluster, then one byte per digit."""

    centres: np.ndarray
    largest: float
    p: Forest
    #: Vectors of the index, from which a query learns what it can reach at least.
    sample: np.ndarray
    #: Widest angle of a member to its centre, by cluster; set once the index is hashed.
    widest: np.ndarray | None = None

    def __post_init__(self):
        size = self.centres.shape[1]
        self.turns = []
        for tree in range(self.p.trees):
            rng = np.random.default_rng(self.p.seed + tree)
            random = (rng.standard_normal((size, max(size, self.p.axes))) for _ in range(self.p.digits))
            self.turns.append([(np.linalg.qr(r)[0] if r.shape[0] == r.shape[1] else r)[:, : self.p.axes] for r in random])
        self.units = self.centres / np.linalg.norm(self.centres, axis=1, keepdims=True)
        # How members spread along the centre and the added component, against the other directions.
        self.planes, self.spreads = [], []
        x = self.widened(self.sample, False)
        cluster = self.clusters(x)[0]
        for c, centre in enumerate(self.centres):
            rest = x[cluster == c + 1] - centre
            plane = np.linalg.qr(np.stack([centre, np.eye(size)[-1]], axis=1))[0]
            along = rest @ plane
            others = ((rest * rest).sum() - (along * along).sum()) / max(1, size - 2)
            self.planes.append(plane)
            self.spreads.append(along.T @ along / others if others > 0 else np.eye(2))

    def widened(self, x: np.ndarray, query: bool) -> np.ndarray:
        """One more component makes all vectors equally long, so that the largest inner product is the smallest angle.

        The length of a query does not change its order, so it is stretched to that of indexed vectors.
        """
        if query:
            x = x * (self.largest / np.linalg.norm(x, axis=1, keepdims=True))
            return np.column_stack([x, np.zeros(len(x))])
        return np.column_stack([x, np.sqrt(np.maximum(self.largest**2 - (x * x).sum(axis=1), 0))])

    def clusters(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cluster of each widened index vector, and its angle to the centre (0 in cluster 0)."""
        cluster, angle = np.zeros(len(x), np.int64), np.zeros(len(x))
        if len(self.centres):
            cosine = x @ self.units.T / np.linalg.norm(x, axis=1, keepdims=True)
            best = cosine.argmax(axis=1)
            top = cosine[np.arange(len(x)), best]
            inside = top >= self.p.cluster_cosine
            cluster[inside] = best[inside] + 1
            angle[inside] = np.arccos(np.minimum(top[inside], 1.0))
        return cluster, angle

    def visits(self, x: np.ndarray) -> np.ndarray:
        """[row, cluster]: whether a widened query must visit a cluster; no other cluster holds any of its nearest."""
        out = np.ones((len(x), 1 + len(self.centres)), bool)
        top = self.p.nearest + 1  # the query itself may be one of them
        if len(self.centres) and len(self.sample) >= top:
            for start in range(0, len(x), 256):
                some = x[start : start + 256]
                floor = -np.partition(-(some[:, :-1] @ self.sample.T), top - 1, axis=1)[:, top - 1]
                angle = np.arccos(np.clip(some @ self.units.T / self.largest, -1, 1))
                most = self.largest**2 * np.cos(np.maximum(angle - self.widest, 0))
                out[start : start + 256, 1:] = most >= floor[:, None] - 1e-6 * self.largest**2
        return out

    def _digits(self, x: np.ndarray, cluster: np.ndarray) -> np.ndarray:
        out = np.empty((self.p.trees, len(x), 2 + self.p.digits), np.uint8)
        out[:, :, 0], out[:, :, 1] = cluster >> 8, cluster & 255
        for tree, turns in enumerate(self.turns):
            for digit, turn in enumerate(turns):
                y = x @ turn
                axis = np.abs(y).argmax(axis=1)
                out[tree, :, 2 + digit] = 2 * axis + (y[np.arange(len(x)), axis] < 0)
        return out

    def strings(self, x: np.ndarray) -> np.ndarray:
        """[tree, row, byte] of index vectors."""
        x = self.widened(x.astype(np.float64), False)
        cluster, _ = self.clusters(x)
        inside = cluster > 0
        x[inside] -= self.centres[cluster[inside] - 1]
        return self._digits(x, cluster)

    def query_strings(self, x: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows, [tree, row, byte]) for each cluster and the queries that visit it."""
        x = self.widened(x.astype(np.float64), True)
        visits = self.visits(x)
        for c in range(visits.shape[1]):
            rows = np.flatnonzero(visits[:, c])
            if not len(rows):
                continue
            some = x[rows]
            if c:
                # Where in the cluster the largest inner products are expected, given how its members spread.
                plane = self.planes[c - 1]
                some = some + some @ plane @ (self.spreads[c - 1] - np.eye(2)) @ plane.T
            yield rows, self._digits(some, np.full(len(rows), c))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    body, bounds = text_buffers(column)
    return body[bounds[0] : bounds[-1]].copy().view(np.float64).reshape(-1, size)


HASHED = "tree int, hash binary, rep long, vector binary"
PREFIX = ("tree", "first")


def hashed(vectors: DataFrame, hasher, query: bool) -> DataFrame:
    """A row per vector (rep, vector) and tree, with the first three bytes of its string as ``first``.

    A query has such rows for each cluster it visits.
    """
    schema = arrow_schema(HASHED)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.array(batch.column(1).to_pylist(), np.float64)
            raw = pa.array([v.tobytes() for v in x], pa.binary())
            parts = hasher.value.query_strings(x) if query else [(np.arange(len(x)), hasher.value.strings(x))]
            for which, strings in parts:
                take = pa.array(which)
                reps, bodies = batch.column(0).take(take), raw.take(take)
                for tree, rows in enumerate(strings):
                    names = pa.array([r.tobytes() for r in rows], pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(which), tree, np.int32)), names, reps, bodies], schema=schema)

    rows = vectors.select("rep", "vector").mapInArrow(work, HASHED)
    return rows.withColumn("first", F.substring("hash", 1, 3))


def widest_angles(vectors: DataFrame, hasher, count: int) -> np.ndarray:
    """Of each of the ``count`` clusters, the widest angle of a member to the centre."""
    ddl = "cluster long, angle double"
    schema = arrow_schema(ddl)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        widest = np.zeros(count + 1)
        for batch in batches:
            if batch.num_rows:
                x = np.array(batch.column(0).to_pylist(), np.float64)
                np.maximum.at(widest, *hasher.value.clusters(hasher.value.widened(x, False)))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(count + 1)), pa.array(widest)], schema=schema)

    out = np.zeros(count + 1)
    for r in vectors.select("vector").mapInArrow(work, ddl).groupBy("cluster").agg(F.max("angle").alias("angle")).collect():
        out[r["cluster"]] = r["angle"]
    return out[1:]


def probe_matches(vectors: DataFrame, probes: list, hasher: Hasher) -> list[tuple[int, int, int]]:
    """(rep, cluster, digits) for the nearest of each probe among all vectors.

    ``cluster`` is that of the neighbour, ``digits`` its longest common prefix with the probe in any tree;
    -1 where the probe does not visit the cluster.
    """
    p = hasher.p
    ddl = "rep long, other long, score double"
    schema = arrow_schema(ddl)
    ids = np.array([r["rep"] for r in probes], np.int64)
    queries = np.array([r["vector"] for r in probes], np.float64)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, others = np.full((len(ids), p.nearest), -np.inf), np.zeros((len(ids), p.nearest), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            reps, x = batch.column(0).to_numpy(), np.array(batch.column(1).to_pylist(), np.float64)
            scores = queries @ x.T
            scores[ids[:, None] == reps[None, :]] = -np.inf
            scores = np.concatenate([best, scores], axis=1)
            names = np.concatenate([others, np.broadcast_to(reps, (len(ids), len(reps)))], axis=1)
            top = np.argpartition(-scores, p.nearest - 1, axis=1)[:, : p.nearest]
            best, others = np.take_along_axis(scores, top, axis=1), np.take_along_axis(names, top, axis=1)
        row, col = np.nonzero(np.isfinite(best))
        yield pa.RecordBatch.from_arrays([pa.array(ids[row]), pa.array(others[row, col]), pa.array(best[row, col])], schema=schema)

    found = vectors.select("rep", "vector").mapInArrow(work, ddl)
    order = F.expr("row_number() over (partition by rep order by score desc, other)")
    found = found.withColumn("place", order).where(F.col("place") <= p.nearest)
    near = found.select("rep", "other").join(vectors.select(F.col("rep").alias("other"), "vector"), "other").collect()
    if not near:
        return []
    asked = {}
    for rows, strings in hasher.query_strings(queries):
        cluster = int.from_bytes(strings[0, 0, :2].tobytes(), "big")
        asked.update({(int(ids[r]), cluster): strings[:, k, 2:] for k, r in enumerate(rows)})
    out = []
    every = hasher.strings(np.array([r["vector"] for r in near], np.float64))
    for k, r in enumerate(near):
        cluster = int.from_bytes(every[0, k, :2].tobytes(), "big")
        wanted = asked.get((r["rep"], cluster))
        digits = -1 if wanted is None else int(np.cumprod(every[:, k, 2:] == wanted, axis=1).sum(axis=1).max())
        out.append((r["rep"], cluster, digits))
    return out


def enough_candidates(matches: list, counts: dict, p: Forest) -> float:
    """The fewest candidates, from ``p.candidates`` in doublings, with which the probes find the share ``recall``.

    ``counts``: by (rep, cluster), vectors under each longer prefix. Two standard errors are left as a margin.
    Infinity stands for whole clusters.
    """
    needed = float(p.candidates)
    most = max((c[0] for c in counts.values()), default=0)
    while needed <= most:
        found: dict[int, list[bool]] = {}
        for rep, cluster, digits in matches:
            held = counts.get((rep, cluster), ())
            level = max((d for d, c in enumerate(held, 1) if c >= needed), default=0)
            found.setdefault(rep, []).append(digits >= level)
        share = np.array([np.mean(f) for f in found.values()])
        if not len(share) or share.mean() - 2 * share.std() / np.sqrt(len(share)) >= p.recall:
            return needed
        needed *= 2
    return float("inf") if most >= p.candidates else needed


def _dealt(index: DataFrame, asked: DataFrame, sizes: DataFrame, p: Forest) -> DataFrame:
    """Index and query rows of each block together, index rows first, strings in order.

    ``index``: tree, first, hash, rep, vector; ``asked``: tree, first, blocks, hash, rep, vector, level.
    """
    keys = ["tree", "first", "block"]
    own = index.join(sizes, list(PREFIX)).withColumn("block", F.pmod(F.xxhash64("rep"), "blocks").cast("int"))
    own = own.select(*keys, F.lit(0).alias("kind"), "hash", "rep", "vector", F.lit(0).alias("level"))
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    asked = asked.select(*keys, F.lit(1).alias("kind"), "hash", "rep", "vector", "level")
    return own.unionByName(asked).repartition(*keys).sortWithinPartitions(*keys, "kind", "hash")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, pa.RecordBatch]]:
    """(index rows, some of the queries) of each block; queries are not held."""
    held: list[pa.RecordBatch] = []
    table, last = None, None
    for batch in batches:
        keys = list(zip(*(batch.column(i).to_pylist() for i in range(4))))
        start = 0
        for i in range(1, len(keys) + 1):
            if i < len(keys) and keys[i] == keys[start]:
                continue
            *block, kind = keys[start]
            if block != last:
                held, table, last = [], None, block
            part = batch.slice(start, i - start)
            if kind == 0:
                held.append(part)
                table = None
            elif held:
                table = table if table is not None else pa.Table.from_batches(held).combine_chunks()
                yield table, part
            start = i


def _ranges(strings: np.ndarray, asked: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the sorted strings begin with the first ``length`` bytes of each asked string."""
    cut = np.ascontiguousarray(strings[:, :length]).view(f"S{length}").ravel() if length else None
    if cut is None:
        return np.zeros(len(asked), np.int64), np.full(len(asked), len(strings), np.int64)
    # Comparison as padded byte strings keeps their order, as symbols are shifted off zero below.
    wanted = np.ascontiguousarray(asked[:, :length]).view(f"S{length}").ravel()
    return np.searchsorted(cut, wanted, "left"), np.searchsorted(cut, wanted, "right")


def _strings(column) -> np.ndarray:
    body, bounds = text_buffers(column)
    n = len(bounds) - 1
    # Zero bytes at the end of a fixed-width string would be dropped: no symbol is zero here.
    return (body[bounds[0] : bounds[-1]].reshape(n, -1).astype(np.uint16) + 1).astype(np.uint8)


def count_prefixes(index: DataFrame, asked: DataFrame, sizes: DataFrame, p: Forest) -> DataFrame:
    """(rep, cluster, counts): vectors under each longer prefix of a query, from one digit to all, in all trees."""
    ddl = "rep long, cluster binary, " + ", ".join(f"c{d} long" for d in range(1, p.digits + 1))
    schema = arrow_schema(ddl)
    empty = F.lit(b"")
    index = index.select("tree", "first", "hash", "rep", empty.alias("vector"))
    asked = asked.join(sizes, list(PREFIX)).withColumn("vector", empty).withColumn("level", F.lit(0))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, queries in _blocks(batches):
            strings, wanted = _strings(table.column("hash")), _strings(queries.column(4))
            counts = []
            names = pa.array([h[:2] for h in queries.column(4).to_pylist()], pa.binary())
            for digit in range(1, p.digits + 1):
                low, high = _ranges(strings, wanted, 2 + digit)
                counts.append(pa.array(high - low))
            yield pa.RecordBatch.from_arrays([queries.column(5), names, *counts], schema=schema)

    rows = _dealt(index, asked, sizes, p).mapInArrow(work, ddl)
    return rows.groupBy("rep", "cluster").agg(*(F.sum(f"c{d}").alias(f"c{d}") for d in range(1, p.digits + 1)))


FOUND = "rep long, other long, score double"


def score_blocks(index: DataFrame, asked: DataFrame, sizes: DataFrame, size: int, p: Forest) -> DataFrame:
    """(rep, other, score): the nearest of each query in each block it was sent to."""
    schema = arrow_schema(FOUND)
    top = p.nearest + 1

    def best(index: pa.Table, x: np.ndarray, queries: np.ndarray, low: int, high: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        ids = index.column("rep").to_numpy()[low:high]
        for start in range(0, len(queries), 256):
            some = queries[start : start + 256]
            rough = some @ x[low:high].T
            keep = min(len(ids), top + 8)
            near = np.argpartition(-rough, keep - 1, axis=1)[:, :keep]
            for k, row in enumerate(near):
                # The same order of additions for every pair, so copies of a pair agree to the bit.
                score = (x[low:high][row] * some[k]).sum(axis=1)
                order = np.lexsort((ids[row], -score))[:top]
                yield start + k, ids[row][order], score[order]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, asked in _blocks(batches):
            strings, wanted = _strings(table.column("hash")), _strings(asked.column(4))
            x, queries = _matrix(table.column("vector").combine_chunks(), size), _matrix(asked.column(6), size)
            reps, levels = asked.column(5).to_numpy(), asked.column(7).to_numpy()
            out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for level in np.unique(levels):
                rows = np.flatnonzero(levels == level)
                # Whole clusters and all vectors take the block as it is.
                low, high = _ranges(strings, wanted[rows], 2 + int(level) if level > 0 else 0)
                for a, b in np.unique(np.stack([low, high], axis=1), axis=0):
                    if a == b:
                        continue
                    same = rows[(low == a) & (high == b)]
                    for k, ids, score in best(table, x, queries[same], a, b):
                        out.append((np.full(len(ids), reps[same[k]]), ids, score))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], schema=schema)

    return _dealt(index, asked, sizes, p).mapInArrow(work, FOUND)


def nearest_neighbours(vectors: DataFrame, queries: DataFrame, p: Forest = Forest(), id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """For each row of ``queries``, a subset of the rows of ``vectors``: query_id, rank, vec_id, score.

    The ``nearest`` found, nearest first, ties to the smaller vec_id; all candidates if there are fewer.
    A query is not its own neighbour (same id). Every row of ``vectors`` is indexed.

    - Vectors that are null, zero or hold null or non-finite components take no part on either side,
      nor do rows without an id, nor vectors of another length than the most frequent one (the
      longer of equally frequent ones).
    - Copies are neighbours like any others. Other columns are ignored; an empty table gives no rows.
    """
    spark = prepare(vectors.sparkSession)
    rows, asking = usable(vectors, id_col, vector_col), usable(queries, id_col, vector_col)
    lengths = rows.groupBy(F.size("vector").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    top = lengths.orderBy(F.desc("n"), F.desc("size")).first()
    size = top["size"] if top else 1
    rows, asking = (d.where(F.size("vector") == size) for d in (rows, asking))

    # Of exact copies only the smallest ids can ever be among the nearest.
    order = F.expr("row_number() over (partition by vector order by vec_id)")
    few = rows.withColumn("place", order).where(F.col("place") <= p.nearest + 1)
    reps = few.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    reps = stored(reps.select(F.element_at("ids", 1).alias("rep"), "vector", "ids"), "vectors")
    asking = stored(asking.join(reps.select("vector", "rep"), "vector").select(F.col("vec_id").alias("query_id"), "rep"), "queries")

    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    count, largest = reps.agg(F.count(F.lit(1)), F.max(norm)).first()
    share = min(1.0, p.sample / max(1, count))
    picked = reps.where(F.pmod(F.xxhash64("rep"), F.lit(1_000_000)) < F.lit(int(share * 1_000_000)))
    sample = np.array([r["vector"] for r in picked.orderBy("rep").select("vector").collect()], np.float64).reshape(-1, size)
    hasher = Hasher(np.empty((0, size + 1)), float(largest or 0.0), p, sample)
    if len(sample):
        hasher = Hasher(find_clusters(hasher.widened(sample, False), p), float(largest), p, sample)
    shared = spark.sparkContext.broadcast(hasher)
    if len(hasher.centres):
        hasher.widest = widest_angles(reps, shared, len(hasher.centres))
        shared = spark.sparkContext.broadcast(hasher)

    index = stored(hashed(reps, shared, query=False), "index")
    asking_reps = asking.select("rep").distinct().join(reps.select("rep", "vector"), "rep")
    wanted = stored(hashed(asking_reps, shared, query=True), "asked")
    sizes = index.groupBy(*PREFIX).agg(F.count(F.lit(1)).alias("members"))
    sizes = stored(sizes.withColumn("blocks", F.ceil(F.col("members") / p.block).cast("int")), "sizes")
    blocks = sizes.select(*PREFIX, "blocks")

    counts = stored(count_prefixes(index, wanted, blocks, p), "counts")
    probes = asking_reps.orderBy(F.xxhash64("rep", F.lit(p.seed)), "rep").limit(p.probes).collect()
    needed = float(p.candidates)
    if probes:
        matches = probe_matches(reps, probes, hasher)
        held = counts.where(F.col("rep").isin([r["rep"] for r in probes])).collect()
        held = {(r["rep"], int.from_bytes(r["cluster"], "big")): tuple(r[f"c{d}"] for d in range(1, p.digits + 1)) for r in held}
        needed = enough_candidates(matches, held, p)

    cluster = F.substring("hash", 1, 2)
    wanted = wanted.withColumn("cluster", cluster)
    enough = F.lit(0)
    for d in range(1, p.digits + 1):
        enough = F.when(F.col(f"c{d}") >= F.lit(needed), F.lit(d)).otherwise(enough)
    # Where no first digit is shared there are no counts: the whole cluster is taken.
    level = counts.select("rep", "cluster", enough.alias("level"))
    asked = wanted.join(level, ["rep", "cluster"], "left").withColumn("level", F.coalesce("level", F.lit(0)))
    deep = asked.where("level >= 1").drop("cluster").join(blocks, list(PREFIX))
    flat = blocks.where("tree = 0").withColumn("cluster", F.substring("first", 1, 2))
    whole = asked.where("level = 0 and tree = 0").drop("tree", "first").join(flat, "cluster").drop("cluster")
    sent = deep.unionByName(whole)
    found = score_blocks(index, sent, blocks, size, p)

    best = F.expr("dense_rank() over (partition by rep order by score desc, other)")
    found = found.withColumn("place", best).where(F.col("place") <= p.nearest + 1).select("rep", "other", "score").distinct()
    found = found.join(reps.select(F.col("rep").alias("other"), "ids"), "other").select("rep", "score", F.explode("ids").alias("vec_id"))
    best = F.expr("row_number() over (partition by rep order by score desc, vec_id)")
    found = found.withColumn("place", best).where(F.col("place") <= p.nearest + 1).drop("place")
    out = asking.join(found, "rep").where("vec_id <> query_id")
    rank = F.expr("row_number() over (partition by query_id order by score desc, vec_id)")
    out = out.withColumn("rank", rank).where(F.col("rank") <= p.nearest)
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
