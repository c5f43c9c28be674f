"""Toxicity from class-conditional Kneser-Ney models.

Two models over the bytes of words, one learned from toxic and one from ordinary labelled
documents, give each byte a probability after the up to four bytes before it in its word.
Their highest order has its own counts per class, discounted absolutely; all that is left of
the mass goes to one shared backoff, whose lower orders are Kneser-Ney continuation counts of
both classes together. Rare spellings are so smoothed alike in both classes.

The log-likelihood ratio of a word is the sum over its bytes. A document is compared by ratios
normalised by length: the mean over all its words, over its five most toxic words, and the most
toxic word. A logistic curve turns them into a score; it is fitted on ratios from models that
have not seen the document (each half of the labelled rows is scored by the other's counts).

All labelled rows that may be learned from are counted. Only the curve's four numbers are
fitted on a sample of at most about ``calibration_rows``. The models are sent to the workers as
tables of exact spellings, one entry for each that was counted: what was seen, what was not and
what only shares a context are never confused, and the tables grow with the distinct spellings.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import arrow_schema, held_out, learned, prepare, stored, text_of
from sparkmart.llm.textbytes import byte_grams, text_buffers, text_pieces

ORDER = 5
TOP = 5
#: Classes by half of the labelled rows: toxic a, toxic b, ordinary a, ordinary b.
COUNTS = ("ta", "tb", "oa", "ob")


@dataclass(frozen=True)
class Toxicity:
    discount: float = 0.75
    calibration_rows: int = 20_000
    threshold: float = 0.7


def _merge(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    every, which = np.unique(np.concatenate(codes), return_inverse=True)
    each = np.concatenate(counts, axis=1)
    return every, np.stack([np.bincount(which, weights=row, minlength=len(every)) for row in each])


def count_grams(rows: DataFrame) -> DataFrame:
    """(code, ta, tb, oa, ob): in how many documents of each class and half a gram occurs.

    ``rows``: text, group (index into COUNTS). Each task combines its counts before the shuffle
    and hands them on whenever they reach two million entries.
    """
    ddl = "code long, ta long, tb long, oa long, ob long"
    schema = arrow_schema(ddl)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        fresh = 0

        def flush(every, each):
            for i in range(0, len(every), 50_000):
                part = [pa.array(every[i : i + 50_000].view(np.int64))]
                part += [pa.array(row[i : i + 50_000].astype(np.int64)) for row in each]
                yield pa.RecordBatch.from_arrays(part, schema=schema)

        for batch in batches:
            body, bounds = text_buffers(batch.column(0))
            for r, group in enumerate(batch.column(1).to_pylist()):
                pieces = [np.unique(byte_grams(p, ORDER)[0]) for p in text_pieces(body, bounds[r], bounds[r + 1])]
                if pieces:
                    own = np.unique(np.concatenate(pieces)) if len(pieces) > 1 else pieces[0]
                    one = np.zeros((len(COUNTS), len(own)))
                    one[group] = 1
                    codes.append(own)
                    counts.append(one)
                    fresh += len(own)
                if fresh > 500_000:
                    every, each = _merge(codes, counts)
                    codes, counts, fresh = [every], [each], 0
                    if len(every) > 2_000_000:
                        yield from flush(every, each)
                        codes, counts = [], []
        if codes:
            yield from flush(*_merge(codes, counts))

    parts = rows.select("text", "group").mapInArrow(work, ddl)
    return parts.groupBy("code").agg(*(F.sum(c).alias(c) for c in COUNTS))


def _last(code, n: int):
    return code.bitwiseAND(F.lit((1 << (8 * n)) - 1))


def shared_backoff(grams: DataFrame, discount: float) -> DataFrame:
    """(code, p): Kneser-Ney probability of the last byte of each gram of one order less."""
    tables = {}
    above = grams.select("code")
    for n in range(ORDER - 1, 0, -1):
        above = above.select(_last(F.col("code"), n).alias("code")).groupBy("code").agg(F.count(F.lit(1)).alias("n"))
        tables[n] = above
    total = tables[1].agg(F.sum("n").alias("total"))
    p = tables[1].crossJoin(F.broadcast(total))  # one row
    p = p.select("code", (F.lit(0.99) * F.col("n") / F.col("total") + F.lit(0.01 / 256)).alias("p"))
    for n in range(2, ORDER):
        context = F.shiftright("code", 8).alias("context")
        rows = tables[n].select("code", "n", context, _last(F.col("code"), n - 1).alias("shorter"))
        sums = rows.groupBy("context").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
        lower = p.select(F.col("code").alias("shorter"), F.col("p").alias("lower"))
        rows = rows.join(sums, "context").join(lower, "shorter")
        held = F.greatest(F.col("n") - discount, F.lit(0.0)) / F.col("total")
        p = rows.select("code", (held + discount * F.col("kinds") / F.col("total") * F.col("lower")).alias("p"))
    return p


#: Which halves count for a model: everything, only a, only b.
MODELS = {"all": ("{c}a + {c}b"), "a": "{c}a", "b": "{c}b"}


def ratios(grams: DataFrame, discount: float) -> tuple[DataFrame, DataFrame]:
    """Log-likelihood ratios toxic to ordinary by code: of seen grams, and of unseen grams by context."""
    context = F.shiftright("code", 8).alias("context")
    rows = grams.select("code", *COUNTS, context, _last(F.col("code"), ORDER - 1).alias("shorter"))
    count = {(m, k): F.expr(f.format(c=k)) for m, f in MODELS.items() for k in "to"}
    sums = [F.sum(c).alias(f"total_{m}_{k}") for (m, k), c in count.items()]
    kinds = [F.count(F.when(c > 0, 1)).alias(f"kinds_{m}_{k}") for (m, k), c in count.items()]
    by_context = rows.groupBy("context").agg(*sums, *kinds)

    def left(m: str, k: str):
        total = F.col(f"total_{m}_{k}")
        return F.when(total > 0, discount * F.col(f"kinds_{m}_{k}") / total).otherwise(F.lit(1.0))

    def p(m: str, k: str):
        held = F.greatest(count[m, k] - discount, F.lit(0.0)) / F.greatest(F.col(f"total_{m}_{k}"), F.lit(1))
        return held + left(m, k) * F.col("p")

    lower = shared_backoff(grams, discount).withColumnRenamed("code", "shorter")
    seen = rows.join(by_context, "context").join(lower, "shorter")
    seen = seen.select("code", *(F.log(p(m, "t") / p(m, "o")).cast("float").alias(m) for m in MODELS))
    unseen = by_context.select(F.col("context").alias("code"), *(F.log(left(m, "t") / left(m, "o")).cast("float").alias(m) for m in MODELS))
    return seen, unseen


#: No gram has this code: codes have five bytes.
EMPTY = np.uint64(2**64 - 1)


@dataclass(frozen=True)
class Table:
    """Exact codes with open addressing: a code lies at its home or behind it, before the next empty place."""

    codes: np.ndarray
    values: np.ndarray
    bits: int

    @staticmethod
    def homes(codes: np.ndarray, bits: int) -> np.ndarray:
        return ((codes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)

    @classmethod
    def of(cls, codes: np.ndarray, values: list[np.ndarray]) -> list[Table]:
        """A table for each array of values, all with the same codes."""
        bits = max(1, int(1.5 * len(codes)).bit_length())
        home = cls.homes(codes, bits)
        order = np.argsort(home, kind="stable")
        step = np.arange(len(codes))
        at = np.maximum.accumulate(home[order] - step) + step
        # One empty place at the end, so every search stops.
        size = max(1 << bits, int(at[-1]) + 1 if len(at) else 0) + 1
        held = np.full(size, EMPTY, np.uint64)
        held[at] = codes[order]
        out = []
        for v in values:
            placed = np.full(size, np.nan, np.float32)
            placed[at] = v[order]
            out.append(cls(held, placed, bits))
        return out

    def find(self, codes: np.ndarray) -> np.ndarray:
        """The value of each code, nan where it is not held."""
        out = np.full(len(codes), np.nan, np.float32)
        at, left = self.homes(codes, self.bits), np.arange(len(codes))
        while len(left):
            there = self.codes[at]
            hit = there == codes[left]
            out[left[hit]] = self.values[at[hit]]
            more = ~hit & (there != EMPTY)
            at, left = at[more] + 1, left[more]
        return out


def word_ratios(piece: np.ndarray, seen: Table, unseen: Table) -> np.ndarray:
    codes, first = byte_grams(piece, ORDER)
    if not len(codes):
        return np.empty(0, np.float32)
    ratio = seen.find(codes)
    new = np.flatnonzero(np.isnan(ratio))
    # A context that was never seen is left to the shared backoff alone, which is the same in both classes.
    ratio[new] = np.nan_to_num(unseen.find(codes[new] >> np.uint64(8)), nan=0.0)
    return np.add.reduceat(ratio, first)


def features(body: np.ndarray, start: int, end: int, seen: Table, unseen: Table) -> tuple[float, float, float]:
    """Mean ratio over all words, over the five highest, and the highest; zeros without words."""
    total, words, top = 0.0, 0, np.empty(0, np.float32)
    for piece in text_pieces(body, start, end):
        ratio = word_ratios(piece, seen, unseen)
        total += float(ratio.sum(dtype=np.float64))
        words += len(ratio)
        if len(ratio) > TOP:
            ratio = np.partition(ratio, len(ratio) - TOP)[-TOP:]
        top = np.sort(np.concatenate([top, ratio]))[-TOP:]
    if not words:
        return 0.0, 0.0, 0.0
    return total / words, float(top.sum()) / TOP, float(top[-1])


def _tables(rows: pa.Table) -> list[Table]:
    codes = rows.column("code").to_numpy().view(np.uint64)
    return Table.of(codes, [rows.column(m).to_numpy() for m in MODELS])


def _fit(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ridge logistic regression by Newton steps: (means, scales, weights with the intercept first)."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    ridge = np.diag([1e-3] + [0.3] * x.shape[1])
    beta = np.zeros(z.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, z.T @ (y - p) - ridge @ beta)
        beta = beta + np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return mean, scale, beta


@dataclass(frozen=True)
class Model:
    """What scoring needs; picklable. ``tables`` is a broadcast of the ratios, or None for a constant score."""

    tables: object
    curve: tuple | None
    base: float

    def scores(self, column: pa.Array) -> np.ndarray:
        if self.tables is None:
            return np.full(len(column), self.base)
        mean, scale, beta = self.curve
        seen, unseen = self.tables.value
        body, bounds = text_buffers(column)
        x = [features(body, bounds[r], bounds[r + 1], seen, unseen) for r in range(len(column))]
        z = beta[0] + (np.array(x).reshape(-1, 3) - mean) / scale @ beta[1:]
        return 1 / (1 + np.exp(-np.clip(z, -700, 700)))


def learn(docs: DataFrame, labels: DataFrame, p: Toxicity = Toxicity()) -> Model:
    """The model from all rows that may be learned from; see ``toxicity_scores``."""
    spark = prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(F.col("text")).alias("text"))
    known = labels.where("toxic in (0, 1) and doc_id is not null").where(learned(F.col("doc_id"), 3, 1))
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    # Labels grow with the corpus: no broadcast, at any size.
    taught = docs.where(learned(F.col("doc_id"), 3, 1)).join(known.hint("merge"), "doc_id")
    half = F.crc32(F.concat(F.lit("half "), F.col("doc_id").cast("string")).cast("binary")) % 2
    group = ((1 - F.col("toxic")) * 2 + half).cast("int").alias("group")
    taught = stored(taught.select("doc_id", "text", group), "taught")
    groups = {r["group"]: r["count"] for r in taught.groupBy("group").count().collect()}
    total, toxic = sum(groups.values()), groups.get(0, 0) + groups.get(1, 0)
    if not toxic or toxic == total:
        return Model(None, None, toxic / total if total else 0.0)

    grams = stored(count_grams(taught), "grams")
    seen, unseen = (t.toArrow() for t in ratios(grams, p.discount))
    seen, unseen = _tables(seen), _tables(unseen)
    halves = spark.sparkContext.broadcast((seen[1:], unseen[1:]))
    tables = spark.sparkContext.broadcast((seen[0], unseen[0]))
    share = min(1.0, p.calibration_rows / total)
    picked = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.lit(int(share * 1_000_000))
    ddl = "a double, b double, c double, y double"
    schema = arrow_schema(ddl)

    def crossed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, unseen = halves.value
        for batch in batches:
            body, bounds = text_buffers(batch.column(0))
            out = []
            for r, group in enumerate(batch.column(1).to_pylist()):
                other = 1 - group % 2
                out.append((*features(body, bounds[r], bounds[r + 1], seen[other], unseen[other]), float(group < 2)))
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.float64()) for i in range(4)], schema=schema)

    sample = taught.where(picked).select("text", "group").mapInArrow(crossed, ddl).toPandas()
    sample = sample.sort_values(["a", "b", "c", "y"]).to_numpy()
    return Model(tables, _fit(sample[:, :3], sample[:, 3]), toxic / total)


def toxicity_scores(docs: DataFrame, labels: DataFrame, p: Toxicity = Toxicity()) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted.

    Learned from the rows of ``labels`` (doc_id, toxic) with toxic 0 or 1 whose id may be learned
    from (crc32 of the id modulo 3 is not 1); an id labelled twice counts as toxic if either says so.

    - Null and empty texts, and texts without a letter or digit, get the score of a text without
      evidence. A row without an id is scored too; it is not held out and never learned from.
    - Without labels of both classes every score is the share of toxic labels (0 without labels).
    - Repeated rows are scored alike; other columns are ignored; an empty table gives no rows.
    """
    model = learn(docs, labels, p)
    ddl = "doc_id long, score double"
    schema = arrow_schema(ddl)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.scores(batch.column(1)))], schema=schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(F.col("text")).alias("text"))
    return rows.mapInArrow(score, ddl).select(
        "doc_id",
        held_out(F.col("doc_id"), 3, 1).alias("held_out"),
        "score",
        (F.col("score") >= p.threshold).cast("int").alias("predicted"),
    )


def keep_ordinary(docs: DataFrame, labels: DataFrame, p: Toxicity = Toxicity()) -> DataFrame:
    """The rows of ``docs`` whose score is below the threshold, with all their columns.

    Rows are judged where they are, so neither a join on ids nor a shuffle of texts is needed.
    """
    model = learn(docs, labels, p)
    at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(model.scores(batch.column(at)) < p.threshold))

    return docs.mapInArrow(keep, docs.schema)
