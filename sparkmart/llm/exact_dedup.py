"""Exact duplicates against a history of digests, looked up through minimal perfect hashing.

History digests are distinct SHA-256 values with a winner and a count. They are dealt to
buckets of bounded size by their first bytes, and each bucket gets a minimal perfect hash:
levels of bit arrays in which a key owns its bit if no other key of the level hits it, and
the rank of the bit is the key's slot. Slots hold the full digest and the winner's locator.
A lookup of a digest that is not in the history also ends in some slot, or in none, so every
hit is checked byte for byte. Members join their slot; nonmembers are grouped among themselves.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import prepare, stored, text_of

BUCKET_KEYS = 20_000
GAMMA = 2.0
INDEX = "bucket long, sizes array<long>, bits binary, digests binary, winners array<long>, counts array<long>"


def _keys(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit words of each 32-byte digest that the bucket choice does not use."""
    words = digests.reshape(-1, 32).copy().view(np.uint64).reshape(-1, 4)
    return words[:, 1], words[:, 2]


def _places(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
    x = a + b * np.uint64(2 * level + 1)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((x ^ (x >> np.uint64(29))) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """A minimal perfect hash over distinct digests: ``slots`` maps each to 0..n-1, all different."""

    def __init__(self, sizes: list[int], bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.rank = np.concatenate([[0], np.cumsum(bits, dtype=np.int64)])

    @classmethod
    def build(cls, digests: np.ndarray) -> PerfectHash:
        a, b = _keys(digests)
        sizes, levels = [], []
        while len(a):
            size = max(64, int(len(a) * GAMMA))
            at = _places(a, b, len(sizes), size)
            hits = np.bincount(at, minlength=size)
            alone = hits[at] == 1
            sizes.append(size)
            levels.append(hits == 1)
            a, b = a[~alone], b[~alone]
            if len(sizes) > 500:
                raise ValueError("digests given to a perfect hash must be distinct")
        return cls(sizes, np.concatenate(levels) if levels else np.empty(0, bool))

    def slots(self, digests: np.ndarray) -> np.ndarray:
        """Slot of each digest; -1 where no level claims it (it is then no member)."""
        a, b = _keys(digests)
        out = np.full(len(a), -1, np.int64)
        left, start = np.arange(len(a)), 0
        for level, size in enumerate(self.sizes):
            at = start + _places(a[left], b[left], level, size)
            hit = self.bits[at]
            out[left[hit]] = self.rank[at[hit]]
            left, start = left[~hit], start + size
            if not len(left):
                break
        return out


def _digests(values) -> np.ndarray:
    return np.frombuffer(b"".join(values), np.uint8).reshape(-1, 32)


def build_index(history: DataFrame) -> DataFrame:
    """One row per bucket from (bucket, digest, winner, copies), digests being distinct."""

    def build(table: pa.Table) -> pa.Table:
        digests = _digests(table.column("digest").to_pylist())
        hashed = PerfectHash.build(digests)
        slot = hashed.slots(digests)
        order = np.argsort(slot)
        winners = table.column("winner").take(pa.array(order))
        counts = table.column("copies").take(pa.array(order))
        return pa.table(
            {
                "bucket": table.column("bucket").slice(0, 1),
                "sizes": pa.array([hashed.sizes], pa.list_(pa.int64())),
                "bits": pa.array([np.packbits(hashed.bits).tobytes()]),
                "digests": pa.array([digests[order].tobytes()]),
                "winners": pa.array([winners.to_pylist()], pa.list_(pa.int64())),
                "counts": pa.array([counts.to_pylist()], pa.list_(pa.int64())),
            }
        )

    return history.select("bucket", "digest", "winner", "copies").groupBy("bucket").applyInArrow(build, INDEX)


FOUND = "digest binary, winner long, copies long, member boolean"


def merge_index(index: DataFrame, incoming: DataFrame) -> DataFrame:
    """The slots of ``index`` after ``incoming`` (bucket, digest, winner, copies; distinct digests).

    A byte-checked member adds its copies to its slot and moves the locator to the larger id.
    Nonmembers come out as they are, with ``member`` false.
    """

    def lookup(slots: pa.Table, rows: pa.Table) -> pa.Table:
        digests = _digests(rows.column("digest").to_pylist())
        winners = np.array(rows.column("winner").fill_null(MISSING).to_numpy(), np.int64)
        copies = np.array(rows.column("copies").to_numpy(), np.int64)
        if slots.num_rows:
            bucket = slots.slice(0, 1).to_pylist()[0]
            bits = np.unpackbits(np.frombuffer(bucket["bits"], np.uint8), count=sum(bucket["sizes"])).astype(bool)
            held = np.frombuffer(bucket["digests"], np.uint8).reshape(-1, 32)
            slot = PerfectHash(bucket["sizes"], bits).slots(digests)
            member = slot >= 0
            member[member] = (held[slot[member]] == digests[member]).all(axis=1)
            best = np.array([MISSING if w is None else w for w in bucket["winners"]], np.int64)
            total = np.array(bucket["counts"], np.int64)
            np.maximum.at(best, slot[member], winners[member])
            np.add.at(total, slot[member], copies[member])
        else:
            held, best, total = np.empty((0, 32), np.uint8), np.empty(0, np.int64), np.empty(0, np.int64)
            member = np.zeros(len(digests), bool)
        every = np.concatenate([held, digests[~member]])
        best = np.concatenate([best, winners[~member]])
        return pa.table(
            {
                "digest": pa.array([d.tobytes() for d in every], pa.binary()),
                "winner": pa.array(best, pa.int64(), mask=best == MISSING),
                "copies": pa.array(np.concatenate([total, copies[~member]])),
                "member": pa.array(np.arange(len(every)) < len(held)),
            }
        )

    incoming = incoming.select("bucket", "digest", "winner", "copies")
    return index.groupBy("bucket").cogroup(incoming.groupBy("bucket")).applyInArrow(lookup, FOUND)


MISSING = -(2**63)


def distinct_digests(rows: DataFrame, buckets: int) -> DataFrame:
    """(bucket, digest, winner, copies) of rows (doc_id, digest); copies are combined before the shuffle."""
    distinct = rows.groupBy("digest").agg(F.max("doc_id").alias("winner"), F.count(F.lit(1)).alias("copies"))
    first = F.conv(F.hex(F.substring("digest", 1, 7)), 16, 10).cast("long")
    return distinct.withColumn("bucket", F.pmod(first, F.lit(buckets)))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", history_share: float = 0.5) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256.

    The rows with the lower ids, ``history_share`` of the id range, are the history that is
    indexed; the others are looked up in it. The result is the same for any share.

    - Texts are compared unchanged; null counts as empty. The largest doc_id of a group stays.
    - Rows without an id belong to the history and never win over a row with one; in a group
      without any id keep_id is null and every row is kept.
    - Rows that repeat both text and winning id are all marked kept.
    - Other columns are ignored. An empty table gives no rows.
    """
    prepare(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.unhex(F.sha2(text_of(F.col(text_col)).cast("binary"), 256)).alias("digest"),
    )
    rows = stored(rows, "digests")
    low, high, count = rows.agg(F.min("doc_id"), F.max("doc_id"), F.count(F.lit(1))).first()
    middle = (low or 0) + int(((high or 0) - (low or 0)) * history_share)
    old = F.coalesce(F.col("doc_id") <= F.lit(middle), F.lit(True))
    buckets = max(1, -(-count // BUCKET_KEYS))
    index = stored(build_index(distinct_digests(rows.where(old), buckets)), "perfect-hash")
    merged = merge_index(index, distinct_digests(rows.where(~old), buckets))
    winners = merged.select("digest", F.col("winner").alias("keep_id"), F.col("copies").alias("group_size"))
    out = rows.join(winners, "digest")
    return out.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull()).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
