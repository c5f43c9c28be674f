"""Deterministic stratified sample and bounded request batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARDS = 64
# Keys of a sample up to this many rows are joined back as a broadcast.
BROADCAST_ROWS = 100_000


def seeded_order(key: str | Column, seed: int) -> Column:
    """A portable pseudo-random order: md5 of the key and the seed."""
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(key.cast("string"), F.lit(str(seed))))


def stratified_sample(
    df: DataFrame,
    key: str,
    stratum: str,
    n: int,
    eligible: Column,
    seed: int = 42,
    strata: int = 5,
    tagged: DataFrame | None = None,
) -> DataFrame:
    """``n // strata`` rows of each stratum, the same ones on every run.

    ``key`` must be unique. ``tagged`` holds keys that are done: they are taken out
    after ranking, so a resumed run never widens the sample. Adds ``rn``.

    Only key, stratum and hash are ranked. Each map task keeps its best rows, 64
    shards per stratum merge those, and one last step per stratum ranks at most
    64 times the quota. The full rows are then fetched by the sampled keys.
    """
    quota = n // strata
    narrow = df.where(eligible).select(key, stratum, seeded_order(key, seed).alias("_order"))
    narrow = narrow.withColumn("_shard", F.pmod(F.spark_partition_id(), F.lit(SHARDS)))
    order = [F.col("_order"), F.col(key)]
    in_shard = Window.partitionBy(stratum, "_shard").orderBy(*order)
    in_stratum = Window.partitionBy(stratum).orderBy(*order)
    picked = (
        narrow.withColumn("_rank", F.row_number().over(in_shard))
        .where(F.col("_rank") <= quota)
        .withColumn("rn", F.row_number().over(in_stratum))
        .where(F.col("rn") <= quota)
        .select(key, "rn")
    )
    if tagged is not None:
        picked = picked.join(tagged.select(key).distinct(), key, "left_anti")
    if n <= BROADCAST_ROWS:
        picked = F.broadcast(picked)
    return df.join(picked, key)


def first_rows(df: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows in the order of all columns, NULLs last.

    Each map task keeps its first ``n`` and 64 shards merge those, so the last step
    sorts 64 times ``n`` rows at most.
    """
    order = [F.col(c).asc_nulls_last() for c in df.columns]
    in_shard = Window.partitionBy("_shard").orderBy(*order)
    return (
        df.withColumn("_shard", F.pmod(F.spark_partition_id(), F.lit(SHARDS)))
        .withColumn("_rank", F.row_number().over(in_shard))
        .where(F.col("_rank") <= n)
        .drop("_shard", "_rank")
        .orderBy(*order)
        .limit(n)
    )


def number_batches(
    df: DataFrame, key: str, group: str, order: Sequence[str], size: int, shard_digits: int = 2
) -> DataFrame:
    """Add ``batch`` (an id) and ``pos`` (0-based) so that no batch exceeds ``size``.

    ``shard_digits`` hex digits of the key's md5 split each group, so that no task
    numbers a hot group alone; each shard may end with one short batch. A bounded
    sample may do without (0).
    """
    shard = F.left(F.md5(F.col(key).cast("string")), F.lit(shard_digits))
    by = Window.partitionBy(group, "_shard").orderBy(*order, key)
    at = F.col("_at")
    return (
        df.withColumn("_shard", shard)
        .withColumn("_at", F.row_number().over(by) - 1)
        .withColumn(
            "batch", F.concat_ws("-", F.col(group).cast("string"), "_shard", F.floor(at / size).cast("string"))
        )
        .withColumn("pos", (at % size).cast("int"))
        .drop("_shard", "_at")
    )
