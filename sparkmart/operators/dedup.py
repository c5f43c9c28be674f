"""One row per key, and the newest snapshot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], named: Sequence[str]) -> DataFrame:
    # Every other column breaks ties, so the winner never depends on task order.
    ties = [f"`{c}` asc nulls last" for c in df.columns if c not in keys and c not in named]
    by = ", ".join(f"`{k}`" for k in keys)
    rank = F.expr(f"row_number() over (partition by {by} order by {', '.join([*order, *ties])})")
    # The filter on the rank lets each map task keep one row per key before the
    # shuffle, so a key with a third of all copies sends one row per task.
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key by ``order``, NULLs last."""
    return _one_per_key(df, keys, [f"`{c}` asc nulls last" for c in order], order)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key by ``order``; NULLs count as oldest."""
    return _one_per_key(df, keys, [f"`{c}` desc nulls last" for c in order], order)


#: Bits that mark hashes in the splits below, in words of 64: a million words at most go to every task.
BITS = 1 << 26


def _word(hashed: Column) -> Column:
    return F.shiftright(F.pmod(hashed, F.lit(BITS)), 6)


def _bit(hashed: Column) -> Column:
    return (F.pmod(hashed, F.lit(BITS)) % 64).cast("int")


def _mark(hashed: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), _bit(hashed))


def _is_marked(marks: str) -> Column:
    return F.coalesce(F.getbit(marks, "_bit") == 1, F.lit(False))


def _beside_marks(df: DataFrame, key: Column, marks: DataFrame) -> DataFrame:
    """The rows with the words of a bit map that their keys belong to, and their bit there."""
    hashed = F.xxhash64(key)
    return df.withColumns({"_word": _word(hashed), "_bit": _bit(hashed)}).join(F.broadcast(marks), "_word", "left")


def split_marked(df: DataFrame, key: Column, hashes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose key may be among the hashes, rows whose key is not), by the 8-byte ``_hash`` of keys.

    The hashes mark bits of a map of fixed size that goes to every task. Rows that meet a marked bit by chance are among
    the first, so what follows has to decide by the keys; rows of the second kind need no shuffle for it.
    """
    marks = hashes.select(_word(F.col("_hash")).alias("_word"), _mark(F.col("_hash")).alias("_mark"))
    rows = _beside_marks(df, key, marks.groupBy("_word").agg(F.bit_or("_mark").alias("_marks")))
    marked = _is_marked("_marks")
    return rows.where(marked).select(*df.columns), rows.where(~marked).select(*df.columns)


def split_repeated(df: DataFrame, key: Column) -> tuple[DataFrame, DataFrame]:
    """(rows whose key occurs once, rows whose key may occur again), NULL being a key like any other.

    For wide rows of which few are repeated: only these need a shuffle and a sort. Keys are counted by an 8-byte hash, and
    the repeated hashes mark bits of a map of fixed size that goes to every task. Rows that meet a marked bit by chance
    are taken for repeated ones, so the more keys are repeated the less is spared, at any number of them.
    """
    hashes = df.select(F.xxhash64(key).alias("_hash")).groupBy("_hash").agg(F.count("*").alias("_n")).where("_n > 1")
    again, once = split_marked(df, key, hashes)
    return once, again


def split_by_keys(df: DataFrame, key: str, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose ``key`` is in ``keys``, all other rows), as a left semi and a left anti join give them; NULL is in none.

    For wide stored rows, which are read three times: only their keys are joined, and two bit maps of fixed size tell which
    rows are in for certain and which are out. Rows are shuffled whole only where a bit stands for keys of both kinds.
    """
    keys = keys.select(key).distinct()
    hashed = F.xxhash64(F.col(key))
    met = df.select(key).join(keys.withColumn("_in", F.lit(True)), key, "left")
    met = met.select(_word(hashed).alias("_word"), _mark(hashed).alias("_mark"), "_in")
    marks = met.groupBy("_word").agg(
        F.bit_or(F.when(F.col("_in"), F.col("_mark"))).alias("_ins"),
        F.bit_or(F.when(F.col("_in").isNull(), F.col("_mark"))).alias("_outs"),
    )
    rows = _beside_marks(df, F.col(key), marks)
    may_be_in, may_be_out = _is_marked("_ins"), _is_marked("_outs")
    unsure = rows.where(may_be_in & may_be_out).select(*df.columns)
    inside = rows.where(may_be_in & ~may_be_out).select(*df.columns)
    outside = rows.where(~may_be_in).select(*df.columns)
    return (
        inside.unionByName(unsure.join(keys, key, "left_semi").select(*df.columns)),
        outside.unionByName(unsure.join(keys, key, "left_anti").select(*df.columns)),
    )


def latest_snapshot(df: DataFrame, column: str) -> DataFrame:
    """Rows that hold the greatest ``column``.

    The scalar subquery becomes a partition filter when ``column`` partitions the
    files, so older snapshots are not read.
    """
    return df.where(F.col(column) == df.agg(F.max(column)).scalar())
