"""Watermark slices of a source, landed as retry-safe partitions."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from sparkmart.operators.merge import replace_partitions
from sparkmart.sources.csv import list_files
from sparkmart.sources.landed import read_or_empty
from sparkmart.sources.paths import file_states, path_uri, plain_path

BACKFILL_GAP_DAYS = 30
BATCH_LOG = "batch_id string, load_date date, reviews long, products long, loaded_at string, source string, min_date date, max_date date"


@dataclass(frozen=True)
class Slice:
    """Source days after ``low`` up to and including ``high``."""

    low: date | None
    high: date

    @property
    def batch_id(self) -> str:
        return f"{'backfill' if self.low is None else 'daily'}_{self.high.isoformat()}"


def utc_now() -> str:
    return datetime.now(timezone.utc).isoformat(timespec="seconds")


def source_date_range(df: DataFrame, day: Column) -> DataFrame:
    """First and last parseable day of a source, in one row."""
    return df.agg(F.min(day).alias("min_date"), F.max(day).alias("max_date"))


def plan_slice(
    watermark: date | None, max_date: date, backfill_until: date | None = None, days: int = 1
) -> Slice | None:
    """The next slice to land, or None when the source holds nothing newer.

    The first slice reaches back without limit, up to ``backfill_until`` or 30 days
    before the newest day. Every later one covers ``days`` days after the watermark.
    """
    if watermark is None:
        return Slice(None, backfill_until or max_date - timedelta(days=BACKFILL_GAP_DAYS))
    if watermark >= max_date:
        return None
    return Slice(watermark, min(watermark + timedelta(days=days), max_date))


def slice_rows(df: DataFrame, day: Column, part: Slice) -> DataFrame:
    """Rows of a slice. A backfill also takes rows whose day cannot be parsed,
    because no later slice could ever match them."""
    if part.low is None:
        return df.where(F.coalesce(day <= F.lit(part.high), F.lit(True)))
    return df.where((day > F.lit(part.low)) & (day <= F.lit(part.high)))


def late_rows(df: DataFrame, day: Column, watermark: date, landed: DataFrame, key: str) -> DataFrame:
    """Rows at or below the watermark whose key never landed: no slice takes them.

    ``day`` is read from ``landed`` too. Only landed rows of days that such rows have are
    compared, and each key once.
    """
    early = df.where(day <= F.lit(watermark))
    days = early.select(day.alias("_day")).distinct()
    near = landed.select(key, day.alias("_day")).join(days, "_day", "left_semi")
    return early.join(near.select(key).distinct(), key, "left_anti")


def land_partition(
    df: DataFrame, base: str, load_date: date, batch_id: str, loaded_at: str | None = None
) -> int:
    """Write one partition and return its row count.

    The write replaces this partition only, so a repeated batch gives the same
    table. The count is taken while writing; nothing is read back.
    """
    seen = Observation()
    stamped = df.withColumns({"_batch_id": F.lit(batch_id), "_loaded_at": F.lit(loaded_at or utc_now())})
    (
        stamped.observe(seen, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("compression", "zstd")
        .parquet(f"{base}/load_date={load_date.isoformat()}")
    )
    return seen.get["rows"]


def batch_log(spark: SparkSession, base: str) -> DataFrame:
    return read_or_empty(spark, f"{base}/batch_log", BATCH_LOG)


def load_watermark(spark: SparkSession, base: str) -> date | None:
    return batch_log(spark, base).agg(F.max("load_date")).first()[0]


def land_batch(
    spark: SparkSession,
    reviews: DataFrame,
    products: DataFrame,
    base: str,
    day: Column,
    backfill_until: date | None = None,
    days: int = 1,
    source: str = "dir",
) -> Slice | None:
    """Land the next slice of reviews and a full product snapshot.

    The batch is logged last, which is what moves the watermark: a run that fails
    half way repeats the same slice into the same partitions. An empty slice moves
    the watermark too. Returns None when the source is exhausted.
    """
    span = source_date_range(reviews, day).first()
    if span["max_date"] is None:
        raise ValueError("the source has no row with a parseable date")
    part = plan_slice(load_watermark(spark, base), span["max_date"], backfill_until, days)
    if part is None:
        return None
    loaded_at = utc_now()
    n_reviews = land_partition(
        slice_rows(reviews, day, part), f"{base}/reviews", part.high, part.batch_id, loaded_at
    )
    n_products = land_partition(products, f"{base}/products", part.high, part.batch_id, loaded_at)
    entry = (part.batch_id, part.high, n_reviews, n_products, utc_now(), source, span["min_date"], span["max_date"])
    log = spark.createDataFrame([entry], BATCH_LOG)
    log.coalesce(1).write.mode("append").parquet(f"{base}/batch_log")
    return part


def due_slices(
    watermark: date | None, max_date: date, backfill_until: date | None, days: int, limit: int
) -> list[Slice]:
    """The next slices, each as ``plan_slice`` gives it after the one before."""
    parts: list[Slice] = []
    while len(parts) < limit and (part := plan_slice(watermark, max_date, backfill_until, days)):
        parts.append(part)
        watermark = part.high
    return parts


def land_slices(
    spark: SparkSession,
    reviews: DataFrame,
    products: DataFrame,
    base: str,
    day: Column,
    backfill_until: date | None = None,
    days: int = 1,
    source: str = "dir",
    limit: int = 1000,
    span: Mapping[str, date | None] | None = None,
) -> list[Slice]:
    """Land up to ``limit`` due slices with one pass over the source, besides that for its range.

    The table is the one that as many calls of ``land_batch`` give, except that a slice
    without reviews leaves no folder of them. All slices are logged together, last.
    ``span`` gives the range where it is known; ``reviews`` may then lack rows of other days.
    """
    span = source_date_range(reviews, day).first() if span is None else span
    if span["max_date"] is None:
        raise ValueError("the source has no row with a parseable date")
    parts = due_slices(load_watermark(spark, base), span["max_date"], backfill_until, days, limit)
    if not parts:
        return []
    loaded_at = utc_now()
    known = F.col("_day")
    low = F.lit(parts[0].low) if parts[0].low else None
    due = known <= F.lit(parts[-1].high)
    due = F.coalesce(due, F.lit(True)) if low is None else due & (known > low)
    # Undated rows go with the backfill; a later slice ends at its step or at the newest day.
    high = F.lit(parts[0].high)
    if len(parts) > 1:
        steps = F.ceil(F.date_diff(known, high) / F.lit(days)).cast("int")
        later = F.least(F.date_add(high, steps * days), F.lit(parts[-1].high))
        high = F.when(known > high, later).otherwise(high)
    rows = reviews.withColumn("_day", day).where(due).withColumn("load_date", high).drop("_day")
    kind = F.when(F.col("load_date") == F.lit(parts[0].high), F.lit(parts[0].batch_id.split("_")[0])).otherwise("daily")
    stamps = {"_batch_id": F.concat_ws("_", kind, F.col("load_date").cast("string")), "_loaded_at": F.lit(loaded_at)}
    seen = Observation()
    dated = rows.withColumns(stamps).observe(seen, *_per_slice(parts))
    replace_partitions(dated, f"{base}/reviews")
    shots = products.withColumn("load_date", F.explode(F.array(*(F.lit(p.high) for p in parts))))
    counted = Observation()
    replace_partitions(shots.withColumns(stamps).observe(counted, *_per_slice(parts)), f"{base}/products")
    entries = [
        (p.batch_id, p.high, seen.get[f"n{i}"], counted.get[f"n{i}"], utc_now(), source, span["min_date"], span["max_date"])
        for i, p in enumerate(parts)
    ]
    spark.createDataFrame(entries, BATCH_LOG).coalesce(1).write.mode("append").parquet(f"{base}/batch_log")
    return parts


def _per_slice(parts: list[Slice]) -> list[Column]:
    return [F.count_if(F.col("load_date") == F.lit(p.high)).alias(f"n{i}") for i, p in enumerate(parts)]


def slice_bounds(watermark: Column, max_date: Column, days: int = 1) -> Column:
    """The bounds ``plan_slice`` would give, as columns: low, high and default cutoff."""
    return F.struct(
        watermark.alias("low"),
        F.least(F.date_add(watermark, days), max_date).alias("high"),
        F.date_sub(max_date, BACKFILL_GAP_DAYS).alias("cutoff"),
        (watermark >= max_date).alias("exhausted"),
    )


ZONES = "file string, bytes long, modified long, low date, high date, undated long"


def zone_map(spark: SparkSession, pattern: str, path: str, day: Column, read: Callable[[list[str]], DataFrame]) -> list[Row]:
    """The days that each file of a source holds, of all files that match ``pattern`` now.

    Kept at ``path`` by file, length and time, so a file is opened for it once. ``read`` reads files, with their
    names in ``filename``. One row per file is on the driver, as in Spark's own listing.
    """
    states = file_states(spark, [path_uri(spark, p) for p, _ in list_files(spark, pattern)])
    known = {(r["file"], r["bytes"], r["modified"]) for r in read_or_empty(spark, path, ZONES).collect()}
    fresh = {f: s for f, s in states.items() if (f, *s) not in known}
    if fresh:
        dated = read(sorted(fresh)).select("filename", day.alias("day"))
        found = dated.groupBy("filename").agg(F.min("day").alias("low"), F.max("day").alias("high"), F.count_if(F.col("day").isNull()).alias("undated"))
        zones = {plain_path(spark, r["filename"]): (r["low"], r["high"], r["undated"]) for r in found.collect()}
        rows = [(f, *s, *zones.get(f, (None, None, 0))) for f, s in sorted(fresh.items())]
        spark.createDataFrame(rows, ZONES).coalesce(1).write.mode("append").parquet(path)
    return [r for r in read_or_empty(spark, path, ZONES).collect() if states.get(r["file"]) == (r["bytes"], r["modified"])]


def land_files(
    spark: SparkSession,
    pattern: str,
    products: DataFrame,
    base: str,
    day: Column,
    read: Callable[[list[str]], DataFrame],
    backfill_until: date | None = None,
    days: int = 1,
    source: str = "dir",
    limit: int = 1000,
) -> list[Slice]:
    """``land_slices`` from the files of a source: only those that hold days of the due slices are opened.

    New files are opened once more, for the zone map.
    """
    zones = zone_map(spark, pattern, f"{base}/zones", day, read)
    lows, highs = ([z[c] for z in zones if z[c]] for c in ("low", "high"))
    span = {"min_date": min(lows, default=None), "max_date": max(highs, default=None)}
    if span["max_date"] is None:
        raise ValueError("the source has no row with a parseable date")
    parts = due_slices(load_watermark(spark, base), span["max_date"], backfill_until, days, limit)
    if not parts:
        return []
    low, high = parts[0].low, parts[-1].high
    # A backfill reaches back without limit and takes undated rows.
    due = [z for z in zones if (z["low"] and z["low"] <= high and (low is None or z["high"] > low)) or (low is None and z["undated"])]
    reviews = read(sorted(z["file"] for z in due or zones[:1])).drop("filename")
    return land_slices(spark, reviews, products, base, day, backfill_until, days, source, limit, span)
