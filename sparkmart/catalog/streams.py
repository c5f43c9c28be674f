"""Streaming twins over the events, run to the end of the input."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkmart.catalog.inputs import table
from sparkmart.session import configure, work_dir
from sparkmart.streaming.keyed import DailyCounts, classify_stream, count_stream
from sparkmart.streaming.reviews import daily_counts, dedup_stream, event_stream, land_stream, write_stream

DELAY = "1 day"
LONG_DELAY = "31 days"


def _events(spark, sf_dir):
    return event_stream(configure(spark), f"{sf_dir}/events.parquet", "ts")


def stream_land(spark, sf_dir):
    """Landed twice from one checkpoint; the second run finds nothing new."""
    base = work_dir(spark, "stream")
    for _ in range(2):
        events = _events(spark, sf_dir)
        land_stream(events, f"{base}/events", f"{base}/checkpoint", F.to_date("ts")).awaitTermination()
    return spark.read.parquet(f"{base}/events").drop("_loaded_at")


def stream_dedup(spark, sf_dir):
    """Every event arrives twice."""
    base = work_dir(spark, "stream")
    twice = _events(spark, sf_dir).unionByName(_events(spark, sf_dir))
    kept = dedup_stream(twice, ["event_id"], "ts", LONG_DELAY).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    write_stream(kept, f"{base}/events", f"{base}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{base}/events")


def stream_daily_counts(spark, sf_dir):
    base = work_dir(spark, "stream")
    counts = daily_counts(_events(spark, sf_dir), "ts", DELAY)
    write_stream(counts, f"{base}/counts", f"{base}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{base}/counts")


def _feed(spark, base, rows, schema):
    """A stream over what is in a folder once ``rows`` are added to it."""
    rows.write.mode("append").parquet(f"{base}/feed")
    return event_stream(spark, f"{base}/feed", "ts", schema)


def stream_first_and_late(spark, sf_dir):
    """Two thirds of the events, half of these twice, and in a second run all of them: each row first, repeated or late."""
    base = work_dir(spark, "stream")
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    schema = "event_id long, ts timestamp_ntz"
    runs = events.where("event_id % 3 <> 0").unionByName(events.where("event_id % 3 = 1")), events
    for rows in runs:
        told = classify_stream(_feed(spark, base, rows, schema), ["event_id"], "ts", DELAY, 365, shards=16)
        write_stream(told, f"{base}/told", f"{base}/checkpoint", ["status"]).awaitTermination()
    return spark.read.parquet(f"{base}/told").groupBy("event_id", "status").agg(F.count("*").alias("n"))


def stream_counts_upsert(spark, sf_dir):
    """Daily counts over two runs that both hold every day; the last batch comes a second time."""
    base = work_dir(spark, "stream")
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    for part in ("event_id % 3 = 0", "event_id % 3 <> 0"):
        feed = _feed(spark, base, events.where(part), "event_id long, ts timestamp_ntz")
        count_stream(feed, f"{base}/counts", f"{base}/checkpoint", "ts").awaitTermination()
    counts = DailyCounts(spark, f"{base}/counts")
    counts.upsert(events.where("event_id % 3 <> 0"), 1, "ts")
    return counts.read()


QUERIES = {
    "stream_land": stream_land,
    "stream_dedup": stream_dedup,
    "stream_daily_counts": stream_daily_counts,
    "stream_first_and_late": stream_first_and_late,
    "stream_counts_upsert": stream_counts_upsert,
}

ORACLES = {
    "stream_first_and_late": """
      with edge as (select epoch_ms(max(ts)) - 86400000 as mark from events where event_id % 3 <> 0),
        again as (
          select event_id, case when epoch_ms(ts) < mark then 'late' when event_id % 3 <> 0 then 'repeated' else 'first' end as status
          from events, edge),
        told as (
          select event_id, 'first' as status from events where event_id % 3 <> 0
          union all select event_id, 'repeated' from events where event_id % 3 = 1
          union all from again)
      select event_id, status, count(*) as n from told group by all""",
    "stream_counts_upsert": "select cast(ts as date) as day, count(*) as n from events group by 1",
    "stream_land": """select cast(event_id as varchar) as event_id, cast(ts as varchar) as ts,
        cast(user_id as varchar) as user_id, event_type, cast(value as varchar) as value, props,
        cast(ts as date) as load_date, 'stream_' || cast(cast(ts as date) as varchar) || '_0' as _batch_id
      from events""",
    "stream_dedup": "select * from events",
    "stream_daily_counts": """select cast(ts as date) as day, count(*) as n from events group by 1
      having cast(ts as date) + interval 1 day <= (select max(ts) from events) - interval 1 day""",
}
