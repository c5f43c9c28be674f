import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sparkmart.streaming import keyed
from sparkmart.streaming.keyed import DailyCounts, classify_stream, count_stream
from sparkmart.streaming.reviews import daily_counts, dedup_stream, event_stream, land_stream, write_stream

SCHEMA = "id int, t timestamp_ntz, v string"


def add(spark, path, rows):
    spark.createDataFrame([(i, dt.datetime(2022, 1, d, h), f"v{i}") for i, d, h in rows], SCHEMA).write.mode("append").parquet(path)


def test_landing_adds_only_what_is_new(spark, base):
    source, out = f"{base}/in", f"{base}/out"

    def run():
        stream = event_stream(spark, source, "t", SCHEMA)
        land_stream(stream, out, f"{base}/cp", F.to_date("t")).awaitTermination()
        return spark.read.parquet(out)

    add(spark, source, [(1, 1, 0), (2, 1, 5), (3, 2, 0)])
    assert run().count() == 3 and run().count() == 3
    add(spark, source, [(4, 1, 9), (5, 3, 0)])  # one late row for a day that was landed before
    landed = run()
    assert landed.count() == 5
    days = {str(r[0]): r[1] for r in landed.groupBy("load_date").count().collect()}
    assert days == {"2022-01-01": 3, "2022-01-02": 1, "2022-01-03": 1}
    assert dict(landed.dtypes)["id"] == "string" and landed.first()["_batch_id"].startswith("stream_2022-01-0")


def test_arrival_day_is_the_default_partition(spark, base):
    add(spark, f"{base}/in", [(1, 1, 0)])
    land_stream(event_stream(spark, f"{base}/in", "t", SCHEMA), f"{base}/out", f"{base}/cp").awaitTermination()
    assert abs(spark.read.parquet(f"{base}/out").first()["load_date"] - dt.datetime.now(dt.timezone.utc).date()).days <= 1


def test_copies_within_the_delay_are_dropped_across_runs(spark, base):
    def run():
        kept = dedup_stream(event_stream(spark, f"{base}/in", "t", SCHEMA), ["id"], "t", "10 days")
        write_stream(kept, f"{base}/out", f"{base}/cp").awaitTermination()
        return sorted(r["id"] for r in spark.read.parquet(f"{base}/out").collect())

    add(spark, f"{base}/in", [(1, 1, 0), (1, 1, 0), (2, 1, 0)])
    assert run() == [1, 2]
    add(spark, f"{base}/in", [(1, 2, 0), (3, 2, 0)])
    assert run() == [1, 2, 3]


def test_days_are_counted_once_closed(spark, base):
    def run():
        write_stream(daily_counts(event_stream(spark, f"{base}/in", "t", SCHEMA), "t", "1 day"), f"{base}/out", f"{base}/cp").awaitTermination()
        return {r["day"].day: r["n"] for r in spark.read.parquet(f"{base}/out").collect()}

    add(spark, f"{base}/in", [(1, 1, 0), (2, 1, 23), (3, 2, 0), (4, 3, 12)])
    assert run() == {1: 2}
    add(spark, f"{base}/in", [(5, 2, 20), (6, 5, 0)])  # day 2 is still open, so this counts
    assert run() == {1: 2, 2: 2, 3: 1}


def classified(spark, base, runs, keep_days=5.0):
    """(id, day, value, status) after runs of (id, day, hour) rows, by a stream that keeps keys for ``keep_days``."""
    for rows in runs:
        add(spark, f"{base}/in", rows)
        told = classify_stream(event_stream(spark, f"{base}/in", "t", SCHEMA), ["id"], "t", "2 days", keep_days, shards=2)
        write_stream(told, f"{base}/out", f"{base}/cp", ["status"]).awaitTermination()
    out = spark.read.parquet(f"{base}/out")
    return sorted(((r["id"], r["t"].day if r["t"] else None, r["status"]) for r in out.collect()), key=str)


def test_each_row_is_first_repeated_or_late(spark, base):
    got = classified(spark, base, [[(1, 3, 1), (1, 2, 0), (2, 9, 0)], [(1, 8, 0), (3, 6, 23), (3, 7, 0), (4, 20, 0)], [(4, 19, 0), (2, 17, 0)]])
    assert got == sorted([
        (1, 2, "first"), (1, 3, "repeated"), (1, 8, "repeated"),  # kept five days past its newest row
        (2, 9, "first"), (2, 17, "late"),
        (3, 6, "late"), (3, 7, "first"),  # the watermark lies at day 7
        (4, 19, "repeated"), (4, 20, "first"),
    ], key=str)


def test_keys_are_forgotten_after_their_time(spark, base):
    """Key 1 is dropped once the watermark is a day past it; key 0 and 1 share the shards with the others."""
    runs = [[(1, 2, 0), (0, 2, 0)], [(i, 10, 0) for i in range(2, 12)], [(i, 11, 0) for i in range(2, 12)], [(1, 12, 0), (2, 12, 0)]]
    got = classified(spark, base, runs, keep_days=1)
    assert (1, 12, "first") in got and (2, 12, "repeated") in got and len(got) == 24


def test_rows_without_a_time_are_told_by_their_key(spark, base):
    spark.createDataFrame([(1, None, "a"), (1, None, "b"), (None, None, "c"), (None, None, "d")], SCHEMA).write.parquet(f"{base}/in")
    assert sorted(s for *_, s in classified(spark, base, [[(1, 3, 0)]])) == ["first", "first", "repeated", "repeated", "repeated"]


def test_counts_are_corrected_and_a_repeated_batch_changes_nothing(spark, base):
    def run():
        count_stream(event_stream(spark, f"{base}/in", "t", SCHEMA), f"{base}/counts", f"{base}/cp", "t").awaitTermination()
        return {r["day"].day: r["n"] for r in DailyCounts(spark, f"{base}/counts").read().collect()}

    add(spark, f"{base}/in", [(1, 1, 0), (2, 1, 23), (3, 2, 0)])
    assert run() == {1: 2, 2: 1} == run()
    add(spark, f"{base}/in", [(4, 1, 1), (5, 9, 0)])  # a late row for day 1
    assert run() == {1: 3, 2: 1, 9: 1}
    rows = spark.createDataFrame([(4, dt.datetime(2022, 1, 1, 1)), (5, dt.datetime(2022, 1, 9))], "id int, t timestamp_ntz")
    counts = DailyCounts(spark, f"{base}/counts")
    counts.upsert(rows, 1, "t")
    assert {r["day"].day: r["n"] for r in counts.read().collect()} == {1: 3, 2: 1, 9: 1}


def test_a_batch_that_died_before_its_log_is_not_read(spark, base, monkeypatch):
    counts = DailyCounts(spark, base)
    rows = spark.createDataFrame([(1, dt.datetime(2022, 1, 1))], "id int, t timestamp_ntz")
    counts.upsert(rows, 0, "t")
    whole = type(counts.state).merge

    def die(self, delta, run):
        whole(self, delta, run)
        raise RuntimeError("died")

    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(type(counts.state), "merge", die)
        counts.upsert(rows, 1, "t")
    assert [r["n"] for r in counts.read().collect()] == [1]
    counts.upsert(rows, 1, "t")
    assert [r["n"] for r in counts.read().collect()] == [2]


def test_ties_are_settled_by_all_columns_and_times_are_kept(spark, base):
    """Rows of one time: the smallest text is first, NULLs last; equal rows give one first; a late row renews no key."""
    at = lambda d: dt.datetime(2022, 1, d)
    runs = [
        [(1, at(2), "b"), (1, at(2), "a"), (1, at(2), None), (2, at(2), "x"), (2, at(2), "x"), (3, at(2), None), (3, at(2), "z"), (4, at(1), "z")],
        [(5, at(9), "n"), (1, at(1), "b")],
        [(1, at(2), "late"), (6, at(8), "p"), (6, at(7), "q")],
    ]
    for rows in runs:
        spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(f"{base}/in")
        told = classify_stream(event_stream(spark, f"{base}/in", "t", SCHEMA), ["id"], "t", "2 days", 30, shards=1)
        write_stream(told, f"{base}/out", f"{base}/cp").awaitTermination()
    got = sorted(((r["id"], r["t"].day, r["v"], r["status"]) for r in spark.read.parquet(f"{base}/out").collect()), key=str)
    assert got == sorted([
        (1, 2, "a", "first"), (1, 2, "b", "repeated"), (1, 2, None, "repeated"), (2, 2, "x", "first"), (2, 2, "x", "repeated"),
        (3, 2, "z", "first"), (3, 2, None, "repeated"), (4, 1, "z", "first"), (5, 9, "n", "first"), (1, 1, "b", "repeated"),
        (1, 2, "late", "late"), (6, 8, "p", "repeated"), (6, 7, "q", "first"),
    ], key=str)


def test_only_different_rows_of_one_time_are_sorted(monkeypatch):
    """All rows of a shard were sorted by their texts."""
    sorted_rows, whole = [], pd.DataFrame.sort_values
    monkeypatch.setattr(pd.DataFrame, "sort_values", lambda self, *a, **k: sorted_rows.append(len(self)) or whole(self, *a, **k))
    n = 1000
    rows = pd.DataFrame({"id": [str(i // 2) for i in range(2 * n)], "v": ["v"] * (2 * n - 1) + ["a"]})
    first = keyed._first_rows(rows, ["id", "v"], np.arange(2 * n), np.arange(2 * n) // 2, np.zeros(2 * n, "int64"))
    assert sorted(first) == [*range(0, 2 * n - 2, 2), 2 * n - 1] and sorted_rows == [2]


def test_few_shards_are_held_in_parts(spark, base, monkeypatch):
    """A task held all rows and keys of one of two shards at once; rows go back in slices."""
    monkeypatch.setattr(keyed, "ROWS", 3)
    rows = [(i, dt.datetime(2022, 1, 2), "v") for i in range(400)] * 2
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{base}/in")
    told = classify_stream(event_stream(spark, f"{base}/in", "t", SCHEMA), ["id"], "t", "2 days", 5, shards=2)
    write_stream(told, f"{base}/out", f"{base}/cp").awaitTermination()
    got = {(r["status"], r["n"]) for r in spark.read.parquet(f"{base}/out").groupBy("status").agg(F.count("*").alias("n")).collect()}
    assert got == {("first", 400), ("repeated", 400)}
    parts = spark.read.format("statestore").load(f"{base}/cp").count()
    assert 150 < parts <= keyed.SHARDS
