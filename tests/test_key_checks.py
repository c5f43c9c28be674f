"""Incremental key checks against the checks over all rows."""

import random

import pytest
from pyspark.sql import functions as F

from sparkmart.operators.group_state import GroupState
from sparkmart.operators.merge import replace_partitions
from sparkmart.plans.key_checks import update_key_checks
from sparkmart.plans.quality import Check, batch_overlap, unique, unique_combination
from sparkmart.sources.paths import delete

CHECKS = [Check("t", ("a", "b"), "unique_combination"), Check("t", ("a",), "unique"), Check("t", ("a", "b"), "batch_overlap")]
SCHEMA = "a string, b int, load_date date"


def want(spark, table):
    df = spark.read.schema(SCHEMA).parquet(table)
    return [unique_combination(df, ["a", "b"]).count(), unique(df, "a").count(), batch_overlap(df, ["a", "b"], "load_date").count()]


def found(df):
    counts = {r["check"]: r["failures"] for r in df.collect()}
    return [counts[c.name] for c in CHECKS]


def land(spark, table, day, rows):
    delete(spark, f"{table}/load_date={day}")
    if rows:
        replace_partitions(spark.createDataFrame(rows, "a string, b int").withColumn("load_date", F.lit(day).cast("date")), table)


@pytest.mark.parametrize("collide", [False, True])
def test_random_partitions_equal_full_checks(spark, base, collide):
    """Partitions come, are replaced and go; fingerprints of one value make all keys collide."""
    r = random.Random(8)
    table = f"{base}/t"
    days = [f"2022-01-0{i}" for i in range(1, 5)]
    code = F.length("full") % 2 if collide else None
    for step in range(4):
        changed = r.sample(days, r.randint(1, 2))
        for day in changed:
            rows = [(r.choice(["x", "y", "z", None, "null"]), r.choice([1, 2, 3, None])) for _ in range(r.randint(1, 4))]
            land(spark, table, day, [] if step > 1 and r.random() < 0.3 else rows)
        got = update_key_checks(spark, table, CHECKS, changed, f"{base}/k", fingerprint=code)
        assert found(got) == want(spark, table), step
    assert found(update_key_checks(spark, table, CHECKS, [], f"{base}/k", fingerprint=code)) == want(spark, table)


def test_a_run_that_died_is_repeated(spark, base, monkeypatch):
    table = f"{base}/t"
    land(spark, table, "2022-01-01", [("x", 1), ("x", 1)])
    assert found(update_key_checks(spark, table, CHECKS, ["2022-01-01"], f"{base}/k")) == [1, 1, 0]
    land(spark, table, "2022-01-02", [("x", 1), ("y", 1), ("y", 2)])
    whole = GroupState.merge

    def die(self, delta, run):
        whole(self, delta, run)
        raise RuntimeError("died")

    monkeypatch.setattr(GroupState, "merge", die)
    with pytest.raises(RuntimeError, match="died"):
        update_key_checks(spark, table, CHECKS, ["2022-01-02"], f"{base}/k")
    monkeypatch.undo()
    land(spark, table, "2022-01-02", [("y", 1), ("y", 2)])
    assert found(update_key_checks(spark, table, CHECKS, ["2022-01-02"], f"{base}/k")) == [1, 2, 0]
    for day in ("2022-01-01", "2022-01-02"):
        land(spark, table, day, [])
    assert found(update_key_checks(spark, table, CHECKS, ["2022-01-01", "2022-01-02"], f"{base}/k")) == [0, 0, 0]


def test_one_shuffle_counts_all_checks_and_only_suspects_are_read_again(spark, base, monkeypatch):
    table = f"{base}/t"
    for day in ("2022-01-01", "2022-01-02"):
        land(spark, table, day, [(f"{day}{i}", i) for i in range(5)])
    update_key_checks(spark, table, CHECKS, ["2022-01-01", "2022-01-02"], f"{base}/k")
    land(spark, table, "2022-01-03", [("2022-01-020", 0), ("new", 1)])
    from sparkmart.plans import key_checks

    seen, whole = [], key_checks._exploded
    monkeypatch.setattr(key_checks, "_exploded", lambda rows, *a: seen.append({f.split("load_date=")[1][:10] for f in rows.inputFiles()}) or whole(rows, *a))
    assert found(update_key_checks(spark, table, CHECKS, ["2022-01-03"], f"{base}/k")) == want(spark, table) == [1, 1, 1]
    plan = spark.read.parquet(table)
    assert len(seen) == 2 and plan.count() == 12


def test_each_key_is_written_once_and_values_never_run_together(spark, base):
    """Distinct keys, also where their values put behind each other are equal: only the ledger holds rows, one per key."""
    rows = [("a", "b", 1), ("ab", "", 1), ("", "ab", 1), ("a1:b", None, 1), (None, "a1:b", 1), ("-", "-", 1), ("-", None, 1), (None, None, 1)]
    land = spark.createDataFrame(rows, "a string, b string, n int").withColumn("load_date", F.lit("2022-01-01").cast("date"))
    replace_partitions(land, f"{base}/t")
    checks = [Check("t", ("a", "b"), "unique_combination"), Check("t", ("b", "a"), "unique_combination")]
    assert [r["failures"] for r in update_key_checks(spark, f"{base}/t", checks, ["2022-01-01"], f"{base}/k").collect()] == [0, 0]
    held = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    folders = [f"{base}/k/ledger", f"{base}/k/run"]
    assert [held.schema("key long").parquet(f).count() for f in folders] == [2 * len(rows), 0]
