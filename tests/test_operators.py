import datetime as dt
import random
import statistics
import time
import zipfile

import pytest
from pyspark.sql import functions as F

from sparkmart.operators import dedup, quantile_sketch
from sparkmart.operators.dedup import keep_first, keep_last, latest_snapshot
from sparkmart.operators.median import exact_median
from sparkmart.operators.merge import apply_delete_insert, delete_insert, new_partitions
from sparkmart.operators.sampling import first_rows, number_batches, stratified_sample
from sparkmart.plans import models
from sparkmart.session import configure, package_archive
from sparkmart.sources.paths import partition_values


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_and_last_copy_of_a_hot_key(spark):
    rnd = random.Random(1)
    rows = [("hot" if i % 3 == 0 else f"k{rnd.randrange(50)}", rnd.choice([None, 1, 2, 3]), i) for i in range(900)]
    df = spark.createDataFrame(rows, "k string, t int, v int").repartition(6)
    by_key = {}
    for k, t, v in rows:
        by_key.setdefault(k, []).append((t, v))
    last = 10**9
    first = {k: min(r, key=lambda x: (last if x[0] is None else x[0], x[1])) for k, r in by_key.items()}
    newest = {k: min(r, key=lambda x: (1 if x[0] is None else -x[0], x[1])) for k, r in by_key.items()}
    assert {r["k"]: (r["t"], r["v"]) for r in keep_first(df, ["k"], ["t"]).collect()} == first
    assert {r["k"]: (r["t"], r["v"]) for r in keep_last(df, ["k"], ["t"]).collect()} == newest


def test_copies_are_dropped_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    tree = plan(keep_first(df, ["k"], ["id"]))
    limit, exchange = tree.rindex("WindowGroupLimit"), tree.rindex("Exchange hashpartitioning")
    assert limit > exchange and tree.count("WindowGroupLimit") == 2


def test_null_keys_are_one_key(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), ("a", 1)], "k string, v int")
    assert sorted(r["v"] for r in keep_first(df, ["k"], ["v"]).collect()) == [1, 1]


def test_newest_snapshot_reads_one_partition(spark, base):
    df = spark.createDataFrame([(i, dt.date(2022, 1, 1 + i % 3)) for i in range(9)], "v int, load_date date")
    df.write.partitionBy("load_date").parquet(base + "/t")
    newest = latest_snapshot(spark.read.parquet(base + "/t"), "load_date")
    assert sorted(r["v"] for r in newest.collect()) == [2, 5, 8]
    assert "PartitionFilters: [isnotnull(load_date" in newest._jdf.queryExecution().toString()


@pytest.mark.parametrize("seed", range(4))
def test_median_is_exact(spark, seed):
    rnd = random.Random(seed)
    draw = [lambda: rnd.uniform(-1e6, 1e6), lambda: rnd.choice([1.0, 2.0, 2.5]), lambda: rnd.lognormvariate(0, 9),
            lambda: float(rnd.randrange(-3, 3))][seed]
    rows = [("hot" if i % 3 == 0 else f"g{rnd.randrange(9)}", None if i % 11 == 0 else draw()) for i in range(700)]
    rows += [("one", 7.0), ("empty", None), (None, 1.0), (None, 4.0)]
    rows += [("inf", v) for v in (float("inf"), float("inf"), 1e300, float("-inf"), -1e300)]
    df = spark.createDataFrame(rows, "g string, v double")
    want = {}
    for g, v in rows:
        if v is not None:
            want.setdefault(g, []).append(v)
    got = {r["g"]: r["m"] for r in exact_median(df, ["g"], "v", "m").collect()}
    assert got == {g: statistics.median(v) for g, v in want.items()}


def test_delete_insert_replaces_keys(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    assert sorted(r["v"] for r in delete_insert(old, new, "k").collect()) == ["B", "C", "a", "n"]


def test_stored_merge_touches_only_affected_partitions(spark, base):
    schema = "k string, v int, load_date date"
    day = lambda n: dt.date(2022, 1, n)
    path = base + "/t"
    first = [(f"k{i}", i, day(1 + i % 3)) for i in range(9)]
    spark.createDataFrame(first, schema).write.parquet(base + "/b1")
    assert apply_delete_insert(spark, path, spark.read.parquet(base + "/b1"), "k") == ["2022-01-01", "2022-01-02", "2022-01-03"]
    files = lambda n: {f for f in spark.read.parquet(f"{path}/load_date=2022-01-0{n}").inputFiles()}
    untouched = files(3)
    # k0 moves to a new day; all of day 2 moves, so that partition empties.
    second = [("k0", 100, day(4)), ("k1", 101, day(4)), ("k4", 104, day(4)), ("k7", 107, day(4)), ("new", 1, day(4))]
    spark.createDataFrame(second, schema).write.parquet(base + "/b2")
    for _ in range(2):  # a repeated merge gives the same table
        apply_delete_insert(spark, path, spark.read.parquet(base + "/b2"), "k")
        want = {r[0]: r for r in first} | {r[0]: r for r in second}
        got = spark.read.schema(schema).parquet(path).collect()
        assert {r["k"]: tuple(r) for r in got} == want and len(got) == len(want)
        assert partition_values(spark, path, "load_date") == ["2022-01-01", "2022-01-03", "2022-01-04"]
    assert files(3) == untouched


def test_new_partitions_default_to_all(spark):
    df = spark.createDataFrame([(dt.date(2022, 1, n),) for n in (1, 2, 3)], "load_date date")
    assert new_partitions(df, None).count() == 3
    assert new_partitions(df, df.where("load_date < date '2022-01-03'")).count() == 1
    assert new_partitions(df, df.where("false")).count() == 3


def test_sample_is_fixed_and_balanced(spark):
    rows = [(f"r{i}", 1 if i % 3 == 0 else 1 + i % 5, "x" * (i % 40)) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, s int, t string")
    draw = lambda d, **kw: {(r["k"], r["rn"]) for r in stratified_sample(d, "k", "s", 100, F.length("t") >= 20, **kw).collect()}
    one = draw(df.repartition(3))
    assert one == draw(df.repartition(7)) and len(one) == 100
    assert draw(df, seed=7) != one
    done = spark.createDataFrame([(k,) for k, rn in one if rn <= 5], "k string")
    assert draw(df, tagged=done) == {(k, rn) for k, rn in one if rn > 5}


def test_first_rows_are_the_smallest(spark):
    df = spark.range(500).select((F.col("id") * 7919 % 500).alias("v")).repartition(9)
    assert sorted(r["v"] for r in first_rows(df, 20).collect()) == list(range(20))


@pytest.mark.parametrize("digits", [0, 1, 2])
def test_batches_are_bounded_and_complete(spark, digits):
    df = spark.range(1000).select(F.col("id").cast("string").alias("k"), F.when(F.col("id") % 3 == 0, 1).otherwise(2).alias("g"))
    rows = number_batches(df, "k", "g", "k", 20, digits).collect()
    sizes = {}
    for r in rows:
        sizes.setdefault(r["batch"], []).append(r["pos"])
    assert len(rows) == 1000 and all(sorted(p) == list(range(len(p))) and len(p) <= 20 for p in sizes.values())


def test_sketched_medians_stay_within_their_bound(spark, base):
    r = random.Random(9)
    rows = [("big", r.gauss(0, 1) ** 3) for _ in range(20_000)] + [("ties", float(r.randrange(3))) for _ in range(3000)]
    rows += [("small", float(v)) for v in (5, 1, 9)] + [("none", None), ("none", float("nan"))]
    df = spark.createDataFrame(rows, "k string, v double").repartition(4)
    for i in range(5):
        part = df.where(F.pmod(F.xxhash64("v"), F.lit(5)) == i)
        for _ in range(2):  # a batch that comes again counts once
            quantile_sketch.add_batch(part, ["k"], "v", f"{base}/s", str(i))
    got = quantile_sketch.read_median(spark, ["k"], f"{base}/s")
    found = {r["k"]: (r["median"], r["n"]) for r in got.collect()}
    assert found["small"] == (5.0, 3) and found["ties"][0] == 1.0 and found["big"][1] == 20_000 and "none" not in found
    errors = {r["k"]: r["error"] for r in quantile_sketch.rank_errors(df, ["k"], "v", got).collect()}
    assert max(errors.values()) <= quantile_sketch.RANK_ERROR and errors["small"] <= 0.5 / 3


def test_the_package_as_an_archive():
    names = zipfile.ZipFile(package_archive()).namelist()
    assert "sparkmart/session.py" in names and "sparkmart/operators/median.py" in names


@pytest.mark.parametrize("bits", [1 << 26, 1 << 10, 1])
def test_only_rows_that_may_repeat_are_split_off(spark, monkeypatch, bits):
    """However many bits mark the repeated keys, no repeated key is left among the others; NULL is a key."""
    monkeypatch.setattr(dedup, "BITS", bits)
    rows = [(str(i % 100) if i % 25 else None, i) for i in range(110)] + [(f"x{i}", -i) for i in range(300)]
    once, again = dedup.split_repeated(spark.createDataFrame(rows, "k string, v int"), F.col("k"))
    once, again = [tuple(r) for r in once.collect()], [tuple(r) for r in again.collect()]
    assert sorted(once + again, key=str) == sorted(rows, key=str)
    keys = [k for k, _ in rows]
    assert {k for k in keys if keys.count(k) > 1} <= {k for k, _ in again} and not {k for k, _ in once} & {k for k, _ in again}
    assert len(again) == (len(rows) if bits == 1 else 23) or bits == 1 << 10


def test_staging_of_stored_rows_equals_that_of_any_rows_and_shuffles_repeated_reviews_only(spark, base):
    """Copies with other titles and dates, NULL parts of a key, and parts that join to the same text."""
    keys = [("a", "p", "2022-01-01", "t"), ("a", "p", "2022-01-01", None), (None, "p", "2022-01-02", ""), ("a|p", "p", "2022-01-01", "t")]
    rows = [{"author_id": f"u{i}", "product_id": "p", "submission_time": "2022-01-01", "review_text": "t", "review_title": str(i), "load_date": d} for i in range(50) for d in ["2022-01-01"]]
    for n, day in enumerate(["2022-01-02", "2022-01-01", "2022-01-01"]):
        rows += [dict(zip(("author_id", "product_id", "submission_time", "review_text"), k), review_title=str(n), load_date=day) for k in keys]
    schema = models.RAW_REVIEW.replace("load_date date", "load_date string")
    rows = [{"rating": "4", **r} for r in rows]
    raw = spark.createDataFrame([tuple(r.get(c.split()[0]) for c in schema.split(", ")) for r in rows], schema).withColumn("load_date", F.col("load_date").cast("date"))
    raw = models.store(raw, f"{base}/raw")
    got, want = (sorted(map(str, models.stg_reviews(raw, stored=s).collect())) for s in (True, False))
    assert got == want and len(want) == 50 + len(keys)
    _, again = dedup.split_repeated(raw, F.expr(f"concat_ws('|', {', '.join(models.REVIEW_KEY)})"))
    assert again.count() == 3 * len(keys)


@pytest.mark.parametrize("bits", [1, 1 << 4, 1 << 10])
def test_rows_are_split_by_keys_as_joins_split_them(spark, monkeypatch, bits):
    """With one bit every row is unsure; NULL keys and repeated rows and keys are told as joins tell them."""
    monkeypatch.setattr(dedup, "BITS", bits)
    rows = [(str(i % 40), i) for i in range(100)] + [(None, 1000), (None, 1000)]
    df = spark.createDataFrame(rows, "k string, v int")
    for held in ([str(i) for i in range(0, 60, 3)] * 2 + [None], [], [None], [str(i) for i in range(40)]):
        keys = spark.createDataFrame([(k,) for k in held], "k string")
        inside, outside = dedup.split_by_keys(df, "k", keys)
        assert inside.columns == outside.columns == df.columns
        assert sorted(map(tuple, inside.collect()), key=str) == sorted(map(tuple, df.join(keys, "k", "left_semi").collect()), key=str)
        assert sorted(map(tuple, outside.collect()), key=str) == sorted(map(tuple, df.join(keys, "k", "left_anti").collect()), key=str)


def _shuffle_files(spark):
    held = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(" ").split()
    return {f for f in held if "shuffle_" in f}


def test_shuffle_files_go_with_the_action_that_wrote_them(spark, base):
    configure(spark)
    before = _shuffle_files(spark)
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    df.write.parquet(f"{base}/counts")
    got = sorted(map(tuple, df.collect()))
    until = time.time() + 20
    while (left := _shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left and got == sorted(map(tuple, df.collect())) and len(got) == 7


def test_a_merge_into_partitions_that_gain_and_lose(spark, base):
    """Rows leave one partition, one is emptied, one only gains, one is not looked at; NULL keys stay."""
    day = [dt.date(2022, 1, d) for d in range(1, 6)]
    old = [("a", 1, day[0]), ("b", 1, day[0]), (None, 1, day[0]), ("c", 1, day[1]), ("d", 1, day[2]), ("e", 1, day[3])]
    frame = lambda rows: spark.createDataFrame(rows, "k string, v int, load_date date")
    apply_delete_insert(spark, f"{base}/t", frame(old), "k")
    batch = [("a", 2, day[2]), ("c", 2, day[4])]
    touched = apply_delete_insert(spark, f"{base}/t", frame(batch), "k", within=[str(d) for d in (*day[:3], day[4])])
    assert touched == [str(day[i]) for i in (0, 1, 2, 4)]
    got = sorted(map(tuple, spark.read.parquet(f"{base}/t").select("k", "v", "load_date").collect()), key=str)
    assert got == sorted([r for r in old if r[0] not in ("a", "c")] + batch, key=str)
    assert partition_values(spark, f"{base}/t", "load_date") == [str(day[i]) for i in (0, 2, 3, 4)]


def test_a_merge_leaves_rows_without_a_partition_value(spark, base):
    """They were left before; for a time the merge failed on them."""
    day = [dt.date(2022, 1, d) for d in (1, 2)]
    frame = lambda rows: spark.createDataFrame(rows, "k string, v int, load_date date")
    apply_delete_insert(spark, f"{base}/t", frame([("a", 1, None), ("b", 1, day[0]), ("c", 1, day[0])]), "k")
    apply_delete_insert(spark, f"{base}/t", frame([("a", 2, day[1]), ("b", 2, day[1])]), "k")
    apply_delete_insert(spark, f"{base}/t", frame([("a", 3, day[0])]), "k", within=[])
    got = sorted(map(tuple, spark.read.parquet(f"{base}/t").select("k", "v", "load_date").collect()), key=str)
    assert got == sorted([("a", 1, None), ("a", 2, day[1]), ("b", 2, day[1]), ("a", 3, day[0]), ("c", 1, day[0])], key=str)
