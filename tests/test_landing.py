import datetime as dt

import pytest
from pyspark.sql import functions as F

from sparkmart.catalog import landing as landing_queries
from sparkmart.catalog.inputs import spark_input
from sparkmart.functions.casts import leading_date
from sparkmart.operators import landing
from sparkmart.operators.landing import land_files
from sparkmart.operators.merge import replace_partitions
from sparkmart.plans.quality import batch_overlap
from sparkmart.session import configure
from sparkmart.sources.csv import read_csv_by_name
from sparkmart.sources.landed import read_landed
from sparkmart.sources.paths import matching_files, partition_values

DAY0 = dt.date(2022, 5, 1)


@pytest.fixture(scope="module")
def source(spark):
    rows = [(str(i), f"p{i % 7}", str(DAY0 + dt.timedelta(days=i % 60)), f"text {i}") for i in range(600)]
    rows += [("bad", "p1", "soon", "x"), ("none", "p1", None, "y")]
    return spark.createDataFrame(rows, "author_id string, product_id string, submission_time string, review_text string")


@pytest.fixture(scope="module")
def products(spark):
    return spark.createDataFrame([(f"p{i}",) for i in range(7)], "product_id string")


def land(spark, source, products, base, until=None, days=1):
    return landing.land_batch(spark, source, products, base, leading_date("submission_time"), until, days)


def test_backfill_then_daily_moves_the_watermark(spark, source, products, base):
    first = land(spark, source, products, base, dt.date(2022, 6, 1))
    second = land(spark, source, products, base)
    assert (first.batch_id, second.batch_id) == ("backfill_2022-06-01", "daily_2022-06-02")
    assert landing.load_watermark(spark, base) == dt.date(2022, 6, 2)
    assert partition_values(spark, f"{base}/reviews", "load_date") == ["2022-06-01", "2022-06-02"]
    assert partition_values(spark, f"{base}/products", "load_date") == ["2022-06-01", "2022-06-02"]
    raw = read_landed(spark, f"{base}/reviews")
    daily = raw.where(F.col("_batch_id") == "daily_2022-06-02")
    assert [r[0] for r in daily.select("submission_time").distinct().collect()] == ["2022-06-02"]
    assert batch_overlap(raw, ["author_id", "product_id", "submission_time"]).count() == 0
    log = {r["batch_id"]: r for r in landing.batch_log(spark, base).collect()}
    assert log["backfill_2022-06-01"]["reviews"] == 322  # 32 days of 10 and two without a date
    assert log["daily_2022-06-02"]["reviews"] == 10 and log["daily_2022-06-02"]["products"] == 7
    assert raw.where("author_id in ('bad', 'none')").select("_batch_id").distinct().count() == 1


def test_default_cutoff_is_thirty_days_before_the_newest(spark, source, products, base):
    assert land(spark, source, products, base).high == DAY0 + dt.timedelta(days=29)


def test_rerun_replaces_its_partition(spark, source, products, base):
    path, day = f"{base}/reviews", dt.date(2022, 6, 1)
    assert landing.land_partition(source, path, day, "b") == 602
    assert landing.land_partition(source.limit(5), path, day, "b") == 5
    assert read_landed(spark, path).count() == 5
    assert landing.land_partition(source.where("false"), path, day, "b") == 0


def test_a_batch_that_was_not_logged_is_repeated(spark, source, products, base):
    land(spark, source, products, base, dt.date(2022, 6, 1))
    # A run that died after its reviews were written, before the log.
    part = landing.plan_slice(dt.date(2022, 6, 1), dt.date(2022, 6, 29))
    day = leading_date("submission_time")
    landing.land_partition(landing.slice_rows(source, day, part), f"{base}/reviews", part.high, part.batch_id)
    assert land(spark, source, products, base) == part
    assert read_landed(spark, f"{base}/reviews").count() == 332


def test_exhausted_source_changes_nothing(spark, source, products, base):
    land(spark, source, products, base, dt.date(2022, 6, 28))
    assert land(spark, source, products, base, days=10).high == dt.date(2022, 6, 29)
    assert land(spark, source, products, base) is None
    assert landing.batch_log(spark, base).count() == 2


def test_an_empty_day_still_moves_the_watermark(spark, source, products, base):
    gap = source.where("submission_time <> '2022-06-02' or submission_time is null")
    land(spark, gap, products, base, dt.date(2022, 6, 1))
    assert land(spark, gap, products, base).batch_id == "daily_2022-06-02"
    assert land(spark, gap, products, base).batch_id == "daily_2022-06-03"
    log = {r["batch_id"]: r["reviews"] for r in landing.batch_log(spark, base).collect()}
    assert log["daily_2022-06-02"] == 0 and log["daily_2022-06-03"] == 10


def test_a_given_cutoff_may_pass_the_newest_day():
    assert landing.plan_slice(None, dt.date(2022, 6, 1), dt.date(2030, 1, 1)).high == dt.date(2030, 1, 1)


def test_late_rows_are_those_no_slice_takes(spark):
    rows = [("a", "2022-01-01"), ("b", "2022-01-02"), ("c", "2022-01-03"), ("d", None)]
    df = spark.createDataFrame(rows, "k string, t string")
    landed = df.where("k = 'a'")
    late = landing.late_rows(df, leading_date("t"), dt.date(2022, 1, 2), landed, "k")
    assert [r["k"] for r in late.collect()] == ["b"]


def test_files_are_opened_for_their_days_once(spark, base):
    """The zone map gives the slices of a full scan; new, rewritten and overlapping files are opened, others are not."""
    read_files = []

    def read(files):
        read_files.append(sorted(f.rsplit("/", 1)[1] for f in files))
        return read_csv_by_name(spark, files)

    def write(name, *rows):
        with open(f"{base}/{name}.csv", "w") as f:
            f.write("k,day\n" + "".join(f"{k},{d}\n" for k, d in rows))

    def landed():
        rows = spark.read.parquet(f"{base}/raw/reviews").select("k", F.col("load_date").cast("string")).collect()
        return sorted(map(tuple, rows))

    day, products = leading_date("day"), spark.createDataFrame([("p",)], "product_id string")
    land = lambda **o: land_files(spark, f"{base}/*.csv", products, f"{base}/raw", day, read, **o)
    write("a", ("1", "2022-01-01"), ("2", "2022-01-03"), ("3", "soon"))
    write("b", ("4", "2022-01-02"), ("5", "2022-01-05"))
    write("only_undated", ("6", ""))
    land(backfill_until=dt.date(2022, 1, 3), limit=1)
    assert read_files == [["a.csv", "b.csv", "only_undated.csv"], ["a.csv", "b.csv", "only_undated.csv"]]
    assert landed() == [(k, "2022-01-03") for k in "12346"]
    read_files.clear()
    write("c", ("7", "2022-01-06"), ("8", "2022-01-09"))
    assert [p.high.day for p in land(days=2)] == [5, 7, 9]
    assert read_files == [["c.csv"], ["b.csv", "c.csv"]]
    assert {("5", "2022-01-05"), ("7", "2022-01-07"), ("8", "2022-01-09")} <= set(landed()) and len(landed()) == 8
    read_files.clear()
    assert land(days=2) == [] and read_files == []


def test_partitions_are_written_side_by_side(spark, base):
    """Without writers side by side a task sorts all its rows by their partition."""
    rows = configure(spark).range(100).selectExpr("id", "date_add(date '2001-01-01', cast(id % 3 as int)) as load_date")
    replace_partitions(rows, f"{base}/t")
    assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) >= 4
    assert sorted(r["count"] for r in spark.read.parquet(f"{base}/t").groupBy("load_date").count().collect()) == [33, 33, 34]


def test_files_of_many_splits_are_read_as_they_lie(spark, base):
    """A fixed number of partitions holds more rows each as the tables grow."""
    columns = "id as l_orderkey, id as l_partkey, id as l_suppkey, cast(id % 7 as int) as l_linenumber, 1d as l_quantity, 1d as l_extendedprice, 0d as l_discount, 'R' as l_returnflag, 'O' as l_linestatus, timestamp_ntz '2001-02-03 00:00:00' as l_shipdate"
    for files in (1, 16):
        folder = f"{base}/{files}"
        spark.range(0, 160, 1, files).selectExpr(*columns.split(", ")).write.parquet(f"{folder}/lineitem.parquet")
        plan = spark_input(spark, folder, "source_reviews")._jdf.queryExecution().optimizedPlan().toString()
        assert ("Repartition" in plan) == (files == 1)


def test_raw_csv_comes_in_more_files_where_the_table_is_larger(spark, base, monkeypatch):
    docs = [(i, f'line {i}\nsays "{i}", twice', "en", "src0", 9) for i in range(300)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{base}/documents.parquet")
    read, files = landing_queries.read_csv_snapshot, []
    monkeypatch.setattr(landing_queries, "read_csv_snapshot", lambda s, p: files.extend(matching_files(s, p)) or read(s, p))
    for size in (32 << 20, 500):
        monkeypatch.setattr(landing_queries, "FILE_BYTES", size, raising=False)
        files.clear()
        rows = landing_queries.csv_multiline_split(spark, base).collect()
        assert sorted(int(r["doc_id"]) for r in rows) == list(range(300))
        assert len({r["text_md5"] for r in rows}) == 300
        assert (len(files) == 2) if size > 500 else (len(files) > 2)
