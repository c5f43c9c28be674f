import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from sparkmart.catalog import checks
from sparkmart.operators import dedup
from sparkmart.plans import quality
from sparkmart.plans.quality import Check


@pytest.fixture(scope="module")
def reviews(spark):
    rows = [("a", "p1", "5", "fine"), ("a", "p1", "5", "fine"), ("b", None, "0", None), ("c", "P_X", "abc", " "),
            (None, "p2", None, "x"), (None, "p2", None, "x"), ("d", "P_X", "5.5", "y"), ("e", "p2", "NaN", "z"), ("f", "p2", "1d", "w")]
    return spark.createDataFrame(rows, "author string, product string, rating string, text string")


def test_single_row_checks(reviews):
    authors = lambda df: sorted(str(r["author"]) for r in df.collect())
    assert authors(quality.not_null(reviews, "product")) == ["b"]
    assert authors(quality.not_blank(reviews, "text")) == ["b", "c"]
    assert authors(quality.accepted_range(reviews, "rating", 1, 5)) == ["b", "c", "d", "e", "f"]
    assert authors(quality.accepted_range(reviews, "rating", 1)) == ["b", "c", "f"]
    assert authors(quality.accepted_range(reviews, "rating")) == ["c", "f"]


def test_range_on_numbers(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (-0.1,), (math.nan,), (None,), (1.1,)], "v double")
    assert quality.accepted_range(df, "v", 0, 1).count() == 3


def test_key_checks(spark, reviews):
    assert [tuple(r) for r in quality.unique(reviews, "author").collect()] == [("a", 2)]
    bad = quality.accepted_values(reviews, "product", ["p1", "p2"]).collect()
    assert [tuple(r) for r in bad] == [("P_X", 2)]
    for by_hash in (False, True):
        groups = quality.unique_combination(reviews, ["author", "product", "rating", "text"], by_hash).collect()
        assert sorted(map(str, (tuple(r) for r in groups))) == sorted(map(str, [("a", "p1", "5", "fine", 2), (None, "p2", None, "x", 2)]))
    parents = spark.createDataFrame([("p1",), ("p2",), (None,)], "id string")
    assert sorted(r["author"] for r in quality.relationships(reviews, "product", parents, "id").collect()) == ["c", "d"]
    assert [tuple(r) for r in quality.orphan_keys(reviews, "product", parents, "id").collect()] == [("P_X", 2)]


def test_batch_overlap(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("a", "y"), ("b", "x"), ("b", "x")], "k string, _batch_id string")
    assert [tuple(r) for r in quality.batch_overlap(df, ["k"]).collect()] == [("a", 2)]


def test_the_suite_is_complete():
    suite = quality.standard_suite()
    assert len(suite) == 35 and len({c.name for c in suite}) == 35
    count = lambda p: sum(1 for c in suite if c.table.startswith(p))
    assert (count("raw_"), count("review_tags")) == (6, 3)
    assert {c.severity for c in suite if c.table.startswith("raw_")} == {"warn"}
    assert {c.severity for c in suite if not c.table.startswith("raw_")} == {"error"}


CHECKS = [
    Check("t", ("product",), "not_null", severity="warn"),
    Check("t", ("text",), "not_blank", severity="warn"),
    Check("t", ("rating",), "accepted_range", {"low": 1, "high": 5}, "warn"),
    Check("t", ("author",), "not_null", severity="warn"),
    Check("t", ("author",), "unique"),
    Check("t", ("product",), "relationships", {"to": "p", "field": "id"}),
]


def test_a_run_stores_and_logs_before_it_raises(spark, reviews, base):
    tables = {"t": reviews, "p": spark.createDataFrame([("p1",), ("p2",)], "id string")}
    args = (f"{base}/audit", f"{base}/log", f"{base}/csv")
    with pytest.raises(quality.ChecksFailed, match="2 checks failed"):
        quality.run_suite(spark, tables, CHECKS, *args, run_id="one")
    log = quality.read_log(spark, f"{base}/log")
    assert {r["check"]: (r["status"], r["failures"]) for r in log.collect()} == {
        "not_null_t_product": ("warn", 1), "not_blank_t_text": ("warn", 2), "accepted_range_t_rating": ("warn", 5),
        "not_null_t_author": ("warn", 2), "unique_t_author": ("fail", 1), "relationships_t_product": ("fail", 2)}
    for check in CHECKS:
        stored = quality.read_failures(spark, check, f"{base}/audit")
        assert sorted(map(str, stored.collect())) == sorted(map(str, check.failing(tables).select(stored.columns).collect()))
    assert quality.latest_run(log).first()["check"] == "accepted_range_t_rating"
    exported = spark.read.option("header", True).csv(f"{base}/csv/*/accepted_range_t_rating")
    assert exported.count() == 5 and exported.columns == reviews.columns


def test_a_clean_run_replaces_old_warnings(spark, reviews, base):
    log = f"{base}/log"
    quality.run_suite(spark, {"t": reviews}, CHECKS[:3], f"{base}/audit", log)
    clean = reviews.where("author = 'a'")
    entries = quality.run_suite(spark, {"t": clean}, CHECKS[:3], f"{base}/audit", log, run_id="two")
    assert {r["status"] for r in entries.collect()} == {"pass"}
    later = quality.read_log(spark, log).withColumn(
        "run_at", F.when(F.col("run_id") == "two", F.col("run_at") + F.expr("interval 1 hour")).otherwise(F.col("run_at")))
    assert quality.latest_run(later).count() == 0 and quality.flagged_results(later).count() == 3
    assert quality.latest_run(quality.read_log(spark, f"{base}/none")).count() == 0


def test_exports_are_whole_and_logged(spark, base):
    tables = {"t": spark.range(30_000).select((F.col("id") % 15_000).cast("string").alias("author"))}
    with pytest.raises(quality.ChecksFailed):
        quality.run_suite(spark, tables, [Check("t", ("author",), "unique")], f"{base}/audit", f"{base}/log", f"{base}/csv")
    entry = quality.read_log(spark, f"{base}/log").first()
    assert spark.read.parquet(entry["audit_table"]).count() == 15_000
    assert spark.read.option("header", True).csv(entry["export_path"]).count() == 15_000


def test_an_export_sample_is_bounded_and_repeatable(spark):
    df = spark.range(300).select((F.col("id") * 31 % 300).alias("v")).repartition(5)
    assert sorted(r["v"] for r in quality.export_sample(df, 10).collect()) == list(range(10))


def test_own_check_kinds(spark, reviews):
    quality.register_check("shouting", row_rule=lambda c: F.upper(c) == F.col(c))
    quality.register_check("at_most", group_rule=lambda t, c: t[c.table].groupBy(*c.columns).count().where(f"count > {c.args['n']}"))
    checks = [Check("t", ("product",), "shouting"), Check("t", ("product",), "at_most", {"n": 2})]
    got = {r["check"]: r["failures"] for r in quality.suite_results({"t": reviews}, checks).collect()}
    assert got == {"shouting_t_product": 2, "at_most_t_product": 1}
    with pytest.raises(ValueError):
        quality.register_check("neither")


def test_rules_observed_on_the_write_equal_the_suite(spark, base):
    df = spark.createDataFrame([("a", 1), (None, 7), (" ", None)], "k string, v int")
    checks = [quality.Check("t", ("k",), "not_null"), quality.Check("t", ("k",), "not_blank", {}, "warn"), quality.Check("t", ("v",), "accepted_range", {"low": 1, "high": 5}),
              quality.Check("t", ("v",), "unique"), quality.Check("other", ("v",), "not_null")]
    observed = quality.Observed(checks)
    stored = observed.store(df, f"{base}/t")
    want = quality.suite_results({"t": stored}, checks[:3])
    assert sorted(map(tuple, observed.results(spark).collect())) == sorted(map(tuple, want.collect()))
    assert observed.store(df.limit(0), f"{base}/x", "other").count() == 0
    assert ("not_null_other_v", "other", "error", "pass", 0) in set(map(tuple, observed.results(spark).collect()))


def test_unique_by_hash_shuffles_no_key_that_occurs_once(spark):
    """The checks of review keys in the suite are by hash; NULL is ignored and repeated values are told as without."""
    df = spark.createDataFrame([(str(i // 2) if i < 20 else str(i) if i < 40 else None,) for i in range(45)], "k string")
    got, want = (sorted(map(tuple, quality.unique(df, "k", by_hash).collect())) for by_hash in (True, False))
    assert got == want == sorted((str(i), 2) for i in range(10))
    held = {c.name: c for c in quality.standard_suite()}
    for name in ("unique_stg_reviews_review_id", "unique_fct_reviews_review_id"):
        assert held[name].args == {"by_hash": True}
        tables = {held[name].table: df.withColumnRenamed("k", "review_id")}
        assert held[name].count(tables).first()[0] == 10 and held[name].failing(tables).count() == 10


@pytest.mark.parametrize("bits", [1, 1 << 10])
def test_only_rows_that_may_be_orphans_are_joined(spark, reviews, monkeypatch, bits):
    monkeypatch.setattr(dedup, "BITS", bits)
    parents = spark.createDataFrame([("p1",), ("p2",), (None,)], "id string")
    found = quality.relationships(reviews, "product", parents, "id")
    assert "_word" in found._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(found.columns) == sorted(reviews.columns) and sorted(r["author"] for r in found.collect()) == ["c", "d"]
    assert quality.relationships(reviews.where("product is null"), "product", parents, "id").count() == 0


def test_the_suite_checks_the_tags_of_two_labelers(spark, tmp_path):
    """Only one labeler had tagged. The one that reads titles finds the complaint in a title."""
    parts = [(k, f"part {k}", f"Brand#{k % 2}1", "TIN", 5, 900.0) for k in range(1, 4)]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    line = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    lines = [(k, 1 + k % 3, k, n, 5.0, 1.0, 0.5, 0.0, "too greasy" if k == 7 else "R", "F", dt.datetime(1995, 1, k)) for k in range(1, 9) for n in (1, 2)]
    spark.createDataFrame(lines, line).write.parquet(f"{tmp_path}/lineitem.parquet")
    tables = checks.suite_tables(spark, str(tmp_path), f"{tmp_path}/suite")
    reviews = sorted(r["review_id"] for r in tables["fct_reviews"].collect())
    tags = tables["review_tags"].collect()
    for who in ("keyword_baseline", "keyword_titled"):
        assert sorted(r["review_id"] for r in tags if r["labeler"] == who) == reviews and len(reviews) == 16
    assert {r["labeler"] for r in tables["mart_brand_complaints"].collect()} == {"keyword_baseline", "keyword_titled"}
    assert len(tags) == 2 * len(reviews)
    assert "keyword_titled" in checks.ORACLES["dq_log"]
    greasy = [r["labeler"] for r in tags if r["evidence"] == "greasy"]
    assert greasy.count("keyword_titled") >= 1
