"""Signed counts: group states, brands and the complaint mart against full results."""

import random

import pytest

from sparkmart.operators.group_state import GroupState
from sparkmart.plans import build, deltas, models
from sparkmart.sources.landed import read_landed
from sparkmart.sources.paths import delete
from tests.test_models import D, land_products, land_reviews, product, review, rows

BRAND = ["brand_id", "brand_name", "n_products", "median_price_usd", "avg_catalog_rating", "total_loves"]
MART = ["brand_id", "brand_name", "labeler", "complaint_type", "n_reviews", "n_negative", "n_tagged_for_brand", "share_of_brand_reviews"]


def test_group_states_by_run(spark, base):
    state = GroupState(spark, f"{base}/s", "k int, t string", ["n"], "k", buckets=3)
    delta = lambda *r: spark.createDataFrame(list(r), "k int, t string, n long")
    state.merge(delta((1, "a", 2), (2, None, 1)), 1)
    state.merge(delta((1, "a", -2), (3, "c", 5)), 2)
    state.merge(delta((1, "a", -2), (3, "c", 5)), 2)  # repeated
    assert rows(state.read(2), "k", "t", "n") == [(2, None, 1), (3, "c", 5)]
    assert rows(state.read(1), "k", "t", "n") == [(1, "a", 2), (2, None, 1)]
    assert state.merge(delta(), 3) == [] and rows(state.read(9), "k", "n") == [(2, 1), (3, 5)]


def test_brands_follow_random_catalogues(spark, base):
    r = random.Random(4)
    for step in range(3):
        rows_ = [
            product(f"p{i}", r.choice(["1", "2", "3", "n/a"]), r.choice(["1.5", "2", "9", None]), brand_name=r.choice("xyz"),
                    rating=r.choice(["4.5", "3", None]), loves_count=r.choice(["7", None]))
            for i in range(12) if r.random() < 0.7
        ]
        delete(spark, f"{base}/raw")
        land_products(spark, base, D[0], rows_)
        staged = models.store(models.stg_products(read_landed(spark, f"{base}/raw/products")), f"{base}/staged{step}")
        want = rows(models.dim_brands(staged), *BRAND)
        for _ in range(1 + step % 2):  # once more with nothing changed
            assert rows(deltas.update_brands(spark, staged, f"{base}/brands"), *BRAND) == want


def tag(spark, base, tags):
    spark.createDataFrame(tags, "review_id string, labeler string, sentiment string, complaint_type string").write.mode("append").parquet(f"{base}/tags")


def test_the_mart_follows_the_build(spark, base):
    """Reviews move, go and come back; tags come before and after their reviews; orphans are taken in; names change."""
    r = random.Random(6)
    names = iter("abcdef")

    def step(days, tagged):
        for day in days:
            land_reviews(spark, base, day, [review(f"u{r.randrange(12)}", r.choice(["p1", "p2", "late"]), D[0]) for _ in range(9)])
        name = next(names)
        land_products(spark, base, D[3], [product("p1", brand_name=name), product("p2", "2")] + ([product("late", "2")] if name > "b" else []))
        staged = models.stg_reviews(read_landed(spark, f"{base}/raw/reviews"))
        some = [(k["review_id"], w, r.choice(["negative", "neutral"]), r.choice(["scent", "none"])) for k in staged.select("review_id").collect() for w in "xy"]
        some = [t for t in some if t[:2] not in tagged and r.random() < 0.5]
        tagged.update(t[:2] for t in some)
        if some:
            tag(spark, base, some)
        tables = build.update_models(spark, f"{base}/raw", f"{base}/models", tags=f"{base}/tags")
        want = models.mart_brand_complaints(spark.read.parquet(f"{base}/tags"), tables["fct_reviews"], tables["dim_brands"])
        assert rows(tables["mart_brand_complaints"], *MART) == rows(want, *MART) and want.count()
        return tables

    tagged: set = set()
    step([D[1], D[2]], tagged)
    step([D[0]], tagged)
    delete(spark, f"{base}/raw/reviews/load_date={D[0]}")
    tables = step([D[2]], tagged)
    path = f"{base}/models/fct_reviews"
    models.extend_fact(spark, f"{base}/models/stg_reviews", tables["dim_products"], path, reprocess_orphans=True)
    step([], tagged)


def test_a_mart_run_that_died_and_tags_that_went(spark, base, monkeypatch):
    land_reviews(spark, base, D[0], [review(f"u{i}", "p1", D[0]) for i in range(4)])
    land_products(spark, base, D[0], [product("p1")])
    keys = [k["review_id"] for k in models.stg_reviews(read_landed(spark, f"{base}/raw/reviews")).select("review_id").orderBy("review_id").collect()]
    tag(spark, base, [(k, "x", "negative", "scent") for k in keys[:2]])
    update = lambda: build.update_models(spark, f"{base}/raw", f"{base}/models", tags=f"{base}/tags")["mart_brand_complaints"]
    assert rows(update(), "complaint_type", "n_reviews", "n_negative") == [("scent", 2, 2)]
    tag(spark, base, [(keys[2], "x", "neutral", "none"), (keys[3], "x", "neutral", "scent")])
    whole = GroupState.merge

    def die(self, delta, run):
        whole(self, delta, run)
        raise RuntimeError("died")

    monkeypatch.setattr(GroupState, "merge", die)
    with pytest.raises(RuntimeError, match="died"):
        deltas.update_mart(spark, f"{base}/tags", f"{base}/models/stg_reviews", f"{base}/models/fct_reviews",
                           spark.read.parquet(f"{base}/models/dim_brands"), f"{base}/models/mart_brand_complaints")
    monkeypatch.undo()
    want = [("none", 1, 0), ("scent", 3, 2)]
    assert rows(update(), "complaint_type", "n_reviews", "n_negative") == want
    assert rows(update(), "complaint_type", "n_reviews", "n_negative") == want  # nothing new
    delete(spark, f"{base}/tags")
    tag(spark, base, [(keys[0], "x", "neutral", "none")])
    assert rows(update(), "complaint_type", "n_reviews", "n_negative") == [("none", 1, 0)]
