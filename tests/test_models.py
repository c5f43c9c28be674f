import datetime as dt

import pytest
from pyspark.sql import functions as F

from sparkmart.operators.landing import land_partition
from sparkmart.plans import build, models
from sparkmart.sources.landed import read_landed
from sparkmart.sources.paths import exists, partition_values

D = [dt.date(2022, 1, n) for n in range(1, 6)]
REVIEW = [
    "author_id", "rating", "is_recommended", "helpfulness", "total_feedback_count", "total_neg_feedback_count",
    "total_pos_feedback_count", "submission_time", "review_text", "review_title", "skin_tone", "eye_color",
    "skin_type", "hair_color", "product_id", "price_usd",
]
PRODUCT = [
    "product_id", "product_name", "brand_id", "brand_name", "price_usd", "sale_price_usd", "rating", "reviews",
    "loves_count", "size", "primary_category", "secondary_category", "tertiary_category", "limited_edition", "new",
    "online_only", "out_of_stock", "store_exclusive",
]


def review(author, product, day, rating="5", text="good", **other):
    row = dict.fromkeys(REVIEW, None) | {
        "author_id": author, "product_id": product, "submission_time": str(day), "rating": rating, "review_text": text,
    }
    return row | other


def product(pid, brand="1", price="10", **other):
    row = dict.fromkeys(PRODUCT, None) | {"product_id": pid, "brand_id": brand, "brand_name": f"b{brand}", "price_usd": price}
    return row | other


def frame(spark, rows, columns):
    return spark.createDataFrame([[r[c] for c in columns] for r in rows], ", ".join(f"{c} string" for c in columns))


def land_reviews(spark, base, day, rows):
    land_partition(frame(spark, rows, REVIEW), f"{base}/raw/reviews", day, f"daily_{day}", f"{day}T00:00:00")


def land_products(spark, base, day, rows, at="T00:00:00"):
    land_partition(frame(spark, rows, PRODUCT), f"{base}/raw/products", day, f"daily_{day}", f"{day}{at}")


def full(spark, base):
    products = models.stg_products(read_landed(spark, f"{base}/raw/products"))
    return models.fct_reviews(models.stg_reviews(read_landed(spark, f"{base}/raw/reviews")), products)


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


def test_staging_types_and_drops_unusable_rows(spark, base):
    land_reviews(spark, base, D[0], [
        review(" a ", "p", D[0], "4.0", "  ", is_recommended="0.6", helpfulness="0.5", skin_tone=" ", skin_type=""),
        review("b", None, D[0]), review("c", "p", D[0], "6"), review("d", "p", D[0], "abc"), review("e", "p", "soon"),
    ])
    got = models.stg_reviews(read_landed(spark, f"{base}/raw/reviews")).collect()
    assert len(got) == 1
    r = got[0]
    assert (r["author_id"], r["rating"], r["review_text"], r["is_recommended"], r["skin_tone"], r["skin_type"]) == (
        "a", 4, None, True, " ", None)
    assert r["load_date"] == D[0] and r["batch_id"] == f"daily_{D[0]}"


def test_products_come_from_the_newest_snapshot_and_its_last_copy(spark, base):
    land_products(spark, base, D[0], [product("p"), product("gone")])
    land_products(spark, base, D[1], [product(" p ", price="30", new="1", size=" "), product(None)])
    got = models.stg_products(read_landed(spark, f"{base}/raw/products")).collect()
    assert [(r["product_id"], r["price_usd"], r["is_new"], r["size"], r["is_online_only"]) for r in got] == [
        ("p", 30.0, True, None, None)]
    assert models.dim_products(models.stg_products(read_landed(spark, f"{base}/raw/products"))).first()["price_band"] == "2. $25-50"


def test_the_exclusive_flag_takes_the_name_of_its_column(spark, base):
    land_products(spark, base, D[0], [product("p", store_exclusive="1")])
    raw = read_landed(spark, f"{base}/raw/products").withColumnRenamed("store_exclusive", "shop_exclusive")
    staged = models.stg_products(raw, "shop_exclusive")
    assert models.dim_products(staged, exclusive_flag="shop_exclusive").first()["is_shop_exclusive"] is True


def grow(spark, base, batches, catalogue):
    """Land batch after batch and extend the stored models after each."""
    for day, reviews in batches:
        land_reviews(spark, base, day, reviews)
        land_products(spark, base, day, catalogue(day))
        build.update_models(spark, f"{base}/raw", f"{base}/models")
    return spark.read.parquet(f"{base}/models/fct_reviews")


def test_growing_table_equals_a_full_rebuild(spark, base):
    again = review("a0", "p0", D[0])
    batches = [
        (D[0], [review(f"a{i}", f"p{i % 3}", D[0]) for i in range(30)] + [again]),
        (D[1], [review(f"b{i}", f"p{i % 3}", D[1]) for i in range(10)] + [again, again]),  # a late copy
        (D[2], [review("bad", "p0", D[2], "9")]),  # nothing usable
        (D[3], [review(f"c{i}", "p1" if i % 3 else "unknown", D[3]) for i in range(10)]),
    ]
    grown = grow(spark, base, batches, lambda d: [product(f"p{i}") for i in range(3)])
    want = full(spark, base)
    assert rows(grown, *models.FACT_COLUMNS) == rows(want, *models.FACT_COLUMNS)
    assert grown.count() == 30 + 10 + 6
    assert grown.select("review_id").distinct().count() == grown.count()


@pytest.mark.parametrize("older,newer", [
    (review("a|p", "2022-01-01", D[1], text="t"), review("a", "p", "2022-01-01", text="2022-01-02|t")),
    (review(None, "p", D[0], text="2022-01-02|t"), review("p", "2022-01-01", D[1], text="t")),
])
def test_keys_that_can_be_read_in_two_ways_still_meet(spark, base, older, newer):
    """Equal keys from rows of different days: the first landed copy wins."""
    land_reviews(spark, base, D[0], [older])
    models.extend_staged_reviews(spark, f"{base}/raw/reviews", f"{base}/staged")
    land_reviews(spark, base, D[3], [newer, review("x", "p", D[3])])
    models.extend_staged_reviews(spark, f"{base}/raw/reviews", f"{base}/staged")
    want = models.stg_reviews(read_landed(spark, f"{base}/raw/reviews"))
    got = spark.read.parquet(f"{base}/staged")
    assert rows(got, "review_id", "load_date") == rows(want, "review_id", "load_date") and got.count() == 2


def test_orphans_stay_out_unless_asked_for(spark, base):
    batches = [(D[0], [review("a", "p0", D[0]), review("b", "late", D[0])]), (D[1], [review("c", "p0", D[1])])]
    grown = grow(spark, base, batches, lambda d: [product("p0")] + ([product("late")] if d > D[0] else []))
    assert rows(grown, "author_id") == [("a",), ("c",)]
    products = spark.read.parquet(f"{base}/models/dim_products")
    path = f"{base}/models/fct_reviews"
    assert models.extend_fact(spark, f"{base}/models/stg_reviews", products, path) == []
    assert models.extend_fact(spark, f"{base}/models/stg_reviews", products, path, True) == [str(D[0])]
    assert rows(spark.read.parquet(path), "author_id") == [("a",), ("b",), ("c",)]
    assert models.extend_fact(spark, f"{base}/models/stg_reviews", products, path, True) == []


def test_a_first_build_that_died_is_done_again(spark, base):
    batches = [(d, [review(f"a{d}", "p0", d)]) for d in D[:3]]
    grow(spark, base, batches, lambda d: [product("p0")])
    products, staged = spark.read.parquet(f"{base}/models/dim_products"), f"{base}/models/stg_reviews"
    path = f"{base}/half"
    newest = spark.read.parquet(f"{base}/models/fct_reviews").where(F.col("load_date") == F.lit(D[2]))
    newest.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").partitionBy("load_date").parquet(path)
    models.extend_fact(spark, staged, products, path)
    assert spark.read.parquet(path).count() == 3


def test_reloaded_reviews_replace_their_rows(spark, base):
    batches = [(D[0], [review(f"a{i}", "p0", D[0]) for i in range(6)]), (D[1], [review("c", "p0", D[1])])]
    grow(spark, base, batches, lambda d: [product("p0")])
    products, path = spark.read.parquet(f"{base}/models/dim_products"), f"{base}/models/fct_reviews"
    staged = spark.read.parquet(f"{base}/models/stg_reviews")
    changed = staged.where("author_id in ('a1', 'c')").withColumns({"rating": F.lit(1), "load_date": F.lit(D[1])})
    changed.write.parquet(f"{base}/changed")
    assert models.reload_fact(spark, spark.read.parquet(f"{base}/changed"), products, path) == [str(D[0]), str(D[1])]
    got = spark.read.parquet(path)
    assert rows(got.where("rating = 1"), "author_id", "load_date") == [("a1", D[1]), ("c", D[1])] and got.count() == 7


def test_staging_a_batch_twice_changes_nothing(spark, base):
    land_reviews(spark, base, D[0], [review("a", "p", D[0])])
    assert models.extend_staged_reviews(spark, f"{base}/raw/reviews", f"{base}/staged") == [str(D[0])]
    assert models.extend_staged_reviews(spark, f"{base}/raw/reviews", f"{base}/staged") == []
    land_reviews(spark, base, D[0], [review("a", "p", D[0]), review("b", "p", D[0])])
    assert models.extend_staged_reviews(spark, f"{base}/raw/reviews", f"{base}/staged") == [str(D[0])]
    assert spark.read.parquet(f"{base}/staged").count() == 2
    assert partition_values(spark, f"{base}/staged", "load_date") == [str(D[0])]


def test_hot_product_and_brand_totals(spark, base):
    land_products(spark, base, D[0], [product(f"p{i}", str(i % 2), str(i), loves_count="2", rating="4.5") for i in range(10)]
                  + [product("x", "n/a")])
    land_reviews(spark, base, D[0], [review(f"a{i}", "p0" if i % 3 == 0 else f"p{i % 10}", D[0]) for i in range(300)])
    products = models.stg_products(read_landed(spark, f"{base}/raw/products"))
    assert rows(models.dim_brands(products), "brand_id", "brand_name", "n_products", "median_price_usd", "avg_catalog_rating", "total_loves") == [
        (0, "b0", 5, 4.0, 4.5, 10), (1, "b1", 5, 5.0, 4.5, 10)]
    assert full(spark, base).count() == 300


def test_complaint_mart_keeps_labelers_apart(spark):
    facts = spark.createDataFrame([(f"r{i}", i % 2) for i in range(10)], "review_id string, brand_id int")
    brands = spark.createDataFrame([(0, "zero"), (1, "one")], "brand_id int, brand_name string")
    tag = lambda i, who, kind: (f"r{i}", who, "negative" if i < 4 else "neutral", kind)
    tags = [tag(i, "x", "scent" if i < 6 else "none") for i in range(10)] + [tag(0, "y", "scent"), tag(99, "y", "scent")]
    df = spark.createDataFrame(tags, "review_id string, labeler string, sentiment string, complaint_type string")
    got = rows(models.mart_brand_complaints(df, facts, brands), "brand_name", "labeler", "complaint_type", "n_reviews",
               "n_negative", "n_tagged_for_brand", "share_of_brand_reviews")
    assert got == sorted([
        ("zero", "x", "scent", 3, 2, 5, 0.6), ("zero", "x", "none", 2, 0, 5, 0.4), ("zero", "y", "scent", 1, 1, 1, 1.0),
        ("one", "x", "scent", 3, 2, 5, 0.6), ("one", "x", "none", 2, 0, 5, 0.4)], key=str)


def test_restaging_keeps_no_copies_of_rows_and_ranks_rivals_only(spark, base):
    """A batch lands wrong and again with rows that are new, repeated, changed or staged under a later day; run folders are gone afterwards."""
    raw, staged = f"{base}/raw/reviews", f"{base}/staged"
    land_products(spark, base, D[0], [product("p")])
    land_reviews(spark, base, D[1], [review(f"a{i}", "p", D[0], review_title="wrong") for i in range(6)])
    land_reviews(spark, base, D[2], [review("b", "p", D[0]), review("late", "p", D[0], review_title="later"), review("c", "p", D[0])])
    products = models.stg_products(read_landed(spark, f"{base}/raw/products"))
    for step in range(4):
        if step == 1:
            again = [review(f"a{i}", "p", D[0], review_title=f"t{i}") for i in range(3, 9)]
            land_reviews(spark, base, D[1], [*again, again[0] | {"review_title": "s"}, review("late", "p", D[0], review_title="first")])
        if step == 2:
            land_reviews(spark, base, D[0], [review("c", "p", D[0], review_title="z"), review("c", "p", D[0], review_title="y"), review("n", "p", D[0])])
        if step == 3:
            land_reviews(spark, base, D[0], [review("n", "p", D[0])])
        models.extend_staged_reviews(spark, raw, staged)
        models.extend_fact(spark, staged, products, f"{base}/fact")
        want = models.stg_reviews(read_landed(spark, raw))
        assert rows(spark.read.parquet(staged), *want.columns) == rows(want, *want.columns)
        assert rows(spark.read.parquet(f"{base}/fact"), *models.FACT_COLUMNS) == rows(models.fct_reviews(want, products), *models.FACT_COLUMNS)
        assert not exists(spark, f"{staged}_run") and not exists(spark, f"{base}/fact_run")
