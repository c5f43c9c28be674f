"""Report tables over the marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.functions.text import COMPLAINT_TYPES

TOP_BRANDS = 12
MIN_REVIEWS = 5


def top_k_groups(df: DataFrame, key: str, value: Column, k: int, out: str = "total") -> DataFrame:
    """The ``k`` keys with the largest sum, ties broken by key."""
    totals = df.groupBy(key).agg(F.sum(value).alias(out))
    return totals.orderBy(F.col(out).desc_nulls_last(), F.col(key).asc_nulls_last()).limit(k)


def _complaints(mart: DataFrame, labeler: str) -> DataFrame:
    return mart.where((F.col("labeler") == labeler) & (F.col("complaint_type") != "none"))


def top_complaints(mart: DataFrame, labeler: str, top_n: int = TOP_BRANDS) -> DataFrame:
    """Complaint counts and shares of the brands with most complaints."""
    complaints = _complaints(mart, labeler)
    top = top_k_groups(complaints, "brand_id", F.col("n_reviews"), top_n)
    return complaints.join(top, "brand_id", "left_semi").select(
        "brand_id", "brand_name", "complaint_type", "n_reviews", "share_of_brand_reviews"
    )


def complaint_grid(top: DataFrame, types: Sequence[str] = COMPLAINT_TYPES) -> DataFrame:
    """Brand by complaint type with 0 for missing pairs, fewest complaints first."""
    kinds = [t for t in types if t != "none"]
    grid = top.groupBy("brand_name").pivot("complaint_type", kinds).agg(F.sum("n_reviews"))
    total = sum((F.coalesce(F.col(t), F.lit(0)) for t in kinds), F.lit(0))
    return grid.na.fill(0, kinds).withColumn("total", total.cast("long")).orderBy("total", "brand_name")


def _ratings_by_product(facts: DataFrame) -> DataFrame:
    """Ratings counted per product, so that only products join the dimensions."""
    return facts.groupBy("product_id").agg(F.sum("rating").alias("stars"), F.count("rating").alias("rated"), F.count("*").alias("n_reviews"))


def price_vs_rating(
    facts: DataFrame, products: DataFrame, brands: DataFrame, min_reviews: int = MIN_REVIEWS
) -> DataFrame:
    """Price, mean rating and point size of products with enough reviews."""
    size = F.least(F.greatest(F.pow("n_reviews", F.lit(0.4)), F.lit(4.0)), F.lit(22.0))
    rated = _ratings_by_product(facts).where(F.col("n_reviews") >= min_reviews)
    named = products.where("price_usd is not null").join(brands.select("brand_id", "brand_name"), "brand_id")
    return rated.join(named.select("product_id", "product_name", "brand_name", "price_usd"), "product_id").select(
        "product_id",
        "product_name",
        "brand_name",
        "price_usd",
        (F.col("stars") / F.col("rated")).alias("avg_rating"),
        "n_reviews",
        F.round(size, 6).alias("point_size"),
    )


def rating_by_price_band(facts: DataFrame, products: DataFrame) -> DataFrame:
    """Mean rating and review count per price band, with a display label."""
    banded = products.where("price_band is not null").select("product_id", "price_band")
    totals = (
        _ratings_by_product(facts)
        .join(banded, "product_id")
        .groupBy("price_band")
        .agg((F.sum("stars") / F.sum("rated")).alias("avg_rating"), F.sum("n_reviews").alias("n_reviews"))
    )
    return totals.withColumn("label", F.expr("substring(price_band, 4)")).orderBy("price_band")


def loads(facts: DataFrame) -> DataFrame:
    """Reviews per batch and load date."""
    return (
        facts.groupBy("batch_id", "load_date")
        .agg(F.count("*").alias("n"))
        .orderBy(F.col("load_date").asc_nulls_last(), F.col("batch_id").asc_nulls_last())
    )


def kpis(facts: DataFrame, products: DataFrame, brands: DataFrame) -> DataFrame:
    """Counts of reviews, products, brands and batches, and the mean rating, in one row."""
    count = F.count("*").alias("n")
    # Counted per batch first: a distinct count beside plain ones would copy every row.
    per_batch = facts.groupBy("batch_id").agg(
        F.count("*").alias("reviews"), F.sum("rating").alias("stars"), F.count("rating").alias("rated")
    )
    return per_batch.agg(
        F.coalesce(F.sum("reviews"), F.lit(0)).alias("reviews"),
        F.count("batch_id").alias("batches"),
        F.round(F.sum("stars") / F.sum("rated"), 2).alias("avg_rating"),
    ).select(
        "reviews",
        products.agg(count).scalar().alias("products"),
        brands.agg(count).scalar().alias("brands"),
        "batches",
        "avg_rating",
    )


def main_labeler(mart: DataFrame) -> DataFrame:
    """The labeler with most rows in the mart."""
    return (
        mart.groupBy("labeler")
        .agg(F.count("*").alias("n"))
        .orderBy(F.col("n").desc(), F.col("labeler").asc_nulls_last())
        .limit(1)
    )
