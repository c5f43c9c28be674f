"""The whole build: stage, model and store as Parquet tables."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from sparkmart.plans import deltas, models
from sparkmart.plans.models import store
from sparkmart.sources.landed import read_newest


def build_models(
    raw_reviews: DataFrame,
    raw_products: DataFrame,
    base: str,
    cuts=tuple(models.PRICE_CUTS),
    top=models.TOP_PRICE,
    exclusive_flag: str = models.EXCLUSIVE_FLAG,
    keep: Callable[[DataFrame, str], DataFrame] = store,
    stored: bool = False,
) -> dict[str, DataFrame]:
    """Staging and star schema from raw tables, stored under ``base``.

    Every model is stored because several later plans read it. ``exclusive_flag`` names
    the catalogue column that marks retailer exclusives, ``cuts`` and ``top`` the price bands.
    ``keep`` writes a table and reads it back; that of ``quality.Observed`` checks rows on the way.
    ``stored`` says that the raw reviews are a stored table, which is cheap to read more than once.
    """
    with ThreadPoolExecutor(2) as pool:
        staged = pool.submit(keep, models.stg_reviews(raw_reviews, stored), f"{base}/stg_reviews")
        tables = _products(raw_products, base, cuts, top, exclusive_flag, keep=keep)
        reviews = staged.result()
    fact = keep(models.fct_reviews(reviews, tables["dim_products"]), f"{base}/fct_reviews")
    raw = {"raw_reviews": raw_reviews, "raw_products": raw_products}
    return raw | tables | {"stg_reviews": reviews, "fct_reviews": fact}


def _products(raw_products: DataFrame, base: str, cuts, top, exclusive_flag: str, brands=None, keep=store) -> dict[str, DataFrame]:
    products = keep(models.stg_products(raw_products, exclusive_flag), f"{base}/stg_products")
    path = f"{base}/dim_brands"
    return {
        "stg_products": products,
        "dim_products": keep(models.dim_products(products, cuts, top, exclusive_flag), f"{base}/dim_products"),
        "dim_brands": brands(products.sparkSession, products, path) if brands else keep(models.dim_brands(products), path),
    }


def update_models(
    spark: SparkSession,
    raw: str,
    base: str,
    cuts=tuple(models.PRICE_CUTS),
    top=models.TOP_PRICE,
    exclusive_flag: str = models.EXCLUSIVE_FLAG,
    tags: str | None = None,
) -> dict[str, DataFrame]:
    """Bring stored models up to the landed files; only new and changed files are read.

    With the path of the tag table the complaint mart is brought up to it as well.
    """
    with ThreadPoolExecutor(2) as pool:
        staged = pool.submit(models.extend_staged_reviews, spark, f"{raw}/reviews", f"{base}/stg_reviews")
        products = read_newest(spark, f"{raw}/products")
        tables = _products(products, base, cuts, top, exclusive_flag, deltas.update_brands)
        staged.result()
    models.extend_fact(spark, f"{base}/stg_reviews", tables["dim_products"], f"{base}/fct_reviews")
    if tags:
        paths = tags, f"{base}/stg_reviews", f"{base}/fct_reviews"
        tables["mart_brand_complaints"] = deltas.update_mart(spark, *paths, tables["dim_brands"], f"{base}/mart_brand_complaints")
    return tables | {
        "stg_reviews": spark.read.parquet(f"{base}/stg_reviews"),
        "fct_reviews": spark.read.parquet(f"{base}/fct_reviews"),
    }
