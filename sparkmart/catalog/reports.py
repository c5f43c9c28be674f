"""The complaint mart and the report tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkmart.catalog.casts import PRICE_CUTS, TOP_PRICE
from sparkmart.catalog.inputs import oracle_inputs, spark_input, table
from sparkmart.catalog.models import DIM_BRANDS, DIM_PRODUCTS, STG_PRODUCTS
from sparkmart.catalog.tagging import keyword_sql
from sparkmart.functions.text import COMPLAINT_TYPES, LEXICON
from sparkmart.plans import models, reports, tagging

# A second labeler reads the patterns in the other order, so its labels differ.
REVERSED = LEXICON[::-1]
TOP = 5


def tags(spark, sf_dir):
    """Labels of every document by two labelers."""
    texts = spark_input(spark, sf_dir, "text_reviews").withColumnRenamed("review_text", "text")
    first = tagging.tag_rows(tagging.keyword_tags(texts), "keyword_baseline", "regex-v1")
    second = tagging.tag_rows(tagging.keyword_tags(texts, lexicon=REVERSED), "keyword_reversed", "regex-v2")
    return first.unionByName(second.where("is_complaint"))


def _brands(spark, sf_dir):
    sources = table(spark, sf_dir, "documents").select(F.col("source").alias("brand_id")).distinct()
    return sources.withColumn("brand_name", F.concat(F.lit("Brand "), "brand_id"))


def mart(spark, sf_dir):
    facts = spark_input(spark, sf_dir, "text_reviews")
    return models.mart_brand_complaints(tags(spark, sf_dir), facts, _brands(spark, sf_dir))


def share_of_total(spark, sf_dir):
    """Order value share of each priority in its status."""
    orders = table(spark, sf_dir, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))
    return models.share_of_total(orders, ["o_orderstatus"], "n", "n_status", "share")


def top_k_groups(spark, sf_dir):
    return reports.top_k_groups(table(spark, sf_dir, "lineitem"), "l_partkey", F.col("l_quantity").cast("long"), 25)


def top_complaints(spark, sf_dir):
    return reports.top_complaints(mart(spark, sf_dir), "keyword_baseline", TOP)


def complaint_grid(spark, sf_dir):
    return reports.complaint_grid(top_complaints(spark, sf_dir))


def main_labeler(spark, sf_dir):
    return reports.main_labeler(mart(spark, sf_dir))


def tag_counts(spark, sf_dir):
    return tagging.tag_counts(tags(spark, sf_dir))


def _star(spark, sf_dir):
    products = models.stg_products(spark_input(spark, sf_dir, "raw_products"))
    return spark_input(spark, sf_dir, "facts"), models.dim_products(products, PRICE_CUTS, TOP_PRICE), products


def price_vs_rating(spark, sf_dir):
    facts, products, staged = _star(spark, sf_dir)
    return reports.price_vs_rating(facts, products, models.dim_brands(staged))


def price_band_report(spark, sf_dir):
    facts, products, _ = _star(spark, sf_dir)
    return reports.rating_by_price_band(facts, products)


def loads(spark, sf_dir):
    return reports.loads(spark_input(spark, sf_dir, "facts"))


def kpis(spark, sf_dir):
    facts, products, staged = _star(spark, sf_dir)
    return reports.kpis(facts, products, models.dim_brands(staged))


QUERIES = {
    "mart_complaints": mart,
    "share_of_total": share_of_total,
    "top_k_groups": top_k_groups,
    "report_top_complaints": top_complaints,
    "report_complaint_grid": complaint_grid,
    "report_main_labeler": main_labeler,
    "report_tag_counts": tag_counts,
    "report_price_vs_rating": price_vs_rating,
    "report_price_band": price_band_report,
    "report_loads": loads,
    "report_kpis": kpis,
}

_share = "cast(round(cast({n} / {total} as decimal(18, 12)), 4) as double)".format
_TAGS = f"""{oracle_inputs('text_reviews')},
  texts as (select *, review_text as text from text_reviews),
  {keyword_sql(LEXICON).format(source='texts', name='labelled_a')},
  {keyword_sql(REVERSED).format(source='texts', name='labelled_b')},
  tags as (
    select review_id, 'keyword_baseline' as labeler, 'regex-v1' as model, sentiment, complaint_type from labelled_a
    union all
    select review_id, 'keyword_reversed', 'regex-v2', sentiment, complaint_type from labelled_b where complaint_type <> 'none')"""
# The mart from one row per tagged review: windows count, then equal rows fall together.
_MART = f"""{_TAGS},
  tagged as (
    select r.brand_id, t.labeler, t.complaint_type, t.sentiment = 'negative' as bad
    from text_reviews r join tags t on t.review_id = r.review_id),
  counted as (
    select brand_id, labeler, complaint_type, count(*) over same as n_reviews, sum(bad::int) over same as n_bad,
      count(*) over (partition by brand_id, labeler) as n_tagged_for_brand
    from tagged window same as (partition by brand_id, labeler, complaint_type)),
  mart as (
    select distinct brand_id, concat('Brand ', brand_id) as brand_name, labeler, complaint_type, n_reviews,
      cast(n_bad as bigint) as n_negative, n_tagged_for_brand,
      {_share(n='n_reviews', total='n_tagged_for_brand')} as share_of_brand_reviews
    from counted)"""
_TOP = f"""{_MART},
  named as (
    select *, sum(n_reviews) over (partition by brand_id) as brand_complaints
    from mart where labeler = 'keyword_baseline' and complaint_type != 'none'),
  top_rows as (
    select brand_id, brand_name, complaint_type, n_reviews, share_of_brand_reviews
    from named qualify dense_rank() over (order by brand_complaints desc, brand_id) <= {TOP})"""
_KINDS = [t for t in COMPLAINT_TYPES if t != "none"]
_GRID = ", ".join(
    f"cast(coalesce(sum(n_reviews) filter (where complaint_type = '{t}'), 0) as bigint) as {t}" for t in _KINDS
)
# Reports from sums per product.
_STAR = f"""{oracle_inputs('raw_products', 'facts')},
{STG_PRODUCTS},
{DIM_PRODUCTS},
{DIM_BRANDS},
per_product as (
  select p.product_id, count(f.rating) as n, sum(f.rating) as stars from facts f, dim_products p
  where f.product_id = p.product_id group by p.product_id),
sold as (select * from per_product natural join dim_products)"""

ORACLES = {
    "mart_complaints": f"{_MART} select * from mart",
    "share_of_total": f"""with n as (
        select o_orderstatus, o_orderpriority, count(*) as n from orders group by 1, 2),
      t as (select *, cast(sum(n) over (partition by o_orderstatus) as bigint) as n_status from n)
      select *, {_share(n='n', total='n_status')} as share from t""",
    "top_k_groups": """select l_partkey, cast(sum(cast(l_quantity as bigint)) as bigint) as total from lineitem
      group by 1 order by total desc, l_partkey limit 25""",
    "report_top_complaints": f"{_TOP} select * from top_rows",
    "report_complaint_grid": f"""{_TOP}
      select brand_name, {_GRID}, cast(sum(n_reviews) as bigint) as total from top_rows group by brand_name""",
    "report_main_labeler": f"{_MART} select labeler, count(*) as n from mart group by 1 order by n desc, labeler limit 1",
    "report_tag_counts": f"{_TAGS} select labeler, model, count(*) as n from tags group by 1, 2",
    "report_price_vs_rating": f"""{_STAR}
      select s.product_id, s.product_name, b.brand_name, s.price_usd, s.stars / s.n as avg_rating, s.n as n_reviews,
        round(case when s.n ** 0.4 < 4 then 4.0 when s.n ** 0.4 > 22 then 22.0 else s.n ** 0.4 end, 6) as point_size
      from sold s, dim_brands b where b.brand_id = s.brand_id and s.price_usd is not null and s.n >= 5""",
    "report_price_band": f"""{_STAR}
      select price_band, cast(sum(stars) as double) / sum(n) as avg_rating, cast(sum(n) as bigint) as n_reviews,
        substr(price_band, 4) as label
      from sold group by price_band having price_band is not null""",
    "report_loads": f"""{oracle_inputs('facts')}
      select distinct batch_id, load_date, count(*) over (partition by batch_id, load_date) as n from facts""",
    "report_kpis": f"""{_STAR},
      all_facts as (select count(*) as reviews, count(distinct batch_id) as batches, sum(rating) / count(rating) as mean from facts),
      all_products as (select count(*) as products from dim_products),
      all_brands as (select count(*) as brands from dim_brands)
      select reviews, products, brands, batches, round(mean, 2) as avg_rating from all_facts, all_products, all_brands""",
}
