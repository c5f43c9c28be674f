"""Casts, blanks, keys, bands and text assembly."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkmart.catalog.inputs import oracle_inputs, spark_input, table
from sparkmart.functions import casts
from sparkmart.functions.text import assemble_text
from sparkmart.plans.models import REVIEW_KEY

JUNK = """
  select l_orderkey, l_linenumber, l_suppkey,
    case l_orderkey % 17 when 0 then '4.0' when 1 then '2.5' when 2 then '-2.5' when 3 then ' 5 ' when 4 then '1e2'
      when 5 then '' when 6 then 'abc' when 7 then '3000000000' when 8 then '0.5' when 9 then '1d' when 10 then '7f'
      when 11 then 'NaN' else cast(l_extendedprice as string) end as number_text,
    case l_orderkey % 13 when 0 then '2022-6-2' when 1 then '2022' when 2 then '2022-06' when 3 then '2022/06/02'
      when 4 then '2022-02-30' when 5 then '06/02/2022' when 6 then '' when 7 then cast(null as string)
      else cast(l_shipdate as string) end as date_text,
    (l_linenumber % 6) / 2.0 + l_suppkey % 3 as half
  from {lineitem}"""

PRICE_CUTS = [(925, "1. <$925"), (950, "2. $925-950"), (975, "3. $950-975")]
TOP_PRICE = "4. $975+"


def _junk(spark, sf_dir):
    return spark.sql(JUNK, lineitem=table(spark, sf_dir, "lineitem"))


def safe_casts(spark, sf_dir):
    return _junk(spark, sf_dir).select(
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        casts.try_int("number_text").alias("as_int"),
        F.nullif(casts.try_double("number_text"), F.lit(float("nan"))).alias("as_double"),
        casts.double_to_int("cast(half as double)").alias("half_to_int"),
    )


def safe_dates(spark, sf_dir):
    return _junk(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", "l_suppkey", "date_text", casts.leading_date("date_text").alias("as_date")
    )


def flag_cast(spark, sf_dir):
    raw = spark_input(spark, sf_dir, "catalogue")
    flags = ["limited_edition", "new", "online_only", "out_of_stock", "store_exclusive"]
    return raw.select("product_id", *[casts.flag(c).alias(f"is_{c}") for c in flags])


def blank_to_null(spark, sf_dir):
    return spark_input(spark, sf_dir, "source_reviews").select(
        F.trim("author_id").alias("author_id"),
        casts.blank_to_null("review_title").alias("review_title"),
        casts.blank_to_null("review_text").alias("review_text"),
        casts.empty_to_null("skin_tone").alias("skin_tone"),
        casts.empty_to_null("skin_type").alias("skin_type"),
    )


def surrogate_key(spark, sf_dir):
    key = casts.surrogate_key(*REVIEW_KEY)
    return spark_input(spark, sf_dir, "source_reviews").select("author_id", "product_id", key.alias("review_id"))


def price_band(spark, sf_dir):
    priced = spark_input(spark, sf_dir, "catalogue").select(
        F.trim("product_id").alias("product_id"), casts.try_double("price_usd").alias("price_usd")
    )
    return priced.withColumn("price_band", casts.band("price_usd", PRICE_CUTS, TOP_PRICE))


def review_text_assembly(spark, sf_dir):
    return spark_input(spark, sf_dir, "text_reviews").select(
        "review_id", assemble_text("review_title", "review_text").alias("text")
    )


QUERIES = {
    "safe_casts": safe_casts,
    "safe_dates": safe_dates,
    "flag_cast": flag_cast,
    "blank_to_null": blank_to_null,
    "surrogate_key": surrogate_key,
    "price_band": price_band,
    "review_text_assembly": review_text_assembly,
}

_JUNK = f"with junk as ({JUNK.format(lineitem='lineitem')})"
BAND_SQL = """case when price_usd < 925 then '1. <$925' when price_usd < 950 then '2. $925-950'
    when price_usd < 975 then '3. $950-975' when price_usd >= 975 then '4. $975+' end"""

ORACLES = {
    "safe_casts": f"""{_JUNK}
      select l_orderkey, l_linenumber, l_suppkey, try_cast(number_text as integer) as as_int,
        case when not isnan(try_cast(number_text as double)) then try_cast(number_text as double) end as as_double,
        try_cast(cast(half as double) as integer) as half_to_int
      from junk""",
    "safe_dates": f"""{_JUNK}
      select l_orderkey, l_linenumber, l_suppkey, date_text, try_cast(left(date_text, 10) as date) as as_date
      from junk""",
    "flag_cast": f"""{oracle_inputs('catalogue')}
      select product_id, try_cast(limited_edition as integer) = 1 as is_limited_edition,
        try_cast(new as integer) = 1 as is_new, try_cast(online_only as integer) = 1 as is_online_only,
        try_cast(out_of_stock as integer) = 1 as is_out_of_stock,
        try_cast(store_exclusive as integer) = 1 as is_store_exclusive
      from catalogue""",
    "blank_to_null": f"""{oracle_inputs('source_reviews')}
      select trim(author_id) as author_id, nullif(trim(review_title), '') as review_title,
        nullif(trim(review_text), '') as review_text, nullif(skin_tone, '') as skin_tone,
        nullif(skin_type, '') as skin_type
      from source_reviews""",
    "surrogate_key": f"""{oracle_inputs('source_reviews')}
      select author_id, product_id,
        md5(concat_ws('|', author_id, product_id, submission_time, coalesce(review_text, ''))) as review_id
      from source_reviews""",
    "price_band": f"""{oracle_inputs('catalogue')},
      priced as (select trim(product_id) as product_id, try_cast(price_usd as double) as price_usd from catalogue)
      select *, {BAND_SQL} as price_band from priced""",
    "review_text_assembly": f"""{oracle_inputs('text_reviews')}
      select review_id, case when review_title is null then review_text else review_title || '. ' || review_text end as text
      from text_reviews""",
}
