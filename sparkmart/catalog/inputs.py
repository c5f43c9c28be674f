"""How the given tables stand in for catalogue, reviews, texts and ratings.

The inputs are plain SQL that reads the same on Spark and on the checking engine,
so both sides start from equal rows. Defects (junk numbers, blank texts, unknown
products, repeated rows) come from the keys, over the whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkmart.session import configure

CATALOGUE = """
  select
    case when p_partkey % 7 = 0 then concat('  ', cast(p_partkey as string), ' ')
         else cast(p_partkey as string) end as product_id,
    concat(p_name, ' ') as product_name,
    case when p_partkey % 89 = 0 then 'n/a'
         when p_partkey % 3 = 0 then concat(replace(p_brand, 'Brand#', ''), '.0')
         else replace(p_brand, 'Brand#', '') end as brand_id,
    concat(' ', p_brand) as brand_name,
    case when p_partkey % 97 = 0 then 'free' when p_partkey % 53 = 0 then '2500.5'
         else cast(p_retailprice as string) end as price_usd,
    case when p_partkey % 4 = 0 then '' else concat(cast(p_size as string), '.25') end as sale_price_usd,
    concat(cast(p_size % 5 as string), '.5') as rating,
    cast(p_size * 3 as string) as reviews,
    case when p_partkey % 10 = 0 then '' else concat(cast(p_size as string), '.0') end as loves_count,
    case when p_partkey % 5 = 0 then '   ' else concat(p_type, ' ') end as size,
    p_type as primary_category,
    case when p_size > 25 then 'large' end as secondary_category,
    p_name as tertiary_category,
    case when p_partkey % 3 = 0 then '1' when p_partkey % 3 = 1 then '0' else 'x' end as limited_edition,
    cast(p_size % 2 as string) as new,
    concat(cast(p_size % 2 as string), '.0') as online_only,
    case when p_size = 1 then '1e0' else '' end as out_of_stock,
    case when p_partkey % 2 = 0 then ' 1 ' else '2.5' end as store_exclusive
  from {part}"""

# Two snapshots; the newer one holds some products twice, landed at different times.
RAW_PRODUCTS = f"""
  select *, date '2001-01-01' as load_date, 'daily_2001-01-01' as _batch_id,
         '2001-01-01T06:00:00+00:00' as _loaded_at from ({CATALOGUE}) a
  union all
  select *, date '2001-02-01' as load_date, 'daily_2001-02-01' as _batch_id,
         case when new = '1' then '2001-02-01T05:00:00+00:00' else '2001-02-01T06:00:00+00:00' end as _loaded_at
  from ({CATALOGUE}) b
  union all
  select product_id, 'second copy' as product_name, brand_id, brand_name, price_usd, sale_price_usd, rating, reviews,
         loves_count, size, primary_category, secondary_category, tertiary_category, limited_edition, new,
         online_only, out_of_stock, store_exclusive, date '2001-02-01' as load_date, 'daily_2001-02-01' as _batch_id,
         '2001-02-01T05:30:00+00:00' as _loaded_at
  from ({CATALOGUE}) c where limited_edition = '1'"""

SOURCE_REVIEWS = """
  select
    case when l_orderkey % 5 = 0 then concat(' ', cast(l_orderkey as string))
         else cast(l_orderkey as string) end as author_id,
    case when l_orderkey % 61 = 0 then 'P_UNKNOWN' when l_orderkey % 103 = 0 then cast(null as string)
         else cast(l_partkey as string) end as product_id,
    case when l_orderkey % 83 = 0 then 'abc'
         when l_linenumber % 2 = 0 then concat(cast(l_linenumber as string), '.0')
         else cast(l_linenumber as string) end as rating,
    case when l_linestatus = 'O' then '1.0' when l_returnflag = 'R' then '0.6' else '0.0' end as is_recommended,
    case when l_suppkey % 10 = 0 then '' else cast(l_discount as string) end as helpfulness,
    cast(l_quantity as string) as total_feedback_count,
    cast(l_linenumber as string) as total_neg_feedback_count,
    concat(cast(l_linenumber as string), '.5') as total_pos_feedback_count,
    case when l_orderkey % 71 = 0 then 'soon'
         when l_orderkey % 13 = 0 then replace(cast(cast(l_shipdate as date) as string), '-', '/')
         when l_orderkey % 13 = 1 then concat(cast(cast(l_shipdate as date) as string), ' 08:30:00')
         else cast(cast(l_shipdate as date) as string) end as submission_time,
    case when l_orderkey % 67 = 0 then cast(null as string) when l_orderkey % 59 = 0 then '   '
         else concat(' Line ', cast(l_linenumber as string), ' of order ', cast(l_orderkey as string), ' by ',
                     cast(l_suppkey as string), ': ', cast(l_quantity as string), ' ', l_returnflag) end as review_text,
    case when l_linenumber = 1 then '' else concat(' ', l_returnflag, l_linestatus, ' ') end as review_title,
    case when l_returnflag = 'A' then '' else l_returnflag end as skin_tone,
    case when l_linestatus = 'F' then ' ' else l_linestatus end as skin_type,
    l_returnflag as eye_color,
    cast(null as string) as hair_color,
    cast(l_extendedprice as string) as price_usd
  from {lineitem}"""

_DAY = "case when submission_time = 'soon' then cast(null as date) else cast(replace(left(submission_time, 10), '/', '-') as date) end"
# Three batches by day, and a fourth that repeats rows of the earlier ones.
RAW_REVIEWS = f"""
  select r.*, concat('batch_', cast(load_date as string)) as _batch_id, '2002-02-01T06:00:00+00:00' as _loaded_at
  from (
    select s.*, case when {_DAY} is null or {_DAY} <= date '2000-12-31' then date '2000-12-31'
                     when {_DAY} <= date '2001-06-30' then date '2001-06-30' else date '2001-12-31' end as load_date
    from ({SOURCE_REVIEWS}) s
    union all
    select s.*, date '2002-01-31' as load_date from ({SOURCE_REVIEWS}) s where total_feedback_count = '7.0'
  ) r"""

# The fact table as the reports read it.
FACTS = """
  select cast(l_partkey as string) as product_id, 1 + (l_linenumber - 1) % 5 as rating,
         cast(date_trunc('month', l_shipdate) as date) as load_date,
         concat('daily_', cast(cast(date_trunc('month', l_shipdate) as date) as string)) as batch_id
  from {lineitem}"""

# Documents as reviews: labels give the rating where there is one, the source is the brand.
TEXT_REVIEWS = """
  select cast(d.doc_id as string) as review_id,
         cast(coalesce(1 + 3 * l.quality + d.doc_id % 2, 1 + d.doc_id % 5) as int) as rating,
         case when d.doc_id % 3 = 0 then cast(null as string) else d.lang end as review_title,
         d.text as review_text, d.source as brand_id
  from {documents} d left join {labels} l on d.doc_id = l.doc_id"""

TABLES = ("part", "lineitem", "documents", "labels", "orders", "customer", "events")
INPUTS = {
    "catalogue": CATALOGUE,
    "raw_products": RAW_PRODUCTS,
    "source_reviews": SOURCE_REVIEWS,
    "raw_reviews": RAW_REVIEWS,
    "facts": FACTS,
    "text_reviews": TEXT_REVIEWS,
}


# Inputs whose queries do much work per row before any shuffle, and the keys that spread their
# tables over all cores where the files are too few for that.
HEAVY = {"catalogue", "source_reviews", "raw_reviews", "text_reviews"}
SPREAD = {"lineitem": ("l_orderkey", "l_linenumber"), "documents": ("doc_id",), "part": ("p_partkey",)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def heavy_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = table(spark, sf_dir, name)
    cores = spark.sparkContext.defaultParallelism
    # Files of more splits than cores are read as they lie: a fixed number of partitions would grow with them.
    return df.repartition(cores, *SPREAD[name]) if name in SPREAD and df.rdd.getNumPartitions() < cores else df


def spark_input(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input as a DataFrame."""
    text = INPUTS[name]
    read = heavy_table if name in HEAVY else table
    return spark.sql(text, **{t: read(spark, sf_dir, t) for t in TABLES if f"{{{t}}}" in text})


def oracle_inputs(*names: str) -> str:
    """The same inputs as a WITH clause for the checking engine."""
    plain = {t: t for t in TABLES}
    return "with " + ",\n".join(f"{n} as ({INPUTS[n].format(**plain)})" for n in names)
