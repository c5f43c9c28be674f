"""Newest snapshot, first and last copies, delete-and-insert, and the growing fact table."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from sparkmart.catalog.inputs import oracle_inputs, spark_input, table
from sparkmart.catalog.models import ALL_MODELS, FACT_SQL
from sparkmart.operators import quantile_sketch
from sparkmart.operators.dedup import keep_first, keep_last, latest_snapshot
from sparkmart.functions.casts import leading_date
from sparkmart.operators.landing import land_partition, land_slices
from sparkmart.operators.merge import apply_delete_insert, new_partitions
from sparkmart.plans import deltas, models
from sparkmart.plans.build import store, update_models
from sparkmart.session import work_dir
from sparkmart.sources.landed import read_landed
from sparkmart.sources.paths import delete
from sparkmart.streaming.reviews import land_stream


def latest(spark, sf_dir):
    """From stored snapshots: only the newest folder is read."""
    base = work_dir(spark, "snapshots")
    raw = spark_input(spark, sf_dir, "raw_products")
    raw.write.partitionBy("load_date").parquet(base)
    return latest_snapshot(read_landed(spark, base), "load_date")


def dedup_first(spark, sf_dir):
    """One line per order and line number: the earliest shipped, by every column."""
    return keep_first(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


def dedup_last(spark, sf_dir):
    return keep_last(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


def _orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.withColumn("load_date", F.to_date(F.date_trunc("year", "o_orderdate")))


def delete_insert(spark, sf_dir):
    """A stored table of orders by year; urgent ones come again under a new date."""
    path = f"{work_dir(spark, 'merge')}/orders"
    orders = _orders(spark, sf_dir)
    apply_delete_insert(spark, path, orders, "o_orderkey")
    again = orders.where(F.col("o_orderpriority") == "1-URGENT").withColumns(
        {"o_orderstatus": F.lit("X"), "load_date": F.lit(date(2030, 1, 1))}
    )
    apply_delete_insert(spark, path, again, "o_orderkey")
    return spark.read.schema(orders.schema).parquet(path)


def partitions_after(spark, sf_dir):
    """Orders of years that a partly loaded table lacks."""
    orders = _orders(spark, sf_dir)
    return new_partitions(orders, orders.where(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")))


FIRST, REST = [date(2000, 12, 31)], [date(2001, 6, 30), date(2001, 12, 31), date(2002, 1, 31)]
STAMPS = ("load_date", "_batch_id", "_loaded_at")


class _Lake:
    """Raw batches, staged reviews and the fact table of one query."""

    def __init__(self, spark, sf_dir):
        self.spark, self.base = spark, work_dir(spark, "fact")
        self.raw = spark_input(spark, sf_dir, "raw_reviews")
        self.products = store(models.stg_products(spark_input(spark, sf_dir, "raw_products")), f"{self.base}/products")

    def land(self, dates, change=lambda rows: rows):
        for d in dates:
            rows = change(self.raw.where(F.col("load_date") == F.lit(d)).drop(*STAMPS))
            land_partition(rows, f"{self.base}/raw", d, f"batch_{d}", "2002-02-01T06:00:00+00:00")

    def build(self):
        models.extend_staged_reviews(self.spark, f"{self.base}/raw", f"{self.base}/staged")
        models.extend_fact(self.spark, f"{self.base}/staged", self.products, f"{self.base}/fact")

    def fact(self):
        return self.spark.read.parquet(f"{self.base}/fact").select(*models.FACT_COLUMNS)


def fact_incremental(spark, sf_dir):
    """Raw batches landed in two rounds, staged and loaded after each."""
    lake = _Lake(spark, sf_dir)
    for dates in (FIRST, REST):
        lake.land(dates)
        lake.build()
    return lake.fact()


def fact_after_reland(spark, sf_dir):
    """Two batches land with part of their rows and wrong titles, and again in full after a build."""
    lake = _Lake(spark, sf_dir)
    wrong = lambda rows: rows.where("eye_color = 'R'").withColumn("review_title", F.lit("wrong"))
    lake.land(FIRST + REST[:1], wrong)
    lake.land(REST[1:])
    lake.build()
    lake.land(FIRST + REST[:1])
    lake.build()
    return lake.fact()


def fact_after_late_partition(spark, sf_dir):
    """The oldest batch lands last, so its copies win over stored ones."""
    lake = _Lake(spark, sf_dir)
    for dates in (REST, FIRST):
        lake.land(dates)
        lake.build()
    return lake.fact()


def fact_after_stream(spark, sf_dir):
    """A stream lands in two runs into the same load dates, with a build after each."""
    lake = _Lake(spark, sf_dir)
    rows = lake.raw.drop("_batch_id", "_loaded_at").withColumnRenamed("load_date", "due")
    for part in ("eye_color = 'R'", "eye_color is distinct from 'R'"):
        rows.where(part).write.mode("append").parquet(f"{lake.base}/feed")
        feed = spark.readStream.schema(rows.schema).parquet(f"{lake.base}/feed")
        query = land_stream(feed, f"{lake.base}/raw", f"{lake.base}/checkpoint", F.col("due"))
        query.awaitTermination()
        lake.build()
    return lake.fact().drop("batch_id")


def fact_by_key_directory(spark, sf_dir):
    """Every order of arrival, with the key directory alone to find older copies.

    A batch lands wrong and whole, one late, one twice under two dates, one goes away and comes
    back; each build looks up its own keys and reads again only files that hold what now comes first.
    """
    lake = _Lake(spark, sf_dir)
    wrong = lambda rows: rows.where("eye_color = 'R'").withColumn("review_title", F.lit("wrong"))
    lake.land(REST[:1], wrong)
    lake.land(REST[1:])
    lake.build()
    lake.land(FIRST)
    lake.land(REST[:1])
    lake.build()
    delete(spark, f"{lake.base}/raw/load_date={FIRST[0]}")
    lake.build()
    lake.land(FIRST)
    lake.build()
    return lake.fact()


def build_any_catalogue(spark, sf_dir):
    """Land, build, land and build again, with other names for the flag column and the bands."""
    base = work_dir(spark, "build")
    reviews = spark_input(spark, sf_dir, "source_reviews")
    catalogue = spark_input(spark, sf_dir, "catalogue").withColumnRenamed("store_exclusive", "shop_exclusive")
    names = {"exclusive_flag": "shop_exclusive", "cuts": [(940, "low"), (960, "middle")], "top": "high"}
    for cutoff in (date(2000, 12, 31), None):
        land_slices(spark, reviews, catalogue, f"{base}/raw", leading_date("submission_time"), cutoff, days=4000, limit=1)
        tables = update_models(spark, f"{base}/raw", f"{base}/models", **names)
    products = tables["dim_products"].select("product_id", "is_shop_exclusive", "price_band")
    fact = tables["fct_reviews"].select("review_id", "product_id", "rating", "review_date")
    return fact.join(products, "product_id")


def dim_brands_incremental(spark, sf_dir):
    """Brands kept by signed counts over three catalogues: one short and cheap, the older, the newer."""
    base = work_dir(spark, "brands")
    raw = spark_input(spark, sf_dir, "raw_products")
    older = raw.where(F.col("load_date") == F.lit(date(2001, 1, 1)))
    short = older.where("limited_edition <> 'x'").withColumns({"price_usd": F.lit("5"), "brand_name": F.lit("AAA")})
    for i, rows in enumerate((short, older, raw)):
        staged = store(models.stg_products(rows), f"{base}/products_{i}")
        brands = deltas.update_brands(spark, staged, f"{base}/dim_brands")
    return brands


def median_sketch(spark, sf_dir):
    """Median price per line number from sketches of seven batches, one written twice; the exact rank says whether it is within its bound."""
    path = f"{work_dir(spark, 'sketch')}/prices"
    lines = table(spark, sf_dir, "lineitem")
    for year in range(7):
        batch = lines.where(F.col("l_suppkey") % 7 == year)
        for _ in range(1 + (year == 3)):
            quantile_sketch.add_batch(batch, ["l_linenumber"], "l_extendedprice", path, str(year))
    medians = quantile_sketch.read_median(spark, ["l_linenumber"], path)
    errors = quantile_sketch.rank_errors(lines, ["l_linenumber"], "l_extendedprice", medians)
    near = (F.col("error") <= quantile_sketch.RANK_ERROR).alias("within_bound")
    return medians.join(errors, "l_linenumber").select("l_linenumber", "n", near)


def _tags(reviews):
    """Labels by two labelers that follow from the rating."""
    kind = F.expr("case when rating = 1 then 'scent' when rating = 2 then 'price' else 'none' end")
    mood = F.when(F.col("rating") <= 2, F.lit("negative")).otherwise(F.lit("neutral"))
    tags = reviews.select("review_id", "rating", mood.alias("sentiment"), kind.alias("complaint_type"))
    both = tags.withColumn("labeler", F.lit("a")).unionByName(tags.where("rating <= 3").withColumn("labeler", F.lit("b")))
    return both.select("review_id", "labeler", "sentiment", "complaint_type")


def mart_incremental(spark, sf_dir):
    """Tags before and after their reviews land, a batch landed wrong, again and late, and brands that get new names."""
    lake = _Lake(spark, sf_dir)
    tags = store(_tags(models.stg_reviews(lake.raw, stored=True)), f"{lake.base}/all_tags")
    brands = store(models.dim_brands(lake.products), f"{lake.base}/brands")
    paths = f"{lake.base}/tags", f"{lake.base}/staged", f"{lake.base}/fact"

    def update(names):
        lake.build()
        return deltas.update_mart(spark, *paths, names, f"{lake.base}/mart")

    tags.where("review_id < '8'").write.mode("append").parquet(paths[0])
    lake.land(REST[:1], lambda rows: rows.where("eye_color = 'R'").withColumn("rating", F.lit("2")))
    lake.land(REST[1:])
    update(brands.withColumn("brand_name", F.lit("old")))
    lake.land(FIRST + REST[:1])
    update(brands)
    tags.where("review_id >= '8'").write.mode("append").parquet(paths[0])
    return update(brands)


QUERIES = {
    "latest_snapshot": latest,
    "dedup_keep_first": dedup_first,
    "dedup_keep_last": dedup_last,
    "delete_insert": delete_insert,
    "new_partitions": partitions_after,
    "fact_incremental": fact_incremental,
    "fact_after_reland": fact_after_reland,
    "fact_after_late_partition": fact_after_late_partition,
    "fact_after_stream": fact_after_stream,
    "fact_by_key_directory": fact_by_key_directory,
    "build_any_catalogue": build_any_catalogue,
    "dim_brands_incremental": dim_brands_incremental,
    "mart_incremental": mart_incremental,
    "median_sketch": median_sketch,
}

_TIES = "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"
_YEAR = "cast(date_trunc('year', o_orderdate) as date)"

ORACLES = {
    "latest_snapshot": f"""{oracle_inputs('raw_products')}
      select * from raw_products where load_date = (select max(load_date) from raw_products)""",
    "dedup_keep_first": f"""select distinct on (l_orderkey, l_linenumber) * from lineitem
      order by l_orderkey, l_linenumber, l_shipdate, {_TIES}""",
    "dedup_keep_last": f"""select distinct on (l_orderkey, l_linenumber) * from lineitem
      order by l_orderkey, l_linenumber, l_shipdate desc, {_TIES}""",
    "delete_insert": f"""
      select o_orderkey, o_custkey, case when o_orderpriority = '1-URGENT' then 'X' else o_orderstatus end as o_orderstatus,
        o_totalprice, o_orderdate, o_orderpriority,
        case when o_orderpriority = '1-URGENT' then date '2030-01-01' else {_YEAR} end as load_date
      from orders""",
    "new_partitions": f"""select *, {_YEAR} as load_date from orders
      where {_YEAR} > (select coalesce(max({_YEAR}), date '1900-01-01') from orders
                       where o_orderdate < timestamp '1998-01-01 00:00:00')""",
    "fact_incremental": FACT_SQL,
    "fact_after_reland": FACT_SQL,
    "fact_after_late_partition": FACT_SQL,
    "fact_by_key_directory": FACT_SQL,
    "fact_after_stream": FACT_SQL.replace("select * from fct_reviews", "select * exclude (batch_id) from fct_reviews"),
    "dim_brands_incremental": f"{ALL_MODELS} select * from dim_brands",
    "median_sketch": "select l_linenumber, count(l_extendedprice) as n, true as within_bound from lineitem group by 1",
    "mart_incremental": f"""{ALL_MODELS},
      labels as (
        select review_id, unnest(if(rating <= 3, ['a', 'b'], ['a'])) as labeler, rating <= 2 as negative,
          case rating when 1 then 'scent' when 2 then 'price' else 'none' end as complaint_type
        from stg_reviews),
      sums as (
        select brand_id, labeler, complaint_type, count(*) as n_reviews, count(*) filter (negative) as n_negative
        from labels join fct_reviews using (review_id) group by all),
      shares as (select *, cast(sum(n_reviews) over (partition by brand_id, labeler) as bigint) as n_tagged_for_brand from sums)
      select s.*, b.brand_name, cast(round(cast(n_reviews / n_tagged_for_brand as decimal(18, 12)), 4) as double) as share_of_brand_reviews
      from shares s join dim_brands b using (brand_id)""",
    "build_any_catalogue": f"""{oracle_inputs('source_reviews', 'catalogue')},
      keyed as (
        select md5(concat_ws('|', author_id, product_id, submission_time, ifnull(review_text, ''))) as review_id, *
        from source_reviews)
      select distinct k.review_id, trim(c.product_id) as product_id, try_cast(k.rating as integer) as rating,
        try_cast(left(k.submission_time, 10) as date) as review_date,
        try_cast(c.store_exclusive as integer) = 1 as is_shop_exclusive,
        case when try_cast(c.price_usd as double) < 940 then 'low' when try_cast(c.price_usd as double) < 960 then 'middle'
             when try_cast(c.price_usd as double) >= 960 then 'high' end as price_band
      from keyed k join catalogue c on trim(c.product_id) = trim(k.product_id)
      where try_cast(k.rating as integer) between 1 and 5 and try_cast(left(k.submission_time, 10) as date) is not null""",
}
