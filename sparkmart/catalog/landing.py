"""CSV and Parquet scans, watermark slices and landed batches."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from sparkmart.catalog.inputs import oracle_inputs, spark_input, table
from sparkmart.functions.casts import leading_date, surrogate_key
from sparkmart.operators.landing import (
    batch_log,
    land_batch,
    land_files,
    land_partition,
    land_slices,
    late_rows,
    slice_bounds,
    source_date_range,
)
from sparkmart.plans.models import REVIEW_KEY, store
from sparkmart.session import work_dir
from sparkmart.sources.csv import WRITE_OPTIONS, read_csv_by_name, read_csv_snapshot
from sparkmart.sources.landed import read_landed
from sparkmart.sources.paths import matching_files

CUTOFF = date(2000, 12, 31)
STEP = 60
# Bytes of text that go to one file of raw CSV, about.
FILE_BYTES = 64 << 20


def _day():
    return leading_date("submission_time")


def _write_csv(df, path):
    df.write.mode("overwrite").options(**WRITE_OPTIONS).csv(path)


def csv_union_by_name(spark, sf_dir):
    """Two sets of review files: other column order, and one column short."""
    base = work_dir(spark, "csv")
    reviews = spark_input(spark, sf_dir, "source_reviews")
    shipped = F.col("skin_type") == "O"
    _write_csv(reviews.where(shipped).drop("skin_tone"), f"{base}/reviews_a")
    _write_csv(reviews.where(~shipped).select(*reversed(reviews.columns)), f"{base}/reviews_b")
    landed = read_csv_by_name(spark, f"{base}/reviews*/*.csv")
    origin = F.regexp_extract("filename", r"/(reviews_\w+)/", 1)
    return landed.select(*reviews.columns, origin.alias("origin"))


def csv_snapshot_scan(spark, sf_dir):
    """Whole documents through CSV, with quotes and line breaks inside values."""
    base = work_dir(spark, "csv")
    _write_csv(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"), f"{base}/documents")
    scanned = read_csv_snapshot(spark, f"{base}/documents/*.csv")
    return scanned.select("doc_id", F.md5("text").alias("text_md5"), F.length("text").alias("chars"), "lang", "source")


def csv_line_scan(spark, sf_dir):
    """Reviews through CSV in files that are read in splits, as no value holds a line break."""
    base = work_dir(spark, "csv")
    reviews = spark_input(spark, sf_dir, "source_reviews")
    _write_csv(reviews, f"{base}/reviews")
    return read_csv_snapshot(spark, f"{base}/reviews/*.csv", line_breaks=False).select(*reviews.columns)


def csv_multiline_split(spark, sf_dir):
    """Whole documents in files of raw CSV, two at least, with line breaks, doubled and stray quotes, each read in eight splits or more."""
    base = work_dir(spark, "csv")
    docs = table(spark, sf_dir, "documents")
    # One task writes a file, so their number grows with the texts and not their size.
    files = max(2, (docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // FILE_BYTES)
    quote = F.lit('"')
    text = F.concat(quote, F.replace(F.col("text"), quote, F.lit('""')), quote)
    note = F.concat(F.when(F.col("doc_id") % 3 == 0, F.lit('5" ')).otherwise(F.lit('"a, ""b" ')), F.coalesce("lang", F.lit("")))
    record = F.concat_ws(",", F.col("doc_id").cast("string"), F.coalesce(text, F.lit("")), note)
    lines = docs.select(F.pmod(F.xxhash64("doc_id"), F.lit(files)).alias("file"), F.lit(1).alias("place"), record.alias("line"))
    heads = spark.range(files).select(F.col("id").alias("file"), F.lit(0).alias("place"), F.lit("doc_id,text,note").alias("line"))
    dealt = lines.unionByName(heads).repartition(files, "file").sortWithinPartitions("file", "place")
    dealt.select("file", "line").write.partitionBy("file").text(f"{base}/raw")
    size = sum(n for _, n in matching_files(spark, f"{base}/raw/*/*.txt"))
    name = "spark.sql.files.maxPartitionBytes"
    usual = spark.conf.get(name)
    spark.conf.set(name, str(max(1024, size // (12 * files))))
    try:
        scanned = read_csv_snapshot(spark, f"{base}/raw/*/*.txt")
        scanned = store(scanned.select("doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"), "note"), f"{base}/read")
    finally:
        spark.conf.set(name, usual)
    return scanned


def partitioned_scan(spark, sf_dir):
    """Landed partitions with a column that only later ones have."""
    base = work_dir(spark, "landed")
    raw = spark_input(spark, sf_dir, "raw_products")
    older = raw.where(F.col("load_date") == F.lit(date(2001, 1, 1)))
    newer = raw.where(F.col("load_date") == F.lit(date(2001, 2, 1)))
    land_partition(
        older.drop("load_date", "_batch_id", "_loaded_at", "store_exclusive"), base, date(2001, 1, 1), "daily_2001-01-01"
    )
    land_partition(newer.drop("load_date", "_batch_id", "_loaded_at"), base, date(2001, 2, 1), "daily_2001-02-01")
    return read_landed(spark, base).drop("_loaded_at")


def source_range(spark, sf_dir):
    return source_date_range(spark_input(spark, sf_dir, "source_reviews"), _day())


def batch_window(spark, sf_dir):
    """For every source day as the watermark: the slice that would follow."""
    reviews = spark_input(spark, sf_dir, "source_reviews").select(_day().alias("day"))
    counted = reviews.where("day is not null").groupBy("day").agg(F.count("*").alias("n"))
    newest = counted.agg(F.max("day")).scalar()
    return counted.withColumn("max_day", newest).select("n", F.inline(F.array(slice_bounds(F.col("day"), F.col("max_day"), 7))))


def _sources(spark, sf_dir):
    return spark_input(spark, sf_dir, "source_reviews"), spark_input(spark, sf_dir, "catalogue")


def land_backfill(spark, sf_dir):
    base = work_dir(spark, "raw")
    reviews, products = _sources(spark, sf_dir)
    land_batch(spark, reviews, products, base, _day(), backfill_until=CUTOFF)
    return read_landed(spark, f"{base}/reviews").drop("_loaded_at")


def _land_three(spark, sf_dir):
    base = work_dir(spark, "raw")
    reviews, products = _sources(spark, sf_dir)
    land_slices(spark, reviews, products, base, _day(), backfill_until=CUTOFF, days=STEP, limit=3)
    return base


def land_incremental(spark, sf_dir):
    return read_landed(spark, f"{_land_three(spark, sf_dir)}/reviews").drop("_loaded_at")


def land_zone_map(spark, sf_dir):
    """CSV files by year, landed in two calls: one opens all for their days, the other those of its slices only."""
    base = work_dir(spark, "zones")
    reviews, products = _sources(spark, sf_dir)
    by_year = reviews.withColumn("part", F.coalesce(F.year(_day()), F.lit(0)))
    by_year.write.options(**WRITE_OPTIONS).partitionBy("part").csv(f"{base}/csv")
    read = lambda files: read_csv_by_name(spark, files, line_breaks=False)
    for limit in (1, 2):
        land_files(spark, f"{base}/csv/*/*.csv", products, f"{base}/raw", _day(), read, CUTOFF, STEP, limit=limit)
    return read_landed(spark, f"{base}/raw/reviews").drop("_loaded_at")


def batch_days(spark, sf_dir):
    """Distinct days each batch holds."""
    landed = read_landed(spark, f"{_land_three(spark, sf_dir)}/reviews")
    return landed.select("_batch_id", _day().alias("day")).distinct()


def land_idempotent(spark, sf_dir):
    """A batch landed twice, the first time with every row doubled."""
    base = work_dir(spark, "raw")
    reviews, _ = _sources(spark, sf_dir)
    land_partition(reviews.unionByName(reviews), base, CUTOFF, "backfill_2000-12-31")
    land_partition(reviews, base, CUTOFF, "backfill_2000-12-31")
    return read_landed(spark, base).drop("_loaded_at")


def land_exhausted(spark, sf_dir):
    """The log after a full backfill and one more run, which finds nothing to do."""
    base = work_dir(spark, "raw")
    reviews, products = _sources(spark, sf_dir)
    newest = source_date_range(reviews, _day()).first()["max_date"]
    land_batch(spark, reviews, products, base, _day(), backfill_until=newest)
    land_batch(spark, reviews, products, base, _day(), days=STEP)
    return batch_log(spark, base).drop("loaded_at")


def late(spark, sf_dir):
    """Rows of the source that a landed table missed."""
    keyed = spark_input(spark, sf_dir, "source_reviews").withColumn("review_id", surrogate_key(*REVIEW_KEY))
    landed = keyed.where(F.col("eye_color") != "R")
    return late_rows(keyed, _day(), CUTOFF, landed, "review_id").select("review_id", "author_id", _day().alias("day"))


QUERIES = {
    "csv_union_by_name": csv_union_by_name,
    "csv_snapshot_scan": csv_snapshot_scan,
    "csv_line_scan": csv_line_scan,
    "csv_multiline_split": csv_multiline_split,
    "partitioned_scan": partitioned_scan,
    "source_date_range": source_range,
    "batch_window": batch_window,
    "land_backfill": land_backfill,
    "land_incremental": land_incremental,
    "land_zone_map": land_zone_map,
    "batch_days": batch_days,
    "land_idempotent": land_idempotent,
    "land_exhausted": land_exhausted,
    "late_rows": late,
}

_REVIEWS = oracle_inputs("source_reviews")
_DAY = "try_cast(left(submission_time, 10) as date)"
_LANDED = f"""{_REVIEWS},
  batches as (
    select *, {_DAY} as day from source_reviews),
  landed as (
    select *, case when day is null or day <= date '2000-12-31' then date '2000-12-31'
                   when day <= date '2001-03-01' then date '2001-03-01'
                   when day <= date '2001-04-30' then date '2001-04-30' end as load_date
    from batches)"""
_BATCH_ID = "case when load_date = date '2000-12-31' then 'backfill_' else 'daily_' end || cast(load_date as varchar)"
_DOCUMENTS = """select cast(doc_id as varchar) as doc_id, md5(text) as text_md5, cast(length(text) as integer) as chars,
  lang, source from documents"""

# An empty value in a file is no value.
_BLANKS = "nullif(columns(*), '')"

ORACLES = {
    "csv_union_by_name": f"""{_REVIEWS}
      select * exclude (skin_tone), case when skin_type <> 'O' then skin_tone end as skin_tone,
        case when skin_type = 'O' then 'reviews_a' else 'reviews_b' end as origin
      from (select {_BLANKS} from source_reviews)""",
    "csv_snapshot_scan": _DOCUMENTS,
    # What stands behind a closing quote belongs to the value, with the quotes as they are.
    "csv_multiline_split": """
      select cast(doc_id as varchar) as doc_id, md5(coalesce(text, '')) as text_md5,
        case when doc_id % 3 = 0 then '5" ' else '"a, "b" ' end || coalesce(lang, '') as note
      from documents""",
    "csv_line_scan": f"{_REVIEWS} select {_BLANKS} from source_reviews",
    "partitioned_scan": f"""{oracle_inputs('raw_products')}
      select * exclude (_loaded_at, store_exclusive),
        case when load_date = date '2001-02-01' then store_exclusive end as store_exclusive
      from raw_products""",
    "source_date_range": f"""{_REVIEWS}
      select min({_DAY}) as min_date, max({_DAY}) as max_date from source_reviews""",
    "batch_window": f"""{_REVIEWS},
      counted as (select {_DAY} as low, count(*) as n from source_reviews where {_DAY} is not null group by 1),
      newest as (select max(low) as max_day from counted)
      select n, low, cast(least(low + 7, max_day) as date) as high, cast(max_day - 30 as date) as cutoff,
        low >= max_day as exhausted
      from counted, newest""",
    "land_backfill": f"""{_REVIEWS}
      select *, date '2000-12-31' as load_date, 'backfill_2000-12-31' as _batch_id
      from source_reviews where {_DAY} <= date '2000-12-31' or {_DAY} is null""",
    "land_incremental": f"""{_LANDED}
      select * exclude (day), {_BATCH_ID} as _batch_id from landed where load_date is not null""",
    "land_zone_map": f"""{_LANDED.replace('from source_reviews)', "from (select nullif(columns(*), '') from source_reviews))")}
      select * exclude (day), {_BATCH_ID} as _batch_id from landed where load_date is not null""",
    "batch_days": f"""{_LANDED}
      select distinct {_BATCH_ID} as _batch_id, day from landed where load_date is not null""",
    "land_idempotent": f"""{_REVIEWS}
      select *, date '2000-12-31' as load_date, 'backfill_2000-12-31' as _batch_id from source_reviews""",
    "land_exhausted": f"""{_REVIEWS},
      span as (select min({_DAY}) as min_date, max({_DAY}) as max_date, count(*) as reviews from source_reviews)
      select 'backfill_' || cast(max_date as varchar) as batch_id, max_date as load_date, reviews,
        (select count(*) from part) as products, 'dir' as source, min_date, max_date
      from span""",
    "late_rows": f"""{_REVIEWS},
      keyed as (select *, {_DAY} as day,
        md5(concat_ws('|', author_id, product_id, submission_time, coalesce(review_text, ''))) as review_id
        from source_reviews)
      select review_id, author_id, day from keyed k
      where day <= date '2000-12-31'
        and not exists (select 1 from keyed o where o.review_id = k.review_id and o.eye_color <> 'R')""",
}
