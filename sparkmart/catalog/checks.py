"""Data checks, the suite, its stored failures and its log."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.catalog.casts import PRICE_CUTS, TOP_PRICE
from sparkmart.catalog.inputs import oracle_inputs, spark_input, table
from sparkmart.catalog.models import ALL_MODELS
from sparkmart.catalog.tagging import KEYWORD_TAGS
from sparkmart.functions.text import COMPLAINT_TYPES, assemble_text
from sparkmart.operators.merge import replace_partitions
from sparkmart.plans import key_checks, models, quality, tagging
from sparkmart.plans.build import build_models, store
from sparkmart.session import work_dir
from sparkmart.sources.csv import read_csv_snapshot
from sparkmart.sources.paths import exists, partition_values

BANDS = [*[label for _, label in PRICE_CUTS], TOP_PRICE]
RAW_KEY = ["author_id", "product_id", "submission_time", "review_text"]


def _raw_reviews(spark, sf_dir):
    return spark_input(spark, sf_dir, "raw_reviews")


def dq_not_null(spark, sf_dir):
    return quality.not_null(_raw_reviews(spark, sf_dir), "product_id")


def dq_unique(spark, sf_dir):
    return quality.unique(table(spark, sf_dir, "lineitem"), "l_orderkey")


def dq_accepted_values(spark, sf_dir):
    return quality.accepted_values(table(spark, sf_dir, "orders"), "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"])


def dq_relationships(spark, sf_dir):
    products = models.stg_products(spark_input(spark, sf_dir, "raw_products"))
    return quality.relationships(_raw_reviews(spark, sf_dir), "product_id", products, "product_id")


def dq_accepted_range(spark, sf_dir):
    return quality.accepted_range(_raw_reviews(spark, sf_dir), "rating", 1, 5)


def dq_not_blank(spark, sf_dir):
    return quality.not_blank(_raw_reviews(spark, sf_dir), "review_text")


def dq_unique_combination(spark, sf_dir):
    return quality.unique_combination(_raw_reviews(spark, sf_dir), RAW_KEY, by_hash=True)


def dq_batch_overlap(spark, sf_dir):
    return quality.batch_overlap(_raw_reviews(spark, sf_dir), RAW_KEY[:3])


def suite_tables(spark, sf_dir, base, keep=store):
    """All eight tables of the suite, stored under ``base`` as a pipeline would.

    Tags are keyword labels of every review in the fact table, by two labelers: one reads the text, one the title too.
    """
    raw_reviews = keep(_raw_reviews(spark, sf_dir), f"{base}/raw_reviews")
    raw_products = keep(spark_input(spark, sf_dir, "raw_products"), f"{base}/raw_products")
    tables = build_models(raw_reviews, raw_products, base, PRICE_CUTS, TOP_PRICE, keep=keep, stored=True)
    facts = tables["fct_reviews"]
    facts_text = facts.select("review_id", "rating", "review_title", F.coalesce("review_text", F.lit("")).alias("text"))
    texts = {"keyword_baseline": F.col("text"), "keyword_titled": assemble_text("review_title", "text")}
    labelled = [(who, tagging.keyword_tags(facts_text.select("review_id", "rating", text.alias("text")))) for who, text in texts.items()]
    tags = [tagging.tag_rows(rows, who, "regex-v1") for who, rows in labelled]
    tables["review_tags"] = keep(reduce(DataFrame.unionByName, tags), f"{base}/review_tags")
    mart = models.mart_brand_complaints(tables["review_tags"], facts, tables["dim_brands"])
    tables["mart_brand_complaints"] = keep(mart, f"{base}/mart_brand_complaints")
    return tables


def _suite():
    return quality.standard_suite(price_bands=BANDS, complaint_types=COMPLAINT_TYPES)


def _key_checks():
    raw = ("raw_reviews", tuple(RAW_KEY), "unique_combination"), ("raw_reviews", tuple(RAW_KEY[:3]), "batch_overlap")
    return [quality.Check(*c) for c in (*raw, ("raw_reviews", ("author_id",), "unique"))], [c for c in _suite() if c.name == "unique_fct_reviews_review_id"]


def dq_keys_incremental(spark, sf_dir):
    """Key checks of raw reviews and of the fact table, partition by partition; one lands twice, first with wrong rows."""
    base = work_dir(spark, "keys")
    raw = _raw_reviews(spark, sf_dir)
    days = [str(r[0]) for r in raw.select("load_date").distinct().orderBy("load_date").collect()]
    checks, fact_checks = _key_checks()
    for batch in ([days[1]], days[2:], days[:2]):
        rows = raw.where(F.col("load_date").cast("string").isin(batch))
        replace_partitions(rows.unionByName(rows) if batch == [days[1]] else rows, f"{base}/raw")
        found = key_checks.update_key_checks(spark, f"{base}/raw", checks, batch, f"{base}/raw_keys")
    products = store(models.stg_products(spark_input(spark, sf_dir, "raw_products")), f"{base}/products")
    landed = spark.read.schema(raw.schema).parquet(f"{base}/raw")
    replace_partitions(models.fct_reviews(models.stg_reviews(landed, stored=True), products), f"{base}/fact")
    facts = partition_values(spark, f"{base}/fact", "load_date")
    return found.unionByName(key_checks.update_key_checks(spark, f"{base}/fact", fact_checks, facts, f"{base}/fact_keys"))


def dq_suite(spark, sf_dir):
    tables = suite_tables(spark, sf_dir, work_dir(spark, "suite"))
    return quality.suite_results(tables, _suite())


def dq_observed(spark, sf_dir):
    """All row rules of the suite, counted while the tables are written."""
    observed = quality.Observed(_suite())
    suite_tables(spark, sf_dir, work_dir(spark, "suite"), observed.store)
    return observed.results(spark)


def _run(spark, sf_dir):
    base = work_dir(spark, "suite")
    tables = suite_tables(spark, sf_dir, base)
    try:
        quality.run_suite(spark, tables, _suite(), f"{base}/audit", f"{base}/log", run_id="first")
    except quality.ChecksFailed:
        pass  # the stand-in catalogue holds a brand that is not a number, on purpose
    return base


def _raw_checks():
    return [c for c in _suite() if c.table == "raw_reviews" and c.row_rule() is not None]


def dq_store_failures(spark, sf_dir):
    """Stored failing rows per check, counted from the audit tables of the whole suite."""
    base = work_dir(spark, "audit")
    tables, suite = suite_tables(spark, sf_dir, base), _suite()
    quality.store_failures(tables, suite, f"{base}/audit")
    # A check that finds nothing may leave no file.
    held = [c for c in suite if exists(spark, quality.audit_path(c, f"{base}/audit"))]
    names = spark.createDataFrame([(c.name,) for c in suite], "check string")
    rows = [quality.read_failures(spark, c, f"{base}/audit").select(F.lit(c.name).alias("check"), F.lit(1).alias("n")) for c in held]
    counts = reduce(DataFrame.unionByName, rows).groupBy("check").agg(F.count("*").alias("n"))
    return names.join(counts, "check", "left").select("check", F.coalesce("n", F.lit(0)).cast("long").alias("n_rows"))


def dq_export(spark, sf_dir):
    """Failing rows of a check, exported to CSV in full and read back."""
    base = work_dir(spark, "audit")
    check = quality.Check("lineitem", ("l_partkey",), "unique")
    quality.store_failures({"lineitem": table(spark, sf_dir, "lineitem")}, [check], f"{base}/audit")
    path = quality.export_failures(spark, check, f"{base}/audit", f"{base}/export")
    return read_csv_snapshot(spark, f"{path}/*.csv", line_breaks=False).select("l_partkey", "n_rows")


def dq_export_sample(spark, sf_dir):
    failing = quality.unique(table(spark, sf_dir, "lineitem"), "l_partkey")
    return quality.export_sample(failing, 100)


def dq_log(spark, sf_dir):
    base = _run(spark, sf_dir)
    log = quality.flagged_results(quality.read_log(spark, f"{base}/log"))
    audit = F.regexp_extract("audit_table", "/audit/(.*)$", 1)
    return log.select("run_id", "check", "status", "failures", audit.alias("audit_table"))


def dq_latest_run(spark, sf_dir):
    """Two runs are logged; the second one only checks raw rows."""
    base = _run(spark, sf_dir)
    tables = {"raw_reviews": _raw_reviews(spark, sf_dir)}
    first = quality.read_log(spark, f"{base}/log")
    second = quality.suite_results(tables, _raw_checks()).select(
        F.lit("second").alias("run_id"),
        (first.agg(F.max("run_at")).scalar() + F.expr("interval 1 day")).alias("run_at"),
        "check", "table", "severity", "status", "failures",
    )
    return quality.latest_run(first.unionByName(second, allowMissingColumns=True))


QUERIES = {
    "dq_not_null": dq_not_null,
    "dq_unique": dq_unique,
    "dq_accepted_values": dq_accepted_values,
    "dq_relationships": dq_relationships,
    "dq_accepted_range": dq_accepted_range,
    "dq_not_blank": dq_not_blank,
    "dq_unique_combination": dq_unique_combination,
    "dq_batch_overlap": dq_batch_overlap,
    "dq_keys_incremental": dq_keys_incremental,
    "dq_suite": dq_suite,
    "dq_observed": dq_observed,
    "dq_store_failures": dq_store_failures,
    "dq_export": dq_export,
    "dq_export_sample": dq_export_sample,
    "dq_log": dq_log,
    "dq_latest_run": dq_latest_run,
}

_RAW = oracle_inputs("raw_reviews")
_RANGE = "rating is not null and (try_cast(rating as double) is null or try_cast(rating as double) < 1 or try_cast(rating as double) > 5)"
_BLANK = "review_text is null or trim(review_text) = ''"


def _failures_sql(c: quality.Check) -> str:
    """The failing-row count of a check, for the checking engine."""
    col, t = c.columns[0], c.table
    if c.kind == "not_null":
        return f"select count(*) from {t} where {col} is null"
    if c.kind == "not_blank":
        return f"select count(*) from {t} where {col} is null or trim({col}) = ''"
    if c.kind == "accepted_range":
        v = f"try_cast({col} as double)"
        return (
            f"select count(*) from {t} where {col} is not null and "
            f"({v} is null or {v} < {c.args['low']} or {v} > {c.args['high']})"
        )
    if c.kind == "unique":
        return f"select count(*) from (select {col} from {t} where {col} is not null group by {col} having count(*) > 1) x"
    if c.kind == "unique_combination":
        cols = ", ".join(c.columns)
        return f"select count(*) from (select {cols} from {t} group by {cols} having count(*) > 1) x"
    if c.kind == "accepted_values":
        listed = ", ".join(repr(v) for v in c.args["values"])
        return f"select count(*) from (select distinct {col} from {t} where {col} not in ({listed})) x"
    to, parent = c.args["to"], c.args["field"]
    return (
        f"select count(*) from {t} a where a.{col} is not null "
        f"and not exists (select 1 from {to} b where b.{parent} = a.{col})"
    )


_SUITE_MODELS = f"""{ALL_MODELS},
  tag_source as (select review_id, rating, coalesce(review_text, '') as text from fct_reviews),
  {KEYWORD_TAGS.format(source='tag_source', name='labelled')},
  review_tags as (select review_id, 'keyword_baseline' as labeler, sentiment, complaint_type from labelled),
  mart_brand_complaints as (
    select f.brand_id, t.labeler, t.complaint_type, count(*) as n_reviews
    from review_tags t join fct_reviews f using (review_id) join dim_brands b on b.brand_id = f.brand_id
    group by 1, 2, 3)"""
_COUNTS = "\n  union all ".join(
    f"select '{c.name}' as check_name, '{c.table}' as table_name, '{c.severity}' as severity, "
    f"({_failures_sql(c)}) as failures"
    for c in _suite()
)
_RESULTS = f"""{_SUITE_MODELS},
  counts as ({_COUNTS}),
  results as (
    select check_name as "check", table_name as "table", severity,
      case when failures = 0 then 'pass' when severity = 'warn' then 'warn' else 'fail' end as status,
      cast(failures as bigint) as failures
    from counts)"""

# The tags of both labelers.
_ONE_LABELER = "review_tags as (select review_id, 'keyword_baseline' as labeler, sentiment, complaint_type from labelled)"
_LOG_RESULTS = _RESULTS.replace(
    _ONE_LABELER,
    f"""titled_source as (
    select review_id, rating, coalesce(review_title || '. ', '') || coalesce(review_text, '') as text from fct_reviews),
  {KEYWORD_TAGS.format(source='titled_source', name='titled')},
  review_tags as (
    select review_id, 'keyword_baseline' as labeler, sentiment, complaint_type from labelled
    union all select review_id, 'keyword_titled', sentiment, complaint_type from titled)""",
)

ORACLES = {
    "dq_not_null": f"{_RAW} select * from raw_reviews where product_id is null",
    "dq_unique": """select l_orderkey, count(*) as n_rows from lineitem where l_orderkey is not null
      group by l_orderkey having count(*) > 1""",
    "dq_accepted_values": """select o_orderpriority, count(*) as n_rows from orders
      where o_orderpriority not in ('1-URGENT', '2-HIGH', '3-MEDIUM') group by o_orderpriority""",
    "dq_relationships": f"""{oracle_inputs('raw_reviews', 'catalogue')}
      select r.* from raw_reviews r where r.product_id is not null
        and not exists (select 1 from catalogue c where trim(c.product_id) = r.product_id)""",
    "dq_accepted_range": f"{_RAW} select * from raw_reviews where {_RANGE}",
    "dq_not_blank": f"{_RAW} select * from raw_reviews where {_BLANK}",
    "dq_unique_combination": f"""{_RAW} select author_id, product_id, submission_time, review_text, count(*) as n_rows
      from raw_reviews group by all having count(*) > 1""",
    "dq_batch_overlap": f"""{_RAW} select author_id, product_id, submission_time, count(distinct _batch_id) as n_batches
      from raw_reviews group by all having count(distinct _batch_id) > 1""",
    "dq_keys_incremental": f"""{ALL_MODELS},
      failing as (
        select 'unique_combination_raw_reviews_author_id_product_id_submission_time_review_text' as "check", 'raw_reviews' as "table",
          count(*) as failures
        from (select 1 from raw_reviews group by author_id, product_id, submission_time, review_text having count(*) > 1)
        union all
        select 'batch_overlap_raw_reviews_author_id_product_id_submission_time', 'raw_reviews', count(*)
        from (select 1 from raw_reviews group by author_id, product_id, submission_time having count(distinct load_date) > 1)
        union all
        select 'unique_raw_reviews_author_id', 'raw_reviews', count(*)
        from (select 1 from raw_reviews where author_id is not null group by author_id having count(*) > 1)
        union all
        select 'unique_fct_reviews_review_id', 'fct_reviews', count(*)
        from (select 1 from fct_reviews where review_id is not null group by review_id having count(*) > 1))
      select * from failing""",
    "dq_suite": f"{_RESULTS} select * from results",
    "dq_observed": f"""{_RESULTS} select * from results
      where starts_with("check", 'not_null') or starts_with("check", 'not_blank') or starts_with("check", 'accepted_range')""",
    "dq_store_failures": f"""{_SUITE_MODELS},
  counts as ({_COUNTS})
  select check_name as "check", cast(failures as bigint) as n_rows from counts""",
    "dq_export": """select cast(l_partkey as varchar) as l_partkey, cast(count(*) as varchar) as n_rows
      from lineitem group by 1 having count(*) > 1""",
    "dq_export_sample": """select l_partkey, count(*) as n_rows from lineitem group by l_partkey having count(*) > 1
      order by l_partkey, n_rows limit 100""",
    "dq_log": f"""{_LOG_RESULTS} select 'first' as run_id, "check", status, failures,
      case when "check" like 'not\\_%' escape '\\' or "check" like 'accepted\\_range%' escape '\\'
           then "table" || '/check=' || "check" else "check" end as audit_table
      from results where failures > 0""",
    "dq_latest_run": f"""{_RAW},
      counts as (
        select 'not_null_raw_reviews_product_id' as "check", count(*) as failures from raw_reviews where product_id is null
        union all select 'not_blank_raw_reviews_review_text', count(*) from raw_reviews where {_BLANK}
        union all select 'accepted_range_raw_reviews_rating', count(*) from raw_reviews where {_RANGE})
      select "check", 'warn' as status, failures from counts where failures > 0""",
}
