"""Data checks that return failing rows, and the suite that runs them."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from sparkmart.functions.casts import try_double
from sparkmart.functions.text import COMPLAINT_TYPES, SENTIMENTS
from sparkmart.operators.dedup import split_marked, split_repeated
from sparkmart.operators.sampling import first_rows
from sparkmart.plans.models import PRICE_CUTS, TOP_PRICE, store
from sparkmart.sources.csv import WRITE_OPTIONS
from sparkmart.sources.landed import read_or_empty

LOG = (
    "run_id string, run_at timestamp, check string, table string, severity string, status string, failures long, "
    "audit_table string, export_path string"
)


# --- checks: failing rows -------------------------------------------------------


def is_null(column: str) -> Column:
    return F.col(column).isNull()


def is_blank(column: str) -> Column:
    """NULL, or nothing left after trimming."""
    return F.col(column).isNull() | (F.trim(column) == "")


def out_of_range(column: str, low: float | None = None, high: float | None = None, cast: str = "double") -> Column:
    """Not NULL, and not castable or outside the closed range. NaN is above every bound."""
    value = try_double(f"cast({column} as string)") if cast == "double" else F.col(column).try_cast(cast)
    bad = value.isNull()
    if low is not None:
        bad = bad | (value < low)
    if high is not None:
        bad = bad | (value > high)
    return F.col(column).isNotNull() & F.coalesce(bad, F.lit(True))


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(is_null(column))


def not_blank(df: DataFrame, column: str) -> DataFrame:
    return df.where(is_blank(column))


def accepted_range(df: DataFrame, column: str, low: float | None = None, high: float | None = None) -> DataFrame:
    return df.where(out_of_range(column, low, high))


def unique(df: DataFrame, column: str, by_hash: bool = False) -> DataFrame:
    """Values that occur more than once, with their count; NULL is ignored.

    ``by_hash`` as in ``unique_combination``.
    """
    df = df.where(F.col(column).isNotNull()).select(column)
    if by_hash:
        df = split_repeated(df, F.col(column))[1]
    counted = df.groupBy(column).agg(F.count("*").alias("n_rows"))
    return counted.where("n_rows > 1")


def accepted_values(df: DataFrame, column: str, values: Sequence[Any]) -> DataFrame:
    """Values outside the list, one row per value with its count; NULL passes."""
    return df.where(~F.col(column).isin(list(values))).groupBy(column).agg(F.count("*").alias("n_rows"))


def unique_combination(df: DataFrame, columns: Sequence[str], by_hash: bool = False) -> DataFrame:
    """Groups of more than one row; NULLs count as equal.

    ``by_hash`` is for long keys of which few are repeated: rows are first counted by an 8-byte
    hash of the key, and only rows whose hash may repeat are shuffled with, and grouped by, the key itself.
    """
    df = df.select(*columns)
    if by_hash:
        df = split_repeated(df, F.struct(*columns))[1]
    return df.groupBy(*columns).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def orphan_keys(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child keys without a parent and how many rows hold each.

    Children are counted per key before the join, so a missing key that a third of
    all rows share is one row there.
    """
    children = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n_rows"))
    parents = parent.select(F.col(parent_column).alias(column)).distinct()
    return children.join(parents, column, "left_anti")


def relationships(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Every row whose key has no parent.

    Rows are read a second time for it; only those whose key may be an orphan by a bit map of fixed size are joined.
    """
    orphans = orphan_keys(df, column, parent, parent_column)
    near = split_marked(df, F.col(column), orphans.select(F.xxhash64(column).alias("_hash")))[0]
    return near.join(orphans, column, "left_semi")


def batch_overlap(df: DataFrame, columns: Sequence[str], batch: str = "_batch_id") -> DataFrame:
    """Keys that landed in more than one batch."""
    pairs = df.select(*columns, batch).distinct()
    return pairs.groupBy(*columns).agg(F.count(batch).alias("n_batches")).where("n_batches > 1")


# --- checks as data -------------------------------------------------------------

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Check:
    """One declared check: a kind from ``KINDS`` on columns of a table."""

    table: str
    columns: tuple[str, ...]
    kind: str
    args: dict[str, Any] = field(default_factory=dict)
    severity: str = "error"

    @property
    def name(self) -> str:
        return "_".join([self.kind, self.table, *self.columns])

    def row_rule(self) -> Column | None:
        """The failing-row condition, when one row decides."""
        rule = ROW_RULES.get(self.kind)
        return rule(self.columns[0], **self.args) if rule else None

    def failing(self, tables: Tables) -> DataFrame:
        rule = self.row_rule()
        if rule is not None:
            return tables[self.table].where(rule)
        return GROUP_RULES[self.kind](tables, self)

    def count(self, tables: Tables) -> DataFrame:
        """One row: the number of failures."""
        if self.kind == "relationships":
            # Counted from keys, without going back to the rows.
            keys = orphan_keys(tables[self.table], self.columns[0], tables[self.args["to"]], self.args["field"])
            return keys.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("failures"))
        return self.failing(tables).agg(F.count("*").alias("failures"))


ROW_RULES: dict[str, Callable[..., Column]] = {
    "not_null": is_null,
    "not_blank": is_blank,
    "accepted_range": out_of_range,
}
GROUP_RULES: dict[str, Callable[[Tables, Check], DataFrame]] = {
    "unique": lambda t, c: unique(t[c.table], c.columns[0], **c.args),
    "accepted_values": lambda t, c: accepted_values(t[c.table], c.columns[0], c.args["values"]),
    "unique_combination": lambda t, c: unique_combination(t[c.table], c.columns, **c.args),
    "relationships": lambda t, c: relationships(t[c.table], c.columns[0], t[c.args["to"]], c.args["field"]),
}


def register_check(
    kind: str,
    row_rule: Callable[..., Column] | None = None,
    group_rule: Callable[[Tables, Check], DataFrame] | None = None,
) -> None:
    """Add a check kind: a condition on one row, or a plan of failing rows."""
    if (row_rule is None) == (group_rule is None):
        raise ValueError("give either row_rule or group_rule")
    if row_rule is not None:
        ROW_RULES[kind] = row_rule
    else:
        GROUP_RULES[kind] = group_rule


def _check(table: str, columns: str, kind: str, severity: str = "error", **args: Any) -> Check:
    return Check(table, tuple(columns.split()), kind, args, severity)


def standard_suite(
    price_bands: Sequence[str] = (*[label for _, label in PRICE_CUTS], TOP_PRICE),
    price_range: tuple[float, float] = (0, 2000),
    complaint_types: Sequence[str] = COMPLAINT_TYPES,
) -> list[Check]:
    """The 35 checks: 6 on raw rows (warn), 3 on tags and 26 on models (error)."""
    stars = {"low": 1, "high": 5}
    prices = {"low": price_range[0], "high": price_range[1]}
    return [
        _check("raw_reviews", "product_id", "not_null", "warn"),
        _check("raw_reviews", "product_id", "relationships", "warn", to="stg_products", field="product_id"),
        _check("raw_reviews", "review_text", "not_blank", "warn"),
        _check("raw_reviews", "rating", "accepted_range", "warn", **stars),
        _check("raw_reviews", "author_id product_id submission_time review_text", "unique_combination", "warn", by_hash=True),
        _check("raw_products", "price_usd", "accepted_range", "warn", **prices),
        _check("review_tags", "review_id labeler", "unique_combination", by_hash=True),
        _check("review_tags", "review_id", "not_null"),
        _check("review_tags", "sentiment", "accepted_values", values=SENTIMENTS),
        _check("stg_products", "product_id", "unique"),
        _check("stg_products", "product_id", "not_null"),
        _check("stg_products", "brand_id", "not_null"),
        _check("stg_products", "price_usd", "not_null"),
        _check("stg_products", "price_usd", "accepted_range", **prices),
        _check("stg_reviews", "review_id", "unique", by_hash=True),
        _check("stg_reviews", "review_id", "not_null"),
        _check("stg_reviews", "rating", "accepted_values", values=[1, 2, 3, 4, 5]),
        _check("stg_reviews", "review_date", "not_null"),
        _check("dim_brands", "brand_id", "unique"),
        _check("dim_brands", "brand_id", "not_null"),
        _check("dim_brands", "brand_name", "not_null"),
        _check("dim_products", "product_id", "unique"),
        _check("dim_products", "product_id", "not_null"),
        _check("dim_products", "brand_id", "relationships", to="dim_brands", field="brand_id"),
        _check("dim_products", "price_band", "accepted_values", values=list(price_bands)),
        _check("fct_reviews", "review_id", "unique", by_hash=True),
        _check("fct_reviews", "review_id", "not_null"),
        _check("fct_reviews", "product_id", "relationships", to="dim_products", field="product_id"),
        _check("fct_reviews", "brand_id", "relationships", to="dim_brands", field="brand_id"),
        _check("fct_reviews", "rating", "not_null"),
        _check("fct_reviews", "rating", "accepted_range", **stars),
        _check("fct_reviews", "helpfulness", "accepted_range", low=0, high=1),
        _check("fct_reviews", "review_date", "not_null"),
        _check("mart_brand_complaints", "brand_id labeler complaint_type", "unique_combination"),
        _check("mart_brand_complaints", "complaint_type", "accepted_values", values=list(complaint_types)),
    ]


# --- the suite ------------------------------------------------------------------


def _result(check: Check, failures: str) -> Column:
    count = F.col(failures).cast("long")
    failed = "warn" if check.severity == "warn" else "fail"
    return F.struct(
        F.lit(check.name).alias("check"),
        F.lit(check.table).alias("table"),
        F.lit(check.severity).alias("severity"),
        F.when(count > 0, failed).otherwise("pass").alias("status"),
        count.alias("failures"),
    )


def _result_parts(tables: Tables, checks: Sequence[Check]) -> list[DataFrame]:
    """The results of a suite in pieces that each need one pass.

    All checks on single rows of a table share one scan that reads only the checked
    columns. Each check on keys is one aggregate.
    """
    parts = []
    by_table: dict[str, list[Check]] = {}
    for check in checks:
        if check.row_rule() is not None:
            by_table.setdefault(check.table, []).append(check)
        else:
            parts.append(check.count(tables).select(F.inline(F.array(_result(check, "failures")))))
    for table, group in by_table.items():
        counts = [F.count_if(c.row_rule()).alias(f"c{i}") for i, c in enumerate(group)]
        results = F.array(*[_result(c, f"c{i}") for i, c in enumerate(group)])
        parts.append(tables[table].agg(*counts).select(F.inline(results)))
    return parts


def suite_results(tables: Tables, checks: Sequence[Check]) -> DataFrame:
    """One row per check: table, severity, status and number of failures."""
    return reduce(DataFrame.unionByName, _result_parts(tables, checks))


def collect_results(tables: Tables, checks: Sequence[Check], jobs: int = 8) -> list[Row]:
    """The same rows on the driver, with up to ``jobs`` passes running side by side.

    As separate jobs, no pass waits for another to be planned again.
    """
    with ThreadPoolExecutor(jobs) as pool:
        return [row for rows in pool.map(DataFrame.collect, _result_parts(tables, checks)) for row in rows]


class Observed:
    """Counts the failures of row rules while a table is written, without a scan of their own.

    Give ``store`` where models are written, as ``build_models`` takes it, and ask for ``results`` afterwards. Spark
    may count a task twice that it had to repeat after it had ended; the suite counts what is stored.
    """

    def __init__(self, checks: Sequence[Check]):
        self.checks = [c for c in checks if c.row_rule() is not None]
        self.seen: dict[str, Observation] = {}

    def store(self, df: DataFrame, path: str, table: str | None = None) -> DataFrame:
        """Write a table and read it back; its name is the end of its path unless given."""
        table = table or path.rstrip("/").rsplit("/", 1)[1]
        rules = [c for c in self.checks if c.table == table]
        if rules:
            self.seen[table] = Observation()
            df = df.observe(self.seen[table], *(F.count_if(c.row_rule()).alias(c.name) for c in rules))
        return store(df, path)

    def results(self, spark: SparkSession) -> DataFrame:
        """What ``suite_results`` gives for the row rules of the tables written."""
        rows = []
        for check in self.checks:
            if check.table in self.seen:
                failures = self.seen[check.table].get[check.name]
                failed = "warn" if check.severity == "warn" else "fail"
                rows.append((check.name, check.table, check.severity, failed if failures else "pass", failures))
        return spark.createDataFrame(rows, "check string, table string, severity string, status string, failures long")


def store_failures(
    tables: Tables, checks: Sequence[Check], audit: str, flagged: Sequence[str] | None = None
) -> None:
    """Write every failing row under ``audit``, in full.

    Checks on single rows of a table are written from one scan, each row once per
    check it fails, to ``audit/<table>/check=<name>``. A check on keys has its own
    columns and goes to ``audit/<name>``. ``flagged`` names the checks known to have
    failures; others are not scanned.
    """
    by_table: dict[str, list[Check]] = {}
    alone = []
    for check in checks:
        if flagged is not None and check.name not in flagged:
            continue
        if check.row_rule() is not None:
            by_table.setdefault(check.table, []).append(check)
        else:
            alone.append(check)

    def store_keys(check: Check) -> None:
        check.failing(tables).write.mode("overwrite").option("compression", "zstd").parquet(f"{audit}/{check.name}")

    def store_rows(table: str) -> None:
        names = F.array_compact(F.array(*[F.when(c.row_rule(), F.lit(c.name)) for c in by_table[table]]))
        rows = tables[table].withColumn("check", F.explode(names))
        rows.write.mode("overwrite").option("compression", "zstd").partitionBy("check").parquet(f"{audit}/{table}")

    # Separate jobs side by side: few of them fill a cluster alone.
    with ThreadPoolExecutor(8) as pool:
        for job in [*(pool.submit(store_keys, c) for c in alone), *(pool.submit(store_rows, t) for t in by_table)]:
            job.result()


def read_failures(spark: SparkSession, check: Check, audit: str) -> DataFrame:
    """The stored failing rows of one check."""
    if check.row_rule() is None:
        return spark.read.parquet(f"{audit}/{check.name}")
    return spark.read.parquet(f"{audit}/{check.table}").where(F.col("check") == check.name).drop("check")


def export_sample(df: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` failing rows for people to read, the same ones on every run."""
    return first_rows(df, rows)


def export_failures(spark: SparkSession, check: Check, audit: str, folder: str, rows: int | None = None) -> str:
    """Write failing rows as CSV files with headers: all of them, unless ``rows`` asks for a sample."""
    path = f"{folder}/{check.name}"
    failing = read_failures(spark, check, audit)
    if rows is not None:
        failing = export_sample(failing, rows)
    failing.write.mode("overwrite").options(**WRITE_OPTIONS).csv(path)
    return path


def audit_path(check: Check, audit: str) -> str:
    """Where ``store_failures`` keeps the failing rows of a check."""
    return f"{audit}/{check.name}" if check.row_rule() is None else f"{audit}/{check.table}/check={check.name}"


class ChecksFailed(Exception):
    """A check of severity error has failing rows."""


def run_suite(
    spark: SparkSession,
    tables: Tables,
    checks: Sequence[Check],
    audit: str,
    log: str,
    export: str | None = None,
    run_id: str | None = None,
    export_rows: int | None = None,
) -> DataFrame:
    """Run all checks, keep failing rows, log the run, then raise on errors.

    Each run logs every check, so a clean run replaces older warnings in the latest
    view. Failing rows and log are stored before an error is raised.
    """
    run_at = datetime.now(timezone.utc).replace(microsecond=0)
    run_id = run_id or run_at.strftime("%Y%m%dT%H%M%SZ")
    # One row per declared check comes to the driver, to decide what to write.
    results = collect_results(tables, checks)
    flagged = [r["check"] for r in results if r["failures"] > 0]
    store_failures(tables, checks, audit, flagged)
    audits = {c.name: audit_path(c, audit) for c in checks if c.name in flagged}
    exports = {}
    if export:
        for check in checks:
            if check.name in flagged:
                folder = f"{export}/{run_at:%Y-%m-%d}"
                exports[check.name] = export_failures(spark, check, audit, folder, export_rows)
    rows = [(run_id, run_at, *r, audits.get(r["check"]), exports.get(r["check"])) for r in results]
    entries = spark.createDataFrame(rows, LOG)
    entries.coalesce(1).write.mode("append").parquet(log)
    broken = [r["check"] for r in results if r["status"] == "fail"]
    if broken:
        raise ChecksFailed(f"{len(broken)} checks failed: {', '.join(sorted(broken))}")
    return entries


def read_log(spark: SparkSession, log: str) -> DataFrame:
    return read_or_empty(spark, log, LOG)


def flagged_results(log: DataFrame) -> DataFrame:
    """Logged checks that found something."""
    return log.where((F.col("status") != "pass") & (F.col("failures") > 0))


def latest_run(log: DataFrame) -> DataFrame:
    """What the latest run flagged, most failures first."""
    newest = log.where(F.col("run_at") == log.agg(F.max("run_at")).scalar())
    return (
        flagged_results(newest)
        .select("check", "status", "failures")
        .orderBy(F.col("failures").desc_nulls_last(), F.col("check").asc_nulls_last())
    )
