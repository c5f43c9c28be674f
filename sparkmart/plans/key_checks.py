"""Key checks of a partitioned table that look at what changed, not at all history again.

All key checks of a table are exploded from one scan of the changed partitions and counted in one shuffle, by the 8-byte
fingerprint of check and key and by the partition. The counts are kept as signed entries in a ledger, a replaced partition
taking its own back, so a run adds its partitions and reads the buckets of its own fingerprints, once. A fingerprint that
occurs twice or more is a suspect: its rows are read from the partitions that hold it, and full keys decide, so
fingerprints that collide fail nothing. How many keys fail under each fingerprint is a stored state of its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DateType, IntegralType, StringType

from sparkmart.operators.group_state import GroupState
from sparkmart.operators.key_directory import KeyDirectory
from sparkmart.plans.models import store
from sparkmart.plans.quality import Check
from sparkmart.sources.landed import read_or_empty
from sparkmart.sources.paths import partition_values

LEDGER = "key long, batch string, n long, arrived int"
RUNS = "run int, batch string"
EXPLODED = "batch string, check int, full string, key long"
#: What makes a key fail, from its rows and the partitions that hold it.
FAILS = {"unique": "n > 1", "unique_combination": "n > 1", "batch_overlap": "batches > 1"}


def _part(column: str, kind: DataType) -> Column:
    """One value of a key as text that tells where it ends, so that values put behind each other never run together."""
    plain = isinstance(kind, (StringType, IntegralType, BooleanType, DateType))
    text = F.col(column).cast("string") if plain else F.to_json(F.struct(column))
    return F.when(F.col(column).isNull(), "-").otherwise(F.concat(F.length(text), F.lit(":"), text))


def _full_key(check: Check, rows: DataFrame) -> Column:
    """The key as one value; NULL where the check ignores the row."""
    key = F.concat(*(_part(c, rows.schema[c].dataType) for c in check.columns))
    return F.when(F.col(check.columns[0]).isNotNull(), key) if check.kind == "unique" else key


def _exploded(rows: DataFrame, checks: Sequence[Check], batch: str, fingerprint: Column) -> DataFrame:
    """(key, batch, check, full): each row once per check; ``key`` is the fingerprint, mixed with the check's place."""
    each = F.array(*(F.struct(F.lit(i).alias("check"), _full_key(c, rows).alias("full")) for i, c in enumerate(checks)))
    rows = rows.select(F.col(batch).cast("string").alias("batch"), F.inline(each)).where("full is not null")
    return rows.withColumn("key", F.xxhash64("check", fingerprint))


def update_key_checks(
    spark: SparkSession,
    table: str,
    checks: Sequence[Check],
    changed: Sequence[str],
    base: str,
    batch: str = "load_date",
    fingerprint: Column | None = None,
) -> DataFrame:
    """(check, table, failures) of key checks on the Parquet table at ``table``, partitioned by ``batch``.

    ``changed`` names the partitions that are new, replaced or gone since the last run. The state lies under ``base``;
    its log is written last, so a run that died is repeated. ``fingerprint`` is a function of the column ``full``.
    """
    code = F.xxhash64("full") if fingerprint is None else fingerprint
    log = read_or_empty(spark, f"{base}/runs", RUNS)
    done = log.agg(F.max("run")).first()[0] or 0
    ledger = KeyDirectory(spark, f"{base}/ledger", entry=LEDGER)
    failing = GroupState(spark, f"{base}/failing", "check int, key long", ["failing"], "key")
    run = done + 1
    if changed:
        names = [str(c) for c in changed]
        whole = spark.read.parquet(table) if partition_values(spark, table, batch) else None

        def rows(batches: Sequence[str]) -> DataFrame:
            if whole is None:  # the last partition is gone, and the columns with it
                return spark.createDataFrame([], EXPLODED)
            return _exploded(whole.where(F.col(batch).cast("string").isin(list(batches))), checks, batch, code)

        fresh = rows(names).groupBy("key", "batch").agg(F.count("*").alias("n"))
        # What the replaced partitions hold now stands in the entries of the runs that took them in.
        earlier = [r[0] for r in log.where(F.col("batch").isin(names)).select("run").distinct().collect()]
        held = ledger.arrivals(sorted(earlier)).where(F.col("batch").isin(names)).select("key", "batch", (-F.col("n")).alias("n"))
        delta = fresh.unionByName(held).groupBy("key", "batch").agg(F.sum("n").alias("n"))
        ledger.add(delta.where("n <> 0").withColumn("arrived", F.lit(run)), run)
        # Entries beside the run's own and the keys that fail so far meet in one shuffle: no join tells which are touched.
        entries = ledger.beside(run).where(F.col("arrived") <= run)
        entries = entries.select("key", "batch", "n", (F.col("arrived") == run).alias("mine"), F.lit(False).alias("failed"))
        failed = failing.read(done).select("key", F.lit(None).cast("string").alias("batch"), F.lit(0).cast("long").alias("n"), F.lit(False).alias("mine"), F.lit(True).alias("failed"))
        held = entries.unionByName(failed).repartition("key").groupBy("key", "batch")
        held = held.agg(F.sum("n").alias("n"), F.max("mine").alias("mine"), F.max("failed").alias("failed"))
        of_key = Window.partitionBy("key")
        whole_key = {"total": F.sum("n").over(of_key), "mine": F.max("mine").over(of_key), "failed": F.max("failed").over(of_key)}
        touched = held.withColumns(whole_key).where("mine and (total > 1 or failed) and (n <> 0 or batch is null)")
        touched = store(touched.select("key", "batch", (F.col("total") > 1).alias("suspect")), f"{base}/run/touched")
        suspects = touched.where("suspect")
        batches = [r[0] for r in suspects.where("batch is not null").select("batch").distinct().collect()]
        suspects = suspects.select("key")
        copies = rows(batches).join(suspects, "key", "left_semi")
        # Copies are counted per partition first, so a key that a third of all rows share is one row there.
        copies = copies.groupBy("check", "key", "full", "batch").agg(F.count("*").alias("n"))
        copies = copies.groupBy("check", "key", "full").agg(F.sum("n").alias("n"), F.count("*").alias("batches"))
        rules = F.expr("case check " + " ".join(f"when {i} then {FAILS[c.kind]}" for i, c in enumerate(checks)) + " end")
        now = copies.where(rules).groupBy("check", "key").agg(F.count("*").alias("failing"))
        before = failing.read(done).join(touched.select("key"), "key", "left_semi").withColumn("failing", -F.col("failing"))
        settled = now.unionByName(before).groupBy("check", "key").agg(F.sum("failing").alias("failing"))
        failing.merge(store(settled.where("failing <> 0"), f"{base}/run/settled"), run)
        spark.createDataFrame([(run, n) for n in names], RUNS).coalesce(1).write.mode("append").parquet(f"{base}/runs")
        done = run
    found = failing.read(done).groupBy("check").agg(F.sum("failing").alias("failures"))
    declared = spark.createDataFrame([(i, c.name, c.table) for i, c in enumerate(checks)], "no int, check string, table string")
    counted = declared.join(found.withColumnRenamed("check", "no"), "no", "left")
    return counted.select("check", "table", F.coalesce("failures", F.lit(0)).cast("long").alias("failures"))
