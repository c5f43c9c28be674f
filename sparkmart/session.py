"""Session settings and the shared work folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import SparkSession

from sparkmart.sources.paths import delete

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot product or brand may hold a third of all rows: let the runtime split
    # its join partition even when that costs one more shuffle downstream.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The JVM never compiles a method above 8,000 bytes of code. A wide staging
    # projection fused into one larger method would run interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Spark's own value, which a session that ran table plans before has lost.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "false",
}
# What plans over wide rows need besides.
TABLE_SETTINGS = RUNTIME_SETTINGS | {
    # Splits that a task can sort in memory, however large the files are.
    "spark.sql.files.maxPartitionBytes": "32MB",
    # A task writes a few partitions side by side; otherwise it would sort, and spill, its rows for them.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    # A join with a side of which every partition measures this small needs no sort, nor spill, of the other.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "32MB",
    # Steps hand on stored tables, so the shuffle files of an action are of no use after it. Otherwise they
    # lie there until the driver happens to collect garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def configure(spark: SparkSession, settings: Mapping[str, str] = TABLE_SETTINGS) -> SparkSession:
    """Apply the settings every plan here relies on to a running session."""
    for key, value in settings.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = 8, app: str = "sparkmart", work: str | None = None) -> SparkSession:
    """A single-machine session for tests and the benchmark; ``work`` is its work folder."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", "16g")
        # Call sites are recorded per column operation, over several calls to the JVM.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in RUNTIME_SETTINGS.items():
        builder = builder.config(key, value)
    if work:
        builder = builder.config("spark.checkpoint.dir", work)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_SHIPPED: set[str] = set()


def package_archive() -> str:
    """A zip file of this package, which Spark copies from the driver to every worker."""
    folder = tempfile.mkdtemp(prefix="sparkmart-")
    return shutil.make_archive(f"{folder}/sparkmart", "zip", Path(__file__).resolve().parents[1], "sparkmart")


def share_package(spark: SparkSession) -> None:
    """Put this package on the path of Python workers: by the same folder on one machine, as an archive on a cluster."""
    if not spark.sparkContext.master.startswith("local") and spark.sparkContext.applicationId not in _SHIPPED:
        _SHIPPED.add(spark.sparkContext.applicationId)
        spark.sparkContext.addPyFile(package_archive())
    root = str(Path(__file__).resolve().parents[1])
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


_MADE: list[tuple[SparkSession, str]] = []


def work_dir(spark: SparkSession, label: str) -> str:
    """A new folder that every executor can reach; it is deleted when the application ends.

    Lives under ``spark.checkpoint.dir``. Where that is not set, a session on one machine uses its warehouse;
    on a cluster, where a local folder of the driver would not do, it is an error.
    """
    given = spark.conf.get("spark.checkpoint.dir", None)
    if not given and spark.sparkContext.master.partition("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    base = given or f"{spark.conf.get('spark.sql.warehouse.dir')}/_work"
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"
    if not _MADE:
        atexit.register(_delete_work)
    _MADE.append((spark, path))
    return path


def _delete_work() -> None:
    for spark, path in _MADE:
        try:
            delete(spark, path)
        except Exception:  # the session may have ended before: the folder is the operator's to clear
            return
