"""What the operators share: session preparation, shared tables, Arrow schemas, grouped batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from sparkmart.session import RUNTIME_SETTINGS, configure, share_package, work_dir


def prepare(spark: SparkSession) -> SparkSession:
    """Settings the operators rely on: batches bounded in bytes, and this package on the workers' path."""
    configure(spark, RUNTIME_SETTINGS)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    share_package(spark)
    return spark


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared work folder and read back, so later steps never compute them again."""
    path = work_dir(df.sparkSession, f"llm-{label}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def arrow_schema(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def text_of(column: Column) -> Column:
    """Null counts as empty."""
    return F.coalesce(column.cast("string"), F.lit(""))


def learned(doc_id: Column, parts: int, held: int) -> Column:
    """Whether a row may be learned from: crc32 of the id as text, modulo ``parts``, is not ``held``."""
    return (F.crc32(doc_id.cast("string").cast("binary")) % parts) != held


def held_out(doc_id: Column, parts: int, held: int) -> Column:
    return F.coalesce(~learned(doc_id, parts, held), F.lit(False))


def row_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows of one key after another, from batches that are sorted by ``keys``.

    Only the rows of one group are held at a time; callers keep groups bounded.
    """
    carry: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_pylist() for k in keys]
        values = list(zip(*columns))
        start = 0
        for i, value in enumerate(values):
            if value != last:
                if i > start:
                    carry.append(batch.slice(start, i - start))
                if carry:
                    yield pa.Table.from_batches(carry)
                carry, start, last = [], i, value
        carry.append(batch.slice(start))
    if carry:
        yield pa.Table.from_batches(carry)
