"""Landed Parquet: one folder per load date, every value text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkmart.sources.paths import exists, partition_values


def read_landed(spark: SparkSession, base: str) -> DataFrame:
    """All partitions, with columns joined by name and ``load_date`` as a date."""
    return spark.read.option("mergeSchema", True).parquet(base)


def read_partitions(spark: SparkSession, base: str, dates: list[str]) -> DataFrame:
    """The named load dates only; other folders are neither listed nor read."""
    paths = [f"{base}/load_date={d}" for d in dates]
    return spark.read.option("mergeSchema", True).option("basePath", base).parquet(*paths)


def read_newest(spark: SparkSession, base: str) -> DataFrame:
    """The newest partition only, found from folder names."""
    return read_partitions(spark, base, partition_values(spark, base, "load_date")[-1:])


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stored table, or an empty typed one before its first write."""
    if exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)
