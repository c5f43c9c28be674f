"""CSV files as all-text tables, joined by column name."""

from __future__ import annotations

import csv
from collections import Counter
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.sources.csv_splits import split_records
from sparkmart.sources.paths import first_lines, matching_files

# A quote inside a value is doubled.
CSV_OPTIONS = {"escape": '"'}
# The writer would strip blanks around values.
WRITE_OPTIONS = {
    "header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}
# Lines are read as one column. The separator only has to be no part of any line; a line that holds it raises.
NO_SEPARATOR = "\u0001\u0002\u0001"
END_MARK = "\u0003end\u0003"


def list_files(spark: SparkSession, pattern: str | Sequence[str]) -> list[tuple[str, int]]:
    """``(path, bytes)`` of files that match a pattern, or one of several; an empty match is an error."""
    patterns = [pattern] if isinstance(pattern, str) else list(pattern)
    files = sorted({f for p in patterns for f in matching_files(spark, p)})
    if not files:
        raise ValueError(f"no file matches {pattern}")
    return files


def column_names(header: str) -> list[str]:
    """Names in a header record. An unnamed column i is ``column<i>``; a name that occurs twice gets its place."""
    names = next(csv.reader([header], doublequote=True), [])
    count = Counter(n.lower() for n in names)
    return [f"column{i}" if not n else f"{n}{i}" if count[n.lower()] > 1 else n for i, n in enumerate(names)]


def _header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """Read by the driver from the start of the file: no Spark job, however many files there are."""
    record = ""
    for line in first_lines(spark, path):
        if not record and not line.strip():
            continue
        record = f"{record}\n{line}" if record else line.lstrip("﻿")
        if record.count('"') % 2 == 0:
            break
    return tuple(column_names(record))


def _schema(header: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in header])


def read_csv_by_name(spark: SparkSession, pattern: str | Sequence[str], filename: bool = True, line_breaks: bool = True, one_task: bool = False) -> DataFrame:
    """All files that match ``pattern`` as text columns, aligned by column name.

    A column missing from a file is NULL there. ``filename`` adds the file path.
    Files with the same header share one scan, so columns never shift between
    files that order them differently.

    ``line_breaks`` says whether values may hold line breaks. If so, the state in which
    each split starts is found in a pass of its own; ``one_task`` reads a file in one task
    instead, whatever its size. If not, one pass will do, and a value whose quote is not
    closed on its line raises an error. All give the same rows, but that Spark's own reader,
    which ``one_task`` uses, reads files of mixed line ends in its own way.
    """
    files = list_files(spark, pattern)
    with ThreadPoolExecutor(16) as pool:
        headers = list(pool.map(lambda f: _header(spark, f[0]), files))
    groups: dict[tuple[str, ...], list[str]] = {}
    for (path, _), header in zip(files, headers):
        groups.setdefault(header, []).append(path)
    read = _read_records if one_task else _read_splits if line_breaks else _read_lines
    parts = []
    for header, paths in groups.items():
        part = read(spark, paths, header)
        parts.append(part if filename else part.drop("filename"))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_csv_snapshot(spark: SparkSession, path: str, line_breaks: bool = True, one_task: bool = False) -> DataFrame:
    """One CSV source as text columns."""
    return read_csv_by_name(spark, path, filename=False, line_breaks=line_breaks, one_task=one_task)


def _read_records(spark: SparkSession, paths: list[str], header: Sequence[str]) -> DataFrame:
    rows = spark.read.schema(_schema(header)).options(header=True, multiLine=True, **CSV_OPTIONS).csv(paths)
    return rows.select(*[F.col(f"`{c}`") for c in header], F.col("_metadata.file_path").alias("filename"))


def _parsed(record: Column, header: Sequence[str]) -> Column:
    """Values of a record with a mark as one more; an open quote swallows the mark.

    An array of one: as no filter on values moves below a generated column, each record is parsed once.
    """
    columns = ", ".join("`{}` string".format(c.replace("`", "``")) for c in [*header, "_end"])
    row = F.from_csv(F.concat(record, F.lit(f",{END_MARK}")), columns, CSV_OPTIONS | {"lineSep": "\n", "multiLine": "true"})
    return F.explode(F.array(row))


def _read_splits(spark: SparkSession, paths: list[str], header: Sequence[str]) -> DataFrame:
    """Each record is parsed on its own. Only the last one of a file may end within a quote; a quote alone is its own value."""
    rows = split_records(spark, paths).select(_parsed(F.col("record"), header).alias("row"), F.col("file").alias("filename"))
    tail = f",{END_MARK}"
    cells = []
    for name in header:
        value = F.col("row").getField(name)
        cut = F.substring(value, F.lit(1), F.length(value) - len(tail))
        whole = F.when(value == tail, F.lit('"')).when(value.endswith(tail), cut).otherwise(value)
        cells.append(F.when(value != END_MARK, whole).alias(name))
    return rows.select(*cells, "filename")


def _read_lines(spark: SparkSession, paths: list[str], header: Sequence[str]) -> DataFrame:
    """A line whose values hold the mark has an open quote."""
    lines = spark.read.schema("line string, rest string").options(header=True, sep=NO_SEPARATOR, quote="").csv(paths)
    lines = lines.select("line", "rest", F.col("_metadata.file_path").alias("filename"))
    rows = lines.withColumn("row", _parsed(F.col("line"), header))
    values = [F.col("row").getField(c) for c in header]
    swallowed = [F.coalesce(F.endswith(v, F.lit(f",{END_MARK}")), F.lit(False)) for v in values]
    bad = reduce(lambda a, b: a | b, swallowed, F.col("rest").isNotNull())
    message = F.concat(F.lit("a value is not closed on its line, in "), F.col("filename"))
    rows = rows.where(F.when(bad, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
    # A line with fewer values than the header has the mark among them.
    cells = [F.when(v != END_MARK, v).alias(c) for v, c in zip(values, header)]
    return rows.select(*cells, "filename")
