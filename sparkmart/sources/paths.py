"""Listing through the Hadoop file system, so any store Spark reads will do."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def is_file(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p) and fs.getFileStatus(p).isFile()


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def matching_files(spark: SparkSession, pattern: str) -> list[tuple[str, int]]:
    """``(path, bytes)`` of the files that match a glob, sorted by path."""
    fs, p = _fs(spark, pattern)
    found = fs.globStatus(p) or []
    return sorted((s.getPath().toString(), s.getLen()) for s in found if s.isFile())


def file_names(spark: SparkSession, folder: str) -> list[str]:
    fs, p = _fs(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def first_lines(spark: SparkSession, path: str) -> Iterator[str]:
    """The lines of a text file from its start, unpacked where the name says it is compressed."""
    fs, p = _fs(spark, path)
    jvm = spark._jvm
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration()).getCodec(p)
    stream = fs.open(p)
    try:
        raw = codec.createInputStream(stream) if codec else stream
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(raw, "UTF-8"))
        while (line := reader.readLine()) is not None:
            yield line
    finally:
        stream.close()


def path_uri(spark: SparkSession, path: str) -> str:
    return spark._jvm.org.apache.hadoop.fs.Path(path).toUri().toString()


def plain_path(spark: SparkSession, uri: str) -> str:
    """The path of a file given by URI, as listings spell it."""
    jvm = spark._jvm
    return jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri)).toString()


def file_states(spark: SparkSession, paths: list[str]) -> dict[str, tuple[int, int]]:
    """``(bytes, modification time)`` of files given by URI, by path, with one listing for each folder they are in."""
    jvm = spark._jvm
    names = {jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(p)).toString() for p in paths}
    out = {}
    for folder in sorted({n.rsplit("/", 1)[0] for n in names}):
        fs, p = _fs(spark, folder)
        for s in fs.listStatus(p):
            if (name := s.getPath().toString()) in names:
                out[name] = (s.getLen(), s.getModificationTime())
    return out


def partition_values(spark: SparkSession, base: str, column: str) -> list[str]:
    """Values of a partition column, read from folder names and not from data."""
    fs, p = _fs(spark, base)
    if not fs.exists(p):
        return []
    prefix = f"{column}="
    names = (s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())
    return sorted(n[len(prefix):] for n in names if n.startswith(prefix))
