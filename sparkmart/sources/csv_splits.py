"""CSV with line breaks inside quoted values, read in splits of any size.

A line starts either a record or inside a quoted value that an earlier line opened, so all that a line does
to the parse is a map of two states: closed or open, before and after it. A first pass gives the map of each
split, composed from those of its lines. The maps of a file are composed in order on the driver, one small
row per split, and give the state in which each split starts. In the second pass every split puts its lines
together to records from its known state. A record that crosses a border leaves a part in each split it
touches; a third pass, made only if there are such records, gathers these parts and joins them by where the record began.

Quotes mean what they mean to Spark's own reader: a quote opens a value only at its start, a doubled one stays
inside, and after a closing quote anything up to the next separator or line break belongs to the value. Records end at a
line feed. Where the first line of a file ends with a carriage return and line feed, these two are one line break in
all of it; a carriage return is a character otherwise. An open quote at the end of a file ends with it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from sparkmart.session import share_package

MAPS = "file string, start long, from_closed boolean, from_open boolean, ends boolean, filled boolean, returns boolean, bytes long, size long"
PARTS = "file string, record string, origin long, part long, heads boolean"


def ends_open(line: str, opened: bool) -> bool:
    """Whether a quoted value is open at the end of a line, given whether one was at its start."""
    at, n = 0, len(line)
    while True:
        if not opened:
            if at >= n:
                return False
            if line[at] != '"':
                at = line.find(",", at) + 1
                if not at:
                    return False
                continue
            at += 1
        opened = False
        while True:
            at = line.find('"', at) + 1
            if not at:
                return True
            if at < n and line[at] == '"':
                at += 1
                continue
            break
        # The value goes on to the next separator, whatever stands behind its closing quote.
        at = line.find(",", at) + 1
        if not at:
            return False


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    text = spark.read.option("lineSep", "\n").text(list(paths))
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("_metadata.file_size").alias("size"), F.col("value").alias("line"))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, pa.Array]]:
    """(file, start, size of the file, lines) of each stretch of one split; lines of a split come in order and without others between."""
    for batch in batches:
        if not batch.num_rows:
            continue
        start = batch.column("start").to_numpy()
        file = batch.column("file").dictionary_encode().indices.to_numpy()
        cuts = [0, *(np.flatnonzero((start[1:] != start[:-1]) | (file[1:] != file[:-1])) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield batch.column("file")[a].as_py(), int(start[a]), batch.column("size")[a].as_py(), batch.column("line").slice(a, b - a)


def _quoted(lines: pa.Array) -> list[int]:
    """Places of the lines that hold a quote: all others keep the state."""
    return np.flatnonzero(pc.match_substring(lines, '"').to_numpy(zero_copy_only=False)).tolist()


def _filled(lines: pa.Array) -> np.ndarray:
    """Lines that are not empty to a reader of records."""
    return pc.greater(pc.binary_length(pc.utf8_rtrim(lines, "\r")), 0).to_numpy(zero_copy_only=False)


def split_maps(lines: DataFrame) -> DataFrame:
    """One row per split that holds lines: its end state for both start states, and whether, if it starts open, a record ends in it."""
    schema = to_arrow_schema(StructType.fromDDL(MAPS))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, closed, opened, ends, filled, returns, total = None, False, True, False, False, False, 0
        done = []
        for file, start, size, values in _runs(batches):
            if (file, start, size) != key:
                if key:
                    done.append((*key[:2], closed, opened, ends, filled, returns, total, key[2]))
                key, closed, opened, ends, filled, total = (file, start, size), False, True, False, False, 0
                returns = values[0].as_py().endswith("\r")
            for i in _quoted(values):
                line = values[i].as_py()
                if closed == opened:
                    closed = opened = ends_open(line, closed)
                else:
                    closed, opened = ends_open(line, closed), ends_open(line, opened)
                ends = ends or not opened
            filled = filled or bool(_filled(values).any())
            total += len(values) + (pc.sum(pc.binary_length(values)).as_py() or 0)
        if key:
            done.append((*key[:2], closed, opened, ends, filled, returns, total, key[2]))
        columns = list(zip(*done)) or [()] * len(schema)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return lines.mapInArrow(scan, MAPS)


class Starts:
    """How each split starts: closed, or open within a record that began in the split ``origin``."""

    def __init__(self, maps: list):
        self.state: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        self.header: dict[str, int] = {}
        self.returns: set[str] = set()
        self.closing: dict[str, int] = {}
        self.crossing = False
        files: dict[str, list] = {}
        for m in sorted(maps, key=lambda m: (m["file"], m["start"])):
            files.setdefault(m["file"], []).append(m)
        for file, splits in files.items():
            opened, origin, origins = False, -1, []
            if splits[0]["returns"]:
                self.returns.add(file)
            for m in splits:
                origins.append(origin if opened else -1)
                if not opened or m["ends"]:
                    origin = m["start"]  # what is open at the end began here
                opened = m["from_open"] if opened else m["from_closed"]
                self.crossing |= opened
            # A value that is open at the end holds the last line break, if the file ends with one.
            if opened and sum(m["bytes"] for m in splits) == splits[0]["size"]:
                self.closing[file] = splits[-1]["start"]
            self.state[file] = (np.array([m["start"] for m in splits]), np.array(origins))
            self.header[file] = next((m["start"] for m in splits if m["filled"]), -1)

    def origin(self, file: str, start: int) -> int:
        """-1 where the split starts closed. Splits other than those of the first pass are an error."""
        starts, origins = self.state.get(file, (np.empty(0, np.int64), np.empty(0, np.int64)))
        at = int(np.searchsorted(starts, start))
        if at == len(starts) or starts[at] != start:
            raise RuntimeError(f"{file} was split differently in the second pass: read it again")
        return int(origins[at])


def _records(values: list[str], opened: bool, quoted: list[int]) -> tuple[list[tuple[int, int]], bool]:
    """(first, last line) of the stretches that quotes hold together, and whether the last one is still open."""
    spans, first = [], 0 if opened else -1
    for i in quoted:
        after = ends_open(values[i], first >= 0)
        if after and first < 0:
            first = i
        elif not after and first >= 0:
            spans.append((first, i))
            first = -1
    if first >= 0:
        spans.append((first, len(values) - 1))
    return spans, first >= 0


def record_parts(lines: DataFrame, starts: Starts, crossing: bool) -> DataFrame:
    """Whole records of all splits, or, if ``crossing``, the parts of records that cross a border.

    The header record of each file is left out; of one that crosses a border the parts are marked.
    """
    schema = to_arrow_schema(StructType.fromDDL(PARTS))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, origin, heading, inside = None, [], -1, False, False

        def part() -> tuple:
            """What is held at a border of the split: of a record that began before it, or goes on behind it."""
            begun = origin if origin >= 0 else key[1]
            text = "\n".join(held)
            if inside and starts.closing.get(key[0]) == key[1]:
                text += "\n"
            if key[0] in starts.returns:
                text = text.removesuffix("\r").replace("\r\n", "\n")
            return key[0], text, begun, key[1], heading and origin < 0

        for file, start, _, column in _runs(batches):
            whole: list[str] = []
            rows: list[tuple] = []
            if (file, start) != key:
                if held:
                    rows.append(part())
                key, held = (file, start), []
                origin = starts.origin(file, start)
                inside = origin >= 0
                heading = starts.header.get(file) == start
            values = column.to_pylist()
            spans, still = _records(values, inside, _quoted(column))
            at = 0
            for first, last in [*spans, (len(values), len(values))]:
                whole.extend(values[at:first])
                if first == len(values):
                    break
                text = values[first : last + 1]
                at = last + 1
                if still and last == len(values) - 1 and (first, last) == spans[-1]:
                    held.extend(text)
                elif inside and first == 0:
                    held.extend(text)
                    inside = False
                    if origin >= 0:
                        rows.append(part())
                        origin = -1
                    else:
                        whole.append("\n".join(held))
                    held = []
                else:
                    whole.append("\n".join(text))
            inside = still
            if whole:
                if file in starts.returns:
                    whole = [w.removesuffix("\r").replace("\r\n", "\n") for w in whole]
                whole = [w for w in whole if w]
                if heading and whole:
                    whole = whole[1:]
                    heading = False
            if crossing:
                table = rows
            else:
                table = [(file, w, None, None, False) for w in whole]
            if table:
                columns = list(zip(*table))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
        if held and crossing:
            columns = list(zip(part()))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return lines.mapInArrow(build, PARTS)


def split_records(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(file, record): the records of CSV files without their headers, blank lines left out, each as one text."""
    share_package(spark)
    lines = _lines(spark, paths)
    # One row of a few bytes per split: about a millionth of the input.
    starts = Starts(split_maps(lines).collect())
    records = record_parts(lines, starts, False).select("file", "record")
    if not starts.crossing:
        return records
    parts = record_parts(lines, starts, True).groupBy("file", "origin").agg(
        F.sort_array(F.collect_list(F.struct("part", "record", "heads"))).alias("parts")
    )
    joined = parts.where(~F.exists("parts", lambda p: p["heads"])).select("file", F.array_join(F.col("parts.record"), "\n").alias("record"))
    return records.unionByName(joined.where("record <> ''"))
