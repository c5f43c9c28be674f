"""Stateful streams: each row told first, repeated or late, and daily counts that are corrected as rows come."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState as StreamState
from pyspark.sql.streaming.state import GroupStateTimeout
from pyspark.sql.types import AtomicType, BinaryType

from sparkmart.operators.group_state import GroupState
from sparkmart.sources.landed import read_or_empty

FIRST, REPEATED, LATE = "first", "repeated", "late"
#: States at least: fewer shards than these are dealt to parts, each with a state of its own.
SHARDS = 256
#: Rows that a worker hands back at a time.
ROWS = 10_000
#: Keys, none of which holds a line break, as one text, and their times as 8-byte numbers: no value is handled alone.
STATE = "keys string, times binary"


def classify_stream(df: DataFrame, keys: Sequence[str], time: str, delay: str, keep_days: float, shards: int = SHARDS) -> DataFrame:
    """All rows of a stream with a ``status``: nothing is dropped, and each row has one status.

    A row is late if its time lies before the watermark, ``delay`` behind the newest time of earlier batches. Of the others
    the first of its key, by time and then by all columns, is first, and all more are repeated, for as long as
    the key is kept: ``keep_days`` past its newest row, by the watermark. Keys are dealt to shards, and these to parts
    that a task holds one at a time, ``SHARDS`` in all at least; a part's state drops what is past that limit whenever it
    is visited, so state is bounded by the keys of that span. A NULL time is never late and never told; such rows are first
    or repeated by their key alone, kept like time 0, which a visit drops after its rows are told.
    """
    names = df.columns
    keep = int(keep_days * 86_400_000)
    key = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})
    # Values pass the workers as text: numbers and times keep all their digits whatever else a column holds.
    texts = {f.name: F.col(f.name).cast("string") for f in df.schema if isinstance(f.dataType, AtomicType) and f.dataType != BinaryType()}
    schema = df.select(*(texts.get(n, F.col(n)).alias(n) for n in names), F.lit("").alias("status")).schema
    millis = F.coalesce(F.unix_millis(time), F.lit(-1)).alias("_millis")
    shard = F.pmod(F.xxhash64(key), F.lit(shards * -(-SHARDS // shards))).alias("_shard")
    # The watermark is named before the shuffle; rows behind it still reach the operator, as it has no event timeout.
    carried = [texts.get(n, F.col(n)).alias(n) for n in names]
    keyed = df.withWatermark(time, delay).select(F.col(time).alias("_time"), *carried, key.alias("_key"), millis, shard)

    def tell(_: tuple, parts: Iterator[pd.DataFrame], state: StreamState) -> Iterator[pd.DataFrame]:
        watermark = state.getCurrentWatermarkMs()
        held, times = _held(state)
        # Other keys' rows may not have come to this part since.
        in_time = (times == 0) | (times >= watermark - keep)
        held, times = held[in_time], times[in_time]
        rows = pd.concat(list(parts), ignore_index=True)
        millis = rows["_millis"].to_numpy("int64")
        late = (millis >= 0) & (millis < watermark)
        status = np.where(late, LATE, REPEATED).astype(object)
        on_time = np.flatnonzero(~late)
        codes, found = pd.factorize(rows["_key"].iloc[on_time])
        place = pd.Index(held).get_indexer(found)
        newest = np.zeros(len(found), "int64")
        newest[place >= 0] = times[place[place >= 0]]
        np.maximum.at(newest, codes, millis[on_time])
        new = place[codes] < 0
        status[_first_rows(rows, names, on_time[new], codes[new], millis)] = FIRST
        untouched = np.ones(len(held), bool)
        untouched[place[place >= 0]] = False
        held, times = np.concatenate([held[untouched], found]), np.concatenate([times[untouched], newest])
        kept = times >= watermark - keep
        state.update(("\n".join(held[kept]), times[kept].tobytes()))
        rows = rows[names].assign(status=status)
        for at in range(0, len(rows), ROWS):
            yield rows.iloc[at : at + ROWS]

    told = keyed.groupBy("_shard").applyInPandasWithState(tell, schema, STATE, "append", GroupStateTimeout.NoTimeout)
    # The operator gives rows of Arrow batches; a computed column turns them into rows that every sink takes.
    back = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name in texts else F.col(f.name) for f in df.schema]
    return told.select(*back, F.concat("status", F.lit("")).alias("status"))


def _held(state: StreamState) -> tuple[np.ndarray, np.ndarray]:
    """The keys of a shard and their newest times."""
    text, times = state.get if state.exists else ("", b"")
    keys = np.array(text.split("\n") if times else [], dtype=object)
    return keys, np.frombuffer(bytes(times), "int64")


def _first_rows(rows: pd.DataFrame, names: list[str], at: np.ndarray, codes: np.ndarray, millis: np.ndarray) -> np.ndarray:
    """Positions, among those at ``at``, of the first row of each code: by time, then by all columns as text."""
    earliest = np.full(codes.max(initial=-1) + 1, np.iinfo("int64").max)
    np.minimum.at(earliest, codes, millis[at])
    may = millis[at] == earliest[codes]
    at, codes = at[may], codes[may]
    tied = np.bincount(codes)[codes] > 1 if len(codes) else np.zeros(0, bool)
    # Equal rows are all as good; only codes with different rows at their first time need an order.
    text = rows[names].iloc[at[tied]].astype("string").assign(_code=codes[tied], _at=at[tied])
    text = text.drop_duplicates(["_code", *names])
    differ = text["_code"].duplicated(keep=False)
    ordered = text[differ].sort_values(names, kind="stable").drop_duplicates("_code")
    return np.concatenate([at[~tied], text.loc[~differ, "_at"].to_numpy("int64"), ordered["_at"].to_numpy("int64")])


# --- counts ------------------------------------------------------------------------


class DailyCounts:
    """Rows per day at ``base``, open days included; late rows correct the day they belong to.

    Each batch is merged as the generation of its number, from what the batches before it left: a batch that
    comes again, as streams repeat one after a failure, changes nothing.
    """

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base
        self.state = GroupState(spark, f"{base}/state", "day date", ["n"], "day")

    def upsert(self, rows: DataFrame, batch: int, time: str) -> None:
        counts = rows.groupBy(F.col(time).cast("date").alias("day")).agg(F.count("*").alias("n"))
        path = f"{self.base}/batch"
        counts.write.mode("overwrite").parquet(path)
        self.state.merge(self.spark.read.schema(counts.schema).parquet(path), batch + 1)
        self.spark.createDataFrame([(batch + 1,)], "run int").coalesce(1).write.mode("append").parquet(f"{self.base}/applied")

    def read(self) -> DataFrame:
        done = read_or_empty(self.spark, f"{self.base}/applied", "run int").agg(F.max("run")).first()[0] or 0
        return self.state.read(done)


def count_stream(df: DataFrame, base: str, checkpoint: str, time: str) -> StreamingQuery:
    """Bring the daily counts at ``base`` up to a stream and stop."""

    def merge(rows: DataFrame, batch: int) -> None:
        DailyCounts(rows.sparkSession, base).upsert(rows, batch, time)

    return df.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
