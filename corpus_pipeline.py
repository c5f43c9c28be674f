"""A corpus pipeline over ``documents``: drop toxic texts, copies and near copies, mix, pack.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns rows with the
columns of ``documents``; the last returns the packed pieces. Between stages the rows are written as
Parquet to the shared work folder and read again.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.llm.common import stored, text_of
from sparkmart.llm.exact_dedup import exact_duplicates
from sparkmart.llm.mixing import mix_documents
from sparkmart.llm.near_dedup import NearDedup, near_duplicates
from sparkmart.llm.packing import pack_documents
from sparkmart.llm.queries import MIXTURE, mixture_columns, tokenizer_path
from sparkmart.llm.toxicity import keep_ordinary


def digest() -> Column:
    """What ``exact_duplicates`` calls text_sha256."""
    return F.sha2(text_of(F.col("text")).cast("binary"), 256)


def _same(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    """Equal in all keys; nulls are equal."""
    return reduce(and_, (a[k].eqNullSafe(b[k]) for k in keys))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_ordinary(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


KEYS = ["__id", "__digest"]
#: Above this id there may be no room for numbers behind all ids.
LAST_ID = 2**62


def _keyed(docs: DataFrame) -> DataFrame:
    """Each row as one value, whatever its columns are called, beside its id and the digest of its text."""
    return docs.select(F.struct("*").alias("__row"), F.col("doc_id").cast("long").alias("__id"), digest().alias("__digest"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per text. Rows are told apart by id and text; of rows alike in both, the least in the other columns stays."""
    marks = exact_duplicates(docs).groupBy(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__digest"))
    marks = stored(marks.agg(F.min("kept").alias("kept"), F.count(F.lit(1)).alias("n")), "exact-marks")
    keyed = _keyed(docs)
    # Copies are folded before any shuffle, so a text repeated under one id is no hot key.
    again = marks.where("kept and n > 1").select(*KEYS)
    order = [*(c for c in docs.columns if c != "text"), "text"]
    repeated = keyed.join(again, _same(keyed, again, KEYS), "left_semi")
    least = F.min(F.struct(*(F.col("__row")[c].alias(c) for c in order))).alias("__row")
    one = repeated.groupBy(*KEYS).agg(least).select(*(F.col("__row")[c].alias(c) for c in docs.columns))
    gone = marks.where("not kept or n > 1").select(*KEYS)
    return keyed.join(gone, _same(keyed, gone, KEYS), "left_anti").select("__row.*").unionByName(one)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per group of near copies, that of the smallest id.

    Rows without an id, and all but one of the rows of a repeated id, get a number behind all ids,
    so that every row is linked, and dropped, by its own text. Where ids leave no room for that, all rows are
    numbered in the order of their ids.
    """
    keyed = _keyed(docs)
    pairs = stored(keyed.select(*KEYS).distinct(), "near-rows")
    top = pairs.agg(F.coalesce(F.max("__id"), F.lit(0)).alias("top")).first()["top"]
    if top < LAST_ID:
        first = pairs.where("__id is not null").groupBy("__id").agg(F.min("__digest").alias("__digest"), F.count(F.lit(1)).alias("n"))
        more = first.where("n > 1").select("__id")
        odd = pairs.join(more, "__id").join(first.select(*KEYS), KEYS, "left_anti").unionByName(pairs.where("__id is null"))
    else:
        odd, top = pairs, -1
    odd = odd.orderBy(F.col("__id").asc_nulls_last(), "__digest").withColumn("__own", F.lit(max(0, top + 1)) + F.monotonically_increasing_id())
    odd = stored(odd, "near-numbers")
    numbered = keyed.join(odd, _same(keyed, odd, KEYS), "left").select("__row", F.coalesce("__own", keyed["__id"]).alias("__number"))
    texts = numbered.select("__number", F.col("__row")["text"].alias("text"))
    lost = near_duplicates(texts, NearDedup(), id_col="__number").where(~F.col("kept")).select(F.col("doc_id").alias("__number")).distinct()
    return numbered.join(lost, "__number", "left_anti").select("__row.*")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_documents(docs, mixture_columns(), MIXTURE)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, tokenizer_path())


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

#: SQL cannot express the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, f"stage-{name}")
    return docs
