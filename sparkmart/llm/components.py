"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import stored


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected_components(links: DataFrame, label: str = "components") -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); component is its smallest reachable node.

    Minima are combined before they are shuffled, and the joins that follow can be split
    by the runtime, so a node with very many links is no hot task. Rows with a null or
    with a == b link nothing. No links give no rows.
    """
    links = (
        links.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    links = stored(links, label)
    before = _state(links)
    while before[0]:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        star = small.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct()
        links = stored(star, label)
        after = _state(links)
        if after == before:
            break
        before = after
    children = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return children.unionByName(roots)
