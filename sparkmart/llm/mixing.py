"""Mixing documents to target shares of tokens by source, language and topic.

Documents fall into cells: a named source or any other, a named language or any other, a named
topic or any other. Iterative proportional fitting rakes the keep probability of every cell until
the expected tokens meet the targets of all three margins, with no probability above one; then
each document is kept with the probability of its cell, decided by a hash of its id.

Only cells are brought to the driver. Their number is the product of the names in the targets,
which are parameters, whatever the number of sources in the data.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import prepare, stored, text_of

#: All categories that a target does not name, nulls included.
OTHER = "*"
MAX_CELLS = 1_000_000


@dataclass(frozen=True)
class Mixture:
    """Target weights per margin (any positive numbers), and the share of all tokens to keep.

    A category without tokens is left out and the others share its weight. If the targets cannot be
    met with probabilities up to one, the closest reachable mixture of the raking is used.
    """

    margins: Mapping[str, Mapping[str, float]] = field(default_factory=dict)
    keep: float = 0.7
    seed: int = 17
    rounds: int = 2_000
    tolerance: float = 1e-10


def word_count(text: Column) -> Column:
    return F.regexp_count(text_of(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def _times(text: Column, mark: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))) / len(mark)


def topic_of(text: Column) -> Column:
    """A coarse topic from the form of a text: license, table, symbols, capitals or prose."""
    text = text_of(text)
    return (
        F.when(F.contains(text, F.lit("icensed under")) | F.contains(text, F.lit("Public License")), "license")
        .when(_times(text, " | ") >= 8, "table")
        .when(F.contains(text, F.lit("%%%")) & F.contains(text, F.lit("&&&")), "symbols")
        .when(_times(text, "!! ") >= 8, "capitals")
        .otherwise("prose")
    )


def rake(tokens: np.ndarray, cells: list[tuple[str, ...]], mixture: Mixture) -> np.ndarray:
    """Keep probability of each cell by iterative proportional fitting."""
    budget = mixture.keep * tokens.sum()
    steps = []
    for i, (_, target) in enumerate(mixture.margins.items()):
        names = sorted({c[i] for c in cells})
        members = [np.array([c[i] == n for c in cells]) for n in names]
        weights = np.array([target.get(n, 0.0) if tokens[m].sum() > 0 else 0.0 for n, m in zip(names, members)])
        if weights.sum() > 0:
            steps.append(list(zip(members, weights / weights.sum() * budget)))
    p = np.full(len(cells), mixture.keep)
    for _ in range(mixture.rounds):
        before = p.copy()
        for step in steps:
            for member, goal in step:
                now = (p * tokens)[member].sum()
                if now > 0:
                    p[member] = np.minimum(1.0, p[member] * goal / now)
        if np.abs(p - before).max(initial=0.0) < mixture.tolerance:
            break
    return p


def _named(column: Column, names) -> Column:
    column = column.cast("string")
    return F.when(column.isin(*names), column).otherwise(OTHER) if names else F.lit(OTHER)


def _cells(columns: Mapping[str, Column], mixture: Mixture) -> list[Column]:
    return [_named(columns[m], [n for n in t if n != OTHER]).alias(f"__cell_{i}") for i, (m, t) in enumerate(mixture.margins.items())]


def draw(doc_id: Column, text: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the id only, or on the text where there is no id."""
    bits = F.xxhash64(F.coalesce(doc_id.cast("long"), F.xxhash64(text)), F.lit(seed))
    return F.shiftrightunsigned(bits, 11) / F.lit(float(2**53))


def _names(mixture: Mixture) -> list[str]:
    return [f"__cell_{i}" for i in range(len(mixture.margins))]


def cell_probabilities(marked: DataFrame, mixture: Mixture) -> DataFrame:
    """A row per cell that occurs in ``marked`` (the cell columns, tokens), with its probability ``__p``."""
    size = int(np.prod([len(t) + 1 for t in mixture.margins.values()]))
    if size > MAX_CELLS:
        raise ValueError(f"targets name {size} cells, more than {MAX_CELLS}")
    names = _names(mixture)
    rows = marked.groupBy(*names).agg(F.sum("tokens").alias("tokens")).collect()
    rows.sort(key=lambda r: tuple(r[n] for n in names))
    cells = [tuple(r[n] for n in names) for r in rows]
    p = rake(np.array([float(r["tokens"]) for r in rows]), cells, mixture)
    schema = ", ".join([*(f"{n} string" for n in names), "__p double"])
    return marked.sparkSession.createDataFrame([(*c, float(x)) for c, x in zip(cells, p)], schema)


def mix_documents(docs: DataFrame, columns: Mapping[str, Column], mixture: Mixture) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, ...) that are drawn, with all their columns.

    - ``columns`` gives the category of each margin as a column of ``docs``; null counts as other.
    - Empty and null texts have no tokens and are kept with the probability of their cell.
    - Rows that repeat an id share one draw; a row without an id draws by its text.
    - An empty table gives no rows. Names of other columns are free.
    """
    prepare(docs.sparkSession)
    cells = _cells(columns, mixture)
    table = cell_probabilities(docs.select(*cells, word_count(F.col("text")).alias("tokens")), mixture)
    drawn = draw(F.col("doc_id"), F.col("text"), mixture.seed).alias("__draw")
    # A row travels as one value, so no name of its columns meets one of these.
    marked = docs.select(F.struct("*").alias("__row"), drawn, *cells).join(F.broadcast(table), _names(mixture), "left")  # at most MAX_CELLS rows
    return marked.where(F.col("__draw") < F.col("__p")).select("__row.*")


def mixing_report(docs: DataFrame, columns: Mapping[str, Column], mixture: Mixture) -> DataFrame:
    """Per row of ``docs``: doc_id, the margins, tokens, probability, kept; rules as in ``mix_documents``."""
    prepare(docs.sparkSession)
    text, doc_id = F.col("text"), F.col("doc_id")
    margins = [c.cast("string").alias(m) for m, c in columns.items()]
    rows = docs.select(
        doc_id.cast("long").alias("doc_id"),
        *margins,
        word_count(text).alias("tokens"),
        *_cells(columns, mixture),
        draw(doc_id, text, mixture.seed).alias("__draw"),
    )
    rows = stored(rows, "cells")
    table = cell_probabilities(rows, mixture)
    marked = rows.join(F.broadcast(table), _names(mixture), "left")  # at most MAX_CELLS rows
    return marked.select("doc_id", *columns, "tokens", F.col("__p").alias("probability"), (F.col("__draw") < F.col("__p")).alias("kept"))
