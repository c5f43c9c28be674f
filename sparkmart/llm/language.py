"""Languages of a document as a mixture, by expectation-maximisation over byte n-grams.

Each language has a table of smoothed log-probabilities of hashed byte trigrams within words,
counted over all documents that may be learned from. A word's likelihood in a language is the
product over its trigrams. A document is a mixture of languages with unknown proportions:
EM estimates them, and the set of languages is chosen by penalised likelihood. It starts with
the best single language and grows by the one that helps most, as long as the gain exceeds
``penalty`` x log(words) / 2.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import arrow_schema, held_out, learned, prepare, text_of
from sparkmart.llm.textbytes import CHUNK_BYTES, byte_grams, text_buffers, text_pieces

ORDER = 3


@dataclass(frozen=True)
class LanguageId:
    slots: int = 65_521
    smoothing: float = 0.5
    #: Share of a word that any language may contain, so that no single word is decisive.
    noise: float = 1e-6
    penalty: float = 8.0
    steps: int = 30
    tolerance: float = 1e-3
    #: The model sent to the workers has slots x languages entries; more languages are refused.
    max_languages: int = 500


def _slots(piece: np.ndarray, slots: int) -> tuple[np.ndarray, np.ndarray]:
    codes, first = byte_grams(piece, ORDER)
    return (codes % np.uint64(slots)).astype(np.int64), first


def count_slots(docs: DataFrame, p: LanguageId) -> DataFrame:
    """(lang, slot, n) over all rows (text, lang); tasks add up their own rows first."""
    ddl = "lang string, slot int, n long"
    schema = arrow_schema(ddl)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            body, bounds = text_buffers(batch.column(0))
            for r, lang in enumerate(batch.column(1).to_pylist()):
                own = counts.setdefault(lang, np.zeros(p.slots, np.int64))
                for piece in text_pieces(body, bounds[r], bounds[r + 1]):
                    own += np.bincount(_slots(piece, p.slots)[0], minlength=p.slots)
            if len(counts) > p.max_languages:
                raise ValueError(f"more than {p.max_languages} languages")
        for lang, own in counts.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(own[at])], schema=schema)

    return docs.select("text", "lang").mapInArrow(work, ddl).groupBy("lang", "slot").agg(F.sum("n").alias("n"))


def log_table(counts: pa.Table, p: LanguageId) -> tuple[list[str], np.ndarray]:
    """Languages in order and, per slot and language, the log-probability."""
    langs = sorted(set(counts.column("lang").to_pylist()))
    if len(langs) > p.max_languages:
        raise ValueError(f"more than {p.max_languages} languages")
    table = np.zeros((p.slots, max(1, len(langs))))
    at = {lang: i for i, lang in enumerate(langs)}
    which = np.array([at[x] for x in counts.column("lang").to_pylist()], np.int64)
    table[counts.column("slot").to_numpy(), which] = counts.column("n").to_numpy()
    shared = table.sum(axis=1, keepdims=True) + p.smoothing
    shared /= shared.sum()
    weight = p.smoothing * p.slots / 10
    table = (table + weight * shared) / (table.sum(axis=0, keepdims=True) + weight)
    return langs, np.log(table).astype(np.float32)


def _em(likelihood: np.ndarray, p: LanguageId) -> tuple[np.ndarray, float]:
    """Proportions of the columns and the log-likelihood of the rows."""
    size = likelihood.shape[1]
    share = np.full(size, 1 / size)
    if size == 1:
        return share, float(np.log(likelihood[:, 0]).sum())
    for _ in range(p.steps):
        total = likelihood @ share
        new = share * (likelihood / total[:, None]).mean(axis=0)
        moved = np.abs(new - share).max()
        share = new / new.sum()
        if moved < p.tolerance:
            break
    return share, float(np.log(likelihood @ share).sum())


def mixture(words: np.ndarray, p: LanguageId) -> np.ndarray:
    """Proportion of each language from the words' log-likelihoods (words x languages)."""
    best = words.max(axis=1, keepdims=True)
    likelihood = np.exp((words - best).astype(np.float64)) + p.noise
    single = np.log(likelihood).sum(axis=0)
    chosen = [int(single.argmax())]
    share, value = np.ones(1), float(single.max())
    cost = p.penalty * np.log(max(2, len(words))) / 2
    while len(chosen) < likelihood.shape[1]:
        mixed = likelihood[:, chosen] @ share
        rest = [k for k in range(likelihood.shape[1]) if k not in chosen]
        # The gain of a language at a tenth of the document orders the candidates and bounds a useless trial.
        gain = [float(np.log1p(0.1 * (likelihood[:, k] / mixed - 1)).sum()) for k in rest]
        k = rest[int(np.argmax(gain))]
        new_share, new_value = _em(likelihood[:, [*chosen, k]], p)
        if new_value - value <= cost:
            break
        chosen, share, value = [*chosen, k], new_share, new_value
    out = np.zeros(likelihood.shape[1])
    out[chosen] = share
    return out


def document_mixture(body: np.ndarray, start: int, end: int, table: np.ndarray, p: LanguageId) -> np.ndarray:
    """Mean over bounded pieces of a text, weighted by their words; zeros without words."""
    total, words = np.zeros(table.shape[1]), 0
    # A piece takes bytes x languages numbers of memory.
    for piece in text_pieces(body, start, end, max(4096, 4 * CHUNK_BYTES // table.shape[1])):
        slots, first = _slots(piece, p.slots)
        if len(first):
            total += len(first) * mixture(np.add.reduceat(table[slots], first, axis=0), p)
            words += len(first)
    return total / words if words else total


def identify_languages(docs: DataFrame, p: LanguageId = LanguageId()) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, lang): doc_id, held_out, lang_pred, score, languages, shares.

    Learned from text and non-null lang of rows whose id may be learned from (crc32 of the id
    modulo 4 is not 2). ``lang_pred`` is the language with the largest share, ties to the first in
    order; ``languages`` and ``shares`` list the chosen set, largest first.

    - Null and empty texts, and texts without a letter, are ``und`` with score 0 and empty lists;
      so is everything if nothing can be learned.
    - Rows without an id are predicted, are not held out and never learned from.
    - Repeated rows are treated alike; other columns are ignored; an empty table gives no rows.
    """
    spark = prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(F.col("text")).alias("text"), F.col("lang").cast("string").alias("lang"))
    taught = rows.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & learned(F.col("doc_id"), 4, 2))
    langs, table = log_table(count_slots(taught, p).toArrow(), p)
    model = spark.sparkContext.broadcast(table)
    ddl = "doc_id long, lang_pred string, score double, languages array<string>, shares array<double>"
    schema = arrow_schema(ddl)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body, bounds = text_buffers(batch.column(1))
            out = []
            for r, letters in enumerate(batch.column(2).to_pylist()):
                share = document_mixture(body, bounds[r], bounds[r + 1], model.value, p) if letters and langs else np.zeros(1)
                order = [int(k) for k in np.argsort(-share, kind="stable") if share[k] > 0]
                if order:
                    out.append((langs[order[0]], min(1.0, float(share[order[0]])), [langs[k] for k in order], [float(share[k]) for k in order]))
                else:
                    out.append(("und", 0.0, [], []))
            columns = [[o[i] for o in out] for i in range(4)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, schema.types[1:]))], schema=schema)

    seen = rows.select("doc_id", "text", F.col("text").rlike(r"\p{L}").alias("letters"))
    found = seen.mapInArrow(work, ddl)
    return found.withColumn("held_out", held_out(F.col("doc_id"), 4, 2))
