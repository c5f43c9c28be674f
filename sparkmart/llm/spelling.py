"""Spelling variants: words one edit apart, found by pivotal grams.

All bigrams of the words are put in one order, the rarest first. The prefix of a word are its three rarest
bigrams, with all others as rare as the third. One edit spoils at most two overlapping bigrams, so of two
disjoint ones one survives: dynamic programming picks as pivots the two disjoint bigrams of the prefix with the
least count. If the last prefix bigram of a word is not behind that of its neighbour, one of its pivots stands
in the neighbour's prefix, and what lies on one side of the two is equal: the edit is on the other side. So
pivots are joined with prefixes by bigram and side, which fixes the position: equal left sides put the bigram
at the same place, equal right sides at most one apart, as lengths differ by one at most. A short side is shared by
many words; there the first or the last letters of the other side, one of which an edit spares, join the key. So a
hot bigram is spread over all that it occurs with. Candidates are verified inside the join; nothing but true
neighbours leaves it.

Letters run over a fixed alphabet of 90 code points, so there are at most 8,100 bigrams, whatever the corpus.

Defined results: null and empty texts hold no words, repeated rows count again, a very long run is one word of its
whole length (sides are hashed; words are compared in full), no words give no rows. Ties between forms of
equal count go to the smaller word in code-point order. Only the named columns are read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import arrow_schema, prepare, stored, text_of

LETTERS = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
GRAM, EDITS = 2, 1
PREFIX = GRAM * EDITS + 1
#: Equal sides below this length are refined by blocks of the other side, of these sizes.
LONG_SIDE, BLOCKS = 6, (2, 4)
#: Entries a task counts before it passes them on.
HELD_WORDS = 200_000


@dataclass(frozen=True)
class Spelling:
    min_length: int = 7
    min_count: int = 2
    #: How many times as frequent as a word its form must be.
    ratio: int = 10
    #: If set, a run whose crc32 of ``<doc_id>:<run>`` this divides loses one code point: planted slips.
    slip: int | None = None


def _emit(counts: Counter, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], schema=schema)


def word_counts(docs: DataFrame, settings: Spelling = Spelling(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of the words of whole texts, counted in tasks before the shuffle."""
    prepare(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), text_of(F.col(text_col)).alias("text"))
    ddl = "word string, n long"
    schema = arrow_schema(ddl)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for doc, text in zip(batch.column("id").to_pylist(), texts):
                runs = Counter(w for w in LETTERS.findall(text.translate(LOWER).decode()) if len(w) >= settings.min_length)
                if settings.slip:
                    start = zlib.crc32(f"{doc}:".encode())
                    for word, n in runs.items():
                        h = zlib.crc32(word.encode(), start)
                        if h % settings.slip == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < settings.min_length:
                                continue
                        total[word] += n
                else:
                    total.update(runs)
                if len(total) >= HELD_WORDS:
                    yield _emit(total, schema)
                    total = Counter()
        yield _emit(total, schema)

    counted = rows.mapInArrow(count, ddl).groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= settings.min_count)


def gram_order(words: DataFrame) -> dict[str, tuple[int, int]]:
    """Each bigram's place in the order, rarest first, and the number of its places in words."""
    places = F.sequence(F.lit(1), F.length("word") - (GRAM - 1))
    grams = words.where(F.length("word") >= GRAM).select(F.explode(F.transform(places, lambda i: F.substring("word", i, GRAM))).alias("gram"))
    counts = grams.groupBy("gram").count().collect()
    ordered = sorted((r["count"], r["gram"]) for r in counts)
    return {gram: (place, n) for place, (n, gram) in enumerate(ordered)}


def prefix_grams(word: str, order: dict[str, tuple[int, int]], size: int = PREFIX) -> list[int]:
    """Places of the rarest bigrams of a word, in order of place, with all as rare as the last."""
    ranks = [order[word[i : i + GRAM]][0] for i in range(len(word) - GRAM + 1)]
    last = sorted(ranks)[min(size, len(ranks)) - 1]
    return [i for i, r in enumerate(ranks) if r <= last]


def pivots(word: str, places: list[int], order: dict[str, tuple[int, int]], wanted: int = EDITS + 1) -> list[int]:
    """The disjoint places with the least sum of counts, by dynamic programming over places and picks."""
    # best[k]: the least sum of k picks among the places so far; states[i]: the same before the i-th place.
    best: list[tuple[int, tuple[int, ...]] | None] = [(0, ())] + [None] * wanted
    states = []
    for i, at in enumerate(places):
        states.append(list(best))
        # Picks may go up to the last place that ends before this one starts.
        before = states[next((j + 1 for j in range(i - 1, -1, -1) if places[j] + GRAM <= at), 0)]
        cost = order[word[at : at + GRAM]][1]
        for k in range(1, wanted + 1):
            if before[k - 1] is not None:
                found = (before[k - 1][0] + cost, (*before[k - 1][1], at))
                if best[k] is None or found < best[k]:
                    best[k] = found
    return list(best[wanted][1]) if best[wanted] else places


def _blocks(other: str) -> Iterator[str]:
    """What two sides one edit apart have in common, one of two: their first letters or their last ones.

    Blocks of h letters lie apart in a side of 2 h letters, so one edit spares one of them. Sides just
    too short for a size also give blocks of that size, as their neighbour may be longer by one.
    """
    n = len(other)
    if n < 2 * BLOCKS[0]:
        yield ""
    for h, upto in zip(BLOCKS, [*(2 * b for b in BLOCKS[1:]), n + 1]):
        if 2 * h - 1 <= n < upto:
            yield f"{h}<{other[:h]}"
            yield f"{h}>{other[-h:]}"


def _keys(word: str, places: list[int]) -> Iterator[int]:
    """For each bigram: itself with all to its left, and itself with all to its right.

    Where that is short, many words share it, so what must agree on the other side is added.
    """
    for at in places:
        for side, same, other in (("<", word[: at + GRAM], word[at + GRAM :]), (">", word[at:], word[:at])):
            for block in [""] if len(same) >= LONG_SIDE else _blocks(other):
                yield xxhash.xxh3_64_intdigest(f"{side}{same} {block}") - 2**63


INDEX = "word string, n long, last int, pivot_keys array<long>, prefix_keys array<long>"


def gram_index(words: DataFrame, order: dict[str, tuple[int, int]]) -> DataFrame:
    """Pivot and prefix keys of each word."""
    schema = arrow_schema(INDEX)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
                places = prefix_grams(word, order)
                last = max(order[word[i : i + GRAM]][0] for i in places)
                chosen = pivots(word, places, order)
                rows.append((word, n, last, sorted(set(_keys(word, chosen))), sorted(set(_keys(word, places)))))
            columns = list(zip(*rows)) or [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return words.mapInArrow(index, INDEX)


def near_words(words: DataFrame) -> DataFrame:
    """(word, near, near_n): all ordered pairs of words one edit apart."""
    index = stored(gram_index(words, gram_order(words)), "spelling-index")
    a = index.select(F.explode("pivot_keys").alias("key"), F.col("word").alias("a"), F.col("n").alias("a_n"), F.col("last").alias("a_last"))
    b = index.select(F.explode("prefix_keys").alias("key"), F.col("word").alias("b"), F.col("n").alias("b_n"), F.col("last").alias("b_last"))
    near = (F.col("a_last") <= F.col("b_last")) & (F.abs(F.length("a") - F.length("b")) <= EDITS) & (F.col("a") != F.col("b"))
    found = a.join(b, "key").where(near).where(F.levenshtein("a", "b", EDITS) == 1)
    both = F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")), F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")))
    return found.select(F.inline(both)).distinct()


def _roots(links: DataFrame, most: int, ratio: int) -> DataFrame:
    """(word, root) for (word, form): forms followed to the last by doubling the step.

    Each step multiplies the count by ``ratio``, so the longest chain follows from the largest count.
    """
    steps = 0
    while ratio > 1 and most >= ratio:
        most //= ratio
        steps += 1
    roots = links.select("word", F.col("form").alias("root"))
    done = 1
    while done < steps:
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = stored(roots.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "spelling-roots")
        done *= 2
    return roots


def spelling_variants(docs: DataFrame, settings: Spelling = Spelling(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each word of the texts."""
    if settings.min_length < GRAM + PREFIX - 1 or settings.ratio < 2:
        raise ValueError("words need four code points for two disjoint bigrams in their prefix, and forms a ratio of two or more")
    words = stored(word_counts(docs, settings, id_col, text_col), "spelling-words")
    pairs = near_words(words)
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word"))).alias("best")
    groups = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    found = F.col("best.n") <= -settings.ratio * F.col("n")
    judged = words.join(groups, "word", "left").select(
        "word",
        F.when(found, F.col("best.word")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(found, -F.col("best.n")).alias("form_n"),
    )
    judged = stored(judged, "spelling-forms")
    most = judged.agg(F.max("form_n")).first()[0] or 0
    roots = _roots(judged.where("form is not null"), most, settings.ratio)
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
