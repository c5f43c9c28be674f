"""Importance resampling towards a target: documents are drawn by how much their word runs speak for the target.

A feature is a run of ``shortest`` to ``longest`` consecutive words, joined by one space; its bucket is the crc32
of its bytes modulo ``buckets``. A dictionary holds distinct words between delimiters, each with its CRC and its
length as payload. An Aho-Corasick automaton over the dictionary scans the texts and emits the payloads in the
order of the text; the CRC of a run is composed of the payloads of its neighbours, without touching its bytes
again: the CRC of what came before is moved on by the length that follows, a linear map, and the next CRC is
added. One scan counts the buckets of the documents and of the target, the other scores each document.

The dictionary goes to every worker, so it is bounded: the most frequent words of all texts, at most
``dictionary_words`` of at most ``WORD_BYTES`` bytes each, counted over all rows. Words outside it are found as
the places where nothing was emitted and get their payload from their bytes: results never depend on the bound.

Documents are drawn without replacement by Gumbel scores: weight plus noise fixed by the id. Only those that can
be drawn are sorted, in ranges, and numbered per range; the noise spreads equal weights over thousands of scores.

Defined results: a null text has no words; a document without features has weight 0; a null id is an empty one in
the noise; rows that repeat an id are all scored, and ties are then broken by the row; a very long text or word is
taken whole; empty tables give no rows, and an empty target evens the gains out. Other columns are passed by.
"""

from __future__ import annotations

import uuid
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.llm.common import arrow_schema, prepare, stored, text_of
from sparkmart.llm.textbytes import CHUNK_BYTES, NO_LETTER, text_pieces, word_spans

WORD_BYTES = 64
HELD_WORDS = 100_000
#: Levels of word counts per doubling.
LEVELS = 8
_PLAIN = bytes(32 if NO_LETTER[b] else b + 32 if 65 <= b <= 90 else b for b in range(256))


@dataclass(frozen=True)
class Resampling:
    shortest: int = 1
    longest: int = 1
    buckets: int = 10_000
    min_words: int = 20
    #: Of the documents with enough words, so many in a hundred are drawn.
    percent: int = 10
    seed: str = "2024"
    dictionary_words: int = 100_000


# --- CRC algebra -------------------------------------------------------------------


def _zero_byte(crc: np.ndarray) -> np.ndarray:
    """CRC registers after one more byte of zeros, without the inversions at the ends."""
    for _ in range(8):
        crc = np.where(crc & 1, (crc >> 1) ^ np.uint32(0xEDB88320), crc >> 1).astype(np.uint32)
    return crc


def _columns(bits: np.ndarray) -> np.ndarray:
    """Lookup tables (4 x 256) of a linear map given by the images of the 32 single bits."""
    values = np.arange(256)
    return np.stack([np.bitwise_xor.reduce(np.where(values[:, None] >> np.arange(8) & 1, bits[8 * q : 8 * q + 8], 0).astype(np.uint32), axis=1) for q in range(4)])


def _apply(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return table[0][crc & 255] ^ table[1][crc >> 8 & 255] ^ table[2][crc >> 16 & 255] ^ table[3][crc >> 24]


def _doublings() -> list[np.ndarray]:
    """Maps that move a CRC on by 1, 2, 4, ... bytes of zeros."""
    tables = [_columns(_zero_byte(np.uint32(1) << np.arange(32, dtype=np.uint32)))]
    while len(tables) < 32:
        tables.append(_columns(_apply(tables[-1], _apply(tables[-1], np.uint32(1) << np.arange(32, dtype=np.uint32)))))
    return tables


_MOVES = _doublings()


def compose(crc: np.ndarray, following: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRCs of two parts in a row, from their CRCs and the length of the second."""
    moved = crc.copy()
    for bit in range(int(length.max()).bit_length() if len(length) else 0):
        at = np.flatnonzero(length >> bit & 1)
        moved[at] = _apply(_MOVES[bit], moved[at])
    return moved ^ following


_SPACE_CRC = np.uint32(zlib.crc32(b" "))


def run_codes(crc: np.ndarray, length: np.ndarray, row: np.ndarray, shortest: int, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """(CRC, row) of all runs of words that stay in one row."""
    codes, rows = [], []
    run = crc
    for size in range(1, longest + 1):
        if size > 1:
            n = len(crc) - size + 1
            if n <= 0:
                break
            gap = compose(run[:n], np.full(n, _SPACE_CRC), np.ones(n, np.int64))
            run = compose(gap, crc[size - 1 :], length[size - 1 :])
        if size >= shortest:
            inside = row[: len(run)] == row[size - 1 :]
            codes.append(run[inside])
            rows.append(row[: len(run)][inside])
    if not codes:
        return np.empty(0, np.uint32), np.empty(0, np.int64)
    return np.concatenate(codes), np.concatenate(rows)


# --- dictionary and automaton -------------------------------------------------------


def _texts(batch: pa.RecordBatch) -> Iterator[bytes]:
    """Plain texts one by one, so that a task never holds a batch twice."""
    return (t.as_py().translate(_PLAIN) for t in batch.column("text").cast(pa.binary()))


def _pieces(text: bytes) -> Iterator[bytes]:
    if len(text) <= CHUNK_BYTES:
        return iter([text])
    return (p.tobytes() for p in _whole_words(np.frombuffer(text, np.uint8)))


def dictionary(tables: list[DataFrame], settings: Resampling) -> list[str]:
    """The most frequent words of all texts: whole levels of counts, from the top, as long as they fit.

    A task reports words it met twice or more since its last report; a word that no task met twice is
    no candidate, so the many words that occur once are never shuffled.
    """
    ddl = "word string, n long"
    schema = arrow_schema(ddl)

    def report(total: Counter) -> pa.RecordBatch:
        kept = [(w, n) for w, n in total.items() if n > 1 and len(w) <= WORD_BYTES]
        words = pa.array([w for w, _ in kept], pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array([n for _, n in kept], pa.int64())], schema=schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for text in _texts(batch):
                for piece in _pieces(text):
                    total.update(piece.split())
                if len(total) >= HELD_WORDS:
                    yield report(total)
                    total.clear()
        yield report(total)

    parts = [t.mapInArrow(count, ddl) for t in tables]
    for part in parts[1:]:
        parts[0] = parts[0].unionByName(part)
    words = parts[0].groupBy("word").agg(F.sum("n").alias("n"))
    words = stored(words.withColumn("level", F.floor(F.log2("n") * LEVELS).cast("int")), "resampling-words")
    # Counts fit 64 bits, so there are at most 64 * LEVELS levels.
    room, lowest = settings.dictionary_words, None
    for level, n in sorted(words.groupBy("level").count().collect(), reverse=True):
        if n > room:
            break
        room, lowest = room - n, level
    if lowest is None:
        return []
    return sorted(r["word"] for r in words.where(F.col("level") >= lowest).select("word").collect())


class Scanner:
    """Payloads of the words of plain texts; each byte is one character of the automaton."""

    def __init__(self, words: list[str]):
        forms = [w.encode() for w in words]
        self.crc = np.array([zlib.crc32(w) for w in forms], np.uint32)
        self.length = np.array([len(w) for w in forms], np.int64)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, form in enumerate(forms):
            self.automaton.add_word(f" {form.decode('latin-1')} ", i)
        if forms:
            self.automaton.make_automaton()

    def scan(self, plain: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(CRC, length, start) of each word, in order; ``plain`` starts and ends with a space."""
        starts, ends = word_spans(np.frombuffer(plain, np.uint8))
        crc = np.zeros(len(starts), np.uint32)
        length = ends - starts
        missing = np.ones(len(starts), bool)
        if len(self.crc) and len(starts):
            hits = np.fromiter(self.automaton.iter(plain.decode("latin-1")), np.dtype([("at", np.int64), ("word", np.int64)]))
            at = np.searchsorted(ends, hits["at"])  # a match ends at the space behind its word
            crc[at], length[at] = self.crc[hits["word"]], self.length[hits["word"]]
            missing[at] = False
        for i in np.flatnonzero(missing).tolist():
            crc[i] = zlib.crc32(plain[starts[i] : ends[i]])
        return crc, length, starts

    def rows(self, texts: Iterator[bytes]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
        """(first row, rows, CRCs, lengths, row of each word) for blocks of bounded size; a long text is scanned in pieces."""
        first, block, size = 0, [], 0
        for text in texts:
            if block and size + len(text) > CHUNK_BYTES:
                yield self._block(first, block)
                first, block, size = first + len(block), [], 0
            block.append(text)
            size += len(text) + 1
        if block:
            yield self._block(first, block)

    def _block(self, first: int, block: list[bytes]) -> tuple[int, int, np.ndarray, np.ndarray, np.ndarray]:
        if len(block) == 1:
            parts = [self.scan(b" " + p + b" ")[:2] for p in _pieces(block[0])]
            crc, length = (np.concatenate(x) for x in zip(*parts))
            return first, 1, crc, length, np.zeros(len(crc), np.int64)
        crc, length, starts = self.scan(b" " + b" ".join(block) + b" ")
        begins = np.cumsum([1] + [len(t) + 1 for t in block[:-1]])
        return first, len(block), crc, length, np.searchsorted(begins, starts, side="right") - 1


def _whole_words(body: np.ndarray) -> Iterator[np.ndarray]:
    """Pieces that end between words, put together where a word is longer than a piece."""
    held: list[np.ndarray] = []
    for piece in text_pieces(body, 0, len(body)):
        held.append(piece)
        if NO_LETTER[piece[-1]]:
            yield np.concatenate(held)
            held = []
    if held:
        yield np.concatenate(held)


class SharedWords:
    """A dictionary on all workers; its name tells it from earlier ones."""

    def __init__(self, spark: SparkSession, words: list[str]):
        self.name = uuid.uuid4().hex
        self.words: Broadcast = spark.sparkContext.broadcast(words)


_SCANNERS: dict[str, Scanner] = {}


def _scanner(shared: SharedWords) -> Scanner:
    """One automaton per worker."""
    if shared.name not in _SCANNERS:
        _SCANNERS.clear()
        _SCANNERS[shared.name] = Scanner(shared.words.value)
    return _SCANNERS[shared.name]


# --- counting and scoring -----------------------------------------------------------


def bucket_counts(texts: DataFrame, words: SharedWords, settings: Resampling) -> np.ndarray:
    """Features of all texts in each bucket: one row per bucket and task is shuffled."""
    ddl = "bucket int, n long"
    schema = arrow_schema(ddl)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(settings.buckets, np.int64)
        for batch in batches:
            for _, _, crc, length, row in _scanner(words).rows(_texts(batch)):
                codes, _ = run_codes(crc, length, row, settings.shortest, settings.longest)
                total += np.bincount(codes % settings.buckets, minlength=settings.buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], schema=schema)

    out = np.zeros(settings.buckets, np.int64)
    for bucket, n in texts.mapInArrow(count, ddl).groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of target to source, with one feature more in each bucket."""
    k = len(source)
    return np.floor(1000 * np.log((target + 1.0) * (source.sum() + float(k)) / ((source + 1.0) * (target.sum() + float(k))))).astype(np.int64)


def document_weights(docs: DataFrame, target: DataFrame, settings: Resampling = Resampling(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight): the floored mean gain of each document's features."""
    spark = prepare(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("doc_id"), text_of(F.col(text_col)).alias("text"))
    wanted = target.select(text_of(F.col(text_col)).alias("text"))
    words = SharedWords(spark, dictionary([texts.select("text"), wanted], settings))
    gains = bucket_gains(bucket_counts(texts.select("text"), words, settings), bucket_counts(wanted, words, settings))
    ddl = f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, n_words long, n_features long, weight long"
    schema = arrow_schema(ddl)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n, total = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for first, rows, crc, length, row in _scanner(words).rows(_texts(batch)):
                codes, of = run_codes(crc, length, row, settings.shortest, settings.longest)
                part = slice(first, first + rows)
                n_words[part] = np.bincount(row, minlength=rows)
                n[part] = np.bincount(of, minlength=rows)
                # Sums stay far below 2**53, so doubles hold them exactly.
                total[part] = np.bincount(of, gains[codes % settings.buckets].astype(np.float64), minlength=rows).astype(np.int64)
            columns = [batch.column("doc_id"), pa.array(n_words), pa.array(n), pa.array(total // np.maximum(n, 1))]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return texts.mapInArrow(score, ddl)


def resample(docs: DataFrame, target: DataFrame, settings: Resampling = Resampling(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank): rank 1, 2, 3... for the drawn, null for all others."""
    weights = document_weights(docs, target, settings, id_col, text_col)
    name = F.concat(F.lit(f"{settings.seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    scored = stored(weights.withColumn("score", F.col("weight") + noise), "resampling-scores")
    return draw(scored, settings)


def draw(scored: DataFrame, settings: Resampling) -> DataFrame:
    """Rank the highest scores among rows with enough words; equal scores by smaller id."""
    able = F.col("n_words") >= settings.min_words
    # One row per distinct score: thousandths of a logarithm, some ten thousand values at any size.
    counts = scored.where(able).groupBy("score").count().orderBy(F.desc("score")).collect()
    wanted = sum(r["count"] for r in counts) * settings.percent // 100
    least, above = None, 0
    for r in counts:
        if above >= wanted:
            break
        least, above = r["score"], above + r["count"]
    columns = [*scored.columns, "rank"]
    if least is None:
        return scored.withColumn("rank", F.lit(None).cast("long")).select(columns)
    chance = able & (F.col("score") >= least)
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.col("n_features"), F.col("n_words")]
    # The number of the range stands in the high bits, the place in it in the low 33.
    top = scored.where(chance).repartitionByRange(*order).sortWithinPartitions(*order)
    top = stored(top.withColumn("place", F.monotonically_increasing_id()), "resampling-top")
    sizes = top.groupBy(F.shiftright("place", 33).alias("part")).count().orderBy("part").collect()
    before = 0
    starts = []
    for r in sizes:
        starts.append((r["part"], before))
        before += r["count"]
    offsets = F.broadcast(scored.sparkSession.createDataFrame(starts, "part long, before long"))
    ranked = top.join(offsets, F.shiftright("place", 33) == F.col("part"))
    rank = F.col("before") + F.col("place").bitwiseAND((1 << 33) - 1) + 1
    ranked = ranked.withColumn("rank", F.when(rank <= wanted, rank)).select(columns)
    rest = scored.where(~F.coalesce(chance, F.lit(False))).withColumn("rank", F.lit(None).cast("long"))
    return rest.select(columns).unionByName(ranked)
