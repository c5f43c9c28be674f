"""Token sequences of documents, and their packing into as few fixed-length sequences as possible.

Packing is a grouping genetic algorithm. An individual is a set of bins. Crossover injects whole
well-filled bins of one parent into the other, removes the bins that hold the same documents
again, and puts the displaced documents back by best fit. Pieces are dealt to shards of bounded
size, each shard to several islands that evolve apart; between epochs every island sends its
best individual to the next one. Bins that end up loosely filled are then brought together over
shards and evolved once more, starting from the bins they have, so no round makes it worse.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import arrow_schema, prepare, stored, text_of
from sparkmart.llm.textbytes import chunks, text_buffers
from sparkmart.llm.tokens import WordTokens, word_pieces

END_ID = 1


@dataclass(frozen=True)
class Packing:
    capacity: int = 4096
    shard: int = 4096
    islands: int = 2
    epochs: int = 2
    population: int = 4
    children: int = 8
    seed: int = 11


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"

_TOKENS: dict[str, WordTokens] = {}


def tokenizer_of(path: str) -> WordTokens:
    """One per worker, with the words it has met."""
    if path not in _TOKENS:
        _TOKENS[path] = WordTokens(path)
    return _TOKENS[path]


def document_ids(texts: pa.Array, path: str) -> Iterator[tuple[int, np.ndarray]]:
    """(row, part of its ids) in order; a row has one part or more, the last ends with END_ID."""
    tokens = tokenizer_of(path)
    body, bounds = text_buffers(texts)
    end = np.array([END_ID], np.uint32)
    for lo, hi in chunks(bounds):
        if hi == lo + 1:
            for part in word_pieces(body, bounds[lo], bounds[hi]):
                yield lo, tokens.encode(part, np.empty(0, np.int64))[0]
            yield lo, end
        else:
            ids, first = tokens.encode(body[bounds[lo] : bounds[hi]], bounds[lo + 1 : hi] - bounds[lo])
            for r in range(hi - lo):
                yield lo + r, np.concatenate([ids[first[r] : first[r + 1]], end])


def cut_documents(docs: DataFrame, path: str, capacity: int) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32. Only documents longer than ``capacity`` are cut."""
    schema = arrow_schema(PIECES)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[int] = []
            out: list[tuple[int, int, int, int]] = []
            current, held, start, piece = -1, np.empty(0, np.uint32), 0, 0

            def close(ids: np.ndarray) -> None:
                nonlocal start, piece
                rows.append(current)
                out.append((piece, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                start, piece = start + len(ids), piece + 1

            for row, ids in document_ids(batch.column(1), path):
                if row != current:
                    if len(held):
                        close(held)
                    current, held, start, piece = row, np.empty(0, np.uint32), 0, 0
                held = np.concatenate([held, ids]) if len(held) else ids
                while len(held) > capacity:
                    close(held[:capacity])
                    held = held[capacity:]
            if len(held):
                close(held)
            columns = [pa.array([o[i] for o in out], schema.types[i + 1]) for i in range(4)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), *columns], schema=schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(F.col("text")).alias("text"))
    return rows.mapInArrow(work, PIECES)


Bins = list[list[int]]


def best_fit(bins: Bins, items: list[int], size: list[int], capacity: int) -> Bins:
    """Items, longest first, each into the fullest bin that still holds it."""
    bins = [list(b) for b in bins]
    free = sorted((capacity - sum(size[i] for i in b), k) for k, b in enumerate(bins))
    for i in sorted(items, key=lambda i: (-size[i], i)):
        at = bisect_left(free, (size[i], -1))
        if at < len(free):
            room, k = free.pop(at)
        else:
            room, k = capacity, len(bins)
            bins.append([])
        bins[k].append(i)
        if room > size[i]:
            insort(free, (room - size[i], k))
    return bins


def fitness(bins: Bins, size: list[int], capacity: int) -> tuple[int, float]:
    """Smaller is better: bins, then how evenly they are filled."""
    return len(bins), -sum((sum(size[i] for i in b) / capacity) ** 2 for b in bins)


def fewest(size: list[int], capacity: int) -> int:
    """A number of bins that no packing goes below: all tokens, or what large pieces force."""
    best = -(-sum(size) // capacity)
    ordered = sorted(size)
    half = [s for s in ordered if 2 * s > capacity]
    for small in {0, *(s for s in ordered if 2 * s <= capacity)}:
        large = sum(1 for s in half if s > capacity - small)
        middle = [s for s in half if s <= capacity - small]
        rest = ordered[bisect_left(ordered, small) : len(ordered) - len(half)]
        over = sum(rest) - (len(middle) * capacity - sum(middle))
        best = max(best, large + len(middle) + max(0, -(-over // capacity)))
        if len(half) * 2 < len(ordered):
            break  # large pieces do not bind
    return best


def cross(one: Bins, other: Bins, size: list[int], capacity: int, rng: np.random.Generator) -> Bins:
    """Whole well-filled bins of ``other`` into ``one``; documents displaced by them are put back by best fit."""
    filled = sorted(range(len(other)), key=lambda k: -sum(size[i] for i in other[k]))
    take = rng.permutation(filled[: max(1, len(filled) * 3 // 4)])[: max(1, len(filled) // 3)]
    injected = [other[k] for k in take]
    used = {i for b in injected for i in b}
    kept, displaced = [], []
    for b in one:
        if used.isdisjoint(b):
            kept.append(b)
        else:
            displaced += [i for i in b if i not in used]
    # The loosest bins are opened too, so that displaced documents meet others.
    kept.sort(key=lambda b: sum(size[i] for i in b))
    opened = max(1, len(kept) // 20)
    displaced += [i for b in kept[:opened] for i in b]
    return best_fit(injected + kept[opened:], displaced, size, capacity)


def evolve(size: list[int], starts: list[Bins], p: Packing, seed: int) -> Bins:
    """The best individual after ``children`` crossovers; stops at a packing no other can beat."""
    rng = np.random.default_rng(seed)
    n, bound = len(size), fewest(size, p.capacity)

    def rated(bins: Bins) -> tuple:
        return (*fitness(bins, size, p.capacity), bins)

    herd = [rated(best_fit([], list(range(n)), size, p.capacity)), *(rated(b) for b in starts)]
    herd.sort(key=lambda x: x[:2])
    if herd[0][0] <= bound:
        return herd[0][2]
    while len(herd) < p.population:
        # Other individuals: best fit after a random part of the pieces has been placed first.
        early = rng.permutation(n)[: n // 4].tolist()
        early_set = set(early)
        bins = best_fit([], early, size, p.capacity)
        herd.append(rated(best_fit(bins, [i for i in range(n) if i not in early_set], size, p.capacity)))
    herd.sort(key=lambda x: x[:2])
    for _ in range(p.children):
        a, b = rng.choice(len(herd), 2, replace=False)
        child = rated(cross(herd[min(a, b)][2], herd[max(a, b)][2], size, p.capacity, rng))
        if child[:2] < herd[-1][:2]:
            herd[-1] = child
            herd.sort(key=lambda x: x[:2])
        if herd[0][0] <= bound:
            break
    return herd[0][2]


def _seed(*parts: int) -> int:
    return zlib.crc32(repr(parts).encode())


STATE = "shard long, island int, item array<long>, size array<long>, bin array<int>, bins int"
_LONGS, _INTS = pa.list_(pa.int64()), pa.list_(pa.int32())


def _as_state(shard: int, island: int, item: np.ndarray, size: list[int], best: Bins) -> pa.Table:
    where = np.zeros(len(size), np.int32)
    for k, b in enumerate(best):
        where[b] = k
    return pa.table(
        {
            "shard": pa.array([shard], pa.int64()),
            "island": pa.array([island], pa.int32()),
            "item": pa.array([item.tolist()], _LONGS),
            "size": pa.array([size], _LONGS),
            "bin": pa.array([where.tolist()], _INTS),
            "bins": pa.array([len(best)], pa.int32()),
        }
    )


def _bins_of(where: list[int]) -> Bins:
    bins: dict[int, list[int]] = {}
    for i, k in enumerate(where):
        bins.setdefault(k, []).append(i)
    return list(bins.values())


def _islands(rows: DataFrame, p: Packing, start: bool) -> DataFrame:
    """Evolve rows (shard, item, length[, bin]) and return (item, shard, bin) of the best island of each shard."""

    def first(table: pa.Table) -> pa.Table:
        table = table.sort_by("item")
        shard, island = table.column("shard")[0].as_py(), table.column("island")[0].as_py()
        size = table.column("length").to_pylist()
        starts = [_bins_of(table.column("bin").to_pylist())] if start else []
        best = evolve(size, starts, p, _seed(p.seed, shard, island))
        return _as_state(shard, island, table.column("item").to_numpy(), size, best)

    def onward(table: pa.Table) -> pa.Table:
        state = sorted(table.to_pylist(), key=lambda s: s["origin"])
        own = next(s for s in state if s["origin"] == s["island"])
        starts = [_bins_of(s["bin"]) for s in state]
        best = evolve(own["size"], starts, p, _seed(p.seed, own["shard"], own["island"], own["epoch"]))
        return _as_state(own["shard"], own["island"], np.array(own["item"]), own["size"], best)

    ring = rows.withColumn("island", F.explode(F.array(*(F.lit(i) for i in range(p.islands)))))
    state = ring.groupBy("shard", "island").applyInArrow(first, STATE)
    for epoch in range(1, p.epochs):
        # An island keeps its own best and gets the best of the island before it in the ring.
        sent = F.array_distinct(F.array(F.col("island"), ((F.col("island") + 1) % p.islands).cast("int")))
        moved = state.withColumn("origin", F.col("island")).withColumn("island", F.explode(sent)).withColumn("epoch", F.lit(epoch))
        state = moved.groupBy("shard", "island").applyInArrow(onward, STATE)
    best = state.groupBy("shard").agg(F.min_by(F.struct("item", "bin"), F.struct("bins", "island")).alias("best"))
    pairs = best.select("shard", F.explode(F.arrays_zip("best.item", "best.bin")).alias("x"))
    return pairs.select(F.col("x.item").alias("item"), "shard", F.col("x.bin").alias("bin"))


def pack(items: DataFrame, count: int, p: Packing) -> DataFrame:
    """(item, sequence_id) for items (item, length): each sequence holds at most ``capacity`` together."""
    shards = max(1, -(-count // p.shard))
    dealt = items.withColumn("shard", F.pmod(F.xxhash64("item"), F.lit(shards)))
    placed = stored(_islands(dealt, p, start=False).join(items, "item"), "packed")
    filled = placed.groupBy("shard", "bin").agg(F.sum("length").alias("filled"))
    loose = filled.where(F.col("filled") < F.lit(p.capacity - p.capacity // 64)).select("shard", "bin")
    number = (F.shiftleft("shard", 24) + F.col("bin")).alias("sequence_id")
    tight = placed.join(loose, ["shard", "bin"], "left_anti").select("item", number)
    # Loose bins meet those of other shards. The bins they have are one of the starting individuals.
    again = placed.join(loose, ["shard", "bin"]).select("item", "length", number)
    rest = stored(again, "loose")
    groups = max(1, -(-rest.count() // p.shard))
    rest = rest.withColumn("shard", F.pmod(F.xxhash64("sequence_id"), F.lit(groups)))
    # Within a group the old bins are numbered by their ids; any distinct numbers do.
    rest = rest.select("item", "length", "shard", F.col("sequence_id").alias("bin"))
    second = _islands(rest, p, start=True)
    number = (F.shiftleft(F.col("shard") + F.lit(shards), 24) + F.col("bin")).alias("sequence_id")
    return tight.unionByName(second.select("item", number))


def pack_documents(docs: DataFrame, tokenizer_path: str, p: Packing = Packing()) -> DataFrame:
    """Per piece of ``docs`` (doc_id, text): doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document's ids are those of its whole text followed by END_ID. Null and empty texts have that
    one id. Only documents above ``capacity`` ids are cut, in pieces of ``capacity``; the last may be
    shorter. Offsets within a sequence are gapless from 0, in order of piece.

    Rows without an id, and rows that repeat one, are documents of their own. Other columns are
    ignored. An empty table gives no rows. ``tokenizer_path`` must exist on every worker.
    """
    prepare(docs.sparkSession)
    pieces = stored(cut_documents(docs, tokenizer_path, p.capacity), "pieces")
    # The files are written, so numbering their rows gives the same numbers whenever it is run again.
    pieces = stored(pieces.withColumn("item", F.monotonically_increasing_id()), "numbered")
    whole = F.col("length") == p.capacity
    shorter = pieces.where(~whole).select("item", "length")
    packed = pack(shorter, shorter.count(), p)
    # Whole sequences are numbered below zero, apart from the packed ones.
    alone = pieces.where(whole).select("item", (-1 - F.col("item")).alias("sequence_id"))
    located = pieces.join(packed.unionByName(alone), "item")
    # A sequence holds at most ``capacity`` pieces, so the windows are small.
    offset = F.expr("sum(length) over (partition by sequence_id order by item) - length")
    located = located.withColumn("offset", offset.cast("long"))
    return located.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
