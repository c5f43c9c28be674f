"""Vectorised words and fingerprints over Arrow text columns, used inside tasks.

A word is a maximal run of bytes other than space and 0x09-0x0D, lower-cased in
A-Z only. UTF-8 never uses those bytes inside a character, so working on bytes
equals working on characters. All arithmetic wraps at 64 bits on purpose.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

_rng = np.random.default_rng(20240501)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_EXACT, _BYTE = _BYTE, _BYTE[_LOWER]
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Bytes between the parts of a text that hold ASCII letters, digits or any other character.
NO_LETTER = np.ones(256, dtype=bool)
NO_LETTER[128:] = False
for _a, _b in ("09", "AZ", "az"):
    NO_LETTER[ord(_a) : ord(_b) + 1] = False
_BASE = 0x9E3779B97F4A7C15


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, dtype=np.uint64)
    out[0] = 1
    done = 1
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = out[:more] * np.uint64(pow(base, done, 2**64))
        done += more
    return out


_POW: list[np.ndarray] = []


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POW or len(_POW[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        _POW[:] = [_powers(_BASE, size), _powers(pow(_BASE, -1, 2**64), size)]
    return _POW[0], _POW[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values in which every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = column.cast(pa.large_binary())
    _, offsets, data = wide.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64, count=len(wide) + 1, offset=8 * wide.offset)
    body = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return body, bounds


def chunks(bounds: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts have at most ``limit`` bytes together; a longer text is alone."""
    row, rows = 0, len(bounds) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(bounds, bounds[row] + limit, side="right")) - 1)
        yield row, min(end, rows)
        row = min(end, rows)


def word_spans(body: np.ndarray, gap: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of one piece of text: its runs without bytes of ``gap``."""
    inside = np.empty(len(body) + 2, dtype=bool)
    inside[0] = inside[-1] = False
    np.logical_not(gap[body], out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def _hash_piece(body: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    power, inverse = _tables(len(body) + 1)
    sums = np.zeros(len(body) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[body] * power[: len(body)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts])


_CLASS = np.full(256, 4, dtype=np.uint8)
_CLASS[SPACE] = 0
_CLASS[33:128] = 3
_CLASS[[ord("'"), ord("<")]] = 4
for _a, _b, _c in ("AZ1", "az1", "092"):
    _CLASS[ord(_a) : ord(_b) + 1] = int(_c)


def token_units(piece: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, starts, ends, simple) of parts of words that a splitter by letters, digits and others keeps apart.

    A word of ASCII and accented Latin letters, digits and marks falls into runs of letters, single
    digits and runs of marks; its hashes ignore the case of A-Z. A word with an apostrophe, ``<``
    or any other character stays whole, case counts, and it is not simple. No unit runs over a cut.
    """
    starts, ends = _cut_words(*word_spans(piece), cuts)
    if not len(starts):
        return np.empty(0, np.uint64), starts, ends, np.empty(0, bool)
    kind = _CLASS[piece]
    lead = np.flatnonzero(piece[:-1] == 0xC3)
    after = piece[lead + 1]
    lead = lead[(after >= 0x80) & (after <= 0xBF) & (after != 0x97) & (after != 0xB7)]
    kind[lead] = kind[lead + 1] = 1
    values = _BYTE[piece]
    odd = np.flatnonzero(kind == 4)
    if len(odd):
        whole = np.unique(np.searchsorted(starts, odd, side="right") - 1)
        inside = np.zeros(len(piece) + 1, np.int8)
        inside[starts[whole]] += 1
        inside[ends[whole]] -= 1
        inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
        kind[inside] = 4
        values[inside] = _EXACT[piece[inside]]
    begins = (kind != 0) & ((kind == 2) | np.concatenate([[True], kind[1:] != kind[:-1]]))
    begins[starts] = True
    first = np.flatnonzero(begins)
    # A unit ends where the next one begins, or at the end of its word.
    last = ends[np.searchsorted(starts, first, side="right") - 1]
    last[:-1] = np.minimum(last[:-1], first[1:])
    power, inverse = _tables(len(piece) + 1)
    sums = np.zeros(len(piece) + 1, dtype=np.uint64)
    np.cumsum(values * power[: len(piece)], out=sums[1:])
    return mix((sums[last] - sums[first]) * inverse[first]), first, last, kind[first] != 4


def _cut_words(starts: np.ndarray, ends: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A word that runs over a row border is two words: add the borders that lie inside words."""
    if len(cuts) and len(starts):
        at = np.searchsorted(starts, cuts, side="left") - 1
        inner = cuts[(at >= 0) & (cuts < ends[np.maximum(at, 0)]) & (cuts > starts[np.maximum(at, 0)])]
        if len(inner):
            inner = np.unique(inner)
            starts = np.sort(np.concatenate([starts, inner]))
            ends = np.sort(np.concatenate([ends, inner]))
    return starts, ends


def doc_words(body: np.ndarray, bounds: np.ndarray, gap: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes, index of the first word of each row plus the total) of consecutive texts.

    Texts are separated first, so words never join across rows. Long texts are hashed
    in pieces that end at a byte of ``gap``.
    """
    rows = len(bounds) - 1
    lo, hi = int(bounds[0]), int(bounds[-1])
    if rows == 1 and hi - lo > CHUNK_BYTES:
        parts, at = [], lo
        while at < hi:
            end = min(at + CHUNK_BYTES, hi)
            if end < hi:
                gaps = np.flatnonzero(gap[body[at:end]])
                if len(gaps):
                    end = at + int(gaps[-1]) + 1
                else:  # a single word longer than a piece: go on to its end
                    more = np.flatnonzero(gap[body[end:hi]])
                    end = end + int(more[0]) + 1 if len(more) else hi
            piece = body[at:end]
            s, e = word_spans(piece, gap)
            parts.append(_hash_piece(piece, s, e))
            at = end
        words = np.concatenate(parts) if parts else np.empty(0, np.uint64)
        return words, np.array([0, len(words)])
    piece = body[lo:hi]
    local = bounds - lo
    starts, ends = _cut_words(*word_spans(piece, gap), local[1:-1])
    words = _hash_piece(piece, starts, ends) if len(starts) else np.empty(0, np.uint64)
    return words, np.searchsorted(starts, local, side="left")


_STEP = [np.uint64(2 * int(x) + 1) for x in _rng.integers(1, 2**62, 8)]


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Distinct fingerprints, sorted, of the runs of ``width`` words; fewer words are one run."""
    n = len(words)
    if n == 0:
        return words
    size = min(width, n)
    total = np.full(n - size + 1, np.uint64(size), dtype=np.uint64)
    for k in range(size):
        total += words[k : n - size + 1 + k] * _STEP[k % 8]
    return np.unique(mix(total))


def byte_grams(piece: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """(codes, index of each word's first code) of the letters and digits of one text.

    The code of a byte holds it in its low 8 bits and the up to ``order`` - 1 bytes before it
    in the same word above; bytes before the word are 0. At most 7 bytes fit.
    """
    gap = NO_LETTER[piece]
    text = _LOWER[piece].astype(np.uint64)
    text[gap] = 0
    codes = text.copy()
    inside = ~gap
    for back in range(1, order):
        inside[back:] &= ~gap[:-back]
        inside[:back] = False
        earlier = np.zeros_like(text)
        earlier[back:] = text[:-back]
        earlier[~inside] = 0
        codes |= earlier << np.uint64(8 * back)
    kept = np.flatnonzero(~gap)
    first = np.ones(len(kept), dtype=bool)
    first[1:] = kept[1:] != kept[:-1] + 1
    return codes[kept], np.flatnonzero(first)


def text_pieces(body: np.ndarray, start: int, end: int, limit: int = CHUNK_BYTES, gap: np.ndarray = NO_LETTER) -> Iterator[np.ndarray]:
    """One text in pieces of bounded size that end between words; a longer word is cut."""
    while start < end:
        stop = min(start + limit, end)
        if stop < end:
            gaps = np.flatnonzero(gap[body[start:stop]])
            if len(gaps):
                stop = start + int(gaps[-1]) + 1
        yield body[start:stop]
        start = stop
