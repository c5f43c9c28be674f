"""Token ids of whole texts by a public tokenizer that never joins across white space.

Words between ASCII white space, and the letters, digits and marks of simple words, are encoded
apart and remembered per worker, so a frequent one is encoded once. This equals encoding the
text as a whole for tokenizers that lower-case, drop white space and split runs of letters,
single digits and runs of marks, as ``word_bpe_49k.json`` does.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import repeat

import numpy as np

from sparkmart.llm.textbytes import CHUNK_BYTES, SPACE, token_units

REMEMBERED_WORDS = 400_000


class WordTokens:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self.known: dict[int, int] = {}
        self.at = np.zeros(1, np.int64)
        self.size = np.zeros(1, np.int64)
        self.flat = np.empty(0, np.uint32)

    def _encode_simple(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, sizes) of units that are one run each: its last id is one that ends a run."""
        texts = [" ".join(units[i : i + 500]) for i in range(0, len(units), 500)]
        ids = np.concatenate([np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)])
        last = np.flatnonzero(self.closes[ids]) + 1
        if len(last) != len(units) or last[-1] != len(ids):
            return self._encode_each(units)
        return ids, np.diff(last, prepend=0)

    def _encode_each(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        encoded = [e.ids for e in self.tokenizer.encode_batch_fast(units, add_special_tokens=False)]
        size = np.fromiter(map(len, encoded), np.int64, len(encoded))
        return np.fromiter((i for e in encoded for i in e), np.uint32, int(size.sum())), size

    def _learn(self, hashes: list[int], units: list[str], simple: np.ndarray) -> None:
        for encode, some in ((self._encode_simple, np.flatnonzero(simple)), (self._encode_each, np.flatnonzero(~simple))):
            if not len(some):
                continue
            ids, size = encode([units[i] for i in some])
            n = len(self.known)
            at = len(self.flat) + np.concatenate([[0], np.cumsum(size)[:-1]])
            self.flat = np.concatenate([self.flat, ids])
            self.at = np.concatenate([self.at[:n], at])
            self.size = np.concatenate([self.size[:n], size])
            self.known.update(zip([hashes[i] for i in some], range(n, n + len(some))))

    def encode(self, piece: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, index of the first id of each row plus the total) for texts cut at ``cuts``."""
        hashes, starts, ends, simple = token_units(piece, cuts)
        if not len(hashes):
            return np.empty(0, np.uint32), np.zeros(len(cuts) + 2, np.int64)
        if len(self.known) > REMEMBERED_WORDS:
            self._forget()
        kinds, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        listed = kinds.tolist()
        index = np.fromiter(map(self.known.get, listed, repeat(-1)), np.int64, len(listed))
        new = np.flatnonzero(index < 0)
        if len(new):
            data = piece.tobytes()
            spans = zip(starts[first[new]].tolist(), ends[first[new]].tolist())
            fresh = [listed[i] for i in new]
            self._learn(fresh, [data[s:e].decode("utf-8", "replace") for s, e in spans], simple[first[new]])
            index[new] = np.fromiter(map(self.known.get, fresh), np.int64, len(fresh))
        word = index[which]
        size = self.size[word]
        until = np.cumsum(size)
        places = np.repeat(self.at[word] - until + size, size) + np.arange(until[-1])
        row_words = np.searchsorted(starts, np.concatenate([[0], cuts, [len(piece)]]), side="left")
        return self.flat[places], np.concatenate([[0], until])[row_words]


def word_pieces(body: np.ndarray, start: int, end: int) -> Iterator[np.ndarray]:
    """One text in pieces that end at white space; a single longer word stays whole."""
    while start < end:
        stop = min(start + CHUNK_BYTES, end)
        if stop < end:
            gaps = np.flatnonzero(SPACE[body[start:stop]])
            if len(gaps):
                stop = start + int(gaps[-1]) + 1
            else:
                more = np.flatnonzero(SPACE[body[stop:end]])
                stop = stop + int(more[0]) + 1 if len(more) else end
        yield body[start:stop]
        start = stop
