"""SentencePiece encoding and decoding of whole texts, exact for models of merge type.

A merge-type model joins, again and again, the neighbours whose union has the best score. A sequence
of pieces is what this gives if, and only if, each two neighbours alone are left apart: joining within
a piece never depends on what lies beyond its neighbours. So a text is encoded from left to right:
an Aho-Corasick automaton over all pieces gives the longest one at each place; a piece that, merged anew
together with the piece before it, does not come back as these two is swapped for its next shorter prefix;
where no prefix is left the place is marked as failed in a bit field, and the piece before it is
shortened. A prefix of a text has one encoding only, so a failed place never has to be tried again.

A text is cut before spaces, and between letters and marks, when no piece of the model holds such a pair of
characters; equal parts are encoded once per worker. The work is linear in the text, whatever its form.

Models: merge type with the identity normaliser, a leading space, and bytes for unknown characters, without
pieces of the user's own. Any other model raises ``ValueError``.

Defined results: a null text is an empty one; an empty text has the end id only, if asked for; a text that
repeats gives the same ids; very long texts and very long words are encoded whole. Null ids decode to an empty
text, ids outside the vocabulary raise. Other columns, whatever their names, are passed by.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import arrow_schema, prepare, text_of

SPACE = "▁"
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
#: Parts of a text up to this many characters are remembered by workers, and so many of them.
REMEMBERED_CHARS, REMEMBERED_PARTS = 48, 400_000
REMEMBERED_PAIRS = 2_000_000
#: Tokens lie between -0x110000 and the size of the vocabulary, so this keeps pairs of them apart.
PAIR, START = 0x400000, -0x200000


def wire_fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of the fields of one protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            value: object = varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            value = data[at : at + size]
            at += size
        yield key >> 3, value


class _Remembered(dict):
    """What short parts came to. When full, the older half of what is known goes, but for what was asked for again."""

    def __init__(self, make):
        self.make, self.older = make, {}

    def __missing__(self, part: str) -> bytes:
        known = self.older.get(part)
        if known is None:
            known = self.make(part)
        if len(part) <= REMEMBERED_CHARS:
            if len(self) >= REMEMBERED_PARTS // 2:
                self.older = dict(self)
                self.clear()
            self[part] = known
        return known


class PieceModel:
    """Pieces, scores and kinds of a model file, with its encoder and decoder."""

    def __init__(self, data: bytes):
        self.pieces: list[str] = []
        self.kinds: list[int] = []
        scores: list[float] = []
        trainer: dict[int, object] = {}
        normaliser: dict[int, object] = {}
        for number, value in wire_fields(data):
            if number == 1:
                piece = dict(wire_fields(value))
                self.pieces.append(piece[1].decode())
                scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                self.kinds.append(piece.get(3, NORMAL))
            elif number == 2:
                trainer = dict(wire_fields(value))
            elif number == 3:
                normaliser = dict(wire_fields(value))
        if trainer.get(3) != 2 or not trainer.get(35) or trainer.get(24):
            raise ValueError("only models of merge type with bytes for unknown characters are read")
        plain = not normaliser.get(2) and normaliser.get(3, 1) and not normaliser.get(4, 1) and normaliser.get(5, 1)
        if not plain or set(self.kinds) - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("only the identity normaliser with a leading space and no pieces of the user's own are read")
        self.end = self.pieces.index(trainer[47].decode() if 47 in trainer else "</s>")
        self.unknown_text = trainer[44].decode() if 44 in trainer else " ⁇ "
        self.byte_ids = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == BYTE}
        self.ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == NORMAL}
        self.score = {p: scores[i] for p, i in self.ids.items()}
        self.parts = self._part_pattern()
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for piece, i in self.ids.items():
            self.automaton.add_word(piece, i)
        self.automaton.make_automaton()
        self.widths = [len(p) for p in self.pieces]
        self.next_shorter = [self._shorter(p) if k == NORMAL else None for p, k in zip(self.pieces, self.kinds)]
        self._pairs: dict[int, bool] = {}
        self._parts = _Remembered(self._part_bytes)
        self._decoder()

    def _part_pattern(self) -> re.Pattern | None:
        """Where texts may be cut: no piece spans the two characters, so no merge ever joins them.

        A cut lies before spaces that follow another character, and, for the marks that no piece holds beside a
        letter, between letters and marks. A word with anything else in it stays whole.
        """
        pairs = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        if any(a != SPACE and b == SPACE for a, b in pairs):
            return None
        letter = re.compile(f"[{LETTERS}]")
        beside = {m for a, b in pairs for m, other in ((a, b), (b, a)) if letter.match(other)}
        marks = "".join(re.escape(c) for c in map(chr, range(128)) if c != " " and not c.isalnum() and c not in beside)
        if not marks:
            return re.compile(" +[^ ]*|[^ ]+")
        return re.compile(f" *+[{LETTERS}]++(?=[{marks} ]|\\Z)| *+[{marks}]++(?=[{LETTERS} ]|\\Z)| ++[^ ]*+|[^ ]++")

    # --- encoding: a token is an id, or -1 - c for a character c without a piece ------

    def text(self, token: int) -> str:
        return self.pieces[token] if token >= 0 else chr(-1 - token)

    def merge(self, text: str) -> list[str]:
        """The rule itself: join the pair of best score, the first of equals, until none is left."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.score.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _settle(self, before: int, token: int) -> bool:
        """Whether merging the two texts anew gives the two back; after ``START``, the one."""
        right = self.text(token)
        if before == START:
            known = self.merge(right) == [right]
        else:
            left = self.text(before)
            known = self.merge(left + right) == [left, right]
        if len(self._pairs) >= REMEMBERED_PAIRS:
            self._pairs.clear()
        self._pairs[before * PAIR + token] = known
        return known

    def _shorter(self, piece: str) -> int | None:
        """The next shorter piece that starts the same way; at last the first character alone."""
        for size in range(len(piece) - 1, 0, -1):
            if piece[:size] in self.ids:
                return self.ids[piece[:size]]
        return None if len(piece) == 1 else -1 - ord(piece[0])

    def encode_part(self, text: str) -> list[int]:
        """Tokens of a text in which spaces are already written as pieces hold them."""
        widths, shorter, pairs = self.widths, self.next_shorter, self._pairs
        size = len(text)
        longest: list[int | None] = [None] * size
        for stop, i in self.automaton.iter(text):
            longest[stop + 1 - widths[i]] = i  # matches come by their ends: the last is the longest
        failed = bytearray(size // 8 + 1)
        tokens: list[int] = []
        at, before = 0, START
        token = longest[0] if size else None
        while at < size:
            if token is None:
                token = -1 - ord(text[at])
            while token is not None:
                stop = at + (widths[token] if token >= 0 else 1)
                if not failed[stop >> 3] >> (stop & 7) & 1:
                    fits = pairs.get(before * PAIR + token)
                    if self._settle(before, token) if fits is None else fits:
                        break
                token = shorter[token] if token >= 0 else None
            while token is None:  # nothing fits here: the place fails, and the piece before it is shortened
                failed[at >> 3] |= 1 << (at & 7)
                if not tokens:
                    raise ValueError("the scores of this model contradict each other")
                last = tokens.pop()
                before = tokens[-1] if tokens else START
                at -= widths[last] if last >= 0 else 1
                token = shorter[last] if last >= 0 else None
                stop = at
            if stop > at:
                tokens.append(token)
                before, at = token, stop
                token = longest[at] if at < size else None
        return tokens

    def _part_bytes(self, part: str) -> bytes:
        """The ids of one part, as 32-bit numbers."""
        out: list[int] = []
        for token in self.encode_part(part.replace(" ", SPACE)):
            if token >= 0:
                out.append(token)
            else:
                out.extend(self.byte_ids[b] for b in chr(-1 - token).encode())
        return np.array(out, np.int32).tobytes()

    def encode(self, text: str, end: bool = True) -> np.ndarray:
        """Ids of one text."""
        tail = np.array([self.end] if end else [], np.int32).tobytes()
        parts: list[str] = []
        if text:
            text = " " + text.replace(SPACE, " ")
            parts = self.parts.findall(text) if self.parts else [text]
        return np.frombuffer(b"".join(map(self._parts.__getitem__, parts)) + tail, np.int32)

    # --- decoding ---------------------------------------------------------------

    def _decoder(self) -> None:
        """The bytes of all pieces behind each other, and where each one starts."""
        forms = []
        for piece, kind in zip(self.pieces, self.kinds):
            if kind == BYTE:
                forms.append(bytes([int(piece[3:5], 16)]))
            elif kind == CONTROL:
                forms.append(b"")
            else:
                forms.append((self.unknown_text if kind == UNKNOWN else piece.replace(SPACE, " ")).encode())
        self.sizes = np.array([len(f) for f in forms], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(forms), np.uint8)
        self.is_byte = np.array([k == BYTE for k in self.kinds])
        self.opens = np.array([k == NORMAL and p.startswith(SPACE) for p, k in zip(self.pieces, self.kinds)])

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: bytes that are no character become U+FFFD one by one, the leading space goes."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.pieces)):
            raise ValueError("an id outside the vocabulary")
        visible = self.sizes[ids] > 0
        shown = ids[visible]
        if not len(shown):
            return ""
        size = self.sizes[shown]
        until = np.cumsum(size)
        data = self.flat[np.repeat(self.starts[shown] - until + size, size) + np.arange(until[-1])].tobytes()
        # Bytes on the two sides of a control piece never form one character.
        gaps = np.flatnonzero(np.diff(np.flatnonzero(visible)) > 1)
        gaps = gaps[self.is_byte[shown[gaps]] & self.is_byte[shown[gaps + 1]]]
        cuts = [int(self.opens[shown[0]]), *until[gaps].tolist(), len(data)]
        return "".join(data[a:b].decode("utf-8", "each-byte") for a, b in zip(cuts[:-1], cuts[1:]))


def _each_byte(error: UnicodeError) -> tuple[str, int]:
    return "�", error.start + 1


_MODELS: dict[int, tuple[bytes, PieceModel]] = {}


def _model(data: bytes) -> PieceModel:
    """One model per worker and file."""
    import codecs

    codecs.register_error("each-byte", _each_byte)
    kept = _MODELS.get(len(data))
    if kept is None or kept[0] != data:
        kept = _MODELS[len(data)] = (data, PieceModel(data))
    return kept[1]


def read_model(path: str) -> bytes:
    """A model file of the driver; its bytes (a fixed file of at most some MB) go to the tasks."""
    with open(path, "rb") as file:
        data = file.read()
    _model(data)  # a model that cannot be read fails here, not in a task
    return data


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)))


def encode_texts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end: bool = True) -> DataFrame:
    """(doc_id, ids): the ids of each whole text, with the end id behind them if ``end``."""
    prepare(docs.sparkSession)
    data = docs.sparkSession.sparkContext.broadcast(read_model(path))
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(F.col(text_col)).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    ddl = f"doc_id {kind}, ids array<int>"
    schema = arrow_schema(ddl)

    def encode(batches):
        model = _model(data.value)
        for batch in batches:
            ids = [model.encode(text, end) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), _lists(ids)], schema=schema)

    return rows.mapInArrow(encode, ddl)


def decode_ids(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, ids, text): the text that each list of ids stands for."""
    prepare(encoded.sparkSession)
    data = encoded.sparkSession.sparkContext.broadcast(read_model(path))
    rows = encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    ddl = f"doc_id {kind}, ids array<int>, text string"
    schema = arrow_schema(ddl)

    def decode(batches):
        model = _model(data.value)
        for batch in batches:
            lists = batch.column("ids")
            offsets, flat = lists.offsets.to_numpy(), np.asarray(lists.values)
            texts = [model.decode(flat[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists, pa.array(texts, pa.string())], schema=schema)

    return rows.mapInArrow(decode, ddl)
