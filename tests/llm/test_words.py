"""Importance resampling, piece encoding and spelling variants against plain Python and the public library."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from sparkmart.llm import pieces, resampling, spelling
from sparkmart.llm.queries import piece_model_path

sentencepiece = pytest.importorskip("sentencepiece")

DOCS = "doc_id long, text string, lang string, source string, n_words int, ids int, word string, rank int"


def documents(spark, texts, ids=None):
    """Extra columns carry names that the operators use themselves."""
    rows = [(i, t, "en", "s", -1, -1, "w", -1) for i, t in zip(ids or range(len(texts)), texts)]
    return spark.createDataFrame(rows, DOCS)


# --- resampling ----------------------------------------------------------------------


def test_crcs_compose():
    r = random.Random(1)
    parts = [(r.randbytes(r.randint(0, 40)), r.randbytes(r.randint(0, 700))) for _ in range(300)]
    crc = lambda xs: np.array([zlib.crc32(x) for x in xs], np.uint32)
    a, b = zip(*parts)
    assert (resampling.compose(crc(a), crc(b), np.array([len(x) for x in b])) == crc([x + y for x, y in parts])).all()


def words_of(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)


def brute_resampling(docs, target, s):
    def features(text):
        w = words_of(text)
        return [" ".join(w[i : i + n]) for n in range(s.shortest, s.longest + 1) for i in range(len(w) - n + 1)]

    bucket = lambda f: zlib.crc32(f.encode()) % s.buckets
    count = [Counter(bucket(f) for t in texts for f in features(t)) for texts in ([t for _, t in docs], target)]
    total = [sum(c.values()) for c in count]
    gain = lambda b: math.floor(1000 * math.log((count[1][b] + 1) * (total[0] + s.buckets) / ((count[0][b] + 1) * (total[1] + s.buckets))))
    rows = []
    for i, text in docs:
        f = features(text)
        weight = sum(gain(bucket(x)) for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{s.seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(words_of(text)), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))])
    able = sorted((r for r in rows if r[1] >= s.min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    drawn = {id(r): k + 1 for k, r in enumerate(able[: s.percent * len(able) // 100])}
    return [(*r, drawn.get(id(r))) for r in rows]


@pytest.mark.parametrize("settings", [
    resampling.Resampling(),
    resampling.Resampling(1, 3, 50, min_words=2, percent=40),
    resampling.Resampling(2, 2, 97, min_words=0, percent=100, dictionary_words=3),
    resampling.Resampling(dictionary_words=0, percent=0),
])
def test_resampling_equals_plain_python(spark, settings):
    r = random.Random(7)
    vocabulary = ["Alpha", "beta", "ÄPFEL", "x1", "don't", "日本", "the", "q" * 90]
    texts = [" ".join(r.choice(vocabulary) + r.choice(["", ",", "\n", "--"]) for _ in range(r.randint(0, 60))) for _ in range(120)]
    texts += [None, "", " .,; ", texts[0], texts[0]]
    docs = list(zip([*range(len(texts) - 2), 3, None], texts))
    target = ["alpha beta the x1", None, "the beta 日本"]
    frame = documents(spark, texts, [i for i, _ in docs]).repartition(3)
    got = resampling.resample(frame, spark.createDataFrame([(t,) for t in target], "text string"), settings)
    order = lambda rows: sorted(map(tuple, rows), key=str)
    columns = ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert order(got.select(columns).collect()) == order(brute_resampling(docs, target, settings))


def test_long_texts_are_scanned_whole(spark, monkeypatch):
    monkeypatch.setattr(resampling, "CHUNK_BYTES", 64)
    scanner = resampling.Scanner(["word", "x"])
    long = ("word x" + "y" * 300 + " Word,other x ") * 20
    blocks = list(scanner.rows(t.encode().translate(resampling._PLAIN) for t in ["x", long, "", "word word"]))
    got = [(first + row, crc) for first, _, crcs, _, rows in blocks for crc, row in zip(crcs.tolist(), rows.tolist())]
    want = [(k, zlib.crc32(w.encode())) for k, t in enumerate(["x", long, "", "word word"]) for w in words_of(t)]
    assert got == want


def test_empty_tables_for_resampling(spark):
    docs = documents(spark, ["a b"])
    assert resampling.resample(docs.limit(0), docs).collect() == []
    assert [tuple(r) for r in resampling.resample(docs, docs.limit(0)).select("n_features", "rank").collect()] == [(2, None)]


# --- pieces --------------------------------------------------------------------------


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=piece_model_path())


def odd_texts():
    r = random.Random(3)
    soup = ["a", "b", " ", "c▁", "\n\t", "é", "日本", "€", "😀", "x", "the ", "ing", "\x00", "    ", "ﬁ", "क्षि"]
    texts = ["".join(r.choice(soup) for _ in range(r.randint(0, 50))) for _ in range(3000)]
    return [*texts, None, "", " ", "▁", "  lead", "日本語" * 2000, "a" * 5000, " " * 3000, "the" * 3000, "<s> </s> <0x41> ⁇"]


def test_ids_and_texts_equal_the_library(spark, library):
    texts = odd_texts()
    encoded = pieces.encode_texts(documents(spark, texts), piece_model_path())
    decoded = pieces.decode_ids(encoded, piece_model_path())
    assert encoded.columns == ["doc_id", "ids"] and decoded.columns == ["doc_id", "ids", "text"]
    got = {r["doc_id"]: (r["ids"], r["text"]) for r in decoded.collect()}
    for i, text in enumerate(texts):
        ids = library.encode(text or "", add_eos=True)
        assert got[i] == (ids, library.decode(ids))
    bare = pieces.encode_texts(documents(spark, ["", "a"]), piece_model_path(), end=False).orderBy("doc_id").collect()
    assert [r["ids"] for r in bare] == [[], library.encode("a")]


def test_any_ids_decode_as_the_library_does(library):
    model = pieces._model(pieces.read_model(piece_model_path()))
    r = random.Random(5)
    for _ in range(4000):
        ids = [r.choice([0, 1, 2, 259, 260, r.randrange(3, 259), r.randrange(32000), 3 + 0xE6, 3 + 0x97]) for _ in range(r.randint(0, 7))]
        assert model.decode(np.array(ids, np.int32)) == library.decode(ids)
    with pytest.raises(ValueError):
        model.decode(np.array([32000]))


def test_backtracking_and_what_a_model_must_be(library):
    """Without cuts at spaces a text is one part; the rule applied to whole words gives the same."""
    model = pieces.PieceModel(pieces.read_model(piece_model_path()))
    assert model.parts.findall(" the.\nA1, b  c ") == [" the", ".\n", "A1,", " b", "  c", " "]
    model.parts = None
    for text in odd_texts()[:400]:
        assert model.encode(text or "").tolist() == library.encode(text or "", add_eos=True)
    for word in ("▁importance", "▁resampling", "ationally", "aaaaaaa"):
        assert [model.text(t) for t in model.encode_part(word)] == model.merge(word)
    with pytest.raises(ValueError):
        pieces.PieceModel(b"\x12\x02\x18\x01")


def test_piece_query_equals_the_library(spark, library):
    from __spark_entry__ import queries

    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: tuple(r)[1:] for r in queries()["op12_pieces"](spark, sf).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()}
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = library.encode(r["text"] or "", add_eos=True)
        assert got[r["doc_id"]] == (len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids)))


def test_empty_table_for_pieces(spark):
    docs = documents(spark, ["a"]).limit(0)
    assert pieces.decode_ids(pieces.encode_texts(docs, piece_model_path()), piece_model_path()).collect() == []


# --- spelling ------------------------------------------------------------------------


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_spelling(docs, s):
    counts = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if s.slip and h % s.slip == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= s.min_length:
                counts[run] += 1
    counts = {w: n for w, n in counts.items() if n >= s.min_count}
    rows, form = {}, {}
    for w, n in counts.items():
        found = sorted((-m, v) for v, m in counts.items() if near(w, v))
        good = found and -found[0][0] >= s.ratio * n
        form[w] = found[0][1] if good else None
        rows[w] = [form[w], n, len(found), -found[0][0] if good else None]
    for w, row in rows.items():
        root = w
        while form[root] is not None:
            root = form[root]
        row.insert(1, root)
    return {w: tuple(r) for w, r in rows.items()}


@pytest.mark.parametrize("settings", [spelling.Spelling(slip=3), spelling.Spelling(5, 1, 2), spelling.Spelling(4, 1, 3, slip=2)])
def test_spelling_equals_plain_python(spark, settings):
    r = random.Random(11)
    letters = "abcÉé÷"
    base = ["".join(r.choice(letters) for _ in range(r.randint(4, 13))) for _ in range(15)]
    base += ["aaaaaaaaa", "ababababab", "Straßenbahn", "x" * 400]

    def word():
        w = base[min(int(r.expovariate(0.3)), len(base) - 1)]
        for _ in range(r.choice([0, 0, 0, 0, 1, 2])):
            at = r.randrange(len(w))
            w = r.choice([w[:at] + w[at + 1 :], w[:at] + r.choice(letters) + w[at:], w[:at] + r.choice(letters) + w[at + 1 :]]) or "a"
        return w

    texts = [" ".join(word() for _ in range(r.randint(0, 40))) for _ in range(150)] + [None, "", "1 2 ,", "same words " * 5]
    docs = list(zip([*range(len(texts) - 1), None], texts))
    frame = documents(spark, texts, [i for i, _ in docs]).repartition(3)
    got = spelling.spelling_variants(frame, settings)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = brute_spelling(docs, settings)
    assert {row[0]: tuple(row)[1:] for row in got.collect()} == want
    assert any(v[0] for v in want.values())
    assert settings.ratio > 3 or any(v[0] and v[1] != v[0] for v in want.values())  # chains


def test_pivots_are_the_cheapest_disjoint_pair():
    r = random.Random(2)
    for _ in range(300):
        word = "".join(r.choice("abc") for _ in range(r.randint(4, 12)))
        grams = sorted({word[i : i + 2] for i in range(len(word) - 1)}, key=lambda g: (r.random(), g))
        order = {g: (k, r.randint(1, 9)) for k, g in enumerate(grams)}
        places = spelling.prefix_grams(word, order)
        chosen = spelling.pivots(word, places, order)
        cost = lambda ps: sum(order[word[p : p + 2]][1] for p in ps)
        assert chosen[1] - chosen[0] >= 2 and cost(chosen) == min(cost((a, b)) for a in places for b in places if b - a >= 2)


def test_no_words_and_bad_settings(spark):
    docs = documents(spark, [None, "", "short one"])
    assert spelling.spelling_variants(docs).collect() == [] and spelling.spelling_variants(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        spelling.spelling_variants(docs, spelling.Spelling(min_length=3))
