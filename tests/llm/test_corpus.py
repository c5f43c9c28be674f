"""Mixing, packing, neighbours and the whole pipeline."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sparkmart.llm import hash_forest, mixing, packing
from sparkmart.llm.queries import tokenizer_path
from tests.llm.test_dedup import brute

tokenizers = pytest.importorskip("tokenizers")


# --- mixing ----------------------------------------------------------------------


def test_raked_tokens_meet_the_targets():
    cells = [(s, l) for s in ("a", "b", "*") for l in ("x", "*")]
    tokens = np.array([900.0, 100.0, 300.0, 300.0, 200.0, 200.0])
    mixture = mixing.Mixture({"s": {"a": 1, "b": 1, "*": 1}, "l": {"x": 3, "*": 2}}, keep=0.4)
    p = mixing.rake(tokens, cells, mixture)
    share = p * tokens / (p * tokens).sum()
    assert (p <= 1).all() and (p * tokens).sum() == pytest.approx(0.4 * tokens.sum())
    for name in ("a", "b", "*"):
        assert sum(x for x, c in zip(share, cells) if c[0] == name) == pytest.approx(1 / 3, abs=1e-6)
    assert sum(x for x, c in zip(share, cells) if c[1] == "x") == pytest.approx(0.6, abs=1e-6)


def test_mixing_report_and_documents_agree(spark):
    rng = random.Random(3)
    rows = [(i, "w " * rng.randint(0, 60), rng.choice(["en", "de", None]), "big" if i % 3 else rng.choice(["s1", "s2"]), 1) for i in range(900)]
    rows += [(None, "x y z", "en", "big", 1), (5, None, "en", "big", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, tokens int")
    columns = {"source": F.col("source"), "lang": F.col("lang")}
    mixture = mixing.Mixture({"source": {"big": 1, "*": 2}, "lang": {"en": 1, "de": 1, "*": 1}}, keep=0.3)
    report = mixing.mixing_report(docs, columns, mixture).collect()
    counts = {i: len((t or "").split()) for i, t, *_ in rows if i != 5}
    assert len(report) == len(rows) and all(r["tokens"] == counts[r["doc_id"]] for r in report if r["doc_id"] != 5)
    cells = {}
    for r in report:
        key = (r["source"] if r["source"] == "big" else "*", r["lang"] or "*")
        cells.setdefault(key, [0, r["probability"]])[0] += r["tokens"]
        assert cells[key][1] == r["probability"]
    total = sum(n for n, _ in cells.values())
    expected = {k: n * p for k, (n, p) in cells.items()}
    assert sum(expected.values()) == pytest.approx(0.3 * total)
    assert sum(v for k, v in expected.items() if k[0] == "big") == pytest.approx(0.1 * total, rel=1e-6)
    kept = mixing.mix_documents(docs, columns, mixture)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(r["doc_id"]) for r in report if r["kept"])
    assert mixing.mixing_report(docs.limit(0), columns, mixture).collect() == []


# --- packing ---------------------------------------------------------------------


def packed(rows):
    return [r.asDict() for r in rows.collect()]


def ids_of(text):
    t = tokenizers.Tokenizer.from_file(tokenizer_path())
    return t.encode(text or "", add_special_tokens=False).ids + [1]


TEXTS = [
    "Don't stop, it's 1,234 o'clock.", "éÀ×÷ç—dash", "<|endoftext|> and <|ENDOFTEXT|>", "", None, " \u0085\u00a0 x", "T\u0308t\u0308 ﬁ½ İΣς 日本語 😀", "a" * 9000,
    "word " * 5000, "ok\x1cgo\x0bnow", "The\tend\r\nof 'S 's",
]


def test_packing_round_trip(spark):
    rng = random.Random(8)
    texts = TEXTS + ["".join(rng.choice("ab é,.<|>'1 \n") for _ in range(rng.randint(0, 400))) for _ in range(150)]
    rows = [(i, t, 9) for i, t in enumerate(texts)] + [(None, "no id here", 9), (3, "same id", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, offset int")
    out = packed(packing.pack_documents(docs, tokenizer_path(), packing.Packing(capacity=64, shard=50)))
    want = {}
    for i, t, _ in rows:
        ids = ids_of(t)
        for k in range(0, len(ids), 64):
            part = np.array(ids[k : k + 64], "<u4")
            want.setdefault((i, k // 64, k, len(part), zlib.crc32(part.tobytes())), 0)
            want[i, k // 64, k, len(part), zlib.crc32(part.tobytes())] += 1
    got = {}
    for r in out:
        key = (r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])
        got[key] = got.get(key, 0) + 1
    assert got == want
    filled = {}
    for r in out:
        filled.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    bound = -(-sum(r["length"] for r in out) // 64)
    assert len(filled) <= bound * 1.03 + 2
    assert packed(packing.pack_documents(docs.limit(0), tokenizer_path())) == []


def test_genetic_algorithm_improves_on_best_fit():
    # Triples fill a bin exactly; best fit decreasing alone misses some.
    rng = np.random.default_rng(2)
    size = []
    for _ in range(60):
        a, b = sorted(rng.integers(200, 450, 2).tolist())
        size += [a, b, 1000 - a - b]
    p = packing.Packing(capacity=1000, children=200, population=6)
    plain = packing.best_fit([], list(range(len(size))), size, 1000)
    best = packing.evolve(size, [], p, 1)
    assert sorted(i for b in best for i in b) == list(range(len(size)))
    assert all(sum(size[i] for i in b) <= 1000 for b in best)
    assert packing.fewest(size, 1000) == 60 <= len(best) <= len(plain)
    child = packing.cross(plain, best, size, 1000, rng)
    assert sorted(i for b in child for i in b) == list(range(len(size)))


def test_bound_with_large_pieces():
    assert packing.fewest([600, 600, 600, 300], 1000) == 3
    assert packing.fewest([], 1000) == 0


# --- neighbours ------------------------------------------------------------------


def vectors(n=700, size=16, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, size))
    x[: n // 3] = x[0] + 0.02 * rng.normal(size=(n // 3, size))
    x[n // 3 : n // 3 + 60] = x[n // 3]
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def exact(x, ids, query, k):
    score = (x.astype(np.float64) * x[query].astype(np.float64)).sum(axis=1)
    order = [i for i in np.lexsort((ids, -score)) if i != query][:k]
    return [(int(ids[i]), float(score[i])) for i in order]


def test_neighbours_against_brute_force(spark):
    x = vectors()
    rows = [(i, [float(c) for c in v], 1) for i, v in enumerate(x)]
    bad = [(9000, None, 1), (9020, [0.0] * 16, 1), (9040, [float("nan")] * 16, 1), (9060, [1.0, None] + [0.0] * 14, 1), (9080, [1.0], 1), (9100, [float("inf")] * 16, 1), (None, [1.0] * 16, 1)]
    table = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>, rank int")
    # Small blocks and few candidates, so that all levels and splits are used.
    p = hash_forest.Forest(trees=12, axes=6, candidates=900, block=64, cluster_members=20, nearest=10)
    out = hash_forest.nearest_neighbours(table, table.where("vec_id % 20 = 0"), p).collect()
    got = {}
    for r in sorted(out, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert set(got) == set(range(0, 700, 20))
    found = 0
    for q, near in got.items():
        want = exact(x, np.arange(len(x)), q, 10)
        assert len(near) == 10
        found += len({i for i, _ in want} & {i for i, _ in near})
        for i, score in near:
            assert score == pytest.approx(float(x[i].astype(np.float64) @ x[q].astype(np.float64)), abs=1e-12)
    assert found / (10 * len(got)) >= 0.9
    # A group of copies: the smallest ids win, and the query itself is left out.
    first = 700 // 3
    copy = next(q for q in got if first <= q < first + 60)
    assert [i for i, _ in got[copy]] == [i for i in range(first, first + 60) if i != copy][:10]


def test_few_vectors_are_all_found(spark):
    table = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 2.0]), (2, [3.0, 1.0])], "vec_id long, embedding array<double>")
    out = [tuple(r) for r in hash_forest.nearest_neighbours(table, table.where("vec_id = 0")).orderBy("rank").collect()]
    assert out == [(0, 1, 2, 3.0), (0, 2, 1, 0.0)]
    assert hash_forest.nearest_neighbours(table.limit(0), table.limit(0)).collect() == []


def found_share(spark, x, asked, p):
    """Recall of each asked id against brute force."""
    table = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in hash_forest.nearest_neighbours(table, table.where(F.col("vec_id").isin(asked)), p).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    ids = np.arange(len(x))
    return np.array([len({i for i, _ in exact(x, ids, q, p.nearest)} & got[q]) / p.nearest for q in asked])


def test_recall_does_not_fall_where_a_digit_holds_enough(spark):
    # Twice as many vectors as let two digits of all trees hold the fewest candidates.
    x = np.random.default_rng(4).normal(size=(6000, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    p = hash_forest.Forest(trees=8, axes=6, candidates=150, block=512, nearest=10)
    assert found_share(spark, x, list(range(0, 6000, 60)), p).mean() >= 0.93


def test_queries_at_the_edge_of_a_cluster_see_both_sides(spark):
    rng = np.random.default_rng(5)
    unit = lambda v: v / np.linalg.norm(v, axis=-1, keepdims=True)
    x = unit(rng.normal(size=(3000, 24)))
    centre = unit(rng.normal(size=24))
    away = rng.normal(size=(3000, 24))
    away = unit(away - np.outer(away @ centre, centre))
    cosine = np.concatenate([rng.uniform(0.9, 1.0, 1500), rng.uniform(0.7, 0.9, 1500)])
    x = np.concatenate([x, cosine[:, None] * centre + np.sqrt(1 - cosine**2)[:, None] * away])
    p = hash_forest.Forest(trees=8, axes=6, candidates=600, block=512, nearest=10)
    asked = [i + 3000 for i in np.flatnonzero((cosine > 0.74) & (cosine < 0.84))[::6].tolist()]
    share = found_share(spark, x, asked, p)
    assert share.mean() >= 0.93 and share.min() >= 0.5


def test_clusters_of_short_vectors_are_found(spark):
    rng = np.random.default_rng(6)
    unit = lambda v: v / np.linalg.norm(v, axis=-1, keepdims=True)
    x = np.concatenate([unit(rng.normal(size=(2500, 24))), 0.6 * unit(unit(rng.normal(size=24)) + 0.08 * rng.normal(size=(1500, 24)))])
    p = hash_forest.Forest(trees=8, axes=6, candidates=600, block=512, nearest=10)
    share = found_share(spark, x, list(range(2500, 4000, 25)), p)
    assert share.mean() >= 0.93 and share.min() >= 0.5


# --- pipeline --------------------------------------------------------------------


def test_pipeline_stages_against_plain_python(spark, tmp_path):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice(["ta", "ro", "mi", "sen", "ka"]) for _ in range(rng.randint(1, 4)))
    rows, labels = [], []
    for i in range(260):
        words = [word() for _ in range(rng.randint(30, 60))]
        toxic = i % 4 == 0
        if toxic:
            words[3:3] = ["vexor", "drikkum", "vexor", "drikkes", "vexum"]
        rows.append((i, " ".join(words), "en", f"src{i % 3}", 0))
        labels.append((i, 1, int(toxic)))
    rows += [(1000 + i, rows[i][1], "de", "src0", 0) for i in range(1, 60, 2)]
    rows += [(2000 + i, rows[i][1] + " extra", "de", "src0", 0) for i in range(1, 60, 6)]
    rows += [(3000, None, None, None, 0), (3001, "", "en", "src0", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    sf, columns = str(tmp_path), docs.columns

    def texts(df):
        return {r["doc_id"]: r["text"] for r in df.collect()}

    after = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == columns
        after[name] = texts(docs)
    bad = {i for i, t, *_ in rows if t and "vexor" in t}
    assert set(after["toxicity"]) == {i for i, *_ in rows} - bad
    last = {}
    for i, t in after["toxicity"].items():
        last[t or ""] = max(i, last.get(t or "", -1))
    assert set(after["exact_dedup"]) == set(last.values())
    near = brute(list(after["exact_dedup"].items()), 80)
    assert set(after["near_dedup"]) == {i for i, (_, _, kept) in near.items() if kept}
    assert set(after["mixing"]) <= set(after["near_dedup"]) and len(after["mixing"]) > 0.4 * len(after["near_dedup"])
    out = corpus_pipeline.run(spark, sf).collect()
    assert {r["doc_id"] for r in out} == set(after["mixing"])
    assert sum(r["length"] for r in out) == sum(len(ids_of(t)) for t in after["mixing"].values())


def test_pipeline_decides_on_rows_not_ids(spark):
    rng = random.Random(9)
    text = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(60))
    a, b, c, d, e, f, g = (text() for _ in range(7))
    rows = [
        (5, a, "x"), (5, b, "x"), (9, b, "x"),  # the unique text a of id 5 stays, b stays with id 9
        (None, b, "x"), (None, c, "x"), (None, c, "y"),  # copies without an id go; one c stays
        (7, d, "y"), (7, d, "x"), (7, d, "x"),  # id and text repeated: one stays
        (11, e, "x"), (11, f, "x"), (3, f + " more", "x"),  # f is a near copy of id 3, e is not
        (None, g, "x"), (None, g + " more", "x"), (None, e + " more", "x"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = corpus_pipeline.exact_dedup(spark, docs, "")
    assert out.columns == docs.columns
    exact = sorted(((r["doc_id"], r["text"], r["lang"]) for r in out.collect()), key=str)
    assert exact == sorted([(5, a, "x"), (9, b, "x"), (None, c, "x"), (7, d, "x"), *rows[9:]], key=str)
    out = corpus_pipeline.near_dedup(spark, out, "")
    near = [(r["doc_id"], r["text"]) for r in out.collect()]
    assert out.columns == docs.columns
    for row in [(5, a), (9, b), (None, c), (7, d)]:
        assert near.count(row) == 1
    for one in (e, f, g):
        assert len([t for _, t in near if t.startswith(one)]) == 1
    assert len(near) == 7
    assert (11, e) in near


@pytest.mark.parametrize("big", [2**63 - 1, 40])
def test_stages_leave_names_and_large_ids_alone(spark, tmp_path, big):
    """Users' columns may be called what a stage calls its own, and ids may fill the range."""
    rng = random.Random(4)
    texts = [" ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(60)) for _ in range(8)]
    clash = ["__id", "__digest", "__row", "__number", "__own", "__p", "__draw", "__cell_0", "n", "kept", "score", "key", "tokens"]
    ids = [-(2**63), 1, 2, 3, None, big, big, 7]
    rows = [(i, t, "en", "src1", 1, *([f"u{k}"] * len(clash))) for k, (i, t) in enumerate(zip(ids, texts))]
    rows.append((8, texts[1], "en", "src1", 1, *(["copy"] * len(clash))))
    rows.append((None, texts[3] + " more", "en", "src1", 1, *(["near"] * len(clash))))
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in clash)
    docs = spark.createDataFrame(rows, schema)
    spark.createDataFrame([(1, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        got = [tuple(r) for r in out.collect()]
        assert all(r in rows for r in got) and (name == "mixing" or {*rows[2:3], *rows[4:8]} <= set(got)), name
        if name == "exact_dedup":
            assert len(got) == 9 and rows[1] not in got
        if name == "near_dedup":
            assert len(got) == 8 and rows[3] in got and rows[-1] not in got
    packed = corpus_pipeline.packing(spark, docs, str(tmp_path)).collect()
    assert len(packed) == len(rows)
