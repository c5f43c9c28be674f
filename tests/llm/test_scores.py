"""Classifiers: toxicity, language, quality."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkmart.llm import boosting, language, quality, toxicity

DOCS = "doc_id long, text string, lang string, source string, score string, predicted string"


def held(i, parts, rest):
    return zlib.crc32(str(i).encode()) % parts == rest


def corpus(seed=2, n=400):
    rng = random.Random(seed)
    syllables = {"aa": ["ta", "ro", "mi", "sen"], "bb": ["lük", "ört", "gab", "fö"]}
    rows, labels = [], []
    for i in range(n):
        lang = rng.choice(["aa", "bb"])
        words = ["".join(rng.choice(syllables[lang]) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(20, 80))]
        toxic = rng.random() < 0.3
        if toxic:
            for _ in range(5):
                words.insert(rng.randrange(len(words)), rng.choice(["vexor", "vexum", "drikk"]) + rng.choice(["", "es"]))
        poor = rng.random() < 0.3
        if poor:
            words = [w.upper() + "!!" for w in words]
        rows.append((i, " ".join(words), lang, rng.choice(["s1", "s2"]), "x", "y"))
        labels.append((i, 0 if poor else 1, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def data(spark):
    rows, labels = corpus()
    odd = [(1000, None, "aa", None, "", ""), (1001, "", None, "s1", "", ""), (None, "ta ro vexor", "aa", "s1", "", ""), (1002, "12 - 34", "bb", "s2", "", "")]
    return spark.createDataFrame(rows + odd + odd[:1], DOCS), spark.createDataFrame(labels + [(None, 1, 1), (7, None, None)], "doc_id long, quality int, toxic int")


def test_toxicity_on_held_out_rows(spark, data):
    docs, labels = data
    out = toxicity.toxicity_scores(docs, labels).collect()
    truth = {r["doc_id"]: r["toxic"] for r in labels.where("toxic is not null and doc_id is not null").collect()}
    assert len(out) == docs.count()
    wrong = [r for r in out if r["held_out"] and r["doc_id"] in truth and r["predicted"] != truth[r["doc_id"]]]
    assert len(wrong) <= 2
    for r in out:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
        assert r["held_out"] == (r["doc_id"] is not None and held(r["doc_id"], 3, 1))
    assert len({r["score"] for r in out if r["doc_id"] == 1000}) == 1


def test_toxicity_does_not_see_held_out_labels(spark, data):
    docs, labels = data
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (sorted((str(r["doc_id"]), r["score"]) for r in toxicity.toxicity_scores(docs, x).collect()) for x in (labels, flipped))
    assert a == b


def test_toxicity_without_classes(spark, data):
    docs, labels = data
    none = labels.where("toxic = 5")
    assert {r["score"] for r in toxicity.toxicity_scores(docs, none).collect()} == {0.0}
    assert {r["score"] for r in toxicity.toxicity_scores(docs, labels.where("toxic = 1")).collect()} == {1.0}
    assert toxicity.toxicity_scores(docs.limit(0), labels).collect() == []


def test_keep_ordinary_keeps_columns(spark, data):
    docs, labels = data
    bad = {r["doc_id"] for r in toxicity.toxicity_scores(docs, labels).where("predicted = 1").collect()}
    kept = toxicity.keep_ordinary(docs, labels)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in docs.collect()} - bad


def test_kneser_ney_by_hand(spark):
    """Probabilities of the shared backoff over one order, and ratios, from the formula."""
    rows = spark.createDataFrame([("ab ab", 0), ("ab ac", 2), ("ac", 3)], "text string, `group` int")
    grams = {r["code"]: tuple(r[c] for c in toxicity.COUNTS) for r in toxicity.count_grams(rows).collect()}
    a, ab, ac = ord("a"), (ord("a") << 8) | ord("b"), (ord("a") << 8) | ord("c")
    assert grams == {a: (1, 0, 1, 1), ab: (1, 0, 1, 0), ac: (0, 0, 1, 1)}
    p = {r["code"]: r["p"] for r in toxicity.shared_backoff(toxicity.count_grams(rows), 0.75).collect()}
    low = lambda n, total: 0.99 * n / total + 0.01 / 256
    # Three different bytes; a alone has an empty context, b and c follow a. Each extension of
    # order keeps a quarter of a single count and backs off with the rest.
    order_2 = {a: 0.25 + 0.75 * low(1, 3), ab: 0.25 / 2 + 0.75 * low(1, 3)}
    order_3 = {k: (0.25 if k == a else 0.125) + 0.75 * v for k, v in order_2.items()}
    assert p[a] == pytest.approx(0.25 + 0.75 * order_3[a])
    assert p[ab] == pytest.approx(0.125 + 0.75 * order_3[ab])


def test_every_gram_keeps_its_own_ratio():
    # More grams than any table of a fixed size that the models ever had.
    codes = np.random.default_rng(1).choice(2**40, 2_400_000).astype(np.uint64)
    codes = np.unique(codes | np.uint64(1))
    values = np.arange(len(codes), dtype=np.float32)
    (table,) = toxicity.Table.of(codes, [values])
    assert (table.find(codes) == values).all()
    assert np.isnan(table.find(codes - np.uint64(1))).all()
    (none,) = toxicity.Table.of(codes[:0], [values[:0]])
    assert np.isnan(none.find(codes[:9])).all()


def test_unseen_grams_take_the_backoff_of_their_context(spark):
    rows = spark.createDataFrame([("ab ab", 0), ("ab ac", 2), ("ac", 3)], "text string, `group` int")
    seen, unseen = (toxicity._tables(t.toArrow()) for t in toxicity.ratios(toxicity.count_grams(rows), 0.75))
    a, ab, ad = ord("a"), (ord("a") << 8) | ord("b"), (ord("a") << 8) | ord("d")
    word = lambda w: float(toxicity.word_ratios(np.frombuffer(w, np.uint8), seen[0], unseen[0])[0])
    codes = lambda *c: np.array(c, np.uint64)
    first, second, other = seen[0].find(codes(a, ab, ad)).tolist()
    assert np.isnan(other) and word(b"ab") == pytest.approx(first + second)
    assert word(b"ad") == pytest.approx(first + float(unseen[0].find(codes(a))[0]))
    # b never begins a word: only the empty context is known; after it nothing is.
    assert word(b"bz") == pytest.approx(float(unseen[0].find(codes(0))[0]))


def test_language_on_held_out_rows(spark, data):
    docs, _ = data
    out = {r["doc_id"]: r for r in language.identify_languages(docs).collect() if r["doc_id"] is not None}
    for r in docs.where("doc_id < 1000").collect():
        got = out[r["doc_id"]]
        assert got["lang_pred"] == r["lang"] and got["held_out"] == held(r["doc_id"], 4, 2) and 0 <= got["score"] <= 1
    for i in (1000, 1001, 1002):
        assert (out[i]["lang_pred"], out[i]["score"], out[i]["languages"]) == ("und", 0.0, [])


def test_language_finds_both_of_a_mixture(spark, data):
    docs, _ = data
    a, b = (docs.where(f"lang = '{x}' and doc_id < 1000").first()["text"] for x in ("aa", "bb"))
    mixed = docs.unionByName(spark.createDataFrame([(2002, f"{a} {b}", None, "s", "", "")], DOCS))
    got = [r for r in language.identify_languages(mixed).collect() if r["doc_id"] == 2002][0]
    share = len(a.split()) / (len(a.split()) + len(b.split()))
    assert set(got["languages"]) == {"aa", "bb"}
    assert dict(zip(got["languages"], got["shares"]))["aa"] == pytest.approx(share, abs=0.15)
    assert {r["lang_pred"] for r in language.identify_languages(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert language.identify_languages(docs.limit(0)).collect() == []


def test_mixture_is_the_likelihood_maximum():
    rng = np.random.default_rng(0)
    words = np.log(rng.dirichlet([1, 1], 400))
    p = language.LanguageId(penalty=0.0, steps=500, tolerance=1e-9, noise=0.0)
    share = language.mixture(words, p)
    grid = np.linspace(0.001, 0.999, 999)
    best = grid[np.argmax([np.log(np.exp(words) @ [g, 1 - g]).sum() for g in grid])]
    assert share[0] == pytest.approx(best, abs=2e-3)


def test_quality_on_held_out_rows(spark, data):
    docs, labels = data
    out = quality.quality_scores(docs, labels, F.col("source"), F.col("lang")).collect()
    truth = {r["doc_id"]: r["quality"] for r in labels.where("quality is not null and doc_id is not null").collect()}
    assert len(out) == docs.count()
    assert sum(r["predicted"] != truth[r["doc_id"]] for r in out if r["held_out"] and r["doc_id"] in truth) <= 2
    assert quality.quality_scores(docs.limit(0), labels, F.col("source"), F.col("lang")).collect() == []


def test_sparse_sites_shrink_to_the_mean(spark):
    groups = spark.createDataFrame([(f"h{i}", 1000, 1000 * q, 1000 * q) for i, q in enumerate([0.2, 0.5, 0.8, 0.4, 0.6])], "host string, n long, total double, squares double")
    mean, strength = quality._moments(groups, quality.Quality())
    assert mean == pytest.approx(0.5) and 2 <= strength < 20
    alike = spark.createDataFrame([(f"h{i}", 1000, 500.0, 500.0) for i in range(5)], "host string, n long, total double, squares double")
    assert quality._moments(alike, quality.Quality())[1] == 1e6


def test_boosting_learns_an_interaction():
    rng = np.random.default_rng(3)
    x = rng.random((2000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    trees = boosting.train(x, y, np.ones(2000), rounds=30)
    assert ((trees.margin(x) > 0) == (y > 0)).mean() > 0.98
