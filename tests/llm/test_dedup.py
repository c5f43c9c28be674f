"""Exact and near duplicates against plain Python."""

import hashlib
import math
import random
import re
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from sparkmart.llm import exact_dedup, near_dedup
from sparkmart.llm.components import connected_components
from sparkmart.llm.textbytes import doc_words, shingles, text_buffers

SCHEMA = "doc_id long, text string, lang string, source string, kept boolean, component_id string, group_size int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = {c: c + 32 for c in range(65, 91)}


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", False, "x", 7) for i, t in rows], SCHEMA)


def shingle_set(text):
    words = WORD.findall((text or "").translate(FOLD))
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(zip(*(words[k:] for k in range(5))))


def brute(rows, similarity):
    sets = {i: shingle_set(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= similarity * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}


def corpus(seed=4):
    """Groups of near copies around the threshold, exact copies, shared passages, short and empty texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeü") for _ in range(rng.randint(2, 6)))
    shared = [word() for _ in range(60)]
    texts = []
    for size in (30, 120, 400):
        for copies in (1, 3, 12):
            base = [word() for _ in range(size)]
            for _ in range(copies):
                own = list(base)
                for _ in range(rng.randint(0, max(1, size // 25))):
                    own[rng.randrange(size)] = word()
                texts.append(" ".join(own))
    texts += [" ".join(shared + [word() for _ in range(60)]) for _ in range(12)]
    texts += [texts[0], texts[0].upper(), texts[5].replace(" ", "\n\t")]
    texts += ["one two three", "One two  three ", "one two", "", None, " \n", "a b c d e", "a b c d e f"]
    rng.shuffle(texts)
    return [(3 * i + 1, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("similarity", [80, 85])
def test_near_duplicates_equal_all_pairs(spark, similarity):
    rows = corpus()
    out = near_dedup.near_duplicates(documents(spark, rows), near_dedup.NearDedup(similarity=similarity, block=8))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in out.collect()}
    assert got == brute(rows, similarity)


def test_near_duplicates_of_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(400_000))
    rows = [(5, long), (2, long + " x"), (None, "a b c d e"), (9, "a b c d e"), (9, "a b c d e"), (4, None)]
    out = {(r[0], r[1], r[2], r[3]) for r in near_dedup.near_duplicates(documents(spark, rows)).collect()}
    assert out == {(5, 399_996, 2, False), (2, 399_997, 2, True), (None, 1, None, True), (9, 1, 9, True), (4, 0, 4, True)}
    assert near_dedup.near_duplicates(documents(spark, [])).collect() == []


def test_fewest_matches_is_the_posterior():
    # Beta(m + 1, n - m + 1) mass above t by direct integration.
    n, t, miss = 32, 0.85, 1e-3
    x = (np.arange(200_000) + 0.5) / 200_000

    def above(m):
        density = x**m * (1 - x) ** (n - m)
        return density[x >= t].sum() / density.sum()

    m = near_dedup.fewest_matches(n, t, miss)
    assert above(m) >= miss > above(m - 1)


def test_words_and_shingles_do_not_cross_rows():
    texts = ["ab", "cd ef", "", None, "gh", " x", "y "]
    body, bounds = text_buffers(pa.array(texts))
    words, first = doc_words(body, bounds)
    assert np.diff(first).tolist() == [1, 2, 0, 0, 1, 1, 1]
    one, at = doc_words(*text_buffers(pa.array(["CD eF"])))
    assert words[1:3].tolist() == one.tolist()
    assert len(shingles(words[:0], 5)) == 0 and len(shingles(one, 5)) == 1


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(8, 60)] + [(3, 3), (None, 4)]
    out = dict(map(tuple, connected_components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert out == {i: 100 for i in range(100, 141)} | {i: 7 for i in range(7, 60)}


@pytest.mark.parametrize("share", [0.0, 0.5, 1.0])
def test_exact_duplicates(spark, share):
    rng = random.Random(1)
    rows = [(i, rng.choice(["a", "A", "a ", "", None, "b" * 70_000, f"u{i}"])) for i in range(300)]
    out = exact_dedup.exact_duplicates(documents(spark, rows), history_share=share).collect()
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    want = set()
    for t, ids in groups.items():
        digest = hashlib.sha256(t.encode()).hexdigest()
        want |= {(i, max(ids), len(ids), i == max(ids), digest) for i in ids}
    assert {tuple(r) for r in out} == want and len(out) == len(rows)


def test_exact_duplicates_of_odd_rows(spark):
    rows = [(None, "a"), (None, "b"), (3, "a"), (4, "c"), (4, "c")]
    out = sorted((r[:4] for r in exact_dedup.exact_duplicates(documents(spark, rows)).collect()), key=str)
    assert out == sorted([(None, 3, 2, False), (None, None, 1, True), (3, 3, 2, True), (4, 4, 2, True), (4, 4, 2, True)], key=str)
    assert exact_dedup.exact_duplicates(documents(spark, [])).collect() == []


def test_perfect_hash_is_minimal_and_checked():
    digests = np.frombuffer(b"".join(hashlib.sha256(str(i).encode()).digest() for i in range(5000)), np.uint8).reshape(-1, 32)
    hashed = exact_dedup.PerfectHash.build(digests[:4000])
    slots = hashed.slots(digests[:4000])
    assert sorted(slots.tolist()) == list(range(4000))
    # Strangers land anywhere or nowhere; only the digest in the slot tells.
    others = hashed.slots(digests[4000:])
    assert others.max() < 4000 and (others >= 0).any()
    with pytest.raises(ValueError):
        exact_dedup.PerfectHash.build(np.concatenate([digests[:2], digests[:1]]))
    assert math.isclose(len(hashed.bits) / 4000, 2.0 * 1.6, rel_tol=0.5)


@pytest.mark.parametrize("similarity", [60, 80, 85, 100])
def test_misses_are_bounded_at_every_threshold(similarity):
    p = near_dedup.NearDedup(similarity=similarity)
    s = similarity / 100
    assert (1 - s**p.rows) ** p.bands <= 1e-5
    assert p.bands == 1 or (1 - s**p.rows) ** (p.bands - 1) > 1e-5
    tests = p.tests()
    assert tests[-1][1] == p.hashes + p.wide
    # The posterior chance of a pair that is dropped, added up over all batches.
    dropped = [sum(float(Fraction(math.comb(n + 1, m)) * Fraction(s) ** m * Fraction(1 - s) ** (n + 1 - m)) for m in range(least)) for _, n, least in tests[:12]]
    assert sum(dropped) <= 1e-4 * len(dropped) / len(tests)
