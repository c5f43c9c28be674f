"""The key directory alone, and staging that relies on it."""

import datetime as dt
import random

import pytest

from sparkmart.operators.key_directory import ENTRY, KeyDirectory
from sparkmart.plans import models
from sparkmart.sources.landed import read_landed
from sparkmart.sources.paths import delete, file_names
from tests.test_models import D, land_reviews, review, rows


def test_lookups_over_merged_runs_find_every_entry_once(spark, base):
    r = random.Random(2)
    directory = KeyDirectory(spark, f"{base}/d", buckets=4, fan=2)
    want = []
    for run in range(1, 8):
        batch = [(f"k{r.randrange(30)}", dt.date(2022, 1, run), f"f{run}", run) for _ in range(6)]
        batch = sorted(set(batch))
        want += batch
        directory.add(spark.createDataFrame(batch, ENTRY), run)
    assert directory._levels() == [(2, 4), (1, 6), (0, 7)]
    keys = spark.createDataFrame([(f"k{i}",) for i in range(0, 30, 3)], "key string")
    found = sorted(map(tuple, KeyDirectory(spark, f"{base}/d", buckets=99).lookup(keys).select("key", "load_date", "file", "arrived").collect()))
    assert found == sorted(w for w in want if int(w[0][1:]) % 3 == 0)
    assert sorted(r["file"] for r in directory.arrivals([3, 9]).collect()) == ["f3"] * sum(w[3] == 3 for w in want)
    directory.add(spark.createDataFrame([], ENTRY), 8)
    assert directory._levels() == [(3, 8)] and directory.lookup(keys).count() == len(found)


def test_a_lookup_reads_the_buckets_of_its_keys(spark, base):
    directory = KeyDirectory(spark, f"{base}/d", buckets=16)
    directory.add(spark.createDataFrame([(f"k{i}", D[0], "f", 1) for i in range(500)], ENTRY), 1)
    found = directory.lookup(spark.createDataFrame([("k7",)], "key string"))
    assert found.count() == 1
    read = {f.split("bucket=")[1].split("/")[0] for f in found.inputFiles() if "bucket=" in f}
    assert len(read) == 1 and len([n for n in file_names(spark, f"{base}/d/buckets=16/level=0/run=1") if n.startswith("bucket=")]) > 10


def staged_equals_full(spark, base):
    want = models.stg_reviews(read_landed(spark, f"{base}/raw/reviews"))
    got = spark.read.parquet(f"{base}/staged")
    assert rows(got, "review_id", "rating", "load_date", "review_title") == rows(want, "review_id", "rating", "load_date", "review_title")


def test_random_landings_equal_a_rebuild(spark, base):
    """Days are landed, landed again with other rows, and deleted, in any order."""
    r = random.Random(5)
    for step in range(9):
        for _ in range(r.randint(1, 2)):
            day = r.choice(D)
            if step > 2 and r.random() < 0.25:
                delete(spark, f"{base}/raw/reviews/load_date={day}")
            else:
                some = [review(f"a{r.randrange(25)}", "p", D[0], str(r.randint(1, 5)), review_title=f"t{r.randrange(3)}") for _ in range(r.randint(0, 20))]
                land_reviews(spark, base, day, some or [review("x", "p", D[0], "9")])
        models.extend_staged_reviews(spark, f"{base}/raw/reviews", f"{base}/staged")
        if file_names(spark, f"{base}/raw/reviews"):
            staged_equals_full(spark, base)


@pytest.mark.parametrize("dies_in", ["apply_delete_insert", "createDataFrame"])
def test_a_run_that_died_is_settled_again(spark, base, monkeypatch, dies_in):
    """It dies before the table changes, or after that and before the log is written; then the landed rows change once more."""
    land_reviews(spark, base, D[1], [review("a", "p", D[0], review_title="1"), review("b", "p", D[0])])
    models.extend_staged_reviews(spark, f"{base}/raw/reviews", f"{base}/staged")
    land_reviews(spark, base, D[0], [review("a", "p", D[0], review_title="0"), review("c", "p", D[0])])
    land_reviews(spark, base, D[2], [review("c", "p", D[0], review_title="2")])
    if dies_in == "apply_delete_insert":
        monkeypatch.setattr(models, dies_in, lambda *a, **k: (_ for _ in ()).throw(RuntimeError("died")))
    else:
        whole = type(spark).createDataFrame

        def die(self, data, schema=None, *a, **k):
            if schema == models.FILES and data:
                raise RuntimeError("died")
            return whole(self, data, schema, *a, **k)

        monkeypatch.setattr(type(spark), "createDataFrame", die)
    with pytest.raises(RuntimeError, match="died"):
        models.extend_staged_reviews(spark, f"{base}/raw/reviews", f"{base}/staged")
    monkeypatch.undo()
    delete(spark, f"{base}/raw/reviews/load_date={D[0]}")
    models.extend_staged_reviews(spark, f"{base}/raw/reviews", f"{base}/staged")
    staged_equals_full(spark, base)
    assert spark.read.parquet(f"{base}/staged").count() == 3


def test_neither_staged_rows_nor_old_raw_files_are_searched(spark, base, monkeypatch):
    for day in D[:3]:
        land_reviews(spark, base, day, [review(f"a{day}{i}", "p", day) for i in range(5)])
    models.extend_staged_reviews(spark, f"{base}/raw/reviews", f"{base}/staged")
    land_reviews(spark, base, D[3], [review("new", "p", D[3]), review(f"a{D[0]}1", "p", D[0])])
    read = []
    filed, merge = models._filed_reviews, models.apply_delete_insert
    monkeypatch.setattr(models, "_filed_reviews", lambda s, b, paths: read.extend(paths) or filed(s, b, paths))
    monkeypatch.setattr(models, "apply_delete_insert", lambda *a, within, **k: read.extend(sorted(within)) or merge(*a, within=within, **k))
    models.extend_staged_reviews(spark, f"{base}/raw/reviews", f"{base}/staged")
    assert all(str(D[3]) in r for r in read)
    staged_equals_full(spark, base)


def test_equal_entries_are_kept_once_without_storing_typed_rows(spark, base):
    directory = KeyDirectory(spark, f"{base}/d", buckets=2)
    twice = [("k", dt.date(2022, 1, 1), "f", 1), ("k", dt.date(2022, 1, 1), "f", 1), ("l", None, "f", 1), ("l", None, "f", 1)]
    directory.add(spark.createDataFrame(twice, ENTRY), 1, distinct=True)
    assert sorted(map(str, directory.arrivals([1]).select("key").collect())) == ["Row(key='k')", "Row(key='l')"]
    for day in D[:2]:
        land_reviews(spark, base, day, [review("a", "p", D[0]), review("a", "p", D[0]), review(f"b{day}", "p", day)])
        models.extend_staged_reviews(spark, f"{base}/raw/reviews", f"{base}/staged")
    assert "typed" not in file_names(spark, f"{base}/staged_run")
    staged_equals_full(spark, base)
