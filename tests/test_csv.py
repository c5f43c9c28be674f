import csv
import gzip
import random

import pytest

from pyspark.sql import functions as F

from sparkmart.sources.csv import read_csv_by_name, read_csv_snapshot
from sparkmart.sources.csv_splits import Starts, _lines, ends_open, split_maps, split_records


def write(path, header, rows, end="\n"):
    with open(path, "w", newline="") as f:
        w = csv.writer(f, lineterminator=end)
        w.writerow(header)
        w.writerows(rows)


def test_columns_are_aligned_by_name(spark, tmp_path):
    write(tmp_path / "reviews_1.csv", ["", "a", "b"], [["0", "a1", "b1"], ["1", "", "b2"]])
    write(tmp_path / "reviews_2.csv", ["b", "a", "c"], [["b3", "a3", "c3"]])
    df = read_csv_by_name(spark, f"{tmp_path}/reviews*.csv")
    rows = {r["b"]: r for r in df.collect()}
    assert set(df.columns) == {"column0", "a", "b", "c", "filename"}
    assert rows["b3"]["a"] == "a3" and rows["b3"]["c"] == "c3" and rows["b3"]["column0"] is None
    assert rows["b2"]["a"] is None and rows["b1"]["column0"] == "0"
    assert rows["b3"]["filename"].endswith("reviews_2.csv")


def test_missing_files_are_an_error(spark, tmp_path):
    with pytest.raises(ValueError):
        read_csv_by_name(spark, f"{tmp_path}/reviews*.csv")


TEXTS = ['say ""twice""', 'a "quote"', "comma, s", " padded ", '"', '""', "plain", "", 'end"start', '5" pump']


def both(spark, path):
    ways = ({"one_task": True}, {"line_breaks": True}, {"line_breaks": False})
    rows = [sorted(map(tuple, read_csv_snapshot(spark, path, **way).collect()), key=str) for way in ways]
    assert rows[0] == rows[1] == rows[2]
    return rows[0]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("split_bytes", [64, 1 << 20])
def test_both_readers_give_the_same_records(spark, tmp_path, end, split_bytes):
    rows = [[str(i), TEXTS[i % len(TEXTS)] * (1 + i % 7), f"t{i}"] for i in range(200)]
    write(tmp_path / "x.csv", ["i", "text", "tail"], rows, end)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    try:
        got = both(spark, f"{tmp_path}/x.csv")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted((int(i), t or "", tail) for i, t, tail in got) == [(int(i), t, tail) for i, t, tail in rows]


def test_line_breaks_in_values(spark, tmp_path):
    texts = ["line\nbreak", "two\n\nbreaks, and, commas", "\n", 'end"\n"start']
    write(tmp_path / "x.csv", ["i", "text"], [[str(i), t] for i, t in enumerate(texts)])
    assert [r["text"] for r in read_csv_snapshot(spark, f"{tmp_path}/x.csv").orderBy("i").collect()] == texts
    with pytest.raises(Exception, match="not closed on its line"):
        read_csv_snapshot(spark, f"{tmp_path}/x.csv", line_breaks=False).collect()


def test_stray_quotes_blank_lines_and_odd_lengths(spark, tmp_path):
    body = '\n\ni,text,tail\n1,a 5" pump,x\n2,"b ""c""",\n\n3,short\n4,d,e,too many\n5,"x" y,z\n'
    (tmp_path / "x.csv").write_text(body)
    assert both(spark, f"{tmp_path}/x.csv") == [
        ("1", 'a 5" pump', "x"), ("2", 'b "c"', None), ("3", "short", None), ("4", "d", "e"), ("5", '"x" y', "z")]


def test_odd_headers_survive_both_readers(spark, tmp_path):
    write(tmp_path / "x.csv", ["a b", "c:d", "e.f", "", "same", "Same", "two\nlines"], [["1", "2", "3", "4", "5", "6", "7"]])
    df = read_csv_snapshot(spark, f"{tmp_path}/x.csv")
    assert df.columns == ["a b", "c:d", "e.f", "column3", "same4", "Same5", "two\nlines"] and tuple(df.first()) == tuple("1234567")
    with gzip.open(tmp_path / "y.csv.gz", "wt") as f:
        f.write("\ufeffa b,\n1,2\n")
    assert read_csv_snapshot(spark, f"{tmp_path}/y.csv.gz").columns == ["a b", "column1"]
    assert both(spark, f"{tmp_path}/y.csv.gz") == [("1", "2")]


def test_the_state_map_of_a_line():
    for line, closed, opened in [
        ("a,b", False, True), ('a,"b', True, False), ('b",c', False, False), ('"a""', True, False), ('x" y,"z"', False, False),
        ('"a" b,"c', True, True), ("", False, True), ('"', True, False), ('""', False, True), ('a""b,c"', False, False),
    ]:
        assert (ends_open(line, False), ends_open(line, True)) == (closed, opened), line


@pytest.fixture()
def small_splits(spark):
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield lambda size: spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("size", [60, 400])
def test_splits_equal_one_task_on_any_quotes(spark, tmp_path, small_splits, end, size):
    """Random quotes, breaks and separators: files of any form, some of them without a last line break."""
    r = random.Random(size)
    for k in range(8):
        soup = ["a", "b", '"', '""', ",", " ", end, "é", '","', ' "', '" ', end + end]
        if k % 2:
            body = "".join(r.choice(soup) for _ in range(r.randint(1, 240)))
        else:
            values = [["".join(r.choice(["x", '""', ",", end, "é", " "]) for _ in range(r.choice([0, 5, 90]))) for _ in range(2)] for _ in range(20)]
            body = end.join(f'{i},"{a}","{b}"' for i, (a, b) in enumerate(values))
        (tmp_path / f"f{k}.csv").write_bytes(("i,a,b" + end + body + (end if k % 3 else "")).encode())
    small_splits(size)
    name = F.substring_index("filename", "/", -1).alias("file")
    ways = [read_csv_by_name(spark, f"{tmp_path}/*.csv", one_task=one).select("i", "a", "b", name) for one in (True, False)]
    one, split = (sorted(map(str, map(tuple, way.collect()))) for way in ways)
    assert one == split and len(one) > 60
    assert split_maps(_lines(spark, [f"{tmp_path}/*.csv"])).count() > 8


def test_a_record_over_many_splits_and_a_header_over_two(spark, tmp_path, small_splits):
    long = "word \n" * 400
    (tmp_path / "x.csv").write_text(f'\n\n"i{"i" * 50}\n{"j" * 50}",text\n1,"{long}"\n2,b\n')
    small_splits(40)
    assert sorted(map(tuple, read_csv_snapshot(spark, f"{tmp_path}/x.csv").collect())) == [("1", long), ("2", "b")]


def test_other_splits_in_the_second_pass_are_an_error(spark, tmp_path, small_splits):
    (tmp_path / "x.csv").write_text("i\n" + "1234567\n" * 100)
    small_splits(64)
    records = split_records(spark, [f"{tmp_path}/x.csv"])
    assert records.count() == 100
    small_splits(96)
    with pytest.raises(Exception, match="split differently"):
        records.select(F.upper("record")).collect()


def test_origins_pass_through_splits_without_a_record_end():
    maps = [("f", 0, True, False, False), ("f", 10, False, True, False), ("f", 20, True, False, True), ("f", 30, False, False, True)]
    rows = [dict(zip(("file", "start", "from_closed", "from_open", "ends"), m), filled=True, returns=False, bytes=10, size=40) for m in maps]
    starts = Starts(rows[::-1])
    assert [starts.origin("f", s) for s in (0, 10, 20, 30)] == [-1, 0, 0, -1] and starts.crossing and not starts.closing


@pytest.mark.parametrize("line_breaks", [True, False])
def test_a_record_is_parsed_once(spark, tmp_path, line_breaks):
    write(tmp_path / "x.csv", ["a", "b", "c"], [["1", "x", "y"], ["2", "", "z"]])
    rows = read_csv_snapshot(spark, f"{tmp_path}/x.csv", line_breaks=line_breaks).where("a > 1 and b is null")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_csv") == 1
    assert [tuple(r) for r in rows.collect()] == [("2", None, "z")]
