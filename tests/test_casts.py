import datetime as dt

import pytest
from pyspark.sql import functions as F

from sparkmart.functions import casts


def values(spark, column, texts, kind="string"):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"i int, t {kind}")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_text_to_integer_rounds_halves_away_from_zero(spark):
    texts = ["4.0", "2.5", "-2.5", " 5 ", "1e2", "", "abc", "3000000000", "0.5", None, "1d", "5f", "7.D", "-0.4"]
    want = [4, 3, -3, 5, 100, None, None, None, 1, None, None, None, None, 0]
    assert values(spark, casts.try_int("t"), texts) == want


def test_double_to_integer_rounds_halves_to_even(spark):
    got = values(spark, casts.double_to_int("t"), [0.5, 0.6, 1.5, 2.5, -2.5, None], "double")
    assert got == [0, 1, 2, 2, -2, None]


def test_text_to_double_refuses_type_suffixes_but_not_infinity(spark):
    got = values(spark, casts.try_double("t"), ["1.5", "1d", "2.0F", "inf", "-Infinity", "x", " 3 ", "", "Inf", "d"])
    assert got == [1.5, None, None, float("inf"), float("-inf"), None, 3.0, None, float("inf"), None]
    assert values(spark, F.isnan(casts.try_double("t")), ["NaN"]) == [True]


def test_dates_need_three_parts_and_one_separator(spark):
    texts = ["2022-06-02", "2022-6-2", "2022", "2022-06", "2022/06/02", "2022-02-30", "06/02/2022", "2022-06/02", "", None]
    texts += ["2022-06-02 10:00:00", "+022-01-01", "2022-1 -02", "soon"]
    day = dt.date(2022, 6, 2)
    want = [day, day, None, None, day, None, None, None, None, None, day, None, None, None]
    assert values(spark, casts.leading_date("t"), texts) == want


def test_flags_have_three_values(spark):
    assert values(spark, casts.flag("t"), ["1", "1.0", "0", "x", "", None, " 1 "]) == [True, True, False, None, None, None, True]


def test_blank_and_empty(spark):
    texts = ["", "  ", " a ", "\t", " ", None]
    assert values(spark, casts.blank_to_null("t"), texts) == [None, None, "a", "\t", " ", None]
    assert values(spark, casts.empty_to_null("t"), texts) == [None, "  ", " a ", "\t", " ", None]


def test_key_uses_raw_values_and_skips_nulls(spark):
    df = spark.createDataFrame([("a", "p"), ("a ", "p"), (None, "p"), ("p", None)], "x string, y string")
    keys = [r[0] for r in df.select(casts.surrogate_key("x", "y")).collect()]
    assert keys[0] != keys[1] and keys[2] == keys[3]


@pytest.mark.parametrize("price,label", [(24.99, "low"), (25.0, "mid"), (99.0, "mid"), (100.0, "top"), (None, None)])
def test_bands_are_half_open(spark, price, label):
    assert values(spark, casts.band("t", [(25, "low"), (100, "mid")], "top"), [price], "double") == [label]
