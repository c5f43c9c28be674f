"""Registered queries over the small tables: whole results with the promised columns."""

import pytest

from __spark_entry__ import oracle_sql, queries

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_near_dedup": ("documents", {"doc_id", "n_shingles", "component_id", "kept"}),
    "op3_quality": ("documents", {"doc_id", "score", "predicted"}),
    "op4_toxicity": ("documents", {"doc_id", "held_out", "score", "predicted"}),
    "op5_html_text": ("pages", {"page_id", "url", "text", "n_chars"}),
    "op7_mixing": ("documents", {"doc_id", "probability", "kept"}),
    "op8_language_id": ("documents", {"doc_id", "held_out", "lang_pred", "score"}),
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_a_row_for_each_row(spark, name):
    table, columns = COLUMNS[name]
    out = queries()[name](spark, SF)
    assert columns <= set(out.columns)
    assert out.count() == spark.read.parquet(f"{SF}/{table}.parquet").count()


def test_packing_and_neighbours(spark):
    assert queries()["op9_packing"](spark, SF).select("doc_id").distinct().count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    assert queries()["op10_neighbours"](spark, SF).count() == 20 * vectors.where("vec_id % 20 = 0").count()


def test_where_sql_can_say_it_there_is_some():
    assert {"op2_exact_dedup", "op6_url_filter"} <= set(oracle_sql())
