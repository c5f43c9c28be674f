"""Every registered query that has SQL against it, over the whole small tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from sparkmart.catalog import ORACLES, QUERIES
from sparkmart.catalog.inputs import spark_input
from tests.compare import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_table_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(oracle_sql()) <= set(queries())


def test_flagship(spark):
    df = entry(spark)
    assert df.columns == ["price_band", "avg_rating", "n_reviews", "label"] and df.count() > 0


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, queries()[name], oracle_sql()[name], SF) is None


def test_a_catalogue_of_one_split_is_dealt_over_the_cores(spark, tmp_path):
    columns = "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    parts = [(k, f"part {k}", f"Brand#{k % 5}", "TIN", k % 50, 900.0 + k) for k in range(200)] + [(None, None, None, None, None, None)] * 2
    spark.createDataFrame(parts, columns).coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    rows = spark_input(spark, str(tmp_path), "catalogue")
    assert rows.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert rows.count() == len(parts) and rows.where("product_id is null").count() == 2
