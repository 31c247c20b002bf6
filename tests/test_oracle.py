import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_oracle import TABLES, compare

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, con, name):
    got = queries()[name](spark, SF_DIR).toPandas()
    spark.catalog.clearCache()
    assert len(got)
    assert compare(got, con.execute(oracle_sql()[name]).df()) == "ok"


@pytest.mark.parametrize("name", ["lsa_embed", "pca_reduce"])
def test_rows_only_queries(spark, name):
    assert queries()[name](spark, SF_DIR).count() > 0
    spark.catalog.clearCache()
