"""Every registered query against its SQL on the smallest given tables."""

import pytest

import __spark_entry__ as entry
from conftest import TESTDATA
from verification.check import compare, connect

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def sql():
    return connect(TESTDATA)


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sql, name):
    df = QUERIES[name](spark, TESTDATA)
    if name in ORACLE:
        assert compare(df, sql.sql(ORACLE[name])) == ""
    else:
        df.count()


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_line_arrives(spark, sql):
    lines = sql.sql("SELECT count(*) FROM lineitem").fetchall()[0][0]
    assert QUERIES["fact_order"](spark, TESTDATA).count() == lines
    raw = sql.sql("SELECT l_partkey, CAST(sum(l_quantity) AS BIGINT) FROM lineitem GROUP BY 1").fetchall()
    sold = QUERIES["gold_product_sales"](spark, TESTDATA).where("units_sold > 0").select("product_id", "units_sold").collect()
    assert sorted(map(tuple, sold)) == sorted(raw)
