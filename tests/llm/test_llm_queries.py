"""The queries that SQL can express, against it, at the size where their tables are whole but small."""

import duckdb
import pytest

from stratalake.llm.oracle import ORACLE
from stratalake.llm.queries import QUERIES
from verification.check import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, sql, name):
    assert compare(QUERIES[name](spark, SF), sql.sql(ORACLE[name])) == ""


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_chat_query_tells_refused_orders(spark, tmp_path):
    """The given conversations are all in order; some of these aren't, and the machine stands in the plan."""
    orders = [["user", "assistant"], ["assistant"], ["user", "user"], ["system", "user", "assistant", "user"], ["user", "tool"], [None], ["system"]]
    turns = [(c, t, r, f"text {t}") for c, roles in enumerate(orders) for t, r in enumerate(roles)]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").coalesce(1).write.parquet(str(tmp_path / "in"))
    (part,) = (tmp_path / "in").glob("part-*.parquet")
    part.rename(tmp_path / "conversations.parquet")
    made = QUERIES["op10_chat_format"](spark, str(tmp_path))
    states = {r["conv_id"]: (r["state"], r["valid"]) for r in made.collect()}
    ok, no = True, ("refused", False)
    assert states == {-1: ("assistant", ok), 0: ("assistant", ok), 1: no, 2: no, 3: ("user", ok), 4: no, 5: no, 6: ("system", ok)}
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet'")
    assert compare(made, con.sql(ORACLE["op10_chat_format"])) == ""
    assert "refused" in made._jdf.queryExecution().optimizedPlan().toString()
