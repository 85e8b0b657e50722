"""Run every registered query next to its SQL and compare: python -m verification.check [sf folder] [name ...]"""

from __future__ import annotations

import decimal
import datetime
import sys
import time

import duckdb

from stratalake.session import drop_scratch, local_session
from verification.oracle import ORACLE
from verification.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def normal(value):
    if isinstance(value, decimal.Decimal):
        return ("num", format(value.normalize(), "f"))
    if isinstance(value, bool):
        return ("bool", str(value))
    if isinstance(value, int):
        return ("num", str(value))
    if isinstance(value, float):
        return ("float", repr(round(value, 9) + 0.0))
    if isinstance(value, datetime.datetime):
        return ("time", value.replace(tzinfo=None).isoformat())
    return (type(value).__name__, str(value))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(normal(r[i]) for i in order) for r in rows)


def compare(df, relation) -> str:
    """Empty when both results agree."""
    theirs = list(relation.columns)
    if sorted(df.columns) != sorted(theirs):
        return f"columns {sorted(df.columns)} != {sorted(theirs)}"
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    other = rows_of(theirs, relation.fetchall())
    if len(mine) != len(other):
        return f"rows {len(mine)} != {len(other)}"
    for a, b in zip(mine, other):
        if a != b:
            return f"{sorted(theirs)}\n   spark {a}\n   sql   {b}"
    return ""


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = local_session()
    con = connect(sf)
    bad = 0
    for name in names:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf)
            if name in ORACLE:
                problem = compare(df, con.sql(ORACLE[name]))
            else:
                problem = "" if df.count() >= 0 else "no rows"
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += bool(problem)
        drop_scratch(spark)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.2f}s {problem}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree; without SQL: {sorted(set(QUERIES) - set(ORACLE))}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
