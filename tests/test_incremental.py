"""Models kept by differences, row-level reconciliation, merged parts and merges of catalog tables."""

import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from stratalake.operators import latest, row_reconcile
from stratalake.plans import incremental, merge
from stratalake.session import materialize
from stratalake.sources import sinks
from stratalake.streaming import state as stream_state

BASE = "id long, g string, h long, x long, y long"


def model():
    return incremental.Model(("g", "h"), {"x": "x"}, {"least": F.min("y"), "kinds": F.count_distinct("y")})


def full(df):
    again = [e.alias(n) for n, e in model().again.items()]
    return df.groupBy("g", "h").agg(F.count(F.lit(1)).alias("_rows"), F.sum("x").alias("x"), F.count("x").alias("_n_x"), *again)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_state_after_batches_is_the_full_aggregate(spark, seed):
    rng = random.Random(seed)
    some = lambda *v: rng.choice([*v, None])
    now, state_ = {}, None
    for _ in range(4):
        touched = rng.sample(range(40), 15)
        left = [now.pop(i) for i in touched if i in now]
        came = [(i, some("a", "b"), some(1, 2, 3), some(1, 2, 3, -4), some(5, 6, 7)) for i in touched if rng.random() < 0.6]
        now.update({r[0]: r for r in came})
        base = spark.createDataFrame(list(now.values()), BASE)
        delta = incremental.signed(spark.createDataFrame(left, BASE), spark.createDataFrame(came, BASE))
        state_ = materialize(incremental.maintain(state_, delta, base, model()))
        want = full(base)
        assert rows(state_, *want.columns) == rows(want, *want.columns)
    # Taking everything back leaves no group.
    last = spark.createDataFrame(list(now.values()), BASE)
    gone = incremental.maintain(state_, incremental.signed(last, last.limit(0)), last.limit(0), model())
    assert gone.count() == 0


def test_untouched_groups_are_not_computed_again(spark):
    base = spark.createDataFrame([(1, "a", 1, 1, 1), (2, "b", 1, 2, 2)], BASE)
    state_ = materialize(incremental.maintain(None, incremental.signed(None, base), base, model()))
    marked = state_.withColumn("least", F.when(F.col("g") == "b", F.lit(-9)).otherwise(F.col("least")))
    came = spark.createDataFrame([(3, "a", 1, 5, 0)], BASE)
    after = incremental.maintain(marked, incremental.signed(None, came), base.unionByName(came), model())
    assert rows(after, "g", "x", "least", "kinds") == [("a", 6, 0, 2), ("b", 2, -9, 1)]


# ---------------------------------------------------------------- rows


@pytest.mark.parametrize("buckets", [1, 7, 4096])
def test_planted_differences_are_found(spark, buckets):
    schema = "k long, j string, a string, b double"
    same = [(i, f"j{i % 3}", f"a{i}", float(i)) for i in range(200)] + [(5, None, None, None), (None, "x", "y", 1.0)]
    left = same + [(900, "m", "v", 1.0), (901, "c", "v", 1.0), (902, "t", "v", 1.0), (902, "t", "v", 1.0), (903, "n", None, 1.0), (None, None, "l", 0.0)]
    right = same + [(800, "e", "v", 1.0), (901, "c", "w", 1.0), (902, "t", "v", 1.0), (903, "n", "None", 1.0), (None, None, "r", 0.0)]
    a, b = (spark.createDataFrame(x, schema).repartition(3) for x in (left, right))
    found = row_reconcile.reconcile_rows(a, b, ["k", "j"], buckets=buckets)
    got = sorted(map(str, rows(found, "k", "j", "difference", "left_rows", "right_rows")))
    assert got == sorted(
        map(
            str,
            [
                (900, "m", "missing", 1, 0), (800, "e", "extra", 0, 1), (901, "c", "changed", 1, 1), (902, "t", "changed", 2, 1),
                (903, "n", "changed", 1, 1), (None, None, "changed", 1, 1),
            ],
        )
    )
    assert row_reconcile.reconcile_rows(a, a.repartition(5), ["k", "j"], buckets=buckets).count() == 0
    assert row_reconcile.reconcile_rows(a.limit(0), b.limit(0), ["k", "j"]).count() == 0


def test_only_rows_of_differing_buckets_are_compared(spark):
    a = spark.range(10_000).select("id", F.lit(1).alias("v"))
    b = a.withColumn("v", F.when(F.col("id") == 77, 2).otherwise(1))
    hashed = [row_reconcile._hashed(x, ["id"], ["v"], 500) for x in (a, b)]
    apart = [r[0] for r in row_reconcile.differing_buckets(*hashed).collect()]
    assert apart == [r[0] for r in hashed[0].filter("id = 77").select("_bucket").collect()]
    assert rows(row_reconcile.reconcile_rows(a, b, ["id"], buckets=500)) == [(77, "changed", 1, 1)]


# ---------------------------------------------------------------- merged parts


def test_merged_parts_hold_every_complete_version_once(spark, tmp_path):
    root, rng = str(tmp_path / "s"), random.Random(2)
    everything = []
    for version in range(1, 12):
        part = [(rng.randint(0, 20), version * 100 + i) for i in range(6)]
        everything += part
        sinks.publish(latest.latest_records(spark.createDataFrame(part, "k long, o long"), ["k"], ["o"]), root, version)
    want = sorted((k, max(o for j, o in everything if j == k)) for k in {k for k, _ in everything})
    assert sorted(rows(stream_state.read_latest(spark, root, ["k"], ["o"]), "k", "o")) == want
    assert stream_state.merge_parts(spark, root, ["k"], ["o"], fan_in=3) == 4
    done, ranges = sinks.versions(spark, root), stream_state._merged_ranges(spark, root)
    assert ranges == {(1, 3), (4, 6), (7, 9), (1, 9)} and len(stream_state._cover(root, done, ranges)) == 3
    assert sorted(rows(stream_state.read_latest(spark, root, ["k"], ["o"]), "k", "o")) == want
    assert stream_state.merge_parts(spark, root, ["k"], ["o"], fan_in=3) == 0
    # A merge without its mark is not read, and is made again.
    os.remove(f"{stream_state._range_path(root, 1, 9)}/_SUCCESS")
    assert len(stream_state._cover(root, done, stream_state._merged_ranges(spark, root))) == 5
    assert sorted(rows(stream_state.read_latest(spark, root, ["k"], ["o"]), "k", "o")) == want
    assert stream_state.merge_parts(spark, root, ["k"], ["o"], fan_in=3) == 1


def test_a_range_with_an_unfinished_version_is_not_merged(spark, tmp_path):
    root = str(tmp_path / "s")
    for version in (1, 2, 3, 4):
        sinks.publish(spark.createDataFrame([(version, version)], "k long, o long"), root, version)
    os.remove(f"{sinks.version_path(root, 2)}/_SUCCESS")
    assert stream_state.merge_parts(spark, root, ["k"], ["o"], fan_in=2) == 1
    assert rows(stream_state.read_latest(spark, root, ["k"], ["o"]), "k") == [(1,), (3,), (4,)]
    # Finished later, it counts.
    sinks.publish(spark.createDataFrame([(2, 2)], "k long, o long"), root, 2)
    assert stream_state.merge_parts(spark, root, ["k"], ["o"], fan_in=2) == 2
    assert rows(stream_state.read_latest(spark, root, ["k"], ["o"]), "k") == [(1,), (2,), (3,), (4,)]
    with pytest.raises(ValueError):
        stream_state.merge_parts(spark, root, ["k"], ["o"], fan_in=1)


# ---------------------------------------------------------------- catalog tables


def test_catalog_merge(spark, tmp_path):
    root = str(tmp_path / "t")
    schema = "business_key string, v string, record_hash string, effective_from int"
    spark.createDataFrame([("a", "1", "h1", 1), ("b", "1", "h1", 1)], schema).createOrReplaceTempView("cm_source")
    first = merge.merge_catalog_tables(spark, "cm_source", "cm_target", root, "type2").first()
    assert first["new_rows"] == 2 and spark.table("cm_target").count() == 2
    spark.createDataFrame([("a", "2", "h2", 2), ("c", "1", "h1", 2)], schema).createOrReplaceTempView("cm_source")
    second = merge.merge_catalog_tables(spark, "cm_source", "cm_target", root, "TYPE2").first()
    assert (second["new_rows"], second["changed_rows"]) == (1, 1)
    assert rows(spark.table("cm_target"), "business_key", "v", "effective_from", "effective_to", "is_current") == [
        ("a", "1", 1, 2, False), ("a", "2", 2, None, True), ("b", "1", 1, None, True), ("c", "1", 2, None, True),
    ]
    assert sinks.versions(spark, root) == [1, 2]
    for bad in ("a b", "x;y", "", "a.b.c.d", "t`"):
        with pytest.raises(ValueError):
            merge.publish_table(spark.table("cm_target"), bad, root)
    spark.sql("DROP VIEW cm_target")


def test_without_a_state_no_group_is_looked_up(spark, monkeypatch):
    """All rows came, so all groups are touched; keys travel packed and come back as texts."""
    base = spark.createDataFrame([(1, "ab", 1, 1, 1), (2, "b", None, 2, 2), (3, None, 1, 3, 3), (4, "ab", 1, None, 1)], BASE)

    def unwanted(*_):
        raise AssertionError("rows were looked up by their group")

    monkeypatch.setattr(incremental, "of_keys", unwanted)
    made = incremental.maintain(None, incremental.signed(None, base), base, model())
    want = full(base)
    assert rows(made, *want.columns) == rows(want, *want.columns)
