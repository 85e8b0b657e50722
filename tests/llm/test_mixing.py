import math

import pytest
from edge import documents
from pyspark.sql import functions as F

from conftest import TESTDATA
from stratalake.llm import mixing


def filled(sizes, weights, cap):
    """Targets by plain repetition of the rule, in fractions of floats."""
    targets = {s: None for s in sizes}
    total = sum(sizes.values())
    while True:
        open_ = [s for s in targets if targets[s] is None]
        left = total - sum(t for t in targets.values() if t is not None)
        weight = sum(weights[s] for s in open_)
        above = [s for s in open_ if left * weights[s] / weight > cap * sizes[s]]
        if not above:
            return {s: t if t is not None else left * weights[s] / weight for s, t in targets.items()}
        for s in above:
            targets[s] = float(cap * sizes[s])


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 10, "b": 10, "c": 10},
        {"a": 1, "b": 100, "c": 50, "d": 2, "e": 300},
        {"A": 0, "a": 5, "ä": 1, None: 4},
        {None: 7},
        {f"s{i:02}": (i * 37) % 11 for i in range(20)},
    ],
)
def test_targets_share_all_words(spark, sizes):
    docs = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r["source"]: r for r in mixing.with_targets(mixing.source_sizes(docs)).collect()}
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    assert {s: r["weight"] for s, r in got.items()} == weights
    for s, target in filled(sizes, weights, 3).items():
        assert math.isclose(got[s]["target"], target, abs_tol=1e-9)
        assert got[s]["rate"] == (got[s]["target"] / sizes[s] if sizes[s] else 0)


def test_no_sources(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix(docs).count() == 0


def test_mix_keeps_columns_and_repeats_as_planned(spark):
    docs = documents(spark)
    sizes, rates = mixing.mixing_plan(docs)
    planned = {(r["doc_id"], r["source"], r["size"]): r["copies"] for r in mixing.with_copies(sizes, rates).collect()}
    assert planned.keys() >= {(3, "a", 0), (4, "a", 0), (5, None, 0), (6, None, 60_000), (8, "a", 3)}
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    counts = {(r["doc_id"], r["source"]): r["count"] for r in mixed.groupBy("doc_id", "source").count().collect()}
    rows = {(r["doc_id"], r["source"]): r["count"] for r in docs.groupBy("doc_id", "source").count().collect()}
    for (doc_id, source, _), n in planned.items():
        assert counts.get((doc_id, source), 0) == n * rows[doc_id, source]
        assert n <= 3


def test_reruns_agree_and_sources_come_near(spark):
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    runs = []
    for _ in range(2):
        sizes, rates = mixing.mixing_plan(docs.repartition(3))
        runs.append(mixing.with_copies(sizes, rates).select("doc_id", "source", "size", "copies", "target"))
    first, second = (sorted(map(tuple, r.collect())) for r in runs)
    assert first == second
    off = runs[0].groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"), F.max("target").alias("target"), F.max("size").alias("most"))
    for r in off.collect():
        assert abs(r["taken"] - r["target"]) <= max(0.15 * r["target"], r["most"])


def test_draw_is_uniform(spark):
    got = [r[0] for r in spark.range(4000).select(mixing.draw(F.col("id"), F.lit(1))).collect()]
    assert 0 <= min(got) and max(got) < 1
    assert abs(sum(got) / len(got) - 0.5) < 0.02
    assert abs(sum(g < 0.2 for g in got) / len(got) - 0.2) < 0.03


def test_columns_named_like_helpers_stay(spark):
    rows = [(i, "a b c", f"s{i % 3}", "own", "own", "own") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, _mix_source string, _mix_rate string, _MIX_SEED string")
    plain_ = docs.select("doc_id", "text", "source")
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and {tuple(r)[3:] for r in mixed.collect()} == {("own",) * 3}
    assert sorted(r["doc_id"] for r in mixed.collect()) == sorted(r["doc_id"] for r in mixing.mix(plain_).collect())


def test_rows_without_ids_or_of_equal_ids_draw_apart(spark):
    rows = [(None if i % 2 else 7, f"w{i} b c d", f"s{i % 3}") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sizes, rates = mixing.mixing_plan(docs)
    targets = {r["source"]: r["target"] for r in rates.collect()}
    assert any(t % 1200 for t in targets.values())
    taken = mixing.mix(docs).groupBy("source").agg(F.sum(mixing.words(F.col("text"))).alias("n"))
    for r in taken.collect():
        assert abs(r["n"] - targets[r["source"]]) <= 0.1 * targets[r["source"]]
    planned = mixing.with_copies(sizes, rates).agg(F.sum("copies")).first()[0]
    assert mixing.mix(docs.repartition(5)).count() == planned
