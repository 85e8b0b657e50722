"""Histories out of changes in any order, bucketed tables, appends that are run again, stable keys and as-of lookups."""

import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import at, rows
from stratalake.operators import as_of, changes, history, numbering, observations
from stratalake.session import materialize
from stratalake.sources import buckets, sinks
from stratalake.sources.config import ChangeSettings
from stratalake.streaming import state

LOG = "k string, t long, s string, n long, is_deleted boolean"


def plain_versions(log):
    """(key, state, payload, start, end) by walking each key's times."""
    out = []
    for key in {r[0] for r in log}:
        points = {}
        for r in sorted((r for r in log if r[0] == key), key=lambda r: (r[1], r[3])):
            points[r[1]] = r
        state_, versions = None, []
        for t in sorted(points):
            _, _, s, n, deleted = points[t]
            now = None if deleted else (s,)
            if now != state_:
                if versions and versions[-1][3] is None and state_ is not None:
                    versions[-1][3] = t
                if now is not None:
                    versions.append([s, n, t, None])
            state_ = now
        out += [(key, *v) for v in versions]
    return sorted(out, key=str)


def made(seed, n=120):
    rng = random.Random(seed)
    return [(rng.choice(["a", "b", "c", None]), rng.randint(1, 30), rng.choice(["x", "y", None]), i, rng.random() < 0.2) for i in range(n)]


def got(df):
    return sorted(((r["k"], r["s"], r["n"], r[history.START], r[history.END]) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("most", [5_000_000, 4])
def test_history_of_a_log_with_deletes(spark, seed, most):
    log = made(seed)
    df = spark.createDataFrame(log, LOG)
    assert got(observations.versions_of(df, ["k"], ["s"], ["t", "n"], max_rows_per_group=most)) == plain_versions(log)


@pytest.mark.parametrize("seed", [3, 4])
def test_batches_in_any_order_and_twice(spark, seed):
    log = made(seed)
    parts = [log[:40], log[40:80], log[80:]]
    random.Random(seed).shuffle(parts)
    hist = seen = None
    for part in [*parts, parts[0]]:
        hist, seen = observations.apply_late(hist, seen, spark.createDataFrame(part, LOG), ["k"], ["s"], ["t", "n"])
        hist, seen = materialize(hist), materialize(seen)
    assert got(hist) == plain_versions(log)


def test_late_change_splits_a_version_and_its_correction_joins_it_again(spark):
    make = lambda *r: spark.createDataFrame([("a", *x, False) for x in r], LOG)
    hist, seen = observations.apply_late(None, None, make((1, "x", 1), (5, "x", 2), (9, "y", 3)), ["k"], ["s"], ["t", "n"])
    assert got(hist) == [("a", "x", 1, 1, 9), ("a", "y", 3, 9, None)]
    hist, seen = observations.apply_late(hist, seen, make((3, "z", 4)), ["k"], ["s"], ["t", "n"])
    assert got(hist) == [("a", "x", 1, 1, 3), ("a", "x", 2, 5, 9), ("a", "y", 3, 9, None), ("a", "z", 4, 3, 5)]
    hist, seen = observations.apply_late(hist, seen, make((3, "x", 5)), ["k"], ["s"], ["t", "n"])
    assert got(hist) == [("a", "x", 1, 1, 9), ("a", "y", 3, 9, None)]


def test_untouched_keys_pass_through(spark):
    hist, seen = observations.apply_late(None, None, spark.createDataFrame(made(5), LOG), ["k"], ["s"], ["t", "n"])
    marked = hist.withColumn("n", F.when(F.col("k") == "b", F.lit(-7)).otherwise(F.col("n")))
    after, _ = observations.apply_late(marked, seen, spark.createDataFrame([("a", 99, "q", 1000, False)], LOG), ["k"], ["s"], ["t", "n"])
    assert {r["n"] for r in after.filter("k = 'b'").collect()} == {-7}
    assert after.filter("k IS NULL").count() == hist.filter("k IS NULL").count()


def test_feed_with_type2_as_configured(spark):
    settings = ChangeSettings("s", "FEED", "op", "seq", "bigint", "HARD", None, "TYPE2")
    feed = [("a", "I", "1", "x"), ("a", " d ", "4", None), ("a", "U", "10", "x"), ("b", "D", "2", None), ("b", None, "3", "y"), ("a", "U", "11", "x")]
    schema = "k string, op string, seq string, s string"
    whole = changes.apply_configured(None, spark.createDataFrame(feed, schema), ["k"], settings)
    want = [("a", "x", 1, 4), ("a", "x", 10, None), ("b", "y", 3, None)]
    assert rows(changes.configured_history(whole, ["k"], settings), "k", "s", history.START, history.END) == want
    kept = None
    for part in (feed[3:], feed[:3], feed[:2]):
        kept = materialize(changes.apply_configured(kept, spark.createDataFrame(part, schema), ["k"], settings))
    assert rows(changes.configured_history(kept, ["k"], settings), "k", "s", history.START, history.END) == want
    assert kept.count() == 6
    empty = spark.createDataFrame([], schema)
    assert changes.apply_configured(None, empty, ["k"], settings).count() == 0


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_many_snapshots_as_folded_one_by_one(spark, seed):
    rng = random.Random(seed)
    schema = "k string, s string, p long, day long"
    days = [3, 4, 8, 9, 20]
    snapshots = [(k, rng.choice(["x", None]), rng.randint(0, 99), d) for d in days for k in ("a", "b", "c", None) if rng.random() < 0.7]
    folded = None
    for d in days:
        one = spark.createDataFrame([r for r in snapshots if r[3] == d], schema)
        folded = materialize(history.scd2_from_snapshot(folded, one, ["k"], ["s"], "day", close_missing=True, missing_at=F.lit(d).cast("long")))
    times = spark.createDataFrame([(d,) for d in days], "day long")
    at_once = observations.scd2_from_snapshots(spark.createDataFrame(snapshots, schema), ["k"], ["s"], "day", times=times)
    columns = ("k", "s", "p", history.START, history.END)
    assert rows(at_once, *columns) == rows(folded, *columns)


def test_a_key_that_misses_a_snapshot_comes_back(spark):
    snapshots = spark.createDataFrame([("a", "x", 1), ("b", "x", 1), ("b", "x", 2), ("a", "x", 3), ("b", "x", 3)], "k string, s string, day long")
    made_ = observations.scd2_from_snapshots(snapshots, ["k"], ["s"], "day", "f", "u")
    assert rows(made_, "k", "f", "u") == [("a", 1, 2), ("a", 3, None), ("b", 1, None)]
    assert observations.scd2_from_snapshots(snapshots.limit(0), ["k"], ["s"], "day").count() == 0


# ---------------------------------------------------------------- buckets


def files_of(root):
    return {os.path.join(d, f) for d, _, names in os.walk(f"{root}/data") for f in names if f.endswith(".parquet")}


def test_upsert_rewrites_touched_buckets_only(spark, tmp_path):
    root = str(tmp_path / "t")
    target = spark.range(1000).select("id", F.lit("old").alias("v"))
    assert buckets.upsert_buckets(target, root, ["id"], "one", 32) == 32
    before = files_of(root)
    source = spark.createDataFrame([(5, "new"), (2000, "new")], "id long, v string")
    wanted = {r[0] for r in source.select(buckets.bucket_of(["id"], 32)).collect()}
    assert buckets.upsert_buckets(source, root, ["id"], "two") == len(wanted)
    written = files_of(root) - before
    assert {int(f.split("_bucket=")[1].split("/")[0]) for f in written} == wanted and before <= files_of(root)
    assert rows(buckets.read_buckets(spark, root)) == rows(changes.scd1_upsert(target, source, ["id"]))
    # The same batch again changes nothing.
    assert buckets.upsert_buckets(source, root, ["id"], "two") == 0 and files_of(root) - before == written
    assert buckets.upsert_buckets(source.limit(0), root, ["id"], "none") == 0


def test_an_attempt_without_manifest_is_not_read_and_repeats(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    first = spark.createDataFrame([(1, "a"), (2, "a"), (None, "a")], "id long, v string")
    buckets.upsert_buckets(first, root, ["id"], "one", 4)
    source = spark.createDataFrame([(1, "b"), (None, "b")], "id long, v string")
    whole = sinks.publish

    def broken(df, path, *more, **kinds):
        if path.endswith("manifest"):
            raise RuntimeError("lost")
        return whole(df, path, *more, **kinds)

    with monkeypatch.context() as m:
        m.setattr(buckets, "publish", broken)
        with pytest.raises(RuntimeError):
            buckets.upsert_buckets(source, root, ["id"], "two")
    assert rows(buckets.read_buckets(spark, root)) == rows(first)
    buckets.upsert_buckets(source, root, ["id"], "two")
    assert rows(buckets.read_buckets(spark, root)) == [(1, "b"), (2, "a"), (None, "b")]


def test_late_history_in_buckets_is_made_good_after_a_loss(spark, tmp_path, monkeypatch):
    log = made(9)
    root = str(tmp_path / "h")
    args = (["k"], ["s"], ["t", "n"])
    buckets.late_history_buckets(spark.createDataFrame(log[60:], LOG), root, *args, "late", 4)
    whole, second = buckets.rewrite_buckets, spark.createDataFrame(log[:60], LOG)

    def broken(df, path, *more, **kinds):
        if path.endswith("versions"):
            raise RuntimeError("lost")
        return whole(df, path, *more, **kinds)

    with monkeypatch.context() as m:
        m.setattr(buckets, "rewrite_buckets", broken)
        with pytest.raises(RuntimeError):
            buckets.late_history_buckets(second, root, *args, "early", 4)
    buckets.late_history_buckets(second, root, *args, "early", 4)
    assert got(buckets.read_buckets(spark, f"{root}/versions")) == plain_versions(log)


# ---------------------------------------------------------------- streamed state


def test_unfinished_versions_are_never_read(spark, tmp_path):
    root = str(tmp_path / "h")
    for version, value in ((1, "x"), (2, "y"), (3, "z")):
        snapshot = spark.createDataFrame([(1, value, at(f"2026-01-0{version} 00:00:00"))], "id long, s string, ingestion_timestamp timestamp")
        if version == 3:
            os.remove(f"{sinks.version_path(root, 2)}/_SUCCESS")
        state.fold_snapshot(spark, root, version, snapshot, ["id"], ["s"])
    assert [r["s"] for r in state.read_history(spark, root).orderBy(history.START).collect()] == ["x", "z"]

    latest = str(tmp_path / "l")
    for version, value in ((1, "x"), (2, "y"), (3, "w")):
        rows_ = spark.createDataFrame([(1 if version < 3 else 2, value, version)], "id long, s string, o long")
        sinks.publish(rows_, latest, version)
    os.remove(f"{sinks.version_path(latest, 2)}/_SUCCESS")
    assert rows(state.read_latest(spark, latest, ["id"], ["o"]), "id", "s") == [(1, "x"), (2, "w")]


# ---------------------------------------------------------------- appends, keys, lookups


def test_appends_count_once_and_only_when_complete(spark, tmp_path):
    root = str(tmp_path / "a")
    one = spark.createDataFrame([(1,), (2,)], "id long")
    assert sinks.read_batches(spark, root) is None
    for name in ("1", "b-2", "1"):
        sinks.append_batch(one, root, name)
    assert rows(sinks.read_batches(spark, root)) == [(1, "1"), (1, "b-2"), (2, "1"), (2, "b-2")]
    os.remove(f"{root}/batch=1/_SUCCESS")
    assert rows(sinks.read_batches(spark, root)) == [(1, "b-2"), (2, "b-2")]
    sinks.load_batch(one.limit(1), root, None, "new")
    assert rows(sinks.read_batches(spark, root), "batch") == [("new",)]
    for bad in ("", "a/b", "é", "a=b"):
        with pytest.raises(ValueError):
            sinks.append_batch(one, root, bad)


def test_numbers_stay(spark):
    first = materialize(numbering.stable_numbers(None, spark.createDataFrame([("c",), ("a",), ("a",)], "k string"), ["k"], "no"))
    assert rows(first) == [("a", 1), ("c", 2)]
    more = spark.createDataFrame([("b",), (None,), ("a",), ("d",)], "k string")
    second = materialize(numbering.stable_numbers(first, more, ["k"], "no"))
    assert dict((r["k"], r["no"]) for r in second.collect()) == {"a": 1, "c": 2, None: 3, "b": 4, "d": 5}
    assert rows(numbering.stable_numbers(second, more, ["k"], "no")) == rows(second)
    assert numbering.stable_numbers(None, more.limit(0), ["k"], "no").count() == 0


@pytest.mark.parametrize("most", [5_000_000, 7])
def test_as_of_lookup(spark, most):
    rng = random.Random(8)
    versions, facts = [], []
    for k in ("a", "b", None):
        cuts = sorted(rng.sample(range(100), 12))
        # Every third stretch is a gap.
        versions += [(k, s, e, f"{k}{s}") for i, (s, e) in enumerate(zip(cuts, [*cuts[1:], None])) if i % 3]
    for i in range(150):
        facts.append((i, rng.choice(["a", "a", "a", "b", "c", None]), rng.choice([*range(110), None])))
    found = as_of.as_of_lookup(
        spark.createDataFrame(facts, "f long, k string, t long"), spark.createDataFrame(versions, "k string, f0 long, u long, v string"), ["k"], "t", ["v"], "f0", "u", most
    )
    want = []
    for f, k, t in facts:
        hit = [v for key, s, e, v in versions if k is not None and t is not None and key == k and s <= t and (e is None or t < e)]
        want.append((f, k, t, hit[0] if hit else None))
    assert rows(found, "f", "k", "t", "v") == sorted(want, key=lambda r: tuple((v is None, str(v)) for v in r))
    assert any(w[3] for w in want)


def test_a_batch_for_buckets_is_written_once_and_merged_once(spark, tmp_path, monkeypatch):
    rng, root, args = random.Random(7), str(tmp_path / "h"), (["k"], ["s"], ["t", "n"])
    log = [(rng.choice(["a", "b", None]), rng.randint(1, 40), rng.choice(["x", "y"]), i, False) for i in range(90)]
    written, merged = [], []
    monkeypatch.setattr(buckets, "materialize", lambda df, label: written.append(label) or materialize(df, label))
    monkeypatch.setattr(buckets, "last_observations", lambda *a: merged.append(1) or observations.last_observations(*a))
    for name, part in (("late", log[50:]), ("early", log[:50]), ("late", log[50:])):
        buckets.late_history_buckets(spark.createDataFrame(part, LOG), root, *args, name, 4)
    assert written == ["bucket-batch"] * 2 and len(merged) == 2
    want = observations.apply_late(None, None, spark.createDataFrame(log, LOG), *args)[0]
    assert rows(buckets.read_buckets(spark, f"{root}/versions"), *want.columns) == rows(want, *want.columns)
