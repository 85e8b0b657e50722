"""Change detection, merges, feeds and histories."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import at, rows
from stratalake.operators import changes, history
from stratalake.operators.shape import with_record_hash
from stratalake.streaming import state as stream_state


def hashed(spark, data):
    return spark.createDataFrame(data, "business_key int, v string, record_hash string")


def test_every_row_gets_a_class_null_hashes_too(spark):
    source = hashed(spark, [(1, "a", "h1"), (2, "b", "h2x"), (3, "c", "h3"), (4, "d", None), (5, "e", None)])
    target = hashed(spark, [(1, "a", "h1"), (2, "b", "h2"), (4, "d", None), (5, "e", "h5"), (9, "z", "h9")])
    found = changes.detect_changes(source, target, detect_deletes=True)
    assert rows(found, "business_key", "change_type") == [
        (1, "unchanged"), (2, "changed"), (3, "new"), (4, "unchanged"), (5, "changed"), (9, "deleted"),
    ]
    metrics = changes.change_metrics(found, target).first().asDict()
    assert metrics == {"source_rows": 5, "target_rows": 5, "new_rows": 1, "changed_rows": 2, "unchanged_rows": 2, "stale_rows": 0}


def test_record_hash_tells_nulls_and_columns_apart(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("", "a"), ("a", None)], "x string, y string")
    hashes = [r.record_hash for r in with_record_hash(df, ["x", "y"]).collect()]
    assert len(set(hashes)) == 3 and hashes[0] == hashes[3]
    times = spark.createDataFrame([(at("2026-01-01T00:00:00.000001"),), (at("2026-01-01T00:00:00.000002"),)], "t timestamp")
    assert with_record_hash(times, ["t"]).select("record_hash").distinct().count() == 2


def test_scd1_replaces_inserts_and_rejects_duplicates(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    source = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    assert rows(changes.scd1_upsert(target, source, ["k"])) == [(1, "a"), (2, "B"), (3, "C")]
    with pytest.raises(ValueError, match="duplicate keys"):
        changes.scd1_upsert(target, source.union(source), ["k"])


HISTORY = "business_key int, v string, record_hash string, effective_from int, effective_to int, is_current boolean"


def test_scd2_merge_inserts_the_new_version_and_replays(spark):
    target = spark.createDataFrame(
        [(1, "a", "h1", 1, None, True), (2, "b0", "h0", 0, 1, False), (2, "b", "h2", 1, None, True), (4, "d", "h4", 0, 1, False)],
        HISTORY,
    )
    source = spark.createDataFrame(
        [(1, "a", "h1", 5), (2, "B", "hX", 5), (3, "c", "h3", 5), (4, "D", "h4", 5)],
        "business_key int, v string, record_hash string, effective_from int",
    )
    once = changes.scd2_merge(target, source)
    expected = [
        (1, "a", 1, None, True), (2, "B", 5, None, True), (2, "b", 1, 5, False), (2, "b0", 0, 1, False),
        (3, "c", 5, None, True), (4, "D", 5, None, True), (4, "d", 0, 1, False),
    ]
    columns = ["business_key", "v", "effective_from", "effective_to", "is_current"]
    assert rows(once, *columns) == expected
    assert rows(changes.scd2_merge(once, source), *columns) == expected
    small = changes.scd2_merge(target, source, small_source=True)
    assert rows(small, *columns) == expected
    assert rows(changes.scd2_merge(small, source, small_source=True), *columns) == expected
    merged, metrics = changes.run_merge(source, target, "type2")
    assert rows(merged, *columns) == expected
    assert metrics.first().asDict() == {
        "source_rows": 4, "target_rows": 4, "new_rows": 2, "changed_rows": 1, "unchanged_rows": 1,
        "stale_rows": 0,
    }


def test_unknown_strategy(spark):
    with pytest.raises(ValueError, match="unsupported"):
        changes.run_merge(hashed(spark, []), hashed(spark, []), "type3")


def test_apply_changes(spark):
    feed = spark.createDataFrame(
        [(1, "I", 1, "a"), (1, "U", 3, "c"), (1, "U", 2, "b"), (2, "I", 1, "x"), (2, "d", 2, None), (3, None, 1, "n")],
        "k int, op string, seq int, v string",
    )
    hard = changes.apply_changes(None, feed, ["k"], "op", "seq")
    assert rows(hard, "k", "seq", "v") == [(1, 3, "c"), (3, 1, "n")]
    soft = changes.apply_changes(None, feed, ["k"], "op", "seq", "SOFT")
    assert rows(soft, "k", "seq", "is_deleted") == [(1, 3, False), (2, 2, True), (3, 1, False)]
    late = spark.createDataFrame([(1, "U", 2, "late"), (2, "U", 1, "late"), (3, "U", 5, "new"), (4, "I", 1, "q")], feed.schema)
    after = changes.apply_changes(soft, late, ["k"], "op", "seq", "soft")
    assert rows(after, "k", "seq", "v", "is_deleted") == [
        (1, 3, "c", False), (2, 2, None, True), (3, 5, "new", False), (4, 1, "q", False),
    ]
    with pytest.raises(ValueError, match="delete handling"):
        changes.apply_changes(None, feed, ["k"], "op", "seq", "keep")


def test_stale_rows_are_reported(spark):
    target = spark.createDataFrame([(1, "a", "h1", 5, None, True), (2, "b", "h2", 5, None, True)], HISTORY)
    source = spark.createDataFrame([(1, "z", "hz", 4), (2, "y", "hy", 5)], "business_key int, v string, record_hash string, effective_from int")
    merged, metrics = changes.run_merge(source, target, "type2")
    assert rows(merged, "business_key", "v", "effective_from", "effective_to") == [(1, "a", 5, None), (2, "y", 5, None)]
    assert metrics.first().asDict() == {
        "source_rows": 2, "target_rows": 2, "new_rows": 0, "changed_rows": 1, "unchanged_rows": 0, "stale_rows": 1,
    }


def test_feed_edges(spark):
    schema = "k int, op string, seq int, v string"
    first = changes.apply_changes(None, spark.createDataFrame([(1, "I", 5, "a"), (None, "I", 1, "n"), (3, "I", None, "q")], schema), ["k"], "op", "seq")
    again = spark.createDataFrame([(1, "U", None, "no"), (None, "I", 1, "n"), (3, "U", None, "no"), (3, "U", 1, "yes")], schema)
    after = changes.apply_changes(first, again, ["k"], "op", "seq")
    assert rows(after, "k", "seq", "v") == [(1, 5, "a"), (3, 1, "yes"), (None, 1, "n")]


def test_a_late_operation_does_not_revive_a_deleted_key(spark):
    schema = "k int, op string, seq int, v string"
    table, graves = changes.apply_changes_with_tombstones(
        None, None, spark.createDataFrame([(1, "I", 1, "a"), (1, "D", 9, None), (2, "I", 1, "b")], schema), ["k"], "op", "seq"
    )
    assert rows(table, "k", "v") == [(2, "b")] and rows(graves) == [(1, 9)]
    late = spark.createDataFrame([(1, "U", 3, "late"), (2, "D", 4, None)], schema)
    table, graves = changes.apply_changes_with_tombstones(table, graves, late, ["k"], "op", "seq")
    assert rows(table) == [] and rows(graves) == [(1, 9), (2, 4)]
    table, graves = changes.apply_changes_with_tombstones(table, graves, spark.createDataFrame([(1, "I", 10, "new")], schema), ["k"], "op", "seq")
    assert rows(table, "k", "seq", "v") == [(1, 10, "new")] and rows(graves) == [(2, 4)]


SNAP = "k int, name string, other int, ingestion_timestamp timestamp"


def snapshot(spark, day, *data):
    return spark.createDataFrame([(*d, at(f"2026-01-{day:02d}")) for d in data], SNAP)


def fold(spark, *snapshots, **options):
    out = None
    for s in snapshots:
        out = history.scd2_from_snapshot(out, s, ["k"], ["name"], **options)
    return [(r[0], r[1], r[2].day, r[3] and r[3].day) for r in rows(out, "k", "name", history.START, history.END)]


@pytest.mark.parametrize("seed", range(3))
def test_both_joins_fold_alike(spark, seed):
    rng = random.Random(seed)
    snapshots = [
        snapshot(spark, rng.randint(1, 9), *[(k, rng.choice(["a", "b", None]), 0) for k in range(6) if rng.random() < 0.6])
        for _ in range(4)
    ]
    assert fold(spark, *snapshots) == fold(spark, *snapshots, small_incoming=True)


def test_snapshot_history(spark):
    one = snapshot(spark, 1, (1, "a", 0), (2, None, 0))
    two = snapshot(spark, 2, (1, "a", 9), (2, "b", 0), (3, "c", 0))
    assert fold(spark, one, two) == [(1, "a", 1, None), (2, "b", 2, None), (2, None, 1, 2), (3, "c", 2, None)]
    # Replays and late snapshots change nothing.
    assert fold(spark, one, two, two, one) == fold(spark, one, two)


def test_new_columns_join_the_history(spark):
    old = history.scd2_from_snapshot(None, snapshot(spark, 1, (1, "a", 0), (2, "b", 0)), ["k"], ["name"])
    wider = snapshot(spark, 2, (1, "A", 0)).withColumn("extra", F.lit("x"))
    out = history.scd2_from_snapshot(old, wider, ["k"], ["name"])
    assert rows(out, "k", "name", "extra") == [(1, "A", "x"), (1, "a", None), (2, "b", None)]


def test_a_correction_of_the_same_time_replaces_the_open_row(spark):
    one, fix, late = snapshot(spark, 2, (1, "a", 0)), snapshot(spark, 2, (1, "b", 0)), snapshot(spark, 1, (1, "z", 0))
    assert fold(spark, one, fix) == [(1, "b", 2, None)]
    assert fold(spark, one, fix, fix, late) == fold(spark, one, fix, small_incoming=True) == [(1, "b", 2, None)]


def test_null_keys_are_keys(spark):
    one, two = snapshot(spark, 1, (None, "a", 0)), snapshot(spark, 2, (None, "b", 0))
    for small in (False, True):
        assert fold(spark, one, one, two, two, small_incoming=small) == [(None, "a", 1, 2), (None, "b", 2, None)]
    table = spark.createDataFrame([(None, "a")], "k int, v string")
    assert rows(changes.scd1_upsert(table, table, ["k"])) == [(None, "a")]


def test_untracked_change_keeps_the_open_row(spark):
    out = None
    for s in (snapshot(spark, 1, (1, "a", 0)), snapshot(spark, 2, (1, "a", 9))):
        out = history.scd2_from_snapshot(out, s, ["k"], ["name"])
    assert rows(out, "other") == [(0,)]


def test_missing_keys_close_on_request_and_reopen(spark):
    one, two, three = snapshot(spark, 1, (1, "a", 0), (2, "b", 0)), snapshot(spark, 2, (1, "a", 0)), snapshot(spark, 3, (1, "a", 0), (2, "b", 0))
    assert fold(spark, one, two) == [(1, "a", 1, None), (2, "b", 1, None)]
    out = history.scd2_from_snapshot(None, one, ["k"], ["name"])
    out = history.scd2_from_snapshot(out, two, ["k"], ["name"], close_missing=True, missing_at=F.lit(at("2026-01-02")))
    out = history.scd2_from_snapshot(out, three, ["k"], ["name"])
    assert [(r[0], r[1].day, r[2] and r[2].day) for r in rows(out, "k", history.START, history.END)] == [
        (1, 1, None), (2, 1, 2), (2, 3, None),
    ]
    with pytest.raises(ValueError, match="missing_at"):
        history.scd2_from_snapshot(out, two, ["k"], ["name"], close_missing=True)


def random_log(seed, n=400):
    """One key holds a third of the rows; another is NULL."""
    rng = random.Random(seed)
    data = []
    for i in range(n):
        key = 0 if rng.random() < 0.34 else rng.choice([1, 2, 3, None])
        data.append((key, rng.choice(["a", "b", None]), i // 2, i))
    return data


def brute_force(data):
    out = []
    for key in {d[0] for d in data}:
        # Of one time the last row counts.
        mine = list({d[2]: d for d in sorted((d for d in data if d[0] == key), key=lambda d: (d[2], d[3]))}.values())
        kept = [d for i, d in enumerate(mine) if i == 0 or mine[i - 1][1] != d[1]]
        for i, d in enumerate(kept):
            out.append((d[0], d[1], d[3], d[2], kept[i + 1][2] if i + 1 < len(kept) else None))
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("limit", [1_000_000, 40, 7, 1])
def test_bulk_history_equals_brute_force_with_any_cutting(spark, limit):
    data = random_log(3)
    log = spark.createDataFrame(data, "k int, v string, seq bigint, id bigint").repartition(5)
    out = history.scd2_from_log(log, ["k"], ["v"], ["seq", "id"], "s", "e", max_rows_per_group=limit)
    assert rows(out, "k", "v", "id", "s", "e") == brute_force(data)


@pytest.mark.parametrize("limit", [1_000_000, 2])
def test_equal_values_and_equal_times_do_not_depend_on_the_limit(spark, limit):
    zeros = [(1, 0.0 if i % 2 else -0.0, i, i) for i in range(40)]
    log = spark.createDataFrame(zeros, "k int, v double, seq bigint, id bigint")
    out = history.scd2_from_log(log, ["k"], ["v"], ["seq", "id"], "s", "e", max_rows_per_group=limit)
    assert rows(out, "s", "e") == [(0, None)]
    same_time = spark.createDataFrame([(1, f"v{i}", 7, i) for i in range(40)], "k int, v string, seq bigint, id bigint")
    out = history.scd2_from_log(same_time, ["k"], ["v"], ["seq", "id"], "s", "e", max_rows_per_group=limit)
    assert rows(out, "v", "s", "e") == [("v39", 7, None)]


def test_bulk_history_equals_folding_every_snapshot(spark, tmp_path):
    data = [(k, v, i) for i, (k, v, _, _) in enumerate(random_log(5, 60)) if k is not None]
    log = spark.createDataFrame(data, "k int, v string, ingestion_timestamp bigint")
    bulk = history.scd2_from_log(log, ["k"], ["v"], ["ingestion_timestamp"], "s", "e")
    root = str(tmp_path / "h")
    for version, start in enumerate(range(0, 60, 12), start=1):
        # Within a step every key appears once: the steps are cut per key change.
        part = log.filter(f"ingestion_timestamp >= {start} AND ingestion_timestamp < {start + 12}")
        last = part.groupBy("k").agg(F.max_by("v", "ingestion_timestamp").alias("v"), F.max("ingestion_timestamp").alias("ingestion_timestamp"))
        for _ in range(2):  # every version is written twice, as a replay would
            stream_state.fold_snapshot(spark, root, version, last, ["k"], ["v"])
    folded = stream_state.read_history(spark, root)
    steps = log.withColumn("step", F.expr("ingestion_timestamp div 12"))
    lasts = steps.groupBy("k", "step").agg(F.max_by("v", "ingestion_timestamp").alias("v"), F.max("ingestion_timestamp").alias("ingestion_timestamp"))
    expected = history.scd2_from_log(lasts, ["k"], ["v"], ["ingestion_timestamp"], "s", "e")
    assert rows(folded, "k", "v", history.START, history.END) == rows(expected, "k", "v", "s", "e")
    assert bulk.count() >= expected.count()


def test_public_view_numbers_the_whole_history(spark):
    data = [("b", 2, None), ("a", 1, 5), ("a", 5, None), ("b", 1, 2)]
    hist = spark.createDataFrame(data, f"id string, {history.START} int, {history.END} int")
    out = history.scd2_view(hist, "id", "sk")
    assert rows(out, "sk", "id", "effective_start_ts", "is_active") == [
        (1, "a", 1, False), (2, "a", 5, True), (3, "b", 1, False), (4, "b", 2, True),
    ]


def test_configured_changes(spark):
    from stratalake.sources.config import change_settings

    schema = (
        "source_id string, cdc_mode string, operation_column string, sequence_column string, sequence_type string,"
        "delete_handling string, snapshot_key_column string, snapshot_strategy string, enabled boolean"
    )
    conf = spark.createDataFrame(
        [("feed", "feed", "op", "seq", "bigint", "HARD", None, "NONE", True), ("snap", "SNAPSHOT", None, "seq", "int", "NONE", "k", "TYPE1", True),
         ("hist", "SNAPSHOT", None, "seq", "int", "NONE", "k", "type2", True), ("off", "FEED", "op", "seq", "int", "HARD", None, "NONE", False)],
        schema,
    )
    # As text, "9" would come after "10".
    feed = spark.createDataFrame([(1, "U", "9", "old"), (1, "U", "10", "new"), (2, "D", "1", None)], "k int, op string, seq string, v string")
    assert rows(changes.apply_configured(None, feed, ["k"], change_settings(conf, "feed")), "k", "seq", "v") == [(1, 10, "new")]
    snap = feed.drop("op")
    first = changes.apply_configured(None, snap, [], change_settings(conf, "snap"))
    assert rows(first, "k", "v") == [(1, "new"), (2, None)]
    after = changes.apply_configured(first, snap.filter("seq = '9'"), [], change_settings(conf, "snap"))
    assert rows(after, "k", "v") == [(1, "old"), (2, None)]
    hist = changes.apply_configured(None, snap.filter("seq <> '10'"), [], change_settings(conf, "hist"))
    hist = changes.apply_configured(hist, snap.filter("seq = '10'"), [], change_settings(conf, "hist"))
    assert rows(hist, "k", "v", history.START, history.END) == [(1, "new", 10, None), (1, "old", 9, 10), (2, None, 1, None)]
    with pytest.raises(LookupError):
        change_settings(conf, "off")
