"""Checkpoints, effective state, configuration, audit and summaries."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import at, rows
from stratalake.plans import audit, state
from stratalake.sources import config

POINT = state.CHECKPOINT_SCHEMA


def effective(spark, points, **settings):
    row = {"api_id": "a", "load_type": "INCREMENTAL", **settings}
    schema = "api_id string, load_type string, overlap_minutes int, initial_load_value string"
    conf = spark.createDataFrame([tuple(row.get(c) for c in ("api_id", "load_type", "overlap_minutes", "initial_load_value"))], schema)
    saved = spark.createDataFrame([("a", t, v, at(w), r) for t, v, w, r in points], POINT)
    got = state.effective_state(config.with_defaults(conf), saved).first()
    return (got.watermark and got.watermark.strftime("%m-%d %H:%M"), got.cursor)


WATERMARK = ("WATERMARK", "2026-09-07T10:00:00", "2026-09-07T11:00", "r1")


def test_effective_state_rules(spark):
    assert effective(spark, [WATERMARK]) == ("09-07 10:00", None)
    assert effective(spark, [WATERMARK], overlap_minutes=15) == ("09-07 09:45", None)
    assert effective(spark, [WATERMARK], load_type="full") == (None, None)
    assert effective(spark, [WATERMARK], load_type=None) == (None, None)
    assert effective(spark, []) == (None, None)
    start = "2026-09-01T12:30:00+00:00"
    assert effective(spark, [], initial_load_value=start) == ("09-01 12:30", None)
    assert effective(spark, [], initial_load_value=start, overlap_minutes=30) == ("09-01 12:00", None)
    cursor = ("CURSOR", "cursor-123", "2026-09-08T00:00", "r2")
    assert effective(spark, [WATERMARK, cursor], initial_load_value=start) == (None, "cursor-123")
    assert effective(spark, [cursor], load_type="FULL") == (None, None)
    later = ("WATERMARK", "2026-09-09T00:00:00Z", "2026-09-08T00:00", "r3")
    assert effective(spark, [later, cursor, WATERMARK]) == ("09-09 00:00", None)


def test_checkpoints_are_only_written_for_cursor_state(spark):
    conf = config.with_defaults(
        spark.createDataFrame([("a", "cursor"), ("b", "OFFSET"), ("c", None), ("d", "CURSOR"), ("", "CURSOR")], "api_id string, pagination_type string")
    )
    cursors = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "x"), ("d", None), ("", "x"), (None, "x")], "api_id string, state_value string")
    out = state.cursor_checkpoints(conf, cursors, "run", F.current_timestamp())
    assert rows(out, "api_id", "state_type", "state_value", "run_id") == [("a", "CURSOR", "x", "run")]
    batch = spark.createDataFrame([("s", at("2026-01-01")), ("s", at("2026-01-03T01:02:03.004005")), ("t", None)], "src string, ts timestamp")
    marks = state.watermark_checkpoints(batch, "src", "ts", "run", F.current_timestamp())
    assert rows(marks, "api_id", "state_value") == [("s", "2026-01-03T01:02:03.004005Z")]


def test_incremental_extract(spark):
    df = spark.createDataFrame([(i, at(f"2026-01-0{i}")) for i in range(1, 6)], "id int, ts timestamp")
    assert state.incremental_extract(df, "ts", None).count() == 5
    assert rows(state.incremental_extract(df, "ts", dt.datetime(2026, 1, 3)), "id") == [(4,), (5,)]


def test_config_defaults_and_lookups(spark):
    raw = spark.createDataFrame(
        [("a", "orders", '{"k":"v"}', "", True, "daily", "g1"), ("b", "users", None, "next", True, "daily", "g2"), ("c", "old", None, None, False, "daily", "g1")],
        "api_id string, api_name string, headers_json string, cursor_field string, enabled boolean, schedule string, execution_group string",
    )
    full = config.with_defaults(raw)
    assert full.columns == list(config.CONFIG_COLUMNS)
    row = full.filter("api_id = 'a'").first()
    assert (row.load_type, row.download_mode, row.landing_container, row.cursor_field, row.cursor_parameter) == (
        "FULL", "BUFFER", "landing", "next_cursor", "cursor",
    )
    assert row.headers_json == {"k": "v"} and row.query_parameters == {} and row.schema_version == 1
    assert [r.api_name for r in config.enabled_sources(raw).collect()] == ["orders", "users"]
    assert [r.api_name for r in config.enabled_sources(raw, "daily", "g1").collect()] == ["orders"]
    assert config.enabled_sources(raw, "hourly").count() == 0
    assert config.single_source(raw, "api_name = 'users'", "users").api_id == "b"
    with pytest.raises(LookupError, match="no enabled"):
        config.single_source(raw, "api_name = 'old'", "old")
    with pytest.raises(LookupError, match="several"):
        config.single_source(raw.union(raw), "api_name = 'users'", "users")
    with pytest.raises(Exception):
        config.with_defaults(raw.withColumn("headers_json", F.lit("{bad"))).collect()


def test_routes(spark):
    schema = "api_id string, bronze_catalog string, bronze_schema string, bronze_table string, record_path string, enabled boolean"
    good = [("b", "c", "s", "t2", None, True), (" a ", "c", "s", "t1", " x . y ", True), ("z", "c", "s", "t", "bad..path", False)]
    routes = config.bronze_routes(spark.createDataFrame(good, schema))
    assert sorted((r.api_id, r.name, r.record_path) for r in routes) == [("a", "c.s.t1", "x.y"), ("b", "c.s.t2", None)]
    assert config.route_for(routes, "a").table == "t1"
    with pytest.raises(LookupError):
        config.route_for(routes, "z")
    with pytest.raises(LookupError, match="several"):
        config.bronze_routes(spark.createDataFrame(good + [("b", "c", "s", "t3", None, True)], schema))
    with pytest.raises(ValueError):
        config.bronze_routes(spark.createDataFrame([("a.b", "c", "s", "t", None, True)], schema))


def test_audit_is_written_on_success_and_failure(spark, tmp_path):
    path = str(tmp_path / "audit")
    with audit.audited(spark, path, "orders", "job", "j1") as run:
        run.update(records_read=10, pages_read=2, landing_file="f.json", landing_file_size_bytes=2048)
    with pytest.raises(RuntimeError, match="boom"):
        with audit.audited(spark, path, "orders", "job", "j2") as run:
            run["stage"] = "LANDING"
            raise RuntimeError("boom")
    got = {r.job_run_id: r for r in spark.read.parquet(path).collect()}
    assert got["j1"].status == "SUCCESS" and got["j1"].records_read == 10
    assert (got["j2"].status, got["j2"].failure_stage, got["j2"].failure_type, got["j2"].error_message) == (
        "FAILED", "LANDING", "RuntimeError", "boom",
    )
    assert len(spark.read.parquet(path).columns) == 20

    stages = spark.createDataFrame(
        [("j1", "SUCCESS", "SUCCESS", "SUCCESS", "SUCCESS", "SUCCESS", "PASSED", "PASSED"),
         ("j2", "FAILED", "FAILED", "SKIPPED", "SKIPPED", "SKIPPED", "NOT_EVALUATED", "NOT_EVALUATED")],
        "job_run_id string, overall_status string, ingestion_status string, bronze_status string, silver_status string,"
        "gold_status string, dq_status string, reconciliation_status string",
    )
    text = {r.job_run_id: r for r in audit.run_summary(spark.read.parquet(path), stages).collect()}
    assert text["j1"].subject == "API Ingestion Run Summary - SUCCESS - j1"
    for line in ("Job: job", "API records read: 10", "Landing file size (bytes): 2048", "DQ status: PASSED", "Failure stage: N/A"):
        assert line in text["j1"].body
    for line in ("API records read: N/A", "Bronze: SKIPPED", "Failure stage: LANDING", "Error message: boom"):
        assert line in text["j2"].body
