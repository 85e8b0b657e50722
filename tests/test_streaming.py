"""Streaming ingestion, keyed state, sinks and published versions."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import at, rows
from stratalake.operators.latest import latest_records
from stratalake.operators.quality import ExpectationFailed
from stratalake.plans import medallion
from stratalake.sources import sinks
from stratalake.sources.schemas import USER_FEED
from stratalake.streaming import bronze, state


def land(folder, name, payload):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(payload if isinstance(payload, str) else json.dumps(payload))


def test_bronze_takes_new_files_once_and_evolves(spark, tmp_path):
    landing = tmp_path / "landing"

    def run():
        return bronze.run_bronze(spark, str(landing), str(tmp_path / "t"), str(tmp_path / "state"), "api")

    land(landing, "1.json", [{"id": 1, "v": 1}, {"id": 2, "v": 2}])
    land(landing, "2.json", [[{"id": 3, "v": 3}], [{"id": 4, "v": 4}]])
    first = run()
    assert rows(first, "id", "v", "_rescued_data", "_api_id") == [(i, i, None, "api") for i in (1, 2, 3, 4)]
    assert set(first.columns) == {"id", "v", "_rescued_data", "_source_file", "_api_id", "ingestion_timestamp"}
    assert run().count() == 4
    land(landing, "3.json", {"id": 5, "v": "text", "extra": {"a": 1}})
    land(landing, "4.json", "{broken")
    second = run()
    assert second.count() == 6
    new = second.filter("_source_file LIKE '%3.json'").first()
    assert (new.id, new.v, new.extra.a, new._rescued_data) == (5, None, 1, '{"v":"text"}')
    assert second.filter("_source_file LIKE '%4.json'").first()._rescued_data == "{broken"


def test_unknown_keys_after_inference_are_rescued(spark, tmp_path):
    land(tmp_path / "in", "1.json", {"id": 1, "late": [1]})
    schema = spark.range(1).schema
    stream = bronze.json_stream(spark, str(tmp_path / "in"), schema, "api")
    stream.writeStream.format("parquet").option("path", str(tmp_path / "t")).option(
        "checkpointLocation", str(tmp_path / "c")
    ).trigger(availableNow=True).start().awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "t")), "id", "_rescued_data") == [(1, '{"late":[1]}')]


def test_finished_files_can_be_archived(spark, tmp_path):
    options = {"cleanSource": "archive", "sourceArchiveDir": str(tmp_path / "done"), "maxFilesPerTrigger": "1"}
    for i in range(3):
        land(tmp_path / "in", f"{i}.json", {"id": i})
        table = bronze.run_bronze(
            spark, str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "s"), "api", source_options=options
        )
        assert table.count() == i + 1
    assert bronze.read_bronze(spark, str(tmp_path / "t")).count() == 3


def test_bronze_by_day_prunes(spark, tmp_path):
    land(tmp_path / "in", "1.json", {"id": 1})
    table = bronze.run_bronze(spark, str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "s"), "api", by_day=True)
    assert table.filter("ingestion_date >= date '2020-01-01'").count() == 1
    pruned = table.filter("ingestion_date < date '2020-01-01'")
    assert "PartitionFilters: [isnotnull(ingestion_date" in pruned._jdf.queryExecution().executedPlan().toString()


def test_fan_out_isolates_a_bad_source(spark, tmp_path):
    land(tmp_path / "landing" / "good", "1.json", {"payload": {"items": [{"id": 1}, {"id": 2}]}})
    land(tmp_path / "landing" / "off", "1.json", {"payload": {"items": [{"id": 9}]}})
    config = spark.createDataFrame(
        [("good", "lake", "b", "t1", "payload.items", True), ("off", "lake", "b", "t2", None, False)],
        "api_id string, bronze_catalog string, bronze_schema string, bronze_table string, record_path string, enabled boolean",
    )
    tables = bronze.bronze_tables(spark, config, str(tmp_path / "landing"), str(tmp_path / "tables"))
    assert list(tables) == ["good"]
    assert rows(tables["good"], "id", "_api_id") == [(1, "good"), (2, "good")]
    assert tables["good"].filter("_rescued_data IS NOT NULL").count() == 0


def test_fixed_schema_stream(spark, tmp_path):
    land(tmp_path / "in", "1.json", json.dumps({"@odata.context": "c", "value": [{"id": "u1"}]}, indent=2))
    stream = bronze.with_lineage(bronze.fixed_schema_stream(spark, str(tmp_path / "in"), USER_FEED), "users")
    stream.writeStream.format("memory").queryName("users").trigger(availableNow=True).start().awaitTermination()
    row = spark.table("users").first()
    assert row["value"][0].id == "u1" and row._source_file.endswith("1.json")


SCHEMA = "id int, v string, ingestion_timestamp timestamp, _source_file string"


def test_latest_stream_over_several_runs(spark, tmp_path):
    data = [(i % 5, f"v{n}-{i}", at(f"2026-01-0{1 + n}"), f"f{n}") for n in (1, 0, 2) for i in range(20)]
    everything = spark.createDataFrame(data, SCHEMA)
    for n in (1, 0, 2):
        everything.filter(f"_source_file = 'f{n}'").coalesce(2).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(everything.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        state.latest_stream(stream, ["id"], str(tmp_path / "s"), str(tmp_path / "c")).awaitTermination()
    expected = rows(latest_records(everything, ["id"]))
    assert rows(state.read_latest(spark, str(tmp_path / "s"), ["id"])) == expected
    state.compact_latest(spark, str(tmp_path / "s"), str(tmp_path / "s2"), ["id"])
    assert rows(state.read_latest(spark, str(tmp_path / "s2"), ["id"])) == expected
    assert len(sinks.versions(spark, str(tmp_path / "s2"))) == 1


def test_streaming_history(spark, tmp_path):
    for day, values in enumerate(["ab", "ac", "ac", "bc"], start=1):
        part = spark.createDataFrame([(k, v, at(f"2026-01-0{day}"), f"f{day}") for k, v in enumerate(values)], SCHEMA)
        part.write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(part.schema).parquet(str(tmp_path / "in"))
        state.scd2_stream(stream, ["id"], ["v"], str(tmp_path / "h"), str(tmp_path / "c")).awaitTermination()
    found = state.read_history(spark, str(tmp_path / "h"))
    got = [(r[0], r[1], r[2].day, r[3] and r[3].day) for r in rows(found, "id", "v", "__START_AT", "__END_AT")]
    assert got == [(0, "a", 1, 4), (0, "b", 4, None), (1, "b", 1, 2), (1, "c", 2, None)]


def test_load_modes(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_by_load_type(spark.range(3), path, None)
    sinks.write_by_load_type(spark.range(2), path, "incremental")
    assert spark.read.parquet(path).count() == 5
    sinks.write_by_load_type(spark.range(2), path, " Full ")
    assert spark.read.parquet(path).count() == 2
    sinks.write_empty(spark, path, "INCREMENTAL")
    assert spark.read.parquet(path).count() == 2
    sinks.write_empty(spark, path, "FULL")
    assert spark.read.parquet(path).schema.simpleString() == "struct<id:bigint>" and spark.read.parquet(path).count() == 0
    sinks.write_empty(spark, str(tmp_path / "new"), "FULL")
    assert spark.read.parquet(str(tmp_path / "new")).columns == ["ingestion_timestamp"]


def test_catalog_table_load_modes(spark):
    for load, expected in ((None, 3), ("INCREMENTAL", 6), ("FULL", 3)):
        sinks.save_table_by_load_type(spark.range(3), "load_modes", load)
        assert spark.table("load_modes").count() == expected
    spark.sql("DROP TABLE load_modes")


def test_a_version_that_breaks_a_rule_is_never_read(spark, tmp_path):
    root = str(tmp_path / "t")
    rules = {"small": "id < 5"}
    sinks.publish(spark.range(3), root, 1, rules)
    with pytest.raises(ExpectationFailed) as failed:
        sinks.publish(spark.range(9), root, 2, rules)
    assert failed.value.failures == {"small": 4}
    assert sinks.versions(spark, root) == [1] and sinks.read_published(spark, root).count() == 3
    sinks.publish(spark.range(4), root, 2, rules)
    sinks.publish(spark.range(4), root, 2, rules)
    assert sinks.read_published(spark, root).count() == 4
    assert sinks.read_published(spark, root, before=2).count() == 3
    assert sinks.read_published(spark, str(tmp_path / "none")) is None


def test_raw_payloads(spark, tmp_path):
    sinks.append_raw(spark.createDataFrame([(1, "a")], "id int, v string"), "api", str(tmp_path / "raw"))
    row = spark.read.parquet(str(tmp_path / "raw")).first()
    assert (row.api_name, row.raw_payload) == ("api", '{"id":1,"v":"a"}') and row.ingest_timestamp is not None


def test_a_whole_batch(spark, tmp_path):
    from verification import inputs

    sf = "/root/testdata/sf0.001"
    args = [f(spark, sf) for f in (inputs.bronze_users, inputs.bronze_products, inputs.bronze_orders)]
    layers = medallion.run_batch(spark, *args, str(tmp_path), 1, "job-1")
    failed = {r.check_name for r in layers.reconciliation.filter("NOT passed").collect()}
    assert failed == {"bronze_orders_vs_silver_orders"}  # orders without lines
    assert layers.order_kpis.count() == layers.fact_order.select("order_id").distinct().count()
    audit = spark.read.parquet(str(tmp_path / "job_execution")).first()
    assert (audit.status, audit.job_run_id, audit.failure_stage) == ("SUCCESS", "job-1", None)

    orders = args[2].withColumn("products", F.transform("products", lambda p: p.withField("quantity", F.lit(0).cast("bigint"))))
    with pytest.raises(ExpectationFailed):
        medallion.run_batch(spark, args[0], args[1], orders, str(tmp_path), 2, "job-2")
    assert sinks.versions(spark, str(tmp_path / "fact_order")) == [1]
    failure = spark.read.parquet(str(tmp_path / "job_execution")).filter("job_run_id = 'job-2'").first()
    assert (failure.status, failure.failure_stage, failure.failure_type) == ("FAILED", "fact_order", "ExpectationFailed")

    before = rows(layers.order_kpis, "order_id", "order_total", "units_sold")
    again = medallion.run_batch(spark, *args, str(tmp_path), 1, "job-1")
    assert rows(again.order_kpis, "order_id", "order_total", "units_sold") == before
    attempts = spark.read.parquet(str(tmp_path / "job_execution"))
    assert attempts.filter("job_run_id = 'job-1'").count() == 2
    newest = latest_records(attempts, ["job_run_id"], ["end_time", "run_id"])
    assert rows(newest, "job_run_id", "status") == [("job-1", "SUCCESS"), ("job-2", "FAILED")]


def test_a_new_checkpoint_goes_on_after_the_old_versions(spark, tmp_path):
    schema = "k int, v string, ingestion_timestamp bigint, _source_file string"
    root = str(tmp_path / "h")
    state_root = str(tmp_path / "latest")
    for n in range(1, 4):
        landing = str(tmp_path / f"landing{n}")
        spark.createDataFrame([(1, f"a{n}", n, "f"), (10 + n, "new", n, "f")], schema).write.parquet(landing)
        stream = spark.readStream.schema(schema).parquet(landing)
        state.scd2_stream(stream, ["k"], ["v"], root, str(tmp_path / f"c{n}")).awaitTermination()
        state.latest_stream(stream, ["k"], state_root, str(tmp_path / f"l{n}")).awaitTermination()
    found = rows(state.read_history(spark, root), "k", "v")
    assert found == [(1, "a1"), (1, "a2"), (1, "a3"), (11, "new"), (12, "new"), (13, "new")]
    assert rows(state.read_latest(spark, state_root, ["k"]), "k", "v") == [(1, "a3"), (11, "new"), (12, "new"), (13, "new")]
    with pytest.raises(ValueError, match="below the newest"):
        state.fold_snapshot(spark, root, 1, spark.createDataFrame([(1, "x", 9, "f")], schema), ["k"], ["v"])


def test_a_gained_column_is_stored_and_compared(spark, tmp_path):
    root = str(tmp_path / "h")
    first = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k int, v string, ingestion_timestamp bigint")
    state.fold_snapshot(spark, root, 1, first, ["k"], ["v"])
    for version in (2, 3, 4):
        wider = spark.createDataFrame([(1, "a", "x", version), (2, "b", None, version)], "k int, v string, w string, ingestion_timestamp bigint")
        state.fold_snapshot(spark, root, version, wider, ["k"], ["v", "w"])
    assert rows(state.read_history(spark, root), "k", "v", "w") == [(1, "a", "x"), (1, "a", None), (2, "b", None)]


def test_broken_documents_arrive_beside_records(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.json").write_text('{"items":[{"id":1},{"id":2}]}\n{"items":[{"id":3}\n{"items":[]}\n')
    found = bronze.run_bronze(
        spark, str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "s"), "x", record_path="items", whole_document=False
    )
    assert rows(found, "id", "_rescued_data") == [(1, None), (2, None), (None, '{"items":[{"id":3}')]


def test_numbers_that_would_change_are_rescued(spark):
    from stratalake.sources.rescue import typed_with_rescue

    texts = ['{"x":9007199254740993}', '{"x":9007199254740991}', '{"x":12345678901234567.89}', '{"x":0.1}', '{"x":5}', '{"x":1e300}']
    df = spark.createDataFrame([(t,) for t in texts], "record string")
    got = typed_with_rescue(df, T.StructType([T.StructField("x", T.DoubleType())])).collect()
    assert [r["x"] for r in got] == [None, 9007199254740991.0, None, 0.1, 5.0, 1e300]
    assert [r["_rescued_data"] is None for r in got] == [False, True, False, True, True, True]
    big = ['{"x":12345678901234567890}', '{"x":5}', '{"x":5.5}']
    got = typed_with_rescue(spark.createDataFrame([(t,) for t in big], "record string"), T.StructType([T.StructField("x", T.DecimalType(38, 0))])).collect()
    assert [r["x"] and int(r["x"]) for r in got] == [12345678901234567890, 5, None]
    assert got[2]["_rescued_data"] == '{"x":5.5}'
