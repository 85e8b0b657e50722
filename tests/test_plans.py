"""The shape of plans, where it decides whether an operator scales."""

import os
import re

import pytest
from pyspark.sql import functions as F

from stratalake.operators import changes, history, latest, lookup, numbering, quality
from stratalake.plans import state
from verification import inputs

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(spark, df):
    return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_latest_limits_groups_before_the_shuffle(spark):
    text = plan(latest.latest_records(inputs.bronze_opportunities(spark, SF), ["Id"]))
    order = [text.index(word) for word in ("1, Final", "Exchange hashpartitioning", "1, Partial")]
    assert order == sorted(order)


def test_consumers_of_few_columns_shuffle_few_columns(spark):
    from stratalake.plans import silver

    text = formatted(spark, silver.dim_customer(inputs.bronze_users(spark, SF)).select("customer_id", "customer_sk"))
    shuffled = re.search(r"\) Exchange\nInput \[(\d+)\]: \[(.*)\]", text)
    # The key, the two arrival columns and the tie-break.
    assert int(shuffled[1]) == 4 and "website" not in shuffled[2]


def test_numbering_has_no_single_task_over_the_data(spark):
    out = numbering.global_row_number(spark.range(1000).withColumn("v", F.col("id") % 7), ["v", "id"], "n")
    text = plan(out)
    # The only single partition holds one count per range.
    assert text.count("SinglePartition") == 1
    single = text.index("SinglePartition")
    assert "HashAggregate" in text[single:] and "count(1)" in text[single:]


def test_a_bulk_history_shuffles_once(spark):
    log = inputs.table(spark, SF, "events").select("user_id", "event_type", "ts", "event_id")
    text = plan(history.scd2_from_log(log, ["user_id"], ["event_type"], ["ts", "event_id"]))
    assert text.count("Exchange hashpartitioning") == 1 and text.count("Sort [") == 1
    cut = plan(history.scd2_from_log(log, ["user_id"], ["event_type"], ["ts", "event_id"], max_rows_per_group=5))
    # All rows move by (key, range); only summaries move by key alone.
    assert "_bucket" in cut and "SinglePartition" not in cut


def test_an_upsert_does_not_shuffle_a_large_target(spark):
    target = inputs.table(spark, SF, "orders").select("o_orderkey", "o_orderstatus")
    few = inputs.table(spark, SF, "region").select(F.col("r_regionkey").cast("bigint").alias("o_orderkey"), F.col("r_name").alias("op"))
    delta = few.withColumnRenamed("op", "o_orderstatus")
    assert "Exchange hashpartitioning" not in plan(changes.scd1_upsert(target, delta, ["o_orderkey"], check_unique=False))
    feed = few.withColumn("seq", F.lit(5).cast("bigint"))
    table = target.withColumn("seq", F.lit(1).cast("bigint"))
    text = plan(changes.apply_changes(table, feed, ["o_orderkey"], "op", "seq"))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_a_small_merge_does_not_shuffle_the_history(spark):
    past = (
        inputs.table(spark, SF, "orders")
        .select("o_orderkey", F.col("o_orderstatus").alias("h"), F.lit(1).alias("effective_from"))
        .withColumn("effective_to", F.lit(None).cast("int"))
        .withColumn("is_current", F.lit(True))
    )
    few = inputs.table(spark, SF, "region").select(
        F.col("r_regionkey").cast("bigint").alias("o_orderkey"), F.col("r_name").alias("h"), F.lit(2).alias("effective_from")
    )
    out = changes.scd2_merge(past, few, ["o_orderkey"], "h", check_unique=False, small_source=True)
    assert "Exchange hashpartitioning" not in plan(out)
    assert out.count() == past.count() + 5


def test_pushdown_of_a_watermark(spark):
    import datetime as dt

    events = inputs.table(spark, SF, "events").select("event_id", "ts")
    text = plan(state.incremental_extract(events, "ts", dt.datetime(2024, 1, 10)))
    assert "GreaterThan(ts" in text and "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text


def test_quality_report_is_one_pass(spark):
    rules = {f"r{i}": f"l_quantity > {i}" for i in range(5)}
    text = plan(quality.quality_report(inputs.table(spark, SF, "lineitem"), rules))
    assert text.count("FileScan") == 1 and "ReadSchema: struct<l_quantity:double>" in text


@pytest.fixture()
def skewed_settings(spark):
    wanted = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_hot_lookup_keys_are_split_at_run_time(spark, skewed_settings):
    fact = spark.range(0, 120_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, None).otherwise(F.col("id")).alias("p"),
        F.concat(F.lit("row"), "id").alias("line"),
    )
    dim = spark.range(1000).select(F.col("id").alias("p"), F.concat(F.lit("sk"), "id").alias("sk"))
    out = lookup.lookup_key(fact, dim, "p", "sk")
    assert out.filter("sk = 'sk7'").count() == 40_000
    collected = out.select(F.count(F.lit(1)), F.count("sk"))
    collected.collect()
    assert "skew=true" in plan(collected)


def test_shuffles_grow_with_the_input_and_not_with_joins(spark):
    from stratalake.session import partitions_for

    orders = inputs.bronze_orders(spark, SF)
    assert partitions_for(orders) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert partitions_for(orders, target_bytes=1000) > 100


def test_the_smallest_watermark_reaches_the_scan(spark):
    from datetime import datetime, timezone

    from stratalake.plans import state

    events = spark.read.parquet(f"{SF}/events.parquet")
    marks = [(t, datetime(2024, 1, d, tzinfo=timezone.utc)) for t, d in (("view", 5), ("click", 9))]
    known = spark.createDataFrame(marks, "api_id string, watermark timestamp")
    out = state.incremental_extract_all(events, "event_type", "ts", known, complete=True)
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts,2024-01-05" in plan(out)
    open_ = known.unionByName(spark.createDataFrame([("new", None)], known.schema))
    assert "GreaterThan(ts," not in plan(state.incremental_extract_all(events, "event_type", "ts", open_, complete=True))


def test_the_fan_out_error_reads_the_fact_once(spark):
    from stratalake.operators import reconcile

    fact = spark.read.parquet(f"{SF}/lineitem.parquet").selectExpr("l_orderkey as order_id", "l_extendedprice as order_total")
    assert plan(reconcile.fan_out_error(fact)).count("FileScan") == 1


def test_merge_reads_its_sides_once_each(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet").selectExpr("o_orderkey as business_key", "o_orderstatus as record_hash")
    _, metrics = changes.run_merge(orders, orders, "TYPE1")
    # The metrics read the classified rows that were written, and count the target.
    assert plan(metrics).count("orders.parquet") == 1


def test_order_documents_are_put_together_in_tasks_of_so_many_bytes(spark, monkeypatch):
    """Adaptive execution merges no tasks of a count that is given."""
    bytes_ = sum(os.path.getsize(f"{SF}/{t}.parquet") for t in ("orders", "lineitem"))
    monkeypatch.setattr(inputs, "TASK_BYTES", 4096)
    wanted = -(-bytes_ // 4096)
    assert wanted > 20 and inputs.orders_with_lines(spark, SF).rdd.getNumPartitions() == wanted
    assert inputs.orders_with_lines(spark, SF).count() == inputs.table(spark, SF, "orders").count()
