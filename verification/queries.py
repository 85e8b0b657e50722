"""The registered queries: name -> (spark, folder of tables) -> DataFrame.

Timestamps come out as TIMESTAMP_NTZ and load times are left out, so that
results compare with plain SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions import iso_text, json_map
from stratalake.operators import aggregates, as_of, changes, history, latest, lookup, numbering, observations, quality, reconcile, row_reconcile, shape
from stratalake.plans import audit, gold, incremental, medallion, merge, silver, state
from stratalake.session import configure, materialize, scratch_path
from stratalake.sources import config as source_config
from stratalake.sources import buckets, landing, rescue, sinks
from stratalake.sources import large_documents as large
from stratalake.streaming import bronze, state as stream_state
from verification import inputs
from verification.inputs import cents, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return _plain(function(configure(spark), sf))

    QUERIES[function.__name__] = run
    return run


def _plain(df: DataFrame) -> DataFrame:
    kept = [f for f in df.schema.fields if f.name != "processed_timestamp"]
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f"`{f.name}`")
            for f in kept
        ]
    )


# ---------------------------------------------------------------- models


@query
def latest_orders(spark, sf):
    return silver.latest_orders(inputs.bronze_orders(spark, sf)).select(
        "id", "userId", "date", "status", "total", F.size("products").alias("lines"), "_source_file", "ingestion_timestamp"
    )


@query
def dim_customer(spark, sf):
    return silver.dim_customer(inputs.bronze_users(spark, sf))


@query
def dim_product(spark, sf):
    return silver.dim_product(inputs.bronze_products(spark, sf))


def _models(spark, sf):
    customers = silver.dim_customer(inputs.bronze_users(spark, sf))
    products = silver.dim_product(inputs.bronze_products(spark, sf))
    return customers, products, silver.fact_order(inputs.bronze_orders(spark, sf), customers, products)


@query
def fact_order(spark, sf):
    return _models(spark, sf)[2]


@query
def gold_order_kpis(spark, sf):
    return gold.order_kpis(_models(spark, sf)[2])


@query
def gold_customer_sales(spark, sf):
    customers, _, fact = _models(spark, sf)
    return gold.customer_sales(gold.order_kpis(fact), customers)


@query
def gold_product_sales(spark, sf):
    _, products, fact = _models(spark, sf)
    return gold.product_sales(fact, products)


@query
def latest_opportunities(spark, sf):
    return silver.opportunity_latest(inputs.bronze_opportunities(spark, sf))


@query
def opportunity_scd2_view(spark, sf):
    """Every event as a state of its opportunity, as a public type 2 table."""
    log = inputs.bronze_opportunities(spark, sf).select(
        F.col("Id").alias("opportunity_id"), F.col("StageName").alias("stage_name"), "ingestion_timestamp", "_source_file"
    )
    versions = history.scd2_from_log(
        log, ["opportunity_id"], ["stage_name"], ["ingestion_timestamp", "_source_file"]
    )
    return silver.opportunity_view(versions).drop("_source_file", "ingestion_timestamp")


# ---------------------------------------------------------------- joins, generators, shapes


@query
def dimension_lookup(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    parts = table(spark, sf, "part").filter("p_size > 10").select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("part_sk")
    )
    return lookup.lookup_key(lines, parts, "l_partkey", "part_sk")


@query
def dimension_lookup_salted(spark, sf):
    """Line items by return flag, a key with few and therefore heavy values."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    flags = (
        table(spark, sf, "orders")
        .select(F.col("o_orderstatus").alias("l_returnflag"))
        .distinct()
        .unionByName(lines.select("l_returnflag").distinct().filter("l_returnflag <> 'R'"))
        .withColumn("flag_sk", F.concat(F.lit("flag-"), "l_returnflag"))
    )
    heavy = lookup.heavy_keys(lines, "l_returnflag")
    return lookup.salted_lookup(lines, flags, "l_returnflag", "flag_sk", heavy, salts=8)


@query
def record_path_extract(spark, sf):
    """Order documents nested one level deep; orders without lines give no row."""
    documents = inputs.bronze_orders(spark, sf).select(
        F.struct(F.col("products").alias("items")).alias("payload"), "_source_file", "_api_id", "ingestion_timestamp"
    )
    return shape.extract_records(documents, "payload.items")


@query
def explode_outer_flatten(spark, sf):
    """All orders, those without lines as one row of NULLs."""
    orders = inputs.orders_with_lines(spark, sf).select(F.col("o_orderkey").alias("order_id"), "products")
    flat = shape.flatten_struct(shape.explode_in_place(orders, "products"), "products", prefix="line_")
    return flat.select(
        "order_id", F.coalesce("line_productId", F.lit(-1)).alias("product_id"), F.coalesce("line_quantity", F.lit(-1)).alias("quantity")
    )


@query
def explode_lines(spark, sf):
    orders = inputs.orders_with_lines(spark, sf)
    return orders.select(F.col("o_orderkey").alias("order_id"), F.explode("products").alias("p")).select(
        "order_id", F.col("p.productId").alias("product_id"), F.col("p.quantity").alias("quantity")
    )


@query
def user_feed_flatten(spark, sf):
    """Explode, flatten, key and keep one row per key: the last product seen by order."""
    feed = inputs.orders_with_lines(spark, sf).select(
        F.col("products").alias("value"), F.col("o_orderkey").alias("order_key")
    )
    return shape.flatten_feed(feed, "value", "productId", ["order_key", "quantity"]).select(
        F.coalesce("business_key", F.lit(-1)).alias("business_key"), "order_key", F.coalesce("quantity", F.lit(-1)).alias("quantity")
    )


@query
def drop_duplicate_keys(spark, sf):
    return shape.drop_duplicate_keys(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"])


@query
def record_hash(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return shape.with_record_hash(orders, ["o_custkey", "o_orderstatus"]).select("o_orderkey", "record_hash")


@query
def iso_timestamp_text(spark, sf):
    return table(spark, sf, "events").select("event_id", iso_text(F.col("ts").cast("timestamp")).alias("ts_text"))


@query
def json_settings(spark, sf):
    """JSON text to a string map, for a settings column of every event."""
    return table(spark, sf, "events").select(
        "event_id", json_map("props").getItem("k").cast("int").alias("k")
    )


# ---------------------------------------------------------------- aggregates, quality, reconciliation


@query
def sum_at_grain(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", cents("o_totalprice").alias("total_cents"))
    lines = table(spark, sf, "lineitem").select("l_orderkey")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return aggregates.sum_at_grain(joined, ["o_orderkey"], "total_cents", by=["o_orderstatus"])


@query
def fan_out_error(spark, sf):
    return reconcile.fan_out_error(_models(spark, sf)[2])


@query
def duplicate_keys(spark, sf):
    return aggregates.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


LINE_RULES = {
    "order_present": "l_orderkey IS NOT NULL",
    "quantity_positive": "l_quantity IS NOT NULL AND l_quantity > 0",
    "discount_small": "l_discount < 0.09",
    "returned_or_open": "nullif(l_returnflag, 'N') IN ('A', 'R')",
}


@query
def dq_report(spark, sf):
    return quality.quality_report(table(spark, sf, "lineitem"), LINE_RULES)


@query
def dq_fact_order(spark, sf):
    """The fact's own gate: the rules hold, as the report shows."""
    return quality.quality_report(_models(spark, sf)[2], quality.FACT_ORDER_RULES)


@query
def dq_expect_in_plan(spark, sf):
    fact = quality.assert_rules(_models(spark, sf)[2], quality.FACT_ORDER_RULES)
    return fact.select("order_id", "line_number", "quantity")


@query
def dq_quarantine(spark, sf):
    marked = quality.quarantine(table(spark, sf, "lineitem"), LINE_RULES)
    broken = F.array_join("failed_rules", ",")
    return marked.groupBy(broken.alias("broken_rules")).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity")
    )


@query
def recon_bronze_silver(spark, sf):
    orders = inputs.bronze_orders(spark, sf)
    return reconcile.bronze_to_silver(orders, _models(spark, sf)[2])


@query
def recon_orders_without_lines(spark, sf):
    return reconcile.orders_without_lines(inputs.bronze_orders(spark, sf), _models(spark, sf)[2])


@query
def recon_silver_gold(spark, sf):
    fact = _models(spark, sf)[2]
    return reconcile.silver_to_gold(fact, gold.order_kpis(fact))


@query
def silver_order_metrics(spark, sf):
    return reconcile.order_metrics(_models(spark, sf)[2])


# ---------------------------------------------------------------- change detection and history


def _merge_sides(spark, sf):
    """Yesterday's orders, without the low priority, against today's, without the high one.

    Today, urgent orders have a new status; unspecified ones have none.
    """
    base = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("business_key"), "o_custkey", F.col("o_orderstatus").alias("status"), "o_orderpriority"
    )
    hashed = ["o_custkey", "status"]
    target = base.filter("o_orderpriority <> '5-LOW'")
    today = base.filter("o_orderpriority <> '2-HIGH'").withColumn(
        "status",
        F.when(F.col("o_orderpriority") == "1-URGENT", "X").when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("status")),
    )
    return shape.with_record_hash(today, hashed).drop("o_orderpriority"), shape.with_record_hash(target, hashed).drop("o_orderpriority")


@query
def change_detection(spark, sf):
    source, target = _merge_sides(spark, sf)
    found = changes.detect_changes(source, target, detect_deletes=True)
    return found.select("business_key", F.coalesce("status", F.lit("-")).alias("status"), "change_type")


@query
def scd1_upsert(spark, sf):
    source, target = _merge_sides(spark, sf)
    return changes.scd1_upsert(target, source, ["business_key"]).select(
        "business_key", "o_custkey", F.coalesce("status", F.lit("-")).alias("status")
    )


def _history_sides(spark, sf):
    source, target = _merge_sides(spark, sf)
    old = (
        target.withColumn("effective_from", F.to_timestamp(F.lit("2026-01-01")))
        .withColumn("effective_to", F.lit(None).cast("timestamp"))
        .withColumn("is_current", F.lit(True))
    )
    return source.withColumn("effective_from", F.to_timestamp(F.lit("2026-01-02"))), old


@query
def scd2_merge(spark, sf):
    source, old = _history_sides(spark, sf)
    return changes.scd2_merge(old, source).select(
        "business_key", F.coalesce("status", F.lit("-")).alias("status"), "effective_from", "effective_to", "is_current"
    )


@query
def merge_metrics(spark, sf):
    source, target = _merge_sides(spark, sf)
    _, first = changes.run_merge(source, target, "type1")
    versioned, old = _history_sides(spark, sf)
    _, second = changes.run_merge(versioned, old, "TYPE2")
    return first.withColumn("strategy", F.lit("TYPE1")).unionByName(second.withColumn("strategy", F.lit("TYPE2")))


@query
def merge_table_type1(spark, sf):
    source, target = _merge_sides(spark, sf)
    merged, _ = changes.run_merge(source, target, "type1")
    return merged.select("business_key", "o_custkey", F.coalesce("status", F.lit("-")).alias("status"))


@query
def merge_table_type2(spark, sf):
    source, old = _history_sides(spark, sf)
    merged, _ = changes.run_merge(source, old, "TYPE2")
    return merged.select(
        "business_key", F.coalesce("status", F.lit("-")).alias("status"), "effective_from", "effective_to", "is_current"
    )


@query
def merge_delta(spark, sf):
    """New and changed rows as one relation by name."""
    source, target = _merge_sides(spark, sf)
    found = changes.detect_changes(source, target)
    new, changed = found.filter("change_type = 'new'"), found.filter("change_type = 'changed'")
    return new.unionByName(changed).select("business_key", F.coalesce("status", F.lit("-")).alias("status"), "change_type")


@query
def scd2_history(spark, sf):
    log = table(spark, sf, "events").select("user_id", "event_type", "ts", "event_id")
    return history.scd2_from_log(log, ["user_id"], ["event_type"], ["ts", "event_id"], "start_at", "end_at").select(
        "user_id", "event_type", "event_id", "start_at", "end_at"
    )


@query
def scd2_history_hot_keys(spark, sf):
    """The same over event types: five keys, so each is hot and cut into ranges."""
    log = table(spark, sf, "events").select("event_type", "user_id", "ts", "event_id")
    return history.scd2_from_log(
        log, ["event_type"], ["user_id"], ["ts", "event_id"], "start_at", "end_at", max_rows_per_group=500
    ).select("event_type", "user_id", "event_id", "start_at", "end_at")


def _by_week(spark, sf, folder):
    """Opportunities laid out by arrival week, so that a week is read without the others."""
    week = F.date_format(F.date_trunc("week", "ingestion_timestamp"), "yyyyMMdd").cast("int")
    typed = inputs.bronze_opportunities(spark, sf).select(
        F.col("Id").alias("opportunity_id"),
        F.col("StageName").alias("stage_name"),
        F.col("Amount").cast("decimal(18,2)").alias("amount"),
        "ingestion_timestamp",
        "_source_file",
        week.alias("week"),
    )
    typed.write.partitionBy("week").parquet(folder)
    rows = spark.read.schema(typed.schema).parquet(folder)
    # The number of weeks, not of events: a short driver loop.
    weeks = [r["week"] for r in rows.select("week").distinct().orderBy("week").collect()]
    return [rows.filter(F.col("week") == w).drop("week") for w in weeks]


def _public(rows):
    return rows.select(
        "opportunity_id", "stage_name", F.col(history.START).alias("start_at"), F.col(history.END).alias("end_at")
    )


@query
def scd2_snapshot_fold(spark, sf):
    """The latest state per opportunity at the end of each week, folded week by week."""
    root = scratch_path(spark, "scd2-fold")
    for number, week in enumerate(_by_week(spark, sf, f"{root}/landing"), start=1):
        snapshot = latest.latest_records(week, ["opportunity_id"]).drop("_source_file")
        stream_state.fold_snapshot(spark, f"{root}/history", number, snapshot, ["opportunity_id"], ["stage_name"])
    return _public(stream_state.read_history(spark, f"{root}/history"))


@query
def scd2_stream(spark, sf):
    """The same, landed week by week and folded by a triggered stream."""
    root = scratch_path(spark, "scd2-stream")
    for week in _by_week(spark, sf, f"{root}/weeks"):
        week.write.mode("append").parquet(f"{root}/landing")
        stream = spark.readStream.schema(week.schema).parquet(f"{root}/landing")
        stream_state.scd2_stream(
            stream, ["opportunity_id"], ["stage_name"], f"{root}/history", f"{root}/checkpoint"
        ).awaitTermination()
    return _public(stream_state.read_history(spark, f"{root}/history"))


@query
def global_row_number(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"
    )
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    return numbering.global_row_number(lines, order, "line_sk")


def _feed(spark, sf):
    return table(spark, sf, "events").select(
        "user_id", F.when(F.col("event_type") == "error", "delete").otherwise(F.col("event_type")).alias("op"), "event_id", "value"
    )


@query
def apply_changes_hard(spark, sf):
    return changes.apply_changes(None, _feed(spark, sf), ["user_id"], "op", "event_id")


def _two_batches(spark, sf):
    """The feed out of order: odd operations first, then the even ones, of which many are late."""
    feed = _feed(spark, sf)
    first = changes.apply_changes_with_tombstones(None, None, feed.filter("event_id % 2 = 1"), ["user_id"], "op", "event_id")
    return changes.apply_changes_with_tombstones(*first, feed.filter("event_id % 2 = 0"), ["user_id"], "op", "event_id")


@query
def apply_changes_late(spark, sf):
    return _two_batches(spark, sf)[0]


@query
def apply_changes_tombstones(spark, sf):
    return _two_batches(spark, sf)[1]


@query
def apply_changes_soft(spark, sf):
    """Two batches, the second with operations older than what the first left behind."""
    feed = _feed(spark, sf)
    first = changes.apply_changes(
        None, feed.filter("op IN ('signup', 'delete')"), ["user_id"], "op", "event_id", "soft"
    )
    rest = feed.filter("op NOT IN ('signup', 'delete')")
    return changes.apply_changes(first, rest, ["user_id"], "op", "event_id", "soft")


# ---------------------------------------------------------------- changes in any order


def _kinds_feed(spark, sf):
    """Events as operations on their user: an error deletes, anything else sets the kind."""
    deleting = F.col("event_type") == "error"
    return table(spark, sf, "events").select(
        "user_id", F.when(deleting, "delete").otherwise("upsert").alias("op"), F.col("event_type").alias("kind"), "event_id", "value"
    )


@query
def scd2_from_feed(spark, sf):
    """A whole feed into a history: users vanish with a delete and come back."""
    made = observations.scd2_from_feed(_kinds_feed(spark, sf), ["user_id"], "op", ["event_id"], ["kind"])
    return made.select("user_id", "kind", "value", F.col(history.START).alias("start_at"), F.col(history.END).alias("end_at"))


@query
def scd2_feed_batches(spark, sf):
    """The same feed as its configuration asks for, in three batches of which the later ones are older."""
    setting = [("events", "feed", "op", "event_id", "bigint", "HARD", None, "TYPE2", True)]
    config = spark.createDataFrame(
        setting,
        "source_id string, cdc_mode string, operation_column string, sequence_column string, sequence_type string,"
        "delete_handling string, snapshot_key_column string, snapshot_strategy string, enabled boolean",
    )
    settings = source_config.change_settings(config, "events")
    feed, kept = _kinds_feed(spark, sf).withColumn("event_id", F.col("event_id").cast("string")), None
    for part in (2, 0, 1):
        kept = changes.apply_configured(kept, feed.filter(F.col("event_id").cast("bigint") % 3 == part), ["user_id"], settings)
        kept = materialize(kept, "feed-kept")
    made = changes.configured_history(kept, ["user_id"], settings, ["kind"])
    return made.select("user_id", "kind", "value", F.col(history.START).alias("start_at"), F.col(history.END).alias("end_at"))


@query
def scd2_backdated(spark, sf):
    """The log in three batches, the oldest last and one of them twice, into a history in buckets."""
    root = scratch_path(spark, "backdated")
    log = table(spark, sf, "events").select("user_id", "event_type", "ts", "event_id")
    for part in (2, 0, 0, 1):
        batch = log.filter(F.pmod(F.weekofyear("ts"), F.lit(3)) == part)
        buckets.late_history_buckets(batch, root, ["user_id"], ["event_type"], ["ts", "event_id"], f"weeks-{part}", 16)
    return buckets.read_buckets(spark, f"{root}/versions").select(
        "user_id", "event_type", "event_id", F.col(history.START).alias("start_at"), F.col(history.END).alias("end_at")
    )


@query
def scd2_many_snapshots(spark, sf):
    """Full snapshots, one a day, of the users active on it: who is missing ends there and opens again on coming back."""
    day = F.date_trunc("day", "ts").alias("day")
    log = table(spark, sf, "events").select("user_id", "event_type", "ts", "event_id", day)
    daily = log.groupBy("user_id", "day").agg(F.max_by(F.struct("event_type", "event_id"), F.struct("ts", "event_id")).alias("s"))
    snapshots = daily.select("user_id", "day", "s.event_type", "s.event_id")
    return observations.scd2_from_snapshots(snapshots, ["user_id"], ["event_type"], "day", "start_at", "end_at").select(
        "user_id", "event_type", "event_id", "start_at", "end_at"
    )


@query
def upsert_in_buckets(spark, sf):
    """Order states in buckets; a second batch for a few customers rewrites the buckets it touches, and its replay none."""
    root = scratch_path(spark, "upsert")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    buckets.upsert_buckets(orders, root, ["o_custkey", "o_orderkey"], "first", 64)
    urgent = orders.filter("o_custkey % 50 = 1").withColumn("o_orderstatus", F.lit("X"))
    new = urgent.withColumn("o_orderkey", -F.col("o_orderkey"))
    for _ in range(2):
        buckets.upsert_buckets(urgent.unionByName(new), root, ["o_custkey", "o_orderkey"], "second")
    return buckets.read_buckets(spark, root)


@query
def append_replayed(spark, sf):
    """Raw payloads and loads, each batch written twice."""
    root = scratch_path(spark, "append")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    for part in (0, 1, 1, 0):
        sinks.append_raw_batch(orders.filter(F.col("o_orderkey") % 2 == part), "orders", f"{root}/raw", f"run-{part}")
        sinks.load_batch(orders.filter(F.col("o_orderkey") % 2 == part), f"{root}/full", "full", f"run-{part}")
        sinks.load_batch(orders.filter(F.col("o_orderkey") % 2 == part), f"{root}/more", "incremental", f"run-{part}")
    raw = sinks.read_batches(spark, f"{root}/raw").select(
        F.lit("raw").alias("table"), F.get_json_object("raw_payload", "$.o_orderkey").cast("bigint").alias("o_orderkey"), "batch"
    )
    loads = [sinks.read_batches(spark, f"{root}/{t}").select(F.lit(t).alias("table"), "o_orderkey", "batch") for t in ("full", "more")]
    return raw.unionByName(loads[0]).unionByName(loads[1])


@query
def stable_keys(spark, sf):
    """Sequential keys of customers: those of one half, then of all, then once more."""
    customers = table(spark, sf, "customer").select("c_custkey")
    registry = None
    for batch in (customers.filter("c_custkey % 2 = 0"), customers, customers):
        registry = materialize(numbering.stable_numbers(registry, batch, ["c_custkey"], "customer_no"), "stable-keys")
    return registry


def _part_history(spark, sf):
    """Prices of parts: from 1996, raised from 1998, and none in 2000 for small parts."""
    part = table(spark, sf, "part").select("p_partkey", "p_size", cents("p_retailprice").alias("price"))
    year = lambda y: F.to_timestamp(F.lit(f"{y}-01-01 00:00:00"))
    small = F.col("p_size") < 10
    made = F.array(
        F.struct(year(1996).alias("start_at"), year(1998).alias("end_at"), F.col("price").alias("price_then")),
        F.struct(year(1998).alias("start_at"), F.when(small, year(2000)).alias("end_at"), (F.col("price") + 100).alias("price_then")),
    )
    again = F.array(F.struct(year(2001).alias("start_at"), F.lit(None).cast("timestamp").alias("end_at"), (F.col("price") + 300).alias("price_then")))
    return part.select("p_partkey", F.inline(F.when(small, F.concat(made, again)).otherwise(made)))


@query
def as_of_price(spark, sf):
    """Every order line with its part's price on the day it was shipped."""
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("p_partkey"), F.col("l_shipdate").cast("timestamp").alias("shipped")
    )
    found = as_of.as_of_lookup(lines, _part_history(spark, sf), ["p_partkey"], "shipped", ["price_then"], "start_at", "end_at", 5_000)
    return found.select("l_orderkey", "l_linenumber", "p_partkey", F.coalesce("price_then", F.lit(-1)).alias("price_then"))


@query
def latest_after_merges(spark, sf):
    """The latest orders of seven batches, of which runs of two and four were merged."""
    root = scratch_path(spark, "merged")
    orders = inputs.bronze_orders(spark, sf).select("id", "status", "ingestion_timestamp", "_source_file")
    for version in range(1, 8):
        batch = orders.filter(F.pmod(F.xxhash64("id", "_source_file"), F.lit(7)) == version - 1)
        sinks.publish(latest.latest_records(batch, ["id"]), root, version)
    stream_state.merge_parts(spark, root, ["id"], fan_in=2)
    return stream_state.read_latest(spark, root, ["id"]).select("id", "status", "ingestion_timestamp", "_source_file")


@query
def recon_rows(spark, sf):
    """Order lines against a copy that lacks some, has other quantities in some, and some more."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("bigint").alias("quantity"))
    key = F.col("l_orderkey")
    copy = lines.filter(key % 97 != 0).withColumn("quantity", F.when(key % 89 == 0, F.col("quantity") + 1).otherwise(F.col("quantity")))
    more = lines.filter(key % 83 == 0).withColumn("l_orderkey", -key)
    return row_reconcile.reconcile_rows(lines, copy.unionByName(more), ["l_orderkey", "l_linenumber"])


def _changed_orders(spark, sf, *columns):
    """(lines before, lines after, all lines now), of ``columns``: a fifth of the orders is new, another one had other values."""
    fact = materialize(_models(spark, sf)[2].select("order_id", "line_number", *columns), "fact")
    fifth = F.pmod(F.col("order_id"), F.lit(5))
    wrong = {"quantity": F.col("quantity") + 1, "order_date": F.timestamp_add("DAY", F.lit(-5000), F.col("order_date")), "order_total": F.col("order_total") + 7}
    wrong["customer_sk"] = F.lit("gone")
    if "product_sk" in columns:
        wrong["product_sk"] = F.when(F.col("line_number") == 1, "gone").otherwise(F.col("product_sk"))
    wrong = {c: v for c, v in wrong.items() if c in columns}
    old = fact.filter(fifth == 0).withColumns(wrong).select(*[F.col(f.name).cast(f.dataType) for f in fact.schema.fields])
    return fact.filter(fifth > 1).unionByName(old), old, fact.filter(fifth < 2), fact


@query
def gold_customer_sales_incremental(spark, sf):
    first, old, new, _ = _changed_orders(spark, sf, *gold.ORDER_LEVEL, "quantity")
    state_ = materialize(incremental.customer_state(None, None, first), "customer-state")
    return incremental.customer_sales(incremental.customer_state(state_, old, new), _models(spark, sf)[0])


@query
def gold_product_sales_incremental(spark, sf):
    first, old, new, fact = _changed_orders(spark, sf, "product_sk", "product_id", "quantity", "order_date")
    state_ = materialize(incremental.product_state(None, None, first, first), "product-state")
    return incremental.product_sales(incremental.product_state(state_, old, new, fact), _models(spark, sf)[1])


@query
def merge_catalog_table(spark, sf):
    """A type 1 merge of catalog tables by their names."""
    source, target = _merge_sides(spark, sf)
    root = scratch_path(spark, "catalog")
    names = [f"{n}_{root[-32:]}" for n in ("merge_source", "merge_target")]
    merge.publish_table(source, names[0], f"{root}/source")
    merge.publish_table(target, names[1], f"{root}/target")
    merge.merge_catalog_tables(spark, *names, f"{root}/target")
    return spark.table(names[1]).select("business_key", "o_custkey", F.coalesce("status", F.lit("-")).alias("status"))


# ---------------------------------------------------------------- landed documents


def _pulled_pages(spark, sf):
    keep = ["run_id", "pagination_type", "page_size", "cursor_field"]
    return landing.explode_pages(inputs.landed_pulls(spark, sf), "payload", keep, pagination="pagination_type")


@query
def landing_pages(spark, sf):
    return _pulled_pages(spark, sf).select(
        "run_id", "page_no", landing.record_count(F.col("page")).alias("page_records")
    )


@query
def landing_metrics(spark, sf):
    return landing.landing_metrics(_pulled_pages(spark, sf), ["run_id"])


@query
def last_cursor(spark, sf):
    found = landing.last_cursor(_pulled_pages(spark, sf), "next_cursor", ["run_id"])
    return found.select("run_id", F.coalesce("state_value", F.lit("-")).alias("state_value"))


@query
def incomplete_pulls(spark, sf):
    """Some pulls have paging settings that nobody knows, or no page size."""
    pages = _pulled_pages(spark, sf)
    odd = F.col("run_id") % 10
    pages = pages.withColumn("pagination_type", F.when(odd == 3, "keyset").otherwise(F.col("pagination_type")))
    return landing.incomplete_pulls(pages.withColumn("page_size", F.when(odd != 7, F.col("page_size"))), ["run_id"])


@query
def split_landed_records(spark, sf):
    """Landed documents to one record per row, whatever their paging."""
    schema = T.StructType([T.StructField("productId", T.LongType()), T.StructField("quantity", T.LongType())])
    records = landing.record_values(inputs.landed_pulls(spark, sf), "payload", ["run_id"])
    return rescue.typed_with_rescue(records, schema, raw="raw").select(
        "run_id",
        "page_no",
        "record_no",
        F.coalesce("productId", F.lit(-1)).alias("product_id"),
        F.coalesce("quantity", F.lit(-1)).alias("quantity"),
        F.col("_rescued_data").isNotNull().alias("rescued"),
    )


@query
def envelope_records(spark, sf):
    records = landing.extract_envelope(inputs.enveloped(spark, sf), "payload", ["order_id"])
    return records.select(
        "order_id",
        F.variant_get("record", "$.productId", "bigint").alias("product_id"),
        F.variant_get("record", "$.quantity", "bigint").alias("quantity"),
    )


@query
def large_documents(spark, sf):
    """Orders landed as one JSON array, which is read in byte ranges; their texts hold braces, brackets and quotes."""
    root = scratch_path(spark, "large")
    text = F.concat(F.lit('a "}{[" \\ '), F.col("o_orderpriority"))
    order = F.to_json(F.struct(F.col("o_orderkey").alias("id"), text.alias("text"), F.array(F.struct("o_custkey")).alias("list")))
    line = table(spark, sf, "orders").select(F.concat(order, F.lit(",")).alias("value"))
    first, last = (spark.createDataFrame([(x,)], "value string") for x in ("[", '{"id": -1, "text": "}", "list": [{"o_custkey": 0}]}]'))
    first.union(line).union(last).coalesce(1).write.text(root)
    customer = T.ArrayType(T.StructType([T.StructField("o_custkey", T.LongType())]))
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("list", customer)])
    records = rescue.typed_with_rescue(large.split_large_array(spark, root), schema)
    return records.select("id", "text", F.col("list")[0]["o_custkey"].alias("customer"), F.col("_rescued_data").isNull().alias("clean"))


# ---------------------------------------------------------------- streaming ingestion


def _land(df: DataFrame, folder: str) -> None:
    df.select(F.to_json(F.struct("*")).alias("value")).write.mode("append").text(folder)


@query
def json_stream_bronze(spark, sf):
    root = scratch_path(spark, "bronze")
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    _land(events, f"{root}/landing")
    rows = bronze.run_bronze(
        spark, f"{root}/landing", f"{root}/table", f"{root}/state", "events", whole_document=False
    )
    return rows.select("event_id", "user_id", "event_type", "value", "_api_id", F.col("_rescued_data").isNull().alias("clean"))


@query
def fixed_schema_stream(spark, sf):
    root = scratch_path(spark, "fixed")
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    _land(events, f"{root}/landing")
    stream = bronze.with_lineage(
        bronze.fixed_schema_stream(spark, f"{root}/landing", events.schema, multi_line=False), "events"
    )
    stream.writeStream.format("parquet").option("path", f"{root}/table").option(
        "checkpointLocation", f"{root}/checkpoint"
    ).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{root}/table").select("event_id", "event_type", "value", "_api_id")


@query
def schema_evolution_rescue(spark, sf):
    """Two runs. Purchases bring a new field; errors a text where a number is known."""
    root = scratch_path(spark, "evolve")
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    kind = F.col("event_type")

    def run():
        return bronze.run_bronze(
            spark, f"{root}/landing", f"{root}/table", f"{root}/state", "events", whole_document=False
        )

    _land(events.filter(~kind.isin("purchase", "error")), f"{root}/landing")
    run()
    _land(events.filter(kind == "purchase").withColumn("coupon", F.lit("C-1")), f"{root}/landing")
    _land(events.filter(kind == "error").withColumn("value", F.lit("n/a")), f"{root}/landing")
    return run().select(
        "event_id",
        "event_type",
        F.coalesce("value", F.lit(-1.0)).alias("value"),
        F.coalesce("coupon", F.lit("-")).alias("coupon"),
        F.coalesce("_rescued_data", F.lit("-")).alias("rescued"),
    )


@query
def medallion_batch(spark, sf):
    """One audited batch of all models, from Bronze to Gold; its order KPIs beside the state its audit row tells."""
    root = scratch_path(spark, "batch")
    layers = medallion.run_batch(
        spark, inputs.bronze_users(spark, sf), inputs.bronze_products(spark, sf), inputs.bronze_orders(spark, sf), root, 1, "job-1"
    )
    # Every attempt of a run is a row of the audit; the newest one tells its state.
    runs = latest.latest_records(spark.read.parquet(f"{root}/job_execution"), ["job_run_id"], ["end_time", "run_id"])
    runs = runs.select("job_run_id", F.concat_ws("/", "api_name", "status").alias("run"))
    return layers.order_kpis.withColumn("job_run_id", F.lit("job-1")).join(runs, "job_run_id").select(
        "order_id", "order_total", "units_sold", "run"
    )


@query
def gate_keeps_last_version(spark, sf):
    """A version that breaks a rule is not published: readers go on with the one before."""
    root = scratch_path(spark, "gate")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    rules = {"valid_quantity": "l_quantity > 0"}
    sinks.publish(lines, root, 1, rules)
    try:
        sinks.publish(lines.withColumn("l_quantity", -F.col("l_quantity")), root, 2, rules)
        raise AssertionError("the gate let a broken version pass")
    except quality.ExpectationFailed:
        pass
    return sinks.read_published(spark, root)


@query
def apply_configured_feed(spark, sf):
    """The feed applied as its configuration asks for."""
    setting = [("events", "feed", "op", "event_id", "bigint", "HARD", None, "NONE", True)]
    config = spark.createDataFrame(
        setting,
        "source_id string, cdc_mode string, operation_column string, sequence_column string, sequence_type string,"
        "delete_handling string, snapshot_key_column string, snapshot_strategy string, enabled boolean",
    )
    feed = _feed(spark, sf).withColumn("event_id", F.col("event_id").cast("string"))
    return changes.apply_configured(None, feed, ["user_id"], source_config.change_settings(config, "events"))


@query
def whole_documents(spark, sf):
    """Each nation's suppliers landed as one file, and read as whole documents."""
    root = scratch_path(spark, "documents")
    record = F.struct(F.col("s_suppkey").alias("id"), "s_acctbal")
    documents = table(spark, sf, "supplier").groupBy("s_nationkey").agg(F.to_json(F.array_sort(F.collect_list(record))).alias("value"))
    documents.select("value", "s_nationkey").write.partitionBy("s_nationkey").text(root)
    found = landing.record_values(landing.read_documents(spark, root).withColumn("nation", F.regexp_extract("file", "s_nationkey=(\\d+)", 1)), "payload", ["nation"])
    schema = T.StructType([T.StructField("id", T.LongType())])
    return rescue.typed_with_rescue(found, schema, raw="raw").select(F.col("nation").cast("bigint").alias("nation"), "id")


@query
def bronze_lossless(spark, sf):
    """Records with ids beyond 64 bits, amounts beyond a double and broken lines, under a record path.

    Every seventh event is a broken line, which has to arrive whole.
    """
    root = scratch_path(spark, "lossless")
    events = table(spark, sf, "events").select("event_id")
    big = F.concat(F.lit("123456789012345"), F.lpad(F.col("event_id").cast("string"), 8, "0"))
    item = F.concat(F.lit('{"id":'), big, F.lit(',"amount":'), F.when(F.col("event_id") % 3 == 0, F.concat(big, F.lit(".89"))).otherwise("0.5"), F.lit("}"))
    line = F.concat(F.lit('{"items":['), item, F.when(F.col("event_id") % 7 == 0, F.lit("")).otherwise(F.lit("]}")))
    events.select(line.alias("value")).write.text(f"{root}/landing")
    rows = bronze.run_bronze(
        spark, f"{root}/landing", f"{root}/table", f"{root}/state", "events", record_path="items", whole_document=False
    )
    return rows.select(
        F.coalesce(F.col("id").cast("string"), F.lit("-")).alias("id"),
        F.coalesce("amount", F.lit(-1.0)).alias("amount"),
        F.coalesce("_rescued_data", F.lit("-")).alias("rescued"),
    )


@query
def bronze_fan_out(spark, sf):
    """One source per event type, found through the configuration table."""
    root = scratch_path(spark, "fanout")
    events = table(spark, sf, "events")
    document = F.struct(
        F.struct(F.array(F.struct("event_id", "user_id", "value")).alias("items")).alias("payload")
    )
    events.select(F.to_json(document).alias("line"), F.col("event_type").alias("source")).write.partitionBy(
        "source"
    ).text(f"{root}/landing")
    config = (
        events.select(F.concat(F.lit("source="), "event_type").alias("api_id"), F.concat(F.lit("events_"), "event_type").alias("bronze_table"))
        .distinct()
        .withColumn("bronze_catalog", F.lit("lake"))
        .withColumn("bronze_schema", F.lit("bronze"))
        .withColumn("record_path", F.lit(" payload . items "))
        .withColumn("enabled", F.lit(True))
    )
    tables = bronze.bronze_tables(spark, config, f"{root}/landing", f"{root}/tables", whole_document=False)
    rows = None
    for one in tables.values():
        part = one.select("event_id", "user_id", "value", "_api_id")
        rows = part if rows is None else rows.unionByName(part)
    return rows


@query
def latest_stream(spark, sf):
    """Latest order per key, kept by micro-batches of the delivered files."""
    root = scratch_path(spark, "latest")
    orders = inputs.bronze_orders(spark, sf).drop("products", "_api_id", "date")
    orders.write.parquet(f"{root}/landing")
    # Three micro-batches, however many files there are.
    files = len(spark.read.schema(orders.schema).parquet(f"{root}/landing").inputFiles())
    stream = (
        spark.readStream.schema(orders.schema)
        .option("maxFilesPerTrigger", -(-files // 3))
        .parquet(f"{root}/landing")
    )
    stream_state.latest_stream(stream, ["id"], f"{root}/state", f"{root}/checkpoint").awaitTermination()
    return stream_state.read_latest(spark, f"{root}/state", ["id"])


@query
def raw_payload_append(spark, sf):
    path = scratch_path(spark, "raw")
    for status in ("F", "O", "P"):
        orders = table(spark, sf, "orders").filter(F.col("o_orderstatus") == status).select("o_orderkey", "o_custkey")
        sinks.append_raw(orders, f"orders_{status}", path)
    return spark.read.parquet(path).drop("ingest_timestamp")


@query
def load_mode_write(spark, sf):
    """A full load, an incremental one, and an incremental one without records."""
    path = scratch_path(spark, "loads")
    events = table(spark, sf, "events").select("event_id", "event_type")
    sinks.write_by_load_type(events, path, "INCREMENTAL")
    sinks.write_by_load_type(events.filter("event_type = 'view'"), path, " full ")
    sinks.write_by_load_type(events.filter("event_type <> 'view'"), path, "incremental")
    sinks.write_empty(spark, path, "INCREMENTAL")
    return spark.read.parquet(path)


@query
def empty_result_write(spark, sf):
    """A full load without records empties the table and keeps its columns."""
    path = scratch_path(spark, "empty")
    sinks.write_by_load_type(table(spark, sf, "events").select("event_id", "event_type"), path, "FULL")
    sinks.write_empty(spark, path, None)
    return spark.read.parquet(path)


# ---------------------------------------------------------------- state, configuration, audit


@query
def latest_checkpoints(spark, sf):
    return state.latest_checkpoints(inputs.checkpoints(spark, sf))


@query
def top_checkpoint(spark, sf):
    """The newest checkpoint of the source with the most of them."""
    rows = inputs.checkpoints(spark, sf)
    busiest = rows.groupBy("api_id").count().orderBy(F.desc("count"), "api_id").limit(1).select(F.col("api_id").alias("_busiest"))
    mine = rows.join(busiest, F.col("api_id") == F.col("_busiest"), "left_semi")
    return latest.top_one(mine, F.lit(True), ["recorded_at", "run_id"])


@query
def effective_state(spark, sf):
    config = source_config.with_defaults(inputs.source_config(spark, sf))
    found = state.effective_state(config, inputs.checkpoints(spark, sf))
    return found.select(
        "api_id", "load_type", F.coalesce(iso_text("watermark"), F.lit("-")).alias("watermark"), F.coalesce("cursor", F.lit("-")).alias("cursor")
    )


@query
def checkpoint_append(spark, sf):
    """Cursor state of every source that pages by cursor, and the next watermarks."""
    config = source_config.with_defaults(inputs.source_config(spark, sf))
    cursors = inputs.checkpoints(spark, sf).filter("state_type = 'Cursor'").groupBy("api_id").agg(
        F.max_by("state_value", F.struct("recorded_at", "run_id")).alias("state_value")
    )
    at = F.to_timestamp(F.lit("2026-01-03 00:00:00"))
    path = scratch_path(spark, "checkpoints")
    state.cursor_checkpoints(config, cursors, "run-1", at).write.mode("append").parquet(path)
    state.watermark_checkpoints(table(spark, sf, "events"), "user_id", "ts", "run-1", at).write.mode("append").parquet(path)
    return spark.read.parquet(path)


@query
def incremental_extract(spark, sf):
    """Events newer than their type's watermark: the start of its last day, less a day's overlap."""
    events = table(spark, sf, "events").select("event_id", "event_type", "ts")
    last_day = F.date_trunc("day", F.max("ts").cast("timestamp"))
    marks = events.groupBy(F.col("event_type").alias("api_id")).agg(iso_text(last_day).alias("state_value"))
    saved = marks.select(
        "api_id",
        F.lit("WATERMARK").alias("state_type"),
        "state_value",
        F.to_timestamp(F.lit("2026-01-01")).alias("recorded_at"),
        F.lit("run-1").alias("run_id"),
    )
    config = marks.select("api_id", F.lit("INCREMENTAL").alias("load_type"), F.lit(1440).alias("overlap_minutes"))
    return state.incremental_extract_all(
        events, "event_type", "ts", state.effective_state(source_config.with_defaults(config), saved), complete=True
    )


@query
def config_defaults(spark, sf):
    full = source_config.with_defaults(inputs.source_config(spark, sf))
    return full.select(
        "api_id", "load_type", "landing_container", "landing_path", "download_mode", "cursor_field",
        "cursor_parameter", "schema_version", F.col("headers_json")["X-Nation"].alias("nation_header"),
        F.size("query_parameters").alias("query_parameter_count"),
    )


@query
def enabled_sources(spark, sf):
    listed = source_config.enabled_sources(inputs.source_config(spark, sf), schedule="hourly")
    return listed.select("api_id", "api_name", "execution_group")


def _audit_rows(spark, sf):
    """Every order as an audited run of its customer's job."""
    failed = F.col("o_orderstatus") == "F"
    start = F.col("o_orderdate").cast("timestamp")
    lines = F.col("lines")
    rows = inputs.orders_with_lines(spark, sf).withColumn("lines", F.size("products"))
    values = {
        "run_id": F.lpad(F.col("o_orderkey").cast("string"), 12, "0"),
        "job_run_id": F.col("o_custkey").cast("string"),
        "api_name": F.lit("orders"),
        "job_name": F.lit("nightly_load"),
        "start_time": start,
        "end_time": start + F.make_dt_interval(F.lit(0), F.lit(0), lines),
        "status": F.when(failed, "FAILED").otherwise("SUCCESS"),
        "records_read": F.when(~failed, lines),
        "pages_read": F.when(~failed, F.lit(1)),
        "duration_seconds": (lines * 60).cast("double"),
        "landing_file": F.when(~failed, F.concat(F.lit("orders/"), F.col("o_orderkey").cast("string"), F.lit(".json"))),
        "failure_stage": F.when(failed, "LANDING"),
        "failure_type": F.when(failed, "HTTP_ERROR"),
    }
    return rows.select(
        *[values.get(c, F.lit(None)).cast(kind.split()[0]).alias(c) for c, kind in audit.AUDIT_COLUMNS.items()]
    )


@query
def audit_report(spark, sf):
    """Runs and records per job and status."""
    return _audit_rows(spark, sf).groupBy("job_name", "status").agg(
        F.count(F.lit(1)).alias("runs"),
        F.coalesce(F.sum("records_read"), F.lit(0)).alias("records_read"),
        F.max("end_time").alias("last_end"),
    )


@query
def run_summary(spark, sf):
    """A summary text for every customer's newest run; customers without orders too."""
    owed = F.col("c_acctbal") < 0
    stages = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("job_run_id"),
        F.when(owed, "FAILED").otherwise("SUCCESS").alias("overall_status"),
        F.when(owed, "FAILED").otherwise("SUCCESS").alias("ingestion_status"),
        F.when(owed, "SKIPPED").otherwise("SUCCESS").alias("bronze_status"),
        F.when(owed, "SKIPPED").otherwise("SUCCESS").alias("silver_status"),
        F.when(owed, "SKIPPED").otherwise("SUCCESS").alias("gold_status"),
        F.when(owed, "NOT_EVALUATED").otherwise("PASSED").alias("dq_status"),
        F.when(owed, "NOT_EVALUATED").otherwise("PASSED").alias("reconciliation_status"),
    )
    return audit.run_summary(_audit_rows(spark, sf), stages)
