"""Cross-layer reconciliation as tidy check rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.operators.aggregates import duplicate_flags, one_row
from stratalake.operators.latest import latest_records


def _check(name: str, left: Column, right: Column) -> Column:
    l, r = left.cast("decimal(38,2)"), right.cast("decimal(38,2)")
    return F.struct(
        F.lit(name).alias("check_name"),
        l.alias("left_value"),
        r.alias("right_value"),
        (l - r).cast("decimal(38,2)").alias("difference"),
        l.eqNullSafe(r).alias("passed"),
    )


def _rows(one_row: DataFrame, checks: list[Column]) -> DataFrame:
    return one_row.select(F.inline(F.array(*checks)))


def bronze_to_silver(bronze_orders: DataFrame, fact: DataFrame) -> DataFrame:
    """Latest Bronze orders against distinct Silver orders, and Silver key uniqueness.

    Orders without lines exist in Bronze only, so the first check fails when
    there are any; :func:`orders_without_lines` lists them.
    """
    # The latest row of a key exists exactly once, NULL key included: counting
    # keys needs no ranking.
    left = bronze_orders.select("id").distinct().agg(F.count(F.lit(1)).alias("bronze_orders"))
    # Both Silver figures come from one scan: lines per key, then keys per order.
    right = (
        duplicate_flags(fact, ["order_id", "line_number"])
        .groupBy("order_id")
        .agg(F.sum("_repeated").alias("_repeated"))
        .agg(F.count("order_id").alias("silver_orders"), F.coalesce(F.sum("_repeated"), F.lit(0)).alias("duplicate_count"))
    )
    one = one_row(left, right)
    return _rows(
        one,
        [
            _check("bronze_orders_vs_silver_orders", F.col("bronze_orders"), F.col("silver_orders")),
            _check("silver_duplicate_line_keys", F.col("duplicate_count"), F.lit(0)),
        ],
    )


def orders_without_lines(bronze_orders: DataFrame, fact: DataFrame) -> DataFrame:
    """Latest Bronze orders that have no Silver line."""
    latest = latest_records(
        bronze_orders.select("id", "status", "total", "ingestion_timestamp", "_source_file"), ["id"]
    ).select(F.col("id").alias("order_id"), "status", F.col("total").alias("order_total"))
    # One row per order before the shuffle, however many lines an order has.
    lines = fact.select(F.col("order_id").alias("_id")).distinct()
    return latest.join(lines, F.col("order_id") == F.col("_id"), "left_anti")


def order_metrics(fact: DataFrame) -> DataFrame:
    """One row: orders, units and sales, the sales reduced to order grain first."""
    # Both figures share the scan: units and the order total reduce to one row
    # per order together.
    per_order = fact.groupBy("order_id").agg(
        F.max("order_total").alias("order_total"), F.sum("quantity").alias("units")
    )
    return per_order.agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum("units").alias("units_sold"),
        F.sum("order_total").alias("sales_amount"),
    )


def silver_to_gold(fact: DataFrame, kpis: DataFrame) -> DataFrame:
    """Orders, units and sales of Silver against Gold, and Gold key uniqueness."""
    silver = order_metrics(fact).toDF("s_orders", "s_units", "s_sales")
    # One row per order again, so repeated orders show in the same pass.
    per_order = kpis.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("_rows"), F.sum("units_sold").alias("_units"), F.sum("order_total").alias("_sales")
    )
    gold = per_order.agg(
        F.sum("_rows").alias("g_orders"),
        F.sum("_units").alias("g_units"),
        F.sum("_sales").alias("g_sales"),
        F.count_if(F.col("_rows") > 1).alias("duplicate_count"),
    )
    one = one_row(silver, gold)
    return _rows(
        one,
        [
            _check("order_count", F.col("s_orders"), F.col("g_orders")),
            _check("units_sold", F.col("s_units"), F.col("g_units")),
            _check("sales_amount", F.col("s_sales"), F.col("g_sales")),
            _check("gold_duplicate_orders", F.col("duplicate_count"), F.lit(0)),
        ],
    )


def fan_out_error(fact: DataFrame) -> DataFrame:
    """Sales summed at order grain next to the same sum at line grain."""
    # Both sums come from one row per order, so the fact is read once.
    per_order = fact.groupBy("order_id").agg(
        F.max("order_total").alias("_once"), F.sum("order_total").alias("_lines"), F.count(F.lit(1)).alias("_rows")
    )
    return per_order.agg(
        F.sum("_once").alias("order_grain_sales"),
        F.count(F.lit(1)).alias("order_count"),
        F.sum("_lines").alias("line_grain_sales"),
        F.sum("_rows").alias("line_count"),
    )
