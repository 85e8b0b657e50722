"""Gold models at order, customer and product grain."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.functions import packed_max
from stratalake.operators.shape import with_processed_time
from stratalake.session import tasks_for


# Columns that repeat on every line of an order, and how they reduce to one value.
ORDER_LEVEL = {
    "customer_sk": packed_max,
    "customer_id": F.max,
    "order_date": F.min,
    "status": F.max,
    "order_total": F.max,
}


#: Parts of a group, and of one with a NULL among its keys, which may hold any share of the rows.
PARTS, NULL_PARTS, PART = 4, 256, "_part"
#: Bytes of the files behind the rows that one task groups.
TASK_BYTES = 16 << 20


def by_group_and(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``rows`` dealt by ``keys`` and by ``_part``, a part of the values of ``value``, each of which falls into one.

    Counting distinct values then moves the rows once, in the order they stand in, and after them one
    row per part. Rows that stand by their group, as after a lookup of it, take little room on the way.
    """
    null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    part = F.pmod(F.xxhash64(value), F.when(null, NULL_PARTS).otherwise(PARTS))
    rows = rows.withColumn(PART, part)
    return rows.repartition(tasks_for(TASK_BYTES, rows), *keys, PART)


def order_kpis(fact: DataFrame, unique_lines: bool = False) -> DataFrame:
    """One row per order. The order total repeats per line and is never summed.

    ``unique_lines`` says that (order_id, line_number) is known to be a key, as
    it is for a fact built against one-row-per-key dimensions. Counting then
    needs no distinct step, which saves a shuffle at line grain.
    """
    lines = F.count("line_number") if unique_lines else F.count_distinct("line_number")
    kept = [reduce_to_one(c).alias(c) for c, reduce_to_one in ORDER_LEVEL.items()]
    units = F.sum("quantity").alias("units_sold")
    return with_processed_time(fact.groupBy("order_id").agg(*kept, lines.alias("line_count"), units))


def _with_attributes(metrics: DataFrame, dim: DataFrame, surrogate: str, key: str, *attributes) -> DataFrame:
    """Left join of aggregated metrics on (surrogate, key); NULL keys match nothing."""
    named = dim.select(F.col(surrogate).alias("_sk"), F.col(key).alias("_id"), *attributes)
    condition = (F.col(surrogate) == F.col("_sk")) & (F.col(key) == F.col("_id"))
    return metrics.join(named, condition, "left").drop("_sk", "_id")


def customer_sales(kpis: DataFrame, customers: DataFrame, unique_orders: bool = False) -> DataFrame:
    """One row per customer, from order-grain input.

    ``unique_orders`` says that order_id is known to be a key of ``kpis``.
    """
    orders = F.count("order_id") if unique_orders else F.count_distinct("order_id")
    metrics = kpis.groupBy("customer_sk", "customer_id").agg(
        orders.alias("order_count"),
        F.sum("order_total").alias("sales_amount"),
        F.sum("units_sold").alias("units_sold"),
    )
    joined = _with_attributes(metrics, customers, "customer_sk", "customer_id", "customer_name")
    return with_processed_time(
        joined.select(
            "customer_sk", "customer_id", "customer_name", "order_count", "sales_amount", "units_sold"
        )
    )


def product_sales(fact: DataFrame, products: DataFrame) -> DataFrame:
    """One row per product. No revenue: the source has no amount per line."""
    units, first, last = F.sum("quantity"), F.min("order_date"), F.max("order_date")
    keys, order = ["product_sk", "product_id"], "order_id"
    per_order = by_group_and(fact.select(*keys, order, "quantity", "order_date"), keys, order).groupBy(*keys, PART, order).agg(
        units.alias("units_sold"), first.alias("first_order_date"), last.alias("last_order_date")
    )
    metrics = per_order.groupBy(*keys).agg(
        F.count(order).alias("order_count"),
        F.sum("units_sold").alias("units_sold"),
        F.min("first_order_date").alias("first_order_date"),
        F.max("last_order_date").alias("last_order_date"),
    )
    title = F.col("title").alias("product_title")
    joined = _with_attributes(metrics, products, "product_sk", "product_id", title, "category")
    return with_processed_time(
        joined.select(
            "product_sk",
            "product_id",
            "product_title",
            "category",
            "order_count",
            "units_sold",
            "first_order_date",
            "last_order_date",
        )
    )
