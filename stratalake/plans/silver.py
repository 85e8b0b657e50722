"""Silver models: customer and product dimensions, order lines, opportunities."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.functions import composite_key, hash_key, packed, to_amount, to_day, to_instant, unpacked
from stratalake.operators.history import END, START, scd2_from_snapshot, scd2_view
from stratalake.operators.latest import ARRIVAL_ORDER, latest_records
from stratalake.operators.lookup import lookup_key
from stratalake.operators.shape import with_processed_time

OPPORTUNITY_TRACKED = ("name", "amount", "stage_name", "close_date", "source_attributes")


# Dimension columns and the document fields they come from.
CUSTOMER_FIELDS = {
    "customer_id": "id",
    "customer_name": "name",
    "username": "username",
    "email": "email",
    "avatar": "avatar",
    "role": "role",
    "phone": "phone",
    "website": "website",
    "address_street": "address.street",
    "address_suite": "address.suite",
    "address_city": "address.city",
    "address_zipcode": "address.zipcode",
    "address_lat": "address.geo.lat",
    "address_lng": "address.geo.lng",
    "company_name": "company.name",
    "company_catch_phrase": "company.catchPhrase",
    "company_bs": "company.bs",
}
PRODUCT_FIELDS = {
    "product_id": "id",
    "title": "title",
    "description": "description",
    "category": "category",
    "price": "price",
    "image": "image",
    "rating_rate": "rating.rate",
    "rating_count": "rating.count",
}


def _dimension(bronze: DataFrame, fields: Mapping[str, str], key: str, surrogate: str) -> DataFrame:
    """The newest document per key, flattened, behind its surrogate key.

    Flattening first keeps unread nested fields out of the shuffle; the
    surrogate key is only computed for the rows that stay.
    """
    flat = bronze.select(*[F.col(path).alias(name) for name, path in fields.items()], *ARRIVAL_ORDER)
    newest = latest_records(flat, [key]).drop("_source_file")
    return with_processed_time(newest.select(hash_key(key).alias(surrogate), "*"))


def dim_customer(bronze_users: DataFrame) -> DataFrame:
    """One row per customer id, nested address and company flattened."""
    return _dimension(bronze_users, CUSTOMER_FIELDS, "customer_id", "customer_sk")


def dim_product(bronze_products: DataFrame) -> DataFrame:
    """One row per product id, rating flattened."""
    return _dimension(bronze_products, PRODUCT_FIELDS, "product_id", "product_sk")


def latest_orders(bronze_orders: DataFrame) -> DataFrame:
    """The newest document of each order, only the columns the fact needs."""
    needed = bronze_orders.select(
        "id", "userId", "date", "status", "total", "products", "ingestion_timestamp", "_source_file"
    )
    return latest_records(needed, ["id"], ARRIVAL_ORDER)


def fact_order(
    bronze_orders: DataFrame, customers: DataFrame, products: DataFrame, lenient: bool = False
) -> DataFrame:
    """Order lines: one row per (order_id, line_number), lines numbered from 1.

    Orders whose ``products`` is NULL or empty have no line and so no row. The
    customer key is looked up per order, before the lines fan out.
    """
    orders = latest_orders(bronze_orders).select(
        F.col("id").alias("order_id"),
        F.col("userId").alias("customer_id"),
        to_instant("date", lenient).alias("order_date"),
        "status",
        F.col("total").alias("order_total"),
        "products",
        "ingestion_timestamp",
    )
    # An order without lines is dropped before it travels to the lookup.
    orders = orders.filter(F.size("products") > 0)
    # The customer's key goes along with every line to the lookup of its product.
    lines = (
        lookup_key(orders, customers, "customer_id", "customer_sk")
        .withColumn("customer_sk", packed("customer_sk"))
        .select("*", F.posexplode("products").alias("_position", "_line"))
        .withColumn("line_number", (F.col("_position") + 1).cast("int"))
        .withColumn("product_id", F.col("_line.productId"))
        .withColumn("quantity", F.col("_line.quantity"))
        .drop("products", "_position", "_line")
    )
    keyed = lookup_key(lines, products, "product_id", "product_sk")
    return with_processed_time(
        keyed.select(
            composite_key("order_id", "line_number").alias("order_sk"),
            "order_id",
            "line_number",
            unpacked("customer_sk").alias("customer_sk"),
            "customer_id",
            "product_sk",
            "product_id",
            "quantity",
            "order_date",
            "status",
            "order_total",
            "ingestion_timestamp",
        )
    )


def opportunity_latest(bronze_opportunities: DataFrame, lenient: bool = False) -> DataFrame:
    """The newest record of each opportunity, typed."""
    typed = bronze_opportunities.select(
        F.col("Id").alias("opportunity_id"),
        F.col("Name").alias("name"),
        to_amount("Amount", lenient=lenient).alias("amount"),
        F.col("StageName").alias("stage_name"),
        to_day("CloseDate", lenient).alias("close_date"),
        F.to_json("attributes").alias("source_attributes"),
        "ingestion_timestamp",
        *[c for c in ["_source_file"] if c in bronze_opportunities.columns],
    )
    return with_processed_time(latest_records(typed, ["opportunity_id"]).drop("_source_file"))


def opportunity_history(history: DataFrame | None, latest: DataFrame) -> DataFrame:
    """Fold the latest opportunities into their type 2 history."""
    return scd2_from_snapshot(history, latest, ["opportunity_id"], OPPORTUNITY_TRACKED)


def opportunity_view(history: DataFrame) -> DataFrame:
    """Public opportunity history with a sequential key and an active flag."""
    return scd2_view(history, "opportunity_id", "opportunity_sk", START, END)
