"""Bronze-shaped inputs derived from the given tables.

An order document holds all its lines as an array, as one landed document does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.session import tasks_for

PAGE_SIZE = 2
# Bytes of the order tables' files that one task puts together; in its memory they are fifty times as many.
TASK_BYTES = 8 << 20


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def cents(column: str) -> Column:
    return F.round(F.col(column) * 100).cast("bigint")


def order_lines(spark: SparkSession, sf: str) -> DataFrame:
    """l_orderkey, products: every line of the order, by line number, part and quantity."""
    line = F.struct("l_linenumber", F.col("l_partkey").alias("productId"), F.col("l_quantity").cast("bigint").alias("quantity"))
    product = F.array_sort(F.collect_list(line))
    lines, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    return lines.repartition(tasks_for(TASK_BYTES, lines, orders), "l_orderkey").groupBy("l_orderkey").agg(
        F.transform(product, lambda x: F.struct(x["productId"].alias("productId"), x["quantity"].alias("quantity"))).alias("products")
    )


def orders_with_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with their products array; empty for an order without lines."""
    lines = order_lines(spark, sf)
    empty = F.array().cast(lines.schema["products"].dataType)
    orders = table(spark, sf, "orders")
    return (
        orders.repartition(tasks_for(TASK_BYTES, table(spark, sf, "lineitem"), orders), "o_orderkey")
        .join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .withColumn("products", F.coalesce("products", empty))
        .drop("l_orderkey")
    )


def _delivery(day: str, file: str, condition: Column | None = None, **overrides: Column) -> Column:
    entry = F.struct(
        F.to_timestamp(F.lit(day)).alias("ingestion_timestamp"),
        F.lit(file).alias("_source_file"),
        *[value.alias(name) for name, value in overrides.items()],
    )
    return entry if condition is None else F.when(condition, entry)


def _delivered(df: DataFrame, *deliveries: Column) -> DataFrame:
    """One row per delivery of each record."""
    return df.withColumn("d", F.explode(F.array_compact(F.array(*deliveries)))).select("*", "d.*").drop("d")


def bronze_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Order documents, some delivered again.

    Urgent orders come again a day later; of those, open ones twice with the
    same time, where the higher file name wins. Filled orders come again with
    the first delivery's time and a lower file name, which loses.
    """
    urgent, status = F.col("o_orderpriority") == "1-URGENT", F.col("o_orderstatus")
    delivered = _delivered(
        orders_with_lines(spark, sf),
        _delivery("2026-01-01 00:00:00", "orders-0001.json", status=status),
        _delivery("2026-01-01 00:00:00", "orders-0000.json", status == "F", status=F.lit("Y")),
        _delivery("2026-01-02 00:00:00", "orders-0002.json", urgent, status=F.lit("X")),
        _delivery("2026-01-02 00:00:00", "orders-0003.json", urgent & (status == "O"), status=F.lit("Z")),
    )
    return delivered.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("userId"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("date"),
        "status",
        cents("o_totalprice").alias("total"),
        "products",
        "_source_file",
        F.lit("orders").alias("_api_id"),
        "ingestion_timestamp",
    )


def bronze_users(spark: SparkSession, sf: str) -> DataFrame:
    """Customer documents; one market segment is renamed a day later."""
    key = F.col("c_custkey").cast("string")
    delivered = _delivered(
        table(spark, sf, "customer"),
        _delivery("2026-01-01 00:00:00", "users-0001.json", name=F.col("c_name")),
        _delivery(
            "2026-01-02 00:00:00",
            "users-0002.json",
            F.col("c_mktsegment") == "BUILDING",
            name=F.concat("c_name", F.lit(" (renamed)")),
        ),
    )
    return delivered.select(
        F.col("c_custkey").alias("id"),
        "name",
        F.lower("c_name").alias("username"),
        F.concat(F.lit("user"), key, F.lit("@example.com")).alias("email"),
        F.concat(F.lit("avatar/"), key).alias("avatar"),
        F.when(F.col("c_acctbal") < 0, "debtor").otherwise("buyer").alias("role"),
        F.concat(F.lit("+"), F.col("c_nationkey").cast("string"), F.lit("-"), key).alias("phone"),
        F.concat(F.lit("https://example.com/"), key).alias("website"),
        F.struct(
            F.concat(F.lit("City "), F.col("c_nationkey").cast("string")).alias("city"),
            F.struct(F.col("c_acctbal").alias("lat"), (-F.col("c_acctbal")).alias("lng")).alias("geo"),
            F.concat(F.lit("Street "), key).alias("street"),
            F.col("c_mktsegment").alias("suite"),
            F.concat(F.lit("Z"), key).alias("zipcode"),
        ).alias("address"),
        F.struct(
            F.lower("c_mktsegment").alias("bs"),
            F.concat(F.lit("We do "), F.lower("c_mktsegment")).alias("catchPhrase"),
            F.concat("c_mktsegment", F.lit(" Inc")).alias("name"),
        ).alias("company"),
        "_source_file",
        F.lit("users").alias("_api_id"),
        "ingestion_timestamp",
    )


def bronze_products(spark: SparkSession, sf: str) -> DataFrame:
    """Part documents; economy parts get a new price a day later."""
    price = cents("p_retailprice")
    delivered = _delivered(
        table(spark, sf, "part"),
        _delivery("2026-01-01 00:00:00", "products-0001.json", price=price),
        _delivery(
            "2026-01-02 00:00:00", "products-0002.json", F.col("p_type") == "ECONOMY", price=price + 100
        ),
    )
    return delivered.select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("title"),
        F.concat("p_type", F.lit(" "), "p_name").alias("description"),
        F.col("p_brand").alias("category"),
        "price",
        F.concat(F.lit("img/"), F.col("p_partkey").cast("string")).alias("image"),
        F.struct(
            F.col("p_size").cast("bigint").alias("count"), (F.col("p_size") / 2).cast("double").alias("rate")
        ).alias("rating"),
        "_source_file",
        F.lit("products").alias("_api_id"),
        "ingestion_timestamp",
    )


def bronze_opportunities(spark: SparkSession, sf: str) -> DataFrame:
    """Every event as a new state of its user's opportunity."""
    user = F.col("user_id").cast("string")
    return table(spark, sf, "events").select(
        F.concat(F.lit("OPP-"), user).alias("Id"),
        F.concat(F.lit("Deal "), user).alias("Name"),
        F.col("value").alias("Amount"),
        F.col("event_type").alias("StageName"),
        F.date_format("ts", "yyyy-MM-dd").alias("CloseDate"),
        F.struct(F.lit("Opportunity").alias("type"), F.concat(F.lit("/o/"), user).alias("url")).alias("attributes"),
        F.concat(F.lit("opp-"), F.lpad(F.col("event_id").cast("string"), 12, "0")).alias("_source_file"),
        F.col("ts").cast("timestamp").alias("ingestion_timestamp"),
    )


def landed_pulls(spark: SparkSession, sf: str) -> DataFrame:
    """Every order as a pull of its lines, two records per page, as one landed document.

    Open orders page by offset (pages are lists), partial ones by cursor, and
    filled ones come unpaged. A single page is landed without the outer array.
    Urgent partial orders still carry a cursor on their last page.
    """
    orders = orders_with_lines(spark, sf)
    n = F.size("products")
    last = F.greatest(F.lit(1), F.ceil(n / F.lit(PAGE_SIZE)).cast("int"))
    status = F.col("o_orderstatus")
    dangling = F.col("o_orderpriority") == "1-URGENT"

    def chunk(k: Column) -> Column:
        return F.slice("products", (k - 1) * PAGE_SIZE + 1, F.lit(PAGE_SIZE))

    def cursor_page(k: Column) -> Column:
        more = (k < last) | dangling
        return F.struct(
            chunk(k).alias("data"), F.when(more, F.concat(F.lit("cursor-"), k.cast("string"))).alias("next_cursor")
        )

    numbers = F.sequence(F.lit(1), last)
    by_offset = F.when(last == 1, F.to_json("products")).otherwise(F.to_json(F.transform(numbers, chunk)))
    by_cursor = F.when(last == 1, F.to_json(cursor_page(F.lit(1)))).otherwise(
        F.to_json(F.transform(numbers, cursor_page))
    )
    unpaged = F.to_json(F.struct(F.col("products").alias("items")))
    return orders.select(
        F.col("o_orderkey").alias("run_id"),
        F.when(status == "O", "OFFSET").when(status == "P", "cursor").alias("pagination_type"),
        F.lit(PAGE_SIZE).alias("page_size"),
        F.lit("next_cursor").alias("cursor_field"),
        F.when(status == "O", by_offset).when(status == "P", by_cursor).otherwise(unpaged).alias("payload"),
    )


def enveloped(spark: SparkSession, sf: str) -> DataFrame:
    """Every order's lines in one of the common envelopes; lines without orders aside.

    Open: a ``records`` object; filled: a ``value`` object; partial: a bare
    list with a stray scalar in it.
    """
    status = F.col("o_orderstatus")
    lines = F.to_json("products")
    # The stray element is put in front, before a comma if lines follow.
    stray = F.concat(
        F.lit("[7"), F.when(F.size("products") > 0, F.lit(",")).otherwise(F.lit("")), F.substring(lines, 2, 1 << 30)
    )
    return orders_with_lines(spark, sf).select(
        F.col("o_orderkey").alias("order_id"),
        F.when(status == "O", F.concat(F.lit('{"totalSize":1,"records":'), lines, F.lit("}")))
        .when(status == "F", F.concat(F.lit('{"@odata.context":"x","value":'), lines, F.lit("}")))
        .otherwise(stray)
        .alias("payload"),
    )


def source_config(spark: SparkSession, sf: str) -> DataFrame:
    """Every customer as a configured source."""
    segment = F.col("c_mktsegment")
    return table(spark, sf, "customer").select(
        F.concat(F.lit("api-"), F.col("c_custkey").cast("string")).alias("api_id"),
        F.col("c_name").alias("api_name"),
        F.when(segment == "BUILDING", "full").when(segment != "FURNITURE", "INCREMENTAL").alias("load_type"),
        F.when(F.col("c_nationkey") > 0, F.col("c_nationkey")).alias("overlap_minutes"),
        F.when(segment == "MACHINERY", F.lit("2024-01-01T00:00:00+00:00")).alias("initial_load_value"),
        F.when(F.col("c_acctbal") > 5000, "cursor").when(F.col("c_acctbal") > 0, "OFFSET").alias("pagination_type"),
        F.concat(F.lit('{"Accept":"application/json","X-Nation":"'), F.col("c_nationkey").cast("string"), F.lit('"}')).alias(
            "headers_json"
        ),
        F.when(F.col("c_nationkey") < 12, "hourly").otherwise("daily").alias("schedule"),
        F.concat(F.lit("group-"), F.col("c_nationkey").cast("string")).alias("execution_group"),
        (F.col("c_acctbal") >= 0).alias("enabled"),
    )


def checkpoints(spark: SparkSession, sf: str) -> DataFrame:
    """Every order as a checkpoint of its customer's source."""
    is_cursor = F.col("o_orderstatus") == "O"
    return table(spark, sf, "orders").select(
        F.concat(F.lit("api-"), F.col("o_custkey").cast("string")).alias("api_id"),
        F.when(is_cursor, "Cursor").when(F.col("o_orderstatus") == "F", "WATERMARK").otherwise("watermark").alias("state_type"),
        F.when(is_cursor, F.concat(F.lit("cursor-"), F.col("o_orderkey").cast("string")))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .alias("state_value"),
        F.col("o_orderdate").cast("timestamp").alias("recorded_at"),
        F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("run_id"),
    )
