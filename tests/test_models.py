"""Dimensions, order lines and Gold aggregates on small hand-made inputs."""

import hashlib

import pytest

from conftest import at, rows
from stratalake.plans import gold, silver

USER = (
    "address struct<city:string,geo:struct<lat:double,lng:double>,street:string,suite:string,zipcode:string>,"
    "avatar string, company struct<bs:string,catchPhrase:string,name:string>, email string, id bigint, name string,"
    "phone string, role string, username string, website string, _rescued_data string, _source_file string,"
    "_api_id string, ingestion_timestamp timestamp"
)
PRODUCT = (
    "category string, description string, id bigint, image string, price bigint,"
    "rating struct<count:bigint,rate:double>, title string, _source_file string, ingestion_timestamp timestamp"
)
ORDER = (
    "date string, id bigint, products array<struct<productId:bigint,quantity:bigint>>, status string, total bigint,"
    "userId bigint, _source_file string, _api_id string, ingestion_timestamp timestamp"
)
FACT = (
    "order_id bigint, line_number int, customer_sk string, customer_id bigint, product_sk string, product_id bigint,"
    "quantity bigint, order_date timestamp, status string, order_total bigint"
)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def user(key, name, hour):
    return (
        ("Town", (1.5, 2.5), "Main", "S1", "1234"), "a.png", ("bs", "phrase", "Corp"), "m@x", key, name, "1", "admin",
        "nick", "w", None, f"users-{hour}.json", "users", at(f"2026-01-01 {hour:02d}:00"),
    )


def order(key, hour, products, total=100, user_id=71, file=None, date="2025-12-19T04:52:57.301Z"):
    return (date, key, products, "new", total, user_id, file or f"orders-{hour}.json", "orders", at(f"2026-01-01 {hour:02d}:00"))


@pytest.fixture()
def dims(spark):
    customers = spark.createDataFrame([("customer-sk-1", 71), ("customer-sk-2", 81)], "customer_sk string, customer_id bigint")
    products = spark.createDataFrame([("product-sk-85", 85), ("product-sk-169", 169)], "product_sk string, product_id bigint")
    return customers, products


def test_dim_customer_keeps_the_newest_and_flattens(spark):
    bronze = spark.createDataFrame([user(1, "Old Name", 8), user(1, "New Name", 9), user(2, "Other", 8)], USER)
    out = silver.dim_customer(bronze)
    assert out.columns == [
        "customer_sk", "customer_id", "customer_name", "username", "email", "avatar", "role", "phone", "website",
        "address_street", "address_suite", "address_city", "address_zipcode", "address_lat", "address_lng",
        "company_name", "company_catch_phrase", "company_bs", "ingestion_timestamp", "processed_timestamp",
    ]
    assert rows(out, "customer_sk", "customer_id", "customer_name", "address_lat", "company_catch_phrase") == sorted(
        [(sha("1"), 1, "New Name", 1.5, "phrase"), (sha("2"), 2, "Other", 1.5, "phrase")]
    )


def test_dim_product(spark):
    make = lambda key, title, hour: ("c", "d", key, "i", 10, (120, 3.9), title, f"p-{hour}", at(f"2026-01-01 {hour:02d}:00"))
    out = silver.dim_product(spark.createDataFrame([make(1, "old", 8), make(1, "new", 9), make(3, "x", 8)], PRODUCT))
    assert rows(out, "product_id", "title", "rating_rate", "rating_count") == [(1, "new", 3.9, 120), (3, "x", 3.9, 120)]
    assert out.columns[0] == "product_sk" and out.columns[-1] == "processed_timestamp"


def fact(spark, dims, *orders):
    return silver.fact_order(spark.createDataFrame(list(orders), ORDER), *dims)


def test_lines_are_numbered_in_array_order_and_keyed(spark, dims):
    out = fact(spark, dims, order(1, 8, [(85, 1), (169, 2)]))
    assert rows(out, "line_number", "product_id", "quantity", "customer_sk", "product_sk", "order_sk") == [
        (1, 85, 1, "customer-sk-1", "product-sk-85", sha("1|1")),
        (2, 169, 2, "customer-sk-1", "product-sk-169", sha("1|2")),
    ]
    assert dict(out.dtypes)["line_number"] == "int"


def test_unknown_keys_stay_with_null_surrogates(spark, dims):
    out = fact(spark, dims, order(1, 8, [(999, 1)], user_id=5), order(2, 8, [(None, 1)], user_id=None))
    assert rows(out, "order_id", "customer_sk", "product_sk") == [(1, None, None), (2, None, None)]


def test_newest_delivery_wins(spark, dims):
    out = fact(spark, dims, order(1, 10, [(85, 1)], 100), order(1, 11, [(169, 3)], 300))
    assert rows(out, "product_id", "quantity", "order_total") == [(169, 3, 300)]


def test_file_name_breaks_ties(spark, dims):
    out = fact(
        spark, dims, order(1, 10, [(85, 1)], 100, file="orders-a"), order(1, 10, [(169, 2)], 200, file="orders-z")
    )
    assert rows(out, "product_id", "quantity", "order_total") == [(169, 2, 200)]


def test_orders_without_lines_have_no_row(spark, dims):
    out = fact(spark, dims, order(1, 8, []), order(2, 8, None), order(3, 8, [(85, 1)]))
    assert rows(out, "order_id") == [(3,)]


def test_late_business_dates_are_kept(spark, dims):
    late = order(2, 12, [(85, 1)], date="2024-02-03T01:02:03.004Z")
    out = fact(spark, dims, order(1, 8, [(85, 1)]), late)
    assert [r.order_date.isoformat() for r in out.orderBy("order_id").collect()] == [
        "2025-12-19T04:52:57.301000", "2024-02-03T01:02:03.004000",
    ]


def test_bad_dates_raise_or_become_null(spark, dims):
    bronze = spark.createDataFrame([order(1, 8, [(85, 1)], date="not a date")], ORDER)
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP|CAST_INVALID_INPUT"):
        silver.fact_order(bronze, *dims).collect()
    assert rows(silver.fact_order(bronze, *dims, lenient=True), "order_date") == [(None,)]


def line(order_id, number, product, quantity, total, day="2026-01-01", customer=7):
    return (order_id, number, f"c{customer}", customer, f"p{product}", product, quantity, at(day), "done", total)


def test_order_kpis_do_not_sum_the_total(spark):
    lines = [line(1, 1, 1, 1, 1082), line(1, 2, 2, 2, 1082), line(1, 3, 3, 2, 1082), line(2, 1, 1, 3, 589), line(2, 2, 2, 2, 589)]
    out = gold.order_kpis(spark.createDataFrame(lines, FACT))
    assert rows(out, "order_id", "line_count", "units_sold", "order_total") == [(1, 3, 5, 1082), (2, 2, 5, 589)]
    unique = gold.order_kpis(spark.createDataFrame(lines, FACT), unique_lines=True)
    assert rows(unique.drop("processed_timestamp")) == rows(out.drop("processed_timestamp"))
    repeated = gold.order_kpis(spark.createDataFrame(lines + lines[:1], FACT))
    assert rows(repeated.filter("order_id = 1"), "line_count", "units_sold") == [(3, 6)]


def test_customer_sales(spark):
    kpis = spark.createDataFrame(
        [(1, "c1", 1, 1082, 5), (2, "c1", 1, 589, 4), (3, "c2", 2, 1000, 3), (4, "c2", 2, 500, 4), (5, None, 9, 7, 1)],
        "order_id bigint, customer_sk string, customer_id bigint, order_total bigint, units_sold bigint",
    )
    dim = spark.createDataFrame([("c1", 1, "Ann"), ("c2", 2, "Bo"), ("c9", 9, "No")], "customer_sk string, customer_id bigint, customer_name string")
    out = gold.customer_sales(kpis, dim)
    assert rows(out, "customer_id", "customer_name", "order_count", "sales_amount", "units_sold") == [
        (1, "Ann", 2, 1671, 9), (2, "Bo", 2, 1500, 7), (9, None, 1, 7, 1),
    ]


def test_product_sales(spark):
    lines = [line(1, 1, 1, 2, 0, "2026-01-01"), line(2, 1, 1, 3, 0, "2026-01-05"), line(1, 2, 2, 3, 0), line(1, 3, 2, 1, 0), line(2, 2, 2, 3, 0)]
    dim = spark.createDataFrame([("p1", 1, "One", "a"), ("p2", 2, "Two", "b")], "product_sk string, product_id bigint, title string, category string")
    out = gold.product_sales(spark.createDataFrame(lines, FACT), dim)
    got = rows(out, "product_id", "product_title", "category", "order_count", "units_sold")
    assert got == [(1, "One", "a", 2, 5), (2, "Two", "b", 2, 7)]
    first = out.filter("product_id = 1").first()
    assert (first.first_order_date.day, first.last_order_date.day) == (1, 5)
    assert "revenue" not in " ".join(out.columns)


def test_opportunities_typed_and_newest(spark):
    bronze = spark.createDataFrame(
        [("A", "n", 1.005, "open", "2026-03-01", ("t", None), at("2026-01-01"), "f1"), ("A", "n", 7.0, "won", "2026-03-02", ("t", "u"), at("2026-01-01"), "f2")],
        "Id string, Name string, Amount double, StageName string, CloseDate string,"
        "attributes struct<type:string,url:string>, ingestion_timestamp timestamp, _source_file string",
    )
    out = silver.opportunity_latest(bronze)
    assert dict(out.dtypes)["amount"] == "decimal(18,2)" and dict(out.dtypes)["close_date"] == "date"
    assert rows(out, "stage_name", "source_attributes") == [("won", '{"type":"t","url":"u"}')]
