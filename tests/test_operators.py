"""Latest records, shapes, lookups, numbering, quality, reconciliation."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import at, rows
from stratalake.functions import json_map, minutes_before, or_na, state_cursor, state_watermark
from stratalake.operators import aggregates, latest, lookup, numbering, quality, reconcile, shape


def test_latest_is_deterministic_within_a_file(spark):
    data = [(1, i, at("2026-01-01"), "f") for i in range(50)]
    schema = "id int, v int, ingestion_timestamp timestamp, _source_file string"
    picks = {
        latest.latest_records(spark.createDataFrame(random.sample(data, 50), schema).repartition(n), ["id"]).first().v
        for n in (1, 3, 7)
    }
    assert len(picks) == 1


def test_latest_null_keys(spark):
    schema = "id int, v int, ingestion_timestamp timestamp, _source_file string"
    df = spark.createDataFrame([(None, 1, at("2026-01-01"), "a"), (None, 2, at("2026-01-02"), "a"), (1, 3, at("2026-01-01"), "a")], schema)
    assert rows(latest.latest_records(df, ["id"]), "id", "v") == [(1, 3), (None, 2)]
    assert rows(latest.latest_records(df, ["id"], null_keys="reject"), "v") == [(3,)]
    assert rows(latest.null_key_records(df, ["id"]), "v") == [(1,), (2,)]


def test_latest_with_maps_and_a_hot_key(spark):
    n = 3000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("seq"),
        F.create_map(F.lit("x"), F.col("id")).alias("m"),
    )
    out = latest.latest_records(df, ["k"], ["seq"])
    assert out.count() == n - n // 3 + 1 - 0
    assert out.filter("k = 0").first().seq == n - 3


def test_top_one(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("b", 9)], "k string, t int")
    assert rows(latest.top_one(df, "k = 'a'", ["t"])) == [("a", 3)]


def test_extract_records(spark):
    df = spark.createDataFrame(
        [(({"a.b": 1} and [(1, 2)], ), "f", "x", at("2026-01-01")), (([],), "f", "x", at("2026-01-01")), ((None,), "f", "x", at("2026-01-01"))],
        "payload struct<items:array<struct<`a.b`:int,c:int>>>, _source_file string, _api_id string, ingestion_timestamp timestamp",
    )
    out = shape.extract_records(df, " payload . items ")
    assert out.columns == ["a.b", "c", "_source_file", "_api_id", "ingestion_timestamp"]
    assert [r[0] for r in out.collect()] == [1]
    with pytest.raises(ValueError, match="must be an array"):
        shape.extract_records(df, "payload")
    with pytest.raises(ValueError, match="array of structs"):
        shape.extract_records(df.withColumn("n", F.array(F.lit(1))), "n")


def test_paths_and_identifiers():
    assert shape.normalize_record_path("  ") is None
    assert shape.normalize_record_path(" a . b ") == "a.b"
    for bad in ("a..b", ".", "a/b", "a\\b", ".."):
        with pytest.raises(ValueError):
            shape.normalize_record_path(bad)
    assert shape.normalize_identifier(" x ", "n") == "x"
    for bad in (None, " ", "a.b", "a/b"):
        with pytest.raises(ValueError):
            shape.normalize_identifier(bad, "n")


def test_flatten(spark):
    df = spark.createDataFrame([(1, [("a", 2)]), (2, []), (3, None)], "k int, v array<struct<id:string,n:int>>")
    flat = shape.flatten_struct(shape.explode_in_place(df, "v"), "v")
    assert rows(flat) == [(1, "a", 2), (2, None, None), (3, None, None)]
    with pytest.raises(ValueError, match="duplicate columns"):
        shape.flatten_struct(df.select(F.lit("x").alias("id"), F.col("v")[0].alias("v")), "v")
    keyed = shape.flatten_feed(df, "v", "id", ["n"])
    assert rows(keyed, "business_key") == [("a",), (None,)]


def test_salted_lookup_equals_plain_lookup(spark):
    fact = spark.range(900).select(
        F.col("id").alias("line"), F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, None).otherwise(F.col("id")).alias("p")
    )
    dim = spark.range(500).select(F.col("id").alias("p"), F.concat(F.lit("sk"), "id").alias("sk"))
    heavy = lookup.heavy_keys(fact, "p", 0.1)
    assert {k for k, _ in heavy} == {7, None}
    plain = rows(lookup.lookup_key(fact, dim, "p", "sk"), "line", "p", "sk")
    assert rows(lookup.salted_lookup(fact, dim, "p", "sk", heavy, salts=5), "line", "p", "sk") == plain
    assert len(plain) == 900


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_numbering_is_gapless_and_ordered(spark, partitions):
    data = [(0 if i % 3 else i, i * 37 % 1000) for i in range(1000)]
    df = spark.createDataFrame(data, "k int, t int").repartition(6)
    out = numbering.global_row_number(df, ["k", F.col("t").desc()], "n", partitions)
    expected = sorted(data, key=lambda r: (r[0], -r[1]))
    assert [(r.k, r.t) for r in out.orderBy("n").collect()] == expected
    assert [r.n for r in out.orderBy("n").collect()] == list(range(1, 1001))


def test_numbering_of_nothing(spark):
    assert numbering.global_row_number(spark.range(0), ["id"], "n").count() == 0


def test_quality_report_gate_and_quarantine(spark):
    df = spark.createDataFrame([(1, 5), (None, 3), (2, None), (3, -1)], "id int, q int")
    rules = {"id": "id IS NOT NULL", "q": "q > 0"}
    assert rows(quality.quality_report(df, rules)) == [("id", 1, 4, False), ("q", 2, 4, False)]
    with pytest.raises(quality.ExpectationFailed) as failed:
        quality.expect_or_fail(df, rules)
    assert failed.value.failures == {"id": 1, "q": 2}
    good = df.filter("id = 1")
    quality.expect_or_fail(good, rules)
    assert quality.assert_rules(good, rules).count() == 1
    with pytest.raises(Exception, match="expectation failed: q"):
        quality.assert_rules(df.filter("id IS NOT NULL"), rules).collect()
    with pytest.raises(Exception, match="expectation failed"):
        quality.assert_rules(df, rules).count()
    assert rows(quality.quarantine(df, rules).select("id", F.concat_ws(",", "failed_rules"))) == [
        (1, ""), (2, "q"), (3, "q"), (None, "id"),
    ]


def test_grain_and_duplicates(spark):
    df = spark.createDataFrame([(1, 1, 10), (1, 2, 10), (2, 1, 5), (2, 1, 5)], "o int, l int, t int")
    assert rows(aggregates.sum_at_grain(df, ["o"], "t")) == [(2, 15)]
    assert rows(aggregates.duplicate_keys(df, ["o", "l"])) == [(2, 1, 2)]
    assert aggregates.duplicate_key_count(df, ["o", "l"]).first()[0] == 1


def test_reconciliation_names_the_difference(spark):
    bronze = spark.createDataFrame(
        [(1, "s", 10, at("2026-01-01"), "a"), (1, "s", 10, at("2026-01-02"), "a"), (2, "s", 5, at("2026-01-01"), "a")],
        "id int, status string, total int, ingestion_timestamp timestamp, _source_file string",
    )
    fact = spark.createDataFrame([(1, 1, 10, 3), (1, 2, 10, 4)], "order_id int, line_number int, order_total int, quantity int")
    checks = {r.check_name: r for r in reconcile.bronze_to_silver(bronze, fact).collect()}
    assert not checks["bronze_orders_vs_silver_orders"].passed and checks["bronze_orders_vs_silver_orders"].difference == 1
    assert checks["silver_duplicate_line_keys"].passed
    assert rows(reconcile.orders_without_lines(bronze, fact), "order_id") == [(2,)]
    assert reconcile.fan_out_error(fact).first().asDict() == {
        "order_count": 1, "order_grain_sales": 10, "line_grain_sales": 20, "line_count": 2,
    }


def test_state_functions(spark):
    df = spark.createDataFrame(
        [("WATERMARK", "2026-09-07T10:00:00Z", 15), ("watermark", "2026-09-07T10:00:00", None), ("CURSOR", "abc", 5), ("Cursor", "d", -3)],
        "t string, v string, m int",
    )
    out = df.select(state_watermark("t", "v").alias("w"), state_cursor("t", "v").alias("c"), minutes_before(state_watermark("t", "v"), "m").alias("b"), or_na("m").alias("n"))
    got = [(r.w and r.w.hour, r.c, r.b and (r.b.hour, r.b.minute), r.n) for r in out.collect()]
    assert got == [(10, None, (9, 45), "15"), (10, None, (10, 0), "N/A"), (None, "abc", None, "5"), (None, "d", None, "-3")]


def test_json_map(spark):
    df = spark.createDataFrame([('{"a":1,"b":"x"}',), (None,), (" ",)], "t string")
    assert [r[0] for r in df.select(json_map("t")).collect()] == [{"a": "1", "b": "x"}, {}, {}]
    with pytest.raises(Exception):
        spark.createDataFrame([("nope",)], "t string").select(json_map("t")).collect()


def test_scratch_tables_go_when_asked(spark, monkeypatch):
    from stratalake import session

    monkeypatch.setattr(session, "_SCRATCH", [])
    table = session.materialize(spark.range(3), "dropped")
    assert table.count() == 3
    assert session.drop_scratch(spark) == 1 and session.drop_scratch(spark) == 0


def test_packed_keys_come_back_and_order_as_texts(spark):
    from stratalake.functions import hash_key, packed, packed_max, unpacked

    texts = ["", "ab", "abcd", "abc", "AB", "0g", "ff", "g", "é", " ab", "a" * 64, None]
    df = spark.createDataFrame([(i % 3, t) for i, t in enumerate(texts)], "g int, t string")
    assert df.filter(~unpacked(packed("t")).eqNullSafe(F.col("t"))).count() == 0
    for keys in ([], ["g"], ["t"]):
        got = df.groupBy(*keys).agg(packed_max("t").alias("m"), F.max("t").alias("w"))
        assert got.filter(~F.col("m").eqNullSafe(F.col("w"))).count() == 0
    hashed = spark.range(5).select(packed(hash_key("id")).alias("p"))
    assert hashed.filter((F.octet_length("p.bytes") == 32) & F.col("p.text").isNull()).count() == 5


def test_product_sales_with_null_keys_and_repeated_orders(spark):
    from stratalake.plans import gold

    rows_ = [("s1", 1, o % 7, o % 5, o) for o in range(60)] + [(None, 2, o % 9, 1, o) for o in range(40)] + [("s3", None, None, None, None), ("s1", 1, None, 2, 3)]
    fact = spark.createDataFrame(rows_, "product_sk string, product_id long, order_id long, quantity long, order_date long")
    products = spark.createDataFrame([("s1", 1, "t", "c")], "product_sk string, product_id long, title string, category string")
    want = fact.groupBy("product_sk", "product_id").agg(
        F.count_distinct("order_id").alias("order_count"), F.sum("quantity").alias("units_sold"), F.min("order_date").alias("first_order_date"), F.max("order_date").alias("last_order_date")
    )
    sales = gold.product_sales(fact, products)
    assert rows(sales, *want.columns) == rows(want, *want.columns)
    # A group's rows are dealt in parts, so that no task gets all that lack a key.
    assert "_part" in sales._jdf.queryExecution().executedPlan().toString()
