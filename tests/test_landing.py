"""Landed documents: pages, counts, cursors, envelopes, rescued data, schemas."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from stratalake.sources import landing, rescue, schemas

PAGES = [{"data": [{"id": 1}], "next_cursor": "cursor-a"}, {"data": [{"id": 2}], "next_cursor": "cursor-b"}, {"data": [{"id": 3}]}]


def documents(spark, *payloads, **extra):
    data = [(f"f{i}", p if isinstance(p, str) else json.dumps(p)) for i, p in enumerate(payloads)]
    df = spark.createDataFrame(data, "file string, payload string")
    for name, value in extra.items():
        df = df.withColumn(name, F.lit(value))
    return df


def test_a_cursor_run(spark):
    pages = landing.explode_pages(documents(spark, PAGES))
    assert rows(landing.landing_metrics(pages)) == [("f0", 3, 3, 0)]
    assert rows(landing.last_cursor(pages)) == [("f0", "cursor-b")]


def test_page_counting_rules(spark):
    docs = documents(
        spark, [[{"a": 1}, {"a": 2}], [{"a": 3}]], {"results": [1, 2]}, {"data": 5, "items": [1]}, {"x": 1}, 7, [], "broken {",
        {"value": [1, 2, 3]}, {"records": None, "items": [1, 2]},
    )
    pages = landing.explode_pages(docs)
    # A broken document has no records, and is reported.
    assert rows(landing.landing_metrics(pages)) == [
        ("f0", 3, 2, 0), ("f1", 2, 1, 0), ("f2", 1, 1, 0), ("f3", 1, 1, 0), ("f4", 1, 1, 0), ("f5", 0, 1, 0), ("f6", 0, 1, 1), ("f7", 1, 1, 0),
        ("f8", 2, 1, 0),
    ]
    with_value = landing.landing_metrics(pages, fields=[*landing.COUNT_FIELDS, "value"])
    assert rows(with_value.filter("file = 'f7'")) == [("f7", 3, 1, 0)]


def test_paging_kind_settles_what_an_array_is(spark):
    one_list = [{"id": 1}, {"id": 2}]
    for kind, pages, records in (("OFFSET", 1, 2), ("NONE", 1, 2), (None, 1, 2), ("cursor", 2, 2)):
        docs = documents(spark, one_list).withColumn("kind", F.lit(kind).cast("string"))
        found = landing.landing_metrics(landing.explode_pages(docs, pagination="kind"))
        assert rows(found, "file", "records_read", "pages_read") == [("f0", records, pages)], kind


def test_cursors_skip_nulls_and_blanks(spark):
    docs = documents(spark, [{"next_cursor": "a"}, {"next_cursor": None}, {"next_cursor": ""}], [{"x": 1}], [{"next_cursor": 12}])
    assert rows(landing.last_cursor(landing.explode_pages(docs))) == [("f0", "a"), ("f1", None), ("f2", "12")]


def test_incomplete_pulls(spark):
    def pages(kind, payload):
        docs = documents(spark, payload, pagination_type=kind, page_size=2, cursor_field="next")
        return landing.explode_pages(docs, "payload", ["file", "pagination_type", "page_size", "cursor_field"], "pagination_type")

    def flagged(kind, payload):
        return landing.incomplete_pulls(pages(kind, payload)).count() == 1

    assert flagged("OFFSET", [[1, 2], [3, 4]]) and not flagged("offset", [[1, 2], [3]])
    assert flagged("CURSOR", [{"next": "a"}, {"next": "b"}]) and not flagged("CURSOR", [{"next": "a"}, {"next": ""}])
    assert not flagged("CURSOR", [{"next": "a"}, {}]) and not flagged("NONE", {"next": "a"})


def test_envelopes(spark):
    docs = documents(
        spark, {"records": [{"a": 1}, 5, None]}, {"value": [{"a": 2}]}, {"a": 3}, [{"a": 4}, "x", [1]], {"records": None, "value": [{"a": 5}]}, {"records": []},
    )
    found = landing.extract_envelope(docs).select("file", F.variant_get("record", "$.a", "int").alias("a"))
    assert rows(found) == [("f0", 1), ("f1", 2), ("f2", 3), ("f3", 4), ("f4", 5)]
    for bad, message in (({"records": 5}, "records"), ({"value": {"a": 1}}, "value"), (7, "object or a list")):
        with pytest.raises(Exception, match=message):
            landing.extract_envelope(documents(spark, bad)).collect()


def test_documents_from_files(spark, tmp_path):
    for i, payload in enumerate([PAGES, [[{"id": 4}, {"id": 5}], [{"id": 6}]]]):
        (tmp_path / f"{i}.json").write_text(json.dumps(payload, indent=1))
    docs = landing.read_documents(spark, str(tmp_path))
    pages = landing.explode_pages(docs, keep=["file", "file_size"])
    found = landing.landing_metrics(pages, size="file_size")
    assert sorted((r.records_read, r.pages_read) for r in found.collect()) == [(3, 2), (3, 3)]
    assert {r.landing_file_size_bytes for r in found.collect()} == {f.stat().st_size for f in tmp_path.glob("*.json")}
    records = landing.split_records(docs)
    ids = records.select(F.get_json_object("record", "$.id").alias("id")).filter("id IS NOT NULL")
    assert rows(ids) == [("4",), ("5",), ("6",)]


SCHEMA = "id bigint, name string, price double, ok boolean, at timestamp, geo struct<lat:double,tags:array<bigint>>"


def rescued(spark, *payloads):
    df = spark.createDataFrame([(i, p if isinstance(p, str) else json.dumps(p)) for i, p in enumerate(payloads)], "n int, record string")
    return rescue.typed_with_rescue(df, T.StructType.fromDDL(SCHEMA)).orderBy("n").collect()


def test_what_fits_is_typed_and_nothing_is_rescued(spark):
    row = rescued(spark, {"id": 1, "name": "x", "price": 2, "ok": True, "at": "2026-01-01T00:00:00Z", "geo": {"lat": 1.5, "tags": [1, None]}})[0]
    assert (row.id, row["name"], row.price, row.ok, row.geo.lat, row.geo.tags) == (1, "x", 2.0, True, 1.5, [1, None])
    assert row["at"].year == 2026 and row._rescued_data is None


def test_misfits_are_rescued_not_lost(spark):
    got = rescued(
        spark, {"id": "seven", "new": 1}, {"id": 1.5}, {"id": 2**70}, {"price": "n/a"}, {"geo": {"lat": 1.0, "deep": {"x": 1}}},
        {"geo": {"tags": [1, "x"]}}, {"name": {"a": 1}}, {"ok": "yes"}, {"id": None}, {"at": "whenever"},
    )
    assert [json.loads(r._rescued_data) if r._rescued_data else None for r in got] == [
        {"id": "seven", "new": 1}, {"id": 1.5}, {"id": 2**70}, {"price": "n/a"}, {"geo": {"lat": 1.0, "deep": {"x": 1}}},
        {"geo": {"tags": [1, "x"]}}, {"name": {"a": 1}}, {"ok": "yes"}, None, {"at": "whenever"},
    ]
    assert got[0].id is None and got[1].id is None and got[4].geo.lat == 1.0


def test_unparsable_text_is_kept_whole(spark):
    got = rescued(spark, "{broken", "[1,2]", "5")
    assert [r._rescued_data for r in got] == ["{broken", "[1,2]", "5"]
    assert all(r.id is None for r in got)


def ddl(text):
    return T.StructType.fromDDL(text)


def test_schema_merge_is_order_free_and_appends(spark):
    a, b, c = ddl("x bigint, s struct<p:bigint>"), ddl("b string, s struct<q:string,p:string>"), ddl("a double, x string")
    one = schemas.merge_schemas(schemas.merge_schemas(a, b), c)
    assert one.simpleString() == "struct<x:bigint,s:struct<p:bigint,q:string>,b:string,a:double>"
    assert schemas.merge_schemas(one, one) == one
    wide = schemas.merge_schemas(ddl("x bigint, y bigint"), ddl("x double, y string"), widen=True)
    assert wide.simpleString() == "struct<x:double,y:string>"


def test_schema_inference(spark):
    df = spark.createDataFrame(
        [('{"b":1,"a":"x","n":null}',), ('{"b":2.5,"s":{"k":[1,2]},"odd name":true}',), ("broken",)], "record string"
    )
    found = schemas.infer_schema(df)
    assert {f.name: f.dataType.simpleString() for f in found.fields} == {
        "a": "string", "b": "double", "n": "string", "odd name": "boolean", "s": "struct<k:array<bigint>>",
    }
    assert schemas.infer_schema(df.limit(0)).fields == []
    mixed = df.union(spark.createDataFrame([("5",), ("[1]",)], "record string"))
    assert schemas.infer_schema(mixed) == found


def test_empty_lists_give_no_record(spark):
    docs = documents(spark, [], [[], [{"a": 1}]], {"a": 2})
    assert rows(landing.split_records(docs)) == [("f1", 2, 1, '{"a":1}'), ("f2", 1, 1, '{"a":2}')]


def test_schema_store_versions(spark, tmp_path):
    store = schemas.SchemaStore(spark, str(tmp_path / "s"))
    assert store.load() == (0, T.StructType([])) and store.seen_until() is None
    assert store.evolve(ddl("a bigint"))[0] == 1
    assert store.evolve(ddl("a bigint"))[0] == 1
    version, schema = store.evolve(ddl("b string"))
    assert (version, schema.simpleString()) == (2, "struct<a:bigint,b:string>")
    store.mark_seen("2026-01-01T00:00:00")
    store.mark_seen("2026-01-02T00:00:00")
    assert schemas.SchemaStore(spark, str(tmp_path / "s")).seen_until() == "2026-01-02T00:00:00"
    assert store.load() == (2, schema)


def test_settings_that_cannot_tell_are_listed(spark):
    settings = [("a", "OFFSET", 2), ("b", "OFFSET", None), ("c", "OFFSET", 0), ("d", "keyset", 2), ("e", None, None), ("f", "OFFSET", 2)]
    pulls = spark.createDataFrame([(f, k, n, "next", "[{}]" if f != "f" else "broken [") for f, k, n in settings], "file string, pagination_type string, page_size int, cursor_field string, payload string")
    pages = landing.explode_pages(pulls, keep=["file", "pagination_type", "page_size", "cursor_field"], pagination="pagination_type")
    assert [r[0] for r in rows(landing.incomplete_pulls(pages), "file")] == ["b", "c", "d", "f"]
