"""Records out of arrays that are read in byte ranges."""

import json
import random

import pytest
from pyspark.sql import functions as F

from stratalake.session import materialize
from stratalake.sources import large_documents, rescue

SPLIT = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"


@pytest.fixture
def small_ranges(spark):
    before = [spark.conf.get(k) for k in SPLIT]

    def set_to(size):
        for k, v in zip(SPLIT, (size, "1b")):
            spark.conf.set(k, v)

    yield set_to
    for k, v in zip(SPLIT, before):
        spark.conf.set(k, v)


def records(seed, n):
    rng = random.Random(seed)
    texts = ["a", "}{", '"}', "\\", '\\"}', "[", "]]", "ü}", "", "\n}", "{\\\\", "x" * 300]
    return [{"id": i, "s": rng.choice(texts) * rng.randint(0, 3), "n": [{"x": rng.choice(["}", "{", '"'])}] * rng.randint(0, 2), "e": {}} for i in range(n)]


def found(spark, path, depth=1):
    out = {}
    for r in large_documents.split_large_array(spark, str(path), depth).orderBy("file", "record_no").collect():
        out.setdefault(r["file"].rsplit("/", 1)[1], []).append(json.loads(r["record"]))
    return out


@pytest.mark.parametrize("size", ["128m", "150b", "1k"])
def test_records_whatever_the_ranges(spark, tmp_path, small_ranges, size):
    small_ranges(size)
    one, two = records(1, 300), records(2, 40)
    (tmp_path / "a.json").write_text(json.dumps(one))
    (tmp_path / "b.json").write_text(json.dumps(two, indent=2, ensure_ascii=False) + "\n")
    (tmp_path / "c.json").write_text("[]")
    (tmp_path / "d.json").write_text(json.dumps([{"only": 1}]))
    assert found(spark, tmp_path) == {"a.json": one, "b.json": two, "d.json": [{"only": 1}]}


@pytest.mark.parametrize("size", ["128m", "100b"])
def test_pages_that_are_arrays(spark, tmp_path, small_ranges, size):
    small_ranges(size)
    rows = records(3, 90)
    (tmp_path / "a.json").write_text(json.dumps([rows[:30], [], rows[30:31], rows[31:]]))
    assert found(spark, tmp_path, 2) == {"a.json": rows}


def test_stray_values_and_broken_ends_are_not_lost(spark, tmp_path):
    (tmp_path / "a.json").write_text('[1, {"id": 1}, {"id": 2}, {"id": 3')
    got = large_documents.split_large_array(spark, str(tmp_path)).orderBy("record_no")
    assert [r["record"] for r in got.collect()] == ['1, {"id": 1}', '{"id": 2}', '{"id": 3']
    typed = rescue.typed_with_rescue(got.select("record_no", "record"), spark.createDataFrame([], "id long").schema).orderBy("record_no")
    assert [(r["id"], r["_rescued_data"] is None) for r in typed.collect()] == [(None, False), (2, True), (None, False)]


def test_a_document_larger_than_a_value_may_be(spark, tmp_path):
    """150 MB in one array, in tasks of 8 MB: beyond what one VARIANT holds."""
    body = "x" * 14_997 + '}"{'
    with open(tmp_path / "big.json", "w") as f:
        f.write("[")
        for i in range(10_000):
            f.write(("," if i else "") + json.dumps({"id": i, "body": body}))
        f.write("]")
    assert (tmp_path / "big.json").stat().st_size > 150_000_000 > 128 << 20
    got = large_documents.split_large_array(spark, str(tmp_path))
    ids = got.select(F.get_json_object("record", "$.id").cast("int").alias("id"), F.length(F.get_json_object("record", "$.body")).alias("n"))
    assert ids.agg(F.count("*"), F.count_distinct("id"), F.min("n"), F.max("n")).first()[:] == (10_000, 10_000, 15_000, 15_000)


def test_windows_hold_units_of_a_range(spark, tmp_path, monkeypatch):
    """One range of 300 records in units of 8 pieces: no window holds the range, and the records are the same."""
    monkeypatch.setattr(large_documents, "UNIT_PIECES", 8)
    rows = records(4, 300)
    (tmp_path / "a.json").write_text(json.dumps(rows))
    read = spark.read.option("lineSep", "}").text(str(tmp_path))
    sizes = large_documents._pieces(read).groupBy("file", "block").count()
    assert sizes.agg(F.max("count")).first()[0] <= 8 and sizes.count() > 40
    assert found(spark, tmp_path) == {"a.json": rows}


def test_tasks_grow_with_the_text(spark, tmp_path, monkeypatch):
    """A task sorts so many bytes of text, whatever adaptive execution would merge."""
    (tmp_path / "a.json").write_text(json.dumps(records(5, 300)))
    monkeypatch.setattr(large_documents, "TASK_BYTES", 500)
    made = []
    monkeypatch.setattr(large_documents, "materialize", lambda df, label: made.append((label, df.rdd.getNumPartitions())) or materialize(df, label))
    assert large_documents.split_large_array(spark, str(tmp_path)).count() == 300
    wanted = -(-(tmp_path / "a.json").stat().st_size // 500)
    assert wanted > 20 and dict(made)["json-states"] == dict(made)["json-placed"] == wanted
