import pytest
import public_tokenizers as P
import tiktoken
from edge import documents

import corpus_pipeline as pipeline
from stratalake.llm import byte_bpe, secret_scan
from test_ngram_join import plain

SF = "/root/testdata/sf0.001"


def test_stages_on_given_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    tables = [docs]
    for name, stage in pipeline.STAGES:
        stage(spark, tables[-1], SF).write.parquet(str(tmp_path / name))
        tables.append(spark.read.parquet(str(tmp_path / name)))
    assert all(t.columns == columns for t in tables[:-1])
    texts = [{r["doc_id"]: r["text"] for r in t.collect()} for t in tables[:-1]]

    assert texts[1] == {i: t for i, t in texts[0].items() if t and any(map(str.isalpha, t))}
    groups = plain(list(texts[1].items()), pipeline.WIDTH, pipeline.PERCENT)
    assert set(texts[2]) == {i for i, _, least in groups if i == least}
    for i, text in texts[3].items():
        assert (text == texts[2][i]) == (not secret_scan.all_spans(texts[2][i]))
        assert not secret_scan.all_spans(text)
    assert set(texts[4]) <= set(texts[3])
    vocabulary = byte_bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))
    reference = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks={t: i for i, t in enumerate(vocabulary)}, special_tokens={})
    last = tables[-1].collect()
    assert len(last) == tables[4].count()
    for r in last:
        assert r["ids"] == reference.encode_ordinary(texts[4][r["doc_id"]]) and r["n_tokens"] == len(r["ids"])

    whole = sorted((r["doc_id"], tuple(r["ids"])) for r in pipeline.run(spark, SF).collect())
    assert whole == sorted((r["doc_id"], tuple(r["ids"])) for r in last)


@pytest.mark.parametrize("stage", [f for _, f in pipeline.STAGES], ids=[n for n, _ in pipeline.STAGES])
def test_stages_bear_edge_rows(spark, stage):
    docs = documents(spark)
    out = stage(spark, docs, SF)
    if stage is not pipeline.encode:
        assert out.columns == docs.columns
    assert out.count() >= 0
    assert stage(spark, docs.limit(0), SF).count() == 0


def test_near_duplicate_stage_by_rows(spark):
    rows = pipeline.keep_one_of_each(spark, documents(spark), SF).collect()
    ids = [r["doc_id"] for r in rows]
    assert 1 in ids and 2 not in ids
    assert ids.count(7) == 1 and ids.count(None) == 1
    assert {3, 4, 5, 6, 8, 9} <= set(ids)


def test_secret_stage_counts_characters(spark):
    for r in pipeline.remove_secrets(spark, documents(spark), SF).collect():
        assert r["n_chars"] == (len(r["text"]) if r["text"] is not None else None)


def test_language_stage_without_labels_loses_letterless_texts_only(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(20).selectExpr("doc_id", "text", "cast(null as string) lang", "source", "n_chars")
    odd = spark.createDataFrame([(-1, "12 !!", None, "s", 5), (-2, None, None, "s", 0), (-3, "é", None, "s", 1)], docs.schema)
    kept = {r["doc_id"] for r in pipeline.keep_languages(spark, docs.unionByName(odd), SF).collect()}
    assert kept == {r["doc_id"] for r in docs.collect()} | {-3}
