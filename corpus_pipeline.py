"""From raw documents to token ids: language, near duplicates, secrets, mixing weights, encoding.

Each stage takes (spark, docs, sf_dir), works on all rows that the one before
left, and returns a table that is written as Parquet and read again. All but the
last return the columns they were given.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm import byte_bpe, language_id, mixing, ngram_join, secret_scan
from stratalake.llm.common import free_name, materialize, sized, table

#: Rows in a batch for Python. All stages run in the same executors, one after another, so each keeps its batches small.
BATCH_ROWS = 300
#: Pieces whose ids, and pairs of tokens whose compatibility, a task of the last stage remembers.
MEMO_PIECES, MEMO_PAIRS = 50_000, 20_000
#: Near duplicates: five words, a similarity of 0.8 or more.
WIDTH, PERCENT = 5, 80


def _small_batches(spark: SparkSession) -> None:
    """The stages' results are written by the caller, so this setting of the pipeline's session stays."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def _columns(names: list[str]) -> list[str]:
    return [f"`{c}`" for c in names]


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in some language: texts that are null or have no letter go, and nothing else.

    Which language it is decides nothing, so a table without a label to learn from loses the same rows.
    """
    _small_batches(spark)
    guess, score = free_name(docs, "_lang_pred"), free_name(docs, "_lang_score")
    named = language_id.identify(docs, into=guess, score=score)
    # Without a model every guess is undetermined, which says nothing about the text.
    known = (F.col(guess) != language_id.UNDETERMINED) | F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return named.where(known).select(*_columns(docs.columns))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id.

    Rows that share a doc_id stay or go together, and those of equal text become
    one; rows without a doc_id can't be named by a decision and stay.
    """
    _small_batches(spark)
    found = materialize(ngram_join.near_duplicates(docs, WIDTH, PERCENT), "pipeline-groups").where("doc_id IS NOT NULL")
    named = found.groupBy(F.col("doc_id").alias("_id")).agg(
        F.bool_or(F.col("doc_id") == F.col("component_id")).alias("stays"), F.count(F.lit(1)).alias("rows")
    )
    named = materialize(named, "pipeline-decisions")
    gone, again = named.where("NOT stays").select("_id"), named.where("stays AND rows > 1").select("_id")
    n_gone, n_again = gone.count(), again.count()
    kept = docs.join(sized(gone, n_gone), F.col("doc_id") == F.col("_id"), "left_anti")
    if not n_again:
        return kept
    single = kept.join(sized(again, n_again), F.col("doc_id") == F.col("_id"), "left_anti")
    several = kept.join(sized(again, n_again), F.col("doc_id") == F.col("_id"), "left_semi")
    return single.unionByName(several.dropDuplicates(["doc_id", "text"]))


def remove_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets give way to a mark; n_chars follows the text. No document goes."""
    _small_batches(spark)
    clean = secret_scan.redact(docs)
    if "n_chars" not in docs.columns:
        return clean
    n_chars = F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars"))
    return clean.withColumn("n_chars", n_chars).select(*_columns(docs.columns))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target asks for."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids: one row per document of the mix."""
    _small_batches(spark)
    texts = docs.select("doc_id", "lang", "source", "text")
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    made = byte_bpe.encode_texts(texts, vocabulary, public_tokenizers.PATTERN, memo_pieces=MEMO_PIECES, memo_pairs=MEMO_PAIRS)
    return made.select("doc_id", "lang", "source", F.size("ids").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", keep_languages),
    ("near duplicates", keep_one_of_each),
    ("secrets", remove_secrets),
    ("mixing", mix_sources),
    ("encoding", encode),
]

#: The language machines and the automaton are beyond SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
