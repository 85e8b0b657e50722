"""Mixing sources to target weights by repeating documents.

The words of each source are counted, targets are derived from weights, and a
source's repetition rate is its target over its size. A document is emitted
floor(rate) times, plus once more if a hash of its id and text falls below the fraction.

The draw of the extra copy is a Bernoulli trial with a hash as its seed, so any
rerun, on any number of machines, draws alike. Of a few seeds a source takes the
one whose total comes nearest to its target: each seed is as fair as another.

Defined results: a text of any length counts whole; a null text or a text of white space counts no words; a null
source is a source of its own; a source without words gets rate 0; rows that
share a doc_id draw apart if their texts differ, and rows alike in both share their draw; an empty table gives an empty mix.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import free_name, materialize, sized, whole_number
from stratalake.operators.numbering import global_row_number

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
SEEDS = 8
# Hexadecimal digits of a hash that fit a double without rounding.
_DIGITS = 13


def words(text: Column) -> Column:
    """Number of words; 0 for null."""
    return whole_number(F.regexp_count(text, F.lit(WORD)))


def fingerprint(text: Column) -> Column:
    """A hash of a text; null counts as empty. It tells rows without an id, or of equal ids, apart."""
    return F.substring(F.md5(F.coalesce(text, F.lit(""))), 1, 16)


def draw(doc_id: Column, seed: Column, mark: Column | None = None) -> Column:
    """A number in [0, 1) that depends on the document's id, the fingerprint of its text and the seed alone."""
    key = F.concat_ws(":", seed.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("") if mark is None else mark)
    return F.conv(F.substring(F.md5(key), 1, _DIGITS), 16, 10).cast("double") / float(16**_DIGITS)


def source_sizes(docs: DataFrame, weights: Sequence[float] = WEIGHTS) -> DataFrame:
    """source, source_size, weight: one row per source. Weights repeat over the sources in code point order, null last.

    ``docs`` has columns source and size.
    """
    sizes = docs.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    numbered = global_row_number(sizes, [F.col("source").asc_nulls_last()], "_place_of")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    place = F.pmod(F.col("_place_of") - 1, F.lit(len(weights))).cast("int")
    return numbered.withColumn("weight", F.get(cycle, place)).drop("_place_of")


def with_targets(sources: DataFrame, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Adds target and rate. Targets share all words by weight and stop at ``max_repeats`` times the source's size.

    What a capped source leaves is shared again among the others, until none is
    above its cap. That only ever adds to the capped sources, so the loop ends;
    each turn sends two sums to the driver, whatever the number of sources.
    """
    cap = F.col("source_size") * F.lit(float(max_repeats))
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    share, capped = None, -1
    while True:
        above = F.lit(False) if share is None else cap < F.col("weight") * F.lit(share)
        row = sources.agg(
            F.sum(F.when(above, cap)).alias("given"),
            F.sum(F.when(~above, F.col("weight"))).alias("open"),
            F.count(F.when(above, F.lit(1))).alias("capped"),
        ).first()
        if row["capped"] == capped or not row["open"]:
            break
        capped = row["capped"]
        share = (total - (row["given"] or 0.0)) / row["open"]
    target = F.least(cap, F.col("weight") * F.lit(share or 0.0))
    return sources.withColumn("target", target).withColumn(
        "rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    )


def with_seeds(docs: DataFrame, rates: DataFrame, n_sources: int, seeds: int = SEEDS) -> DataFrame:
    """Adds seed: the one of ``seeds`` whose extra copies bring the source nearest to its target; the lowest of equals."""
    fraction = F.col("rate") - F.floor("rate")
    joined = docs.join(sized(rates.withColumnRenamed("source", "_s"), n_sources), F.col("source").eqNullSafe(F.col("_s")))
    extra = [
        F.sum(F.when(draw(F.col("doc_id"), F.lit(k), F.col("fingerprint")) < fraction, F.col("size")).otherwise(F.lit(0))).alias(f"_x{k}")
        for k in range(seeds)
    ]
    sums = joined.groupBy("source").agg(F.max("target").alias("_t"), F.sum(F.floor("rate") * F.col("size")).alias("_f"), *extra)
    off = [
        F.struct(F.abs(F.col("_t") - F.col("_f") - F.col(f"_x{k}")).alias("off"), F.lit(k).alias("seed")) for k in range(seeds)
    ]
    best = sums.select(F.col("source").alias("_s"), F.array_min(F.array(*off))["seed"].alias("seed"))
    return rates.join(best, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s").withColumn(
        "seed", F.coalesce("seed", F.lit(0))
    )


def mixing_plan(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, max_repeats: int = MAX_REPEATS, seeds: int = SEEDS
) -> tuple[DataFrame, DataFrame]:
    """(sizes, rates) of ``docs`` with columns doc_id, text, source.

    sizes: doc_id, source, size, fingerprint, one row per document, written once because
    three steps read it; the texts are read a single time. rates: source,
    source_size, weight, target, rate, seed, one row per source.
    """
    sizes = materialize(docs.select("doc_id", "source", words(F.col("text")).alias("size"), fingerprint(F.col("text")).alias("fingerprint")), "mix-sizes")
    rates = materialize(with_targets(source_sizes(sizes, weights), max_repeats), "mix-rates")
    return sizes, materialize(with_seeds(sizes, rates, rates.count(), seeds), "mix-seeds")


def copies(doc_id: Column, rate: Column, seed: Column, mark: Column) -> Column:
    """How often a document is emitted."""
    return (F.floor(rate) + F.when(draw(doc_id, seed, mark) < rate - F.floor(rate), F.lit(1)).otherwise(F.lit(0))).cast("int")


def with_copies(docs: DataFrame, rates: DataFrame) -> DataFrame:
    """``docs`` (doc_id, source, fingerprint and any other columns) with the columns of ``rates`` and copies.

    The rates go to every task if their number is small, which is checked;
    else the join shuffles and adaptive execution splits the hot source.
    """
    of = free_name(docs, "_mix_source")
    right = rates.withColumnRenamed("source", of)
    return (
        docs.join(sized(right, rates.count()), F.col("source").eqNullSafe(F.col(of)), "left")
        .drop(of)
        .withColumn("copies", copies(F.col("doc_id"), F.col("rate"), F.col("seed"), F.col("fingerprint")))
    )


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """The mixed documents: every row of ``docs``, repeated as planned, with its own columns only."""
    _, rates = mixing_plan(docs, weights, max_repeats)
    columns = docs.columns
    of, rate, seed = (free_name(docs, n) for n in ("_mix_source", "_mix_rate", "_mix_seed"))
    right = rates.select(F.col("source").alias(of), F.col("rate").alias(rate), F.col("seed").alias(seed))
    times = copies(F.col("doc_id"), F.col(rate), F.col(seed), fingerprint(F.col("text")))
    return (
        docs.join(sized(right, rates.count()), F.col("source").eqNullSafe(F.col(of)))
        .where(times > 0)
        .withColumn(rate, F.explode(F.array_repeat(F.lit(0), times)))
        .select(*[f"`{c}`" for c in columns])
    )
