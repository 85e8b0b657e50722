"""Cutting the rows of hot keys into ranges of a sequence column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.session import materialize

# A key is hot above max_rows, and never below this share of all rows: so at
# most MAX_HOT_KEYS keys and 2 * MAX_HOT_KEYS ranges exist at any data size.
MAX_HOT_KEYS = 10_000
# Bounds the quantile grid held per hot key.
MAX_RANGES_PER_KEY = 4_000
_BLOCK = 64


def _as_number(column: str, dtype: T.DataType):
    """A numeric image of the sequence that keeps its order."""
    c = F.col(column)
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(dtype, T.TimestampNTZType):
        return F.unix_micros(c.cast("timestamp"))
    if isinstance(dtype, T.DateType):
        return F.unix_date(c).cast("long")
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return c.cast("long")
    raise ValueError(f"cannot cut ranges of {dtype.simpleString()}")


def bucketed_by_sequence(
    df: DataFrame, keys: Sequence[str], sequence: str, max_rows: int
) -> tuple[DataFrame, DataFrame | None]:
    """Add ``_bucket`` and ``_hot`` so that no (key, bucket) grows far past the limit.

    The limit is ``max_rows``, or a 1 / MAX_HOT_KEYS share of all rows if that
    is more. A narrow count per key finds the keys beyond it. Their range
    limits are approximate quantiles of the sequence, fetched to the driver as
    constants, so every later reading of ``df`` cuts at the same places; they
    number at most 2 * MAX_HOT_KEYS in all. Buckets follow the sequence, and
    equal sequence values share a bucket.

    Without hot keys the second result is None and ``_bucket`` is constant.
    """
    plain = df.withColumn("_bucket", F.lit(0)).withColumn("_hot", F.lit(False))
    # One narrow count per key gives the total as well.
    counts = materialize(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")), "key-counts")
    total = counts.agg(F.sum("count")).first()[0] or 0
    limit = max(max_rows, total // MAX_HOT_KEYS)
    found = counts.filter(F.col("count") > limit).collect()
    if not found:
        return plain, None

    spark = df.sparkSession
    dtype = df.schema[sequence].dataType
    key_fields = [T.StructField(f"_h{i}", df.schema[k].dataType) for i, k in enumerate(keys)]
    names = [f.name for f in key_fields]

    def match(left: Sequence[str], right: Sequence[str]):
        condition = F.lit(True)
        for a, b in zip(left, right):
            condition = condition & F.col(a).eqNullSafe(F.col(b))
        return condition

    pieces = [
        (*[r[k] for k in keys], min(MAX_RANGES_PER_KEY, -(-r["count"] // limit))) for r in found
    ]
    wanted = spark.createDataFrame(pieces, T.StructType([*key_fields, T.StructField("_pieces", T.LongType())]))
    number = _as_number(sequence, dtype)
    # One grid serves all hot keys; each keeps every step-th point of it, on
    # the executors, so only the wanted limits travel.
    grid = max(p[-1] for p in pieces)
    fractions = F.array(*[F.lit(i / grid) for i in range(1, grid)])
    step = F.greatest(F.lit(1), F.floor(F.lit(grid) / F.col("_pieces")))
    limits = (
        df.select(*keys, number.alias("_number"))
        .join(F.broadcast(wanted), match(keys, names))
        .groupBy(*names, "_pieces")
        .agg(F.percentile_approx("_number", fractions, 10_000).alias("_grid"))
        .select(
            *names,
            F.array_distinct(F.filter("_grid", lambda _, i: (i + 1) % step == 0)).alias("_limits"),
        )
        .collect()
    )
    # Searched in two steps, blocks first, so a row costs a few dozen
    # comparisons even with thousands of limits.
    chosen = [(*[r[n] for n in names], r["_limits"], r["_limits"][_BLOCK - 1 :: _BLOCK]) for r in limits]
    array = T.ArrayType(T.LongType())
    schema = T.StructType([*key_fields, T.StructField("_limits", array), T.StructField("_blocks", array)])
    hot = spark.createDataFrame(chosen, schema)

    def below(limits_of) -> Column:
        return F.size(F.filter(limits_of, lambda p: p < number))

    bucketed = (
        df.join(F.broadcast(hot), match(keys, names), "left")
        .withColumn("_hot", F.col("_limits").isNotNull())
        .withColumn("_skipped", below("_blocks") * _BLOCK)
        .withColumn("_within", below(F.slice("_limits", F.col("_skipped") + 1, F.lit(_BLOCK))))
        .withColumn("_bucket", F.when(F.col("_hot"), F.col("_skipped") + F.col("_within")).otherwise(F.lit(0)))
        .drop(*names, "_limits", "_blocks", "_skipped", "_within")
    )
    return bucketed, hot
