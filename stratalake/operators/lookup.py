"""Dimension lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lookup_key(fact: DataFrame, dim: DataFrame, on: str, surrogate: str) -> DataFrame:
    """Left join that adds the surrogate key for ``on``; unmatched rows keep NULL.

    Only the two needed dimension columns take part. No hint is given: the
    planner broadcasts a dimension whose measured size allows it, and
    otherwise sorts and merges, where adaptive execution splits the partitions
    of hot keys (NULL included) on the fact side.
    """
    keys = dim.select(F.col(on).alias("_lookup"), F.col(surrogate))
    return fact.join(keys, F.col(on) == F.col("_lookup"), "left").drop("_lookup")


def _hashable(dtype: T.DataType) -> bool:
    if isinstance(dtype, (T.MapType, T.VariantType)):
        return False
    if isinstance(dtype, T.ArrayType):
        return _hashable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(_hashable(f.dataType) for f in dtype.fields)
    return True


def heavy_keys(df: DataFrame, on: str, share: float = 0.01) -> list[tuple]:
    """Keys that hold more than ``share`` of all rows, NULL included, with that share.

    Fewer than ``1 / share`` keys can qualify, so the answer is bounded however
    large ``df`` is. Counting combines on the map side.
    """
    if not 0.0 < share < 1.0:
        raise ValueError("share must lie between 0 and 1")
    total = df.count()
    heavy = df.groupBy(F.col(on).alias("key")).count().filter(F.col("count") > total * share)
    return [(r["key"], r["count"] / total) for r in heavy.collect()]


def salted_lookup(
    fact: DataFrame,
    dim: DataFrame,
    on: str,
    surrogate: str,
    heavy: Sequence[tuple],
    salts: int = 64,
) -> DataFrame:
    """:func:`lookup_key` that spreads known heavy keys over ``salts`` partitions.

    For sessions without adaptive skew handling, or where the join feeds an
    operator that needs its output partitioning. Heavy fact rows are salted by
    a hash of their other columns, which a recomputed task repeats exactly (a
    random salt would not). Only the heavy dimension rows are copied, once per
    salt, so the copy adds at most ``len(heavy) * salts`` rows.
    """
    values = [key for key, _ in heavy if key is not None]
    is_heavy = F.coalesce(F.col(on).isin(values), F.lit(False)) if values else F.lit(False)
    others = [f.name for f in fact.schema.fields if f.name != on and _hashable(f.dataType)]
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in others]), F.lit(salts)).cast("int")
    # NULL never matches, so its rows may go anywhere.
    salted_fact = fact.withColumn("_salt", F.when(is_heavy | F.col(on).isNull(), spread).otherwise(F.lit(0)))
    dim_heavy = F.col("_lookup").isin(values) if values else F.lit(False)
    copies = F.when(dim_heavy, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    salted_dim = (
        dim.select(F.col(on).alias("_lookup"), F.col(surrogate))
        .withColumn("_dim_salt", F.explode(copies))
    )
    condition = (F.col(on) == F.col("_lookup")) & (F.col("_salt") == F.col("_dim_salt"))
    return salted_fact.join(salted_dim, condition, "left").drop("_lookup", "_salt", "_dim_salt")
