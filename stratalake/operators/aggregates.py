"""Grain-safe aggregation and key checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sum_at_grain(
    df: DataFrame,
    grain: Sequence[str],
    value: str,
    by: Sequence[str] = (),
    alias: str = "total",
    count_alias: str = "grain_rows",
) -> DataFrame:
    """Sum a value that repeats on every row of a coarser grain.

    The value is first reduced to one per ``grain`` and only then summed, so a
    row fan-out below the grain cannot inflate it.
    """
    per_grain = df.groupBy(*by, *[g for g in grain if g not in by]).agg(F.max(value).alias("_value"))
    return per_grain.groupBy(*by).agg(
        F.count(F.lit(1)).alias(count_alias), F.sum("_value").alias(alias)
    )


def one_row(*parts: DataFrame) -> DataFrame:
    """Put one-row results with different columns side by side."""
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def duplicate_keys(df: DataFrame, keys: Sequence[str], alias: str = "row_count") -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(alias)).filter(F.col(alias) > 1)


def duplicate_flags(df: DataFrame, keys: Sequence[str], alias: str = "_repeated") -> DataFrame:
    """Every key once, with 1 when it repeats and 0 when it does not."""
    return df.groupBy(*keys).agg((F.count(F.lit(1)) > 1).cast("int").alias(alias))


def duplicate_key_count(df: DataFrame, keys: Sequence[str], alias: str = "duplicate_count") -> DataFrame:
    return duplicate_keys(df, keys).agg(F.count(F.lit(1)).alias(alias))


def require_unique(df: DataFrame, keys: Sequence[str], what: str = "input") -> None:
    """Raise when a key repeats. Runs a job; only a few offending keys reach the driver."""
    offending = duplicate_keys(df, keys).limit(5).collect()
    if offending:
        sample = [tuple(r[k] for k in keys) for r in offending]
        raise ValueError(f"{what} has duplicate keys on {list(keys)}, e.g. {sample}")
