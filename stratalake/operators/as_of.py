"""Lookups in a history as of a time of the fact's own."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.operators.history import END, START
from stratalake.operators.skew import bucketed_by_sequence
from stratalake.session import materialize


def as_of_lookup(
    facts: DataFrame,
    history: DataFrame,
    keys: Sequence[str],
    at: str,
    columns: Sequence[str],
    start: str = START,
    end: str = END,
    max_rows_per_group: int = 5_000_000,
) -> DataFrame:
    """``facts`` with ``columns`` of the version that held at their time; NULL where none did.

    A version holds from ``start``, inclusive, to ``end``, exclusive; versions of a
    key don't overlap. Facts and versions are put in one order per key, and each fact
    takes the last version before it: rows are sorted once, where a join on the
    interval would meet every fact with every version of its key. A key with more rows than ``max_rows_per_group``
    is cut into ranges of time, and a range takes over the last version of the ranges before it.

    A NULL key or time matches nothing.
    """
    names = {k: f"_k{i}" for i, k in enumerate(keys)}
    known = reduce(lambda a, b: a & b, [F.col(f"`{k}`").isNotNull() for k in (*keys, at)])
    version = F.struct(*[F.col(f"`{c}`") for c in columns], F.col(end).alias("_until"))
    own = [F.col(f"`{k}`").alias(n) for k, n in names.items()]
    left = facts.filter(known).select(*own, F.col(f"`{at}`").alias("_at"), F.lit(1).alias("_kind"), F.struct(*[F.col(f"`{c}`") for c in facts.columns]).alias("_fact"))
    right = history.filter(F.col(start).isNotNull()).select(*own, F.col(start).cast(facts.schema[at].dataType).alias("_at"), F.lit(0).alias("_kind"), version.alias("_version"))
    both = materialize(left.unionByName(right, allowMissingColumns=True), "as-of")
    group = [*names.values()]
    rows, hot = bucketed_by_sequence(both, group, "_at", max_rows_per_group)
    so_far = Window.partitionBy(*group, "_bucket").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("_found", F.last("_version", ignorenulls=True).over(so_far))
    if hot is not None:
        rows = _with_earlier_range(rows, group)
    holds = F.col("_found._until").isNull() | (F.col("_at") < F.col("_found._until"))
    taken = [F.when(holds, F.col(f"_found.`{c}`")).alias(c) for c in columns]
    matched = rows.filter("_kind = 1").select("_fact.*", *taken)
    unknown = facts.filter(~known).select("*", *[F.lit(None).cast(history.schema[c].dataType).alias(c) for c in columns])
    return matched.unionByName(unknown)


def _with_earlier_range(rows: DataFrame, group: Sequence[str]) -> DataFrame:
    """Hot keys: where a range has no version yet, the last one of the ranges before it.

    One summary row per range; their number is bounded (see ``bucketed_by_sequence``), hence the broadcast.
    """
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    last: Column = F.max_by("_version", "_at").alias("_last")
    versions = rows.filter(F.col("_hot") & F.col("_version").isNotNull()).groupBy(*group, "_bucket").agg(last)
    ranges = rows.filter("_hot").select(*group, "_bucket").distinct().join(versions, [*group, "_bucket"], "left")
    carried = ranges.select(*[F.col(g).alias(f"{g}c") for g in group], F.col("_bucket").alias("_cb"), F.last("_last", ignorenulls=True).over(before).alias("_carried"))
    same = reduce(lambda a, b: a & b, [F.col(g) == F.col(f"{g}c") for g in group])
    joined = rows.join(F.broadcast(carried), F.col("_hot") & (F.col("_bucket") == F.col("_cb")) & same, "left")
    return joined.withColumn("_found", F.coalesce("_found", "_carried"))
