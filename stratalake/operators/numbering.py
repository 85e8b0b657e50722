"""Global sequential numbers without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.session import materialize, partitions_for

# monotonically_increasing_id() keeps the row position in the low 33 bits and
# the partition number above them.
_POSITION_BITS = 33


def global_row_number(
    df: DataFrame,
    order: Sequence[str | Column],
    alias: str,
    partitions: int | None = None,
) -> DataFrame:
    """Number all rows 1..n in ``order``.

    Rows are range-partitioned on the whole sort key, so one hot leading key is
    cut wherever the later columns differ, then sorted within partitions. Each
    row's (partition, position) is written out with the row, because range
    boundaries come from sampling and a second evaluation could draw others.
    Only the per-partition counts, one row each, pass through one task.

    The order is total when the sort key is unique.
    """
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    n = partitions or partitions_for(df)
    placed = (
        df.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    placed = materialize(placed, "numbering")
    part = F.shiftright(F.col("_place"), _POSITION_BITS)
    position = F.col("_place").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    counts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # At most n rows: bounded by the partition count, not by the data.
    offsets = counts.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    return (
        placed.join(F.broadcast(offsets), part == F.col("_part"))
        .withColumn(alias, (F.col("_offset") + position + 1).cast("long"))
        .drop("_place", "_part", "_offset")
    )


def stable_numbers(registry: DataFrame | None, rows: DataFrame, keys: Sequence[str], alias: str) -> DataFrame:
    """The registry (``keys``, ``alias``) with a number for every key of ``rows``.

    Numbers once given stay. New keys get the numbers after the largest one, in
    their own order, without gaps; a batch that comes again brings no new key. NULL
    is a key like any other.
    """
    found = rows.select(*keys).distinct()
    if registry is None:
        return global_row_number(found, list(keys), alias)
    same = reduce(lambda a, b: a & b, [F.col(f"f.`{k}`").eqNullSafe(F.col(f"g.`{k}`")) for k in keys])
    new = found.alias("f").join(registry.alias("g"), same, "left_anti")
    largest = registry.agg(F.coalesce(F.max(alias), F.lit(0))).first()[0]
    numbered = global_row_number(new, list(keys), alias)
    return registry.unionByName(numbered.withColumn(alias, F.col(alias) + F.lit(largest)))
