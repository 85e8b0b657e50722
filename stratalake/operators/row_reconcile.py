"""Reconciliation of two tables row by row, without joining what agrees.

Both sides are reduced to sums of row hashes by bucket of the key, which don't
depend on the order of rows. Buckets whose sums agree hold the same rows. Only
the rows of the other buckets are compared key by key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.session import materialize

BUCKETS = 4096
MISSING, EXTRA, CHANGED = "missing", "extra", "changed"
_HALF = (1 << 32) - 1


def _row_hash(columns: Sequence[str]) -> Column:
    """Each value with a mark for NULL, so that a NULL next to a value isn't the value next to a NULL."""
    parts = [p for c in columns for p in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return F.xxhash64(*parts)


def _sums(prefix: str) -> list[Column]:
    """Number of rows and the sums of the halves of their hashes, which can't overflow below 2**31 rows a group."""
    low, high = F.col("_hash").bitwiseAND(F.lit(_HALF)), F.shiftrightunsigned("_hash", 32)
    return [F.count(F.lit(1)).alias(f"{prefix}_rows"), F.sum(low).alias(f"{prefix}_low"), F.sum(high).alias(f"{prefix}_high")]


def _hashed(df: DataFrame, keys: Sequence[str], columns: Sequence[str], buckets: int) -> DataFrame:
    bucket = F.pmod(_row_hash(keys), F.lit(buckets)).cast("int").alias("_bucket")
    return df.select(*[F.col(f"`{k}`") for k in keys], _row_hash([*keys, *columns]).alias("_hash"), bucket)


def differing_buckets(left: DataFrame, right: DataFrame) -> DataFrame:
    a, b = left.groupBy("_bucket").agg(*_sums("left")), right.groupBy("_bucket").agg(*_sums("right"))
    same = [F.col(f"left_{x}").eqNullSafe(F.col(f"right_{x}")) for x in ("rows", "low", "high")]
    return a.join(b, "_bucket", "full").filter(~(same[0] & same[1] & same[2])).select("_bucket")


def reconcile_rows(
    left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None, buckets: int = BUCKETS
) -> DataFrame:
    """``keys``, difference, left_rows, right_rows: keys whose rows in ``left`` and ``right`` differ.

    missing: only in ``left``; extra: only in ``right``; changed: in both, with
    other values or another number of rows. ``columns`` defaults to all that ``left`` has beside the keys; both
    sides need the same types. A key may repeat; NULL is a key like any other.
    The first pass shuffles one row per bucket and task. Equal sums of different rows have a chance below 2**-60.
    """
    columns = list(columns) if columns is not None else [c for c in left.columns if c not in keys]
    a, b = (_hashed(side, keys, columns, buckets) for side in (left, right))
    # At most `buckets` rows.
    apart = F.broadcast(materialize(differing_buckets(a, b), "differing-buckets"))
    one, two = (
        side.join(apart, "_bucket", "left_semi").groupBy(*keys).agg(*_sums(name)) for side, name in ((a, "left"), (b, "right"))
    )
    same_key = F.lit(True)
    for k in keys:
        same_key = same_key & F.col(f"l.`{k}`").eqNullSafe(F.col(f"r.`{k}`"))
    met = one.alias("l").join(two.alias("r"), same_key, "full")
    rows = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("left_rows", "right_rows")]
    equal = F.col("left_low").eqNullSafe(F.col("right_low")) & F.col("left_high").eqNullSafe(F.col("right_high")) & F.col("left_rows").eqNullSafe(F.col("right_rows"))
    kind = F.when(F.col("right_rows").isNull(), MISSING).when(F.col("left_rows").isNull(), EXTRA).otherwise(CHANGED)
    named = [F.when(F.col("left_rows").isNull(), F.col(f"r.`{k}`")).otherwise(F.col(f"l.`{k}`")).alias(k) for k in keys]
    return met.filter(~equal).select(*named, kind.alias("difference"), *rows)
