"""Latest record per key, and its single-source and top-1 forms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ARRIVAL_ORDER = ("ingestion_timestamp", "_source_file")


def _hashable(field: T.StructField) -> Column:
    """The column itself, or its JSON text where the hash function takes no such type."""

    def plain(dtype: T.DataType) -> bool:
        if isinstance(dtype, T.ArrayType):
            return plain(dtype.elementType)
        if isinstance(dtype, T.StructType):
            return all(plain(f.dataType) for f in dtype.fields)
        return not isinstance(dtype, (T.MapType, T.VariantType))

    c = F.col(f"`{field.name}`")
    return c if plain(field.dataType) else F.to_json(F.struct(c))


def content_hash(df: DataFrame, leave_out: Sequence[str] = ()) -> Column:
    """A 64-bit hash of a row's content. Column order and NULL columns do not matter."""
    fields = sorted((f for f in df.schema.fields if f.name not in set(leave_out)), key=lambda f: f.name)
    return F.xxhash64(*[_hashable(f) for f in fields]) if fields else F.lit(0).cast("long")


def arrival_ordering(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> list[Column]:
    """Newest first; rows of one file and time are told apart by their content.

    The tie-break is one number per row, so that a consumer that needs two of
    twenty columns still shuffles two columns and not twenty.
    """
    named = [c for c in order if c in df.columns]
    return [F.col(f"`{c}`").desc() for c in named] + [content_hash(df, [*keys, *named]).desc()]


def latest_records(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = ARRIVAL_ORDER,
    null_keys: str = "collapse",
) -> DataFrame:
    """One row per key: the one that arrived last.

    Arrival decides, never a business date. ``row_number() = 1`` is planned as
    a group limit before *and* after the shuffle, so each map task sends at
    most one row per key: a key that holds a third of the input reaches its
    reducer as one row per map task.

    ``null_keys``: ``collapse`` treats NULL as one key, ``reject`` leaves such
    rows out (see :func:`null_key_records`).
    """
    if null_keys not in ("collapse", "reject"):
        raise ValueError(f"unknown null_keys {null_keys!r}")
    if null_keys == "reject":
        df = df.filter(~_any_null(keys))
    window = Window.partitionBy(*keys).orderBy(*arrival_ordering(df, keys, order))
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def _any_null(keys: Sequence[str]) -> Column:
    condition = F.lit(False)
    for k in keys:
        condition = condition | F.col(f"`{k}`").isNull()
    return condition


def null_key_records(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows :func:`latest_records` leaves out with ``null_keys='reject'``."""
    return df.filter(_any_null(keys))


def top_one(df: DataFrame, predicate: Column | str, newest_first: Sequence[str]) -> DataFrame:
    """The newest matching row; planned as a top-1, not a full sort."""
    return df.filter(predicate).orderBy(*[F.col(c).desc() for c in newest_first]).limit(1)
