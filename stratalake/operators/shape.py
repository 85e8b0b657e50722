"""Flattening, exploding and keying of nested records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions.keys import record_hash
from stratalake.operators.latest import latest_records

TECHNICAL_COLUMNS = ("_source_file", "_api_id", "ingestion_timestamp")


def quoted(path: str) -> str:
    """A dotted path with every part quoted, so odd field names stay usable."""
    return ".".join(f"`{part}`" for part in path.split("."))


def normalize_record_path(path: str | None) -> str | None:
    """Trim a dotted record path; blank means none; malformed parts raise."""
    if path is None or not path.strip():
        return None
    parts = [p.strip() for p in path.strip().split(".")]
    if any(not p or "/" in p or "\\" in p for p in parts):
        raise ValueError(f"invalid record path: {path!r}")
    return ".".join(parts)


def normalize_identifier(value: str | None, name: str) -> str:
    """Trim one catalog identifier; NULL, blank, dots and slashes raise."""
    if value is None or not value.strip():
        raise ValueError(f"{name} must not be empty")
    trimmed = value.strip()
    if set(trimmed) & set("./\\"):
        raise ValueError(f"{name} has an invalid character: {value!r}")
    return trimmed


def extract_records(
    df: DataFrame, record_path: str, technical: Sequence[str] = TECHNICAL_COLUMNS, rescued: str | None = None
) -> DataFrame:
    """One row per element of the array of structs at ``record_path``.

    Output: the element's fields, then the technical columns. Rows whose array
    is NULL or empty give nothing; sibling columns are dropped. ``rescued`` names
    a column with what of a document could not be read: where it is not NULL,
    it comes as one more row, after the fields of a record that are NULL there.
    """
    path = normalize_record_path(record_path)
    if path is None:
        raise ValueError("record path must not be empty")
    source = F.col(quoted(path))
    dtype = df.select(source.alias("r")).schema["r"].dataType
    if not isinstance(dtype, T.ArrayType):
        raise ValueError(f"record path {path!r} must be an array, not {dtype.simpleString()}")
    if not isinstance(dtype.elementType, T.StructType):
        raise ValueError(f"record path {path!r} must be an array of structs")
    clashes = set(dtype.elementType.fieldNames()) & {*technical, *([rescued] if rescued else [])}
    if clashes:
        raise ValueError(f"record fields clash with technical columns: {sorted(clashes)}")
    fields = dtype.elementType.fieldNames()
    if rescued:
        none = F.lit(None).cast(dtype.elementType)
        row = T.ArrayType(T.StructType([T.StructField("r", dtype.elementType), T.StructField("s", T.StringType())]))
        found = F.coalesce(F.transform(source, lambda x: F.struct(x.alias("r"), F.lit(None).cast("string").alias("s"))), F.array().cast(row))
        left = F.when(F.col(rescued).isNotNull(), F.array(F.struct(none.alias("r"), F.col(rescued).alias("s")))).otherwise(F.array().cast(row))
        return df.select(F.explode(F.concat(found, left)).alias("_row"), *technical).select(
            *[F.col(f"_row.r.`{f}`").alias(f) for f in fields], F.col("_row.s").alias(rescued), *technical
        )
    # The array is projected next to the technical columns before exploding,
    # so no sibling column is copied once per element.
    return (
        df.select(F.explode(source).alias("_record"), *technical)
        .select(*[F.col(f"_record.`{f}`").alias(f) for f in fields], *technical)
    )


def explode_in_place(df: DataFrame, column: str) -> DataFrame:
    """Replace an array column by its elements; NULL and empty arrays stay as one NULL row."""
    if not isinstance(df.schema[column].dataType, T.ArrayType):
        raise ValueError(f"{column} must be an array")
    return df.withColumn(column, F.explode_outer(F.col(f"`{column}`")))


def flatten_struct(df: DataFrame, column: str, prefix: str = "") -> DataFrame:
    """Append a struct's fields as columns and drop the struct; clashes raise."""
    dtype = df.schema[column].dataType
    if not isinstance(dtype, T.StructType):
        raise ValueError(f"{column} must be a struct")
    others = [c for c in df.columns if c != column]
    clashes = {prefix + f for f in dtype.fieldNames()} & set(others)
    if clashes:
        raise ValueError(f"flattening {column} would duplicate columns: {sorted(clashes)}")
    return df.select(
        *[F.col(f"`{c}`") for c in others],
        *[F.col(f"`{column}`.`{f}`").alias(prefix + f) for f in dtype.fieldNames()],
    )


def with_business_key(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn("business_key", F.col(f"`{column}`"))


def with_record_hash(df: DataFrame, columns: Sequence[str], name: str = "record_hash") -> DataFrame:
    return df.withColumn(name, record_hash(columns))


def with_processed_time(df: DataFrame) -> DataFrame:
    return df.withColumn("processed_timestamp", F.current_timestamp())


def drop_duplicate_keys(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the latest by ``order`` when given, else any one."""
    return latest_records(df, keys, order) if order else df.dropDuplicates(list(keys))


def flatten_feed(df: DataFrame, array_column: str, key: str, order: Sequence[str] = ()) -> DataFrame:
    """Explode a record array, flatten its struct, key it and keep one row per key."""
    flat = flatten_struct(explode_in_place(df, array_column), array_column)
    return drop_duplicate_keys(with_business_key(flat, key), ["business_key"], order)
