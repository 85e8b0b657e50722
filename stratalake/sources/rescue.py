"""Typed columns out of JSON text, with everything that does not fit rescued."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESCUED = "_rescued_data"
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)


def _fits(value: Column, dtype: T.DataType) -> Column:
    """Whether a variant converts to ``dtype`` without losing anything."""
    if isinstance(dtype, T.StringType):
        kind = F.schema_of_variant(value)
        return ~(kind.startswith("OBJECT") | kind.startswith("ARRAY"))
    if isinstance(dtype, T.VariantType):
        return F.lit(True)
    if isinstance(dtype, T.StructType):
        fields = value.try_cast("map<string,variant>")
        names = F.array(*[F.lit(n) for n in dtype.fieldNames()]).cast("array<string>")
        good = fields.isNotNull() & (F.size(F.array_except(F.map_keys(fields), names)) == 0)
        for f in dtype.fields:
            good = good & _absent_or_fits(fields[f.name], f.dataType)
        return good
    if isinstance(dtype, T.ArrayType):
        items = value.try_cast("array<variant>")
        return items.isNotNull() & F.forall(items, lambda x: _absent_or_fits(x, dtype.elementType))
    if isinstance(dtype, T.MapType):
        fields = value.try_cast("map<string,variant>")
        return fields.isNotNull() & F.forall(
            F.map_values(fields), lambda x: _absent_or_fits(x, dtype.valueType)
        )
    converts = value.try_cast(dtype).isNotNull()
    kind = F.schema_of_variant(value)
    if isinstance(dtype, _INTEGRAL):
        return converts & (kind == "BIGINT")
    if isinstance(dtype, T.DecimalType):
        # The type text tells how many digits stand before and behind the point.
        digits = F.regexp_extract(kind, r"DECIMAL\((\d+),", 1).try_cast("int")
        behind = F.regexp_extract(kind, r",(\d+)\)", 1).try_cast("int")
        exact = (behind <= dtype.scale) & (digits - behind <= dtype.precision - dtype.scale)
        return converts & ((kind == "BIGINT") | F.coalesce(exact, F.lit(False)))
    if isinstance(dtype, _FRACTIONAL):
        # A number fits if it comes back the same. Fifteen digits always do.
        near = value.try_cast(dtype).cast("double")
        whole = (kind == "BIGINT") & (F.abs(near) < float(1 << 53))
        few = kind.rlike(r"^DECIMAL\(([1-9]|1[0-5]),\d+\)$")
        back = kind.startswith("DECIMAL") & (near.try_cast("decimal(38,18)") == value.try_cast("decimal(38,18)"))
        return converts & (whole | few | F.coalesce(back, F.lit(False)) | kind.isin("DOUBLE", "FLOAT"))
    if isinstance(dtype, T.BooleanType):
        return converts & (kind == "BOOLEAN")
    return converts


def _absent_or_fits(value: Column, dtype: T.DataType) -> Column:
    absent = value.isNull() | F.coalesce(F.is_variant_null(value), F.lit(True))
    return F.when(absent, F.lit(True)).otherwise(F.coalesce(_fits(value, dtype), F.lit(False)))


def _clean_pattern(dtype: T.DataType) -> str | None:
    """A pattern for ``schema_of_variant`` that only values without misfits match.

    None where the type text alone cannot tell, such as for timestamps.
    """
    if isinstance(dtype, T.StringType):
        return "(STRING|BIGINT|DOUBLE|BOOLEAN|VOID)"
    if isinstance(dtype, T.LongType):
        return "(BIGINT|VOID)"
    if isinstance(dtype, T.DoubleType):
        # Whole numbers and long decimals have to be looked at one by one.
        return r"(DOUBLE|DECIMAL\(([1-9]|1[0-5]),\d+\)|VOID)"
    if isinstance(dtype, T.DecimalType) and dtype.scale == 0 and dtype.precision == 38:
        return r"(BIGINT|DECIMAL\(\d+,0\)|VOID)"
    if isinstance(dtype, T.BooleanType):
        return "(BOOLEAN|VOID)"
    if isinstance(dtype, T.ArrayType):
        element = _clean_pattern(dtype.elementType)
        return element and f"(ARRAY<{element}>|VOID)"
    if isinstance(dtype, T.StructType):
        # A variant keeps its keys sorted, and each may be absent.
        parts = []
        for f in sorted(dtype.fields, key=lambda f: f.name):
            inner = _clean_pattern(f.dataType)
            if inner is None or not re.fullmatch(r"\w+", f.name):
                return None
            parts.append(f"(`?{f.name}`?: {inner}(, |(?=>)))?")
        return f"(OBJECT<{''.join(parts)}>|VOID)"
    return None


def typed_with_rescue(
    df: DataFrame, schema: T.StructType, payload: str = "record", raw: str | None = None
) -> DataFrame:
    """Replace a JSON column, text or VARIANT, by the schema's columns and ``_rescued_data``.

    A key the schema does not know, and a value its column cannot hold (at any
    depth), is kept under its top-level key as JSON text. Text that is not an
    object is kept whole. NULL when nothing had to be rescued. Numbers do not
    become shorter: 1.5 in an integer column is rescued, not cut. ``raw`` names
    the column with the text of records that did not parse into a VARIANT.
    """
    others = [c for c in df.columns if c not in (payload, raw)]
    if isinstance(df.schema[payload].dataType, T.VariantType):
        parsed, text = F.col(payload), F.to_json(payload)
    else:
        parsed, text = F.try_parse_json(F.col(payload)), F.col(payload)
    if raw:
        text = F.coalesce(F.col(raw), text)
    clashes = set(schema.fieldNames()) & set(others)
    if clashes:
        raise ValueError(f"record fields clash with columns: {sorted(clashes)}")
    if not schema.fields:
        return df.select(*others, text.alias(RESCUED))
    value, fields = F.col("_value"), F.col("_value").try_cast("map<string,variant>")
    # Most records have no misfit, which their type text shows. Only the
    # others are taken apart key by key.
    pattern = _clean_pattern(schema)
    kind = F.schema_of_variant(value)
    clean = F.coalesce(kind.rlike(f"^{pattern}$") & (kind != "VOID"), F.lit(False)) if pattern else F.lit(False)
    checked = [
        F.struct(_absent_or_fits(F.col("_fields")[f.name], f.dataType).alias("fits")).alias(f.name) for f in schema.fields
    ]
    typed, misfits = [], []
    for f in schema.fields:
        fits = F.col(f"_checked.`{f.name}`.fits")
        best = F.col("_fields")[f.name].try_cast(f.dataType)
        # A nested value keeps the parts that do convert; a scalar is all or nothing.
        nested = isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))
        typed.append((best if nested else F.when(fits, best)).alias(f.name))
        misfits.append(F.when(~fits, F.lit(f.name)))
    known = F.array(*[F.lit(n) for n in schema.fieldNames()])
    kept = F.map_filter(
        F.col("_fields"),
        lambda k, v: ~F.array_contains(known, k) | F.array_contains(F.array_compact(F.array(*misfits)), k),
    )
    leftover = F.when(F.col("_fields").isNull(), text).when(F.size("_kept") > 0, F.to_json("_kept"))
    staged = (
        df.withColumn("_value", parsed)
        .withColumn("_clean", clean)
        .withColumn("_fields", F.when(~F.col("_clean"), fields))
        .withColumn("_checked", F.when(~F.col("_clean"), F.struct(*checked)))
        .withColumn("_kept", F.when(~F.col("_clean"), kept))
        .withColumn("_row", F.when(F.col("_clean"), value.try_cast(schema)).otherwise(F.struct(*typed)))
    )
    return staged.select(
        *others,
        *[F.col(f"_row.`{n}`").alias(n) for n in schema.fieldNames()],
        F.when(~F.col("_clean"), leftover).alias(RESCUED),
    )
