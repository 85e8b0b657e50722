"""Persisted, versioned schemas that grow between runs."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The declared schemas of the user feed and of the news feed.
USER_FEED = (
    "`@odata.context` STRING, value ARRAY<STRUCT<businessPhones: ARRAY<STRING>, displayName: STRING, givenName: STRING,"
    " id: STRING, jobTitle: STRING, mail: STRING, mobilePhone: STRING, officeLocation: STRING, preferredLanguage: STRING,"
    " surname: STRING, userPrincipalName: STRING>>"
)
NEWS_FEED = (
    "articles ARRAY<STRUCT<author: STRING, content: STRING, description: STRING, publishedAt: STRING,"
    " source: STRUCT<id: STRING, name: STRING>, title: STRING, url: STRING, urlToImage: STRING>>,"
    " status STRING, totalResults BIGINT, ingestion_date DATE"
)


def merge_schemas(known: T.DataType, seen: T.DataType, widen: bool = False) -> T.DataType:
    """The known schema plus the seen one's new fields, at any depth.

    Known fields keep their place and type; new ones are appended by name, so
    the outcome does not depend on the order in which files were seen. With
    ``widen`` a type conflict moves to decimal, double or string; without, the known
    type stays and misfits are rescued at read time.
    """
    if isinstance(known, T.StructType) and isinstance(seen, T.StructType):
        theirs = {f.name: f for f in seen.fields}
        fields = []
        for f in known.fields:
            other = theirs.get(f.name)
            dtype = merge_schemas(f.dataType, other.dataType, widen) if other else f.dataType
            fields.append(T.StructField(f.name, dtype, True))
        old = set(known.fieldNames())
        new = sorted((f for f in seen.fields if f.name not in old), key=lambda f: f.name)
        return T.StructType(fields + [T.StructField(f.name, f.dataType, True) for f in new])
    if isinstance(known, T.ArrayType) and isinstance(seen, T.ArrayType):
        return T.ArrayType(merge_schemas(known.elementType, seen.elementType, widen))
    if known == seen or not widen or isinstance(seen, T.NullType):
        return known
    if isinstance(known, T.LongType) and isinstance(seen, T.DecimalType) or isinstance(known, T.DecimalType) and isinstance(seen, T.LongType):
        return known if isinstance(known, T.DecimalType) else seen
    numeric = (T.LongType, T.DoubleType)
    if isinstance(known, numeric) and isinstance(seen, numeric):
        return T.DoubleType()
    return T.StringType()


def infer_schema(records: DataFrame, payload: str = "record", sampling: float = 1.0) -> T.StructType:
    """The schema of a column of JSON objects (text or VARIANT), fields sorted by name.

    Inference is a distributed aggregation. ``sampling`` below 1 reads fewer
    records; what the sample missed is rescued, not lost.
    """
    picked = records if sampling >= 1.0 else records.sample(sampling, seed=7)
    value = F.col(payload)
    if not isinstance(records.schema[payload].dataType, T.VariantType):
        value = F.try_parse_json(value)
    inferred = _schema_of(picked, value)
    if inferred and not inferred.startswith("OBJECT<"):
        # Stray scalars or lists blur the picture; look at the objects alone.
        inferred = _schema_of(picked, F.when(F.schema_of_variant(value).startswith("OBJECT"), value))
    if not inferred or not inferred.startswith("OBJECT<"):
        return T.StructType([])
    ddl = inferred.replace("OBJECT<", "STRUCT<")
    dtype = records.sparkSession.range(0).select(F.lit(None).cast(ddl).alias("s")).schema["s"].dataType
    return _plain(dtype)


def _schema_of(records: DataFrame, value: Column) -> str | None:
    return records.agg(F.schema_of_variant_agg(value).alias("s")).first()["s"]


def _plain(dtype: T.DataType) -> T.DataType:
    """Long for integers, decimal for those beyond 64 bits, double for fractions, string for what was only ever null.

    A fraction that a double would change is rescued when it is read.
    """
    if isinstance(dtype, T.StructType):
        fields = sorted(dtype.fields, key=lambda f: f.name)
        return T.StructType([T.StructField(f.name, _plain(f.dataType), True) for f in fields])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_plain(dtype.elementType))
    if isinstance(dtype, T.DecimalType) and dtype.scale == 0 and dtype.precision > 18:
        return T.DecimalType(38, 0)
    if isinstance(dtype, (T.DecimalType, T.FloatType)):
        return T.DoubleType()
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType)):
        return T.LongType()
    if isinstance(dtype, (T.NullType, T.VariantType)):
        return T.StringType()
    return dtype


class SchemaStore:
    """The schema versions of one source, as small JSON files in a folder."""

    def __init__(self, spark: SparkSession, path: str):
        self._spark = spark
        self._path = path.rstrip("/")

    def _rows(self, pattern: str, schema: str) -> list:
        try:
            return self._spark.read.schema(schema).json(f"{self._path}/{pattern}").collect()
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return []
            raise

    def load(self) -> tuple[int, T.StructType]:
        """Current version number and schema; version 0 is empty."""
        versions = self._rows("v*", "version INT, body STRING")
        if not versions:
            return 0, T.StructType([])
        last = max(versions, key=lambda r: r["version"])
        return last["version"], T.StructType.fromJson(json.loads(last["body"]))

    def evolve(self, seen: T.StructType, widen: bool = False) -> tuple[int, T.StructType]:
        """Merge a newly seen schema in; a new version is stored only on change."""
        version, known = self.load()
        merged = merge_schemas(known, seen, widen)
        if version and merged == known:
            return version, known
        version += 1
        row = self._spark.createDataFrame([(version, merged.json())], "version INT, body STRING")
        row.coalesce(1).write.mode("overwrite").json(f"{self._path}/v{version:06d}")
        return version, merged

    def seen_until(self) -> str | None:
        """File time up to which documents have been looked at; None means look at all."""
        rows = self._rows("seen", "seen_until STRING")
        return rows[0]["seen_until"] if rows else None

    def mark_seen(self, until: str) -> None:
        # Losing this mark only means that the next run looks at older files
        # again, and merging is idempotent.
        row = self._spark.createDataFrame([(until,)], "seen_until STRING")
        row.coalesce(1).write.mode("overwrite").json(f"{self._path}/seen")
