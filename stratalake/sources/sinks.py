"""Writing tables: load modes, raw payloads, control rows and published versions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.operators.quality import observe_rules, observed_failures, raise_failures
from stratalake.session import COMPRESSION

EMPTY_SCHEMA = T.StructType([T.StructField("ingestion_timestamp", T.TimestampType())])


def write_mode(load_type: str | None) -> str:
    """FULL, or nothing, overwrites; any other load type appends."""
    return "overwrite" if (load_type or "FULL").strip().upper() == "FULL" else "append"


def existing_schema(spark: SparkSession, path: str) -> T.StructType | None:
    try:
        return spark.read.parquet(path).schema
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def write_by_load_type(df: DataFrame, path: str, load_type: str | None) -> None:
    """Write a parquet table in the mode its load type asks for."""
    df.write.mode(write_mode(load_type)).parquet(path)


def save_table_by_load_type(df: DataFrame, table: str, load_type: str | None) -> None:
    """The same for a catalog table."""
    df.write.mode(write_mode(load_type)).format("parquet").saveAsTable(table)


def write_empty(spark: SparkSession, path: str, load_type: str | None, schema: T.StructType | None = None) -> None:
    """A load without records: the table exists afterwards, and FULL empties it.

    A known schema, given or already stored, is kept.
    """
    known = schema or existing_schema(spark, path) or EMPTY_SCHEMA
    spark.createDataFrame([], known).write.mode(write_mode(load_type)).parquet(path)


def raw_payloads(df: DataFrame, api_name: str) -> DataFrame:
    """Every record as (ingest_timestamp, api_name, raw_payload), built on the executors."""
    return df.select(
        F.current_timestamp().alias("ingest_timestamp"),
        F.lit(api_name).alias("api_name"),
        F.to_json(F.struct("*")).alias("raw_payload"),
    )


def append_raw(df: DataFrame, api_name: str, path: str) -> None:
    raw_payloads(df, api_name).write.mode("append").parquet(path)


def append_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str, path: str) -> None:
    """Append a handful of control rows."""
    spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(path)


def version_path(root: str, version: int) -> str:
    """The folder of one version."""
    return f"{root.rstrip('/')}/version={version:012d}"


def versions(spark: SparkSession, root: str) -> list[int]:
    """Completely written versions under ``root``, ascending."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(root)
    fs = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    found = fs.globStatus(hadoop.Path(f"{root.rstrip('/')}/version=*/_SUCCESS")) or []
    return sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in found)


def publish(
    df: DataFrame,
    root: str,
    version: int,
    rules: Mapping[str, str] | None = None,
    partition_by: Sequence[str] = (),
) -> str:
    """Write a table version to its own folder.

    The folder carries the batch number, so a replayed batch writes the same
    place again and no plan overwrites what it reads. With ``rules``, failures
    are counted during the write itself, and a version that breaks a rule never
    gets its completion mark, so it is never read.
    """
    path = version_path(root, version)
    if not rules:
        df.write.mode("overwrite").option("compression", COMPRESSION).partitionBy(*partition_by).parquet(path)
        return path
    spark = df.sparkSession
    observed, observation = observe_rules(df, rules)
    writer = observed.write.mode("overwrite").option("compression", COMPRESSION).partitionBy(*partition_by)
    writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
    raise_failures(observed_failures(observation, rules))
    hadoop = spark._jvm.org.apache.hadoop.fs
    mark = hadoop.Path(f"{path}/_SUCCESS")
    mark.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).create(mark, True).close()
    return path


def read_published(spark: SparkSession, root: str, before: int | None = None) -> DataFrame | None:
    """The newest complete version, or the newest one below ``before``; None if there is none."""
    ready = [v for v in versions(spark, root) if before is None or v < before]
    return spark.read.parquet(version_path(root, ready[-1])) if ready else None


def append_batch(df: DataFrame, root: str, batch: str) -> str:
    """Append ``df`` as the batch named ``batch``; the same batch again takes its own place, so nothing is appended twice.

    A batch counts once it is complete (see :func:`read_batches`).
    """
    if not batch or not all((c.isascii() and c.isalnum()) or c in "-_" for c in batch):
        raise ValueError(f"a batch name has letters, digits, - and _ only: {batch!r}")
    path = f"{root.rstrip('/')}/batch={batch}"
    df.write.mode("overwrite").parquet(path)
    return path


def append_raw_batch(df: DataFrame, api_name: str, root: str, batch: str) -> str:
    """:func:`append_raw` that survives being run again."""
    return append_batch(raw_payloads(df, api_name), root, batch)


def complete_batches(spark: SparkSession, root: str) -> list[str]:
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(root)
    fs = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    found = fs.globStatus(hadoop.Path(f"{root.rstrip('/')}/batch=*/_SUCCESS")) or []
    return sorted(s.getPath().getParent().getName().split("=", 1)[1] for s in found)


def read_batches(spark: SparkSession, root: str) -> DataFrame | None:
    """All complete batches with their names in ``batch``; None if there is none. What an unfinished write left is not read."""
    done = complete_batches(spark, root)
    if not done:
        return None
    paths = [f"{root.rstrip('/')}/batch={b}" for b in done]
    # A name of digits stays text.
    read = spark.read.option("mergeSchema", True).option("basePath", root).parquet(*paths)
    return read.withColumn("batch", F.regexp_extract(F.col("_metadata.file_path"), "batch=([^/]+)/", 1))


def load_batch(df: DataFrame, root: str, load_type: str | None, batch: str) -> None:
    """:func:`write_by_load_type` that survives being run again: FULL leaves this batch alone, anything else adds it.

    Batches that a full load replaces go after it is complete; until then readers see both or, before, the old ones.
    """
    spark = df.sparkSession
    append_batch(df, root, batch)
    if write_mode(load_type) == "overwrite":
        hadoop = spark._jvm.org.apache.hadoop.fs
        for other in complete_batches(spark, root):
            if other != batch:
                path = hadoop.Path(f"{root.rstrip('/')}/batch={other}")
                path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
