"""Bronze tables from landed JSON files, with schema evolution between runs."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stratalake.operators.shape import TECHNICAL_COLUMNS, extract_records
from stratalake.sources.config import Route, bronze_routes
from stratalake.sources.landing import record_values
from stratalake.sources.rescue import RESCUED, typed_with_rescue
from stratalake.sources.schemas import SchemaStore, infer_schema


def with_lineage(df: DataFrame, api_id: str) -> DataFrame:
    """Add the source file, the source id and the load time to a file-based read."""
    return (
        df.withColumn("_source_file", F.col("_metadata.file_path"))
        .withColumn("_api_id", F.lit(api_id))
        .withColumn("ingestion_timestamp", F.current_timestamp())
    )


def fixed_schema_stream(
    spark: SparkSession, path: str, schema: T.StructType | str, multi_line: bool = True
) -> DataFrame:
    """Stream JSON files of a declared schema.

    ``multi_line`` reads a file as one document; JSON lines (False) can be
    split between tasks.
    """
    return spark.readStream.schema(schema).option("multiLine", multi_line).json(path)


def _records(lines: DataFrame, api_id: str) -> DataFrame:
    """Landed text rows to one record per row, with lineage."""
    return record_values(with_lineage(lines, api_id), "value", TECHNICAL_COLUMNS).drop("page_no", "record_no")


def json_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    api_id: str,
    record_path: str | None = None,
    whole_document: bool = True,
    source_options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Stream new landed files as typed rows with ``_rescued_data`` and lineage.

    With ``record_path`` the rows are the records inside the documents, without
    their siblings. What of a document could not be read, a broken or oversized
    one as a whole, is a row of its own with ``_rescued_data``. ``source_options`` go
    to the file source: ``maxFilesPerTrigger`` bounds a micro-batch, and
    ``cleanSource`` moves finished files away, which keeps listing a long-lived
    landing folder cheap.
    """
    reader = spark.readStream.options(**(source_options or {})).option("wholetext", whole_document)
    typed = typed_with_rescue(_records(reader.text(path), api_id), schema, raw="raw")
    if record_path:
        return extract_records(typed, record_path, rescued=RESCUED)
    ordered = [*schema.fieldNames(), "_rescued_data", *TECHNICAL_COLUMNS]
    return typed.select(*ordered)


def evolve_schema(
    spark: SparkSession,
    path: str,
    store: SchemaStore,
    whole_document: bool = True,
    sampling: float = 1.0,
    widen: bool = False,
) -> tuple[int, T.StructType]:
    """Look at the files that are new since the last run and merge their schema.

    A file that lands after this look is still safe: what the schema does not
    know is rescued.
    """
    # Files may get their time stamp some way before they become visible.
    until = (datetime.now(timezone.utc) - timedelta(minutes=5)).strftime("%Y-%m-%dT%H:%M:%S")
    reader = spark.read.option("wholetext", whole_document)
    since = store.seen_until()
    if since:
        reader = reader.option("modifiedAfter", since).option("timeZone", "UTC")
    seen = infer_schema(_records(reader.text(path), ""), "record", sampling)
    result = store.evolve(seen, widen)
    store.mark_seen(until)
    return result


def start_bronze(
    spark: SparkSession,
    landing: str,
    table: str,
    state: str,
    api_id: str,
    record_path: str | None = None,
    whole_document: bool = True,
    sampling: float = 1.0,
    source_options: Mapping[str, str] | None = None,
    by_day: bool = False,
    widen: bool = False,
) -> tuple[StreamingQuery, T.StructType]:
    """Start one triggered run that appends everything new to a Bronze table.

    Returns the running query and the table's schema from now on. ``state``
    holds the schema versions and the stream checkpoint. The file sink makes
    the append exactly-once. ``by_day`` partitions the table by
    ``ingestion_date``, so that readers of recent loads skip the rest. ``widen``
    lets a column's type grow when new files ask for it (see ``merge_schemas``).
    """
    _, schema = evolve_schema(spark, landing, SchemaStore(spark, f"{state}/schema"), whole_document, sampling, widen)
    rows = json_stream(spark, landing, schema, api_id, record_path, whole_document, source_options)
    days = ["ingestion_date"] if by_day else []
    if by_day:
        rows = rows.withColumn("ingestion_date", F.to_date("ingestion_timestamp"))
    query = (
        rows.writeStream.format("parquet")
        .partitionBy(*days)
        .outputMode("append")
        .option("path", table)
        .option("checkpointLocation", f"{state}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    return query, rows.schema


def run_bronze(spark: SparkSession, landing: str, table: str, state: str, api_id: str, **options) -> DataFrame:
    """Ingest everything new and return the Bronze table."""
    query, schema = start_bronze(spark, landing, table, state, api_id, **options)
    query.awaitTermination()
    return read_bronze(spark, table, schema)


def read_bronze(spark: SparkSession, table: str, schema: T.StructType | None = None) -> DataFrame:
    """A Bronze table with the columns of all its schema versions.

    Files older than a column read as NULL there. Without a schema all file
    footers have to be read to find the columns.
    """
    if schema is None:
        return spark.read.option("mergeSchema", True).parquet(table)
    return spark.read.schema(schema).parquet(table)


def bronze_tables(
    spark: SparkSession,
    config: DataFrame,
    landing_root: str,
    table_root: str,
    at_once: int = 8,
    **options,
) -> dict[str, DataFrame]:
    """One Bronze table per enabled source, keyed by source id.

    Sources run side by side, ``at_once`` at a time; all are waited for before
    the first error is raised, so one bad source does not stop the others.
    """
    routes = bronze_routes(config)

    def ingest(route: Route) -> DataFrame:
        return run_bronze(
            spark,
            f"{landing_root}/{route.api_id}",
            table_path(table_root, route),
            f"{table_root}/_state/{route.api_id}",
            route.api_id,
            record_path=route.record_path,
            **options,
        )

    # The threads only start and watch Spark jobs.
    with ThreadPoolExecutor(at_once) as pool:
        runs = {route.api_id: pool.submit(ingest, route) for route in routes}
    for run in runs.values():
        if run.exception():
            raise run.exception()
    return {api_id: run.result() for api_id, run in runs.items()}


def table_path(table_root: str, route: Route) -> str:
    return f"{table_root}/{route.catalog}/{route.schema}/{route.table}"
