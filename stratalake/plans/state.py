"""Incremental-load state: checkpoints, effective watermarks and cursors, extracts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions import minutes_before, normalized, state_cursor, state_watermark
from stratalake.operators.latest import latest_records

# The checkpoint table.
CHECKPOINT_SCHEMA = "api_id STRING, state_type STRING, state_value STRING, recorded_at TIMESTAMP, run_id STRING"


def cursor_checkpoints(config: DataFrame, cursors: DataFrame, run_id: str | Column, recorded_at: Column) -> DataFrame:
    """Checkpoint rows for the cursors a run ended with.

    ``cursors`` has ``api_id`` and ``state_value``. Nothing is written for
    sources without an id, without state, or that do not page by cursor.
    """
    paged = config.filter(normalized("pagination_type", "NONE") == "CURSOR").select("api_id")
    run = F.lit(run_id) if isinstance(run_id, str) else run_id
    return (
        cursors.filter(F.col("state_value").isNotNull() & (F.col("api_id") != ""))
        .join(paged, "api_id", "left_semi")
        .select(
            "api_id",
            F.lit("CURSOR").alias("state_type"),
            F.col("state_value").cast("string").alias("state_value"),
            recorded_at.alias("recorded_at"),
            run.alias("run_id"),
        )
    )


def watermark_checkpoints(
    batch: DataFrame, source: str, incremental_column: str, run_id: str, recorded_at: Column
) -> DataFrame:
    """Checkpoint rows with the newest incremental value each source delivered."""
    newest = F.max(F.col(incremental_column).cast("timestamp"))
    return (
        batch.groupBy(F.col(source).cast("string").alias("api_id"))
        .agg(newest.alias("_newest"))
        .filter(F.col("_newest").isNotNull() & (F.col("api_id") != ""))
        .select(
            "api_id",
            F.lit("WATERMARK").alias("state_type"),
            F.date_format("_newest", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("state_value"),
            recorded_at.alias("recorded_at"),
            F.lit(run_id).alias("run_id"),
        )
    )


def latest_checkpoints(checkpoints: DataFrame) -> DataFrame:
    """The newest checkpoint of every source; equal times fall to the higher run id."""
    return latest_records(checkpoints, ["api_id"], ["recorded_at", "run_id"])


def effective_state(config: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Per source: the watermark and cursor its next extraction starts from.

    A full load has neither. A checkpoint decides alone: cursor state gives no
    watermark and does not fall back to the initial value. Without a checkpoint
    the watermark is the initial value. The overlap is taken off at the end.
    """
    latest = latest_checkpoints(checkpoints).select(
        F.col("api_id").alias("_api_id"), "state_type", "state_value"
    )
    joined = config.join(latest, F.col("api_id") == F.col("_api_id"), "left")
    incremental = F.upper(F.trim("load_type")) != "FULL"
    base = F.when(F.col("_api_id").isNotNull(), state_watermark("state_type", "state_value")).otherwise(
        F.to_timestamp("initial_load_value")
    )
    return joined.select(
        "api_id",
        "load_type",
        F.when(incremental, minutes_before(base, "overlap_minutes")).alias("watermark"),
        F.when(incremental, state_cursor("state_type", "state_value")).alias("cursor"),
    )


def incremental_extract(df: DataFrame, column: str, watermark: datetime | None) -> DataFrame:
    """Rows newer than a source's watermark; all rows without one.

    A constant, so the comparison reaches the scan and prunes partitions.
    """
    return df if watermark is None else df.filter(F.col(column) > F.lit(watermark))


def incremental_extract_all(
    df: DataFrame, source: str, column: str, state: DataFrame, complete: bool = False
) -> DataFrame:
    """The same for a table that holds many sources, each with its own watermark.

    Rows of a source that the state does not name are all kept. ``complete``
    declares that it names every source of the table. If each has a watermark,
    which one small job finds out, no row up to the smallest can be new, and
    comparing with that constant reaches the scan.
    """
    marks = state.select(F.col("api_id").alias("_api_id"), "watermark")
    if complete:
        least = marks.agg(F.min("watermark").alias("mark"), F.count_if(F.col("watermark").isNull()).alias("open")).first()
        if least["mark"] is not None and not least["open"]:
            df = df.filter(F.col(column) > F.lit(least["mark"]).cast(df.schema[column].dataType))
    joined = df.join(marks, F.col(source) == F.col("_api_id"), "left")
    fresh = F.col("watermark").isNull() | (F.col(column).cast("timestamp") > F.col("watermark"))
    return joined.filter(fresh).drop("_api_id", "watermark")
