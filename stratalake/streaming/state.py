"""Keyed state kept up to date by micro-batches: latest records and type 2 history."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from threading import Event

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stratalake.operators.history import END, scd2_from_snapshot
from stratalake.operators.latest import ARRIVAL_ORDER, latest_records
from stratalake.sources.sinks import append_rows, publish, version_path, versions


_ASSIGNED = "query_id STRING, batch_id BIGINT, version BIGINT"


def _version_of(spark: SparkSession, root: str, query_id: str, batch_id: int) -> int | None:
    """The version that a batch writes; None if it is done and others came after it.

    Batch numbers begin again with every new checkpoint, versions never do. So
    each batch of each query gets the next version, which is noted before it is
    written; a replay finds its note.
    """
    path = f"{root.rstrip('/')}/_assigned"
    try:
        rows = spark.read.schema(_ASSIGNED).parquet(path)
        mine = rows.filter((F.col("query_id") == query_id) & (F.col("batch_id") == batch_id)).agg(F.max("version")).first()[0]
        last = rows.agg(F.max("version")).first()[0] or 0
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        mine, last = None, 0
    done = versions(spark, root)
    newest = max([last, *done[-1:]])
    if mine is None:
        append_rows(spark, [(query_id, batch_id, newest + 1)], _ASSIGNED, path)
        return newest + 1
    return None if mine in done and mine < newest else mine


def _each_batch(stream: DataFrame, root: str, checkpoint: str, step: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Run ``step`` with every micro-batch and the version it writes under ``root``."""
    known, started = {}, Event()

    def run(batch: DataFrame, batch_id: int) -> None:
        started.wait()
        version = _version_of(batch.sparkSession, root, known["id"], batch_id)
        if version is not None:
            step(batch, version)

    query = (
        stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    # The id is part of the checkpoint: a new checkpoint is a new query.
    known["id"] = str(query.id)
    started.set()
    return query


def _stored(spark: SparkSession, root: str, newest: int) -> DataFrame:
    """All versions, with the columns of the newest, which has every column that the ones before had."""
    columns = spark.read.parquet(version_path(root, newest)).schema.fields
    schema = T.StructType([f for f in columns if f.name not in ("version", "_open")])
    partitions = [T.StructField("_open", T.IntegerType()), T.StructField("version", T.LongType())]
    return spark.read.schema(T.StructType([*schema.fields, *partitions])).parquet(root)


def latest_stream(
    stream: DataFrame,
    keys: Sequence[str],
    state: str,
    checkpoint: str,
    order: Sequence[str] = ARRIVAL_ORDER,
) -> StreamingQuery:
    """Keep the latest record per key without ranking all of Bronze again.

    A micro-batch is reduced to its own latest records, which are written as a
    version of their own: the cost follows the batch, not the state, and a replay
    rewrites the same folder. "Latest" is associative, so the latest of these
    parts is the latest of everything. A new checkpoint goes on after the
    versions that are there.
    """

    def step(batch: DataFrame, version: int) -> None:
        publish(latest_records(batch, keys, order), state, version)

    return _each_batch(stream, state, checkpoint, step)


def _merged_ranges(spark: SparkSession, state: str) -> set[tuple[int, int]]:
    """(first, last) of the ranges of versions that were merged into one part, complete ones only."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(state).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    found = fs.globStatus(hadoop.Path(f"{state.rstrip('/')}/_merged/*-*/_SUCCESS")) or []
    return {tuple(map(int, s.getPath().getParent().getName().split("-"))) for s in found}


def _range_path(state: str, first: int, last: int) -> str:
    return f"{state.rstrip('/')}/_merged/{first:012d}-{last:012d}"


def _cover(state: str, done: Sequence[int], ranges: set[tuple[int, int]]) -> list[str]:
    """Folders that hold each complete version once: the longest merged range from each version on, else the version itself."""
    longest: dict[int, int] = {}
    for first, last in ranges:
        longest[first] = max(last, longest.get(first, 0))
    paths, reached = [], 0
    for v in done:
        if v <= reached:
            continue
        reached = longest.get(v, v)
        paths.append(_range_path(state, v, reached) if reached > v else version_path(state, v))
    return paths


def merge_parts(
    spark: SparkSession, state: str, keys: Sequence[str], order: Sequence[str] = ARRIVAL_ORDER, fan_in: int = 8
) -> int:
    """Merge runs of ``fan_in`` parts of one size into one of the next; the number of merges.

    Ranges are aligned to powers of ``fan_in``, and only those of which every
    version is complete are merged, so a version that is finished later is never lost.
    After it a reader opens at most ``fan_in`` - 1 parts of each size: their number grows
    with the logarithm of the batches. Every row is merged once for each size. A merge that was cut
    short has no mark and is written again.
    """
    if fan_in < 2:
        raise ValueError("fan_in must be 2 or more")
    done, merged, size = set(versions(spark, state)), 0, fan_in
    ranges = _merged_ranges(spark, state)
    while done and size <= max(done):
        for first in range(1, max(done) - size + 2, size):
            span = (first, first + size - 1)
            whole = range(first, first + size)
            if span in ranges or not all(v in done for v in whole):
                continue
            parts = spark.read.option("mergeSchema", True).parquet(*_cover(state, whole, {r for r in ranges if first <= r[0] and r[1] <= span[1]}))
            latest_records(parts, keys, order).write.mode("overwrite").parquet(_range_path(state, *span))
            ranges.add(span)
            merged += 1
        size *= fan_in
    return merged


def read_latest(
    spark: SparkSession, state: str, keys: Sequence[str], order: Sequence[str] = ARRIVAL_ORDER
) -> DataFrame:
    """The latest record per key over all complete batches so far, merged parts in place of their batches."""
    done = versions(spark, state)
    if not done:
        raise LookupError(f"no complete batch under {state}")
    parts = spark.read.option("mergeSchema", True).parquet(*_cover(state, done, _merged_ranges(spark, state)))
    return latest_records(parts, keys, order)


def compact_latest(
    spark: SparkSession, state: str, target: str, keys: Sequence[str], order: Sequence[str] = ARRIVAL_ORDER
) -> None:
    """Write the current latest records as the single part of a new state folder."""
    publish(read_latest(spark, state, keys, order), target, versions(spark, state)[-1])


def fold_snapshot(
    spark: SparkSession,
    root: str,
    version: int,
    snapshot: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    effective: str = "ingestion_timestamp",
    small_incoming: bool = False,
) -> None:
    """Fold one snapshot into a stored history as version ``version``.

    A version holds the open rows (one per key) and the rows it closed. Only
    the previous version's open rows are read, with all its columns; closed rows
    are written once and never touched again. A replay of the newest version
    starts from the same previous one and writes the same result to the same
    folder; a version below the newest is refused.
    """
    done = versions(spark, root)
    if done and version < done[-1]:
        raise ValueError(f"version {version} is below the newest one, {done[-1]}")
    done = [v for v in done if v < version]
    previous = None
    if done:
        rows = spark.read.parquet(version_path(root, done[-1]))
        previous = rows.filter(F.col("_open") == 1).drop("version", "_open")
    current = scd2_from_snapshot(
        previous, snapshot, keys, tracked, effective, small_incoming=small_incoming and previous is not None
    )
    publish(current.withColumn("_open", F.col(END).isNull().cast("int")), root, version, partition_by=["_open"])


def scd2_stream(
    stream: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    root: str,
    checkpoint: str,
    order: Sequence[str] = ARRIVAL_ORDER,
    effective: str = "ingestion_timestamp",
    small_batches: bool = False,
) -> StreamingQuery:
    """Type 2 history fed by a stream; every micro-batch is a snapshot.

    ``small_batches`` says that a batch holds few of the keys (see ``apply_versions``).
    """

    def step(batch: DataFrame, version: int) -> None:
        snapshot = latest_records(batch, keys, order)
        fold_snapshot(batch.sparkSession, root, version, snapshot, keys, tracked, effective, small_batches)

    return _each_batch(stream, root, checkpoint, step)


def read_history(spark: SparkSession, root: str) -> DataFrame:
    """All closed rows, and the open rows of the newest complete version."""
    done = versions(spark, root)
    if not done:
        raise LookupError(f"no complete version under {root}")
    rows = _stored(spark, root, done[-1])
    # A version that was never finished may lie between complete ones; what it closed, the next one closed, too.
    wanted = ((F.col("_open") == 0) & F.col("version").isin(done)) | (F.col("version") == done[-1])
    return rows.filter(wanted).drop("version", "_open")
