"""Small helpers that several operators of this subpackage share."""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.session import discard, materialize

# A table of at most so many rows of a few numbers (tens of MB) may be broadcast.
BROADCAST_ROWS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, or a longer name if ``df`` has such a column already."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def sized(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``limit`` rows; beyond that the planner shuffles it."""
    return F.broadcast(df) if rows <= limit else df


def whole_number(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(0)).cast("long")


@contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """At most ``rows`` rows in a batch for Python, for the jobs that run inside.

    Rows of many kilobytes in batches of the usual count are hundreds of
    megabytes, held at once by the executor and its Python worker.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


@functools.cache
def _trim() -> Callable[[int], int]:
    """The C library's call that hands free pages back; nothing where it has none."""
    try:
        return ctypes.CDLL(None).malloc_trim
    except (OSError, AttributeError):
        return lambda pad: 0


def giving_back(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run``, which afterwards hands the memory it no longer uses back to the system.

    Python workers live on and serve later stages. What they keep of an earlier
    one's batches would count on top of what the next one needs.
    """

    def lean(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            _trim()(0)

    return lean


def map_texts(df: DataFrame, column: str, made: dict[str, str], of: Callable, chunk: int = 256) -> DataFrame:
    """``df`` with new columns ``made`` (name: type), which replace columns of those names.

    ``of()`` is called once per task and gives a function from a list of values
    (None for null) to one tuple of the new values for each. It sees at most
    ``chunk`` texts at a time. One pass; no row is moved.
    """
    keep = [f for f in df.schema.fields if f.name not in made]
    # Numbered names on the way through Python: any name may stand in the table.
    kept, new = [f"k{i}" for i in range(len(keep))], [f"m{i}" for i in range(len(made))]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        values = of()
        for batch in batches:
            for at in range(0, len(batch), chunk):
                part = batch.iloc[at : at + chunk]
                rows = values(part["text"].tolist())
                yield part[kept].assign(**{n: pd.Series([r[i] for r in rows], index=part.index, dtype=object) for i, n in enumerate(new)})

    schema = [f"{k} {f.dataType.simpleString()}" for k, f in zip(kept, keep)] + [f"{n} {t}" for n, t in zip(new, made.values())]
    picked = df.select(*[F.col(f"`{f.name}`").alias(k) for k, f in zip(kept, keep)], F.col(f"`{column}`").alias("text"))
    return picked.mapInPandas(giving_back(run), ", ".join(schema)).toDF(*[f.name for f in keep], *made)


__all__ = ["BROADCAST_ROWS", "arrow_rows", "discard", "free_name", "giving_back", "map_texts", "materialize", "sized", "table", "whole_number"]
