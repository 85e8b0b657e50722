"""Tables in hash buckets of their keys, so that a batch rewrites only the buckets it touches.

``root/data/version=N`` holds the buckets that version N rewrote, and
``root/manifest/version=N`` says for every bucket which version holds it now. A
version counts once its manifest is complete; until then readers see the one
before, and a repeated attempt writes the same folders again. A batch whose name
is in a complete manifest has been applied and is not applied again.

A manifest has one row per bucket, so what the driver sees is bounded by the
number of buckets, which the first batch fixes.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.operators.changes import scd1_upsert
from stratalake.operators.observations import last_observations, of_keys, versions_of
from stratalake.session import materialize
from stratalake.sources.sinks import publish, version_path, versions

BUCKETS = 256
_BUCKET = "_bucket"
_MANIFEST = "bucket int, data_version bigint, buckets int, batch string"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`").cast("string") for k in keys]), F.lit(buckets)).cast("int")


def manifest(spark: SparkSession, root: str) -> tuple[int, dict[int, int], int | None]:
    """(newest complete version, the version that holds each bucket, number of buckets). Version 0 is the empty table."""
    done = versions(spark, f"{root}/manifest")
    if not done:
        return 0, {}, None
    rows = spark.read.schema(_MANIFEST).parquet(version_path(f"{root}/manifest", done[-1])).collect()
    return done[-1], {r["bucket"]: r["data_version"] for r in rows if r["bucket"] is not None}, rows[0]["buckets"] if rows else None


def applied(spark: SparkSession, root: str, batch: str) -> bool:
    done = versions(spark, f"{root}/manifest")
    if not done:
        return False
    known = spark.read.schema(f"{_MANIFEST}, version bigint").parquet(f"{root}/manifest")
    return not known.filter(F.col("version").isin(done) & (F.col("batch") == batch)).limit(1).isEmpty()


def read_buckets(spark: SparkSession, root: str, only: Sequence[int] | None = None) -> DataFrame | None:
    """The table, or some of its buckets; None if nothing was ever written to them."""
    _, where, _ = manifest(spark, root)
    paths = [f"{version_path(f'{root}/data', v)}/{_BUCKET}={b}" for b, v in sorted(where.items()) if only is None or b in only]
    return spark.read.option("mergeSchema", True).option("basePath", f"{root}/data").parquet(*paths).drop("version", _BUCKET) if paths else None


def rewrite_buckets(
    batch_rows: DataFrame,
    root: str,
    keys: Sequence[str],
    batch: str,
    step: Callable[[DataFrame | None, DataFrame], DataFrame],
    buckets: int = BUCKETS,
    written: bool = False,
) -> int:
    """Apply ``step(stored rows of the touched buckets, batch rows)``, whose result takes these buckets' place; how many they are.

    The batch is written once, so that what decides which buckets are touched is what gets applied; ``written``: it is already.
    """
    spark = batch_rows.sparkSession
    if applied(spark, root, batch):
        return 0
    version, where, fixed = manifest(spark, root)
    buckets = fixed or buckets
    rows = batch_rows if written else materialize(batch_rows, "bucket-batch")
    touched = sorted(r[0] for r in rows.select(bucket_of(keys, buckets)).distinct().collect())
    if not touched:
        return 0
    content = step(read_buckets(spark, root, touched), rows).withColumn(_BUCKET, bucket_of(keys, buckets))
    # Small buckets share a task, and a bucket that is large is written by several.
    publish(content.hint("rebalance", _BUCKET), f"{root}/data", version + 1, partition_by=[_BUCKET])
    held = {r[0] for r in spark.read.parquet(version_path(f"{root}/data", version + 1)).select(_BUCKET).distinct().collect()}
    where = {b: v for b, v in where.items() if b not in touched} | {b: version + 1 for b in held}
    entries = [(b, v, buckets, batch) for b, v in sorted(where.items())] or [(None, None, buckets, batch)]
    publish(spark.createDataFrame(entries, _MANIFEST).coalesce(1), f"{root}/manifest", version + 1)
    return len(touched)


def upsert_buckets(source: DataFrame, root: str, keys: Sequence[str], batch: str, buckets: int = BUCKETS) -> int:
    """Type 1 upsert of ``source``, one row per key, into the table under ``root``."""

    def step(stored: DataFrame | None, rows: DataFrame) -> DataFrame:
        return rows if stored is None else scd1_upsert(stored, rows, keys)

    return rewrite_buckets(source, root, keys, batch, step, buckets)


def late_history_buckets(
    rows: DataFrame, root: str, keys: Sequence[str], tracked: Sequence[str], sequence: Sequence[str], batch: str, buckets: int = BUCKETS
) -> int:
    """Type 2 history under ``root`` out of batches in any order (see :func:`apply_late`).

    Observations and versions are two tables of equal buckets. Versions go second,
    from the observations as they then are, so a run that ended between the two is made good by its replay.
    """

    spark, observed = rows.sparkSession, f"{root}/observations"
    if applied(spark, observed, batch) and applied(spark, f"{root}/versions", batch):
        return 0
    rows = materialize(rows, "bucket-batch")

    def observe(stored: DataFrame | None, new: DataFrame) -> DataFrame:
        # The touched buckets are written whole, so that rows of other keys need not be told apart: the last of one is itself.
        return last_observations(new if stored is None else stored.unionByName(new, allowMissingColumns=True), keys, sequence)

    rewrite_buckets(rows, observed, keys, batch, observe, buckets, written=True)
    _, _, fixed = manifest(spark, observed)

    def version(stored: DataFrame | None, new: DataFrame) -> DataFrame:
        touched = sorted(r[0] for r in new.select(bucket_of(keys, fixed)).distinct().collect())
        known = read_buckets(spark, observed, touched)
        # The batch is among what was observed: nothing is merged again.
        renewed = versions_of(of_keys(known, new, keys, "left_semi"), keys, tracked, sequence)
        return renewed if stored is None else of_keys(stored, new, keys, "left_anti").unionByName(renewed, allowMissingColumns=True)

    return rewrite_buckets(rows, f"{root}/versions", keys, batch, version, fixed or buckets, written=True)
