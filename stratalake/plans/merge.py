"""Merges of catalog tables by name.

A table is a view over the newest of its published versions. A merge writes the
next version and then replaces the view, which the catalog does at once: readers see
the table before or after, and a run that ends in between leaves the table before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.operators.changes import run_merge
from stratalake.session import materialize
from stratalake.sources.sinks import publish, version_path, versions


def _quoted(name: str) -> str:
    parts = name.split(".")
    if not all(p and all(c.isalnum() or c == "_" for c in p) for p in parts) or len(parts) > 3:
        raise ValueError(f"not a table name: {name!r}")
    return ".".join(f"`{p}`" for p in parts)


def publish_table(df: DataFrame, name: str, root: str, version: int | None = None) -> int:
    """Write ``df`` as the next version under ``root`` and let the catalog's ``name`` be it."""
    spark = df.sparkSession
    version = version if version is not None else max([0, *versions(spark, root)]) + 1
    publish(df, root, version)
    path = version_path(root, version).replace("`", "``")
    spark.sql(f"CREATE OR REPLACE VIEW {_quoted(name)} AS SELECT * FROM parquet.`{path}`")
    return version


def merge_catalog_tables(
    spark: SparkSession,
    source: str,
    target: str,
    root: str,
    strategy: str = "TYPE1",
    keys: Sequence[str] = ("business_key",),
    hash_column: str = "record_hash",
) -> DataFrame:
    """Merge the table named ``source`` into the one named ``target``, kept under ``root``; the merge's row metrics.

    A target that isn't there is made of an empty one, so all rows are new.
    """
    incoming = spark.table(source)
    if spark.catalog.tableExists(target):
        known = spark.table(target)
    else:
        known = incoming.limit(0)
        if strategy.strip().upper() == "TYPE2":
            since = incoming.schema["effective_from"].dataType
            known = known.withColumns({"effective_to": F.lit(None).cast(since), "is_current": F.lit(True)})
    merged, metrics = run_merge(incoming, known, strategy, keys, hash_column)
    # The metrics describe the target before it is replaced.
    metrics = materialize(metrics, "merge-metrics")
    publish_table(merged, target, root)
    return metrics
