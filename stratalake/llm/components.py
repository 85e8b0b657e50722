"""Connected components by large and small stars, as joins and grouped minima.

Every step replaces links by links to smaller nodes of the same component, until
each component is a star around its smallest node. Only minima are grouped, and
they combine before the shuffle, so a node with very many links stays cheap. Each
round is written to the shared folder, which cuts the lineage. Nothing but a
count and a checksum per round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import materialize

_CHECK = 1 << 40


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of a node, and the node itself, get linked to the smallest node of its neighbourhood."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """``a`` > ``b`` in ``links``. A node and its smaller neighbours get linked to the smallest of these."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def _state(links: DataFrame) -> tuple[int, int]:
    row = links.agg(F.count("a").alias("n"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(_CHECK))).alias("s")).first()
    return row["n"], row["s"] or 0


def components(links: DataFrame) -> DataFrame:
    """node, root: for every node that ``links`` (a, b: whole numbers, never null) names, the smallest node of its component.

    Links of a node to itself and repeated links do no harm; without links the result is empty.
    """
    current = links.select(F.greatest("a", "b").cast("long").alias("a"), F.least("a", "b").cast("long").alias("b")).distinct()
    current = materialize(current.where("a <> b"), "links")
    before = _state(current)
    while before[0]:
        current = materialize(_small_star(_large_star(current)), "links")
        now = _state(current)
        if now == before:
            break
        before = now
    roots = current.select(F.col("b").alias("node")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots.select("node", F.col("node").alias("root")))
