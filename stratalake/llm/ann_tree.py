"""Approximate nearest neighbours by cosine: a hierarchical k-means tree, searched best bin first.

The tree is fitted on a bounded sample (``SAMPLE_ROWS`` for each 256 leaves, by hash)
and sorts every vector into one of its leaves, whose number grows with the square root
of the rows, from 256 to 4,096 (``levels_for``). A query visits leaves in the order
in which a priority queue over the nodes yields them, nearest centre first. How
many it visits is calibrated: for ``CALIBRATION`` queries the true neighbours among
all rows are computed in one pass, and visits are widened until the share of them
whose leaf was visited reaches the target. This is done apart for queries in crowded
leaves and for those in sparse ones, as clusters of copies need far fewer visits than
what lies between them. However few its visits, a query goes on until the leaves hold
as many others as are wanted.

Leaves and the queries that visit them meet in blocks of bounded size, so a leaf
that holds a third of all rows is many groups. Scores are cosines of the original
vectors in double precision.

Vectors of different lengths never meet. The most common length has a tree, and so has
every length of more than ``SAMPLE_ROWS`` vectors; all others are compared exactly
within their length, which are few rows each.

Defined results: vectors that are null, zero or hold null or non-finite components
take no part, nor do rows without an id; of equal scores the smaller id is nearer; rows that share a query's id are its own
row; with fewer candidates than wanted all are returned; an empty table gives an
empty result.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.common import materialize, sized
from stratalake.llm.vector_dedup import scaled, usable

SAMPLE_ROWS = 8_192
BRANCHES, LEVELS, MOST_LEVELS = 4, 4, 6
#: Rows up to which ``LEVELS`` do; 16 times as many get a level more, which is four times the leaves.
ROWS_OF_LEVELS = 1 << 16
CALIBRATION = 128
TARGET_RECALL = 0.95
ROW_BLOCK, QUERY_BLOCK = 2_048, 1_024
_TIE = 1e-12


def unit(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def stacked(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    """Centres of spherical k-means; fewer than ``k`` where the vectors are too few or too alike."""
    centres = x[[int(rng.integers(len(x)))]]
    while len(centres) < k:
        far = 1 - (x @ centres.T).max(axis=1)
        if far.max() <= 1e-9:
            break
        centres = np.vstack([centres, x[int(far.argmax())]])
    for _ in range(rounds):
        own = (x @ centres.T).argmax(axis=1)
        sums = np.stack([x[own == c].sum(axis=0) if (own == c).any() else centres[c] for c in range(len(centres))])
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 0, sums / np.where(norms > 0, norms, 1), centres)
    return centres


class Tree:
    """centres: one per node. children: nodes below a node. leaf_of: leaf number of a node, or -1."""

    def __init__(self, x: np.ndarray, branches: int = BRANCHES, levels: int = LEVELS, seed: int = 5):
        rng = np.random.default_rng(seed)
        centres, self.children, self.leaf_of, self.leaves = [x.mean(axis=0)], [[]], [-1], 0
        todo = [(0, x, 0)]
        while todo:
            node, members, level = todo.pop(0)
            below = _kmeans(members, branches, rng) if level < levels and len(members) > branches else np.zeros((0, x.shape[1]))
            if len(below) < 2:
                self.leaf_of[node], self.leaves = self.leaves, self.leaves + 1
                continue
            own = (members @ below.T).argmax(axis=1)
            for c, centre in enumerate(below):
                centres.append(centre)
                self.children.append([])
                self.leaf_of.append(-1)
                self.children[node].append(len(centres) - 1)
                todo.append((len(centres) - 1, members[own == c], level + 1))
        self.centres = np.stack(centres)

    def leaf(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row, down the nearest centres."""
        out = np.zeros(len(x), dtype=np.int32)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if not len(rows):
                continue
            if self.leaf_of[node] >= 0:
                out[rows] = self.leaf_of[node]
                continue
            below = self.children[node]
            own = (x[rows] @ self.centres[below].T).argmax(axis=1)
            todo += [(child, rows[own == c]) for c, child in enumerate(below)]
        return out

    def visits(self, q: np.ndarray, most: int, held: np.ndarray | None = None, least: int = 0) -> list[int]:
        """The first ``most`` leaves of a best-bin-first traversal, and more until they hold ``least`` rows by ``held``."""
        near = self.centres @ q
        queue, out, rows = [(0.0, 0)], [], 0
        while queue and (len(out) < most or rows < least):
            _, node = heapq.heappop(queue)
            if self.leaf_of[node] >= 0:
                out.append(self.leaf_of[node])
                rows += int(held[out[-1]]) if held is not None else 0
            for child in self.children[node]:
                heapq.heappush(queue, (-float(near[child]), child))
        return out


def vectors_of(df: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """id, v: the rows that take part."""
    rows = df.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{vector_column}`").cast("array<double>").alias("v"))
    return rows.where(F.col("id").isNotNull() & usable("v"))


def lengths_of(rows: DataFrame) -> list[int]:
    """The most common length, then all others of more than ``SAMPLE_ROWS`` vectors, which bounds their number."""
    counts = rows.groupBy(F.size("v").alias("n")).agg(F.count("id").alias("c")).orderBy(F.desc("c"), "n")
    most = [r["n"] for r in counts.limit(1).collect()]
    return most + [r["n"] for r in counts.where(F.col("c") > SAMPLE_ROWS).collect() if r["n"] not in most]


def levels_for(count: int) -> int:
    """Levels of the tree of ``count`` rows."""
    level = LEVELS
    while level < MOST_LEVELS and count > ROWS_OF_LEVELS * 16 ** (level - LEVELS):
        level += 1
    return level


def hash_sample(rows: DataFrame, count: int, wanted: int, salt: int) -> DataFrame:
    """About ``wanted`` of ``count`` rows (id, v, ...), those of the lowest hashes; equal rows count once, and twice ``wanted`` is the most."""
    span = 1 << 30
    of = F.pmod(F.xxhash64("id", "v", F.lit(salt)), F.lit(span))
    low = rows.where(of < F.lit(int(min(1.0, wanted / max(count, 1)) * span))).dropDuplicates(["id", "v"])
    return low.orderBy(of, "id").limit(2 * wanted)


def _top(scores: np.ndarray, ids: np.ndarray, q: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, scores) of the ``k`` nearest of one query by ``scores``, exact about order and ties.

    All within rounding of the k-th are scored again, each the same way wherever it stands, and ordered.
    """
    if len(scores) > k:
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= kth - _TIE)
    else:
        at = np.arange(len(scores))
    exact = (x[at] * q).sum(axis=1) / np.sqrt((x[at] * x[at]).sum(axis=1) * (q * q).sum())
    order = np.lexsort((ids[at], -exact))[:k]
    return at[order], exact[order]


def _nearest(queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    qid, rid = queries["id"].to_numpy(), rows["id"].to_numpy()
    q, x = scaled(stacked(queries["v"])), scaled(stacked(rows["v"]))
    scores = unit(q) @ unit(x).T
    out = []
    for i in range(len(qid)):
        others = np.flatnonzero(rid != qid[i])
        at, exact = _top(scores[i][others], rid[others], q[i], x[others], k)
        out += [(int(qid[i]), int(rid[others[p]]), float(s)) for p, s in zip(at, exact)]
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})


def _best(found: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: the first ``k`` of each query."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    distinct = found.dropDuplicates(["query_id", "vec_id"])
    return distinct.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def brute_force(rows: DataFrame, queries: pd.DataFrame, k: int) -> DataFrame:
    """The true neighbours of a bounded set of queries (id, v) among all ``rows``: one pass, ``k`` rows per query and batch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield _nearest(queries, batch, k)

    return _best(rows.mapInPandas(run, "query_id bigint, vec_id bigint, score double"), k)


class Index:
    """A tree and the table of all rows of one length with their leaves; of the most common one if none is given."""

    def __init__(self, df: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", length: int | None = None):
        rows = vectors_of(df, id_column, vector_column)
        length = length if length is not None else next(iter(lengths_of(rows)), 0)
        rows = rows.where(F.size("v") == length)
        self.count = rows.count()
        levels = levels_for(self.count)
        wanted = SAMPLE_ROWS * BRANCHES ** (levels - LEVELS)
        sample = hash_sample(rows, self.count, wanted, 1).toPandas() if self.count else pd.DataFrame({"v": []})
        if not len(sample) and self.count:
            sample = rows.limit(1).toPandas()
        self.tree = tree = Tree(unit(stacked(sample["v"])), levels=levels) if len(sample) else None

        def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if len(batch):
                    yield batch.assign(leaf=tree.leaf(unit(stacked(batch["v"]))))

        schema = "id bigint, v array<double>, leaf int"
        self.rows = materialize(rows.mapInPandas(place, schema), "ann-rows") if tree else rows.withColumn("leaf", F.lit(0))

    def held(self) -> np.ndarray:
        """Ids in each leaf; one that stands in several counts in the first of them only. Bounded by the tree."""
        out = np.zeros(self.tree.leaves, dtype=np.int64)
        homes = self.rows.groupBy("id").agg(F.min("leaf").alias("leaf")).groupBy("leaf").agg(F.count("id").alias("n"))
        for r in homes.collect():
            out[r["leaf"]] = r["n"]
        return out

    def calibrate(self, queries: DataFrame, k: int, crowded: np.ndarray, target: float = TARGET_RECALL, most: int = CALIBRATION) -> tuple[int, int]:
        """How many leaves to visit from a sparse and from a crowded leaf, so that the share ``target`` of the true neighbours
        of ``most`` queries of either kind lies in them. ``crowded``: whether a leaf is."""
        tree = self.tree

        def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if len(batch):
                    yield batch.assign(kind=crowded[tree.leaf(unit(stacked(batch["v"])))])

        placed = materialize(queries.select("id", "v").mapInPandas(place, "id bigint, v array<double>, kind int"), "ann-asked")
        counts = {r["kind"]: r["n"] for r in placed.groupBy("kind").agg(F.count("id").alias("n")).collect()}
        parts = [hash_sample(placed.where(F.col("kind") == c), n, most, 2).toPandas() for c, n in sorted(counts.items())]
        picked = pd.concat(parts).drop_duplicates("id").sort_values("id") if parts else pd.DataFrame({"id": []})
        if not len(picked):
            return tree.leaves, tree.leaves
        true = brute_force(self.rows.select("id", "v"), picked[["id", "v"]], k)
        leaf = self.rows.select(F.col("id").alias("vec_id"), "leaf")
        found = true.join(leaf, "vec_id").select("query_id", "leaf").collect()
        order = {
            i: {leaf: p for p, leaf in enumerate(tree.visits(q, tree.leaves), 1)}
            for i, q in zip(picked["id"].tolist(), unit(stacked(picked["v"])))
        }
        kinds = dict(zip(picked["id"].tolist(), picked["kind"].tolist()))
        out = []
        for kind in (0, 1):
            needed = sorted(order[r["query_id"]][r["leaf"]] for r in found if kinds[r["query_id"]] == kind)
            out.append(needed[max(0, math.ceil(target * len(needed)) - 1)] if needed else tree.leaves)
        return out[0], out[1]

    def crowded(self, held: np.ndarray) -> np.ndarray:
        """1 for each leaf that holds more than the mean of ``held``, else 0."""
        return (held > held.mean()).astype(np.int32)

    def search(self, queries: DataFrame, k: int = 5, visits: int | tuple[int, int] | None = None) -> DataFrame:
        """query_id, rank, vec_id, score. ``queries``: id, v, as vectors_of gives them.

        ``visits``, one number or one each for sparse and crowded leaves, is calibrated on these queries if not given.
        However few the visits, more follow until ``k`` others are met or no leaf is left.
        """
        schema = "query_id bigint, vec_id bigint, score double"
        tree = self.tree
        if tree is None:
            return _best(queries.sparkSession.createDataFrame([], schema), k)
        held = self.held()
        crowded = self.crowded(held)
        if visits is None:
            visits = self.calibrate(queries, k, crowded)
        most = visits if isinstance(visits, tuple) else (visits, visits)

        def plan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if len(batch):
                    x = unit(stacked(batch["v"]))
                    # Its own id may be among the rows a query meets.
                    yield batch.assign(leaves=[tree.visits(q, most[c], held, k + 1) for q, c in zip(x, crowded[tree.leaf(x)])])

        planned = queries.select("id", "v").dropDuplicates(["id"]).mapInPandas(plan, "id bigint, v array<double>, leaves array<int>")
        planned = materialize(planned, "ann-queries").withColumn("leaf", F.explode("leaves")).drop("leaves")
        return _in_blocks(self.rows, planned, k)


def _in_blocks(rows: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of what meets: ``rows`` and ``asked`` (leaf, id, v) of equal leaf, in blocks of bounded size."""
    counted = ((rows, ROW_BLOCK, "blocks"), (asked, QUERY_BLOCK, "q_blocks"))
    sides = [x.groupBy("leaf").agg(F.ceil(F.count("id") / F.lit(size)).cast("int").alias(name)) for x, size, name in counted]
    blocks = materialize(sides[0].join(sides[1], "leaf"), "ann-blocks")
    blocks = sized(blocks, blocks.count())

    def dealt(side: DataFrame, own: str, other: str) -> DataFrame:
        of = F.pmod(F.xxhash64("id", F.lit(3)), F.col(own)).cast("int").alias("own")
        every = F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias("other")
        # Both sides may come from one table: new columns tell them apart.
        own_columns = [F.col(c).alias(c) for c in ("leaf", "id", "v")]
        return side.join(blocks, "leaf").select(*own_columns, of, every)

    left = dealt(rows, "blocks", "q_blocks").withColumnsRenamed({"own": "block", "other": "q_block"})
    right = dealt(asked, "q_blocks", "blocks").withColumnsRenamed({"own": "q_block", "other": "block"})

    def meet(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(asked):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        return _nearest(asked, rows, k)

    keys = ["leaf", "block", "q_block"]
    schema = "query_id bigint, vec_id bigint, score double"
    return _best(left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(meet, schema), k)


def nearest(
    df: DataFrame, is_query: Column, k: int = 5, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest rows that were found for each row on whose ``id`` ``is_query`` holds."""
    rows = vectors_of(df, id_column, vector_column)
    lengths = lengths_of(rows)
    found = []
    for length in lengths or [0]:
        index = Index(df, id_column, vector_column, length)
        found.append(index.search(index.rows.where(is_query).select("id", "v"), k))
    others = rows.where(~F.size("v").isin(lengths or [0])).select(F.size("v").alias("leaf"), "id", "v")
    if not others.isEmpty():
        found.append(_in_blocks(others, others.where(is_query).dropDuplicates(["leaf", "id"]), k))
    if len(found) == 1:
        return found[0]
    return _best(reduce(DataFrame.unionByName, [f.drop("rank") for f in found]), k)
