"""Hard negatives by angular triangle filtering: rows of another label that score high, but clearly below a positive.

Vectors become whole numbers, and a score is their inner product. Every row
stores its norm and its angles to a few reference directions. The angles of two
rows to one direction bound the angle between the rows from both sides, and so,
times the norms, their score. Only where such an interval meets what is still
wanted is the product computed, in whole numbers.

Rows are sorted by their nearest reference and the angle to it, numbered, and cut
into blocks; anchors are cut alike. Three levels are filtered by the same bound:
blocks of anchors against blocks of rows, before any vector moves; anchors against
runs of rows, within a task; anchors against rows. What is wanted is known early: each anchor first
meets its own block, and the k-th best found there is the least that other blocks
have to offer. A block pair is one bounded task and returns at most k rows for an
anchor and window, so no label, copy or direction is too frequent.

For an anchor and a positive the window of scores lies between ``low`` and ``high``
hundredths of the positive's score.

Defined results: rows whose label or vector is null, or whose vector holds a null or
non-finite component, take no part; zero and empty vectors do, with scores of 0.
Vectors of different lengths never meet. Ties go to the smaller id, a null id last,
then repeat in any order; rows that share an id are rows of their own. Components
beyond 2**53 in size count as 2**53, scores beyond 64 bits as the limit. A positive
with a negative score has no window, so no negatives. An anchor without another row
of its label has no positives. An empty table gives an empty result. Other columns
play no part, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.common import materialize
from stratalake.operators.numbering import global_row_number

POSITIVES, NEGATIVES = 5, 10
#: The window of a negative's score, in hundredths of the positive's.
LOW, HIGH = 30, 90
REFERENCES = 16
#: References are fitted to so many rows, those of the lowest hashes, and hold for all.
SAMPLE_ROWS = 4096
#: Rows and anchors of a block, and rows of a run.
BLOCK, ANCHORS, RUN = 4096, 1024, 512
#: Angles are kept in single precision and computed in double: what both can be off, and more.
MARGIN = 2e-6
_LIMIT = 1 << 53
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


def whole_numbers(vector: Column, scale: float) -> Column:
    """floor(scale * x) of each component."""

    def whole(x):
        x = F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(float(_LIMIT))), F.lit(float(-_LIMIT))))
        return x.cast("long")

    return F.transform(vector, whole)


def takes_part(vector: Column, label: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return label.isNotNull() & vector.isNotNull() & F.coalesce(finite, F.lit(False))


def directions(length: int, sample: np.ndarray, count: int = REFERENCES) -> np.ndarray:
    """Unit vectors: farthest-first among the sample's, then moved to the middle of those nearest to them; random ones if there are too few."""
    rng = np.random.default_rng(length)
    found = rng.normal(size=(count, length))
    norm = np.sqrt((sample * sample).sum(axis=1))
    unit = sample[norm > 0] / norm[norm > 0][:, None]
    if len(unit):
        chosen = [0]
        near = unit @ unit[0]
        while len(chosen) < min(count, len(unit)):
            chosen.append(int(near.argmin()))
            near = np.maximum(near, unit @ unit[chosen[-1]])
        found[: len(chosen)] = unit[chosen]
        for _ in range(5):
            nearest = (unit @ found.T).argmax(axis=1)
            for c in range(count):
                middle = unit[nearest == c].sum(axis=0)
                if middle @ middle > 1e-12:
                    found[c] = middle
            found /= np.sqrt((found * found).sum(axis=1))[:, None]
    size = np.sqrt((found * found).sum(axis=1))[:, None]
    return found / np.where(size > 0, size, 1)


def with_angles(rows: DataFrame, count: int, sample_rows: int) -> DataFrame:
    """``rows`` (with e, a list of whole numbers) and their norm, angles to the references, and the nearest of these."""
    picked = rows.select("e").orderBy(F.xxhash64("id", "e"), "id").limit(sample_rows).toPandas()["e"]
    by_length: dict[int, list] = {}
    for e in picked:
        by_length.setdefault(len(e), []).append(np.asarray(e, dtype=np.float64))
    fitted = {n: directions(n, np.stack(some), count) for n, some in by_length.items()}

    def run(batches):
        for batch in batches:
            lengths = batch["e"].map(len).to_numpy()
            norm, angles = np.zeros(len(batch)), np.zeros((len(batch), count))
            for n in np.unique(lengths):
                at = lengths == n
                x = np.stack(batch["e"][at].to_numpy()).astype(np.float64)
                of = fitted[n] if n in fitted else directions(int(n), np.zeros((0, int(n))), count)
                norm[at] = np.sqrt((x * x).sum(axis=1))
                angles[at] = np.arccos(np.clip((x @ of.T) / np.where(norm[at] > 0, norm[at], 1)[:, None], -1, 1))
            nearest = angles.argmin(axis=1)
            batch["norm"], batch["angles"] = norm, list(angles.astype(np.float32))
            batch["cell"], batch["own"] = nearest, angles[np.arange(len(batch)), nearest] if len(batch) else []
            yield batch

    schema = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in rows.schema.fields)}, norm double, angles array<float>, cell int, own double"
    return rows.mapInPandas(run, schema)


def _interval(gap, reach, low_a, high_a, low_b, high_b):
    """(least, most) score of vectors whose angle lies between ``gap`` and ``reach``, whose norms lie between the given ones."""
    near, far = np.cos(np.clip(gap - MARGIN, 0, np.pi)), np.cos(np.clip(reach + MARGIN, 0, np.pi))
    slack = 1 + 1e-9 * high_a * high_b
    most = np.where(near >= 0, near * high_a * high_b, near * low_a * low_b) + slack
    least = np.where(far >= 0, far * low_a * low_b, far * high_a * high_b) - slack
    return least, most


def _products(a: np.ndarray, b: np.ndarray, safe: bool) -> np.ndarray:
    if safe:
        return np.einsum("ij,ij->i", a, b)
    exact = (sum(x * y for x, y in zip(p, q)) for p, q in zip(a.tolist(), b.tolist()))
    return np.array([min(max(s, _LEAST), _MOST) for s in exact], dtype=np.int64)


class _Best:
    """The k best rows of every window: scores downwards, then ids and row numbers upwards."""

    def __init__(self, windows: int, k: int, low: np.ndarray):
        self.k, self.low = k, low
        self.rows = [np.zeros(0, np.int64)] * 4

    def add(self, window, score, identity, number):
        window, score, identity, number = (np.concatenate(x) for x in zip(self.rows, (window, score, identity, number)))
        # ~score runs downwards without the overflow that -score has.
        order = np.lexsort((number, identity, ~score, window))
        window = window[order]
        place = np.arange(len(window)) - np.searchsorted(window, window)
        keep = order[place < self.k]
        self.rows = [window[place < self.k], score[keep], identity[keep], number[keep]]
        last = place == self.k - 1
        self.low[window[last]] = np.maximum(self.low[window[last]], score[order[last]])


def _ids(column: pd.Series) -> np.ndarray:
    return column.astype("Int64").fillna(_MOST).to_numpy(dtype=np.int64)


def _meet(k: int, same: bool, own: bool, run: int):
    """One block of anchors, each with its windows, against one block of rows. ``own``: whether an anchor meets its own block."""

    def meet(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({c: np.zeros(0, np.int64) for c in ("anchor", "slot", "found", "score")})
        if not len(anchors) or not len(rows):
            return empty
        anchors, rows = anchors.sort_values("number"), rows.sort_values("number")
        a, b = (np.stack(x["e"].to_numpy()).astype(np.int64) for x in (anchors, rows))
        norm_a, norm_b = anchors["norm"].to_numpy(), rows["norm"].to_numpy()
        angle_a, angle_b = (np.stack(x["angles"].to_numpy()).astype(np.float64) for x in (anchors, rows))
        label_a, label_b = (x["label"].astype(object).to_numpy() for x in (anchors, rows))
        codes = {v: i for i, v in enumerate(pd.unique(np.concatenate([label_a, label_b])))}
        label_a, label_b = (np.array([codes[v] for v in x]) for x in (label_a, label_b))
        number_a, number_b, ids = anchors["number"].to_numpy(), rows["number"].to_numpy(), _ids(rows["id"])
        block_a, block_b = anchors["block"].to_numpy(), rows["block"].to_numpy()
        safe = norm_a.max() * norm_b.max() < 2.0**62

        slots = [[(w["slot"], w["lo"], w["hi"]) for w in ws] for ws in anchors["windows"]]
        of = np.repeat(np.arange(len(slots)), [len(s) for s in slots])
        slot, low, high = (np.array([w[i] for s in slots for w in s], dtype=np.int64) for i in range(3))
        if not len(of):
            return empty
        first = np.searchsorted(of, np.arange(len(slots)))
        some = np.flatnonzero(np.diff(np.append(first, len(of))))
        best = _Best(len(of), k, low)
        wide = np.full(len(slots), np.inf), np.full(len(slots), -np.inf)
        for start in range(0, len(b), run):
            part = slice(start, start + run)
            wide[0][some], wide[1][some] = np.minimum.reduceat(best.low, first[some]), np.maximum.reduceat(high, first[some])
            # Anchors against the whole run.
            lowest, highest = angle_b[part].min(axis=0), angle_b[part].max(axis=0)
            gap = np.maximum(np.maximum(angle_a - highest, lowest - angle_a), 0).max(axis=1)
            reach = np.minimum(angle_a + highest, 2 * np.pi - angle_a - lowest).min(axis=1)
            least, most = _interval(gap, reach, norm_a, norm_a, norm_b[part].min(), norm_b[part].max())
            into = np.flatnonzero((most >= wide[0]) & (least <= wide[1]))
            if not len(into):
                continue
            # Anchors against rows.
            gap = np.zeros((len(into), len(norm_b[part])))
            reach = np.full_like(gap, np.pi)
            for r in range(angle_a.shape[1]):
                x, y = angle_a[into, r][:, None], angle_b[part, r][None, :]
                np.maximum(gap, np.abs(x - y), out=gap)
                both = x + y
                np.minimum(reach, np.minimum(both, 2 * np.pi - both), out=reach)
            least, most = _interval(gap, reach, norm_a[into][:, None], norm_a[into][:, None], norm_b[part][None, :], norm_b[part][None, :])
            open_ = (most >= wide[0][into][:, None]) & (least <= wide[1][into][:, None])
            open_ &= (label_a[into][:, None] == label_b[part][None, :]) == same
            open_ &= number_a[into][:, None] != number_b[part][None, :]
            if not own:
                open_ &= block_a[into][:, None] != block_b[part][None, :]
            i, j = np.nonzero(open_)
            for at in range(0, len(i), 1 << 17):
                p, q = into[i[at : at + (1 << 17)]], start + j[at : at + (1 << 17)]
                score = _products(a[p], b[q], safe)
                # A score goes into each window of its anchor that it meets.
                for w in range(int(np.diff(np.append(first, len(of))).max())):
                    window = first[p] + w
                    there = window < np.append(first, len(of))[p + 1]
                    window = np.where(there, window, 0)
                    there &= (score >= best.low[window]) & (score <= high[window])
                    best.add(window[there], score[there], ids[q][there], number_b[q][there])
        window, score, _, number = best.rows
        return pd.DataFrame({"anchor": number_a[of[window]], "slot": slot[window], "found": number, "score": score})

    return meet


def _summary(rows: DataFrame, keys: list[str], references: int) -> DataFrame:
    ends = [(f, n) for f, n in ((F.min, "lowest"), (F.max, "highest"))]
    return rows.groupBy(*keys).agg(
        *[F.array(*[f(F.col("angles")[r].cast("double")) for r in range(references)]).alias(n) for f, n in ends],
        F.min("norm").alias("least_norm"), F.max("norm").alias("most_norm"),
        F.min("label").alias("least_label"), F.max("label").alias("most_label"),
    )


def _overlaps(references: int, same: bool) -> Column:
    """Whether a block of anchors (a) and one of rows (b) can hold a wanted pair."""
    low, high = (lambda t, r: F.col(f"{t}.lowest")[r]), (lambda t, r: F.col(f"{t}.highest")[r])
    each = range(references)
    gap = F.greatest(F.lit(0.0), *[F.greatest(low("a", r) - high("b", r), low("b", r) - high("a", r)) for r in each])
    reach = F.least(
        F.lit(math.pi), *[F.least(high("a", r) + high("b", r), F.lit(2 * math.pi) - low("a", r) - low("b", r)) for r in each]
    )
    near, far = F.cos(F.greatest(gap - MARGIN, F.lit(0.0))), F.cos(F.least(reach + MARGIN, F.lit(math.pi)))
    most_norms, least_norms = F.col("a.most_norm") * F.col("b.most_norm"), F.col("a.least_norm") * F.col("b.least_norm")
    slack = 1 + 1e-9 * most_norms
    most = near * F.when(near >= 0, most_norms).otherwise(least_norms) + slack
    least = far * F.when(far >= 0, least_norms).otherwise(most_norms) - slack
    meets = (most >= F.col("a.lo")) & (least <= F.col("a.hi"))
    if same:
        return meets & (F.col("a.least_label") <= F.col("b.most_label")) & (F.col("b.least_label") <= F.col("a.most_label"))
    one = F.col("a.least_label") == F.col("b.most_label")
    return meets & ~(one & (F.col("a.most_label") == F.col("b.least_label")))


def search(rows: DataFrame, anchors: DataFrame, windows: DataFrame, k: int, same: bool, references: int, block: int, dealt: int, run: int) -> DataFrame:
    """anchor, slot, found, score: for each window (anchor, slot, lo, hi) the ``k`` best rows whose score lies in it."""
    schema = "anchor bigint, slot bigint, found bigint, score bigint"
    vectors = ["length", "block", "number", "id", "label", "e", "norm", "angles"]
    asked = windows.groupBy("anchor").agg(F.collect_list(F.struct("slot", "lo", "hi")).alias("windows"))
    asking = anchors.join(asked, F.col("number") == F.col("anchor")).drop("anchor")
    inner = asking.select(*vectors, "windows").groupBy("length", "block").cogroup(rows.select(*vectors).groupBy("length", "block"))
    first = materialize(inner.applyInPandas(_meet(k, same, True, run), schema), "negatives-own")

    # The k-th best of the own block is the least that counts elsewhere.
    reached = first.groupBy("anchor", "slot").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).where(F.col("n") >= k)
    raised = windows.join(reached, ["anchor", "slot"], "left").withColumn("lo", F.greatest("lo", "least"))
    asked = raised.groupBy("anchor").agg(
        F.collect_list(F.struct("slot", "lo", "hi")).alias("windows"), F.min("lo").alias("lo"), F.max("hi").alias("hi")
    )
    asking = materialize(anchors.join(asked, F.col("number") == F.col("anchor")).drop("anchor"), "negatives-anchors")
    a = _summary(asking, ["length", "dealt"], references).join(
        asking.groupBy("length", "dealt").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")), ["length", "dealt"]
    )
    b = _summary(rows, ["length", "block"], references)
    pairs = a.alias("a").join(b.alias("b"), F.col("a.length") == F.col("b.length")).where(_overlaps(references, same))
    pairs = materialize(pairs.select("a.length", "a.dealt", "b.block"), "negatives-pairs")

    left = asking.select(*vectors, "windows", "dealt").join(pairs.withColumnRenamed("block", "of"), ["length", "dealt"])
    right = rows.select(*vectors).join(pairs.withColumnRenamed("block", "of"), (rows["block"] == F.col("of")) & (rows["length"] == pairs["length"]))
    right = right.drop(pairs["length"])
    met = left.groupBy("length", "dealt", "of").cogroup(right.groupBy("length", "dealt", "of"))
    found = first.unionByName(met.applyInPandas(_meet(k, same, False, run), schema))
    best = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), F.col("found_id").asc_nulls_last(), "found")
    named = found.join(rows.select(F.col("number").alias("found"), F.col("id").alias("found_id")), "found")
    ranked = named.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return materialize(ranked, "negatives-found")


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label: Column | None = None,
    scale: float = 256.0,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    references: int = REFERENCES,
    block: int = BLOCK,
    dealt: int = ANCHORS,
    run: int = RUN,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``is_anchor`` is a condition on ``id``; ``label`` an expression over the columns of ``vectors`` (column ``label`` if None).
    """
    vector, label = F.col(f"`{vector_column}`"), F.col("label") if label is None else label
    rows = vectors.where(takes_part(vector, label)).select(
        F.col(f"`{id_column}`").cast("long").alias("id"), label.alias("label"), whole_numbers(vector, scale).alias("e")
    )
    rows = with_angles(rows, references, sample_rows).withColumn("length", F.size("e"))
    rows = global_row_number(rows, ["length", "cell", "own", "id", F.xxhash64("e", "label")], "number").drop("cell", "own")
    rows = materialize(rows.withColumn("block", F.floor((F.col("number") - 1) / block)), "negatives-rows")
    anchors = global_row_number(rows.where(F.coalesce(is_anchor, F.lit(False))), ["number"], "place")
    anchors = materialize(anchors.withColumn("dealt", F.floor((F.col("place") - 1) / dealt)).drop("place"), "negatives-anchors")

    anywhere = anchors.select(F.col("number").alias("anchor"), F.lit(0).cast("long").alias("slot"), F.lit(_LEAST).alias("lo"), F.lit(_MOST).alias("hi"))
    sizes = (references, block, dealt, run)
    near = search(rows, anchors, anywhere, positives, True, *sizes)
    near = near.select("anchor", F.col("found").alias("slot"), F.col("found_id").alias("positive_id"), F.col("score").alias("positive_score"))
    share = F.col("positive_score").cast("decimal(20,0)")
    windows = near.select(
        "anchor", "slot", F.ceil(share * low / 100).cast("long").alias("lo"), F.floor(share * high / 100).cast("long").alias("hi")
    ).where("lo <= hi")
    hard = search(rows, anchors, windows, negatives, False, *sizes)
    names = anchors.select(F.col("number").alias("anchor"), F.col("id").alias("anchor_id"))
    return (
        hard.join(near, ["anchor", "slot"]).join(names, "anchor")
        .select("anchor_id", "positive_id", "rank", F.col("found_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
    )
