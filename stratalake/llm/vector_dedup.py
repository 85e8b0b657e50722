"""Near duplicates among embeddings: int8 tile products with rigorous error bounds, doubles only where these can't decide.

Vectors are compared within their label. Equal vectors are first folded into one
class. Every class is quantised once, and only its int8 codes, its step and the
bound of its error travel to the comparisons. A label's classes are dealt out to
cells around a few of its own vectors, and each cell to tiles of bounded size.
Two tiles whose centres are farther apart than both radii and the threshold's
angle allow hold no link and never meet; each other pair of tiles is one group:
two bounded blocks of codes, whose int8 products are one matrix product. A
product bounds the cosine from both sides: pairs surely above the threshold are
links, pairs surely below are none. Classes with pairs in between are fetched in
doubles in a second pass over their tile pairs, and those pairs alone are computed
in double precision.

A group gives one count per vector and links that span what it found connected,
never all its pairs, so a large cluster of near copies costs comparisons, but no
rows. What remains is one comparison for each pair of classes of a label whose
tiles lie near each other, spread evenly over the groups; where directions are
spread out evenly these are all pairs, as exactness asks for.

Defined results: vectors that are null, zero or hold null or non-finite
components, and those without a label, have no links and are kept; vectors of
different lengths are never linked; every row counts as a vector of its own, also
if a vec_id repeats or is null; a component is named by its smallest vec_id, so a
row without one is kept only where no row of its component has one; an empty table
gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.common import materialize, whole_number
from stratalake.llm.components import components

THRESHOLD = 0.98
#: Classes in a tile, on average: a group holds two tiles.
TILE = 1024
#: Cells of a label at most, and classes that are quantised in one group.
CELLS, BLOCK = 64, 4096
_MARGIN = 1e-9
#: Arc cosines of rounded products err by less.
_ANGLE_MARGIN = 1e-6


def usable(column: str) -> Column:
    """Whether an array column holds a vector with a direction."""
    v = F.col(column)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(int8 codes, step, bound) of vectors of length 1: each differs from step * codes by at most its bound."""
    step = np.abs(x).max(axis=1) / 127
    codes = np.rint(x / step[:, None]).astype(np.int8)
    error = np.sqrt(((x - codes * step[:, None]) ** 2).sum(axis=1)) + 1e-12
    return codes, step, error


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times powers of two, so that no square overflows or vanishes; no digit changes."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosines of the rows of ``x`` and ``y``, pair by pair, in double precision."""
    return (x * y).sum(axis=1) / np.sqrt((x * x).sum(axis=1) * (y * y).sum(axis=1))


def directions(x: np.ndarray) -> np.ndarray:
    """Rows as vectors of length 1."""
    x = scaled(x)
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def _decide(left: tuple, right: tuple, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """(surely linked, open) pairs of rows of two (codes, step, error); of a tile with itself only those above the diagonal.

    Sums of products of int8 are whole numbers below 2**24 up to a thousand
    components: exact in single precision. So the second pass, which sees some
    of the rows only, decides alike.
    """
    (qa, sa, ea), (qb, sb, eb) = left, right
    kind = np.float32 if qa.shape[1] <= 1000 else np.float64
    near = (qa.astype(kind) @ qb.astype(kind).T) * sa[:, None] * sb[None, :]
    bound = ea[:, None] * (1 + eb[None, :]) + eb[None, :] + _MARGIN
    linked = near - bound >= threshold
    open_ = (near + bound >= threshold) & ~linked
    return (np.triu(linked, 1), np.triu(open_, 1)) if same else (linked, open_)


def _exactly(open_: np.ndarray, left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    """Which of the open pairs reach the threshold in double precision."""
    linked = np.zeros(open_.shape, bool)
    i, j = np.nonzero(open_)
    for at in range(0, len(i), 65_536):
        part = slice(at, at + 65_536)
        linked[i[part], j[part]] = cosines(left[i[part]], right[j[part]]) >= threshold
    return linked


def _spanning(linked: np.ndarray, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Links between the nodes ``a`` and ``b`` that connect whatever ``linked`` connects."""
    seen_a, seen_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
    if a is b:
        linked = linked | linked.T
    out = []
    for first in np.flatnonzero(linked.any(axis=1)):
        if seen_a[first]:
            continue
        frontier = np.array([first])
        seen_a[first] = True
        while len(frontier):
            reached = linked[frontier].any(axis=0) & ~(seen_a if a is b else seen_b)
            if a is b:
                reached[frontier] = False
                seen_a |= reached
            else:
                seen_b |= reached
            new = np.flatnonzero(reached)
            # Any link of the frontier to the new node will do.
            via = frontier[linked[np.ix_(frontier, new)].argmax(axis=0)] if len(new) else new
            out += [(int(a[x]), int(b[y])) for x, y in zip(via, new)]
            if a is b:
                frontier = new
                continue
            reached = linked[:, new].any(axis=1) & ~seen_a
            seen_a |= reached
            frontier = np.flatnonzero(reached)
            back = new[linked[np.ix_(frontier, new)].argmax(axis=1)] if len(frontier) else frontier
            out += [(int(a[x]), int(b[y])) for x, y in zip(frontier, back)]
    return out


_FOUND = "a bigint, b bigint, n bigint, i bigint, j bigint, side int"


def _found(linked: np.ndarray, a: np.ndarray, ca: np.ndarray, b: np.ndarray, cb: np.ndarray) -> list[tuple]:
    """Rows of counts (a, n) and of spanning links (a, b). ``a is b`` for a tile with itself."""
    counts: dict[int, int] = {}
    for nodes, found in ((a, linked @ cb), (b, ca @ linked)):
        for k in np.flatnonzero(found):
            counts[int(nodes[k])] = counts.get(int(nodes[k]), 0) + int(found[k])
    out = [(k, None, n, None, None, None) for k, n in counts.items()]
    return out + [(x, y, None, None, None, None) for x, y in _spanning(linked, a, b)]


def _sides(pdf: pd.DataFrame) -> list[pd.DataFrame]:
    """The rows of either side; of a tile with itself twice the same."""
    if pdf["i"].iloc[0] == pdf["j"].iloc[0]:
        return [pdf.sort_values("node")] * 2
    return [pdf[pdf["side"] == side].sort_values("node") for side in (0, 1)]


def _codes(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    codes = np.frombuffer(b"".join(rows["codes"]), np.int8).reshape(len(rows), -1)
    return codes, rows["step"].to_numpy(), rows["error"].to_numpy()


def _compare(threshold: float, exactly: bool):
    """A function of the rows of one pair of tiles.

    The first pass gives counts and links of the sure pairs, and the rows that
    have open ones. The second one sees these rows with their doubles and gives
    counts and links of the open pairs.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        i, j = int(pdf["i"].iloc[0]), int(pdf["j"].iloc[0])
        left, right = _sides(pdf)
        out: list[tuple] = []
        if len(left) and len(right):
            linked, open_ = _decide(_codes(left), _codes(right), threshold, i == j)
            a, b = left["node"].to_numpy(), right["node"].to_numpy()
            if i == j:
                b = a
            if exactly:
                x, y = (scaled(np.stack(s["v"].to_numpy()).astype(np.float64)) for s in (left, right))
                linked = _exactly(open_, x, y, threshold)
            else:
                rows, columns = open_.any(axis=1), open_.any(axis=0)
                if i == j:
                    rows = columns = rows | columns
                out += [(int(k), None, None, i, j, 0) for k in a[rows]]
                if i != j:
                    out += [(int(k), None, None, i, j, 1) for k in b[columns]]
            out += _found(linked, a, left["copies"].to_numpy(), b, right["copies"].to_numpy())
        return pd.DataFrame(out, columns=["a", "b", "n", "i", "j", "side"]).astype(
            {"a": "int64", "b": "Int64", "n": "Int64", "i": "Int64", "j": "Int64", "side": "Int32"}
        )

    return run


def classes(vectors: DataFrame, id_column: str, vector_column: str, label_column: str) -> DataFrame:
    """node, label, v, copies, least: one row per distinct usable vector of a label."""
    rows = vectors.select(
        F.col(id_column).cast("long").alias("id"), F.col(label_column).alias("label"), F.col(vector_column).cast("array<double>").alias("v")
    ).where(F.col("label").isNotNull())
    grouped = rows.where(usable("v")).groupBy("label", "v").agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("least"))
    return materialize(grouped.withColumn("node", F.monotonically_increasing_id()), "vector-classes")


def _unit(v: str) -> Column:
    """An array of length 1 in the direction of column ``v``, to rounding."""
    shrunk = F.transform(v, lambda x: x / F.array_max(F.transform(v, lambda y: F.abs(y))))
    length = F.sqrt(F.aggregate(shrunk, F.lit(0.0), lambda s, x: s + x * x))
    return F.transform(shrunk, lambda x: x / length)


def _centres(nodes: DataFrame, kinds: DataFrame) -> DataFrame:
    """kind, blocks, cell, centre: the classes of lowest hash of each kind, in a number that grows with it up to ``CELLS``."""
    order = Window.partitionBy("label", "length").orderBy(F.xxhash64("v"), "node")
    # The literal bound makes it a group limit: no task sorts more of a hot label than that.
    first = nodes.withColumn("cell", F.row_number().over(order)).where(F.col("cell") <= CELLS)
    return first.join(kinds, ["label", "length"]).where(F.col("cell") <= F.col("cells")).select(
        "kind", "blocks", "cell", _unit("v").alias("centre")
    )


def _place(rows: pd.DataFrame, centres: pd.DataFrame) -> pd.DataFrame:
    """A block of classes quantised, with the nearest centre and the angle to it."""
    if not len(rows):
        return pd.DataFrame({c: [] for c in ("node", "kind", "cell", "angle", "copies", "codes", "step", "error")})
    unit = directions(np.stack(rows["v"].to_numpy()).astype(np.float64))
    codes, step, error = quantise(unit)
    centres = centres.sort_values("cell")
    products = unit @ np.stack(centres["centre"].to_numpy()).astype(np.float64).T
    nearest = products.argmax(axis=1)
    return pd.DataFrame(
        {
            "node": rows["node"].to_numpy(),
            "kind": rows["kind"].to_numpy(),
            "cell": centres["cell"].to_numpy()[nearest],
            "angle": np.arccos(np.clip(products[np.arange(len(unit)), nearest], -1, 1)),
            "copies": rows["copies"].to_numpy(),
            "codes": [c.tobytes() for c in codes],
            "step": step,
            "error": error,
        }
    )


def _coded(nodes: DataFrame, tile: int) -> tuple[DataFrame, DataFrame]:
    """(classes as codes, with their cell and the angle to its centre; the centres). A kind is a label and a length."""
    nodes = nodes.withColumn("length", F.size("v"))
    n = F.count(F.lit(1))
    kinds = nodes.groupBy("label", "length").agg(
        F.ceil(n / F.lit(BLOCK)).cast("int").alias("blocks"),
        F.least(F.ceil(n / F.lit(tile)), F.lit(CELLS)).cast("int").alias("cells"),
    )
    kinds = materialize(kinds.withColumn("kind", F.monotonically_increasing_id()), "vector-kinds")
    centres = materialize(_centres(nodes, kinds), "vector-centres")
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block")
    rows = nodes.join(kinds, ["label", "length"]).select("kind", block, "node", "copies", "v")
    met = centres.select("kind", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "cell", "centre")
    schema = "node bigint, kind bigint, cell int, angle double, copies bigint, codes binary, step double, error double"
    coded = rows.groupBy("kind", "block").cogroup(met.groupBy("kind", "block")).applyInPandas(_place, schema)
    return materialize(coded, "vector-codes"), centres


def _near_tiles(tiles: DataFrame, centres: DataFrame, threshold: float) -> DataFrame:
    """i, j: the pairs of tiles of a kind that may hold a link, by the angles between centres and the radii."""
    p = centres.select("kind", F.col("cell").alias("cell_i"), F.col("centre").alias("p"))
    q = centres.select("kind", F.col("cell").alias("cell_j"), F.col("centre").alias("q"))
    dot = F.aggregate(F.zip_with("p", "q", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    apart = p.join(q, "kind").select("kind", "cell_i", "cell_j", F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot))).alias("apart"))
    a = tiles.select("kind", F.col("cell").alias("cell_i"), F.col("tile").alias("i"), F.col("radius").alias("r_i"))
    b = tiles.select("kind", F.col("cell").alias("cell_j"), F.col("tile").alias("j"), F.col("radius").alias("r_j"))
    reach = F.lit(math.acos(max(-1.0, min(1.0, threshold))) + _ANGLE_MARGIN)
    return (
        a.join(apart, ["kind", "cell_i"]).join(b, ["kind", "cell_j"])
        .where((F.col("i") <= F.col("j")) & ((F.col("i") == F.col("j")) | (F.col("apart") - F.col("r_i") - F.col("r_j") <= reach)))
        .select("i", "j")
    )


def _meeting(coded: DataFrame, centres: DataFrame, threshold: float, tile: int) -> DataFrame:
    """Every class as codes once for each pair of tiles in which its own meets another: group columns i, j, and side."""
    parts = coded.groupBy("kind", "cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(tile)).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    placed = coded.join(parts, ["kind", "cell"]).withColumn("part", part).drop("parts")
    tiles = placed.groupBy("kind", "cell", "part").agg(F.max("angle").alias("radius"))
    tiles = materialize(tiles.withColumn("tile", F.monotonically_increasing_id()), "vector-tiles")
    pairs = _near_tiles(tiles, centres, threshold)
    sides = F.array(F.struct(F.col("i").alias("tile"), F.lit(0).alias("side")), F.struct(F.col("j").alias("tile"), F.lit(1).alias("side")))
    pairs = pairs.select("i", "j", F.inline(F.when(F.col("i") < F.col("j"), sides).otherwise(F.slice(sides, 1, 1))))
    placed = placed.join(tiles.drop("radius"), ["kind", "cell", "part"])
    return placed.join(pairs, "tile").select("i", "j", "side", "node", "copies", "codes", "step", "error")


def _links(nodes: DataFrame, threshold: float, tile: int) -> DataFrame:
    """a, b, n: numbers of linked classes' vectors (a, n) and links that span the components (a, b)."""
    coded, centres = _coded(nodes, tile)
    meeting = _meeting(coded, centres, threshold, tile)
    sure = materialize(meeting.groupBy("i", "j").applyInPandas(_compare(threshold, False), _FOUND), "vector-links")
    left = sure.where("side IS NOT NULL").select("i", "j", "side", F.col("a").alias("node"))
    fetched = left.join(coded.select("node", "copies", "codes", "step", "error"), "node").join(nodes.select("node", "v"), "node")
    exact = fetched.groupBy("i", "j").applyInPandas(_compare(threshold, True), _FOUND)
    return sure.where("side IS NULL").select("a", "b", "n").union(materialize(exact, "vector-exact").select("a", "b", "n"))


def near_duplicates(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    tile: int = TILE,
) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per vector; columns keep the name of ``id_column``."""
    nodes = classes(vectors, id_column, vector_column, label_column)
    found = _links(nodes, threshold, tile)
    counts = found.where("n IS NOT NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("others"))
    roots = components(found.where("b IS NOT NULL").select("a", "b"))
    named = (
        nodes.select("node", "label", "v", "copies", "least").join(counts, "node", "left").join(roots, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    least = named.groupBy("root").agg(F.min("least").alias("component"))
    named = named.join(least, "root").select(
        F.col("label").alias("_label"), F.col("v").alias("_v"), (F.col("copies") - 1 + whole_number("others")).alias("_links"), "component"
    )
    own = F.col(id_column).cast("long")
    rows = vectors.select(own.alias("_id"), F.col(label_column).alias("_l"), F.col(vector_column).cast("array<double>").alias("_w"))
    joined = rows.join(named, (F.col("_l") == F.col("_label")) & (F.col("_w") == F.col("_v")), "left")
    return joined.select(
        F.col("_id").alias(id_column),
        whole_number("_links").alias("n_links"),
        F.coalesce("component", "_id").alias("component_id"),
        F.col("_id").eqNullSafe(F.coalesce("component", "_id")).alias("kept"),
    )
