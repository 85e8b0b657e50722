import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratalake.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<double>, label int, score long, `a.b` string"
SMALL = {"block": 16, "dealt": 3, "run": 5, "references": 4, "sample_rows": 20}


def plain(rows, is_anchor, positives, negatives, low, high):
    """By scoring everything; ids are unique and never null."""
    taken = []
    for i, v, label, *_ in rows:
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            taken.append((i, [max(-(1 << 53), min(1 << 53, math.floor(max(-1e300, min(1e300, 256 * x))))) for x in v], label))
    out = []
    for i, a, label in taken:
        if not is_anchor(i):
            continue
        scored = [(-sum(x * y for x, y in zip(a, b)), j, other == label) for j, b, other in taken if j != i and len(a) == len(b)]
        scored.sort()
        for p, j, _ in [s for s in scored if s[2]][:positives]:
            wanted = [(n, k) for n, k, same in scored if not same and low * -p <= 100 * -n <= high * -p][:negatives]
            out += [(i, j, r + 1, k, -p, -n) for r, (n, k) in enumerate(wanted)]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def made(n, seed, length=6, labels=4, centres=5):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, length))
    out = []
    for i in range(n):
        v = middle[rng.integers(centres)] + rng.normal(size=length) * rng.choice([0.01, 0.5, 2])
        out.append((int(i), [float(x) for x in v], int(rng.integers(labels)), 1, "dot"))
    return out


@pytest.mark.parametrize("seed,labels,centres", [(1, 2, 3), (2, 5, 8), (3, 3, 1)])
def test_as_by_scoring_everything(spark, seed, labels, centres):
    rows = made(150, seed, labels=labels, centres=centres)
    mined = H.mine(spark.createDataFrame(rows, SCHEMA), F.col("id") % 10 == 0, positives=3, negatives=4, **SMALL)
    want = plain(rows, lambda i: i % 10 == 0, 3, 4, 30, 90)
    assert want and got(mined) == want


def test_copies_ties_and_odd_rows(spark):
    rows = made(40, 4)
    same = rows[3][1]
    rows += [(100 + i, same, i % 2, 1, "dot") for i in range(60)]
    rows += [
        (200, None, 1, 1, None), (201, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1, 1, None), (202, [math.nan] * 6, 0, 1, None), (203, same, None, 1, None),
        (204, [math.inf] + same[1:], 0, 1, None), (205, [0.0] * 6, 1, 1, None), (206, [1.0, 2.0], 1, 1, None), (207, [2.0, 2.0], 1, 1, None),
        (208, [1.5, 2.0], 0, 1, None), (209, [], 1, 1, None), (210, [], 0, 1, None), (220, [0.6, 0.9], 2, 1, None), (230, [0.0] * 6, 0, 1, None),
    ]
    mined = H.mine(spark.createDataFrame(rows, SCHEMA), F.col("id") % 10 == 0, positives=5, negatives=10, **SMALL)
    want = plain(rows, lambda i: i % 10 == 0, 5, 10, 30, 90)
    assert len(want) > 100 and got(mined) == want
    every = H.mine(spark.createDataFrame(rows, SCHEMA), F.lit(True), positives=1, negatives=2, low=0, high=100, **SMALL)
    assert got(every) == plain(rows, lambda i: True, 1, 2, 0, 100)


def test_empty_table_and_no_anchor(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert H.mine(none, F.col("id") % 2 == 0).count() == 0
    assert H.mine(spark.createDataFrame(made(9, 1), SCHEMA), F.col("id") < 0).count() == 0


def test_rows_that_share_an_id_or_have_none(spark):
    v = [1.0, 0.0]
    rows = [(1, v, 0, 1, ""), (1, v, 0, 1, ""), (None, [0.5, 0.0], 1, 1, ""), (7, [0.5, 0.0], 1, 1, "")]
    out = got(H.mine(spark.createDataFrame(rows, SCHEMA), F.col("id") == 1))
    assert out == [(1, 1, 1, 7, 65536, 32768), (1, 1, 1, 7, 65536, 32768), (1, 1, 2, None, 65536, 32768), (1, 1, 2, None, 65536, 32768)]


def test_huge_components_are_exact_and_bounded(spark):
    big = 2.0**40
    rows = [(0, [big, 1.0], 0, 1, ""), (1, [big, 3.0], 0, 1, ""), (2, [big / 2, 0.0], 1, 1, ""), (3, [1e300, 1e300], 1, 1, "")]
    out = got(H.mine(spark.createDataFrame(rows, SCHEMA), F.col("id") == 0))
    # The positive's score exceeds 64 bits and counts as their limit; the window lies below it.
    assert all(r[4] == (1 << 63) - 1 and 30 * r[4] <= 100 * r[5] <= 90 * r[4] for r in out)


def test_bounds_hold_and_cut():
    rng = np.random.default_rng(7)
    centre = rng.normal(size=(6, 16))
    x = centre[rng.integers(6, size=300)] + 0.05 * rng.normal(size=(300, 16))
    x = np.floor(256 * x)
    of = H.directions(16, x)
    norm = np.sqrt((x * x).sum(axis=1))
    angle = np.arccos(np.clip(x @ of.T / norm[:, None], -1, 1)).astype(np.float32).astype(float)
    gap = np.abs(angle[:, None] - angle[None]).max(axis=2)
    both = angle[:, None] + angle[None]
    reach = np.minimum(both, 2 * np.pi - both).min(axis=2)
    least, most = H._interval(gap, reach, norm[:, None], norm[:, None], norm[None], norm[None])
    score = x @ x.T
    assert (least <= score).all() and (score <= most).all()
    # Vectors of other groups are told apart without a product.
    assert (most < 0.9 * norm[:, None] * norm[None]).mean() > 0.5


def test_far_blocks_never_meet(spark):
    rng = random.Random(3)
    # Two tight groups, far apart: the second level is asked for one of them only.
    rows = []
    for i in range(128):
        base = [1.0, 0.0, 0.0] if i < 64 else [0.0, 1.0, 0.0]
        rows.append((i, [b + rng.uniform(0, 0.01) for b in base], 0, 1, ""))
    df = spark.createDataFrame(rows, SCHEMA)
    v = df.select(F.col("vec_id").alias("id"), "label", H.whole_numbers(F.col("embedding"), 256.0).alias("e"))
    r = H.with_angles(v, 4, 128).withColumn("length", F.size("e")).withColumn("number", F.col("id")).withColumn("block", F.floor(F.col("id") / 32))
    a = H._summary(r.where("id < 2"), ["length"], 4).select("*", F.lit(60000).alias("lo"), F.lit(1 << 40).alias("hi"))
    b = H._summary(r, ["length", "block"], 4)
    met = a.alias("a").join(b.alias("b"), F.col("a.length") == F.col("b.length")).where(H._overlaps(4, True)).select("b.block")
    assert sorted(x[0] for x in met.collect()) == [0, 1]
