"""Exact Jaccard join of word n-gram sets: size-banded tiles, bitmap bounds, then sorted arrays.

1. Every text becomes its sorted array of hashed shingles, a bitmap signature of
   about as many bits, and a 128-bit name of the whole set. Texts of equal sets
   are one class from here on.
2. Shingles are counted into buckets, more of them the more shingles there are,
   which gives all sets the same order, rarest first. By the threshold, two linked sets share one of their
   first few shingles in that order, so only those become tile keys.
3. A tile is a shingle and a band of sizes. A size can link only to its own and
   the neighbouring band.
4. First each class is compared with the first class of its tiles. The links found
   already connect nearly all of a group of copies.
5. Then, in tiles where more than one component is left, classes of different
   components are compared. In a tile whose classes are all of one component
   nothing is left to find. A tile that has many such pairs is compared inside
   tasks, block by block, with wider signatures, and only pairs that may be
   linked leave them: so a group of many near copies never becomes rows in the
   square of its size.

A comparison looks at the signatures: the bits that one has and the other lacks
bound the overlap from above. Only pairs that pass have their arrays intersected.

What is exact: no pair at or above the threshold is left out of a component, and
none below it links. Shingles are compared by 64-bit hashes; within a pair of
texts of a thousand shingles an accidental match has a chance below 1e-13.

Defined results: a text without words, an empty one and a null one have an empty
set, no link, and their own doc_id as component; a text with fewer words than a
shingle has one shingle, the whole of it; rows that share a doc_id are separate
texts; a null doc_id takes part and gets the smallest doc_id of its component; an
empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import arrow_rows, discard, giving_back, materialize, sized
from stratalake.llm.components import components

#: Buckets have so many shingles each on average, as long as there are neither fewer nor more than so many (powers of
#: two) of them. A task sends one row for each bucket that it meets, and the driver holds one number for each.
BUCKET_SHINGLES, BUCKET_BITS = 4_096, (17, 22)
#: A bucket with so many times the mean count, or with so many shingles, is hot: its shingles skip the search for single
#: ones, where all rows of a shingle meet in one task.
HOT, HOT_ROWS = 8, 1 << 22
MEMO_WORDS = 100_000
#: A tile with more pairs to compare than this is compared inside tasks, in blocks of so many rows, by signatures of
#: so many bits for each shingle.
TILE_PAIRS, TILE_BLOCK, WIDE_BITS = 20_000, 1_024, 8
#: Rows in a batch for Python. An array of shingles has several kilobytes.
BATCH_ROWS = 1_000
_P = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingles(text: str | None, width: int, hashes: _Hashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text. ASCII letters are lower-cased; words end at ASCII white space."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.zeros(0, dtype=np.uint64)
    w = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    k = min(width, len(w))
    h = np.full(len(w) - k + 1, k, dtype=np.uint64)
    for i in range(k):
        h = (h ^ w[i : len(w) - k + 1 + i]) * _P[0]
        h ^= h >> np.uint64(29)
    h = (h * _P[1]) ^ (h >> np.uint64(32))
    return np.unique(h * _P[2])


def bitmap(shingle_set: np.ndarray, bits_each: int = 1) -> bytes:
    """A signature of 64 bits, or of the next power of two that is not below ``bits_each`` times the size."""
    bits = 1 << max(6, (bits_each * len(shingle_set) - 1).bit_length())
    marks = np.zeros(bits, dtype=np.uint8)
    marks[(shingle_set >> np.uint64(7)) & np.uint64(bits - 1)] = 1
    return np.packbits(marks, bitorder="little").tobytes()


def overlap_bound(a: bytes, na: int, b: bytes, nb: int) -> int:
    """No less than the overlap of two sets, from their signatures: a bit that only one has is an element that only one has."""
    x, y = np.frombuffer(a, dtype=np.uint8), np.frombuffer(b, dtype=np.uint8)
    while len(x) > len(y):
        x = x[: len(x) // 2] | x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] | y[len(y) // 2 :]
    return min(na - int(np.bitwise_count(x & ~y).sum()), nb - int(np.bitwise_count(y & ~x).sum()))


def prefix_length(n: int, percent: int) -> int:
    """How many of ``n`` ordered shingles suffice to meet every linked set."""
    return n - (percent * n + 99) // 100 + 1


def band(n: np.ndarray, percent: int) -> np.ndarray:
    """Linked sizes are in the same or in neighbouring bands."""
    width = math.log(100 / percent) * (1 + 1e-9) if percent < 100 else 1.0
    return np.floor(np.log(n) / width).astype(np.int32)


def shingle_sets(docs: DataFrame, width: int, id_column: str, text_column: str) -> DataFrame:
    """rid, id, n, name, sig, shingles: one row per document, written once. rid numbers the rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = _Hashes()
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.iloc[at : at + 500]
                sets = [shingles(t, width, hashes) for t in part["t"]]
                yield pd.DataFrame(
                    {
                        "id": part["id"].astype("Int64"),
                        "n": [len(s) for s in sets],
                        "name": [xxhash.xxh3_128_digest(s.tobytes()) for s in sets],
                        "sig": [bitmap(s) for s in sets],
                        "shingles": [s.tobytes() for s in sets],
                    }
                )

    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("t"))
    made = rows.mapInPandas(giving_back(run), "id bigint, n int, name binary, sig binary, shingles binary")
    return materialize(made.withColumn("rid", F.monotonically_increasing_id()), "shingle-sets")


def bucket_bits(total: int) -> int:
    """The logarithm of the number of buckets for ``total`` shingles."""
    least, most = BUCKET_BITS
    return min(max((total // BUCKET_SHINGLES).bit_length(), least), most)


def bucket_counts(sets: DataFrame) -> np.ndarray:
    """Shingles by bucket, over all sets."""
    bits = bucket_bits(sets.agg(F.sum(F.col("n").cast("long"))).first()[0] or 0)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(1 << bits, dtype=np.int64)
        for batch in batches:
            joined = np.frombuffer(b"".join(batch["shingles"]), dtype=np.uint64)
            total += np.bincount(_bucket(joined, bits), minlength=1 << bits)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": at.astype(np.int32), "c": total[at]})

    counted = sets.select("shingles").mapInPandas(giving_back(run), "bucket int, c bigint").groupBy("bucket").agg(F.sum("c").alias("c")).toPandas()
    out = np.zeros(1 << bits, dtype=np.int64)
    out[counted["bucket"].to_numpy(dtype=np.int64)] = counted["c"].to_numpy(dtype=np.int64)
    return out


def _bucket(h: np.ndarray, bits: int) -> np.ndarray:
    return (h >> np.uint64(64 - bits)).astype(np.int64)


def hot_buckets(counts: np.ndarray) -> np.ndarray:
    return counts > min(HOT * max(1.0, counts.mean()), HOT_ROWS)


def tile_keys(sets: DataFrame, counts: np.ndarray, percent: int) -> DataFrame:
    """sh, band, node, n, hot: the first shingles of each set, rarest bucket first."""
    hot, bits = hot_buckets(counts), len(counts).bit_length() - 1
    schema = pa.schema([("sh", pa.int64()), ("band", pa.int32()), ("node", pa.int64()), ("n", pa.int32()), ("hot", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column("rid").to_numpy()
            picked = []
            for s in batch.column("shingles"):
                h = np.frombuffer(s.as_buffer(), dtype=np.uint64)
                picked.append(h[np.lexsort((h, counts[_bucket(h, bits)]))[: prefix_length(len(h), percent)]])
            if not picked:
                continue
            sizes = batch.column("n").to_numpy()
            each = np.array([len(p) for p in picked])
            keys = np.concatenate(picked)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys.view(np.int64)),
                    pa.array(np.repeat(band(sizes, percent), each)),
                    pa.array(np.repeat(nodes, each)),
                    pa.array(np.repeat(sizes, each).astype(np.int32)),
                    pa.array(hot[_bucket(keys, bits)]),
                ],
                schema=schema,
            )

    return sets.select("rid", "n", "shingles").mapInArrow(giving_back(run), "sh bigint, band int, node bigint, n int, hot boolean")


def _drop_single(percent: int):
    return lambda batches: _shared(batches, percent)


def _shared(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by sh, n and node those whose sh occurs again, with their band and the first node of their tile.

    Holds one batch, one row and the last tile's first node, however long a run is.
    """
    held, center, before = None, None, None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if not len(table):
            continue
        table = table.append_column("band", pa.array(band(table.column("n").to_numpy(), percent)))
        if held is not None:
            table = pa.concat_tables([held, table])
        sh, bands, node = (table.column(c).to_numpy() for c in ("sh", "band", "node"))
        new_sh = np.r_[True if before is None else sh[0] != before[0], sh[1:] != sh[:-1]]
        new_tile = new_sh | np.r_[True if before is None else bands[0] != before[1], bands[1:] != bands[:-1]]
        first = np.maximum.accumulate(np.where(new_tile, np.arange(len(sh)), -1))
        centers = np.where(first >= 0, node[first], center if center is not None else 0)
        shared = ~new_sh | np.r_[~new_sh[1:], False]
        # Whether the last row's key goes on is seen in the next batch.
        table = table.append_column("center", pa.array(centers, type=pa.int64()))
        keep = shared.copy()
        keep[-1] = False
        yield from table.filter(pa.array(keep)).select(["sh", "band", "node", "n", "center"]).to_batches()
        held = table.slice(len(table) - 1).drop_columns(["center"])
        last_shared, last_center = bool(~new_sh[-1]), int(centers[-1])
        if len(table) > 1:
            before, center = (sh[-2], bands[-2]), int(centers[-2])
    if held is not None and last_shared:
        yield from held.append_column("center", pa.array([last_center], type=pa.int64())).select(["sh", "band", "node", "n", "center"]).to_batches()


def shared_keys(keys: DataFrame, percent: int) -> DataFrame:
    """sh, band, node, n, center: the keys that more than one class has; center is a class of the same tile.

    A key of a cold bucket is rare by construction, so its rows may meet in one
    task. Hot ones are counted with partial sums and joined back.
    """
    schema = "sh bigint, band int, node bigint, n int, center bigint"
    cold = keys.where("NOT hot").select("sh", "node", "n").repartition("sh").sortWithinPartitions("sh", "n", "node")
    hot = keys.where("hot").select("sh", "band", "node", "n")
    seen = hot.groupBy("sh", "band").agg(F.min("node").alias("center"), F.max("node").alias("_last"))
    whole = seen.groupBy("sh").agg(F.min("center").alias("_a"), F.max("_last").alias("_b")).where("_a < _b").select("sh")
    hot = hot.join(seen.join(whole, "sh", "left_semi").drop("_last"), ["sh", "band"])
    return cold.mapInArrow(giving_back(_drop_single(percent)), schema).unionByName(hot.select("sh", "band", "node", "n", "center"))


def _passing(percent: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            most = np.array([overlap_bound(*x) for x in zip(p["sig_a"], p["n_a"], p["sig_b"], p["n_b"])], dtype=np.int64)
            union = p["n_a"].to_numpy(dtype=np.int64) + p["n_b"].to_numpy(dtype=np.int64) - most
            yield p.loc[100 * most >= percent * union, ["a", "b"]]

    return run


def _linked(percent: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            keep = []
            for x, y in zip(p["set_a"], p["set_b"]):
                both = np.concatenate([np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)])
                both.sort(kind="stable")  # two sorted runs: one merge
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= percent * (len(both) - common))
            yield p.loc[np.array(keep, dtype=bool), ["a", "b"]]

    return run


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The ``pairs`` (a, b: rids) whose sets are linked. Signatures first; arrays travel for the pairs that pass only."""
    sigs = sets.select("rid", "n", "sig")
    joined = pairs.join(sigs.toDF("a", "n_a", "sig_a"), "a").join(sigs.toDF("b", "n_b", "sig_b"), "b")
    joined = joined.where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)
    passed = materialize(joined.mapInPandas(giving_back(_passing(percent)), "a bigint, b bigint"), "ngram-pairs")
    needed = materialize(
        passed.select(F.col("a").alias("rid")).union(passed.select(F.col("b").alias("rid"))).distinct(), "ngram-needed"
    )
    arrays = sets.select("rid", "shingles").join(sized(needed, needed.count()), "rid", "left_semi")
    both = passed.join(arrays.toDF("a", "set_a"), "a").join(arrays.toDF("b", "set_b"), "b")
    return materialize(both.mapInPandas(giving_back(_linked(percent)), "a bigint, b bigint"), "ngram-links")


def _across(shared: DataFrame, roots: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """a, b: pairs of one tile that are in different components and of sizes that can link, as a written table.

    The component with most rows of a tile is met by the others only, never by itself.
    """
    named = shared.select("sh", "band", "node", "n").join(roots, "node", "left")
    named = named.withColumn("root", F.coalesce("root", "node"))
    # A class is in the tile of its own band, and reaches up to that of the next.
    tiled = materialize(named.withColumn("tile", F.explode(F.array(F.col("band"), F.col("band") + 1))), "ngram-tiles")
    parts = tiled.groupBy("sh", "tile", "root").agg(F.count("node").alias("c"))
    mixed = parts.groupBy("sh", "tile").agg(
        F.count("root").alias("_roots"), F.sum("c").alias("rows"), F.max(F.struct("c", "root")).alias("_major")
    )
    mixed = mixed.where("_roots > 1").select(
        "sh", "tile", F.col("_major.root").alias("major"), "rows", (F.col("rows") - F.col("_major.c")).alias("minor_rows")
    )
    rows = materialize(tiled.join(mixed, ["sh", "tile"]).drop("band"), "ngram-mixed")
    discard(tiled)
    large = F.col("rows") * F.col("minor_rows") > TILE_PAIRS
    small_rows, large_rows = rows.where(~large), rows.where(large)
    left = small_rows.where("root <> major").select(
        "sh", "tile", F.col("node").alias("a"), F.col("n").alias("na"), F.col("root").alias("ra")
    )
    right = small_rows.select(
        "sh", "tile", F.col("node").alias("b"), F.col("n").alias("nb"), F.col("root").alias("rb"), (F.col("root") == F.col("major")).alias("big")
    )
    fits = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent
    met = left.join(right, ["sh", "tile"]).where((F.col("ra") != F.col("rb")) & (F.col("big") | (F.col("a") < F.col("b"))) & fits)
    met = met.select("a", "b").union(_within_large(large_rows, sets, percent))
    pairs = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    pairs = materialize(pairs, "ngram-across")
    discard(rows)
    return pairs


def _wide_bitmaps(sets: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, wide: signatures that leave few bits to chance, for the ``nodes`` (rid)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = [bitmap(np.frombuffer(s, dtype=np.uint64), WIDE_BITS) for s in batch["shingles"]]
            yield pd.DataFrame({"node": batch["rid"], "wide": made})

    wanted = sets.select("rid", "shingles").join(sized(nodes, nodes.count()), "rid", "left_semi")
    return wanted.mapInPandas(giving_back(run), "node bigint, wide binary")


def _folded(column: pd.Series, size: int) -> np.ndarray:
    """Signatures as rows of ``size`` bytes. Longer ones are halved by joining both halves, which keeps every bound."""
    out = np.empty((len(column), size), dtype=np.uint8)
    for i, s in enumerate(column):
        x = np.frombuffer(s, dtype=np.uint8)
        while len(x) > size:
            x = x[: len(x) // 2] | x[len(x) // 2 :]
        out[i] = x
    return out


def _meet(percent: int):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"a": [], "b": []}).astype("int64")
        if not len(left) or not len(right):
            return none
        size = min(min(map(len, left["wide"])), min(map(len, right["wide"])))
        x, y = _folded(left["wide"], size), _folded(right["wide"], size)
        common = np.zeros((len(x), len(y)), dtype=np.float32)
        for at in range(0, size, 512):
            bits = [np.unpackbits(z[:, at : at + 512], axis=1).astype(np.float32) for z in (x, y)]
            common += bits[0] @ bits[1].T
        ones = [np.bitwise_count(z).sum(axis=1, dtype=np.int64) for z in (x, y)]
        na, nb = left["n"].to_numpy(dtype=np.int64)[:, None], right["n"].to_numpy(dtype=np.int64)[None, :]
        common = common.astype(np.int64)
        most = np.minimum(na - (ones[0][:, None] - common), nb - (ones[1][None, :] - common))
        other = left["root"].to_numpy()[:, None] != right["root"].to_numpy()[None, :]
        once = right["big"].to_numpy(dtype=bool)[None, :] | (left["node"].to_numpy()[:, None] < right["node"].to_numpy()[None, :])
        i, j = np.nonzero((100 * most >= percent * (na + nb - most)) & other & once)
        return pd.DataFrame({"a": left["node"].to_numpy()[i], "b": right["node"].to_numpy()[j]})

    return run


def _within_large(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """a, b: pairs of large tiles that pass the bound of wide signatures.

    Rows of the lesser components and all rows of a tile meet in blocks of
    bounded size; a block's pairs are one matrix product.
    """
    nodes = materialize(rows.select(F.col("node").alias("rid")).distinct(), "ngram-large")
    rows = rows.join(_wide_bitmaps(sets, nodes), "node")
    blocks = [F.ceil(F.col(c) / F.lit(TILE_BLOCK)).cast("int") for c in ("minor_rows", "rows")]
    own = [F.pmod(F.xxhash64("node"), b).cast("int") for b in blocks]
    every = [F.explode(F.sequence(F.lit(0), b - 1)) for b in blocks]
    # Both sides come from one table: new columns tell them apart.
    columns = [F.col(c).alias(c) for c in ("sh", "tile", "node", "n", "root", "wide")]
    big = (F.col("root") == F.col("major")).alias("big")
    left = rows.where("root <> major").select(*columns, own[0].alias("i"), every[1].alias("j"))
    right = rows.select(*columns, big, own[1].alias("j"), every[0].alias("i"))
    keys = ["sh", "tile", "i", "j"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(_meet(percent), "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """doc_id, n_shingles, component_id, one row per document. Linked: 100 * overlap >= percent * union of the shingle sets."""
    with arrow_rows(docs.sparkSession, BATCH_ROWS):
        sets = shingle_sets(docs, width, id_column, text_column)
        groups, roots = _classes_and_roots(sets, percent)
    named = groups.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("least").alias("component"))
    named = named.join(least, "root").select("name", "component")
    return (
        sets.select("id", "n", "name")
        .join(named, "name", "left")
        .select(
            F.col("id").alias(id_column),
            F.col("n").cast("long").alias("n_shingles"),
            F.coalesce("component", "id").alias("component_id"),
        )
    )


def _classes_and_roots(sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(name, node, least, copies of each distinct set; node, root of those that have links). All of its jobs have run."""
    filled = sets.where("n > 0")
    groups = materialize(
        filled.groupBy("name").agg(F.min("rid").alias("node"), F.min("id").alias("least"), F.count("rid").alias("copies")), "ngram-classes"
    )
    copies = materialize(
        filled.select("rid", "name").join(groups.where("copies > 1").select("name", "node"), "name").where("rid <> node").select("rid"),
        "ngram-copies",
    )
    nodes = filled.join(sized(copies, copies.count()), "rid", "left_anti")
    keys = materialize(tile_keys(nodes, bucket_counts(nodes), percent), "ngram-keys")
    shared = materialize(shared_keys(keys, percent), "ngram-shared")
    discard(keys)
    first = verified(shared.where("node <> center").select(F.col("center").alias("a"), F.col("node").alias("b")).distinct(), sets, percent)
    roots = materialize(components(first), "ngram-roots")
    second = verified(_across(shared, roots, sets, percent), sets, percent)
    discard(shared)
    stars = roots.where("node <> root").select(F.col("root").alias("a"), F.col("node").alias("b"))
    return groups, components(stars.union(second))
