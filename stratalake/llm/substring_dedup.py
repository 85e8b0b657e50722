"""Removes passages that stand earlier in the corpus, found through recompression.

Words are symbols. A round joins every pair of a left and the right symbol next to it,
where a symbol's side follows from its name, and then makes one symbol of every
run of equal ones that no pair took. The new names are hashes of what they stand for, so they
are the same in every task and the rounds need no exchange. Whether a symbol
arises depends on a known stretch of words: a pair on its own, all else on its
neighbours, too. Wherever this stretch stands, the symbol stands.

Every window of ``width`` words therefore holds the same symbols wherever it is,
and is filed under one of them: of the last round that has a symbol whose
stretch lies within the window, the first. Neighbouring windows share it, so what
is exchanged is one symbol with its place for several windows, and a short hash of
each. Windows that no symbol of the second round fits into are filed under
themselves. Partitions by symbol then compare the windows of equal symbols and
tell which of them stand earlier.

Equal windows of one task's batch are settled there, so the commonest passage
reaches a partition once a batch, and a partition holds each different
window once while the others stream by: no passage is too frequent for a task.
Very long texts pass in overlapping pieces; a window lies in one of them whole,
and what it is filed under does not depend on the piece.

Names have 64 bits and windows 48 more; different windows that agree in all of
them would count as equal, at a chance below 1e-9 for a corpus of 1e12 words.

Defined results: a null, empty or blank text has no words; a text shorter than the
window loses nothing. Documents are ordered by id, those that share an id by a
hash of their text, those without id last, by such a hash; rows equal in id and
text count as one document and get the same result. An empty table gives an empty
result. Columns that have the names of new ones are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import arrow_rows, materialize

WIDTH = 20
#: Text that a task works on at once, in bytes; pieces of very long texts, in words.
BATCH_BYTES, PIECE_WORDS = 6 << 20, 1 << 18
#: Windows that a partition gets to compare, on average.
PARTITION_WINDOWS = 1 << 20
#: Symbols of earlier rounds are too common to file under, and of later ones rarely lie in a window; so many windows share one on average: 5.
FIRST_ROUND, LAST_ROUND = 2, 4
_HASH_BYTES = 1 << 20
_FAR = 1 << 40

_GAP = np.zeros(256, bool)
_GAP[[0x20, *range(0x09, 0x0E)]] = True
_rng = np.random.default_rng(20)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_BASE, _BASE2 = 0x9E3779B97F4A7C15 | 3, 0xD1342543DE82EF95
_u = np.uint64


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Powers:
    """Powers of a base modulo 2**64 and of its inverse, as many as were asked for."""

    def __init__(self, base: int):
        self.base, self.up, self.down = base, np.ones(1, np.uint64), np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = _powers(self.base, n), _powers(pow(self.base, -1, 1 << 64), n)
        return self.up, self.down


def _mixed(x: np.ndarray) -> np.ndarray:
    """Each 64-bit number to another, with all bits stirred."""
    x = (x ^ (x >> _u(30))) * _u(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _u(27))) * _u(0x94D049BB133111EB)
    return x ^ (x >> _u(31))


class Words:
    """Hashes of the words of a text in UTF-8."""

    def __init__(self):
        self.powers = _Powers(_BASE)

    def hashes(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(hash, first byte) of each word."""
        found, begins, at = [], [], 0
        data = np.frombuffer(text, np.uint8)
        while at < len(data):
            end = min(len(data), at + _HASH_BYTES)
            # Parts end at gaps, however long the last word is.
            while end < len(data) and not _GAP[data[end]]:
                more = _GAP[data[end : end + _HASH_BYTES]]
                end += int(more.argmax()) if more.any() else len(more)
            part = data[at:end]
            inside = np.concatenate([[False], ~_GAP[part], [False]])
            edges = np.flatnonzero(inside[1:] != inside[:-1])
            first, last = edges[::2], edges[1::2]
            up, down = self.powers.to(len(part) + 1)
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(_BYTE[part] * up[: len(part)], out=sums[1:])
            found.append(_mixed((sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64)))
            begins.append(first + at)
            at = end
        if not found:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        return np.concatenate(found), np.concatenate(begins)


class _Symbols:
    """The symbols of one round: names, the stretch of words each depends on, and the document of each."""

    def __init__(self, name, low, high, doc):
        self.name, self.low, self.high, self.doc = name, low, high, doc

    def __len__(self):
        return len(self.name)

    def next(self, number: int) -> tuple["_Symbols", np.ndarray]:
        """The symbols of the next round, and which of them are new."""
        name, low, high, doc = self.name, self.low, self.high, self.doc
        n = len(name)
        right = (_mixed(name + _u(number)) >> _u(63)).astype(bool)
        beside = doc[1:] == doc[:-1]
        paired = np.zeros(n, bool)
        paired[:-1] = beside & ~right[:-1] & right[1:]
        second = np.zeros(n, bool)
        second[1:] = paired[:-1]
        single = ~(paired | second)
        # Runs of equal symbols that no pair took.
        follows = np.zeros(n, bool)
        follows[1:] = beside & single[1:] & single[:-1] & (name[1:] == name[:-1])
        head = np.flatnonzero(~follows & ~second)
        tail = np.append(head[1:], n) - 1
        length = tail - head + 1
        pair = paired[head]
        run = ~pair & (length > 1)
        new_name = name[head].copy()
        new_name[pair] = _mixed(name[head][pair] * _u(3) + _mixed(name[head + pair][pair] + _u(7)))
        new_name[run] = _mixed(name[head][run] * _u(5) + length[run].astype(np.uint64))
        # A pair depends on its halves only, anything else also on its neighbours; without one, on what no window shows.
        alone = ~pair

        def beyond(end, step):
            """The neighbour in direction ``step``, and whether there is one; past an equal one, which a pair took, the next."""
            next_ = np.clip(end + step, 0, n - 1)
            there = (next_ != end) & (doc[next_] == doc[end])
            equal = there & (name[next_] == name[end])
            further = np.clip(next_ + step, 0, n - 1)
            there &= ~equal | ((further != next_) & (doc[further] == doc[end]))
            return np.where(equal, further, next_), there

        before, has_before = beyond(head, -1)
        after, has_after = beyond(tail, 1)
        new_low = np.where(alone, np.where(has_before, low[before], -_FAR), low[head])
        new_high = np.where(alone, np.where(has_after, high[after], _FAR), high[tail])
        return _Symbols(new_name, new_low, new_high, doc[head]), pair | run


def _spans(sums, down, low, high) -> np.ndarray:
    return (sums[high] - sums[low]) * down[low]


def _windows(hashes: np.ndarray, doc: np.ndarray, width: int, powers: _Powers):
    """(place, name, lead, short): every window's first word, the symbol it is filed under, how far in this begins, and the window's hash."""
    n = len(hashes)
    place = np.arange(max(0, n - width + 1))
    place = place[doc[place] == doc[place + width - 1]] if len(place) else place
    up, down = powers.to(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * up[:n], out=sums[1:])
    whole = _mixed(_spans(sums, down, place, place + width))
    name, lead = _mixed(whole + _u(11)), np.zeros(len(place), np.int64)
    symbols = _Symbols(hashes, np.arange(n), np.arange(1, n + 1), doc)
    for number in range(1, LAST_ROUND + 1) if len(place) else ():
        symbols, new = symbols.next(number)
        new &= symbols.high - symbols.low <= width
        if number < FIRST_ROUND or not new.any():
            continue
        low, high = symbols.low[new], symbols.high[new]
        # Both ends of the stretches ascend, so the first that begins within a window is the first to end.
        first = np.cumsum(np.bincount(low + 1, minlength=n + 2))[place]
        there = first < len(low)
        first = np.where(there, first, 0)
        there &= high[first] <= place + width
        named = _mixed(_spans(sums, down, low, high) + _u((number << 32) % (1 << 64)) + (high - low).astype(np.uint64))
        name[there], lead[there] = named[first[there]], (low[first] - place)[there]
    return place, name, lead, whole >> _u(16)


def _keys(name: np.ndarray, lead: np.ndarray, short: np.ndarray) -> np.ndarray:
    return _mixed(name + lead.astype(np.uint64) * _u(0x9E3779B97F4A7C15)) ^ _mixed(short)


def _later(key, doc, tail, place) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, new, gone): windows by key, which of them begin a key, and which come later than their key's first."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    several = np.zeros(len(key), bool)
    several[:-1] |= ~new[1:]
    several[1:] |= ~new[1:]
    at = order[several]
    # Rows without id have a tail of -1 and come last.
    order[several] = at[np.lexsort((place[at], tail[at], doc[at], tail[at] < 0, key[several]))]
    doc, tail, place = doc[order], tail[order], place[order]
    group = np.flatnonzero(new)[np.cumsum(new) - 1]
    return order, new, (doc != doc[group]) | (tail != tail[group]) | (place != place[group])


class _Firsts:
    """The first place of every window seen so far."""

    def __init__(self):
        self.rows = [np.zeros(0, t) for t in (np.uint64, np.int64, np.int32, np.int32)]

    def add(self, *more: np.ndarray) -> list[np.ndarray]:
        """(doc, tail, place) of windows that are not the first of their kind. ``more``: key, doc, tail, place."""
        rows = [np.concatenate(x) for x in zip(self.rows, more)]
        order, new, gone = _later(*rows)
        self.rows = [x[order[new]] for x in rows]
        return [x[order[gone]] for x in rows[1:]]


def _runs(doc, tail, place) -> list[np.ndarray]:
    """(doc, tail, first, n): consecutive places as one."""
    order = np.lexsort((place, tail, doc))
    doc, tail, place = doc[order].astype(np.int64), tail[order].astype(np.int32), place[order].astype(np.int32)
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (tail[1:] != tail[:-1]) | (place[1:] != place[:-1] + 1)
    first = np.flatnonzero(new)
    return [doc[first], tail[first], place[first], np.diff(np.append(first, len(doc))).astype(np.int32)]


#: What a task hands on: numbers of many symbols in one value. name, doc, tail, place, lead, n: of a symbol; short: six bytes of each of its windows.
_PACKED = {"name": "<u8", "doc": "<i8", "tail": "<i4", "place": "<i4", "lead": "<u2", "n": "<u2", "short": "V6"}
#: Windows settled within a task.
_SETTLED = {"gone_doc": "<i8", "gone_tail": "<i4", "gone_first": "<i4", "gone_n": "<i4"}
_SCHEMA = "bucket int, " + ", ".join(f"{c} binary" for c in (*_PACKED, *_SETTLED))


def _binary(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """One value for each stretch of ``values`` between two ``offsets``."""
    offsets = (offsets * values.dtype.itemsize).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _filed(rows: list[tuple[int, int, bytes]], width: int, buckets: int, words: Words, powers: _Powers) -> pa.RecordBatch | None:
    """All windows of a batch of documents (doc, tail, text), by bucket."""
    found, begins = words.hashes(b" ".join(t for _, _, t in rows))
    if not len(found):
        return None
    ends = np.cumsum([len(t) + 1 for _, _, t in rows])
    of = np.searchsorted(ends, begins, side="right")
    start = np.searchsorted(of, np.arange(len(rows)))
    docs, tails = np.array([d for d, _, _ in rows], np.int64), np.array([t for _, t, _ in rows], np.int32)
    parts = []
    for a in range(0, len(found), PIECE_WORDS):
        # All windows that begin within the piece.
        piece = slice(a, a + PIECE_WORDS + width - 1)
        place, *more = _windows(found[piece], of[piece], width, powers)
        parts.append((place + a, *more))
    place, name, lead, short = (np.concatenate(x) for x in zip(*parts))
    if not len(place):
        return None
    row = of[place]
    inside = (place - start[row]).astype(np.int32)
    order, _, later = _later(_keys(name, lead, short), docs[row], tails[row], inside)
    settled = order[later]
    gone = _runs(docs[row[settled]], tails[row[settled]], inside[settled])
    # What stays of a symbol's windows stays together.
    stays = np.ones(len(place), bool)
    stays[settled] = False
    place, name, lead, short, row, inside = (x[stays] for x in (place, name, lead, short, row, inside))
    new = np.ones(len(place), bool)
    new[1:] = (name[1:] != name[:-1]) | (place[1:] != place[:-1] + 1) | (lead[1:] != lead[:-1] - 1)
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(place)))
    bucket = (name[first] % _u(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    first, n, bucket = first[order], n[order], bucket[order]
    edges = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])[: len(bucket)]), len(bucket))
    after = np.append(0, np.cumsum(n))
    every = np.repeat(first - after[:-1], n) + np.arange(after[-1])
    six = np.ascontiguousarray(short[every].astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :6]
    values = {
        "name": name[first], "doc": docs[row[first]], "tail": tails[row[first]], "place": inside[first], "lead": lead[first], "n": n,
        "short": np.ascontiguousarray(six).reshape(-1).view("V6"),
    }
    columns = [pa.array(bucket[edges[:-1]], pa.int32())]
    for c, kind in _PACKED.items():
        columns.append(_binary(values[c].astype(kind), after[edges] if c == "short" else edges))
    # What was settled here goes along with the first bucket.
    if not len(bucket):
        columns = [pa.array([0], pa.int32()), *[pa.array([b""], pa.binary()) for _ in _PACKED]]
        edges = np.array([0, 0])
    for (c, kind), value in zip(_SETTLED.items(), gone):
        offsets = np.full(len(edges), len(value))
        offsets[0] = 0
        columns.append(_binary(value.astype(kind), offsets))
    return pa.RecordBatch.from_arrays(columns, ["bucket", *_PACKED, *_SETTLED])


def _file(width: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, powers = Words(), _Powers(_BASE2)
        rows, size = {}, 0
        for batch in batches:
            for doc, tail, text in zip(batch.column("doc").to_pylist(), batch.column("tail").to_pylist(), batch.column("text")):
                data = text.as_buffer().to_pybytes()
                # Equal rows are one document.
                if (doc, tail) not in rows:
                    rows[doc, tail] = data
                    size += len(data)
                if size >= BATCH_BYTES:
                    made = _filed([(*k, t) for k, t in rows.items()], width, buckets, words, powers)
                    rows, size = {}, 0
                    if made:
                        yield made
        made = _filed([(*k, t) for k, t in rows.items()], width, buckets, words, powers) if rows else None
        if made:
            yield made

    return run


_GONE = "doc bigint, tail int, first int, n int"


def _unpacked(batch: pa.RecordBatch, names: dict[str, str]) -> list[np.ndarray]:
    return [np.frombuffer(b"".join(v.as_buffer() for v in batch.column(c)), kind) for c, kind in names.items()]


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows that are not the first of their kind, as stretches of a document."""
    firsts, waiting, size = _Firsts(), [], 0

    def out(columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["doc", "tail", "first", "n"])

    def settled() -> pa.RecordBatch:
        nonlocal waiting, size
        gone = firsts.add(*(np.concatenate(x) for x in zip(*waiting)))
        waiting, size = [], 0
        return out(_runs(*gone))

    for batch in batches:
        *settled_there, = _unpacked(batch, _SETTLED)
        if len(settled_there[0]):
            yield out(settled_there)
        name, doc, tail, place, lead, n, short = _unpacked(batch, _PACKED)
        if not len(name):
            continue
        n = n.astype(np.int64)
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        eight = np.zeros((len(short), 8), np.uint8)
        eight[:, :6] = short.view(np.uint8).reshape(-1, 6)
        key = _keys(np.repeat(name, n), np.repeat(lead.astype(np.int64), n) - step, eight.reshape(-1).view("<u8"))
        waiting.append((key, np.repeat(doc, n), np.repeat(tail, n), (np.repeat(place, n) + step).astype(np.int32)))
        size += len(key)
        if size >= PARTITION_WINDOWS:
            yield settled()
    if waiting:
        yield settled()


def repeated(docs: DataFrame, width: int, partition_windows: int = PARTITION_WINDOWS) -> DataFrame:
    """doc, tail, first, n: stretches of windows that stand earlier, too. ``docs`` has doc, tail, text (never null)."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # A word and its gap take six bytes or so.
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // (6 * partition_windows)))
    filed = docs.select("doc", "tail", "text").mapInArrow(_file(width, partitions), _SCHEMA)
    # Values hold many symbols each, so few of them make a batch.
    with arrow_rows(spark, 64):
        return materialize(filed.repartitionById(partitions, "bucket").mapInArrow(_settle, _GONE), "repeated-windows")


def _kept(width: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for text, gone in zip(batch.column("text"), batch.column("gone")):
                words = text.as_buffer().to_pybytes().split()
                n = len(words)
                if gone.is_valid:
                    mask = bytearray(b"\x01") * n
                    for part in gone.as_py():
                        last = part["first"] + part["n"] - 1 + width
                        mask[part["first"] : last] = bytes(last - part["first"])
                    words = list(compress(words, mask))
                made.append((n, n - len(words), b" ".join(words)))
            columns = [batch.column(c) for c in names]
            columns += [pa.array([m[i] for m in made], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.binary()))]
            yield pa.RecordBatch.from_arrays(columns, [*names, "n_words", "n_removed", "kept"])

    return run


def remove_repeats(docs: DataFrame, width: int = WIDTH, id_column: str = "doc_id", column: str = "text") -> DataFrame:
    """``docs`` with n_words, n_removed and, in ``column``, the words that are left, joined by one space."""
    text = F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))
    own, code = F.col(f"`{id_column}`").cast("long"), F.xxhash64(text)
    # Rows without id are named by their text, which a tail of -1 tells.
    tail = F.when(own.isNull(), -1).otherwise(code.bitwiseAND(F.lit(0x7FFFFFFF))).cast("int")
    key = (F.coalesce(own, code).alias("doc"), tail.alias("tail"), text.alias("text"))
    gone = repeated(docs.select(*key), width).groupBy("doc", "tail").agg(F.collect_list(F.struct("first", "n")).alias("gone"))
    others = [c for c in docs.columns if c not in (column, "n_words", "n_removed")]
    # Numbered names on the way: any name may stand in the table.
    names = [f"c{i}" for i in range(len(others))]
    rows = docs.select(*key, *[F.col(f"`{c}`").alias(n) for n, c in zip(names, others)]).join(gone, ["doc", "tail"], "left")
    schema = [f"{n} {docs.schema[c].dataType.simpleString()}" for n, c in zip(names, others)]
    schema += ["n_words bigint", "n_removed bigint", "kept binary"]
    found = rows.drop("doc", "tail").mapInArrow(_kept(width, names), ", ".join(schema))
    renamed = [F.col(n).alias(c) for n, c in zip(names, others)]
    return found.select(*renamed, F.col("kept").cast("string").alias(column), "n_words", "n_removed")
