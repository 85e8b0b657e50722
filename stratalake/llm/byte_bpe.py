"""Byte-level BPE in linear time, with the ids that merging step by step gives.

The bytes of a piece are mapped to Latin-1 characters, and an Aho-Corasick
automaton over all tokens finds the longest token that starts at each byte. The
encoder walks from longest matches and steps back to shorter ones whenever two
adjacent tokens could not both be left over by the merges. Whether a pair can
is looked up once and remembered. Pieces repeat, so their ids are remembered
per task, too, up to a fixed number of pieces.

The vocabulary is read once on the driver. Its merges follow from the ranks; they
are under a megabyte and travel to the tasks with the function.

Defined results: a null or empty text has no ids; repeated rows are encoded
alike; an empty table gives an empty result. A text is encoded whole.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Callable

import ahocorasick
import numpy as np
import regex
from pyspark.sql import DataFrame

from stratalake.llm.common import map_texts

#: Pieces whose ids a task remembers, some 200 bytes each.
MEMO_PIECES = 1_000_000
#: A longer piece hardly comes again.
MEMO_LENGTH = 64
MEMO_PAIRS = 100_000


def read_ranks(path: str) -> list[bytes]:
    """Tokens by id, from a file of base64 tokens and ranks."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f.read().splitlines() if line.strip()]
    by_rank = {int(rank): base64.b64decode(token) for token, rank in pairs}
    return [by_rank[i] for i in range(len(by_rank))]


def merges_of(tokens: list[bytes]) -> np.ndarray:
    """For each id the two ids whose merge makes it; twice its own id where no merge does."""
    ranks = {t: i for i, t in enumerate(tokens)}
    out = np.empty((len(tokens), 2), dtype=np.int32)
    for i, token in enumerate(tokens):
        parts = [token[k : k + 1] for k in range(len(token))]
        while len(parts) > 2:
            best, at = i, -1
            for k in range(len(parts) - 1):
                rank = ranks.get(parts[k] + parts[k + 1], i)
                if rank < best:
                    best, at = rank, k
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        out[i] = (ranks[parts[0]], ranks[parts[1]]) if len(parts) == 2 else (i, i)
    return out


class Encoder:
    """Encodes pieces of text. Built once per task."""

    def __init__(self, tokens: list[bytes], merges: np.ndarray, memo_pairs: int = MEMO_PAIRS):
        self.tokens, self.memo_pairs = tokens, memo_pairs
        self.ranks = {t: i for i, t in enumerate(tokens)}
        self.lengths = [len(t) for t in tokens]
        self.left, self.right = merges[:, 0].tolist(), merges[:, 1].tolist()
        self.pairs = {(a, b): i for i, (a, b) in enumerate(zip(self.left, self.right)) if a != i}
        self.automaton = ahocorasick.Automaton()
        for i, t in enumerate(tokens):
            self.automaton.add_word(t.decode("latin-1"), i)
        self.automaton.make_automaton()
        self.shorter: dict[int, int] = {}
        self.fits: dict[tuple[int, int], bool] = {}

    def next_shorter(self, token: int) -> int:
        """The longest token that is a proper prefix of ``token``; -1 if there is none."""
        found = self.shorter.get(token)
        if found is None:
            data, found = self.tokens[token], -1
            for n in range(len(data) - 1, 0, -1):
                if (found := self.ranks.get(data[:n], -1)) >= 0:
                    break
            self.shorter[token] = found
        return found

    def compatible(self, first: int, second: int) -> bool:
        """Whether merging can leave ``first`` and ``second`` next to each other."""
        found = self.fits.get((first, second))
        if found is None:
            if len(self.fits) >= self.memo_pairs:
                self.fits.clear()
            found = self.fits[first, second] = self._compatible(first, second)
        return found

    def _compatible(self, first: int, second: int) -> bool:
        # Undo the merges on both sides of the border, the latest first. If at any
        # time the tokens at the border had a merge that came earlier than the one
        # just undone, merging would have crossed the border.
        limit = len(self.tokens) + 1
        while True:
            joint = self.pairs.get((first, second))
            if joint is not None and joint < limit:
                return False
            split_first = self.left[first] != first and first > second
            if not split_first and self.left[second] == second:
                if self.left[first] == first:
                    return True
                split_first = True
            if split_first:
                limit, first = first, self.right[first]
            else:
                # Of equal ranks the left one is merged first, so an equal merge at the border counts as earlier.
                limit, second = second + 1, self.left[second]

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        lengths, fits, compatible, next_shorter = self.lengths, self.fits, self.compatible, self.next_shorter
        # Matches come by ascending end, so the last one written for a start is its longest.
        longest = [-1] * n
        for end, token in self.automaton.iter(piece.decode("latin-1")):
            longest[end + 1 - lengths[token]] = token
        ids: list[int] = []
        open_ends = bytearray(b"\x01") * (n + 1)
        at, token = 0, longest[0]
        while True:
            end = at + lengths[token]
            if open_ends[end]:
                if not ids:
                    fit = True
                else:
                    fit = fits.get((ids[-1], token))
                    if fit is None:
                        fit = compatible(ids[-1], token)
                if fit:
                    ids.append(token)
                    if end == n:
                        return ids
                    at, token = end, longest[end]
                    continue
            token = next_shorter(token)
            while token < 0:
                # Nothing that starts here follows the last token: its end is a dead end.
                open_ends[at] = 0
                token = ids.pop()
                at -= lengths[token]
                token = next_shorter(token)


class _Memo(dict):
    """Packed ids of pieces, in two generations."""

    def __init__(self, encoder: Encoder, pieces: int):
        super().__init__()
        self.encoder, self.half, self.older = encoder, max(1, pieces // 2), {}

    def __missing__(self, piece: str) -> bytes:
        packed = self.older.get(piece)
        if packed is None:
            ids = self.encoder.encode(piece.encode("utf-8"))
            packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= MEMO_LENGTH:
            if len(self) >= self.half:
                self.older = dict(self)
                self.clear()
            self[piece] = packed
        return packed


def text_encoder(
    tokens: list[bytes], merges: np.ndarray, pattern: str, memo_pieces: int = MEMO_PIECES, memo_pairs: int = MEMO_PAIRS
) -> Callable[[str | None], bytes]:
    """A function from a text to its ids as little-endian unsigned 32-bit integers."""
    find = regex.compile(pattern).findall
    ids_of = _Memo(Encoder(tokens, merges, memo_pairs), memo_pieces).__getitem__

    def encode(text: str | None) -> bytes:
        return b"".join(map(ids_of, find(text))) if text else b""

    return encode


def unpack(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, dtype="<u4")


def decode(packed: bytes, tokens: list[bytes]) -> bytes:
    return b"".join(map(tokens.__getitem__, unpack(packed).tolist()))


def encode_texts(
    df: DataFrame, path: str, pattern: str, column: str = "text", into: str = "ids", memo_pieces: int = MEMO_PIECES,
    memo_pairs: int = MEMO_PAIRS,
) -> DataFrame:
    """``df`` with the ids of ``column`` in ``into``, an array of int. One pass; no row is moved.

    A task remembers the ids of ``memo_pieces`` pieces and, of ``memo_pairs`` pairs
    of tokens, whether they can be neighbours. Fewer take less memory and more time.
    """
    tokens = read_ranks(path)
    merges = merges_of(tokens)

    def of():
        encode = text_encoder(tokens, merges, pattern, memo_pieces, memo_pairs)
        return lambda texts: [(unpack(encode(text)).astype(np.int32),) for text in texts]

    return map_texts(df, column, {into: "array<int>"}, of)


def decode_ids(df: DataFrame, path: str, column: str = "ids", into: str = "decoded") -> DataFrame:
    """``df`` with the bytes that the ids in ``column`` stand for, in ``into``."""
    tokens = read_ranks(path)

    def of():
        return lambda rows: [(b"" if ids is None else b"".join(tokens[i] for i in ids),) for ids in rows]

    return map_texts(df, column, {into: "binary"}, of)


def round_trip(df: DataFrame, path: str, pattern: str, column: str = "text") -> DataFrame:
    """``df`` with n_tokens, ids_sha256 and decoded_sha256 of ``column``: encoded, then decoded from the ids alone."""
    tokens = read_ranks(path)
    merges = merges_of(tokens)

    def of():
        encode = text_encoder(tokens, merges, pattern)

        def digests(text):
            packed = encode(text)
            back = decode(packed, tokens)
            return len(packed) // 4, hashlib.sha256(packed).hexdigest(), hashlib.sha256(back).hexdigest()

        return lambda texts: [digests(text) for text in texts]

    return map_texts(df, column, {"n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}, of)
