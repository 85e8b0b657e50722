"""Secrets in texts: three fixed patterns, and a battery of randomness tests for what no pattern names.

A candidate of the battery is a run of 20 or more characters of the usual
encodings. Its encoding is the smallest alphabet that holds it. Three statistics
are taken over that alphabet: chi-squared against equal shares, runs of character
classes, and the serial correlation of neighbours. Fisher's method makes them one
p-value, that of the candidate as random data. Then it is judged as something
people write, by the same three traits (shares of letters, changes of class,
letter pairs) in a model of written text: how much likelier equal shares of the
alphabet make it than the model does. One over that ratio is a p-value, as the
ratio's mean over what the model writes is 1. Both go through the
Benjamini-Hochberg procedure over a text's candidates, with weights in proportion
to length, as a long candidate carries more evidence. A secret is what is not
discovered as unlike random data, and is discovered as unlike written text; so
each kind of false discovery is held at its share.

The model's letter pairs are counted over all texts of the table, candidates left
out, in one pass that gives 27 x 27 numbers. Names in programs are written text
too, so the pairs of the sources of Python's standard library, as installed with
the driver, have a share; where a table has few letters, they stand in for it.

Defined results: a null or empty text has no spans; offsets count code points,
ends are exclusive; what a pattern's span covers of a candidate is left to that
span, and the rest is tested by itself; digits alone are a number;
repeated rows are judged alike, as a text is judged by itself but for the
table's letter pairs; an empty table gives an empty result. Texts are read whole.
"""

from __future__ import annotations

import functools
import math
import os
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import free_name, giving_back, map_texts

#: In the order in which spans of the same start are listed.
KINDS = ("assign", "access", "hex", "random")
BASE_KINDS = KINDS[:3]
#: Fixed values of the patterns. Case is ignored among ASCII letters only.
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_VALUE, ACCESS_LENGTH = 6, 20

CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
#: False discoveries among those of written text as secrets, and of random data as no secrets.
FALSE_SHARE, RANDOM_SHARE = 0.001, 0.001
#: Written text: how often neighbours change between digits, letters and signs, and how often a letter after one of either case is upper.
KIND_CHANGES, UPPER_AFTER_LOWER, UPPER_AFTER_UPPER, UPPER_FIRST = 0.15, 0.07, 0.5, 0.4
#: Shares of the texts, of program sources and of equal chances in the letter pairs of written text. A letter's row of
#: pairs counts as much as so many pairs of the sources.
TEXT_SHARE, SOURCE_SHARE, EQUAL_SHARE = 0.6, 0.3, 0.1
PRIOR_PAIRS = 1_000
#: Alphabets from the smallest.
_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ALPHABETS = (
    ("hex", _DIGITS + "abcdef"),
    ("HEX", _DIGITS + "ABCDEF"),
    ("lower26", _LOWER),
    ("upper26", _UPPER),
    ("base32", _UPPER + "234567"),
    ("lower36", _DIGITS + _LOWER),
    ("upper36", _DIGITS + _UPPER),
    ("letters52", _UPPER + _LOWER),
    ("base62", _DIGITS + _UPPER + _LOWER),
    ("base64", _UPPER + _LOWER + _DIGITS + "+/"),
    ("base64url", _UPPER + _LOWER + _DIGITS + "-_"),
)
_SETS = [(name, frozenset(chars), {c: i for i, c in enumerate(chars)}) for name, chars in ALPHABETS]
_CLASS = {c: k for k, chars in enumerate((_DIGITS, _LOWER, _UPPER)) for c in chars}
_SHARES = {
    name: [sum(_CLASS.get(c, 3) == k for c in chars) / len(chars) for k in range(4)] for name, chars in ALPHABETS
}


def letter_pairs(texts: list[str]) -> np.ndarray:
    """How often each letter (column) follows each (row) in the texts without their candidates; 26 is anything else."""
    code = np.full(256, 26, dtype=np.int64)
    for i, c in enumerate(_LOWER):
        code[ord(c)] = code[ord(c.upper())] = i
    written = " ".join(["", *[CANDIDATE.sub(" ", t) for t in texts]])
    at = code[np.frombuffer(written.encode(errors="replace"), dtype=np.uint8)]
    return np.bincount(at[:-1] * 27 + at[1:], minlength=27 * 27).reshape(27, 27)


@functools.cache
def source_pairs() -> np.ndarray:
    """Letter pairs of the modules of the standard library."""
    modules = sorted(Path(os.__file__).parent.glob("*.py"))
    return sum((letter_pairs([m.read_text(encoding="utf-8", errors="replace")]) for m in modules), np.zeros((27, 27), dtype=np.int64))


def corpus_pairs(df: DataFrame, column: str = "text") -> np.ndarray:
    """Letter pairs of all texts of a column."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((27, 27), dtype=np.int64)
        for batch in batches:
            texts = [t for t in batch["t"] if t]
            for at in range(0, len(texts), 64):
                total += letter_pairs(texts[at : at + 64])
        yield pd.DataFrame({"pair": np.arange(total.size, dtype=np.int32), "c": total.ravel()})

    counted = df.select(F.col(f"`{column}`").alias("t")).mapInPandas(giving_back(run), "pair int, c bigint")
    out = np.zeros(27 * 27, dtype=np.int64)
    for r in counted.groupBy("pair").agg(F.sum("c").alias("c")).collect():
        out[r["pair"]] = r["c"]
    return out.reshape(27, 27)


def written_costs(pairs: np.ndarray | None = None) -> dict[tuple[str, str], float]:
    """-log2 of the chance of a character after another ("" before the first one) in written text with such letter pairs."""
    signs = "+/-_"
    source = source_pairs()[:, :26].astype(float)
    source /= np.maximum(source.sum(axis=1, keepdims=True), 1)
    found = (np.zeros((27, 26)) if pairs is None else pairs[:, :26]) + PRIOR_PAIRS * source
    found /= np.maximum(found.sum(axis=1, keepdims=True), 1)
    mixed = TEXT_SHARE * found + SOURCE_SHARE * source + EQUAL_SHARE / 26
    letters = (mixed / mixed.sum(axis=1, keepdims=True)).tolist()

    def kind(c: str) -> int:
        return 0 if c in _DIGITS else 2 if c in signs else 1

    def chance(before: str, c: str) -> float:
        share = 1 / 3 if not before else 1 - KIND_CHANGES if kind(before) == kind(c) else KIND_CHANGES / 2
        if kind(c) != 1:
            return share / (10 if kind(c) == 0 else 2)  # an alphabet has two signs
        follows = bool(before) and kind(before) == 1
        upper = UPPER_FIRST if not follows else UPPER_AFTER_UPPER if before in _UPPER else UPPER_AFTER_LOWER
        row = letters[_LOWER.index(before.lower()) if follows else 26]
        return share * row[_LOWER.index(c.lower())] * (upper if c in _UPPER else 1 - upper)

    every = _DIGITS + _UPPER + _LOWER + signs
    return {(a, b): -math.log2(chance(a, b)) for a in ["", *every] for b in every}


@functools.cache
def _source_costs() -> dict[tuple[str, str], float]:
    return written_costs()


def _below(z: float) -> float:
    """Probability that a standard normal value is at most ``z``."""
    return 0.5 * math.erfc(-z / math.sqrt(2))


def _normal_of_chi2(x: float, k: int) -> float:
    """A chi-squared value with ``k`` degrees of freedom as a standard normal value (Wilson and Hilferty)."""
    return ((x / k) ** (1 / 3) - (1 - 2 / (9 * k))) / math.sqrt(2 / (9 * k))


def battery(token: str, costs: dict[tuple[str, str], float]) -> tuple[float, float] | None:
    """(p as random data, p as written by people) of a candidate; None if no alphabet holds it or it is a number."""
    body = token.rstrip("=")
    if body.isdigit():
        return None
    chars = set(body)
    for name, members, code in _SETS:
        if chars <= members:
            break
    else:
        return None
    n, k = len(body), len(members)
    counts = [body.count(c) for c in chars]
    chi2 = sum(x * x for x in counts) * k / n - n
    chi_random = _normal_of_chi2(max(chi2, 1e-9), k - 1)
    ps = [_below(-chi_random)]

    classes = [_CLASS.get(c, 3) for c in body]
    changes = sum(a != b for a, b in zip(classes, classes[1:]))
    share = 1 - sum(s * s for s in _SHARES[name])
    if share:  # letters of one case have one class, so their runs say nothing
        runs_random = (changes - (n - 1) * share) / math.sqrt((n - 1) * share * (1 - share))
        ps.append(2 * _below(-abs(runs_random)))

    codes = [code[c] for c in body]
    mean = sum(codes) / n
    spread = sum((c - mean) ** 2 for c in codes)
    serial = sum((a - mean) * (b - mean) for a, b in zip(codes, codes[1:])) / spread if spread else 1.0
    serial_random = (serial + 1 / n) * math.sqrt(n)

    ps.append(2 * _below(-abs(serial_random)))
    fisher = -2 * sum(math.log(max(p, 1e-300)) for p in ps)
    as_random = _below(-_normal_of_chi2(max(fisher, 1e-9), 2 * len(ps)))
    written = sum(costs[pair] for pair in zip(["", *body], body))
    as_written = 2 ** min(0.0, n * math.log2(k) - written)
    return as_random, as_written


def discoveries(tests: list[tuple[int, float]], share: float = FALSE_SHARE) -> list[bool]:
    """Weighted Benjamini-Hochberg over (length, p): which hypotheses are rejected."""
    if not tests:
        return []
    mean = sum(n for n, _ in tests) / len(tests)
    weighted = [p * mean / n for n, p in tests]
    limit = -1.0
    for rank, p in enumerate(sorted(weighted), 1):
        if p <= share * rank / len(tests):
            limit = p
    return [p <= limit for p in weighted]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the patterns' matches, by start and kind."""
    out = []
    if "=" in text or ":" in text:
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_VALUE]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LENGTH]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """(start, end) of the candidates, without what the patterns' spans cover of them."""
    covered: list[list[int]] = []
    for start, _, end in base:
        if covered and start <= covered[-1][1]:
            covered[-1][1] = max(covered[-1][1], end)
        else:
            covered.append([start, end])
    out, at = [], 0
    for m in CANDIDATE.finditer(text):
        start = m.start()
        while at < len(covered) and covered[at][0] < m.end():
            if rest := CANDIDATE.fullmatch(text, start, max(start, covered[at][0])):
                out.append(rest.span())
            start = max(start, covered[at][1])
            if start >= m.end():
                break
            at += 1
        if start < m.end() and (rest := CANDIDATE.fullmatch(text, start, m.end())):
            out.append(rest.span())
    return out


def all_spans(text: str | None, costs: dict[tuple[str, str], float] | None = None) -> list[tuple[int, int, int]]:
    """The patterns' spans and those the battery adds, by start and kind. Without ``costs`` written text is program sources."""
    if not text:
        return []
    base = base_spans(text)
    found = []
    for start, end in candidates(text, base):
        if p := battery(text[start:end], _source_costs() if costs is None else costs):
            found.append((start, end, *p))
    unlike_random = discoveries([(e - s, p) for s, e, p, _ in found], RANDOM_SHARE)
    unlike_written = discoveries([(e - s, p) for s, e, _, p in found])
    added = [(s, 3, e) for (s, e, *_), plain, secret in zip(found, unlike_random, unlike_written) if secret and not plain]
    return sorted(base + added)


def scan(df: DataFrame, column: str = "text", into: str = "spans") -> DataFrame:
    """``df`` with ``into``: array of (kind, start, end) by start and kind."""

    costs = written_costs(corpus_pairs(df, column))

    def of():
        return lambda texts: [([(KINDS[k], s, e) for s, k, e in all_spans(t, costs)],) for t in texts]

    return map_texts(df, column, {into: "array<struct<kind:string,start:bigint,end:bigint>>"}, of)


def listed(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def of_kind(spans: Column, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def redact(df: DataFrame, column: str = "text", mark: str = "<SECRET>") -> DataFrame:
    """``df`` with every span of ``column`` replaced by ``mark``; spans that meet are replaced as one."""
    field, kept = df.columns, free_name(df, "_redacted")
    costs = written_costs(corpus_pairs(df, column))

    def clean(text: str | None) -> str | None:
        if not text or not (spans := all_spans(text, costs)):
            return text
        out, at = [], 0
        for start, _, end in spans:
            if start >= at:
                out += [text[at:start], mark]
            at = max(at, end)
        return "".join(out) + text[at:]

    made = map_texts(df, column, {kept: "string"}, lambda: lambda texts: [(clean(t),) for t in texts])
    return made.select(*[F.col(kept).alias(c) if c == column else F.col(f"`{c}`") for c in field])
