"""Language identification in two steps: the family first, then the languages within it.

A text becomes the hashed shares of its letter trigrams (bytes of the lower-cased
letters, anything else a blank). Linear support vector machines, one against one,
vote for a family; those that separate the languages of the winning family, one
against one, vote for the language. A family of more than ``FAMILY_SIZE`` members is halved, by the
direction in which their mean vectors differ most, until no part has more, and
so are the families; each part is one more step. So every language is learned, and machines
grow in proportion to the languages and not to their square.

The machines are fitted on a bounded sample of labelled texts (``FIT_ROWS``,
shared equally among the languages, those of the lowest hashes, each text once
however often it stands in the table), one group of rows for each pair.
Prediction covers every whole text.

Defined results: ties between languages go to the first by name; columns of the names asked for are replaced; a null text, or one without a letter, is ``und`` with score 0;
with no labelled row every text is ``und``; with one language every other text is
of it; rows without a language teach nothing; equal texts are judged alike; an
empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.common import arrow_rows, giving_back, map_texts, materialize, sized

UNDETERMINED = "und"
#: At most so many labelled texts fit the machines, or one for each language if there are more languages.
FIT_ROWS = 4_000
#: So many members of a family are told apart in one step.
FAMILY_SIZE = 16
DIMENSIONS = 4096
#: Rows in a batch for Python while fitting.
BATCH_ROWS = 1_000
#: Families by two-letter code. A language that is not listed is a family of its own, while there are few.
FAMILIES = {
    "germanic": "af da de en fo fy is lb nb nl nn no sv yi",
    "romance": "ca co es fr gl it la lmo oc pms pt rm ro sc scn wa",
    "slavic": "be bg bs cs hr hsb mk pl ru sk sl sr szl uk",
    "baltic": "lt lv ltg",
    "celtic": "br cy ga gd gv kw",
    "indic": "as bn gu hi mr ne or pa sa si ur",
    "iranian": "ckb fa ku os ps tg",
    "turkic": "az ba cv kk ky sah tk tr tt ug uz",
    "uralic": "et fi hu kv mhr se",
    "semitic": "am ar arz he mt ti",
    "austronesian": "ceb id jv mg mi ms su tl war",
    "dravidian": "kn ml ta te",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

_NO_LETTERS = re.compile(r"[\W\d_]+")


def family_of(language: str) -> str:
    return FAMILY_OF.get(language.lower().replace("_", "-").split("-")[0], language)


def shares(text: str | None, dimensions: int = DIMENSIONS) -> np.ndarray | None:
    """Square roots of the shares of the hashed trigrams, a vector of length 1; None without a letter."""
    if not text:
        return None
    letters = _NO_LETTERS.sub(" ", text.lower())
    if not any(map(str.isalpha, letters)):
        return None
    b = np.frombuffer(f" {letters.strip()} ".encode(), dtype=np.uint8).astype(np.uint32)
    hashed = (b[:-2] * np.uint32(0x9E3779B1) + b[1:-1] * np.uint32(0x85EBCA77) + b[2:] * np.uint32(0xC2B2AE3D)) >> np.uint32(16)
    counts = np.bincount(hashed % dimensions, minlength=dimensions)
    return np.sqrt(counts / len(hashed)).astype(np.float32)


def matrix_of(vectors: Iterable[bytes], rows: int, dimensions: int = DIMENSIONS) -> np.ndarray:
    """Vectors of two-byte numbers as rows, each followed by a 1. The matrix is the only copy that is made."""
    out = np.ones((rows, dimensions + 1), dtype=np.float32)
    for row, v in zip(out, vectors):
        row[:-1] = np.frombuffer(v, dtype=np.float16)
    return out


def fit_machine(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3, steps: int = 150) -> tuple[np.ndarray, float]:
    """Weights (the last one is the offset) and scale of a linear support vector machine with squared hinge loss.

    The last column of x is 1 (see :func:`matrix_of`). y: 1 or -1; both kinds
    weigh the same. Accelerated gradient steps of a fixed length, so equal rows in
    equal order give equal weights. scale turns margins into log odds: 4 at the
    median margin.
    """
    weight = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)).astype(np.float32)
    w = v = np.zeros(x.shape[1], dtype=np.float32)
    step = 1 / (penalty + 4.0)  # rows have length sqrt(2) and weights sum to 1
    for k in range(steps):
        slack = np.maximum(0, 1 - y * (x @ v))
        nxt = v - step * (penalty * v - 2 * (x.T @ (weight * slack * y)))
        v = nxt + k / (k + 3) * (nxt - w)
        w = nxt
    return w.astype(np.float32), 4 / max(float(np.median(np.abs(x @ w))), 1e-6)


def sample_rows(labelled: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """text, lang: of each language the fit_rows / languages texts of the lowest hashes, or all if it has fewer; no text twice."""
    rows = labelled.select("text", "lang", F.xxhash64("text").alias("_h")).where("text IS NOT NULL AND lang IS NOT NULL")
    # A text without a letter teaches nothing, so it takes no place.
    rows = rows.where(F.col("text").rlike(r"\p{L}"))
    texts = materialize(rows.select("lang", "_h").distinct(), "lang-texts")
    each = max(1, fit_rows // max(texts.select("lang").distinct().count(), 1))
    order = Window.partitionBy("lang").orderBy("_h")
    lowest = texts.withColumn("_rank", F.row_number().over(order))
    lowest = materialize(lowest.where(F.col("_rank") <= each).select("lang", "_h"), "lang-lowest")
    return rows.join(sized(lowest, lowest.count()), ["lang", "_h"]).dropDuplicates(["lang", "_h"]).select("text", "lang")


def _vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        made = [shares(t) for t in batch["text"]]
        known = [i for i, v in enumerate(made) if v is not None]
        yield pd.DataFrame(
            {"lang": batch["lang"].iloc[known].to_numpy(), "x": [made[i].astype(np.float16).tobytes() for i in known]}
        )


def _fit_pair(pdf: pd.DataFrame) -> pd.DataFrame:
    first, second, level = pdf["first"].iloc[0], pdf["second"].iloc[0], pdf["level"].iloc[0]
    pdf = pdf.sort_values(["side", "x"])
    w, scale = fit_machine(matrix_of(pdf["x"], len(pdf)), np.where(pdf["side"].to_numpy() == first, 1, -1).astype(np.float32))
    return pd.DataFrame({"level": [level], "first": [first], "second": [second], "w": [w.astype(np.float16).tobytes()], "scale": [scale]})


def halved(members: dict[str, np.ndarray], size: int = FAMILY_SIZE) -> list[list[str]]:
    """Members (name: mean vector) in groups of at most ``size``, cut again and again where their vectors differ most."""
    names = sorted(members)
    if len(names) <= size:
        return [names]
    x = np.stack([members[n] for n in names]).astype(np.float64)
    x -= x.mean(axis=0)
    # The direction of the largest spread, by power iteration from the member farthest from the middle.
    axis = x[int((x * x).sum(axis=1).argmax())].copy()
    for _ in range(20):
        axis = x.T @ (x @ axis)
        axis /= max(float(np.sqrt(axis @ axis)), 1e-30)
    order = np.argsort(x @ axis, kind="stable")
    first, second = ([names[i] for i in half] for half in np.array_split(order, 2))
    return [g for half in (first, second) for g in halved({n: members[n] for n in half}, size)]


def family_tree(means: dict[str, np.ndarray]) -> dict[str, list[str]]:
    """What each step chooses from, beginning with "": names of further steps, and languages, from their mean vectors."""
    families: dict[str, list[str]] = {}
    for language in sorted(means):
        families.setdefault(family_of(language), []).append(language)
    tree: dict[str, list[str]] = {}

    def free(name: str) -> str:
        while name in tree or name in means or not name:
            name += "*"
        return name

    def mean_of(name: str) -> np.ndarray:
        return np.mean([mean_of(c) for c in tree[name]], axis=0) if name in tree else means[name]

    def arranged(members: list[str]) -> list[str]:
        while len(members) > FAMILY_SIZE:
            groups = halved({m: mean_of(m) for m in members})
            members = []
            for group in groups:
                tree[name := free(f"near {group[0]}")] = group
                members.append(name)
        return sorted(members)

    known = {f: ls for f, ls in families.items() if f in FAMILIES}
    top = [ls[0] for f, ls in families.items() if f not in known and len(ls) == 1]
    for family, languages in families.items():
        if family in known or len(languages) > 1:
            name = free(family)
            tree[name] = []
            tree[name] = arranged(languages)
            top.append(name)
    tree[""] = arranged(top)
    return tree


class Model:
    """tree: the steps (see :func:`family_tree`). machines: (step, first, second) -> (weights, scale)."""

    def __init__(self, tree: dict[str, list[str]], machines: dict[tuple[str, str, str], tuple[np.ndarray, float]]):
        self.tree = tree
        self.families = {name: below for name, below in tree.items() if name}
        self.keys: dict[str, list[tuple[str, str]]] = {}
        for step, first, second in machines:
            self.keys.setdefault(step, []).append((first, second))
        self.machines = sorted(machines)
        self.scales = {step: np.array([machines[step, a, b][1] for a, b in keys]) for step, keys in self.keys.items()}
        # Two bytes a weight, one matrix for each step.
        self.weights = {step: np.stack([machines[step, a, b][0] for a, b in keys]).astype(np.float16) for step, keys in self.keys.items()}

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        known = [(i, v) for i, t in enumerate(texts) if (v := shares(t)) is not None]
        out = [(UNDETERMINED, 0.0)] * len(texts)
        if not known or not self.tree.get(""):
            return out
        x = np.stack([v for _, v in known])
        todo = [("", np.arange(len(known)), np.ones(len(known)))]
        while todo:
            step, rows, sure = todo.pop()
            if step not in self.tree:
                for r, s in zip(rows, sure):
                    out[known[r][0]] = (step, float(s))
                continue
            names = self.tree[step]
            if len(names) == 1:
                todo.append((names[0], rows, sure))
                continue
            w = self.weights[step].astype(np.float32)
            margins = (x[rows] @ w[:, :-1].T + w[:, -1]) * self.scales[step]
            votes = [self._vote(names, dict(zip(self.keys[step], m))) for m in margins.tolist()]
            chosen = np.array([names.index(n) for n, _ in votes])
            surest = np.minimum(sure, [s for _, s in votes])
            todo += [(names[c], rows[chosen == c], surest[chosen == c]) for c in np.unique(chosen)]
        return out

    @staticmethod
    def _vote(names: list[str], margin: dict[tuple[str, str], float]) -> tuple[str, float]:
        """The name that wins most duels (of equals the one with the larger margins), and the chance it won its closest one."""
        won = dict.fromkeys(names, (0, 0.0))
        closest = dict.fromkeys(names, 30.0)
        for a, b in combinations(names, 2):
            m = margin.get((a, b), 0.0)
            for name, value in ((a, m), (b, -m)):
                won[name] = (won[name][0] + (value > 0), won[name][1] + value)
                closest[name] = min(closest[name], value)
        best = max(names, key=lambda n: won[n])
        return best, 1 / (1 + float(np.exp(-max(min(closest[best], 30.0), -30.0))))


def _mean(pdf: pd.DataFrame) -> pd.DataFrame:
    x = np.stack([np.frombuffer(v, dtype=np.float16) for v in sorted(pdf["x"])])
    return pd.DataFrame({"lang": [pdf["lang"].iloc[0]], "x": [x.mean(axis=0, dtype=np.float32).astype(np.float16).tobytes()]})


def fit(labelled: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """A model from ``labelled`` (text, lang). Machines are fitted in tasks of their own, one for each pair."""
    spark = labelled.sparkSession
    with arrow_rows(spark, BATCH_ROWS):
        vectors = materialize(sample_rows(labelled, fit_rows).mapInPandas(giving_back(_vectors), "lang string, x binary"), "lang-vectors")
    found = vectors.groupBy("lang").applyInPandas(_mean, "lang string, x binary").collect()
    tree = family_tree({r["lang"]: np.frombuffer(r["x"], dtype=np.float16).astype(np.float32) for r in found})

    def languages(name: str) -> list[str]:
        return [x for c in tree[name] for x in languages(c)] if name in tree else [name]

    pairs = [
        (step, a, b, side, x)
        for step, names in tree.items() for a, b in combinations(names, 2) for side in (a, b) for x in languages(side)
    ]
    if not pairs:
        return Model(tree, {})
    duels = spark.createDataFrame(pairs, "level string, first string, second string, side string, lang string")
    fitted = (
        vectors.join(sized(duels, len(pairs)), "lang")
        .groupBy("level", "first", "second")
        .applyInPandas(_fit_pair, "level string, first string, second string, w binary, scale double")
        .collect()
    )
    machines = {(r["level"], r["first"], r["second"]): (np.frombuffer(r["w"], dtype=np.float16), r["scale"]) for r in fitted}
    return Model(tree, machines)


def predict(df: DataFrame, model: Model, column: str = "text", into: str = "lang_pred", score: str = "score") -> DataFrame:
    """``df`` with the language of ``column`` and a score from 0 to 1, which replace columns of those names."""
    return map_texts(df, column, {into: "string", score: "double"}, lambda: model.predict)


def held_out(doc_id: str = "doc_id"):
    """Whether a document is held out from learning; null for a null id, which neither is held out nor teaches."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(5)) == 0


def identify(docs: DataFrame, into: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with predictions of a model that learns from their labelled rows that are not held out."""
    return predict(docs, fit(docs.where(~held_out())), into=into, score=score)
