"""How far the sources of a language differ in their words: smoothed term rates, compared through frequent-pattern trees.

A term's row is the ordered list of the sources that have it, each with its rate.
Rows are inserted into a tree in which equal beginnings share their nodes, and
every node knows how many terms run through it. The distance of two sources is
then written as what they would differ in if neither had any term, one
correction for each term that a single source has, and one for each term that
both have. The last kind is made once for each node and ancestor, times the
node's terms, and not once for each term.

Trees are built by streaming sorted rows: a row leaves the nodes of the one
before it where they part, so a task holds one path and not its tree. Equal rows
are counted before they are sorted, and the sort is by the whole row, so no
source and no row is too frequent for a task. Terms are counted in tasks first;
what is shuffled is one row for each term, source and bounded count of terms.

Numbers are whole throughout: a rate is 1 + floor(SCALE * (count + SMOOTH) / (all
counts + SMOOTH * terms)).

Defined results: null texts, languages and sources count as empty ones; a text
without letters adds no term, yet its source is a group, and every other source of the
language is compared with it; a language without frequent terms has distances of 0
and no terms; repeated rows count as often as they stand there; ties go to the
smaller name, by bytes; an empty table gives an empty result. A text of any length
counts as a whole. Other columns of the table play no part.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.common import arrow_rows, materialize, sized

SCALE, SMOOTH = 1_000_000_000, 5
#: A term counts if it is in so many documents of its language.
MIN_DOCUMENTS = 30
#: Terms reported for a group.
TOP_TERMS = 50
#: Different terms a task counts before it hands them on.
HELD_TERMS = 200_000
#: Corrections a task holds before it hands on their sums.
HELD_CORRECTIONS = 1 << 18
#: ASCII letters in lower case and all bytes beyond ASCII; everything else parts terms.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text in UTF-8: runs of ASCII letters and of anything beyond ASCII, only A-Z lower-cased."""
    return text.encode("utf-8", "replace").translate(_LETTERS).split() if text else []


def _texts(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    named = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source")))
    return docs.select(*named, F.col(f"`{text}`").alias("text"))


def _counted(texts: DataFrame, by_source: bool) -> DataFrame:
    """lang, source, term, n: occurrences by source; or lang, term, n: documents by language. A key may come several times."""
    schema = "lang string, source string, term binary, n bigint" if by_source else "lang string, term binary, n bigint"
    names = [p.split()[0] for p in schema.split(", ")]

    def handed_on(held: dict[tuple, Counter]) -> pa.RecordBatch:
        keys = [[k for key, counts in held.items() for k in [key[i]] * len(counts)] for i in range(len(names) - 2)]
        found = [t for counts in held.values() for t in counts]
        n = [c for counts in held.values() for c in counts.values()]
        columns = [*(pa.array(k, pa.string()) for k in keys), pa.array(found, pa.binary()), pa.array(n, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, Counter] = {}
        size = 0
        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in names[:-2]))
            for key, text in zip(keys, batch.column("text")):
                found = terms_of(text.as_py())
                counts = held.setdefault(key, Counter())
                before = len(counts)
                counts.update(found if by_source else set(found))
                size += len(counts) - before
                if size > HELD_TERMS or len(held) > HELD_TERMS:
                    yield handed_on(held)
                    held, size = {}, 0
        yield handed_on(held)

    return texts.mapInArrow(run, schema)


def _rate(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + SMOOTH) / (total + SMOOTH * terms)), exactly; null if there is no term."""
    whole = [c.cast("decimal(20,0)") for c in (count + SMOOTH, total + SMOOTH * terms)]
    return F.when(terms > 0, 1 + F.call_function("div", whole[0] * F.lit(SCALE).cast("decimal(11,0)"), whole[1]))


def term_rates(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = MIN_DOCUMENTS):
    """(groups, items): every group with its number of terms and the rate of a term it lacks, and
    every term that a group has with the group's rate ``p`` and the language's rate ``q``."""
    texts = _texts(docs, text, lang, source)
    with arrow_rows(docs.sparkSession, 500):
        kept = _counted(texts, False).groupBy("lang", "term").agg(F.sum("n").alias("documents")).where(F.col("documents") >= least)
        kept = materialize(kept.select("lang", "term"), "divergence-terms")
        n_kept = kept.count()
        found = _counted(texts, True).join(sized(kept, n_kept), ["lang", "term"], "left_semi")
        counts = materialize(found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n")), "divergence-counts")
    terms = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = (
        texts.select("lang", "source").distinct().join(terms, "lang", "left").join(totals, ["lang", "source"], "left")
        .fillna(0, ["terms", "total"])
    )
    groups = groups.withColumn("lacking", _rate(F.lit(0).cast("long"), F.col("total"), F.col("terms")))
    groups = materialize(groups, "divergence-groups")
    n_groups = groups.count()
    languages = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    of_term = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"))
    items = (
        counts.join(of_term, ["lang", "term"]).join(sized(groups, n_groups), ["lang", "source"])
        .join(sized(languages, n_groups), "lang")
        .select(
            "lang", "source", F.col("term").cast("string").alias("term"), "lacking",
            _rate(F.col("n"), F.col("total"), F.col("terms")).alias("p"),
            _rate(F.col("lang_n"), F.col("lang_total"), F.col("terms")).alias("q"),
        )
    )
    return groups, materialize(items, "divergence-items")


def _corrections(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted rows of terms through a tree: for each node and each of its ancestors the correction, times the node's terms."""
    lang, names, index = None, [], {}
    path: list[tuple[str, int]] = []
    # The path's sources by number, their rates, and their rates for terms they lack; a node's terms, counted while it is open.
    at, rate, lacking = (np.zeros(64, np.int64) for _ in range(3))
    through: list[int] = []
    pairs, sums, held = [], [], 0

    def leave(depth: int):
        """Nodes below ``depth`` get no more terms: each meets its ancestors once."""
        nonlocal held
        for d in range(len(path) - 1, depth - 1, -1):
            above = slice(0, d)
            if d:
                p, none = rate[d], lacking[d]
                value = np.abs(rate[above] - p) - np.abs(rate[above] - none) - np.abs(lacking[above] - p) + np.abs(lacking[above] - none)
                pairs.append((at[above] << 32) | at[d])
                sums.append(value * through[d])
                held += d
            if d:
                through[d - 1] += through[d]
        del path[depth:], through[depth:]

    def handed_on() -> pd.DataFrame:
        nonlocal pairs, sums, held
        key, where = np.unique(np.concatenate(pairs), return_inverse=True)
        total = np.zeros(len(key), np.int64)
        np.add.at(total, where, np.concatenate(sums))
        pairs, sums, held = [], [], 0
        return pd.DataFrame(
            {"lang": lang, "a": [names[k] for k in key >> 32], "b": [names[k] for k in key & 0xFFFFFFFF], "both": total}
        )

    for batch in batches:
        for row_lang, row, terms in zip(batch["lang"], batch["row"], batch["terms"]):
            if row_lang != lang:
                leave(0)
                if pairs:
                    yield handed_on()
                lang, names, index = row_lang, [], {}
            row = [(r["source"], r["p"], r["lacking"]) for r in row]
            common = 0
            while common < min(len(path), len(row)) and path[common] == row[common][:2]:
                common += 1
            leave(common)
            if len(row) > len(at):
                at, rate, lacking = (np.concatenate([x, np.zeros(len(row), np.int64)]) for x in (at, rate, lacking))
            for d in range(common, len(row)):
                name, p, none = row[d]
                if name not in index:
                    index[name] = len(names)
                    names.append(name)
                path.append((name, p))
                through.append(0)
                at[d], rate[d], lacking[d] = index[name], p, none
            through[len(row) - 1] += int(terms)
            if held > HELD_CORRECTIONS:
                yield handed_on()
    leave(0)
    if pairs:
        yield handed_on()


def distances(groups: DataFrame, items: DataFrame) -> DataFrame:
    """lang, source, other, value: the sum over all terms of the differences of two sources' rates, for every two sources of a language."""
    rows = items.groupBy("lang", "term").agg(F.sort_array(F.collect_list(F.struct("source", "p", "lacking"))).alias("row"))
    rows = rows.groupBy("lang", "row").agg(F.count(F.lit(1)).alias("terms"))
    both = rows.repartitionByRange("lang", "row").sortWithinPartitions("lang", "row")
    both = both.mapInPandas(_corrections, "lang string, a string, b string, both bigint")
    both = both.groupBy("lang", "a", "b").agg(F.sum("both").alias("both"))
    both = both.union(both.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "both"))

    other = groups.select("lang", F.col("source").alias("other"), F.col("lacking").alias("other_lacking"))
    rates = items.groupBy("lang", "source", "lacking", "p").agg(F.count(F.lit(1)).alias("n"))
    own = rates.join(other, "lang").where("source <> other").groupBy("lang", "source", "other").agg(
        F.sum(F.col("n") * (F.abs(F.col("p") - F.col("other_lacking")) - F.abs(F.col("lacking") - F.col("other_lacking")))).alias("own")
    )
    turned = own.select("lang", F.col("other").alias("source"), F.col("source").alias("other"), F.col("own").alias("others"))
    met = both.select("lang", F.col("a").alias("source"), F.col("b").alias("other"), "both")
    keys = ["lang", "source", "other"]
    every = groups.join(other, "lang").where("source <> other")
    every = every.join(own, keys, "left").join(turned, keys, "left").join(met, keys, "left")
    neither = F.col("terms") * F.abs(F.col("lacking") - F.col("other_lacking"))
    parts = (neither, *(F.col(c) for c in ("own", "others", "both")))
    return every.select(*keys, sum((F.coalesce(c, F.lit(0)) for c in parts), F.lit(0)).cast("long").alias("value"))


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = MIN_DOCUMENTS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: for each group its distances to all other sources of its
    language (``pair``), and the ``top`` terms it uses more than the language does (``term``), the largest values first."""
    groups, items = term_rates(docs, text, lang, source, least)
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = distances(groups, items).select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), "value")
    pairs = pairs.withColumn("rank", F.row_number().over(by_value))
    more = items.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    more = more.withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top)
    return pairs.unionByName(more)
