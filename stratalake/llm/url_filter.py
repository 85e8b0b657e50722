"""URL filter: host and path rules first, gradient-boosted trees on lexical features for the rest.

Everything is DataFrame functions and Spark's own tree learner; no Python runs on
the executors. The trees learn from labelled URLs. For the fit a bounded sample
of them is taken (``FIT_ROWS``), half of either kind, chosen by hash from the
distinct ones; every other step, the suffix statistics too, covers all rows.

Defined results: a url of any length is judged whole; a null url, or one without ``://``, has an empty host and path
and features of an empty text; repeated rows are judged alike; an empty table
gives an empty result; without labelled URLs of both kinds there is nothing to
learn, and the verdict of what no rule decides is ``allow``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import free_name, materialize, sized

ALLOW, BLOCK = "allow", "block"
#: At most about so many labelled URLs, half of either kind, chosen by hash, fit the trees.
FIT_ROWS = 20_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``host`` with all its subdomains, and every path that starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: Fixed values of the registered query.
RULES = (
    Rule("net", "/", BLOCK),
    Rule("example.net", "/en/", ALLOW),
    Rule("example.com", "/de/", BLOCK),
    Rule("org", "/fr/", ALLOW),
)


def _after_scheme(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def best_rule(host_: Column, path_: Column, rules: Sequence[Rule]) -> Column:
    """The index of the rule that fits and is longest; null if none fits. Of equal lengths the first."""
    order = sorted(range(len(rules)), key=lambda i: (-len(rules[i].name), i))
    found = [
        F.when(((host_ == r.host) | host_.endswith("." + r.host)) & path_.startswith(r.path), F.lit(i))
        for i in order
        for r in [rules[i]]
    ]
    return F.coalesce(*found) if found else F.lit(None).cast("int")


def with_rules(urls: DataFrame, rules: Sequence[Rule], column: str = "url") -> DataFrame:
    """Adds host, path, rule and decided (the rule's verdict)."""
    url = F.col(f"`{column}`")
    out = urls.withColumns({"host": host(url), "path": path(url)})
    which = best_rule(F.col("host"), F.col("path"), rules)
    at = which + F.lit(1)
    names, verdicts = F.array(*[F.lit(r.name) for r in rules]), F.array(*[F.lit(r.verdict) for r in rules])
    return out.withColumns({"rule": F.try_element_at(names, at), "decided": F.try_element_at(verdicts, at)})


def suffix(host_: Column) -> Column:
    """The last label of a host."""
    return F.substring_index(host_, ".", -1)


def _share(url: Column, pattern: str) -> Column:
    n = F.length(url)
    kept = F.length(F.regexp_replace(url, pattern, ""))
    return F.when(n > 0, (n - kept) / n).otherwise(F.lit(0.0))


def entropy(text: Column) -> Column:
    """Shannon entropy of the characters, in bits."""
    n = F.length(text)

    def term(c: Column) -> Column:
        p = (n - F.length(F.replace(text, c, F.lit("")))) / n
        return -p * F.log2(p)

    chars = F.array_distinct(F.split(text, "", -1))
    return F.when(n > 0, F.aggregate(F.filter(chars, lambda c: c != ""), F.lit(0.0), lambda s, c: s + term(c))).otherwise(
        F.lit(0.0)
    )


def features(url: Column, host_: Column, path_: Column) -> dict[str, Column]:
    """Lexical features, all of them numbers."""
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    segments = F.filter(F.split(path_, "/", -1), lambda s: s != "")
    return {
        "length": F.length(url),
        "host_length": F.length(host_),
        "labels": F.size(F.split(host_, r"\.", -1)),
        "depth": F.size(segments),
        "longest_segment": F.coalesce(F.array_max(F.transform(segments, F.length)), F.lit(0)),
        "first_segment": F.coalesce(F.length(F.get(segments, F.lit(0))), F.lit(0)),
        "first_segment_start": F.coalesce(F.ascii(F.get(segments, F.lit(0))), F.lit(0)),
        "digit_ratio": _share(url, "[0-9]"),
        "host_digit_ratio": _share(host_, "[0-9]"),
        "upper_ratio": _share(url, "[A-Z]"),
        "symbol_ratio": _share(url, "[A-Za-z0-9./:]"),
        "hyphens": F.length(host_) - F.length(F.replace(host_, F.lit("-"), F.lit(""))),
        "entropy": entropy(url),
        "host_entropy": entropy(host_),
        "parameters": F.when(query == "", F.lit(0)).otherwise(F.size(F.split(query, "[&;]", -1))),
        "query_length": F.length(query),
        "fragment": F.instr(url, "#").cast("boolean").cast("int"),
        "escapes": F.length(url) - F.length(F.replace(url, F.lit("%"), F.lit(""))),
        "secure": F.lower(url).startswith("https:").cast("int"),
    }


def with_features(urls: DataFrame, suffixes: DataFrame, column: str, into: str) -> DataFrame:
    """Adds the vector ``into``. ``suffixes``: _of, _block_rate, _seen, with a broadcast hint if they are few."""
    url = F.coalesce(F.col(f"`{column}`"), F.lit(""))
    own = {f"_f_{k}": v.cast("double") for k, v in features(url, F.col("host"), F.col("path")).items()}
    out = urls.withColumns(own).withColumn("_suffix", suffix(F.col("host")))
    out = out.join(suffixes, F.col("_suffix") == F.col("_of"), "left").drop("_of")
    out = out.withColumns(
        {"_f_block_rate": F.coalesce("_block_rate", F.lit(0.5)), "_f_seen": F.log1p(F.coalesce("_seen", F.lit(0)))}
    )
    names = [*own, "_f_block_rate", "_f_seen"]
    made = VectorAssembler(inputCols=names, outputCol=into, handleInvalid="keep").transform(out)
    return made.drop(*names, "_suffix", "_block_rate", "_seen")


@dataclass(frozen=True)
class UrlModel:
    """Trees and the suffix statistics they were fitted with; trees is None when there was nothing to tell apart."""

    trees: object
    suffixes: DataFrame

    def score(self, urls: DataFrame, column: str, into: str) -> DataFrame:
        """``urls`` with host and path, and the probability of block in ``into``."""
        if self.trees is None:
            return urls.withColumn(into, F.lit(0.0))
        made = with_features(urls, self.suffixes, column, "_url_features")
        trees = self.trees.setFeaturesCol("_url_features").setRawPredictionCol("_url_raw")
        scored = trees.setPredictionCol("_url_pred").setProbabilityCol("_url_p").transform(made)
        return scored.withColumn(into, vector_to_array("_url_p")[1]).drop("_url_features", "_url_raw", "_url_pred", "_url_p")


def fit(labelled: DataFrame, column: str = "url", label: str = "label", fit_rows: int = FIT_ROWS, rounds: int = 10, seed: int = 7) -> UrlModel:
    """Trees from ``labelled`` (url, label: 1 to block, 0 to allow; other labels are left out).

    About ``fit_rows`` distinct URLs, half of either kind and those of lowest hash, are used, all of a kind that has fewer; both
    kinds get the same total weight. The suffix statistics are of all rows.
    """
    url = F.coalesce(F.col(f"`{column}`"), F.lit(""))
    rows = labelled.select(url.alias("url"), F.col(f"`{label}`").cast("double").alias("label")).where(F.col("label").isin(0.0, 1.0))
    suffixes = materialize(
        rows.groupBy(suffix(host(F.col("url"))).alias("_of")).agg(
            ((F.sum("label") + 1) / (F.count("label") + 2)).alias("_block_rate"), F.count("label").alias("_seen")
        ),
        "url-suffixes",
    )
    suffixes = sized(suffixes, suffixes.count())
    hashed = F.xxhash64("url", F.lit(seed))
    distinct = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count_distinct(hashed).alias("n")).collect()}
    if len(distinct) < 2:
        return UrlModel(None, suffixes)
    span = 1 << 30
    below = {k: int(min(1.0, fit_rows / 2 / n) * span) for k, n in distinct.items()}
    sample = rows.where(F.pmod(hashed, F.lit(span)) < F.when(F.col("label") == 1.0, F.lit(below[1.0])).otherwise(F.lit(below[0.0])))
    sample = sample.dropDuplicates(["url", "label"])
    sample = materialize(sample.withColumns({"host": host(F.col("url")), "path": path(F.col("url"))}), "url-sample")
    kinds = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("url").alias("n")).collect()}
    if len(kinds) < 2:
        return UrlModel(None, suffixes)
    weight = F.when(F.col("label") == 1.0, F.lit(0.5 / kinds[1.0])).otherwise(F.lit(0.5 / kinds[0.0])) * sum(kinds.values())
    training = with_features(sample, suffixes, "url", "features").withColumn("weight", weight)
    gbt = GBTClassifier(
        featuresCol="features", labelCol="label", weightCol="weight", maxIter=rounds, maxDepth=4, stepSize=0.3, seed=seed,
        featureSubsetStrategy="all", subsamplingRate=1.0,
    )
    return UrlModel(gbt.fit(training.select("features", "label", "weight")), suffixes)


def filter_urls(urls: DataFrame, rules: Sequence[Rule] = RULES, labelled: DataFrame | None = None, column: str = "url") -> DataFrame:
    """``urls`` with host, path, rule, score (probability of block by the trees) and verdict.

    Columns of these names are replaced, but a ``score`` stays and the new one gets a longer name; all others stay, whatever their names.
    Without ``labelled``, the URLs that a rule decides are the labelled ones.
    """
    score = free_name(urls, "score")
    made = ("host", "path", "rule", "verdict")
    # Numbered names on the way: the columns of the work in between may stand in the table, too.
    kept = {f"c{i}": c for i, c in enumerate(c for c in urls.columns if c.lower() not in made)}
    ruled = with_rules(urls.select(F.col(f"`{column}`").alias("url"), *[F.col(f"`{c}`").alias(k) for k, c in kept.items()]), rules)
    if labelled is None:
        labelled = ruled.select("url", (F.col("decided") == BLOCK).cast("int").alias("label")).where(F.col("label").isNotNull())
    scored = fit(labelled).score(ruled, "url", "score")
    own = F.when(F.col("score") > 0.5, F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    others = [F.col(k).alias(c) for k, c in kept.items()]
    return scored.select(*others, "host", "path", "rule", F.col("score").alias(score), F.coalesce("decided", own).alias("verdict"))
