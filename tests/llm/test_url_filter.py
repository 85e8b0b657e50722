import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from stratalake.llm import url_filter as uf
from stratalake.llm.queries import op3_url_verdicts

URLS = [
    "http://www.Example.NET/en/1", "https://example.net/en", "https://a.b.example.net/en/", "https://example.net/EN/1", "https://net/", "https://xnet/a",
    "https://x.net?en/", "https://x.net", "http://example.com/de/1", "http://notexample.com/de/1", "http://m.example.com/de", "http://x.org/fr/1",
    "http://org/fr/", "http://org.uk/fr/", None, "", "no scheme", "://", "a://b://c.net/x", "http://h.net#/en/", "http://h.net/a?b#c/d", "HTTP://É.NET/",
    "http://x.net:80/en/", "http://" + "a" * 50_000 + ".org/fr/x",
]


def plain(url):
    """host, path and rule by hand."""
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
        rest = rest[end:]
        path = rest[: min([rest.index(c) for c in "?#" if c in rest], default=len(rest))]
    fits = [
        (len(h + p), h + p, v)
        for h, p, v in (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return host, path, *(max(fits)[1:] if fits else (None, None))


def frame(spark):
    rows = [(i, u, "own", "own", 1.0, "own") for i, u in enumerate(URLS + URLS)]
    return spark.createDataFrame(rows, "page_id long, url string, rule string, verdict string, features double, label string")


def test_rules_and_verdicts(spark):
    got = uf.filter_urls(frame(spark)).collect()
    assert len(got) == 2 * len(URLS)
    for r in got:
        host, path, rule, verdict = plain(r["url"])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] in ("allow", "block") and (verdict is None or r["verdict"] == verdict)
        assert r["label"] == "own" and r["features"] == 1.0
    assert uf.filter_urls(frame(spark).limit(0)).count() == 0


def test_nothing_to_learn_allows(spark):
    urls = spark.createDataFrame([(1, "http://a.com/x"), (2, "http://a.net/x")], "page_id long, url string")
    assert {r["page_id"]: r["verdict"] for r in uf.filter_urls(urls).collect()} == {1: "allow", 2: "block"}


def test_query_follows_the_rules(spark):
    pages = {r["page_id"]: r["url"] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    rows = op3_url_verdicts(spark, "/root/testdata/sf0.01").collect()
    assert {r["page_id"] for r in rows} == set(pages)
    for r in rows:
        host, path, rule, verdict = plain(pages[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert verdict is None or r["verdict"] == verdict


@pytest.mark.parametrize("text", ["", "a", "aaaa", "abab", "https://www.example.com/a?b=1", "日本語日"])
def test_entropy(spark, text):
    counts = Counter(text)
    want = -sum(c / len(text) * math.log2(c / len(text)) for c in counts.values())
    got = spark.createDataFrame([(text,)], "u string").select(uf.entropy(F.col("u"))).first()[0]
    assert math.isclose(got, want, abs_tol=1e-12)


def test_features(spark):
    url = "https://a-b.c1.example.com/x1/yy/z?p=1&q=2#top"
    names = uf.features(F.col("u"), uf.host(F.col("u")), uf.path(F.col("u")))
    got = spark.createDataFrame([(url,)], "u string").select(*[v.alias(k) for k, v in names.items()]).first().asDict()
    assert got["length"] == len(url) and got["labels"] == 4 and got["depth"] == 3 and got["parameters"] == 2
    assert got["hyphens"] == 1 and got["fragment"] == 1 and got["secure"] == 1 and got["longest_segment"] == 2
    assert math.isclose(got["digit_ratio"], 4 / len(url))


def test_trees_learn_lexical_patterns(spark):
    def url(i):
        if i % 2:
            return f"http://win{i * 7919 % 100000}-prize{i}.example.info/{i}/{i * 31}?id={i}&x={i * 3}&y=1&z=2"
        return f"https://news.example.com/{'abcdefgh'[i % 8]}rticles/of-the-day"

    rows = [(url(i), i % 2) for i in range(600)]
    model = uf.fit(spark.createDataFrame(rows[:400], "url string, label int"))
    test = spark.createDataFrame(rows[400:], "url string, label int")
    scored = model.score(test.withColumns({"host": uf.host(F.col("url")), "path": uf.path(F.col("url"))}), "url", "p").collect()
    assert sum((r["p"] > 0.5) == bool(r["label"]) for r in scored) >= 0.97 * len(scored)


def test_a_rare_verdict_and_a_hot_url_leave_both_kinds_in_the_sample(spark):
    rows = [(f"https://news.example.com/{i}/story", 0) for i in range(2000)] + [("https://hot.example.com/", 0)] * 3000
    rows += [(f"http://win{i}-prize.example.info/?id={i}&x=1", 1) for i in range(3)]
    labelled = spark.createDataFrame(rows, "url string, label int")
    model = uf.fit(labelled, fit_rows=60)
    assert model.trees is not None
    asked = spark.createDataFrame([("http://win9-prize.example.info/?id=9&x=1",), ("https://news.example.com/9999/story",)], "url string")
    asked = asked.withColumns({"host": uf.host(F.col("url")), "path": uf.path(F.col("url"))})
    assert [r["p"] > 0.5 for r in model.score(asked, "url", "p").orderBy("url").collect()] == [True, False]


def test_suffix_statistics_are_of_all_rows(spark):
    rows = [(f"https://a{i}.example.com/x", i % 2) for i in range(3000)] + [("http://b.zz/", 1)] * 500
    model = uf.fit(spark.createDataFrame(rows, "url string, label int"), fit_rows=40)
    got = {r["_of"]: (r["_seen"], r["_block_rate"]) for r in model.suffixes.collect()}
    assert got == {"com": (3000, 1501 / 3002), "zz": (500, 501 / 502)}


def test_columns_of_any_name_and_very_long_urls(spark):
    long = "https://x.example.net/" + "a/" * 50_000 + "?q=" + "9" * 100_000
    rows = [(1, long), (2, None), (3, "https://example.com/de/x"), (4, "https://a.org/"), (4, "https://a.org/")]
    plain_ = spark.createDataFrame(rows, "page_id long, url string")
    names = ["decided", "_suffix", "_of", "_seen", "_block_rate", "_url_p", "_url_features", "_f_length", "score", "host", "Verdict", "c0", "a.b"]
    wide = plain_.select("*", *[F.lit(f"own {n}").alias(n) for n in names])
    out = uf.filter_urls(wide)
    assert out.columns == ["page_id", "url", *[n for n in names if n not in ("host", "Verdict")], "host", "path", "rule", "score_", "verdict"]
    want = {(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in uf.filter_urls(plain_).collect()}
    got = out.collect()
    assert len(got) == 5 and {(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in got} == want
    assert all(r[n] == f"own {n}" for r in got for n in names if n not in ("host", "Verdict"))
