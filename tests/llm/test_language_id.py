import pickle
import random
import zlib

import numpy as np

from edge import documents

from conftest import TESTDATA
from stratalake.llm import language_id as lid
from stratalake.llm.queries import op8_language_id


def test_held_out_accuracy(spark):
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    rows = op8_language_id(spark, "/root/testdata/sf0.01").collect()
    assert {r["doc_id"] for r in rows} == set(langs)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == langs[r["doc_id"]] for r in held) >= 0.97 * len(held)


def test_predictions_depend_on_the_text_alone(spark):
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    model = lid.fit(docs)
    first = {r["text"]: (r["lang_pred"], r["score"]) for r in lid.predict(docs, model).collect()}
    other = docs.selectExpr("-doc_id as doc_id", "text", "'xx' as lang", "null as source").repartition(5)
    assert {r["text"]: (r["lang_pred"], round(r["score"], 4)) for r in lid.predict(other, model).collect()} == {
        t: (p, round(s, 4)) for t, (p, s) in first.items()
    }


def test_hierarchy(spark):
    model = lid.fit(spark.read.parquet(f"{TESTDATA}/documents.parquet"))
    assert model.families == {"germanic": ["de", "en"], "romance": ["es", "fr"]}
    assert sorted(model.machines) == [("", "germanic", "romance"), ("germanic", "de", "en"), ("romance", "es", "fr")]
    assert lid.family_of("pt-BR") == "romance" and lid.family_of("tlh") == "tlh"


def invented(language, n, rng):
    """Texts of an invented language: words out of its own few syllables."""
    own = random.Random(language)
    syllables = ["".join(own.choices("abcdefghijklmnopqrstuvwxyz", k=3)) for _ in range(12)]
    return [" ".join("".join(rng.choices(syllables, k=2)) for _ in range(60)) for _ in range(n)]


def test_every_one_of_300_languages_is_learned(spark):
    rng = random.Random(1)
    rows = [(t, f"lang{i}") for i in range(300) for t in invented(i, 8, rng)]
    model = lid.fit(spark.createDataFrame(rows, "text string, lang string"), 1500)
    assert all(len(below) <= lid.FAMILY_SIZE for below in model.tree.values())
    below = [x for names in model.tree.values() for x in names]
    assert len(below) == len(set(below)) and {f"lang{i}" for i in range(300)} <= set(below)
    assert len(pickle.dumps(model)) < 50 << 20
    texts = [(t, f"lang{i}") for i in range(300) for t in invented(i, 1, rng)]
    found = model.predict([t for t, _ in texts])
    assert sum(p == lang for (p, _), (_, lang) in zip(found, texts)) >= 270
    assert {p for p, _ in found} >= {f"lang{i}" for i in range(256, 300)} - {lang for (p, _), (_, lang) in zip(found, texts) if p != lang}


def test_names_that_clash_with_families(spark):
    rng = random.Random(2)
    names = ["germanic", "de", "en", "near de", "romance", "x-a", "x-b"]
    rows = [(t, lang) for lang in names for t in invented(lang, 6, rng)]
    model = lid.fit(spark.createDataFrame(rows, "text string, lang string"))
    found = model.predict([t for t, _ in rows])
    assert sum(p == lang for (p, _), (_, lang) in zip(found, rows)) >= 0.9 * len(rows)


def test_groups_are_bounded_and_whole():
    rng = np.random.default_rng(3)
    members = {f"m{i}": rng.normal(size=8) for i in range(101)} | {f"same{i}": np.zeros(8) for i in range(40)}
    groups = lid.halved(members, 7)
    assert sorted(x for g in groups for x in g) == sorted(members) and all(1 <= len(g) <= 7 for g in groups)


def test_edge_rows(spark):
    docs = documents(spark)
    rows = lid.identify(docs).collect()
    assert len(rows) == docs.count()
    by_text = {r["text"]: r for r in rows}
    for text in (None, "", " \t\n\x0b\f\r ", "12345 !!! ###"):
        assert (by_text[text]["lang_pred"], by_text[text]["score"]) == ("und", 0.0)
    assert by_text["one"]["lang_pred"] in ("en", "la", "de")
    assert "a.b" in rows[0].asDict()


def test_nothing_and_one_language_to_learn(spark):
    docs = documents(spark)
    assert lid.identify(docs.limit(0)).count() == 0
    unknown = lid.identify(docs.selectExpr("doc_id", "text", "cast(null as string) lang")).collect()
    assert {r["lang_pred"] for r in unknown} == {"und"}
    single = lid.predict(docs, lid.fit(docs.selectExpr("text", "'en' as lang"))).collect()
    assert {r["lang_pred"] for r in single} == {"en", "und"}


def test_sample_is_bounded_and_even(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    counts = {r["lang"]: r["count"] for r in lid.sample_rows(docs, 200).groupBy("lang").count().collect()}
    assert set(counts) == {"de", "en", "es", "fr"} and all(20 <= n <= 100 for n in counts.values())


def test_copies_do_not_thin_out_the_sample(spark):
    rows = [(f"wort {i % 40} nummer", "de") for i in range(4000)] + [("the same hot text", "en")] * 3000
    rows += [(f"word {i} number", "en") for i in range(100)] + [(f"{i} !!", "en") for i in range(300)] + [(f"mot {i}", "fr") for i in range(7)]
    docs = spark.createDataFrame([(t.replace(str(i % 10), "abcdefghij"[i % 10]), lang) for i, (t, lang) in enumerate(rows)], "text string, lang string")
    texts = {}
    for t, lang in docs.distinct().collect():
        if any(map(str.isalpha, t)):
            texts.setdefault(lang, set()).add(t)
    sample = [tuple(r) for r in lid.sample_rows(docs, 90).select("lang", "text").collect()]
    assert len(sample) == len(set(sample))
    for lang, distinct in texts.items():
        taken = {t for x, t in sample if x == lang}
        assert taken <= distinct and len(taken) == min(30, len(distinct))


def test_a_language_of_copies_is_learned(spark):
    given = spark.read.parquet(f"{TESTDATA}/documents.parquet").select("text", "lang").where("lang != 'fr'")
    copies = spark.createDataFrame([(f"le petit chat de la maison est dans le jardin {k}", "fr") for k in "abc"] * 3000, "text string, lang string")
    model = lid.fit(given.unionByName(copies), 200)
    assert model.families["romance"] == ["es", "fr"]


def test_matrix_has_the_vectors_and_a_one():
    x = np.arange(12, dtype=np.float16).reshape(3, 4)
    assert lid.matrix_of([v.tobytes() for v in x], 3, 4).tolist() == [[*v, 1.0] for v in x.tolist()]
    assert lid.matrix_of([], 0, 4).shape == (0, 5)
