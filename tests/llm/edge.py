"""Rows every operator on documents has to bear."""

LONG = "lorem ipsum dolor " * 20_000

#: doc_id, text, lang, source, n_chars, and columns whose names operators use, too.
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "size long, rate double, copies int, seed int, score double, spans string, ids string, n int, node long, root long, `a.b` string"
)
_MORE = (9, 9.0, 9, 9, 9.0, "own", "own", 9, 9, 9, "dot")

ROWS = [
    (1, "Plain words in a plain text, nothing more to it.", "en", "a", 48),
    (2, "Plain words in a plain text, nothing more to it.", "en", "b", 48),
    (3, None, "en", "a", None),
    (4, "", None, "a", 0),
    (5, " \t\n\x0b\f\r ", "de", None, 7),
    (6, LONG, "la", None, len(LONG)),
    (None, "A text without any id.", "en", "c", 22),
    (7, "one", None, "c", 3),
    (7, "one", None, "c", 3),
    (8, "12345 !!! ###", "en", "a", 13),
    (9, "naïve Ünïcödé 🙂 and a token = abcdef1234 here", None, "b", 46),
]
ROWS = [r + _MORE for r in ROWS]


def documents(spark, rows=ROWS):
    return spark.createDataFrame(rows, SCHEMA)
