import random

import numpy as np
import pytest
from edge import LONG, documents

from stratalake.llm import substring_dedup as S


def plain(rows, width):
    """doc_id, kept words, removed: by looking at every window; ids are unique and never null."""
    first, out = set(), []
    for i, text in sorted(rows):
        words = (text or "").encode().split()
        gone = set()
        for s in range(len(words) - width + 1):
            window = tuple(words[s : s + width])
            if window in first:
                gone.update(range(s, s + width))
            first.add(window)
        out.append((i, len(words), len(gone), b" ".join(w for k, w in enumerate(words) if k not in gone).decode()))
    return out


def result(df):
    return sorted((r["doc_id"], r["n_words"], r["n_removed"], r["text"]) for r in df.collect())


def made(letters, n, seed, length=60):
    rng = random.Random(seed)
    passages = [" ".join(rng.choice(letters) for _ in range(rng.randint(3, 30))) for _ in range(6)]
    out = []
    for i in range(n):
        parts = [rng.choice(passages) if rng.random() < 0.4 else " ".join(rng.choice(letters) for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(0, length // 6))]
        out.append((i * 7 % n, "\n".join(parts)))
    return out


@pytest.mark.parametrize("letters", ["a", "ab", "abc", "abcdefghij"])
@pytest.mark.parametrize("width", [1, 4, 20])
def test_equal_windows_are_filed_alike(letters, width):
    words, powers, seen = S.Words(), S._Powers(S._BASE2), {}
    for _, text in made(letters, 60, 5):
        hashes, _ = words.hashes(text.encode())
        own = text.split()
        place, *filed = S._windows(hashes, np.zeros(len(hashes), int), width, powers)
        assert list(place) == list(range(max(0, len(own) - width + 1)))
        for p, *named in zip(place, *filed):
            assert seen.setdefault(tuple(own[p : p + width]), named) == named
            assert 0 <= named[1] < width
    assert len({tuple(map(int, v)) for v in seen.values()}) == len(seen)


@pytest.mark.parametrize("letters,width", [("a", 5), ("ab", 6), ("abc", 5), ("abcdefghijklmnop", 4), ("abcd", 20)])
def test_as_looking_at_every_window(spark, letters, width):
    rows = made(letters, 80, 11)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert result(S.remove_repeats(docs, width)) == plain(rows, width)


def test_small_batches_and_pieces_change_nothing(spark, monkeypatch):
    rows = made("abcdefgh", 60, 3, 300)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    filed = S._file

    def small(width, buckets):
        run = filed(width, buckets)

        def in_task(batches):
            S.BATCH_BYTES, S.PIECE_WORDS, S._HASH_BYTES, S.PARTITION_WINDOWS = 500, 37, 11, 50
            return run(batches)

        return in_task

    monkeypatch.setattr(S, "_file", small)
    assert result(S.remove_repeats(docs, 6)) == plain(rows, 6)


def test_word_hashes_do_not_depend_on_what_stands_around():
    words = S.Words()
    text = "äö  x\x0b\x0cüüü\tx \r\n" + "y" * 3000 + " x "
    own = text.encode().split()
    hashes, begins = words.hashes(text.encode())
    assert [text.encode()[b : b + len(w)] for b, w in zip(begins, own)] == own
    assert hashes[1] == hashes[3] == hashes[5] and len(set(hashes.tolist())) == 4
    assert [int(words.hashes(w)[0][0]) for w in own] == hashes.tolist()


def test_edge_rows(spark):
    docs = documents(spark)
    out = S.remove_repeats(docs)
    assert set(out.columns) == set(docs.columns) | {"n_words", "n_removed"} and out.count() == docs.count()
    by_id = {}
    for r in out.collect():
        by_id.setdefault(r["doc_id"], []).append(r)
    assert by_id[3][0]["n_words"] == by_id[4][0]["n_words"] == by_id[5][0]["n_words"] == 0 and by_id[3][0]["text"] == ""
    # The long text repeats three words: only what its first windows cover stays.
    assert by_id[6][0]["n_words"] == len(LONG.split()) and by_id[6][0]["n_removed"] == len(LONG.split()) - 3
    assert [r["n_removed"] for r in by_id[7]] == [0, 0] and by_id[None][0]["n_words"] == 5
    assert all(r["a.b"] == "dot" and r["spans"] == "own" for rs in by_id.values() for r in rs)
    assert S.remove_repeats(docs.limit(0)).count() == 0


def test_rows_without_id_and_rows_that_share_one(spark):
    words = " ".join(f"w{i}" for i in range(30))
    rows = [(None, words), (None, words + " more"), (2, words), (2, words), (1, words + " end"), (5, "x " + words)]
    out = S.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_removed"]) for r in out)
    assert got == [(False, 1, 0), (False, 2, 30), (False, 2, 30), (False, 5, 30), (True, 0, 30), (True, 0, 30)]
    # Equal rows are one document: nothing stands earlier.
    out = S.remove_repeats(spark.createDataFrame([(2, words), (2, words)], "doc_id long, text string")).collect()
    assert [r["n_removed"] for r in out] == [0, 0]
