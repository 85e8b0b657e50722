import random

import numpy as np
import pytest
from edge import documents

from stratalake.llm import ngram_join as nj


def shingle_set(text, width):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\f\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def plain(rows, width, percent):
    """(doc_id, size, component) by comparing every pair."""
    sets = [shingle_set(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return [(doc, len(sets[i]), least.get(find(i))) for i, (doc, _) in enumerate(rows)]


def key(row):
    return tuple((x is not None, x) for x in row)


def check(spark, rows, width=4, percent=85):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [tuple(r) for r in nj.near_duplicates(docs, width, percent).collect()]
    assert sorted(got, key=key) == sorted(plain(rows, width, percent), key=key)


def mutated(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = rng.choice("abcdefgh") + str(rng.randrange(50))
    return words


@pytest.mark.parametrize(("width", "percent"), [(4, 85), (5, 80), (1, 50), (3, 100)])
def test_random_texts(spark, width, percent):
    rng = random.Random(width * 100 + percent)
    rows = []
    for i in range(60):
        base = [rng.choice("abcdefgh") + str(rng.randrange(50)) for _ in range(rng.choice([1, 3, 5, 12, 40, 80, 150]))]
        for _ in range(rng.choice([1, 1, 2, 5])):
            rows.append((len(rows), " ".join(mutated(rng, base, rng.choice([0, 0, 1, 2, 5])))))
    check(spark, rows, width, percent)


def test_a_large_group_of_near_copies_beside_a_common_passage(spark):
    rng = random.Random(5)
    base = [f"w{rng.randrange(500)}" for _ in range(60)]
    passage = [f"p{k}" for k in range(30)]
    rows = [(i, " ".join(mutated(rng, base, rng.choice([1, 1, 2])))) for i in range(120)]
    rows += [(1000 + i, " ".join([f"u{i}_{k}" for k in range(rng.randrange(3, 40))] + passage)) for i in range(120)]
    rows += [(5000 + i, " ".join(base)) for i in range(30)]
    check(spark, rows)


@pytest.mark.parametrize("block", [1024, 16])
def test_large_tiles_are_compared_inside_tasks(spark, monkeypatch, block):
    monkeypatch.setattr(nj, "TILE_PAIRS", 0)
    monkeypatch.setattr(nj, "TILE_BLOCK", block)
    rng = random.Random(8)
    base = [f"w{k}" for k in range(70)]
    check(spark, [(i, " ".join(mutated(rng, base, rng.choice([1, 2, 3, 5])))) for i in range(150)])


def test_chains_are_one_component(spark):
    words = [f"w{k}" for k in range(100)]
    rows = [(40 - i, " ".join([f"x{k}" for k in range(2 * i)] + words[2 * i :])) for i in range(20)]
    check(spark, rows)


def test_hot_keys_take_the_other_way(spark, monkeypatch):
    monkeypatch.setattr(nj, "HOT", 0)
    rng = random.Random(6)
    base = [f"w{k}" for k in range(30)]
    check(spark, [(i, " ".join(mutated(rng, base, rng.choice([0, 1, 1, 8])))) for i in range(80)])


def test_edge_rows(spark):
    docs = documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = [tuple(r) for r in nj.near_duplicates(docs, 5, 80).collect()]
    assert sorted(got, key=key) == sorted(plain(rows, 5, 80), key=key)
    assert nj.near_duplicates(docs.limit(0)).count() == 0
    assert nj.near_duplicates(docs.where("text is null")).first()["component_id"] == 3


def test_words(spark):
    check(spark, [(1, "A B\tC\nd"), (2, "a b c D"), (3, "a\u00a0b c d"), (4, "É b c d"), (5, "é b c d"), (6, "a b c"), (7, "a b c"), (8, "a b c a b c")])


def test_the_threshold_itself_links(spark):
    words = [f"w{k}" for k in range(23)]
    # 20 shingles each; 17 in common and 20 in the union is 85 of 100.
    check(spark, [(1, " ".join(words)), (2, " ".join(words[:20])), (3, " ".join(words[:19]))])


def test_bound_is_from_above():
    rng = np.random.default_rng(4)
    for _ in range(200):
        pool = rng.integers(0, 1 << 62, size=900, dtype=np.uint64)
        a = np.unique(rng.choice(pool, size=rng.integers(1, 700)))
        b = np.unique(rng.choice(pool, size=rng.integers(1, 700)))
        for bits in (1, nj.WIDE_BITS):
            bound = nj.overlap_bound(nj.bitmap(a, bits), len(a), nj.bitmap(b, bits), len(b))
            assert len(np.intersect1d(a, b)) <= bound <= min(len(a), len(b))


def test_bands_and_prefixes():
    for percent in (50, 80, 85, 99, 100):
        for n in range(1, 3000, 7):
            most = 100 * n // percent
            low, high = nj.band(np.array([n, most]), percent)
            assert 0 <= high - low <= 1
            assert 1 <= nj.prefix_length(n, percent) <= n


def test_buckets_grow_with_the_shingles():
    assert [nj.bucket_bits(n) for n in (0, 10**8, 10**10, 10**14)] == [17, 17, 22, 22]
    counts = np.full(1 << 17, nj.HOT_ROWS, dtype=np.int64)
    counts[5] += 1
    # One bucket is beyond what a task may hold, though no more than others.
    assert np.flatnonzero(nj.hot_buckets(counts)).tolist() == [5]
    assert np.flatnonzero(nj.hot_buckets(np.r_[np.ones(99, dtype=np.int64), 900])).tolist() == [99]


@pytest.mark.parametrize("bits", [3, 12])
def test_the_number_of_buckets_changes_nothing(spark, monkeypatch, bits):
    monkeypatch.setattr(nj, "BUCKET_BITS", (bits, bits))
    rng = random.Random(bits)
    base = [f"w{k}" for k in range(30)]
    check(spark, [(i, " ".join(mutated(rng, base, rng.choice([0, 1, 1, 8])))) for i in range(60)])


def test_every_bucket_beyond_a_task_is_hot(spark, monkeypatch):
    monkeypatch.setattr(nj, "HOT_ROWS", 0)
    rng = random.Random(12)
    base = [f"w{k}" for k in range(30)]
    check(spark, [(i, " ".join(mutated(rng, base, rng.choice([0, 1, 1, 8])))) for i in range(60)])
