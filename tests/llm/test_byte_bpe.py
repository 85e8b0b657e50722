import base64
import hashlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from edge import LONG, documents
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import TESTDATA
from stratalake.llm import byte_bpe

PATH = P.path("byte_bpe_50k.tiktoken")
TOKENS = byte_bpe.read_ranks(PATH)
MERGES = byte_bpe.merges_of(TOKENS)
ENCODE = byte_bpe.text_encoder(TOKENS, MERGES, P.PATTERN)
REFERENCE = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks={t: i for i, t in enumerate(TOKENS)}, special_tokens={})


def ids(text):
    return byte_bpe.unpack(ENCODE(text)).tolist()


def test_ranks():
    with open(PATH, "rb") as f:
        first = f.readline().split()
    assert TOKENS[int(first[1])] == base64.b64decode(first[0]) and len(TOKENS) == 50_256


def test_merges_make_their_tokens():
    for i, (a, b) in enumerate(MERGES.tolist()):
        assert TOKENS[i] == (TOKENS[a] if a == i else TOKENS[a] + TOKENS[b])


@pytest.mark.parametrize("text", ["", None, " ", "a" * 5000, "<|endoftext|>", "\x00\x01", "🙂" * 300, "ÄÖÜß naïve", "\r\n\t  x", LONG[:50_000]])
def test_texts(text):
    assert ids(text) == REFERENCE.encode_ordinary(text or "")
    assert byte_bpe.decode(ENCODE(text), TOKENS) == (text or "").encode()


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80) | st.text(alphabet="etaoins", min_size=20, max_size=200))
def test_any_text(text):
    assert ids(text) == REFERENCE.encode_ordinary(text)


@settings(max_examples=100, deadline=None)
@given(st.binary(min_size=1, max_size=60))
def test_any_bytes_as_one_piece(data):
    """Step-by-step merging is the meaning of the ids."""
    ranks = {t: i for i, t in enumerate(TOKENS)}
    parts = [data[i : i + 1] for i in range(len(data))]
    while True:
        found = min(((ranks.get(a + b, 1 << 30), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))), default=(1 << 30, 0))
        if found[0] == 1 << 30:
            break
        parts[found[1] : found[1] + 2] = [parts[found[1]] + parts[found[1] + 1]]
    assert byte_bpe.Encoder(TOKENS, MERGES).encode(data) == [ranks[p] for p in parts]


def test_one_very_long_piece_takes_linear_time():
    assert len(byte_bpe.Encoder(TOKENS, MERGES).encode(b"a" * 300_000)) > 1000


@pytest.mark.parametrize("pieces", [1, 2, 7, 1000])
def test_memo_of_any_size_changes_nothing(pieces):
    encode = byte_bpe.text_encoder(TOKENS, MERGES, P.PATTERN, pieces)
    text = " ".join(f"piece{i % 40} once{i}" for i in range(300)) + " " + "x" * 100
    for _ in range(2):
        assert byte_bpe.unpack(encode(text)).tolist() == REFERENCE.encode_ordinary(text)
    memo = encode.__closure__
    held = next(c.cell_contents.__self__ for c in memo if isinstance(getattr(c.cell_contents, "__self__", None), byte_bpe._Memo))
    assert len(held) + len(held.older) <= max(2, pieces) and all(len(p) <= byte_bpe.MEMO_LENGTH for p in held)


def test_documents_round_trip(spark):
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet").select("doc_id", "text")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in byte_bpe.round_trip(docs, PATH, P.PATTERN).collect():
        want = REFERENCE.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(want)
        assert r["ids_sha256"] == hashlib.sha256(np.array(want, dtype="<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_edge_rows(spark):
    docs = documents(spark)
    made = byte_bpe.decode_ids(byte_bpe.encode_texts(docs, PATH, P.PATTERN, into="tokens"), PATH, "tokens")
    assert set(docs.columns) <= set(made.columns)
    rows = made.collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert bytes(r["decoded"]) == (r["text"] or "").encode()
        assert r["tokens"] == REFERENCE.encode_ordinary(r["text"] or "")
    assert byte_bpe.encode_texts(docs, PATH, P.PATTERN).columns.count("ids") == 1
    assert byte_bpe.round_trip(docs.limit(0), PATH, P.PATTERN).count() == 0


@pytest.mark.parametrize("pairs", [0, 1, 7])
def test_few_remembered_pairs_change_nothing(pairs):
    few = byte_bpe.text_encoder(TOKENS, MERGES, P.PATTERN, 1, pairs)
    for text in ("unbelievable internationalisation xyzzyqqjj", "Donaudampfschifffahrtsgesellschaft", "a" * 500, "日本語のテキスト"):
        assert few(text) == ENCODE(text)
