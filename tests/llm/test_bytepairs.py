"""Encoding against the tiktoken library and against a plain merge loop, decoding as a round trip."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as entry_point
from vigilframe.llm import bytepairs, pretokens

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
SF = "/root/testdata/sf0.001"
POOL = [" ", "  ", "\n", "\t", "\x85", "\xa0", " ", "\x1c", "'s", "'re", "'", "a", "b", "the", "é", "ß", "1", "²",
        "१", "日本", "<|endoftext|>", "\U0001f600", "՘", "\U00011de0", "࢏", ".", ",", "...", "​", "aaaa", "\x00", "�", "́"]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bytepairs.read_ranks(PATH), special_tokens={})


def ids(packed):
    return np.frombuffer(packed, "<u4").tolist()


def plain(piece, ranks):
    """The lowest rank first, the leftmost pair of that rank first, by scanning all pairs."""
    if piece in ranks:
        return [ranks[piece]]
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while True:
        pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not pairs:
            return [ranks[p] for p in parts]
        i = min(pairs)[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("abc", min_size=2, max_size=5), unique=True, max_size=25), st.lists(st.text("abc", max_size=30), unique=True, max_size=6),
       st.integers(0, 9))
def test_any_ranks(words, pieces, seed):
    """Ranks in any order, also such that a merge makes a pair of a lower rank."""
    order = [bytes([i]) for i in range(256)] + [w.encode() for w in words]
    numbers = list(range(len(order)))
    random.Random(seed).shuffle(numbers)
    ranks = dict(zip(order, numbers))
    found = bytepairs.Merger(ranks).packed(pieces)
    assert [ids(x) for x in found] == [plain(p.encode(), ranks) if p else [] for p in pieces]


def test_interrupted_buckets():
    """Pieces whose merges fall back to lower ranks many times within one bucket."""
    ranks = {bytes([i]): i + 10 for i in range(256)} | {b"ab": 400, b"abc": 2, b"ca": 401, b"abcabc": 1}
    merger = bytepairs.Merger(ranks)
    text = "abc" * 50 + "ab" * 20 + "cab" * 30
    assert ids(merger.packed([text])[0]) == plain(text.encode(), ranks)
    assert merger.queue.top == 0 and not merger.queue.buckets and not merger.queue.heaps and not any(merger.queue.low)


def test_long_piece(library):
    text = "ab" * 40_000 + "a" * 40_000 + "x" * 3
    assert ids(bytepairs.Merger(bytepairs.read_ranks(PATH)).packed([text])[0]) == library.encode_ordinary(text)


def test_texts(spark, library, monkeypatch):
    rng = random.Random(5)
    texts = ["".join(rng.choice(POOL) for _ in range(rng.randrange(40))) for _ in range(600)]
    texts += ["", " ", "  ", "<|endoftext|> <|endoftext|>", "x", "x", "many words of a long text, " * 60_000]  # over LONG_TEXT
    rows = [(i, t, "mine", 1, 2) for i, t in enumerate(texts)] + [(None, "no id", None, 1, 2), (7000, None, "n", 1, 2), (7000, None, "n", 1, 2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids string, `row` int, value int").repartition(3)
    coded = bytepairs.encode(docs, PATH, public_tokenizers.PATTERN)
    assert coded.columns == ["doc_id", "text", "row", "value", "ids"]  # the clashing column is replaced, others are kept
    found = bytepairs.decode(coded, PATH).collect()
    assert len(found) == len(rows) and {(r.row, r.value) for r in found} == {(1, 2)}
    for r in found:
        assert ids(r.ids) == library.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode()


def test_edges(spark):
    nothing = spark.createDataFrame([], "doc_id bigint, text string")
    assert bytepairs.encode(nothing, PATH, public_tokenizers.PATTERN).count() == 0
    odd = spark.createDataFrame([(1, None), (2, bytearray(b"\x00\x00")), (3, bytearray((10**9).to_bytes(4, "little")))], "doc_id bigint, ids binary")
    assert {bytes(r.decoded) for r in bytepairs.decode(odd, PATH).collect()} == {b""}
    bad = spark.sql("SELECT 1L AS doc_id, cast(X'61FF62' AS string) AS text")
    first = bytepairs.decode(bytepairs.encode(bad, PATH, public_tokenizers.PATTERN), PATH).first()
    assert bytes(first.decoded).decode() == "a�b"


def test_forgetting():
    merger = bytepairs.Merger(bytepairs.read_ranks(PATH))
    known = pretokens.Known(merger.packed, room=1500)
    for k in range(50):
        pieces = [f" piece{k}", f"x{k}y", "same"]
        assert known.of(pieces) == merger.packed(pieces)
    assert len(known) < 20


def test_query(spark, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = entry_point.queries()["op12_byte_bpe"](spark, SF).collect()
    assert sorted(r.doc_id for r in found) == sorted(docs)
    for r in found:
        expected = library.encode_ordinary(docs[r.doc_id])
        assert r.n_tokens == len(expected)
        assert r.ids_sha256 == hashlib.sha256(np.array(expected, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()
