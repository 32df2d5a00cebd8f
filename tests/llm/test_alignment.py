"""Alignment against brute force over the libraries' own ids of whole texts."""

import hashlib
import json
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as entry_point
from vigilframe.llm import alignment

SF = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
POOL = [" ", " ", "  ", "\n", "\n ", " \n", "\t", "\xa0", " ", "'s", "a", "b", "the", "é", "ß", "1", "²", "日本", "<|endoftext|>",
        "<s>", "\U0001f600", "՘", "\U00011de0", "࢏", ".", ", ", "aaaa", "\x00", "́", "tion", "ation ", "anno"]


@pytest.fixture(scope="module")
def brute():
    a, b = tokenizers.Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    plain = {c: i for i, c in enumerate(map(chr, [*range(33, 127), *range(161, 173), *range(174, 256)]))}
    letters = {c: ord(c) for c in plain}
    letters |= {chr(256 + k): x for k, x in enumerate(x for x in range(256) if chr(x) not in letters)}

    def tokens(text):
        """(id, bytes) lists of both, empty where the bytes differ from space and text."""
        if not text:
            return [], []
        x = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        y = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]
        whole = (" " + text).encode()
        return (x, y) if b"".join(t for _, t in x) == whole == b"".join(t for _, t in y) else ([], [])

    def everything(texts):
        spans, counts = [], Counter()
        for text in texts:
            both = []
            for ids in tokens(text):
                at, out = 0, []
                for i, t in ids:
                    out.append((i, at, at + len(t)))
                    at += len(t)
                both.append(out)
            links = [(i, j) for i, s, e in both[0] for j, u, v in both[1] if s < v and u < e]
            counts.update(links)
            spans.append((both, links))
        best = {}
        for (_, j), n in counts.items():
            best[j] = max(best.get(j, 0), n)
        out = []
        for (x, y), links in spans:
            ends = sorted({e for _, _, e in x} & {e for _, _, e in y})
            said = ";".join(",".join(str(i) for i, s, e in x if lo <= s < hi) + "|" + ",".join(str(i) for i, s, e in y if lo <= s < hi)
                            for lo, hi in zip([0, *ends], ends))
            out.append((len(x), len(y), len(ends), len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links), said))
        return out

    return everything


def texts(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice(POOL) for _ in range(rng.randrange(25))) for _ in range(n)] + ["", " ", "  ", "a", " a", "a ", "▁", "a▁b", "a  b   c "]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=60), st.lists(st.integers(1, 3), max_size=60), st.sampled_from([1, 100]), st.integers(0, 40))
def test_runs(steps_a, steps_b, scale, alike):
    """Any two lists of lengths with one sum: groups are the stretches between common ends, links the overlaps."""
    steps_a, steps_b = ([scale * s for s in steps_a[:alike] + steps] for steps in (steps_a, steps_b))
    a, b = [sum(steps_a[:i + 1]) for i in range(len(steps_a))], [sum(steps_b[:i + 1]) for i in range(len(steps_b))]
    end = max([*a, *b, 0]) + 1
    a, b = [*a, end], [*b, end]
    runs, groups, links = (x.tolist() for x in alignment.diagonal_runs(np.diff([0, *a]), np.diff([0, *b])))
    single = [(s + t, u + t) for s, u, n in runs for t in range(n)]
    spans = sorted([(i, i + 1, j, j + 1) for i, j in single] + [tuple(g) for g in groups])
    common = sorted(set(a) & set(b))
    assert [(a[y - 1], b[v - 1]) for x, y, u, v in spans] == [(e, e) for e in common]
    assert [s[0] for s in spans] == [0, *[s[1] for s in spans]][:-1]
    overlaps = {(i, j) for i in range(len(a)) for j in range(len(b)) if max([0, *a][i], [0, *b][j]) < min(a[i], b[j])}
    found = single + list(zip(*links))
    assert len(found) == len(overlaps) and set(found) == overlaps


def test_ranks_only_where_they_are_the_same():
    description = json.loads(open(A, encoding="utf-8").read())
    assert alignment.as_ranks(json.dumps(description))
    merges = description["model"]["merges"]
    for change in ({"merges": [merges[1], merges[0], *merges[2:]]}, {"merges": merges[1:]}, {"ignore_merges": True}):
        assert not alignment.as_ranks(json.dumps(description | {"model": description["model"] | change}))
    assert not alignment.as_ranks(json.dumps(description | {"normalizer": {"type": "NFC"}}))


@pytest.mark.parametrize("by_ranks", [False, True])
def test_encoders_alike(by_ranks):
    """Ids from words and pre-tokens equal those of whole texts, or the text has no tokens."""
    a = alignment.ByteLevel(open(A, encoding="utf-8").read(), public_tokenizers.PATTERN, alignment.odd_classes(), by_ranks)
    b = alignment.Pieces(open(B, "rb").read())
    assert b.by_word
    some = [t for t in texts(1, 3000) if t]
    some += ["".join(random.Random(i).choices(["a", " ", "\n", "\t", " b", "\xa0", "."], k=9)) for i in range(2000)]
    encoder, kept = alignment.Encoder(a, b), 0
    for t, (x, y) in zip(some, encoder.packed(some)):
        whole_a, whole_b = a.library.encode(" " + t, add_special_tokens=False).ids, b.library.encode(t)
        joined = [b"".join(k.bytes[i] for i in ids) == (" " + t).encode() for k, ids in ((a, whole_a), (b, whole_b))]
        if all(joined):
            kept += 1
            assert x == b"".join(i.to_bytes(4, "little") for i in whole_a), t
            assert y == b"".join(i.to_bytes(4, "little") for i in whole_b), t
        else:
            assert (x, y) == (b"", b""), t
    assert 4000 < kept < len(some)
    rng = random.Random(3)
    letters = [t for t in map(str.strip, a.library.decode_batch([[i] for i in range(50_000)])) if t.isalpha()]
    glued = ["".join(rng.choices(letters, k=3)) for _ in range(20_000)]
    assert a.ids(glued) == [e.ids for e in a.library.encode_batch_fast(glued, add_special_tokens=False)]
    b.by_word = False  # a vocabulary with pieces across spaces encodes whole texts
    assert alignment.Encoder(a, b).packed(some[:300]) == encoder.packed(some[:300])


@pytest.mark.parametrize("chunk_bytes", [200, 1 << 20])
def test_brute(spark, brute, chunk_bytes):
    some = [*texts(2, 150), None, None]
    rows = [(i, t, "g", "r", 5, 6) for i, t in enumerate(some)] + [(3, some[3], "g", "r", 5, 6), (None, some[4], "g", "r", 5, 6)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, groups string, `row` string, chunk int, n_a int").repartition(3)
    found = alignment.align(docs, A, B, public_tokenizers.PATTERN, chunk_bytes=chunk_bytes)
    assert found.columns == ["doc_id", "row", "chunk", *alignment.RESULTS]
    expected = sorted((str(r[0]), "r", 5, *x) for r, x in zip(rows, brute([r[1] for r in rows])))
    got = sorted((str(r.doc_id), r.row, r.chunk, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) for r in found.collect())
    assert got == expected
    assert any(x[3] for x in expected) and any(not x[3] for x in expected)


def test_long_text_and_nothing(spark, brute):
    long = "the quick annotation, " * 60_000
    docs = spark.createDataFrame([(1, long), (2, "the quick")], "doc_id bigint, text string")
    found = {r.doc_id: r for r in alignment.align(docs, A, B, public_tokenizers.PATTERN).collect()}
    part = brute(["the quick annotation, " * 3])[0]
    assert found[1].groups.startswith(re.sub(";[^;]*$", "", part[-1]))
    assert found[1].n_links == found[1].n_a + found[1].n_b - found[1].n_groups > 100_000
    nothing = spark.createDataFrame([], "doc_id bigint, text string")
    assert alignment.align(nothing, A, B, public_tokenizers.PATTERN).count() == 0


def test_query(spark, brute):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = {r.doc_id: r for r in entry_point.queries()["op13_align_tokenizers"](spark, SF).collect()}
    assert sorted(found) == sorted(docs)
    keys = sorted(docs, key=lambda k: len(docs[k] or ""))
    for k, x in zip(keys[:60], brute([docs[k] for k in keys[:60]])):  # counts are corpus-wide, so not compared here
        r = found[k]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links) == x[:4]
        assert r.groups_sha256 == (hashlib.sha256(x[-1].encode()).hexdigest() if x[-1] else "")
