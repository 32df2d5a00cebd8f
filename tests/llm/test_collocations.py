"""Filters as exact counters, and phrases against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vigilframe.llm import collocations
from vigilframe.llm import quotient as Q


def entries(grams, width):
    ids = Q.restored(grams.left, grams.right, width)
    return {tuple(k): n for k, n in zip(ids.tolist(), grams.count.tolist())}


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 32), st.integers(0, 6), st.integers(0, 400), st.integers(0, 999))
def test_filters_are_exact(width, shard_bits, n, seed):
    """Counts survive packing, cutting into shards, writing, reading and merging; wide ids take two halves of 48 bits."""
    rng = np.random.default_rng(seed)
    shard_bits = min(shard_bits, Q.half(width))
    expected, parts = Counter(), {}
    for _ in range(3):
        ids = rng.integers(0, min(1 << width, rng.choice([3, 50, 1 << 32])), (n, 3))
        counts = rng.choice([1, 2, 254, 255, 256, 1 << 40], n)
        for k, c in zip(ids.tolist(), counts.tolist()):
            expected[tuple(k)] += c
        whole = Q.summed(*Q.permuted(ids, width), counts, width)
        for shard, data in Q.shards(whole, width, shard_bits):
            parts.setdefault(shard, Q.Merging(width)).add(Q.read(data, shard))
    found = {}
    for shard in parts:
        some = entries(parts[shard].result(), width)
        assert not found.keys() & some.keys()
        found |= some
    assert found == {k: c for k, c in expected.items() if c}


def test_compact():
    rng = np.random.default_rng(3)
    ids = rng.integers(1, 1 << 20, (100_000, 3))
    grams = Q.summed(*Q.permuted(ids, 20), np.ones(len(ids), np.int64), 20)
    assert len(Q.write(grams, 20, 0)) < 8.5 * len(ids)  # 60 bits of key and a counter


def brute(rows, least, best):
    f, n = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    key = lang, tuple(w[i:i + k])
                    f[key] = f.get(key, 0) + 1
    often = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    out = []
    for lang in n:
        rows = []
        for (of, p), a in often.items():
            if of != lang or (len(p) == 2 and any(100 * b >= 50 * a for (o, q), b in often.items() if o == lang and len(q) == 3 and p in (q[:2], q[1:]))):
                continue
            cuts = [(1000000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            rows.append((-score, -a, " ".join(p).encode(), a, f[lang, p[:k]], f[lang, p[k:]]))
        for rank, (score, _, p, a, l, r) in enumerate(sorted(rows)[:best], 1):
            out.append((lang, rank, p.decode(), a, l, r, n[lang], -score))
    return sorted(out)


def texts(seed, n):
    rng = random.Random(seed)
    pool = ["New", "york", "city", "of", "the", "Été", "straße", "a", "b", "\xa0x", "日本"]
    out = []
    for _ in range(n):
        words = []
        for _ in range(rng.randrange(60)):
            words.append(rng.choice(pool) if rng.random() < 0.6 else "new york city" if rng.random() < 0.5 else "und so weiter")
        out.append("".join(w + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ";", ",", "\r\n"]) for w in words))
    return out


@pytest.mark.parametrize("sizes", [(300, 200), (1 << 20, 1 << 20)])
def test_brute(spark, sizes):
    rows = [(t, [None, "und", "en", "de", ""][i % 5]) for i, t in enumerate(texts(1, 150))]
    rows += [(None, "en"), ("", "en"), ("... ,,", "fr"), ("one two", None), rows[2], rows[2]]
    docs = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "text string, lang string, a int, x int, rank int").repartition(3)
    found = collocations.collocations(docs, least=5, best=25, chunk_bytes=sizes[0], shard_grams=sizes[1]).collect()
    assert sorted(tuple(r) for r in found) == brute(rows, 5, 25)


def test_ties_and_sums_beyond_64_bits(spark):
    assert spark.sql(f"SELECT {collocations.score('9000000000', '9000000001', '9000000000')} AS s").first().s == 999999
    assert spark.sql(f"SELECT {collocations.score('a', 'a', 'a')} AS s FROM VALUES (999999999999999) AS t(a)").first().s == 1000000
    rows = [("x y z", "en")] * 5 + [("p q", "en")] * 5
    found = collocations.collocations(spark.createDataFrame(rows, "text string, lang string"), least=5).collect()
    assert sorted(tuple(r) for r in found) == brute(rows, 5, 2000) == [("en", 1, "p q", 5, 5, 5, 25, 1000000), ("en", 2, "x y z", 5, 5, 5, 25, 1000000)]


def test_nothing_and_long_text(spark):
    nothing = spark.createDataFrame([], "text string, lang string")
    assert collocations.collocations(nothing).count() == 0
    assert collocations.collocations(spark.createDataFrame([(None, None), ("", "en")], "text string, lang string")).count() == 0
    long = [("alpha beta gamma delta " * 60_000, "en")]
    found = collocations.collocations(spark.createDataFrame(long, "text string, lang string")).collect()
    assert {(r.phrase, r.a, r.n) for r in found} >= {("alpha beta gamma", 60_000, 240_000), ("delta alpha beta", 59_999, 240_000)}
