"""The trained models against enumeration and difference quotients, and the mixture against its definition."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vigilframe.llm import language, mixing, quality, samples, toxicity


def test_chain_marginals_by_enumeration():
    rng = np.random.default_rng(1)
    scores, move = rng.normal(0, 1, (11, 3)), rng.normal(0, 1, (3, 3))
    chains = np.array([0, 4, 5, 11])
    chance, pairs = language.marginals(scores, chains, move, pairs=True)
    expected, both = np.zeros((11, 3)), np.zeros((3, 3))
    for a, b in zip(chains[:-1], chains[1:]):
        ways = {}
        for path in itertools.product(range(3), repeat=b - a):
            total = sum(scores[a + t, s] for t, s in enumerate(path)) + sum(move[s, u] for s, u in zip(path, path[1:]))
            ways[path] = np.exp(total)
        whole = sum(ways.values())
        for path, weight in ways.items():
            for t, s in enumerate(path):
                expected[a + t, s] += weight / whole
            for s, u in zip(path, path[1:]):
                both[s, u] += weight / whole
    np.testing.assert_allclose(chance, expected, rtol=1e-9)
    np.testing.assert_allclose(pairs, both, rtol=1e-9)


def test_code_switched_text():
    """Words of two languages in one text are labelled word by word, and the document takes the language of most."""
    en, de = "the house of the rising sun is where they have been and this".split(), "das haus der sonne ist wo sie nicht gewesen sind und".split()
    rng = random.Random(2)
    rows = [(" ".join(rng.choices(words, k=30)) + ".", lang) for words, lang in ((en, "en"), (de, "de")) for _ in range(20)]
    model = language.fit(rows, {"en": 20, "de": 20})
    text = "the house is where they have been und das haus der sonne ist nicht gewesen wo sie sind."
    data = np.frombuffer(text.encode(), np.uint8)
    words = language.analysed(data, np.array([0, len(data)]))
    chance, _ = language.marginals(language.emissions(words, model.weights), words.chains, model.move)
    assert [model.langs[k] for k in chance.argmax(axis=1)] == ["en"] * 7 + ["de"] * 11
    lang, score, shares = language.judged(model, pa.array([text, "the sun und.", None, "123"]))
    assert lang[0] == "de" and lang[1] == "en" and lang[2:] == ["und", "und"] and abs(sum(shares[0]) - 1) < 1e-9 and 0.5 < score[0] < 0.8


def descent(negative_risk):
    rng = np.random.default_rng(3)
    edges = [np.arange(3.0)] * quality.COLUMNS
    model = quality.Model(edges, rng.normal(0, 0.05, 4 * quality.COLUMNS), -3.0 if negative_risk else 0.4)
    first = 4 * np.arange(quality.COLUMNS)
    p, u = (rng.integers(0, 4, (n, quality.COLUMNS)) + first for n in (40, 60))
    if negative_risk:
        model.weights[p.ravel()] += 0.1  # P lies above U, so what U has beyond P's part is below zero
    return quality.Descent(model, p, 1.3 if negative_risk else 0.3, 0.05, 0.0), u


@pytest.mark.parametrize("negative_risk", [False, True])
def test_positive_unlabelled_gradient(negative_risk):
    """The slopes are those of the unbiased risk, and those of its negative part turned round where that is below zero."""
    step, u = descent(negative_risk)

    def risks():
        margins_p, margins_u = step.model.margins(step.p), step.model.margins(u)
        loss = lambda z: np.log1p(np.exp(z)).mean()
        return step.prior * loss(-margins_p), loss(margins_u) - step.prior * loss(margins_p)

    by_bin, total, loss = quality.parts(step.model, u)
    slopes, risk = step.gradient(by_bin / len(u), total / len(u), loss / len(u))
    plus, rest = risks()
    assert (rest < 0) == negative_risk and risk == pytest.approx(plus + max(0, rest), rel=1e-6)
    for i in (*range(0, len(step.model.weights), 7), None):
        ends = []
        for move in (1e-5, -1e-5):
            if i is None:
                step.model.bias += move
            else:
                step.model.weights[i] += move
            plus, rest = risks()
            ends.append(-rest if negative_risk else plus + rest)
            if i is None:
                step.model.bias -= move
            else:
                step.model.weights[i] -= move
        assert slopes[-1 if i is None else i] == pytest.approx((ends[0] - ends[1]) / 2e-5, abs=1e-6)


def test_prior_and_border():
    """The prior of separable and of overlapping margins, and the thinnest place as border."""
    rng = np.random.default_rng(4)
    edges = np.linspace(-12, 12, quality.MARGINS + 1)
    p = rng.normal(4, 1, 3000)
    u = np.r_[rng.normal(4, 1, 20_000), rng.normal(-4, 1, 60_000)]
    counts = np.histogram(u, edges)[0]
    assert quality.estimated_prior(p, counts, edges) == pytest.approx(0.25, abs=0.015)
    assert -1.5 < quality.border(counts, edges, 0.25) < 1.5
    near = np.r_[rng.normal(4, 1, 20_000), rng.normal(2, 1, 60_000)]
    assert 0.2 < quality.estimated_prior(p, np.histogram(near, edges)[0], edges) < 0.6
    assert quality.estimated_prior(p, np.zeros(quality.MARGINS), edges) == 0.0


def test_training_reads_all_unlabelled_rows(spark):
    """Positives in a table of unlabelled rows, without any label 0, are told from the rest; and tables without any."""
    rng = random.Random(6)
    good = lambda: " ".join(rng.choice(["river", "stone", "garden", "winter", "letter"]) + "." * (rng.random() < 0.1) for _ in range(60))
    bad = lambda: " ".join(rng.choice(["$$", "##1", "xx", "%", "BUY"]) for _ in range(60))
    rows = [(i, good() if i % 4 == 0 else bad()) for i in range(800)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    labels = spark.createDataFrame([(i, 1) for i in range(0, 200, 4)] + [(1, 0), (None, 1), (3, None)], "doc_id bigint, label int")
    model = quality.train(docs, labels, start=200)
    found = {r.doc_id: r.score >= 0.3 for r in quality.score(docs, model).collect()}
    assert sum(found[i] == (i % 4 == 0) for i, _ in rows) >= 790
    clash = quality.score(docs.withColumn("score", F.lit("x")).withColumn("row", F.lit(1)), model)
    assert clash.columns == ["doc_id", "row", "score"] and dict(clash.dtypes)["score"] == "double"
    assert {r.score > 0.5 for r in quality.score(docs, quality.train(docs.limit(0), labels)).collect()} == {False}
    assert {r.score > 0.5 for r in quality.score(docs, quality.train(docs, labels.limit(0))).collect()} == {False}


def test_samples_are_the_smallest_hashes(spark):
    """The bound on the hashes changes nothing: still the smallest of each label, and all labels' totals."""
    ids = spark.range(20_000).select(F.col("id").alias("doc_id"), (F.col("id") % 5 == 0).cast("int").alias("label"))
    docs = ids.select("doc_id", F.concat(F.lit("t"), "doc_id").alias("text"))
    rows, totals = samples.labelled(docs, ids, 300)
    assert totals == {0: 16_000, 1: 4_000} and len(rows) == 600
    order = ids.withColumn("h", F.xxhash64("doc_id")).orderBy("h").collect()
    for label in (0, 1):
        assert {t for t, k in rows if k == label} == {f"t{r.doc_id}" for r in [r for r in order if r.label == label][:300]}
    few, _ = samples.labelled(docs.limit(3), ids.limit(3), 300)
    assert len(few) <= 3 and samples.labelled(docs, ids.limit(0), 300) == ([], {})


def test_noisy_or(spark):
    """A document's chance is one less the product of its sentences' chances of being clean; offending ones are located."""
    rng = random.Random(7)
    calm, vile = ["good", "day", "walk", "tree", "song"], ["scum", "vermin"]
    say = lambda words, n: " ".join(rng.choices(words, k=n))
    rows = [(f"{say(calm, 6)}. {say(calm + vile * (i % 2), 5)} {'scum vermin' if i % 2 else 'tree song'}. {say(calm, 4)}.", i % 2) for i in range(200)]
    model = toxicity.fit(rows, {0: 100, 1: 100})
    texts = ["good day. scum vermin walk. tree. vermin scum.", "good day. tree song.", "", None, "é good. scum vermin!"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert found[0].score >= 0.3 > found[1].score and found[4].score >= 0.3
    for i, text in enumerate(texts):
        singles = spark.createDataFrame([(k, s + ".") for k, s in enumerate((text or "").rstrip(".!").split(". "))], "doc_id int, text string")
        parts = [r.score for r in toxicity.score(singles, model).collect()]
        assert found[i].score == pytest.approx(max(1 - np.prod([1 - p for p in parts]), toxicity.FLOOR), abs=1e-5)
    assert {texts[0][s.start:s.end].strip() for s in found[0].sentences} == {"scum vermin walk.", "vermin scum."}
    assert [texts[4][s.start:s.end].strip() for s in found[4].sentences] == ["scum vermin!"] and not found[1].sentences


def test_mixture(spark):
    """Takes near every source's target, none above twice its size, shards even, and all rows of the mix in one shard each."""
    rng = random.Random(9)
    rows = [(i, None if i % 11 == 0 else ["hot", "b", "c", "d"][min(3, int(rng.expovariate(1)))], rng.choice([0, 1, 5, 40, 300])) for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, size bigint").repartition(5)
    mix = mixing.mix_sources(docs).cache()
    total, found = sum(r[2] for r in rows), mix.collect()
    by_source = {}
    for r in found:
        at = by_source.setdefault(r.source, [r.mix.target, r.mix.source_size, 0])
        at[2] += r["size"] * len(r.mix.draws)
        assert len(r.mix.draws) <= 2 and len({d.copy for d in r.mix.draws}) == len(r.mix.draws)
    names = [*sorted(s for s in by_source if s is not None), None]
    weight, left, target = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}, 1.5 * total, {}
    open_ = set(names)
    while True:  # targets stop at twice the source's size, the excess is shared anew
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] > 2 * by_source[s][1]}
        if not full:
            break
        target |= {s: 2.0 * by_source[s][1] for s in full}
        left, open_ = left - sum(2 * by_source[s][1] for s in full), open_ - full
    target |= share
    for s, (wanted, size, taken) in by_source.items():
        assert wanted == pytest.approx(target[s]) and abs(taken - wanted) <= max(0.02 * wanted, 600)
    shards = [d.shard for r in found for d in r.mix.draws]
    per = np.bincount(shards, minlength=16)
    assert len(per) == 16 and per.min() > 0.5 * per.mean() and per.max() < 1.6 * per.mean()
    assert mixing.mixed(mix).count() == len(shards)
    again = {(r.doc_id, str(r.mix.draws)) for r in mixing.mix_sources(docs.repartition(2)).collect()}
    assert again == {(r.doc_id, str(r.mix.draws)) for r in found}
