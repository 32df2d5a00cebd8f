"""Edge rows through every operator, against brute force where there is one, and held-out accuracy."""

import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point

import corpus_pipeline
from vigilframe.session import materialize
from vigilframe.llm import jaccard, language, ledger, lines, mixing, postings, quality, secrets, substrings, toxicity

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, key bigint, score string"


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "Été", "of", "the"]) + str(rng.randrange(60)) for _ in range(n))


def edge_rows():
    long = prose(1, 3000)
    near = prose(2, 120).split()
    texts = ["", None, "  \n\t ", "one", "one", long, long, " ".join(near), " ".join(near[:118] + ["x", "y"]), "a b c d",
             prose(3, 60) + "\n" + prose(4, 60) + "\nline\nline\nline\nline\nline", prose(4, 60) + " tail " + prose(3, 60)]
    rows = [(i, t, "en", None if i % 4 == 0 else "s%d" % (i % 2), 1, "r", 7, "x") for i, t in enumerate(texts)]
    return [*rows, rows[5], rows[3], (None, long, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_jaccard(docs, nothing):
    def shingles(text):
        w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in words(text)]
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = {r[0]: shingles(r[1]) for r in edge_rows() if r[0] is not None}
    root = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if sets[a] and sets[b] and 4 * len(sets[a] & sets[b]) >= 3 * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
    found = jaccard.near_duplicates(docs).collect()
    assert len(found) == len(edge_rows())
    for r in found:
        if r.doc_id is None:
            assert r.component_id is None
        else:
            assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), root[r.doc_id])
    assert jaccard.near_duplicates(nothing).count() == 0


def test_substrings(docs, nothing):
    texts = {r[0]: words(r[1]) for r in edge_rows() if r[0] is not None}
    starts = {}
    for i, w in texts.items():
        for j in range(len(w) - 49):
            key = tuple(w[j:j + 50])
            starts[key] = min(starts.get(key, i), i)
    for r in substrings.dedup_substrings(docs).collect():
        if r.doc_id is None:
            assert r.n_removed == 0
            continue
        w = texts[r.doc_id]
        gone = {p for j in range(len(w) - 49) if starts[tuple(w[j:j + 50])] < r.doc_id for p in range(j, j + 50)}
        assert (r.n_words, r.n_removed, r.kept) == (len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone))
    assert substrings.dedup_substrings(nothing).count() == 0


def test_lines(docs, nothing):
    cut = {r.doc_id: r for r in lines.dedup_lines(docs).collect()}
    assert cut[1].text is None and cut[None].text == edge_rows()[-1][1]
    assert cut[10].text.endswith("\nline\nline\nline\nline\nline") is False and cut[10].lines.n_removed == 4
    assert lines.dedup_lines(docs).columns == [*docs.columns, "lines"]
    assert lines.dedup_lines(nothing).count() == 0


def test_lines_of_many_words(spark):
    a, b, c, d = prose(11, 51), prose(12, 50), prose(13, 30), prose(14, 21)
    texts = [f"x\n{a}\ny\n{b}", f"{a}", f"z\n{b}\nw", f"{c}\n{d}\nu\nv", f"t\n{c}\n \n{d}", "short", "short", "one\ntwo",
             "one\n\ntwo", "two", f"{a}\nx", "short\ntwo\none", f"s\n{a}\ny\nr\n{a}", f"{c}\n{c}"]
    where, gone = {}, {}
    for i, t in enumerate(texts):  # brute force, documents and lines in order
        w = [x for x in t.split("\n") if x.strip()]
        for p in range(len(w)):
            for n in (1, 2, 3):
                part = tuple(w[p:p + n])
                many = sum(len(words(x)) for x in part) > 50
                if len(part) == n and (n == 3 or many or len(w) == n):
                    key = (part, n < 3 and not many)
                    if where.setdefault(key, (i, p)) < (i, p):
                        gone.setdefault(i, set()).update(range(p, p + n))
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    cut = {r.doc_id: r for r in lines.dedup_lines(rows).collect()}
    assert {i: r.lines.n_removed for i, r in cut.items() if r.lines.n_removed} == {i: len(x) for i, x in gone.items()}
    assert [cut[i].text for i in (1, 2, 4, 6, 8, 9, 10, 12)] == ["", texts[2], "t\n ", "", "", "two", "x", "s\nr"]
    old = {r.doc_id: r.lines.n_removed for r in lines.dedup_lines(rows, long_words=None).collect()}
    assert not any(old.values())


def test_mixing(docs, nothing):
    sized = docs.withColumn("size", mixing.word_count(docs["text"]))
    rows = mixing.mix_sources(sized).collect()
    assert len(rows) == len(edge_rows())
    again = mixing.mix_sources(sized).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    total = sum(r["size"] for r in rows)
    assert abs(sum({r.source: r.mix.target for r in rows}.values()) - 1.5 * total) < 1e-6
    assert all(len(r.mix.draws) <= 2 for r in rows)
    assert mixing.mix_sources(nothing.withColumn("size", mixing.word_count(nothing["text"]))).count() == 0


def test_postings(spark, docs, nothing):
    items = spark.createDataFrame([(1, prose(3, 20)), (2, "ONE"), (3, None), (1, prose(3, 20))], "item_id bigint, text string")
    found = {r.doc_id: r for r in postings.contamination(docs, items).collect()}
    assert found[3].n_hit == 1 and found[3].item_ids == ["2"] and found[3].contaminated
    assert found[10].item_ids == ["1"] and found[10].n_hit == 20 and found[11].n_hit == 20
    assert found[1].n_words == 0 and not found[1].contaminated
    assert postings.contamination(nothing, items).count() == 0
    assert postings.contamination(docs, items.limit(0)).filter("contaminated").count() == 0


def test_ledger(docs, nothing):
    book = ledger.ledger(docs)
    assert book.count() == len(edge_rows()) and ledger.ledger(nothing).count() == 0
    effect = {r.rule: r for r in ledger.ablations(book, ledger.POLICIES["v2"]).collect()}
    kept = ledger.verdicts(book, ledger.POLICIES["v2"]).filter("kept").count()
    assert all(r.kept_without == kept + r.failed_alone for r in effect.values())


def test_secrets(spark, nothing):
    import base64
    import gzip

    secret = 'token = "0123456789abcdef0123"'
    url = "".join(f"%{b:02x}" for b in secret.encode())
    packed = base64.b64encode(gzip.compress(secret.encode())).decode()
    twice = base64.b64encode(base64.b64encode(secret.encode())).decode()
    texts = ["é " + secret, "x " + url, "x " + packed + " y", "x " + twice, None, "", "AKIA" + "A" * 16]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id: r for r in secrets.digest(secrets.scan(rows)).collect()}
    assert found[0].spans == "assign:2:31,hex:11:31" and found[0].n_hex == 1
    assert found[1].n_assign == 0 and found[1].spans.startswith("assign:2:")
    assert found[2].spans == f"assign:2:{2 + len(packed)},hex:2:{2 + len(packed)}"
    assert found[3].spans.startswith("assign:2:") and found[4].spans == found[5].spans == ""
    assert found[6].n_access == 1
    assert secrets.scan(nothing).count() == 0


def test_secrets_in_bytes(spark):
    import base64
    import gzip
    import zlib

    secret = b'token = "0123456789abcdef0123"'
    noise = random.Random(5).randbytes(3000)
    b64 = lambda x: base64.b64encode(x).decode()
    members = gzip.compress(b"first ") + gzip.compress(secret[:12]) + b"\0\0" + gzip.compress(secret[12:])
    percent = "".join(f"%{b:02X}" for b in gzip.compress(secret))
    far = b"\n".join(b"line %d" % i for i in range(2_000_000)) + b"\n" + secret  # past the first piece
    layers = [gzip.compress(gzip.compress(secret)), zlib.compress(gzip.compress(b64(secret).encode())), b"\0tar\0" + secret + b"\0",
              "Z\u00fcrich ".encode("latin-1") + secret, members, noise + gzip.compress(secret), gzip.compress(far)]
    texts = [f"x {b64(x)} y" for x in layers] + [f"x {percent} y", "x " + b64(gzip.compress(b"a" * (17 << 20) + b"\n" + secret)) + " y"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id: r for r in secrets.digest(secrets.scan(rows)).collect()}
    for i, text in enumerate(texts):
        assert f"assign:2:{len(text) - 2}" in found[i].spans.split(","), i
        assert found[i].truncated == (i == 8)  # a token of 17 MB is cut; what follows it is searched
    deep = secret
    for _ in range(120):
        deep = gzip.compress(deep)
    assert secrets.scan_text(b64(deep).encode())[2]


def test_models(spark, docs, nothing):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = {r.doc_id: r for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    langs = {r.doc_id: r.lang for r in table.collect()}
    assert all((zlib.crc32(str(r.doc_id).encode()) % 4 == 2) == r.held_out
               for r in entry_point.queries()["op1_toxic_sentences"](spark, "/root/testdata/sf0.01").collect())
    held = [r for r in entry_point.queries()["op3_language_chains"](spark, "/root/testdata/sf0.01").collect() if r.held_out]
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.97 * len(held)
    for name, label, least in (("op1_toxic_sentences", "toxic", 0.9), ("op5_quality_unlabelled", "quality", 0.9)):
        held = [r for r in entry_point.queries()[name](spark, "/root/testdata/sf0.01").collect() if r.held_out and r.doc_id in labels]
        assert sum(r.predicted == labels[r.doc_id][label] for r in held) >= least * len(held)
    no_model = (toxicity.score(docs, None), language.predict(docs, None), quality.score(docs, quality.constant(0.0)))
    assert all(x.count() == len(edge_rows()) for x in no_model)
    assert toxicity.score(nothing, None).count() == language.predict(nothing, None).count() == 0
    model = language.fit([("the house of the rising", "en"), ("das haus der sonne", "de")] * 5, {"en": 5, "de": 5})
    judged = {r.doc_id: r for r in language.predict(docs, model).collect()}
    assert judged[1].lang_pred == "und" and judged[2].lang_pred == "und" and judged[5].lang_pred in ("de", "en")


def test_pipeline_edges(spark, docs, nothing):
    """All five stages on edge rows with clashing column names, one after the other, and on no rows."""
    given = docs.select("doc_id", "text", "lang", "source", "n_chars").withColumns({
        c: F.lit(f"my {c}") for c in ("score", "lines", "key", "row", "words", "mix", "lang_pred", "component_id", "n_hit")})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = materialize(stage(spark, given, SF), name)
        assert kept.columns == given.columns and kept.count() <= given.count(), name
        assert all(kept.filter(f"`{c}` <> 'my {c}'").isEmpty() for c in given.columns[5:]), name
        if name in ("near_duplicates", "decontamination"):
            assert kept.filter("doc_id IS NULL").count() == given.filter("doc_id IS NULL").count(), name
        given = kept
    last = corpus_pipeline.STAGES[-1][1](spark, given, SF)
    assert last.count() == given.count() and last.columns == [*given.columns, *corpus_pipeline.ADDED]
    clash = corpus_pipeline.STAGES[-1][1](spark, given.withColumn("size", F.lit("x")), SF)
    assert dict(clash.dtypes)["size"] == "bigint"
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, nothing.select("doc_id", "text", "lang", "source", "n_chars"), SF)
        assert empty.count() == 0 and empty.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"], name


def test_pipeline_stages_one_by_one(spark):
    """Every stage on rows that it alone must drop or change, nulls and repeats among them."""
    stages = dict(corpus_pipeline.STAGES)
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    item = spark.read.parquet(f"{SF}/benchmark.parquet").filter("size(split(text, ' ')) > 15").first().text
    run = "\n".join(prose(20 + i, 9) for i in range(4))
    rows = [(1, run, "en", "a", 7), (2, f"new line\n{run}", "en", "a", 7), (3, run, "en", "a", 7), (4, item, "en", "b", 1),
            (5, None, None, None, None), (6, "", "en", None, 0), (None, item, "en", "b", 1), (4, item, "en", "b", 1), (7, prose(40, 60), "en", "b", 3)]
    docs = spark.createDataFrame(rows, schema)
    cut = {r.doc_id: (r.text, r.n_chars) for r in stages["line_dedup"](spark, docs, SF).collect()}
    assert cut[2] == ("new line", 8) and 3 not in cut and cut[1] == (run, 7) and cut[5] == (None, None) and cut[6] == ("", 0)
    near = sorted(str(r.doc_id) for r in stages["near_duplicates"](spark, docs, SF).collect())
    assert near == ["1", "2", "4", "4", "5", "6", "7", "None"] or near == ["1", "4", "4", "5", "6", "7", "None"]
    clean = sorted(str(r.doc_id) for r in stages["decontamination"](spark, docs, SF).collect())
    assert clean == ["1", "2", "3", "5", "6", "7"]
    mix = stages["mixing"](spark, docs, SF).collect()
    assert len(mix) == len(rows) and all(r.taken <= 2 * r["size"] for r in mix)
