"""The queries of the numbered operators over the whole tables, with SQL twins where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from vigilframe.llm import alignment, bytepairs, collocations, jaccard, language, ledger, lines, mixing, postings, quality, samples, secrets, substrings, toxicity
from vigilframe.plans.catalog import query
from vigilframe.session import materialize


def table(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query("op4_mix_sources")
def op4_mix_sources(spark, sf):
    sized = table(spark, sf, "documents").select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    mix = mixing.mix_sources(materialize(sized, "sizes"))
    return mix.select(
        "doc_id", "size", "mix.source_size", "mix.target",
        (F.col("size") * F.size("mix.draws")).cast("bigint").alias("taken"),
        F.transform("mix.draws", lambda d: d["shard"]).alias("shards"))


TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query("op9_benchmark_postings", f"""
    WITH d AS (SELECT doc_id, {TERMS} AS w FROM documents),
    b AS (SELECT item_id, {TERMS} AS w FROM benchmark),
    bw AS (SELECT item_id, w, least(len(w), 13) AS n, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0),
    bwin AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS s FROM bw),
    lens AS (SELECT DISTINCT n FROM bwin),
    starts AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n),
    hit AS (SELECT doc_id, item_id, i, n FROM (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s FROM starts) JOIN bwin USING (n, s)),
    hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY 1),
    found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY 1)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
      sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN found USING (doc_id)""")
def op9_benchmark_postings(spark, sf):
    found = postings.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"), "contaminated")


@query("op6_substring_sketch", r"""
    WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    win AS (SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d)),
    later AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS first FROM win) WHERE doc_id > first),
    gone AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(i, i + 50)) AS p FROM later)),
    word AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
    kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS text FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY 1)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
    FROM d LEFT JOIN kept USING (doc_id)""")
def op6_substring_sketch(spark, sf):
    cut = substrings.dedup_substrings(table(spark, sf, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


LINE_CUT = r"""
    l AS (SELECT doc_id, lang, source, n_chars, text, pieces, list_filter(range(1, len(pieces) + 1), lambda i: regexp_matches(pieces[i], '[^\x20\x09-\x0D]')) AS idx
      FROM (SELECT *, string_split(text, chr(10)) AS pieces FROM docs)),
    lrow AS (SELECT doc_id, pieces, idx, list_transform(idx, lambda i: len(regexp_extract_all(pieces[i], '[^\x20\x09-\x0D]+'))) AS n FROM l),
    lsize AS (SELECT doc_id, pieces, idx, n, size, whole, unnest(range(1, len(idx) - size + 2)) AS i
      FROM lrow, (VALUES (3, false), (1, false), (2, false), (1, true), (2, true)) AS sizes(size, whole) WHERE len(idx) >= size AND (NOT whole OR len(idx) = size)),
    lwin AS (SELECT doc_id, i, size, struct_pack(a := pieces[idx[i]], b := CASE WHEN size > 1 THEN pieces[idx[i + 1]] END, c := CASE WHEN size > 2 THEN pieces[idx[i + 2]] END,
        w := whole) AS s FROM lsize
      WHERE CASE WHEN whole THEN list_sum(n) <= 50 ELSE size = 3 OR list_sum(n[i:i + size - 1]) > 50 END),
    llater AS (SELECT doc_id, i, size FROM (SELECT doc_id, i, size, min(struct_pack(d := doc_id, i := i)) OVER (PARTITION BY size, s) AS first FROM lwin)
      WHERE doc_id > first.d OR (doc_id = first.d AND i > first.i)),
    lgone AS (SELECT doc_id, list(DISTINCT p) AS gone FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM llater) GROUP BY 1),
    lcut AS (SELECT l.doc_id, lang, source, n_chars, len(idx) AS n_lines, coalesce(len(gone), 0) AS n_removed,
        CASE WHEN gone IS NULL THEN text WHEN len(gone) = len(idx) THEN ''
          ELSE array_to_string(list_transform(list_filter(range(1, len(pieces) + 1), lambda i: NOT list_contains(list_transform(gone, lambda p: idx[p]), i)), lambda i: pieces[i]), chr(10)) END AS text
      FROM l LEFT JOIN lgone USING (doc_id))"""


@query("op10_line_winnowing", f"""
    WITH docs AS (SELECT * FROM documents), {LINE_CUT}
    SELECT doc_id, coalesce(n_lines, 0) AS n_lines, n_removed, sha256(coalesce(text, '')) AS kept_sha256 FROM lcut""")
def op10_line_winnowing(spark, sf):
    cut = lines.dedup_lines(table(spark, sf, "documents"))
    return cut.select("doc_id", "lines.n_lines", "lines.n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query("op2_jaccard_blocks", r"""
    WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
    s AS (SELECT DISTINCT doc_id, hash(array_to_string(w[i:i + 4], ' ')) AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
    often AS (SELECT s FROM s GROUP BY 1 HAVING count(*) > 1),
    r AS (SELECT doc_id, s FROM s SEMI JOIN often USING (s)),
    link AS (SELECT a.doc_id AS a, b.doc_id AS b FROM r AS a JOIN r AS b ON a.s = b.s AND a.doc_id < b.doc_id
      JOIN n AS na ON na.doc_id = a.doc_id JOIN n AS nb ON nb.doc_id = b.doc_id
      GROUP BY 1, 2, na.n, nb.n HAVING 100 * count(*) >= 75 * (na.n + nb.n - count(*))),
    edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
    reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, edge.b FROM reach JOIN edge ON reach.b = edge.a)
    SELECT a AS doc_id, coalesce(n, 0) AS n_shingles, component_id FROM (SELECT a, min(b) AS component_id FROM reach GROUP BY 1) LEFT JOIN n ON n.doc_id = a""")
def op2_jaccard_blocks(spark, sf):
    return jaccard.near_duplicates(table(spark, sf, "documents")).select("doc_id", "n_shingles", "component_id")


@query("op7_rule_ledger", r"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    l AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
      WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY 1),
    win AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
    twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS n FROM win) WHERE n > 1),
    r AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY 1),
    m AS (SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
        length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
        length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS n_upper
      FROM d LEFT JOIN l USING (doc_id) LEFT JOIN r USING (doc_id)),
    f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
    SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
      CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
      NOT (base_failed OR 100 * n_symbols > 50 * n_words OR 100 * n_upper > 50 * word_chars
        OR word_chars > 25 * n_words OR word_chars < 2 * n_words) AS kept
    FROM f""")
def op7_rule_ledger(spark, sf):
    book = ledger.ledger(table(spark, sf, "documents").select("doc_id", "text"))
    return ledger.verdicts(book, ledger.POLICIES["v2"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.expr(f"failed_bits & {ledger.mask(ledger.BASE_RULES)} != 0").alias("base_failed"), "kept")


@query("op8_secret_layers")
def op8_secret_layers(spark, sf):
    return secrets.digest(secrets.scan(table(spark, sf, "documents").select("doc_id", "text")))


def by_label(spark, sf, name, folds, out):
    labels = table(spark, sf, "labels").select("doc_id", F.col(name).alias("label"))
    return labels.filter(samples.fold(F.col("doc_id"), folds) != out)


def judged(scored, folds, out, *more):
    return scored.select(
        "doc_id", (samples.fold(F.col("doc_id"), folds) == out).alias("held_out"), "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"), *more)


@query("op1_toxic_sentences")
def op1_toxic_sentences(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = toxicity.score(docs, toxicity.train(docs, by_label(spark, sf, "toxic", 4, 2)))
    spans = F.transform("sentences", lambda s: F.concat_ws(":", s["start"], s["end"]))
    return judged(found, 4, 2, F.array_join(spans, ",").alias("sentences"))


@query("op5_quality_unlabelled")
def op5_quality_unlabelled(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    rest = docs.filter(samples.fold(F.col("doc_id"), 5) != 0)
    return judged(quality.score(docs, quality.train(rest, by_label(spark, sf, "quality", 5, 0))), 5, 0)


def language_model(docs):
    """Trained on the rows outside fold 2 of 4 that have a language."""
    known = docs.filter((samples.fold(F.col("doc_id"), 4) != 2) & F.col("lang").isNotNull())
    return language.train(docs, known.select("doc_id", F.col("lang").alias("label")))


@query("op3_language_chains")
def op3_language_chains(spark, sf):
    docs = table(spark, sf, "documents")
    found = language.predict(docs.select("doc_id", "text"), language_model(docs.select("doc_id", "text", "lang")))
    return found.select("doc_id", (samples.fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")


@query("op11_collocations", r"""
    WITH piece AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS p FROM (SELECT coalesce(lang, 'und') AS lang,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)),
    w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM piece),
    f AS (SELECT lang, k, phrase, count(*) AS a FROM (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
        FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (VALUES (1), (2), (3)) AS sizes(k) WHERE len(w) >= k)) GROUP BY 1, 2, 3),
    total AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY 1),
    c AS (SELECT *, string_split(phrase, ' ') AS parts FROM f WHERE k > 1 AND a >= 10),
    inner_pair AS (SELECT lang, unnest([array_to_string(parts[1:2], ' '), array_to_string(parts[2:3], ' ')]) AS phrase, a AS longer FROM c WHERE k = 3),
    longest AS (SELECT lang, phrase, max(longer) AS longer FROM inner_pair GROUP BY 1, 2),
    kept AS (SELECT c.* FROM c LEFT JOIN longest USING (lang, phrase) WHERE k = 3 OR longer IS NULL OR 100 * longer < 50 * a),
    cut AS (SELECT lang, phrase, k, a, k1, array_to_string(parts[1:k1], ' ') AS head, array_to_string(parts[k1 + 1:k], ' ') AS tail
        FROM (SELECT *, unnest(range(1, k)) AS k1 FROM kept)),
    scored AS (SELECT cut.lang, cut.phrase, cut.a, k1, h.a AS l, t.a AS r,
        CAST((1000000 * CAST(cut.a AS HUGEINT) * cut.a) // (CAST(h.a AS HUGEINT) * t.a) AS BIGINT) AS score
        FROM cut JOIN f AS h ON h.lang = cut.lang AND h.phrase = head AND h.k = k1 JOIN f AS t ON t.lang = cut.lang AND t.phrase = tail AND t.k = cut.k - k1),
    least_cut AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k1) = 1)
    SELECT lang, rank, phrase, a, l, r, n, score
    FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM least_cut) JOIN total USING (lang)
    WHERE rank <= 2000""")
def op11_collocations(spark, sf):
    return collocations.collocations(table(spark, sf, "documents").select("text", "lang"))


@query("op12_byte_bpe")
def op12_byte_bpe(spark, sf):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = bytepairs.encode(table(spark, sf, "documents").select("doc_id", "text"), path, public_tokenizers.PATTERN)
    back = bytepairs.decode(coded.select("doc_id", "ids"), path)
    return back.select(
        "doc_id", F.expr("octet_length(ids) div 4").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op13_align_tokenizers")
def op13_align_tokenizers(spark, sf):
    found = alignment.align(
        table(spark, sf, "documents").select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.PATTERN, digest=True)
    return found.withColumnRenamed("groups", "groups_sha256")
