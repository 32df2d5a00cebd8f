"""Benchmark decontamination with a distributed positional inverted index (SQL functions only).

One scan of the training texts stores the postings (document, position, term) of every term that the
benchmark uses.  Each benchmark window is looked up by its rarest term: a posting of it, less its offset
in the item, is an alignment of item and document.  The lists of the other terms, moved by their offsets,
are then intersected with the alignments, in a join on (document, position).  A run of matching places at
least as long as a window is an exact phrase match; an alignment with most of a window's words in place
is a proximity match.

Windows with a term that no document has are out before any join.  The benchmark side of a join is
broadcast only if its counted rows are few.  Postings are dealt by document and position, so neither
a frequent term nor a long document lands in one task.

Defined results: NULL or wordless texts have no words and no hits; an item of fewer words than a window
is one window; items without words match nothing; repeated rows get the same result each; other columns
of the inputs are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigilframe.llm.frames import ascii_lower, pick, small
from vigilframe.session import materialize

TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(ascii_lower(text), F.lit("")), F.lit(TERM), F.lit(0))


@dataclass
class Matches:
    documents: DataFrame  # doc_id, key, n_words
    exact: DataFrame  # key, item_id, start, length: maximal runs of matching words, in words of the document
    near: DataFrame  # key, item_id, start, matched: alignments with a window mostly, but not wholly, in place


def find_matches(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", window: int = 13, near: float = 0.7,
) -> Matches:
    words = materialize(pick(items, item_id=item_id, text=item_text).select(
        "item_id", terms(F.col("text")).alias("words")).filter(F.size("words") > 0).distinct().select(
        "item_id", F.xxhash64("item_id", "words").alias("item"), F.size("words").alias("length"),
        F.posexplode("words").alias("at", "term")), "items")
    vocabulary = materialize(words.groupBy("term").agg(F.xxhash64(F.first("term")).alias("t")), "vocabulary")

    texts = pick(docs, doc_id=doc_id, text=text)
    exploded = texts.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), terms(F.col("text")).alias("words")).select(
        "doc_id", "key", F.size("words").alias("n_words"), F.posexplode_outer("words").alias("pos", "term"))
    # The row of the last word, or the only row of a wordless text, is kept for every document.
    known = exploded.join(small(vocabulary), "term", "left").filter(
        F.col("t").isNotNull() | F.col("pos").isNull() | (F.col("pos") == F.col("n_words") - 1))
    index = materialize(known.select("doc_id", "key", "n_words", "pos", "t"), "postings")
    documents = index.filter(F.col("pos").isNull() | (F.col("pos") == F.col("n_words") - 1)).select("doc_id", "key", "n_words")
    postings = index.filter("t IS NOT NULL").select("key", "pos", "t")

    frequency = postings.groupBy("t").agg(F.count(F.lit(1)).alias("df"))
    coded = materialize(words.withColumn("t", F.xxhash64("term")).join(frequency, "t", "left").select(
        "item_id", "item", "length", "at", "t", F.coalesce("df", F.lit(0)).alias("df")), "item-terms")
    span = F.least("length", F.lit(window))
    starts = coded.select("item_id", "item", "length", "at", "t", "df", F.explode(F.sequence(
        F.greatest(F.lit(0), F.col("at") - span + 1), F.least(F.col("at"), F.col("length") - span))).alias("start"))
    rarest = F.min(F.struct("df", "t", "at"))
    windows = starts.groupBy("item_id", "item", "length", "start").agg(rarest.alias("r")).filter("r.df > 0")
    anchors = windows.groupBy("item_id", "item", "length", F.col("r.at").alias("at"), F.col("r.t").alias("t")).agg(
        F.min("start").alias("low"), (F.max("start") + F.max(span)).alias("high"))
    anchors = materialize(anchors, "anchors")

    aligned = postings.join(small(anchors), "t").select(
        "key", "item_id", "item", "length", (F.col("pos") - F.col("at")).alias("shift"), "low", "high")
    aligned = materialize(aligned.distinct(), "alignments")
    places = coded.select("item", "at", "t").groupBy("item").agg(F.array_sort(F.collect_set(F.struct("at", "t"))).alias("places"))
    expected = aligned.join(small(materialize(places, "places"), 20_000), "item").select(
        "key", "item_id", "item", "length", "shift",
        F.explode(F.expr("slice(places, low + 1, high - low)")).alias("p")).select(
        "key", "item_id", "item", "length", "shift", F.col("p.at").alias("at"), F.col("p.t").alias("t"),
        (F.col("shift") + F.col("p.at")).alias("pos")).distinct()
    candidates = materialize(aligned.select("key").distinct(), "candidates")
    held = postings.join(small(candidates), "key", "left_semi").distinct()
    matched = expected.join(held, ["key", "pos", "t"])

    line = Window.partitionBy("key", "item_id", "item", "shift").orderBy("at")
    matched = materialize(matched.withColumns({
        "run": F.col("at") - F.row_number().over(line),
        "ahead": F.count(F.lit(1)).over(line.rangeBetween(0, window - 1)),
        "span": span,
    }), "matched")
    runs = matched.groupBy("key", "item_id", "item", "shift", "run").agg(
        (F.min("at") + F.col("shift")).alias("start"), F.count(F.lit(1)).alias("length"), F.max("span").alias("span"))
    exact = runs.filter("length >= span").select("key", "item_id", "start", "length")
    close = matched.groupBy("key", "item_id", "item", "shift").agg(
        F.max("ahead").alias("matched"), F.max("span").alias("span"), F.min("at").alias("at"))
    close = close.filter((F.col("matched") < F.col("span")) & (F.col("matched") >= near * F.col("span")))
    return Matches(documents, exact, close.select("key", "item_id", (F.col("shift") + F.col("at")).alias("start"), "matched"))


def contamination(docs: DataFrame, items: DataFrame, percent: int = 5, **names) -> DataFrame:
    """Per document: words, words inside benchmark windows, items found, and whether the share reaches `percent`."""
    found = find_matches(docs, items, **names)
    exact = materialize(found.exact, "exact")
    hits = exact.select("key", F.explode(F.sequence("start", F.col("start") + F.col("length") - 1)).alias("pos")).distinct()
    hits = hits.groupBy("key").agg(F.count(F.lit(1)).alias("n_hit"))
    items_hit = exact.groupBy("key").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids"))
    near = found.near.select("key", "item_id").distinct().join(exact.select("key", "item_id").distinct(), ["key", "item_id"], "left_anti")
    near = near.groupBy("key").agg(F.count(F.lit(1)).alias("n_near"))
    out = found.documents.join(hits, "key", "left").join(items_hit, "key", "left").join(near, "key", "left")
    zero = {c: F.coalesce(c, F.lit(0)).cast("bigint") for c in ("n_hit", "n_near")}
    return out.withColumns(zero).select(
        "doc_id", "key", F.col("n_words").cast("bigint").alias("n_words"), "n_hit",
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"), "n_near",
        ((F.col("n_hit") > 0) & (100 * F.col("n_hit") >= percent * F.col("n_words"))).alias("contaminated"))
