"""A corpus from raw documents: language, repeated lines, near-duplicates, benchmark texts, mixture.

Every stage takes (spark, docs, sf_dir), works on all its predecessor kept and returns the columns of
`documents`; the last adds those of the mixture.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilframe.llm import jaccard, language, lines, mixing, postings, queries
from vigilframe.llm.frames import small
from vigilframe.plans.catalog import query
from vigilframe.session import materialize

LEAST_SHARE = 0.3  # of a language in a document; below it, no learned language fits
ADDED = ("size", "source_size", "target", "taken", "shards")


def packed(docs: DataFrame, *names: str) -> DataFrame:
    """The named columns, and the whole input row as `row`, so that no column of it can clash with those of a stage."""
    return docs.select(*names, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def unpacked(rows: DataFrame, docs: DataFrame, **changed) -> DataFrame:
    """The columns of `docs` from `row`, but for the changed ones."""
    return rows.select(*[changed.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def spoken(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or in which no learned language reaches `LEAST_SHARE`, go; so do those of NULL text."""
    found = language.predict(packed(docs, "text"), queries.language_model(docs))
    return unpacked(found.filter((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SHARE)), docs)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later runs of repeated lines are deleted; documents that lose every line go; those of NULL text or id stay."""
    cut = lines.dedup_lines(packed(docs, "doc_id", "text"))
    removed = F.col("lines.n_removed")
    kept = cut.filter((removed == 0) | (removed < F.col("lines.n_lines")))
    size = F.when(removed > 0, F.char_length("text").cast("bigint")).otherwise(F.col("row.n_chars"))
    return unpacked(kept, docs, text=F.col("text"), n_chars=size)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the smallest id stays, with all its rows; rows without an id stay."""
    found = jaccard.near_duplicates(docs.select("doc_id", "text"))
    copies = materialize(found.filter("doc_id <> component_id").select("doc_id").distinct(), "near-copies")
    return docs.join(small(copies), "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go, with all rows of their id and text; documents without words stay."""
    found = postings.contamination(docs.select("doc_id", "text"), queries.table(spark, sf_dir, "benchmark"))
    bad = materialize(found.filter("contaminated").select("key").distinct(), "contaminated")
    keyed = packed(docs, F.xxhash64("doc_id", "text").alias("key"))
    return unpacked(keyed.join(small(bad), "key", "left_anti"), docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its source's target, the words the mix takes of it, and the shards of its draws.

    Texts without words have size 0 and are taken 0 times; a NULL source is one of its own.  Input columns that are named
    like an added one are replaced.
    """
    sized = packed(docs, "doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    mix = mixing.mix_sources(sized)
    return mix.select(
        *[F.col("row").getField(c).alias(c) for c in docs.columns if c not in ADDED], "size", "mix.source_size", "mix.target",
        (F.col("size") * F.size("mix.draws")).cast("bigint").alias("taken"),
        F.transform("mix.draws", lambda d: d["shard"]).alias("shards"))


STAGES = [
    ("language", spoken),
    ("line_dedup", without_repeated_lines),
    ("near_duplicates", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
]
ORACLE_SQL = None  # the language stage is a trained model


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


query("pipeline")(run)
