"""Bounded samples of labelled rows for fitting models on the driver."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigilframe.llm.frames import pick


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`; NULL ids count as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def labelled(docs: DataFrame, labels: DataFrame, per_class: int, doc_id: str = "doc_id", text: str = "text",
             label: str = "label") -> tuple[list[tuple[str, object]], dict]:
    """(text, label) of at most `per_class` rows per label, smallest hashes first, and all rows per label.

    `labels` has doc_id and label.  Only ids are ranked, and of these only such as have a hash below a bound that a few more
    than `per_class` rows of the label stay under, so no task ranks all ids of a label; texts are then fetched for the
    chosen ids.
    """
    known = pick(labels, doc_id=doc_id, label=label).filter("doc_id IS NOT NULL AND label IS NOT NULL").distinct()
    totals = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    order = Window.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id")
    rates = {k: min(1.0, (per_class + 8 * math.sqrt(per_class) + 20) / n) for k, n in totals.items()}
    bounds = {k: int(-(1 << 63) + rate * ((1 << 64) - 1)) for k, rate in rates.items() if rate < 1.0}
    if bounds:
        bound = F.create_map(*[F.lit(x) for pair in bounds.items() for x in pair])[F.col("label")]
        known = known.filter(bound.isNull() | (F.xxhash64("doc_id") <= bound))
    chosen = known.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= per_class).drop("rank")
    texts = pick(docs, doc_id=doc_id, text=text).filter("text IS NOT NULL")
    rows = texts.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id", "label"])  # at most per_class ids a label
    return [(r["text"], r["label"]) for r in rows.orderBy("doc_id", "label").select("text", "label").collect()], totals
