"""Threat-indicator correlation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilframe.functions.severity import severity_rank
from vigilframe.functions.timing import instant

INDICATOR_TYPES = ("ip", "domain", "url", "hash")


def union_feeds(*feeds: DataFrame) -> DataFrame:
    """All indicator rows of known types, duplicates kept."""
    out = feeds[0]
    for feed in feeds[1:]:
        out = out.unionByName(feed, allowMissingColumns=True)
    return out.where(F.col("type").isin(*INDICATOR_TYPES))


def publish_indicators(df: DataFrame, as_of: str) -> DataFrame:
    return df.withColumn("event_ts", instant(as_of))


def indicator_counts(df: DataFrame) -> DataFrame:
    """Indicators per type, zeros included."""
    counted = df.agg(*[F.count_if(F.col("type") == t).alias(t) for t in INDICATOR_TYPES])
    rows = F.array(*[F.struct(F.lit(t).alias("type"), F.col(t).alias("indicators")) for t in INDICATOR_TYPES])
    return counted.select(F.inline(rows))


def typed(kind: str):
    return lambda value: F.struct(F.lit(kind).alias("type"), value.cast("string").alias("value"))


def observables(logs: DataFrame, row_id: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Narrow `(row_id, type, value)` rows of the observables a log row carries.

    A column of observables holds one, or an array of them; an array's values count once each.
    """
    present = [t for t in INDICATOR_TYPES if t in logs.columns]
    lists = []
    for t in present:
        held = F.col(t)
        many = logs.schema[t].dataType.typeName() == "array"
        values = F.array_distinct(F.coalesce(held, F.array().cast("array<string>"))) if many else F.array(held)
        lists.append(F.transform(values, typed(t)))
    return logs.select(row_id, *keep, F.inline(F.concat(*lists))).where("value IS NOT NULL")


def listed(indicators: DataFrame) -> DataFrame:
    """One row per distinct indicator: level and description of its worst entry, and the number of entries.

    Of entries of the worst level the one with the first description counts (NULL last), so level and description always
    stem from one entry of a feed.  Feeds repeat indicators; folding the copies keeps every join at one partner per value.
    """
    worst = F.min(F.struct(
        (-severity_rank(F.col("threat_level"))).alias("rank"), F.col("description").isNull().alias("none"), "description", "threat_level"))
    return indicators.groupBy("type", F.col("indicator").alias("value")).agg(
        worst.alias("worst"), F.count("*").alias("entries")).select(
        "type", "value", F.col("worst.threat_level").alias("threat_level"), F.col("worst.description").alias("description"), "entries")


def _hits(logs: DataFrame, indicators: DataFrame, row_id: str) -> DataFrame:
    """Distinct ids of log rows with at least one indicator of the matching type."""
    return observables(logs, row_id).join(listed(indicators), ["type", "value"], "left_semi").select(row_id).distinct()


def correlate(logs: DataFrame, indicators: DataFrame, row_id: str) -> DataFrame:
    """Log rows whose ip, domain, url or hash equals an indicator of that same type.

    Four alternatives become one equality on `(type, value)`, so the join hashes instead
    of looping; only ids and values travel, and each row counts once.
    """
    return logs.join(_hits(logs, indicators, row_id), row_id, "left_semi")


def correlation_count(logs: DataFrame, indicators: DataFrame, row_id: str) -> DataFrame:
    return _hits(logs, indicators, row_id).agg(F.count("*").alias("correlations"))


def clean_logs(logs: DataFrame, indicators: DataFrame, row_id: str) -> DataFrame:
    """Log rows without any indicator contact."""
    return logs.join(_hits(logs, indicators, row_id), row_id, "left_anti")


def enrich(logs: DataFrame, indicators: DataFrame, row_id: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per (log row, matching indicator) with the level, description and feed entries."""
    return observables(logs, row_id, keep).join(listed(indicators), ["type", "value"])


def indicator_hits(logs: DataFrame, indicators: DataFrame, row_id: str) -> DataFrame:
    """Contacts per indicator.

    Observables are counted per value before the join, so a value seen in a third of all
    rows joins as one row.
    """
    seen = observables(logs, row_id).groupBy("type", "value").agg(F.count("*").alias("hits"))
    return seen.join(listed(indicators), ["type", "value"])
