"""Time predicates.  `as_of` is always an explicit instant, never the wall clock."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def instant(as_of: str | Column) -> Column:
    return F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else as_of


def time_range(
    df: DataFrame, ts: str, lookback: str, as_of: str | Column, partition: str | None = None
) -> DataFrame:
    """Rows with `as_of - lookback <= ts <= as_of`, both ends included and no row cap.

    Name the date partition column to prune whole partitions as well.
    """
    end = instant(as_of)
    start = end - F.expr(f"INTERVAL {lookback}")
    if partition:
        df = df.where(F.col(partition).between(F.to_date(start), F.to_date(end)))
    return df.where(F.col(ts).between(start, end))


def within_retention(df: DataFrame, ts: str, as_of: str | Column, days: int = 90) -> DataFrame:
    """Rows younger than the retention limit."""
    return df.where(F.col(ts) >= instant(as_of) - F.expr(f"INTERVAL {int(days)} DAYS"))


def backfill_timestamp(df: DataFrame, target: str = "@timestamp", fallback: str = "timestamp") -> DataFrame:
    """Fill a missing event time from the secondary time column."""
    return df.withColumn(target, F.coalesce(F.col(f"`{target}`"), F.col(f"`{fallback}`")))
