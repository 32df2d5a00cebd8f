"""Registry of named queries and of their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilframe.session import ship

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Instants as zone-less timestamps, so results compare with engines that have no zones."""
    zoned = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
    return df.withColumns({c: F.col(f"`{c}`").cast("timestamp_ntz") for c in zoned}) if zoned else df


def rounded(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    """Round doubles, whose last bits depend on the order of summation."""
    doubles = [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]
    return df.withColumns({c: F.round(c, special.get(c, digits)) for c in doubles}) if doubles else df


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf: str) -> DataFrame:
            ship(spark)
            return plain(fn(spark, sf))

        QUERIES[name] = run
        run.__doc__ = fn.__doc__
        if sql:
            SQL[name] = sql
        return fn

    return register
