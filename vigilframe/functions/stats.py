"""Exact order statistics by radix selection, and score scaling; no table is ever sorted."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIGIT = 16  # bits of a pass: at most 65,536 counts for each rank that is looked for


def order_keys(x: np.ndarray) -> np.ndarray:
    """64-bit integers in the order of the doubles: both zeros are one value, NaN is the greatest, as in Spark."""
    bits = np.where(np.isnan(x), np.nan, x + 0.0).view(np.int64)
    return bits ^ ((bits >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))


def key_value(key: int) -> float:
    bits = np.int64(key)
    return float((bits ^ ((bits >> np.int64(63)) & np.int64(0x7FFFFFFFFFFFFFFF))).view(np.float64))


def _digit_counts(shift: int, prefixes: list[int] | None):
    """Rows whose higher bits are one of `prefixes` (all, if None), counted by the bits from `shift` up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = order_keys(batch.column(0).to_numpy(zero_copy_only=False))
            if prefixes is not None:
                keys = keys[np.isin(keys >> np.int64(shift + DIGIT), prefixes)]
            if not len(keys):
                continue
            keys = np.sort(keys)
            digits, first, counts = np.unique(keys >> np.int64(shift), return_index=True, return_counts=True)
            last = first + counts - 1
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (digits, counts, keys[first], keys[last])], ["digits", "n", "least", "most"])
    return run


def order_statistics(df: DataFrame, column: str, ranks: Callable[[int], list[int]]) -> tuple[int, list[float]]:
    """The number n of values that are not NULL, and the values at the zero-based ranks `ranks(n)`, exact for every n.

    Doubles become 64-bit keys in the same order.  A pass counts the keys by their next 16 bits, with the least and the most
    key of each count, and keeps only the counts that hold a wanted rank; once such a count has one key, or after four
    passes, its value is known.  Only counts reach the driver, 65,536 for each rank at most, whatever the table.
    """
    values = df.select(F.col(column).cast("double").alias("x")).where(F.col("x").isNotNull())
    shift, prefixes, n, found, wanted = 64 - DIGIT, None, 0, {}, {}
    while True:
        counted = values.mapInArrow(_digit_counts(shift, prefixes), "digits bigint, n bigint, least bigint, most bigint")
        rows = counted.groupBy("digits").agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most")).collect()
        rows.sort(key=lambda r: r["digits"])
        if prefixes is None:
            n = sum(r["n"] for r in rows)
            wanted = {None: {rank: rank for rank in ranks(n) if 0 <= rank < n}}  # by prefix: rank and what is left of it
        following: dict = {}
        for prefix, left in wanted.items():
            inside = [r for r in rows if prefix is None or r["digits"] >> DIGIT == prefix]
            upto = np.cumsum([r["n"] for r in inside])
            for rank, rest in left.items():
                at = int(np.searchsorted(upto, rest, "right"))
                row = inside[at]
                if row["least"] == row["most"]:
                    found[rank] = key_value(row["least"])
                else:
                    following.setdefault(row["digits"], {})[rank] = rest - int(upto[at] - row["n"])
        if not following:
            return n, [found[rank] for rank in ranks(n) if 0 <= rank < n]
        wanted, prefixes, shift = following, sorted(following), shift - DIGIT


def quantile(df: DataFrame, column: str, share: float) -> float | None:
    """The linearly interpolated quantile; None without values."""

    def around(n: int) -> list[int]:
        low = int((n - 1) * share)
        return [low, min(low + 1, n - 1)]

    n, values = order_statistics(df, column, around)
    if not n:
        return None
    low, high = values
    place = (n - 1) * share
    return low if low == high else low + (high - low) * (place - int(place))


def exact_quantile(df: DataFrame, column: str, share: float) -> DataFrame:
    """One row with column `quantile`."""
    return df.sparkSession.createDataFrame([(quantile(df, column, share),)], "quantile double")


def below_quantile(df: DataFrame, column: str, share: float) -> DataFrame:
    """Rows strictly below the exact quantile; if every value ties none qualifies."""
    return df.where(F.col(column) < F.lit(quantile(df, column, share)).cast("double"))


def inverse_min_max(df: DataFrame, column: str, out: str) -> DataFrame:
    """`1 - (x - min) / (max - min)` over all rows; NULL when all values are equal."""
    low, high = df.agg(F.min(column)).scalar(), df.agg(F.max(column)).scalar()
    return df.withColumn(out, 1 - F.try_divide(F.col(column) - low, high - low))


def dispersion(df: DataFrame, column: str, keys: list[str]) -> DataFrame:
    """Population standard deviation per key set."""
    return df.groupBy(*keys).agg(F.stddev_pop(column).alias("objective"))


def first_best(df: DataFrame, score: str, ordinal: str) -> DataFrame:
    """The row with the highest score; equal scores keep the earliest ordinal."""
    return df.orderBy(F.desc(score), F.asc(ordinal)).limit(1)
