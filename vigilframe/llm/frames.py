"""DataFrame helpers shared by the operators of this folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BROADCAST_ROWS = 200_000


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """`df` marked for broadcast if it holds at most `rows` rows, else as it is, for a shuffled join.

    Meant for written stages of narrow rows, where counting costs little.
    """
    return F.broadcast(df) if df.count() <= rows else df


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only.  Texts of one byte per character take the cheaper general function."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, CAPITALS, SMALL))


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under internal names, so that no other column can clash."""
    return df.select(*[F.col(f"`{name}`").alias(alias) for alias, name in columns.items()])


def small_by(df: DataFrame, weight: Column, rows: int = BROADCAST_ROWS, total: int = 4_000_000) -> DataFrame:
    """Like `small`, for rows with arrays: the sum of `weight` (their lengths) must not be above `total` either."""
    size = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(weight), F.lit(0)).alias("w")).first()
    return F.broadcast(df) if size["n"] <= rows and size["w"] <= total else df


BATCH_BYTES = 8 << 20


def bounded_batches(df: DataFrame) -> DataFrame:
    """`df`, after lowering the session's Arrow batches to 8 MB where they are larger.

    Two tasks of an executor hold several batches each, inside and outside the JVM; a batch of long texts
    of the default 64 MB would count several times.  The setting is read when a plan runs, so it stays.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = str(df.sparkSession.conf.get(key)).lower().rstrip("b")
    if not now.isdigit() or int(now) > BATCH_BYTES:
        df.sparkSession.conf.set(key, str(BATCH_BYTES))
    return df
