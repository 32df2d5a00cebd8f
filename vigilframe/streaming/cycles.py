"""Periodic detection and scoring as a stream: cycles in event time, each computed once from a sliding look-back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Job = Callable[[DataFrame, str], DataFrame]


def cycle_batches(root: str, job: Job, period_seconds: int, lookback_seconds: int, delay_seconds: int = 0):
    """`foreachBatch` function that closes cycles at multiples of `period_seconds` of event time.

    Rows are kept as a history by day below `root/history`; only the days of a look-back are read again.  When the latest row
    is `delay_seconds` past a cycle's end, `job(rows, as_of)` runs once on the rows with as_of - look-back < event_ts <= as_of
    and its result becomes `root/results/cycle=<end>`.  How far the cycles have come is written with each batch, after its
    results.  A replayed batch writes the same rows and cycles over its own folders, so nothing is kept twice.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen = batch.agg(F.max(F.unix_seconds("event_ts")).alias("last"), F.min(F.unix_seconds("event_ts")).alias("first")).first()
        before = progress(spark, root, batch_id)
        if seen["last"] is None:
            _keep(spark, root, batch_id, before)
            return
        batch.withColumn("dt", F.to_date("event_ts")).write.mode("overwrite").partitionBy("dt").parquet(f"{root}/history/batch={batch_id}")
        last = max(seen["last"], before["last"]) if before else seen["last"]
        # The first cycle ends at or after the earliest row of the first batch.
        start = before["cycle"] if before else -(-seen["first"] // period_seconds) * period_seconds - period_seconds
        ended = (last - delay_seconds) // period_seconds * period_seconds
        history = spark.read.schema(T.StructType([*batch.schema.fields, T.StructField("dt", T.DateType())])).option("basePath", f"{root}/history").parquet(f"{root}/history/batch=*")
        for end in range(start + period_seconds, ended + 1, period_seconds):
            low, high = F.timestamp_seconds(F.lit(end - lookback_seconds)), F.timestamp_seconds(F.lit(end))
            recent = history.where((F.col("dt") >= F.to_date(low)) & (F.col("dt") <= F.to_date(high)))
            recent = recent.where((F.col("event_ts") > low) & (F.col("event_ts") <= high)).select(*batch.columns)
            as_of = spark.range(1).select(high.cast("string").alias("t")).first()["t"]
            job(recent, as_of).write.mode("overwrite").parquet(f"{root}/results/cycle={end}")
        _keep(spark, root, batch_id, {"cycle": max(start, ended), "last": last})

    return handle


def _keep(spark: SparkSession, root: str, batch_id: int, state: dict | None) -> None:
    rows = [(state["cycle"], state["last"])] if state else []
    spark.createDataFrame(rows, "cycle bigint, last bigint").coalesce(1).write.mode("overwrite").json(f"{root}/progress/batch={batch_id}")


def progress(spark: SparkSession, root: str, batch_id: int) -> dict | None:
    """The last closed cycle and the latest row before a batch, None before the first."""
    if batch_id == 0:
        return None
    rows = spark.read.schema("cycle bigint, last bigint").json(f"{root}/progress/batch={batch_id - 1}").collect()
    return rows[0].asDict() if rows else None


def results(spark: SparkSession, root: str, schema) -> DataFrame:
    """The results of all closed cycles with the instant `cycle_ts` of each."""
    shape = T.StructType([*schema.fields, T.StructField("cycle", T.LongType())])
    found = spark.read.schema(shape).option("basePath", f"{root}/results").parquet(f"{root}/results/cycle=*")
    return found.withColumn("cycle_ts", F.timestamp_seconds("cycle")).drop("cycle")
