"""Event-time streams: hourly counts, uptime sessions, duplicate suppression, indicator hits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilframe.operators.intel import listed, observables
from vigilframe.operators.prepare import METRIC_FEATURES
from vigilframe.session import materialize


def hourly_counts(logs: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Rows per hour, emitted once the watermark passes the hour; later rows are dropped."""
    return (
        logs.withWatermark("event_ts", delay).groupBy(F.window("event_ts", "1 hour").alias("w"))
        .agg(F.count("*").alias("n")).select(F.col("w.start").alias("bucket"), "n")
    )


def sliding_metrics(metrics: DataFrame, width: str = "1 hour", slide: str = "5 minutes", delay: str = "5 minutes") -> DataFrame:
    """Mean of every metric per host over a look-back that moves on by `slide`, emitted when closed."""
    window = F.window("event_ts", width, slide).alias("w")
    means = [F.avg(f).alias(f) for f in METRIC_FEATURES]
    return (
        metrics.withWatermark("event_ts", delay).groupBy(window, "host")
        .agg(*means, F.count("*").alias("samples"))
        .select(F.col("w.start").alias("window_start"), "host", *METRIC_FEATURES, "samples")
    )


def uptime_sessions(messages: DataFrame, timeout: str = "60 seconds", delay: str = "1 minute") -> DataFrame:
    """Heartbeat sessions per worker, emitted when closed."""
    signals = messages.where("type IN ('register', 'heartbeat')")
    return (
        signals.withWatermark("event_ts", delay)
        .groupBy("worker_id", F.session_window("event_ts", timeout).alias("w"))
        .agg(F.count("*").alias("signals"), F.max("event_ts").alias("ended"))
        .select("worker_id", F.col("w.start").alias("started"), "ended", "signals")
    )


def deduplicate(rows: DataFrame, keys: list[str], delay: str = "1 hour") -> DataFrame:
    """First arrival per key while its event time is inside the watermark."""
    return rows.withWatermark("event_ts", delay).dropDuplicatesWithinWatermark(keys)


def match_batches(indicators: DataFrame, row_id: str, out: str):
    """`foreachBatch` function that writes a batch's log rows with an indicator, each once, below `out`.

    The indicators are folded and written once, before the first batch.  Of each batch only observables that are not NULL
    travel, as (id, type, value), to one join; the ids found fetch their rows.  A replayed batch overwrites its own folder.
    """
    known = materialize(listed(indicators).select("type", "value"), "indicators")

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = materialize(batch, "log-batch")
        hits = observables(rows, row_id).join(known, ["type", "value"], "left_semi").select(row_id).distinct()
        rows.join(hits, row_id, "left_semi").write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return handle
