"""Overview panels as table queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilframe.operators.prepare import METRIC_FEATURES


def open_services(scans: DataFrame) -> DataFrame:
    """Distinct services per host and their share of all host/service pairs."""
    per_host = scans.groupBy("host").agg(F.countDistinct("service").alias("services"))
    total = per_host.agg(F.sum("services")).scalar()
    return per_host.withColumn("share", F.col("services") / total)


def metrics_over_time(metrics: DataFrame, width: str = "5 minutes", slide: str | None = None) -> DataFrame:
    """Mean of every metric per host and time bucket; overlapping buckets with `slide`.

    Overlapping buckets are built from sums per slide, so a row is not repeated for each
    bucket it falls in; `width` must be a multiple of `slide`.
    """
    pane = F.window("event_ts", slide or width)["start"].alias("window_start")
    sums = {f"s_{f}": F.sum(f) for f in METRIC_FEATURES} | {f"c_{f}": F.count(f) for f in METRIC_FEATURES}
    panes = metrics.groupBy(pane, "host").agg(
        *[c.alias(n) for n, c in sums.items()], F.count("*").alias("samples"))
    if slide:
        bucket = F.window("window_start", width, slide)["start"].alias("window_start")
        panes = panes.groupBy(bucket, "host").agg(
            *[F.sum(n).alias(n) for n in sums], F.sum("samples").alias("samples"))
    means = [F.try_divide(f"s_{f}", f"c_{f}").alias(f) for f in METRIC_FEATURES]
    return panes.select("window_start", "host", *means, "samples")


def recent_anomalies(df: DataFrame, tie: str, k: int = 20) -> DataFrame:
    """The newest k anomalies."""
    return df.orderBy(F.desc("event_ts"), F.desc(tie)).limit(k)
