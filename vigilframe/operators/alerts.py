"""Alert rows: thresholds, the first rows of an alert, and its text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigilframe.functions.severity import severity_at_least

HEAD = 5
# Subjects, bodies and this footer are fixed values.
FOOTER = "\n\nThis is an automated message.\n"


def first_rows(df: DataFrame, keys: list[str], order: list, k: int = HEAD) -> DataFrame:
    """The first k rows per key, numbered in `position`.

    The rank filter is pushed below the shuffle as a group limit, so every map task sends
    at most k rows per key, even for a key that holds a third of all rows.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("position", rank).where(F.col("position") <= k)


def _lines(entry: Column) -> Column:
    """Entry texts of one alert, in position order; at most `HEAD` rows are collected."""
    ordered = F.array_sort(F.collect_list(F.struct("position", entry.alias("text"))))
    return F.array_join(F.transform(ordered, lambda row: row["text"]), "\n")


def anomaly_alerts(df: DataFrame, order: list[str], period: str = "day", threshold: int = 3) -> DataFrame:
    """One alert per period with at least `threshold` anomalies, listing its first five.

    The `details` of an anomaly, where there are any, are listed as JSON.
    """
    details = F.coalesce(F.to_json("details"), F.lit("{}")) if "details" in df.columns else F.lit("{}")
    df = df.withColumn("period", F.date_trunc(period, "event_ts"))
    counts = df.groupBy("period").agg(F.count("*").alias("anomalies")).where(F.col("anomalies") >= threshold)
    entry = F.format_string(
        "%d. Host: %s\n   Score: %.2f\n   Timestamp: %s\n   Details: %s\n", F.col("position"), F.coalesce("host", F.lit("unknown")),
        F.coalesce("anomaly_score", F.lit(0.0)), F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss"), details,
    )
    listed = first_rows(df, ["period"], order).groupBy("period").agg(_lines(entry).alias("listing"))
    subject = F.format_string("ALERT: %d security anomalies detected", "anomalies")
    body = F.concat(
        F.format_string("Security Alert: Anomalies Detected\n\n%d anomalies were detected in the last monitoring "
                        "period.\n\nTop 5 Anomalies:\n\n", "anomalies"),
        F.col("listing"), F.lit(FOOTER),
    )
    return counts.join(listed, "period").select("period", "anomalies", subject.alias("subject"), body.alias("body"))


def vulnerability_alerts(
    df: DataFrame, order: list[str], period: str = "year", severity: str = "medium", mode: str = "ordinal"
) -> DataFrame:
    """One alert per period with any vulnerability of the given severity or worse."""
    severe = df.where(severity_at_least(F.col("severity"), severity, mode)).withColumn(
        "period", F.date_trunc(period, "event_ts"))
    counts = severe.groupBy("period").agg(F.count("*").alias("vulnerabilities"))
    unknown = F.lit("unknown")
    entry = F.format_string(
        "%d. Host: %s\n   Service: %s on port %s\n   Severity: %s\n   Description: %s\n", F.col("position"),
        F.coalesce("host", unknown), F.coalesce("service", unknown), F.coalesce(F.col("port").cast("string"), unknown),
        F.coalesce("severity", unknown), F.coalesce("description", F.lit("")),
    )
    listed = first_rows(severe, ["period"], order).groupBy("period").agg(_lines(entry).alias("listing"))
    subject = F.format_string(f"ALERT: %d {severity}+ severity vulnerabilities detected", "vulnerabilities")
    body = F.concat(
        F.format_string("Security Alert: Vulnerabilities Detected\n\n%d vulnerabilities with severity >= "
                        f"{severity} were detected.\n\nTop 5 Vulnerabilities:\n\n", "vulnerabilities"),
        F.col("listing"), F.lit(FOOTER),
    )
    return counts.join(listed, "period").select(
        "period", "vulnerabilities", subject.alias("subject"), body.alias("body"))
