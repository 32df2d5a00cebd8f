"""Whole runs: read tables, apply operators, write results.

Each function is one cycle at an explicit `as_of`; repeating it is the caller's business.
Tables are given and left as frames, so any Spark source and sink fits.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilframe.functions.timing import time_range
from vigilframe.operators import alerts, classify, compliance, detect, intel, logs, prepare, risk
from vigilframe.sources import readers, sinks


def collect_logs(spark: SparkSession, types: dict[str, str], as_of: str, out: str, host: str = "unknown") -> None:
    """Append every line of the listed files to the daily log table."""
    sinks.append_daily(readers.ingest_lines(spark, types, as_of, host), out)


def analyze_logs(log_table: DataFrame, as_of: str, out: str, lookback: str = "1 DAY") -> None:
    """Write the log-analysis document of a look-back."""
    recent = time_range(log_table, "event_ts", lookback, as_of)
    sinks.save_document(logs.log_document(recent, as_of), out)


def detect_anomalies(
    metrics: DataFrame, keys: list[str], as_of: str, out: str, lookback: str = "1 HOUR", contamination: float = 0.05,
    algorithms: tuple[str, ...] = ("isolation_forest", "local_outlier_factor"),
) -> None:
    """Append the anomalies of all algorithms over a look-back of metric documents."""
    rows = prepare.metric_features(time_range(metrics, "event_ts", lookback, as_of), keys)
    found = detect.detect_all(rows, prepare.METRIC_FEATURES, keys, algorithms, contamination)
    sinks.append_daily(prepare.anomaly_documents(found, [*keys, "algorithm"]), out)


def score_risk(
    anomalies: DataFrame, vulnerabilities: DataFrame, checks: DataFrame, assets: DataFrame, as_of: str, out: str,
    lookbacks: tuple[str, str, str] = ("1 DAY", "7 DAYS", "7 DAYS"), deduplicate: bool = True,
) -> None:
    """Append the risk score of every asset; stored duplicates of an anomaly count once by default."""
    recent = [
        time_range(table, "event_ts", back, as_of)
        for table, back in zip((anomalies, vulnerabilities, checks), lookbacks)
    ]
    found = risk.distinct_anomalies(recent[0]) if deduplicate else recent[0]
    scored = risk.risk_scores(found, recent[1], prepare.failed_checks(recent[2]), assets, as_of)
    sinks.append_daily(scored, out)


def analyze_compliance(checks: DataFrame, as_of: str, out: str, lookback: str = "7 DAYS") -> None:
    """Write the compliance document of a look-back."""
    sinks.save_document(compliance.compliance_document(time_range(checks, "event_ts", lookback, as_of), as_of), out)


def refresh_intel(
    indicators: DataFrame, log_table: DataFrame, row_id: str, as_of: str, out: str, lookback: str = "1 DAY"
) -> DataFrame:
    """Publish the indicators, split by type, and return the log rows they touch."""
    sinks.save_by_type(intel.publish_indicators(indicators, as_of), out)
    return intel.correlate(time_range(log_table, "event_ts", lookback, as_of), indicators, row_id)


def tune_detectors(metrics: DataFrame, keys: list[str], as_of: str, out: str, lookback: str = "7 DAYS") -> None:
    """Write the best parameters of both detectors with their objective."""
    rows = prepare.metric_features(time_range(metrics, "event_ts", lookback, as_of), keys, drop_featureless=True)
    features = prepare.METRIC_FEATURES
    best = detect.best_params(detect.tune_iforest(rows, features, keys), "isolation_forest").drop("psi").unionByName(
        detect.best_params(detect.tune_lof(rows, features), "local_outlier_factor"))
    sinks.save_document(best.withColumn("chosen_at", F.lit(as_of).cast("timestamp")), out)


def train_classifier(labelled: DataFrame, row_id: str, model_path: str) -> tuple[PipelineModel, DataFrame]:
    """Train on the larger part of the split, save the model, return it with its report."""
    split = classify.train_test_split(readers.require_training(labelled), row_id)
    model = classify.train_classifier(split.where("NOT is_test"))
    sinks.save_model(model, model_path)
    return model, classify.classification_report(classify.classify(model, split.where("is_test")))


def raise_alerts(anomalies: DataFrame, vulnerabilities: DataFrame, checks: DataFrame, tie: str) -> DataFrame:
    """All alert rows of the three tables as `(kind, period, subject, body)`."""
    shape = ["kind", "period", "subject", "body"]
    spikes = alerts.anomaly_alerts(anomalies, ["event_ts", tie]).withColumn("kind", F.lit("anomaly"))
    holes = alerts.vulnerability_alerts(vulnerabilities, ["event_ts", tie], "day").withColumn("kind", F.lit("vulnerability"))
    rate = compliance.rate_alert(checks).select(
        F.lit("compliance").alias("kind"), F.lit(None).cast("timestamp").alias("period"),
        F.format_string("ALERT: compliance rate %.2f%%", 100 * F.col("compliance_rate")).alias("subject"),
        F.lit(None).cast("string").alias("body"))
    return spikes.select(*shape).unionByName(holes.select(*shape)).unionByName(rate)
