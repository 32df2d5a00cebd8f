import datetime as dt

import pytest
from pyspark.sql import functions as F

from vigilframe import jobs
from vigilframe.operators import risk
from vigilframe.plans import views as V

SF = "/root/testdata/sf0.001"
AS_OF = V.EVENTS_AS_OF


def test_collect_then_analyze(spark, tmp_path):
    (tmp_path / "auth.log").write_text("sudo: x\nFailed password for y\n\n")
    jobs.collect_logs(spark, {str(tmp_path / "auth.log"): "auth"}, AS_OF, str(tmp_path / "logs"))
    jobs.analyze_logs(spark.read.parquet(str(tmp_path / "logs")), AS_OF, str(tmp_path / "doc"))
    doc = spark.read.json(str(tmp_path / "doc")).first()
    assert doc["pattern_matches"]["sudo_command"] == 1 and doc["auth_logs_count"] == 3 and doc["num_clusters"] == 3


def test_detect_then_score(spark, tmp_path):
    out = str(tmp_path / "anomalies")
    for _ in range(2):  # two overlapping cycles store the same rows
        jobs.detect_anomalies(V.v_metrics(spark, SF), ["event_id"], AS_OF, out, "30 DAYS")
    stored = spark.read.parquet(out).withColumn("dt", F.to_date("event_ts"))
    assert stored.count() == 2 * stored.select("event_id", "algorithm").distinct().count() > 0
    assert risk.distinct_anomalies(stored).count() <= stored.count() // 2
    jobs.score_risk(stored, V.v_vulns(spark, SF), V.v_compliance_hosts(spark, SF), V.v_assets(spark, SF), AS_OF,
                    str(tmp_path / "risk"), ("30 DAYS", "9999 DAYS", "9999 DAYS"))
    scores = spark.read.parquet(str(tmp_path / "risk"))
    assert scores.count() > 0 and scores.where("score < 0 OR score > 1").count() == 0


def test_compliance_intel_and_alerts(spark, tmp_path):
    jobs.analyze_compliance(V.v_compliance(spark, SF), V.ORDERS_AS_OF, str(tmp_path / "c"), "9999 DAYS")
    assert spark.read.json(str(tmp_path / "c")).count() == 1
    logs = V.v_beat_logs(spark, SF).withColumn("event_ts", F.lit(AS_OF).cast("timestamp"))
    feed = V.v_feeds(spark, SF)
    hits = jobs.refresh_intel(feed[0].unionByName(feed[1]), logs, "log_id", AS_OF, str(tmp_path / "i"))
    assert 0 < hits.count() < logs.count()
    kinds = jobs.raise_alerts(
        V.v_anomalies(spark, SF), V.v_vulns(spark, SF).withColumnRenamed("o_orderkey", "event_id"),
        V.v_compliance_hosts(spark, SF), "event_id").groupBy("kind").count().collect()
    assert {r["kind"] for r in kinds} == {"anomaly", "vulnerability", "compliance"}


def test_tuning_and_training(spark, tmp_path):
    jobs.tune_detectors(V.v_metrics(spark, SF), ["event_id"], AS_OF, str(tmp_path / "p"), "2 DAYS")
    best = spark.read.json(str(tmp_path / "p"))
    assert {r["algorithm"] for r in best.collect()} == {"isolation_forest", "local_outlier_factor"}
    data = [(i, f"failed password root{i % 3}", "brute") for i in range(10)] + [(50 + i, f"malware file{i % 3}", "malware") for i in range(10)]
    frame = spark.createDataFrame(data, "id int, message string, threat_type string")
    _, report = jobs.train_classifier(frame, "id", str(tmp_path / "m"))
    assert report.where("class = 'accuracy'").first()["precision"] == pytest.approx(1.0)
    with pytest.raises(ValueError):
        jobs.train_classifier(frame.limit(1), "id", str(tmp_path / "n"))


def test_aliases(spark):
    anomalies = spark.createDataFrame([("web", 1.0)], "host string, anomaly_score double")
    nothing = spark.createDataFrame([], "host string, vulnerability_score double")
    assets = spark.createDataFrame(
        [("10.0.0.1", "n", "high", 0.3, 0.4, 0.3, 1.0), ("default", "d", "low", 0.3, 0.4, 0.3, 1.0)],
        "asset string, name string, criticality string, anomaly_weight double, vulnerability_weight double, "
        "compliance_weight double, total_weight double")
    aliases = spark.createDataFrame([("web", "10.0.0.1")], "host string, asset string")
    row = risk.risk_scores(anomalies, nothing, nothing.select("host"), assets, "2024-01-01", aliases=aliases).first()
    assert (row["asset"], row["criticality"]) == ("web", "high")
    assert row["event_ts"] == dt.datetime(2024, 1, 1)
