import pytest
from pyspark.sql import functions as F

from conftest import rows
from vigilframe.operators import compliance as C
from vigilframe.operators import risk

ASSETS = [("a", "A", "high", 0.5, 0.3, 0.2, 1.0), ("default", "D", "low", 0.3, 0.3, 0.4, 1.0)]
ASSET_SCHEMA = ("asset string, name string, criticality string, anomaly_weight double, vulnerability_weight double, "
                "compliance_weight double, total_weight double")


@pytest.fixture
def frames(spark):
    anomalies = spark.createDataFrame([("a", 5.0), ("a", None), ("b", 30.0)], "host string, anomaly_score double")
    vulns = spark.createDataFrame([("a", 10.0), ("c", -4.0)], "host string, vulnerability_score double")
    checks = spark.createDataFrame([("b",)] * 4, "host string")
    return anomalies, vulns, checks, spark.createDataFrame(ASSETS, ASSET_SCHEMA)


def test_scores(frames):
    out = {r["asset"]: r for r in risk.risk_scores(*frames, "2024-01-01").collect()}
    assert out["a"]["score"] == pytest.approx(0.3 * 0.5 + 0.4 * 0.5) and out["a"]["criticality"] == "high"
    assert out["b"]["anomaly_score"] == 1.0 and out["b"]["compliance_score"] == pytest.approx(0.2)
    assert out["b"]["criticality"] == "low" and out["b"]["risk_level"] == "low"
    assert out["c"]["score"] < 0  # only an upper cap


def test_per_asset_weights_and_intel(frames, spark):
    per_asset = {r["asset"]: r["score"] for r in risk.risk_scores(*frames, "2024-01-01", weights="per_asset").collect()}
    assert per_asset["a"] == pytest.approx(0.5 * 0.5 + 0.3 * 0.5)
    contacts = spark.createDataFrame([("a",)] * 5, "host string")
    with_intel = {r["asset"]: r for r in risk.risk_scores(*frames, "2024-01-01", intel=contacts, intel_weight=0.2).collect()}
    assert with_intel["a"]["score"] == pytest.approx(0.35 + 0.2 * 0.5)


def test_levels_are_inclusive(spark):
    df = spark.createDataFrame([(0.7,), (0.4,), (0.39999,)], "s double")
    assert [r[0] for r in df.select(risk.risk_level(F.col("s"))).collect()] == ["high", "medium", "low"]


CHECKS = "framework string, check_name string, status string"


def test_single_failure_document(spark):
    df = spark.createDataFrame([("CIS", "Ensure SSH root login is disabled", "FAIL")], CHECKS)
    doc = C.compliance_document(df, "2024-01-01").first()
    assert doc["compliance_rate"] == 0.0
    assert doc["framework_stats"]["CIS"].asDict() == {
        "pass_rate": 0.0, "total_checks": 1, "passed_checks": 0, "failed_checks": 1}
    assert doc["top_failures"] == {"Ensure SSH root login is disabled": 1}
    assert doc["recommendations"] == ["Disable SSH root login to improve security."]


def test_null_status_framework_and_ties(spark):
    data = [("CIS", n, "FAIL") for n in "fedcba"] + [("CIS", "a", "FAIL"), (None, "x", None), ("CIS", "y", "PASS"), ("CIS", None, "FAIL")]
    df = spark.createDataFrame(data, CHECKS)
    assert rows(C.top_failures(df)) == [("a", 2), ("b", 1), ("c", 1), ("d", 1), ("e", 1)]
    assert C.compliance_rate(df).first()["compliance_rate"] == pytest.approx(1 / 10)
    stats = {r["framework"]: r for r in C.framework_stats(df).collect()}
    assert stats["Unknown"]["total_checks"] == 1 and stats["Unknown"]["passed_checks"] == 0
    assert C.rate_alert(df).count() == 1 and C.rate_alert(df, 0.05).count() == 0


def test_missing_column_and_empty(spark):
    df = spark.createDataFrame([("n", "FAIL")], "check_name string, status string")
    assert rows(C.framework_stats(df))[0][0] == "Unknown"
    empty = spark.createDataFrame([], CHECKS)
    assert C.compliance_document(empty, "2024-01-01").count() == 0 and C.compliance_rate(empty).count() == 0
    assert C.recommendations(empty).count() == 0


def test_risk_by_asset(spark):
    df = spark.sql("SELECT * FROM VALUES ('a', timestamp '2024-01-01', 0.2D), ('a', timestamp '2024-01-02', 0.4D) t(asset, event_ts, score)")
    assert rows(risk.risk_by_asset(df)) == [("a", 0.4, pytest.approx(0.3), 2)]


def test_missing_host_is_unknown(spark):
    df = spark.createDataFrame([("a", 1.0), (None, 2.0), ("unknown", 3.0)], "host string, points double")
    assert sorted(r.host for r in risk.asset_universe(df).collect()) == ["a", "unknown"]
    assert {r.host: r.p for r in risk.component_sums({"p": df}).collect()} == {"a": 1.0, "unknown": 5.0}
