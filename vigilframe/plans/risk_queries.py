"""Risk and compliance queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigilframe.functions.timing import time_range
from vigilframe.operators import compliance as C
from vigilframe.operators import intel, prepare, risk
from vigilframe.plans import views as V
from vigilframe.plans.catalog import query, rounded

LOOKBACK = {"anomaly": "30 DAYS", "vulnerability": "365 DAYS", "compliance": "30 DAYS"}
SHORT = {"anomaly": "1 DAY", "vulnerability": "7 DAYS", "compliance": "7 DAYS"}


def inputs(spark, sf, lookback=None):
    back = lookback or LOOKBACK
    return (
        time_range(V.v_anomalies(spark, sf), "event_ts", back["anomaly"], V.EVENTS_AS_OF),
        time_range(V.v_vulns(spark, sf), "event_ts", back["vulnerability"], V.ORDERS_AS_OF),
        prepare.failed_checks(time_range(V.v_compliance_hosts(spark, sf), "event_ts", back["compliance"], V.ORDERS_AS_OF)),
    )


def _range(view: str, as_of: str, back: str, more: str = "") -> str:
    return (f"SELECT * FROM {view} WHERE event_ts BETWEEN TIMESTAMP '{as_of}' - INTERVAL {back} "
            f"AND TIMESTAMP '{as_of}'{more}")


def _risk_sql(lookback: dict, weights: str = "global", tail: str = "SELECT * FROM scored", intel_weight: float | None = None) -> str:
    w = (dict(a="0.3", v="0.4", c="0.3") if weights == "global" else
         dict(a="anomaly_weight", v="vulnerability_weight", c="compliance_weight"))
    extra_part = "UNION ALL SELECT host, 'i', 1.0::DOUBLE FROM v_observables o JOIN (SELECT DISTINCT type, indicator FROM v_indicators) i ON o.type = i.type AND o.value = i.indicator" if intel_weight is not None else ""
    intel_col = ", least(coalesce(sum(points) FILTER (WHERE part='i'),0)/10.0, 1.0) AS intel_score" if intel_weight is not None else ""
    intel_term = f" + intel_score*{intel_weight}" if intel_weight is not None else ""
    intel_out = ", round(intel_score,6) AS intel_score" if intel_weight is not None else ""
    names = "v_anomalies v_vulns v_compliance_hosts v_assets" + (" v_indicators" if intel_weight is not None else "")
    return V.with_views(names, f"""+
      parts AS (
        SELECT host, 'a' AS part, anomaly_score AS points FROM ({_range('v_anomalies', V.EVENTS_AS_OF, lookback['anomaly'])})
        UNION ALL SELECT host, 'v', vulnerability_score FROM ({_range('v_vulns', V.ORDERS_AS_OF, lookback['vulnerability'])})
        UNION ALL SELECT host, 'c', 0.5::DOUBLE FROM ({_range('v_compliance_hosts', V.ORDERS_AS_OF, lookback['compliance'], " AND status='FAIL'")})
        {extra_part}),
      sums AS (
        SELECT host, least(coalesce(sum(points) FILTER (WHERE part='a'),0)/10.0, 1.0) AS anomaly_score,
          least(coalesce(sum(points) FILTER (WHERE part='v'),0)/20.0, 1.0) AS vulnerability_score,
          least(coalesce(sum(points) FILTER (WHERE part='c'),0)/10.0, 1.0) AS compliance_score {intel_col}
        FROM parts GROUP BY host),
      raw AS (
        SELECT s.*, d.criticality,
          anomaly_score*{w['a']} + vulnerability_score*{w['v']} + compliance_score*{w['c']}{intel_term} AS s
        FROM sums s JOIN v_assets d
          ON d.asset = CASE WHEN s.host IN (SELECT asset FROM v_assets) THEN s.host ELSE 'default' END),
      scored AS (
        SELECT TIMESTAMP '{V.EVENTS_AS_OF}' AS event_ts, host AS asset, round(s,6) AS score,
          CASE WHEN s >= 0.7 THEN 'high' WHEN s >= 0.4 THEN 'medium' ELSE 'low' END AS risk_level,
          round(anomaly_score,6) AS anomaly_score, round(vulnerability_score,6) AS vulnerability_score,
          round(compliance_score,6) AS compliance_score {intel_out}, criticality, 'vigilframe' AS source
        FROM raw)
      {tail}""")


@query("risk_scores", _risk_sql(LOOKBACK))
def risk_scores(spark, sf):
    """Flagship: capped component sums per host, weighted, classified, with the asset row."""
    return rounded(risk.risk_scores(*inputs(spark, sf), V.v_assets(spark, sf), V.EVENTS_AS_OF))


@query("risk_scores_short_lookback", _risk_sql(SHORT))
def risk_scores_short(spark, sf):
    """The same with look-backs of one and seven days."""
    return rounded(risk.risk_scores(*inputs(spark, sf, SHORT), V.v_assets(spark, sf), V.EVENTS_AS_OF))


@query("risk_scores_per_asset_weights", _risk_sql(LOOKBACK, "per_asset"))
def risk_scores_per_asset(spark, sf):
    return rounded(risk.risk_scores(
        *inputs(spark, sf), V.v_assets(spark, sf), V.EVENTS_AS_OF, weights="per_asset"))


@query("risk_with_intel", _risk_sql(LOOKBACK, intel_weight=0.1))
def risk_with_intel(spark, sf):
    """Indicator contacts as a fourth component."""
    indicators = intel.union_feeds(*V.v_feeds(spark, sf))
    contacts = intel.enrich(V.v_beat_logs(spark, sf), indicators, "log_id", ("host",))
    return rounded(risk.risk_scores(
        *inputs(spark, sf), V.v_assets(spark, sf), V.EVENTS_AS_OF, intel=contacts, intel_weight=0.1))


@query("distinct_anomalies", V.with_views("v_anomalies", """
    SELECT host, event_ts, max(anomaly_score) AS anomaly_score FROM v_anomalies GROUP BY 1, 2"""))
def distinct_anomalies(spark, sf):
    """Two detection cycles stored every anomaly; each counts once."""
    stored = V.v_anomalies(spark, sf)
    return risk.distinct_anomalies(stored.unionByName(stored))


@query("asset_universe", V.with_views("v_anomalies v_vulns v_compliance_hosts", f"""
    SELECT host FROM v_anomalies UNION SELECT host FROM v_vulns
    UNION SELECT host FROM v_compliance_hosts WHERE status='FAIL'"""))
def asset_universe(spark, sf):
    return risk.asset_universe(
        V.v_anomalies(spark, sf), V.v_vulns(spark, sf), prepare.failed_checks(V.v_compliance_hosts(spark, sf)))


@query("risk_by_asset", V.with_views("v_anomalies", """
    SELECT host AS asset, round(arg_max(score, day), 11) AS latest_score, round(avg(score), 11) AS mean_score, count(*) AS runs
    FROM (SELECT host, date_trunc('day', event_ts) AS day, least(sum(anomaly_score)/10.0, 1.0)*0.3 AS score
          FROM v_anomalies GROUP BY 1, 2) GROUP BY host"""))
def risk_by_asset(spark, sf):
    """Panel over daily scoring runs of the anomaly component."""
    daily = V.v_anomalies(spark, sf).groupBy("host", F.date_trunc("day", "event_ts").alias("event_ts")).agg(
        F.sum("anomaly_score").alias("points"))
    runs = daily.select(
        F.col("host").alias("asset"), "event_ts",
        (F.least(F.col("points") / risk.CAPS["anomaly"], F.lit(1.0)) * risk.WEIGHTS["anomaly"]).alias("score"))
    return rounded(risk.risk_by_asset(runs), 11)


_STATS = """SELECT framework, round(count(*) FILTER (WHERE status='PASS') / count(*)::DOUBLE, 6) AS pass_rate,
      count(*) AS total_checks, count(*) FILTER (WHERE status='PASS') AS passed_checks,
      count(*) FILTER (WHERE status='FAIL') AS failed_checks
    FROM v_compliance_hosts GROUP BY framework"""
_TOP = """SELECT check_name, count(*) AS failures FROM v_compliance WHERE status='FAIL'
    GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5"""
_ADVICE = "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT DISTINCT {i} AS position, '{text}' AS recommendation FROM v_compliance WHERE status='FAIL' AND check_name='{check}'"
    for i, (check, text) in enumerate(C.REMEDIATIONS, start=1)) + ")"


@query("compliance_rate", V.with_views("v_compliance_hosts", """
    SELECT round(count(*) FILTER (WHERE status='PASS') / count(*)::DOUBLE, 6) AS compliance_rate, count(*) AS total_checks
    FROM v_compliance_hosts"""))
def compliance_rate(spark, sf):
    return rounded(C.compliance_rate(V.v_compliance_hosts(spark, sf)))


@query("framework_stats", V.with_views("v_compliance_hosts", _STATS))
def framework_stats(spark, sf):
    return rounded(C.framework_stats(V.v_compliance_hosts(spark, sf)))


@query("top_failures", V.with_views("v_compliance", _TOP))
def top_failures(spark, sf):
    return C.top_failures(V.v_compliance(spark, sf))


@query("recommendations", V.with_views("v_compliance", _ADVICE))
def recommendations(spark, sf):
    return C.recommendations(V.v_compliance(spark, sf))


@query("compliance_alert", V.with_views("v_compliance_hosts", """
    SELECT * FROM (SELECT round(count(*) FILTER (WHERE status='PASS') / count(*)::DOUBLE, 6) AS compliance_rate,
      count(*) AS total_checks FROM v_compliance_hosts) WHERE compliance_rate < 0.7"""))
def compliance_alert(spark, sf):
    return rounded(C.rate_alert(V.v_compliance_hosts(spark, sf)))


@query("compliance_document", V.with_views("v_compliance_hosts v_compliance", f"""+
    stats AS ({_STATS}), top AS ({_TOP}), advice AS ({_ADVICE})
    SELECT TIMESTAMP '{V.ORDERS_AS_OF}' AS timestamp,
      (SELECT round(sum(passed_checks) / sum(total_checks)::DOUBLE, 6) FROM stats) AS compliance_rate,
      (SELECT string_agg(framework || ':' || passed_checks || '/' || failed_checks || '/' || total_checks, ';' ORDER BY framework) FROM stats) AS framework_stats,
      (SELECT string_agg(check_name || '=' || failures, ';' ORDER BY failures DESC, check_name) FROM top) AS top_failures,
      (SELECT string_agg(recommendation, ';' ORDER BY position) FROM advice) AS recommendations"""))
def compliance_document(spark, sf):
    """The nested summary row, its maps and arrays written out as text for comparison."""
    doc = C.compliance_document(V.v_compliance(spark, sf), V.ORDERS_AS_OF)
    stats = F.transform(F.map_entries("framework_stats"), lambda e: F.concat(
        e["key"], F.lit(":"), e["value"]["passed_checks"], F.lit("/"), e["value"]["failed_checks"], F.lit("/"),
        e["value"]["total_checks"]))
    top = F.transform(F.map_entries("top_failures"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return rounded(doc.select(
        "timestamp", "compliance_rate", F.array_join(stats, ";").alias("framework_stats"),
        F.array_join(top, ";").alias("top_failures"), F.array_join("recommendations", ";").alias("recommendations")))
