"""Indicator, message, alert and panel queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigilframe.operators import alerts, detections, intel, messages, panels, prepare
from vigilframe.functions.severity import severity_at_least
from vigilframe.plans import views as V
from vigilframe.plans.catalog import query, rounded

AS_OF = V.EVENTS_AS_OF
_TS = f"TIMESTAMP '{AS_OF}'"


def _indicators(spark, sf):
    return intel.union_feeds(*V.v_feeds(spark, sf))


@query("indicator_union", V.with_views("v_indicators", f"""
    SELECT type, indicator, threat_level, description, {_TS} AS event_ts FROM v_indicators"""))
def indicator_union(spark, sf):
    return intel.publish_indicators(_indicators(spark, sf), AS_OF)


@query("indicator_counts", V.with_views("v_indicators", """
    SELECT t.type, count(i.indicator) AS indicators
    FROM (VALUES ('ip'), ('domain'), ('url'), ('hash')) t(type) LEFT JOIN v_indicators i ON i.type = t.type GROUP BY 1"""))
def indicator_counts(spark, sf):
    return intel.indicator_counts(_indicators(spark, sf))


_MATCH = """EXISTS (SELECT 1 FROM v_indicators i WHERE i.type = 'ip' AND list_contains(b.ip, i.indicator))
      OR EXISTS (SELECT 1 FROM v_indicators i WHERE i.type = 'domain' AND i.indicator = b.domain)
      OR EXISTS (SELECT 1 FROM v_indicators i WHERE i.type = 'url' AND i.indicator = b.url)
      OR EXISTS (SELECT 1 FROM v_indicators i WHERE i.type = 'hash' AND i.indicator = b.hash)"""
_BEAT = "log_id, host, array_to_string(ip, ',') AS ip, domain, url, hash"


def beat_columns(rows):
    """The rows as the SQL side selects them, all addresses in one text."""
    return rows.select("log_id", "host", F.array_join("ip", ",").alias("ip"), "domain", "url", "hash")


@query("intel_matches", V.with_views("v_beat_logs v_indicators", f"SELECT {_BEAT} FROM v_beat_logs b WHERE {_MATCH}"))
def intel_matches(spark, sf):
    found = intel.correlate(V.v_beat_logs(spark, sf), _indicators(spark, sf), "log_id")
    return beat_columns(found)


@query("intel_match_count", V.with_views("v_beat_logs v_indicators", f"SELECT count(*) AS correlations FROM v_beat_logs b WHERE {_MATCH}"))
def intel_match_count(spark, sf):
    return intel.correlation_count(V.v_beat_logs(spark, sf), _indicators(spark, sf), "log_id")


@query("clean_logs", V.with_views("v_beat_logs v_indicators", f"SELECT {_BEAT} FROM v_beat_logs b WHERE NOT ({_MATCH})"))
def clean_logs(spark, sf):
    left = intel.clean_logs(V.v_beat_logs(spark, sf), _indicators(spark, sf), "log_id")
    return beat_columns(left)


_LISTED = """listed AS (SELECT type, value, entries, worst.d AS description, worst.l AS threat_level
      FROM (SELECT type, indicator AS value, count(*) AS entries, min(struct_pack(r := CASE threat_level WHEN 'critical' THEN 1 WHEN 'high' THEN 2
        WHEN 'medium' THEN 3 ELSE 4 END, d := description, l := threat_level)) AS worst FROM v_indicators GROUP BY 1, 2))"""


@query("intel_enriched", V.with_views("v_observables v_indicators", f"""+ {_LISTED}
    SELECT type, value, log_id, host, threat_level, description, entries
    FROM v_observables JOIN listed USING (type, value)"""))
def intel_enriched(spark, sf):
    return intel.enrich(V.v_beat_logs(spark, sf), _indicators(spark, sf), "log_id", ("host",))


@query("indicator_hits", V.with_views("v_observables v_indicators", f"""+ {_LISTED}
    SELECT type, value, hits, threat_level, description, entries
    FROM (SELECT type, value, count(*) AS hits FROM v_observables GROUP BY 1, 2) JOIN listed USING (type, value)"""))
def indicator_hits(spark, sf):
    return intel.indicator_hits(V.v_beat_logs(spark, sf), _indicators(spark, sf), "log_id")


@query("hash_hits", V.with_views("v_observables v_indicators", """
    SELECT log_id, value AS hash FROM v_observables
    WHERE type = 'hash' AND value IN (SELECT indicator FROM v_indicators WHERE type = 'hash')"""))
def hash_hits(spark, sf):
    """Known bad files: the digest of the whole content is listed."""
    files = V.v_beat_logs(spark, sf).where("hash IS NOT NULL").select("log_id", "hash")
    return intel.correlate(files, _indicators(spark, sf), "log_id")


# ---------------------------------------------------------------------------------- messages

_ERROR = """CASE WHEN type IS NULL THEN 'Invalid message format'
      WHEN type NOT IN ('register','heartbeat','send_data','get_status') THEN 'Unknown message type: ' || type
      WHEN type = 'register' AND (worker_id IS NULL OR worker_type IS NULL) THEN 'Missing worker_id or worker_type'
      WHEN type = 'heartbeat' AND worker_id IS NULL THEN 'Missing worker_id'
      WHEN type = 'send_data' AND (worker_id IS NULL OR data IS NULL) THEN 'Missing worker_id or data' END"""
REPLIES_SQL = V.with_views("v_messages", f"""+
    checked AS (SELECT *, {_ERROR} AS error FROM v_messages),
    gated AS (SELECT *, coalesce(sum(CASE WHEN type = 'register' AND error IS NULL THEN 1 ELSE 0 END)
        OVER (PARTITION BY worker_id ORDER BY event_ts), 0) > 0 AS registered FROM checked)
    SELECT event_id, event_ts, type, worker_id, worker_type, host, data,
      CASE WHEN error IS NOT NULL OR (type IN ('heartbeat','send_data') AND NOT registered) THEN 'error' ELSE 'success' END AS status,
      CASE WHEN error IS NOT NULL THEN error
           WHEN type = 'get_status' THEN NULL
           WHEN type = 'register' THEN 'Worker ' || worker_id || ' registered successfully'
           WHEN NOT registered THEN 'Worker ' || worker_id || ' not registered'
           WHEN type = 'heartbeat' THEN 'Heartbeat received from ' || worker_id
           ELSE 'Data received from ' || worker_id END AS message
    FROM gated""")


@query("message_routing", REPLIES_SQL)
def message_routing(spark, sf):
    return messages.replies(V.v_messages(spark, sf))


@query("registration_gate", f"SELECT event_id, worker_id, substr(data, 1, 100) AS preview FROM ({REPLIES_SQL}) WHERE type = 'send_data' AND status = 'success'")
def registration_gate(spark, sf):
    return messages.accepted_data(V.v_messages(spark, sf)).select("event_id", "worker_id", "preview")


_STATUS = V.with_views("v_messages", f"""+
    ok AS (SELECT * FROM v_messages WHERE worker_id IS NOT NULL AND event_ts <= {_TS}
           AND ((type = 'register' AND worker_type IS NOT NULL) OR type = 'heartbeat')),
    reg AS (SELECT worker_id, arg_max(worker_type, event_ts) AS type, arg_max(coalesce(host, 'unknown'), event_ts) AS host
            FROM ok WHERE type = 'register' GROUP BY 1),
    listed AS (SELECT r.worker_id AS id, r.type, r.host, max(o.event_ts) AS last_heartbeat
            FROM reg r JOIN ok o ON o.worker_id = r.worker_id GROUP BY ALL)
    SELECT id, type, host, last_heartbeat,
      CASE WHEN {_TS} - last_heartbeat > INTERVAL 12 HOURS THEN 'offline' ELSE 'online' END AS status FROM listed""")


@query("worker_status", _STATUS)
def worker_status(spark, sf):
    """Registry listing; workers here signal every few hours, hence the long timeout."""
    return messages.worker_status(V.v_messages(spark, sf), AS_OF, "12 HOURS")


@query("status_listings", V.with_views("v_messages", """+
    ok AS (SELECT * FROM v_messages WHERE worker_id IS NOT NULL
           AND ((type = 'register' AND worker_type IS NOT NULL) OR type = 'heartbeat')),
    asked AS (SELECT event_id, event_ts FROM v_messages WHERE type = 'get_status')
    SELECT event_id, asked.event_ts, worker_id AS id, arg_max(worker_type, ok.event_ts) FILTER (type = 'register') AS type,
      arg_max(coalesce(host, 'unknown'), ok.event_ts) FILTER (type = 'register') AS host, max(ok.event_ts) AS last_heartbeat,
      CASE WHEN asked.event_ts - max(ok.event_ts) > INTERVAL 12 HOURS THEN 'offline' ELSE 'online' END AS status
    FROM asked JOIN (SELECT event_id AS signal_id, event_ts, worker_id, type, worker_type, host FROM ok) ok ON ok.event_ts <= asked.event_ts
    GROUP BY event_id, asked.event_ts, worker_id HAVING count(*) FILTER (type = 'register') > 0"""))
def status_listings(spark, sf):
    """The answers to all status requests: every worker registered by then."""
    return messages.status_listings(V.v_messages(spark, sf), "12 HOURS")


@query("worker_counts", f"SELECT status, count(*) AS workers FROM ({_STATUS}) GROUP BY 1")
def worker_counts(spark, sf):
    return messages.status_counts(messages.worker_status(V.v_messages(spark, sf), AS_OF, "12 HOURS"))


SESSIONS_SQL = V.with_views("v_messages", """+
    s AS (SELECT worker_id, event_ts, lag(event_ts) OVER (PARTITION BY worker_id ORDER BY event_ts) AS prev
          FROM v_messages WHERE type IN ('register', 'heartbeat')),
    g AS (SELECT *, sum(CASE WHEN event_ts - prev <= INTERVAL 12 HOURS THEN 0 ELSE 1 END)
          OVER (PARTITION BY worker_id ORDER BY event_ts ROWS UNBOUNDED PRECEDING) AS session FROM s)
    SELECT worker_id, CAST(session AS BIGINT) AS session, min(event_ts) AS started, max(event_ts) AS ended, count(*) AS signals
    FROM g GROUP BY 1, 2""")


@query("uptime_sessions", SESSIONS_SQL)
def uptime_sessions(spark, sf):
    return messages.uptime_sessions(V.v_messages(spark, sf), 12 * 3600)


# ---------------------------------------------------------------------------------- severity, alerts, panels

_VULN = ["o_orderkey", "event_ts", "host", "severity"]


@query("severity_ordinal", V.with_views("v_vulns", f"""
    SELECT {', '.join(_VULN)} FROM v_vulns WHERE severity IN ('medium', 'high', 'critical')"""))
def severity_ordinal(spark, sf):
    return V.v_vulns(spark, sf).where(severity_at_least(F.col("severity"), "medium")).select(*_VULN)


@query("severity_lexical", V.with_views("v_vulns", f"""
    SELECT {', '.join(_VULN)} FROM v_vulns WHERE lower(severity) >= 'medium'"""))
def severity_lexical(spark, sf):
    """The plain string comparison: it keeps `unknown` and drops `critical` and `high`."""
    return V.v_vulns(spark, sf).where(severity_at_least(F.col("severity"), "medium", "lexical")).select(*_VULN)


_FOOT = "chr(10) || chr(10) || 'This is an automated message.' || chr(10)"
_NL = "chr(10)"
ANOMALY_ALERT_SQL = V.with_views("v_anomalies", f"""+
    r AS (SELECT *, date_trunc('day', event_ts) AS period,
            row_number() OVER (PARTITION BY date_trunc('day', event_ts) ORDER BY event_ts, event_id) AS position FROM v_anomalies),
    c AS (SELECT period, count(*) AS anomalies FROM r GROUP BY 1 HAVING count(*) >= 3),
    l AS (SELECT period, string_agg(position || '. Host: ' || host || {_NL} || '   Score: ' || printf('%.2f', anomaly_score) || {_NL}
            || '   Timestamp: ' || strftime(event_ts, '%Y-%m-%d %H:%M:%S') || {_NL}
            || '   Details: {{"event_id":' || event_id || '}}' || {_NL}, {_NL} ORDER BY position) AS listing
          FROM r WHERE position <= 5 GROUP BY 1)
    SELECT c.period, anomalies, 'ALERT: ' || anomalies || ' security anomalies detected' AS subject,
      'Security Alert: Anomalies Detected' || {_NL} || {_NL} || anomalies || ' anomalies were detected in the last monitoring period.'
        || {_NL} || {_NL} || 'Top 5 Anomalies:' || {_NL} || {_NL} || listing || {_FOOT} AS body
    FROM c JOIN l ON c.period = l.period""")


@query("alert_text", ANOMALY_ALERT_SQL)
def alert_text(spark, sf):
    """Daily anomaly alerts with subject and full body."""
    found = V.v_anomalies(spark, sf).withColumn("details", F.struct("event_id"))
    return alerts.anomaly_alerts(found, ["event_ts", "event_id"])


@query("anomaly_alert", f"SELECT period, anomalies, subject FROM ({ANOMALY_ALERT_SQL})")
def anomaly_alert(spark, sf):
    return alerts.anomaly_alerts(V.v_anomalies(spark, sf), ["event_ts", "event_id"]).select("period", "anomalies", "subject")


@query("vulnerability_alert", V.with_views("v_vulns", f"""+
    s AS (SELECT *, date_trunc('year', event_ts) AS period FROM v_vulns WHERE severity IN ('medium','high','critical')),
    r AS (SELECT *, row_number() OVER (PARTITION BY period ORDER BY event_ts, o_orderkey) AS position FROM s),
    c AS (SELECT period, count(*) AS vulnerabilities FROM s GROUP BY 1),
    l AS (SELECT period, string_agg(position || '. Host: ' || host || {_NL} || '   Service: ' || service || ' on port ' || port || {_NL}
            || '   Severity: ' || severity || {_NL} || '   Description: ' || description || {_NL}, {_NL} ORDER BY position) AS listing
          FROM r WHERE position <= 5 GROUP BY 1)
    SELECT c.period, vulnerabilities, 'ALERT: ' || vulnerabilities || ' medium+ severity vulnerabilities detected' AS subject,
      'Security Alert: Vulnerabilities Detected' || {_NL} || {_NL} || vulnerabilities || ' vulnerabilities with severity >= medium were detected.'
        || {_NL} || {_NL} || 'Top 5 Vulnerabilities:' || {_NL} || {_NL} || listing || {_FOOT} AS body
    FROM c JOIN l ON c.period = l.period"""))
def vulnerability_alert(spark, sf):
    return alerts.vulnerability_alerts(V.v_vulns(spark, sf), ["event_ts", "o_orderkey"])


@query("open_services", V.with_views("v_vulns", """
    SELECT host, services, round(services / sum(services) OVER ()::DOUBLE, 6) AS share
    FROM (SELECT host, count(DISTINCT service) AS services FROM v_vulns GROUP BY 1)"""))
def open_services(spark, sf):
    return rounded(panels.open_services(V.v_vulns(spark, sf)))


_DIGITS = {"cpu_usage": 9, "memory_usage": 9, "load_1m": 7, "network_in_bytes": 7, "network_out_bytes": 7}
_AVGS = ", ".join(f"round(avg({f}), {d}) AS {f}" for f, d in _DIGITS.items())


@query("metrics_over_time", V.with_views("v_features", f"""
    SELECT time_bucket(INTERVAL 5 MINUTES, event_ts) AS window_start, host, {_AVGS}, count(*) AS samples
    FROM v_features GROUP BY 1, 2"""))
def metrics_over_time(spark, sf):
    return rounded(panels.metrics_over_time(prepare.metric_features(V.v_metrics(spark, sf))), **_DIGITS)


@query("sliding_metrics", V.with_views("v_features", f"""
    SELECT time_bucket(INTERVAL 5 MINUTES, event_ts) - i * INTERVAL 5 MINUTES AS window_start, host, {_AVGS}, count(*) AS samples
    FROM v_features, range(12) t(i) GROUP BY 1, 2"""))
def sliding_metrics(spark, sf):
    """Look-back of one hour, evaluated every five minutes."""
    return rounded(panels.metrics_over_time(prepare.metric_features(V.v_metrics(spark, sf)), "1 hour", "5 minutes"), **_DIGITS)


@query("recent_anomalies", V.with_views("v_anomalies", """
    SELECT event_id, event_ts, host, round(anomaly_score, 6) AS anomaly_score FROM v_anomalies
    ORDER BY event_ts DESC, event_id DESC LIMIT 20"""))
def recent_anomalies(spark, sf):
    return rounded(panels.recent_anomalies(V.v_anomalies(spark, sf), "event_id"))


@query("dedup_anomalies", V.with_views("v_anomalies", """
    SELECT host, event_ts, min(event_id) AS event_id FROM v_anomalies GROUP BY 1, 2"""))
def dedup_anomalies(spark, sf):
    """Overlapping detection cycles store the same anomaly again; one copy survives."""
    rows = V.v_anomalies(spark, sf).select("event_id", "event_ts", "host")
    return prepare.deduplicate(rows.unionByName(rows), ["host", "event_ts"])


@query("rule_coverage", V.with_views("v_logs v_vulns v_beat_logs v_indicators", f"""+
    hits AS (
      SELECT 'brute force' AS scenario, 'logs' AS dataset, (SELECT count(*) FROM (SELECT 1 FROM v_logs WHERE contains(message,'Failed password for')
          OR contains(message,'Invalid user') GROUP BY date_trunc('day', event_ts), host, regexp_extract(message, 'from ([0-9.]+)', 1) HAVING count(*) >= 2)) AS hits
      UNION ALL SELECT 'sudo abuse', 'logs', (SELECT count(*) FROM (SELECT 1 FROM v_logs WHERE contains(message,'sudo')
          GROUP BY date_trunc('day', event_ts), host HAVING count(*) >= 3))
      UNION ALL SELECT 'malicious file', 'beat_logs', (SELECT count(*) FROM v_beat_logs WHERE hash IN (SELECT indicator FROM v_indicators WHERE type='hash'))
      UNION ALL SELECT 'vulnerability scan', 'vulnerabilities', (SELECT count(*) FROM (SELECT 1 FROM v_vulns
          GROUP BY date_trunc('day', event_ts), host HAVING count(DISTINCT port) >= 3))
      UNION ALL SELECT 'indicator contact', 'beat_logs', (SELECT count(*) FROM v_beat_logs b WHERE {_MATCH})
      UNION ALL SELECT 'service failure', 'logs', (SELECT count(*) FROM (SELECT 1 FROM v_logs GROUP BY host, source
          HAVING max(event_ts) < {_TS} - INTERVAL 12 HOURS)))
    SELECT scenario, dataset, hits, CASE WHEN hits > 0 THEN 'detected' ELSE 'silent' END AS verdict FROM hits"""))
def rule_coverage(spark, sf):
    """Validation matrix: every scenario with its number of detections."""
    rows, vulns = V.v_logs(spark, sf), V.v_vulns(spark, sf)
    beat, indicators = V.v_beat_logs(spark, sf), _indicators(spark, sf)
    files = beat.where("hash IS NOT NULL").select("log_id", "hash")
    return detections.rule_coverage({
        "brute force": ("logs", detections.brute_force(rows, "1 day", 2)),
        "sudo abuse": ("logs", detections.sudo_bursts(rows, "1 day", 3)),
        "malicious file": ("beat_logs", intel.correlate(files, indicators, "log_id")),
        "vulnerability scan": ("vulnerabilities", detections.scan_bursts(vulns, "1 day", 3)),
        "indicator contact": ("beat_logs", intel.correlate(beat, indicators, "log_id")),
        "service failure": ("logs", detections.silent_sources(rows, AS_OF, "12 HOURS")),
    })
