"""Log analysis, ingest, parsing and preparation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigilframe.functions import text, timing
from vigilframe.operators import detections, logs, messages, prepare, rule_tables
from vigilframe.plans import views as V
from vigilframe.plans.catalog import query, rounded
from vigilframe.schemas import enforce, schema_of
from vigilframe.session import run_folder
from vigilframe.sources import indices, parsers, readers, sinks
from vigilframe.sources.readers import log_rows

AS_OF = V.EVENTS_AS_OF
_TS = f"TIMESTAMP '{AS_OF}'"
_LOG = "event_id, event_ts, message, log_type, source, host"
_LOG_COLS = _LOG.split(", ")


@query("time_range", V.with_views("v_logs", f"""
    SELECT {_LOG} FROM v_logs WHERE event_ts BETWEEN {_TS} - INTERVAL 7 DAYS AND {_TS}"""))
def time_range(spark, sf):
    """Both ends included, no row cap, pushed down to the scan."""
    return timing.time_range(V.v_logs(spark, sf), "event_ts", "7 DAYS", AS_OF).select(*_LOG_COLS)


@query("retention", V.with_views("v_vulns", f"""
    SELECT o_orderkey, event_ts FROM v_vulns WHERE event_ts >= TIMESTAMP '{V.ORDERS_AS_OF}' - INTERVAL 90 DAYS"""))
def retention(spark, sf):
    return timing.within_retention(V.v_vulns(spark, sf), "event_ts", V.ORDERS_AS_OF).select("o_orderkey", "event_ts")


@query("pattern_tags", V.with_views("v_logs", """
    SELECT event_id, host, message, 'ssh_login_failure' AS pattern FROM v_logs WHERE contains(message, 'Failed password for')
    UNION ALL SELECT event_id, host, message, 'sudo_command' FROM v_logs WHERE contains(message, 'sudo')"""))
def pattern_tags(spark, sf):
    return logs.tag_patterns(V.v_logs(spark, sf)).select("event_id", "host", "message", "pattern")


@query("pattern_counts", V.with_views("v_logs", """
    SELECT 'ssh_login_failure' AS pattern, count(*) FILTER (WHERE contains(message, 'Failed password for')) AS matches FROM v_logs
    UNION ALL SELECT 'sudo_command', count(*) FILTER (WHERE contains(message, 'sudo')) FROM v_logs"""))
def pattern_counts(spark, sf):
    return logs.pattern_counts(V.v_logs(spark, sf))


@query("auth_logs", V.with_views("v_logs", f"SELECT {_LOG} FROM v_logs WHERE contains(source, 'auth')"))
def auth_logs(spark, sf):
    return logs.auth_logs(V.v_logs(spark, sf)).select(*_LOG_COLS)


@query("hourly_counts", V.with_views("v_logs", """
    SELECT date_trunc('hour', event_ts) AS bucket, count(*) AS n FROM v_logs GROUP BY 1"""))
def hourly_counts(spark, sf):
    return logs.hourly_counts(V.v_logs(spark, sf))


@query("round_robin_clusters", V.with_views("v_logs", """
    SELECT 'cluster_' || (i % 10) AS cluster, count(*) AS logs
    FROM (SELECT row_number() OVER (ORDER BY event_ts, event_id) - 1 AS i FROM v_logs) GROUP BY 1"""))
def round_robin_clusters(spark, sf):
    return logs.round_robin_clusters(V.v_logs(spark, sf))


@query("template_clusters", V.with_views("v_logs", r"""
    SELECT trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(message,
        '\b[0-9]{1,3}(\.[0-9]{1,3}){3}\b', '<ip>', 'g'), '\b0x[0-9a-fA-F]+\b', '<hex>', 'g'),
        '\b[0-9a-fA-F]{16,}\b', '<hex>', 'g'), '[0-9]+', '<n>', 'g'), '\s+', ' ', 'g')) AS template,
      count(*) AS logs, min(event_ts) AS first_seen, max(event_ts) AS last_seen
    FROM v_logs GROUP BY 1"""))
def template_clusters(spark, sf):
    return logs.template_clusters(V.v_logs(spark, sf))


@query("log_rate_anomalies", V.with_views("v_logs", """+
    c AS (SELECT host, date_trunc('hour', event_ts) AS bucket, count(*) AS n FROM v_logs GROUP BY 1, 2),
    w AS (SELECT *, coalesce(sum(n) OVER f, 0) AS total, coalesce(sum(n * n) OVER f, 0) AS squares,
            min(bucket) OVER (PARTITION BY host) AS since FROM c
          WINDOW f AS (PARTITION BY host ORDER BY bucket RANGE BETWEEN INTERVAL 12 HOURS PRECEDING AND INTERVAL 1 HOUR PRECEDING)),
    s AS (SELECT *, CAST(total AS DOUBLE) / 12 AS mean, sqrt(CAST(12 * squares - total * total AS DOUBLE) / 132) AS dev FROM w)
    SELECT host, bucket, n, round(mean, 6) AS mean, round(dev, 6) AS dev, round((n - mean) / dev, 6) AS z
    FROM s WHERE bucket >= since + INTERVAL 12 HOURS AND dev > 0 AND (n - mean) / dev >= 2.0"""))
def log_rate_anomalies(spark, sf):
    return rounded(logs.log_rate_anomalies(V.v_logs(spark, sf), trailing=12, z=2.0))


@query("running_counts", """
    SELECT source, n, CAST(sum(n) OVER (ORDER BY source) AS BIGINT) AS total
    FROM (SELECT source, CAST(sum(len(string_split(text, chr(10)))) AS BIGINT) AS n FROM documents GROUP BY source)""")
def running_counts(spark, sf):
    """Lines per file and the cumulative number collected."""
    return logs.running_counts(V.v_lines(spark, sf).select("source"))


@query("log_document", V.with_views("v_logs", f"""
    SELECT {_TS} AS timestamp,
      'ssh_login_failure=' || count(*) FILTER (WHERE contains(message, 'Failed password for'))
        || ';sudo_command=' || count(*) FILTER (WHERE contains(message, 'sudo')) AS pattern_matches,
      CAST(least(count(*), 10) AS INTEGER) AS num_clusters,
      (SELECT string_agg('cluster_' || i, ';' ORDER BY i) FROM range(10) t(i) WHERE i < (SELECT count(*) FROM v_logs)) AS cluster_keys,
      0 AS freq_anomalies, count(*) FILTER (WHERE contains(source, 'auth')) AS auth_logs_count
    FROM v_logs"""))
def log_document(spark, sf):
    doc = logs.log_document(V.v_logs(spark, sf), AS_OF)
    matches = F.transform(F.map_entries("pattern_matches"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return doc.select(
        "timestamp", F.array_join(matches, ";").alias("pattern_matches"), "num_clusters",
        F.array_join("cluster_keys", ";").alias("cluster_keys"), F.size("freq_anomalies").alias("freq_anomalies"),
        "auth_logs_count")


@query("line_ingest", V.with_views("v_lines", rf"""
    SELECT doc_id, line_no, {_TS} AS event_ts,
      regexp_replace(regexp_replace(line, '^\s+', ''), '\s+$', '') AS message,
      CASE source WHEN 'src0' THEN 'syslog' WHEN 'src1' THEN 'auth' ELSE 'unknown' END AS log_type, source, lang AS host
    FROM v_lines"""))
def line_ingest(spark, sf):
    """Every line of every document as a log row, blank lines kept."""
    lines = V.v_lines(spark, sf).withColumnRenamed("line", "value")
    typed = log_rows(lines.select("value", F.struct("source", "doc_id", "line_no", "lang").alias("key"), "source"),
                     {"src0": "syslog", "src1": "auth"}, AS_OF, F.col("key"))
    return typed.select(
        F.col("host.doc_id").alias("doc_id"), F.col("host.line_no").alias("line_no"), "event_ts", "message",
        "log_type", "source", F.col("host.lang").alias("host"))


@query("syslog_parse", V.with_views("v_logs", """
    SELECT event_id, date_trunc('second', event_ts) AS event_ts, host AS logsource,
      CASE log_type WHEN 'error' THEN 'sshd' WHEN 'signup' THEN 'sudo' ELSE log_type END AS program,
      CASE WHEN log_type = 'error' THEN CAST(1000 + user_id AS INTEGER) END AS pid, message AS syslog_message
    FROM v_logs"""))
def syslog_parse(spark, sf):
    """Log rows are written out as syslog text and parsed back; days are padded with a blank."""
    v = V.v_logs(spark, sf)
    program = F.when(F.col("log_type") == "error", F.concat(F.lit("sshd["), 1000 + F.col("user_id"), F.lit("]"))).when(
        F.col("log_type") == "signup", "sudo").otherwise(F.col("log_type"))
    day = F.lpad(F.date_format("event_ts", "d"), 2, " ")
    line = F.concat(F.date_format("event_ts", "MMM "), day, F.date_format("event_ts", " HH:mm:ss "), "host",
                    F.lit(" "), program, F.lit(": "), "message")
    parsed = parsers.parse_syslog(v.select("event_id", line.alias("line")), "line", 2024)
    return parsed.drop("line")


@query("access_log_parse", V.with_views("v_logs", """
    SELECT event_id, date_trunc('second', event_ts) AS event_ts, '10.0.0.' || (user_id % 256) AS client,
      NULL::VARCHAR AS ident, 'user' || user_id AS auth,
      CASE log_type WHEN 'purchase' THEN 'POST' ELSE 'GET' END AS verb, '/' || log_type || '?id=' || event_id AS path,
      '1.1' AS http_version, CASE log_type WHEN 'error' THEN 401 ELSE 200 END AS status,
      CASE WHEN log_type <> 'error' THEN CAST(length(message) AS BIGINT) END AS bytes,
      NULL::VARCHAR AS referrer, host || ' agent' AS agent
    FROM v_logs"""))
def access_log_parse(spark, sf):
    v = V.v_logs(spark, sf)
    lit = F.lit
    line = F.concat(
        lit("10.0.0."), F.col("user_id") % 256, lit(" - user"), "user_id",
        F.date_format("event_ts", " '['dd/MMM/yyyy:HH:mm:ss '+0000] \"'"),
        F.when(F.col("log_type") == "purchase", "POST").otherwise("GET"), lit(" /"), "log_type", lit("?id="),
        "event_id", lit(' HTTP/1.1" '), F.when(F.col("log_type") == "error", "401 -").otherwise(
            F.concat(lit("200 "), F.length("message"))), lit(' "-" "'), "host", lit(' agent"'))
    parsed = parsers.parse_access(v.select("event_id", line.alias("line")), "line")
    return parsed.drop("line")


@query("batch_unpack", V.with_views("v_logs", f"SELECT user_id, event_ts, host, log_type, message FROM v_logs"))
def batch_unpack(spark, sf):
    """Log rows are packed as data messages and unpacked again."""
    entry = F.struct(
        F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("@timestamp"), "host", "log_type", "message")
    packed = V.v_logs(spark, sf).select(
        "user_id", F.to_json(F.struct(F.lit("logs").alias("type"), F.array(entry).alias("logs"))).alias("data"))
    return messages.unpack_batches(packed, keep=("user_id",))


@query("timestamp_backfill", """
    SELECT event_id, CASE WHEN event_type = 'view' THEN date_trunc('day', ts) ELSE ts END AS "@timestamp",
      date_trunc('day', ts) AS timestamp FROM events""")
def timestamp_backfill(spark, sf):
    e = V.table(spark, sf, "events").select(
        "event_id", F.when(F.col("event_type") != "view", F.col("ts")).alias("@timestamp"),
        F.date_trunc("day", "ts").alias("timestamp"))
    return timing.backfill_timestamp(e)


@query("typed_schema", V.with_views("v_vulns", """
    SELECT 'typed' AS side, host, CAST(port AS VARCHAR) AS port, severity FROM v_vulns WHERE severity <> 'unknown'
    UNION ALL SELECT 'quarantine', host, 'port ' || port, severity FROM v_vulns WHERE severity = 'unknown'"""))
def typed_schema(spark, sf):
    """Loose text columns are cast to the declared schema; rows that do not cast are set aside."""
    v = V.v_vulns(spark, sf)
    loose = v.withColumn("port", F.when(F.col("severity") == "unknown", F.concat(F.lit("port "), "port")).otherwise(
        F.col("port").cast("string")))
    typed, bad = enforce(loose, schema_of("vulnerabilities"))

    def side(df, name):
        return df.select(F.lit(name).alias("side"), "host", F.col("port").cast("string").alias("port"), "severity")

    return side(typed, "typed").unionByName(side(bad, "quarantine"))


@query("path_tags", V.with_views("v_logs", """
    SELECT event_id, source, CASE WHEN log_type = 'error' THEN 'system' WHEN log_type = 'signup' THEN 'application' ELSE '' END AS tags,
      CASE WHEN log_type = 'error' THEN 'syslog' WHEN log_type = 'signup' THEN 'application' END AS source_type,
      CASE WHEN log_type IN ('error', 'signup') THEN 'security' END AS environment
    FROM (SELECT event_id, log_type, CASE log_type WHEN 'error' THEN source WHEN 'signup' THEN '/opt/worker/logs/worker.log'
            ELSE '/home/data.txt' END AS source FROM v_logs)"""))
def path_tags(spark, sf):
    source = F.when(F.col("log_type") == "error", F.col("source")).when(
        F.col("log_type") == "signup", "/opt/worker/logs/worker.log").otherwise("/home/data.txt")
    tagged = prepare.path_tags(V.v_logs(spark, sf).select("event_id", source.alias("source")))
    return tagged.withColumn("tags", F.array_join("tags", ","))


_FEATURES = ", ".join(prepare.METRIC_FEATURES)


@query("metric_features", V.with_views("v_features", f"SELECT event_id, event_ts, host, {_FEATURES} FROM v_features"))
def metric_features(spark, sf):
    return prepare.metric_features(V.v_metrics(spark, sf), ["event_id"])


@query("metric_features_nonempty", V.with_views("v_features", "SELECT event_id, event_ts, host, " + ", ".join(
    f"coalesce({f}, 0.0) AS {f}" for f in prepare.METRIC_FEATURES) +
    " FROM v_features WHERE coalesce(" + _FEATURES + ") IS NOT NULL"))
def metric_features_nonempty(spark, sf):
    """Rows with at least one feature, NULLs filled with 0 for a fit."""
    df = prepare.metric_features(V.v_metrics(spark, sf), ["event_id"], drop_featureless=True)
    return prepare.fill_features(df, prepare.numeric_features(df, ("event_id",)))


@query("host_normalise", """
    SELECT event_id, CASE event_type WHEN 'click' THEN 'host-' || user_id WHEN 'view' THEN 'h' || user_id ELSE 'unknown' END AS host
    FROM events""")
def host_normalise(spark, sf):
    """Host given as an object, as text, or missing."""
    e = V.table(spark, sf, "events")
    doc = F.when(F.col("event_type") == "click", F.to_json(F.struct(F.struct(
        F.concat(F.lit("host-"), "user_id").alias("name")).alias("host")))).when(
        F.col("event_type") == "view", F.to_json(F.struct(F.concat(F.lit("h"), "user_id").alias("host")))).otherwise("{}")
    return e.select("event_id", prepare.host_name(doc).alias("host"))


@query("fail_filter", V.with_views("v_compliance_hosts", f"""
    SELECT event_ts, host, framework FROM v_compliance_hosts WHERE status = 'FAIL'
      AND event_ts BETWEEN TIMESTAMP '{V.ORDERS_AS_OF}' - INTERVAL 7 DAYS AND TIMESTAMP '{V.ORDERS_AS_OF}'"""))
def fail_filter(spark, sf):
    recent = timing.time_range(V.v_compliance_hosts(spark, sf), "event_ts", "7 DAYS", V.ORDERS_AS_OF)
    return prepare.failed_checks(recent).select("event_ts", "host", "framework")


@query("default_columns", V.with_views("v_compliance_hosts", """
    SELECT host, framework, status, 'Unknown' AS check_name FROM v_compliance_hosts"""))
def default_columns(spark, sf):
    return prepare.default_columns(
        V.v_compliance_hosts(spark, sf).drop("event_ts"), ["status", "framework", "check_name"])


@query("clean_keys", """
    SELECT event_id, CASE WHEN event_type = 'view' THEN 'user' ELSE 'event,user' END AS keys,
      CASE WHEN event_type = 'view' THEN 0 ELSE 1 END AS empty_values FROM events""")
def clean_keys(spark, sf):
    """Empty-string keys go, on both levels of a nested map; empty values stay."""
    e = V.table(spark, sf, "events")
    inner = F.create_map(F.lit(""), F.lit("x"), F.lit("a"), F.lit(""))
    nested = F.create_map(
        F.when(F.col("event_type") == "view", "").otherwise("event"), inner, F.lit("user"), F.create_map(F.lit("b"), F.lit("y")))
    cleaned = e.select("event_id", text.clean_nested_keys(nested).alias("m"))
    return cleaned.select(
        "event_id", F.array_join(F.array_sort(F.map_keys("m")), ",").alias("keys"),
        F.size(F.filter(F.flatten(F.transform(F.map_values("m"), lambda v: F.map_values(v))), lambda v: v == "")).alias("empty_values"))


@query("brute_force", V.with_views("v_logs", r"""
    SELECT date_trunc('day', event_ts) AS window_start, host, regexp_extract(message, 'from ([0-9.]+)', 1) AS peer, count(*) AS failures
    FROM v_logs WHERE contains(message, 'Failed password for') OR contains(message, 'Invalid user')
    GROUP BY ALL HAVING count(*) >= 2"""))
def brute_force(spark, sf):
    return detections.brute_force(V.v_logs(spark, sf), "1 day", 2)


@query("sudo_burst", V.with_views("v_logs", """
    SELECT date_trunc('day', event_ts) AS window_start, host, count(*) AS commands
    FROM v_logs WHERE contains(message, 'sudo') GROUP BY ALL HAVING count(*) >= 3"""))
def sudo_burst(spark, sf):
    return detections.sudo_bursts(V.v_logs(spark, sf), "1 day", 3)


@query("scan_burst", V.with_views("v_vulns", """
    SELECT time_bucket(INTERVAL 28 DAYS, event_ts, TIMESTAMP '1970-01-01 00:00:00') AS window_start, host, count(DISTINCT port) AS ports, count(*) AS findings
    FROM v_vulns GROUP BY 1, 2 HAVING count(DISTINCT port) >= 3"""))
def scan_burst(spark, sf):
    return detections.scan_bursts(V.v_vulns(spark, sf), "28 days", 3)


@query("silent_sources", V.with_views("v_logs", f"""
    SELECT host, source, max(event_ts) AS last_seen FROM v_logs GROUP BY 1, 2
    HAVING max(event_ts) < {_TS} - INTERVAL 12 HOURS"""))
def silent_sources(spark, sf):
    return detections.silent_sources(V.v_logs(spark, sf), AS_OF, "12 HOURS")


@query("keyword_rules", V.with_views("v_lines", " UNION ALL ".join(
    f"SELECT doc_id, line_no, '{r.name}' AS pattern FROM v_lines WHERE contains(line, '{r.needles[0]}')"
    for r in detections.KEYWORD_RULES)))
def keyword_rules(spark, sf):
    return logs.tag_patterns(V.v_lines(spark, sf), detections.KEYWORD_RULES, "line").select("doc_id", "line_no", "pattern")


@query("keyword_counts", V.with_views("v_lines", " UNION ALL ".join(
    f"SELECT '{r.name}' AS pattern, count(*) FILTER (WHERE contains(line, '{r.needles[0]}')) AS matches FROM v_lines"
    for r in detections.KEYWORD_RULES)))
def keyword_counts(spark, sf):
    return logs.pattern_counts(V.v_lines(spark, sf), detections.KEYWORD_RULES, "line")


_RULES = """rules AS (SELECT 'user-' || c_custkey AS rule, unnest(['user' || c_custkey, '.' || (c_custkey % 256) || ' port']) AS needle FROM customer)"""


def customer_rules(spark, sf):
    """Two needles for every customer key: the name of a user, and the end of a peer address."""
    key = F.col("c_custkey")
    needles = F.array(F.concat(F.lit("user"), key), F.concat(F.lit("."), key % 256, F.lit(" port")))
    return V.table(spark, sf, "customer").select(F.concat(F.lit("user-"), key).alias("rule"), F.explode(needles).alias("needle"))


@query("rule_table_hits", V.with_views("v_logs", f"""+ {_RULES}
    SELECT DISTINCT event_id, rule FROM v_logs JOIN rules ON contains(message, needle)"""))
def rule_table_hits(spark, sf):
    """Log rows against a rule table with rules for every customer, in one pass."""
    return rule_tables.rule_hits(V.v_logs(spark, sf).select("event_id", "message"), customer_rules(spark, sf)).select("event_id", "rule")


@query("rule_table_counts", V.with_views("v_logs", f"""+ {_RULES},
    hits AS (SELECT DISTINCT event_id, rule FROM v_logs JOIN rules ON contains(message, needle))
    SELECT rule, count(event_id) AS matches FROM (SELECT DISTINCT rule FROM rules) LEFT JOIN hits USING (rule) GROUP BY 1"""))
def rule_table_counts(spark, sf):
    return rule_tables.rule_counts(V.v_logs(spark, sf), customer_rules(spark, sf))


@query("line_ingest_files", V.with_views("v_lines", rf"""
    SELECT doc_id, line_no, {_TS} AS event_ts, regexp_replace(line, '\s+$', '') AS message,
      CASE source WHEN 'src0' THEN 'syslog' WHEN 'src1' THEN 'auth' ELSE 'unknown' END AS log_type, source, 'here' AS host
    FROM v_lines"""))
def line_ingest_files(spark, sf):
    """Lines written to text files with blanks in their folders' names, and read back by the file reader."""
    folder = run_folder(spark, "text lines")
    key = F.concat_ws(":", "doc_id", "line_no", F.lit(""))
    # Bytes that Spark's line reader takes for line ends, and one that is not UTF-8, are put in and taken out again.
    value = F.concat(F.lit("\t"), key, F.replace(F.col("line"), F.lit("\r"), F.lit("\u2028")), F.lit(" \t"))
    lines = V.v_lines(spark, sf).select("source", F.concat(value.cast("binary"), F.unhex(F.lit("FF20"))).cast("string").alias("value"))
    lines.write.partitionBy("source").text(folder)
    types = {f"{folder}/source={name}/part-*": kind for name, kind in (("src0", "syslog"), ("src1", "auth"))}
    types[f"{folder}/source=src[!01]*/part-*"] = types[f"{folder}/source=src[01]?*/part-*"] = "unknown"
    read = readers.ingest_lines(spark, types, AS_OF, "here")
    parts = F.split("message", ":", 3)
    # Trimming has taken the blanks at the end; the line behind the key is left as it was in front.
    return read.select(
        parts[0].cast("bigint").alias("doc_id"), parts[1].cast("int").alias("line_no"), "event_ts",
        F.replace(parts[2], F.lit("\u2028"), F.lit("\r")).alias("message"), "log_type",
        F.regexp_extract("source", "/source=([^/]*)/", 1).alias("source"), "host")


@query("index_pattern_scan", V.with_views("v_logs v_features", """
    SELECT 'filebeat-' || strftime(event_ts, '%Y.%m.%d') AS index_name, event_id, message, NULL::DOUBLE AS cpu_usage FROM v_logs
    WHERE strftime(event_ts, '%Y.%m.%d') LIKE '2024.01.1%' AND strftime(event_ts, '%Y.%m.%d') <> '2024.01.13'
    UNION ALL SELECT 'metricbeat-' || strftime(event_ts, '%Y.%m.%d'), event_id, NULL, cpu_usage FROM v_features
    WHERE strftime(event_ts, '%Y.%m.%d') = '2024.01.05'"""))
def index_pattern_scan(spark, sf):
    """Two beats with different columns in one daily table, and a pattern over beats and days."""
    root = run_folder(spark, "indices")
    sinks.append_daily(V.v_logs(spark, sf).select("event_id", "event_ts", "message"), root, beat="filebeat")
    metrics = prepare.metric_features(V.v_metrics(spark, sf), ["event_id"])
    sinks.append_daily(metrics.select("event_id", "event_ts", "cpu_usage"), root, beat="metricbeat")
    found = indices.read_indices(spark, root, "filebeat-2024.01.1*,metricbeat-2024.01.05,-*beat-2024.01.13")
    return found.select("index_name", "event_id", "message", "cpu_usage")
