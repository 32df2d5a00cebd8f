"""Streams over the benchmark tables, run until all available input is processed."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigilframe.functions import stats
from vigilframe.operators import classify, intel, prepare
from vigilframe.plans import views as V
from vigilframe.plans.catalog import query, rounded
from vigilframe.plans.intel_queries import _AVGS, _BEAT, _DIGITS, _MATCH, REPLIES_SQL, beat_columns
from vigilframe.session import materialize, run_folder
from vigilframe.sources import sinks
from vigilframe.streaming import cycles, drops, registry, runs, windows


def table_stream(spark, sf, name):
    """A table, one file or a folder of files, as a stream, with instants as watermarks require them.

    The path is a pattern, `.parque[t]`: a stream takes a plain path for the root of a partitioned folder, which a file cannot be.
    """
    raw = spark.readStream.schema(V.TABLES[name]).parquet(f"{sf}/{name}.parque[t]")
    return V.with_instants(raw, name)


def stream_view(view, spark, sf):
    """A dataset view whose tables are read as streams."""
    return view(spark, sf, table_stream)


@query("hourly_counts_stream", V.with_views("v_logs", """
    SELECT date_trunc('hour', event_ts) AS bucket, count(*) AS n FROM v_logs GROUP BY 1
    HAVING date_trunc('hour', event_ts) + INTERVAL 1 HOUR <= (SELECT max(event_ts) FROM v_logs) - INTERVAL 1 HOUR"""))
def hourly_counts_stream(spark, sf):
    """Closed hours only: those the watermark has passed."""
    return runs.run_once(windows.hourly_counts(stream_view(V.v_logs, spark, sf)), spark, "hourly-counts")


@query("sliding_metrics_stream", V.with_views("v_features", f"""
    SELECT * FROM (
      SELECT time_bucket(INTERVAL 5 MINUTES, event_ts) - i * INTERVAL 5 MINUTES AS window_start, host, {_AVGS}, count(*) AS samples
      FROM v_features, range(12) t(i) GROUP BY 1, 2)
    WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(event_ts) FROM v_features) - INTERVAL 5 MINUTES"""))
def sliding_metrics_stream(spark, sf):
    """The one-hour look-back every five minutes as a stream; closed windows only."""
    rows = prepare.metric_features(stream_view(V.v_metrics, spark, sf))
    return rounded(runs.run_once(windows.sliding_metrics(rows), spark, "sliding"), **_DIGITS)


@query("uptime_sessions_stream", V.with_views("v_messages", """+
    s AS (SELECT worker_id, event_ts, lag(event_ts) OVER (PARTITION BY worker_id ORDER BY event_ts) AS prev
          FROM v_messages WHERE type IN ('register', 'heartbeat')),
    g AS (SELECT *, sum(CASE WHEN event_ts - prev <= INTERVAL 12 HOURS THEN 0 ELSE 1 END)
          OVER (PARTITION BY worker_id ORDER BY event_ts ROWS UNBOUNDED PRECEDING) AS session FROM s)
    SELECT worker_id, min(event_ts) AS started, max(event_ts) AS ended, count(*) AS signals FROM g GROUP BY worker_id, session
    HAVING max(event_ts) + INTERVAL 12 HOURS <= (SELECT max(event_ts) FROM s) - INTERVAL 1 MINUTE"""))
def uptime_sessions_stream(spark, sf):
    """Closed heartbeat sessions."""
    stream = windows.uptime_sessions(stream_view(V.v_messages, spark, sf), "12 hours")
    return runs.run_once(stream, spark, "sessions")


@query("dedup_stream", V.with_views("v_anomalies", "SELECT DISTINCT host, event_ts FROM v_anomalies"))
def dedup_stream(spark, sf):
    """Every anomaly arrives twice, as overlapping detection cycles deliver it."""
    rows = stream_view(V.v_anomalies, spark, sf).select("host", "event_ts")
    twice = rows.select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("cycle")).drop("cycle")
    return runs.run_once(windows.deduplicate(twice, ["host", "event_ts"]), spark, "dedup")


def keyed_session(spark):
    """A session of its own for keyed state, which keeps the state store setting away from the caller's."""
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    session.conf.set("spark.sql.streaming.stateStore.providerClass", runs.ROCKSDB)
    return session


@query("worker_status_stream", V.with_views("v_messages", """+
    ok AS (SELECT * FROM v_messages WHERE worker_id IS NOT NULL
           AND ((type = 'register' AND worker_type IS NOT NULL) OR type = 'heartbeat')),
    reg AS (SELECT worker_id, arg_max(worker_type, event_ts) AS type, arg_max(coalesce(host, 'unknown'), event_ts) AS host
            FROM ok WHERE type = 'register' GROUP BY 1),
    listed AS (SELECT r.worker_id, r.type, r.host, max(o.event_ts) AS last_heartbeat
            FROM reg r JOIN ok o ON o.worker_id = r.worker_id GROUP BY ALL)
    SELECT *, 'online' AS status FROM listed
    UNION ALL SELECT *, 'offline' FROM listed WHERE last_heartbeat + INTERVAL 12 HOURS < (SELECT max(event_ts) FROM ok)"""))
def worker_status_stream(spark, sf):
    """Status changes from keyed state: online on signals, offline when the timer fires."""
    session = keyed_session(spark)
    changes = registry.worker_status_changes(stream_view(V.v_messages, session, sf), 12 * 3600)
    out = run_folder(spark, "status")
    runs.run_once(changes, session, "status", out)
    return spark.read.schema(changes.schema).parquet(out)


@query("worker_listing_stream", V.with_views("v_messages", """+
    ok AS (SELECT * FROM v_messages WHERE worker_id IS NOT NULL
           AND ((type = 'register' AND worker_type IS NOT NULL) OR type = 'heartbeat')),
    reg AS (SELECT worker_id, arg_max(worker_type, event_ts) AS type, arg_max(coalesce(host, 'unknown'), event_ts) AS host
            FROM ok WHERE type = 'register' GROUP BY 1)
    SELECT r.worker_id AS id, r.type, r.host, max(o.event_ts) AS last_heartbeat,
      CASE WHEN TIMESTAMP '2024-01-31 00:00:00' - max(o.event_ts) > INTERVAL 12 HOURS THEN 'offline' ELSE 'online' END AS status
    FROM reg r JOIN ok o ON o.worker_id = r.worker_id GROUP BY ALL"""))
def worker_listing_stream(spark, sf):
    """The answer to a status request after the stream's last batch, read from the stream's state."""
    session = keyed_session(spark)
    changes = registry.worker_status_changes(stream_view(V.v_messages, session, sf), 12 * 3600)
    state = run_folder(spark, "listing-state")
    runs.run_once(changes, session, "listing", checkpoint=state)
    return registry.listed_workers(session, state, V.EVENTS_AS_OF, "12 HOURS")


@query("message_routing_stream", f"""
    SELECT * FROM ({REPLIES_SQL}) WHERE status = 'success' OR message NOT LIKE '% not registered'
      OR event_ts < (SELECT max(ts) FROM events) - INTERVAL 2 MILLISECONDS""")
def message_routing_stream(spark, sf):
    """The registration gate as keyed state: all messages but the refused ones that the watermark has not passed."""
    session = keyed_session(spark)
    answers = registry.gated_replies(stream_view(V.v_messages, session, sf))
    out = run_folder(spark, "replies")
    runs.run_once(answers, session, "replies", out)
    return spark.read.schema(answers.schema).parquet(out)


@query("intel_stream", V.with_views("v_beat_logs v_indicators", f"SELECT {_BEAT} FROM v_beat_logs b WHERE {_MATCH}"))
def intel_stream(spark, sf):
    """Stream of log rows against the static indicator table."""
    indicators = intel.union_feeds(*V.v_feeds(spark, sf))
    rows = stream_view(V.v_beat_logs, spark, sf)
    out = run_folder(spark, "intel")
    runs.run_batches(rows, spark, "intel", windows.match_batches(indicators, "log_id", out))
    return beat_columns(spark.read.schema(rows.schema).parquet(out))


@query("drop_folder_stream", V.with_views("v_anomalies", """
    SELECT event_ts, host, anomaly_score FROM v_anomalies"""))
def drop_folder_stream(spark, sf):
    """Anomaly rows written to a drop folder as JSON and taken up once."""
    folder = run_folder(spark, "drop")
    rows = V.v_anomalies(spark, sf).select("event_ts", "host", "anomaly_score")
    rows.write.option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(folder)
    return runs.run_once(runs.drop_folder_stream(spark, folder, rows.schema, multi_line=False), spark, "taken")


@query("drop_folder_arrays", V.with_views("v_anomalies v_vulns", """
    SELECT 'anomalies' AS dataset, host, event_ts, anomaly_score AS score, NULL::VARCHAR AS text FROM v_anomalies
    UNION ALL SELECT 'vulnerabilities', host, event_ts, vulnerability_score, description FROM v_vulns
    UNION ALL SELECT 'quarantine', NULL, NULL, NULL, 'of ' || count(*) FROM v_vulns"""))
def drop_folder_arrays(spark, sf):
    """JSON arrays in a drop folder, taken up in two runs: each file once, rows without a host set aside."""
    folder, root, archive = (run_folder(spark, name) for name in ("drop", "taken", "archive"))
    found = V.v_anomalies(spark, sf).select("host", "event_ts", "anomaly_score")
    holes = V.v_vulns(spark, sf).select("host", "event_ts", "vulnerability_score", "description")
    bad = holes.agg(F.count("*").alias("n")).select(
        F.lit(None).cast("string").alias("host"), F.lit(None).cast("timestamp").alias("event_ts"),
        F.lit(None).cast("double").alias("vulnerability_score"), F.concat(F.lit("of "), "n").alias("description"))
    datasets = {
        "anomalies": drops.Dataset("anomalies", found.schema, ("host",)),
        "vulnerabilities": drops.Dataset("vulnerabilities", holes.schema, ("host",))}
    half = F.pmod(F.hash("host"), F.lit(2))
    for run in (0, 1):
        drops.write_arrays(found.where(half == run), ["host"], f"{folder}/anomalies")
        drops.write_arrays(holes.where(half == run), ["host"], f"{folder}/vulnerabilities")
        if run:
            drops.write_arrays(bad, ["description"], f"{folder}/vulnerabilities")
        tables = drops.take_up(spark, folder, datasets, root, archive)
    aside = drops.quarantined(spark, root, "vulnerabilities").select(
        F.lit("quarantine").alias("dataset"), *[F.lit(None).cast(t).alias(c) for c, t in (("host", "string"), ("event_ts", "timestamp"), ("score", "double"))],
        F.get_json_object("row", "$.description").alias("text"))
    return tables["anomalies"].select(
        F.lit("anomalies").alias("dataset"), "host", "event_ts", F.col("anomaly_score").alias("score"), F.lit(None).cast("string").alias("text")).unionByName(
        tables["vulnerabilities"].select(
            F.lit("vulnerabilities").alias("dataset"), "host", "event_ts", F.col("vulnerability_score").alias("score"), F.col("description").alias("text"))).unionByName(aside)


@query("detection_cycles_stream", V.with_views("v_anomalies", """+
    bounds AS (SELECT max(epoch(event_ts))::BIGINT AS last, min(epoch(event_ts))::BIGINT AS first FROM v_anomalies),
    cycles AS (SELECT unnest(range((first + 172799) // 172800 * 172800, last // 172800 * 172800 + 1, 172800)) AS c FROM bounds),
    seen AS (SELECT c, event_id, host, event_ts, anomaly_score FROM cycles, v_anomalies
      WHERE event_ts > make_timestamp((c - 259200) * 1000000) AND event_ts <= make_timestamp(c * 1000000)),
    cut AS (SELECT c, quantile_cont(anomaly_score, 0.05) AS q FROM seen GROUP BY 1)
    SELECT make_timestamp(c * 1000000) AS cycle_ts, event_id, host, anomaly_score FROM seen JOIN cut USING (c) WHERE anomaly_score < q"""))
def detection_cycles_stream(spark, sf):
    """A detection cycle every two days over the last three, closed in event time, with its own threshold each."""
    root = run_folder(spark, "cycles")
    rows = stream_view(V.v_anomalies, spark, sf)

    def lowest(recent, as_of):
        kept = materialize(recent, "cycle")
        return stats.below_quantile(kept, "anomaly_score", 0.05).select("event_id", "host", "anomaly_score")

    runs.run_batches(rows, spark, "cycles", cycles.cycle_batches(root, lowest, 2 * 86400, 3 * 86400))
    shape = T.StructType([rows.schema[c] for c in ("event_id", "host", "anomaly_score")])
    return cycles.results(spark, root, shape).select("cycle_ts", "event_id", "host", "anomaly_score")


@query("score_messages_stream")
def score_messages_stream(spark, sf):
    """A saved classifier, loaded again, on the stream of conversation turns."""
    path = run_folder(spark, "model")
    sinks.save_model(classify.train_classifier(V.v_training(spark, sf)), path)
    turns = table_stream(spark, sf, "conversations")
    root = run_folder(spark, "scored")
    runs.run_batches(turns, spark, "scored", classify.classify_batches(sinks.load_model(path), root, ["conv_id", "turn"], "text"))
    shape = T.StructType([turns.schema["conv_id"], turns.schema["turn"], T.StructField("predicted", T.StringType())])
    return spark.read.schema(shape).option("basePath", root).parquet(f"{root}/batch=*").select(*shape.names)
