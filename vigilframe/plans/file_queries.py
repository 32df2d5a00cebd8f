"""Loaders, sinks and models as round trips: a table is written as an outside producer would, and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigilframe.operators import intel
from vigilframe.plans import views as V
from vigilframe.plans.catalog import query
from vigilframe.plans.stream_queries import stream_view
from vigilframe.session import run_folder
from vigilframe.sources import readers, sinks
from vigilframe.streaming import drops, runs


@query("indicator_files", V.with_views("v_indicators", "SELECT type, indicator, threat_level, description FROM v_indicators"))
def indicator_files(spark, sf):
    """Indicators as files of mixed typed rows, next to a path that is not there, and split by type on the way out."""
    known = intel.union_feeds(*V.v_feeds(spark, sf)).select("type", "indicator", "threat_level", "description")
    parted = known.withColumn("part", F.pmod(F.hash("indicator"), F.lit(16)))
    folder = drops.write_arrays(parted, ["part"])
    loaded = readers.load_indicators(spark, [], [f"{folder}/*/part-*", f"{folder}/missing.json"])
    out = run_folder(spark, "by-type")
    sinks.save_by_type(loaded, out)
    return spark.read.schema("indicator string, threat_level string, description string, type string").json(out).select(*known.columns)


@query("host_line_ingest", V.with_views("v_logs", f"""
    SELECT TIMESTAMP '{V.EVENTS_AS_OF}' AS event_ts, message, 'unknown' AS log_type, host, count(*) AS copies FROM v_logs GROUP BY ALL"""))
def host_line_ingest(spark, sf):
    """Log messages in a landing folder per host."""
    root = run_folder(spark, "hosts")
    V.v_logs(spark, sf).select("host", "message").write.partitionBy("host").text(root)
    rows = readers.ingest_host_lines(spark, root, {"syslog": "syslog"}, V.EVENTS_AS_OF)
    return rows.groupBy("event_ts", "message", "log_type", "host").agg(F.count("*").alias("copies"))


@query("scan_report", V.with_views("v_vulns", """
    SELECT 'finding ' || o_orderkey AS name, host, port, severity AS threat, description FROM v_vulns"""))
def scan_report(spark, sf):
    """Scanner findings as CSV files with a header."""
    out = run_folder(spark, "scans")
    found = V.v_vulns(spark, sf).select(
        F.concat(F.lit("finding "), "o_orderkey").alias("name"), "host", "port", F.col("severity").alias("threat"), "description")
    found.write.option("header", True).csv(out)
    return readers.read_scan_report(spark, out)


@query("asset_file", V.with_views("v_assets", "SELECT * FROM v_assets"))
def asset_file(spark, sf):
    """The asset dimension, a row per host, as one JSON object."""
    assets = V.v_assets(spark, sf)
    fields = [c for c in assets.columns if c != "asset"]
    out = run_folder(spark, "assets")
    rows = F.collect_list(F.struct("asset", F.struct(*fields)))
    assets.agg(F.to_json(F.map_from_entries(rows)).alias("value")).coalesce(1).write.text(out)
    return readers.load_assets(spark, out).select(*assets.columns)


@query("training_files", V.with_views("v_training", """
    SELECT threat_type, count(*) AS n, CAST(sum(length(message)) AS BIGINT) AS chars, count(DISTINCT md5(message)) AS texts FROM v_training GROUP BY 1"""))
def training_files(spark, sf):
    """Labelled messages as files of JSON arrays."""
    rows = V.v_training(spark, sf).select("message", "threat_type", F.pmod(F.col("doc_id"), F.lit(32)).alias("part"))
    folder = drops.write_arrays(rows, ["part"])
    return readers.load_training(spark, f"{folder}/*/part-*").groupBy("threat_type").agg(
        F.count("*").alias("n"), F.sum(F.char_length("message")).alias("chars"), F.countDistinct(F.md5("message")).alias("texts"))


@query("batch_sink", V.with_views("v_logs", "SELECT event_id, event_ts, message, CAST(event_ts AS DATE) AS dt FROM v_logs"))
def batch_sink(spark, sf):
    """A stream into the batch sink; a batch that is handed over twice is kept once."""
    out = run_folder(spark, "batches")
    write = sinks.append_batch(out)

    def twice(batch, batch_id):
        write(batch, batch_id)
        write(batch, batch_id)

    runs.run_batches(stream_view(V.v_logs, spark, sf).select("event_id", "event_ts", "message"), spark, "batches", twice)
    return spark.read.parquet(out).select("event_id", "event_ts", "message", "dt")


@query("retention_sink", V.with_views("v_vulns", f"""
    SELECT o_orderkey, event_ts FROM v_vulns WHERE event_ts >= TIMESTAMP '{V.ORDERS_AS_OF}' - INTERVAL 90 DAYS"""))
def retention_sink(spark, sf):
    """A daily table from which what is past the limit is taken, whole days as folders."""
    root = run_folder(spark, "retained")
    sinks.append_daily(V.v_vulns(spark, sf).select("o_orderkey", "event_ts"), root)
    sinks.drop_expired(spark, root, V.ORDERS_AS_OF)
    return spark.read.parquet(root).select("o_orderkey", "event_ts")
