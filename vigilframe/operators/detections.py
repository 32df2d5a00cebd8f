"""Detection rules over log, scan and health tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilframe.functions.timing import instant
from vigilframe.operators.logs import Rule

# Message texts and the address pattern.
SSH_FAILURE = Rule("ssh_login_failure", ("Failed password for", "Invalid user"))
SUDO = Rule("sudo_command", ("sudo",))
PEER = r"from ([0-9]{1,3}(?:\.[0-9]{1,3}){3})"

# Fixed keyword rules for privilege escalation and tampering.
KEYWORD_RULES = (
    Rule("sudo", ("sudo",)),
    Rule("passwd", ("passwd",)),
    Rule("editor", ("nano",)),
    Rule("echo", ("echo",)),
)


def _buckets(df: DataFrame, keys: list, width: str):
    start = F.window("event_ts", width)["start"].alias("window_start")
    return df.groupBy(start, *keys)


def brute_force(logs: DataFrame, width: str = "1 hour", threshold: int = 10) -> DataFrame:
    """Failed logins per host, peer address and window, from the threshold on."""
    failed = logs.where(SSH_FAILURE.matches(F.col("message"))).withColumn(
        "peer", F.nullif(F.regexp_extract("message", PEER, 1), F.lit("")))
    return _buckets(failed, ["host", "peer"], width).agg(F.count("*").alias("failures")).where(
        F.col("failures") >= threshold)


def sudo_bursts(logs: DataFrame, width: str = "1 hour", threshold: int = 10) -> DataFrame:
    """Sudo messages per host and window, from the threshold on."""
    return _buckets(logs.where(SUDO.matches(F.col("message"))), ["host"], width).agg(
        F.count("*").alias("commands")).where(F.col("commands") >= threshold)


def scan_bursts(scans: DataFrame, width: str = "1 day", threshold: int = 5) -> DataFrame:
    """Hosts with many distinct ports in one window; repeated ports are folded map-side first."""
    return _buckets(scans, ["host"], width).agg(
        F.countDistinct("port").alias("ports"), F.count("*").alias("findings")
    ).where(F.col("ports") >= threshold)


def silent_sources(logs: DataFrame, as_of: str, limit: str = "1 hour") -> DataFrame:
    """Sources whose last row is older than the limit."""
    last = logs.groupBy("host", "source").agg(F.max("event_ts").alias("last_seen"))
    return last.where(F.col("last_seen") < instant(as_of) - F.expr(f"INTERVAL {limit}"))


def rule_coverage(counts: dict[str, tuple[str, DataFrame]]) -> DataFrame:
    """Scenario -> (dataset name, detections); hit counts with zeros, and the verdict."""
    out = None
    for scenario, (dataset, found) in counts.items():
        row = found.agg(F.count("*").alias("hits")).select(
            F.lit(scenario).alias("scenario"), F.lit(dataset).alias("dataset"), "hits",
            F.when(F.col("hits") > 0, "detected").otherwise("silent").alias("verdict"))
        out = row if out is None else out.unionByName(row)
    return out
