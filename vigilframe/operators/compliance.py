"""Compliance summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilframe.functions.timing import instant
from vigilframe.operators.prepare import default_columns

REQUIRED = ["status", "framework", "check_name"]

# Failed check -> remediation text, in report order.
REMEDIATIONS = (
    ("Ensure SSH root login is disabled", "Disable SSH root login to improve security."),
    ("Ensure password authentication is disabled in SSH",
     "Use key-based authentication instead of passwords for SSH."),
    ("Ensure auditd is installed", "Install auditd for better system auditing capabilities."),
)


def _count_status(value: str):
    return F.count_if(F.coalesce(F.col("status"), F.lit("")) == value)


def compliance_rate(df: DataFrame) -> DataFrame:
    """Share of PASS over all rows, one row; no input row gives no output row."""
    return (
        default_columns(df, REQUIRED)
        .agg(F.count("*").alias("total_checks"), _count_status("PASS").alias("passed_checks"))
        .where("total_checks > 0")
        .select((F.col("passed_checks") / F.col("total_checks")).alias("compliance_rate"), "total_checks")
    )


def framework_stats(df: DataFrame) -> DataFrame:
    """Pass rate and counts per framework; a NULL framework counts as `Unknown`."""
    framework = F.coalesce(F.col("framework"), F.lit("Unknown")).alias("framework")
    return (
        default_columns(df, REQUIRED)
        .groupBy(framework)
        .agg(F.count("*").alias("total_checks"), _count_status("PASS").alias("passed_checks"),
             _count_status("FAIL").alias("failed_checks"))
        .select("framework", (F.col("passed_checks") / F.col("total_checks")).alias("pass_rate"),
                "total_checks", "passed_checks", "failed_checks")
    )


def failure_counts(df: DataFrame) -> DataFrame:
    failed = default_columns(df, REQUIRED).where("status = 'FAIL' AND check_name IS NOT NULL")
    return failed.groupBy("check_name").agg(F.count("*").alias("failures"))


def top_failures(df: DataFrame, k: int = 5) -> DataFrame:
    """The k most frequent failing checks, ties by name."""
    return failure_counts(df).orderBy(F.desc("failures"), "check_name").limit(k)


def recommendations(df: DataFrame, rules: tuple[tuple[str, str], ...] = REMEDIATIONS) -> DataFrame:
    """Remediations whose check failed at least once, as `(position, recommendation)`.

    The checks are known in advance, so one aggregate of booleans answers all rules.
    """
    failed = default_columns(df, REQUIRED).where("status = 'FAIL'")
    hits = failed.agg(*[
        F.coalesce(F.bool_or(F.col("check_name") == check), F.lit(False)).alias(f"r{i}")
        for i, (check, _) in enumerate(rules)
    ])
    rows = F.array(*[
        F.struct(F.lit(i + 1).alias("position"), F.lit(text).alias("recommendation"), F.col(f"r{i}").alias("hit"))
        for i, (_, text) in enumerate(rules)
    ])
    return hits.select(F.inline(rows)).where("hit").drop("hit")


def rate_alert(df: DataFrame, threshold: float = 0.7) -> DataFrame:
    """One row when the overall rate is below the threshold, none otherwise."""
    return compliance_rate(df).where(F.col("compliance_rate") < threshold)


def compliance_document(df: DataFrame, as_of: str) -> DataFrame:
    """The summary as one nested row; empty input gives no row.

    Checks are counted once by (framework, check, status); every part of the document is
    derived from those few counts.
    """
    df = default_columns(df, REQUIRED)
    counts = df.groupBy(
        F.coalesce("framework", F.lit("Unknown")).alias("framework"), "check_name", "status"
    ).agg(F.count("*").alias("n"))
    n_pass = F.coalesce(F.sum(F.when(F.col("status") == "PASS", F.col("n"))), F.lit(0))
    n_fail = F.coalesce(F.sum(F.when(F.col("status") == "FAIL", F.col("n"))), F.lit(0))
    frameworks = (
        counts.groupBy("framework")
        .agg(F.sum("n").alias("total_checks"), n_pass.alias("passed_checks"), n_fail.alias("failed_checks"))
        .select("framework", F.struct(
            (F.col("passed_checks") / F.col("total_checks")).alias("pass_rate"),
            "total_checks", "passed_checks", "failed_checks").alias("stats"))
        .agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("framework", "stats")))).alias("m"))
    )
    failures = counts.where("status = 'FAIL' AND check_name IS NOT NULL").groupBy("check_name").agg(
        F.sum("n").alias("failures"))
    top = (
        failures.orderBy(F.desc("failures"), "check_name").limit(5)
        .agg(F.array_sort(F.collect_list(F.struct((-F.col("failures")).alias("o"), "check_name", "failures"))).alias("a"))
        .select(F.map_from_entries(F.transform("a", lambda x: F.struct(x["check_name"], x["failures"]))).alias("m"))
    )
    advice = recommendations(counts).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("position", "recommendation"))),
                    lambda r: r["recommendation"]).alias("a")
    )
    return (
        counts.agg(F.sum("n").alias("total"), n_pass.alias("passed"))
        .where("total > 0")
        .select(
            instant(as_of).alias("timestamp"), (F.col("passed") / F.col("total")).alias("compliance_rate"),
            frameworks.scalar().alias("framework_stats"), top.scalar().alias("top_failures"),
            advice.scalar().alias("recommendations"),
        )
    )
