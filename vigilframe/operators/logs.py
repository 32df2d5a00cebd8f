"""Log analysis: patterns, clusters, rates and the summary document."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigilframe.functions.text import message_template
from vigilframe.functions.timing import instant

CLUSTERS = 10


@dataclass(frozen=True)
class Rule:
    """A named set of case-sensitive substrings; one hit is enough."""

    name: str
    needles: tuple[str, ...]

    def matches(self, text: Column) -> Column:
        text = F.coalesce(text, F.lit(""))
        hit = F.lit(False)
        for needle in self.needles:
            hit = hit | text.contains(needle)
        return hit


# Fixed values.
LOG_PATTERNS = (
    Rule("ssh_login_failure", ("Failed password for",)),
    Rule("sudo_command", ("sudo",)),
)


def tag_patterns(df: DataFrame, rules: tuple[Rule, ...] = LOG_PATTERNS, text: str = "message") -> DataFrame:
    """One row per (log row, matching rule); a row may match several rules or none."""
    hits = F.array_compact(F.array(*[F.when(r.matches(F.col(text)), F.lit(r.name)) for r in rules]))
    return df.select("*", F.explode(hits).alias("pattern"))


def pattern_counts(df: DataFrame, rules: tuple[Rule, ...] = LOG_PATTERNS, text: str = "message") -> DataFrame:
    """Matches per rule, zeros included: one global aggregate, no shuffle of log rows."""
    counted = df.agg(*[F.count_if(r.matches(F.col(text))).alias(r.name) for r in rules])
    rows = F.array(*[F.struct(F.lit(r.name).alias("pattern"), F.col(r.name).alias("matches")) for r in rules])
    return counted.select(F.inline(rows))


def is_auth() -> Column:
    return F.coalesce(F.col("source"), F.lit("")).contains("auth")


def auth_logs(df: DataFrame) -> DataFrame:
    return df.where(is_auth())


def hourly_counts(df: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    return df.groupBy(*keys, F.date_trunc("hour", "event_ts").alias("bucket")).agg(F.count("*").alias("n"))


def round_robin_clusters(df: DataFrame) -> DataFrame:
    """Clusters filled in turn: name and size of each non-empty one.

    Row i goes to cluster `i mod 10`, so the sizes depend on the row count alone and no
    global numbering is needed.
    """
    index = F.explode(F.sequence(F.lit(0), F.lit(CLUSTERS - 1)))
    return (
        df.agg(F.count("*").alias("n"))
        .select("n", index.alias("i"))
        .where(F.col("i") < F.col("n"))
        .select(F.concat(F.lit("cluster_"), F.col("i")).alias("cluster"),
                F.floor((F.col("n") - 1 - F.col("i")) / CLUSTERS + 1).cast("bigint").alias("logs"))
    )


def template_clusters(df: DataFrame, text: str = "message") -> DataFrame:
    """Group messages by their masked template, with the first and last time it was seen.

    All aggregates have fixed width, so the rows are hashed rather than sorted.
    """
    return df.groupBy(message_template(F.col(text)).alias("template")).agg(
        F.count("*").alias("logs"), F.min("event_ts").alias("first_seen"), F.max("event_ts").alias("last_seen"))


def log_rate_anomalies(
    df: DataFrame, keys: tuple[str, ...] = ("host",), trailing: int = 24, z: float = 3.0
) -> DataFrame:
    """Hours whose count is `z` deviations above the mean of the `trailing` hours before, of that key.

    Hours without rows count as 0, by arithmetic; an hour is judged once its key has been
    seen `trailing` hours earlier.  Rows are counted per hour before the window, so a window
    group holds at most one row per hour however hot the key.
    """
    order = Window.partitionBy(*keys).orderBy("hour")
    frame = order.rangeBetween(-trailing, -1)
    none = F.lit(0).cast("bigint")
    counts = hourly_counts(df, keys).withColumn("hour", F.floor(F.unix_seconds("bucket") / 3600)).withColumns({
        "total": F.coalesce(F.sum("n").over(frame), none),
        "squares": F.coalesce(F.sum(F.col("n") * F.col("n")).over(frame), none),
        "since": F.min("hour").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
    })
    spread = trailing * F.col("squares") - F.col("total") * F.col("total")
    return (
        counts.withColumns({"mean": F.col("total") / trailing, "dev": F.sqrt(spread / (trailing * (trailing - 1)))})
        .withColumn("z", F.try_divide(F.col("n") - F.col("mean"), F.col("dev")))
        .where((F.col("hour") - F.col("since") >= trailing) & (F.col("z") >= z))
        .select(*keys, "bucket", "n", "mean", "dev", "z")
    )


def running_counts(df: DataFrame, key: str = "source") -> DataFrame:
    """Rows per file and the total collected up to and including it, files in name order.

    Only one row per file reaches the ordered window.
    """
    per_file = df.groupBy(key).agg(F.count("*").alias("n"))
    frame = Window.orderBy(key).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per_file.withColumn("total", F.sum("n").over(frame))


def log_document(df: DataFrame, as_of: str, rules: tuple[Rule, ...] = LOG_PATTERNS) -> DataFrame:
    """All analyses of a log range as one nested row, from a single pass over the logs.

    The list of frequency anomalies is always empty; `log_rate_anomalies` is the separate
    working detector.
    """
    counted = df.agg(
        F.count("*").alias("n"), F.count_if(is_auth()).alias("auth_logs_count"),
        *[F.count_if(r.matches(F.col("message"))).alias(r.name) for r in rules],
    )
    clusters = F.least(F.col("n"), F.lit(CLUSTERS)).cast("int")
    keys = F.filter(F.transform(F.sequence(F.lit(0), F.lit(CLUSTERS - 1)), lambda i: F.when(
        i < F.col("n"), F.concat(F.lit("cluster_"), i))), lambda k: k.isNotNull())
    matches = F.map_from_arrays(F.array(*[F.lit(r.name) for r in rules]), F.array(*[F.col(r.name) for r in rules]))
    return counted.select(
        instant(as_of).alias("timestamp"), matches.alias("pattern_matches"), clusters.alias("num_clusters"),
        keys.alias("cluster_keys"), F.array().cast("array<string>").alias("freq_anomalies"), "auth_logs_count",
    )
