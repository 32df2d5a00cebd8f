"""Row preparation: nested metrics, host names, defaults, tags, document shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

METRIC_FEATURES = [
    "cpu_usage", "memory_usage", "load_1m", "network_in_bytes", "network_out_bytes",
]

# feature -> (parent struct, leaf path below it); fixed by the metric documents.
METRIC_PATHS = {
    "cpu_usage": ("system.cpu", "total.norm.pct"),
    "memory_usage": ("system.memory", "actual.used.pct"),
    "load_1m": ("system.load", "`1`"),
    "network_in_bytes": ("network", "in.bytes"),
    "network_out_bytes": ("network", "out.bytes"),
}

# Value of the `source` column in produced rows.
PRODUCER = "vigilframe"


def metric_features(df: DataFrame, keep: list[str] | None = None, drop_featureless: bool = False) -> DataFrame:
    """Flatten metric documents into `host` plus five numeric features.

    A present parent with a missing leaf gives 0, an absent parent gives NULL.  Detection
    keeps rows without any feature, tuning drops them (`drop_featureless`).
    """
    features = [
        F.when(
            F.col(parent).isNotNull(), F.coalesce(F.col(f"{parent}.{leaf}").cast("double"), F.lit(0.0))
        ).alias(name)
        for name, (parent, leaf) in METRIC_PATHS.items()
    ]
    host = F.coalesce(F.col("host.name"), F.lit("unknown")).alias("host")
    out = df.select(*(keep or []), "event_ts", host, *features)
    return out.dropna(how="all", subset=METRIC_FEATURES) if drop_featureless else out


def numeric_features(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    """Names of all numeric columns but the excluded keys; none is an error."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in exclude]
    if not names:
        raise ValueError("no numeric feature column")
    return names


def fill_features(df: DataFrame, features: list[str]) -> DataFrame:
    """NULL and NaN features become 0 before any fit."""
    return df.withColumns({
        f: F.coalesce(F.nanvl(F.col(f).cast("double"), F.lit(0.0)), F.lit(0.0)) for f in features
    })


def null_if_nan(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def host_name(document: Column) -> Column:
    """Host of a JSON document, given as `{"name": ...}` or as plain text."""
    return F.coalesce(
        F.get_json_object(document, "$.host.name"),
        # An object without a name has no usable host.
        F.when(~F.coalesce(F.get_json_object(document, "$.host"), F.lit("")).startswith("{"),
               F.get_json_object(document, "$.host")),
        F.lit("unknown"),
    )


def failed_checks(df: DataFrame) -> DataFrame:
    return df.where(F.col("status") == "FAIL")


def default_columns(df: DataFrame, columns: list[str], value: str = "Unknown") -> DataFrame:
    """Add required columns only where the whole column is absent."""
    return df.withColumns({c: F.lit(value) for c in columns if c not in df.columns})


def path_tags(df: DataFrame, application_prefix: str = "/opt/worker/logs/") -> DataFrame:
    """Tag rows by the folder of their log file: system logs or application logs."""
    system, application = F.col("source").startswith("/var/log/"), F.col("source").startswith(application_prefix)
    return df.withColumns({
        "tags": F.when(system, F.array(F.lit("system")))
        .when(application, F.array(F.lit("application"))).otherwise(F.array().cast("array<string>")),
        "source_type": F.when(system, "syslog").when(application, "application"),
        "environment": F.when(system | application, "security"),
    })


def anomaly_documents(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Shape detector output into stored anomaly rows with a nested `details` struct.

    Detectors without a score column store score 0.
    """
    absent = F.lit(0.0)
    details = F.struct(*[
        (null_if_nan(F.col(f)) if f in df.columns else absent).alias(f) for f in METRIC_FEATURES
    ])
    score = null_if_nan(F.col("anomaly_score")) if "anomaly_score" in df.columns else absent
    return df.select(
        *(keep or []), "event_ts",
        (F.col("host") if "host" in df.columns else F.lit("unknown")).alias("host"),
        score.alias("anomaly_score"), F.lit("system_metrics").alias("anomaly_type"),
        F.lit(PRODUCER).alias("source"), details.alias("details"),
    )


def deduplicate(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key set; the surviving row is the least one, whatever the partitioning."""
    others = [c for c in df.columns if c not in keys]
    if len(others) == 1:  # one plain column aggregates by hashing, a struct needs a sort
        return df.groupBy(*keys).agg(F.min(others[0]).alias(others[0]))
    return df.groupBy(*keys).agg(F.min(F.struct(*others)).alias("_row")).select(*keys, "_row.*")
