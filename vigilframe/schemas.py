"""Declared schema of every dataset, and the typed reader with its quarantine side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


DETAILS = (
    "struct<cpu_usage:double,memory_usage:double,load_1m:double,"
    "network_in_bytes:double,network_out_bytes:double>"
)

SCHEMAS: dict[str, str] = {
    "logs": "event_ts timestamp, message string, log_type string, source string, host string",
    "beat_logs": (
        "event_ts timestamp, message string, source string, ip string, domain string, url string, "
        "hash string, tags array<string>, fields struct<source_type:string,environment:string>"
    ),
    "metrics": (
        "event_ts timestamp, host struct<name:string>, "
        "system struct<cpu:struct<total:struct<norm:struct<pct:double>>>,"
        "memory:struct<actual:struct<used:struct<pct:double>>>,load:struct<`1`:double>>, "
        "network struct<`in`:struct<bytes:double>,out:struct<bytes:double>>"
    ),
    "anomalies": (
        "event_ts timestamp, host string, anomaly_score double, anomaly_type string, source string, "
        f"details {DETAILS}"
    ),
    "vulnerabilities": (
        "event_ts timestamp, host string, port int, service string, severity string, "
        "description string, vulnerability_score double"
    ),
    "compliance": (
        "event_ts timestamp, host string, framework string, check_name string, status string, output string"
    ),
    "risk_scores": (
        "event_ts timestamp, asset string, score double, risk_level string, anomaly_score double, "
        "vulnerability_score double, compliance_score double, criticality string, source string"
    ),
    "threat_intel": "type string, indicator string, threat_level string, description string",
    "threat_training": "message string, threat_type string",
    "asset_criticality": (
        "asset string, name string, criticality string, anomaly_weight double, "
        "vulnerability_weight double, compliance_weight double, total_weight double"
    ),
    "openvas_results": "name string, host string, port int, threat string, description string",
    "messages": (
        "event_ts timestamp, type string, worker_id string, worker_type string, host string, data string"
    ),
    "worker_status": (
        "id string, type string, host string, last_heartbeat double, status string"
    ),
}


def schema_of(name: str) -> T.StructType:
    """Declared schema of a dataset; needs a running session to read the type text."""
    return T.StructType.fromDDL(SCHEMAS[name])


def enforce(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Cast loose columns to a declared schema; return `(typed, quarantine)`.

    Columns absent from `df` become NULL.  A row whose non-null value does not cast is
    kept whole in the quarantine frame, with the failing columns listed in `bad_columns`.
    """
    present = [f for f in schema.fields if f.name in df.columns]

    def cast(field: T.StructField) -> Column:
        return F.col(f"`{field.name}`").try_cast(field.dataType)

    failed = F.array_compact(
        F.array(*[
            F.when(F.col(f"`{f.name}`").isNotNull() & cast(f).isNull(), F.lit(f.name)) for f in present
        ])
    )
    checked = df.withColumn("bad_columns", failed)
    typed = checked.where(F.size("bad_columns") == 0).select(*[
        (cast(f) if f in present else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields
    ])
    return typed, checked.where(F.size("bad_columns") > 0)


def parse_json(df: DataFrame, column: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Parse JSON text into `schema`; rows that are not valid JSON go to the quarantine frame."""
    corrupt = T.StructField("_corrupt_record", T.StringType())
    parsed = df.withColumn(
        "_parsed",
        F.from_json(column, T.StructType([*schema.fields, corrupt]), {"mode": "PERMISSIVE"}),
    )
    bad = F.col("_parsed").isNull() | F.col("_parsed._corrupt_record").isNotNull()
    good = parsed.where(~bad).select(*[F.col(f"_parsed.`{f.name}`").alias(f.name) for f in schema.fields])
    return good, parsed.where(bad).drop("_parsed")
