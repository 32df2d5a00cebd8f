"""Risk score of every asset from anomalies, vulnerabilities and failed checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilframe.functions.timing import instant
from vigilframe.operators.prepare import PRODUCER

# Fixed values of the scoring rule.
WEIGHTS = {"anomaly": 0.3, "vulnerability": 0.4, "compliance": 0.3}
CAPS = {"anomaly": 10.0, "vulnerability": 20.0, "compliance": 10.0, "intel": 10.0}
THRESHOLDS = {"high": 0.7, "medium": 0.4}
COMPLIANCE_POINTS = 0.5


def risk_level(score: Column, thresholds: dict[str, float] | None = None) -> Column:
    limits = thresholds or THRESHOLDS
    return F.when(score >= limits["high"], "high").when(score >= limits["medium"], "medium").otherwise("low")


def asset_universe(*frames: DataFrame) -> DataFrame:
    """Distinct hosts over all frames; rows without a host belong to `unknown`."""
    hosts = frames[0].select("host")
    for frame in frames[1:]:
        hosts = hosts.unionByName(frame.select("host"))
    return hosts.select(F.coalesce("host", F.lit("unknown")).alias("host")).distinct()


def component_sums(parts: dict[str, DataFrame]) -> DataFrame:
    """One row per host with the summed points of each component.

    The frames, each `(host, points)`, are stacked and aggregated once: a single shuffle
    of partial sums replaces the full outer joins, and a hot host costs nothing extra.
    """
    stacked = None
    for name, frame in parts.items():
        tagged = frame.select(F.coalesce("host", F.lit("unknown")).alias("host"), F.lit(name).alias("component"), F.col("points").cast("double"))
        stacked = tagged if stacked is None else stacked.unionByName(tagged)
    return stacked.groupBy("host").agg(*[
        F.coalesce(F.sum(F.when(F.col("component") == n, F.col("points"))), F.lit(0.0)).alias(n) for n in parts
    ])


def with_asset(df: DataFrame, assets: DataFrame, key: str = "host") -> DataFrame:
    """Attach the asset row to each host; hosts not listed take the `default` row.

    `assets` is a dimension; Spark broadcasts it only when its measured size allows.
    """
    columns = [c for c in assets.columns if c != "asset"]
    default = assets.where(F.col("asset") == "default").select(F.struct(*columns).alias("row"))
    joined = df.join(assets, df[key] == assets["asset"], "left")
    fallback = default.scalar()
    return joined.select(
        *df.columns, *[F.coalesce(assets[c], fallback.getField(c)).alias(c) for c in columns]
    )


def risk_scores(
    anomalies: DataFrame,
    vulnerabilities: DataFrame,
    compliance: DataFrame,
    assets: DataFrame,
    as_of: str,
    weights: str | dict[str, float] = "global",
    caps: dict[str, float] | None = None,
    thresholds: dict[str, float] | None = None,
    intel: DataFrame | None = None,
    intel_weight: float = 0.0,
    aliases: DataFrame | None = None,
) -> DataFrame:
    """Score every host seen in any input.

    `compliance` holds the failed checks only.  `weights="per_asset"` takes the weights of
    the asset row.  `intel` adds one point per indicator contact, weighted by `intel_weight`.
    `aliases(host, asset)`, one row per host, names the asset key of hosts listed under
    another name, such as their address.
    """
    limits = {**CAPS, **(caps or {})}
    parts = {
        "anomaly": anomalies.select("host", F.col("anomaly_score").alias("points")),
        "vulnerability": vulnerabilities.select("host", F.col("vulnerability_score").alias("points")),
        "compliance": compliance.select("host", F.lit(COMPLIANCE_POINTS).alias("points")),
    }
    if intel is not None:
        parts["intel"] = intel.select("host", F.lit(1.0).alias("points"))
    sums = component_sums(parts).select(
        "host", *[F.least(F.col(n) / limits[n], F.lit(1.0)).alias(f"{n}_score") for n in parts]
    )
    if aliases is None:
        joined = with_asset(sums, assets)
    else:
        named = sums.join(aliases.withColumnRenamed("asset", "asset_key"), "host", "left")
        joined = with_asset(named.withColumn("asset_key", F.coalesce("asset_key", "host")), assets, "asset_key")
    chosen = WEIGHTS if weights == "global" else weights

    def weight(name: str) -> Column:
        return F.col(f"{name}_weight") if weights == "per_asset" else F.lit(chosen[name])

    score = sum(
        (F.col(f"{n}_score") * weight(n) for n in ("vulnerability", "compliance")),
        F.col("anomaly_score") * weight("anomaly"),
    )
    if intel is not None:
        score = score + F.col("intel_score") * F.lit(intel_weight)
    return joined.withColumn("score", score).select(
        instant(as_of).alias("event_ts"), F.col("host").alias("asset"), "score",
        risk_level(F.col("score"), thresholds).alias("risk_level"),
        *[f"{n}_score" for n in parts], "criticality", F.lit(PRODUCER).alias("source"),
    )


def distinct_anomalies(anomalies: DataFrame) -> DataFrame:
    """Anomalies stored again by overlapping detection cycles count once.

    The key is host, time and, where present, algorithm; the score is the highest stored.
    """
    keys = [k for k in ("host", "event_ts", "algorithm") if k in anomalies.columns]
    return anomalies.groupBy(*keys).agg(F.max("anomaly_score").alias("anomaly_score"))


def risk_by_asset(scores: DataFrame) -> DataFrame:
    """Latest and mean score per asset over all scoring runs."""
    return scores.groupBy("asset").agg(
        F.max_by("score", "event_ts").alias("latest_score"), F.avg("score").alias("mean_score"),
        F.count("*").alias("runs"),
    )
