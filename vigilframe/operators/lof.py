"""Local outlier factor (Breunig et al. 2000) as joins over the exact neighbour edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilframe.functions.stats import below_quantile
from vigilframe.operators.neighbours import Neighbourhood, nearest, neighbourhood
from vigilframe.operators.prepare import fill_features
from vigilframe.session import materialize

DENSITY_FLOOR = 1e-10  # fixed value; keeps the density of piled-up copies finite


def point_factors(hood: Neighbourhood, k: int | None = None) -> DataFrame:
    """`(pid, m, lof)` per distinct point, for the built k or any smaller one."""
    edges = hood.edges
    size = hood.k
    if k is not None and k < hood.k:
        edges, size = nearest(edges, k), k
    reach_of = edges.groupBy("qid").agg(F.sqrt(F.max("d2")).alias("kdist")).withColumnRenamed("qid", "pid")
    reach = F.greatest("kdist", F.sqrt("d2"))
    density = (
        edges.join(reach_of, "pid").groupBy("qid")
        .agg((1.0 / (F.sum(F.col("w") * reach) / size + DENSITY_FLOOR)).alias("lrd"))
    )
    near = density.withColumnRenamed("qid", "pid").withColumnRenamed("lrd", "near_lrd")
    mean = edges.join(near, "pid").groupBy("qid").agg((F.sum(F.col("w") * F.col("near_lrd")) / size).alias("mean_lrd"))
    factors = mean.join(density, "qid").select(
        F.col("qid").alias("pid"), (F.col("mean_lrd") / F.col("lrd")).alias("lof"))
    return hood.points.select("pid", "m").join(factors, "pid")


def lof_scores(df: DataFrame, features: list[str], k: int = 20) -> DataFrame:
    """Every row with its `lof`.  Missing features count as 0; equal rows score equal."""
    filled = fill_features(df, features)
    hood = neighbourhood(filled, features, k)
    factors = hood.points.join(point_factors(hood).select("pid", "lof"), "pid").select(*features, "lof")
    return filled.join(factors, features).select(*df.columns, "lof")


def lof_anomalies(df: DataFrame, features: list[str], contamination: float = 0.05, k: int = 20) -> DataFrame:
    """Rows whose negated factor lies strictly below the contamination quantile."""
    scored = materialize(lof_scores(df, features, k).withColumn("negative_lof", -F.col("lof")))
    return below_quantile(scored, "negative_lof", contamination).drop("negative_lof")


def factor_dispersion(hood: Neighbourhood, k: int) -> DataFrame:
    """Population deviation of the factor over all rows, one row `(objective)`."""
    factors = materialize(point_factors(hood, k))
    mean = factors.agg(F.sum(F.col("m") * F.col("lof")) / F.sum("m")).scalar()
    return factors.select("m", (F.col("lof") - mean).alias("d")).agg(
        F.sqrt(F.sum(F.col("m") * F.col("d") * F.col("d")) / F.sum("m")).alias("objective"))
