"""Algorithm registry and grid searches of the anomaly detectors."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilframe.functions.stats import first_best
from vigilframe.operators.iforest import PSI, ForestSpec, forest_totals, iforest_anomalies, ranked
from vigilframe.operators.lof import factor_dispersion, lof_anomalies
from vigilframe.operators.neighbours import neighbourhood
from vigilframe.operators.prepare import fill_features
from vigilframe.session import materialize

# Fixed parameter grids, searched in nested order.
IFOREST_GRID = {
    "n_estimators": [100, 200], "max_samples": ["auto", 0.5], "contamination": [0.01, 0.05], "max_features": [1.0, 0.7],
}
LOF_GRID = {"n_neighbors": [5, 10], "algorithm": ["auto"], "leaf_size": [20, 30], "metric": ["euclidean"]}


def detect(
    df: DataFrame, features: list[str], keys: list[str], algorithm: str = "isolation_forest",
    contamination: float = 0.05, seed: int = 42,
) -> DataFrame:
    """Anomalous rows by the named algorithm; an unknown name is an error."""
    if algorithm == "isolation_forest":
        return iforest_anomalies(df, features, keys, contamination, seed=seed)
    if algorithm == "local_outlier_factor":
        return lof_anomalies(df, features, contamination)
    raise ValueError(f"unsupported algorithm: {algorithm}")


def detect_all(
    df: DataFrame, features: list[str], keys: list[str],
    algorithms: tuple[str, ...] = ("isolation_forest", "local_outlier_factor"), contamination: float = 0.05,
    lof_as_score: bool = False,
) -> DataFrame:
    """The anomalies of several algorithms, one below the other, with an `algorithm` column.

    Outlier-factor rows carry score 0 unless `lof_as_score` asks for the factor.
    """
    out = None
    for algorithm in algorithms:
        found = detect(df, features, keys, algorithm, contamination).withColumn("algorithm", F.lit(algorithm))
        if lof_as_score and "lof" in found.columns:
            found = found.withColumn("anomaly_score", F.col("lof"))
        found = found.drop("lof")
        if "anomaly_score" not in found.columns:
            found = found.withColumn("anomaly_score", F.lit(0.0))
        out = found if out is None else out.unionByName(found, allowMissingColumns=True)
    return out


def grid_points(grid: dict[str, list]) -> list[dict]:
    return [dict(zip(grid, values)) for values in itertools.product(*grid.values())]


def _grid_frame(df: DataFrame, points: list[dict]) -> DataFrame:
    rows = [(i, {k: str(v) for k, v in p.items()}) for i, p in enumerate(points)]
    return df.sparkSession.createDataFrame(rows, "grid_idx int, params map<string,string>")


def tune_iforest(
    df: DataFrame, features: list[str], keys: list[str], grid: dict[str, list] | None = None, seed: int = 42,
) -> DataFrame:
    """Objective (deviation of the scores) of every grid point, in grid order.

    A smaller forest is a prefix of the larger one and the contamination only shifts all
    scores, so few distinct forests are grown and scored.
    A sub-sample share is that share of the rows at every size; `psi` tells the rows per tree.
    """
    points = grid_points(grid or IFOREST_GRID)
    filled = fill_features(df.select(*keys, *features), features)
    rows = materialize(ranked(filled, keys, features, seed), "ranked")
    n = rows.count()

    def psi_of(share) -> int:
        wanted = PSI if share == "auto" else int(share * n) if isinstance(share, float) else int(share)
        return max(1, min(wanted, n))

    shapes = sorted({(psi_of(p["max_samples"]), p["max_features"]) for p in points})
    specs = [ForestSpec(i, psi, share) for i, (psi, share) in enumerate(shapes)]
    counts = sorted({p["n_estimators"] for p in points})
    scores = forest_totals(rows, features, specs, counts, seed, n)
    sizes = df.sparkSession.createDataFrame([(s.forest, s.psi) for s in specs], "forest int, psi int")
    long = scores.groupBy("forest", "n").agg(F.stddev_pop("score").alias("objective")).join(sizes, "forest")
    plan = [(i, shapes.index((psi_of(p["max_samples"]), p["max_features"])), p["n_estimators"])
            for i, p in enumerate(points)]
    keyed = _grid_frame(df, points).join(
        df.sparkSession.createDataFrame(plan, "grid_idx int, forest int, n int"), "grid_idx")
    return keyed.join(long, ["forest", "n"]).select("grid_idx", "params", "psi", "objective")


def tune_lof(df: DataFrame, features: list[str], grid: dict[str, list] | None = None) -> DataFrame:
    """Objective of every grid point; one neighbour search with the largest k serves all.

    `algorithm` and `leaf_size` are labels only: they cannot change an exact result.
    """
    points = grid_points(grid or LOF_GRID)
    sizes = sorted({p["n_neighbors"] for p in points})
    hood = neighbourhood(fill_features(df, features), features, max(sizes))
    objective = None
    for k in sizes:
        row = factor_dispersion(hood, k).withColumn("k", F.lit(k))
        objective = row if objective is None else objective.unionByName(row)
    plan = df.sparkSession.createDataFrame(
        [(i, p["n_neighbors"]) for i, p in enumerate(points)], "grid_idx int, k int")
    return _grid_frame(df, points).join(plan, "grid_idx").join(objective, "k").select(
        "grid_idx", "params", "objective")


def best_params(tuned: DataFrame, algorithm: str) -> DataFrame:
    """The winning grid point; the earliest wins a tie, and NULL objectives never win."""
    usable = tuned.where(F.col("objective").isNotNull() & ~F.isnan("objective"))
    return first_best(usable, "objective", "grid_idx").withColumn("algorithm", F.lit(algorithm))
