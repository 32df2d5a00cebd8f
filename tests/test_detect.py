import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from vigilframe.functions import stats
from vigilframe.operators import classify, detect, iforest, lof, neighbours
from vigilframe.sources import sinks


def brute_lof(x, k):
    """Textbook factor; neighbours by squared distance, then by feature values."""
    order = np.lexsort(x.T[::-1])
    x = x[order]
    k = min(k, len(x) - 1)
    d2 = sum((x[:, None, j] - x[None, :, j]) ** 2 for j in range(x.shape[1]))
    np.fill_diagonal(d2, np.inf)
    near = np.argsort(d2, axis=1, kind="stable")[:, :k]
    dist = np.sqrt(np.take_along_axis(d2, near, axis=1))
    reach = np.maximum(dist[:, -1][near], dist)
    lrd = 1 / (reach.mean(axis=1) + 1e-10)
    out = np.empty(len(x))
    out[order] = lrd[near].mean(axis=1) / lrd
    return out


@pytest.mark.parametrize("cell_points", [4, 50, 10_000])
def test_lof_equals_brute_force(spark, cell_points):
    rng = np.random.default_rng(1)
    x = np.round(np.vstack([rng.normal(0, 1, (150, 2)), rng.normal(8, 0.1, (60, 2)), np.zeros((70, 2)), [[30, 30]]]), 1)
    df = spark.createDataFrame(pd.DataFrame({"id": range(len(x)), "a": x[:, 0], "b": x[:, 1]}))
    hood = neighbours.neighbourhood(df, ["a", "b"], 5, cell_points)
    joined = df.join(hood.points, ["a", "b"]).join(lof.point_factors(hood).select("pid", "lof"), "pid")
    got = joined.orderBy("id").toPandas()["lof"].to_numpy()
    np.testing.assert_allclose(got, brute_lof(x, 5), rtol=1e-9)
    smaller = df.join(hood.points, ["a", "b"]).join(lof.point_factors(hood, 3).select("pid", "lof"), "pid")
    np.testing.assert_allclose(smaller.orderBy("id").toPandas()["lof"].to_numpy(), brute_lof(x, 3), rtol=1e-9)


@pytest.mark.parametrize("first_levels,cell_points", [(1, 4), (2, 8), (3, 30)])
def test_lof_with_two_tiers(spark, monkeypatch, first_levels, cell_points):
    """Cells of a second tier, thin ones among them, give the exact factors."""
    monkeypatch.setattr(neighbours, "MAX_LEVELS", first_levels)
    monkeypatch.setattr(neighbours, "SAMPLE_PER_CELL", 2)  # poor samples: uneven and empty cells
    rng = np.random.default_rng(8)
    x = np.round(np.vstack([rng.normal(0, 1, (160, 3)), rng.normal(5, 0.2, (70, 3)), np.zeros((40, 3)), [[40, 40, 40], [41, 40, 40], [-90, 0, 0]]]), 2)
    df = spark.createDataFrame(pd.DataFrame(x, columns=list("abc")).assign(id=range(len(x)))).repartition(3)
    for k in (3, 12):
        got = df.join(_factors(df, k, cell_points), ["a", "b", "c"])
        np.testing.assert_allclose(got.orderBy("id").toPandas()["lof"].to_numpy(), brute_lof(x, k), rtol=1e-9)


def _factors(df, k, cell_points):
    hood = neighbours.neighbourhood(df, ["a", "b", "c"], k, cell_points)
    return hood.points.join(lof.point_factors(hood).select("pid", "lof"), "pid").select("a", "b", "c", "lof")


def test_thin_cells_take_the_box_around():
    boxes = pd.DataFrame({"cell": [0, 1, 2, 5], "rows": [9, 2, 1, 1], "lo0": [0.0, 5.0, 9.0, 20.0], "hi0": [4.0, 6.0, 9.0, 21.0]})
    low, high = neighbours.around(boxes, 1, 3)
    assert low.ravel().tolist() == [0, 0, 0, 0] and high.ravel().tolist() == [4, 6, 9, 21]
    low, high = neighbours.around(boxes, 1, 50)  # nowhere enough: the box around all
    assert set(low.ravel()) == {0} and set(high.ravel()) == {21}


def test_lof_grid_interior_and_small_tables(spark):
    grid = spark.sql("SELECT a.id * 1.0D AS a, b.id * 1.0D AS b FROM range(12) a JOIN range(12) b")
    inner = lof.lof_scores(grid, ["a", "b"], 4).where("a BETWEEN 3 AND 8 AND b BETWEEN 3 AND 8")
    assert inner.agg(F.max(F.abs(F.col("lof") - 1))).first()[0] < 1e-6
    three = spark.createDataFrame([(0.0,), (1.0,), (None,)], "a double")
    assert lof.lof_scores(three, ["a"]).count() == 3


def test_chunks_split_hot_cells(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "QUERY_CHUNK", 7)
    monkeypatch.setattr(neighbours, "POINT_CHUNK", 11)
    x = np.round(np.random.default_rng(3).normal(0, 1, (120, 3)), 1)
    df = spark.createDataFrame(pd.DataFrame(x, columns=list("abc")).assign(id=range(len(x))))
    got = lof.lof_scores(df, ["a", "b", "c"], 6).orderBy("id").toPandas()["lof"].to_numpy()
    np.testing.assert_allclose(got, brute_lof(x, 6), rtol=1e-9)


def test_iforest_finds_planted_rows(spark):
    rng = np.random.default_rng(0)
    x = np.vstack([rng.normal(0, 1, (600, 3)), rng.normal(0, 1, (6, 3)) + 15])
    df = spark.createDataFrame(pd.DataFrame(x, columns=list("abc")).assign(id=range(len(x))))
    found = iforest.iforest_anomalies(df, ["a", "b", "c"], ["id"], 0.01).toPandas()
    assert set(range(600, 606)) <= set(found["id"]) and len(found) <= 0.01 * len(x) + 1
    assert found["anomaly_score"].between(0, 1).all()
    again = iforest.iforest_anomalies(df.repartition(3), ["a", "b", "c"], ["id"], 0.01).toPandas()
    assert sorted(found["id"]) == sorted(again["id"])  # independent of the partitioning


def brute_paths(x, r, spec, tree, n, seed):
    """A tree grown and walked node by node, from the same draws."""
    draws, out = iforest.Draws(seed, spec.forest, tree), np.zeros(len(x))
    allowed = draws.features(x.shape[1], spec.max_features)
    a, b = draws.sample(n)
    psi = min(spec.psi, n)
    some = np.array([(a * int(v) + b) % n < psi for v in r])
    assert some.sum() == psi

    def walk(rows, node, depth):
        inside = x[rows[some[rows]]]
        free = [f for f in allowed if len(inside) and inside[:, f].max() > inside[:, f].min()]
        if depth == math.ceil(math.log2(max(psi, 2))) or not free:
            out[rows] = depth + iforest.average_path(len(inside))
            return
        digits = draws.hexadecimal(f"n{node}")
        f = free[int(int(digits[:13], 16) / 16**13 * len(free))]
        low, high = inside[:, f].min(), inside[:, f].max()
        cut = low + int(digits[13:26], 16) / 16**13 * (high - low)
        cut = cut if cut < high else low
        walk(rows[x[rows, f] <= cut], 2 * node, depth + 1)
        walk(rows[x[rows, f] > cut], 2 * node + 1, depth + 1)

    walk(np.arange(len(x)), 1, 0)
    return out


def test_average_path_and_trees(spark):
    assert iforest.average_path(1) == 0 and iforest.average_path(2) == 1
    assert iforest.average_path(256) == pytest.approx(10.244770, abs=1e-5)
    df = spark.range(2000).select("id", F.rand(1).alias("a"))
    rows_ = iforest.ranked(df, ["id"], ["a"], 42)
    forest = iforest.fit_forests(rows_, ["a"], [iforest.ForestSpec(0, 64)], 10, 42, 2000)[0]
    assert forest.feature.shape[0] == 10 and forest.psi == 64
    assert (forest.feature >= 0).sum(axis=1).max() <= 63


def test_order_and_samples(spark):
    """Places are a permutation whatever the partitions; every tree draws exactly psi rows, from all rows."""
    df = spark.range(5000).select("id", (F.col("id") % 10).cast("double").alias("a"))
    order = [r["r"] for r in iforest.ranked(df, ["id"], ["a"], 42).orderBy("r").collect()]
    assert order == list(range(5000))
    one, two = (iforest.ranked(d, ["id"], ["a"], 42).orderBy("r").collect() for d in (df, df.repartition(7)))
    assert one == two
    spec = iforest.ForestSpec(3, 8)
    rows_ = iforest.ranked(df.withColumn("b", F.col("id").cast("double")), ["id"], ["b"], 42)
    few = iforest.sampled(rows_, [spec], ["b"], 40, 42, 5000)
    assert {r["count"] for r in few.groupBy("tree").count().collect()} == {8}
    assert few.select("b").distinct().count() > 250  # of 320 draws
    place = {r["r"]: r["b"] for r in rows_.collect()}
    for tree in range(5):
        a, b = iforest.Draws(42, 3, tree).sample(5000)
        wanted = {place[v] for v in range(5000) if (a * v + b) % 5000 < 8}
        assert {r["b"] for r in few.where(F.col("tree") == tree).collect()} == wanted


@pytest.mark.parametrize("leaf_rows", [5, 60, 10_000])
def test_ways_of_growing_agree(spark, monkeypatch, leaf_rows):
    """Shipped models, whole tables in batches of trees, and growth by levels against plain recursion."""
    rng = np.random.default_rng(4)
    x = np.round(np.vstack([rng.normal(0, 1, (180, 3)), np.zeros((25, 3)), rng.normal(6, 3, (20, 3))]), 1)
    n, features = len(x), ["a", "b", "c"]
    df = spark.createDataFrame(pd.DataFrame(x, columns=features).assign(id=range(n)))
    specs = [iforest.ForestSpec(0, 16), iforest.ForestSpec(1, 112, 0.7)]
    ordered = iforest.ranked(df, ["id"], features, 7)
    kept = ordered.orderBy("r").toPandas()
    expected = {}
    for spec in specs:
        paths = np.stack([brute_paths(kept[features].to_numpy(), kept["r"].to_numpy(), spec, t, n, 7) for t in range(6)])
        for count in (4, 6):
            expected[spec.forest, count] = np.sort(iforest.scores(paths[:count].sum(axis=0), count, spec.psi))
    monkeypatch.setattr(iforest, "LEAF_ROWS", leaf_rows)
    monkeypatch.setattr(iforest, "TREE_BATCH", 3)
    for light in (True, False):
        monkeypatch.setattr(iforest, "travelling", lambda *a: light)
        got = iforest.forest_totals(ordered, features, specs, [4, 6], 7, n).toPandas()
        for (forest, count), wanted in expected.items():
            mine = got[(got["forest"] == forest) & (got["n"] == count)]["score"]
            np.testing.assert_allclose(np.sort(mine), wanted, rtol=1e-9)


def test_shares_have_no_limit(spark):
    df = spark.range(20_000).select("id", F.rand(1).alias("a"))
    tuned = detect.tune_iforest(df, ["a"], ["id"], {"n_estimators": [3], "max_samples": [64, 0.5], "contamination": [0.05], "max_features": [1.0]})
    got = {r["grid_idx"]: r for r in tuned.collect()}
    assert got[0]["psi"] == 64 and got[1]["psi"] == 10_000
    kept = iforest.ranked(df, ["id"], ["a"], 42).toPandas()
    for i, psi in enumerate((64, 10_000)):
        spec = iforest.ForestSpec(i, psi)
        total = sum(brute_paths(kept[["a"]].to_numpy(), kept["r"].to_numpy(), spec, t, 20_000, 42) for t in range(3))
        assert got[i]["objective"] == pytest.approx(iforest.scores(total, 3, psi).std(), rel=1e-9)


def test_iforest_keeps_repeated_rows_and_columns(spark):
    """Rows of one key stay apart, and rows without features or keys take part."""
    data = [(1, 0.0, "x"), (1, 0.1, "y"), (None, None, "z")] + [(2, 50.0, "far")] + [(3 + i % 4, (i % 10) / 10, "in") for i in range(60)]
    df = spark.createDataFrame(data, "id int, a double, note string")
    found = iforest.iforest_anomalies(df, ["a"], ["id"], 0.02).collect()
    assert [(r["id"], r["a"], r["note"]) for r in found] == [(2, 50.0, "far")]
    assert iforest.iforest_anomalies(df.limit(0), ["a"], ["id"]).count() == 0


def test_constant_rows(spark):
    df = spark.range(50).select("id", F.lit(1.0).alias("a"))
    assert iforest.iforest_anomalies(df, ["a"], ["id"]).count() == 0  # all scores tie
    assert lof.lof_anomalies(df, ["a"]).count() == 0


def test_registry_and_grids(spark):
    df = spark.range(300).select("id", F.pow(F.col("id") / 50, F.lit(2)).alias("a"))
    with pytest.raises(ValueError):
        detect.detect(df, ["a"], ["id"], "nonsense")
    tuned = detect.tune_iforest(df, ["a"], ["id"], {"n_estimators": [5, 10], "max_samples": ["auto", 0.5], "contamination": [0.01, 0.05], "max_features": [1.0]})
    got = {r["grid_idx"]: r for r in tuned.collect()}
    assert len(got) == 8 and got[0]["objective"] == got[1]["objective"] and got[2]["psi"] == 150
    assert detect.best_params(tuned, "isolation_forest").count() == 1
    both = detect.detect_all(df, ["a"], ["id"])
    assert both.where("algorithm = 'local_outlier_factor' AND anomaly_score = 0").count() > 0
    assert both.where("anomaly_score IS NULL").count() == 0
    grid = {r["grid_idx"]: r["objective"] for r in detect.tune_lof(df, ["a"]).collect()}
    assert len(grid) == 4 and grid[0] == grid[1] and grid[2] == grid[3]
    x = np.array([[(i / 50) ** 2] for i in range(300)])
    assert grid[0] == pytest.approx(brute_lof(x, 5).std()) and grid[2] == pytest.approx(brute_lof(x, 10).std())


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 6), min_size=1, max_size=40), st.sampled_from([0.0, 0.05, 0.3, 0.5, 0.97, 1.0]))
def test_exact_quantile(spark, values, share):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = stats.exact_quantile(df, "x", share).first()[0]
    assert got == pytest.approx(float(np.quantile(values, share)))


HUGE = st.floats(allow_nan=False, allow_infinity=True)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.sampled_from([0.0, -0.0, 1.0, -1.0, 5e-324, -5e-324, 1.7e308, -1.7e308]), HUGE), min_size=1, max_size=60), st.data())
def test_order_statistics(spark, values, data):
    """Ties, negative, tiny, huge and infinite values, and NULL, which is no value."""
    ranks = data.draw(st.lists(st.integers(0, len(values) - 1), min_size=1, max_size=4))
    df = spark.createDataFrame([(v,) for v in [*values, None]], "x double").repartition(3)
    assert stats.order_statistics(df, "x", lambda n: ranks) == (len(values), [sorted(values)[r] for r in ranks])


def test_order_statistics_over_many_rows(spark):
    df = spark.range(200_000).select((F.pmod(F.col("id") * 7919, F.lit(200_000)) / 3 - 30_000).alias("x"))
    expected = np.arange(200_000) / 3 - 30_000
    assert stats.quantile(df, "x", 0.05) == pytest.approx(float(np.quantile(expected, 0.05)), rel=1e-12)
    close = spark.range(50_000).select((1 + F.col("id") * F.lit(2.0**-52)).alias("x"))  # neighbours among doubles
    assert stats.order_statistics(close, "x", lambda n: [0, 31_337, n - 1])[1] == [1.0, 1 + 31_337 * 2.0**-52, 1 + 49_999 * 2.0**-52]


def test_order_statistics_special(spark):
    nothing = spark.createDataFrame([], "x double")
    assert stats.quantile(nothing, "x", 0.5) is None and stats.exact_quantile(nothing, "x", 0.5).first()[0] is None
    assert stats.below_quantile(nothing, "x", 0.5).count() == 0
    odd = spark.createDataFrame([(float("nan"),), (1.0,), (float("-inf"),)], "x double")
    n, found = stats.order_statistics(odd, "x", lambda n: [0, 1, 2])
    assert n == 3 and found[:2] == [float("-inf"), 1.0] and math.isnan(found[2])  # NaN is the greatest, as in Spark
    plan = stats.below_quantile(spark.range(100), "id", 0.1)._jdf.queryExecution().toString()
    assert "Window" not in plan and "percentile" not in plan


def test_min_max_ties(spark):
    df = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert rows(stats.inverse_min_max(df, "x", "s").select("s")) == [(None,), (None,)]
    best = spark.createDataFrame([(0, 1.0), (1, 2.0), (2, 2.0)], "i int, s double")
    assert stats.first_best(best, "s", "i").first()["i"] == 1


def test_half_a_table_of_few_rows_is_not_grown_by_levels(spark, monkeypatch):
    """Beyond 131,072 rows as below: a tree's rows are dealt once, not written a level."""
    monkeypatch.setattr(iforest, "level_totals", lambda *_: pytest.fail("grown by levels"))
    n = 140_000
    rows_ = spark.range(n).select(F.col("id").alias("r"), F.pmod(F.xxhash64("id"), F.lit(1000)).cast("double").alias("a"))
    found = iforest.forest_totals(rows_, ["a"], [iforest.ForestSpec(0, n // 2)], [4], 42, n).agg(F.count("score"), F.min("score"), F.max("score")).first()
    assert found[0] == n and -1 <= found[1] < found[2] < 0


def test_half_a_large_table_is_dealt_packed(spark, monkeypatch):
    """Up to `WHOLE_LEAVES` times `LEAF_ROWS` rows too: whole, in blocks, with the paths of plain recursion."""
    monkeypatch.setattr(iforest, "level_totals", lambda *_: pytest.fail("grown by levels"))
    monkeypatch.setattr(iforest, "LEAF_ROWS", 100)
    monkeypatch.setattr(iforest, "BLOCK_ROWS", 64)
    n, rng = 700, np.random.default_rng(3)
    x = np.where(rng.random((n, 3)) < 0.6, 0.0, rng.exponential(1, (n, 3)))
    rows_ = spark.createDataFrame(pd.DataFrame(x, columns=list("abc")).assign(r=range(n))).repartition(3)
    spec = iforest.ForestSpec(0, 3 * n // 4)
    monkeypatch.setattr(iforest, "travelling", lambda *_: False)
    got = iforest.forest_totals(rows_, list("abc"), [spec], [2, 5], 42, n).toPandas()
    paths = np.stack([brute_paths(x, np.arange(n), spec, t, n, 42) for t in range(5)])
    for count in (2, 5):
        wanted = np.sort(iforest.scores(paths[:count].sum(axis=0), count, spec.psi))
        np.testing.assert_allclose(np.sort(got[got["n"] == count]["score"]), wanted, rtol=1e-9)


@pytest.mark.parametrize("small", [8, 10_000])
def test_paths_in_the_order_of_the_features(monkeypatch, small):
    """Sparse, dense, infinite and missing numbers: large nodes met one by one, small ones by level, lines by their cuts."""
    monkeypatch.setattr(iforest, "SMALL_ROWS", small)
    rng, n = np.random.default_rng(6), 400
    one = np.zeros((n, 3))
    one[np.arange(n), rng.integers(0, 3, n)] = rng.exponential(1, n)
    odd = rng.normal(0, 1, (n, 3)).round(1)
    odd[rng.random((n, 3)) < 0.03] = np.inf
    for x in (one, rng.normal(0, 1, (n, 3)), odd):
        for tree in range(3):
            spec, draws = iforest.ForestSpec(0, n // 2, 0.7), iforest.Draws(1, 0, tree)
            some = iforest.inside(np.arange(n), *draws.sample(n), n, spec.psi)
            with np.errstate(all="ignore"):
                got = iforest.lengths(x, some, draws.features(3, 0.7), draws, iforest.depth_limit(spec.psi))
                np.testing.assert_allclose(got, brute_paths(x, np.arange(n), spec, tree, n, 1), rtol=1e-12)
    gaps = np.array([[np.nan], [1.0], [2.0], [np.nan], [3.0]])
    draws = iforest.Draws(1, 0, 0)
    assert (iforest.lengths(gaps, np.ones(5, bool), np.array([0]), draws, 3) == iforest.average_path(5)).all()  # not cut beside NaN


@pytest.fixture(scope="module")
def training(spark):
    data = [(i, f"failed password for root{i} from host common", "brute") for i in range(12)]
    data += [(20 + i, f"malware signature{i} detected common x", "malware") for i in range(12)]
    return spark.createDataFrame(data, "id int, message string, threat_type string")


def test_tfidf_hand_computed(spark):
    df = spark.createDataFrame([(1, "Red red blue a all"), (2, "blue all"), (3, "green all")], "id int, message string")
    got = {(r["id"], r["token"]): r["weight"] for r in classify.tfidf_weights(df, "id").collect()}
    red, blue = 2 * (math.log(4 / 2) + 1), math.log(4 / 3) + 1
    norm = math.hypot(red, blue)
    assert set(got) == {(1, "red"), (1, "blue"), (2, "blue"), (3, "green")}  # "all" is in every row, "a" too short
    assert got[1, "red"] == pytest.approx(red / norm) and got[2, "blue"] == pytest.approx(1.0)


def test_split_size(spark):
    for n in (1, 2, 7, 10, 101):
        split = classify.train_test_split(spark.range(n), "id")
        assert split.where("is_test").count() == math.ceil(0.3 * n)
        assert rows(split, "id") == rows(classify.train_test_split(spark.range(n).repartition(3), "id"), "id")


def test_classifier(spark, training, tmp_path):
    model = classify.train_classifier(training)
    sinks.save_model(model, str(tmp_path / "m"))
    again = sinks.load_model(str(tmp_path / "m"))
    fresh = spark.createDataFrame([("failed password again",), ("malware found",)], "message string")
    assert [r["predicted"] for r in classify.classify(again, fresh).collect()] == ["brute", "malware"]
    fresh.write.parquet(str(tmp_path / "s"))
    from vigilframe.streaming import runs
    stream = classify.classify(again, spark.readStream.schema("message string").parquet(str(tmp_path / "s")))
    assert {r["predicted"] for r in runs.run_once(stream, spark, "c").collect()} == {"brute", "malware"}
    weights = {(r["id"], r["token"]): r["weight"] for r in classify.tfidf_weights(training, "id").where("id = 0").collect()}
    unit = model.transform(training.where("id = 0")).first()["features"].toArray()
    np.testing.assert_allclose(sorted(v for v in unit if v), sorted(weights.values()), rtol=1e-9)


def test_wide_classifier(spark, training, tmp_path, monkeypatch):
    """Words and coefficients as a table: the minimum, predictions, a saved model, a stream; no row is left out."""
    from vigilframe.operators import wide
    from vigilframe.streaming import runs
    monkeypatch.setattr(wide, "PART_ROWS", 7)
    monkeypatch.setattr(classify, "TOL", 1e-7)
    third = spark.createDataFrame([(40 + i, f"common lines of host{i % 3} x1 x1", "normal") for i in range(5)] + [(50, None, "normal"), (51, "a", "normal")], training.schema)
    fresh = spark.createDataFrame([("failed password again",), ("malware found",), ("unheard",), (None,)], "message string")
    for rows_ in (training, training.unionByName(third)):
        model = classify.train_classifier(rows_, max_coefficients=0)
        tf = {(r["id"], r["token"]): r["weight"] for r in classify.tfidf_weights(rows_, "id").collect()}
        table = {r["token"]: r["weights"] for r in model.weights.collect()}
        assert set(table) == {token for _, token in tf}
        ids, words = sorted(r["id"] for r in rows_.collect()), sorted(table)
        x = np.array([[tf.get((i, w), 0.0) for w in words] for i in ids])
        classes = {r["id"]: model.classes.index(r["threat_type"]) for r in rows_.collect()}
        w, y = np.array([table[t] for t in words]), np.array([classes[i] for i in ids])
        margins = x @ w + np.array(model.intercepts)
        both = margins if margins.shape[1] > 1 else np.hstack([0 * margins, margins])
        p = np.exp(both) / np.exp(both).sum(axis=1, keepdims=True)
        p[np.arange(len(y)), y] -= 1
        gradient = np.vstack([x.T @ p[:, -w.shape[1]:] + w, p[:, -w.shape[1]:].sum(axis=0)])
        assert np.abs(gradient).max() < 1e-2 and np.abs(w).max() > 0.1  # at the minimum it is zero
        sinks.save_model(model, str(tmp_path / f"m{len(ids)}"))
        again = sinks.load_model(str(tmp_path / f"m{len(ids)}"))
        found = [r["predicted"] for r in classify.classify(again, fresh).collect()]
        assert found[:2] == ["brute", "malware"] and found[2] == found[3] == model.classes[int(np.argmax([0.0, *model.intercepts][-len(model.classes):]))]
    fresh.write.parquet(str(tmp_path / "s"))
    stream = spark.readStream.schema("message string").parquet(str(tmp_path / "s"))
    with pytest.raises(ValueError):
        classify.classify(again, stream)
    runs.run_batches(stream, spark, "wide", classify.classify_batches(again, str(tmp_path / "out"), ["message"]))
    assert {r["predicted"] for r in spark.read.parquet(str(tmp_path / "out" / "batch=*")).where("message LIKE '%found' OR message LIKE '%again'").collect()} == {"brute", "malware"}


def test_spark_ml_fits_small_models_only(spark, monkeypatch):
    """The last ten steps, two vectors each, lie on the driver, so 160,000 coefficients are too many for it."""
    frame = spark.range(4).select(F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(20_000)), lambda i: F.concat(F.lit("w"), F.col("id"), F.lit("x"), i))).alias("message"),
                                  F.concat(F.lit("class"), F.col("id") % 2).alias("threat_type"))
    monkeypatch.setattr(classify.wide, "train", lambda rows_, n, words, classes, *_: (rows_.count(), n, words, classes))
    assert classify.train_classifier(frame) == (4, 4, 80_000, ["class0", "class1"])
    assert 20 * 8 * classify.MODEL_COEFFICIENTS <= 32 << 20


def test_wide_matrix_is_compact(monkeypatch):
    """Entries of a word in many rows take some five bytes; counts beyond a byte, texts without words and batches make no difference."""
    import pyarrow as pa
    from vigilframe.operators import wide
    texts = [["common", "common", f"only{i % 7}"] for i in range(500)] + [None, [], ["common"] * 300]

    def block(size):
        table = pa.table({"row": pa.array(range(len(texts)), pa.int64()), "words": pa.array(texts, pa.list_(pa.string()))})
        return wide.block_of(len(texts), 1.0, 1)(pa.Table.from_batches(wide.pieces_of(1)(table.to_batches(max_chunksize=size))))

    def seen(cells):
        found, words = wide.Block(cells), cells.column("tokens")[0].as_py()
        return {w: (r.tolist(), v.tolist()) for w, r, v in zip(words, *(np.split(x, np.cumsum(found.sizes)[:-1]) for x in (found.rows, found.values)))}

    whole = block(1000)
    assert seen(whole) == seen(block(13)) and sum(len(whole.column(c)[0].as_py()) for c in ("rows", "tf")) <= 6 * 1001
    rows_, values = seen(whole)["common"]
    idf = math.log(504 / 502) + 1
    assert rows_ == [*range(500), 502] and values == pytest.approx([2 * idf] * 500 + [300 * idf])
    assert len(seen(whole)) == 8 and wide.PART_ROWS * 1000 <= 1 << 23  # a part's past steps fit one Arrow batch


def test_classifier_guards(spark, training):
    with pytest.raises(ValueError):
        classify.train_classifier(training.limit(1))
    with pytest.raises(ValueError):
        classify.train_classifier(training.where("threat_type = 'brute'"))


def test_report(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "a")], "threat_type string, predicted string")
    got = {r["class"]: tuple(r)[1:] for r in classify.classification_report(df).collect()}
    assert got["a"] == (0.5, 0.5, 0.5, 2) and got["c"] == (0.0, 0.0, 0.0, 1)
    assert got["accuracy"][0] == 0.5 and got["weighted avg"][1] == pytest.approx(0.5)
    assert classify.accuracy(df).first()[0] == 0.5


def test_wide_groups_have_a_task_each(spark):
    """By their hash several groups met in one task while others had none."""
    from vigilframe.operators import wide
    for number in (1, 6, 18):
        dealt = spark.createDataFrame([(c,) for c in wide.one_a_partition(spark, number)], "c int").repartition(number, "c")
        assert dealt.groupBy(F.spark_partition_id()).count().agg(F.count("*"), F.max("count")).first()[:] == (number, 1)


def test_wide_fit_takes_few_passes(spark, monkeypatch):
    """Newton's steps end near the minimum of the losses and the penalty after a few passes over the matrix."""
    from vigilframe.operators import wide
    rng, passes, advanced = np.random.default_rng(2), [], wide.advanced
    data = [(" ".join(f"w{int(j)}" for j in rng.zipf(1.3, 30) if j < 400), f"c{int(rng.integers(3))}") for _ in range(150)]
    rows_ = spark.createDataFrame([(i, m, t) for i, (m, t) in enumerate(data)], "id int, message string, threat_type string")
    monkeypatch.setattr(wide, "advanced", lambda *a: passes.append(1) or advanced(*a))
    model = classify.train_classifier(rows_, max_coefficients=0)
    table = {r["token"]: r["weights"] for r in model.weights.collect()}
    tf = {(r["id"], r["token"]): r["weight"] for r in classify.tfidf_weights(rows_, "id").collect()}
    words = sorted(table)
    x, w = np.array([[tf.get((i, t), 0.0) for t in words] for i in range(len(data))]), np.array([table[t] for t in words])
    p = np.exp(x @ w + np.array(model.intercepts))
    p /= p.sum(axis=1, keepdims=True)
    y = np.eye(3)[[model.classes.index(t) for _, t in data]]
    value = -np.log((p * y).sum(axis=1)).sum() + (w * w).sum() / 2
    left = ((x.T @ (p - y) + w) ** 2).sum() / 2 + ((p - y).sum(axis=0) ** 2).sum() / 2
    assert left <= 1e-4 * value and len(passes) <= 14
