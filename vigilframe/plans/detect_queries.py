"""Anomaly detection, tuning and classification queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigilframe.functions import stats
from vigilframe.operators import classify, detect, iforest, lof, prepare
from vigilframe.plans import views as V
from vigilframe.plans.catalog import query, rounded

FEATURES = prepare.METRIC_FEATURES


def metrics(spark, sf, drop_featureless=False):
    return prepare.metric_features(V.v_metrics(spark, sf), ["event_id"], drop_featureless)


@query("minmax_scores", """
    SELECT event_id, round(1 - (value - (SELECT min(value) FROM events)) / ((SELECT max(value) FROM events) - (SELECT min(value) FROM events)), 9) AS anomaly_score
    FROM events""")
def minmax_scores(spark, sf):
    scored = stats.inverse_min_max(V.table(spark, sf, "events"), "value", "anomaly_score")
    return rounded(scored.select("event_id", "anomaly_score"), 9)


@query("contamination_flags", """
    SELECT event_id, value FROM events WHERE value < (SELECT quantile_cont(value, 0.05) FROM events)""")
def contamination_flags(spark, sf):
    return stats.below_quantile(V.table(spark, sf, "events"), "value", 0.05).select("event_id", "value")


@query("exact_quantile", "SELECT round(quantile_cont(l_extendedprice, 0.95), 6) AS quantile FROM lineitem")
def exact_quantile(spark, sf):
    return rounded(stats.exact_quantile(V.table(spark, sf, "lineitem"), "l_extendedprice", 0.95))


@query("score_dispersion", "SELECT event_type, round(stddev_pop(value), 6) AS objective FROM events GROUP BY 1")
def score_dispersion(spark, sf):
    return rounded(stats.dispersion(V.table(spark, sf, "events"), "value", ["event_type"]))


@query("best_dispersion", """
    SELECT event_type, round(stddev_pop(value), 6) AS objective FROM events GROUP BY 1 ORDER BY stddev_pop(value) DESC, 1 LIMIT 1""")
def best_dispersion(spark, sf):
    found = stats.dispersion(V.table(spark, sf, "events"), "value", ["event_type"])
    return rounded(stats.first_best(found, "objective", "event_type"))


@query("anomaly_documents", V.with_views("v_features", f"""
    SELECT event_id, event_ts, host, 0.0::DOUBLE AS anomaly_score, 'system_metrics' AS anomaly_type, 'vigilframe' AS source,
      {', '.join(FEATURES)} FROM v_features"""))
def anomaly_documents(spark, sf):
    """Detector rows without a score column become stored rows with score 0."""
    docs = prepare.anomaly_documents(metrics(spark, sf), ["event_id"])
    return docs.select(*[c for c in docs.columns if c != "details"], "details.*")


# Brute force over all pairs of rows, for the SQL side only.
def _lof_sql(k: int, tail: str, source: str = "v_features") -> str:
    fill = ", ".join(f"coalesce({f}, 0.0) AS f{i}" for i, f in enumerate(FEATURES))
    d2 = " + ".join(f"(a.f{i}-b.f{i})*(a.f{i}-b.f{i})" for i in range(len(FEATURES)))
    return V.with_views("v_features", f"""+
    p AS MATERIALIZED (SELECT row_number() OVER (ORDER BY f0, f1, f2, f3, f4) AS r, * FROM (SELECT event_id, {fill} FROM {source})),
    nn AS MATERIALIZED (SELECT a.r AS q, min({{'d2': {d2}, 'o': b.r}}, {k}) AS nb FROM p a, p b WHERE a.r <> b.r GROUP BY a.r),
    e AS MATERIALIZED (SELECT q, n.d2 AS d2, n.o AS o FROM (SELECT q, unnest(nb) AS n FROM nn)),
    kd AS MATERIALIZED (SELECT q, sqrt(max(d2)) AS kd FROM e GROUP BY q),
    lrd AS MATERIALIZED (SELECT e.q, 1.0 / (avg(greatest(kd.kd, sqrt(e.d2))) + 1e-10) AS lrd FROM e JOIN kd ON kd.q = e.o GROUP BY e.q),
    lof AS MATERIALIZED (SELECT p.event_id, any_value(p.r) AS r, avg(l.lrd) / any_value(m.lrd) AS lof
            FROM e JOIN lrd l ON l.q = e.o JOIN lrd m ON m.q = e.q JOIN p ON p.r = e.q GROUP BY p.event_id)
    {tail}""")


@query("lof_scores", _lof_sql(20, "SELECT event_id, printf('%.6e', lof) AS lof FROM lof"))
def lof_scores(spark, sf):
    """Outlier factor of every row among all rows, exact, to seven digits."""
    scored = lof.lof_scores(metrics(spark, sf), FEATURES)
    return scored.select("event_id", F.format_string("%.6e", "lof").alias("lof"))


@query("lof_anomalies", _lof_sql(20, """SELECT event_id, printf('%.6e', lof) AS lof FROM lof
    WHERE -lof < (SELECT quantile_cont(-lof, 0.05) FROM lof)"""))
def lof_anomalies(spark, sf):
    found = lof.lof_anomalies(metrics(spark, sf), FEATURES)
    return found.select("event_id", F.format_string("%.6e", "lof").alias("lof"))


_NONEMPTY = "(SELECT * FROM v_features WHERE coalesce(" + ", ".join(FEATURES) + ") IS NOT NULL)"


def _lof_objective(k: int) -> str:
    return f"({_lof_sql(k, 'SELECT stddev_pop(lof) FROM lof', _NONEMPTY)})"


@query("lof_grid", f"""
    SELECT grid_idx, n_neighbors, leaf_size, printf('%.6e', CASE n_neighbors WHEN '5' THEN {_lof_objective(5)} ELSE {_lof_objective(10)} END) AS objective
    FROM (VALUES (0, '5', '20'), (1, '5', '30'), (2, '10', '20'), (3, '10', '30')) g(grid_idx, n_neighbors, leaf_size)""")
def lof_grid(spark, sf):
    tuned = detect.tune_lof(metrics(spark, sf, True), FEATURES)
    return tuned.select(
        "grid_idx", F.col("params")["n_neighbors"].alias("n_neighbors"), F.col("params")["leaf_size"].alias("leaf_size"),
        F.format_string("%.6e", "objective").alias("objective"))


def _number(name: str, at: int = 1) -> str:
    return f"('0x' || substr(sha256({name}), {at}, 13))::BIGINT / 4503599627370496.0"


def _path(n: str) -> str:
    return f"CASE WHEN {n} <= 1 THEN 0.0 WHEN {n} = 2 THEN 1.0 ELSE 2.0 * (ln({n} - 1.0) + 0.5772156649015329) - 2.0 * ({n} - 1.0) / {n} END"


# The forests grown level by level over all rows of all trees, for the SQL side only.
def _forest_sql(forests: str, trees: int, levels: int, source: str) -> str:
    """CTEs up to `total` (forest, psi, tree, r, path) for a table `forests` of (forest, psi, k), with `nn` in reach."""
    k = range(len(FEATURES))
    fill = ", ".join(f"coalesce({f}, 0.0) AS f{i}" for i, f in enumerate(FEATURES))
    values = "[" + ", ".join(f"f{i}" for i in k) + "]"
    parts = [f"""+
    p AS MATERIALIZED (SELECT event_id, r, {values} AS x FROM (SELECT *, row_number() OVER (ORDER BY sha256('42-' || event_id), {', '.join(f'f{i}' for i in k)}) - 1 AS r
      FROM (SELECT event_id, {fill} FROM {source}))),
    nn AS MATERIALIZED (SELECT count(*) AS n FROM p),
    forests AS MATERIALIZED ({forests}),
    named AS (SELECT *, '42-' || forest || '-' || tree || '-' AS name, ceil(log2(greatest(psi, 2))) AS deepest FROM forests, nn, (SELECT unnest(range({trees})) AS tree)),
    c AS MATERIALIZED (SELECT *, list_filter(range(least_a, least_a + 1000), lambda v: gcd(v, n) = 1)[1] AS a,
        list_sort(list_transform(list_sort(list_transform(range({len(FEATURES)}), lambda j: {{'h': sha256(name || 'f' || j), 'j': j}}))[1:k], lambda s: s.j)) AS allowed
      FROM (SELECT *, greatest(1, floor({_number("name || 'a'")} * n)::BIGINT) AS least_a, floor({_number("name || 'b'")} * n)::BIGINT AS b FROM named)),
    s0 AS MATERIALIZED (SELECT forest, tree, 1::BIGINT AS node, r, (a * r + b) % n < psi AS sampled FROM p, c)"""]
    for i in range(levels + 1):
        low, high = ("[" + ", ".join(f"{end}(x[{j + 1}]) FILTER (sampled)" for j in k) + "]" for end in ("min", "max"))
        parts.append(f"""
    t{i} AS MATERIALIZED (SELECT forest, tree, node, count(*) FILTER (sampled) AS n_sampled, {low} AS lo, {high} AS hi FROM s{i} JOIN p USING (r) GROUP BY 1, 2, 3),
    g{i} AS (SELECT t{i}.*, {_number("name || 'n' || node")} AS u, {_number("name || 'n' || node", 14)} AS v,
        CASE WHEN deepest > {i} THEN list_filter(allowed, lambda j: hi[j + 1] > lo[j + 1]) ELSE [] END AS free FROM t{i} JOIN c USING (forest, tree)),
    h{i} AS (SELECT *, free[least(floor(u * len(free))::BIGINT, len(free) - 1) + 1] + 1 AS j FROM g{i}),
    w{i} AS MATERIALIZED (SELECT forest, tree, node, n_sampled, j, CASE WHEN lo[j] + v * (hi[j] - lo[j]) < hi[j] THEN lo[j] + v * (hi[j] - lo[j]) ELSE lo[j] END AS cut FROM h{i}),
    l{i} AS (SELECT forest, tree, r, {i} + {_path("n_sampled")} AS path FROM s{i} JOIN w{i} USING (forest, tree, node) WHERE j IS NULL)""")
        if i < levels:
            parts.append(f"""
    s{i + 1} AS MATERIALIZED (SELECT forest, tree, 2 * node + (x[j] > cut)::BIGINT AS node, r, sampled FROM s{i} JOIN w{i} USING (forest, tree, node) JOIN p USING (r) WHERE j IS NOT NULL)""")
    union = " UNION ALL ".join(f"SELECT * FROM l{i}" for i in range(levels + 1))
    return ",".join(parts) + f""",
    total AS MATERIALIZED ({union})"""


_ANOMALIES = _forest_sql(f"SELECT 0 AS forest, least(256, n) AS psi, {len(FEATURES)} AS k FROM nn", 100, 8, "v_features") + f""",
    scored AS MATERIALIZED (SELECT r, -pow(2.0, -round(sum(path), 9) / 100 / greatest({_path("any_value(psi)")}, 1e-12)) AS score FROM total, forests GROUP BY r),
    flagged AS (SELECT event_id, round(1 - (score - (SELECT min(score) FROM scored)) / ((SELECT max(score) FROM scored) - (SELECT min(score) FROM scored)), 6) AS anomaly_score
      FROM scored JOIN p USING (r) WHERE score < (SELECT quantile_cont(score, 0.05) FROM scored))
    """


@query("iforest_anomalies", V.with_views("v_features", _ANOMALIES + "SELECT event_id, event_ts, host, anomaly_score FROM flagged JOIN v_features USING (event_id)"))
def iforest_anomalies(spark, sf):
    """The five percent most isolated metric rows."""
    found = iforest.iforest_anomalies(metrics(spark, sf), FEATURES, ["event_id"])
    return rounded(found.select("event_id", "event_ts", "host", "anomaly_score"))


_SHARES = {"1.0": len(FEATURES), "0.7": int(0.7 * len(FEATURES))}
_POINTS = ", ".join(
    f"({i}, {p['n_estimators']}, '{p['max_samples']}', {p['max_features']}, {_SHARES[str(p['max_features'])]}, '{p['contamination']}')"
    for i, p in enumerate(detect.grid_points(detect.IFOREST_GRID)))


@query("iforest_grid", V.with_views("v_features", _forest_sql(
    "SELECT DISTINCT psi, share, k, dense_rank() OVER (ORDER BY psi, share) - 1 AS forest FROM points", 200, 17, _NONEMPTY).replace(
    "forests AS MATERIALIZED", f"""points AS MATERIALIZED (SELECT *, greatest(1, CASE samples WHEN 'auto' THEN least(256, n) ELSE n // 2 END) AS psi
      FROM nn, (VALUES {_POINTS}) AS v(grid_idx, trees, samples, share, k, contamination)),
    forests AS MATERIALIZED""", 1) + f""",
    sums AS (SELECT forest, r, sum(path) FILTER (tree < 100) AS s100, sum(path) AS s200 FROM total GROUP BY 1, 2),
    objectives AS (SELECT forest, stddev_pop(-pow(2.0, -round(s100, 9) / 100 / greatest({_path("psi")}, 1e-12))) AS o100,
        stddev_pop(-pow(2.0, -round(s200, 9) / 200 / greatest({_path("psi")}, 1e-12))) AS o200 FROM sums JOIN forests USING (forest) GROUP BY 1)
    SELECT grid_idx, trees::VARCHAR AS n_estimators, samples AS max_samples, contamination, share::VARCHAR AS max_features, psi::INTEGER AS psi, round(CASE trees WHEN 100 THEN o100 ELSE o200 END, 6) AS objective
    FROM points JOIN forests USING (psi, share, k) JOIN objectives USING (forest)"""))
def iforest_grid(spark, sf):
    tuned = detect.tune_iforest(metrics(spark, sf, True), FEATURES, ["event_id"])
    names = ("n_estimators", "max_samples", "contamination", "max_features")
    return rounded(tuned.select("grid_idx", *[F.col("params")[n].alias(n) for n in names], "psi", "objective"))


_STORED = "'system_metrics' AS anomaly_type, 'vigilframe' AS source"


def _union_sql() -> str:
    """Both algorithms' flagged rows, each side brute force on its own."""
    lof = _lof_sql(20, "SELECT event_id FROM lof WHERE -lof < (SELECT quantile_cont(-lof, 0.05) FROM lof)")
    forest = V.with_views("v_features", _ANOMALIES + "SELECT event_id, anomaly_score FROM flagged")
    return V.with_views("v_features", f"""
    SELECT event_id, event_ts, host, algorithm, anomaly_score, {_STORED}
    FROM (SELECT event_id, 'isolation_forest' AS algorithm, anomaly_score FROM ({forest}) UNION ALL SELECT event_id, 'local_outlier_factor', 0.0 FROM ({lof})) JOIN v_features USING (event_id)""")


@query("union_anomalies", _union_sql())
def union_anomalies(spark, sf):
    """Anomalies of both algorithms as stored rows."""
    found = detect.detect_all(metrics(spark, sf), FEATURES, ["event_id"])
    return rounded(prepare.anomaly_documents(found, ["event_id", "algorithm"]).drop("details"))


# ---------------------------------------------------------------------------------- classification

_TOKENS = r"regexp_extract_all(lower(message), '[\p{L}\p{N}_]{2,}')"


@query("tfidf_weights", V.with_views("v_training", f"""+
    tf AS (SELECT doc_id, token, count(*) AS tf FROM (SELECT doc_id, unnest({_TOKENS}) AS token FROM v_training) GROUP BY 1, 2),
    n AS (SELECT count(*) AS n FROM v_training),
    idf AS (SELECT token, ln((n + 1)::DOUBLE / (count(*) + 1)) + 1 AS idf FROM tf, n GROUP BY token, n HAVING count(*) <= 0.95 * n),
    raw AS (SELECT doc_id, token, tf * idf AS raw FROM tf JOIN idf USING (token)),
    norm AS (SELECT doc_id, sqrt(sum(raw * raw)) AS norm FROM raw GROUP BY 1)
    SELECT doc_id, token, round(raw / norm, 6) AS weight FROM raw JOIN norm USING (doc_id)"""))
def tfidf_weights(spark, sf):
    return rounded(classify.tfidf_weights(V.v_training(spark, sf), "doc_id"))


@query("train_split", V.with_views("v_training", """
    SELECT doc_id, threat_type, row_number() OVER (ORDER BY ('0x' || substr(sha256(doc_id || '-42'), 1, 13))::BIGINT)
      <= ceil(0.3 * count(*) OVER ()) AS is_test FROM v_training"""))
def train_split(spark, sf):
    return classify.train_test_split(V.v_training(spark, sf), "doc_id").select("doc_id", "threat_type", "is_test")


def _rule_predicted():
    """A fixed stand-in prediction, so the report can be checked against SQL."""
    size = F.length("message")
    return F.when(size > 2000, "normal").when(size > 600, "toxic").otherwise("junk")


@query("eval_report", V.with_views("v_training", """+
    s AS (SELECT threat_type AS l, CASE WHEN length(message) > 2000 THEN 'normal' WHEN length(message) > 600 THEN 'toxic' ELSE 'junk' END AS p FROM v_training),
    c AS (SELECT class, (SELECT count(*) FROM s WHERE l = class) AS support, (SELECT count(*) FROM s WHERE p = class) AS called,
            (SELECT count(*) FROM s WHERE l = class AND p = class) AS hits
          FROM (SELECT l AS class FROM s UNION SELECT p FROM s)),
    r AS (SELECT class, support, hits, CASE WHEN called = 0 THEN 0 ELSE hits / called::DOUBLE END AS precision,
            CASE WHEN support = 0 THEN 0 ELSE hits / support::DOUBLE END AS recall FROM c),
    f AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0 ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM r)
    SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM f
    UNION ALL SELECT 'accuracy', round(sum(hits) / sum(support)::DOUBLE, 6), round(sum(hits) / sum(support)::DOUBLE, 6), round(sum(hits) / sum(support)::DOUBLE, 6), CAST(sum(support) AS BIGINT) FROM f
    UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM f
    UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
      round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM f"""))
def eval_report(spark, sf):
    return rounded(classify.classification_report(V.v_training(spark, sf).withColumn("predicted", _rule_predicted())))


@query("accuracy", V.with_views("v_training", """
    SELECT round(avg(CASE WHEN threat_type = CASE WHEN length(message) > 2000 THEN 'normal' WHEN length(message) > 600 THEN 'toxic' ELSE 'junk' END
      THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM v_training"""))
def accuracy(spark, sf):
    return rounded(classify.accuracy(V.v_training(spark, sf).withColumn("predicted", _rule_predicted())))


@query("classifier_eval")
def classifier_eval(spark, sf):
    """Train on the larger part of the split, report on the rest."""
    split = classify.train_test_split(V.v_training(spark, sf), "doc_id")
    model = classify.train_classifier(split.where("NOT is_test"))
    return rounded(classify.classification_report(classify.classify(model, split.where("is_test"))))


@query("score_messages")
def score_messages(spark, sf):
    """Score every conversation turn with a model trained on the labelled documents."""
    model = classify.train_classifier(V.v_training(spark, sf))
    turns = V.table(spark, sf, "conversations")
    return classify.classify(model, turns, "text").select("conv_id", "turn", "predicted")
