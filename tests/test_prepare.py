from pyspark.sql import functions as F

from conftest import rows
from vigilframe.functions import text, timing
from vigilframe.functions.severity import severity_at_least
from vigilframe.operators import prepare
from vigilframe.schemas import SCHEMAS, enforce, parse_json, schema_of


def test_time_range_includes_both_ends(spark):
    df = spark.createDataFrame(
        [("2024-01-01 00:00:00",), ("2024-01-02 00:00:00",), ("2023-12-31 23:59:59.999999",), ("2024-01-02 00:00:00.000001",)],
        "t string").select(F.col("t").cast("timestamp").alias("t"))
    assert timing.time_range(df, "t", "1 DAY", "2024-01-02 00:00:00").count() == 2


def test_time_range_prunes_partitions(spark, tmp_path):
    df = spark.sql("SELECT timestamp '2024-01-01' + make_interval(0,0,0,cast(id as int)) AS t, id FROM range(10)")
    df.withColumn("dt", F.to_date("t")).write.partitionBy("dt").parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    found = timing.time_range(table, "t", "2 DAYS", "2024-01-05 00:00:00", "dt")
    assert sorted(r["id"] for r in found.collect()) == [2, 3, 4]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "dt" in plan.split("PartitionFilters:")[1].split("]")[0]


def test_metric_features_absent_parent_and_leaf(spark):
    docs = spark.createDataFrame(
        [(1, '{"host":{"name":"a"},"system":{"cpu":{"total":{"norm":{"pct":0.5}}}}}'),
         (2, '{"host":{"name":"a"},"system":{"cpu":{"total":{}}}}'),
         (3, '{"system":{"load":{"1":2.5}}}'),
         (4, '{"host":{"name":"b"}}'),
         (5, '{"host":{"name":"b"},"network":{"in":{"bytes":7}}}')], "id int, j string")
    df = docs.select("id", F.from_json("j", schema_of("metrics")).alias("m")).select("id", "m.*")
    out = {r["id"]: r for r in prepare.metric_features(df, ["id"]).collect()}
    assert out[1]["cpu_usage"] == 0.5 and out[1]["memory_usage"] is None
    assert out[2]["cpu_usage"] == 0.0
    assert out[3]["load_1m"] == 2.5 and out[3]["host"] == "unknown"
    assert out[4]["network_in_bytes"] is None
    assert (out[5]["network_in_bytes"], out[5]["network_out_bytes"]) == (7.0, 0.0)
    assert prepare.metric_features(df, ["id"], drop_featureless=True).count() == 4


def test_host_name_shapes(spark):
    df = spark.createDataFrame(
        [(1, '{"host":{"name":"a"}}'), (2, '{"host":"b"}'), (3, "{}"), (4, '{"host":{"ip":"x"}}')], "id int, j string")
    assert rows(df.select("id", prepare.host_name(F.col("j"))), "id") == [
        (1, "a"), (2, "b"), (3, "unknown"), (4, "unknown")]


def test_fill_and_document_nulls(spark):
    df = spark.createDataFrame([(None, float("nan"))], "a double, b double")
    assert rows(prepare.fill_features(df, ["a", "b"])) == [(0.0, 0.0)]
    full = spark.createDataFrame(
        [("2024-01-01", "h", float("nan"), 1.0)], "t string, host string, anomaly_score double, cpu_usage double"
    ).select(F.col("t").cast("timestamp").alias("event_ts"), "host", "anomaly_score", "cpu_usage")
    row = prepare.anomaly_documents(full).first()
    assert row["anomaly_score"] is None and row["details"]["cpu_usage"] == 1.0 and row["details"]["load_1m"] == 0.0
    assert prepare.anomaly_documents(full.drop("anomaly_score")).first()["anomaly_score"] == 0.0


def test_severity_modes(spark):
    df = spark.createDataFrame([(s,) for s in ["critical", "high", "medium", "Medium", "low", "unknown", None]], "s string")
    keep = lambda mode: sorted(r[0] for r in df.where(severity_at_least(F.col("s"), "medium", mode)).collect())
    assert keep("ordinal") == ["Medium", "critical", "high", "medium"]
    assert keep("lexical") == ["Medium", "medium", "unknown"]


def test_clean_keys(spark):
    df = spark.sql("SELECT map('', map('a', '1'), 'k', map('', '2', 'b', '')) AS m")
    assert df.select(text.clean_nested_keys(F.col("m"))).first()[0] == {"k": {"b": ""}}


def test_strip_and_template(spark):
    df = spark.createDataFrame([("\t Failed from 10.0.0.1 port 22 0xAF \n",)], "m string")
    assert df.select(text.strip_all(F.col("m"))).first()[0] == "Failed from 10.0.0.1 port 22 0xAF"
    assert df.select(text.message_template(F.col("m"))).first()[0] == "Failed from <ip> port <n> <hex>"


def test_enforce_and_quarantine(spark):
    df = spark.createDataFrame([("h", "80"), ("h", "x"), ("h", None)], "host string, port string")
    typed, bad = enforce(df, schema_of("vulnerabilities"))
    assert typed.dtypes == spark.createDataFrame([], SCHEMAS["vulnerabilities"]).dtypes
    assert typed.count() == 2 and rows(bad.select("port", "bad_columns")) == [("x", ["port"])]


def test_parse_json_quarantine(spark):
    df = spark.createDataFrame([('{"message":"m","threat_type":"t"}',), ("{broken",), (None,)], "j string")
    good, bad = parse_json(df, "j", schema_of("threat_training"))
    assert rows(good) == [("m", "t")] and bad.count() == 2


def test_default_columns_only_when_absent(spark):
    df = spark.createDataFrame([(None,)], "status string")
    assert prepare.default_columns(df, ["status", "framework"]).first().asDict() == {"status": None, "framework": "Unknown"}


def test_deduplicate_and_backfill(spark):
    df = spark.createDataFrame([("h", 1, 2), ("h", 1, 1), ("g", 1, 5)], "host string, t int, id int")
    assert rows(prepare.deduplicate(df, ["host", "t"]), "host") == [("g", 1, 5), ("h", 1, 1)]
    stamped = spark.sql("SELECT CAST(NULL AS timestamp) AS `@timestamp`, timestamp '2024-01-01' AS timestamp")
    assert timing.backfill_timestamp(stamped).first()[0] is not None
