import datetime as dt
import json

import pytest

from pyspark.sql import functions as F

from conftest import rows
from vigilframe.sources import indices, parsers, readers, sinks
from vigilframe.streaming import drops, runs


def test_ingest_lines(spark, tmp_path):
    auth, other = tmp_path / "auth.log", tmp_path / "x.log"
    auth.write_bytes(b"\tFailed password \n\n  sudo\n")
    other.write_text("one\n")
    got = readers.ingest_lines(spark, {str(auth): "auth", str(tmp_path / "gone.log"): "syslog"}, "2024-01-01", "me")
    assert sorted((r["message"], r["log_type"], r["host"]) for r in got.collect()) == [
        ("", "auth", "me"), ("Failed password", "auth", "me"), ("sudo", "auth", "me")]
    assert got.first()["source"] == str(auth) and got.first()["event_ts"] == dt.datetime(2024, 1, 1)
    assert readers.ingest_lines(spark, {str(tmp_path / "gone.log"): "syslog"}, "2024-01-01").count() == 0


def test_ingest_paths_and_bytes(spark, tmp_path):
    """Blanks, per cent signs, brackets, patterns and URIs in paths; bytes that are not UTF-8; both kinds of line ends."""
    odd = tmp_path / "in dir" / "a%20b [1].log"
    odd.parent.mkdir()
    odd.write_bytes(b"a\xff\xfeb\xe2\x82 c\r\n\xef\xbf\xbd kept \x01\xc3\n\xc3\xa9 x\n\xed\xa0\x80")
    for name in ("p1.txt", "p2.txt", "q.txt"):
        (tmp_path / "in dir" / name).write_text(name)
    (tmp_path / "in dir" / "p.txt").mkdir()  # a folder is no file
    types = {str(tmp_path / "in dir" / "p*.txt"): "many", "file://" + str(tmp_path / "in dir" / "q.txt").replace(" ", "%20"): "uri",
             str(tmp_path / "in dir" / "q.txt"): "twice", str(tmp_path / "in dir" / "none*"): "none"}
    types = {k.replace("%20", " "): v for k, v in types.items()}
    folder = str(tmp_path / "in dir")
    got = {(r["message"], r["log_type"], r["source"]) for r in readers.ingest_lines(spark, types, "2024-01-01").collect()}
    assert got == {("p1.txt", "many", folder + "/p1.txt"), ("p2.txt", "many", folder + "/p2.txt"),
                   ("q.txt", "uri", "file://" + folder + "/q.txt"), ("q.txt", "twice", folder + "/q.txt")}
    pattern = folder + "/a*log"
    lines = readers.ingest_lines(spark, {pattern: "t"}, "2024-01-01").collect()
    expected = [x.strip() for x in odd.read_bytes().decode(errors="ignore").replace("\r\n", "\n").split("\n")]
    assert sorted(r["message"] for r in lines) == sorted(expected) and "\ufffd kept \x01" in expected
    assert {r["source"] for r in lines} == {str(odd)}


def test_ingest_hosts(spark, tmp_path):
    for host in ("a", "b"):
        folder = tmp_path / f"host={host}"
        folder.mkdir()
        (folder / "syslog").write_text("m\n")
    got = readers.ingest_host_lines(spark, str(tmp_path), {"syslog": "syslog"}, "2024-01-01")
    assert rows(got.select("host", "log_type"), "host") == [("a", "syslog"), ("b", "syslog")]


def test_daily_sink_beats_and_retention(spark, tmp_path):
    df = spark.sql("SELECT timestamp '2024-01-01' + make_interval(0,0,0,cast(id as int)) AS event_ts, id FROM range(5)")
    root = str(tmp_path / "t")
    sinks.append_daily(df, root, beat="filebeat")
    sinks.append_daily(df, root, beat="metricbeat")
    sinks.append_daily(df.where("id < 2"), root, beat="filebeat")
    assert readers.read_beat(spark, root, "filebeat").count() == 7
    assert "PartitionFilters: [isnotnull(beat" in readers.read_beat(spark, root, "filebeat")._jdf.queryExecution().executedPlan().toString()
    sinks.apply_retention(df, str(tmp_path / "kept"), "2024-01-04", 2)
    assert spark.read.parquet(str(tmp_path / "kept")).count() == 4


def test_expired_days_go_in_place(spark, tmp_path):
    """Whole days go, the limit's own day loses its early rows, later days keep their files; with and without beats."""
    df = spark.sql("SELECT timestamp '2024-01-01 10:00:00' + make_interval(0,0,0,0,12*cast(id as int)) AS event_ts, id FROM range(9)")
    for beat in (None, "filebeat"):
        root = str(tmp_path / f"t{beat}")
        sinks.append_daily(df, root, beat=beat)
        before = {f for f in spark.read.parquet(root).inputFiles() if "dt=2024-01-04" in f}
        sinks.drop_expired(spark, root, "2024-01-05 12:00:00", 2)
        kept = spark.read.parquet(root)
        assert rows(kept.select("id"), "id") == [(i,) for i in (5, 6, 7, 8)]
        assert before and before <= set(kept.inputFiles())
        sinks.drop_expired(spark, root, "2024-01-05 12:00:00", 2)
        assert spark.read.parquet(root).count() == 4


def test_indicator_files(spark, tmp_path):
    keyed, listed = tmp_path / "k.json", tmp_path / "l.json"
    keyed.write_text(json.dumps({"ip": [{"indicator": "1", "threat_level": "high"}], "hash": [], "url": [{"indicator": "u"}]}, indent=1))
    listed.write_text(json.dumps([{"type": "ip", "indicator": "1"}, {"type": "mail", "indicator": "m"}], indent=1))
    got = readers.load_indicators(spark, [str(keyed), str(tmp_path / "none.json")], [str(listed)])
    assert sorted((r["type"], r["indicator"]) for r in got.collect()) == [("ip", "1"), ("ip", "1"), ("url", "u")]
    sinks.save_by_type(got, str(tmp_path / "out"))
    assert sorted(p.name for p in (tmp_path / "out").glob("type=*")) == ["type=ip", "type=url"]


def test_assets_training_and_scans(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"10.0.0.1": {"name": "n", "criticality": "high"}, "default": {"criticality": "low"}}))
    assert rows(readers.load_assets(spark, str(tmp_path / "a.json")).select("asset", "criticality"), "asset") == [
        ("10.0.0.1", "high"), ("default", "low")]
    (tmp_path / "t.json").write_text(json.dumps([{"message": "m", "threat_type": "t"}]))
    with pytest.raises(ValueError):
        readers.load_training(spark, str(tmp_path / "t.json"))
    (tmp_path / "s.csv").write_text("name,host,port,threat,description\nn,h,22,High,d\n")
    assert rows(readers.read_scan_report(spark, str(tmp_path / "s.csv"))) == [("n", "h", 22, "High", "d")]


def test_syslog_variants(spark):
    df = spark.createDataFrame([
        ("Jun  1 10:00:00 h sshd[12]: Failed: x",), ("May 23 11:42:27 h kernel: up",), ("garbage",)], "line string")
    got = [tuple(r)[1:] for r in parsers.parse_syslog(df, "line", 2025).collect()]
    assert got == [(dt.datetime(2025, 6, 1, 10), "h", "sshd", 12, "Failed: x"),
                   (dt.datetime(2025, 5, 23, 11, 42, 27), "h", "kernel", None, "up"), (None,) * 5]


def test_access_variants(spark):
    df = spark.createDataFrame([
        ('1.2.3.4 - bob [10/Oct/2000:13:55:36 -0700] "GET /a HTTP/1.0" 200 23 "http://r" "M 4"',),
        ('1.2.3.4 - - [10/Oct/2000:13:55:36 +0000] "-" 408 - "-" "-"',), ("x",)], "line string")
    got = [r.asDict() for r in parsers.parse_access(df, "line").drop("line").collect()]
    assert got[0]["event_ts"] == dt.datetime(2000, 10, 10, 20, 55, 36) and got[0]["bytes"] == 23
    assert got[0]["verb"] == "GET" and got[0]["auth"] == "bob" and got[0]["agent"] == "M 4"
    assert got[1]["status"] == 408 and got[1]["verb"] is None and got[1]["bytes"] is None
    assert set(got[2].values()) == {None}


def test_drop_folder_takes_each_file_once(spark, tmp_path):
    folder, out, state = tmp_path / "in", tmp_path / "out", tmp_path / "state"
    folder.mkdir()
    schema = spark.createDataFrame([], "host string, anomaly_score double").schema

    def take():
        stream = runs.drop_folder_stream(spark, str(folder), schema)
        return runs.run_once(stream, spark, "t", str(out), str(state)).count()

    (folder / "a.json").write_text(json.dumps([{"host": "h", "anomaly_score": 0.5}, {"host": "g"}], indent=1))
    assert take() == 2
    assert take() == 2
    (folder / "b.json").write_text(json.dumps([{"host": "z"}]))
    assert take() == 3


def test_batch_sink_is_idempotent(spark, tmp_path):
    write = sinks.append_batch(str(tmp_path))
    df = spark.sql("SELECT timestamp '2024-01-01' AS event_ts")
    write(df, 0)
    write(df, 0)
    assert spark.read.parquet(str(tmp_path)).count() == 1


def test_document_sink(spark, tmp_path):
    sinks.save_document(spark.sql("SELECT map('a', 1) AS m"), str(tmp_path / "d"))
    assert spark.read.schema("m map<string,int>").json(str(tmp_path / "d")).first()["m"] == {"a": 1}


def test_index_patterns(spark, tmp_path):
    """Patterns over beats and days read only the matching folders and merge the columns of different beats."""
    root = str(tmp_path / "t")
    days = spark.sql("SELECT timestamp '2024-01-30' + make_interval(0,0,0,cast(id as int)) AS event_ts, id FROM range(5)")
    sinks.append_daily(days.withColumn("a", F.lit("x")), root, beat="filebeat")
    sinks.append_daily(days.withColumn("b", F.lit(1)), root, beat="metricbeat")

    def ids(pattern):
        return sorted((r["index_name"], r["id"]) for r in indices.read_indices(spark, root, pattern).collect())

    assert ids("filebeat-*") == [(f"filebeat-2024.{d}", i) for i, d in enumerate(("01.30", "01.31", "02.01", "02.02", "02.03"))]
    assert ids("*beat-2024.02.01") == [("filebeat-2024.02.01", 2), ("metricbeat-2024.02.01", 2)]
    assert ids("*-2024.02.*, -metric*, -*.03") == [("filebeat-2024.02.01", 2), ("filebeat-2024.02.02", 3)]
    assert ids("none-*") == [] and ids("filebeat-2024.01.31") == [("filebeat-2024.01.31", 1)]
    both = indices.read_indices(spark, root, "*-2024.01.30")
    assert {"a", "b"} <= set(both.columns) and both.where("a IS NULL AND b = 1").count() == 1
    files = indices.read_indices(spark, root, "filebeat-2024.01.31").inputFiles()
    assert len(files) == 1 and "beat=filebeat/dt=2024-01-31" in files[0]
    with pytest.raises(FileNotFoundError):
        indices.read_indices(spark, str(tmp_path / "nothing"), "*")


def test_drop_folder_routes_archives_and_sets_aside(spark, tmp_path):
    folder, root, archive = tmp_path / "in", str(tmp_path / "root"), str(tmp_path / "old")
    folder.mkdir()
    shapes = {
        "anomalies": drops.Dataset("anomalies*.json", spark.createDataFrame([], "host string, anomaly_score double").schema, ("host",)),
        "vulnerabilities": drops.Dataset("vulnerabilities*.json", spark.createDataFrame([], "host string, port int").schema),
        "compliance_issues": drops.Dataset("compliance_issues*.json", spark.createDataFrame([], "check string").schema)}

    def run():
        tables = drops.take_up(spark, str(folder), shapes, root, archive)
        return {k: sorted(map(str, (tuple(r) for r in t.collect()))) for k, t in tables.items()}

    assert run() == {"anomalies": [], "vulnerabilities": [], "compliance_issues": []}
    (folder / "anomalies.json").write_text(json.dumps([{"host": "h", "anomaly_score": 0.5}, {"anomaly_score": 1}, {"host": "g", "anomaly_score": "much"}], indent=1))
    (folder / "vulnerabilities.1.json").write_text(json.dumps([{"host": "v", "port": 22, "extra": 1}]))
    (folder / "anomalies.broken.json").write_text('[{"host": "cut off"')
    (folder / "anomalies.empty.json").write_text("")
    first = run()
    assert first["anomalies"] == ["('h', 0.5)"] and first["vulnerabilities"] == ["('v', 22)"]
    held = sorted(r["row"] for r in drops.quarantined(spark, root, "anomalies").collect())
    assert len(held) == 3 and '{"anomaly_score":1.0}' in held and any("cut off" in h for h in held) and any("much" in h for h in held)
    assert run() == first
    (folder / "anomalies.2.json").write_text(json.dumps([{"host": "z"}]))
    (folder / "compliance_issues.json").write_text(json.dumps([{"check": "c"}]))
    second = run()
    assert second["anomalies"] == ["('h', 0.5)", "('z', None)"] and second["compliance_issues"] == ["('c',)"]
    assert run() == second
    moved = sorted(p.name for p in (tmp_path / "old").rglob("*.json"))
    assert "anomalies.json" in moved and not (folder / "anomalies.json").exists()
