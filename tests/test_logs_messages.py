import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from vigilframe.operators import alerts, detections, intel, logs, messages, panels

LOG = "event_id int, event_ts string, message string, source string, host string"


def frame(spark, data, schema):
    df = spark.createDataFrame(data, schema)
    return df.withColumn("event_ts", F.col("event_ts").cast("timestamp"))


@pytest.fixture
def lines(spark):
    return frame(spark, [
        (1, "2024-01-01 00:10:00", "sudo: Failed password for root", "/var/log/auth.log", "h"),
        (2, "2024-01-01 00:20:00", "failed password for root", None, "h"),
        (3, "2024-01-01 01:20:00", None, "/var/log/syslog", "h"),
    ], LOG)


def test_patterns(lines):
    assert sorted(r["pattern"] for r in logs.tag_patterns(lines).collect()) == ["ssh_login_failure", "sudo_command"]
    assert dict(rows(logs.pattern_counts(lines.where("event_id > 1")))) == {"ssh_login_failure": 0, "sudo_command": 0}
    assert [r["event_id"] for r in logs.auth_logs(lines).collect()] == [1]


def test_document_and_clusters(lines):
    doc = logs.log_document(lines, "2024-01-02").first()
    assert doc["num_clusters"] == 3 and doc["cluster_keys"] == ["cluster_0", "cluster_1", "cluster_2"]
    assert doc["freq_anomalies"] == [] and doc["auth_logs_count"] == 1
    assert doc["pattern_matches"] == {"ssh_login_failure": 1, "sudo_command": 1}
    assert rows(logs.round_robin_clusters(lines), "cluster") == [("cluster_0", 1), ("cluster_1", 1), ("cluster_2", 1)]
    assert dict(rows(logs.round_robin_clusters(lines.sparkSession.range(23).withColumn("event_ts", F.lit(None))))) == {
        f"cluster_{i}": 3 if i < 3 else 2 for i in range(10)}


def test_running_counts(spark):
    df = spark.createDataFrame([("a",)] * 227 + [("b",)] * 6246, "source string")
    assert rows(logs.running_counts(df), "source") == [("a", 227, 227), ("b", 6246, 6473)]


def test_rate_spike(spark):
    df = spark.sql(
        "SELECT timestamp '2024-01-01' + make_interval(0,0,0,0,h) AS event_ts, 'h' AS host FROM "
        "(SELECT cast(id as int) h FROM range(30)) LATERAL VIEW explode(sequence(1, if(h = 28, 90, 5 + h % 2))) AS n")
    found = logs.log_rate_anomalies(df).collect()
    assert [r["bucket"].hour for r in found] == [4] and found[0]["n"] == 90


def test_rate_counts_absent_hours(spark):
    """Hours long ago do not judge a later one, and empty hours lower the mean."""
    busy = "SELECT timestamp '2024-01-01' + make_interval(0,0,0,0,cast(id as int)) AS event_ts, 'h' AS host FROM range(30)"
    lone = "SELECT timestamp '2024-01-20' + make_interval(0,0,0,0,cast(id div 9 as int)) AS event_ts, 'h' AS host FROM range(18)"
    found = logs.log_rate_anomalies(spark.sql(f"{busy} UNION ALL {lone}")).collect()
    assert [(r["bucket"].day, r["bucket"].hour) for r in found] == [(20, 1)]  # the first of them has a flat past
    assert found[0]["mean"] == 9 / 24 and found[0]["dev"] == pytest.approx(9 / 24**0.5)


MSG = "event_id int, event_ts string, type string, worker_id string, worker_type string, host string, data string"


@pytest.fixture
def feed(spark):
    return frame(spark, [
        (1, "2024-01-01 00:00:00", "heartbeat", "w", None, None, None),
        (2, "2024-01-01 00:00:01", "send_data", "w", None, None, "{}"),
        (3, "2024-01-01 00:00:10", "register", "w", "scanner", None, None),
        (4, "2024-01-01 00:00:20", "register", "w", "collector", "h2", None),
        (5, "2024-01-01 00:01:00", "heartbeat", "w", None, None, None),
        (6, "2024-01-01 00:05:00", "send_data", "w", None, None, "{}"),
        (7, "2024-01-01 00:00:30", "register", "v", None, None, None),
        (8, "2024-01-01 00:00:30", None, "v", None, None, None),
        (9, "2024-01-01 00:00:30", "reboot", "v", None, None, None),
        (10, "2024-01-01 00:06:00", "send_data", "w", None, None, None),
    ], MSG)


def test_replies(feed):
    out = {r["event_id"]: (r["status"], r["message"]) for r in messages.replies(feed).collect()}
    assert out[1] == ("error", "Worker w not registered") and out[2] == ("error", "Worker w not registered")
    assert out[3] == ("success", "Worker w registered successfully")
    assert out[5] == ("success", "Heartbeat received from w") and out[6] == ("success", "Data received from w")
    assert out[7] == ("error", "Missing worker_id or worker_type")
    assert out[8] == ("error", "Invalid message format") and out[9] == ("error", "Unknown message type: reboot")
    assert out[10] == ("error", "Missing worker_id or data")
    assert [r["event_id"] for r in messages.accepted_data(feed).collect()] == [6]


def test_status_edges(feed):
    status = lambda at: rows(messages.worker_status(feed, at).select("id", "type", "host", "status"))
    assert status("2024-01-01 00:02:00") == [("w", "collector", "h2", "online")]  # exactly 60 s
    assert status("2024-01-01 00:02:00.001") == [("w", "collector", "h2", "offline")]
    assert status("2024-01-01 00:05:30")[0][3] == "offline"  # data does not refresh
    assert status("2024-01-01 00:00:15")[0][1] == "scanner"


def test_sessions(spark):
    beats = frame(spark, [(i, f"2024-01-01 00:0{m}:{s:06.3f}", "heartbeat", "w", None, None, None) for i, (m, s) in enumerate(
        [(0, 0.0), (1, 0.0), (2, 0.001), (2, 30.0)])], MSG)
    found = rows(messages.uptime_sessions(beats, 60).select("started", "ended", "signals"), "started")
    at = lambda m, s, us=0: dt.datetime(2024, 1, 1, 0, m, s, us)
    assert found == [(at(0, 0), at(1, 0), 2), (at(2, 0, 1000), at(2, 30), 2)]


def test_unpack(spark):
    df = spark.createDataFrame(
        [('{"type":"logs","logs":[{"@timestamp":"2024-01-01T00:00:00","message":"a"},{"message":"b"}]}',), ('{"type":"x"}',)], "data string")
    assert [r["message"] for r in messages.unpack_batches(df).collect()] == ["a", "b"]


def test_indicators(spark):
    indicators = spark.createDataFrame(
        [("ip", "1.1.1.1", "low", "x"), ("ip", "1.1.1.1", "critical", "y"), ("domain", "d", "high", "z"), ("mail", "m", "low", "q"), ("url", "1.1.1.2", "low", "u")],
        "type string, indicator string, threat_level string, description string")
    known = intel.union_feeds(indicators)
    assert dict(rows(intel.indicator_counts(known))) == {"ip": 2, "domain": 1, "url": 1, "hash": 0}
    beat = spark.createDataFrame(
        [(1, "1.1.1.1", "d"), (2, "1.1.1.2", None), (3, None, "D"), (4, None, "d")], "id int, ip string, domain string")
    assert [r["id"] for r in intel.correlate(beat, known, "id").orderBy("id").collect()] == [1, 4]
    assert intel.correlation_count(beat, known, "id").first()[0] == 2
    assert [r["id"] for r in intel.clean_logs(beat, known, "id").orderBy("id").collect()] == [2, 3]
    hit = intel.enrich(beat, known, "id").where("type = 'ip'").collect()
    assert [(r["id"], r["threat_level"], r["description"], r["entries"]) for r in hit] == [(1, "critical", "y", 2)]
    assert intel.indicator_hits(beat, known, "id").where("value = 'd'").first()["hits"] == 2


def test_level_and_description_of_one_entry(spark):
    """Entries (high, b) and (low, a) give (high, b), a pair that a feed holds; NULL texts come last, unknown levels too."""
    entries = [("ip", "1", "high", "b"), ("ip", "1", "low", "a"), ("ip", "2", "critical", None), ("ip", "2", "critical", "z"), ("ip", "3", None, "n"),
               ("ip", "3", "weird", "m"), ("ip", "4", "low", None)]
    known = spark.createDataFrame(entries, "type string, indicator string, threat_level string, description string")
    got = {r["value"]: (r["threat_level"], r["description"], r["entries"]) for r in intel.listed(known).collect()}
    assert got == {"1": ("high", "b", 2), "2": ("critical", "z", 2), "3": ("weird", "m", 2), "4": ("low", None, 1)}


def test_rows_with_many_addresses(spark):
    """Every address of a row counts, each once; rows without any stay clean."""
    known = spark.createDataFrame([("ip", "9.9.9.9", "low", "x"), ("ip", "1.1.1.1", "high", "y")], "type string, indicator string, threat_level string, description string")
    beat = spark.createDataFrame([(1, ["8.8.8.8", "9.9.9.9", "9.9.9.9"]), (2, []), (3, None), (4, ["1.1.1.1", None, "9.9.9.9"])], "id int, ip array<string>")
    assert [r["id"] for r in intel.correlate(beat, known, "id").orderBy("id").collect()] == [1, 4]
    assert intel.enrich(beat, known, "id").count() == 3
    assert {r["value"]: r["hits"] for r in intel.indicator_hits(beat, known, "id").collect()} == {"9.9.9.9": 2, "1.1.1.1": 1}
    assert [r["id"] for r in intel.clean_logs(beat, known, "id").orderBy("id").collect()] == [2, 3]


def test_correlate_never_loops(spark):
    indicators = spark.createDataFrame([("ip", "a", "low", "")], "type string, indicator string, threat_level string, description string")
    beat = spark.createDataFrame([(1, "a", "b")], "id int, ip string, domain string")
    plan = intel.correlate(beat, indicators, "id")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_alerts(spark):
    found = frame(spark, [(i, f"2024-01-01 00:0{i}:00", "h", i / 10) for i in range(7)] + [(9, "2024-01-02 00:00:00", "g", 1.0)],
                  "event_id int, event_ts string, host string, anomaly_score double")
    alert = alerts.anomaly_alerts(found, ["event_ts", "event_id"]).collect()
    assert len(alert) == 1 and alert[0]["subject"] == "ALERT: 7 security anomalies detected"
    assert alert[0]["body"].count("Host: h") == 5 and "Score: 0.40" in alert[0]["body"]
    assert alert[0]["body"].count("\n   Details: {}\n") == 5
    detailed = found.withColumn("details", F.struct(F.col("event_id").alias("cpu_usage")))
    assert '\n   Details: {"cpu_usage":3}\n' in alerts.anomaly_alerts(detailed, ["event_ts", "event_id"]).first()["body"]
    vulns = frame(spark, [(1, "2024-01-01 00:00:00", "h", None, None, "low", "d")],
                  "id int, event_ts string, host string, port int, service string, severity string, description string")
    assert alerts.vulnerability_alerts(vulns, ["id"]).count() == 0
    body = alerts.vulnerability_alerts(vulns, ["id"], severity="low").first()["body"]
    assert "Service: unknown on port unknown" in body


def test_group_limit_below_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), "id")
    plan = alerts.first_rows(df, ["g"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_detections(spark):
    df = frame(spark, [(i, f"2024-01-01 00:00:{i:02d}", "Invalid user x from 10.0.0.1 port 1", "s", "h") for i in range(12)], LOG)
    hit = detections.brute_force(df).first()
    assert (hit["peer"], hit["failures"]) == ("10.0.0.1", 12) and detections.sudo_bursts(df).count() == 0
    assert detections.silent_sources(df, "2024-01-01 01:00:11").count() == 0
    assert detections.silent_sources(df, "2024-01-01 01:00:12").count() == 1
    scans = df.select("host", "event_ts", (F.col("event_id") % 4).alias("port"), F.col("event_id").cast("string").alias("service"))
    assert detections.scan_bursts(scans, threshold=4).first()["ports"] == 4
    assert panels.open_services(scans).first()["share"] == 1.0


def test_rule_tables_equal_contains(spark, monkeypatch):
    """Every rule by one automaton, in one part or many, as `contains` rule by rule."""
    from vigilframe.operators import rule_tables

    texts = ["", None, "aab abba", "Failed password for root", "x.y", "ünï ☃ code", "aaaa", "b"]
    table = [("r1", "ab"), ("r1", "bb"), ("r2", "a"), ("r2", "a"), ("r3", ""), ("r4", "☃ c"), ("r5", "."), (None, "a"), ("r6", None), ("r7", "zzz"), ("r8", "Failed"), ("r9", "aa"), ("r9", "aaa")]
    rules = spark.createDataFrame(table, "rule string, needle string")
    logs_ = spark.createDataFrame(list(enumerate(texts)), "id int, message string")
    expected = {(i, r) for i, t in enumerate(texts) for r, n in table if r and n is not None and n in (t or "")}
    for size in (200_000, 3):
        monkeypatch.setattr(rule_tables, "PART_NEEDLES", size)
        hits = [(x["id"], x["rule"]) for x in rule_tables.rule_hits(logs_, rules).collect()]
        assert len(hits) == len(set(hits)) and set(hits) == expected
        counts = {x["rule"]: x["matches"] for x in rule_tables.rule_counts(logs_, rules).collect()}
        assert counts == {r: sum(1 for _, q in expected if q == r) for r, _ in table if r}
    assert rule_tables.tag_rules(logs_, rules.limit(0)).where("size(rules) > 0").count() == 0
    assert rule_tables.rule_hits(logs_.limit(0), rules).count() == 0


def test_rule_tables_share_needles(spark, monkeypatch):
    """Needles of many rules, rules of many needles and of several common ones: Python gives keys, never their rules."""
    from vigilframe.operators import rule_tables

    monkeypatch.setattr(rule_tables, "HEAVY", 4)
    monkeypatch.setattr(rule_tables, "WIDE", 3)
    table = [(f"c{i}", n) for i in range(9) for n in ("port", f"u{i}")] + [(f"d{i}", n) for i in range(6) for n in ("port", "ssh")]
    table += [("w", f"u{i}") for i in range(9)] + [("e", ""), ("s", "ssh"), ("s", "u1"), ("p", "port")]
    texts = ["u1 port", "u1 port", "port", "ssh", "u2 ssh port u3", "u1 u2", "", None, "u8 ssh"]
    rules = spark.createDataFrame(table, "rule string, needle string")
    logs_ = spark.createDataFrame(list(enumerate(texts)), "id int, message string")
    expected = sorted((i, r) for i, t in enumerate(texts) for r in {r for r, n in table if n in (t or "")})
    for size in (200_000, 4):
        monkeypatch.setattr(rule_tables, "PART_NEEDLES", size)
        assert sorted((x["id"], x["rule"]) for x in rule_tables.rule_hits(logs_, rules).collect()) == expected
        counts = {x["rule"]: x["matches"] for x in rule_tables.rule_counts(logs_, rules).collect()}
        assert counts == {r: sum(q == r for _, q in expected) for r, _ in table}
        tagged = {x["id"]: x["rules"] for x in rule_tables.tag_rules(logs_, rules).collect()}
        assert tagged == {i: sorted(r for j, r in expected if j == i) for i in range(len(texts))}
    keys = rule_tables.with_keys(logs_, rule_tables.keyed_rules(rules), "message", "k").where("id = 0").first()["k"]
    assert set(keys) >= {"hport"} and not any(k.startswith("rc") or k == "rp" for k in keys)


def test_status_listings_equal_brute_force(spark):
    """Requests and signals at random instants, many of them equal, over several buckets."""
    import random

    rng, data = random.Random(3), []
    for i in range(400):
        second = rng.choice([rng.randrange(300), rng.randrange(20_000)])
        kind = rng.choices(["register", "heartbeat", "get_status", "send_data", "reboot"], [2, 6, 1, 1, 1])[0]
        worker = None if kind == "get_status" else f"w{rng.randrange(12)}"
        data.append((i, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=second), kind, worker, f"t{i}" if kind == "register" and i % 5 else None,
                     rng.choice([None, "h1", "h2"]), "{}"))
    table = spark.createDataFrame(data, "event_id int, event_ts timestamp, type string, worker_id string, worker_type string, host string, data string")
    expected = []
    for i, at, kind, *_ in data:
        if kind != "get_status":
            continue
        seen = [r for r in data if r[1] <= at and r[3]]
        for w in sorted({r[3] for r in seen}):
            joins = [(r[1], r[4], r[5] or "unknown") for r in seen if r[3] == w and r[2] == "register" and r[4]]
            if joins:
                last = max(r[1] for r in seen if r[3] == w and (r[2] == "heartbeat" or (r[2] == "register" and r[4])))
                _, name, host = max(joins)
                expected.append((i, at, w, name, host, last, "offline" if (at - last).total_seconds() > 60 else "online"))
    assert len({x[-1] for x in expected}) == 2
    for bucket in (60, 3600):
        found = messages.status_listings(table, bucket_seconds=bucket)
        assert sorted(tuple(r) for r in found.collect()) == sorted(expected)
    assert messages.status_listings(table.where("type <> 'get_status'")).count() == 0
    assert messages.status_listings(table.where("type = 'get_status'")).count() == 0


def test_status_listings_deal_out_the_answers(spark, monkeypatch):
    """A state is written out for its requests in pieces, in tasks whose number does not follow the bytes of the states."""
    data = [(0, 0, "register", "w0", "x"), (1, 0, "register", "w1", "x"), (2, 30, "heartbeat", "w1", None)]
    data += [(10 + i, i, "get_status", None, None) for i in range(50)]
    table = spark.createDataFrame(data, "event_id int, s long, type string, worker_id string, worker_type string").select(
        "*", F.timestamp_seconds("s").alias("event_ts"), F.lit("h").alias("host"), F.lit("{}").alias("data"))
    whole = sorted(tuple(r) for r in messages.status_listings(table).collect())
    monkeypatch.setattr(messages, "LISTED", 7, raising=False)
    found = messages.status_listings(table)
    assert sorted(tuple(r) for r in found.collect()) == whole and len(whole) == 100
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "REPARTITION_BY_NUM" in plan[plan.index("Generate explode(sequence(slot"):]


def test_status_listings_shuffle_no_answer(spark, monkeypatch):
    """However many the requests, a state meets them before it is written out: no exchange or join of answers."""
    data = [(i, i, "register", f"w{i}", "x") for i in range(5)] + [(10 + i, 3 + 2 * i, "get_status", None, None) for i in range(30)]
    table = spark.createDataFrame(data, "event_id int, s long, type string, worker_id string, worker_type string").select(
        "*", F.timestamp_seconds("s").alias("event_ts"), F.lit("h").alias("host"), F.lit("{}").alias("data"))
    whole = sorted(tuple(r) for r in messages.status_listings(table).collect())
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for listed in (1024, 7):
            monkeypatch.setattr(messages, "LISTED", listed)
            found = messages.status_listings(table)
            assert sorted(tuple(r) for r in found.collect()) == whole and len(whole) > 100
            plan = found._jdf.queryExecution().sparkPlan().toString()
            above = plan[:plan.index("Generate explode(sequence(slot")]
            assert "Join" not in above and "Exchange" not in above
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_rule_table_rows_travel_without_needless_keys(spark, monkeypatch):
    """A message's keys go with a row only where another of them may count for the same rule."""
    from vigilframe.operators import rule_tables

    monkeypatch.setattr(rule_tables, "HEAVY", 4)
    table = [(f"c{i}", n) for i in range(9) for n in ("port", f"u{i}")] + [("two", "ssh"), ("two", "sudo"), ("one", "u1")]
    rules = spark.createDataFrame(table, "rule string, needle string")
    texts = ["u1 port", "u1 ssh sudo port", "sudo", "port u8", None]
    logs_ = spark.createDataFrame(list(enumerate(texts)), "id int, message string")
    keyed = rule_tables.keyed_rules(rules)
    kinds = {x["needle"]: x["kind"] for x in keyed.collect()}
    assert kinds["port"] == "h" and kinds["ssh"] == kinds["sudo"] == "m" and kinds["u1"] == "n"
    found = rule_tables.with_keys(logs_, keyed, "message", "_keys").where("size(_keys) > 0")
    hits = sorted((x["id"], x["rule"]) for x in rule_tables._matches(found, rule_tables.rule_keys(keyed), ["id"]).collect())
    assert hits == sorted((i, r) for i, t in enumerate(texts) for r in {r for r, n in table if n in (t or "")})
    plan = rule_tables._matches(found, rule_tables.rule_keys(keyed), ["id"])._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN (StartsWith(_key" in plan and "StartsWith(_key" in plan[plan.index("RepartitionByExpression"):]  # dropped before rows are dealt
