import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from vigilframe.operators import messages
from vigilframe.streaming import cycles, registry, runs, windows

SCHEMA = "event_id int, event_ts timestamp, type string, worker_id string, worker_type string, host string, data string"


class Feed:
    """A folder of message files, one file per delivery."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.sent = spark, str(folder / "in"), 0
        self.all = []

    def send(self, *entries):
        data = []
        for kind, worker, second in entries:
            self.sent += 1
            at = dt.datetime(2024, 1, 1) + dt.timedelta(seconds=second)
            data.append((self.sent, at, kind, worker, "scanner" if kind == "register" else None, "h", "{}"))
        self.all += data
        self.spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(self.folder)

    def stream(self):
        return self.spark.readStream.schema(SCHEMA).parquet(self.folder)

    def table(self):
        return self.spark.createDataFrame(self.all, SCHEMA)


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def test_registry_timer_and_revival(spark, feed, tmp_path):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")

    def step():
        changes = registry.worker_status_changes(feed.stream(), 60)
        df = runs.run_once(changes, spark, "r", out, state)
        return rows(df.select("worker_id", F.unix_timestamp("last_heartbeat") - 1704067200, "status"), "worker_id", "last_heartbeat", "status")

    feed.send(("heartbeat", "a", 0), ("register", "a", 10), ("heartbeat", "b", 5), ("register", "c", 10), ("send_data", "c", 50))
    assert step() == [("a", 10, "online"), ("c", 10, "online")]
    feed.send(("heartbeat", "c", 70))  # exactly 60 s: a stays online
    assert step()[-1] == ("c", 70, "online") and ("a", 10, "offline") not in step()
    feed.send(("heartbeat", "c", 71))
    assert ("a", 10, "offline") in step()
    feed.send(("heartbeat", "a", 80))
    final = step()
    assert ("a", 80, "online") in final and not any(r[0] == "b" for r in final)


def gate_step(spark, feed, tmp_path, delay="0 seconds"):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    return runs.run_once(registry.gated_replies(feed.stream(), delay), spark, "g", out, state)


def test_gate_over_batches_equals_table(spark, feed, tmp_path):
    """Registrations that come late, but within the delay, count for the messages of their time and after."""
    deliveries = [
        [("heartbeat", "a", 1), ("register", "b", 2), ("send_data", "b", 1), ("heartbeat", "d", 3), (None, "a", 1)],
        [("register", "a", 3), ("heartbeat", "a", 4), ("heartbeat", "b", 5), ("register", "d", 2), ("reboot", "a", 5)],
        [("heartbeat", "a", 6), ("register", "b", 7), ("send_data", "c", 8), ("register", "c", 8), ("get_status", None, 9)],
        [("register", "a", 1), ("heartbeat", "e", 9)],
        [("get_status", None, 100)],  # moves the watermark past all that waits
    ]
    for delivery in deliveries:
        feed.send(*delivery)
        streamed = gate_step(spark, feed, tmp_path, "30 seconds")
    batch = messages.replies(feed.table())
    assert streamed.columns == batch.columns
    assert rows(streamed, "event_id") == rows(batch, "event_id")
    refused = {r["event_id"]: r["message"] for r in batch.where("message LIKE '%not registered'").collect()}
    assert refused == {3: "Worker b not registered", 17: "Worker e not registered"}


def test_gate_answers_when_it_can(spark, feed, tmp_path):
    """Messages with a known registration are answered at once, others wait for the watermark and are answered once."""
    feed.send(("register", "a", 10), ("heartbeat", "a", 12), ("heartbeat", "b", 11), ("heartbeat", "a", 9))
    assert rows(gate_step(spark, feed, tmp_path, "60 seconds").select("event_id"), "event_id") == [(1,), (2,)]
    feed.send(("register", "b", 11))
    assert rows(gate_step(spark, feed, tmp_path, "60 seconds").select("event_id"), "event_id") == [(1,), (2,), (3,), (5,)]
    feed.send(("get_status", None, 200))
    found = rows(gate_step(spark, feed, tmp_path, "60 seconds").select("event_id", "status"), "event_id")
    assert found == [(1, "success"), (2, "success"), (3, "success"), (4, "error"), (5, "success"), (6, "success")]


def test_gate_spreads_a_hot_worker(spark, feed, tmp_path):
    feed.send(("register", "hot", 1), *[("heartbeat", "hot", 2 + i) for i in range(200)])
    out = gate_step(spark, feed, tmp_path)
    assert out.where("status = 'success'").count() == 201 and out.select("event_id").distinct().count() == 201
    keys = spark.read.format("statestore").option("stateVarName", "first").load(str(tmp_path / "state"))
    assert keys.where("key.worker_id = 'hot'").count() == 8


def test_listing_from_state(spark, feed, tmp_path):
    """The state of the registry stream, batch by batch, gives the listing of the table form."""
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    for delivery in ([("register", "a", 1), ("heartbeat", "b", 2)], [("register", "b", 70), ("heartbeat", "a", 30), ("register", "c", 5)]):
        feed.send(*delivery)
        runs.run_once(registry.worker_status_changes(feed.stream(), 60, "1 hour"), spark, "r", out, state)
        now = max(r[1] for r in feed.all).isoformat(sep=" ")
        listed = registry.listed_workers(spark, state, now)
        assert rows(listed, "id") == rows(messages.worker_status(feed.table(), now), "id") != []


def test_registrations_of_one_instant(spark, tmp_path):
    """The greater description wins, whichever comes first, as in the table form."""
    at = dt.datetime(2024, 1, 1)
    data = [(1, at, "register", "a", "zeta", "h2", None), (2, at, "register", "a", "alpha", "h9", None), (3, at, "register", "b", "x", "h1", None)]
    data += [(4, at, "register", "b", "x", "h3", None), (5, at, "heartbeat", "a", None, None, None)]
    folder = str(tmp_path / "in")
    for k, some in enumerate((data[:1] + data[3:4], data[1:3] + data[4:])):
        spark.createDataFrame(some, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        changes = registry.worker_status_changes(spark.readStream.schema(SCHEMA).parquet(folder), 60, "1 hour")
        runs.run_once(changes, spark, "r", str(tmp_path / "out"), str(tmp_path / "state"))
    listed = registry.listed_workers(spark, str(tmp_path / "state"), "2024-01-01 00:00:10")
    table = messages.worker_status(spark.createDataFrame(data, SCHEMA), "2024-01-01 00:00:10")
    assert rows(listed, "id") == rows(table, "id") and [r[1:3] for r in rows(listed, "id")] == [("zeta", "h2"), ("x", "h3")]


def test_hourly_late_rows_and_sessions(spark, feed, tmp_path):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")

    def step():
        return rows(runs.run_once(windows.hourly_counts(feed.stream(), "10 minutes"), spark, "h", out, state), "bucket")

    feed.send(("heartbeat", "a", 10), ("heartbeat", "a", 20), ("heartbeat", "a", 3 * 3600))
    assert [n for _, n in step()] == [2]
    feed.send(("heartbeat", "a", 30), ("heartbeat", "a", 6 * 3600))  # the first is too late
    assert [n for _, n in step()] == [2, 1]


def test_dedup_across_batches(spark, feed, tmp_path):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")

    def step():
        return runs.run_once(windows.deduplicate(feed.stream(), ["worker_id", "event_ts"]), spark, "d", out, state).count()

    feed.send(("heartbeat", "a", 1), ("heartbeat", "a", 1), ("heartbeat", "b", 1))
    assert step() == 2
    feed.send(("heartbeat", "a", 1), ("heartbeat", "a", 2))
    assert step() == 3


def test_match_batches_count_once(spark, tmp_path):
    """Rows with several indicators count once, rows without any observable take part in no join, over two batches."""
    schema = "id int, ip array<string>, domain string"
    indicators = spark.createDataFrame(
        [("ip", "x", "low", None), ("ip", "y", "low", None), ("domain", "d", "high", "a"), ("domain", "d", "low", "b")],
        "type string, indicator string, threat_level string, description string")
    handle = windows.match_batches(indicators, "id", str(tmp_path / "out"))
    data = [(1, ["q", "x", "y"], "d"), (2, ["d"], None), (3, None, None), (4, [], "d"), (5, ["x", None], "e")]
    for some in (data[:3], data[3:]):
        spark.createDataFrame(some, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        runs.run_batches(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), spark, "m", handle, str(tmp_path / "state"))
    found = spark.read.parquet(str(tmp_path / "out"))
    assert rows(found.select("id"), "id") == [(1,), (4,), (5,)]
    handle(spark.createDataFrame(data[3:], schema), 1)  # a replay writes nothing twice
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_cycles_equal_table_jobs(spark, feed, tmp_path):
    """Every cycle once, over several batches and late rows within the delay, as the job on the whole table gives it."""
    root, state, ran = str(tmp_path / "root"), str(tmp_path / "state"), []

    def job(recent, as_of):
        ran.append(as_of)
        return recent.groupBy("worker_id").agg(F.count("*").alias("n"), F.max("event_id").alias("last")).withColumn("as_of", F.lit(as_of))

    handle = cycles.cycle_batches(root, job, 60, 150, 30)
    shape = None
    for delivery in (
        [("heartbeat", "a", 5), ("heartbeat", "b", 61), ("heartbeat", "a", 100)],
        [("heartbeat", "a", 90), ("heartbeat", "c", 180), ("heartbeat", "a", 120)],
        [("heartbeat", "b", 400)],
        [("heartbeat", "b", 401), ("heartbeat", "b", 380)],
    ):
        feed.send(*delivery)
        runs.run_batches(feed.stream(), spark, "c", handle, state)
    shape = job(feed.table(), "x").schema
    ran.pop()
    assert ran == [f"2024-01-01 00:0{m}:00" for m in (1, 2, 3, 4, 5, 6)]
    found = cycles.results(spark, root, shape).select("as_of", "worker_id", "n", "last")
    expected = []
    for m in range(1, 7):
        end = dt.datetime(2024, 1, 1, 0, m)
        recent = feed.table().where((F.col("event_ts") > end - dt.timedelta(seconds=150)) & (F.col("event_ts") <= end))
        expected += [(f"2024-01-01 00:0{m}:00", r["worker_id"], r["n"], r["last"]) for r in job(recent, "").collect()]
    assert rows(found, "as_of", "worker_id") == sorted(expected)
    last = spark.createDataFrame(feed.all[-2:], SCHEMA)
    handle(last, 3)  # a replayed batch closes nothing twice and keeps its rows once
    assert rows(cycles.results(spark, root, shape).select("as_of", "worker_id", "n", "last"), "as_of", "worker_id") == sorted(expected)
    assert spark.read.parquet(root + "/history").count() == len(feed.all)


def test_table_stream_of_a_file_and_of_a_folder(spark, tmp_path):
    """A table may be one file or a folder of files, and the stream reads either whole."""
    from vigilframe.plans.stream_queries import table_stream

    pages = spark.createDataFrame([(i, f"http://h{i}/", "x") for i in range(10)], "page_id bigint, url string, html string")
    pages.repartition(3).write.parquet(str(tmp_path / "many" / "pages.parquet"))
    pages.toPandas().to_parquet(str(tmp_path / "pages.parquet"))
    for folder in (tmp_path / "many", tmp_path):
        assert runs.run_once(table_stream(spark, str(folder), "pages"), spark, "pages").count() == 10


def test_array_files_are_cut_once_a_file(spark, tmp_path):
    """The array is parsed below the rows of its elements, not again for each of them."""
    from vigilframe.streaming import drops

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('[{"n": 1}, {"n": 2}]')
    stream = drops.array_stream(spark, str(tmp_path), drops.Dataset("in", spark.createDataFrame([], "n int").schema))
    run = stream.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    run.awaitTermination()
    plan = run._jsq.explainInternal(True).split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    assert "Generate explode" in plan and "ArrayType(StringType" not in plan[:plan.index("Generate explode")]


def test_gate_keeps_one_timer_for_all_that_wait():
    """Messages that wait set one timer a key, at the earliest, and what is not due yet sets the next one."""
    from unittest.mock import MagicMock

    from pyspark.sql import Row

    gate, held = registry.RegistrationGate(), []
    gate.handle, gate.first, gate.waiting = MagicMock(), MagicMock(), MagicMock()
    gate.first.get.return_value, gate.waiting.get.side_effect = None, lambda: iter(held)
    gate.waiting.appendList.side_effect = held.extend
    sent = [Row(us=1000 * k, body=str(k), joins=False) for k in (7, 5, 9)]
    assert list(gate.handleInputRows(("w", 0), iter(sent), None)) == []
    gate.handle.registerTimer.assert_called_once_with(6)
    now = MagicMock()
    now.getCurrentWatermarkInMs.return_value = 8
    assert sorted(r.body for r in gate.handleExpiredTimer(("w", 0), now, None)) == ["5", "7"]
    gate.waiting.put.assert_called_once_with([(9000, "9")])
    assert gate.handle.registerTimer.call_args.args == (10,)
