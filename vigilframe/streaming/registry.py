"""Worker registry and registration gate as keyed stream state."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from vigilframe.functions.timing import instant
from vigilframe.operators.messages import reply, validate

CHANGES = "worker_id string, type string, host string, last_heartbeat timestamp, status string"
_STATE = "type string, host string, joined bigint, last bigint"
_MESSAGE = "us bigint, body string"


class WorkerRegistry(StatefulProcessor):
    """Keeps one worker; emits `online` with every batch of signals and `offline` on silence.

    The offline timer fires one millisecond after the timeout, since a silence of exactly
    the timeout still counts as online.
    """

    def __init__(self, timeout_ms: int) -> None:
        self.timeout_ms = timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.worker = handle.getValueState("worker", _STATE)

    def _deadline(self, last: int) -> int:
        return last // 1000 + self.timeout_ms + 1

    def _row(self, key, state, status: str):
        kind, host, _, last = state
        return Row(worker_id=key[0], type=kind, host=host, us=last, status=status)

    def handleInputRows(self, key, rows, timerValues):
        known = self.worker.get()
        kind, host, joined, last = old = tuple(known) if known else (None, None, None, None)
        old_last = last
        for row in rows:
            if row.message_type == "register":
                newest = (row.us, row.worker_type, row.host)
                if joined is None or newest > (joined, kind, host):
                    joined, kind, host = newest
            last = row.us if last is None else max(last, row.us)
        if joined is None:
            return
        if (kind, host, joined, last) != old:
            self.worker.update((kind, host, joined, last))
        if last != old_last:
            if old_last is not None:
                self.handle.deleteTimer(self._deadline(old_last))
            self.handle.registerTimer(self._deadline(last))
        yield self._row(key, (kind, host, joined, last), "online")

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        known = self.worker.get()
        if known:
            yield self._row(key, tuple(known), "offline")

    def close(self) -> None:
        pass


def fold_signals(batches):
    """Map-side combine: per Arrow batch and worker only the newest signal and registration.

    The state needs no more than these, so a worker that sends a third of all messages
    still brings a few rows per task to its shuffle.
    """
    for batch in batches:
        newest = batch.groupby("worker_id")["us"].idxmax()
        registered = batch[batch["message_type"] == "register"].sort_values(["us", "worker_type", "host"]).groupby("worker_id").tail(1)
        yield batch.loc[sorted(set(newest) | set(registered.index))]


def worker_status_changes(messages: DataFrame, timeout_seconds: int = 60, delay: str = "0 seconds") -> DataFrame:
    """Status changes per worker.  The session needs the RocksDB state store provider."""
    signals = (
        validate(messages).where("error IS NULL AND type IN ('register', 'heartbeat')")
        .withWatermark("event_ts", delay)
        .select("worker_id", "event_ts", F.col("type").alias("message_type"), "worker_type",
                F.coalesce("host", F.lit("unknown")).alias("host"), F.unix_micros("event_ts").alias("us"))
    )
    folded = signals.mapInPandas(fold_signals, signals.schema)
    changes = folded.groupBy("worker_id").transformWithState(
        statefulProcessor=WorkerRegistry(timeout_seconds * 1000), outputStructType="worker_id string, type string, host string, us bigint, status string",
        outputMode="Append", timeMode="EventTime")
    return changes.select("worker_id", "type", "host", F.timestamp_micros("us").alias("last_heartbeat"), "status")


def listed_workers(spark: SparkSession, checkpoint: str, as_of: str, timeout: str = "60 seconds") -> DataFrame:
    """The registry of a `worker_status_changes` stream as a listing at `as_of`, read from its state after the last batch.

    Signals later than `as_of` that the stream has taken in already are part of the state.
    """
    state = spark.read.format("statestore").option("stateVarName", "worker").load(checkpoint)
    last = F.timestamp_micros(F.col("value.last"))
    late = instant(as_of) > last + F.expr(f"INTERVAL {timeout}")
    return state.select(
        F.col("key.worker_id").alias("id"), F.col("value.type").alias("type"), F.col("value.host").alias("host"),
        last.alias("last_heartbeat"), F.when(late, "offline").otherwise("online").alias("status"))


class RegistrationGate(StatefulProcessor):
    """Keeps a worker's first registration, and the messages that wait for one.

    A message is answered at once if a registration of its time or earlier is known.  Else it waits until the watermark has
    passed it: no registration can then come that counts for it.  One timer stands for all that wait, at the earliest of them.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.first = handle.getValueState("first", "us bigint")
        self.waiting = handle.getListState("waiting", _MESSAGE)

    def _answers(self, key, messages: list[tuple[int, str]], registered: bool):
        for us, body in messages:
            yield Row(worker_id=key[0], us=us, body=body, registered=registered)

    def handleInputRows(self, key, rows, timerValues):
        known = self.first.get()
        first = old = known[0] if known else None
        fresh = []
        for row in rows:
            if row.joins:
                first = row.us if first is None else min(first, row.us)
            else:
                fresh.append((row.us, row.body))
        waiting = fresh
        if first != old:
            self.first.update((first,))
            held = [tuple(m) for m in self.waiting.get()]
            waiting = held + fresh
            if held:
                self.waiting.clear()
        passed = [m for m in waiting if first is not None and m[0] >= first]
        waiting = [m for m in waiting if first is None or m[0] < first]
        if waiting:
            self.waiting.appendList(waiting)
            self.handle.registerTimer(min(waiting)[0] // 1000 + 1)
        yield from self._answers(key, passed, True)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        held = [tuple(m) for m in self.waiting.get()]
        passed = timerValues.getCurrentWatermarkInMs()
        due = [m for m in held if m[0] // 1000 < passed]
        if due:
            rest = [m for m in held if m[0] // 1000 >= passed]
            if rest:
                self.waiting.put(rest)
                self.handle.registerTimer(min(rest)[0] // 1000 + 1)
            else:
                self.waiting.clear()
        yield from self._answers(key, due, False)

    def close(self) -> None:
        pass


def gated_replies(messages: DataFrame, delay: str = "0 seconds", salts: int = 8) -> DataFrame:
    """The reply to every message of a stream, as `messages.replies` gives it for a table.

    Heartbeats and data go through keyed state, spread over `salts` keys a worker, to each of which the worker's
    registrations go, so a worker that sends a third of all messages does not meet one task.  All other messages are
    answered at once.  Messages without a registration are answered when the watermark has passed them.  The session needs
    the RocksDB state store provider.
    """
    checked = validate(messages).withWatermark("event_ts", delay).withColumn("us", F.unix_micros("event_ts"))
    rest = [c for c in messages.columns if c not in ("event_ts", "worker_id")]
    gated = F.col("error").isNull() & F.col("type").isin("heartbeat", "send_data")
    joins = F.col("error").isNull() & (F.col("type") == "register")
    body = F.to_json(F.struct(*rest), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})
    salt = F.when(joins, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.pmod(F.xxhash64("us", body), F.lit(salts)).cast("int")))
    keyed = checked.where(gated | joins).select(
        "worker_id", F.explode(salt).alias("salt"), "event_ts", "us", joins.alias("joins"), F.when(~joins, body).alias("body"))
    answered = keyed.groupBy("worker_id", "salt").transformWithState(
        statefulProcessor=RegistrationGate(), outputStructType="worker_id string, us bigint, body string, registered boolean",
        outputMode="Append", timeMode="EventTime")
    shape = T.StructType([f for f in messages.schema.fields if f.name in rest])
    back = answered.select(
        "worker_id", F.timestamp_micros("us").alias("event_ts"), "registered",
        F.from_json("body", shape, {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}).alias("m"))
    back = back.select(*[F.col("m")[c].alias(c) if c in rest else F.col(c) for c in messages.columns], "registered", F.lit(None).cast("string").alias("error"))
    direct = checked.where(~gated).select(*messages.columns, F.lit(False).alias("registered"), "error")
    return direct.unionByName(back).withColumn("reply", reply(F.col("registered"))).select(
        *messages.columns, F.col("reply.status").alias("status"), F.col("reply.message").alias("message"))
