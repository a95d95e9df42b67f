"""Structured Streaming over files: the batch operators around a stream."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from logloom.functions.rules import RULES_V1, RuleSet
from logloom.functions.syslog import parse_lines
from logloom.operators.predicates import DENYLIST, LARGE_BACKLOG, is_denylisted
from logloom.plans import jobs
from logloom.sources import collect

from .store import Store

EVERY = {"processingTime": "300 seconds"}
CATCH_UP = {"availableNow": True}


def file_stream(spark: SparkSession, path: str, fmt: str, schema, files_per_trigger: int | None = None,
                glob: str | None = None) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def run_fingerprints(events: DataFrame, store: Store, run: str, checkpoint: str, trigger: dict | None = None,
                     ruleset: RuleSet = RULES_V1, unique_ids: bool = False,
                     backlog: Callable[[DataFrame], int] = DataFrame.count,
                     hold: Callable[[Callable[[], int]], int] | None = None) -> StreamingQuery:
    """Feed a stream of events into the store, batch by batch.

    The checkpoint fixes what belongs to a batch, the store skips batches it
    has committed, and events already in the bridge are left out; together a
    replay of any kind adds nothing.  ``backlog`` tells how much waits, by
    default the batch itself; ``hold`` may keep a batch waiting and returns
    the backlog it let through.
    """
    def one(batch: DataFrame, batch_id: int) -> None:
        pending = hold(lambda: backlog(batch)) if hold else backlog(batch)
        processed = jobs.process_batch(store, batch, run, batch_id, ruleset, unique_ids)
        jobs.record_tick(store, run, pending, processed)

    return (events.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or EVERY)).start())


class IdleTicks(StreamingQueryListener):
    """A tick also when a query finds nothing to do, so that a quiet stream is
    idle and not dead."""

    def __init__(self, store: Store, run: str):
        self.store, self.run, self.query_id = store, run, None

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        pass  # batches record their own ticks

    def onQueryIdle(self, event) -> None:
        if str(event.id) == self.query_id:
            jobs.record_tick(self.store, self.run, 0, 0)

    def onQueryTerminated(self, event) -> None:
        if str(event.id) == self.query_id:
            self.store.spark.streams.removeListener(self)


def follow(events: DataFrame, store: Store, checkpoint: str, trigger: dict | None = None, ruleset: RuleSet = RULES_V1,
           limit: int = LARGE_BACKLOG, now: Callable[[], datetime] = jobs.utc_now,
           wait: Callable[[float], None] = time.sleep, source: Callable[[], DataFrame] | None = None) -> StreamingQuery:
    """The live job: while the blackout lasts a large backlog waits, ticking
    once a minute, and an idle stream keeps ticking.

    ``source`` reads the streamed table as it is now; the backlog is what it
    holds above the bridge's highest id, however small the batches are in
    which it arrives.  Without it the backlog is the batch.
    """
    def backlog(batch: DataFrame) -> int:
        return jobs.waiting(store, source()).count() if source else batch.count()

    def hold(count: Callable[[], int]) -> int:
        pending = count()
        while jobs.decision(store.spark, pending, "follow", now(), limit) == "defer":
            jobs.record_tick(store, "follow", pending, 0)
            wait(60.0)
            pending = count()
        return pending

    ticks = IdleTicks(store, "follow")
    store.spark.streams.addListener(ticks)
    query = run_fingerprints(events, store, "follow", checkpoint, trigger, ruleset, backlog=backlog, hold=hold)
    ticks.query_id = str(query.id)
    return query


def to_parquet(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    return (df.writeStream.format("parquet").outputMode("append").option("path", path)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or EVERY)).start())


def ingest(syslog: DataFrame, router: DataFrame, container: DataFrame, patterns=DENYLIST) -> DataFrame:
    """Three line streams to one event stream.

    ``syslog`` has ``line``, ``router`` has ``xml``, ``container`` has
    ``stream`` and ``line``; each has ``received_at``.  The denylist applies
    to the container stream, before anything else is done to its rows.
    """
    parts = collect.split_container_lines(container, "line", "received_at").where(~is_denylisted("message", patterns))
    parts = parts.withColumn("timestamp", collect.container_timestamp("ts_text", "received_at"))
    return collect.union_events(
        parse_lines(syslog, "line", "received_at"),
        collect.map_router(collect.parse_router_xml(router, "xml"), "received_at"),
        collect.map_container(parts, "stream", "timestamp", "message"))


RAW_SCHEMA = "source string, stream string, raw string, received_at string"


def raw_lines(syslog: DataFrame, router: DataFrame, container: DataFrame) -> DataFrame:
    """The three line streams of ``ingest`` as one, with the collector's name."""
    def part(df: DataFrame, source: str, raw: str) -> DataFrame:
        stream = F.col("stream") if "stream" in df.columns else F.lit(None).cast("string")
        return df.select(F.lit(source).alias("source"), stream.alias("stream"), F.col(raw).alias("raw"), "received_at")

    return part(syslog, "syslog", "line").unionByName(part(router, "router", "xml")).unionByName(
        part(container, "container", "line"))


def backup_rows(raw: DataFrame) -> DataFrame:
    """Every line as it goes into the backup, before any filter."""
    lines = collect.split_container_lines(raw.where("source = 'container'"), "raw", "received_at").select(
        "source", collect.backup_line("stream", "ts_text", "message").alias("value"))
    return lines.unionByName(raw.where("source <> 'container'").select(
        "source", collect.backup_line("raw").alias("value")))


def ingest_batch(raw: DataFrame, path: str, batch: int, patterns=DENYLIST) -> None:
    """Backup first, then the events, both under the batch's own folder: a
    batch that runs again replaces what it wrote.

    Events keep the time as it came and get it as an instant beside it.
    """
    raw.transform(backup_rows).write.mode("overwrite").partitionBy("source").text(f"{path}/backup/batch={batch}")

    def part(source: str, name: str) -> DataFrame:
        return raw.where(F.col("source") == source).withColumnRenamed("raw", name)

    events = ingest(part("syslog", "line"), part("router", "xml"), part("container", "line"), patterns)
    events.withColumn("event_ts", F.try_to_timestamp("timestamp")).write.mode("overwrite").parquet(
        f"{path}/events/batch={batch}")


def run_ingest(syslog: DataFrame, router: DataFrame, container: DataFrame, path: str, checkpoint: str,
               trigger: dict | None = None, patterns=DENYLIST) -> StreamingQuery:
    """The live collectors with both sinks under one batch id."""
    return (raw_lines(syslog, router, container).writeStream
            .foreachBatch(lambda batch, number: ingest_batch(batch, path, number, patterns))
            .option("checkpointLocation", checkpoint).trigger(**(trigger or EVERY)).start())


def timed(events: DataFrame, ts: str, delay: str) -> DataFrame:
    """Event time as the instant type watermarks need."""
    return events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def dedup(events: DataFrame, delay: str = "24 hours") -> DataFrame:
    """Drop resent rows while the look-back keeps their first copy."""
    return timed(events, "timestamp", delay).dropDuplicatesWithinWatermark(["timestamp", "message"])


def burst(events: DataFrame, key: str, threshold: int, window: str = "15 minutes", slide: str = "5 minutes",
          delay: str = "10 minutes") -> DataFrame:
    counted = timed(events, "ts", delay).groupBy(F.window("ts", window, slide), key).agg(F.count("*").alias("events"))
    return counted.where(F.col("events") >= threshold).select(
        key, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "events")


def sessions(events: DataFrame, key: str, gap: str, delay: str = "10 minutes") -> DataFrame:
    """Episodes closed by a silence.  Sessions are merged inside each task
    before the shuffle, so a busy key moves sessions, not events, if the
    session's ``sessionWindow.merge.sessions.in.local.partition`` is on."""
    found = timed(events, "ts", delay).groupBy(F.session_window("ts", gap), key).agg(
        F.count("*").alias("events"), F.max("ts").alias("last_event"))
    return found.select(key, F.col("session_window.start").alias("episode"), "last_event",
                        F.col("session_window.end").alias("closed_at"), "events")


class _Silence(StatefulProcessor):
    """Last sighting per key and a timer for when it becomes overdue."""

    def __init__(self, limit_ms: int):
        self.limit_ms = limit_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "last_us long, alarmed boolean")

    def _alarm(self, key, last_us: int) -> pd.DataFrame:
        opened = last_us + self.limit_ms * 1000
        return pd.DataFrame({"key": [key[0]], "last_event_us": [last_us], "opened_at_us": [opened]})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # Rows are one (first, last) pair per minute, so a batch's worth for
        # one key is small; they need not arrive in order.
        spans = pd.concat(list(rows))[["first_us", "last_us"]].sort_values("first_us")
        last, alarmed = self.last.get() if self.last.exists() else (None, False)
        for first_us, last_us in spans.itertuples(index=False):
            if last is not None and not alarmed and first_us - last > self.limit_ms * 1000:
                yield self._alarm(key, last)
            if last is None or last_us > last:
                last, alarmed = last_us, False
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(last // 1000 + self.limit_ms)
        self.last.update((int(last), bool(alarmed)))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last, alarmed = self.last.get()
        if not alarmed:
            self.last.update((int(last), True))
            yield self._alarm(key, last)

    def close(self) -> None:
        pass


def absence(events: DataFrame, key: str, every_minutes: int, delay: str = "10 minutes") -> DataFrame:
    """Alarm once per silence: when the next event shows the gap, or when
    event time passes the limit without one.

    Events are first reduced to one (first, last) pair per key and minute, so
    the state of a busy key is fed by minutes, not by events.  Gaps inside a
    minute are below any limit of a minute or more.
    """
    if every_minutes < 1:
        raise ValueError("the limit is at least one minute")
    micros = F.unix_micros("ts")
    spans = timed(events.select(F.col(key).cast("string").alias("key"), "ts"), "ts", delay).groupBy(
        F.window("ts", "1 minute"), "key").agg(F.min(micros).alias("first_us"), F.max(micros).alias("last_us"))
    spans = spans.select("key", "first_us", "last_us", F.window_time("window").alias("at"))
    found = spans.groupBy("key").transformWithStateInPandas(
        statefulProcessor=_Silence(every_minutes * 60_000),
        outputStructType="key string, last_event_us long, opened_at_us long",
        outputMode="append", timeMode="EventTime", eventTimeColumnName="")
    return found.select(F.col("key").alias(key), F.timestamp_micros("last_event_us").alias("last_event"),
                        F.timestamp_micros("opened_at_us").alias("opened_at"))
