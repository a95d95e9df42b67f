"""Registered streaming queries.  Each runs its stream over the given tables
until it has caught up and returns what the sink or the store then holds."""

from __future__ import annotations

from pyspark.sql import functions as F

from logloom.operators import register as reg
from logloom.session import shared_dir
from logloom.streaming import streams
from logloom.streaming.store import Store

from . import fixtures as fx
from .queries import query


def _events_stream(spark, d, columns=None):
    schema = fx.table(spark, d, "events").schema
    raw = streams.file_stream(spark, d, "parquet", schema, glob="events.parquet")
    return raw.select(*(columns or fx.monitoring_columns()))


def _finish(stream) -> None:
    try:
        stream.awaitTermination()
    finally:
        stream.stop()


def _caught_up(spark, d, run="follow", store=None):
    store = store or Store(spark, shared_dir(spark, "store"))
    _finish(streams.run_fingerprints(_events_stream(spark, d), store, run, shared_dir(spark, "checkpoint"),
                                     streams.CATCH_UP, unique_ids=True))
    return store


def _collected(spark, df):
    out = shared_dir(spark, "sink")
    _finish(streams.to_parquet(df, out, shared_dir(spark, "checkpoint"), streams.CATCH_UP))
    return spark.read.schema(df.schema).parquet(out)


def _ntz(df):
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name) if f.dataType.typeName() == "timestamp"
                       else F.col(f.name) for f in df.schema.fields])


@query("SELECT * FROM reg0")
def stream_fingerprint(spark, d):
    return _caught_up(spark, d).register().select(*reg.DELTA_COLUMNS)


@query("SELECT event_id, fingerprint, cleaner_ver, normalizer_ver, bom_missing, bom_missing_unverified FROM bridge")
def stream_backfill(spark, d):
    return _caught_up(spark, d, "backfill").bridge().drop("computed_at", "event_ts")


@query("SELECT fingerprint, vorkommen, erstmals, zuletzt FROM reg0")
def stream_exactly_once(spark, d):
    """The same events a second time, as a new run, add nothing."""
    store = _caught_up(spark, d, "first")
    return _caught_up(spark, d, "again", store).register().select("fingerprint", "vorkommen", "erstmals", "zuletzt")


@query("""
SELECT 'follow' AS mode, count(*) AS last_batch_size, true AS worked, 1 AS cleaner_ver, 1 AS normalizer_ver FROM ev""")
def stream_progress(spark, d):
    ticks = _caught_up(spark, d).ticks()
    return reg.heartbeat(ticks).select("mode", F.col("last_batch_size").cast("bigint").alias("last_batch_size"),
                                       F.col("last_work_at").isNotNull().alias("worked"), "cleaner_ver", "normalizer_ver")


RECEIVED = "2024-02-01T00:00:00.000000"


def _line_streams(spark, d):
    """Line files of the three collectors, written from the tables."""
    base = shared_dir(spark, "lines")
    fx.syslog_lines(spark, d).select("line").write.text(f"{base}/syslog")
    entry = fx.router_entries(spark, d)

    def tag(c):
        inner = F.replace(F.replace(F.col(c), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
        return F.coalesce(F.concat(F.lit(f"<{c}>"), inner, F.lit(f"</{c}>")), F.lit(""))
    xml = F.concat(F.lit("<Event>"), *[tag(c) for c in ("id", "group", "date", "time", "msg")], F.lit("</Event>"))
    entry.select(xml).write.text(f"{base}/router")
    for name in ("stdout", "stderr"):
        fx.container_lines(spark, d).where(F.col("stream") == name).select("line").write.text(f"{base}/{name}")

    def lines(folder, column):
        read = streams.file_stream(spark, f"{base}/{folder}", "text", "value string")
        return read.select(F.col("value").alias(column), F.lit(RECEIVED).alias("received_at"))
    container = lines("stdout", "line").withColumn("stream", F.lit("stdout")).unionByName(
        lines("stderr", "line").withColumn("stream", F.lit("stderr")))
    return lines("syslog", "line"), lines("router", "xml"), container


@query(f"""
WITH allowed AS (SELECT * FROM cmap WHERE NOT regexp_matches(message, 'INFO \\(\\d+\\): Skipping operation'))
SELECT CASE WHEN parsed THEN "timestamp" ELSE '{RECEIVED}' END AS "timestamp", host, facility, priority, program, message FROM parsed
UNION ALL SELECT CASE WHEN seq % 40 = 0 THEN '{RECEIVED}' ELSE "timestamp" END, host, facility, priority, program, trim(message) FROM routed
UNION ALL SELECT CASE WHEN id % 60 = 0 OR id % 59 = 0 THEN '{RECEIVED}' ELSE "timestamp" END, host, facility, priority, program, message
FROM allowed""")
def stream_ingest_union(spark, d):
    out = streams.ingest(*_line_streams(spark, d))
    return _collected(spark, out.select("timestamp", "host", "facility", "priority", "program", "message"))


def _ingested(spark, d):
    path = shared_dir(spark, "ingest")
    _finish(streams.run_ingest(*_line_streams(spark, d), path, shared_dir(spark, "checkpoint"), streams.CATCH_UP))
    return path


@query(f"""
SELECT 'container' AS source, concat(stream, ' ', CASE WHEN id % 60 = 0 THEN '{RECEIVED}' ELSE ts_text END, ' ', message) AS value FROM csplit
UNION ALL SELECT 'syslog', line FROM lines""")
def stream_raw_backup(spark, d):
    """What the live job has backed up before it filtered: all lines, also those that no event came from."""
    path = _ingested(spark, d)

    def kept(source):
        return spark.read.text(f"{path}/backup/*/source={source}").select(F.lit(source).alias("source"), "value")
    return kept("syslog").union(kept("container"))


@query('SELECT "timestamp", message, min(id) AS id FROM ev GROUP BY 1, 2')
def stream_resume(spark, d):
    """Two runs on one checkpoint; the second run's files replay the boundary."""
    base = shared_dir(spark, "resume")
    cut = fx.cut_id(spark, d)
    rows = fx.monitoring_events(spark, d)
    out, checkpoint = f"{base}/sink", f"{base}/checkpoint"
    for part in (rows.where(F.col("id") <= cut), rows.where(F.col("id") >= cut)):
        part.write.mode("append").parquet(f"{base}/in")
        stream = streams.file_stream(spark, f"{base}/in", "parquet", rows.schema)
        _finish(streams.to_parquet(stream, out, checkpoint, streams.CATCH_UP))
    return reg.overlap_dedup(spark.read.parquet(out))


@query('SELECT DISTINCT "timestamp", message FROM ev')
def stream_dedup(spark, d):
    first = _events_stream(spark, d).select("timestamp", "message")
    again = _events_stream(spark, d).where("id % 3 = 0").select("timestamp", "message")
    return _ntz(_collected(spark, streams.dedup(first.unionByName(again))))


def _keyed_stream(spark, d):
    return _events_stream(spark, d, [F.col("ts"), fx.monitoring_columns()[2]])


@query("""
WITH w AS (SELECT host, time_bucket(INTERVAL 5 MINUTE, ts, TIMESTAMP '2000-01-01') - to_minutes(5 * k) AS window_start
 FROM ke, (SELECT unnest([0, 1, 2]) AS k)),
c AS (SELECT host, window_start, window_start + INTERVAL 15 MINUTE AS window_end, count(*) AS events FROM w GROUP BY ALL)
SELECT c.* FROM c, last_ts WHERE events >= 2 AND window_end <= t - INTERVAL 10 MINUTE""")
def stream_burst(spark, d):
    """Windows the watermark has closed."""
    return _ntz(_collected(spark, streams.burst(_keyed_stream(spark, d), "host", 2)))


@query("""
SELECT s.* FROM (SELECT host, min(ts) AS episode, max(ts) AS last_event, max(ts) + INTERVAL 30 MINUTE AS closed_at, count(*) AS events
 FROM (SELECT *, sum(CASE WHEN p IS NULL OR ts >= p + INTERVAL 30 MINUTE THEN 1 ELSE 0 END) OVER (PARTITION BY host ORDER BY ts) AS g
  FROM (SELECT *, lag(ts) OVER (PARTITION BY host ORDER BY ts) AS p FROM ke)) GROUP BY host, g) s, last_ts
WHERE closed_at <= t - INTERVAL 10 MINUTE""")
def stream_session(spark, d):
    return _ntz(_collected(spark, streams.sessions(_keyed_stream(spark, d), "host", "30 minutes")))


@query("""
SELECT host, ts AS last_event, ts + INTERVAL 90 MINUTE AS opened_at
FROM (SELECT *, lead(ts) OVER (PARTITION BY host ORDER BY ts) AS nxt FROM ke), last_ts
WHERE (nxt IS NULL OR nxt > ts + INTERVAL 90 MINUTE) AND ts + INTERVAL 90 MINUTE < t - INTERVAL 10 MINUTE""")
def stream_absence(spark, d):
    """Alarms whose limit event time (the watermark) has passed, whether or
    not the next event has come."""
    previous = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        return _ntz(_collected(spark, streams.absence(_keyed_stream(spark, d), "host", 90)))
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", previous)
