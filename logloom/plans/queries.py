"""Registered queries: every operator over the given tables, with check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.functions import fields, syslog, text
from logloom.functions.rules import RULES_V1, RULES_V2
from logloom.operators import incidents as inc
from logloom.operators import migrate as mig
from logloom.operators import predicates as pred
from logloom.operators import quality as dq
from logloom.operators import register as reg
from logloom.session import materialize
from logloom.sources import collect

from . import fixtures as fx
from .oracle import form_sql, sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(body: str | None = None, *views: str, name: str | None = None):
    def add(fn):
        key = name or fn.__name__
        QUERIES[key] = fn
        if body is not None:
            ORACLE[key] = sql(body, *views)
        return fn
    return add


def ntz(c) -> F.Column:
    return (F.col(c) if isinstance(c, str) else c).cast("timestamp_ntz")


# --- sources, parsing, sinks ----------------------------------------------

PARSED = "id, \"timestamp\", host, facility, priority, program, pid, msgid, message, parsed"


def _parsed(spark, d):
    return syslog.parse_lines(fx.syslog_lines(spark, d), "line", "received_at")


@query(f"SELECT {PARSED} FROM parsed")
def syslog_parse(spark, d):
    return _parsed(spark, d)


@query("SELECT e.event_id AS id, p.facility, p.priority FROM events e JOIN pri p ON p.pri = e.event_id % 250", "pri")
def syslog_pri(spark, d):
    pri = (F.col("event_id") % 250).cast("int")
    return fx.table(spark, d, "events").select(
        F.col("event_id").alias("id"), syslog.facility_name(pri).alias("facility"),
        syslog.severity_name(pri).alias("priority"))


@query(f"SELECT {PARSED} FROM parsed WHERE NOT parsed")
def syslog_unparsed(spark, d):
    return _parsed(spark, d).where(~F.col("parsed"))


@query("""
WITH n AS (SELECT id // 300 AS f, row_number() OVER (PARTITION BY id // 300 ORDER BY id) - 1 AS frame_no, line,
  lead(id) OVER (PARTITION BY id // 300 ORDER BY id) IS NULL AS tail FROM lines)
SELECT CAST(f AS STRING) AS path, frame_no, line FROM n WHERE NOT (f = 0 AND tail)""")
def syslog_frames(spark, d):
    return collect.split_frames(fx.syslog_captures(spark, d))


@query("""
SELECT seq, id, "group", date, time, trim(msg) AS msg FROM entries""")
def router_xml(spark, d):
    def tag(c):
        escaped = F.replace(F.replace(F.col(c), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
        return F.when(F.col(c).isNotNull(), F.concat(F.lit(f"<{c}> "), escaped, F.lit(f" </{c}>"))).otherwise("")
    body = F.concat(F.lit("<Event>"), *[tag(c) for c in ("id", "group", "date", "time", "msg")], F.lit("</Event>"))
    return collect.parse_router_xml(fx.router_entries(spark, d).select("seq", body.alias("xml")), "xml")


@query("SELECT seq, utc FROM rtime")
def router_datetime(spark, d):
    return fx.router_entries(spark, d).select("seq", ntz(collect.router_datetime("date", "time")).alias("utc"))


@query('SELECT seq, "timestamp", host, facility, priority, program, message FROM routed')
def router_map(spark, d):
    return collect.map_router(fx.router_entries(spark, d), "received_at", ("seq",))


@query("SELECT id, stream, ts_text, message FROM csplit")
def container_line_split(spark, d):
    return collect.split_container_lines(fx.container_lines(spark, d), "line", "received_at").drop("received_at")


def _container(spark, d):
    parts = collect.split_container_lines(fx.container_lines(spark, d), "line", "received_at")
    return parts.withColumn("timestamp", collect.container_timestamp("ts_text", "received_at"))


@query('SELECT id, "timestamp" FROM cmap')
def container_ts(spark, d):
    return _container(spark, d).select("id", "timestamp")


@query('SELECT id, "timestamp", host, facility, priority, program, message FROM cmap')
def container_map(spark, d):
    return collect.map_container(_container(spark, d), "stream", "timestamp", "message", ("id",))


def _union(spark, d):
    return collect.union_events(
        _parsed(spark, d).withColumn("source", F.lit("syslog")),
        collect.map_router(fx.router_entries(spark, d), "received_at", ("seq",))
        .withColumnRenamed("seq", "id").withColumn("source", F.lit("router")),
        collect.map_container(_container(spark, d), "stream", "timestamp", "message", ("id",))
        .withColumn("source", F.lit("container")))


UNION = """
SELECT id, "timestamp", host, facility, priority, program, pid, msgid, message, parsed, 'syslog' AS source FROM parsed
UNION ALL SELECT seq, "timestamp", host, facility, priority, program, NULL, NULL, message, NULL, 'router' FROM routed
UNION ALL SELECT id, "timestamp", host, facility, priority, program, NULL, NULL, message, NULL, 'container' FROM cmap"""


@query(UNION)
def event_union(spark, d):
    return _union(spark, d)


@query("SELECT concat(stream, ' ', ts_text, ' ', message) AS value FROM csplit")
def raw_backup(spark, d):
    parts = collect.split_container_lines(fx.container_lines(spark, d), "line", "received_at")
    return parts.select(collect.backup_line("stream", "ts_text", "message").alias("value"))


@query("""
SELECT id, CAST(json_object('timestamp', "timestamp", 'host', host, 'facility', facility, 'priority', priority,
 'program', program, 'message', message) AS STRING) AS body FROM cmap""")
def event_json(spark, d):
    rows = collect.map_container(_container(spark, d), "stream", "timestamp", "message", ("id",))
    return rows.select("id", collect.event_json().alias("body"))


@query("""
SELECT event_id, delivered_at_try, delivered_at_try IS NOT NULL AS delivered, coalesce(delivered_at_try, t) AS tries,
 CAST(coalesce(delivered_at_try, t) * (coalesce(delivered_at_try, t) - 1) / 2 AS DOUBLE) AS waited_seconds FROM dout""")
def delivery_outcome(spark, d):
    return collect.delivery_outcome(fx.delivery_attempts(spark, d))


@query("""
SELECT o.event_id, o.t AS tries, e.message AS report_text, substr(e.message, 1, 100) AS report_head
FROM dout o JOIN ev e ON e.id = o.event_id WHERE o.delivered_at_try IS NULL""")
def dead_letters(spark, d):
    outcome = collect.delivery_outcome(fx.delivery_attempts(spark, d))
    return collect.dead_letters(outcome, fx.monitoring_events(spark, d))


@query('SELECT doc_id AS id, CAST(NULL AS TIMESTAMP) AS "timestamp", lang AS host, source AS program, text AS message '
       "FROM documents")
def events_scan(spark, d):
    raw = collect.scan_events(spark, f"{d}/documents.parquet", columns={
        "id": "doc_id", "timestamp": "doc_id", "host": "lang", "program": "source", "message": "text"})
    return raw.withColumn("timestamp", F.lit(None).cast("timestamp_ntz"))


# --- filters and predicates -----------------------------------------------

DENY_SQL = " OR ".join("regexp_matches(message, '{}')".format(p.replace("'", "''")) for p in pred.DENYLIST)


@query("""
SELECT DISTINCT event_type AS pattern, true AS valid FROM events UNION ALL
SELECT DISTINCT concat('(', event_type), false FROM events""")
def denylist_load(spark, d):
    kinds = fx.table(spark, d, "events").select("event_type").distinct()
    listed = kinds.select(F.concat(F.lit(" "), "event_type", F.lit("\n\n("), "event_type", F.lit("\n")).alias("pattern"))
    return pred.load_denylist(listed)


@query(f"SELECT id, stream, message FROM csplit WHERE NOT ({DENY_SQL})")
def denylist_filter(spark, d):
    parts = collect.split_container_lines(fx.container_lines(spark, d), "line", "received_at")
    listed = spark.createDataFrame([(p + "\n(" + p,) for p in pred.DENYLIST], "pattern string")
    denylist = pred.load_denylist(listed)
    return pred.flag_denylisted(parts, denylist).where(~F.col("denylisted")).select("id", "stream", "message")


@query(f"""
SELECT stream, count(*) AS seen, count(*) FILTER (hit) AS filtered, count(*) FILTER (NOT hit) AS forwarded
FROM (SELECT stream, ({DENY_SQL}) AS hit FROM csplit) GROUP BY stream""")
def denylist_counters(spark, d):
    parts = collect.split_container_lines(fx.container_lines(spark, d), "line", "received_at")
    return pred.denylist_counters(parts, "stream")


def _polled(spark, d):
    entries = fx.router_entries(spark, d)
    return entries.select("seq", ntz(collect.router_datetime("date", "time")).alias("utc"))


@query("""
SELECT seq, utc, m.kind FROM rtime, last_ts, (SELECT unnest(['fresh', 'recent', 'old']) AS kind) m
WHERE utc >= CASE m.kind WHEN 'fresh' THEN t - INTERVAL 720 SECOND WHEN 'recent' THEN t - INTERVAL 2 HOUR
 ELSE t - INTERVAL 24 HOUR END""")
def poll_window(spark, d):
    now = fx.as_of(spark, d)
    marks = {"fresh": F.lit(None).cast("timestamp_ntz"), "recent": now - F.expr("INTERVAL 2 HOURS"),
             "old": now - F.expr("INTERVAL 90 HOURS")}
    parts = [pred.poll_window(_polled(spark, d), "utc", now, mark).withColumn("kind", F.lit(kind))
             for kind, mark in marks.items()]
    return collect.union_events(*parts)


@query("""
SELECT seq, event_ts FROM rtime, last_ts WHERE event_ts >= t - INTERVAL 24 HOUR AND (utc >= t - INTERVAL 24 HOUR) IS NOT TRUE""")
def poll_window_null_ts(spark, d):
    """Entries of the last day that the window loses, most for want of a time."""
    now = fx.as_of(spark, d)
    mark = now - F.expr("INTERVAL 24 HOURS")
    rows = fx.router_entries(spark, d).select("seq", "event_ts", ntz(collect.router_datetime("date", "time")).alias("utc"))
    inside = pred.poll_window(rows, "utc", now, mark).select("seq")
    return rows.where(F.col("event_ts") >= mark).join(inside, "seq", "left_anti").select("seq", "event_ts")


@query("SELECT * FROM ev WHERE id > (SELECT c FROM cut)", "cut")
def watermark_filter(spark, d):
    return pred.above_mark(fx.monitoring_events(spark, d), fx.cut_id(spark, d))


@query("""SELECT * FROM ev WHERE id > 0 AND "timestamp" >= (SELECT t FROM last_ts) - INTERVAL 10 DAY""")
def since_days_filter(spark, d):
    since = fx.as_of(spark, d) - F.expr("INTERVAL 10 DAYS")
    return pred.above_mark(fx.monitoring_events(spark, d), 0, since)


BERLIN = "strftime({} AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Berlin', '%H:%M')"
BLACK = "({0} >= '23:45' OR {0} < '04:00')"


@query(f"""
SELECT id, {BERLIN.format('"timestamp"')} AS local_clock, {BLACK.format(BERLIN.format('"timestamp"'))} AS blackout,
 {BERLIN.format('"timestamp"')} >= '01:00' AND {BERLIN.format('"timestamp"')} < '05:30' AS other_window FROM ev""")
def blackout_flag(spark, d):
    return fx.monitoring_events(spark, d).select(
        "id", F.date_format(pred.local_time("timestamp"), "HH:mm").alias("local_clock"),
        pred.in_blackout("timestamp").alias("blackout"),
        pred.in_blackout("timestamp", "01:00", "05:30").alias("other_window"))


@query(f"""
SELECT tick, pending, b AS blackout,
 CASE WHEN b AND pending > 2000 THEN 'defer' WHEN pending > 0 THEN 'process' ELSE 'idle' END AS follow,
 CASE WHEN b AND pending > 2000 THEN 'refuse' WHEN pending > 0 THEN 'process' ELSE 'idle' END AS backfill,
 CASE WHEN pending > 0 THEN 'process' ELSE 'idle' END AS backfill_forced,
 CASE WHEN b THEN 'pause' WHEN pending > 0 THEN 'process' ELSE 'idle' END AS backfill_running
FROM (SELECT *, {BLACK.format(BERLIN.format('tick'))} AS b FROM ticks)""")
def admission_decision(spark, d):
    ticks = fx.backlog_ticks(spark, d).withColumn("blackout", pred.in_blackout("tick"))
    p, b = F.col("pending"), F.col("blackout")
    return ticks.select(
        "tick", "pending", "blackout", pred.admission(p, b, "follow").alias("follow"),
        pred.admission(p, b, "backfill").alias("backfill"),
        pred.admission(p, b, "backfill", forced=True).alias("backfill_forced"),
        pred.admission(p, b, "backfill", running=True).alias("backfill_running"))


@query("SELECT id, host, program FROM ev WHERE host = 'DiskStation225' AND NOT contains(message, chr(65279))")
def bom_not_like(spark, d):
    return fx.monitoring_events(spark, d).where(text.bom_missing("host", "message")).select("id", "host", "program")


@query("SELECT fingerprint, erstmals FROM reg WHERE bewertet_am IS NULL")
def review_open(spark, d):
    return reg.newest_first(reg.review_open(fx.register(spark, d))).select("fingerprint", "erstmals")


@query("SELECT fingerprint, erstmals, bewertet_von FROM reg WHERE bewertet_von IS DISTINCT FROM 'axel'")
def review_awaiting(spark, d):
    return reg.newest_first(reg.review_awaiting(fx.register(spark, d), fx.FINAL_REVIEWER)).select(
        "fingerprint", "erstmals", "bewertet_von")


def _mixed_bridge(spark, d):
    """Bridge of three versions, by event id."""
    two, three = F.col("event_id") % 3 == 1, F.col("event_id") % 3 == 2
    return fx.bridge(spark, d).withColumn("normalizer_ver", F.when(two | three, 2).otherwise(1)).withColumn(
        "cleaner_ver", F.when(three, 2).otherwise(1))


MIXED = ("(SELECT event_id, fingerprint, CAST(CASE WHEN event_id % 3 = 2 THEN 2 ELSE 1 END AS INTEGER) AS cleaner_ver, "
         "CAST(CASE WHEN event_id % 3 > 0 THEN 2 ELSE 1 END AS INTEGER) AS normalizer_ver FROM bridge)")


@query(f"SELECT event_id, cleaner_ver, normalizer_ver FROM {MIXED} WHERE (cleaner_ver, normalizer_ver) <> (1, 2)")
def version_mismatch(spark, d):
    return mig.version_mismatch(_mixed_bridge(spark, d), RULES_V2).select("event_id", "cleaner_ver", "normalizer_ver")


# --- scalar functions ------------------------------------------------------

@query("SELECT id, cleaned, contains(message, chr(65279)) AS bom_found FROM cl")
def clean_bom(spark, d):
    return fx.monitoring_events(spark, d).select(
        "id", text.clean_bom("message").alias("cleaned"), text.has_bom("message").alias("bom_found"))


def _register_rule(rule_name: str, key: str) -> None:
    def run(spark, d):
        out = text.clean_bom("message")
        for rule in RULES_V1.rules:
            out = text.apply_rule(out, rule)
            if rule.name == rule_name:
                break
        return fx.monitoring_events(spark, d).select("id", out.alias("text"))
    query(f"SELECT id, {form_sql('cleaned', RULES_V1, rule_name)} AS text FROM cl", name=key)(run)


for _rule, _key in (("mac", "norm_mac"), ("iso_ts", "norm_iso_ts"), ("de_date", "norm_de_date"), ("time", "norm_time"),
                    ("ip6", "norm_ip6"), ("ip4", "norm_ip4"), ("path", "norm_path"), ("hash", "norm_hash"),
                    ("qty", "norm_qty"), ("version", "norm_version"), ("id", "norm_id"), ("int", "norm_int")):
    _register_rule(_rule, _key)


@query(r"SELECT doc_id, trim(regexp_replace(text, '[\s\v\p{Z}\x{85}\x1c-\x1f]+', ' ', 'g')) AS text FROM documents")
def norm_space(spark, d):
    return fx.table(spark, d, "documents").select("doc_id", text.collapse_space("text").alias("text"))


@query(f"SELECT id, {form_sql('cleaned')} AS form FROM cl")
def normalize_form(spark, d):
    return fx.monitoring_events(spark, d).select(
        "id", text.normalize_form(text.clean_bom("message")).alias("form"))


@query()
def normalize_documents(spark, d):
    """Whole texts of the second corpus; DuckDB's regex knows ASCII word
    boundaries only, so the tests hold this one against Python's ``re``."""
    docs = collect.scan_events(spark, f"{d}/documents.parquet", columns={
        "id": "doc_id", "timestamp": "doc_id", "host": "lang", "program": "source", "message": "text"})
    return text.with_fingerprint(docs.drop("timestamp")).select("id", "fingerprint")


@query("SELECT id, fingerprint FROM fp")
def fingerprint_key(spark, d):
    return fx.fingerprinted(spark, d).select("id", "fingerprint")


@query("SELECT id, fingerprint FROM fp")
def fingerprint_sql_function(spark, d):
    text.register_sql_functions(spark)
    fx.table(spark, d, "events")
    events = fx.monitoring_events(spark, d)
    return spark.sql("SELECT id, fingerprint_of(host, program, message) AS fingerprint FROM {ev}", ev=events)


@query("SELECT id, fingerprint FROM fp")
def fingerprint_distinct(spark, d):
    return text.with_fingerprint_distinct(fx.monitoring_events(spark, d)).select("id", "fingerprint")


@query("SELECT id, bom_missing, bom_missing_unverified FROM fp")
def bom_flags(spark, d):
    return fx.fingerprinted(spark, d).select("id", "bom_missing", "bom_missing_unverified")


@query("""
SELECT fingerprint, llm_vorschlag->>'rolle' AS rolle, llm_vorschlag->>'severity' AS severity,
 CAST(NULL AS STRING) AS group_key_felder, CAST(NULL AS STRING) AS abschluss,
 llm_vorschlag->>'stille_minuten' AS stille_minuten, CAST(NULL AS STRING) AS bezeichnung,
 CAST(NULL AS STRING) AS begruendung, CAST(NULL AS STRING) AS hinweis FROM reg""")
def proposal_fields(spark, d):
    return fx.register(spark, d).select("fingerprint", *fields.proposal_fields("llm_vorschlag"))


@query("""
SELECT event_id, CAST(event_id % 1000 AS BIGINT) AS open_minutes, CASE WHEN event_id % 1000 >= 720 THEN 'error'
 WHEN event_id % 1000 >= 360 THEN 'warning' ELSE 'info' END AS severity FROM events""")
def severity_steps(spark, d):
    lasted = F.col("event_id") % 1000
    steps = F.lit('{"720": "error", "360": "warning"}')
    return fx.table(spark, d, "events").select(
        "event_id", lasted.alias("open_minutes"), inc.severity_at(steps, lasted, F.lit("info")).alias("severity"))


@query("""
SELECT id, priority, CASE WHEN priority IN ('emergency', 'alert', 'critical') THEN 'critical' WHEN priority = 'error' THEN 'error'
 WHEN priority = 'warning' THEN 'warning' WHEN priority IN ('notice', 'informational', 'debug') THEN 'info' END AS severity
FROM parsed""")
def severity_map(spark, d):
    return _parsed(spark, d).select("id", "priority", syslog.rule_severity(F.col("priority")).alias("severity"))


# --- aggregations ----------------------------------------------------------

@query("SELECT coalesce(max(event_id), 0) AS watermark FROM bridge")
def id_watermark(spark, d):
    return reg.id_watermark(fx.bridge(spark, d))


@query("SELECT count(*) AS pending FROM ev WHERE id > (SELECT c FROM cut)", "cut")
def pending_count(spark, d):
    return reg.pending_count(fx.monitoring_events(spark, d), fx.cut_id(spark, d))


@query("SELECT * FROM reg0")
def register_delta(spark, d):
    return reg.register_delta(fx.fingerprinted(spark, d))


@query("SELECT host, program, count(*) AS missing, count(*) FILTER (bom_missing_unverified) AS unverified "
       "FROM fp WHERE bom_missing GROUP BY host, program")
def bom_report(spark, d):
    return reg.bom_report(fx.fingerprinted(spark, d))


@query("SELECT count(*) AS raw_messages, count(DISTINCT fingerprint) AS forms, "
       "round(count(*) / count(DISTINCT fingerprint), 2) AS collapse_factor, count(*) FILTER (bom_missing) AS without_bom "
       "FROM fp")
def collapse_report(spark, d):
    return reg.collapse_report(fx.fingerprinted(spark, d))


@query("""
SELECT fingerprint, CAST(sum(n) OVER (PARTITION BY fingerprint) AS BIGINT) AS form_size, example, n AS example_count
FROM (SELECT fingerprint, cleaned AS example, count(*) AS n FROM fp GROUP BY 1, 2) ORDER BY 2 DESC, 1, 4 DESC, 3""")
def collapse_groups(spark, d):
    return reg.collapse_groups(fx.fingerprinted(spark, d))


@query("""
SELECT day, n AS new_forms, CAST(sum(n) OVER (ORDER BY day) AS BIGINT) AS forms_so_far
FROM (SELECT CAST(erstmals AS DATE) AS day, count(*) AS n FROM reg0 GROUP BY 1)""")
def saturation_curve(spark, d):
    return reg.saturation_curve(reg.register_delta(fx.fingerprinted(spark, d)))


@query(f"SELECT cleaner_ver, normalizer_ver, count(*) AS events FROM {MIXED} GROUP BY 1, 2")
def version_inventory(spark, d):
    return reg.version_inventory(_mixed_bridge(spark, d))


@query("SELECT host, program, count(*) AS forms, CAST(sum(vorkommen) AS BIGINT) AS occurrences "
       "FROM reg0 GROUP BY ROLLUP (host, program)")
def host_program_summary(spark, d):
    return reg.host_program_summary(reg.register_delta(fx.fingerprinted(spark, d)))


@query("""
WITH l AS (SELECT event_type, max(CASE WHEN event_type = 'error' THEN ts - INTERVAL 7 DAY ELSE ts END) AS last_activity
 FROM events GROUP BY 1),
s AS (SELECT *, date_diff('microsecond', last_activity, t) // 1000000 AS silent_seconds FROM l, last_ts)
SELECT event_type, last_activity, silent_seconds, silent_seconds > 21600 AS stalled,
 CASE WHEN silent_seconds <= 21600 THEN 'ok' WHEN bool_and(silent_seconds > 21600) OVER () THEN 'critical' ELSE 'info' END AS level
FROM s""")
def stall_check(spark, d):
    """The stream of errors is moved back a week, so that it is quiet at the end."""
    early = F.when(F.col("event_type") == "error", F.col("ts") - F.expr("INTERVAL 7 DAYS")).otherwise(F.col("ts"))
    ev = fx.table(spark, d, "events").select("event_type", early.alias("ts"))
    return reg.stall_check(ev, "event_type", "ts", fx.as_of(spark, d))


# --- joins and merges ------------------------------------------------------

@query("SELECT id FROM fp WHERE id >= (SELECT c FROM cut) OR id % 4 = 3", "cut")
def bridge_insert_new(spark, d):
    """A batch against a bridge that ends at the cut and lacks late ids."""
    known = fx.bridge(spark, d).where((F.col("event_id") < fx.cut_id(spark, d)) & (F.col("event_id") % 4 != 3))
    return reg.new_events(fx.monitoring_events(spark, d), known.select("event_id")).select("id")


@query("SELECT * FROM reg0 ORDER BY fingerprint")
def register_upsert(spark, d):
    """Register of the first part merged with the delta of the rest."""
    cut = fx.cut_id(spark, d)
    fp = fx.fingerprinted(spark, d)
    first = reg.register_delta(fp.where(F.col("id") < cut))
    rest = reg.register_delta(fp.where(F.col("id") >= cut))
    return reg.register_upsert(first, rest).select(*reg.DELTA_COLUMNS)


def _heartbeat_ticks(spark, d):
    ticks = fx.backlog_ticks(spark, d)
    return ticks.select(F.col("tick").alias("tick_at"), F.lit("follow").alias("mode"), "pending",
                        F.when(F.hour("tick") < 20, F.least(F.col("arrived"), F.lit(500))).otherwise(0).alias("processed"))


HEART = """
SELECT CAST(1 AS SMALLINT) AS id, 'follow' AS mode, max(tick) AS last_tick_at,
 max(tick) FILTER (hour(tick) < 20 AND arrived > 0) AS last_work_at, arg_max(pending, tick) AS last_pending,
 CAST(arg_max(CASE WHEN hour(tick) < 20 THEN least(arrived, 500) ELSE 0 END, tick) AS INTEGER) AS last_batch_size,
 1 AS cleaner_ver, 1 AS normalizer_ver FROM ticks"""


@query(HEART)
def heartbeat_upsert(spark, d):
    return reg.heartbeat(_heartbeat_ticks(spark, d))


@query(f"""
SELECT a.hours, h.last_tick_at, h.last_work_at, CASE WHEN a.hours * 3600 > 900 + 3600 THEN 'dead' ELSE
 CASE WHEN date_diff('second', last_work_at, last_tick_at + to_hours(a.hours)) > 21600 THEN 'idle' ELSE 'working' END END AS state
FROM ({HEART}) h, (SELECT CAST(unnest([0, 1, 3]) AS INTEGER) AS hours) a""")
def heartbeat_state(spark, d):
    state = reg.heartbeat(_heartbeat_ticks(spark, d))
    parts = [reg.heartbeat_state(state, F.col("last_tick_at") + F.expr(f"INTERVAL {h} HOURS"), 900 + 3600).select(
        F.lit(h).alias("hours"), "last_tick_at", "last_work_at", "state") for h in (0, 1, 3)]
    return collect.union_events(*parts)


@query("""
SELECT CAST(1 AS SMALLINT) AS id, max(tick) AS last_tick_at, max(tick) FILTER (arrived % 3 > 0) AS last_run_at,
 CAST(arg_max(arrived % 3, tick) AS INTEGER) AS last_batch_size, CAST(arg_max(arrived % 2, tick) AS INTEGER) AS last_error_count,
 arg_max(concat('m', CAST(arrived % 2 AS STRING)), tick) AS model_used FROM ticks""")
def triage_heartbeat(spark, d):
    runs = fx.backlog_ticks(spark, d).select(
        F.col("tick").alias("tick_at"), (F.col("arrived") % 3).alias("batch_size"),
        (F.col("arrived") % 2).alias("error_count"),
        F.concat(F.lit("m"), (F.col("arrived") % 2).cast("string")).alias("model"))
    return reg.triage_heartbeat(runs)


def _moved(spark, d, forms=None):
    return mig.moved_events(fx.bridge(spark, d, forms), fx.monitoring_events(spark, d), RULES_V2, (1, 1))


def _moves(spark, d, forms=None):
    return materialize(mig.moves_of(_moved(spark, d, forms), fx.monitoring_events(spark, d)), "moves")


def _moves_and_register(spark, d):
    """The old forms stand behind both, so they are worked out once."""
    forms = materialize(fx.fingerprinted(spark, d), "forms")
    return _moves(spark, d, forms), materialize(fx.register(spark, d, forms), "register")


@query("SELECT event_id, old_fingerprint, new_fingerprint FROM moved")
def migrate_join(spark, d):
    return _moved(spark, d).select("event_id", "old_fingerprint", "new_fingerprint")


@query("SELECT event_id, bom_missing, false AS bom_missing_unverified FROM bridge")
def bom_backfill(spark, d):
    """The bridge as it was before the flags existed."""
    before = fx.bridge(spark, d).withColumn("bom_missing", F.lit(False)).withColumn(
        "bom_missing_unverified", F.lit(False))
    return mig.bom_backfill(before, fx.monitoring_events(spark, d)).select(
        "event_id", "bom_missing", "bom_missing_unverified")


# --- ordering, limits, windows --------------------------------------------

@query("""
WITH d AS (SELECT host, "timestamp" AS ts, id, NOT (id % 997 = 0 AND id > 3000) AS ok FROM ev)
SELECT host, max(ts) AS mark FROM (SELECT *, bool_and(ok) OVER (PARTITION BY host ORDER BY ts, id ROWS UNBOUNDED PRECEDING) AS a FROM d)
WHERE a GROUP BY host""")
def delivery_watermark(spark, d):
    log = fx.monitoring_events(spark, d).select(
        "host", F.col("timestamp").alias("ts"), "id", (~((F.col("id") % 997 == 0) & (F.col("id") > 3000))).alias("ok"))
    return reg.delivery_watermark(log, "host").where("mark IS NOT NULL")


@query("""
SELECT CAST(n // 500 AS BIGINT) AS batch_no, min(id) AS first_id, max(id) AS last_id, count(*) AS events
FROM (SELECT event_id * (1 + event_id % 3) * 7 + event_id % 5 AS id, row_number() OVER (ORDER BY id) - 1 AS n FROM events) GROUP BY 1""")
def batch_ranges(spark, d):
    """All events, their ids stretched unevenly."""
    ids = fx.table(spark, d, "events").select(F.expr("event_id * (1 + event_id % 3) * 7 + event_id % 5").alias("id"))
    return reg.batch_ranges(ids, 500)


@query("SELECT * FROM ev WHERE id > (SELECT c FROM cut) ORDER BY id LIMIT 500", "cut")
def batch_head(spark, d):
    return reg.batch_head(fx.monitoring_events(spark, d), fx.cut_id(spark, d), 500)


@query('SELECT id, "timestamp", message FROM ev ORDER BY "timestamp", id')
def chrono_sort(spark, d):
    return reg.chrono_sort(fx.monitoring_events(spark, d)).select("id", "timestamp", "message")


@query("SELECT fingerprint, count(*) AS form_size FROM fp GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
def top_forms(spark, d):
    return reg.top_forms(fx.fingerprinted(spark, d))


@query("SELECT fingerprint, erstmals, klasse FROM reg WHERE bewertet_von IS DISTINCT FROM 'axel' "
       "ORDER BY erstmals DESC, fingerprint")
def review_queue(spark, d):
    return reg.newest_first(reg.review_awaiting(fx.register(spark, d), fx.FINAL_REVIEWER)).select(
        "fingerprint", "erstmals", "klasse")


@query(f"SELECT DISTINCT cleaner_ver, normalizer_ver FROM {MIXED} WHERE (cleaner_ver, normalizer_ver) <> (1, 2)")
def distinct_versions(spark, d):
    return mig.distinct_versions(_mixed_bridge(spark, d), RULES_V2)


@query("SELECT DISTINCT fingerprint FROM bridge")
def distinct_old_forms(spark, d):
    return mig.distinct_old_forms(fx.bridge(spark, d), (1, 1))


@query("""
SELECT "timestamp", message, min(id) AS id FROM (SELECT "timestamp", message, id FROM ev UNION ALL
 SELECT "timestamp", message, id + 10000000 FROM ev WHERE id % 3 = 0) GROUP BY 1, 2""")
def overlap_dedup(spark, d):
    """A third of the rows is sent a second time."""
    ev = fx.monitoring_events(spark, d)
    again = ev.where("id % 3 = 0").withColumn("id", F.col("id") + 10_000_000)
    return reg.overlap_dedup(ev.unionByName(again))


# --- quality ---------------------------------------------------------------

BROKEN_SQL = """(SELECT * REPLACE (
 CASE WHEN vorkommen % 7 = 1 THEN 'wichtig' ELSE klasse END AS klasse,
 CASE WHEN vorkommen % 7 = 2 THEN 'I-14' WHEN vorkommen % 7 = 3 THEN 'X-1' ELSE incident_typ END AS incident_typ,
 CASE WHEN vorkommen % 7 = 4 THEN 'bot' WHEN vorkommen % 7 = 5 THEN NULL ELSE bewertet_von END AS bewertet_von,
 CASE WHEN vorkommen % 7 = 6 THEN NULL ELSE host END AS host) FROM reg)"""


def _broken(spark, d):
    """Register with rows that break each rule, by count modulo seven."""
    v = F.col("vorkommen") % 7
    return fx.register(spark, d).withColumns({
        "klasse": F.when(v == 1, "wichtig").otherwise(F.col("klasse")),
        "incident_typ": F.when(v == 2, "I-14").when(v == 3, "X-1").otherwise(F.col("incident_typ")),
        "bewertet_von": F.when(v == 4, "bot").when(v != 5, F.col("bewertet_von")),
        "host": F.when(v != 6, F.col("host"))})


@query(f"SELECT fingerprint, klasse FROM {BROKEN_SQL} WHERE klasse NOT IN ('rauschen', 'betrieb', 'relevant', 'kritisch', 'unklar')")
def dq_klasse(spark, d):
    return dq.bad_klasse(_broken(spark, d))


@query(f"""SELECT fingerprint, incident_typ, incident_typ <> 'X-1' AS in_type_table FROM {BROKEN_SQL}
WHERE NOT regexp_full_match(incident_typ, 'I-(0[0-9]|1[0-3])')""")
def dq_incident_typ(spark, d):
    return dq.bad_incident_typ(_broken(spark, d), inc.incident_types(spark))


@query(f"SELECT fingerprint, bewertet_von FROM {BROKEN_SQL} WHERE bewertet_von <> 'axel' AND bewertet_von NOT LIKE 'llm:%'")
def dq_reviewer(spark, d):
    return dq.bad_reviewer(_broken(spark, d), fx.FINAL_REVIEWER)


@query(f"SELECT fingerprint, bewertet_am, bewertet_von FROM {BROKEN_SQL} WHERE (bewertet_am IS NULL) <> (bewertet_von IS NULL)")
def dq_review_pair(spark, d):
    return dq.bad_review_pair(_broken(spark, d))


@query("SELECT fingerprint, CAST(2 AS BIGINT) AS copies FROM reg WHERE vorkommen % 7 = 0")
def dq_register_pk(spark, d):
    rows = fx.register(spark, d)
    return dq.duplicate_keys(rows.unionByName(rows.where("vorkommen % 7 = 0")), "fingerprint")


@query("SELECT event_id, CAST(2 AS BIGINT) AS copies FROM bridge WHERE event_id % 97 = 0")
def dq_bridge_pk(spark, d):
    rows = fx.bridge(spark, d)
    return dq.duplicate_keys(rows.unionByName(rows.where("event_id % 97 = 0")), "event_id")


@query("SELECT fingerprint, count(*) AS events FROM bridge WHERE fingerprint IN "
       "(SELECT fingerprint FROM reg WHERE vorkommen % 5 = 0) GROUP BY 1")
def dq_bridge_fk(spark, d):
    return dq.orphan_forms(fx.bridge(spark, d), fx.register(spark, d).where("vorkommen % 5 <> 0"))


@query("SELECT event_id, fingerprint FROM bridge WHERE event_id % 83 = 0")
def dq_event_fk(spark, d):
    return dq.orphan_events(fx.bridge(spark, d), fx.monitoring_events(spark, d).where("id % 83 <> 0"))


@query(f"SELECT fingerprint, 'host' AS null_columns FROM {BROKEN_SQL} WHERE host IS NULL")
def dq_not_null(spark, d):
    return dq.missing_required(_broken(spark, d), "fingerprint", dq.REGISTER_REQUIRED)


@query("SELECT event_id, CASE WHEN event_id % 91 = 0 AND event_id % 89 = 0 THEN 'fingerprint,computed_at' "
       "WHEN event_id % 91 = 0 THEN 'fingerprint' ELSE 'computed_at' END AS null_columns "
       "FROM bridge WHERE event_id % 91 = 0 OR event_id % 89 = 0")
def dq_bridge_not_null(spark, d):
    """The bridge with some forms and computing times taken out."""
    bad = fx.bridge(spark, d).withColumns({
        "fingerprint": F.when(F.col("event_id") % 91 != 0, F.col("fingerprint")),
        "computed_at": F.when(F.col("event_id") % 89 != 0, F.col("computed_at"))})
    return dq.missing_required(bad, "event_id", dq.BRIDGE_REQUIRED)


@query("SELECT fingerprint, vorkommen, nullif(vorkommen - count(*) FILTER (event_id % 101 = 0), 0) AS bridge_rows "
       "FROM reg JOIN bridge USING (fingerprint) GROUP BY 1, 2 HAVING count(*) FILTER (event_id % 101 = 0) > 0")
def dq_register_counts(spark, d):
    return dq.count_mismatch(fx.register(spark, d), fx.bridge(spark, d).where("event_id % 101 <> 0"))


@query("SELECT CAST(id AS INTEGER) AS id, last_tick_at FROM (SELECT 1 + (row_number() OVER (ORDER BY tick) > 1)::INTEGER AS id, "
       "tick AS last_tick_at FROM ticks) WHERE id <> 1")
def dq_single_row(spark, d):
    """A heartbeat table that was appended to instead of updated."""
    ticks = fx.backlog_ticks(spark, d)
    first = ticks.agg(F.min("tick")).scalar()
    state = ticks.select(F.when(F.col("tick") == first, 1).otherwise(2).alias("id"), F.col("tick").alias("last_tick_at"))
    return dq.not_single_row(state)


def _rules_from_events(spark, d):
    """One rule per event type with domains broken by name."""
    kinds = fx.table(spark, d, "events").select("event_type").distinct()
    k = F.col("event_type")
    cells = {
        "rule_name": k, "incident_type": F.when(k == "view", "I-99").otherwise("I-01"),
        "mechanism": F.when(k == "click", "guess").otherwise("burst"),
        "base_severity": F.when(k == "error", "informational").otherwise("info"),
        "escalate_basis": F.when(k == "click", "days"), "escalate_to_severity": F.when(k == "signup", "fatal"),
        "reported_via": F.when(k == "purchase", "both").otherwise("old")}
    return kinds.select(*[c.alias(n) for n, c in cells.items()])


@query("""
SELECT rule_name, broken_column FROM (SELECT DISTINCT event_type AS rule_name FROM events) JOIN (VALUES
 ('view', 'incident_type'), ('click', 'mechanism'), ('error', 'base_severity'), ('click', 'escalate_basis'),
 ('signup', 'escalate_to_severity'), ('purchase', 'reported_via')) v(r, broken_column) ON r = rule_name""")
def dq_rule_config(spark, d):
    return dq.bad_rule_config(_rules_from_events(spark, d), inc.incident_types(spark))


# --- migration -------------------------------------------------------------

@query("SELECT old_fingerprint, new_fingerprint, count(*) OVER (PARTITION BY old_fingerprint) AS targets, events, "
       "erstmals, zuletzt FROM moves")
def migrate_targets(spark, d):
    return mig.migrate_targets(_moves(spark, d))


@query("SELECT * FROM outcome")
def migrate_outcome(spark, d):
    return mig.migrate_outcome(*_moves_and_register(spark, d))


@query("SELECT outcome, count(*) AS old_forms FROM outcome GROUP BY outcome")
def migrate_summary(spark, d):
    return mig.migrate_summary(mig.migrate_outcome(*_moves_and_register(spark, d)))


@query("SELECT old_fingerprint, count(*) AS targets, CAST(sum(events) AS BIGINT) AS events, 'dry-run' AS outcome "
       "FROM moves GROUP BY 1")
def migrate_dry_run(spark, d):
    return mig.dry_run(mig.moves_of(_moved(spark, d)))


@query("""
WITH a AS (SELECT new_fingerprint AS fingerprint, arg_min(host, first_id) AS host, arg_min(program, first_id) AS program,
 arg_min(cleaned, first_id) AS cleaned, min(erstmals) AS erstmals, max(zuletzt) AS zuletzt,
 CAST(sum(events) AS BIGINT) AS vorkommen FROM moves GROUP BY 1)
SELECT a.fingerprint, a.host, a.program, a.cleaned AS beispiel_roh, a.erstmals, a.zuletzt, a.vorkommen,
 1 AS cleaner_ver, 2 AS normalizer_ver,
 CASE WHEN NOT cleared THEN v.klasse END AS klasse, CASE WHEN NOT cleared THEN v.incident_typ END AS incident_typ,
 CASE WHEN NOT cleared THEN v.bewertet_am END AS bewertet_am, CASE WHEN NOT cleared THEN v.bewertet_von END AS bewertet_von,
 CASE WHEN v.target IS NULL THEN own.llm_vorschlag WHEN NOT cleared THEN v.llm_vorschlag END AS llm_vorschlag
FROM a LEFT JOIN verdict v ON v.target = a.fingerprint
LEFT JOIN src own ON own.old_fingerprint = a.fingerprint AND own.target = a.fingerprint""")
def migrate_register(spark, d):
    return mig.migrate_register(*_moves_and_register(spark, d), RULES_V2)


@query("SELECT event_id, new_fingerprint AS fingerprint, 1 AS cleaner_ver, 2 AS normalizer_ver, computed_at, bom_missing, "
       "bom_missing_unverified FROM bridge JOIN moved USING (event_id)")
def migrate_bridge(spark, d):
    return mig.migrate_bridge(fx.bridge(spark, d), _moved(spark, d), RULES_V2)


def _listing(word):
    return (f"SELECT o.old_fingerprint AS old_form, m.new_fingerprint AS target "
            f"FROM outcome o JOIN moves m USING (old_fingerprint) WHERE o.outcome = '{word}'")


@query(_listing("conflict"))
def migrate_conflicts(spark, d):
    moves, register = _moves_and_register(spark, d)
    return mig.migrate_listing(mig.migrate_outcome(moves, register), moves, "conflict")


@query(_listing("split_needs_review"))
def migrate_splits(spark, d):
    moves, register = _moves_and_register(spark, d)
    return mig.migrate_listing(mig.migrate_outcome(moves, register), moves, "split_needs_review")


@query("SELECT cleaner_ver, normalizer_ver, count(*) AS old_events FROM bridge GROUP BY 1, 2")
def migrate_from_version(spark, d):
    """The version found in the bridge and the events it covers; naming the
    current one gives nothing to do."""
    bridge = fx.bridge(spark, d)
    version = mig.old_version(bridge.select("cleaner_ver", "normalizer_ver"), RULES_V2)
    if version is None or mig.old_version(bridge, RULES_V2, (1, 2)) is not None:
        raise ValueError("unexpected version history")
    return bridge.where(mig.is_version(*version)).groupBy("cleaner_ver", "normalizer_ver").agg(
        F.count("*").alias("old_events"))
