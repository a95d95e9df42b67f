"""Registered queries over the incident rules and their evaluators."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from logloom.operators import incidents as inc
from logloom.session import materialize
from logloom.sources import collect

from . import fixtures as fx
from .queries import _parsed, query

FORMS = "(SELECT incident_typ AS c, count(*) AS forms FROM reg GROUP BY 1)"


def _forms(spark, d):
    # Written once: a join's null filter would move down to the events and work each of their forms out again.
    counted = fx.register(spark, d).groupBy(F.col("incident_typ").alias("_c")).agg(F.count("*").alias("forms"))
    return materialize(counted, "forms")


def _with_forms(df, spark, d, column):
    joined = df.join(_forms(spark, d), F.col(column) == F.col("_c"), "left").drop("_c")
    return joined.withColumn("forms", F.coalesce("forms", F.lit(0)))


# --- rule tables, with the forms of the register behind each type ----------

@query(f"SELECT code, label, coalesce(forms, 0) AS forms FROM types LEFT JOIN {FORMS} f ON f.c = code")
def incident_type_list(spark, d):
    seed = inc.incident_types(spark)
    stored = inc.insert_new(seed.where("code < 'I-05'"), seed, "code")
    return _with_forms(inc.insert_new(stored, seed, "code"), spark, d, "code")


RULE_LIST = ", ".join(c for c in inc.RULE_COLUMNS if c != "note")


@query(f"SELECT {RULE_LIST}, coalesce(forms, 0) AS forms FROM rules LEFT JOIN {FORMS} f ON f.c = incident_type")
def rule_config(spark, d):
    seed = inc.rule_config(spark)
    return _with_forms(inc.insert_new(seed, seed, "rule_name"), spark, d, "incident_type").drop("note")


@query(f"SELECT incident_type, count(*) AS rules, coalesce(any_value(forms), 0) AS forms FROM rules "
       f"LEFT JOIN {FORMS} f ON f.c = incident_type WHERE active GROUP BY 1")
def active_rules(spark, d):
    return _with_forms(inc.active_rules(inc.rule_config(spark)), spark, d, "incident_type")


SPLIT = "CASE WHEN coalesce(forms, 0) > 0 THEN 'new' ELSE 'old' END"


@query(f"SELECT {SPLIT} AS reported_via, count(*) AS rules FROM rules LEFT JOIN {FORMS} f ON f.c = incident_type GROUP BY 1")
def reported_via_split(spark, d):
    """Rules switched to the new path once their type has forms."""
    rules = _with_forms(inc.rule_config(spark), spark, d, "incident_type")
    moved = rules.withColumn("reported_via", F.when(F.col("forms") > 0, "new").otherwise(F.col("reported_via")))
    return inc.reported_via_split(moved)


@query(f"SELECT rule_name, incident_type, label, coalesce(forms, 0) AS forms FROM rules JOIN types ON code = incident_type "
       f"LEFT JOIN {FORMS} f ON f.c = incident_type")
def config_types(spark, d):
    return _with_forms(inc.config_types(inc.rule_config(spark), inc.incident_types(spark)), spark, d, "incident_type")


@query("""
SELECT id, incident_type, CASE incident_type
 WHEN 'I-01' THEN CASE f WHEN 0 THEN 'i01-c2' WHEN 1 THEN 'i01-usb' END
 WHEN 'I-02' THEN CASE f WHEN 0 THEN 'i02-default' WHEN 1 THEN 'i02-usb' END
 WHEN 'I-13' THEN CASE host WHEN 'DiskStation225' THEN 'i13-diskstation' WHEN 'FritzBox' THEN 'i13-fritzbox' ELSE 'i13-gesamtstille' END
 WHEN 'I-15' THEN 'i15' END AS rule_name
FROM (SELECT id, host, id % 3 AS f, CASE event_type WHEN 'view' THEN 'I-01' WHEN 'click' THEN 'I-02' WHEN 'error' THEN 'I-13'
  WHEN 'signup' THEN 'I-15' ELSE 'I-77' END AS incident_type FROM ke)""")
def rule_select(spark, d):
    kind = F.col("event_type")
    typ = (F.when(kind == "view", "I-01").when(kind == "click", "I-02").when(kind == "error", "I-13")
           .when(kind == "signup", "I-15").otherwise("I-77"))
    target = F.when(F.col("id") % 3 == 0, "Synology C2").when(F.col("id") % 3 == 1, "USBFestplatte")
    given = F.create_map(F.lit("host"), F.col("host"), F.lit("target"), target)
    rows = fx.keyed_events(spark, d).withColumn("incident_type", typ)
    return inc.select_rule(rows, inc.rule_config(spark), given).select("id", "incident_type", "rule_name")


# --- burst -----------------------------------------------------------------

def episodes_sql(source: str, key: str, silence: int | None) -> str:
    gap = "false" if silence is None else f"ts > p + INTERVAL {silence} MINUTE"
    return f"""SELECT *, sum(CASE WHEN p IS NULL OR {gap} THEN 1 ELSE 0 END) OVER (PARTITION BY {key} ORDER BY ts) AS ep
 FROM (SELECT *, lag(ts) OVER (PARTITION BY {key} ORDER BY ts) AS p FROM {source})"""


def burst_sql(source: str, key: str, threshold: int, window: int | None, silence: int | None,
              escalate: tuple[int, int | None] | None = None) -> str:
    def count(minutes):
        start = "UNBOUNDED PRECEDING" if minutes is None else f"INTERVAL {minutes} MINUTE PRECEDING"
        return f"count(*) OVER (PARTITION BY {key}, ep ORDER BY ts RANGE BETWEEN {start} AND CURRENT ROW)"
    base = f"SELECT *, {count(window)} AS n FROM ({episodes_sql(source, key, silence)})"
    opened = f"SELECT *, min(ts) FILTER (n >= {threshold}) OVER (PARTITION BY {key}, ep) AS o FROM ({base})"
    extra = ""
    if escalate:
        limit, minutes = escalate
        more = count(minutes) if minutes else (
            f"count(*) FILTER (ts >= o) OVER (PARTITION BY {key}, ep ORDER BY ts RANGE UNBOUNDED PRECEDING)")
        opened = f"SELECT *, {more} AS m FROM ({opened})"
        extra = f", min(ts) FILTER (ts >= o AND m >= {limit}) AS escalated_at"
    return (f"SELECT {key}, min(ts) AS episode, any_value(o) AS opened_at, max(ts) AS last_event, count(*) AS events{extra} "
            f"FROM ({opened}) WHERE o IS NOT NULL GROUP BY {key}, ep")


def _keyed(spark, d):
    return fx.keyed_events(spark, d)


@query(f"SELECT host, min(ts) AS episode, max(ts) AS last_event, count(*) AS events "
       f"FROM ({episodes_sql('ke', 'host', 120)}) GROUP BY host, ep")
def silence_episodes(spark, d):
    return inc.silence_episodes(_keyed(spark, d), ["host"], 120)


@query(burst_sql("ke", "host", 3, 15, 60))
def inc_burst(spark, d):
    return inc.burst(_keyed(spark, d), ["host"], 3, 15, 60)


@query(burst_sql("ke", "user_id", 20, None, None))
def inc_burst_unbounded(spark, d):
    """No window and no silence: the twentieth event of a key opens."""
    return inc.burst(_keyed(spark, d), ["user_id"], 20)


CLOSED = "CASE WHEN last_event + INTERVAL {0} MINUTE <= t THEN last_event + INTERVAL {0} MINUTE END"


@query(f"SELECT b.*, {CLOSED.format(90)} AS closed_at FROM ({burst_sql('ke', 'program', 2, 30, 90)}) b, last_ts")
def inc_autoclose(spark, d):
    found = inc.burst(_keyed(spark, d), ["program"], 2, 30, 90)
    return inc.autoclose(found, 90, fx.as_of(spark, d))


@query(f"SELECT * FROM ({burst_sql('ke', 'host', 2, 20, 60, (6, 120))}) UNION ALL BY NAME "
       f"SELECT * FROM ({burst_sql('ke', 'program', 2, 20, 60, (8, None))})")
def inc_escalate_occurrences(spark, d):
    """By host within two hours, by program since opening."""
    ev = _keyed(spark, d)
    return collect.union_events(inc.burst(ev, ["host"], 2, 20, 60, 6, 120),
                                inc.burst(ev, ["program"], 2, 20, 60, 8, None))


@query(f"""
SELECT host, opened_at, n AS incidents_in_window FROM (SELECT host, opened_at, count(*) OVER (PARTITION BY host ORDER BY opened_at
 RANGE BETWEEN INTERVAL 1440 MINUTE PRECEDING AND CURRENT ROW) AS n FROM ({burst_sql('ke', 'host', 2, 15, 30)})) WHERE n >= 3""")
def inc_escalate_incidents(spark, d):
    found = inc.burst(_keyed(spark, d), ["host"], 2, 15, 30)
    return inc.escalate_by_incidents(found, ["host"], 3, 1440)


def _rule_branch(rule, names=None):
    r, names = next(r for r in inc.RULES if r["rule_name"] == rule), names or BURST_RULES
    quiet = r.get("autoclose_silence_minutes")
    by_count = r.get("escalate_basis") == "occurrences"
    body = burst_sql(f"(SELECT * FROM ke WHERE id % {len(names)} = {names.index(rule)})", "host",
                     r.get("open_threshold_count", 1), r.get("open_window_minutes"), quiet,
                     (r["escalate_count"], r.get("escalate_window_minutes")) if by_count else None)
    escalated = "escalated_at" if by_count else "CAST(NULL AS TIMESTAMP)"
    severity = (f"CASE WHEN escalated_at IS NOT NULL THEN '{r['escalate_to_severity']}' ELSE '{r['base_severity']}' END"
                if by_count else f"'{r['base_severity']}'")
    return (f"SELECT '{rule}' AS rule_name, host, episode, opened_at, last_event, events, {escalated} AS escalated_at, "
            f"{CLOSED.format(quiet) if quiet else 'CAST(NULL AS TIMESTAMP)'} AS closed_at, {severity} AS severity FROM ({body}), last_ts")


BURST_RULES = tuple(sorted(r["rule_name"] for r in inc.RULES if r["mechanism"] == "burst" and r.get("active", True)))


@query(" UNION ALL ".join(map(_rule_branch, BURST_RULES)))
def inc_burst_rules(spark, d):
    """All active burst rules; every event is assigned to one of them by its id."""
    name = F.element_at(F.array(*map(F.lit, BURST_RULES)), (F.col("id") % len(BURST_RULES) + 1).cast("int"))
    return inc.burst_by_rules(_keyed(spark, d).withColumn("rule_name", name), inc.rule_config(spark), "host",
                              fx.as_of(spark, d))


# --- pair ------------------------------------------------------------------

PAIR = """
SELECT user_id, id AS start_id, ts AS opened_at, nxt AS closed_at FROM (
 SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, id) AS nxt FROM (
  SELECT *, lag(role) OVER (PARTITION BY user_id ORDER BY ts, id) AS before FROM ke WHERE role IS NOT NULL)
 WHERE role IS DISTINCT FROM before) WHERE role = 'start'"""


def _pairs(spark, d):
    return inc.pair(_keyed(spark, d), ["user_id"])


@query(PAIR)
def inc_pair(spark, d):
    return _pairs(spark, d)


@query(f"SELECT * FROM ({PAIR}) WHERE closed_at IS NULL OR closed_at > opened_at + INTERVAL 6 HOUR")
def inc_pair_delay(spark, d):
    return inc.without_short(_pairs(spark, d), 6 * 3600)


@query(f"SELECT p.*, CASE WHEN coalesce(closed_at, t) > opened_at + INTERVAL 1440 MINUTE THEN opened_at + INTERVAL 1440 MINUTE END "
       f"AS overdue_at FROM ({PAIR}) p, last_ts")
def inc_pair_overdue(spark, d):
    return inc.overdue(_pairs(spark, d), 1440, fx.as_of(spark, d))


@query(f"""
SELECT user_id, min(opened_at) AS incident_opened_at, CASE WHEN count(*) = count(closed_at) THEN max(closed_at) END AS incident_closed_at,
 count(*) AS openings FROM (SELECT *, sum(CASE WHEN c IS NULL OR opened_at > c + INTERVAL 720 MINUTE THEN 1 ELSE 0 END)
  OVER (PARTITION BY user_id ORDER BY opened_at) AS g
  FROM (SELECT *, lag(closed_at) OVER (PARTITION BY user_id ORDER BY opened_at) AS c FROM ({PAIR}))) GROUP BY user_id, g""")
def inc_pair_reopen(spark, d):
    return inc.reopen(_pairs(spark, d), ["user_id"], 720)


@query(f"""
SELECT user_id, opened_at, closed_at, m AS open_minutes, CASE WHEN m >= 30 THEN 'error' WHEN m >= 5 THEN 'warning' ELSE 'info' END AS severity
FROM (SELECT *, date_diff('microsecond', opened_at, coalesce(closed_at, t)) // 60000000 AS m FROM ({PAIR}), last_ts)""")
def inc_severity_duration(spark, d):
    pairs = _pairs(spark, d).withColumn("rule_name", F.lit("i03"))
    return inc.severity_by_duration(pairs, inc.rule_config(spark), fx.as_of(spark, d)).select(
        "user_id", "opened_at", "closed_at", "open_minutes", "severity")


@query(f"""
SELECT r AS rule_name, user_id, opened_at, closed_at, r = 'i01-c2' AS needs_ack, closed_at IS NOT NULL AND r <> 'i08' AS close_notice
FROM (SELECT *, CASE user_id % 3 WHEN 0 THEN 'i01-c2' WHEN 1 THEN 'i03' ELSE 'i08' END AS r FROM ({PAIR}))
WHERE r = 'i01-c2' OR (closed_at IS NOT NULL AND r <> 'i08')""")
def inc_ack_notify(spark, d):
    third = F.col("user_id") % 3
    name = F.when(third == 0, "i01-c2").when(third == 1, "i03").otherwise("i08")
    pairs = _pairs(spark, d).select(name.alias("rule_name"), "user_id", "opened_at", "closed_at")
    return inc.ack_notify(pairs, inc.rule_config(spark))


def _rules_with(**fields):
    return sorted((r for r in inc.RULES if r.get("active", True) and all(
        (r.get(k) is not None) if v is None else r.get(k) == v for k, v in fields.items())), key=lambda r: r["rule_name"])


def _assigned(names, source):
    listed = ", ".join(f"'{n}'" for n in names)
    return f"(SELECT *, ([{listed}])[CAST(id % {len(names)} AS INTEGER) + 1] AS rule_name FROM {source})"


def _by_id(ev, rules):
    names = F.array(*[F.lit(r["rule_name"]) for r in rules])
    return ev.withColumn("rule_name", F.element_at(names, (F.col("id") % len(rules) + 1).cast("int")))


PAIR_RULES = _rules_with(mechanism="pair")


def _severity_case(rule):
    steps = sorted(((int(k), v) for k, v in json.loads(rule.get("severity_by_duration") or "{}").items()), reverse=True)
    cases = " ".join(f"WHEN m >= {k} THEN '{v}'" for k, v in steps)
    return f"WHEN '{rule['rule_name']}' THEN " + (f"CASE {cases} ELSE '{rule['base_severity']}' END" if cases
                                                 else f"'{rule['base_severity']}'")


def _limit_case(rules, column):
    cases = " ".join(f"WHEN '{r['rule_name']}' THEN {r[column]}" for r in rules if r.get(column))
    return f"CASE rule_name {cases} END" if cases else "CAST(NULL AS INTEGER)"


def _pair_rules_sql(rules, key, source):
    """Pair rules in the words of the rule table: silence, delay, grace, longest opening, severity by duration."""
    def limit(column):
        return f"to_minutes({_limit_case(rules, column)})"
    return f"""
WITH r AS (SELECT *, lag(ts) OVER (PARTITION BY rule_name, {key} ORDER BY ts) AS p FROM {source} WHERE role IS NOT NULL),
e AS (SELECT *, sum(CASE WHEN p IS NULL OR ts > p + {limit("autoclose_silence_minutes")} THEN 1 ELSE 0 END)
 OVER (PARTITION BY rule_name, {key} ORDER BY ts) AS ep FROM r),
p AS (SELECT rule_name, {key}, id AS start_id, ts AS opened_at,
  coalesce(nxt, CASE WHEN last + {limit("autoclose_silence_minutes")} <= t THEN last + {limit("autoclose_silence_minutes")} END) AS closed_at
 FROM (SELECT *, lead(ts) OVER w AS nxt FROM (SELECT *, lag(role) OVER (PARTITION BY rule_name, {key}, ep ORDER BY ts, id) AS before,
   max(ts) OVER (PARTITION BY rule_name, {key}, ep) AS last FROM e) WHERE role IS DISTINCT FROM before
  WINDOW w AS (PARTITION BY rule_name, {key}, ep ORDER BY ts, id)), last_ts WHERE role = 'start'),
d AS (SELECT *, lag(closed_at) OVER (PARTITION BY rule_name, {key} ORDER BY opened_at, start_id) AS c FROM p
 WHERE closed_at IS NULL OR closed_at > opened_at + to_seconds(coalesce({_limit_case(rules, "open_delay_seconds")}, -1))),
g AS (SELECT *, sum(CASE WHEN opened_at <= c + {limit("pair_reopen_grace_minutes")} THEN 0 ELSE 1 END)
 OVER (PARTITION BY rule_name, {key} ORDER BY opened_at, start_id) AS part FROM d),
m AS (SELECT rule_name, {key}, min_by(start_id, struct_pack(a := opened_at, b := start_id)) AS start_id, min(opened_at) AS opened_at,
 CASE WHEN count(*) = count(closed_at) THEN max(closed_at) END AS closed_at FROM g GROUP BY rule_name, {key}, part),
q AS (SELECT *, opened_at + {limit("max_open_minutes")} AS due,
 date_diff('microsecond', opened_at, coalesce(closed_at, t)) // 60000000 AS m FROM m, last_ts)
SELECT rule_name, {key}, start_id, opened_at, closed_at, CASE WHEN coalesce(closed_at, t) > due THEN due END AS overdue_at,
 CASE rule_name {" ".join(map(_severity_case, rules))} END AS severity FROM q"""


@query(_pair_rules_sql(PAIR_RULES, "user_id", _assigned([r["rule_name"] for r in PAIR_RULES], "ke")))
def inc_pair_rules(spark, d):
    """All active pair rules; every event is assigned to one of them by its id."""
    return inc.pair_by_rules(_by_id(_keyed(spark, d), PAIR_RULES), inc.rule_config(spark), "user_id", fx.as_of(spark, d))


# --- absence, rate, value --------------------------------------------------

#: One more rule than the shipped ones: any host, among them one that never speaks.
SILENT_HOST = dict(rule_name="x-any-host", incident_type="I-13", match_field="host", mechanism="absence",
                   base_severity="info", severity_by_duration='{"60": "warning"}', expected_every_minutes=90)
TYPE_OF_KE = "CASE event_type WHEN 'click' THEN 'I-12' WHEN 'error' THEN 'I-13' END"


def _silence_sql(rule, who, heard):
    """Silences of one rule in the words of the rule: ``who`` lists the keys, ``heard`` the events each of them is heard by."""
    steps = sorted(((int(k), v) for k, v in json.loads(rule.get("severity_by_duration") or "{}").items()), reverse=True)
    cases = " ".join(f"WHEN m >= {k} THEN '{v}'" for k, v in steps)
    severity = f"CASE {cases} ELSE '{rule['base_severity']}' END" if cases else f"'{rule['base_severity']}'"
    every = f"INTERVAL {rule['expected_every_minutes']} MINUTE"
    return f"""
SELECT '{rule["rule_name"]}' AS rule_name, key, last_event, opened_at, closed_at, {severity} AS severity FROM (
 SELECT key, CASE WHEN spoke THEN ts END AS last_event, ts + {every} AS opened_at, nxt AS closed_at,
  date_diff('microsecond', ts + {every}, coalesce(nxt, t)) // 60000000 AS m
 FROM (SELECT *, lead(ts) OVER (PARTITION BY key ORDER BY ts, spoke) AS nxt FROM (
   SELECT DISTINCT key, ts, true AS spoke FROM ({heard}) UNION ALL SELECT key, (SELECT min(ts) FROM ke), false FROM ({who}))), last_ts
 WHERE coalesce(nxt, t) > ts + {every})"""


def _absence_rule_sql(rule):
    if rule["mechanism"] != "absence":
        kind = rule["incident_type"]
        return _silence_sql(rule, f"SELECT '{kind}' AS key", f"SELECT '{kind}' AS key, ts FROM ke WHERE {TYPE_OF_KE} = '{kind}'")
    if rule.get("match_value"):
        value = rule["match_value"]
        return _silence_sql(rule, f"SELECT '{value}' AS key", f"SELECT host AS key, ts FROM ke WHERE host = '{value}'")
    if rule.get("match_field"):
        return _silence_sql(rule, "SELECT DISTINCT host AS key FROM ke UNION ALL SELECT 'NeverSeen'", "SELECT host AS key, ts FROM ke")
    return _silence_sql(rule, "SELECT 'all' AS key", "SELECT 'all' AS key, ts FROM ke")


ABSENCE_RULES = [*_rules_with(expected_every_minutes=None), SILENT_HOST]


@query(" UNION ALL ".join(map(_absence_rule_sql, ABSENCE_RULES)))
def inc_absence_rules(spark, d):
    """All rules with an expected interval, each over its own scope: the whole stream, a host, an incident type, any host."""
    since = fx.table(spark, d, "events").agg(F.min("ts")).scalar()
    return inc.absence_by_rules(_typed(spark, d), inc.rule_config(spark, (*inc.RULES, SILENT_HOST)), _host_field(),
                                since, fx.as_of(spark, d), _expected_hosts(spark, d))


def _host_field():
    return F.create_map(F.lit("host"), F.col("host"))


def _typed(spark, d):
    kind = F.col("event_type")
    return _keyed(spark, d).withColumn("incident_type", F.when(kind == "click", "I-12").when(kind == "error", "I-13"))


def _expected_hosts(spark, d):
    hosts = _keyed(spark, d).select(F.lit("host").alias("scope"), F.col("host").alias("value")).distinct()
    return hosts.union(spark.createDataFrame([("host", "NeverSeen")], "scope string, value string"))


def absence_sql(key: str, minutes: int) -> str:
    part = f"PARTITION BY {key}" if key else ""
    head = key or "'all' AS host"
    return (f"SELECT {head}, ts AS last_event, ts + INTERVAL {minutes} MINUTE AS opened_at, nxt AS closed_at "
            f"FROM (SELECT *, lead(ts) OVER ({part} ORDER BY ts, id) AS nxt FROM ke), last_ts "
            f"WHERE coalesce(nxt, t) > ts + INTERVAL {minutes} MINUTE")


@query(f"{absence_sql('host', 100)} UNION ALL {absence_sql('', 20)}")
def inc_absence(spark, d):
    """Per host, and over the whole stream."""
    ev, now = _keyed(spark, d), fx.as_of(spark, d)
    stream = inc.absence(ev, [], 20, now).withColumn("host", F.lit("all"))
    return inc.absence(ev, ["host"], 100, now).unionByName(stream)


EXPECTED_SQL = """
WITH s AS (SELECT ts, CASE WHEN id % 3 = 0 THEN 'Synology C2' WHEN id % 3 = 1 THEN 'USBFestplatte' ELSE 'paperless-ngx' END AS target
 FROM ke WHERE event_type = 'view'),
dd AS (SELECT rule_name, match_value AS target, CAST(day AS DATE) AS day,
 (CAST(day AS DATE) + CAST(expected_at_local AS TIME)) AT TIME ZONE timezone AT TIME ZONE 'UTC' AS due_at
 FROM (SELECT rule_name, match_value, expected_at_local, timezone,
  unnest(range(date_trunc('day', lo AT TIME ZONE 'UTC' AT TIME ZONE timezone), hi AT TIME ZONE 'UTC' AT TIME ZONE timezone, INTERVAL 1 DAY)) AS day
  FROM rules, (SELECT min(ts) AS lo, max(ts) + INTERVAL 1 MICROSECOND AS hi FROM events) WHERE expected_at_local IS NOT NULL))
SELECT rule_name, target, day, due_at, due_at + INTERVAL 30 MINUTE AS late_at FROM dd, last_ts
WHERE due_at + INTERVAL 30 MINUTE <= t AND NOT EXISTS (SELECT 1 FROM s WHERE s.target = dd.target AND s.ts >= due_at AND s.ts < due_at + INTERVAL 30 MINUTE)"""


def _starts(spark, d):
    third = F.col("id") % 3
    target = F.when(third == 0, "Synology C2").when(third == 1, "USBFestplatte").otherwise("paperless-ngx")
    return _keyed(spark, d).where("event_type = 'view'").select("ts", target.alias("target"))


@query(EXPECTED_SQL)
def inc_expected_at(spark, d):
    since = fx.table(spark, d, "events").agg(F.min("ts")).scalar()
    return inc.expected_at(_starts(spark, d), inc.rule_config(spark), since, fx.as_of(spark, d))


RATE_SQL = """
WITH c AS (SELECT host, date_trunc('hour', ts) AS hour, count(*) AS n FROM {0} GROUP BY 1, 2),
a AS (SELECT host, unnest(generate_series(min(hour), max(hour), INTERVAL 1 HOUR)) AS hour FROM c GROUP BY host),
h AS (SELECT host, hour, coalesce(n, 0) AS events FROM a LEFT JOIN c USING (host, hour)),
m AS (SELECT *, quantile_cont(events, 0.5) OVER (PARTITION BY host ORDER BY hour RANGE BETWEEN INTERVAL 336 HOUR PRECEDING
 AND INTERVAL 1 HOUR PRECEDING) AS median FROM h)
SELECT host, hour, events, CAST(median AS DOUBLE) AS median, coalesce(events > median * 1.5, false) AS alarm FROM m"""


@query(RATE_SQL.format("ke"))
def inc_rate(spark, d):
    return inc.rate(_keyed(spark, d), "host", 1.5)


@query("SELECT id, host, value FROM ke WHERE value < 8.0")
def inc_value_threshold(spark, d):
    return inc.below_limit(_keyed(spark, d), "value", 8.0).select("id", "host", "value")


@query("""
SELECT id, priority, CASE WHEN priority IN ('emergency', 'alert', 'critical') THEN 'I-00-CRIT' ELSE 'I-00' END AS incident_type
FROM parsed WHERE program <> 'System' AND NOT (program = 'Connection' AND id % 2 = 0)""")
def inc_catch_all(spark, d):
    """No type, a type without rules, and a type whose rules all ask for another value."""
    program = F.col("program")
    typ = F.when(program == "System", "I-14").when(program == "Connection", "I-10").when(
        program == "EventLog-1", "I-99")
    origin = F.when(F.col("id") % 2 == 0, "foreign").otherwise("unknown")
    rows = _parsed(spark, d).select("id", "priority", typ.alias("incident_type"), origin.alias("origin"))
    chosen = inc.select_rule(rows, inc.rule_config(spark), F.create_map(F.lit("ip_class"), F.col("origin")))
    return inc.catch_all(chosen).select("id", "priority", "incident_type")


# --- all rules in one table ------------------------------------------------

#: One more rule: pairs that continue within a grace and escalate by incidents of any age.
REOPENED = dict(rule_name="x-reopen", incident_type="I-03", mechanism="pair", base_severity="info", max_open_minutes=600,
                pair_reopen_grace_minutes=240, escalate_count=5, escalate_basis="incidents", escalate_to_severity="error")
ALL_RULES = [*inc.RULES, SILENT_HOST, REOPENED]
PAIRED = [*PAIR_RULES, REOPENED]
#: Rules that events are assigned to, by their id.
OWNED = [*BURST_RULES, *[r["rule_name"] for r in PAIRED], "i15"]


def _all_rules_sql():
    none = "CAST(NULL AS TIMESTAMP)"
    bursts = " UNION ALL ".join(_rule_branch(r, OWNED) for r in BURST_RULES)
    pairs = _pair_rules_sql(PAIRED, "host", f"(SELECT * FROM {_assigned(OWNED, 'ke')} WHERE rule_name IN "
                            f"({', '.join(repr(r['rule_name']) for r in PAIRED)}))")
    absences = " UNION ALL ".join(map(_absence_rule_sql, ABSENCE_RULES))
    rates = RATE_SQL.format(f"(SELECT * FROM ke WHERE id % {len(OWNED)} = {OWNED.index('i15')})")
    counted = [r | {"_n": r["escalate_count"]} for r in ALL_RULES if r.get("escalate_basis") == "incidents"]
    # A rule without a window counts incidents of any age: a window longer than the data.
    windows = [r | {"_w": r.get("escalate_window_minutes") or 10**7} for r in counted]
    base = " ".join(map(_severity_case, ALL_RULES))
    raised = " ".join(f"WHEN '{r['rule_name']}' THEN '{r['escalate_to_severity']}'" for r in ALL_RULES if r.get("escalate_to_severity"))
    order = "['info', 'warning', 'error', 'critical']"
    return f"""
WITH f AS (
 SELECT rule_name, 'burst' AS kind, host AS key, opened_at, closed_at, escalated_at AS e, {none} AS overdue_at FROM ({bursts})
 UNION ALL SELECT rule_name, 'pair', host, opened_at, closed_at, {none}, overdue_at FROM ({pairs})
 UNION ALL SELECT rule_name, 'absence', key, opened_at, closed_at, {none}, {none} FROM ({absences})
 UNION ALL SELECT rule_name, 'expected', target, late_at, {none}, {none}, {none} FROM ({EXPECTED_SQL})
 UNION ALL SELECT 'i15', 'rate', host, hour, CASE WHEN hour + INTERVAL 1 HOUR <= t THEN hour + INTERVAL 1 HOUR END, {none}, {none}
  FROM ({rates}), last_ts WHERE alarm),
n AS (SELECT *, (SELECT count(*) FROM f g WHERE g.rule_name = f.rule_name AND g.kind = f.kind AND g.key = f.key
 AND g.opened_at <= f.opened_at AND g.opened_at >= f.opened_at - to_minutes({_limit_case(windows, "_w")})) AS opened FROM f),
x AS (SELECT *, coalesce(e, CASE WHEN opened >= {_limit_case(counted, "_n")} THEN opened_at END) AS escalated_at,
 date_diff('microsecond', opened_at, coalesce(closed_at, t)) // 60000000 AS m FROM n, last_ts),
s AS (SELECT *, CASE rule_name {base} END AS by_time, CASE WHEN escalated_at IS NOT NULL THEN CASE rule_name {raised} END END AS up FROM x)
SELECT rule_name, kind, key, opened_at, closed_at, overdue_at, escalated_at,
 CASE WHEN coalesce(list_position({order}, up), 0) > list_position({order}, by_time) THEN up ELSE by_time END AS severity FROM s"""


@query(_all_rules_sql())
def inc_rules(spark, d):
    """All rules over the same events, in one table."""
    names = F.element_at(F.array(*map(F.lit, OWNED)), (F.col("id") % len(OWNED) + 1).cast("int"))
    since = fx.table(spark, d, "events").agg(F.min("ts")).scalar()
    return inc.incidents_by_rules(_typed(spark, d).withColumn("rule_name", names), inc.rule_config(spark, ALL_RULES), "host",
                                  _host_field(), _starts(spark, d), since, fx.as_of(spark, d), _expected_hosts(spark, d), 1.5)
