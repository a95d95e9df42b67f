"""Incident rules: table, assignment, and one evaluator per mechanism."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logloom.functions.syslog import rule_severity
from logloom.session import materialize

from . import timeline as tl

# --- rule tables -----------------------------------------------------------

# Incident types.
INCIDENT_TYPES = (
    ("I-00", "Auffangtyp"),
    ("I-00-CRIT", "Kritisches Rohereignis ohne Klassifikation"),
    ("I-01", "Backup-Lauf"),
    ("I-02", "Integritaetspruefung"),
    ("I-03", "Repeater-Backhaul unterbrochen"),
    ("I-04", "DFS-Radar auf 5 GHz"),
    ("I-05", "Backhaul-Bandbreite herabgesetzt"),
    ("I-06", "WLAN-Anmeldefehler"),
    ("I-07", "Syslog-Ingest gestoert"),
    ("I-08", "n8n-Datenbankfehler"),
    ("I-09", "n8n-Neustart"),
    ("I-10", "Fehlgeschlagene Anmeldung DiskStation"),
    ("I-11", "DSM-Paketaktualisierung"),
    ("I-12", "Internet- / DDNS-Stoerung"),
    ("I-13", "Ueberwachung ausgefallen (Watchdog)"),
    ("I-14", "DSM-Berechtigungsaenderung"),
    ("I-15", "Ratenanomalie je Host"),
)

RULE_SCHEMA = (
    "rule_name string, incident_type string, match_field string, match_value string, mechanism string, "
    "base_severity string, open_threshold_count int, open_window_minutes int, open_delay_seconds int, "
    "escalate_count int, escalate_window_minutes int, escalate_basis string, escalate_to_severity string, "
    "severity_by_duration string, max_open_minutes int, autoclose_silence_minutes int, "
    "expected_every_minutes int, expected_at_local string, timezone string, pair_reopen_grace_minutes int, "
    "require_ack boolean, notify_on_close boolean, reported_via string, live_activity boolean, "
    "active boolean, note string"
)
RULE_COLUMNS = tuple(c.split()[0] for c in RULE_SCHEMA.split(", "))

# The shipped rules, only what differs from the defaults below.
_BACKUP = '{"30": "warning", "240": "error"}'
_WATCHDOG = '{"360": "warning", "720": "error"}'
RULES = (
    dict(rule_name="i01-c2", incident_type="I-01", match_field="target", match_value="Synology C2",
         mechanism="pair", base_severity="warning", escalate_count=2, escalate_window_minutes=4320,
         escalate_basis="incidents", escalate_to_severity="critical", severity_by_duration=_BACKUP,
         max_open_minutes=25, expected_at_local="03:00", require_ack=True, notify_on_close=True),
    dict(rule_name="i01-usb", incident_type="I-01", match_field="target", match_value="USBFestplatte",
         mechanism="pair", base_severity="warning", escalate_count=2, escalate_window_minutes=4320,
         escalate_basis="incidents", escalate_to_severity="critical", severity_by_duration=_BACKUP,
         max_open_minutes=90, expected_at_local="04:00", require_ack=True, notify_on_close=True),
    dict(rule_name="i01-paperless", incident_type="I-01", match_field="target", match_value="paperless-ngx",
         mechanism="pair", base_severity="warning", escalate_count=2, escalate_window_minutes=4320,
         escalate_basis="incidents", escalate_to_severity="critical", severity_by_duration=_BACKUP,
         max_open_minutes=20, expected_at_local="01:55", require_ack=True, notify_on_close=True),
    dict(rule_name="i02-usb", incident_type="I-02", match_field="target", match_value="USBFestplatte",
         mechanism="pair", base_severity="error", max_open_minutes=180, require_ack=True, notify_on_close=True),
    dict(rule_name="i02-default", incident_type="I-02", match_field="target",
         mechanism="pair", base_severity="error", max_open_minutes=30, require_ack=True, notify_on_close=True),
    dict(rule_name="i03", incident_type="I-03", mechanism="pair", base_severity="info", open_delay_seconds=5,
         escalate_count=4, escalate_window_minutes=1440, escalate_basis="incidents",
         escalate_to_severity="error", severity_by_duration='{"5": "warning", "30": "error"}',
         notify_on_close=True),
    dict(rule_name="i04", incident_type="I-04", mechanism="pair", base_severity="info", escalate_count=3,
         escalate_window_minutes=10080, escalate_basis="incidents", escalate_to_severity="warning",
         autoclose_silence_minutes=60, notify_on_close=True),
    dict(rule_name="i05-5ghz", incident_type="I-05", match_field="channel", match_value="5GHz",
         mechanism="burst", base_severity="warning"),
    dict(rule_name="i05-24ghz", incident_type="I-05", match_field="channel", match_value="2.4GHz",
         mechanism="burst", base_severity="warning"),
    dict(rule_name="i06-client", incident_type="I-06", mechanism="burst", base_severity="warning",
         open_threshold_count=5, open_window_minutes=15, escalate_count=15, escalate_window_minutes=60,
         escalate_basis="occurrences", escalate_to_severity="warning", autoclose_silence_minutes=60),
    dict(rule_name="i06-repeater", incident_type="I-06", mechanism="burst", base_severity="warning",
         open_threshold_count=2, open_window_minutes=30),
    dict(rule_name="i07", incident_type="I-07", mechanism="burst", base_severity="warning",
         open_threshold_count=10, open_window_minutes=5, escalate_count=100, escalate_basis="occurrences",
         escalate_to_severity="error", autoclose_silence_minutes=15),
    dict(rule_name="i08", incident_type="I-08", mechanism="burst", base_severity="warning",
         open_threshold_count=1, escalate_count=3, escalate_window_minutes=1440, escalate_basis="incidents",
         escalate_to_severity="error", autoclose_silence_minutes=30),
    dict(rule_name="i09", incident_type="I-09", mechanism="pair", base_severity="warning", escalate_count=3,
         escalate_window_minutes=360, escalate_basis="incidents", escalate_to_severity="error",
         max_open_minutes=10, notify_on_close=True),
    dict(rule_name="i10-internal", incident_type="I-10", match_field="ip_class", match_value="internal",
         mechanism="burst", base_severity="info", open_threshold_count=5, open_window_minutes=10,
         escalate_count=10, escalate_window_minutes=30, escalate_basis="occurrences",
         escalate_to_severity="warning", autoclose_silence_minutes=120),
    dict(rule_name="i10-foreign", incident_type="I-10", match_field="ip_class", match_value="foreign",
         mechanism="burst", base_severity="warning", open_threshold_count=1, escalate_count=3,
         escalate_window_minutes=60, escalate_basis="occurrences", escalate_to_severity="critical",
         require_ack=True),
    dict(rule_name="i10-timemachine-smb", incident_type="I-10", match_field="ip_class",
         match_value="timemachine-smb", mechanism="burst", base_severity="info"),
    dict(rule_name="i11", incident_type="I-11", mechanism="pair", base_severity="error",
         open_window_minutes=15, max_open_minutes=30, notify_on_close=True),
    dict(rule_name="i12", incident_type="I-12", mechanism="pair", base_severity="info", escalate_count=2,
         escalate_window_minutes=30, escalate_basis="incidents", escalate_to_severity="warning",
         autoclose_silence_minutes=360, expected_every_minutes=2160, notify_on_close=True),
    dict(rule_name="i13-diskstation", incident_type="I-13", match_field="host", match_value="DiskStation225",
         mechanism="absence", base_severity="warning", severity_by_duration=_WATCHDOG,
         expected_every_minutes=360, notify_on_close=True),
    dict(rule_name="i13-fritzbox", incident_type="I-13", match_field="host", match_value="FritzBox",
         mechanism="absence", base_severity="warning", severity_by_duration=_WATCHDOG,
         expected_every_minutes=720, notify_on_close=True),
    dict(rule_name="i13-gesamtstille", incident_type="I-13", mechanism="absence", base_severity="warning",
         severity_by_duration=_WATCHDOG, expected_every_minutes=120, notify_on_close=True),
    dict(rule_name="i14", incident_type="I-14", mechanism="burst", base_severity="info",
         open_threshold_count=1, open_window_minutes=15, autoclose_silence_minutes=30, require_ack=True),
    dict(rule_name="i15", incident_type="I-15", match_field="host", mechanism="rate", base_severity="warning"),
    dict(rule_name="i00", incident_type="I-00", mechanism="burst", base_severity="info"),
    dict(rule_name="i00-crit", incident_type="I-00-CRIT", mechanism="burst", base_severity="critical",
         autoclose_silence_minutes=60),
)
_DEFAULTS = dict(timezone="Europe/Berlin", require_ack=False, notify_on_close=False, reported_via="old",
                 live_activity=False, active=True)


def rule_values(**fields) -> tuple:
    """One rule as a row; what is not given is the column's default."""
    row = _DEFAULTS | fields
    return tuple(row.get(c) for c in RULE_COLUMNS)


def incident_types(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(INCIDENT_TYPES), "code string, label string")


def rule_config(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame([rule_values(**r) for r in rules], RULE_SCHEMA)


def insert_new(stored: DataFrame, seed: DataFrame, key: str) -> DataFrame:
    """Stored rows plus seed rows with a new key; inserting again is a no-op."""
    return stored.unionByName(seed.join(stored.select(key), key, "left_anti"))


def active_rules(rules: DataFrame) -> DataFrame:
    return rules.where("active").groupBy("incident_type").agg(F.count("*").alias("rules"))


def reported_via_split(rules: DataFrame) -> DataFrame:
    return rules.groupBy("reported_via").agg(F.count("*").alias("rules"))


def config_types(rules: DataFrame, types: DataFrame) -> DataFrame:
    return rules.join(types, rules["incident_type"] == types["code"]).select("rule_name", "incident_type", "label")


def select_rule(events: DataFrame, rules: DataFrame, fields: Column) -> DataFrame:
    """Adds ``rule_name``, null where no active rule of the event's
    ``incident_type`` fits.

    ``fields`` maps field names to the event's values.  A rule with a value
    needs equality; one with only a field needs the field to be present; one
    with neither takes the whole stream.  The most specific rule wins, then
    the first by name.

    Which rule wins depends on type and fields alone, so it is found once per
    distinct combination: each lists the keys that a rule may have for it,
    keys meet rules as rows, and the best match is a partial minimum.  No row
    grows with the number of rules.
    """
    given = F.array_sort(F.filter(F.map_entries(fields), lambda e: e["value"].isNotNull()))
    events = events.withColumn("_given", F.coalesce(given, F.array().cast("array<struct<key:string,value:string>>")))

    def key(rank: int, field: Column, value: Column) -> Column:
        return F.struct(F.lit(rank).alias("rank"), field.alias("field"), value.alias("value"))

    none = F.lit(None).cast("string")
    keys = F.concat(F.transform("_given", lambda e: key(1, e["key"], e["value"])),
                    F.transform("_given", lambda e: key(2, e["key"], none)), F.array(key(3, none, none)))
    value, whole = F.col("match_value").isNotNull(), F.col("match_field").isNull()
    named = rules.where("active").groupBy(
        "incident_type", F.when(whole, 3).when(value, 1).otherwise(2).alias("rank"),
        F.coalesce("match_field", F.lit("")).alias("field"),
        F.coalesce(F.when(~whole, F.col("match_value")), F.lit("")).alias("value")).agg(F.min("rule_name").alias("rule"))
    combos = events.select("incident_type", "_given").distinct()
    wanted = combos.select("incident_type", "_given", F.explode(keys).alias("k")).select(
        "incident_type", "_given", "k.rank", *[F.coalesce(f"k.{c}", F.lit("")).alias(c) for c in ("field", "value")])
    best = (wanted.join(named, ["incident_type", "rank", "field", "value"]).groupBy("incident_type", "_given")
            .agg(F.min(F.struct("rank", "rule"))["rule"].alias("rule_name")))
    return events.join(best, ["incident_type", "_given"], "left").drop("_given")


# --- severities ------------------------------------------------------------

def severity_at(steps_json: Column, elapsed_minutes: Column, base: Column) -> Column:
    """Severity of the highest step at or below the elapsed minutes."""
    steps = F.transform(F.map_entries(F.from_json(steps_json, "map<string,string>")),
                        lambda e: F.struct(e["key"].cast("int").alias("m"), e["value"].alias("s")))
    reached = F.array_max(F.filter(steps, lambda e: e["m"] <= elapsed_minutes))
    return F.coalesce(reached["s"], base)


def elapsed_minutes(start: Column, end: Column) -> Column:
    return F.floor(F.timestamp_diff("SECOND", start, end) / 60)


def severity_by_duration(incidents: DataFrame, rules: DataFrame, as_of: Column) -> DataFrame:
    """Severity an incident has reached when it closed, or at ``as_of``."""
    steps = rules.select("rule_name", "base_severity", "severity_by_duration")
    lasted = elapsed_minutes(F.col("opened_at"), F.coalesce("closed_at", as_of))
    return incidents.join(steps, "rule_name").withColumn("open_minutes", lasted).withColumn(
        "severity", severity_at(F.col("severity_by_duration"), F.col("open_minutes"), F.col("base_severity"))
    ).drop("base_severity", "severity_by_duration")


# --- burst -----------------------------------------------------------------

def silence_episodes(events: DataFrame, keys: list[str], silence_minutes: int | None,
                     width: int = tl.HOUR) -> DataFrame:
    """Start, end and size of the stretches a silence separates."""
    pts = tl.with_episodes(tl.points(events, keys, "ts", width), keys, silence_minutes)
    return pts.groupBy(*keys, "episode").agg(F.max("ts").alias("last_event"), F.sum("n").alias("events"))


LIMITS = ("_threshold", "_window", "_quiet", "_limit_count", "_limit_window")


def burst(events: DataFrame, keys: list[str], threshold: int | None = 1, window_minutes: int | None = None,
          silence_minutes: int | None = None, escalate_count: int | None = None,
          escalate_window_minutes: int | None = None, width: int = tl.HOUR) -> DataFrame:
    """One row per episode that reached the threshold.

    ``opened_at`` is the event that made the rolling count reach it,
    ``escalated_at`` the first event from then on whose count within the
    escalation window (without one: since opening) reaches that limit.
    """
    values = (threshold or 1, window_minutes, silence_minutes, escalate_count, escalate_window_minutes)
    pts = tl.points(events, keys, "ts", width).withColumns(
        {name: F.lit(v).cast("int") for name, v in zip(LIMITS, values)})
    pts = tl.with_episodes(pts, keys, F.col("_quiet"), keep=LIMITS)
    windows = {"_count": window_minutes, "_more": escalate_window_minutes if escalate_count else None}
    pts = tl.rolling_counts(pts, keys, {name: m for name, m in windows.items() if m is not None}, width)
    pts = pts.withColumns({name: F.col("so_far") for name, m in windows.items() if m is None})
    out = _burst(pts, keys, escalate_count is not None)
    return out if escalate_count else out.drop("escalated_at")


def _burst(pts: DataFrame, keys: list[str], escalates: bool = True) -> DataFrame:
    """Points with their episode, limits and rolling counts, to one row per
    episode.  What an episode opened with is carried along its slices, so a
    hot episode is as spread as a hot key."""
    group = [*keys, "episode"]
    count, more = F.least("_count", "so_far"), F.least("_more", "so_far")
    reached = F.when(count >= F.col("_threshold"), F.struct("ts", (F.col("so_far") - F.col("n")).alias("before")))
    late = F.lit(None).cast("timestamp_ntz")
    if escalates:
        # Slices and their carry read it twice; written once instead.
        pts = materialize(pts, "counted")
        pts = tl.running_min(pts, group, ["ts"], reached, "_open")
        since = more - F.when(F.col("_limit_window").isNull(), F.col("_open.before")).otherwise(0)
        late = F.when(F.col("_open").isNotNull() & (since >= F.col("_limit_count")), F.col("ts"))
    return pts.groupBy(*group).agg(
        F.min(reached)["ts"].alias("opened_at"), F.max("ts").alias("last_event"), F.sum("n").alias("events"),
        F.min(late).alias("escalated_at")).where("opened_at IS NOT NULL")


def autoclose(incidents: DataFrame, silence_minutes: int | None, as_of: Column) -> DataFrame:
    """Close after the silence; still open if that lies after ``as_of``."""
    if silence_minutes is None:
        return incidents.withColumn("closed_at", F.lit(None).cast("timestamp_ntz"))
    end = F.col("last_event") + tl.minutes(silence_minutes)
    return incidents.withColumn("closed_at", F.when(end <= as_of, end))


def burst_by_rules(events: DataFrame, rules: DataFrame, key: str, as_of: Column, width: int = tl.HOUR) -> DataFrame:
    """All burst rules at once over events ``(rule_name, key, ts)`` already
    assigned to a rule: one pass, however many rules there are."""
    by_count = F.col("escalate_basis") == "occurrences"
    table = rules.where("active AND mechanism = 'burst'").select(
        "rule_name", F.coalesce("open_threshold_count", F.lit(1)).alias("_threshold"),
        F.col("open_window_minutes").alias("_window"), F.col("autoclose_silence_minutes").alias("_quiet"),
        F.when(by_count, F.col("escalate_count")).alias("_limit_count"),
        F.when(by_count, F.col("escalate_window_minutes")).alias("_limit_window"),
        F.col("base_severity").alias("_base"), F.col("escalate_to_severity").alias("_raised"))
    keys = ["rule_name", key]
    # The rules go to the events: shuffled by rule, a hot one would be one task's.
    pts = tl.points(events, keys, "ts", width).join(F.broadcast(table.drop("_base", "_raised")), "rule_name")
    pts = materialize(tl.with_episodes(pts, keys, F.col("_quiet"), keep=LIMITS), "episodes")
    out = _burst(tl.rolling_by_column(pts, keys, {"_count": "_window", "_more": "_limit_window"}, width), keys)
    end = F.col("last_event") + tl.minutes(F.col("_quiet"))
    return out.join(F.broadcast(table.select("rule_name", "_quiet", "_base", "_raised")), "rule_name").select(
        *out.columns, F.when(end <= as_of, end).alias("closed_at"),
        F.when(F.col("escalated_at").isNotNull(), F.col("_raised")).otherwise(F.col("_base")).alias("severity"))


def escalate_by_incidents(incidents: DataFrame, keys: list[str], count: int, window_minutes: int,
                          width: int = 24 * tl.HOUR) -> DataFrame:
    """Incidents whose key opened ``count`` of them within the window."""
    opened = tl.points(incidents.select(*keys, F.col("opened_at").alias("ts")), keys, "ts", width)
    rolled = tl.rolling_counts(opened, keys, {"incidents_in_window": window_minutes}, width)
    hits = rolled.where(F.col("incidents_in_window") >= count)
    return hits.select(*keys, F.col("ts").alias("opened_at"), "incidents_in_window")


# --- pair ------------------------------------------------------------------

def pair(events: DataFrame, keys: list[str], width: int = tl.HOUR) -> DataFrame:
    """Start events open, the next end event of the key closes.

    ``events`` has the keys, ``ts``, ``id`` and ``role``.  Repeated starts of
    an open incident and ends without one change nothing, so only the rows
    where the role changes matter, and they alternate.
    """
    order = ["ts", "id"]
    roles = tl.on_timeline(events.where(F.col("role").isin("start", "end")), keys)
    rows = tl.sliced(roles.select(*keys, *order, "role"), "ts", width)
    here = tl.local(keys, *order)
    end_ts = F.when(F.col("role") == "end", F.col("ts"))
    rows = rows.withColumn("_role_before", F.lag("role").over(here)).withColumn(
        "_end_after", F.min(end_ts).over(here.rowsBetween(W.currentRow, W.unboundedFollowing)))
    rows = tl.with_carry(
        rows, keys,
        border={"_last_role": F.max_by("role", F.struct(*order)), "_first_end": F.min(end_ts)},
        carry={"_role_slice": F.lag("_last_role").over(tl.slices_of(keys)),
               "_end_slice": F.min("_first_end").over(tl.later_slices(keys))})
    idle = F.coalesce("_role_before", "_role_slice", F.lit("end")) == "end"
    return rows.where(idle & (F.col("role") == "start")).select(
        *keys, F.col("id").alias("start_id"), F.col("ts").alias("opened_at"),
        F.coalesce("_end_after", "_end_slice").alias("closed_at"))


def pair_by_rules(events: DataFrame, rules: DataFrame, key: str, as_of: Column, width: int = tl.HOUR) -> DataFrame:
    """All pair rules at once over events ``(rule_name, key, ts, id, role)``
    already assigned to a rule; all limits come from the rule table.

    A rule with a silence closes what is open after it, counted from the
    key's last start or end; later ends find nothing open.  Openings that end
    within the delay never opened.  A start within the grace after the last
    close continues that incident.
    """
    keys = ["rule_name", key]
    limits = rules.where("active AND mechanism = 'pair'").select(
        "rule_name", "open_delay_seconds", "max_open_minutes", "base_severity", "severity_by_duration",
        F.col("autoclose_silence_minutes").alias("_quiet"), F.col("pair_reopen_grace_minutes").alias("_grace"))
    roles = events.where(F.col("role").isin("start", "end")).select(*keys, "ts", "id", "role")
    pts = tl.points(roles, keys, "ts", width).join(F.broadcast(limits.select("rule_name", "_quiet")), "rule_name")
    at = tl.with_episodes(pts, keys, F.col("_quiet")).select(*keys, "ts", "episode")
    roles = materialize(roles.join(at, [*keys, "ts"]), "pair-episodes")
    last = roles.groupBy(*keys, "episode").agg(F.max("ts").alias("_last"))
    found = pair(roles, [*keys, "episode"], width).join(last, [*keys, "episode"]).join(F.broadcast(limits), "rule_name")
    quiet = F.col("_last") + tl.minutes(F.col("_quiet"))
    found = found.withColumn("closed_at", F.coalesce("closed_at", F.when(quiet <= as_of, quiet)))
    settled = F.col("opened_at") + F.make_dt_interval(secs=F.coalesce("open_delay_seconds", F.lit(-1)))
    kept = found.where(F.col("closed_at").isNull() | (F.col("closed_at") > settled)).drop("_last", "episode")
    kept = tl.sliced(materialize(kept, "pairs"), "opened_at", 24 * tl.HOUR)
    order = ["opened_at", "start_id"]
    kept = tl.previous(kept, keys, order, F.col("closed_at"), "_closed")
    again = F.coalesce(F.col("opened_at") <= F.col("_closed") + tl.minutes(F.col("_grace")), F.lit(False))
    kept = tl.running_max(kept, keys, order, F.when(~again, F.struct(*order)), "_first")
    whole = kept.groupBy(*keys, "_first", "max_open_minutes", "base_severity", "severity_by_duration").agg(
        F.when(F.count_if(F.col("closed_at").isNull()) == 0, F.max("closed_at")).alias("closed_at"))
    whole = whole.select("*", *[F.col("_first")[c].alias(c) for c in order])
    limit, end = F.col("opened_at") + tl.minutes(F.col("max_open_minutes")), F.coalesce("closed_at", as_of)
    severity = severity_at(F.col("severity_by_duration"), F.col("_open"), F.col("base_severity"))
    return whole.withColumn("_open", elapsed_minutes(F.col("opened_at"), end)).select(
        *keys, "start_id", "opened_at", "closed_at", F.when(end > limit, limit).alias("overdue_at"),
        severity.alias("severity"))


def without_short(incidents: DataFrame, delay_seconds: int) -> DataFrame:
    """Drop incidents that closed within the delay; they never opened."""
    limit = F.col("opened_at") + F.make_dt_interval(secs=F.lit(delay_seconds))
    return incidents.where(F.col("closed_at").isNull() | (F.col("closed_at") > limit))


def overdue(incidents: DataFrame, max_open_minutes: int, as_of: Column) -> DataFrame:
    limit = F.col("opened_at") + tl.minutes(max_open_minutes)
    late = F.coalesce("closed_at", as_of) > limit
    return incidents.withColumn("overdue_at", F.when(late, limit))


def reopen(incidents: DataFrame, keys: list[str], grace_minutes: int, width: int = 24 * tl.HOUR) -> DataFrame:
    """A start within the grace after the last close continues that incident."""
    rows = tl.sliced(incidents, "opened_at", width)
    rows = tl.previous(rows, keys, ["opened_at"], F.col("closed_at"), "_closed")
    fresh = F.col("_closed").isNull() | (F.col("opened_at") > F.col("_closed") + tl.minutes(grace_minutes))
    rows = tl.running_max(rows, keys, ["opened_at"], F.when(fresh, F.col("opened_at")), "_first")
    return rows.groupBy(*keys, F.col("_first").alias("incident_opened_at")).agg(
        F.when(F.count_if(F.col("closed_at").isNull()) == 0, F.max("closed_at")).alias("incident_closed_at"),
        F.count("*").alias("openings"))


# --- absence, rate, value --------------------------------------------------

def absence(events: DataFrame, keys: list[str], every_minutes: int, as_of: Column,
            width: int = tl.HOUR) -> DataFrame:
    """Gaps above the limit, from last event plus limit to the next event or
    to ``as_of``.  No keys means the whole stream."""
    scope = keys or ["_stream"]
    rows = events if keys else events.withColumn("_stream", F.lit("all"))
    pts = tl.following(tl.points(rows, scope, "ts", width), scope, ["ts"], F.col("ts"), "next_event")
    limit = F.col("ts") + tl.minutes(every_minutes)
    return pts.where(F.coalesce("next_event", as_of) > limit).select(
        *keys, F.col("ts").alias("last_event"), limit.alias("opened_at"), F.col("next_event").alias("closed_at"))


def rule_scopes(rules: DataFrame) -> DataFrame:
    """What each rule with an expected interval listens to, as data: a scope
    and its value, or all values of the scope where that is null.

    Absence rules listen to the whole stream or to a field; rules of other
    mechanisms listen to the events of their own incident type.
    """
    absent, field = F.col("mechanism") == "absence", F.col("match_field")
    return rules.where("active AND expected_every_minutes IS NOT NULL").select(
        "rule_name", "expected_every_minutes", "base_severity", "severity_by_duration",
        F.when(~absent, "incident_type").when(field.isNull(), "stream").otherwise(field).alias("scope"),
        F.when(~absent, F.col("incident_type")).when(field.isNull(), "all").otherwise(F.col("match_value")).alias("value"))


def absence_by_rules(events: DataFrame, rules: DataFrame, fields: Column, since: Column, as_of: Column,
                     expected: DataFrame | None = None, width: int = tl.HOUR) -> DataFrame:
    """Silences of all rules with an expected interval, each in its own scope.

    ``events`` has ``ts`` and ``incident_type``, ``fields`` maps field names
    to an event's values.  Gaps are found once per scope and value, whatever
    the number of rules, and then meet the rules.  A value that a rule names,
    and each (scope, value) of ``expected`` for rules that take any value, is
    listened for from ``since`` on, so one that never spoke alarms too; its
    ``last_event`` is null.

    No two events of a stretch as short as the scope's shortest limit are a
    silence apart, so only the first and last event of each such stretch are
    kept, found by partial aggregation; no task sorts the events of a scope.
    """
    scopes = rule_scopes(rules)
    # One row per scope, so small whatever the number of rules.  Shuffled by
    # scope instead, the whole stream would be one task's.
    shortest = F.broadcast(scopes.groupBy("scope").agg(F.min("expected_every_minutes").alias("_every")))
    entry = "array<struct<key:string,value:string>>"
    heard = F.concat(F.array(F.struct(F.lit("stream").alias("key"), F.lit("all").alias("value")),
                             F.struct(F.lit("incident_type").alias("key"), F.col("incident_type").alias("value"))).cast(entry),
                     F.coalesce(F.map_entries(fields), F.array()).cast(entry))
    rows = events.select("ts", F.explode(heard).alias("_e")).select("ts", F.col("_e.key").alias("scope"), "_e.value")
    keys = ["scope", "value"]
    rows = tl.on_timeline(rows.join(shortest, "scope"), keys).where(F.col("ts") >= since)
    heard = tl.stretches(rows, keys, F.col("_every")).select(*keys, "_every", "ts", "last", F.lit(1).alias("n"))
    named = scopes.where("value IS NOT NULL").select(*keys)
    if expected is not None:
        named = named.union(expected.select(*keys).join(scopes.where("value IS NULL").select("scope").distinct(), "scope")
                            .select(*keys))
    begin = named.distinct().join(shortest, "scope").select(*keys, "_every", since.cast("timestamp_ntz").alias("ts"))
    begin = begin.select("*", F.col("ts").alias("last"), F.lit(0).alias("n"))
    pts = tl.following(tl.sliced(heard.unionByName(begin), "ts", width), keys, ["ts", "n"], F.col("ts"), "next_event")
    pts = pts.select(*keys, F.col("last").alias("ts"), "n", "next_event", "_every")
    # Only what is a silence for some rule meets the rules.
    pts = pts.where(F.coalesce("next_event", as_of) > F.col("ts") + tl.minutes(F.col("_every")))
    one = scopes.where("value IS NOT NULL")
    anyone = scopes.where("value IS NULL").drop("value")
    gaps = pts.join(one, keys).unionByName(pts.join(anyone, "scope"))
    limit = F.col("ts") + tl.minutes(F.col("expected_every_minutes"))
    late = gaps.where(F.coalesce("next_event", as_of) > limit).withColumn(
        "_open", elapsed_minutes(limit, F.coalesce("next_event", as_of)))
    return late.select(
        "rule_name", F.col("value").alias("key"), F.when(F.col("n") > 0, F.col("ts")).alias("last_event"),
        limit.alias("opened_at"), F.col("next_event").alias("closed_at"),
        severity_at(F.col("severity_by_duration"), F.col("_open"), F.col("base_severity")).alias("severity"))


def expected_at(starts: DataFrame, rules: DataFrame, since: Column, as_of: Column) -> DataFrame:
    """Local days on which a target did not start in time.

    ``starts`` has ``target`` and UTC ``ts``.  A rule waits from its local
    time of day to its first duration step.  The days looked at are those of
    the rule's own zone from ``since`` to ``as_of``; what is not yet late at
    ``as_of`` gives no alarm.
    """
    steps = F.map_keys(F.from_json("severity_by_duration", "map<string,string>"))
    patience = F.array_min(F.transform(steps, lambda k: k.cast("int")))
    first, last = (F.to_date(F.from_utc_timestamp(t, F.col("timezone"))) for t in (since, as_of))
    due = rules.where("expected_at_local IS NOT NULL AND match_field = 'target'").select(
        "rule_name", F.col("match_value").alias("target"), "timezone", "expected_at_local",
        F.coalesce(patience, F.lit(0)).alias("_wait"),
        F.explode(F.sequence(first, last, F.expr("INTERVAL 1 DAY"))).alias("day"))
    local = F.to_timestamp_ntz(F.concat_ws(" ", F.col("day").cast("string"), "expected_at_local"),
                               F.lit("yyyy-MM-dd HH:mm"))
    due = due.withColumn("due_at", F.to_utc_timestamp(local, F.col("timezone")).cast("timestamp_ntz"))
    due = due.withColumn("late_at", F.col("due_at") + tl.minutes(F.col("_wait"))).where(F.col("late_at") <= as_of)
    # Days with a start in time.  A waiting period is laid over the hours it
    # touches, so a start meets only the periods of its own hour.
    hours = F.explode(F.sequence(tl.slice_of("due_at"), tl.slice_of("late_at")))
    waiting = due.select("rule_name", "target", "day", "due_at", "late_at", hours.alias(tl.SLICE))
    seen = tl.sliced(starts.select("target", F.col("ts").alias("started_at")), "started_at")
    met = waiting.join(seen, ["target", tl.SLICE]).where(
        (F.col("started_at") >= F.col("due_at")) & (F.col("started_at") < F.col("late_at"))
    ).select("rule_name", "day").distinct()
    return due.join(met, ["rule_name", "day"], "left_anti").select("rule_name", "target", "day", "due_at", "late_at")


def rate(events: DataFrame, key: str | list[str], multiplier: float = 5.0, history_hours: int = 336) -> DataFrame:
    """Hours whose count exceeds a multiple of the median of the hours
    before; no history, no alarm.  Hours without events count as zero from a
    key's first hour to its last.  The window runs over hourly counts."""
    keys = [key] if isinstance(key, str) else key
    counted = events.groupBy(*keys, F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour")).agg(
        F.count("*").alias("events"))
    span = counted.groupBy(*keys).agg(F.min("hour").alias("_first"), F.max("hour").alias("_last"))
    hours = span.select(*keys, F.explode(F.sequence("_first", "_last", F.expr("INTERVAL 1 HOUR"))).alias("hour"))
    hourly = hours.join(counted, [*keys, "hour"], "left").withColumn("events", F.coalesce("events", F.lit(0)))
    median = tl.over_interval("percentile(events, 0.5)", keys, "hour",
                              f"INTERVAL {history_hours} HOURS PRECEDING", "INTERVAL 1 HOUR PRECEDING")
    rated = hourly.withColumn("median", median)
    return rated.withColumn("alarm", F.coalesce(F.col("events") > F.col("median") * multiplier, F.lit(False)))


def below_limit(measurements: DataFrame, value: str, limit: float) -> DataFrame:
    return measurements.where(F.col(value) < limit)


# --- all rules ---------------------------------------------------------------

SEVERITIES = ("info", "warning", "error", "critical")


def worse(a: Column, b: Column) -> Column:
    """The higher of two severities; null counts as none."""
    order = F.array(*map(F.lit, SEVERITIES))
    rank = [F.coalesce(F.array_position(order, c), F.lit(0)) for c in (a, b)]
    return F.when(rank[0] >= rank[1], a).otherwise(b)


def incidents_by_rules(events: DataFrame, rules: DataFrame, key: str, fields: Column, starts: DataFrame,
                       since: Column, as_of: Column, expected: DataFrame | None = None, multiplier: float = 5.0,
                       width: int = tl.HOUR) -> DataFrame:
    """One table of the incidents of all active rules.

    ``events`` has ``rule_name`` (see ``select_rule``), ``incident_type``, the
    ``key``, ``ts``, ``id`` and ``role``; ``fields`` and ``expected`` are
    those of ``absence_by_rules``, ``starts`` those of ``expected_at``.  An
    incident is one of a rule, a kind and a key:

    * ``burst`` and ``pair``: as their evaluators find them,
    * ``absence``: a silence of the rule's scope, closed by its next event,
    * ``expected``: a start that did not come; it stays open,
    * ``rate``: an hour above the limit, closed at the hour's end.

    Rules that escalate by incidents raise an incident at its opening where
    rule, kind and key then opened the limit's number within the window (all
    of them without one).  The severity is the worse of what the duration
    and the escalation ask for.  The plan's size does not depend on the
    number of rules or of their windows.
    """
    active = rules.where("active")
    own = events.join(F.broadcast(active.select("rule_name", F.col("mechanism").alias("_by"))), "rule_name")
    moment = F.lit(None).cast("timestamp_ntz")

    def found(df: DataFrame, kind: str, name: str, opened: Column, closed: Column, raised=moment, overdue=moment) -> DataFrame:
        return df.select("rule_name", F.lit(kind).alias("kind"), F.col(name).alias("key"), opened.alias("opened_at"),
                         closed.alias("closed_at"), raised.alias("escalated_at"), overdue.alias("overdue_at"))

    opened, closed = F.col("opened_at"), F.col("closed_at")
    bursts = burst_by_rules(own.where("_by = 'burst'"), rules, key, as_of, width)
    pairs = pair_by_rules(own.where("_by = 'pair'"), rules, key, as_of, width)
    silent = absence_by_rules(events, rules, fields, since, as_of, expected, width)
    missed = expected_at(starts, active, since, as_of)
    rated = rate(tl.on_timeline(own.where("_by = 'rate'"), ["rule_name", key]), ["rule_name", key], multiplier).where("alarm")
    over = F.col("hour") + tl.minutes(60)
    every = [found(bursts, "burst", key, opened, closed, F.col("escalated_at")),
             found(pairs, "pair", key, opened, closed, overdue=F.col("overdue_at")),
             found(silent, "absence", "key", opened, closed),
             found(missed, "expected", "target", F.col("late_at"), moment),
             found(rated, "rate", key, F.col("hour"), F.when(over <= as_of, over))]
    table = every[0]
    for more in every[1:]:
        table = table.union(more)
    table = materialize(table, "incidents")

    by_incidents = F.col("escalate_basis") == "incidents"
    limits = active.select("rule_name", F.when(by_incidents, F.col("escalate_count")).alias("_limit"),
                           F.col("escalate_window_minutes").alias("_window"), F.col("base_severity").alias("_base"),
                           F.col("escalate_to_severity").alias("_raised"), F.col("severity_by_duration").alias("_steps"))
    keys, day = ["rule_name", "kind", "key"], 24 * tl.HOUR
    openings = tl.points(table.select(*keys, F.col("opened_at").alias("ts")), keys, "ts", day).join(
        F.broadcast(limits.where("_limit IS NOT NULL").select("rule_name", "_limit", "_window")), "rule_name")
    counted = tl.rolling_by_column(openings, keys, {"_opened": "_window"}, day)
    many = counted.where("_opened >= _limit").select(*keys, F.col("ts").alias("opened_at"), F.lit(True).alias("_many"))
    table = table.join(many, [*keys, "opened_at"], "left").join(F.broadcast(limits), "rule_name")
    raised = F.coalesce("escalated_at", F.when(F.col("_many"), F.col("opened_at")))
    lasted = elapsed_minutes(F.col("opened_at"), F.coalesce("closed_at", as_of))
    severity = worse(severity_at(F.col("_steps"), F.col("_open"), F.col("_base")), F.when(raised.isNotNull(), F.col("_raised")))
    return table.withColumn("_open", lasted).select(*keys, "opened_at", "closed_at", "overdue_at", raised.alias("escalated_at"), severity.alias("severity"))


# --- follow-up -------------------------------------------------------------

def ack_notify(incidents: DataFrame, rules: DataFrame) -> DataFrame:
    """Incidents that need acknowledging, or a notice that they closed."""
    flags = rules.select("rule_name", "require_ack", "notify_on_close")
    out = incidents.join(flags, "rule_name").select(
        *incidents.columns, F.col("require_ack").alias("needs_ack"),
        (F.col("notify_on_close") & F.col("closed_at").isNotNull()).alias("close_notice"))
    return out.where("needs_ack OR close_notice")


def catch_all(events: DataFrame) -> DataFrame:
    """Events that no rule takes: those whose ``rule_name`` (see
    ``select_rule``) is null, whether their type has rules or not.  ``events``
    also has the syslog ``priority``."""
    critical = F.coalesce(rule_severity(F.col("priority")) == "critical", F.lit(False))
    return events.where(F.col("rule_name").isNull()).withColumn(
        "incident_type", F.when(critical, "I-00-CRIT").otherwise("I-00"))
