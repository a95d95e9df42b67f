"""Check SQL: the given tables as the engine's inputs, in DuckDB's dialect.

``sql(body, *names)`` puts the named views and everything they stand on in
front of a query.
"""

from __future__ import annotations

import re

from logloom.functions.rules import RULES_V1, RULES_V2, RuleSet
from logloom.operators.incidents import INCIDENT_TYPES, RULE_COLUMNS, RULES, rule_values

BOMC = "chr(65279)"


def rule_sql(text: str, rule) -> str:
    if rule.name == "id":
        # RE2 has no lookahead: judge each run of id characters by itself.
        return (
            f"array_to_string(list_transform(regexp_extract_all({text}, '[A-Za-z0-9_-]+|[^A-Za-z0-9_-]+'), "
            "lambda x: CASE WHEN length(trim(x, '-')) >= 8 AND regexp_full_match(x, '[A-Za-z0-9_-]+') "
            "AND regexp_matches(x, '[A-Za-z]') AND regexp_matches(x, '[0-9][^0-9]*[0-9]') "
            r"THEN regexp_replace(x, '^(-*)(.*?)(-*)$', '\1<ID>\3') ELSE x END), '')")
    return f"regexp_replace({text}, '{rule.pattern}', '{rule.token}', 'g')"


def space_sql(text: str) -> str:
    return rf"trim(regexp_replace({text}, '\s+', ' ', 'g'))"


def form_sql(text: str, ruleset: RuleSet = RULES_V1, upto: str | None = None, space: bool = True) -> str:
    for rule in ruleset.rules:
        text = rule_sql(text, rule)
        if rule.name == upto:
            return text
    return space_sql(text) if space else text


def strip_sql(text: str) -> str:
    return rf"regexp_replace({text}, '^\s+|\s+$', '', 'g')"


DT = "strftime({}, '%Y-%m-%d %H:%M:%S')"
ISO = "strftime({}, '%Y-%m-%dT%H:%M:%S.%f')"

def _value(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v).lower()
    return str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"


def values_sql(rows, columns: tuple[str, ...]) -> str:
    body = ", ".join("(" + ", ".join(_value(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {body}) t({', '.join(columns)})"


VIEWS = {
    "types": values_sql(INCIDENT_TYPES, ("code", "label")),
    "rules": values_sql([rule_values(**r) for r in RULES], RULE_COLUMNS),
    "ev": f"""
SELECT event_id AS id, ts AS "timestamp",
 CASE user_id % 3 WHEN 0 THEN 'DiskStation225' WHEN 1 THEN 'FritzBox' ELSE 'n8n' END AS host,
 CASE user_id % 3
  WHEN 0 THEN CASE event_type WHEN 'view' THEN 'Hyper_Backup' WHEN 'error' THEN 'Connection' WHEN 'click' THEN 'System'
    WHEN 'purchase' THEN 'WinFileService' ELSE 'System' END
  WHEN 1 THEN concat('EventLog-', CAST(event_id % 4 AS STRING))
  ELSE CASE event_type WHEN 'error' THEN 'n8n-stderr' ELSE 'n8n-stdout' END END AS program,
 concat(
  CASE WHEN user_id % 3 = 0 AND event_id % 10 <> 0
    THEN concat('CEF:0|arg_5=tok', CAST(event_id AS STRING), '|', {BOMC}) ELSE '' END,
  CASE event_type
   WHEN 'view' THEN concat('Backup task [Synology C2] finished: ', CAST(event_id % 900 + 1 AS STRING), ' MB in ',
     CAST(event_id % 60 AS STRING), ' min, log /var/log/run', CAST(event_id % 7 AS STRING), '/out.txt')
   WHEN 'error' THEN concat('User admin from 192.168.', CAST(event_id % 256 AS STRING), '.', CAST(user_id % 256 AS STRING),
     ' failed to sign in at ', {DT.format('ts')}, ', session a1b2', CAST(event_id + 1000 AS STRING), 'x, attempt ',
     CAST(event_id % 12 AS STRING))
   WHEN 'click' THEN concat('WLAN device 02:00:5e:10:00:', CAST(event_id % 90 + 10 AS STRING), ' on 5.',
     CAST(event_id % 900 + 100 AS STRING), ' GHz, rate ', CAST(event_id % 1000 AS STRING), ' Mbit/s, fe80::',
     CAST(event_id % 9000 + 1000 AS STRING))
   WHEN 'purchase' THEN concat('Package v22.', CAST(event_id % 20 AS STRING), '.1 updated,  checksum deadbeef0123456',
     CAST(event_id % 10 AS STRING), ', load ', CAST(event_id % 100 AS STRING), ' %')
   ELSE concat('INFO (42): Skipping operation at 12:', CAST(event_id % 50 + 10 AS STRING), ' on service ',
     substr('abcdefghijklmnopqrstuvwxyzabcde', day(ts), 1), ' via 10.11.', CAST(event_id % 120 AS STRING), '.',
     CAST(event_id % 200 AS STRING))
  END) AS message
FROM events""",
    "cl": f"SELECT *, {strip_sql(f'list_extract(string_split(message, {BOMC}), -1)')} AS cleaned FROM ev",
    "fp": f"""
SELECT id, "timestamp", host, program, cleaned, concat(host, '|', program, '|', {form_sql('cleaned')}) AS fingerprint,
 host = 'DiskStation225' AND NOT contains(message, {BOMC}) AS bom_missing,
 host = 'DiskStation225' AND NOT contains(message, {BOMC})
   AND program NOT IN ('Hyper_Backup', 'Connection', 'System') AS bom_missing_unverified
FROM cl""",
    "bridge": """
SELECT id AS event_id, fingerprint, 1 AS cleaner_ver, 1 AS normalizer_ver, "timestamp" AS computed_at,
 bom_missing, bom_missing_unverified FROM fp""",
    "reg0": """
SELECT fingerprint, arg_min(host, id) AS host, arg_min(program, id) AS program, arg_min(cleaned, id) AS beispiel_roh,
 min("timestamp") AS erstmals, max("timestamp") AS zuletzt, count(*) AS vorkommen, 1 AS cleaner_ver, 1 AS normalizer_ver
FROM fp GROUP BY fingerprint""",
    "reg": """
SELECT *,
 CASE length(fingerprint) % 5 WHEN 1 THEN 'rauschen' WHEN 2 THEN 'betrieb' WHEN 3 THEN 'relevant' WHEN 4 THEN 'kritisch' END AS klasse,
 CASE WHEN length(fingerprint) % 5 > 0 THEN concat('I-0', CAST(length(fingerprint) % 5 AS STRING)) END AS incident_typ,
 CASE WHEN length(fingerprint) % 5 > 0 THEN zuletzt END AS bewertet_am,
 CASE WHEN length(fingerprint) % 5 > 0 THEN CASE WHEN length(fingerprint) % 3 = 0 THEN 'axel' ELSE 'llm:test' END END AS bewertet_von,
 CASE WHEN length(fingerprint) % 3 = 1 THEN '{"rolle":"start","severity":"warning","stille_minuten":30}' END AS llm_vorschlag
FROM reg0""",
    "cut": "SELECT CAST(max(event_id) * 6 // 10 AS BIGINT) AS c FROM events",
    "last_ts": "SELECT max(ts) AS t FROM events",
    "moved": f"""
SELECT b.event_id, c."timestamp", c.host, c.program, c.cleaned, b.fingerprint AS old_fingerprint,
 concat(c.host, '|', c.program, '|', {form_sql('c.cleaned', RULES_V2)}) AS new_fingerprint
FROM bridge b JOIN cl c ON c.id = b.event_id""",
    "moves": """
SELECT old_fingerprint, new_fingerprint, count(*) AS events, min("timestamp") AS erstmals, max("timestamp") AS zuletzt,
 min(event_id) AS first_id, arg_min(host, event_id) AS host, arg_min(program, event_id) AS program,
 arg_min(cleaned, event_id) AS cleaned
FROM moved GROUP BY 1, 2""",
    "src": """
SELECT m.old_fingerprint, m.targets, m.moved, CASE WHEN m.targets = 1 THEN m.t END AS target,
 r.klasse, r.incident_typ, r.bewertet_am, r.bewertet_von, r.llm_vorschlag
FROM (SELECT old_fingerprint, count(*) AS targets, CAST(sum(events) AS BIGINT) AS moved, min(new_fingerprint) AS t
      FROM moves GROUP BY 1) m
LEFT JOIN reg r ON r.fingerprint = m.old_fingerprint""",
    "ranked": """
SELECT *, row_number() OVER (PARTITION BY target ORDER BY CASE WHEN target = old_fingerprint THEN 0 ELSE 1 END, old_fingerprint) AS rn
FROM src WHERE target IS NOT NULL AND bewertet_am IS NOT NULL""",
    "verdict": """
SELECT target, max(CASE WHEN rn = 1 THEN klasse END) AS klasse, max(CASE WHEN rn = 1 THEN incident_typ END) AS incident_typ,
 max(CASE WHEN rn = 1 THEN bewertet_am END) AS bewertet_am, max(CASE WHEN rn = 1 THEN bewertet_von END) AS bewertet_von,
 max(CASE WHEN rn = 1 THEN llm_vorschlag END) AS llm_vorschlag, max(CASE WHEN rn = 1 THEN old_fingerprint END) AS first_old,
 count(DISTINCT concat(coalesce(klasse, '-'), '/', coalesce(incident_typ, '-'))) > 1 AS cleared
FROM ranked GROUP BY target""",
    "outcome": """
SELECT s.old_fingerprint, s.targets, s.moved AS events,
 CASE WHEN s.bewertet_am IS NULL THEN 'unclassified_no_action'
  WHEN s.targets > 1 THEN 'split_needs_review'
  WHEN v.first_old = s.old_fingerprint AND s.old_fingerprint <> s.target THEN 'carried_over'
  WHEN s.klasse IS NOT DISTINCT FROM v.klasse AND s.incident_typ IS NOT DISTINCT FROM v.incident_typ THEN 'already_consistent'
  ELSE 'conflict' END AS outcome
FROM src s LEFT JOIN verdict v ON v.target = s.target""",
    "lines": f"""
SELECT id, CASE WHEN id % 50 = 0 THEN message ELSE concat('<', CAST(id % 192 AS STRING), '>1 ',
  strftime("timestamp", '%Y-%m-%dT%H:%M:%S'), '+00:00 ', host, ' ', program, ' ',
  CASE WHEN id % 4 = 0 THEN '-' ELSE CAST(id AS STRING) END, ' - ',
  CASE WHEN id % 7 = 0 THEN '[a b="c"]' ELSE '-' END, ' ', message) END AS line,
 concat(strftime("timestamp", '%Y-%m-%dT%H:%M:%S'), '+00:00') AS received_at FROM ev""",
    "pri": """
SELECT n AS pri, CASE n // 8
  WHEN 0 THEN 'kern' WHEN 1 THEN 'user' WHEN 2 THEN 'mail' WHEN 3 THEN 'daemon' WHEN 4 THEN 'auth' WHEN 5 THEN 'syslog'
  WHEN 6 THEN 'lpr' WHEN 7 THEN 'news' WHEN 8 THEN 'uucp' WHEN 9 THEN 'cron' WHEN 10 THEN 'authpriv' WHEN 11 THEN 'ftp'
  WHEN 16 THEN 'local0' WHEN 17 THEN 'local1' WHEN 18 THEN 'local2' WHEN 19 THEN 'local3' WHEN 20 THEN 'local4'
  WHEN 21 THEN 'local5' WHEN 22 THEN 'local6' WHEN 23 THEN 'local7' ELSE concat('facility', CAST(n // 8 AS STRING)) END AS facility,
 CASE n % 8 WHEN 0 THEN 'emergency' WHEN 1 THEN 'alert' WHEN 2 THEN 'critical' WHEN 3 THEN 'error' WHEN 4 THEN 'warning'
  WHEN 5 THEN 'notice' WHEN 6 THEN 'informational' ELSE 'debug' END AS priority
FROM (SELECT unnest(range(0, 1000)) AS n)""",
    "raws": rf"""
SELECT id, received_at, {strip_sql('line')} AS raw,
 '(?s)^<(\d{{1,3}})>(\d+)\s+(\S+)\s+(\S+)\s+(\S+)\s+(\S+)\s+(\S+)\s+(?:\[.*?\]|-)\s?(.*)$' AS p FROM lines""",
    "parsed": """
SELECT r.id, CASE WHEN ok THEN regexp_extract(raw, PAT, 3) ELSE received_at END AS "timestamp",
 CASE WHEN ok THEN regexp_extract(raw, PAT, 4) ELSE 'unknown' END AS host,
 CASE WHEN ok THEN pri.facility ELSE 'unknown' END AS facility,
 CASE WHEN ok THEN pri.priority ELSE 'unknown' END AS priority,
 CASE WHEN ok THEN regexp_extract(raw, PAT, 5) ELSE 'unknown' END AS program,
 CASE WHEN ok AND regexp_extract(raw, PAT, 6) <> '-' THEN regexp_extract(raw, PAT, 6) ELSE '' END AS pid,
 CASE WHEN ok AND regexp_extract(raw, PAT, 7) <> '-' THEN regexp_extract(raw, PAT, 7) ELSE '' END AS msgid,
 CASE WHEN ok THEN STRIPPED ELSE raw END AS message, ok AS parsed
FROM (SELECT id, received_at, raw, regexp_matches(raw, PAT) AS ok,
        TRY_CAST(regexp_extract(raw, PAT, 1) AS INTEGER) AS pri_no FROM raws) r
LEFT JOIN pri ON pri.pri = r.pri_no""".replace(
        "STRIPPED", strip_sql("regexp_extract(raw, PAT, 8)")).replace(
        "PAT", r"'(?s)^<(\d{1,3})>(\d+)\s+(\S+)\s+(\S+)\s+(\S+)\s+(\S+)\s+(\S+)\s+(?:\[.*?\]|-)\s?(.*)$'"),
    "entries": f"""
SELECT id AS seq, "timestamp" AS event_ts, CASE WHEN id % 11 > 0 THEN CAST(id % 4 AS STRING) END AS id,
 CASE WHEN id % 3 > 0 THEN CASE WHEN id % 3 = 1 THEN 'net' ELSE 'sys' END END AS "group",
 CASE WHEN id % 40 = 0 THEN '??' ELSE strftime("timestamp", '%d.%m.%y') END AS date,
 strftime("timestamp", '%H:%M:%S') AS time, CASE WHEN id % 13 > 0 THEN message END AS msg,
 {ISO.format('"timestamp"')} AS received_at FROM ev""",
    "rtime": """
SELECT *, CASE WHEN date <> '??' THEN strptime(concat(date, ' ', time), '%d.%m.%y %H:%M:%S')
   AT TIME ZONE 'Europe/Berlin' AT TIME ZONE 'UTC' END AS utc FROM entries""",
    "routed": f"""
SELECT seq, coalesce({ISO.format('utc')}, received_at) AS "timestamp", 'FritzBox' AS host,
 coalesce("group", 'fritzbox') AS facility, 'informational' AS priority,
 rtrim(concat('EventLog-', coalesce(id, '')), '-') AS program, coalesce(msg, '') AS message FROM rtime""",
    "clines": f"""
SELECT id, CASE WHEN program = 'n8n-stderr' THEN 'stderr' ELSE 'stdout' END AS stream,
 CASE WHEN id % 97 = 0 THEN '' WHEN id % 60 = 0 THEN replace(message, ' ', '_')
  WHEN id % 59 = 0 THEN concat('yesterday ', message)
  ELSE concat({ISO.format('"timestamp"')}, '789Z ', message) END AS line,
 {ISO.format('"timestamp"')} AS received_at FROM ev WHERE host = 'n8n'""",
    "csplit": """
SELECT id, stream, received_at,
 CASE WHEN contains(line, ' ') THEN split_part(line, ' ', 1) ELSE received_at END AS ts_text,
 CASE WHEN contains(line, ' ') THEN substr(line, strpos(line, ' ') + 1) ELSE line END AS message
FROM clines WHERE line <> ''""",
    "cmap": r"""
SELECT id, stream, CASE WHEN regexp_matches(ts_text, '^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d+Z$')
   THEN substr(ts_text, 1, 26) ELSE received_at END AS "timestamp",
 'n8n' AS host, 'docker' AS facility, CASE WHEN stream = 'stderr' THEN 'error' ELSE 'informational' END AS priority,
 concat('n8n-', stream) AS program, message FROM csplit""",
    "attempts": """
SELECT event_id, CAST(a AS INTEGER) AS attempt, CASE WHEN (event_id + a) % 5 = 0 THEN 200 ELSE 502 END AS status
FROM events, (SELECT unnest([1, 2, 3, 4]) AS a)""",
    "dout": """
SELECT event_id, min(CASE WHEN attempt <= 3 AND status < 300 THEN attempt END) AS delivered_at_try,
 max(CASE WHEN attempt <= 3 THEN attempt END) AS t FROM attempts GROUP BY event_id""",
    "ticks": """
SELECT tick, arrived, CAST(sum(arrived) OVER (ORDER BY tick ROWS UNBOUNDED PRECEDING) % 4000 AS BIGINT) AS pending
FROM (SELECT date_trunc('hour', ts) AS tick, count(*) AS arrived FROM events GROUP BY 1)""",
    "ke": """
SELECT ev.*, e.ts, e.user_id, e.event_type, e.value,
 CASE e.event_type WHEN 'signup' THEN 'start' WHEN 'purchase' THEN 'end' END AS role
FROM ev JOIN events e ON e.event_id = ev.id""",
}


def _closure(names: tuple[str, ...]) -> set[str]:
    found, todo = set(), list(names)
    while todo:
        name = todo.pop()
        if name not in found:
            found.add(name)
            todo += [v for v in VIEWS if v != name and re.search(rf"\b(FROM|JOIN)\s+{v}\b", VIEWS[name])]
    return found


def sql(body: str, *names: str) -> str:
    used = {v for v in VIEWS if re.search(rf"\b{v}\b", body)} | set(names)
    views = _closure(tuple(used))
    if not views:
        return body
    parts = [f"{v} AS MATERIALIZED ({VIEWS[v].strip()})" for v in VIEWS if v in views]
    body = body.strip()
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(parts) + ",\n" + body[5:]
    return "WITH " + ",\n".join(parts) + "\n" + body
