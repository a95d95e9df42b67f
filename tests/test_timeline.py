"""Sliced windows against plain Python, with one key holding most rows."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from logloom.operators import incidents as inc
from logloom.operators import timeline as tl

START = datetime(2024, 3, 1)


@pytest.fixture(scope="module")
def events():
    rng, rows, clock = random.Random(3), [], START
    for i in range(600):
        clock += timedelta(seconds=rng.choice([0, 5, 40, 300, 300, 2000, 9000]))
        key = "hot" if rng.random() < 0.7 else rng.choice("abc")
        rows.append((i, key, clock, rng.choice(["start", "end", None])))
    return rows


@pytest.fixture(scope="module")
def frame(spark, events):
    return spark.createDataFrame(events, "id int, key string, ts timestamp_ntz, role string").repartition(3)


def by_key(events):
    out = defaultdict(list)
    for i, key, ts, role in events:
        out[key].append((ts, i, role))
    return {k: sorted(v, key=lambda r: r[:2]) for k, v in out.items()}


def plain_burst(events, threshold, window, silence, escalate=None, escalate_window=None):
    out = {}
    for key, rows in by_key(events).items():
        times, episodes = [r[0] for r in rows], []
        for t in times:
            if not episodes or (silence is not None and t > episodes[-1][-1] + timedelta(minutes=silence)):
                episodes.append([])
            episodes[-1].append(t)
        for ep in episodes:
            def count(t, minutes, first=None):
                low = t - timedelta(minutes=minutes) if minutes is not None else (first or ep[0])
                return sum(low <= x <= t for x in ep)
            opened = next((t for t in ep if count(t, window) >= threshold), None)
            if opened:
                more = None
                if escalate:
                    more = next((t for t in ep if t >= opened and count(t, escalate_window, opened) >= escalate), None)
                out[(key, ep[0])] = (opened, ep[-1], len(ep), more)
    return out


CASES = [(3, 15, 60, None, None), (2, 30, 30, 4, 60), (5, None, 120, None, None), (4, None, None, 9, None),
         (6, 240, 300, 8, 600), (1, 5, None, 3, 15)]


@pytest.mark.parametrize("case", CASES, ids=str)
@pytest.mark.parametrize("width", [900, 3600])
def test_burst(frame, events, case, width):
    threshold, window, silence, escalate, escalate_window = case
    got = inc.burst(frame, ["key"], threshold, window, silence, escalate, escalate_window, width)
    got = {(r.key, r.episode): (r.opened_at, r.last_event, r.events, getattr(r, "escalated_at", None) if escalate else None)
           for r in got.collect()}
    assert got == plain_burst(events, *case)


def test_pair(frame, events):
    want = set()
    for key, rows in by_key(events).items():
        opened = None
        for ts, i, role in rows:
            if role == "start" and opened is None:
                opened = (key, i, ts)
            elif role == "end" and opened is not None:
                want.add((*opened, ts))
                opened = None
        if opened:
            want.add((*opened, None))
    got = {(r.key, r.start_id, r.opened_at, r.closed_at) for r in inc.pair(frame, ["key"], width=1200).collect()}
    assert got == want


@pytest.mark.parametrize("keys", [["key"], []])
def test_absence(frame, events, keys):
    groups = by_key(events) if keys else {"": sorted((e[2], e[0], None) for e in events)}
    as_of, want = max(e[2] for e in events) + timedelta(minutes=500), set()
    for key, rows in groups.items():
        times = [r[0] for r in rows]
        for a, b in zip(times, times[1:] + [None]):
            if (b or as_of) > a + timedelta(minutes=45):
                want.add((key, a, b))
    got = inc.absence(frame, keys, 45, F.lit(as_of).cast("timestamp_ntz"), 1800)
    assert {(r.key if keys else "", r.last_event, r.closed_at) for r in got.collect()} == want


def test_reopen(spark):
    at = lambda m: START + timedelta(minutes=m)
    rows = [("k", at(0), at(5)), ("k", at(8), at(20)), ("k", at(60), at(61)), ("k", at(63), None)]
    df = spark.createDataFrame(rows, "key string, opened_at timestamp_ntz, closed_at timestamp_ntz")
    got = sorted((r.incident_opened_at, r.incident_closed_at, r.openings) for r in inc.reopen(df, ["key"], 5, 600).collect())
    assert got == [(at(0), at(20), 2), (at(60), None, 2)]


def test_neighbours_and_running_sum(frame, events):
    rows = tl.sliced(frame, "ts", 700)
    order = ["ts", "id"]
    out = tl.previous(rows, ["key"], order, F.col("id"), "prev")
    out = tl.following(out, ["key"], order, F.col("id"), "next")
    out = tl.running_sum(out, ["key"], order, F.col("id"), "sum")
    got = {r.id: (r.prev, r.next, r.sum) for r in out.collect()}
    for rows_ in by_key(events).values():
        ids, total = [r[1] for r in rows_], 0
        for i, (a, b, c) in enumerate(zip([None] + ids, ids, ids[1:] + [None])):
            total += b
            assert got[b] == (a, c, total)


def test_hot_key_is_spread(frame):
    """The window partitioning names the slice, not the key alone."""
    plan = inc.burst(frame, ["key"], 3, 15, 60)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(key" in plan and "_slice" in plan


def test_event_without_key_is_left_out(spark):
    df = spark.createDataFrame([(None, START), ("a", START)], "key string, ts timestamp_ntz")
    assert inc.burst(df, ["key"], 1).count() == 1


def test_windows_given_as_column(frame, events):
    """Keys with windows of their own, among them none, in one sweep."""
    windows = {"hot": 40, "a": 5, "b": None, "c": 700}
    pts = tl.points(frame, ["key"]).withColumn("m", F.create_map(*[F.lit(x) for kv in windows.items() for x in kv])[F.col("key")])
    got = {(r.key, r.ts): r.c for r in tl.rolling_by_column(pts, ["key"], {"c": "m"}, 900).collect()}
    for key, rows in by_key(events).items():
        for t in {r[0] for r in rows}:
            low = START - timedelta(days=1) if windows[key] is None else t - timedelta(minutes=windows[key])
            assert got[(key, t)] == sum(low <= r[0] <= t for r in rows)


PAIRS = [dict(rule_name="quiet", autoclose_silence_minutes=30), dict(rule_name="grace", pair_reopen_grace_minutes=90),
         dict(rule_name="both", autoclose_silence_minutes=45, pair_reopen_grace_minutes=60, open_delay_seconds=200),
         dict(rule_name="plain")]


def plain_pairs(rows, rule, as_of):
    quiet, grace = (rule.get(c) for c in ("autoclose_silence_minutes", "pair_reopen_grace_minutes"))
    delay, out, opened, before = rule.get("open_delay_seconds", -1), [], None, None
    for ts, i, role in [r for r in rows if r[2]] + [(as_of + timedelta(days=99), None, None)]:
        if opened and quiet and ts > before + timedelta(minutes=quiet):
            end = before + timedelta(minutes=quiet)
            out.append((*opened, end if end <= as_of else None))
            opened = None
        if opened and (role == "end" or role is None):
            out.append((*opened, ts if role else None))
            opened = None
        elif role == "start" and not opened:
            opened = (i, ts)
        before = ts
    out = [r for r in out if r[2] is None or r[2] > r[1] + timedelta(seconds=delay)]
    merged = []
    for i, ts, end in out:
        last = merged[-1] if merged else None
        if last and grace and last[2] and ts <= last[2] + timedelta(minutes=grace):
            merged[-1] = (last[0], last[1], end)
        else:
            merged.append((i, ts, end))
    return set(merged)


def test_pair_rules_close_by_silence_and_continue_within_grace(spark, frame, events):
    rules = inc.rule_config(spark, [dict(incident_type="I-03", mechanism="pair", base_severity="info") | r for r in PAIRS])
    rows = frame.crossJoin(spark.createDataFrame([(r["rule_name"],) for r in PAIRS], "rule_name string"))
    as_of = max(e[2] for e in events)
    out = inc.pair_by_rules(rows, rules, "key", F.lit(as_of).cast("timestamp_ntz"), 1800).collect()
    for rule in PAIRS:
        for key, own in by_key(events).items():
            got = {(r.start_id, r.opened_at, r.closed_at) for r in out if r.rule_name == rule["rule_name"] and r.key == key}
            assert got == plain_pairs(own, rule, as_of), (rule, key)


def test_rules_escalate_by_incidents(spark):
    """The third incident within an hour is raised, one of another key is not; the plan does not grow with the rules."""
    at = lambda m: START + timedelta(minutes=m)
    rule = dict(rule_name="r", incident_type="I-08", mechanism="burst", base_severity="warning", autoclose_silence_minutes=5,
                escalate_count=3, escalate_window_minutes=60, escalate_basis="incidents", escalate_to_severity="error")
    schema = "id int, key string, ts timestamp_ntz, role string, rule_name string, incident_type string"
    rows = [(i, k, at(m), None, "r", "I-08") for i, (k, m) in enumerate(
        [("a", 0), ("a", 20), ("b", 25), ("a", 60), ("a", 121)])]
    rows += [(9, None, at(1), None, "r", "I-08"), (10, "a", None, None, "r", "I-08"), (11, "a", at(2), None, None, None)]
    events = spark.createDataFrame(rows, schema)
    starts, now = spark.createDataFrame([], "target string, ts timestamp_ntz"), F.lit(at(200)).cast("timestamp_ntz")

    def found(rules):
        return inc.incidents_by_rules(events, inc.rule_config(spark, rules), "key", F.create_map(F.lit("host"), F.col("key")),
                                      starts, F.lit(START).cast("timestamp_ntz"), now)

    def exchanges(df):
        return df._jdf.queryExecution().executedPlan().toString().count("Exchange ")
    one = found([rule])
    size = exchanges(one)
    got = {(r.kind, r.key, r.opened_at, r.closed_at, r.escalated_at, r.severity) for r in one.collect()}
    assert got == {("burst", k, at(m), at(m + 5), at(m) if up else None, "error" if up else "warning")
                   for k, m, up in [("a", 0, 0), ("a", 20, 0), ("b", 25, 0), ("a", 60, 1), ("a", 121, 0)]}
    many = [rule] + [rule | dict(rule_name=f"r{n}", escalate_window_minutes=n, open_window_minutes=n) for n in range(1, 20)]
    assert exchanges(found(many)) == size
