"""Rule selection, silences by scope, and loaded denylists against plain Python."""

import random
import re
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from logloom.operators import incidents as inc
from logloom.operators import predicates as pred

T = datetime(2024, 1, 1)


def test_select_rule_prefers_the_specific_one(spark):
    rules = inc.rule_config(spark, [
        dict(rule_name="a-whole", incident_type="X", mechanism="burst", base_severity="info"),
        dict(rule_name="b-any", incident_type="X", mechanism="burst", base_severity="info", match_field="host"),
        dict(rule_name="d-h", incident_type="X", mechanism="burst", base_severity="info", match_field="host", match_value="h"),
        dict(rule_name="c-u", incident_type="X", mechanism="burst", base_severity="info", match_field="user", match_value="u"),
        dict(rule_name="0-off", incident_type="X", mechanism="burst", base_severity="info", active=False),
        dict(rule_name="e-y", incident_type="Y", mechanism="burst", base_severity="info", match_field="host", match_value="")])
    rows = [(1, "X", "h", "u"), (2, "X", "h", None), (3, "X", "g", None), (4, "X", None, None), (5, "Y", "g", None),
            (6, "Z", "h", "u"), (7, None, "h", "u"), (8, "Y", "", None), (8, "Y", "", None)]
    df = spark.createDataFrame(rows, "id int, incident_type string, host string, user string")
    got = inc.select_rule(df, rules, F.create_map(F.lit("host"), F.col("host"), F.lit("user"), F.col("user")))
    assert sorted((r.id, r.rule_name) for r in got.collect()) == [
        (1, "c-u"), (2, "d-h"), (3, "b-any"), (4, "a-whole"), (5, None), (6, None), (7, None), (8, "e-y"), (8, "e-y")]


def test_silences_by_scope(spark):
    rules = inc.rule_config(spark, [
        dict(rule_name="all", mechanism="absence", base_severity="warning", expected_every_minutes=20),
        dict(rule_name="h", mechanism="absence", base_severity="info", match_field="host", match_value="h",
             severity_by_duration='{"30": "error"}', expected_every_minutes=30),
        dict(rule_name="gone", mechanism="absence", base_severity="info", match_field="host", match_value="gone",
             expected_every_minutes=60),
        dict(rule_name="any", mechanism="absence", base_severity="info", match_field="user", expected_every_minutes=50),
        dict(rule_name="typ", incident_type="I-12", mechanism="pair", base_severity="info", expected_every_minutes=70)])
    at = [(0, "h", "u", "I-12"), (5, "g", None, None), (40, "g", "v", None), (75, "h", "u", None), (90, None, "u", "I-12")]
    df = spark.createDataFrame([(T + timedelta(minutes=m), h, u, t) for m, h, u, t in at],
                               "ts timestamp_ntz, host string, user string, incident_type string")
    expected = spark.createDataFrame([("user", "w"), ("other", "x")], "scope string, value string")
    fields = F.create_map(F.lit("host"), F.col("host"), F.lit("user"), F.col("user"))
    since, now = (F.lit(T + timedelta(minutes=m)).cast("timestamp_ntz") for m in (0, 100))
    got = inc.absence_by_rules(df, rules, fields, since, now, expected)

    def minute(t):
        return None if t is None else (t - T).total_seconds() / 60
    rows = {(r.rule_name, r.key, minute(r.last_event), minute(r.opened_at), minute(r.closed_at), r.severity) for r in got.collect()}
    assert rows == {("all", "all", 5, 25, 40, "warning"), ("all", "all", 40, 60, 75, "warning"), ("h", "h", 0, 30, 75, "error"),
                    ("gone", "gone", None, 60, None, "info"), ("any", "u", 0, 50, 75, "info"), ("any", "v", 40, 90, None, "info"),
                    ("any", "w", None, 50, None, "info"), ("typ", "I-12", 0, 70, 90, "info")}


def test_loaded_denylist_drops_lines(spark):
    listed = spark.createDataFrame([(" ^noise\n\n(open\n",), ("(a)b\\1\n(?<n>q)\\k<n>\n[z",), ("\\p{Lu}{3}",)], "pattern string")
    denylist = pred.load_denylist(listed)
    assert {(r.pattern, r.valid) for r in denylist.collect()} == {
        ("^noise", True), ("(open", False), ("(a)b\\1", True), ("(?<n>q)\\k<n>", True), ("[z", False), ("\\p{Lu}{3}", True)}
    lines = ["noise here", "no noise", "xabax", "ab", "qq", "q", "ÄÖÜ", "Äö", None, ""]
    df = spark.createDataFrame([(m,) for m in lines], "message string")
    hits = {r.message: r.denylisted for r in pred.flag_denylisted(df, denylist).collect()}
    assert {m for m, hit in hits.items() if hit} == {"noise here", "xabax", "qq", "ÄÖÜ"}
    assert not pred.flag_denylisted(df, denylist.where("not valid")).where("denylisted").count()
    same = {m for m in filter(None, lines) if any(re.search(p, m) for p in ("^noise", "(a)b\\1", "(?P<n>q)(?P=n)", "[A-ZÄÖÜ]{3}"))}
    assert same == {m for m, hit in hits.items() if hit}


def test_backup_holds_filtered_lines_and_replays_once(spark, tmp_path):
    from logloom.streaming import streams
    rows = [("container", "stdout", "2024-01-01T00:00:00.5Z kept line", "2024-02-01T00:00:00.000000"),
            ("container", "stderr", "2024-01-01T00:00:01Z Deregistered all crons", "2024-02-01T00:00:00.000000"),
            ("syslog", None, "<14>1 2024-01-01T01:00:00+01:00 h app 1 - - text", "2024-02-01T00:00:00.000000"),
            ("router", None, "<Event><id>1</id><group>g</group><date>01.01.24</date><time>01:00:00</time><msg>m</msg></Event>",
             "2024-02-01T00:00:00.000000")]
    raw = spark.createDataFrame(rows, streams.RAW_SCHEMA)
    for _ in range(2):
        streams.ingest_batch(raw, str(tmp_path), 3)
    backup = sorted(r.value for r in spark.read.text(str(tmp_path / "backup" / "batch=3")).collect())
    assert len(backup) == 4 and any("Deregistered all crons" in v for v in backup)
    events = spark.read.parquet(str(tmp_path / "events" / "batch=3"))
    assert sorted(r.message for r in events.collect()) == ["kept line", "m", "text"]
    times = {r.message: r.t for r in events.select("message", F.col("event_ts").cast("timestamp_ntz").alias("t")).collect()}
    assert times == {"kept line": T + timedelta(seconds=0.5), "text": T, "m": T}


def _scope_rules(spark, minutes=(7, 20, 45)):
    rules = [dict(rule_name=f"all{m}", mechanism="absence", base_severity="info", expected_every_minutes=m) for m in minutes]
    rules.append(dict(rule_name="any", mechanism="absence", base_severity="info", match_field="host", expected_every_minutes=30))
    return inc.rule_config(spark, rules)


def test_silences_of_several_limits_against_plain_python(spark):
    """Stretches are as long as the scope's shortest limit, also before 1970 and where gaps equal a limit."""
    rng, clock, rows = random.Random(5), datetime(1969, 12, 31, 20), []
    for _ in range(250):
        clock += timedelta(seconds=rng.choice([0, 0, 1, 60, 419, 420, 421, 1200, 1201, 1800, 1801, 2700, 2701]))
        rows.append((clock, rng.choice(["h", "h", "g", None])))
    df = spark.createDataFrame(rows + [(None, "h")], "ts timestamp_ntz, host string").withColumn("incident_type", F.lit(None).cast("string"))
    since, now = (F.lit(t).cast("timestamp_ntz") for t in (rows[3][0], clock))
    got = inc.absence_by_rules(df, _scope_rules(spark), F.create_map(F.lit("host"), F.col("host")), since, now, width=900)
    got = sorted(((r.rule_name, r.key, r.last_event, r.closed_at) for r in got.collect()), key=repr)
    want = []
    for name, minutes in (("all7", 7), ("all20", 20), ("all45", 45), ("any", 30)):
        for key in ("h", "g") if name == "any" else ("all",):
            at = sorted(t for t, host in rows if t >= rows[3][0] and key in ("all", host))
            at = [(t, 1) for t in at] if name == "any" else [(rows[3][0], 0), *((t, 1) for t in at)]
            want += [(name, key, a if heard else None, b if b is not None else None)
                     for (a, heard), b in zip(at, [*(t for t, _ in at[1:]), None])
                     if (b or clock) > a + timedelta(minutes=minutes)]
    assert got == sorted(want, key=repr) and len({r[0] for r in got}) == 4


def _exchanges(df):
    """The keys by which the plan's shuffles deal rows out, before anything has run."""
    plan = df._jdf.queryExecution().executedPlan().treeString()
    return [re.sub(r"#\d+", "", keys).split(", ")[:-1] for keys in re.findall(r"hashpartitioning\(([^)]*)\)", plan)]


def _one_rule(spark):
    df = spark.range(50).select(
        "id", (F.lit(T).cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id"))).alias("ts"), F.lit("h").alias("host"),
        F.lit("start").alias("role"), F.lit("I-1").alias("incident_type"), F.lit("r").alias("rule_name"))
    return df, F.lit(T + timedelta(minutes=1)).cast("timestamp_ntz")


def test_no_task_takes_a_whole_scope(spark):
    df, now = _one_rule(spark)
    fields, since = F.create_map(F.lit("host"), F.col("host")), F.lit(T).cast("timestamp_ntz")
    dealt = _exchanges(inc.absence_by_rules(df, _scope_rules(spark), fields, since, now))
    # Events leave their tasks as stretches, and no shuffle deals single instants.
    assert [k for k in dealt if "_beginsL" in k] and not [k for k in dealt if k == ["scope", "value", "ts"]]


def test_no_task_takes_a_whole_rule(spark):
    df, now = _one_rule(spark)
    small = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(small)
    spark.conf.set(small, "-1")  # as where the planner does not know that the rules are few
    try:
        for evaluate, kind in ((inc.pair_by_rules, "pair"), (inc.burst_by_rules, "burst")):
            rules = inc.rule_config(spark, [dict(rule_name="r", mechanism=kind, base_severity="info")])
            assert ["rule_name"] not in _exchanges(evaluate(df, rules, "host", now))
    finally:
        spark.conf.set(small, before)
