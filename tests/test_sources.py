"""Readers over real files, and time edges."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from logloom.functions import syslog
from logloom.operators import predicates as pred
from logloom.plans import fixtures as fx
from logloom.sources import collect


def test_frames_from_files(spark, sf_dir, tmp_path):
    lines = [r.line for r in fx.syslog_lines(spark, sf_dir).orderBy("id").limit(40).collect()]

    def pack(items):
        return b"".join(f"{len(b)} ".encode() + b for b in (i.encode() for i in items))
    (tmp_path / "a.cap").write_bytes(pack(lines[:20]))
    (tmp_path / "cut.cap").write_bytes(pack(lines[20:30])[:-3])
    (tmp_path / "blocked.cap").write_bytes(pack(lines[30:33]) + b"x5 hello" + pack(lines[33:]))
    (tmp_path / "odd.cap").write_bytes(b"3 a\xffb4 c\xc3\xa4d")
    frames = collect.split_frames(collect.read_captures(spark, str(tmp_path)), batch_rows=7)
    got = {}
    for r in frames.orderBy("path", "frame_no").collect():
        got.setdefault(r.path.rsplit("/", 1)[1], []).append(r.line)
    assert got == {"a.cap": lines[:20], "cut.cap": lines[20:29], "blocked.cap": lines[30:33], "odd.cap": ["a�b", "cäd"]}
    assert collect.read_syslog(spark, str(tmp_path)).count() == 34


@pytest.mark.parametrize("line, want", [
    ("<134>1 2024-07-11T14:00:00+02:00 h app 12 - - hello  ", ("local0", "informational", "app", "12", "", "hello", True)),
    ("<13>1 t h app - id [x y=\"]\"] rest] msg", ("user", "notice", "app", "", "id", "\"] rest] msg", True)),
    ("<999>1 t h app - - - multi\nline", ("facility124", "debug", "app", "", "", "multi\nline", True)),
    ("no header", ("unknown", "unknown", "unknown", "", "", "no header", False)),
])
def test_syslog_line(spark, line, want):
    df = spark.createDataFrame([(line, "now")], "line string, at string")
    r = syslog.parse_lines(df, "line", "at").first()
    assert (r.facility, r.priority, r.program, r.pid, r.msgid, r.message, r.parsed) == want
    assert r.timestamp == ("now" if not want[-1] else line.split()[1])


def test_router_xml_files(spark, tmp_path):
    (tmp_path / "log.xml").write_text(
        "<Log><Event><id>7</id><group> net </group><date>31.03.24</date><time>03:30:00</time><msg> a &lt; b </msg></Event>"
        "<Event><id></id><date>??</date><time>01:00:00</time></Event></Log>")
    rows = collect.map_router(collect.read_router_xml(spark, str(tmp_path)).withColumn("at", F.lit("rx")), "at")
    got = {tuple(r) for r in rows.collect()}
    assert got == {
        ("2024-03-31T01:30:00.000000", "FritzBox", "net", "informational", "EventLog-7", "a < b"),
        ("rx", "FritzBox", "fritzbox", "informational", "EventLog", "")}


@pytest.mark.parametrize("text, want", [
    ("2024-01-02T03:04:05.123456789Z", "2024-01-02T03:04:05.123456"), ("2024-01-02T03:04:05.9Z", "2024-01-02T03:04:05.900000"),
    ("2024-01-02T03:04:05Z", "2024-01-02T03:04:05.000000"), ("2024-01-02T03:04:05+00:00", "rx"),
    ("2024-13-02T03:04:05Z", "rx"), ("x", "rx")])
def test_container_time(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(collect.container_timestamp("t", F.lit("rx"))).first()[0] == want


@pytest.mark.parametrize("utc, want", [
    ("2025-01-10 22:44:59", False), ("2025-01-10 22:45:00", True), ("2025-01-10 23:30:00", True),
    ("2025-01-11 02:59:59", True), ("2025-01-11 03:00:00", False),
    ("2025-07-10 21:45:00", True), ("2025-07-10 21:44:00", False), ("2025-07-11 01:59:00", True), ("2025-07-11 02:00:00", False),
    ("2025-03-30 01:59:00", True), ("2025-03-30 02:00:00", False), ("2025-10-26 02:59:00", True), ("2025-10-26 03:00:00", False)])
def test_blackout(spark, utc, want):
    df = spark.createDataFrame([(datetime.fromisoformat(utc),)], "t timestamp_ntz")
    assert df.select(pred.in_blackout("t")).first()[0] is want


def test_router_time_both_changes(spark):
    df = spark.createDataFrame([("30.03.25", "01:59:59"), ("30.03.25", "03:00:00"), ("26.10.25", "02:30:00"), ("26.10.25", "03:00:00")],
                               "d string, t string")
    got = [str(r[0]) for r in df.select(collect.router_datetime("d", "t").cast("timestamp_ntz")).collect()]
    assert got == ["2025-03-30 00:59:59", "2025-03-30 01:00:00", "2025-10-26 00:30:00", "2025-10-26 02:00:00"]


def test_denylist_default_and_back_reference(spark):
    rows = ['INFO (7): Skipping operation x', '"method":  "get"', "  }  ", "", "keep me", "abab"]
    df = spark.createDataFrame([(r,) for r in rows], "m string")
    kept = [r.m for r in df.where(~pred.is_denylisted("m")).collect()]
    assert kept == ["keep me", "abab"]
    assert [r.m for r in df.where(pred.is_denylisted("m", (r"^(ab)\1$", "keep"))).collect()] == ["keep me", "abab"]


def test_scan_reads_only_what_it_needs(spark, sf_dir):
    docs = collect.scan_events(spark, f"{sf_dir}/documents.parquet", columns={
        "id": "doc_id", "timestamp": "n_chars", "host": "lang", "program": "source", "message": "text"})
    plan = pred.above_mark(docs, 10).select("id", "host")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,lang:string>" in plan and "GreaterThan(doc_id,10)" in plan


def test_backup_is_written_before_filtering(spark, sf_dir, tmp_path):
    lines = collect.split_container_lines(fx.container_lines(spark, sf_dir), "line", "received_at")
    collect.write_backup(lines, str(tmp_path / "backup"), "stream", "ts_text", "message")
    assert spark.read.text(str(tmp_path / "backup")).count() == lines.count()
