"""Views over the given tables in the schemas the engine works on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logloom.functions.rules import RULES_V1, RuleSet
from logloom.functions.text import with_fingerprint
from logloom.operators.register import bridge_rows, register_delta

BOM = "\ufeff"
# Fixed value: reviewer whose verdict is final in the test views.
FINAL_REVIEWER = "axel"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(value) -> Column:
    return value.cast("string") if isinstance(value, Column) else F.lit(value)


def _cat(*parts) -> Column:
    return F.concat(*[_text(p) for p in parts])


def monitoring_columns() -> list[Column]:
    """Select list that turns an ``events`` row into a monitoring event."""
    eid, ts, user, kind = F.col("event_id"), F.col("ts"), F.col("user_id"), F.col("event_type")
    host = (F.when(user % 3 == 0, "DiskStation225").when(user % 3 == 1, "FritzBox").otherwise("n8n"))
    dsm_program = (F.when(kind == "view", "Hyper_Backup").when(kind == "error", "Connection")
                   .when(kind == "click", "System").when(kind == "purchase", "WinFileService").otherwise("System"))
    program = (F.when(user % 3 == 0, dsm_program)
               .when(user % 3 == 1, _cat("EventLog-", eid % 4))
               .otherwise(F.when(kind == "error", "n8n-stderr").otherwise("n8n-stdout")))
    prefix = (F.when((user % 3 == 0) & (eid % 10 != 0), _cat("CEF:0|arg_5=tok", eid, "|", BOM)).otherwise(""))
    body = (
        F.when(kind == "view", _cat(
            "Backup task [Synology C2] finished: ", eid % 900 + 1, " MB in ", eid % 60,
            " min, log /var/log/run", eid % 7, "/out.txt"))
        .when(kind == "error", _cat(
            "User admin from 192.168.", eid % 256, ".", user % 256, " failed to sign in at ",
            F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), ", session a1b2", eid + 1000, "x, attempt ", eid % 12))
        .when(kind == "click", _cat(
            "WLAN device 02:00:5e:10:00:", eid % 90 + 10, " on 5.", eid % 900 + 100, " GHz, rate ",
            eid % 1000, " Mbit/s, fe80::", eid % 9000 + 1000))
        .when(kind == "purchase", _cat(
            "Package v22.", eid % 20, ".1 updated,  checksum deadbeef0123456", eid % 10, ", load ", eid % 100, " %"))
        .otherwise(_cat(
            "INFO (42): Skipping operation at 12:", eid % 50 + 10, " on service ",
            F.substring(F.lit("abcdefghijklmnopqrstuvwxyzabcde"), F.day(ts), F.lit(1)),
            " via 10.11.", eid % 120, ".", eid % 200)))
    return [eid.alias("id"), ts.alias("timestamp"), host.alias("host"), program.alias("program"),
            F.concat(prefix, body).alias("message")]


def monitoring_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(*monitoring_columns())


def fingerprinted(spark: SparkSession, sf_dir: str, ruleset: RuleSet = RULES_V1) -> DataFrame:
    # All token rules behind these message columns are one generated method of more than 8,000 bytes, which HotSpot only
    # interprets; above the limit Spark generates the same projection in smaller methods.
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return with_fingerprint(monitoring_events(spark, sf_dir), ruleset)


def bridge(spark: SparkSession, sf_dir: str, forms: DataFrame | None = None) -> DataFrame:
    """From ``forms``, where the fingerprinted events are already written."""
    return bridge_rows(forms or fingerprinted(spark, sf_dir))


def reviewed(register: DataFrame) -> DataFrame:
    """Review state by the length of the form."""
    n, r = F.length("fingerprint") % 5, F.length("fingerprint") % 3
    klasse = F.when(n == 1, "rauschen").when(n == 2, "betrieb").when(n == 3, "relevant").when(n == 4, "kritisch")
    seen = n > 0
    return register.select(
        "*", klasse.alias("klasse"), F.when(seen, _cat("I-0", n)).alias("incident_typ"),
        F.when(seen, F.col("zuletzt")).alias("bewertet_am"),
        F.when(seen, F.when(r == 0, FINAL_REVIEWER).otherwise("llm:test")).alias("bewertet_von"),
        F.when(r == 1, '{"rolle":"start","severity":"warning","stille_minuten":30}').alias("llm_vorschlag"))


def register(spark: SparkSession, sf_dir: str, forms: DataFrame | None = None) -> DataFrame:
    return reviewed(register_delta(forms or fingerprinted(spark, sf_dir)))


def cut_id(spark: SparkSession, sf_dir: str) -> int:
    """First id of the incremental batch: 60 % of the id range."""
    return table(spark, sf_dir, "events").agg(F.max("event_id")).first()[0] * 6 // 10


def as_of(spark: SparkSession, sf_dir: str) -> Column:
    """Latest event time as a scalar subquery; stands in for the clock."""
    return table(spark, sf_dir, "events").agg(F.max("ts")).scalar()


def syslog_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    eid, ts = F.col("id"), F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss")
    header = _cat("<", eid % 192, ">1 ", ts, "+00:00 ", F.col("host"), " ", F.col("program"), " ",
                  F.when(eid % 4 == 0, "-").otherwise(eid.cast("string")), " - ",
                  F.when(eid % 7 == 0, '[a b="c"]').otherwise("-"), " ")
    line = F.when(eid % 50 == 0, F.col("message")).otherwise(F.concat(header, F.col("message")))
    return monitoring_events(spark, sf_dir).select("id", line.alias("line"), _cat(ts, "+00:00").alias("received_at"))


def syslog_captures(spark: SparkSession, sf_dir: str, lines_per_file: int = 300) -> DataFrame:
    """Octet-counted captures of a few hundred lines; the first is cut short."""
    framed = syslog_lines(spark, sf_dir).select(
        F.floor(F.col("id") / lines_per_file).alias("path"), "id",
        F.concat(F.octet_length("line").cast("string"), F.lit(" "), F.col("line")).alias("frame"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", "frame"))), lambda f: f["frame"]), "")
    packed = framed.groupBy("path").agg(F.encode(joined, "UTF-8").alias("content"))
    short = F.substring("content", F.lit(1), F.octet_length("content") - 5)
    return packed.select(F.col("path").cast("string").alias("path"),
                         F.when(F.col("path") == 0, short).otherwise(F.col("content")).alias("content"))


def router_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = monitoring_events(spark, sf_dir)
    eid, ts = F.col("id"), F.col("timestamp")
    return ev.select(
        eid.alias("seq"), ts.alias("event_ts"),
        F.when(eid % 11 > 0, (eid % 4).cast("string")).alias("id"),
        F.when(eid % 3 > 0, F.when(eid % 3 == 1, "net").otherwise("sys")).alias("group"),
        F.when(eid % 40 == 0, "??").otherwise(F.date_format(ts, "dd.MM.yy")).alias("date"),
        F.date_format(ts, "HH:mm:ss").alias("time"),
        F.when(eid % 13 > 0, F.col("message")).alias("msg"),
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("received_at"))


def container_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = monitoring_events(spark, sf_dir).where("host = 'n8n'")
    eid, ts = F.col("id"), F.col("timestamp")
    stamp = _cat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), "789Z")
    line = (F.when(eid % 97 == 0, "").when(eid % 60 == 0, F.regexp_replace("message", " ", "_"))
            .when(eid % 59 == 0, F.concat(F.lit("yesterday "), F.col("message")))
            .otherwise(F.concat(stamp, F.lit(" "), F.col("message"))))
    return ev.select("id", F.when(F.col("program") == "n8n-stderr", "stderr").otherwise("stdout").alias("stream"),
                     line.alias("line"), F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("received_at"))


def delivery_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = monitoring_events(spark, sf_dir).select(F.col("id").alias("event_id"))
    tries = ids.select("event_id", F.explode(F.array(*[F.lit(i) for i in range(1, 5)])).alias("attempt"))
    return tries.withColumn("status", F.when((F.col("event_id") + F.col("attempt")) % 5 == 0, 200).otherwise(502))


def backlog_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly counts, with their running sum modulo 4000 as the backlog."""
    hourly = table(spark, sf_dir, "events").groupBy(
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("tick")).agg(F.count("*").alias("arrived"))
    total = F.sum("arrived").over(W.orderBy("tick").rowsBetween(W.unboundedPreceding, W.currentRow))
    return hourly.select("tick", "arrived", (total % 4000).alias("pending"))


def keyed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monitoring events with the incident keys and roles."""
    ev = table(spark, sf_dir, "events")
    role = F.when(F.col("event_type") == "signup", "start").when(F.col("event_type") == "purchase", "end")
    return ev.select(*monitoring_columns(), F.col("ts"), "user_id", "event_type", "value", role.alias("role"))
