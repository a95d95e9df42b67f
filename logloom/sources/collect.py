"""Readers and mappers of the three collectors, and their common schema."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.functions.syslog import parse_lines

# Constants the mappers write, and the router's time zone.
ROUTER_HOST = "FritzBox"
ROUTER_FACILITY = "fritzbox"
ROUTER_PRIORITY = "informational"
ROUTER_ZONE = "Europe/Berlin"
ROUTER_TIME_FORMAT = "dd.MM.yy HH:mm:ss"
CONTAINER_FACILITY = "docker"
WIRE_FIELDS = ("timestamp", "host", "facility", "priority", "program", "message")
ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


# --- event table -----------------------------------------------------------

def scan_events(spark: SparkSession, path: str | None = None, fmt: str = "parquet",
                columns: dict[str, str] | None = None, **options: str) -> DataFrame:
    """The event table under its configured column names.

    ``columns`` maps the engine's names (id, timestamp, host, program,
    message) to the source's.  Only those are read.  For ``fmt='jdbc'`` pass
    partitionColumn, lowerBound, upperBound and numPartitions as options so
    that the read is split over the executors.
    """
    reader = spark.read.format(fmt).options(**options)
    return select_events(reader.load(path) if path else reader.load(), columns)


def select_events(df: DataFrame, columns: dict[str, str] | None = None) -> DataFrame:
    names = {c: c for c in ("id", "timestamp", "host", "program", "message")} | (columns or {})
    return df.select(*[F.col(source).alias(name) for name, source in names.items()])


# --- syslog ----------------------------------------------------------------

def _frames_of(content: bytes) -> Iterator[str]:
    position, end = 0, len(content)
    while position < end:
        blank = content.find(b" ", position)
        if blank < 0:
            return
        header = content[position:blank]
        if not header.isdigit():
            return
        start, stop = blank + 1, blank + 1 + int(header)
        if stop > end:
            return
        yield content[start:stop].decode("utf-8", errors="replace")
        position = stop


def split_frames(captures: DataFrame, batch_rows: int = 10_000, keep: tuple[str, ...] = ()) -> DataFrame:
    """Octet-counted frames of ``(path, content)`` rows, one row per frame,
    with the capture's columns named in ``keep``.

    Incomplete tails stay unread and a non-numeric header blocks the rest of
    its capture.  Captures are spread over tasks by file; a task holds one
    capture and emits its frames in batches.
    """
    names = ["path", "frame_no", "line", *keep]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for path, content, *more in zip(part["path"], part["content"], *(part[c] for c in keep)):
                rows: list[tuple] = []
                for number, text in enumerate(_frames_of(bytes(content))):
                    rows.append((path, number, text, *more))
                    if len(rows) == batch_rows:
                        yield pd.DataFrame(rows, columns=names)
                        rows = []
                if rows:
                    yield pd.DataFrame(rows, columns=names)

    taken = captures.select("path", "content", *keep)
    kinds = [f"`{c}` {taken.schema[c].dataType.simpleString()}" for c in keep]
    return taken.mapInPandas(run, ", ".join(["path string, frame_no long, line string", *kinds]))


def read_captures(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def read_syslog(spark: SparkSession, path: str) -> DataFrame:
    """Framed captures to events; the file's own time stands in for the
    time of receipt of unparsed lines."""
    files = spark.read.format("binaryFile").load(path)
    timed = files.select("path", "content", F.date_format("modificationTime", ISO).alias("received_at"))
    return parse_lines(split_frames(timed, keep=("received_at",)), "line", "received_at")


# --- router ----------------------------------------------------------------

ROUTER_SCHEMA = "id string, `group` string, date string, time string, msg string"


def read_router_xml(spark: SparkSession, path: str, row_tag: str = "Event") -> DataFrame:
    return trim_entries(
        spark.read.format("xml").option("rowTag", row_tag).option("ignoreSurroundingSpaces", "true")
        .option("nullValue", "\x00").schema(ROUTER_SCHEMA).load(path))


def parse_router_xml(df: DataFrame, xml: str) -> DataFrame:
    """The same from one XML element per row."""
    entry = F.from_xml(F.col(xml), ROUTER_SCHEMA, {"ignoreSurroundingSpaces": "true", "nullValue": "\x00"})
    keep = [c for c in df.columns if c != xml]
    return trim_entries(df.select(*keep, entry.alias("_entry")).select(*keep, "_entry.*"))


def trim_entries(df: DataFrame) -> DataFrame:
    from logloom.functions.text import strip_space
    fields = [c.strip().split(" ")[0].strip("`") for c in ROUTER_SCHEMA.split(",")]
    return df.select(*[strip_space(c).alias(c) if c in fields else F.col(c) for c in df.columns])


def router_datetime(date: Column | str, time: Column | str) -> Column:
    """UTC instant of a local date and time; null when missing or malformed."""
    date, time = (F.col(c) if isinstance(c, str) else c for c in (date, time))
    text = F.concat(date, F.lit(" "), time)
    return F.to_utc_timestamp(F.try_to_timestamp(text, F.lit(ROUTER_TIME_FORMAT)), ROUTER_ZONE)


def map_router(entries: DataFrame, received_at: str, keep: tuple[str, ...] = ()) -> DataFrame:
    entry_id = F.coalesce("id", F.lit(""))
    return entries.select(
        *keep,
        F.coalesce(F.date_format(router_datetime("date", "time"), ISO), F.col(received_at)).alias("timestamp"),
        F.lit(ROUTER_HOST).alias("host"),
        F.coalesce("group", F.lit(ROUTER_FACILITY)).alias("facility"),
        F.lit(ROUTER_PRIORITY).alias("priority"),
        F.regexp_replace(F.concat(F.lit("EventLog-"), entry_id), "-+$", "").alias("program"),
        F.coalesce("msg", F.lit("")).alias("message"),
    )


# --- container -------------------------------------------------------------

def split_container_lines(lines: DataFrame, line: str, received_at: str) -> DataFrame:
    """``ts_text`` and ``message``; empty lines dropped, a line without a
    blank gets the time of receipt."""
    text = F.regexp_replace(F.col(line), "\n+$", "")
    parts = F.split(text, " ", 2)
    whole = F.size(parts) < 2
    keep = [c for c in lines.columns if c != line]
    return lines.where(text != "").select(
        *keep,
        F.when(whole, F.col(received_at)).otherwise(F.get(parts, F.lit(0))).alias("ts_text"),
        F.when(whole, text).otherwise(F.get(parts, F.lit(1))).alias("message"),
    )


def container_timestamp(ts_text: Column | str, received_at: Column | str) -> Column:
    """ISO text with six fraction digits (cut, not rounded, and padded);
    anything but a UTC ``Z`` time falls back to the time of receipt."""
    ts_text, received_at = (F.col(c) if isinstance(c, str) else c for c in (ts_text, received_at))
    shape = r"^(\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2})(?:\.(\d*))?Z$"
    head = F.regexp_extract(ts_text, shape, 1)
    fraction = F.rpad(F.substring(F.regexp_extract(ts_text, shape, 2), 1, 6), 6, "0")
    real = F.try_to_timestamp(head, F.lit("yyyy-MM-dd'T'HH:mm:ss")).isNotNull()
    return F.when(real, F.concat(head, F.lit("."), fraction)).otherwise(received_at)


def map_container(lines: DataFrame, stream: str, timestamp: str, message: str,
                  keep: tuple[str, ...] = (), host: str = "n8n") -> DataFrame:
    return lines.select(
        *keep,
        F.col(timestamp).alias("timestamp"),
        F.lit(host).alias("host"),
        F.lit(CONTAINER_FACILITY).alias("facility"),
        F.when(F.col(stream) == "stderr", "error").otherwise("informational").alias("priority"),
        F.concat(F.lit("n8n-"), F.col(stream)).alias("program"),
        F.col(message).alias("message"),
    )


# --- common ----------------------------------------------------------------

def union_events(*sources: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)


def event_json(*fields: str) -> Column:
    """JSON body with fields in the given order and null fields kept."""
    return F.to_json(F.struct(*(fields or WIRE_FIELDS)), {"ignoreNullFields": "false"})


def backup_line(*parts: str) -> Column:
    """Raw line as it goes into the backup, before any filter."""
    return F.regexp_replace(F.concat_ws(" ", *parts), "\n+$", "")


def write_backup(df: DataFrame, path: str, *parts: str) -> None:
    df.select(backup_line(*parts).alias("value")).write.mode("append").text(path)


def delivery_outcome(attempts: DataFrame, max_retries: int = 3, backoff_seconds: float = 1.0) -> DataFrame:
    """One row per event of an attempts log ``(event_id, attempt, status)``.

    Delivered when a counted attempt has a status below 300; the wait is
    linear between tries, so k tries wait ``backoff * k * (k - 1) / 2``.
    """
    counted = F.col("attempt") <= max_retries
    success = F.min(F.when(counted & (F.col("status") < 300), F.col("attempt")))
    tries = F.max(F.when(counted, F.col("attempt")))
    out = attempts.groupBy("event_id").agg(success.alias("delivered_at_try"), tries.alias("_tries"))
    used = F.coalesce("delivered_at_try", "_tries")
    return out.select(
        "event_id", "delivered_at_try",
        F.col("delivered_at_try").isNotNull().alias("delivered"),
        used.alias("tries"),
        (F.lit(backoff_seconds) * used * (used - 1) / 2).alias("waited_seconds"),
    )


def dead_letters(outcome: DataFrame, events: DataFrame) -> DataFrame:
    """Undelivered events with the whole report text, and its head for a list."""
    failed = outcome.where(~F.col("delivered")).select("event_id", "tries")
    return events.join(failed, events["id"] == failed["event_id"]).select(
        "event_id", "tries", F.col("message").alias("report_text"), F.substring("message", 1, 100).alias("report_head"))


# --- co-located tables -----------------------------------------------------

def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, partition_by: tuple[str, ...] = ()) -> None:
    """Save as a table bucketed and sorted by an id, so that joins on that id
    with another table of as many buckets need no shuffle."""
    writer = df.write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)
