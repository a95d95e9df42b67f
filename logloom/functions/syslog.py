"""RFC 5424 lines as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import strip_space

# RFC 5424 line layout, facility and severity names, and the
# severity vocabulary of the incident rules.
LINE_PATTERN = (
    r"(?Us)^<(\d{1,3})>(\d+)\s+(\S+)\s+(\S+)\s+(\S+)\s+(\S+)\s+(\S+)\s+(?:\[.*?\]|-)\s?(.*)$"
)
FACILITIES = {
    0: "kern", 1: "user", 2: "mail", 3: "daemon", 4: "auth", 5: "syslog", 6: "lpr", 7: "news",
    8: "uucp", 9: "cron", 10: "authpriv", 11: "ftp", 16: "local0", 17: "local1", 18: "local2",
    19: "local3", 20: "local4", 21: "local5", 22: "local6", 23: "local7",
}
SEVERITIES = {
    0: "emergency", 1: "alert", 2: "critical", 3: "error",
    4: "warning", 5: "notice", 6: "informational", 7: "debug",
}
RULE_SEVERITY = {
    "emergency": "critical", "alert": "critical", "critical": "critical", "error": "error",
    "warning": "warning", "notice": "info", "informational": "info", "debug": "info",
}


def _lookup(names: dict, key: Column) -> Column:
    pairs = [F.lit(part) for item in names.items() for part in item]
    return F.element_at(F.create_map(*pairs), key)


def facility_name(pri: Column) -> Column:
    code = F.shiftright(pri, 3)
    return F.coalesce(_lookup(FACILITIES, code), F.concat(F.lit("facility"), code.cast("string")))


def severity_name(pri: Column) -> Column:
    code = pri.bitwiseAND(7)
    return F.coalesce(_lookup(SEVERITIES, code), F.concat(F.lit("severity"), code.cast("string")))


def rule_severity(priority: Column) -> Column:
    """Syslog severity name to the rule vocabulary; unknown names are null."""
    return _lookup(RULE_SEVERITY, priority)


def parse_lines(lines: DataFrame, line: str, received_at: str) -> DataFrame:
    """Replace ``line`` and ``received_at`` (ISO text) by the event columns.

    A line that does not match is kept whole and marked, with the time it was
    received; that time is a column so that a rerun gives the same rows.
    """
    raw = F.col("_raw")
    # One match rewrites the line to its fields.  They hold no whitespace, so
    # a line feed separates them; the message comes last and may hold any.
    parts = F.split(F.regexp_replace(raw, LINE_PATTERN, "$1\n$3\n$4\n$5\n$6\n$7\n$8"), "\n", 7)
    part = lambda n: F.get(F.col("_parts"), F.lit(n))
    dash = lambda c: F.when(c == "-", "").otherwise(c)
    pri, known, unknown = part(0).try_cast("int"), F.col("parsed"), F.lit("unknown")
    keep = [c for c in lines.columns if c not in (line, received_at)]
    at = F.col(received_at).alias("_at")
    staged = lines.select(*keep, at, strip_space(line).alias("_raw"))
    staged = staged.select(*keep, "_at", "_raw", raw.rlike(LINE_PATTERN).alias("parsed"), parts.alias("_parts"))
    return staged.select(
        *keep,
        F.when(known, part(1)).otherwise(F.col("_at")).alias("timestamp"),
        F.when(known, part(2)).otherwise(unknown).alias("host"),
        F.when(known, facility_name(pri)).otherwise(unknown).alias("facility"),
        F.when(known, severity_name(pri)).otherwise(unknown).alias("priority"),
        F.when(known, part(3)).otherwise(unknown).alias("program"),
        F.when(known, dash(part(4))).otherwise("").alias("pid"),
        F.when(known, dash(part(5))).otherwise("").alias("msgid"),
        F.when(known, strip_space(part(6))).otherwise(F.col("_raw")).alias("message"),
        known,
    )
