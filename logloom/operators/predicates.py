"""Filters: denylist, poll window, id marks, blackout and admission."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Default denylist, poll and backlog settings, blackout bounds.
DENYLIST = (
    r"INFO \(\d+\): Skipping operation",
    r'"operationId":',
    r'"method":\s*"(get|post|put|delete|patch)"',
    r'"pattern":\s*"/api/',
    r"^\s*operation:\s*\{",
    r"^\s*\}\s*$",
    r"Refresh token rotated and new access token issued",
    r"Deregistered all crons",
    r"Pruning old insights data",
    r"\[DEP0060\] DeprecationWarning",
    r"Use `node --trace-deprecation",
    r"^\s*$",
)
POLL_SECONDS, OVERLAP_SECONDS, LOOKBACK_SECONDS = 600, 120, 24 * 3600
LARGE_BACKLOG = 2000
BLACKOUT_START, BLACKOUT_END, LOCAL_ZONE = "23:45", "04:00", "Europe/Berlin"


# --- denylist --------------------------------------------------------------

def load_denylist(patterns: DataFrame, column: str = "pattern") -> DataFrame:
    """Stripped, non-empty patterns with a validity flag; the list stays a
    table of any length."""
    from logloom.functions.text import strip_space
    lines = (
        patterns.select(F.posexplode(F.split(F.col(column), "\n")).alias("pos", "raw"))
        .select(strip_space("raw").alias("pattern")).where("pattern <> ''").distinct()
    )
    return lines.select("pattern", is_valid_pattern("pattern").alias("valid"))


def is_valid_pattern(pattern: Column | str) -> Column:
    """Whether the matcher that will run the pattern accepts it."""
    pattern = F.col(pattern) if isinstance(pattern, str) else pattern
    return F.try_reflect(F.lit("java.util.regex.Pattern"), F.lit("compile"), F.concat(F.lit("(?U)"), pattern)).isNotNull()


def flag_denylisted(lines: DataFrame, denylist: DataFrame, message: str = "message", flag: str = "denylisted") -> DataFrame:
    """Adds whether any valid pattern of a loaded denylist (see
    ``load_denylist``) is found anywhere in the message.

    The valid patterns become one alternation, a scalar of the plan, whose
    compiled form the search keeps from row to row.  Patterns with groups that
    are named or referred to stay apart, because joining would renumber them.
    """
    apart = F.col("pattern").rlike(r"\\[1-9k]|\(\?<[A-Za-z]")
    joined = F.array_join(F.array_sort(F.collect_list(F.when(~apart, F.concat(F.lit("(?:"), "pattern", F.lit(")"))))), "|")
    alone = F.array_sort(F.collect_list(F.when(apart, F.concat(F.lit("(?U)"), "pattern"))))
    valid = denylist.where("valid")
    rows = lines.withColumns({"_one": valid.agg(F.concat(F.lit("(?U)"), F.nullif(joined, F.lit(""))).alias("p")).scalar(),
                              "_rest": valid.agg(alone.alias("p")).scalar()})
    found = F.coalesce(F.regexp_instr(message, F.col("_one")) > 0, F.lit(False))
    rest = F.coalesce(F.exists("_rest", lambda p: F.regexp_instr(message, p) > 0), F.lit(False))
    return rows.withColumn(flag, found | rest).drop("_one", "_rest")


def is_denylisted(message: Column | str, patterns=DENYLIST) -> Column:
    """Any pattern found anywhere in the message: one search for their
    alternation, compiled once per task.  Patterns with back references keep
    their own search, because joining them would renumber their groups."""
    message = F.col(message) if isinstance(message, str) else message
    if not patterns:
        return F.lit(False)
    alone = [p for p in patterns if re.search(r"\\[1-9k]", p)]
    joined = "|".join(f"(?:{p})" for p in patterns if p not in alone)
    searches = [message.rlike("(?U)" + p) for p in ([joined] if joined else []) + alone]
    return F.coalesce(reduce(Column.__or__, searches), F.lit(False))


def denylist_counters(lines: DataFrame, by: str, message: str = "message", patterns=DENYLIST) -> DataFrame:
    flagged = lines.select(by, is_denylisted(message, patterns).alias("_hit"))
    return flagged.groupBy(by).agg(
        F.count("*").alias("seen"),
        F.count_if("_hit").alias("filtered"),
        F.count_if(~F.col("_hit")).alias("forwarded"))


# --- time windows ----------------------------------------------------------

def _seconds(n: int) -> Column:
    return F.make_dt_interval(secs=F.lit(n))


def poll_cutoff(now: Column, mark: Column) -> Column:
    """Lower bound of a poll: the mark, but at most a day back; without a
    mark one interval plus the overlap."""
    return F.when(mark.isNull(), now - _seconds(POLL_SECONDS + OVERLAP_SECONDS)).otherwise(
        F.greatest(mark, now - _seconds(LOOKBACK_SECONDS)))


def poll_window(entries: DataFrame, ts: str, now: Column, mark: Column) -> DataFrame:
    """Entries at or after the cutoff; those without a time fall out."""
    return entries.where(F.col(ts) >= poll_cutoff(now, mark))


def above_mark(events: DataFrame, mark: Column | int, since: Column | None = None) -> DataFrame:
    """Events strictly above the id mark, optionally not older than ``since``."""
    out = events.where(F.col("id") > mark)
    return out if since is None else out.where(F.col("timestamp") >= since)


def local_time(ts: Column | str, zone: str = LOCAL_ZONE) -> Column:
    return F.from_utc_timestamp(F.col(ts) if isinstance(ts, str) else ts, zone)


def in_blackout(ts: Column | str, start: str = BLACKOUT_START, end: str = BLACKOUT_END,
                zone: str = LOCAL_ZONE) -> Column:
    """Local wall clock in [start, end), wrapping midnight if start > end."""
    clock = F.date_format(local_time(ts, zone), "HH:mm")
    return (clock >= start) & (clock < end) if start <= end else (clock >= start) | (clock < end)


def admission(pending: Column, blackout: Column, mode: str, forced: bool = False,
              running: bool = False, limit: int = LARGE_BACKLOG) -> Column:
    """What a tick does: follow defers a large backlog inside the blackout,
    backfill refuses it, a running backfill pauses there at any backlog."""
    held = blackout & (pending > limit)
    if mode == "follow":
        held_word = "defer"
    else:
        held_word = "pause" if running else "refuse"
        held = F.lit(False) if forced else (blackout if running else held)
    return F.when(held, held_word).when(pending > 0, "process").otherwise("idle")
