"""The register of forms, the event bridge, and what is reported on them.

Register: one row per form.  Bridge: one row per event, append only.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logloom.functions.rules import RULES_V1, RuleSet

from .timeline import SLICE, slice_of, sliced

REVIEW_COLUMNS = ("klasse", "incident_typ", "bewertet_am", "bewertet_von", "llm_vorschlag")
REVIEW_TYPES = {"klasse": "string", "incident_typ": "string", "bewertet_am": "timestamp_ntz",
                "bewertet_von": "string", "llm_vorschlag": "string"}
DELTA_COLUMNS = ("fingerprint", "host", "program", "beispiel_roh", "erstmals", "zuletzt", "vorkommen",
                 "cleaner_ver", "normalizer_ver")


# --- bridge ----------------------------------------------------------------

def bridge_rows(fingerprinted: DataFrame, ruleset: RuleSet = RULES_V1,
                computed_at: Column | None = None, keep: tuple[Column, ...] = ()) -> DataFrame:
    return fingerprinted.select(
        F.col("id").alias("event_id"), "fingerprint",
        F.lit(ruleset.cleaner_ver).alias("cleaner_ver"), F.lit(ruleset.normalizer_ver).alias("normalizer_ver"),
        (F.col("timestamp") if computed_at is None else computed_at).alias("computed_at"),
        "bom_missing", "bom_missing_unverified", *keep)


def id_watermark(bridge: DataFrame) -> DataFrame:
    return bridge.agg(F.coalesce(F.max("event_id"), F.lit(0)).alias("watermark"))


def pending_count(events: DataFrame, mark: Column | int) -> DataFrame:
    return events.where(F.col("id") > mark).agg(F.count("*").alias("pending"))


def new_events(events: DataFrame, bridge: DataFrame, top: int | None = None) -> DataFrame:
    """Events the bridge does not know.  ``top`` is the bridge's highest id
    where the caller has it at hand.

    Ids above the bridge's highest id are new without looking; only late ids
    at or below it meet the bridge in an anti join, and both sides of that
    join are cut to the same id range first, so a replay of a recent batch
    touches the recent end of the bridge only.
    """
    top = bridge.agg(F.max("event_id")).scalar() if top is None else F.lit(top)
    ahead = events.where((F.col("id") > top) | top.isNull())
    late = events.where(F.col("id") <= top)
    oldest = late.agg(F.min("id")).scalar()
    known = bridge.where(F.col("event_id") >= oldest).select(F.col("event_id").alias("id"))
    return ahead.unionByName(late.join(known, "id", "left_anti"))


def distinct_ids(events: DataFrame) -> DataFrame:
    """One row per event id, for sources that may resend a row.  Whether any
    id repeats is asked first, on the ids alone; moving and sorting whole
    messages is left to batches that need it."""
    if duplicate_keys(events, "id").isEmpty():
        return events
    return events.dropDuplicates(["id"])


def duplicate_keys(table: DataFrame, key: str) -> DataFrame:
    return table.groupBy(key).agg(F.count("*").alias("copies")).where("copies > 1")


# --- register --------------------------------------------------------------

def register_delta(fingerprinted: DataFrame, ruleset: RuleSet = RULES_V1) -> DataFrame:
    """Count, first and last time and one cleaned example per form.

    The aggregate is partial before the shuffle, so what moves is forms per
    task, not events, however hot a form is.
    """
    example = F.min_by(F.struct("host", "program", "cleaned"), "id")
    return (
        fingerprinted.groupBy("fingerprint")
        .agg(example.alias("_e"), F.min("timestamp").alias("erstmals"),
             F.max("timestamp").alias("zuletzt"), F.count("*").alias("vorkommen"))
        .select("fingerprint", "_e.host", "_e.program", F.col("_e.cleaned").alias("beispiel_roh"),
                "erstmals", "zuletzt", "vorkommen",
                F.lit(ruleset.cleaner_ver).alias("cleaner_ver"),
                F.lit(ruleset.normalizer_ver).alias("normalizer_ver"))
    )


def with_review_columns(register: DataFrame) -> DataFrame:
    missing = [F.lit(None).cast(REVIEW_TYPES[c]).alias(c) for c in REVIEW_COLUMNS if c not in register.columns]
    return register.select("*", *missing)


def register_upsert(register: DataFrame, delta: DataFrame) -> DataFrame:
    """Merge a delta: counts add, times widen, versions are replaced, and
    example, host, program and review keep what is stored."""
    old, new = with_review_columns(register).alias("o"), delta.alias("n")
    o, n = (lambda c: F.col(f"o.{c}")), (lambda c: F.col(f"n.{c}"))
    return old.join(new, o("fingerprint") == n("fingerprint"), "full_outer").select(
        F.coalesce(o("fingerprint"), n("fingerprint")).alias("fingerprint"),
        *[F.when(o("fingerprint").isNull(), n(c)).otherwise(o(c)).alias(c)
          for c in ("host", "program", "beispiel_roh")],
        F.least(o("erstmals"), n("erstmals")).alias("erstmals"),
        F.greatest(o("zuletzt"), n("zuletzt")).alias("zuletzt"),
        (F.coalesce(o("vorkommen"), F.lit(0)) + F.coalesce(n("vorkommen"), F.lit(0))).alias("vorkommen"),
        *[F.coalesce(n(c), o(c)).alias(c) for c in ("cleaner_ver", "normalizer_ver")],
        *[o(c).alias(c) for c in REVIEW_COLUMNS])


# --- reports ---------------------------------------------------------------

def bom_report(fingerprinted: DataFrame) -> DataFrame:
    return (
        fingerprinted.where("bom_missing").groupBy("host", "program")
        .agg(F.count("*").alias("missing"), F.count_if("bom_missing_unverified").alias("unverified")))


def collapse_report(fingerprinted: DataFrame, approximate: bool = False) -> DataFrame:
    """Raw lines, forms and their ratio.  Forms are counted from a grouping,
    which pre-aggregates; ``approximate`` keeps a sketch instead."""
    ratio = F.round(F.col("raw_messages") / F.col("forms"), 2).alias("collapse_factor")
    if approximate:
        out = fingerprinted.agg(F.count("*").alias("raw_messages"),
                                F.approx_count_distinct("fingerprint").alias("forms"),
                                F.count_if("bom_missing").alias("without_bom"))
    else:
        per_form = fingerprinted.groupBy("fingerprint").agg(
            F.count("*").alias("n"), F.count_if("bom_missing").alias("b"))
        out = per_form.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("raw_messages"), F.count("*").alias("forms"),
                           F.coalesce(F.sum("b"), F.lit(0)).alias("without_bom"))
    return out.select("raw_messages", "forms", ratio, "without_bom")


def collapse_groups(fingerprinted: DataFrame) -> DataFrame:
    """Every form with its size and every distinct whole text with its own
    count, largest first.  Examples stay rows: a form of any size is never
    gathered into one list."""
    examples = fingerprinted.groupBy("fingerprint", F.col("cleaned").alias("example")).agg(
        F.count("*").alias("example_count"))
    sizes = examples.groupBy("fingerprint").agg(F.sum("example_count").alias("form_size"))
    return examples.join(sizes, "fingerprint").select("fingerprint", "form_size", "example", "example_count").orderBy(
        F.desc("form_size"), "fingerprint", F.desc("example_count"), "example")


def top_forms(fingerprinted: DataFrame, k: int = 20) -> DataFrame:
    sizes = fingerprinted.groupBy("fingerprint").agg(F.count("*").alias("form_size"))
    return sizes.orderBy(F.desc("form_size"), "fingerprint").limit(k)


def saturation_curve(register: DataFrame) -> DataFrame:
    """New forms per day of first sighting, with the running total.  The
    window runs over one row per day."""
    daily = register.groupBy(F.to_date("erstmals").alias("day")).agg(F.count("*").alias("new_forms"))
    total = F.sum("new_forms").over(W.orderBy("day").rowsBetween(W.unboundedPreceding, W.currentRow))
    return daily.select("day", "new_forms", total.alias("forms_so_far"))


def version_inventory(bridge: DataFrame) -> DataFrame:
    return bridge.groupBy("cleaner_ver", "normalizer_ver").agg(F.count("*").alias("events"))


def host_program_summary(register: DataFrame) -> DataFrame:
    return register.rollup("host", "program").agg(
        F.count("*").alias("forms"), F.sum("vorkommen").alias("occurrences"))


def stall_check(activity: DataFrame, by: str, ts: str, as_of: Column, limit_seconds: int = 6 * 3600) -> DataFrame:
    """Silence per stream.  All streams silent is critical, some is info."""
    last = activity.groupBy(by).agg(F.max(ts).alias("last_activity"))
    silence = F.timestamp_diff("SECOND", F.col("last_activity"), as_of)
    flagged = last.select(by, "last_activity", silence.alias("silent_seconds")).withColumn(
        "stalled", F.col("silent_seconds") > limit_seconds)
    everything = flagged.agg(F.bool_and("stalled")).scalar()
    return flagged.withColumn("level", F.when(~F.col("stalled"), "ok").when(everything, "critical").otherwise("info"))


# --- review ----------------------------------------------------------------

def review_open(register: DataFrame) -> DataFrame:
    """Forms nobody has looked at."""
    return register.where(F.col("bewertet_am").isNull())


def review_awaiting(register: DataFrame, reviewer: str) -> DataFrame:
    """Forms without a verdict of the reviewer whose word is final."""
    return register.where(~F.col("bewertet_von").eqNullSafe(reviewer))


def newest_first(register: DataFrame) -> DataFrame:
    return register.orderBy(F.desc("erstmals"), "fingerprint")


# --- heartbeats ------------------------------------------------------------

def heartbeat(ticks: DataFrame, ruleset: RuleSet = RULES_V1) -> DataFrame:
    """Fold ticks ``(tick_at, mode, pending, processed)`` into the one-row
    state: the tick always counts, work only when something was processed."""
    last = F.max_by(F.struct("mode", "pending", "processed"), "tick_at")
    return ticks.agg(last.alias("s"), F.max("tick_at").alias("last_tick_at"),
                     F.max(F.when(F.col("processed") > 0, F.col("tick_at"))).alias("last_work_at")).select(
        F.lit(1).cast("smallint").alias("id"), F.col("s.mode").alias("mode"), "last_tick_at", "last_work_at",
        F.col("s.pending").cast("bigint").alias("last_pending"),
        F.col("s.processed").cast("int").alias("last_batch_size"),
        F.lit(ruleset.cleaner_ver).alias("cleaner_ver"), F.lit(ruleset.normalizer_ver).alias("normalizer_ver"))


def heartbeat_state(state: DataFrame, as_of: Column, tick_limit_seconds: int = 900,
                    work_limit_seconds: int = 6 * 3600) -> DataFrame:
    tick_age = F.timestamp_diff("SECOND", F.col("last_tick_at"), as_of)
    work_age = F.timestamp_diff("SECOND", F.col("last_work_at"), as_of)
    word = (F.when(tick_age > tick_limit_seconds, "dead")
            .when(F.col("last_work_at").isNull() | (work_age > work_limit_seconds), "idle").otherwise("working"))
    return state.withColumn("state", word)


def triage_heartbeat(runs: DataFrame) -> DataFrame:
    """The same for the review job's ``(tick_at, batch_size, error_count, model)``."""
    last = F.max_by(F.struct("batch_size", "error_count", "model"), "tick_at")
    return runs.agg(last.alias("s"), F.max("tick_at").alias("last_tick_at"),
                    F.max(F.when(F.col("batch_size") > 0, F.col("tick_at"))).alias("last_run_at")).select(
        F.lit(1).cast("smallint").alias("id"), "last_tick_at", "last_run_at",
        F.col("s.batch_size").cast("int").alias("last_batch_size"),
        F.col("s.error_count").cast("int").alias("last_error_count"), F.col("s.model").alias("model_used"))


# --- ordering, marks -------------------------------------------------------

def batch_head(events: DataFrame, mark: Column | int, size: int) -> DataFrame:
    return events.where(F.col("id") > mark).orderBy("id").limit(size)


def chrono_sort(events: DataFrame) -> DataFrame:
    return events.orderBy("timestamp", "id")


def overlap_dedup(events: DataFrame) -> DataFrame:
    """One row per (timestamp, message) of overlapping polls, keeping the
    smallest id; resent rows collapse before the shuffle."""
    return events.groupBy("timestamp", "message").agg(F.min("id").alias("id"))


def delivery_watermark(attempts: DataFrame, by: str, old_marks: DataFrame | None = None) -> DataFrame:
    """Where the delivery mark of each source stands.

    In (ts, id) order the mark moves over successes and sticks at the first
    failure, so it is the latest success before that failure.  Whole hours
    before it count by their own maximum; only the hour of the failure is
    looked at row by row, so a busy source is never ordered or gathered.
    ``attempts`` has ``by, ts, id, ok``; ``old_marks`` has ``by, mark``.
    """
    hours = sliced(attempts, "ts")
    fail, done = F.when(~F.col("ok"), F.col("ts")), F.when(F.col("ok"), F.col("ts"))
    per_hour = hours.groupBy(by, SLICE).agg(F.min(fail).alias("_fail"), F.max(done).alias("_done"))
    first = per_hour.groupBy(by).agg(F.min("_fail").alias("fail_ts")).withColumn(
        "_fail_hour", F.when(F.col("fail_ts").isNotNull(), slice_of("fail_ts")))
    clear = F.col("_fail_hour").isNull() | (F.col(SLICE) < F.col("_fail_hour"))
    before = per_hour.join(first, by).groupBy(by).agg(F.max(F.when(clear, F.col("_done"))).alias("_before"))
    failed = first.where(F.col("fail_ts").isNotNull()).select(by, F.col("_fail_hour").alias(SLICE), "fail_ts")
    tie = F.col("ts") == F.col("fail_ts")
    near = hours.join(failed, [by, SLICE]).groupBy(by).agg(
        F.max(F.when(F.col("ok") & (F.col("ts") < F.col("fail_ts")), F.col("ts"))).alias("_near"),
        F.min("fail_ts").alias("_at"),
        F.min(F.when(tie & F.col("ok"), F.col("id"))).alias("_ok_id"),
        F.min(F.when(tie & ~F.col("ok"), F.col("id"))).alias("_fail_id"))
    mark = F.coalesce(F.when(F.col("_ok_id") < F.col("_fail_id"), F.col("_at")), "_near", "_before")
    out = before.join(near, by, "left").select(by, mark.alias("mark"))
    if old_marks is None:
        return out
    return out.join(old_marks.select(by, F.col("mark").alias("_old")), by, "left").select(
        by, F.coalesce("mark", "_old").alias("mark"))


def id_bounds(events: DataFrame, ranges: int = 512) -> list[int]:
    """Ids that cut a table into ranges of about as many rows each, whatever
    the gaps between ids."""
    shares = [i / ranges for i in range(1, ranges)]
    found = events.agg(F.percentile_approx("id", shares, 10 * ranges)).first()[0]
    return sorted(set(found or []))


def batch_ranges(events: DataFrame, size: int, bounds: list[int] | None = None) -> DataFrame:
    """First id, last id and size of consecutive batches of ``size`` events.

    Ids are cut into ranges of like numbers of rows.  Counts per range, summed
    up in order, give each range its offset; rows are numbered inside their
    range only, so no task ever orders the whole table.
    """
    bounds = id_bounds(events) if bounds is None else bounds
    # Bucketizer looks a row's range up by binary search.
    splits = [-math.inf, *sorted({float(b) for b in bounds}), math.inf]
    ranged = events.select("id", F.col("id").cast("double").alias("_id"))
    ranged = (Bucketizer(splits=splits, inputCol="_id", outputCol="_range").transform(ranged).drop("_id")
              if len(splits) > 2 else ranged.select("id", F.lit(0.0).alias("_range")))
    offsets = ranged.groupBy("_range").agg(F.count("*").alias("_n")).select(
        "_range", (F.sum("_n").over(W.orderBy("_range").rowsBetween(W.unboundedPreceding, W.currentRow))
                   - F.col("_n")).alias("_offset"))
    numbered = ranged.withColumn("_rn", F.row_number().over(W.partitionBy("_range").orderBy("id")))
    batch = F.floor((F.col("_offset") + F.col("_rn") - 1) / size).alias("batch_no")
    return numbered.join(offsets, "_range").groupBy(batch).agg(
        F.min("id").alias("first_id"), F.max("id").alias("last_id"), F.count("*").alias("events"))
