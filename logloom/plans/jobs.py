"""Backfill, follow and migrate as jobs over a store."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.functions.rules import RULES_V1, RuleSet
from logloom.functions.text import clean_bom, with_fingerprint
from logloom.operators import migrate as mig
from logloom.operators import predicates as pred
from logloom.operators import register as reg
from logloom.session import materialize
from logloom.streaming.store import Conflict, Store

def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def delta_of_bridge(part: DataFrame, register: DataFrame, events: DataFrame, ruleset: RuleSet,
                    work: str | None = None) -> DataFrame:
    """Register delta of bridge rows already written.

    Counts and times come from the bridge's own columns by hash aggregation.
    The text example is looked up for forms the register lacks, in a join
    whose kind the planner chooses by the size of those ids.
    """
    forms = materialize(part.groupBy("fingerprint").agg(
        F.count("*").alias("vorkommen"), F.min("event_ts").alias("erstmals"),
        F.max("event_ts").alias("zuletzt"), F.min("event_id").alias("first_id")), "forms", work)
    fresh = forms.join(register.select("fingerprint"), "fingerprint", "left_anti").select(
        "fingerprint", F.col("first_id").alias("id"))
    examples = events.select("id", "host", "program", "message").join(fresh, "id").select(
        "fingerprint", "host", "program", clean_bom("message").alias("beispiel_roh"))
    return forms.join(examples, "fingerprint", "left").select(
        "fingerprint", "host", "program", "beispiel_roh", "erstmals", "zuletzt", "vorkommen",
        F.lit(ruleset.cleaner_ver).alias("cleaner_ver"), F.lit(ruleset.normalizer_ver).alias("normalizer_ver"))


def process_batch(store: Store, events: DataFrame, run: str, batch: int, ruleset: RuleSet = RULES_V1,
                  unique_ids: bool = True, now: datetime | None = None, attempts: int = 5) -> int:
    """One batch of events into bridge and register, exactly once.

    A batch that is already committed is skipped; events the bridge knows are
    left out; bridge rows and register become visible in one commit.  If
    another writer commits in between, the batch is worked out anew on the
    state that it left.  Returns the number of events recorded.
    """
    for attempt in range(attempts):
        try:
            return _try_batch(store, events, run, batch, ruleset, unique_ids, now)
        except Conflict:
            if attempt + 1 == attempts:
                raise
    return 0


def _try_batch(store: Store, events: DataFrame, run: str, batch: int, ruleset: RuleSet, unique_ids: bool,
               now: datetime | None) -> int:
    state = store.state()
    if state["batches"].get(run, -1) >= batch:
        return 0
    source = events if unique_ids else reg.distinct_ids(events)
    fresh = source if state["top"] is None else reg.new_events(source, store.bridge(), state["top"])
    folder = store.bridge_folder(state, run, batch)
    # The event time is kept beside the bridge columns, so counts and times
    # never need the events again.
    staged = reg.bridge_rows(with_fingerprint(fresh, ruleset), ruleset, F.lit(now or utc_now()).cast("timestamp_ntz"),
                             keep=(F.col("timestamp").cast("timestamp_ntz").alias("event_ts"),))
    staged.write.mode("overwrite").parquet(folder)
    written = store.spark.read.parquet(folder)
    recorded, top = written.agg(F.count("*"), F.max("event_id")).first()
    new_state = state | {"batches": state["batches"] | {run: batch}}
    if recorded:
        new_state["top"] = max(top, state["top"] if state["top"] is not None else top)
        # Only the partitions that hold a form of the batch are read and rewritten.
        touched = [r.part for r in written.select(store.part_of("fingerprint").alias("part")).distinct().collect()]
        register = store.register(touched)
        merged = reg.register_upsert(register, delta_of_bridge(
            written, register, source, ruleset, f"{store.path}/work/{run}-forms"))
        new_state["register"] = state["register"] | store.write_register(
            merged, f"register/{run}-{batch}-{state['version'] + 1}")
    store.commit(new_state)
    return recorded


def record_tick(store: Store, run: str, pending: int, processed: int, now: datetime | None = None) -> None:
    store.record_tick(now or utc_now(), run, pending, processed)


def waiting(store: Store, events: DataFrame) -> DataFrame:
    """Events above the bridge's highest id."""
    mark = store.state()["top"]
    return events if mark is None else pred.above_mark(events, mark)


def decision(spark, pending: int, mode: str, now: datetime, limit: int = pred.LARGE_BACKLOG) -> str:
    """The admission rule for a known backlog."""
    word = pred.admission(F.lit(pending), pred.in_blackout(F.lit(now).cast("timestamp_ntz")), mode, limit=limit)
    return spark.range(1).select(word.alias("w")).first().w


def admitted(store: Store, events: DataFrame, mode: str, now: datetime | None = None, forced: bool = False,
             running: bool = False) -> str:
    """Decision for a job: process, idle, defer, refuse, or pause one that runs."""
    clock = F.lit(now or utc_now()).cast("timestamp_ntz")
    word = pred.admission(F.col("pending"), pred.in_blackout(clock), mode, forced, running)
    return waiting(store, events).agg(F.count("*").alias("pending")).select(word.alias("w")).first().w


def backfill(store: Store, events: DataFrame, since_days: int | None = 90, ruleset: RuleSet = RULES_V1,
             now: datetime | None = None, forced: bool = False, pieces: int = 1) -> tuple[str, int]:
    """Everything above the mark, optionally of the last days.

    With ``pieces`` above one, ids are cut into that many ranges of like
    numbers of rows, each committed by itself, so that a lost driver goes on
    behind the last one.  Before each further piece the blackout is asked
    again: a running backfill pauses in it, whatever is left.
    """
    decision = admitted(store, events, "backfill", now, forced)
    if decision != "process":
        return decision, 0
    mark = store.state()["top"]
    since = None if since_days is None else F.lit(now or utc_now()).cast("timestamp_ntz") - F.expr(f"INTERVAL {since_days} DAYS")
    rest = pred.above_mark(events, F.lit(-1) if mark is None else mark, since)
    bounds = reg.id_bounds(rest, pieces) if pieces > 1 else []
    done = 0
    for n, (low, high) in enumerate(zip([None, *bounds], [*bounds, None])):
        if n and admitted(store, events, "backfill", now, forced, running=True) == "pause":
            return "pause", done
        part = rest if low is None else rest.where(F.col("id") > low)
        part = part if high is None else part.where(F.col("id") <= high)
        done += process_batch(store, part, "backfill", store.committed("backfill") + 1, ruleset, now=now)
    return decision, done


def migrate(store: Store, events: DataFrame, ruleset: RuleSet, version: tuple[int, int] | None = None,
            dry_run: bool = False) -> DataFrame | None:
    """Move the store to ``ruleset``.  Returns outcomes per old form, or None
    when there is nothing to do.  The recomputed events are written once and
    everything else is built on them."""
    bridge = store.bridge()
    old = mig.old_version(bridge, ruleset, version)
    if old is None:
        return None
    moved = materialize(mig.moved_events(bridge, events, ruleset, old), "moved", f"{store.path}/work/moved")
    moves = materialize(mig.moves_of(moved, events), "moves", f"{store.path}/work/moves")
    if dry_run:
        return mig.dry_run(moves)
    register, state = store.register(), store.state()
    outcome = materialize(mig.migrate_outcome(moves, register), "outcome", f"{store.path}/work/outcome")
    nxt = state["version"] + 1
    tagged = mig.migrate_bridge(bridge, moved, ruleset, old)
    new = {"bridge": f"bridge-{nxt}", "batches": state["batches"] | {"migrate": nxt}}
    tagged.write.mode("overwrite").parquet(f"{store.path}/{new['bridge']}/run=migrate/batch={nxt}")
    new["register"] = store.write_register(mig.migrate_register(moves, register, ruleset), f"register/migrate-{nxt}")
    store.commit(state | new)
    return outcome
