"""Carrying classifications over to a new rule version, all forms at once.

Only ``moved_events`` touches events.  Everything after it works on
``moves``, one row per (old form, new form).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.functions.rules import RuleSet
from logloom.functions.text import clean_bom, with_fingerprint

from .register import REVIEW_COLUMNS, with_review_columns


class AmbiguousVersion(ValueError):
    """More than one old version in the bridge and none was named."""


def is_version(cleaner_ver: int, normalizer_ver: int) -> Column:
    return (F.col("cleaner_ver") == cleaner_ver) & (F.col("normalizer_ver") == normalizer_ver)


def version_mismatch(bridge: DataFrame, ruleset: RuleSet) -> DataFrame:
    return bridge.where(~is_version(ruleset.cleaner_ver, ruleset.normalizer_ver))


def distinct_versions(bridge: DataFrame, ruleset: RuleSet) -> DataFrame:
    return version_mismatch(bridge, ruleset).select("cleaner_ver", "normalizer_ver").distinct()


def old_version(bridge: DataFrame, ruleset: RuleSet,
                explicit: tuple[int, int] | None = None) -> tuple[int, int] | None:
    """The version to migrate from, or None when there is nothing to do."""
    if explicit is None:
        found = distinct_versions(bridge, ruleset).limit(2).collect()
        if len(found) > 1:
            raise AmbiguousVersion("several old versions in the bridge; name the one to migrate from")
        explicit = (found[0].cleaner_ver, found[0].normalizer_ver) if found else None
    return None if explicit == (ruleset.cleaner_ver, ruleset.normalizer_ver) else explicit


def distinct_old_forms(bridge: DataFrame, version: tuple[int, int]) -> DataFrame:
    return bridge.where(is_version(*version)).select("fingerprint").distinct()


def moved_events(bridge: DataFrame, events: DataFrame, ruleset: RuleSet, version: tuple[int, int]) -> DataFrame:
    """Events of the old version under the current rules.  Tables bucketed by
    event id join here without a shuffle."""
    old = bridge.where(is_version(*version)).select("event_id", F.col("fingerprint").alias("old_fingerprint"))
    joined = old.join(events, old["event_id"] == events["id"]).drop("id").withColumnRenamed("event_id", "id")
    return with_fingerprint(joined, ruleset).select(
        F.col("id").alias("event_id"), "timestamp", "old_fingerprint", F.col("fingerprint").alias("new_fingerprint"))


def moves_of(moved: DataFrame, events: DataFrame | None = None) -> DataFrame:
    """Count and times per (old form, new form).  With ``events``, the texts
    of each move's first event are looked up as its example; the moved events
    themselves carry no texts."""
    moves = moved.groupBy("old_fingerprint", "new_fingerprint").agg(
        F.count("*").alias("events"), F.min("timestamp").alias("erstmals"), F.max("timestamp").alias("zuletzt"),
        F.min("event_id").alias("first_id"))
    if events is None:
        return moves
    texts = events.select(F.col("id").alias("first_id"), F.struct(
        "host", "program", clean_bom("message").alias("cleaned")).alias("example"))
    return moves.join(texts, "first_id", "left").select(*moves.columns, "example")


def migrate_targets(moves: DataFrame) -> DataFrame:
    per_old = moves.groupBy("old_fingerprint").agg(F.count("*").alias("targets"))
    return moves.join(per_old, "old_fingerprint").select(
        "old_fingerprint", "new_fingerprint", "targets", "events", "erstmals", "zuletzt")


def dry_run(moves: DataFrame) -> DataFrame:
    """Targets and event counts per old form, nothing decided or written."""
    return moves.groupBy("old_fingerprint").agg(
        F.count("*").alias("targets"), F.sum("events").alias("events")).withColumn("outcome", F.lit("dry-run"))


def _sources(moves: DataFrame, register: DataFrame) -> DataFrame:
    """Old forms with their review state and, for a single target, the target."""
    per_old = moves.groupBy("old_fingerprint").agg(
        F.count("*").alias("targets"), F.sum("events").alias("moved"),
        F.min("new_fingerprint").alias("only_target"))
    review = with_review_columns(register).select(
        F.col("fingerprint").alias("old_fingerprint"), "vorkommen", *REVIEW_COLUMNS)
    return per_old.join(review, "old_fingerprint", "left").select(
        "old_fingerprint", "targets", "moved", "vorkommen", *REVIEW_COLUMNS,
        F.when(F.col("targets") == 1, F.col("only_target")).alias("target"),
        F.col("bewertet_am").isNotNull().alias("classified"))


def _kept_rows(moves: DataFrame, register: DataFrame) -> DataFrame:
    """Register rows that events of other versions still stand behind."""
    moved = moves.groupBy(F.col("old_fingerprint").alias("fingerprint")).agg(F.sum("events").alias("_moved"))
    left = F.col("vorkommen") - F.coalesce("_moved", F.lit(0))
    return (with_review_columns(register).join(moved, "fingerprint", "left")
            .where(F.col("_moved").isNull() | (left > 0)).withColumn("vorkommen", left).drop("_moved"))


def _verdicts(sources: DataFrame, kept: DataFrame) -> DataFrame:
    """One verdict per target over all its classified single-target sources
    and its own row, independent of any processing order.

    Rank 0 is the target's own row, rank 1 a source; the lowest (rank, old
    form) sets the class, and any second class among them clears it.
    """
    own = kept.select(F.col("fingerprint").alias("target"), F.lit(0).alias("rank"),
                      F.col("fingerprint").alias("old"), *REVIEW_COLUMNS)
    stay = F.col("target") == F.col("old_fingerprint")
    src = sources.where(F.col("target").isNotNull()).select(
        "target", F.when(stay, 0).otherwise(1).alias("rank"), F.col("old_fingerprint").alias("old"), *REVIEW_COLUMNS)
    known = F.col("bewertet_am").isNotNull()
    klass = F.struct("klasse", "incident_typ")
    return own.unionByName(src).groupBy("target").agg(
        F.min_by(F.when(known, F.struct(*REVIEW_COLUMNS)), F.when(known, F.struct("rank", "old"))).alias("verdict"),
        F.min(F.when(known, F.struct("rank", "old"))).alias("verdict_from"),
        F.min(F.when(known, klass)).alias("_low"), F.max(F.when(known, klass)).alias("_high"),
        F.max(F.when(F.col("rank") == 0, F.col("llm_vorschlag"))).alias("own_proposal"),
    ).select("target", "verdict", "verdict_from", "own_proposal",
             (~F.col("_low").eqNullSafe(F.col("_high"))).alias("cleared"))


def migrate_outcome(moves: DataFrame, register: DataFrame) -> DataFrame:
    """Outcome per old form."""
    sources = _sources(moves, register)
    verdicts = _verdicts(sources, _kept_rows(moves, register))
    same = (F.col("klasse").eqNullSafe(F.col("verdict.klasse"))
            & F.col("incident_typ").eqNullSafe(F.col("verdict.incident_typ")))
    first = (F.col("verdict_from.rank") == 1) & (F.col("verdict_from.old") == F.col("old_fingerprint"))
    word = (F.when(~F.col("classified"), "unclassified_no_action")
            .when(F.col("targets") > 1, "split_needs_review")
            .when(first, "carried_over").when(same, "already_consistent").otherwise("conflict"))
    return sources.join(verdicts, "target", "left").select(
        "old_fingerprint", "targets", F.col("moved").alias("events"), word.alias("outcome"))


def migrate_summary(outcome: DataFrame) -> DataFrame:
    return outcome.groupBy("outcome").agg(F.count("*").alias("old_forms"))


def migrate_listing(outcome: DataFrame, moves: DataFrame, word: str) -> DataFrame:
    """Whole old forms of one outcome with each of their targets as a row of
    its own."""
    hits = outcome.where(F.col("outcome") == word).select("old_fingerprint")
    return hits.join(moves.select("old_fingerprint", "new_fingerprint"), "old_fingerprint").select(
        F.col("old_fingerprint").alias("old_form"), F.col("new_fingerprint").alias("target"))


def migrate_register(moves: DataFrame, register: DataFrame, ruleset: RuleSet) -> DataFrame:
    """The register after the migration."""
    kept = _kept_rows(moves, register)
    verdicts = _verdicts(_sources(moves, register), kept)
    arrived = moves.groupBy(F.col("new_fingerprint").alias("fingerprint")).agg(
        F.min_by("example", "first_id").alias("e"), F.min("erstmals").alias("erstmals"),
        F.max("zuletzt").alias("zuletzt"), F.sum("events").alias("events"))
    k, a = (lambda c: F.col(f"k.{c}")), (lambda c: F.col(f"a.{c}"))
    merged = kept.alias("k").join(arrived.alias("a"), k("fingerprint") == a("fingerprint"), "full_outer").select(
        F.coalesce(k("fingerprint"), a("fingerprint")).alias("fingerprint"),
        F.coalesce(k("host"), a("e.host")).alias("host"),
        F.coalesce(k("program"), a("e.program")).alias("program"),
        F.coalesce(k("beispiel_roh"), a("e.cleaned")).alias("beispiel_roh"),
        F.least(k("erstmals"), a("erstmals")).alias("erstmals"),
        F.greatest(k("zuletzt"), a("zuletzt")).alias("zuletzt"),
        (F.coalesce(k("vorkommen"), F.lit(0)) + F.coalesce(a("events"), F.lit(0))).alias("vorkommen"),
        F.when(a("fingerprint").isNull(), k("cleaner_ver")).otherwise(ruleset.cleaner_ver).alias("cleaner_ver"),
        F.when(a("fingerprint").isNull(), k("normalizer_ver")).otherwise(ruleset.normalizer_ver).alias("normalizer_ver"),
        a("fingerprint").isNotNull().alias("_arrived"),
        *[k(c).alias(f"_{c}") for c in REVIEW_COLUMNS])

    def review(name: str) -> Column:
        decided = F.col(f"verdict.{name}")
        if name == "llm_vorschlag":
            decided = F.coalesce(decided, F.col("own_proposal"))
        return (F.when(~F.col("_arrived"), F.col(f"_{name}"))
                .when(~F.coalesce("cleared", F.lit(False)), decided).alias(name))

    out = merged.join(verdicts, merged["fingerprint"] == verdicts["target"], "left")
    return out.select("fingerprint", "host", "program", "beispiel_roh", "erstmals", "zuletzt", "vorkommen",
                      "cleaner_ver", "normalizer_ver", *[review(c) for c in REVIEW_COLUMNS])


def migrate_bridge(bridge: DataFrame, moved: DataFrame, ruleset: RuleSet, version: tuple[int, int] | None = None) -> DataFrame:
    """Bridge re-tagged with new form and versions; quality flags stay.  With
    the old ``version``, rows of other versions pass by the join."""
    target = moved.select("event_id", "new_fingerprint")
    hit = F.col("new_fingerprint").isNotNull()
    old = bridge if version is None else bridge.where(is_version(*version))
    tagged = old.join(target, "event_id", "left").withColumns({
        "fingerprint": F.coalesce("new_fingerprint", "fingerprint"),
        "cleaner_ver": F.when(hit, ruleset.cleaner_ver).otherwise(F.col("cleaner_ver")),
        "normalizer_ver": F.when(hit, ruleset.normalizer_ver).otherwise(F.col("normalizer_ver")),
    }).drop("new_fingerprint")
    if version is None:
        return tagged
    return tagged.unionByName(bridge.where(~F.coalesce(is_version(*version), F.lit(False))))


def bom_backfill(bridge: DataFrame, events: DataFrame) -> DataFrame:
    """Set ``bom_missing`` from the raw events; the unverified flag is left
    alone because it depends on a list that changes."""
    from logloom.functions.text import bom_missing
    hits = events.where(bom_missing("host", "message")).select(
        F.col("id").alias("event_id"), F.lit(True).alias("_hit"))
    return bridge.join(hits, "event_id", "left").withColumn(
        "bom_missing", F.col("bom_missing") | F.col("_hit").isNotNull()).drop("_hit")
