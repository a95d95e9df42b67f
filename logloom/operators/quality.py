"""Key, domain and reference rules as queries that return the violations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .register import duplicate_keys  # noqa: F401

# Domains of the register and of the rule table.
KLASSEN = ("rauschen", "betrieb", "relevant", "kritisch", "unklar")
TYPE_PATTERN = r"^I-(0[0-9]|1[0-3])$"
MECHANISMS = ("pair", "burst", "absence", "rate")
RULE_SEVERITIES = ("info", "warning", "error", "critical")
ESCALATE_BASES = ("occurrences", "incidents")
REPORT_PATHS = ("old", "new")
REGISTER_REQUIRED = ("host", "program", "beispiel_roh", "erstmals", "zuletzt", "vorkommen", "cleaner_ver",
                     "normalizer_ver")
BRIDGE_REQUIRED = ("fingerprint", "cleaner_ver", "normalizer_ver", "computed_at")


def bad_klasse(register: DataFrame) -> DataFrame:
    return register.where(~F.col("klasse").isin(*KLASSEN)).select("fingerprint", "klasse")


def bad_incident_typ(register: DataFrame, types: DataFrame) -> DataFrame:
    """Types outside the narrow pattern, and whether the type table knows them."""
    codes = types.select(F.col("code").alias("incident_typ"), F.lit(True).alias("known"))
    return register.join(codes, "incident_typ", "left").where(
        F.col("incident_typ").isNotNull()
        & (~F.col("incident_typ").rlike(TYPE_PATTERN) | F.col("known").isNull())
    ).select("fingerprint", "incident_typ", F.col("known").isNotNull().alias("in_type_table"))


def bad_reviewer(register: DataFrame, final: str) -> DataFrame:
    who = F.col("bewertet_von")
    return register.where(~((who == final) | who.startswith("llm:"))).select("fingerprint", "bewertet_von")


def bad_review_pair(register: DataFrame) -> DataFrame:
    return register.where(F.col("bewertet_am").isNull() != F.col("bewertet_von").isNull()).select(
        "fingerprint", "bewertet_am", "bewertet_von")


def orphan_forms(bridge: DataFrame, register: DataFrame) -> DataFrame:
    """Forms the bridge uses and the register lacks, with their event count.
    Counting first leaves one row per form for the join."""
    used = bridge.groupBy("fingerprint").agg(F.count("*").alias("events"))
    return used.join(register.select("fingerprint"), "fingerprint", "left_anti")


def orphan_events(bridge: DataFrame, events: DataFrame) -> DataFrame:
    known = events.select(F.col("id").alias("event_id"))
    return bridge.select("event_id", "fingerprint").join(known, "event_id", "left_anti")


def missing_required(table: DataFrame, key: str, required: tuple[str, ...]) -> DataFrame:
    """Keys with null required columns, and which ones."""
    names = F.filter(F.array(*[F.when(F.col(c).isNull(), c) for c in required]), lambda c: c.isNotNull())
    return table.where(reduce(Column.__or__, [F.col(c).isNull() for c in required])).select(
        key, F.array_join(names, ",").alias("null_columns"))


def count_mismatch(register: DataFrame, bridge: DataFrame) -> DataFrame:
    """Forms whose register count differs from their bridge rows."""
    counted = bridge.groupBy("fingerprint").agg(F.count("*").alias("bridge_rows"))
    return register.select("fingerprint", "vorkommen").join(counted, "fingerprint", "full_outer").where(
        ~F.col("vorkommen").eqNullSafe(F.col("bridge_rows")))


def not_single_row(state: DataFrame) -> DataFrame:
    return state.where("id <> 1")


def bad_rule_config(rules: DataFrame, types: DataFrame) -> DataFrame:
    """One row per rule and broken domain."""
    codes = types.select(F.col("code").alias("incident_type"), F.lit(True).alias("_known"))
    checks = {
        "mechanism": ~F.col("mechanism").isin(*MECHANISMS),
        "base_severity": ~F.col("base_severity").isin(*RULE_SEVERITIES),
        "escalate_to_severity": ~F.col("escalate_to_severity").isin(*RULE_SEVERITIES),
        "escalate_basis": ~F.col("escalate_basis").isin(*ESCALATE_BASES),
        "reported_via": ~F.col("reported_via").isin(*REPORT_PATHS),
        "incident_type": F.col("_known").isNull(),
    }
    broken = F.array(*[F.when(bad, name) for name, bad in checks.items()])
    return rules.join(codes, "incident_type", "left").select(
        "rule_name", F.explode(F.array_compact(broken)).alias("broken_column"))
