"""Cleaning, normalizing and fingerprinting of messages as column expressions.

Every function here returns one nested expression over its input, so a whole
fingerprint stays inside a single code-generated stage and no Python worker
is started.  Each level refers to the one below exactly once: a filter or a
join that Catalyst moves through it cannot multiply the regex work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .rules import RULES_V1, RuleSet, TokenRule

# Byte order mark, the host that sends it, and the programs of
# that host for which the mark has been verified.
BOM = "\ufeff"
BOM_HOST = "DiskStation225"
VERIFIED_PROGRAMS = ("Hyper_Backup", "Connection", "System")

# Java's \s lacks U+001C..U+001F even in Unicode mode.
_SPACE = r"[\s\x1c-\x1f]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_space(c: Column | str) -> Column:
    """Cut Unicode whitespace (not just blanks) from both ends."""
    return F.regexp_replace(_col(c), rf"(?U)^{_SPACE}+|{_SPACE}+$", "")


def collapse_space(c: Column | str) -> Column:
    """Every whitespace run becomes one blank, the ends are cut."""
    return F.trim(F.regexp_replace(_col(c), rf"(?U){_SPACE}+", " "))


def has_bom(message: Column | str) -> Column:
    return F.contains(_col(message), F.lit(BOM))


def clean_bom(message: Column | str) -> Column:
    """Text after the last byte order mark, or the whole text, stripped."""
    return strip_space(F.substring_index(_col(message), BOM, -1))


def jvm_pattern(rule: TokenRule) -> str:
    return "(?U)" + (rule.jvm or rule.pattern).replace(r"\s", _SPACE)


def apply_rule(c: Column | str, rule: TokenRule) -> Column:
    return F.regexp_replace(_col(c), jvm_pattern(rule), rule.token)


def normalize_form(text: Column | str, ruleset: RuleSet = RULES_V1) -> Column:
    """All token rules in order, then whitespace collapsed."""
    out = _col(text)
    for rule in ruleset.rules:
        out = apply_rule(out, rule)
    return collapse_space(out)


def fingerprint_key(host: Column | str, program: Column | str, form: Column | str) -> Column:
    """``host|program|form``; never null, so equi-joins on it add no null
    filter that would run the regex chain a second time."""
    parts = [F.coalesce(_col(c), F.lit("")) for c in (host, program, form)]
    return F.concat_ws("|", *parts)


def bom_missing(host: Column | str, message: Column | str) -> Column:
    return F.coalesce((_col(host) == BOM_HOST) & ~has_bom(message), F.lit(False))


def bom_missing_unverified(host: Column | str, program: Column | str, message: Column | str) -> Column:
    return bom_missing(host, message) & ~F.coalesce(_col(program).isin(*VERIFIED_PROGRAMS), F.lit(False))


def with_fingerprint(events: DataFrame, ruleset: RuleSet = RULES_V1) -> DataFrame:
    """Add the cleaned text, the key and the quality flags; drop the raw
    message, which may hold tokens that must not be stored."""
    return (
        events.withColumn("cleaned", clean_bom("message"))
        .withColumn("fingerprint", fingerprint_key("host", "program", normalize_form("cleaned", ruleset)))
        .withColumn("bom_missing", bom_missing("host", "message"))
        .withColumn("bom_missing_unverified", bom_missing_unverified("host", "program", "message"))
        .drop("message")
    )


def with_fingerprint_distinct(events: DataFrame, ruleset: RuleSet = RULES_V1) -> DataFrame:
    """Same result, but each distinct (host, program, message) is normalized
    once and joined back.  Worth two shuffles only where messages repeat
    often; hot messages are pre-aggregated by the distinct."""
    keys = ["host", "program", "message"]
    forms = with_fingerprint(events.select(*keys).distinct().withColumn("raw", F.col("message")), ruleset)
    left, right = events.alias("e"), forms.alias("f")
    same = [F.col(f"e.{k}").eqNullSafe(F.col(f"f.{'raw' if k == 'message' else k}")) for k in keys]
    kept = [F.col(f"e.{c}") for c in events.columns if c != "message"]
    added = [F.col(f"f.{c}") for c in ("cleaned", "fingerprint", "bom_missing", "bom_missing_unverified")]
    return left.join(right, same[0] & same[1] & same[2]).select(*kept, *added)


def register_sql_functions(spark: SparkSession, ruleset: RuleSet = RULES_V1) -> list[str]:
    """Offer the column functions to SQL text as inlined SQL functions."""
    def quoted(text: str) -> str:
        return "r'" + text + "'"

    norm = "message"
    for rule in ruleset.rules:
        norm = f"regexp_replace({norm}, {quoted(jvm_pattern(rule))}, '{rule.token}')"
    norm = f"trim(regexp_replace({norm}, {quoted(f'(?U){_SPACE}+')}, ' '))"
    bom = "decode(unhex('EFBBBF'), 'UTF-8')"
    strip = quoted(f"(?U)^{_SPACE}+|{_SPACE}+$")
    bodies = {
        "clean_message(message STRING)":
            f"regexp_replace(substring_index(message, {bom}, -1), {strip}, '')",
        "normalize_message(message STRING)": norm,
        "fingerprint_of(host STRING, program STRING, message STRING)":
            "concat_ws('|', coalesce(host, ''), coalesce(program, ''), "
            "coalesce(normalize_message(clean_message(message)), ''))",
    }
    for head, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURNS STRING RETURN {body}")
    return [head.split("(")[0] for head in bodies]
