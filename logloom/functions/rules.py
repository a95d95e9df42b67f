"""Normalization rule sets.

A rule set is an ordered list of token rules plus the two version numbers
that tag every form it produces.  It is a parameter of the operators, never a
module constant baked into a plan, so two versions can be compared in one job.
"""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class TokenRule:
    """One token replacement.

    ``pattern`` defines the rule.  ``jvm`` may hold an equal pattern that the
    JVM's backtracking matcher rejects sooner (a cheap lookahead before the
    word boundary, possessive runs where giving back could never help); the
    tests hold both forms against each other.
    """

    name: str
    token: str
    pattern: str
    jvm: str = ""


@dataclass(frozen=True)
class RuleSet:
    cleaner_ver: int
    normalizer_ver: int
    rules: tuple[TokenRule, ...]

    def rule(self, name: str) -> TokenRule:
        return next(r for r in self.rules if r.name == name)


# Unit names and token patterns, in the order they are applied.
UNITS = ("GB", "MB", "KB", "TB", "Mbit/s", "Kbit/s", "Gbit/s", "kbit/s", "%",
         "GHz", "MHz", r"Min\.", "min", "h", "s")
_QUANTITY = r"\b\d[\d.,]*\s*(?:" + "|".join(UNITS) + ")"

RULES_V1 = RuleSet(1, 1, (
    TokenRule("mac", "<MAC>", r"\b[0-9A-Fa-f]{2}(?::[0-9A-Fa-f]{2}){5}\b"),
    TokenRule("iso_ts", "<TS>",
              r"\b\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(?:\.\d+)?(?:Z|[+-]\d{2}:?\d{2})?\b"),
    TokenRule("de_date", "<DATE>", r"\b\d{2}\.\d{2}\.\d{2,4}(?:\s+\d{2}:\d{2}:\d{2})?\b"),
    TokenRule("time", "<TS>", r"\b\d{2}:\d{2}(?::\d{2})?\b"),
    TokenRule("ip6", "<IP6>",
              r"\b(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}\b"
              r"|\b(?:[0-9A-Fa-f]{1,4}:)+:(?:[0-9A-Fa-f]{1,4}:?)*\b",
              jvm=r"(?=[0-9A-Fa-f]{1,4}+:)\b(?:(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}\b"
                  r"|(?:[0-9A-Fa-f]{1,4}:)+:(?:[0-9A-Fa-f]{1,4}:?)*\b)"),
    TokenRule("ip4", "<IP>", r"\b\d{1,3}(?:\.\d{1,3}){3}\b"),
    TokenRule("path", "<PATH>", r"(?:/[\w.\-@+]+){2,}"),
    TokenRule("hash", "<HASH>", r"\b[0-9A-Fa-f]{16,}\b",
              jvm=r"(?=[0-9A-Fa-f]{16})\b[0-9A-Fa-f]{16,}+\b"),
    TokenRule("qty", "<QTY>", _QUANTITY + r"\b",
              jvm=r"(?=\d)\b\d[\d.,]*+\s*+(?:" + "|".join(UNITS) + r")\b"),
    TokenRule("version", "<VER>", r"\bv?\d+(?:\.\d+){1,3}\b"),
    TokenRule("id", "<ID>",
              r"\b(?=[A-Za-z0-9_-]*[A-Za-z])(?=[A-Za-z0-9_-]*\d[A-Za-z0-9_-]*\d)[A-Za-z0-9_-]{8,}\b",
              jvm=r"\b(?=[A-Za-z0-9_-]{8})(?=[0-9_-]*+[A-Za-z])"
                  r"(?=[A-Za-z_-]*+\d[A-Za-z_-]*+\d)[A-Za-z0-9_-]{8,}\b"),
    TokenRule("int", "<N>", r"\b\d+\b", jvm=r"(?=\d)\b\d++\b"),
))


def _second_version(base: RuleSet) -> RuleSet:
    """Example successor: IPv4 before dates, ``%`` closes a quantity on its
    own, one-digit and longer integers get different tokens."""
    by_name = {r.name: r for r in base.rules}
    order = ["mac", "iso_ts", "ip4", "de_date", "time", "ip6", "path", "hash", "qty", "version", "id"]
    units = "|".join(u for u in UNITS if u != "%")
    by_name["qty"] = replace(by_name["qty"], pattern=rf"\b\d[\d.,]*\s*(?:(?:{units})\b|%)", jvm="")
    rules = [by_name[name] for name in order]
    rules += [TokenRule("int_one", "<N>", r"\b\d\b"), TokenRule("int_many", "<NN>", r"\b\d{2,}\b")]
    return RuleSet(base.cleaner_ver, base.normalizer_ver + 1, tuple(rules))


RULES_V2 = _second_version(RULES_V1)
