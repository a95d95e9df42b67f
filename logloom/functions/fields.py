"""Fields of the JSON proposal a review job leaves on a form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fields the proposal is known to carry.
PROPOSAL_FIELDS = ("rolle", "severity", "group_key_felder", "abschluss", "stille_minuten", "bezeichnung",
                   "begruendung", "hinweis")


def proposal_fields(proposal: Column | str) -> list[Column]:
    """Known fields as text columns; the JSON itself keeps unknown keys."""
    parsed = F.try_parse_json(proposal)
    return [F.try_variant_get(parsed, f"$.{name}", "string").alias(name) for name in PROPOSAL_FIELDS]
