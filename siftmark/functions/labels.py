"""Display strings built from metrics (no Python UDFs)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from siftmark.functions.columns import col, zero_if_null
from siftmark.spec import MarketSpec

NOT_AVAILABLE = "N/A"

# Sentence per rank, and the note for entities without their own note.
RANK_SENTENCES = {
    1: "Scale leader with a strong blend of size and trajectory.",
    2: "High-upside market with strong forward demand signal.",
}
OTHER_RANK_SENTENCE = "Attractive demand story with clear strategic trade-offs to manage."
DEFAULT_NOTE = (
    "Strong analytical candidate; strategic overlay should focus on fit, competition, and operating model."
)


def _or_na(c: Column, text: Column) -> Column:
    return F.when(c.isNotNull(), text).otherwise(NOT_AVAILABLE)


def pct_text(x: Column, decimals: int = 1) -> Column:
    return F.format_string(f"%.{decimals}f%%", x * F.lit(100.0))


def pct(c: str | Column, decimals: int = 1) -> Column:
    return _or_na(col(c), pct_text(col(c), decimals))


def millions(c: str | Column) -> Column:
    return _or_na(col(c), F.format_string("%.0fM", col(c) / F.lit(1e6)))


def number(c: str | Column, decimals: int = 0) -> Column:
    return _or_na(col(c), F.format_string(f"%,.{decimals}f", col(c).cast("double")))


def narrative(rank: str | Column, growth: str | Column, import_share: str | Column) -> Column:
    """Sentence by rank, then growth and import dependency where they are known."""
    r, g, i = col(rank), col(growth), col(import_share)
    lead = F.lit(OTHER_RANK_SENTENCE)
    for position, sentence in RANK_SENTENCES.items():
        lead = F.when(r == position, F.lit(sentence)).otherwise(lead)
    return F.concat_ws(
        " ",
        lead,
        F.when(g.isNotNull(), F.concat(F.lit("5Y CAGR at "), pct_text(g, 1), F.lit("."))),
        F.when(i.isNotNull(), F.concat(F.lit("Import dependency near "), pct_text(i, 0), F.lit("."))),
    )


def reason(spec: MarketSpec, growth: str, import_share: str) -> Column:
    """One-line justification of a top candidate."""
    return F.concat(
        F.col(spec.name), F.lit(": size="), F.format_string("%,.0f", F.col(spec.consumption)),
        F.lit(", growth="), pct_text(zero_if_null(growth), 1),
        F.lit(", pop="), F.format_string("%.0fM", F.col(spec.population) / F.lit(1e6)),
        F.lit(", import_dep="), pct_text(zero_if_null(import_share), 0),
    )


def opportunity(spec: MarketSpec, import_share: str) -> Column:
    """Headline sentence of an entity's detail page."""
    return F.concat(
        F.col(spec.name), F.lit(" sits in "), F.coalesce(F.col(spec.region), F.lit(NOT_AVAILABLE)),
        F.lit(" with current consumption of "), number(spec.consumption),
        F.lit(" and import dependency of "), pct(import_share), F.lit("."),
    )


def note_for(name: str | Column, notes: Mapping[str, str], default: str = DEFAULT_NOTE) -> Column:
    """Note written for an entity, or the default note."""
    if not notes:
        return F.lit(default)
    pairs = [F.lit(x) for item in notes.items() for x in item]
    return F.coalesce(F.element_at(F.create_map(*pairs), col(name)), F.lit(default))
