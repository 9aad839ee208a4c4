"""Checks of published page markup, one row per page, read inside the row without a shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.quality import EMAIL, OPAQUE_KEY, PHONE, has_personal_data

# What a published page must not contain.
FORBIDDEN_EXACT = ["localhost:3000", "/api/removals"]
FORBIDDEN_ANY_CASE = ["catch-up mode", "meeting memory"]
# Script arrays of rows about persons.
PERSON_ARRAYS = ["REVIEW_ROWS", "OUTREACH_ROWS"]
# The markup that carries keys, counts and the removal registry.
KEY_ATTRIBUTE = 'data-permanent-key="mb-[0-9a-f]{24}"'
COUNT_ATTRIBUTE = r'data-support-count="(\d+)"'
CARD = '<article class="support-open"[^>]*>'
PANEL = '<section class="support-panel"[^>]*>'
REGISTRY = r"const recordedPermanentRemovalKeys=new Set\(\[([\s\S]*?)\]\);"


def _all(text: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def _unique(values: Column) -> Column:
    return F.size(F.array_distinct(values)) == F.size(values)


def _opaque(values: Column) -> Column:
    return F.forall(values, lambda v: v.rlike(OPAQUE_KEY))


def page_checks(
    pages: DataFrame, text_col: str, expected_agents: Sequence[str], *keep: str
) -> DataFrame:
    """One column per check, true when the page passes, and `passed` for all of them."""
    rows = pages.select(
        *keep,
        F.col(text_col).alias("_text"),
        _all(F.col(text_col), 'data-agent="([^"]+)"').alias("_agents"),
        _all(F.col(text_col), 'data-permanent-key="([^"]+)"').alias("_keys"),
        _all(F.col(text_col), CARD, 0).alias("_cards"),
        F.regexp_extract(F.col(text_col), PANEL, 0).alias("_panel"),
        F.regexp_extract(F.col(text_col), REGISTRY, 0).alias("_registry"),
    ).withColumn("_recorded", _all(F.col("_registry"), "'([^']+)'"))
    text = F.col("_text")
    represented = F.aggregate(
        "_cards",
        F.lit(0).cast("bigint"),
        lambda total, card: total
        + F.coalesce(F.regexp_extract(card, COUNT_ATTRIBUTE, 1).try_cast("bigint"), F.lit(0)),
    )
    live = F.regexp_extract("_panel", r'data-live-open="(\d+)"', 1).try_cast("bigint")
    wanted = F.array(*map(F.lit, expected_agents))
    checks = {
        "agents_complete": (F.size("_agents") == len(expected_agents))
        & (F.size(F.array_except(wanted, F.col("_agents"))) == 0),
        "keys_unique": _unique(F.col("_keys")),
        "keys_opaque": _opaque(F.col("_keys")),
        "cards_keyed": F.forall("_cards", lambda card: card.rlike(KEY_ATTRIBUTE)),
        "cards_counted": F.forall("_cards", lambda card: card.rlike(COUNT_ATTRIBUTE)),
        "counts_agree": F.coalesce(represented == live, F.lit(False)),
        "registry_valid": (F.col("_registry") != "")
        & _unique(F.col("_recorded"))
        & _opaque(F.col("_recorded")),
        "no_personal_data": ~text.rlike(PHONE) & ~text.rlike(EMAIL),
        "nothing_forbidden": ~_contains_any(text, FORBIDDEN_EXACT)
        & ~_contains_any(F.lower(text), FORBIDDEN_ANY_CASE),
    }
    result = rows.select(*keep, *[check.alias(name) for name, check in checks.items()])
    every = None
    for name in checks:
        every = F.col(name) if every is None else every & F.col(name)
    return result.withColumn("passed", every)


def _contains_any(text: Column, phrases: Sequence[str]) -> Column:
    found = None
    for phrase in phrases:
        one = text.contains(phrase)
        found = one if found is None else found | one
    return found


def array_literal_is_empty(text: Column, name: str) -> Column:
    """Whether the page declares the named script array as empty."""
    return text.contains(f"const {name} = [];")


def without_array_rows(text: Column, name: str) -> Column:
    """The page with the rows of the named script array taken out; fails without such an array."""
    head = f"const {name} = ["
    start = F.position(F.lit(head), text)
    end = F.position(F.lit("];"), text, start + len(head))
    emptied = F.concat(
        F.substring(text, F.lit(1), start - 1),
        F.lit(f"const {name} = [];"),
        F.substring(text, end + 2, F.length(text)),
    )
    missing = F.raise_error(F.lit(f"refusing to publish: no array {name}")).cast("string")
    return F.when((start > 0) & (end > 0), emptied).otherwise(missing)


def sanitized_pages(pages: DataFrame, text_col: str, *keep: str) -> DataFrame:
    """Pages with all person arrays emptied: whether each array was empty before, the page to write
    (null if it is blocked), and `blocked`: a phone number or e-mail address is left elsewhere."""
    text = F.col(text_col)
    was_empty = [array_literal_is_empty(text, n).alias(f"{n.lower()}_empty") for n in PERSON_ARRAYS]
    rows = pages.select(*keep, *was_empty, text.alias("_page"))
    for name in PERSON_ARRAYS:  # a column for each step: nested, a step would be evaluated at each use
        rows = rows.withColumn("_page", without_array_rows(F.col("_page"), name))
    return (
        rows.withColumn("blocked", has_personal_data(F.col("_page")))
        .withColumn("page", F.when(~F.col("blocked"), F.col("_page")))
        .drop("_page")
    )
