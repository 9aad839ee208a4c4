"""Skill keys, ladder tables and evidence columns."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import bind
from .vocabulary import (
    BADGES,
    GUARDED_PHRASES,
    SKILL_ALIASES,
    SKILL_BADGES,
    SKILL_PHRASES,
    ladder_rows,
    qualifying_skills,
)


def skill_key(skill: Column) -> Column:
    """Lower-cased, space-trimmed label with known spellings folded together."""
    plain = F.lower(F.trim(skill))
    folded = None
    for canonical, spellings in SKILL_ALIASES.items():
        start = F if folded is None else folded
        folded = start.when(plain.isin(spellings), F.lit(canonical))
    return folded.otherwise(plain)


def _fixed_table(spark: SparkSession, rows: list[tuple], columns: str) -> DataFrame:
    """A small literal table the optimizer knows the size of."""
    values = ", ".join(
        "(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in row) + ")"
        for row in rows
    )
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({columns})")


def skill_ladder(spark: SparkSession) -> DataFrame:
    """The 35 (track, skill_key, tier) rungs."""
    return _fixed_table(spark, ladder_rows(), "track, skill_key, tier")


def qualifying_pairs(spark: SparkSession) -> DataFrame:
    """The closure of the fixed ladder as a literal table of 85 (skill_key, matched_key) rows."""
    pairs = [(skill, above) for skill in SKILL_PHRASES for above in qualifying_skills(skill)]
    return _fixed_table(spark, pairs, "skill_key, matched_key")


def ladder_closure(ladder: DataFrame) -> DataFrame:
    """Distinct (skill_key, matched_key): the matched rung is as high or higher in a shared track."""
    target, matched = ladder.alias("target"), ladder.alias("matched")
    return (
        target.join(
            matched,
            (F.col("target.track") == F.col("matched.track"))
            & (F.col("matched.tier") >= F.col("target.tier")),
        )
        .select(
            F.col("target.skill_key").alias("skill_key"),
            F.col("matched.skill_key").alias("matched_key"),
        )
        .distinct()
    )


def _by_skill(entries: dict[str, list], key: Column) -> Column:
    """Look a skill up in a literal map; it folds to one constant in the plan."""
    return F.create_map(
        *[
            part
            for skill, items in entries.items()
            for part in (F.lit(skill), F.array(*map(F.lit, items)))
        ]
    )[key]


def _listed_phrase(text: Column, key: Column) -> Column:
    """Whether a phrase of the skill, or of one above it, occurs in the text."""
    phrases = {
        skill: [p for above in qualifying_skills(skill) for p in SKILL_PHRASES[above]]
        for skill in SKILL_PHRASES
    }
    found = F.exists(_by_skill(phrases, key), lambda phrase: F.contains(text, phrase))
    for skill, (bare, blockers) in GUARDED_PHRASES.items():
        blocked = reduce(lambda a, b: a | b, [text.contains(b) for b in blockers])
        found = found | ((key == skill) & text.contains(bare) & ~blocked)
    return found


def _names_skill(text: Column, raw_skill: Column) -> Column:
    """text LIKE %skill%; the label's own % and _ stay wildcards, a backslash is literal."""
    label = F.lower(F.trim(raw_skill))
    pattern = F.concat(F.lit("%"), F.replace(label, F.lit("\\"), F.lit("\\\\")), F.lit("%"))
    return F.when(label.rlike(r"[%_\\]"), F.like(text, pattern)).otherwise(F.contains(text, label))


def profile_evidence(
    text: Column, key: Column, raw_skill: Column, blank_counts_as_missing: bool = True
) -> Column:
    """1 when the profile text shows the skill or a higher one, else 0.

    A skill whose phrases all fail still matches when the text names the raw label.
    """
    missing = text.isNull()
    if blank_counts_as_missing:
        missing = missing | (F.trim(text) == "")
    return (
        F.when(missing, 0)
        .when(_listed_phrase(text, key), 1)
        .when(_names_skill(text, raw_skill), 1)
        .otherwise(0)
    )


def badge_evidence(
    key: Column, badge: Callable[[str], Column] = lambda name: F.col(f"cert_{name}")
) -> Column:
    """Highest badge value among the skill and those above it; NULL off the ladder."""
    positions = {
        skill: [
            BADGES.index(name)
            for above in qualifying_skills(skill)
            for name in SKILL_BADGES[above]
        ]
        for skill in SKILL_BADGES
    }
    held = F.array(*[F.coalesce(badge(name), F.lit(0)) for name in BADGES])
    wanted = _by_skill(positions, key)
    return bind(
        held, lambda values: F.array_max(F.transform(wanted, lambda i: F.get(values, i)))
    )


def badge_status(profile_flag: Column, badge_flag: Column) -> Column:
    shown, badged, unbadged = profile_flag == 1, badge_flag == 1, badge_flag == 0
    return (
        F.when(shown & badged, "Profile + Badge")
        .when(shown & unbadged, "Profile Only")
        .when(shown & badge_flag.isNull(), "Profile (Badge N/A)")
        .when((profile_flag == 0) & badged, "Badge Only")
        .when((profile_flag == 0) & unbadged, "Neither")
        .otherwise("No Profile Match (Badge N/A)")
    )


def yes_no(test: Column) -> Column:
    return F.when(test, "Yes").otherwise("No")


def any_true(*tests: Column) -> Column:
    return reduce(lambda a, b: a | b, tests)


def profile_match_source(profile_flag: Column, badge_flag: Column) -> Column:
    return (
        F.when(profile_flag == 1, "Profile experience (same or higher tier)")
        .when(badge_flag == 1, "Profile skill/certification (same or higher tier)")
        .otherwise("No match")
    )
