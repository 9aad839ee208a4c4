from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from crewlens.functions.skills import (
    badge_evidence,
    ladder_closure,
    profile_evidence,
    qualifying_pairs,
    skill_key,
    skill_ladder,
)
from crewlens.functions.vocabulary import (
    BADGES,
    SKILL_ALIASES,
    SKILL_BADGES,
    SKILL_PHRASES,
    TRACKS,
    ladder_rows,
    qualifying_skills,
)


def test_vocabulary_is_consistent():
    on_ladder = {skill for rungs in TRACKS.values() for skill in rungs}
    assert len(ladder_rows()) == 35 and len(TRACKS) == 9 and len(on_ladder) == 27
    assert on_ladder == set(SKILL_PHRASES) == set(SKILL_BADGES)
    assert set(SKILL_ALIASES) <= on_ladder
    assert len(BADGES) == len(set(BADGES)) == 28
    assert not any(re.search(r"[%_\\]", p) for ps in SKILL_PHRASES.values() for p in ps)


def test_closure_equals_fixed_pairs(spark):
    closure = {tuple(r) for r in ladder_closure(skill_ladder(spark)).collect()}
    assert closure == {tuple(r) for r in qualifying_pairs(spark).collect()}
    assert len(closure) == 85
    assert ("dishwasher", "baker/pastry cook") in closure
    assert ("baker/pastry cook", "line cook") not in closure


def test_skill_key(spark):
    given = ["  Food Service Worker", "B&W Bartender", "sommelier", None, "Coat Check", "STAGE"]
    rows = spark.createDataFrame([(g,) for g in given], "skill string")
    got = [r[0] for r in rows.select(skill_key(F.col("skill"))).collect()]
    assert got == [
        "food assembler", "beer & wine bartender", "sommelier", None, "coat check attendant",
        "stage",
    ]


def flag(spark, text, raw, blank=True):
    rows = spark.createDataFrame([(text, raw)], "text string, raw string")
    column = profile_evidence(F.col("text"), skill_key(F.col("raw")), F.col("raw"), blank)
    return rows.select(column).first()[0]


@pytest.mark.parametrize(
    "text, raw, expected",
    [
        ("beer & wine bartender", "bartender", 1),  # the raw label re-admits it
        ("beer & wine bartender", "full-service bartender", 0),
        ("a bartender", "full-service bartender", 1),
        ("mixologist", "barback", 1),
        ("barback", "mixologist", 0),
        ("banquet chef", "dishwasher", 1),
        ("dishwasher", "event chef", 0),
        ("housekeeper", "banquet setup", 1),
        ("line cook", "baker/pastry cook", 0),
        ("line xcook", "line_cook", 0),
        ("line cook", "line_cook", 1),  # the label's underscore is a wildcard
        ("100 percent", "100%t", 1),
        ("a\\b", "a\\b", 1),
        ("any text", None, 0),
        ("any text", "", 1),
        ("  ", "", 0),
        (None, "stage", 0),
        ("i am a sommelier here", "Sommelier", 1),
    ],
)
def test_profile_evidence(spark, text, raw, expected):
    assert flag(spark, text, raw) == expected


def test_blank_text_counts_in_the_outreach_form(spark):
    assert flag(spark, " ", "", blank=False) == 1
    assert flag(spark, " ", "stage", blank=False) == 0


def test_profile_evidence_for_every_skill_and_phrase(spark):
    """Each skill against each single phrase, by the ladder's definition."""
    rows = [
        (skill, phrase, holder)
        for skill in SKILL_PHRASES
        for holder, phrases in SKILL_PHRASES.items()
        for phrase in phrases
    ]
    df = spark.createDataFrame(rows, "skill string, phrase string, holder string")
    got = df.select(
        "skill", "phrase",
        profile_evidence(F.col("phrase"), F.col("skill"), F.col("skill")).alias("flag"),
    ).collect()
    for row in got:
        accepted = [p for s in qualifying_skills(row["skill"]) for p in SKILL_PHRASES[s]]
        expected = any(p in row["phrase"] for p in accepted + [row["skill"]])
        if row["skill"] == "bartender" and "bartender" in row["phrase"]:
            expected = True
        assert row["flag"] == int(expected), row


def test_badge_evidence_for_every_skill_and_badge(spark):
    columns = ", ".join(f"cert_{b} int" for b in BADGES)
    rows = [
        (skill, held, *[1 if b == held else None for b in BADGES])
        for skill in [*SKILL_BADGES, "sommelier", None]
        for held in BADGES
    ]
    df = spark.createDataFrame(rows, f"skill_key string, held string, {columns}")
    for row in df.select("skill_key", "held", badge_evidence(F.col("skill_key")).alias("v")).collect():
        if row["skill_key"] not in SKILL_BADGES:
            assert row["v"] is None
        else:
            good = [b for s in qualifying_skills(row["skill_key"]) for b in SKILL_BADGES[s]]
            assert row["v"] == int(row["held"] in good), row
