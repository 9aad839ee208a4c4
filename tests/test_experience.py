"""Experience counts against a direct pairing in Python."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest

from crewlens.functions.skills import qualifying_pairs
from crewlens.functions.vocabulary import SKILL_PHRASES, qualifying_skills
from crewlens.operators import experience, skew
from crewlens.operators.experience import (
    position_ratings,
    position_summary,
    prior_experience,
    prior_position,
    prior_qualifying,
)

START = datetime(2024, 1, 1)
SKILLS = [*list(SKILL_PHRASES)[:7], "bartender", "barback", "sommelier", None]


def make(seed):
    rng = random.Random(seed)
    # Pro 1 holds a third of all rows; times collide on purpose.
    pros = [1] * 10 + list(range(2, 20))

    def at():
        return START + timedelta(hours=rng.choice([0, 1, 24, 25, 26, 48, 500]) + rng.randint(0, 9))

    hist = {
        (rng.choice(pros), gig): (
            rng.choice([10, 11, None]), at(), rng.choice([None, 0.0, 1.0, 3.5, 5.0, 6.0]),
            rng.choice(SKILLS),
        )
        for gig in range(900)
    }
    conf = {
        (gig, rng.choice(pros)): (rng.choice([10, 11, None]), at(), rng.choice(SKILLS))
        for gig in range(1000, 1300)
    }
    return conf, hist


def frames(spark, conf, hist):
    c = spark.createDataFrame(
        [(g, p, *v) for (g, p), v in conf.items()],
        "shift_id bigint, pro_id bigint, location_id bigint, start_time timestamp_ntz,"
        " skill_key string",
    )
    h = spark.createDataFrame(
        [(p, g, *v) for (p, g), v in hist.items()],
        "gigster_id bigint, gig_id bigint, location_id bigint, start_time timestamp_ntz,"
        " rating double, skill_key string",
    )
    return c, h


def accepts(wanted, held):
    if wanted is None or held is None:
        return False
    return held in (qualifying_skills(wanted) or [wanted])


def brute(conf, hist):
    by_pro = defaultdict(list)
    for (pro, _), row in hist.items():
        by_pro[pro].append(row)
    out = {}
    for (gig, pro), (loc, start, skill) in conf.items():
        before = [h for h in by_pro[pro] if h[1] < start]
        good = [h for h in before if accepts(skill, h[3])]
        rated = [h[2] for h in before if skill is not None and h[3] == skill
                 and h[2] is not None and 1 <= h[2] <= 5]
        same = [h for h in good if loc is not None and h[0] == loc]
        average = round(sum(rated) / len(rated) + 1e-12, 2) if rated else None
        out[(gig, pro)] = (len(good), len(same), average, len(rated))
    return out


@pytest.mark.parametrize("hot_rows", [None, 0.02])
@pytest.mark.parametrize("floor", [None, START, START + timedelta(hours=-5)])
def test_against_pairing(spark, monkeypatch, floor, hot_rows):
    if hot_rows:
        monkeypatch.setattr(skew, "EVEN_SHARES", hot_rows)
    conf, hist = make(7)
    if floor == START:
        # Older history folds only when it precedes every application.
        hist |= {(1, 5000 + i): (10, START - timedelta(days=i), 4.0, "dishwasher")
                 for i in range(1, 9)}
    expected = brute(conf, hist)
    c, h = frames(spark, conf, hist)
    pairs = qualifying_pairs(spark)
    counts = prior_experience(c, h, pairs, floor).collect()
    ratings = position_ratings(c, h, pairs, floor).collect()
    got_counts = {(r[0], r[1]): (r[2], r[3]) for r in counts}
    got_ratings = {
        (r[0], r[1]): (None if r[2] is None else float(r[2]), r[3]) for r in ratings
    }
    assert len(counts) == len(ratings) == len(conf)
    for key, (n, same, average, rated) in expected.items():
        assert got_counts[key] == (n, same), key
        assert got_ratings[key][1] == rated
        assert got_ratings[key][0] == pytest.approx(average, abs=0.0051)


@pytest.mark.parametrize("rows", [0, 300])
def test_pros_with_many_rows_are_counted_alike(spark, monkeypatch, rows):
    """All pros in slices of a day, or only pro 1, who holds a third of the rows."""
    conf, hist = make(13)
    hist |= {(1, 5000 + i): (10, START - timedelta(days=i), 4.0, "dishwasher") for i in range(1, 9)}
    c, h = frames(spark, conf, hist)
    monkeypatch.setattr(experience, "TIMED_ROWS", rows)
    counts = prior_experience(c, h, qualifying_pairs(spark), START).collect()
    ratings = position_ratings(c, h, qualifying_pairs(spark), START).collect()
    rated = {(r[0], r[1]): (r[3], r[2]) for r in ratings}
    expected = brute(conf, hist)
    assert {(r[0], r[1]): (r[2], r[3]) for r in counts} == {k: v[:2] for k, v in expected.items()}
    assert {k: v[0] for k, v in rated.items()} == {k: v[3] for k, v in expected.items()}
    for key, (_, _, average, _) in expected.items():
        got = rated[key][1]
        assert got == average if average is None else float(got) == pytest.approx(average, abs=0.0051)


def test_long_pros_are_those_with_many_rows(spark, monkeypatch):
    """Of applications or of history."""
    conf, hist = make(13)
    c, h = frames(spark, {k: v for k, v in conf.items() if k[1] != 2}, hist)
    points = h.selectExpr("gigster_id AS pro_id", "1 AS shifts")
    monkeypatch.setattr(experience, "TIMED_ROWS", 300)
    assert [r[0] for r in experience._long_pros(c, points, ["shifts"]).collect()] == [1]
    many = points.union(spark.range(301).selectExpr("2", "1"))
    assert sorted(r[0] for r in experience._long_pros(c, many, ["shifts"]).collect()) == [1, 2]


def test_positions_and_qualifying(spark):
    conf, hist = make(11)
    c, h = frames(spark, conf, hist)
    elevated = c.withColumnsRenamed({"shift_id": "gig_id", "pro_id": "gigster_id"})
    positions = prior_position(h)
    qualifying = {
        (r["gigster_id"], r["gig_id"]): r["prior_paid_qualifying_skill_shifts"]
        for r in prior_qualifying(elevated, positions, qualifying_pairs(spark)).collect()
    }
    summary = {
        (r["gigster_id"], r["gig_id"]): r["prior_paid_qualifying_skill_shifts"]
        for r in position_summary(elevated, positions, qualifying_pairs(spark)).collect()
    }
    assert len(summary) == len(conf)
    for (gig, pro), (_, _, skill) in conf.items():
        n = sum(accepts(skill, row[3]) for (p, _), row in hist.items() if p == pro)
        assert summary[(pro, gig)] == n
        if skill in SKILL_PHRASES:
            assert qualifying[(pro, gig)] == n
        else:
            assert (pro, gig) not in qualifying


def test_very_many_lookups_of_one_day(spark):
    """A day's lookups are never held together: 100,000 of one pro, with points before, between and after."""
    from pyspark.sql import functions as F

    conf = spark.range(100_000).select(
        F.col("id").alias("shift_id"), F.lit(7).cast("bigint").alias("pro_id"),
        F.lit(10).cast("bigint").alias("location_id"),
        F.expr("TIMESTAMP_NTZ '2024-01-02 00:00:00' + make_dt_interval(0, 0, 0, id % 86400)").alias("start_time"),
        F.lit("dishwasher").alias("skill_key"),
    )
    hist = spark.range(50).select(
        F.lit(7).cast("bigint").alias("gigster_id"), (F.col("id") + 10**6).alias("gig_id"),
        F.lit(10).cast("bigint").alias("location_id"),
        F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(0, id, 0, 0)").alias("start_time"),
        F.lit(4.0).alias("rating"), F.lit("dishwasher").alias("skill_key"),
    )
    found = prior_experience(conf, hist, qualifying_pairs(spark))
    counts = found.groupBy("prior_paid_qualifying_skill_shifts").count().collect()
    expected = defaultdict(int)
    for i in range(100_000):
        second = i % 86400
        expected[24 + min(26, -(-second // 3600))] += 1
    assert {r[0]: r[1] for r in counts if r[0] <= 50} == {min(k, 50): v for k, v in expected.items()}
    assert "collect_list" not in found._jdf.queryExecution().toString()
