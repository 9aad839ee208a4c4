"""Ranking, candidate selection, billing, checks and publishing on small tables."""

from __future__ import annotations

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from crewlens.functions import labels
from crewlens.operators import quality
from crewlens.operators.candidates import (
    confirmed_applications,
    historical_paid,
    restrict_to_keys,
    upcoming_locations,
)
from crewlens.operators.profiles import latest_profiles, pro_profiles, profiles_of_anyone
from crewlens.operators.ranking import first_shifts, shift_level, with_group_count
from crewlens.plans.outreach import attach_notes, outreach_queue
from crewlens.plans.summary import snapshot_counts
from crewlens.operators.quality import GateError
from crewlens.sources.publish import json_rows, latest_manifest, publish, publish_tables

AT = datetime(2026, 1, 1)


def test_first_shifts(spark):
    apps = spark.createDataFrame(
        [("Cafe ", 1, g, AT, datetime(2026, 1, d) if d else None) for g, d in
         [(1, 5), (2, 5), (3, None), (4, 1), (5, 2), (6, 3), (7, 9)]]
        + [(" cafe", 2, 9, AT, datetime(2025, 1, 1)), ("x", None, 8, AT, AT)]
        + [("Cafe ", 1, 4, datetime(2026, 2, 2), AT)],
        "location_name string, location_id bigint, gig_id bigint,"
        " gig_creation_time timestamp_ntz, gig_start_time_local timestamp_ntz",
    )
    gigs = spark.createDataFrame(
        [(g, "OPEN") for g in range(1, 8)] + [(9, "OPEN"), (10, None)], "id bigint, status string"
    ).withColumn("status", F.when(F.col("id") == 5, "CANCELLED").otherwise(F.col("status")))
    shifts = shift_level(apps, gigs)
    got = first_shifts(shifts).orderBy("business_shift_number").collect()
    assert [r["shift_id"] for r in got] == [9, 4, 6, 1, 2]
    assert got[1]["gig_created_at"] == datetime(2026, 2, 2)
    counts = with_group_count(first_shifts(shifts), ["business_key"], "n", of=shifts).collect()
    assert {r["n"] for r in counts} == {7}


def test_group_count_with_missing_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, v int")
    got = {(r["v"], r["n"]) for r in with_group_count(df, ["k"], "n").collect()}
    assert got == {(1, 2), (2, 2), (3, 1)}


APPLICATION = (
    "app_id bigint, gig_id bigint, gigster_id bigint, location_id bigint, skill string,"
    " is_confirmed boolean, is_canceled int, is_paid int, rating double,"
    " start_time timestamp_ntz, gig_start_time_local timestamp_ntz,"
    " confirmation_timestamp timestamp_ntz, rating_timestamp timestamp_ntz"
)


def application(app, gig=1, pro=1, confirmed=True, canceled=None, paid=1, start=AT, stamp=AT):
    return (app, gig, pro, 5, "Stage", confirmed, canceled, paid, 4.0, start, start, stamp, stamp)


def test_confirmed_applications(spark):
    late = datetime(2026, 1, 2)
    apps = spark.createDataFrame(
        [
            application(1, stamp=None), application(2), application(3), application(4, stamp=None),
            application(5, gig=2, confirmed=None), application(6, gig=2, canceled=1),
            application(7, gig=2, pro=None), application(8, gig=2, start=datetime(2025, 1, 1)),
            application(9, gig=3, stamp=None), application(10, gig=4, canceled=0, start=late),
        ],
        APPLICATION,
    )
    got = confirmed_applications(apps, None, AT).collect()
    assert {r["shift_id"]: r["app_id"] for r in got} == {1: 3, 3: 9, 4: 10}
    shifts = spark.createDataFrame([(1,), (1,), (4,)], "shift_id bigint")
    assert confirmed_applications(apps, shifts, AT).count() == 2
    assert {r["gig_id"] for r in historical_paid(apps, late).collect()} == {1, 2, 3}
    assert upcoming_locations(apps, date(2026, 1, 1)).count() == 1
    assert upcoming_locations(apps, date(2026, 3, 1)).count() == 0


def test_restrict_to_keys_is_only_a_filter(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k bigint")
    keys = spark.createDataFrame([(1,), (1,), (None,), (3,)], "k bigint")
    assert [r[0] for r in restrict_to_keys(df, keys, "k").collect()] == [1]


def test_profiles(spark):
    profiles = spark.createDataFrame(
        [(1, 7, "Old", datetime(2025, 1, 1), None), (2, 7, "Mid", AT, False), (3, 7, "New", AT, None),
         (4, 7, "Gone", datetime(2027, 1, 1), True), (5, 8, "Undated", None, None)],
        "id bigint, user_id bigint, bio string, last_updated_ts timestamp_ntz, deleted boolean",
    )
    assert {tuple(r) for r in latest_profiles(profiles).collect()} == {(7, "New"), (8, "Undated")}
    snapshot = spark.createDataFrame([(7, "Chef"), (9, None)], "pro_id bigint, experience string")
    texts = {r["pro_id"]: r["profile_text"] for r in pro_profiles(snapshot, profiles).collect()}
    assert texts == {7: "chef new", 9: " "}
    every = {
        r["pro_id"]: r["profile_text"] for r in profiles_of_anyone(snapshot, profiles).collect()
    }
    assert every == {7: "chef new", 8: " undated", 9: " "}


@pytest.mark.parametrize(
    "point, other, miles",
    [((40.0, -70.0), (40.0, -70.0), 0.0), ((0.0, 0.0), (0.0, 180.0), 12437.6),
     ((None, 0.0), (0.0, 0.0), None), ((0.0, 0.0), (0.0, None), None),
     ((40.7, -74.0), (34.05, -118.25), 2446.5)],
)
def test_distance(spark, point, other, miles):
    df = spark.createDataFrame([(*point, *other)], "a double, b double, c double, d double")
    got = df.select(labels.distance_miles(*map(F.col, "abcd"))).first()[0]
    assert (None if got is None else float(got)) == miles


def test_hours_do_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame(
        [(datetime(2026, 3, 8, 12), datetime(2026, 3, 8))], "a timestamp_ntz, b timestamp_ntz"
    )
    hours = labels.hours_to_start(F.col("a"), F.col("b"))
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert float(df.select(hours).first()[0]) == 12.0
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_outreach_queue_and_notes(spark):
    report = spark.createDataFrame(
        [("1-1", "No", 0, "No"), ("1-2", "No", 2, "No"), ("1-3", "Yes", 0, "Yes"),
         ("1-4", "Yes", 3, "No")],
        "row_key string, has_matching_profile_skill string, prior_paid_same_skill_shifts bigint,"
        " poor_position_rating string",
    )
    assert {r[0] for r in outreach_queue(report).collect()} == {"1-1", "1-3"}
    notes = spark.createDataFrame([("1-1", "n", "Ann")], "row_key string, notes string, agent_name string")
    assert {(r["row_key"], r["notes"]) for r in attach_notes(report, notes).collect()} == {
        ("1-1", "n"), ("1-2", None), ("1-3", None), ("1-4", None)
    }


def test_snapshot_counts(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "shift_id bigint")
    assert tuple(snapshot_counts(df).first()) == (4, 3)
    assert tuple(snapshot_counts(df.limit(0)).first()) == (0, 0)


def test_gates(spark):
    df = spark.createDataFrame([(1, "x +15551234567"), (1, "me@ex.com"), (2, None)], "k int, t string")
    with pytest.raises(quality.GateError):
        quality.require_rows(quality.emptied(df), "nothing")
    with pytest.raises(quality.GateError, match="z"):
        quality.require_columns(df, ["k", "z"])
    with pytest.raises(quality.GateError):
        quality.require_no_pii(df, ["t"])
    clean = quality.redact(df, ["k"], ["t"])
    assert clean.columns == ["t"]
    quality.require_no_pii(clean, ["t"])
    assert [tuple(r) for r in quality.duplicate_keys(df, "k").collect()] == [(1, 2)]
    scan = quality.pii_scan(df, "t").first()
    assert (scan["rows"], scan["rows_with_phone"], scan["rows_with_email"]) == (3, 1, 1)


def test_page_checks(spark):
    key = "mb-" + "0a" * 12
    pages = spark.createDataFrame(
        [(1, f'<article data-permanent-key="{key}"><p data-permanent-key="mb-XY">Catch-Up Mode')],
        "page int, html string",
    )
    keys = quality.extract_attr(pages, "html", "data-permanent-key", "page")
    assert [(r["position"], r["value"]) for r in keys.orderBy("position").collect()] == [
        (0, key), (1, "mb-XY")
    ]
    assert [r["value"] for r in quality.bad_format(keys, "value", quality.OPAQUE_KEY).collect()] == [
        "mb-XY"
    ]
    found = quality.forbidden(pages, "html", ["localhost:3000"], ["catch-up mode"]).first()
    assert found["found"] == ["catch-up mode"]
    expected = spark.createDataFrame([(key,), ("mb-other",)], "value string")
    diff = quality.set_diff(keys, expected, "value").first()
    assert (diff["missing"], diff["passed"]) == (1, False)
    assert quality.set_diff(expected, expected, "value").first()["passed"] is True
    panel = spark.createDataFrame([(1, 3), (2, 0), (3, 1)], "page int, live bigint")
    cards = spark.createDataFrame([(1, 2), (1, 1), (1, None), (3, None)], "page int, n bigint")
    got = {
        r["page"]: r["passed"] for r in quality.reconcile(cards, panel, "page", "n", "live").collect()
    }
    assert got == {1: True, 2: True, 3: False}


def test_publish(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, "é \"q\"", None, 2.5, datetime(2026, 1, 2, 3, 4, 5), True)],
        "a bigint, b string, c string, d double, e timestamp_ntz, f boolean",
    ).withColumn("g", F.lit("3.50").cast("decimal(5,2)"))
    columns = ["b", "a", "c", "d", "e", "f", "g"]
    text = json_rows(df, columns).first()["value"]
    assert json.loads(text) == ['é "q"', 1, None, 2.5, "2026-01-02 03:04:05", True, 3.5]
    assert "é" in text
    target = str(tmp_path / "out")
    assert publish(df, target, columns, datetime(2026, 1, 1, 2, 3, 4)) == 1
    assert publish(df.limit(0), target, columns, datetime(2026, 1, 1, 5, 0, 0)) == 0
    manifest = latest_manifest(spark, target)
    assert manifest["snapshot_utc"] == "2026-01-01T05:00:00Z"
    assert manifest["tables"]["rows"]["rows"] == 0
    # A failing gate leaves the newest manifest as it is.
    late = datetime(2026, 1, 1, 6, 0, 0)
    with pytest.raises(GateError, match="rows is empty"):
        publish_tables({"rows": (df.limit(0), columns)}, target, late)
    with pytest.raises(GateError, match="personal data in rows"):
        publish_tables({"rows": (df.withColumn("b", F.lit("a@b.org")), columns)}, target, late)
    assert latest_manifest(spark, target) == manifest
    # The same moment again: a new folder, and the later run counts.
    again = publish_tables({"rows": (df, columns)}, target, datetime(2026, 1, 1, 5, 0, 0))
    assert latest_manifest(spark, target) == again
    assert spark.read.text(again["tables"]["rows"]["folder"]).count() == 1


def good_page():
    key, other = "mb-" + "0a" * 12, "mb-" + "1b" * 12
    return (
        '<i data-agent="north"><i data-agent="south">'
        f'<article class="support-open" data-permanent-key="{key}" data-support-count="2">'
        f'<p data-permanent-key="{other}"><section class="support-panel" data-live-open="2">'
        f"const recordedPermanentRemovalKeys=new Set(['{key}',\n'{other}']);"
        "const REVIEW_ROWS = [[1],\n[2]]; const OTHER = [3];"
    )


@pytest.mark.parametrize(
    "old, new, failing",
    [
        ("", "", set()),
        ('data-agent="south"', 'data-agent="north"', {"agents_complete"}),
        ("1b" * 12 + '">', "0a" * 12 + '">', {"keys_unique"}),
        ("1b" * 12 + '">', "1B" * 12 + '">', {"keys_opaque"}),
        (' data-support-count="2"', "", {"cards_counted", "counts_agree"}),
        ('data-live-open="2"', 'data-live-open="3"', {"counts_agree"}),
        ("new Set([", "new Map([", {"registry_valid"}),
        ("const OTHER", "a@b.co const OTHER", {"no_personal_data"}),
        ("const OTHER", "Meeting Memory const OTHER", {"nothing_forbidden"}),
    ],
)
def test_published_page(spark, old, new, failing):
    from crewlens.plans.page_checks import page_checks

    page = good_page()
    assert old in page
    pages = spark.createDataFrame([(1, page.replace(old, new, 1))], "page int, html string")
    row = page_checks(pages, "html", ["north", "south"], "page").first().asDict()
    assert {name for name, passed in row.items() if passed is False} == failing | (
        {"passed"} if failing else set()
    )


def test_script_arrays(spark):
    from crewlens.plans.page_checks import array_literal_is_empty, without_array_rows

    pages = spark.createDataFrame([(good_page(),)], "html string")
    html = F.col("html")
    done = pages.select(without_array_rows(html, "REVIEW_ROWS").alias("html"))
    assert done.first()[0] == good_page().replace("[[1],\n[2]]", "[]")
    assert pages.select(array_literal_is_empty(html, "REVIEW_ROWS")).first()[0] is False
    assert done.select(array_literal_is_empty(html, "REVIEW_ROWS")).first()[0] is True
    with pytest.raises(Exception, match="no array OUTREACH_ROWS"):
        pages.select(without_array_rows(html, "OUTREACH_ROWS")).collect()
