"""One query per operator, run over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crewlens.functions import clock, labels, text
from crewlens.functions.skills import (
    badge_status,
    ladder_closure,
    profile_match_source,
    qualifying_pairs,
    skill_key,
    skill_ladder,
)
from crewlens.operators import quality, roster
from crewlens.operators.billing import needs_billing
from crewlens.operators.candidates import (
    confirmed_applications,
    elevated_shifts,
    historical_paid,
    moment,
    upcoming_locations,
)
from crewlens.operators.experience import (
    LOOKED_UP,
    position_ratings,
    prior_experience,
    prior_position,
    prior_qualifying,
)
from crewlens.operators.profiles import latest_profiles, pro_profiles
from crewlens.operators.ranking import (
    first_shifts,
    notes_by_key,
    shift_level,
    with_group_count,
)
from crewlens.operators.skew import hot_keys
from crewlens.plans import sheets
from crewlens.plans.agents import agents_online
from crewlens.plans.billing import PAYMENT_COLUMNS, billing_report
from crewlens.plans.outreach import attach_notes, elevated_signals, outreach_queue, vip_outreach
from crewlens.plans.page_checks import page_checks as check_pages
from crewlens.plans.page_checks import sanitized_pages
from crewlens.plans.qualification import (
    PUBLISHED_NAMES,
    SHIFT_LINK_COLUMNS,
    experience_labels,
    first_five_qualification,
    first_shift_candidates,
    with_evidence,
)
from crewlens.plans.summary import snapshot_counts
from crewlens.sources.publish import json_rows, publish_tables, read_quarantine, read_snapshot
from crewlens.sources.sheets import rows_of, split_sections
from crewlens.sources.staging import new_folder, staged

from . import tables as lens_tables
from .dialect import Spark
from .tables import base, lens, row_count

AS_OF = datetime(1997, 1, 1, 12, 0, 0)
TODAY = date(1997, 1, 1)
AHEAD_DAYS = 90
ONE_DAY = date(2024, 1, 22)
BASE_URL = "https://staffing.example.com"
SHEET_ZONE = "Asia/Manila"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so both engines hand over the same type."""
    decimals = [f.name for f in df.schema if isinstance(f.dataType, T.DecimalType)]
    return df.withColumns({c: F.col(c).cast("double") for c in decimals})


def joined(values: Column) -> Column:
    return F.array_join(F.transform(values, lambda v: v.cast("string")), ",")


# Reports


@query
def first_five_report(spark, d):
    return plain(first_five_qualification(lens(spark, d), AS_OF, row_count(spark, d, "lineitem")))


@query
def vip_outreach_report(spark, d):
    return plain(vip_outreach(lens(spark, d), AS_OF, BASE_URL, AHEAD_DAYS))


@query
def billing_status(spark, d):
    return billing_report(lens(spark, d), TODAY)


def _agents(spark, d, day=None):
    t = lens(spark, d)
    # The daily roster sheets of a year are one roster, in which a name's latest row counts.
    one_roster = t["roster"].withColumn("sheet", F.substring("sheet", 1, 4))
    return agents_online(one_roster, t["clockins"], t["aliases"], SHEET_ZONE, day)


@query
def agents_on_shift(spark, d):
    return _agents(spark, d)


@query
def agents_one_day(spark, d):
    return _agents(spark, d, ONE_DAY)


# Sources and sinks


@query
def source_tables(spark, d):
    found = None
    for name, df in lens(spark, d).items():
        one = df.agg(F.count(F.lit(1)).alias("table_rows")).select(
            F.lit(name).alias("table_name"), "table_rows"
        )
        found = one if found is None else found.unionByName(one)
    return found


def payment_lines(spark, d):
    """A payment export per nation as physical CSV lines, with quoted line breaks. Each sheet has a
    header after its customers up to 40; some have another one, and then repeat it as a row."""

    def header(nation: str) -> Column:
        return F.when(F.col(nation) % 2 == 0, ",".join(PAYMENT_COLUMNS)).otherwise(
            ",".join(["location_id", "extra", *PAYMENT_COLUMNS[:0:-1]])
        )

    titles = header("c_nationkey")
    key = F.when(F.col("c_custkey") % 23 != 0, F.col("c_custkey").cast("string")).otherwise("")
    name = F.when(
        F.col("c_custkey") % 10 == 3,
        F.concat(F.lit('"'), "c_name", F.lit(', the ""old""\none"')),
    ).when(  # a quote inside a plain cell, and text after a closing quote
        F.col("c_custkey") % 10 == 6, F.concat("c_name", F.lit(' 6" pipe'))
    ).when(
        F.col("c_custkey") % 10 == 8, F.concat(F.lit('"'), "c_name", F.lit('" tail'))
    ).otherwise(F.col("c_name"))
    status = F.when(F.col("c_custkey") % 4 == 0, " ").otherwise(F.lower("c_mktsegment"))
    even = F.concat_ws(",", key, name, status, F.lit("Yes"), F.lit("a scope"))
    odd = F.concat_ws(",", key, F.lit("x"), F.lit("a scope"), F.lit("Yes"), status, name)
    short = F.concat_ws(",", key, F.lit('"q"'))
    record = (
        F.when(F.col("c_custkey") % 31 == 5, titles)
        .when(F.col("c_custkey") % 13 == 1, short)
        .when(F.col("c_nationkey") % 2 == 0, even)
        .otherwise(odd)
    )
    lines = base(spark, d, "customer").select(
        F.concat(F.lit("nation "), F.col("c_nationkey").cast("string")).alias("sheet"),
        "c_custkey",
        F.posexplode(F.split(record, "\n")).alias("part", "value"),
    )
    line = F.col("c_custkey") * 10 + F.col("part")
    sheet_titles = base(spark, d, "nation").select(
        F.concat(F.lit("nation "), F.col("n_nationkey").cast("string")).alias("sheet"),
        F.lit(405).cast("bigint").alias("line"), header("n_nationkey").alias("value"),
    )
    return lines.select("sheet", line.alias("line"), "value").unionByName(sheet_titles).select(
        "sheet", F.expr("line DIV 333").alias("block"), "line", "value"
    )


@query
def sheet_rows(spark, d):
    return sheets.payment_sheet(rows_of(payment_lines(spark, d)))


def vip_shift_rows(spark, d):
    s = Spark()
    cells = [
        "CASE WHEN o_orderkey % 19 = 4 THEN ' ' ELSE CAST(o_orderkey AS STRING) END",
        s.pick(lens_tables.DATE_TEXTS, "o_orderkey"),
        "' ' || o_orderpriority",
        "'Venue ' || CAST(o_custkey AS STRING)",
        "''",
        s.pick(lens_tables.FLAG_TEXTS, "o_orderkey"),
        s.pick(lens_tables.WHOLE_TEXTS, "o_orderkey"),
        "CAST(o_totalprice AS STRING)",
    ]
    orders = base(spark, d, "orders")
    sheet = "'Q' || CAST(quarter(o_orderdate) AS STRING) AS sheet"
    title = "array(' id ', 'start')"
    rows = orders.selectExpr(
        sheet, "o_orderkey * 2 AS line",
        f"CASE WHEN o_orderkey % 499 = 17 THEN {title} ELSE array({', '.join(cells)}) END AS cells",
    )
    titles = orders.selectExpr(sheet, "o_orderkey").groupBy("sheet").agg(
        F.expr("min(o_orderkey) * 2 + 1 AS line"), F.expr(f"any_value({title}) AS cells")
    )
    return rows.unionByName(titles).selectExpr(
        "sheet", "named_struct('block', line DIV 1000, 'line', line) AS row_no", "cells"
    )


@query
def positional_rows(spark, d):
    return sheets.vip_shift_sheet(vip_shift_rows(spark, d))


def section_rows(spark, d):
    def titles(name):
        return F.array(F.lit(""), *map(F.lit, sheets.SECTION_HEADERS[name]), F.lit(""))

    e = F.col("event_id")
    kind = (
        F.when(e % 61 == 3, titles("SEC1"))
        .when(e % 61 == 20, titles("SEC2"))
        .when(e % 61 == 40, titles("SEC3"))
        .when(e % 17 == 0, F.array(F.lit("x"), F.lit(""), F.lit("")))
        .when(e % 71 == 0, F.array(F.lit("x")))
        .otherwise(F.array(F.lit(""), F.col("event_type"), F.lit(""), e.cast("string"), F.lit("")))
    )
    return base(spark, d, "events").select(
        F.concat(F.lit("team "), (F.col("user_id") % 10).cast("string")).alias("sheet"),
        F.struct(F.expr("event_id DIV 100").alias("block"), e.alias("line")).alias("row_no"),
        kind.alias("cells"),
    )


@query
def sheet_sections(spark, d):
    return split_sections(section_rows(spark, d), sheets.SECTION_HEADERS).select(
        "sheet", F.col("row_no.line").alias("line"), "section",
        F.array_join("cells", "|").alias("cells"),
    )


@query
def snapshot_rows(spark, d):
    return json_rows(billing_report(lens(spark, d), TODAY), PAYMENT_COLUMNS)


@query
def published_snapshot(spark, d):
    """Payments and last notes published in two phases, then read through the newest manifest."""
    folder = new_folder(spark, "snapshots")
    notes = notes_by_key(lens(spark, d)["notes"])
    publish_tables(
        {
            "PAYMENT_ROWS": (billing_report(lens(spark, d), TODAY), PAYMENT_COLUMNS),
            "NOTE_ROWS": (notes, ["row_key", "notes", "agent_name"]),
            "REVIEW_ROWS": (quality.emptied(notes), ["row_key"]),
        },
        folder, AS_OF, may_be_empty=["REVIEW_ROWS"],
    )
    return read_snapshot(spark, folder)


# Standardization


def _key_counts(t):
    return t["applications"].groupBy(skill_key(F.col("skill")).alias("used_key")).agg(
        F.count(F.lit(1)).alias("applications")
    )


@query
def ladder_usage(spark, d):
    ladder = skill_ladder(spark)
    counts = _key_counts(lens(spark, d))
    return ladder.join(counts, F.col("skill_key") == F.col("used_key"), "left").select(
        "track", "skill_key", "tier", F.coalesce("applications", F.lit(0)).alias("applications")
    )


@query
def closure_usage(spark, d):
    closure = ladder_closure(skill_ladder(spark))
    counts = _key_counts(lens(spark, d))
    return closure.join(counts, F.col("matched_key") == F.col("used_key"), "left").select(
        "skill_key", "matched_key", F.coalesce("applications", F.lit(0)).alias("applications")
    )


@query
def skill_keys(spark, d):
    return lens(spark, d)["applications"].select(
        "app_id", "gig_id", skill_key(F.col("skill")).alias("skill_key")
    )


@query
def typed_cells(spark, d):
    raw = lens(spark, d)["raw_sheet"].withColumn("float_text", F.col("whole_text"))
    return sheets.coerce_columns(
        raw, ["whole_text"], ["float_text"], ["pct_text"], ["date_text"], ["free_text"]
    ).select("event_id", "whole_text", "float_text", "pct_text", "date_text", "free_text")


@query
def normalized_datetimes(spark, d):
    return lens(spark, d)["raw_sheet"].select(
        "event_id",
        text.normalize_datetime(F.col("date_text")).alias("report_time"),
        text.normalize_datetime(F.col("date_text"), sheets.ALL_FORMATS).alias("outreach_time"),
    )


@query
def onoff_flags(spark, d):
    return lens(spark, d)["raw_sheet"].select(
        "event_id", text.to_onoff(F.col("flag_text")).alias("flag")
    )


@query
def cleaned_text(spark, d):
    tabbed = F.concat(F.lit("\t"), F.col("free_text"), F.lit(" \n"))
    return lens(spark, d)["raw_sheet"].select("event_id", text.clean(tabbed).alias("cleaned"))


@query
def published_names(spark, d):
    return sheets.project_as(first_five_report(spark, d), PUBLISHED_NAMES)


# Ranking


def _shifts(t):
    return shift_level(t["applications"], t["gigs"])


@query
def shift_rollup(spark, d):
    return _shifts(lens(spark, d))


@query
def first_five_shifts(spark, d):
    shifts = _shifts(lens(spark, d))
    return with_group_count(
        first_shifts(shifts), ["business_key"], "total_business_postings", of=shifts
    )


@query
def business_postings(spark, d):
    return with_group_count(
        _shifts(lens(spark, d)).select("business_key", "shift_id", "location_id", "business_name"),
        ["business_key"],
        "total_business_postings",
    )


@query
def latest_bios(spark, d):
    return latest_profiles(lens(spark, d)["profiles"])


@query
def latest_notes(spark, d):
    return notes_by_key(lens(spark, d)["notes"])


# Candidate selection

CONFIRMED_COLUMNS = [
    "shift_id", "pro_id", "app_id", "location_id", "start_time", "skill", "skill_key",
]


@query
def confirmed_first_five(spark, d):
    return first_shift_candidates(lens(spark, d), AS_OF).select(*CONFIRMED_COLUMNS)


@query
def elevated_applications(spark, d):
    t = lens(spark, d)
    return elevated_shifts(t["applications"], t["locations"], AS_OF, AHEAD_DAYS).select(
        "gig_id", "gigster_id", "app_id", "location_id", "gig_start_time_local", "skill_key"
    )


@query
def upcoming_location_ids(spark, d):
    return upcoming_locations(lens(spark, d)["applications"], TODAY)


@query
def paid_history(spark, d):
    return historical_paid(lens(spark, d)["applications"])


@query
def paid_history_before(spark, d):
    return historical_paid(lens(spark, d)["applications"], AS_OF)


# Joins and aggregations


def _history_inputs(spark, d):
    t = lens(spark, d)
    apps = t["applications"]
    return (
        confirmed_applications(apps, None, AS_OF),
        historical_paid(apps),
        qualifying_pairs(spark),
    )


@query
def earlier_experience(spark, d):
    worked = row_count(spark, d, "lineitem")
    return prior_experience(*_history_inputs(spark, d), floor=AS_OF, worked=worked)


@query
def earlier_ratings(spark, d):
    worked = row_count(spark, d, "lineitem")
    return plain(position_ratings(*_history_inputs(spark, d), floor=AS_OF, worked=worked))


@query
def earlier_positions(spark, d):
    return plain(prior_position(historical_paid(lens(spark, d)["applications"], AS_OF)))


@query
def qualifying_history(spark, d):
    t = lens(spark, d)
    return prior_qualifying(
        elevated_shifts(t["applications"], t["locations"], AS_OF, AHEAD_DAYS),
        prior_position(historical_paid(t["applications"], AS_OF)),
        qualifying_pairs(spark),
    )


@query
def profile_texts(spark, d):
    t = lens(spark, d)
    return pro_profiles(t["pro_snapshot"], t["profiles"]).select("pro_id", "profile_text")


@query
def outreach_with_notes(spark, d):
    notes = notes_by_key(lens(spark, d)["notes"])
    return attach_notes(vip_outreach_report(spark, d), notes).select(
        "row_key", "pro_id", "qualification_gap", "notes", "agent_name"
    )


@query
def report_counts(spark, d):
    return snapshot_counts(first_shift_candidates(lens(spark, d), AS_OF))


# Derived signals


def _evidence(spark, d):
    t = lens(spark, d)
    confirmed = confirmed_applications(t["applications"], None, AS_OF)
    return with_evidence(confirmed, pro_profiles(t["pro_snapshot"], t["profiles"]))


@query
def profile_flags(spark, d):
    return _evidence(spark, d).select(
        "shift_id", "pro_id", "profile_experience_qualifying_flag"
    )


@query
def profile_flags_from_bio(spark, d):
    """The outreach form: a bio counts without a snapshot and a blank text is not missing."""
    return elevated_signals(lens(spark, d), AS_OF, AHEAD_DAYS).select(
        "gig_id", "gigster_id", F.col("profile_flag").alias("profile_experience_qualifying_flag")
    )


@query
def badge_flags(spark, d):
    return _evidence(spark, d).select("shift_id", "pro_id", "confirmed_skill_badged_flag")


@query
def badge_labels(spark, d):
    return _evidence(spark, d).select(
        "shift_id", "pro_id",
        badge_status(
            F.col("profile_experience_qualifying_flag"), F.col("confirmed_skill_badged_flag")
        ).alias("confirmed_skill_profile_badge_status"),
    )


@query
def experience_flags(spark, d):
    t = lens(spark, d)
    confirmed, history, pairs = _history_inputs(spark, d)
    # Written once, for the evidence and for the earlier experience.
    confirmed = staged(confirmed.select(*LOOKED_UP, "skill"), "confirmed")
    hot = hot_keys(confirmed, "pro_id")
    experience = prior_experience(
        confirmed, history, pairs, AS_OF, hot, row_count(spark, d, "lineitem"), written=True
    )
    rows = with_evidence(confirmed, pro_profiles(t["pro_snapshot"], t["profiles"]), hot).join(
        experience, ["shift_id", "pro_id"], "left"
    )
    flags = experience_labels(
        F.col("profile_experience_qualifying_flag"),
        F.col("confirmed_skill_badged_flag"),
        F.coalesce("prior_paid_qualifying_skill_shifts", F.lit(0)),
        F.coalesce("prior_paid_qualifying_skill_shifts_same_business", F.lit(0)),
    )
    return rows.select("shift_id", "pro_id", *[c.alias(name) for name, c in flags.items()])


@query
def match_sources(spark, d):
    return _evidence(spark, d).select(
        "shift_id", "pro_id",
        profile_match_source(
            F.col("profile_experience_qualifying_flag"), F.col("confirmed_skill_badged_flag")
        ).alias("profile_match_source"),
    )


@query
def outreach_statuses(spark, d):
    return lens(spark, d)["applications"].select(
        "app_id", "gig_id",
        labels.outreach_status(F.col("outreached"), F.col("outreach_pro_response")).alias(
            "outreach_status"
        ),
    )


@query
def qualification_gaps(spark, d):
    return vip_outreach_report(spark, d).select(
        "row_key", "poor_position_rating", "qualification_gap"
    )


@query
def outreach_queue_rows(spark, d):
    return outreach_queue(vip_outreach_report(spark, d)).select("row_key", "qualification_gap")


@query
def hours_to_start(spark, d):
    return plain(
        lens(spark, d)["applications"].select(
            "app_id", "gig_id",
            labels.hours_to_start(F.col("gig_start_time_local"), moment(AS_OF)).alias(
                "hours_to_start"
            ),
        )
    )


@query
def distances(spark, d):
    t = lens(spark, d)
    pros = t["pro_snapshot"].select("pro_id", "pro_last_lat", "pro_last_long")
    return plain(
        t["applications"].join(pros, F.col("gigster_id") == F.col("pro_id"), "left").select(
            "app_id", "gig_id",
            labels.distance_miles(
                F.col("pro_last_lat"), F.col("pro_last_long"),
                F.col("location_address_latitude"), F.col("location_address_longitude"),
            ).alias("distance_miles"),
        )
    )


@query
def scaled_percentages(spark, d):
    shares = ["completion_percentage", "completion_percentage_30", "pro_cancel_percentage_30"]
    return plain(
        lens(spark, d)["pro_snapshot"].select(
            "pro_id", *[labels.pct(F.col(c)).alias(f"{c}_pct") for c in shares]
        )
    )


@query
def tri_state_labels(spark, d):
    t = lens(spark, d)
    pros = t["pro_snapshot"].select("pro_id", "verified_pro")
    return t["applications"].join(
        pros, F.col("gigster_id") == F.col("pro_id"), "left"
    ).select(
        "app_id", "gig_id",
        labels.auto_select(F.col("gig_auto_select_enabled")).alias("auto_select_status"),
        labels.verified(F.col("verified_pro")).alias("verified_status"),
    )


@query
def row_links(spark, d):
    return lens(spark, d)["applications"].select(
        "app_id",
        labels.row_key(F.col("gig_id"), F.col("gigster_id")).alias("row_key"),
        labels.applicants_link(BASE_URL, F.col("location_id"), F.col("gig_id")).alias("shift_url"),
    )


@query
def locations_needing_billing(spark, d):
    return needs_billing(billing_report(lens(spark, d), TODAY))


# Roster, schedules and clock-ins


@query
def roster_days(spark, d):
    return roster.roster_long(lens(spark, d)["roster"])


@query
def roster_hours(spark, d):
    return roster.with_shift_hours(roster.roster_long(lens(spark, d)["roster"]))


@query
def hour_labels(spark, d):
    hour = F.hour("ts")
    return base(spark, d, "events").select(
        "event_id", clock.hour_label(hour).alias("hour_label")
    )


@query
def clock_times(spark, d):
    return lens(spark, d)["raw_sheet"].select(
        "event_id", clock.clock_micros(F.col("clock_text")).alias("clock_micros")
    )


@query
def schedule_segments(spark, d):
    raw = lens(spark, d)["raw_sheet"]
    return roster.segment_rows(raw, "schedule_text", "event_id").withColumn("days", joined("days"))


@query
def segment_days(spark, d):
    raw = lens(spark, d)["raw_sheet"]
    return raw.select(
        "event_id", joined(clock.segment_days(F.col("schedule_text"))).alias("days")
    )


@query
def scheduled_starts(spark, d):
    day = F.col("work_date")
    return lens(spark, d)["raw_sheet"].select(
        "event_id",
        clock.scheduled_start(
            F.col("schedule_text"), F.weekday(day), day, F.lit(SHEET_ZONE)
        ).alias("scheduled_start"),
    )


@query
def late_clockins(spark, d):
    rows = lens(spark, d)["raw_sheet"].select(
        "event_id", "work_date", F.col("schedule_text").alias("schedule"),
        F.col("clock_text").alias("clock_in"),
    )
    return roster.with_lateness(rows, SHEET_ZONE).select("event_id", "late")


@query
def open_clockins(spark, d):
    return roster.open_sessions(lens(spark, d)["clockins"]).drop("sheet")


@query
def week_labels(spark, d):
    day = F.col("work_date")
    return lens(spark, d)["raw_sheet"].select(
        "event_id",
        clock.week_label(day).alias("week_label"),
        clock.tab_covers(F.lit("1/7 - 1/13"), day).alias("in_second_week"),
    )


@query
def week_tab_title(spark, d):
    """The tab of one week among the week tabs that the events call for."""
    sunday = clock.week_start(F.col("work_date"))
    weeks = lens(spark, d)["raw_sheet"].groupBy(sunday.alias("sunday")).agg(
        F.min("event_id").alias("tab_no")
    )
    title = F.concat(
        F.date_format("sunday", "M/d"), F.lit(" - "),
        F.date_format(F.date_add("sunday", 6), "M/d"),
    )
    return roster.week_tab(weeks.select(title.alias("title"), "tab_no"), date(2024, 1, 17))


@query
def week_tabs_of_days(spark, d):
    """The tab of every order day: weeks of one year, whose titles cover days of other years too, exact
    labels of another year's weeks, and tabs of whole months last."""
    orders = base(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    sunday, month = clock.week_start(F.col("day")), F.month("day")

    def title(first: Column, last: Column, form: str) -> Column:
        return F.concat(F.date_format(first, form), F.lit(" - "), F.date_format(last, form))

    weeks = orders.filter(F.year("day") == 1996).groupBy(
        title(sunday, F.date_add(sunday, 6), "M/d").alias("title")
    ).agg(F.min("o_orderkey").alias("tab_no"))
    labels = orders.filter(F.year("day") == 1995).groupBy(
        title(sunday, F.date_add(sunday, 6), "MM/dd").alias("title")
    ).agg((F.min("o_orderkey") + 2_000_000_000).alias("tab_no"))
    months = orders.select(month.alias("month")).distinct().select(
        "month",
        F.explode(
            F.array(
                F.concat("month", F.lit("/1 - "), "month", F.lit("/28")),
                F.when(F.col("month") < 12, F.concat("month", F.lit("/28 - "), F.col("month") + 1, F.lit("/1")))
                .otherwise("12/28 - 12/31"),
            )
        ).alias("title"),
    ).select("title", (F.col("month") + 1_000_000_000).cast("bigint").alias("tab_no"))
    return roster.week_tabs(orders, weeks.unionByName(labels).unionByName(months))


def outreach_export(spark, d):
    """The outreach rows as sheet cells, one sheet per ship year."""
    s = Spark()
    key = "CAST(l_orderkey AS STRING) || '-' || CAST(l_suppkey AS STRING)"
    titles = ["row_key ", "pro_name", "hours_to_start", "start_time", "pro_id", "gig_id", "market"]
    cells = [
        f"CASE WHEN l_linenumber = 3 THEN '' ELSE ' ' || {key} END",
        "'Pro ' || CAST(l_suppkey AS STRING)",
        s.pick(lens_tables.WHOLE_TEXTS, "l_partkey"),
        s.pick(lens_tables.DATE_TEXTS, "l_partkey"),
        "CAST(l_suppkey AS STRING)",
        "CAST(l_orderkey AS STRING) || '.0'",
    ]
    items, header = base(spark, d, "lineitem"), f"array({', '.join(repr(t) for t in titles)})"
    sheet = "CAST(year(l_shipdate) AS STRING) AS sheet"
    rows = items.selectExpr(
        sheet, "l_orderkey", "(l_orderkey * 10 + l_linenumber) * 10000000 + l_partkey AS line",
        f"CASE WHEN l_orderkey % 500 = 1 AND l_linenumber = 1 THEN {header} ELSE"
        f" array({', '.join(cells)}) END AS cells",
    )
    # after the first order of each year
    firsts = items.selectExpr(sheet, "l_orderkey").groupBy("sheet").agg(F.min("l_orderkey").alias("l_orderkey"))
    headers = firsts.selectExpr("sheet", "l_orderkey", "(l_orderkey * 10 + 9) * 10000000 AS line", f"{header} AS cells")
    return rows.unionByName(headers).selectExpr(
        "sheet", "named_struct('block', l_orderkey DIV 1000, 'line', line) AS row_no", "cells"
    )


@query
def outreach_sheet_rows(spark, d):
    """Typed outreach export with the latest notes."""
    typed = sheets.outreach_sheet(outreach_export(spark, d))
    return attach_notes(typed, notes_by_key(lens(spark, d)["notes"])).select(
        "row_key", "pro_name", "hours_to_start", "start_time", "pro_id", "gig_id", "market",
        "profile_match_source", "notes", "agent_name",
    )


# Checks and redaction


@query
def gated_shift_links(spark, d):
    report = first_shift_candidates(lens(spark, d), AS_OF).select(
        F.col("location_name").alias("business_name"),
        "location_id",
        "shift_id",
        F.col("gig_start_time_local").alias("shift_date"),
        "skill",
        F.col("original_allowed_confirmed_pros").alias("requested_pros"),
        F.col("current_confirmed_pros_count").alias("confirmed_pros"),
    )
    quality.require_columns(report, SHIFT_LINK_COLUMNS)
    return quality.guarded(report, {"shift links": report})


@query
def redacted_documents(spark, d):
    documents = base(spark, d, "documents")
    return quality.redact(documents, ["source"], ["text"]).select(
        "doc_id", "lang", "n_chars", F.md5("text").alias("text_md5")
    )


@query
def pii_scan(spark, d):
    return quality.pii_scan(base(spark, d, "documents"), "text", "lang")


@query
def duplicate_note_keys(spark, d):
    return quality.duplicate_keys(lens(spark, d)["notes"], "row_key")


def _permanent_keys(spark, d):
    digest = F.md5(F.col("doc_id").cast("string"))
    return base(spark, d, "documents").select(
        "doc_id",
        F.when(F.col("doc_id") % 11 == 0, F.upper(F.concat(F.lit("mb-"), digest)))
        .when(F.col("doc_id") % 13 == 0, F.concat(F.lit("mb-"), F.substring(digest, 1, 23)))
        .when(F.col("doc_id") % 17 != 0, F.concat(F.lit("mb-"), F.substring(digest, 1, 24)))
        .alias("permanent_key"),
    )


@query
def malformed_keys(spark, d):
    return quality.bad_format(_permanent_keys(spark, d), "permanent_key", quality.OPAQUE_KEY)


@query
def quarantined_keys(spark, d):
    """The rows that gates on keys hold back when a table is published, with the gates' names."""
    # documents with one remainder share a key
    keys = _permanent_keys(spark, d).withColumn(
        "permanent_key",
        F.when(F.col("doc_id") % 7 == 0, F.concat(F.lit("mb-shared-"), (F.col("doc_id") % 10).cast("string")))
        .otherwise(F.col("permanent_key")),
    )
    key, folder = F.col("permanent_key"), new_folder(spark, "quarantine")
    gates = {
        "missing key": key.isNull(),
        "malformed key": ~key.rlike(quality.OPAQUE_KEY),
        "repeated key": F.col("copies") > 1,
    }
    table = (quality.with_copies(keys, "permanent_key"), ["doc_id", "permanent_key"])
    manifest = publish_tables({"KEYS": table}, folder, AS_OF, gates={"KEYS": gates}, refuse=False)
    held = read_quarantine(spark, manifest["tables"]["KEYS"])
    cells = F.from_json("row", "array<string>")
    return held.select("gate", cells[0].cast("bigint").alias("doc_id"), cells[1].alias("permanent_key"))


@query
def expected_gigs(spark, d):
    t = lens(spark, d)
    actual = t["applications"].select("gig_id").distinct()
    expected = t["gigs"].select(F.col("id").alias("gig_id"))
    return quality.set_diff(actual, expected, "gig_id")


@query
def reconciled_counts(spark, d):
    orders = base(spark, d, "orders")
    cards = orders.select(
        F.col("o_custkey").alias("panel"),
        F.when(F.col("o_orderkey") % 10 != 0, 1).alias("requests"),
    )
    panels = base(spark, d, "customer").select(
        F.col("c_custkey").alias("panel"), (F.col("c_custkey") % 12).alias("live_open")
    )
    return quality.reconcile(cards, panels, "panel", "requests", "live_open")


@query
def page_checks(spark, d):
    return check_pages(lens(spark, d)["markup"], "html", ["north", "south"], "page_id")


@query
def emptied_pages(spark, d):
    pages = sanitized_pages(lens(spark, d)["markup"], "html", "page_id")
    return pages.withColumn("page_md5", F.md5("page")).drop("page")


EXACT_PHRASES = ["localhost:3000", "/api/removals", "License"]
ANY_CASE_PHRASES = ["catch-up mode", "meeting memory", "the qu"]


@query
def forbidden_phrases(spark, d):
    found = quality.forbidden(
        base(spark, d, "documents"), "text", EXACT_PHRASES, ANY_CASE_PHRASES
    )
    return found.select("doc_id", F.array_join("found", "|").alias("found"))


@query
def attribute_values(spark, d):
    return quality.extract_attr(base(spark, d, "pages"), "html", "href", "page_id")
