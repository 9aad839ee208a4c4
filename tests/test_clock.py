"""Golden cases for clock times, schedules and lateness."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from crewlens.functions import clock
from crewlens.functions.vocabulary import WEEKDAYS
from crewlens.operators import roster

MONDAY = date(2026, 8, 17)
EASTERN = "Monday - Friday 10:00 AM - 07:00 PM EST"
SPLIT = "Monday-Tuesday 12 PM - 09 PM | Wednesday - Friday 10:00 AM - 7:00 PM EST"


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "clock_in, schedule, late",
    [
        ("22:00:00", EASTERN, False),
        ("22:00:00.000001", EASTERN, True),
        ("21:59:59.999999", EASTERN, False),
        ("23:58:01.186000", SPLIT, False),
        ("00:02:00", SPLIT, True),
        ("UTO", EASTERN, False),
        ("22:05:00", "Schedule pending", False),
        ("10:00:00", EASTERN, False),  # half a day either way: the earlier occurrence counts
        ("09:59:59", EASTERN, True),
        ("10:00:01", EASTERN, False),
    ],
)
def test_lateness(spark, clock_in, schedule, late):
    rows = spark.createDataFrame(
        [(clock_in, schedule, MONDAY)], "clock_in string, schedule string, work_date date"
    )
    assert roster.with_lateness(rows, "Asia/Manila").first()["late"] is late


MIXED = "Mon,Thur, Fri: 08:00 AM - 05:00 PM EST | Tue - Wed: 07:00 AM - 04:00 PM EST"


@pytest.mark.parametrize(
    "schedule, day, start",
    [
        (MIXED, MONDAY, datetime(2026, 8, 17, 20, 0)),
        (MIXED, date(2026, 8, 18), datetime(2026, 8, 18, 19, 0)),
        ("Thursday - Monday 07:00 AM - 04:00 PM EST", MONDAY, datetime(2026, 8, 17, 19, 0)),
        ("Monday - Friday 10:00 PM - 7:00 AM MNL", MONDAY, datetime(2026, 8, 17, 22, 0)),
        ("Monday 9 AM - 5 PM", MONDAY, datetime(2026, 8, 17, 9, 0)),
        ("Monday 9 AM - 5 PM | Tuesday 9 AM - 5 PM ET", MONDAY, datetime(2026, 8, 17, 21, 0)),
        ("Monday 13 PM - 5 PM | Monday 9 AM - 5 PM", MONDAY, None),
        ("Tuesday 9 AM - 5 PM", MONDAY, None),
        ("Monday 10:00 AM - 7 PM EST", date(2026, 1, 5), datetime(2026, 1, 5, 23, 0)),
    ],
)
def test_scheduled_start(spark, schedule, day, start):
    got = one(
        spark,
        clock.scheduled_start(
            F.lit(schedule), F.lit(day.weekday()), F.lit(day), F.lit("Asia/Manila")
        ),
    )
    assert got == start


def micros(hour, minute=0, second=0, micro=0):
    return ((hour * 60 + minute) * 60 + second) * 1_000_000 + micro


@pytest.mark.parametrize(
    "text, expected",
    [
        ("21:55:01.231000", micros(21, 55, 1, 231000)),
        ("9:05 PM", micros(21, 5)),
        ("Leave", None),
        ("12:00 am", micros(0)),
        ("12:30PM", micros(12, 30)),
        ("0:30 AM", None),
        ("24:00", None),
        ("23:60", None),
        ("7:05:09.5", micros(7, 5, 9, 500000)),
        ("7:05:09.1234567", None),
        (None, None),
        ("", None),
    ],
)
def test_clock_micros(spark, text, expected):
    assert one(spark, clock.clock_micros(F.lit(text).cast("string"))) == expected


@pytest.mark.parametrize(
    "text, days",
    [
        ("Fri - Mon", [0, 4, 5, 6]),
        ("Mon - Fri, Sun", [0, 4, 6]),
        ("Mon-Mon", [0]),
        ("", []),
        ("Monday, Thurs", [0, 3]),
        ("Mondayish", []),
        ("sat-sun", [5, 6]),
        ("Mon to Wed", [0, 2]),
    ],
)
def test_segment_days(spark, text, days):
    assert one(spark, clock.segment_days(F.lit(text))) == days


@pytest.mark.parametrize(
    "code, hours",
    [
        ("12-9", (12, 21)), ("7-12", (7, 12)), ("1-10", (13, 22)), ("6-3", (18, 15)),
        ("OFF", None), ("", None), ("x", None), (" 9-6 ", (9, 18)), ("9-6-3", None), (None, None),
    ],
)
def test_shift_hours(spark, code, hours):
    got = one(spark, clock.shift_hours(F.lit(code).cast("string")))
    assert (tuple(got) if got else None) == hours


@pytest.mark.parametrize("hour, label", [(21, "9:00 PM"), (12, "12:00 PM"), (0, "12:00 AM")])
def test_hour_label(spark, hour, label):
    assert one(spark, clock.hour_label(F.lit(hour))) == label


def test_week_label_and_tab(spark):
    assert one(spark, clock.week_label(F.lit(MONDAY))) == "08/16 - 08/22"
    tabs = spark.createDataFrame(
        [("8/9 - 8/15", 1), ("8/16 - 8/22", 2), ("8/1 - 8/31", 3), ("Template", 4),
         ("13/1 - 14/2", 5)],
        "title string, tab_no int",
    )
    assert [r["title"] for r in roster.week_tab(tabs, MONDAY).collect()] == ["8/16 - 8/22"]
    exact = tabs.unionByName(
        spark.createDataFrame([("08/16 - 08/22", 9)], "title string, tab_no int")
    )
    assert [r["title"] for r in roster.week_tab(exact, MONDAY).collect()] == ["08/16 - 08/22"]
    with pytest.raises(Exception, match="no week tab for 2026-12-24"):
        roster.week_tab(tabs, date(2026, 12, 24)).collect()


def sheet(spark, rows, name="s"):
    return spark.createDataFrame(
        [(name, (0, i), cells) for i, cells in enumerate(rows)],
        "sheet string, row_no struct<block:bigint,line:bigint>, cells array<string>",
    )


def roster_sheet(spark):
    return sheet(
        spark,
        [
            ["Ann", "1-2"] + [""] * 6,
            ["Name", *WEEKDAYS],
            ["TEAM"] + [""] * 7,
            [" Ann ", "12-9", "OFF", "", "", "", "", ""],
            ["Bob", "OFF", "7-12"],
            ["", "1-2", "", "", "", "", "", ""],
            ["Ann", "9-6"],
        ],
    )


def test_roster_long(spark):
    got = {
        (r["name"], r["weekday"]): r["code"]
        for r in roster.roster_long(roster_sheet(spark)).collect()
    }
    assert {k[0] for k in got} == {"Ann", "Bob"}
    assert len(got) == 14
    assert got[("Ann", 0)] == "9-6" and got[("Ann", 1)] == ""
    assert got[("Bob", 1)] == "7-12"


def test_agents_online(spark):
    from crewlens.plans.agents import agents_online

    clockins = sheet(
        spark,
        [
            ["", "Team", "", "8/17/26", "", "8/18/26", ""],
            ["", "Ann Full", EASTERN, "22:00:01", "", "", ""],
            ["", "Bob Full", EASTERN, "22:00:01", "", "", ""],
            ["", "Ann Full", EASTERN, "21:00:00", "06:00"],
        ],
    )
    aliases = spark.createDataFrame(
        [("Ann", "Ann Full"), ("Bob", "Bob Full")], "name string, full_name string"
    )
    got = agents_online(roster_sheet(spark), clockins, aliases, "Asia/Manila", MONDAY).collect()
    assert [(r["name"], r["until"], r["late"]) for r in got] == [("Ann", "6:00 PM", True)]


def test_missing_day_column_fails(spark):
    """When the result is read: building it runs no job."""
    found = roster.open_clockins(sheet(spark, [["", "A", "", "8/17/26", ""]]), date(2026, 8, 20))
    with pytest.raises(Exception, match="refusing to publish: date column 2026-08-20 is empty"):
        found.collect()


def test_week_tabs_of_many_days(spark):
    """Exact labels first, then the first range; leap days, ranges over the year's end, and a day without a tab."""
    from datetime import date

    from crewlens.operators.roster import week_tabs

    tabs = spark.createDataFrame(
        [("2/1 - 3/31", 5), ("2/26 - 3/3", 3), ("03/03 - 03/09", 9), ("12/29 - 1/4", 1), ("12/29 - 01/04", 2), ("2/29 - 3/6", 0), ("x", 4)],
        "title string, tab_no int",
    )

    def found(*days):
        rows = spark.createDataFrame([(d,) for d in (*days, *days, None)], "day date")
        return {r.day: r.title for r in week_tabs(rows, tabs).collect()}

    assert found(date(2023, 3, 1), date(2024, 2, 29), date(2024, 3, 1), date(2024, 3, 5), date(2025, 1, 1), date(2024, 12, 30)) == {
        date(2023, 3, 1): "2/26 - 3/3", date(2024, 2, 29): "2/29 - 3/6", date(2024, 3, 1): "2/29 - 3/6",
        date(2024, 3, 5): "03/03 - 03/09", date(2025, 1, 1): "12/29 - 01/04", date(2024, 12, 30): "12/29 - 01/04",
    }
    with pytest.raises(Exception, match="no week tab for 2024-05-01"):
        found(date(2024, 5, 1))
