"""Weekly rosters, clock-in sheets and who is on shift.

Sheets arrive as rows (sheet, row_no, cells): cells are strings, row_no orders a sheet's rows
(a block and a line within it, see sources.sheets).
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clock import (
    hour_label,
    is_late,
    schedule_segments,
    scheduled_start,
    shift_hours,
    tab_covers,
    tab_days,
    week_label,
)
from ..functions.text import strip
from ..functions.vocabulary import WEEKDAYS
from ..sources.sheets import summary_per_sheet
from .quality import guarded, require_per_sheet
from .ranking import latest_by
from .skew import hot_from_counts, spread_join

# Fixed value: how the date columns of a clock-in sheet are titled.
DATE_CELL = r"^\s*\d{1,2}/\d{1,2}/\d{2}\s*$"


def cell(position: int) -> Column:
    """A cell by position, blank when the row is short."""
    return strip(F.coalesce(F.get("cells", F.lit(position)), F.lit("")))


def roster_long(rows: DataFrame, skip_headerless: bool = False) -> DataFrame:
    """(sheet, name, weekday, code) for every named agent below the 'Name' header row.

    Section titles (no code on any day) are not agents; a repeated name keeps its last row. A sheet
    without the header row fails the job, unless `skip_headerless` says that it is no roster.
    """
    is_header = cell(0) == "Name"
    sheets = summary_per_sheet(rows, F.min(F.when(is_header, F.col("row_no"))).alias("header_no"))
    hot = hot_from_counts(sheets, "sheet", "_rows")
    header = (
        sheets.filter(F.col("header_no").isNotNull())
        if skip_headerless
        else require_per_sheet(sheets, "header_no", "the row 'Name'")
    ).drop("_rows")
    codes = F.array(*[cell(1 + i) for i in range(len(WEEKDAYS))])
    agents = (
        rows.filter(~is_header & (cell(0) != ""))
        .select("sheet", "row_no", cell(0).alias("name"), codes.alias("codes"))
        .filter(F.exists("codes", lambda c: c != ""))
    )
    # A name whose last row precedes the header has no row below it, so the rows can be reduced
    # to the last per name before they meet the header.
    latest = latest_by(agents, ["sheet", "name"], [F.col("row_no").desc_nulls_last()])
    below = spread_join(latest, header, ["sheet"], hot, "sheet", ["name"]).filter(F.col("row_no") > F.col("header_no"))
    return below.select("sheet", "name", F.posexplode("codes").alias("weekday", "code"))


def with_shift_hours(roster: DataFrame) -> DataFrame:
    """Decoded hours of each roster code; days off keep NULL hours."""
    hours = shift_hours(F.col("code"))
    return roster.withColumns(
        {
            "start_hour": hours["start_hour"],
            "end_hour": hours["end_hour"],
            "until": hour_label(hours["end_hour"]),
        }
    )


def segment_rows(df: DataFrame, schedule: str, *keep: str) -> DataFrame:
    """One row per schedule segment that holds a time range."""
    parts = F.posexplode(schedule_segments(F.col(schedule))).alias("segment_no", "segment")
    return df.select(*keep, parts).select(
        *keep,
        "segment_no",
        F.col("segment.days").alias("days"),
        F.col("segment.start_minute").alias("start_minute"),
        F.col("segment.zone").alias("zone"),
    )


def open_sessions(rows: DataFrame, skip_headerless: bool = False) -> DataFrame:
    """Clock-ins without a clock-out, for every date column of every sheet.

    The dates stand in the first row with a date-like cell; a date's column holds the clock-in and
    the next one the clock-out. Column 1 is the name, column 2 the schedule. Among a name's open
    rows the last one wins. Text that is not a real date is dropped. A sheet without a date row
    fails the job, unless `skip_headerless` says that it is no clock-in sheet.
    """
    dated_no = F.when(F.exists("cells", lambda c: c.rlike(DATE_CELL)), F.col("row_no"))
    sheets = summary_per_sheet(
        rows, F.min(dated_no).alias("dated_no"), F.min_by("cells", dated_no).alias("header")
    )
    hot = hot_from_counts(sheets, "sheet", "_rows")
    first = (
        sheets.filter(F.col("dated_no").isNotNull())
        if skip_headerless
        else require_per_sheet(sheets, "header", "the row of dates")
    )
    columns = first.select("sheet", F.posexplode("header").alias("position", "title")).select(
        "sheet",
        "position",
        strip(F.col("title")).alias("title"),
        F.try_to_date(strip(F.col("title")), "M/d/yy").alias("work_date"),
    )
    columns = (
        columns.filter(F.date_format("work_date", "M/d/yy") == F.col("title"))
        .groupBy("sheet", "work_date")
        .agg(F.min("position").alias("position"))
        .groupBy("sheet")
        .agg(F.collect_list(F.struct("work_date", "position")).alias("date_columns"))
    )
    at = F.col("date_column.position")

    def at_position(position: Column) -> Column:
        return strip(F.coalesce(F.get("cells", position), F.lit("")))

    sessions = (
        spread_join(
            rows.filter(cell(1) != ""), columns, ["sheet"], hot, "sheet", ["row_no"],
        )
        .select(
            "sheet", "row_no", cell(1).alias("full_name"), cell(2).alias("schedule"), "cells",
            F.explode("date_columns").alias("date_column"),
        )
        .select(
            "sheet", "row_no", "full_name", "schedule",
            F.col("date_column.work_date").alias("work_date"),
            at_position(at).alias("clock_in"),
            at_position(at + 1).alias("clock_out"),
        )
        .filter((F.col("clock_in") != "") & (F.col("clock_out") == ""))
    )
    return latest_by(
        sessions, ["sheet", "work_date", "full_name"], [F.col("row_no").desc_nulls_last()]
    ).drop("row_no", "clock_out")


def has_date_column(rows: DataFrame, day: date) -> Column:
    """For a sheet row: whether one of its cells is the day's column title."""
    title = f"{day.month}/{day.day}/{day.year % 100}"
    return F.exists("cells", lambda c: strip(c) == title)


def open_clockins(rows: DataFrame, day: date, skip_headerless: bool = False) -> DataFrame:
    """Open sessions of one day; the job fails when no sheet has a column for the day."""
    sessions = open_sessions(rows, skip_headerless).filter(F.col("work_date") == F.lit(day))
    return guarded(sessions, {f"date column {day.isoformat()}": rows.filter(has_date_column(rows, day))})


def week_tab(tabs: DataFrame, day: date) -> DataFrame:
    """The title of the week tab for a day: the exact label, else the first range covering it.

    Always one row; if no tab fits, the job fails, naming the day.
    """
    wanted = F.lit(day)
    exact = F.col("title") == week_label(wanted)
    fits = exact | tab_covers(F.col("title"), wanted)
    best = F.min_by("title", F.when(fits, F.struct((~exact).alias("later"), "tab_no")))
    message = F.lit(f"no week tab for {day.isoformat()}")
    return tabs.agg(best.alias("title")).select(
        F.coalesce("title", F.raise_error(message).cast("string")).alias("title")
    )


def week_tabs(days: DataFrame, tabs: DataFrame) -> DataFrame:
    """(day, title) of every distinct day of `days` (day): the tab with the exact label of its week, else
    the first by `tab_no` whose range covers it in the day's own year.

    A join on ranges by buckets: each tab is exploded to the month-and-days of its range, at most 366, and
    days meet them by equality; the exact labels are a second join by equality. A day without a tab fails
    the job by name.
    """
    wanted = days.select("day").filter(F.col("day").isNotNull()).distinct()
    exact = wanted.withColumn("title", week_label(F.col("day"))).join(tabs.select("title", "tab_no"), "title")
    spans = tabs.select("title", "tab_no", F.explode(tab_days(F.col("title"))).alias("month_day"))
    covering = wanted.withColumn("month_day", F.date_format("day", "MM-dd")).join(spans, "month_day")
    fits = (
        exact.select("day", "title", F.lit(0).alias("later"), "tab_no")
        .unionByName(covering.filter(tab_covers(F.col("title"), F.col("day"))).select("day", "title", F.lit(1).alias("later"), "tab_no"))
        .groupBy("day").agg(F.min_by("title", F.struct("later", "tab_no")).alias("title"))
    )
    missing = F.raise_error(F.concat(F.lit("no week tab for "), F.col("day").cast("string"))).cast("string")
    return wanted.join(fits, "day", "left").select("day", F.coalesce("title", missing).alias("title"))


def with_lateness(sessions: DataFrame, sheet_zone: str) -> DataFrame:
    """Scheduled start in the sheet's zone and whether the clock-in came after it."""
    start = scheduled_start(
        F.col("schedule"), F.weekday("work_date"), F.col("work_date"), F.lit(sheet_zone)
    )
    return sessions.withColumn("scheduled_start", start).withColumn(
        "late", is_late(F.col("clock_in"), F.col("scheduled_start"))
    )


def online(
    roster: DataFrame, aliases: DataFrame, sessions: DataFrame, sheet_zone: str
) -> DataFrame:
    """Agents scheduled on a date, known to the alias table and clocked in without a clock-out.

    `roster` has (name, weekday, code), `aliases` (name, full_name), `sessions` the open sessions
    of any number of dates.
    """
    scheduled = with_shift_hours(roster).filter(F.col("end_hour").isNotNull()).select(
        "name", "weekday", "until"
    )
    on_shift = sessions.withColumn("weekday", F.weekday("work_date")).join(aliases, "full_name")
    return with_lateness(
        on_shift.join(scheduled, ["name", "weekday"]), sheet_zone
    ).select("work_date", "name", "until", "late")
