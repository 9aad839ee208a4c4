"""Agents on shift, from the roster sheet, the clock-in sheets and the alias table."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.quality import guarded
from ..operators.ranking import ordered
from ..operators.roster import has_date_column, online, open_sessions, roster_long


def agents_online(
    roster_rows: DataFrame,
    clockin_rows: DataFrame,
    aliases: DataFrame,
    sheet_zone: str,
    day: date | None = None,
    skip_headerless: bool = False,
) -> DataFrame:
    """Who is on shift on one day, or with `day` left out on every date the sheets hold.

    An empty roster, or a day without a column, fails the job that reads the result.
    `skip_headerless` says that files without a header row or a row of dates are no sheets.
    """
    roster = roster_long(roster_rows, skip_headerless)
    sessions = open_sessions(clockin_rows, skip_headerless)
    if day is not None:
        sessions = sessions.filter(F.col("work_date") == F.lit(day))
    found = online(roster, aliases, sessions, sheet_zone)
    if day is not None:
        dated = clockin_rows.filter(has_date_column(clockin_rows, day))
        found = guarded(found, {"roster": roster, f"date column {day.isoformat()}": dated})
    return ordered(found, [F.col("work_date"), F.col("name")])
