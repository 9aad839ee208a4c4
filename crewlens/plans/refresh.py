"""Refresh jobs: parse a dashboard's exports, gate them and publish one snapshot.

Every job writes its tables once under a new folder, checks count and personal data on what was
written, and adds its manifest last; a failing gate leaves the snapshot before it readable.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.quality import emptied
from ..operators.ranking import notes_by_key
from ..sources.publish import publish_tables
from ..sources.sheets import sheet_columns, snake_case, split_sections
from .agents import agents_online
from .billing import PAYMENT_COLUMNS
from .outreach import attach_notes
from .qualification import PUBLISHED_NAMES, SHIFT_LINK_COLUMNS
from .sheets import (
    OUTREACH_COLUMNS,
    SECTION_HEADERS,
    VIP_SHIFT_COLUMNS,
    housekeeping_sheet,
    outreach_sheet,
    payment_sheet,
    qualification_sheet,
    shift_link_sheet,
    vip_shift_sheet,
)

# Names of the published tables.
PERSON_TABLES = ["REVIEW_ROWS", "OUTREACH_ROWS"]


def notes_sheet(rows: DataFrame) -> DataFrame:
    """The last note and agent of each key of a notes export."""
    names = ["row_key", "notes", "agent_name"]
    return notes_by_key(sheet_columns(rows, "row_key", names, form=snake_case))


def refresh_dashboard(
    section_rows: DataFrame,
    shift_links: DataFrame,
    payments: DataFrame,
    pros: DataFrame,
    path: str,
    as_of: datetime,
    headers: Mapping[str, Sequence[str]] = SECTION_HEADERS,
) -> dict:
    """Sections, shift links and payments, none of which may be empty; person rows stay unpublished,
    only their columns are."""
    sections = split_sections(section_rows, headers)
    tables = {
        name: (
            sections.filter(F.col("section") == name).select(
                *[F.coalesce(F.get("cells", F.lit(i)), F.lit("")).alias(t) for i, t in enumerate(titles)]
            ),
            list(titles),
        )
        for name, titles in headers.items()
    }
    tables["SHIFT_LINK_ROWS"] = (shift_link_sheet(shift_links), SHIFT_LINK_COLUMNS)
    tables["PAYMENT_ROWS"] = (payment_sheet(payments), PAYMENT_COLUMNS)
    people = emptied(qualification_sheet(pros))
    for name in PERSON_TABLES:
        tables[name] = (people, list(PUBLISHED_NAMES.values()))
    return publish_tables(tables, path, as_of, may_be_empty=PERSON_TABLES)


def refresh_outreach(
    shifts: DataFrame, outreach: DataFrame, notes: DataFrame, path: str, as_of: datetime
) -> dict:
    """Elevated shifts, which may not be empty, and the outreach queue with its notes, which may:
    an empty queue means that nobody has a gap now."""
    queue = attach_notes(outreach_sheet(outreach), notes_sheet(notes))
    tables = {
        "SHIFT_ROWS": (vip_shift_sheet(shifts), VIP_SHIFT_COLUMNS),
        "OUTREACH_ROWS": (queue, OUTREACH_COLUMNS),
    }
    return publish_tables(tables, path, as_of, may_be_empty=["OUTREACH_ROWS"])


def refresh_housekeeping(rows: DataFrame, path: str, as_of: datetime) -> dict:
    typed = housekeeping_sheet(rows)
    return publish_tables({"ROWS": (typed, typed.columns)}, path, as_of)


def refresh_agents(
    roster: DataFrame,
    clockins: DataFrame,
    aliases: DataFrame,
    sheet_zone: str,
    day: date,
    path: str,
    as_of: datetime,
) -> dict:
    """Who is on shift on one day; nobody may be, but roster and date column must exist."""
    found = agents_online(roster, clockins, aliases, sheet_zone, day).select("name", "until", "late")
    return publish_tables({"AGENT_STATUS": (found, found.columns)}, path, as_of, may_be_empty=["AGENT_STATUS"])
