"""Typed tables from the cleaned spreadsheet exports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..sources.sheets import positional_columns, sheet_columns
from .billing import PAYMENT_COLUMNS
from .outreach import PUBLISHED_COLUMNS as OUTREACH_COLUMNS
from .qualification import (
    NUMBERS,
    PERCENTAGES,
    PUBLISHED_NAMES,
    SHIFT_LINK_COLUMNS,
    TIMES,
    WHOLE_NUMBERS,
)

# Columns and section headers of the spreadsheet exports.
VIP_SHIFT_COLUMNS = [
    "shift_id", "start_datetime", "market", "location_name", "shift_type",
    "auto_select_enabled", "allowed_confirmed_pros", "current_confirmed_pros_count",
    "number_of_selected_pros", "shift_url",
]
SECTION_HEADERS = {
    "SEC1": [
        "Business Name", "Date", "Skill", "Requested", "Confirmed", "Unfilled", "Status",
        "Auto Select", "Gig Type", "Account Manager", "Ops Manager",
    ],
    "SEC2": [
        "Business Name", "Date", "Skill", "Requested Pros", "Confirmed Pros", "Unfilled Pros",
        "Account Manager", "Ops Manager",
    ],
    "SEC3": [
        "Date", "Business Name", "Unfilled", "Filled", "Unapproved", "Auto Select",
        "Private Offer",
    ],
}
ALL_FORMATS = ("us12", "us24", "serial")


def coerce_columns(
    df: DataFrame,
    ints: Sequence[str] = (),
    floats: Sequence[str] = (),
    pcts: Sequence[str] = (),
    dates: Sequence[str] = (),
    texts: Sequence[str] = (),
    formats: Sequence[str] = ("us12", "iso"),
) -> DataFrame:
    """Type the named text columns; blank and unreadable numbers become NULL."""
    typed: dict[str, Column] = {c: text.to_long(F.col(c)) for c in ints}
    typed |= {c: text.to_double(F.col(c)) for c in floats}
    typed |= {c: text.to_percent(F.col(c)) for c in pcts}
    typed |= {c: text.normalize_datetime(F.col(c), formats) for c in dates}
    typed |= {c: text.clean(F.col(c)) for c in texts}
    return df.withColumns(typed)


def project_as(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Source column -> output name, in the order of the mapping; absent sources give NULL."""
    return df.select(
        *[
            (F.col(source) if source in df.columns else F.lit(None).cast("string")).alias(name)
            for source, name in names.items()
        ]
    )


def qualification_sheet(rows: DataFrame) -> DataFrame:
    """The per-pro export under its published names."""
    picked = sheet_columns(rows, "business_name", list(PUBLISHED_NAMES))
    rest = [
        c for c in PUBLISHED_NAMES if c not in WHOLE_NUMBERS + PERCENTAGES + NUMBERS + TIMES
    ]
    typed = coerce_columns(picked, WHOLE_NUMBERS, NUMBERS, PERCENTAGES, TIMES, rest)
    return project_as(typed, PUBLISHED_NAMES)


def shift_link_sheet(rows: DataFrame) -> DataFrame:
    picked = sheet_columns(rows, "business_name", SHIFT_LINK_COLUMNS)
    ints = [c for c in SHIFT_LINK_COLUMNS if c in WHOLE_NUMBERS]
    return coerce_columns(
        picked, ints, dates=["shift_date"], texts=["business_name", "skill"]
    ).drop("sheet", "row_no")


def payment_sheet(rows: DataFrame, skip_headerless: bool = False) -> DataFrame:
    picked = sheet_columns(
        rows, "location_id", PAYMENT_COLUMNS, PAYMENT_COLUMNS, skip_headerless=skip_headerless
    )
    return coerce_columns(picked, ["location_id"], texts=PAYMENT_COLUMNS[1:]).drop(
        "sheet", "row_no"
    )


def housekeeping_sheet(rows: DataFrame) -> DataFrame:
    """The housekeeping export: header in its first row, dates kept as given, no % signs."""
    names = [n for n in PUBLISHED_NAMES.values() if not n.startswith("position_")]
    ints = [PUBLISHED_NAMES[c] for c in WHOLE_NUMBERS]
    floats = [PUBLISHED_NAMES[c] for c in NUMBERS + PERCENTAGES]
    picked = sheet_columns(rows, None, names)
    return coerce_columns(
        picked,
        [c for c in names if c in ints],
        [c for c in names if c in floats],
        texts=[c for c in names if c not in ints + floats],
    ).drop("sheet", "row_no")


def vip_shift_sheet(rows: DataFrame, skip_headerless: bool = False) -> DataFrame:
    picked = positional_columns(rows, "id", VIP_SHIFT_COLUMNS, skip_headerless=skip_headerless)
    typed = coerce_columns(
        picked,
        ints=[
            "shift_id", "allowed_confirmed_pros", "current_confirmed_pros_count",
            "number_of_selected_pros",
        ],
        dates=["start_datetime"],
        texts=["market", "location_name", "shift_type", "shift_url"],
        formats=ALL_FORMATS,
    )
    return typed.withColumn(
        "auto_select_enabled", text.to_onoff(F.col("auto_select_enabled"))
    ).drop("sheet", "row_no")


def outreach_sheet(rows: DataFrame, skip_headerless: bool = False) -> DataFrame:
    """The outreach export, without the two note columns that are joined later."""
    names = OUTREACH_COLUMNS[:-2]
    ints = [
        "pro_id", "gig_id", "prior_paid_same_skill_shifts", "position_ratings_count",
        "overall_ratings_count",
    ]
    floats = ["hours_to_start", "position_avg_rating", "overall_avg_rating"]
    picked = sheet_columns(
        rows, "row_key", names, form=text.strip, skip_headerless=skip_headerless
    )
    return coerce_columns(
        picked, ints, floats, dates=["start_time"],
        texts=[c for c in names if c not in ints + floats + ["start_time"]],
        formats=ALL_FORMATS,
    ).drop("sheet", "row_no")
