"""Billing report of locations with upcoming shifts."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.billing import billing_status
from ..operators.candidates import upcoming_locations
from ..operators.ranking import ordered

# The report's columns.
PAYMENT_COLUMNS = [
    "location_id", "location_name", "approval_status", "has_payment_information",
    "payment_information_scope",
]


def billing_report(
    tables: Mapping[str, DataFrame], today: date, limit: int | None = None
) -> DataFrame:
    """Every location with an upcoming shift, by location. A caller's `limit` cuts the finished
    report; take `needs_billing` of the whole report, not of a cut one."""
    status = billing_status(
        upcoming_locations(tables["applications"], today),
        tables["locations"],
        tables["location_billing"],
        tables["organizations"],
    )
    return ordered(status, [F.col("location_id").asc_nulls_last()], limit)
