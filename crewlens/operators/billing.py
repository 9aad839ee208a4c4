"""Billing status of locations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import payment_scope
from ..functions.skills import yes_no


def billing_status(
    upcoming: DataFrame, locations: DataFrame, location_billing: DataFrame, organizations: DataFrame
) -> DataFrame:
    """Whether the billing source selected for each upcoming location has a billing account."""
    accounts = location_billing.select(
        F.col("id").alias("location_id"),
        "billing_source",
        "organization_id",
        F.col("billing_customer_id").alias("location_customer"),
    )
    organizations = organizations.select(
        F.col("id").alias("organization_id"),
        F.col("billing_customer_id").alias("organization_customer"),
    )
    scope = payment_scope(
        F.col("billing_source"), F.col("location_customer"), F.col("organization_customer")
    )
    return (
        upcoming.join(locations, "location_id")
        .join(accounts, "location_id")
        .join(organizations, "organization_id", "left")
        .select(
            "location_id",
            "location_name",
            "approval_status",
            yes_no(scope.endswith("account")).alias("has_payment_information"),
            scope.alias("payment_information_scope"),
        )
    )


def needs_billing(status: DataFrame) -> DataFrame:
    return status.filter(F.col("has_payment_information") == "No")
