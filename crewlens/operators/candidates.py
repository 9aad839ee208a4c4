"""Which applications, locations and paid history take part in a report."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.skills import skill_key
from .ranking import latest_by


def moment(value: datetime) -> Column:
    """A zone-less timestamp literal."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def _uncanceled() -> Column:
    # Spelled out so that the scan can use it: a coalesce would not reach the files.
    return F.col("is_canceled").isNull() | (F.col("is_canceled") == 0)


def _standing(apps: DataFrame) -> DataFrame:
    return apps.filter(F.col("is_confirmed") & _uncanceled() & F.col("gigster_id").isNotNull())


def _one_per_pro_and_gig(apps: DataFrame, newest: str) -> DataFrame:
    return latest_by(
        apps,
        ["gig_id", "gigster_id"],
        [F.col(newest).desc_nulls_last(), F.col("app_id").desc_nulls_first()],
    )


def upcoming_standing(apps: DataFrame, as_of: datetime) -> DataFrame:
    return _standing(apps).filter(F.col("start_time") >= moment(as_of))


def confirmed_applications(
    apps: DataFrame, shifts: DataFrame | None, as_of: datetime
) -> DataFrame:
    """Standing confirmed applications from `as_of` on, one per (gig, pro), with skill keys.

    With `shifts`, only gigs listed there. The list only selects, so it is a semi-join: two names
    for one gig cannot multiply its applications. It follows the deduplication, which then shuffles
    on (gig, pro) rather than inheriting a shuffle on the gig alone.
    """
    rows = _one_per_pro_and_gig(upcoming_standing(apps, as_of), "confirmation_timestamp")
    if shifts is not None:
        rows = rows.join(shifts.select(F.col("shift_id").alias("gig_id")), "gig_id", "left_semi")
    return (
        rows.withColumn("skill_key", skill_key(F.col("skill")))
        .withColumnsRenamed({"gig_id": "shift_id", "gigster_id": "pro_id"})
    )


def starting_within(apps: DataFrame, as_of: datetime, days: int) -> DataFrame:
    until = moment(as_of) + F.make_dt_interval(F.lit(days))
    local = F.col("gig_start_time_local")
    return _standing(apps).filter((local >= moment(as_of)) & (local < until))


def elevated_shifts(
    apps: DataFrame, locations: DataFrame, as_of: datetime, days: int = 3
) -> DataFrame:
    """Standing confirmed applications at VIP locations starting within the next days."""
    vip = locations.filter(F.col("currently_elevated_status") == "VIP").select("location_id")
    rows = starting_within(apps, as_of, days).join(vip, "location_id", "left_semi")
    return _one_per_pro_and_gig(rows, "confirmation_timestamp").withColumn(
        "skill_key", skill_key(F.col("skill"))
    )


def upcoming_locations(
    apps: DataFrame, today: date, back: int = 1, ahead: int = 31
) -> DataFrame:
    """Distinct locations with a shift from `back` days ago up to `ahead` days from now."""
    midnight = moment(datetime(today.year, today.month, today.day))
    local = F.col("gig_start_time_local")
    return (
        apps.filter(
            (local >= midnight - F.make_dt_interval(F.lit(back)))
            & (local < midnight + F.make_dt_interval(F.lit(ahead)))
            & F.col("location_id").isNotNull()
        )
        .select("location_id")
        .distinct()
    )


def historical_paid(apps: DataFrame, before: datetime | None = None) -> DataFrame:
    """Paid, uncancelled work, the latest rated row per (pro, gig), with skill keys."""
    rows = apps.filter((F.col("is_paid") == 1) & _uncanceled())
    if before is not None:
        rows = rows.filter(F.col("gig_start_time_local") < moment(before))
    return _one_per_pro_and_gig(rows, "rating_timestamp").select(
        "gigster_id",
        "gig_id",
        "location_id",
        "start_time",
        "rating",
        skill_key(F.col("skill")).alias("skill_key"),
    )


def restrict_to_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in `keys`: an early filter for a later join on the same key."""
    return df.join(keys.select(key).filter(F.col(key).isNotNull()), key, "left_semi")
