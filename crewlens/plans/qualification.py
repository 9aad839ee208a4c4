"""First-shifts qualification report: confirmed pros of each business's first five shifts."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import labels
from ..functions.skills import (
    any_true,
    badge_evidence,
    badge_status,
    profile_evidence,
    qualifying_pairs,
    yes_no,
)
from ..operators.candidates import confirmed_applications, historical_paid, restrict_to_keys
from ..operators.experience import experience_and_ratings
from ..operators.profiles import pro_profiles
from ..operators.ranking import first_shifts, ordered, shift_level
from ..operators.skew import hot_from_counts, hot_keys, spread_join
from ..sources.staging import staged

# Report columns and the names they are published under.
PUBLISHED_NAMES = {
    "business_name": "business_name",
    "location_id": "location_id",
    "shift_id": "shift_id",
    "shift_date": "shift_date",
    "market": "market",
    "skill": "skill",
    "requested_pros": "requested_pros",
    "confirmed_pros": "confirmed_pros",
    "auto_select_status": "auto_select_status",
    "shift_type": "shift_type",
    "pro_id": "pro_id",
    "pro_name": "pro_name",
    "confirmed_skill_profile_badge_status": "housekeeping_certified",
    "prior_paid_same_skill_shifts": "prior_paid_housekeeping_shifts",
    "has_worked_same_skill_before": "has_worked_housekeeping_before",
    "prior_paid_same_skill_shifts_same_business": "prior_paid_housekeeping_shifts_same_business",
    "repeat_same_skill_at_same_business": "repeat_housekeeping_at_same_business",
    "has_relevant_same_skill_experience": "has_relevant_housekeeping_experience",
    "avg_rating": "avg_rating",
    "ratings_count": "ratings_count",
    "completion_rate_lifetime_pct": "completion_rate_lifetime_pct",
    "completion_rate_last_30_days_pct": "completion_rate_last_30_days_pct",
    "completed_shifts_lifetime": "completed_shifts_lifetime",
    "pro_cancellations_last_30_days": "pro_cancellations_last_30_days",
    "pro_cancel_rate_last_30_days_pct": "pro_cancel_rate_last_30_days_pct",
    "no_shows_last_30_days": "no_shows_last_30_days",
    "distance_from_pro_last_seen_to_business_miles":
        "distance_from_pro_last_seen_to_business_miles",
    "pro_last_seen_at": "pro_last_seen_at",
    "confirmation_timestamp": "confirmation_timestamp",
    "selection_source": "selection_source",
    "pro_phone_number": "pro_phone_number",
    "position_avg_rating": "position_avg_rating",
    "position_ratings_count": "position_ratings_count",
}
# Types of the report's columns in its spreadsheet export.
WHOLE_NUMBERS = [
    "location_id", "shift_id", "requested_pros", "confirmed_pros", "pro_id",
    "prior_paid_same_skill_shifts", "prior_paid_same_skill_shifts_same_business",
    "ratings_count", "completed_shifts_lifetime", "pro_cancellations_last_30_days",
    "no_shows_last_30_days", "position_ratings_count",
]
PERCENTAGES = [
    "completion_rate_lifetime_pct", "completion_rate_last_30_days_pct",
    "pro_cancel_rate_last_30_days_pct",
]
NUMBERS = ["avg_rating", "position_avg_rating", "distance_from_pro_last_seen_to_business_miles"]
TIMES = ["shift_date", "pro_last_seen_at", "confirmation_timestamp"]
SHIFT_LINK_COLUMNS = [
    "business_name", "location_id", "shift_id", "shift_date", "skill", "requested_pros",
    "confirmed_pros",
]


def with_evidence(
    candidates: DataFrame, profiles: DataFrame, hot_pros: DataFrame | None = None
) -> DataFrame:
    """Candidates with their pro's profile and the profile and badge flags.

    A pro without a snapshot has no text, hence a zero profile flag.
    """
    hot = hot_keys(candidates, "pro_id") if hot_pros is None else hot_pros
    joined = spread_join(
        candidates, profiles, ["pro_id"], hot, "pro_id", ["shift_id"], "left"
    )
    return joined.withColumns(
        {
            "profile_experience_qualifying_flag": profile_evidence(
                F.col("profile_text"), F.col("skill_key"), F.col("skill")
            ),
            "confirmed_skill_badged_flag": badge_evidence(F.col("skill_key")),
        }
    )


def experience_labels(profile_flag: Column, badge_flag: Column, shifts: Column, same: Column):
    """The three Yes/No columns about earlier experience."""
    return {
        "has_worked_same_skill_before": yes_no(shifts > 0),
        "repeat_same_skill_at_same_business": yes_no(same > 0),
        "has_relevant_same_skill_experience": yes_no(
            any_true(profile_flag == 1, badge_flag == 1, shifts > 0)
        ),
    }


def first_shift_candidates(tables: Mapping[str, DataFrame], as_of: datetime) -> DataFrame:
    shifts = first_shifts(shift_level(tables["applications"], tables["gigs"]))
    return confirmed_applications(tables["applications"], shifts, as_of)


def first_five_qualification(
    tables: Mapping[str, DataFrame], as_of: datetime, worked: int | None = None
) -> DataFrame:
    """Evidence, experience, ratings and reliability of each confirmed first-shifts pro.

    The applications are read three times: for the shifts and for the candidates, which are written
    once, and for the history of the candidates' pros. Lookups, hot pros and the report itself start
    from the written candidates. The candidates' pros are written as well: a file so small can be broadcast,
    and the history then stays in the tasks in which its latest rows are found. `worked` is about how many
    applications there are; without it they are counted, which a stored table does by its files' footers.
    """
    apps = tables["applications"]
    confirmed = staged(first_shift_candidates(tables, as_of), "candidates")
    pros = staged(confirmed.groupBy("pro_id").agg(F.count(F.lit(1)).alias("rows")), "pros")
    hot_pros = hot_from_counts(pros, "pro_id", "rows")
    history = historical_paid(apps)
    experience = experience_and_ratings(
        confirmed,
        restrict_to_keys(history, pros.withColumnRenamed("pro_id", "gigster_id"), "gigster_id"),
        qualifying_pairs(apps.sparkSession),
        as_of,
        hot_pros,
        apps.count() if worked is None else worked,
    )
    profiles = pro_profiles(tables["pro_snapshot"], tables["profiles"])
    rows = with_evidence(
        confirmed.join(experience, ["shift_id", "pro_id"], "left"), profiles, hot_pros
    )

    profile_flag, badge_flag = (
        F.col("profile_experience_qualifying_flag"), F.col("confirmed_skill_badged_flag")
    )
    shifts = F.coalesce("qualifying_shifts", F.lit(0))
    same = F.coalesce("qualifying_shifts_same_place", F.lit(0))
    yes_nos = experience_labels(profile_flag, badge_flag, shifts, same)
    report = rows.select(
        F.col("location_name").alias("business_name"),
        "location_id",
        "shift_id",
        F.col("gig_start_time_local").alias("shift_date"),
        "market",
        "skill",
        F.col("original_allowed_confirmed_pros").alias("requested_pros"),
        F.col("current_confirmed_pros_count").alias("confirmed_pros"),
        labels.auto_select(F.col("gig_auto_select_enabled")).alias("auto_select_status"),
        F.col("gig_type").alias("shift_type"),
        "pro_id",
        F.col("full_name").alias("pro_name"),
        F.col("phone_number").alias("pro_phone_number"),
        badge_status(profile_flag, badge_flag).alias("confirmed_skill_profile_badge_status"),
        shifts.alias("prior_paid_same_skill_shifts"),
        same.alias("prior_paid_same_skill_shifts_same_business"),
        *[column.alias(name) for name, column in yes_nos.items()],
        "avg_rating",
        F.col("ratings").alias("ratings_count"),
        labels.pct(F.col("completion_percentage")).alias("completion_rate_lifetime_pct"),
        labels.pct(F.col("completion_percentage_30")).alias("completion_rate_last_30_days_pct"),
        F.col("paid_gigs").alias("completed_shifts_lifetime"),
        F.col("pro_cancelled_gigs_30").alias("pro_cancellations_last_30_days"),
        labels.pct(F.col("pro_cancel_percentage_30")).alias("pro_cancel_rate_last_30_days_pct"),
        F.col("no_show_gigs_last_30").alias("no_shows_last_30_days"),
        labels.distance_miles(
            F.col("pro_last_lat"), F.col("pro_last_long"),
            F.col("location_address_latitude"), F.col("location_address_longitude"),
        ).alias("distance_from_pro_last_seen_to_business_miles"),
        F.col("pro_last_on").alias("pro_last_seen_at"),
        "confirmation_timestamp",
        "selection_source",
        "position_avg_rating",
        F.coalesce("position_ratings_count", F.lit(0)).alias("position_ratings_count"),
    )
    return ordered(
        report,
        [F.col(c).asc_nulls_last() for c in ("shift_date", "business_name", "shift_id", "pro_name")],
    )
