"""VIP outreach report: confirmed pros at elevated locations and why they may need a call."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import labels
from ..functions.skills import (
    badge_evidence,
    profile_evidence,
    profile_match_source,
    qualifying_pairs,
    yes_no,
)
from ..operators.candidates import (
    elevated_shifts,
    historical_paid,
    moment,
    restrict_to_keys,
    starting_within,
)
from ..operators.experience import position_summary, prior_position
from ..operators.profiles import profiles_of_anyone
from ..operators.ranking import ordered
from ..operators.skew import hot_keys, spread_join

# Columns of the published outreach table.
PUBLISHED_COLUMNS = [
    "row_key", "pro_name", "pro_phone_number", "outreach_status", "verified_status",
    "hours_to_start", "start_time", "location_name", "market", "skillset_type",
    "pro_id", "gig_id", "has_matching_profile_skill", "profile_match_source",
    "prior_paid_same_skill_shifts", "position_avg_rating", "position_ratings_count",
    "overall_avg_rating", "overall_ratings_count", "poor_position_rating",
    "qualification_gap", "notes", "agent_name",
]


def elevated_signals(
    tables: Mapping[str, DataFrame], as_of: datetime, days: int = 3
) -> DataFrame:
    """Elevated shifts with profile text, both flags, match source and earlier work.

    The text starts from the application, so a bio counts even for a pro without a snapshot.
    """
    apps = tables["applications"]
    elevated = elevated_shifts(apps, tables["locations"], as_of, days)
    # The window of days is short, so its pros are usually few against the whole history.
    history = historical_paid(
        restrict_to_keys(apps, elevated, "gigster_id"), before=as_of
    )
    hot_pros = hot_keys(starting_within(apps, as_of, days), "gigster_id")
    earlier = position_summary(
        elevated,
        prior_position(history),
        qualifying_pairs(apps.sparkSession),
        hot_pros,
    )
    people = profiles_of_anyone(tables["pro_snapshot"], tables["profiles"])
    rows = spread_join(
        elevated.join(earlier, ["gigster_id", "gig_id"], "left"),
        people.withColumnRenamed("pro_id", "gigster_id"),
        ["gigster_id"],
        hot_pros,
        "gigster_id",
        ["gig_id"],
        "left",
    ).withColumn("profile_text", F.coalesce("profile_text", F.lit(" ")))
    flags = rows.withColumns(
        {
            "profile_flag": profile_evidence(
                F.col("profile_text"), F.col("skill_key"), F.col("skill"),
                blank_counts_as_missing=False,
            ),
            "badge_flag": badge_evidence(F.col("skill_key")),
        }
    )
    return flags.withColumns(
        {
            "profile_match_source": profile_match_source(F.col("profile_flag"), F.col("badge_flag")),
            "prior_shifts": F.coalesce("prior_paid_qualifying_skill_shifts", F.lit(0)),
            "rated_shifts": F.coalesce("position_ratings_count", F.lit(0)),
        }
    )


def vip_outreach(
    tables: Mapping[str, DataFrame], as_of: datetime, base_url: str, days: int = 3
) -> DataFrame:
    signals = elevated_signals(tables, as_of, days)
    average, rated = F.col("position_avg_rating"), F.col("rated_shifts")
    source, prior = F.col("profile_match_source"), F.col("prior_shifts")
    local = F.col("gig_start_time_local")
    report = signals.select(
        labels.row_key(F.col("gig_id"), F.col("gigster_id")).alias("row_key"),
        F.col("full_name").alias("pro_name"),
        F.col("phone_number").alias("pro_phone_number"),
        labels.outreach_status(F.col("outreached"), F.col("outreach_pro_response")).alias(
            "outreach_status"
        ),
        labels.verified(F.col("verified_pro")).alias("verified_status"),
        labels.hours_to_start(local, moment(as_of)).alias("hours_to_start"),
        local.alias("start_time"),
        "location_name",
        "market",
        F.col("skill").alias("skillset_type"),
        labels.applicants_link(base_url, F.col("location_id"), F.col("gig_id")).alias("shift_url"),
        F.col("gigster_id").alias("pro_id"),
        "gig_id",
        yes_no(source != "No match").alias("has_matching_profile_skill"),
        "profile_match_source",
        prior.alias("prior_paid_same_skill_shifts"),
        "position_avg_rating",
        rated.alias("position_ratings_count"),
        F.col("avg_rating").alias("overall_avg_rating"),
        F.col("ratings").alias("overall_ratings_count"),
        yes_no(labels.is_poor_rating(average, rated)).alias("poor_position_rating"),
        labels.qualification_gap(source, prior, average, rated, F.col("skill")).alias(
            "qualification_gap"
        ),
    )
    return ordered(
        report,
        [F.col(c).asc_nulls_last() for c in ("start_time", "location_name", "gig_id", "pro_name")],
    )


def outreach_queue(report: DataFrame) -> DataFrame:
    """Rows with neither qualification signal, or with a poor rating in the assigned position."""
    no_signal = (F.col("has_matching_profile_skill") == "No") & (
        F.col("prior_paid_same_skill_shifts") == 0
    )
    return report.filter(no_signal | (F.col("poor_position_rating") == "Yes"))


def attach_notes(report: DataFrame, notes: DataFrame) -> DataFrame:
    """Each row with the note and agent of its key, if any; `notes` has one row per key."""
    return report.join(notes.select("row_key", "notes", "agent_name"), "row_key", "left")
