"""Profile texts and the evidence they and the badges give."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import latest_by


def latest_profiles(profiles: DataFrame) -> DataFrame:
    """The newest profile of each user that is not marked deleted."""
    kept = profiles.filter(~F.coalesce("deleted", F.lit(False)))
    return latest_by(
        kept,
        ["user_id"],
        [F.col("last_updated_ts").desc_nulls_last(), F.col("id").desc_nulls_first()],
    ).select("user_id", "bio")


def profile_text(experience: Column, bio: Column) -> Column:
    blank = F.lit("")
    return F.lower(
        F.concat(F.coalesce(experience, blank), F.lit(" "), F.coalesce(bio, blank))
    )


def profiles_of_anyone(snapshot: DataFrame, profiles: DataFrame) -> DataFrame:
    """Every pro with a snapshot or a profile; the text of a missing part is blank."""
    bios = latest_profiles(profiles).withColumnRenamed("user_id", "pro_id")
    return (
        snapshot.join(bios, "pro_id", "full")
        .withColumn("profile_text", profile_text(F.col("experience"), F.col("bio")))
        .drop("bio")
    )


def pro_profiles(snapshot: DataFrame, profiles: DataFrame) -> DataFrame:
    """The snapshot with each pro's searchable text."""
    bios = latest_profiles(profiles).withColumnRenamed("user_id", "pro_id")
    return (
        snapshot.join(bios, "pro_id", "left")
        .withColumn("profile_text", profile_text(F.col("experience"), F.col("bio")))
        .drop("bio")
    )
