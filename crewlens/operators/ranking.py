"""First-N, latest-per-key, group totals and ordered reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import clean
from .skew import hot_from_counts, spread_join


def shift_level(apps: DataFrame, gigs: DataFrame) -> DataFrame:
    """One row per (business, name, location, gig) with its latest created and start times.

    Both sides are reduced before they meet: a gig with very many applications is collapsed on the
    map side instead of travelling row by row to one join task.
    """
    postings = (
        apps.filter(F.col("gig_id").isNotNull() & F.col("location_id").isNotNull())
        .groupBy("location_name", "location_id", "gig_id")
        .agg(
            F.max("gig_creation_time").alias("gig_created_at"),
            F.max("gig_start_time_local").alias("shift_date"),
        )
    )
    live = (
        gigs.filter(F.col("status") != "CANCELLED")
        .groupBy(F.col("id").alias("gig_id"))
        .agg(F.max("status").alias("shift_status"))
    )
    return postings.join(live, "gig_id").select(
        F.lower(F.trim("location_name")).alias("business_key"),
        F.col("location_name").alias("business_name"),
        "location_id",
        F.col("gig_id").alias("shift_id"),
        "gig_created_at",
        "shift_date",
        "shift_status",
    )


def first_n(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, name: str
) -> DataFrame:
    """The first n rows of each group with their position.

    The bound on row_number becomes a per-task group limit ahead of the shuffle, so each task sends
    at most n rows of a group however large the group is.
    """
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col(name) <= n)


def first_shifts(shifts: DataFrame, n: int = 5) -> DataFrame:
    return first_n(
        shifts,
        ["business_key"],
        [
            F.col("shift_date").asc_nulls_last(),
            F.col("gig_created_at").asc_nulls_last(),
            F.col("shift_id").asc_nulls_last(),
        ],
        n,
        "business_shift_number",
    )


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order."""
    return first_n(df, keys, order, 1, "_position").drop("_position")


def with_group_count(
    df: DataFrame, keys: Sequence[str], name: str, of: DataFrame | None = None
) -> DataFrame:
    """Attach each row's group size, counted over `of` (by default the rows themselves).

    A whole-group window would hold the largest group in one task. The counts are aggregated with
    map-side combine and joined back, with the rows of large groups spread over several tasks. The
    key travels as a struct, in which missing values are equal to each other.
    """
    keyed = F.struct(*keys)
    counts = (df if of is None else of).groupBy(keyed.alias("_group")).agg(
        F.count(F.lit(1)).alias(name)
    )
    return spread_join(
        df.withColumn("_group", keyed),
        counts,
        ["_group"],
        hot_from_counts(counts, "_group", name),
        "_group",
        [F.col(c) for c in df.columns],
    ).drop("_group")


def notes_by_key(notes: DataFrame, key: str = "row_key", order: str = "row_no") -> DataFrame:
    """The last note of each key in file order; blank keys are dropped."""
    cleaned = notes.select(
        clean(F.col(key)).alias(key),
        clean(F.col("notes")).alias("notes"),
        clean(F.col("agent_name")).alias("agent_name"),
        order,
    ).filter(F.col(key).isNotNull())
    return latest_by(cleaned, [key], [F.col(order).desc_nulls_last()]).drop(order)


def ordered(df: DataFrame, order: Sequence[Column], limit: int | None = None) -> DataFrame:
    result = df.orderBy(*order)
    return result if limit is None else result.limit(limit)
