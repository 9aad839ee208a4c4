"""Many-to-one joins that stay balanced when a few keys hold much of the data.

Spark's adaptive skew handling splits a hot key only when both join inputs come straight from a
shuffle. A lookup table that was just aggregated or joined on the same key does not, and a window
or aggregation on more columns than the join would silently keep the join's partitioning. Joining
on a salt as well avoids both.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EVEN_SHARES = 1.0
PART = "_part"


def hot_from_counts(counts: DataFrame, key: str, rows: str) -> DataFrame:
    """(hot_key, parts) of the keys with more rows than a shuffle partition's even share.

    The share is all rows over the number of shuffle partitions, so fewer keys than partitions can
    exceed it, and their parts together are fewer than twice the partitions: the list needs no
    limit at any size. EVEN_SHARES moves the bound; any list gives the same results.
    """
    partitions = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = counts.agg(F.coalesce(F.sum(rows), F.lit(0)).alias("total")).scalar()
    share = F.greatest(total * (EVEN_SHARES / partitions), F.lit(1.0))
    return counts.filter(F.col(rows) > share).select(
        F.col(key).alias("hot_key"), F.ceil(F.col(rows) / share).cast("int").alias("parts")
    )


def hot_keys(rows: DataFrame, key: str) -> DataFrame:
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    return hot_from_counts(counts, key, "_rows")


def _with_parts(df: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    # The broadcast has fewer rows than there are partitions, see `hot_from_counts`.
    return df.join(F.broadcast(hot), F.col(key).eqNullSafe(F.col("hot_key")), "left").drop(
        "hot_key"
    )


def spread_rows(
    rows: DataFrame, hot: DataFrame, hot_key: str, by: Sequence[str | Column]
) -> DataFrame:
    """Number the parts of hot keys' rows by the hash of `by`; other rows get part 0."""
    part = F.pmod(F.xxhash64(*by), F.col("parts")).cast("int")
    return _with_parts(rows, hot, hot_key).withColumn(PART, F.coalesce(part, F.lit(0))).drop(
        "parts"
    )


def spread_copies(table: DataFrame, hot: DataFrame, hot_key: str) -> DataFrame:
    """Copy a hot key's table rows once per part."""
    copies = F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)
    return _with_parts(table, hot, hot_key).withColumn(PART, F.explode(copies)).drop("parts")


def spread_join(
    rows: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    hot: DataFrame,
    hot_key: str,
    spread_by: Sequence[str | Column],
    how: str = "inner",
) -> DataFrame:
    """Join rows with a table that has at most one row per key, splitting the hot keys.

    Any list of hot keys gives the same result; only the balance differs.
    """
    return (
        spread_rows(rows, hot, hot_key, spread_by)
        .join(spread_copies(table, hot, hot_key), [*on, PART], how)
        .drop(PART)
    )
