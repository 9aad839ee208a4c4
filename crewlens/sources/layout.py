"""Applications laid out for the reports: partitioned by the period they start in, bucketed by pro and gig.

A report that looks at starts before or after a moment reads only the files of those periods, and the latest
row per pro and gig is found within a bucket, without a shuffle. Buckets go by both keys: by the pro alone, one
with very many applications would be one task's work.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.candidates import historical_paid

PERIOD = "start_period"
BUCKETED_BY = ["gigster_id", "gig_id"]


def write_applications(apps: DataFrame, table: str, path: str, buckets: int, grain: str = "month") -> None:
    """Write `apps` as a new table under `path`. `grain` is 'day' where a day's bucket still fills a file, else
    'month'. Each task writes one bucket, so a period has at most `buckets` files."""
    period = F.trunc("gig_start_time_local", "month") if grain == "month" else F.col("gig_start_time_local").cast("date")
    (
        apps.withColumn(PERIOD, period)
        .repartition(buckets, *BUCKETED_BY)
        .sortWithinPartitions(PERIOD, *BUCKETED_BY)
        .write.partitionBy(PERIOD).bucketBy(buckets, *BUCKETED_BY).sortBy(*BUCKETED_BY)
        .option("path", path).mode("errorifexists").saveAsTable(table)
    )


def applications_of(spark: SparkSession, table: str, since: datetime | None = None, before: datetime | None = None) -> DataFrame:
    """The table's applications; with bounds on the local start, only from the periods that may hold them.
    Rows without a local start are read only where there is no bound."""
    apps = spark.table(table)
    if since is not None:  # a month begins at most 30 days before any of its days
        apps = apps.filter(F.col(PERIOD) >= F.date_sub(F.lit(since.date()), 30))
        apps = apps.filter(F.col("gig_start_time_local") >= F.lit(since.isoformat(sep=" ")).cast("timestamp_ntz"))
    if before is not None:
        apps = apps.filter(F.col(PERIOD) <= F.lit(before.date()))
        apps = apps.filter(F.col("gig_start_time_local") < F.lit(before.isoformat(sep=" ")).cast("timestamp_ntz"))
    return apps.drop(PERIOD)


def paid_history_before(spark: SparkSession, table: str, before: datetime) -> DataFrame:
    """`historical_paid` from the laid-out table."""
    return historical_paid(applications_of(spark, table, before=before), before)
