"""Row and shift counts of a published report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def snapshot_counts(report: DataFrame, key: str = "shift_id") -> DataFrame:
    """One row: report rows and distinct shifts; a NULL shift counts as one shift."""
    some_null = F.max(F.col(key).isNull().cast("bigint"))
    return report.agg(
        F.count(F.lit(1)).alias("report_rows"),
        (F.count_distinct(key) + F.coalesce(some_null, F.lit(0))).alias("shifts"),
    )
