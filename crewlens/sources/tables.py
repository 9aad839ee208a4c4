"""Warehouse tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

TABLES = (
    "applications", "gigs", "profiles", "pro_snapshot", "locations", "location_billing",
    "organizations",
)


def load(
    spark: SparkSession,
    location: str,
    names: Iterable[str] = TABLES,
    schemas: Mapping[str, StructType] | None = None,
) -> dict[str, DataFrame]:
    """The named tables stored as parquet under one location; a known schema is not read again."""
    found = {}
    for name in names:
        known = (schemas or {}).get(name)
        reader = spark.read if known is None else spark.read.schema(known)
        found[name] = reader.parquet(f"{location}/{name}.parquet")
    return found
