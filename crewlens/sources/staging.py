"""Tables written once in the folder that driver and executors share, and read by several consumers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Where it names none, a process that runs alone takes a
    temporary folder; a cluster fails, as its executors would write where nobody else reads."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL:
        _LOCAL[application] = tempfile.mkdtemp(prefix="crewlens-")
    return _LOCAL[application]


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/crewlens-{uuid.uuid4().hex}/{name}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write `df` under a new name and read it back: each consumer, and each lost executor's work,
    starts from there instead of from the sources."""
    folder = new_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def by_rows(table: DataFrame, rows: int, most: int) -> DataFrame:
    """Rows of a written table, `most` at most, in tasks of about so many. Files are split by bytes, and numbers are
    written so compactly that the rows of a split would grow with the table until far more than a task should hold."""
    parts = -(-most // rows)
    return table.repartition(parts) if parts > 1 else table


def by_keys(table: DataFrame, parts: int | None, *keys: str) -> DataFrame:
    """The table's rows dealt by the hash of the keys to so many tasks; without a number they are left to
    adaptive execution, which sizes tasks by bytes and never makes more than there are shuffle partitions."""
    return table.repartition(parts, *keys) if parts else table
