"""Published snapshots: one JSON array per row, with a stamp and a row count."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.quality import REFUSED, GateError, has_personal_data, offences

Table = tuple[DataFrame, Sequence[str]]
PUBLISHED, QUARANTINED = "published", "quarantined"


def json_value(df: DataFrame, name: str) -> Column:
    """One column as JSON text; times read 'yyyy-MM-dd HH:mm:ss', decimals are plain numbers."""
    value = F.col(name)
    if isinstance(df.schema[name].dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        value = value.cast("string")
    wrapped = F.to_json(F.array(value), {"ignoreNullFields": "false"})
    return F.substring(wrapped, F.lit(2), F.length(wrapped) - 2)


def json_rows(df: DataFrame, columns: Sequence[str], *keep: str) -> DataFrame:
    """Each row as a JSON array of the columns in the given order."""
    parts = F.concat_ws(",", *[json_value(df, c) for c in columns])
    return df.select(F.concat(F.lit("["), parts, F.lit("]")).alias("value"), *keep)


def _gated_rows(df: DataFrame, columns: Sequence[str], gates: Mapping[str, Column]) -> DataFrame:
    """JSON rows (value, state, gates); a row that fails a gate is quarantined as an object of the gates'
    names and the row."""
    failed = offences(df, gates)
    row = json_rows(df.withColumn("_failed", failed), columns, "_failed")
    held = F.size("_failed") > 0
    object_ = F.concat(F.lit('{"gates":'), F.to_json("_failed"), F.lit(',"row":'), "value", F.lit("}"))
    return row.select(
        F.when(held, object_).otherwise(F.col("value")).alias("value"),
        F.when(held, QUARANTINED).otherwise(PUBLISHED).alias("state"),
        F.col("_failed").alias("gates"),
    )


def publish_tables(
    tables: Mapping[str, Table],
    path: str,
    as_of: datetime,
    may_be_empty: Sequence[str] = (),
    gates: Mapping[str, Mapping[str, Column]] | None = None,
    refuse: bool = True,
) -> dict:
    """Write every table under a new folder, check what was written, then add a manifest.

    Each table is evaluated once: its rows, those with a phone number or e-mail address, and those that
    fail each of the table's `gates` (true for an offending row) are counted in the job that writes them.
    Offending rows go to a quarantine beside the published ones. An empty table that may not be, personal
    data, or with `refuse` any offending row, raises and leaves the manifests as they are. Folders and
    manifests are named by a run of their own and never overwritten, so readers (`latest_manifest`) always
    find a complete snapshot. `as_of` is UTC.
    """
    run = f"{as_of.strftime('%Y%m%dT%H%M%SZ')}-{uuid.uuid4().hex[:12]}"
    manifest = {"snapshot_utc": as_of.strftime("%Y-%m-%dT%H:%M:%SZ"), "run": run, "tables": {}}
    spark = None
    for name, (df, columns) in tables.items():
        spark, seen = df.sparkSession, Observation()
        folder = f"{path}/rows/run={run}/{name}"
        tests = (gates or {}).get(name, {})
        published = F.col("state") == PUBLISHED
        counts = [F.count_if(F.array_contains("gates", gate)).alias(gate) for gate in tests]
        rows = _gated_rows(df, columns, tests).observe(
            seen,
            F.count_if(published).alias("published rows"),
            F.count_if(published & has_personal_data(F.col("value"))).alias("personal data"),
            *counts,
        )
        try:
            rows.drop("gates").write.partitionBy("state").text(folder)
        except PySparkException as error:
            if REFUSED not in str(error):
                raise
            raise GateError(str(error)) from error
        found = seen.get
        if not found["published rows"] and name not in may_be_empty:
            raise GateError(f"{REFUSED}{name} is empty")
        if found["personal data"]:
            raise GateError(f"{REFUSED}personal data in {name}")
        failed = {gate: found[gate] for gate in tests if found[gate]}
        if failed and refuse:
            raise GateError(f"{REFUSED}{name} fails {failed}, see {folder}")
        manifest["tables"][name] = {
            "folder": folder, "columns": list(columns), "rows": found["published rows"], "failed": failed,
        }
    line = json.dumps(manifest, ensure_ascii=False)
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.text(
        f"{path}/manifests/{run}"
    )
    return manifest


def read_rows_of(spark: SparkSession, table: Mapping, state: str = PUBLISHED) -> DataFrame:
    """The JSON rows (value) of one table of a manifest; of its quarantine, with the gates' names."""
    held = table["rows"] if state == PUBLISHED else table["failed"]
    if not held:  # then the table has no such folder
        return spark.createDataFrame([], "value string")
    return spark.read.text(f"{table['folder']}/state={state}")


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete snapshot: snapshot_utc, table_name, table_rows, value (a JSON array a row)."""
    manifest = latest_manifest(spark, path)
    parts = [
        read_rows_of(spark, table).select(
            F.lit(manifest["snapshot_utc"]).alias("snapshot_utc"), F.lit(name).alias("table_name"),
            F.lit(table["rows"]).cast("bigint").alias("table_rows"), "value",
        )
        for name, table in manifest["tables"].items()
    ]
    return reduce(DataFrame.unionByName, parts)


def read_quarantine(spark: SparkSession, table: Mapping) -> DataFrame:
    """(gate, row) of a table's offending rows, one for each gate that a row fails."""
    gates = F.explode(F.from_json(F.get_json_object("value", "$.gates"), "array<string>")).alias("gate")
    return read_rows_of(spark, table, QUARANTINED).select(gates, F.get_json_object("value", "$.row").alias("row"))


def latest_manifest(spark: SparkSession, path: str) -> dict:
    """The newest complete manifest; of one moment, the run written last."""
    lines = spark.read.option("recursiveFileLookup", "true").text(f"{path}/manifests").select(
        "value", F.col("_metadata.file_modification_time").alias("written")
    )
    stamp = F.get_json_object("value", "$.snapshot_utc")
    return json.loads(lines.agg(F.max_by("value", F.struct(stamp, "written"))).first()[0])


def publish(df: DataFrame, path: str, columns: Sequence[str], as_of: datetime) -> int:
    """Publish one table, which may be empty, and return its number of rows."""
    manifest = publish_tables({"rows": (df, columns)}, path, as_of, may_be_empty=["rows"])
    return manifest["tables"]["rows"]["rows"]
