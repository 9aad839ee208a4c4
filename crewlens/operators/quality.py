"""Checks and redaction before a table is published."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bitmaps import may_repeat
from .skew import hot_from_counts, spread_join

REFUSED = "refusing to publish: "

# What counts as a phone number, an address and an opaque key.
PHONE = r"\+1\d{10}"
EMAIL = r"(?i)[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}"
OPAQUE_KEY = r"^mb-[0-9a-f]{24}$"


class GateError(ValueError):
    """A table must not be published."""


def require_rows(df: DataFrame, name: str) -> DataFrame:
    if df.isEmpty():
        raise GateError(f"{REFUSED}{name} is empty")
    return df


def guarded(df: DataFrame, needed: Mapping[str, DataFrame]) -> DataFrame:
    """`df`, whose job fails by name if a needed table has no rows.

    The checks are branches of the plan without rows, so building it runs no job; each task of a check
    reads one row at most.
    """
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema]
    for name, table in needed.items():
        found = table.limit(1).agg(F.count(F.lit(1)).alias("_found"))
        failed = F.raise_error(F.lit(f"{REFUSED}{name} is empty")).cast("boolean")
        df = df.unionByName(found.filter(F.when(F.col("_found") > 0, False).otherwise(failed)).select(*columns))
    return df


def offences(df: DataFrame, gates: Mapping[str, Column]) -> Column:
    """The names of the gates that a row fails, in order; a gate is true for an offending row."""
    return F.array_compact(F.array(*[F.when(F.coalesce(test, F.lit(False)), name) for name, test in gates.items()]))


def require_per_sheet(per_sheet: DataFrame, column: str, what: str) -> DataFrame:
    """A table with one row per sheet, failing the job for a sheet in which `column` is null.

    The check is part of the column's value: a filter could be passed by others on the same column.
    """
    message = F.concat(F.lit(f"{what} is missing in sheet "), F.col("sheet"))
    return per_sheet.withColumn(column, F.coalesce(column, F.raise_error(message)))


def require_columns(df: DataFrame, columns: Sequence[str], name: str = "table") -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise GateError(f"refusing to publish: {name} lacks columns {missing}")
    return df


def without_separators(text: Column) -> Column:
    """Text with white space and the usual phone punctuation taken out."""
    return F.translate(text, " \t\n\x0b\f\r().-", "")


def pii_scan(df: DataFrame, text_col: str, *by: str) -> DataFrame:
    """Rows and matches of phone numbers and e-mail addresses, per group or overall."""
    text = F.col(text_col)

    def matches(inside: Column, mark: str, pattern: str) -> Column:
        # Most texts lack the one character every match has, which is much cheaper to look for.
        return F.when(text.contains(mark), F.regexp_count(inside, F.lit(pattern))).otherwise(0)

    phones = matches(text, "+", PHONE)
    loose = matches(without_separators(text), "+", PHONE)
    emails = matches(text, "@", EMAIL)
    return df.select(
        *by, phones.alias("phones"), loose.alias("loose"), emails.alias("emails")
    ).groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("phones") > 0).alias("rows_with_phone"),
        F.count_if(F.col("loose") > 0).alias("rows_with_loose_phone"),
        F.count_if(F.col("emails") > 0).alias("rows_with_email"),
        F.coalesce(F.sum("emails"), F.lit(0)).cast("bigint").alias("email_matches"),
    )


def has_personal_data(text: Column) -> Column:
    """Whether a text holds a phone number or an e-mail address."""
    phone = text.contains("+") & text.rlike(PHONE)
    return F.coalesce(phone | (text.contains("@") & text.rlike(EMAIL)), F.lit(False))


def require_no_pii(df: DataFrame, text_cols: Sequence[str]) -> DataFrame:
    """One scan for all columns; a table on its way out is checked by `publish_tables` instead."""
    hits = [F.max(has_personal_data(F.col(c))).alias(c) for c in text_cols]
    found = [c for c, hit in df.agg(*hits).first().asDict().items() if hit]
    if found:
        raise GateError(f"refusing to publish: personal data in {', '.join(found)}")
    return df


def redact(df: DataFrame, drop_cols: Sequence[str], text_cols: Sequence[str]) -> DataFrame:
    """Leave out columns about a person and blank phone numbers and addresses in texts."""
    masked = {
        c: F.regexp_replace(F.regexp_replace(F.col(c), PHONE, ""), EMAIL, "") for c in text_cols
    }
    return df.drop(*drop_cols).withColumns(masked)


def emptied(df: DataFrame) -> DataFrame:
    """The table's columns without its rows."""
    return df.limit(0)


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys of more than one row; only rows whose key may repeat are shuffled."""
    return (
        may_repeat(df, key).groupBy(key).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)
    )


def with_copies(df: DataFrame, key: str, name: str = "copies") -> DataFrame:
    """Each row with the number of rows of its key, for a gate on uniqueness; a key that cannot repeat is
    not looked up by a shuffle of its own, and a hot one is no task's work alone."""
    repeated = duplicate_keys(df, key).select(F.col(key).alias("_key"), F.col("copies").alias("_copies"))
    hot = hot_from_counts(repeated, "_key", "_copies")
    rows = df.withColumn("_key", F.col(key))
    by = [F.xxhash64(*[F.col(c) for c in df.columns])]
    met = spread_join(rows, repeated.filter(F.col("_key").isNotNull()), ["_key"], hot, "_key", by, "left")
    return met.withColumn(name, F.coalesce("_copies", F.lit(1))).drop("_key", "_copies")


def bad_format(df: DataFrame, key: str, pattern: str) -> DataFrame:
    """Rows whose key does not match; a missing key does not match."""
    return df.filter(~F.coalesce(F.col(key).rlike(pattern), F.lit(False)))


def set_diff(actual: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """One row: row counts of both sides and how many expected keys are absent."""
    sides = {
        "actual_rows": actual,
        "expected_rows": expected,
        "missing": expected.join(actual.select(key).distinct(), key, "left_anti"),
    }
    tagged = reduce(
        DataFrame.unionByName,
        [df.select(F.lit(side).alias("side")) for side, df in sides.items()],
    )
    return tagged.agg(
        *[F.count_if(F.col("side") == side).alias(side) for side in sides]
    ).withColumn(
        "passed", (F.col("actual_rows") == F.col("expected_rows")) & (F.col("missing") == 0)
    )


def reconcile(
    cards: DataFrame, panels: DataFrame, key: str, count_col: str, total_col: str
) -> DataFrame:
    """Compare each panel's declared total with the sum of its cards; absent counts are zero."""
    sums = cards.groupBy(key).agg(
        F.sum(F.coalesce(count_col, F.lit(0))).cast("bigint").alias("represented")
    )
    represented = F.coalesce("represented", F.lit(0))
    return panels.join(sums, key, "left").select(
        key,
        F.col(total_col).alias("declared"),
        represented.alias("represented"),
        F.coalesce(F.col(total_col) == represented, F.lit(False)).alias("passed"),
    )


def forbidden(
    df: DataFrame, text_col: str, exact: Sequence[str], any_case: Sequence[str]
) -> DataFrame:
    """Rows whose text holds a listed phrase, with the phrases found."""
    text = F.col(text_col)
    found = [F.when(text.contains(p), p) for p in exact]
    found += [F.when(F.lower(text).contains(p.lower()), p) for p in any_case]
    return df.withColumn("found", F.array_compact(F.array(*found))).filter(F.size("found") > 0)


def extract_matches(
    df: DataFrame, text_col: str, pattern: str, *keep: str, group: int = 1
) -> DataFrame:
    """Every match of a pattern in page markup, in order."""
    matches = F.regexp_extract_all(F.col(text_col), F.lit(pattern), F.lit(group))
    return df.select(*keep, F.posexplode(matches).alias("position", "value"))


def extract_attr(df: DataFrame, text_col: str, attr: str, *keep: str) -> DataFrame:
    return extract_matches(df, text_col, attr + '="([^"]+)"', *keep)
