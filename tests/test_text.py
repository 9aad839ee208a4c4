from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from crewlens.functions import text
from crewlens.plans.sheets import ALL_FORMATS


def run(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "given, formats, expected",
    [
        ("7/22/2026 5:30 PM", ("us12", "iso"), "2026-07-22 17:30:00"),
        ("2026-07-22 7:00:00", ("us12", "iso"), "2026-07-22 07:00:00"),
        ("2026-07-22", ("us12", "iso"), "2026-07-22 00:00:00"),
        ("2026-07-22 9:15", ("us12", "iso"), "2026-07-22 09:15:00"),
        ("12/1/2026 12:05 AM", ("us12", "iso"), "2026-12-01 00:05:00"),
        ("12/1/2026 12:05pm", ("us12", "iso"), "2026-12-01 12:05:00"),
        ("1/2/2026 3:04:05", ALL_FORMATS, "2026-01-02 03:04:05"),
        ("1/2/2026 3:04:05", ("us12", "iso"), "1/2/2026 3:04:05"),
        ("46225.5", ALL_FORMATS, "2026-07-22 12:00:00"),
        ("46225", ALL_FORMATS, "2026-07-22 00:00:00"),
        ("45292.999995", ALL_FORMATS, "2024-01-02 00:00:00"),
        ("13/45/2026 1:00 PM", ALL_FORMATS, "2026-13-45 13:00:00"),
        ("soon", ALL_FORMATS, "soon"),
        ("99999999", ALL_FORMATS, "99999999"),
        (" \t", ALL_FORMATS, None),
    ],
)
def test_normalize_datetime(spark, given, formats, expected):
    assert run(spark, text.normalize_datetime(F.lit(given), formats)) == expected


@pytest.mark.parametrize(
    "given, whole, number",
    [
        ("12.9", 12, 12.9), ("-12.9", -12, -12.9), ("", None, None), ("n/a", None, None),
        ("1d", None, None), (" 7 ", 7, 7.0), ("1e3", 1000, 1000.0), (".5", 0, 0.5),
        ("NaN", None, None), ("1e400", None, float("inf")), ("1_000", None, None),
    ],
)
def test_numbers(spark, given, whole, number):
    assert run(spark, text.to_long(F.lit(given))) == whole
    assert run(spark, text.to_double(F.lit(given))) == number


@pytest.mark.parametrize(
    "given, expected", [("98.5%", 98.5), ("100 %", 100.0), ("%", None), ("5%%", 5.0), ("", None)]
)
def test_percent(spark, given, expected):
    assert run(spark, text.to_percent(F.lit(given))) == expected


@pytest.mark.parametrize(
    "given, expected",
    [("TRUE", "On"), (" false ", "Off"), ("", None), ("maybe", "MAYBE"), (None, None)],
)
def test_onoff(spark, given, expected):
    assert run(spark, text.to_onoff(F.lit(given).cast("string"))) == expected


def test_clean_strips_all_white_space(spark):
    assert run(spark, text.clean(F.lit("\t x y \n"))) == "x y"
    assert run(spark, text.clean(F.lit("  \r"))) is None
