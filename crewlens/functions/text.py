"""Cleaning and typing of spreadsheet text."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted shapes of spreadsheet dates, serial days and numbers.
US_12H = r"^(\d{1,2})/(\d{1,2})/(\d{4})\s+(\d{1,2}):(\d{2})\s*([AaPp])[Mm]$"
US_24H = r"^(\d{1,2})/(\d{1,2})/(\d{4})\s+(\d{1,2}):(\d{2}):(\d{2})$"
ISO = r"^(\d{4})-(\d{2})-(\d{2})(?:\s+(\d{1,2}):(\d{2})(?::(\d{2}))?)?$"
SERIAL = r"^\d+(\.\d+)?$"
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
# The characters Unicode counts as white space.
WHITE_SPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
LAST_SERIAL = 2958466  # first day after 9999-12-31 in spreadsheet days


def bind(value: Column, build: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once and use it several times inside `build`."""
    return F.get(F.transform(F.array(value), build), 0)


def strip(text: Column) -> Column:
    """Drop white space of every kind from both ends."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def clean(text: Column) -> Column:
    """Stripped text, NULL when nothing is left."""
    return F.nullif(strip(text), F.lit(""))


def to_double(text: Column) -> Column:
    bare = clean(text)
    return F.when(bare.rlike(NUMBER), bare.try_cast("double"))


def to_long(text: Column) -> Column:
    """Whole part of a number; text that is not a number gives NULL."""
    return to_double(text).try_cast("bigint")


def to_percent(text: Column) -> Column:
    return to_double(F.regexp_replace(strip(text), r"%+$", ""))


def to_onoff(text: Column) -> Column:
    word = F.upper(clean(text))
    return F.when(word == "TRUE", "On").when(word == "FALSE", "Off").otherwise(word)


def _pad2(text: Column) -> Column:
    return F.lpad(text, 2, "0")


def _stamp(y: Column, mo: Column, d: Column, h: Column, mi: Column, s: Column) -> Column:
    return F.concat(
        y, F.lit("-"), _pad2(mo), F.lit("-"), _pad2(d), F.lit(" "),
        _pad2(h), F.lit(":"), mi, F.lit(":"), s,
    )


def _parts(text: Column, pattern: str, count: int) -> list[Column]:
    return [F.regexp_extract(text, pattern, i) for i in range(1, count + 1)]


def _from_us_12h(text: Column) -> Column:
    mo, d, y, h, mi, half = _parts(text, US_12H, 6)
    hour = h.try_cast("int") % 12 + F.when(F.upper(half) == "P", 12).otherwise(0)
    return _stamp(y, mo, d, hour.cast("string"), mi, F.lit("00"))


def _from_us_24h(text: Column) -> Column:
    mo, d, y, h, mi, s = _parts(text, US_24H, 6)
    return _stamp(y, mo, d, h, mi, s)


def _from_iso(text: Column) -> Column:
    y, mo, d, h, mi, s = _parts(text, ISO, 6)
    h, mi, s = (F.coalesce(F.nullif(p, F.lit("")), F.lit("00")) for p in (h, mi, s))
    return _stamp(y, mo, d, h, mi, s)


def _from_serial(text: Column) -> Column:
    """Days since 1899-12-30; the fraction is a time of day rounded to the second."""
    serial = text.try_cast("double")
    days = F.floor(serial)
    seconds = F.bround((serial % 1) * 86400).cast("bigint") + days * 86400
    moment = F.timestamp_add("SECOND", seconds, F.lit("1899-12-30").cast("timestamp_ntz"))
    return F.when(serial < LAST_SERIAL, moment.cast("string")).otherwise(text)


_SHAPES = {
    "us12": (US_12H, _from_us_12h),
    "iso": (ISO, _from_iso),
    "us24": (US_24H, _from_us_24h),
    "serial": (SERIAL, _from_serial),
}


def normalize_datetime(text: Column, formats: Sequence[str] = ("us12", "iso")) -> Column:
    """yyyy-MM-dd HH:mm:ss for the accepted shapes; other text passes through unchanged.

    The digits are only rearranged, never checked against a calendar.
    """

    def rearranged(bare: Column) -> Column:
        result = None
        for name in formats:
            pattern, build = _SHAPES[name]
            start = F if result is None else result
            result = start.when(bare.rlike(pattern), build(bare))
        return result.otherwise(bare)

    # Bound, so the cleaned text is read once and the generated code stays small.
    return bind(clean(text), rearranged)
