"""Shift codes, clock times and schedule cells as column expressions.

A schedule cell is read inside its row with higher-order functions, so nothing is exploded or
shuffled to find the segment that covers a day. Weekdays count from Monday = 0.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .labels import seconds_between
from .text import bind, strip
from .vocabulary import DAY_TOKENS, WEEKDAYS, ZONE_LABELS

# Shapes of shift codes, clock times, schedule segments and tab titles.
SHIFT_CODE = r"^(\d{1,2})-(\d{1,2})$"
CLOCK = r"(?i)^(\d{1,2}):(\d{2})(?::(\d{2})(?:\.(\d{1,6}))?)?\s*(AM|PM)?$"
START = r"(\d{1,2}(?::\d{2})?\s*(?:AM|PM))"
TIME_RANGE = START + r"\s*-\s*\d{1,2}(?::\d{2})?\s*(?:AM|PM)"
SEGMENT = r"(?is)^(.*?)" + TIME_RANGE
START_TIME = r"(?i)^(\d{1,2})(?::(\d{2}))?\s*(AM|PM)$"
DAY = r"\b(" + "|".join(DAY_TOKENS) + r")\b"
DAY_RANGE = r"(?i)" + DAY + r"\s*-\s*" + DAY
ZONE = r"(?i)\b(" + "|".join(ZONE_LABELS) + r")\b"
TAB_RANGE = r"^(\d{1,2})/(\d{1,2})\s*-\s*(\d{1,2})/(\d{1,2})$"

DAY_MICROS = 86_400_000_000


def _number(text: Column, pattern: str, group: int) -> Column:
    """An optional numeric group; absent digits count as zero."""
    return F.concat(F.lit("0"), F.regexp_extract(text, pattern, group)).cast("bigint")


def shift_hours(code: Column) -> Column:
    """'12-9' -> {12, 21}: ends are always PM, starts from 1 to 6 are PM."""
    bare = strip(code)
    start, end = _number(bare, SHIFT_CODE, 1), _number(bare, SHIFT_CODE, 2)
    start24 = F.when(start <= 6, start + 12).otherwise(start)
    end24 = F.when(end == 12, 12).otherwise(end + 12)
    return F.when(
        bare.rlike(SHIFT_CODE),
        F.struct(start24.alias("start_hour"), end24.cast("bigint").alias("end_hour")),
    )


def hour_label(hour: Column) -> Column:
    """21 -> '9:00 PM'."""
    twelve = F.when(hour % 12 == 0, 12).otherwise(hour % 12)
    return F.concat(twelve.cast("string"), F.when(hour < 12, ":00 AM").otherwise(":00 PM"))


def _half(text: Column, pattern: str, group: int) -> Column:
    """0 without AM or PM, 1 for AM, 2 for PM."""
    first = F.upper(F.substring(F.regexp_extract(text, pattern, group), 1, 1))
    return F.when(first == "A", 1).when(first == "P", 2).otherwise(0)


def _hour24(hour: Column, half: Column) -> Column:
    return hour % 12 + F.when(half == 2, 12).otherwise(0)


def _parts(text: Column, pattern: str, build: Callable[..., Column], *parts: Column) -> Column:
    """build(*parts) for matching text, each part being read from the text once."""
    read = F.array(*[part.cast("bigint") for part in parts])
    found = bind(read, lambda all_parts: build(*[F.get(all_parts, i) for i in range(len(parts))]))
    return F.when(text.rlike(pattern), found)


def clock_micros(value: Column) -> Column:
    """Microseconds since midnight of a clock-in cell; NULL for anything but a valid time."""

    def total(hour, minute, second, micros, half):
        hours = F.when(half == 0, F.when(hour <= 23, hour)).otherwise(
            F.when(hour.between(1, 12), _hour24(hour, half))
        )
        whole = ((hours * 60 + minute) * 60 + second) * 1_000_000 + micros
        return F.when((minute <= 59) & (second <= 59), whole)

    def decode(text: Column) -> Column:
        fraction = F.rpad(F.regexp_extract(text, CLOCK, 4), 6, "0").cast("bigint")
        return _parts(
            text, CLOCK, total,
            *[_number(text, CLOCK, group) for group in (1, 2, 3)], fraction, _half(text, CLOCK, 5),
        )

    return bind(strip(value), decode)


def start_minutes(value: Column) -> Column:
    """Minutes since midnight of a schedule start such as '12 PM'; NULL when out of range."""

    def total(hour, minute, half):
        return F.when(hour.between(1, 12) & (minute <= 59), _hour24(hour, half) * 60 + minute)

    def decode(text: Column) -> Column:
        return _parts(
            text, START_TIME, total,
            _number(text, START_TIME, 1), _number(text, START_TIME, 2), _half(text, START_TIME, 3),
        )

    return bind(strip(value), decode)


def day_index(token: Column) -> Column:
    two = F.upper(F.substring(token, 1, 2))
    index = None
    for i, name in enumerate(WEEKDAYS):
        start = F if index is None else index
        index = start.when(two == name[:2], i)
    return index


def _day_tokens(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit("(?i)" + DAY), F.lit(1)), day_index)


def segment_days(text: Column) -> Column:
    """Sorted weekday numbers of one schedule segment.

    Exactly two days joined by a hyphen span an inclusive range, which may wrap the week; any
    other list names just its own days.
    """

    def listed(days: Column) -> Column:
        first, last = F.get(days, 0), F.get(days, 1)
        span = F.transform(
            F.sequence(F.lit(0), F.pmod(last - first, F.lit(7))),
            lambda step: F.pmod(first + step, F.lit(7)),
        )
        return F.when((F.size(days) == 2) & text.rlike(DAY_RANGE), span).otherwise(days)

    return F.array_sort(F.array_distinct(bind(_day_tokens(text), listed)))


def covers_day(text: Column, weekday: Column) -> Column:
    """Whether a segment text names the weekday: segment_days without building the list."""

    def named(days: Column) -> Column:
        first, last = F.get(days, 0), F.get(days, 1)
        within = F.pmod(weekday - first, F.lit(7)) <= F.pmod(last - first, F.lit(7))
        is_range = (F.size(days) == 2) & text.rlike(DAY_RANGE)
        return F.when(is_range, within).otherwise(F.array_contains(days, weekday))

    return bind(_day_tokens(text), named)


def zone_name(text: Column) -> Column:
    """Time zone of the first zone label in the text, NULL without one."""
    labels = F.create_map(*[F.lit(part) for pair in ZONE_LABELS.items() for part in pair])
    return labels[F.upper(F.regexp_extract(text, ZONE, 1))]


def timed_segments(schedule: Column) -> Column:
    """The texts of a schedule cell's segments that hold a time range, in order."""
    return F.filter(
        F.split(strip(schedule), r"\|"), lambda segment: segment.rlike("(?i)" + TIME_RANGE)
    )


def days_text(segment: Column) -> Column:
    return F.regexp_extract(segment, SEGMENT, 1)


def segment_start(segment: Column) -> Column:
    return start_minutes(F.regexp_extract(segment, SEGMENT, 2))


def schedule_segments(schedule: Column) -> Column:
    """Structs of days, start minutes and own zone of the segments with a time range."""
    return F.transform(
        timed_segments(schedule),
        lambda segment: F.struct(
            bind(days_text(segment), segment_days).alias("days"),
            segment_start(segment).alias("start_minute"),
            zone_name(segment).alias("zone"),
        ),
    )


def scheduled_start(
    schedule: Column, weekday: Column, work_date: Column, sheet_zone: Column
) -> Column:
    """Zone-less scheduled start in the sheet's zone, from the first segment covering the weekday."""
    covering = F.filter(
        timed_segments(schedule),
        lambda segment: bind(days_text(segment), lambda text: covers_day(text, weekday)),
    )

    def start_of(segment: Column) -> Column:
        zone = F.coalesce(zone_name(segment), zone_name(schedule), sheet_zone)
        local = F.timestamp_add("MINUTE", segment_start(segment), work_date.cast("timestamp_ntz"))
        return F.convert_timezone(zone, sheet_zone, local)

    return F.get(F.transform(F.slice(covering, 1, 1), start_of), 0)


def time_of_day_micros(moment: Column) -> Column:
    """Microseconds since midnight of a zone-less timestamp, in any session zone."""
    midnight = moment.cast("date").cast("timestamp_ntz")
    return (seconds_between(moment, midnight) * 1_000_000).cast("bigint")


def is_late(clock_in: Column, start: Column) -> Column:
    """True when the clock time nearest the scheduled start falls after it.

    The clock-in has no date. Of the day before, the day itself and the day after, the nearest
    occurrence counts and the earlier one wins a tie, so it is late exactly when the wrapped
    difference lies strictly between zero and half a day.
    """
    gap = F.pmod(clock_micros(clock_in) - time_of_day_micros(start), F.lit(DAY_MICROS))
    return F.coalesce((gap > 0) & (gap < DAY_MICROS // 2), F.lit(False))


def week_start(day: Column) -> Column:
    """The Sunday on or before the day."""
    return F.date_sub(day, F.pmod(F.weekday(day) + 1, F.lit(7)))


def week_label(day: Column) -> Column:
    """'MM/dd - MM/dd' of the Sunday-to-Saturday week."""
    sunday = week_start(day)
    return F.concat(
        F.date_format(sunday, "MM/dd"), F.lit(" - "), F.date_format(F.date_add(sunday, 6), "MM/dd")
    )


def tab_covers(title: Column, day: Column) -> Column:
    """Whether an 'M/d - M/d' tab title, read in the day's own year, contains the day."""
    text = strip(title)

    def date_at(month: int, dom: int) -> Column:
        parts = F.concat_ws(
            "-",
            F.year(day).cast("string"),
            F.lpad(F.regexp_extract(text, TAB_RANGE, month), 2, "0"),
            F.lpad(F.regexp_extract(text, TAB_RANGE, dom), 2, "0"),
        )
        return parts.try_cast("date")

    return F.coalesce(
        text.rlike(TAB_RANGE) & day.between(date_at(1, 2), date_at(3, 4)), F.lit(False)
    )


def tab_days(title: Column) -> Column:
    """The days 'MM-dd' of an 'M/d - M/d' tab title, as a leap year has them; null for any other title
    and for a range that runs over the end of the year."""
    text = strip(title)

    def date_at(month: int, dom: int) -> Column:
        parts = [F.lpad(F.regexp_extract(text, TAB_RANGE, g), 2, "0") for g in (month, dom)]
        return F.concat_ws("-", F.lit("2024"), *parts).try_cast("date")

    first, last = date_at(1, 2), date_at(3, 4)
    days = F.transform(F.sequence(first, last), lambda day: F.date_format(day, "MM-dd"))
    return F.when(text.rlike(TAB_RANGE) & (first <= last), days)
