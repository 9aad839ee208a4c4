"""Earlier paid work of a pro, counted through the skill ladder.

No operator here pairs a pro's applications with the pro's history. History is unique per
(pro, gig) and the ladder closure has no duplicate pairs, so every count of distinct gigs is a sum
of per-skill subtotals: history is summed per (pro, skill, place) with map-side combine, and each
application looks up the few subtotals its skill accepts.

Applications and sums are dealt by their pro once, and lookups are made where they are put in order
of time: an application travels as one row, not as one for each skill and scope. Pros with more rows
than such a task should hold are taken in slices of a day instead, whose lookups do travel.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.labels import rounded
from ..sources.staging import by_keys, by_rows, staged
from .candidates import moment
from .skew import PART, hot_keys, spread_copies, spread_join, spread_rows

ANYWHERE, SAME_PLACE = 0, 1
BEGINNING = datetime(1, 1, 1)
SERIES = ["pro_id", "matched_key", "scope", "place"]
SHIFTS = ["shifts"]
RATINGS = ["rated", "rating_sum"]
TOTALS = [*SHIFTS, *RATINGS]
RATING_SUM = "decimal(38,10)"
LOOKED_UP = ["shift_id", "pro_id", "location_id", "start_time", "skill_key"]
LOOKUP = ["shift_id", "pro_id", "matched_key", "scope", "place", "day", "start_time"]
# Applications that a task makes lookups of, up to fourteen each.
APPLICATIONS = 50_000
# Lookups of an application: seven skills at most, each anywhere and at the same place.
SKILLS_EACH = 7
LOOKUPS_EACH = 2 * SKILLS_EACH
# Points and lookups that a task puts in order of time, and rows from which they are dealt so. A pro with
# more of them is taken in slices of a day.
TIMED_ROWS, FEW_TIMED_ROWS = 1_000_000, 4_000_000


def _in_range(rating: Column) -> Column:
    return rating.between(1, 5)


def _scopes(location: Column) -> Column:
    """Each row counts once for the pro anywhere and once for the pro at that location."""
    return F.explode(
        F.array(
            F.struct(F.lit(ANYWHERE).alias("scope"), F.lit(0).cast("bigint").alias("place")),
            F.struct(F.lit(SAME_PLACE).alias("scope"), location.alias("place")),
        )
    )


def _anywhere(df: DataFrame) -> DataFrame:
    return df.withColumns({"scope": F.lit(ANYWHERE), "place": F.lit(0).cast("bigint")})


def _scoped(df: DataFrame) -> DataFrame:
    return (
        df.withColumn("_scope", _scopes(F.col("location_id")))
        .withColumns({"scope": F.col("_scope.scope"), "place": F.col("_scope.place")})
        .drop("_scope")
        .filter(F.col("place").isNotNull())
    )


def _sum_totals(df: DataFrame, keys: Sequence[str], totals: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in totals])


def _with_day(df: DataFrame) -> DataFrame:
    """The calendar day; the filter is stated so that every use of the rows has the same plan."""
    return df.withColumn("day", F.col("start_time").cast("date")).filter(F.col("day").isNotNull())


def _history_points(hist: DataFrame, floor: datetime | None, keys: Sequence[str], totals: Sequence[str]) -> DataFrame:
    """History as points in time, not yet told apart by scope: its totals per skill and start, older than
    `floor` as one. Every use of them reads the same columns, so that they are summed once."""
    start = F.col("start_time")
    if floor is not None:
        start = F.when(start < moment(floor), moment(BEGINNING)).otherwise(start)
    rows = hist.filter(F.col("gigster_id").isNotNull() & F.col("skill_key").isNotNull()).select(
        F.col("gigster_id").alias("pro_id"),
        F.col("skill_key").alias("matched_key"),
        "location_id",
        start.alias("start_time"),
        F.lit(1).cast("bigint").alias("shifts"),
        _in_range(F.col("rating")).cast("bigint").alias("rated"),
        # Decimals: their sum is the same in any order.
        F.when(_in_range(F.col("rating")), F.col("rating")).cast("decimal(18,10)").alias("rating_sum"),
    ).filter(F.col("start_time").isNotNull())
    return _sum_totals(rows, keys, totals)


def _asking(conf: DataFrame) -> DataFrame:
    """The applications that can have earlier work."""
    return conf.select(*LOOKED_UP).dropna(subset=["pro_id", "skill_key", "start_time"])


def _accepting(rows: DataFrame, closure: DataFrame, asks: Column | None = None) -> DataFrame:
    """One row per row that asks and accepted skill; a skill off the ladder accepts itself, and so do rows
    that do not ask."""
    ladder = closure.withColumnRenamed("skill_key", "_wanted")
    wanted = F.col("skill_key") == F.col("_wanted")
    found = rows.join(F.broadcast(ladder), wanted if asks is None else asks & wanted, "left").drop("_wanted")
    return found.withColumn("matched_key", F.coalesce("matched_key", "skill_key")).withColumn(
        "own_skill", F.col("matched_key") == F.col("skill_key")
    )


def _parts(rows: int) -> int | None:
    """Tasks for so many timed rows; None leaves few rows to adaptive execution."""
    return -(-rows // TIMED_ROWS) if rows > FEW_TIMED_ROWS else None


def _with_totals_before(
    lookups: DataFrame,
    per_start: DataFrame,
    series: list[str],
    totals: Sequence[str],
    parts: int | None,
) -> DataFrame:
    """Add to each lookup the totals of its series' points that start strictly earlier.

    A prefix sum in slices of a day: within a slice the rows run past in order of time, so neither a
    day's points nor its lookups are ever held together; each slice's total is carried over to the later
    ones in a table of its own, in which a series has at most one row per calendar day, and meets the
    slice's lookups by key. A hot series' points are thus never one task's work.
    """
    zero = {c: F.lit(0).cast(per_start.schema[c].dataType) for c in totals}
    timeline = per_start.withColumn("is_point", F.lit(1)).unionByName(
        lookups.withColumns({**zero, "is_point": F.lit(0)}), allowMissingColumns=True
    )
    timeline = by_keys(timeline, parts, *series, "day")
    # At equal start times probes sort ahead of points, which keeps "earlier" strict.
    within = Window.partitionBy(*series, "day").orderBy("start_time", "is_point").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    today = [F.coalesce(F.sum(c).over(within), zero[c]).alias(f"{c}_today") for c in totals]
    carried = [c for c in lookups.columns if c not in (*series, "day", "start_time")]
    probes = timeline.select("*", *today).filter(F.col("is_point") == 0)

    slices = per_start.select(*series, "day", *totals).unionByName(
        lookups.select(*series, "day").withColumns(zero)
    )
    earlier = Window.partitionBy(*series).orderBy("day").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = [F.coalesce(F.sum(c).over(earlier), zero[c]).alias(f"{c}_before") for c in totals]
    slices = _sum_totals(by_keys(slices, parts, *series, "day"), [*series, "day"], totals)
    carry = by_keys(slices, parts, *series).select(*series, "day", *before)
    return probes.join(carry, [*series, "day"]).select(
        *series,
        *carried,
        *[(F.col(f"{c}_today") + F.col(f"{c}_before")).alias(c) for c in totals],
    )


def _long_pros(asking: DataFrame, points: DataFrame, totals: Sequence[str]) -> DataFrame:
    """Pros with more points and lookups than a task puts in order of time: at most one for each such task."""
    asked = asking.groupBy("pro_id").agg((SKILLS_EACH * F.count(F.lit(1))).alias("_rows"))
    # Counted by the totals, one of which is never missing, so that the points have the same columns as elsewhere.
    known = points.groupBy("pro_id").agg(F.count(F.coalesce(*totals)).alias("_rows"))
    rows = _sum_totals(asked.unionByName(known), ["pro_id"], ["_rows"])
    return rows.filter(F.col("_rows") > TIMED_ROWS).select(F.col("pro_id").alias("long_pro"))


def _of_pros(rows: DataFrame, pros: DataFrame, how: str) -> DataFrame:
    return rows.join(F.broadcast(pros), F.col("pro_id") == F.col("long_pro"), how)


def _summed_at_once(
    asking: DataFrame, points: DataFrame, closure: DataFrame, long: DataFrame, most_rows: int
) -> DataFrame:
    """The totals of pros whose rows a task puts in order of time, per application.

    One exchange, by pro, serves the lookups, which are made behind it, their running totals and the
    sums over each application. Rows run past in order of time and are never held together.
    """
    here = [c for c in ("location_id",) if c in points.columns]
    timeline = points.withColumnRenamed("matched_key", "skill_key").withColumn("is_point", F.lit(1)).unionByName(
        asking.select("shift_id", "pro_id", "skill_key", *here, "start_time").withColumn("is_point", F.lit(0)),
        allowMissingColumns=True,
    )
    parts = _parts(most_rows)
    timeline = _of_pros(timeline, long, "left_anti").repartition(*([parts] if parts else []), "pro_id")
    rows = _accepting(timeline, closure, F.col("is_point") == 0)
    rows = rows if here else rows.filter("own_skill")

    def before(total: str, *keys: str) -> Column:
        # At equal start times lookups sort ahead of points, which keeps "earlier" strict.
        series = Window.partitionBy("pro_id", "matched_key", *keys).orderBy("start_time", "is_point")
        return F.sum(total).over(series.rowsBetween(Window.unboundedPreceding, Window.currentRow))

    counted = {c: before(c) for c in TOTALS if c in points.columns}
    if here:
        counted["same_place"] = F.when(F.col("location_id").isNotNull(), before("shifts", "location_id"))
    found = rows.select("shift_id", "pro_id", "is_point", "own_skill", *[v.alias(c) for c, v in counted.items()])
    own = {c: F.when(F.col("own_skill"), F.col(c)) for c in RATINGS}
    sums = {c: F.sum(own.get(c, F.col(c))) for c in counted}
    return found.filter(F.col("is_point") == 0).groupBy("shift_id", "pro_id").agg(
        *[v.alias(c) for c, v in sums.items()]
    )


def _found(
    lookups: DataFrame,
    points: DataFrame,
    hot: DataFrame,
    totals: Sequence[str],
    most_lookups: int,
    most_points: int,
) -> DataFrame:
    """The lookups with their totals, in tasks of few applications for the sums over each of them."""
    per_start = _sum_totals(points, [*SERIES, "day", "start_time"], totals)
    found = _with_totals_before(
        spread_rows(lookups, hot, "pro_id", ["shift_id"]),
        spread_copies(per_start, hot, "pro_id"),
        [*SERIES, PART],
        totals,
        _parts(most_lookups + most_points),
    )
    return by_keys(found, _parts(most_lookups), "shift_id", "pro_id")


def _earlier(
    conf: DataFrame,
    hist: DataFrame,
    closure: DataFrame,
    floor: datetime | None,
    hot_pros: DataFrame | None,
    worked: int,
    totals: Sequence[str],
) -> DataFrame:
    """The totals of earlier history per (shift, pro): shifts, those at the same place, own-skill ratings.

    Pros with many rows are taken in slices of a day, all others at once. Without shifts among the totals
    places make no difference.
    """
    asking, shifts = _asking(conf), "shifts" in totals
    keys = ["pro_id", "matched_key", *(["location_id"] if shifts else []), "start_time"]
    points = _history_points(hist, floor, keys, totals)
    long = _long_pros(asking, points, totals)
    applied = conf.count()
    # Of rows in order of time, each counted for the order at its place as well.
    most_lookups, most_points = (LOOKUPS_EACH * applied, 2 * worked) if shifts else (applied, worked)
    at_once = _summed_at_once(asking, points, closure, long, most_lookups + most_points)

    hot = hot_keys(conf, "pro_id") if hot_pros is None else hot_pros
    lookups = by_rows(_of_pros(asking, long, "left_semi"), APPLICATIONS, applied)
    lookups = _with_day(_accepting(lookups, closure))
    scoped = _scoped if shifts else _anywhere
    found = _found(
        scoped(lookups if shifts else lookups.filter("own_skill")).select(*LOOKUP, "own_skill"),
        scoped(_with_day(_of_pros(points, long, "left_semi"))),
        hot,
        totals,
        most_lookups,
        most_points,
    )
    anywhere, own = F.col("scope") == ANYWHERE, F.col("own_skill")
    sums = {c: F.sum(F.when(anywhere & own if c in RATINGS else anywhere, F.col(c))) for c in totals}
    if shifts:
        sums["same_place"] = F.sum(F.when(~anywhere, F.col("shifts")))
    in_slices = found.groupBy("shift_id", "pro_id").agg(*[v.alias(c) for c, v in sums.items()])

    columns = [F.col(c).cast(RATING_SUM) if c == "rating_sum" else F.coalesce(c, F.lit(0)).alias(c) for c in sums]
    return at_once.select("shift_id", "pro_id", *columns).unionByName(
        in_slices.select("shift_id", "pro_id", *columns)
    )


def experience_totals(
    conf: DataFrame,
    hist: DataFrame,
    closure: DataFrame,
    floor: datetime | None = None,
    hot_pros: DataFrame | None = None,
    worked: int = 0,
    totals: Sequence[str] = TOTALS,
) -> DataFrame:
    """Per (shift, pro): qualifying shifts, those at the same location, and own-skill ratings, if asked for.

    Only history starting strictly before the application counts. `floor` is a time no application
    starts before: history older than it precedes every application, so each series' older points
    fold into one at the beginning of time before anything is shuffled. `hot_pros` lists pros with
    very many applications; their lookups are spread over parts, each with a copy of the points.
    `conf` is a written table; its rows are counted by the files' footers. `worked` is about how many
    rows the history has at most: with the lookups' number it sets the number of tasks, so that no task's
    rows grow with the input; any number gives the same result.
    """
    return _earlier(conf, hist, closure, floor, hot_pros, worked, totals).withColumnsRenamed(
        {
            "shifts": "qualifying_shifts",
            "same_place": "qualifying_shifts_same_place",
            "rated": "rated_shifts",
        }
    )


def rating_totals(
    conf: DataFrame,
    hist: DataFrame,
    closure: DataFrame,
    floor: datetime | None = None,
    hot_pros: DataFrame | None = None,
    worked: int = 0,
) -> DataFrame:
    """The ratings of `experience_totals` alone: they look up the own skill anywhere, and points without
    a rating from 1 to 5 add nothing to them."""
    rated = hist.filter(_in_range(F.col("rating")))
    return _earlier(conf, rated, closure, floor, hot_pros, worked, RATINGS).withColumnRenamed(
        "rated", "rated_shifts"
    )


def _average(total: str, count: str) -> Column:
    return rounded(F.when(F.col(count) > 0, F.col(total).cast("double") / F.col(count)), 2)


def prior_experience(
    conf: DataFrame,
    hist: DataFrame,
    closure: DataFrame,
    floor: datetime | None = None,
    hot_pros: DataFrame | None = None,
    worked: int = 0,
    written: bool = False,
) -> DataFrame:
    """Qualifying earlier shifts per (shift, pro); pros without history get zeros. `conf` is written
    once, for the lookups, the lists of pros and the result, unless it is a `written` table already."""
    conf = conf if written else staged(conf.select(*LOOKED_UP), "lookups")
    totals = experience_totals(conf, hist, closure, floor, hot_pros, worked, SHIFTS)
    return conf.select("shift_id", "pro_id").join(totals, ["shift_id", "pro_id"], "left").select(
        "shift_id",
        "pro_id",
        F.coalesce("qualifying_shifts", F.lit(0)).alias("prior_paid_qualifying_skill_shifts"),
        F.coalesce("qualifying_shifts_same_place", F.lit(0)).alias(
            "prior_paid_qualifying_skill_shifts_same_business"
        ),
    )


def position_ratings(
    conf: DataFrame,
    hist: DataFrame,
    closure: DataFrame,
    floor: datetime | None = None,
    hot_pros: DataFrame | None = None,
    worked: int = 0,
) -> DataFrame:
    """Average and count of earlier ratings from 1 to 5 in the same skill, per (shift, pro)."""
    conf = staged(conf.select(*LOOKED_UP), "lookups")
    totals = rating_totals(conf, hist, closure, floor, hot_pros, worked)
    return conf.select("shift_id", "pro_id").join(totals, ["shift_id", "pro_id"], "left").select(
        "shift_id",
        "pro_id",
        _average("rating_sum", "rated_shifts").alias("position_avg_rating"),
        F.coalesce("rated_shifts", F.lit(0)).alias("position_ratings_count"),
    )


def experience_and_ratings(
    conf: DataFrame,
    hist: DataFrame,
    closure: DataFrame,
    floor: datetime | None = None,
    hot_pros: DataFrame | None = None,
    worked: int = 0,
) -> DataFrame:
    """Both reports from one pass; only (shift, pro) with a usable skill are present."""
    return experience_totals(conf, hist, closure, floor, hot_pros, worked).select(
        "shift_id",
        "pro_id",
        "qualifying_shifts",
        "qualifying_shifts_same_place",
        _average("rating_sum", "rated_shifts").alias("position_avg_rating"),
        F.col("rated_shifts").alias("position_ratings_count"),
    )


def prior_position(hist: DataFrame) -> DataFrame:
    """Shifts, average in-range rating and rated shifts per (pro, skill)."""
    rating = F.when(_in_range(F.col("rating")), F.col("rating"))
    return hist.groupBy("gigster_id", "skill_key").agg(
        F.count("gig_id").alias("prior_paid_same_position_shifts"),
        rounded(F.avg(rating), 2).alias("position_avg_rating"),
        F.count(F.when(rating.isNotNull(), F.col("gig_id"))).alias("position_ratings_count"),
    )


def _accepted_positions(
    elevated: DataFrame,
    positions: DataFrame,
    closure: DataFrame,
    how: str,
    hot_pros: DataFrame | None,
) -> DataFrame:
    hot = hot_keys(elevated, "gigster_id") if hot_pros is None else hot_pros
    rows = elevated.select("gigster_id", "gig_id", "skill_key").join(
        closure, "skill_key", how
    )
    rows = rows.withColumn("matched_key", F.coalesce("matched_key", "skill_key"))
    return spread_join(
        rows,
        positions.withColumnRenamed("skill_key", "matched_key"),
        ["gigster_id", "matched_key"],
        hot,
        "gigster_id",
        ["gig_id"],
        "left",
    )


def prior_qualifying(
    elevated: DataFrame,
    positions: DataFrame,
    closure: DataFrame,
    hot_pros: DataFrame | None = None,
) -> DataFrame:
    """Qualifying paid shifts per (pro, gig); skills off the ladder have no row."""
    return (
        _accepted_positions(elevated, positions, closure, "inner", hot_pros)
        .groupBy("gigster_id", "gig_id")
        .agg(
            F.coalesce(F.sum("prior_paid_same_position_shifts"), F.lit(0)).alias(
                "prior_paid_qualifying_skill_shifts"
            )
        )
    )


def position_summary(
    elevated: DataFrame,
    positions: DataFrame,
    closure: DataFrame,
    hot_pros: DataFrame | None = None,
) -> DataFrame:
    """Qualifying shifts and own-skill ratings per (pro, gig) from one join.

    A skill off the ladder accepts only itself, which is its same-position count.
    """
    own = F.col("matched_key") == F.col("skill_key")
    return (
        _accepted_positions(elevated, positions, closure, "left", hot_pros)
        .groupBy("gigster_id", "gig_id")
        .agg(
            F.coalesce(F.sum("prior_paid_same_position_shifts"), F.lit(0)).alias(
                "prior_paid_qualifying_skill_shifts"
            ),
            F.max(F.when(own, F.col("position_avg_rating"))).alias("position_avg_rating"),
            F.coalesce(F.max(F.when(own, F.col("position_ratings_count"))), F.lit(0)).alias(
                "position_ratings_count"
            ),
        )
    )
