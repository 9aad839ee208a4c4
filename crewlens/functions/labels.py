"""Report labels, distances and rounded numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_MILES = 3959.0
POOR_RATING = 4.0


def exact(value: Column) -> Column:
    """Decimal form used before rounding, so halves round the same way everywhere."""
    return value.cast("decimal(18,10)")


def rounded(value: Column, places: int) -> Column:
    return F.round(exact(value), places)


def pct(share: Column) -> Column:
    """A share as a percentage with one decimal."""
    return rounded(F.lit(100.0) * share, 1)


def distance_miles(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance by the spherical law of cosines; NULL when a coordinate is."""
    cosine = F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.cos(
        F.radians(lon2) - F.radians(lon1)
    ) + F.sin(F.radians(lat1)) * F.sin(F.radians(lat2))
    known = lat1.isNotNull() & lon1.isNotNull() & lat2.isNotNull() & lon2.isNotNull()
    clamped = F.least(F.lit(1.0), F.greatest(F.lit(-1.0), cosine))
    return F.when(known, rounded(EARTH_RADIUS_MILES * F.acos(clamped), 1))


def auto_select(flag: Column) -> Column:
    return F.when(flag, "On").when(~flag, "Off").otherwise("Unknown")


def verified(flag: Column) -> Column:
    return F.when(flag, "Verified").otherwise("Unverified")


def outreach_status(outreached: Column, responded: Column) -> Column:
    return (
        F.when(F.coalesce(outreached, F.lit(0)) == 0, "Not outreached")
        .when(responded == 1, "Pro responded")
        .otherwise("No pro response")
    )


def is_poor_rating(average: Column, rated: Column) -> Column:
    return (rated > 0) & (average < POOR_RATING)


def qualification_gap(
    match_source: Column, prior_shifts: Column, average: Column, rated: Column, skill: Column
) -> Column:
    """Why a confirmed pro needs a call; the average must be a decimal with two places."""
    return (
        F.when(
            (match_source == "No match") & (prior_shifts == 0),
            "No same- or higher-tier profile experience/certification"
            " and no prior paid qualifying shifts",
        )
        .when(
            is_poor_rating(average, rated),
            F.concat(
                F.lit("Poor prior "), skill, F.lit(" rating: "), average.cast("string"),
                F.lit(" across "), rated.cast("string"), F.lit(" rated shifts"),
            ),
        )
        .otherwise("Qualified - no outreach")
    )


def seconds_between(later: Column, earlier: Column) -> Column:
    """Seconds between two zone-less timestamps, independent of the session zone."""
    return (later - earlier).cast("interval second").cast("decimal(20,6)")


def hours_to_start(start: Column, as_of: Column) -> Column:
    return F.round(seconds_between(start, as_of) / F.lit(3600), 2)


def row_key(gig: Column, pro: Column) -> Column:
    return F.concat(gig.cast("string"), F.lit("-"), pro.cast("string"))


def applicants_link(base_url: str, location: Column, gig: Column) -> Column:
    """Spreadsheet link to a gig's applicants; NULL when the location is unknown."""
    return F.concat(
        F.lit(f'=HYPERLINK("{base_url}/locations/'), location.cast("string"),
        F.lit("/gigs/"), gig.cast("string"), F.lit('/applicants", "Shift Link")'),
    )


def payment_scope(source: Column, location_customer: Column, organization_customer: Column) -> Column:
    """Which billing account the selected source leads to."""
    chosen = F.upper(F.coalesce(source, F.lit("")))
    return (
        F.when(
            chosen == "LOCATION",
            F.when(location_customer.isNotNull(), "Location billing account").otherwise(
                "Location billing incomplete"
            ),
        )
        .when(
            chosen == "ORGANIZATION",
            F.when(organization_customer.isNotNull(), "Organization billing account").otherwise(
                "Organization billing incomplete"
            ),
        )
        .otherwise("No billing source")
    )
