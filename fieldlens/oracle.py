"""DuckDB statements that compute each query on their own.

They are written as plain relational SQL: literal inequality joins, COUNT(DISTINCT), exploded
segments and phrase tables, so they check the Spark forms by a different route.
"""

from __future__ import annotations

import re

from crewlens.functions.vocabulary import (
    BADGES,
    DAY_TOKENS,
    GUARDED_PHRASES,
    SKILL_ALIASES,
    SKILL_BADGES,
    SKILL_PHRASES,
    WEEKDAYS,
    ladder_rows,
)
from crewlens.plans.billing import PAYMENT_COLUMNS
from crewlens.plans.qualification import PUBLISHED_NAMES
from crewlens.plans.sheets import SECTION_HEADERS

from . import tables as lens_tables
from .dialect import Duck, literal
from .queries import (
    AHEAD_DAYS,
    ANY_CASE_PHRASES,
    BASE_URL,
    EXACT_PHRASES,
    SHEET_ZONE,
)
from .tables import DEFINITIONS, _statement

AS_OF = "TIMESTAMP '1997-01-01 12:00:00'"
TODAY = "TIMESTAMP '1997-01-01 00:00:00'"
PHONE = r"\+1\d{10}"
EMAIL = r"[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}"


def values(rows) -> str:
    return "VALUES " + ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)


def pairs(table: dict) -> list[tuple[str, str]]:
    return [(key, item) for key, items in table.items() for item in items]


BLOCKERS = GUARDED_PHRASES["bartender"][1]
STRIP = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def strip(col: str) -> str:
    return STRIP.format(col)


def clean(col: str) -> str:
    return f"nullif({strip(col)}, '')"


def to_double(col: str) -> str:
    return (
        f"CASE WHEN regexp_matches({clean(col)}, '{NUMBER}') THEN"
        f" TRY_CAST({clean(col)} AS DOUBLE) END"
    )


def to_long(col: str) -> str:
    return f"CAST(trunc({to_double(col)}) AS BIGINT)"


def piece(col: str, pattern: str, group: int) -> str:
    return f"regexp_extract({col}, '{pattern}', {group})"


def pad(text: str) -> str:
    return f"lpad({text}, 2, '0')"


US_DATE = r"^(\d{1,2})/(\d{1,2})/(\d{4})\s+(\d{1,2}):(\d{2})"
ISO_DATE = r"^(\d{4})-(\d{2})-(\d{2})(?:\s+(\d{1,2}):(\d{2})(?::(\d{2}))?)?$"


def normalized(col: str, formats: tuple[str, ...]) -> str:
    bare = clean(col)
    us12, us24 = US_DATE + r"\s*([AaPp])[Mm]$", US_DATE + r":(\d{2})$"
    us_day = "{0} || '-' || {1} || '-' || {2} || ' '".format(
        piece(bare, US_DATE, 3), pad(piece(bare, US_DATE, 1)), pad(piece(bare, US_DATE, 2))
    )
    hour = f"CAST({piece(bare, US_DATE, 4)} AS INT)"
    shapes = {
        "us12": f"WHEN regexp_matches({bare}, '{us12}') THEN {us_day} || lpad(CAST({hour} % 12 +"
        f" CASE WHEN upper({piece(bare, us12, 6)}) = 'P' THEN 12 ELSE 0 END AS STRING), 2, '0')"
        f" || ':' || {piece(bare, US_DATE, 5)} || ':00'",
        "us24": f"WHEN regexp_matches({bare}, '{us24}') THEN {us_day}"
        f" || {pad(piece(bare, US_DATE, 4))} || ':' || {piece(bare, US_DATE, 5)} || ':'"
        f" || {piece(bare, us24, 6)}",
        "iso": f"WHEN regexp_matches({bare}, '{ISO_DATE}') THEN substr({bare}, 1, 10) || ' ' ||"
        + " || ':' || ".join(
            f"lpad(coalesce(nullif({piece(bare, ISO_DATE, g)}, ''), '00'), 2, '0')"
            for g in (4, 5, 6)
        ),
        "serial": rf"WHEN regexp_matches({bare}, '^\d+(\.\d+)?$') THEN"
        " strftime(TIMESTAMP '1899-12-30 00:00:00'"
        f" + to_days(CAST(floor(CAST({bare} AS DOUBLE)) AS INT))"
        f" + to_seconds(round_even((CAST({bare} AS DOUBLE) % 1) * 86400, 0)),"
        " '%Y-%m-%d %H:%M:%S')",
    }
    return f"CASE {' '.join(shapes[f] for f in formats)} ELSE {bare} END"


def rate(average: str) -> str:
    return f"CAST(round(CAST({average} AS DECIMAL(18,10)), 2) AS DOUBLE)"


def share(col: str) -> str:
    return f"CAST(round(CAST(100.0 * {col} AS DECIMAL(18,10)), 1) AS DOUBLE)"


DISTANCE = (
    "CASE WHEN pro_last_lat + pro_last_long + location_address_latitude"
    " + location_address_longitude IS NOT NULL THEN CAST(round(CAST(3959.0 * acos(least(1.0, greatest(-1.0,"
    " sin(radians(pro_last_lat)) * sin(radians(location_address_latitude))"
    " + cos(radians(pro_last_lat)) * cos(radians(location_address_latitude))"
    " * cos(radians(location_address_longitude) - radians(pro_last_long)))))"
    " AS DECIMAL(18,10)), 1) AS DOUBLE) END"
)


def yes(test: str) -> str:
    return f"CASE WHEN {test} THEN 'Yes' ELSE 'No' END"


AUTO_SELECT = (
    "CASE gig_auto_select_enabled WHEN true THEN 'On' WHEN false THEN 'Off' ELSE 'Unknown' END"
)
VERIFIED = "CASE WHEN verified_pro THEN 'Verified' ELSE 'Unverified' END"
OUTREACH = (
    "CASE WHEN outreached IS NULL OR outreached = 0 THEN 'Not outreached'"
    " WHEN outreach_pro_response = 1 THEN 'Pro responded' ELSE 'No pro response' END"
)
ROW_KEY = "CAST(gig_id AS STRING) || '-' || CAST(gigster_id AS STRING)"
LINK = (
    f"'=HYPERLINK(\"{BASE_URL}/locations/' || CAST(location_id AS STRING) || '/gigs/'"
    " || CAST(gig_id AS STRING) || '/applicants\", \"Shift Link\")'"
)
HOURS = (
    f"CAST(round(CAST(date_diff('microsecond', {AS_OF}, gig_start_time_local) AS DECIMAL(24,6))"
    " / 3600000000, 2) AS DOUBLE)"
)
BADGE_LABEL = (
    "CASE coalesce(CAST(profile_flag AS STRING), 'x') || coalesce(CAST(badge_flag AS STRING), '-')"
    " WHEN '11' THEN 'Profile + Badge' WHEN '10' THEN 'Profile Only'"
    " WHEN '1-' THEN 'Profile (Badge N/A)' WHEN '01' THEN 'Badge Only' WHEN '00' THEN 'Neither'"
    " ELSE 'No Profile Match (Badge N/A)' END"
)
MATCH_SOURCE = (
    "CASE WHEN profile_flag = 1 THEN 'Profile experience (same or higher tier)'"
    " WHEN badge_flag = 1 THEN 'Profile skill/certification (same or higher tier)'"
    " ELSE 'No match' END"
)
TEXT = "lower(concat(coalesce(experience, ''), ' ', coalesce(bio, '')))"


def keyed(columns: str, source: str, key: str = "skill") -> str:
    """Rows with their skill key through the alias table."""
    return (
        f"SELECT {columns}, coalesce(canonical, lower(trim({key}))) AS skill_key"
        f" FROM {source} LEFT JOIN alias ON spelling = lower(trim({key}))"
    )


def evidence(candidates: str, text_rows: str, pro: str, gig: str, blank_missing: bool) -> str:
    """profile_flag and badge_flag per candidate, from the phrase and badge tables."""
    usable = "profile_text IS NOT NULL" + (" AND trim(profile_text) <> ''" if blank_missing else "")
    blockers = " AND ".join(f"NOT contains(profile_text, {literal(b)})" for b in BLOCKERS)
    return f"""
    SELECT c.*, p.* EXCLUDE ({pro}),
      CASE WHEN {usable} AND (
        EXISTS (SELECT 1 FROM closure k JOIN phrase f ON f.skill_key = k.matched_key
                WHERE k.skill_key = c.skill_key AND contains(p.profile_text, f.phrase))
        OR (c.skill_key = 'bartender' AND contains(profile_text, 'bartender') AND {blockers})
        OR coalesce(p.profile_text LIKE '%' || lower(trim(c.skill)) || '%', false)
      ) THEN 1 ELSE 0 END AS profile_flag,
      (SELECT max(coalesce(h.held, 0)) FROM closure k JOIN badge b ON b.skill_key = k.matched_key
        LEFT JOIN held_badge h ON h.badge = b.badge AND h.pro_id = c.{pro}
        WHERE k.skill_key = c.skill_key) AS badge_flag
    FROM {candidates} c LEFT JOIN {text_rows} p ON p.{pro} = c.{pro}"""


STANDING = (
    "is_confirmed AND (is_canceled IS NULL OR is_canceled = 0) AND gigster_id IS NOT NULL"
)


def dedup(source: str, where: str, newest: str) -> str:
    return (
        f"SELECT * FROM {source} WHERE {where} QUALIFY row_number() OVER (PARTITION BY gig_id,"
        f" gigster_id ORDER BY {newest} DESC NULLS LAST, app_id DESC) = 1"
    )


def ranked_experience(conf: str) -> str:
    """Counts and ratings by pairing every confirmed row with all earlier history."""
    return f"""
    SELECT c.gig_id AS shift_id, c.gigster_id AS pro_id,
      count(DISTINCT h.gig_id) FILTER (WHERE k.matched_key IS NOT NULL
        OR (c.off_ladder AND h.skill_key = c.skill_key)) AS qualifying,
      count(DISTINCT h.gig_id) FILTER (WHERE h.location_id = c.location_id AND
        (k.matched_key IS NOT NULL OR (c.off_ladder AND h.skill_key = c.skill_key))) AS same_place,
      {rate("avg(h.rating) FILTER (WHERE h.skill_key = c.skill_key AND h.rating BETWEEN 1 AND 5)")}
        AS position_avg_rating,
      count(DISTINCT h.gig_id) FILTER (WHERE h.skill_key = c.skill_key
        AND h.rating BETWEEN 1 AND 5) AS position_ratings_count
    FROM (SELECT *, skill_key NOT IN (SELECT skill_key FROM ladder) AS off_ladder FROM {conf}) c
    LEFT JOIN history h ON h.gigster_id = c.gigster_id AND h.start_time < c.start_time
    LEFT JOIN closure k ON k.skill_key = c.skill_key AND k.matched_key = h.skill_key
    GROUP BY c.gig_id, c.gigster_id"""


CELL = "trim(coalesce(cells[{0}], ''))"
DAY_PATTERN = r"(?i)\b(" + "|".join(DAY_TOKENS) + r")\b"
START = r"\d{1,2}(?::\d{2})?\s*(?:AM|PM)"
RANGE = rf"({START})\s*-\s*{START}"
ZONE = r"(?i)\b(EST|EDT|ET|MNL|PHT)\b"


def zone_of(text: str) -> str:
    return (
        f"CASE WHEN upper(regexp_extract({text}, '{ZONE}', 1)) IN ('EST', 'EDT', 'ET')"
        f" THEN 'America/New_York' WHEN upper(regexp_extract({text}, '{ZONE}', 1))"
        " IN ('MNL', 'PHT') THEN 'Asia/Manila' END"
    )


def day_list(text: str) -> str:
    """Sorted weekday list of a segment text, spelled over a table of seven days."""
    tokens = f"regexp_extract_all({text}, '{DAY_PATTERN}', 1)"
    names = "[" + ", ".join(literal(w[:2]) for w in WEEKDAYS) + "]"
    index = f"list_position({names}, upper(substr(t, 1, 2))) - 1"
    numbers = f"[{index} FOR t IN {tokens}]"
    adjacent = (
        f"len({tokens}) = 2 AND regexp_matches({text}, '{DAY_PATTERN}\\s*-\\s*{DAY_PATTERN[4:]}')"
    )
    span = (
        f"[x FOR x IN range(7) IF (x - {numbers}[1] + 7) % 7"
        f" <= ({numbers}[2] - {numbers}[1] + 7) % 7]"
    )
    return f"list_sort(list_distinct(CASE WHEN {adjacent} THEN {span} ELSE {numbers} END))"


def clock(col: str) -> str:
    text = strip(col)
    shape = r"(?i)^(\d{1,2}):(\d{2})(?::(\d{2})(?:\.(\d{1,6}))?)?\s*(AM|PM)?$"
    h, m, s = (f"coalesce(TRY_CAST({piece(text, shape, g)} AS BIGINT), 0)" for g in (1, 2, 3))
    fraction = f"CAST(rpad({piece(text, shape, 4)}, 6, '0') AS BIGINT)"
    half = f"upper({piece(text, shape, 5)})"
    hour = f"CASE {half} WHEN '' THEN {h} WHEN 'AM' THEN {h} % 12 ELSE {h} % 12 + 12 END"
    return (
        f"CASE WHEN regexp_matches({text}, '{shape}') AND {m} < 60 AND {s} < 60 AND"
        f" CASE WHEN {half} = '' THEN {h} < 24 ELSE {h} BETWEEN 1 AND 12 END"
        f" THEN ((({hour}) * 60 + {m}) * 60 + {s}) * 1000000 + {fraction} END"
    )


def segments(source: str, id_cols: str) -> str:
    return f"""
    SELECT {id_cols}, schedule_text, pos - 1 AS pos, seg,
      {day_list(f"regexp_extract(seg, '(?is)^(.*?){RANGE}', 1)")} AS days,
      upper(regexp_extract(seg, '(?is)^(.*?){RANGE}', 2)) AS start_text
    FROM (SELECT *, unnest(string_split({strip('schedule_text')}, '|')) AS seg,
                 unnest(range(1, len(string_split(schedule_text, '|')) + 1)) AS pos
          FROM {source})
    WHERE regexp_matches(seg, '(?i){RANGE}')"""


START_HOUR = r"CAST(regexp_extract(start_text, '^(\d+)', 1) AS INT)"
START_MINUTE = r"coalesce(TRY_CAST(regexp_extract(start_text, ':(\d\d)', 1) AS INT), 0)"
START_MINUTES = (
    f"CASE WHEN {START_HOUR} BETWEEN 1 AND 12 AND {START_MINUTE} < 60 THEN"
    f" ({START_HOUR} % 12 + CASE WHEN start_text LIKE '%PM' THEN 12 ELSE 0 END) * 60"
    f" + {START_MINUTE} END"
)


def starts(source: str, segment_table: str, id_col: str) -> str:
    """The scheduled start in the sheet zone: first covering segment by position."""
    return f"""
    SELECT r.{id_col}, r.work_date,
      timezone('{SHEET_ZONE}', timezone(coalesce(zone, {zone_of('r.schedule_text')},
        '{SHEET_ZONE}'), CAST(r.work_date AS TIMESTAMP) + to_minutes(minutes))) AS scheduled_start
    FROM {source} r LEFT JOIN (
      SELECT {id_col}, first({zone_of('seg')} ORDER BY pos) AS zone,
             first(CAST({START_MINUTES} AS BIGINT) ORDER BY pos) AS minutes
      FROM {segment_table} WHERE list_contains(days, isodow(work_date) - 1)
      GROUP BY {id_col}) s ON s.{id_col} = r.{id_col}"""


def lateness(clock_micros: str) -> str:
    """Whichever of yesterday, today and tomorrow puts the clock nearest to the start."""
    return f"""coalesce((SELECT arg_min(tried > scheduled_start, [abs(date_diff('microsecond',
      scheduled_start, tried)), o]) FROM (SELECT o, CAST(CAST(scheduled_start AS DATE) AS TIMESTAMP)
      + to_days(CAST(o AS INT)) + to_microseconds({clock_micros}) AS tried
      FROM (VALUES (-1), (0), (1)) AS offsets(o))
      WHERE tried IS NOT NULL AND scheduled_start IS NOT NULL), false)"""


SHIFT_START = r"CAST(regexp_extract(code, '^(\d+)-(\d+)$', 1) AS BIGINT)"
SHIFT_END = r"CAST(regexp_extract(code, '^(\d+)-(\d+)$', 2) AS BIGINT)"
IS_CODE = r"regexp_matches(code, '^\d{1,2}-\d{1,2}$')"
HOURS24 = (
    f"CASE WHEN {IS_CODE} THEN CASE WHEN {SHIFT_START} < 7 THEN {SHIFT_START} + 12"
    f" ELSE {SHIFT_START} END END AS start_hour,"
    f" CASE WHEN {IS_CODE} THEN CASE WHEN {SHIFT_END} = 12 THEN 12 ELSE {SHIFT_END} + 12 END"
    " END AS end_hour"
)


def twelve_hour(hour: str) -> str:
    return (
        f"CAST(({hour} + 11) % 12 + 1 AS STRING) ||"
        f" CASE WHEN {hour} < 12 THEN ':00 AM' ELSE ':00 PM' END"
    )


VIEWS = {
    **{name: _statement(name, Duck()) for name in DEFINITIONS},
    "alias": "SELECT canonical, spelling FROM (" + values(pairs(SKILL_ALIASES))
    + ") AS t(canonical, spelling)",
    "ladder": "SELECT * FROM (" + values(ladder_rows()) + ") AS t(track, skill_key, tier)",
    "phrase": "SELECT * FROM (" + values(pairs(SKILL_PHRASES)) + ") AS t(skill_key, phrase)",
    "badge": "SELECT * FROM (" + values(pairs(SKILL_BADGES)) + ") AS t(skill_key, badge)",
    "closure": "SELECT DISTINCT a.skill_key, b.skill_key AS matched_key FROM ladder a JOIN ladder b"
    " ON a.track = b.track AND b.tier >= a.tier",
    "held_badge": "SELECT pro_id, unnest([" + ", ".join(literal(b) for b in BADGES)
    + "]) AS badge, unnest([" + ", ".join(f"cert_{b}" for b in BADGES)
    + "]) AS held FROM pro_snapshot",
    "keyed_apps": keyed("applications.*", "applications"),
    "shifts": """
      SELECT lower(trim(location_name)) AS business_key, location_name AS business_name,
        location_id, gig_id AS shift_id, max(gig_creation_time) AS gig_created_at,
        max(gig_start_time_local) AS shift_date, max(status) AS shift_status
      FROM applications JOIN gigs ON id = gig_id
      WHERE location_id IS NOT NULL AND status <> 'CANCELLED'
      GROUP BY ALL""",
    "first_five": """
      SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY business_key ORDER BY
        shift_date NULLS LAST, gig_created_at NULLS LAST, shift_id) AS business_shift_number,
        count(*) OVER (PARTITION BY business_key) AS total_business_postings FROM shifts)
      WHERE business_shift_number <= 5""",
    "candidates": dedup("keyed_apps", f"{STANDING} AND start_time >= {AS_OF}",
                        "confirmation_timestamp"),
    "confirmed": dedup(
        "keyed_apps",
        f"{STANDING} AND start_time >= {AS_OF} AND gig_id IN (SELECT shift_id FROM first_five)",
        "confirmation_timestamp",
    ),
    "elevated": dedup(
        "keyed_apps",
        f"{STANDING} AND gig_start_time_local >= {AS_OF} AND gig_start_time_local <"
        f" {AS_OF} + INTERVAL {AHEAD_DAYS} DAY AND location_id IN"
        " (SELECT location_id FROM locations WHERE currently_elevated_status = 'VIP')",
        "confirmation_timestamp",
    ),
    "history": dedup("keyed_apps", "is_paid = 1 AND coalesce(is_canceled, 0) = 0",
                     "rating_timestamp"),
    "history_before": dedup(
        "keyed_apps",
        f"is_paid = 1 AND coalesce(is_canceled, 0) = 0 AND gig_start_time_local < {AS_OF}",
        "rating_timestamp",
    ),
    "bios": "SELECT user_id, bio FROM profiles WHERE deleted IS NOT TRUE QUALIFY row_number() OVER"
    " (PARTITION BY user_id ORDER BY last_updated_ts DESC NULLS LAST, id DESC) = 1",
    "texts": f"SELECT pro_id AS gigster_id, s.* EXCLUDE (pro_id), {TEXT} AS profile_text"
    " FROM pro_snapshot s LEFT JOIN bios ON user_id = pro_id",
    "every_text": f"SELECT g.gigster_id, s.* EXCLUDE (pro_id), {TEXT} AS profile_text"
    " FROM (SELECT DISTINCT gigster_id FROM elevated) g LEFT JOIN pro_snapshot s"
    " ON s.pro_id = g.gigster_id LEFT JOIN bios ON user_id = g.gigster_id",
    "evidenced": evidence("candidates", "texts", "gigster_id", "gig_id", True),
    "evidenced_five": evidence("confirmed", "texts", "gigster_id", "gig_id", True),
    "evidenced_vip": evidence("elevated", "every_text", "gigster_id", "gig_id", False),
    "experience": ranked_experience("candidates"),
    "experience_five": ranked_experience("confirmed"),
    "positions": f"""
      SELECT gigster_id, skill_key, count(DISTINCT gig_id) AS prior_paid_same_position_shifts,
        {rate("avg(CASE WHEN rating BETWEEN 1 AND 5 THEN rating END)")} AS position_avg_rating,
        count(DISTINCT gig_id) FILTER (WHERE rating BETWEEN 1 AND 5) AS position_ratings_count
      FROM history_before GROUP BY gigster_id, skill_key""",
    "qualifying": """
      SELECT e.gigster_id, e.gig_id, count(DISTINCT h.gig_id) AS
        prior_paid_qualifying_skill_shifts
      FROM elevated e JOIN closure k ON k.skill_key = e.skill_key
      LEFT JOIN history_before h ON h.gigster_id = e.gigster_id AND h.skill_key = k.matched_key
      GROUP BY e.gigster_id, e.gig_id""",
    "vip_rows": f"""
      SELECT v.*, {MATCH_SOURCE} AS profile_match_source,
        coalesce(q.prior_paid_qualifying_skill_shifts, p.prior_paid_same_position_shifts, 0)
          AS prior_shifts,
        p.position_avg_rating, coalesce(p.position_ratings_count, 0) AS position_ratings_count,
        coalesce(p.position_ratings_count, 0) > 0 AND p.position_avg_rating < 4 AS is_poor
      FROM evidenced_vip v
      LEFT JOIN positions p ON p.gigster_id = v.gigster_id AND p.skill_key = v.skill_key
      LEFT JOIN qualifying q ON q.gigster_id = v.gigster_id AND q.gig_id = v.gig_id""",
    "vip": f"""
      SELECT {ROW_KEY} AS row_key, full_name AS pro_name, phone_number AS pro_phone_number,
        {OUTREACH} AS outreach_status, {VERIFIED} AS verified_status, {HOURS} AS hours_to_start,
        gig_start_time_local AS start_time, location_name, market, skill AS skillset_type,
        {LINK} AS shift_url, gigster_id AS pro_id, gig_id,
        {yes("profile_match_source <> 'No match'")} AS has_matching_profile_skill,
        profile_match_source, prior_shifts AS prior_paid_same_skill_shifts, position_avg_rating,
        position_ratings_count, avg_rating AS overall_avg_rating,
        ratings AS overall_ratings_count, {yes('is_poor')} AS poor_position_rating,
        CASE WHEN profile_match_source = 'No match' AND prior_shifts = 0 THEN
          'No same- or higher-tier profile experience/certification'
          || ' and no prior paid qualifying shifts'
          WHEN is_poor THEN 'Poor prior ' || skill || ' rating: '
          || CAST(CAST(position_avg_rating AS DECIMAL(18,2)) AS STRING) || ' across '
          || CAST(position_ratings_count AS STRING) || ' rated shifts'
          ELSE 'Qualified - no outreach' END AS qualification_gap
      FROM vip_rows""",
    "last_notes": f"""
      SELECT row_key, {clean('notes')} AS notes, {clean('agent_name')} AS agent_name
      FROM (SELECT {clean('row_key')} AS row_key, notes, agent_name, row_no FROM notes)
      WHERE row_key IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY row_key ORDER BY row_no DESC) = 1""",
    "upcoming": f"""
      SELECT DISTINCT location_id FROM applications WHERE location_id IS NOT NULL
      AND gig_start_time_local >= {TODAY} - INTERVAL 1 DAY
      AND gig_start_time_local < {TODAY} + INTERVAL 31 DAY""",
    "paying": """
      SELECT location_id, location_name, approval_status,
        CASE upper(coalesce(b.billing_source, ''))
          WHEN 'LOCATION' THEN CASE WHEN b.billing_customer_id IS NULL
            THEN 'Location billing incomplete' ELSE 'Location billing account' END
          WHEN 'ORGANIZATION' THEN CASE WHEN o.billing_customer_id IS NULL
            THEN 'Organization billing incomplete' ELSE 'Organization billing account' END
          ELSE 'No billing source' END AS payment_information_scope
      FROM upcoming JOIN locations USING (location_id) JOIN location_billing b ON b.id = location_id
      LEFT JOIN organizations o ON o.id = b.organization_id""",
    "billing": f"""
      SELECT location_id, location_name, approval_status,
        {yes("payment_information_scope LIKE '%account'")} AS has_payment_information,
        payment_information_scope
      FROM paying ORDER BY location_id""",
    "five_report": f"""
      SELECT c.location_name AS business_name, c.location_id, c.gig_id AS shift_id,
        c.gig_start_time_local AS shift_date, c.market, c.skill,
        c.original_allowed_confirmed_pros AS requested_pros,
        c.current_confirmed_pros_count AS confirmed_pros, {AUTO_SELECT} AS auto_select_status,
        c.gig_type AS shift_type, c.gigster_id AS pro_id, full_name AS pro_name,
        phone_number AS pro_phone_number,
        {BADGE_LABEL} AS confirmed_skill_profile_badge_status,
        x.qualifying AS prior_paid_same_skill_shifts,
        {yes('x.qualifying > 0')} AS has_worked_same_skill_before,
        x.same_place AS prior_paid_same_skill_shifts_same_business,
        {yes('x.same_place > 0')} AS repeat_same_skill_at_same_business,
        {yes('profile_flag = 1 OR badge_flag = 1 OR x.qualifying > 0')}
          AS has_relevant_same_skill_experience,
        avg_rating, ratings AS ratings_count,
        {share('completion_percentage')} AS completion_rate_lifetime_pct,
        {share('completion_percentage_30')} AS completion_rate_last_30_days_pct,
        paid_gigs AS completed_shifts_lifetime,
        pro_cancelled_gigs_30 AS pro_cancellations_last_30_days,
        {share('pro_cancel_percentage_30')} AS pro_cancel_rate_last_30_days_pct,
        no_show_gigs_last_30 AS no_shows_last_30_days,
        {DISTANCE} AS distance_from_pro_last_seen_to_business_miles,
        pro_last_on AS pro_last_seen_at, c.confirmation_timestamp, c.selection_source,
        x.position_avg_rating, x.position_ratings_count
      FROM evidenced_five c LEFT JOIN experience_five x
        ON x.shift_id = c.gig_id AND x.pro_id = c.gigster_id""",
    "roster_named": f"""
      SELECT sheet, line, {CELL.format(1)} AS name, cells,
        [{', '.join(CELL.format(i + 2) for i in range(7))}] AS codes FROM roster""",
    "roster_agents": """
      SELECT * FROM roster_named r WHERE name NOT IN ('', 'Name')
        AND len([c FOR c IN codes IF c <> '']) > 0
        AND line > (SELECT min(line) FROM roster_named h WHERE h.sheet = r.sheet
                    AND h.name = 'Name')
      QUALIFY row_number() OVER (PARTITION BY sheet, name ORDER BY line DESC) = 1""",
    "roster_codes": "SELECT sheet, name, CAST(unnest(range(7)) AS INT) AS weekday,"
    " unnest(codes) AS code FROM roster_agents",
    "one_roster": """
      SELECT name, CAST(unnest(range(7)) AS INT) AS weekday, unnest(codes) AS code FROM (
        SELECT * FROM roster_named WHERE name NOT IN ('', 'Name')
          AND len([c FOR c IN codes IF c <> '']) > 0
          AND line > (SELECT min(line) FROM roster_named WHERE name = 'Name')
        QUALIFY row_number() OVER (PARTITION BY sheet[:4], name ORDER BY line DESC) = 1)""",
    "date_header": r"""
      SELECT sheet, unnest(cells) AS title, unnest(range(1, len(cells) + 1)) AS col FROM (
        SELECT sheet, arg_min(cells, line) AS cells FROM clockins WHERE
          len([c FOR c IN cells IF regexp_matches(trim(c), '^\d{1,2}/\d{1,2}/\d{2}$')]) > 0
        GROUP BY sheet)""",
    "sessions": """
      SELECT c.sheet, CAST(strptime(title, '%m/%d/%y') AS DATE) AS work_date,
        trim(cells[2]) AS full_name, trim(cells[3]) AS schedule_text, trim(cells[col]) AS clock_in
      FROM clockins c JOIN date_header h ON h.sheet = c.sheet AND title LIKE '%/%/%'
      WHERE trim(cells[2]) <> '' AND trim(cells[col]) <> ''
        AND trim(coalesce(cells[col + 1], '')) = ''
      QUALIFY row_number() OVER (PARTITION BY c.sheet, title, full_name ORDER BY line DESC) = 1""",
    "numbered_sessions": "SELECT *, row_number() OVER () AS session_id FROM sessions",
    "raw_segments": segments("raw_sheet", "event_id, work_date"),
    "raw_starts": starts("raw_sheet", "raw_segments", "event_id"),
    "session_segments": segments("numbered_sessions", "session_id, work_date"),
    "session_starts": starts("numbered_sessions", "session_segments", "session_id"),
}
MATERIALIZED = {
    "applications", "keyed_apps", "numbered_sessions", "sessions", "history", "history_before",
    "candidates", "confirmed", "elevated", "closure", "ladder",
}


def with_views(body: str) -> str:
    """Prefix a statement with the views it needs, in order."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, definition in VIEWS.items():
            if name not in needed and re.search(rf"\b(FROM|JOIN) {name}\b", text):
                visit(definition)
                if name not in needed:
                    needed.append(name)

    visit(body)
    parts = [
        f"{n} AS {'MATERIALIZED ' if n in MATERIALIZED else ''}({VIEWS[n]})" for n in needed
    ]
    return ("WITH " + ", ".join(parts) + " " if parts else "") + body


def _tables_count() -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS table_rows FROM {name}"
        for name in DEFINITIONS
    )


def _sheet_rows() -> str:
    return r"""
    SELECT c_custkey AS location_id,
      CASE WHEN c_custkey % 13 = 1 THEN CASE WHEN c_nationkey % 2 = 0 THEN 'q' END
        WHEN c_custkey % 10 = 3 THEN c_name || ', the "old"' || chr(10) || 'one'
        WHEN c_custkey % 10 = 6 THEN c_name || ' 6" pipe'
        WHEN c_custkey % 10 = 8 THEN c_name || ' tail'
        ELSE c_name END AS location_name,
      CASE WHEN c_custkey % 13 <> 1 AND c_custkey % 4 <> 0 THEN lower(c_mktsegment) END
        AS approval_status,
      CASE WHEN c_custkey % 13 <> 1 THEN 'Yes' END AS has_payment_information,
      CASE WHEN c_custkey % 13 <> 1 THEN 'a scope' END AS payment_information_scope
    FROM (SELECT *, least(405, min(c_custkey * 10) FILTER (WHERE c_custkey % 31 = 5)
            OVER (PARTITION BY c_nationkey)) AS header_no FROM customer)
    WHERE c_custkey * 10 > header_no AND c_custkey % 23 <> 0 AND c_custkey % 31 <> 5
    UNION ALL
    SELECT NULL, 'location_name', 'approval_status', 'has_payment_information',
      'payment_information_scope'
    FROM (SELECT c_nationkey, c_custkey * 10 AS line FROM customer WHERE c_custkey % 31 = 5
          UNION ALL SELECT n_nationkey, 405 FROM nation)
    QUALIFY line > min(line) OVER (PARTITION BY c_nationkey)"""


def _positional_rows() -> str:
    d = Duck()
    dates, flags, numbers = (
        d.pick(items, "o_orderkey")
        for items in (lens_tables.DATE_TEXTS, lens_tables.FLAG_TEXTS, lens_tables.WHOLE_TEXTS)
    )
    return f"""
    SELECT CASE WHEN is_header THEN NULL ELSE o_orderkey END AS shift_id,
      CASE WHEN is_header THEN 'start' ELSE {normalized('dates', ('us12', 'us24', 'serial'))} END
        AS start_datetime,
      CASE WHEN NOT is_header THEN o_orderpriority END AS market,
      CASE WHEN NOT is_header THEN 'Venue ' || CAST(o_custkey AS STRING) END AS location_name,
      CAST(NULL AS STRING) AS shift_type,
      CASE WHEN NOT is_header THEN CASE upper(trim(flags)) WHEN 'TRUE' THEN 'On'
        WHEN 'FALSE' THEN 'Off' ELSE nullif(upper(trim(flags)), '') END END AS auto_select_enabled,
      CASE WHEN NOT is_header THEN {to_long('numbers')} END AS allowed_confirmed_pros,
      CASE WHEN NOT is_header THEN CAST(trunc(o_totalprice) AS BIGINT) END
        AS current_confirmed_pros_count,
      CAST(NULL AS BIGINT) AS number_of_selected_pros, CAST(NULL AS STRING) AS shift_url
    FROM (SELECT *, {dates} AS dates, {flags} AS flags, {numbers} AS numbers,
            min(line) FILTER (WHERE is_header) OVER (PARTITION BY sheet) AS header_no
          FROM (SELECT *, o_orderkey * 2 AS line, quarter(o_orderdate) AS sheet,
                  o_orderkey % 499 = 17 AS is_header FROM orders
                UNION ALL BY NAME
                SELECT min(o_orderkey) AS o_orderkey, min(o_orderkey) * 2 + 1 AS line,
                  quarter(o_orderdate) AS sheet, true AS is_header FROM orders GROUP BY quarter(o_orderdate)))
    WHERE line > header_no AND (is_header OR o_orderkey % 19 <> 4)"""


def _sections() -> str:
    kinds = " ".join(
        f"WHEN event_id % 61 = {m} THEN '{s}'" for s, m in zip(SECTION_HEADERS, (3, 20, 40))
    )
    return f"""
    SELECT sheet, line, section, cells FROM (
      SELECT 'team ' || CAST(user_id % 10 AS STRING) AS sheet, event_id AS line, mark,
        event_type || '||' || CAST(event_id AS STRING) AS cells,
        last_value(mark IGNORE NULLS) OVER (PARTITION BY user_id % 10 ORDER BY event_id) AS section
      FROM (SELECT *, CASE {kinds} WHEN event_id % 17 = 0 OR event_id % 71 = 0 THEN '' END AS mark
            FROM events))
    WHERE mark IS NULL AND section <> ''"""


def _json_rows(table: str = "billing", columns=PAYMENT_COLUMNS) -> str:
    cells = " || ',' || ".join(f"coalesce(CAST(to_json({c}) AS STRING), 'null')" for c in columns)
    return f"SELECT '[' || {cells} || ']' AS value FROM {table}"


def _snapshot() -> str:
    parts = {"PAYMENT_ROWS": _json_rows(), "NOTE_ROWS": _json_rows("last_notes", ["row_key", "notes", "agent_name"])}
    return " UNION ALL ".join(
        f"SELECT '1997-01-01T12:00:00Z' AS snapshot_utc, '{name}' AS table_name,"
        f" count(*) OVER () AS table_rows, value FROM ({rows})"
        for name, rows in parts.items()
    )


def _week_tabs() -> str:
    def on(month: int, dom: int) -> str:
        part = "lpad(regexp_extract(title, '^(\\d+)/(\\d+) - (\\d+)/(\\d+)$', {0}), 2, '0')"
        return f"TRY_CAST(year(day) || '-' || {part.format(month)} || '-' || {part.format(dom)} AS DATE)"

    sunday = "(day - CAST(isodow(day) % 7 AS INT))"
    padded = f"strftime({sunday}, '%m/%d') || ' - ' || strftime({sunday} + 6, '%m/%d')"
    return f"""
    SELECT day, arg_min(title, (title <> {padded}, tab_no)) AS title
    FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders) CROSS JOIN (
      SELECT strftime({sunday}, '%-m/%-d') || ' - ' || strftime({sunday} + 6, '%-m/%-d') AS title,
        min(o_orderkey) AS tab_no
      FROM (SELECT *, CAST(o_orderdate AS DATE) AS day FROM orders) WHERE year(day) = 1996 GROUP BY 1
      UNION ALL
      SELECT {padded}, min(o_orderkey) + 2000000000
      FROM (SELECT *, CAST(o_orderdate AS DATE) AS day FROM orders) WHERE year(day) = 1995 GROUP BY 1
      UNION ALL SELECT m || '/1 - ' || m || '/28', 1000000000 + m FROM range(1, 13) AS months(m)
      UNION ALL SELECT CASE WHEN m < 12 THEN m || '/28 - ' || (m + 1) || '/1' ELSE '12/28 - 12/31' END,
        1000000000 + m FROM range(1, 13) AS months(m))
    WHERE title = {padded} OR day BETWEEN {on(1, 2)} AND {on(3, 4)}
    GROUP BY day"""


PAID = "SELECT gigster_id, gig_id, location_id, start_time, rating, skill_key FROM"

STATEMENTS = {
    "first_five_report": "SELECT * FROM five_report",
    "vip_outreach_report": "SELECT * FROM vip",
    "billing_status": "SELECT * FROM billing",
    "agents_on_shift": f"""
      SELECT s.work_date, a.name, {twelve_hour('end_hour')} AS until,
        {lateness('clock_micros')} AS late
      FROM (SELECT *, {clock('clock_in')} AS clock_micros FROM numbered_sessions) s
      JOIN session_starts USING (session_id) JOIN aliases a ON a.full_name = s.full_name
      JOIN (SELECT *, {HOURS24} FROM one_roster) r
        ON r.name = a.name AND r.weekday = isodow(s.work_date) - 1
      WHERE end_hour IS NOT NULL""",
    "source_tables": _tables_count(),
    "sheet_rows": _sheet_rows(),
    "positional_rows": _positional_rows(),
    "sheet_sections": _sections(),
    "snapshot_rows": _json_rows(),
    "published_snapshot": _snapshot(),
    "week_tabs_of_days": _week_tabs(),
    "quarantined_keys": """
      SELECT gate, doc_id, permanent_key FROM (
        SELECT doc_id, permanent_key, unnest(['missing key', 'malformed key', 'repeated key']) AS gate,
          unnest([permanent_key IS NULL, NOT regexp_matches(permanent_key, '^mb-[0-9a-f]{24}$'),
            permanent_key IS NOT NULL AND count(*) OVER (PARTITION BY permanent_key) > 1]) AS offends
        FROM (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 'mb-shared-' || CAST(doc_id % 10 AS STRING)
            WHEN doc_id % 11 = 0 THEN upper('mb-' || md5(CAST(doc_id AS STRING)))
            WHEN doc_id % 13 = 0 THEN 'mb-' || substr(md5(CAST(doc_id AS STRING)), 1, 23)
            WHEN doc_id % 17 <> 0 THEN 'mb-' || substr(md5(CAST(doc_id AS STRING)), 1, 24)
            END AS permanent_key FROM documents)) WHERE offends""",
    "ladder_usage": """
      SELECT track, l.skill_key, tier, count(a.app_id) AS applications FROM ladder l
      LEFT JOIN keyed_apps a ON a.skill_key = l.skill_key GROUP BY ALL""",
    "closure_usage": """
      SELECT c.skill_key, c.matched_key, count(a.app_id) AS applications FROM closure c
      LEFT JOIN keyed_apps a ON a.skill_key = c.matched_key GROUP BY ALL""",
    "skill_keys": "SELECT app_id, gig_id, skill_key FROM keyed_apps",
    "typed_cells": f"""
      SELECT event_id, {to_long('whole_text')} AS whole_text,
        {to_double('whole_text')} AS float_text,
        {to_double("rtrim(" + strip('pct_text') + ", '%')")} AS pct_text,
        {normalized('date_text', ('us12', 'iso'))} AS date_text,
        {clean('free_text')} AS free_text
      FROM raw_sheet""",
    "normalized_datetimes": f"""
      SELECT event_id, {normalized('date_text', ('us12', 'iso'))} AS report_time,
        {normalized('date_text', ('us12', 'us24', 'serial'))} AS outreach_time FROM raw_sheet""",
    "onoff_flags": """
      SELECT event_id, CASE upper(trim(flag_text)) WHEN 'TRUE' THEN 'On' WHEN 'FALSE' THEN 'Off'
        WHEN '' THEN NULL ELSE upper(trim(flag_text)) END AS flag FROM raw_sheet""",
    "cleaned_text": "SELECT event_id, nullif(trim(free_text), '') AS cleaned FROM raw_sheet",
    "published_names": "SELECT " + ", ".join(f"{s} AS {n}" for s, n in PUBLISHED_NAMES.items())
    + " FROM five_report",
    "shift_rollup": "SELECT * FROM shifts",
    "first_five_shifts": "SELECT * REPLACE (CAST(business_shift_number AS INT) AS"
    " business_shift_number) FROM first_five",
    "business_postings": "SELECT business_key, shift_id, location_id, business_name,"
    " count(*) OVER (PARTITION BY business_key) AS total_business_postings FROM shifts",
    "latest_bios": "SELECT * FROM bios",
    "latest_notes": "SELECT * FROM last_notes",
    "confirmed_first_five": "SELECT gig_id AS shift_id, gigster_id AS pro_id, app_id, location_id,"
    " start_time, skill, skill_key FROM confirmed",
    "elevated_applications": "SELECT gig_id, gigster_id, app_id, location_id,"
    " gig_start_time_local, skill_key FROM elevated",
    "upcoming_location_ids": "SELECT * FROM upcoming",
    "paid_history": f"{PAID} history",
    "paid_history_before": f"{PAID} history_before",
    "earlier_experience": "SELECT shift_id, pro_id, qualifying AS"
    " prior_paid_qualifying_skill_shifts, same_place AS"
    " prior_paid_qualifying_skill_shifts_same_business FROM experience",
    "earlier_ratings": "SELECT shift_id, pro_id, position_avg_rating, position_ratings_count"
    " FROM experience",
    "earlier_positions": "SELECT * FROM positions",
    "qualifying_history": "SELECT * FROM qualifying",
    "profile_texts": "SELECT gigster_id AS pro_id, profile_text FROM texts",
    "outreach_with_notes": "SELECT row_key, pro_id, qualification_gap, notes, agent_name FROM vip"
    " LEFT JOIN last_notes USING (row_key)",
    "report_counts": "SELECT count(*) AS report_rows, count(DISTINCT gig_id) AS shifts"
    " FROM confirmed",
    "profile_flags": "SELECT gig_id AS shift_id, gigster_id AS pro_id, profile_flag AS"
    " profile_experience_qualifying_flag FROM evidenced",
    "profile_flags_from_bio": "SELECT gig_id, gigster_id, profile_flag AS"
    " profile_experience_qualifying_flag FROM evidenced_vip",
    "badge_flags": "SELECT gig_id AS shift_id, gigster_id AS pro_id, badge_flag AS"
    " confirmed_skill_badged_flag FROM evidenced",
    "badge_labels": f"SELECT gig_id AS shift_id, gigster_id AS pro_id, {BADGE_LABEL} AS"
    " confirmed_skill_profile_badge_status FROM evidenced",
    "experience_flags": f"""
      SELECT shift_id, pro_id, {yes('qualifying > 0')} AS has_worked_same_skill_before,
        {yes('same_place > 0')} AS repeat_same_skill_at_same_business,
        {yes('profile_flag = 1 OR badge_flag = 1 OR qualifying > 0')}
          AS has_relevant_same_skill_experience
      FROM evidenced JOIN experience ON shift_id = gig_id AND pro_id = gigster_id""",
    "match_sources": f"SELECT gig_id AS shift_id, gigster_id AS pro_id, {MATCH_SOURCE} AS"
    " profile_match_source FROM evidenced",
    "outreach_statuses": f"SELECT app_id, gig_id, {OUTREACH} AS outreach_status FROM applications",
    "qualification_gaps": "SELECT row_key, poor_position_rating, qualification_gap FROM vip",
    "outreach_queue_rows": "SELECT row_key, qualification_gap FROM vip WHERE"
    " poor_position_rating = 'Yes' OR (profile_match_source = 'No match' AND"
    " prior_paid_same_skill_shifts = 0)",
    "hours_to_start": f"SELECT app_id, gig_id, {HOURS} AS hours_to_start FROM applications",
    "distances": f"SELECT app_id, gig_id, {DISTANCE} AS distance_miles FROM applications LEFT JOIN"
    " pro_snapshot ON pro_id = gigster_id",
    "scaled_percentages": "SELECT pro_id, " + ", ".join(
        f"{share(c)} AS {c}_pct"
        for c in ("completion_percentage", "completion_percentage_30", "pro_cancel_percentage_30")
    ) + " FROM pro_snapshot",
    "tri_state_labels": f"SELECT app_id, gig_id, {AUTO_SELECT} AS auto_select_status, {VERIFIED} AS"
    " verified_status FROM applications LEFT JOIN pro_snapshot ON pro_id = gigster_id",
    "row_links": f"SELECT app_id, {ROW_KEY} AS row_key, {LINK} AS shift_url FROM applications",
    "locations_needing_billing": "SELECT * FROM billing WHERE has_payment_information = 'No'",
    "roster_days": "SELECT sheet, name, weekday, code FROM roster_codes",
    "roster_hours": f"""
      SELECT sheet, name, weekday, code, start_hour, end_hour, {twelve_hour('end_hour')} AS until
      FROM (SELECT *, {HOURS24} FROM roster_codes)""",
    "hour_labels": f"SELECT event_id, {twelve_hour('hour(ts)')} AS hour_label FROM events",
    "clock_times": f"SELECT event_id, {clock('clock_text')} AS clock_micros FROM raw_sheet",
    "schedule_segments": f"""
      SELECT event_id, CAST(row_number() OVER (PARTITION BY event_id ORDER BY pos) - 1 AS INT)
        AS segment_no, array_to_string(days, ',') AS days,
        CAST({START_MINUTES} AS BIGINT) AS start_minute, {zone_of('seg')} AS zone
      FROM raw_segments""",
    "segment_days": f"SELECT event_id, array_to_string({day_list('schedule_text')}, ',') AS days"
    " FROM raw_sheet",
    "scheduled_starts": "SELECT event_id, scheduled_start FROM raw_starts",
    "late_clockins": f"""
      SELECT event_id, {lateness('clock_micros')} AS late
      FROM (SELECT event_id, {clock('clock_text')} AS clock_micros FROM raw_sheet)
      JOIN raw_starts USING (event_id)""",
    "open_clockins": "SELECT work_date, full_name, schedule_text AS schedule, clock_in"
    " FROM sessions",
    "week_labels": """
      SELECT event_id, strftime(sunday, '%m/%d') || ' - ' || strftime(sunday + 6, '%m/%d')
        AS week_label, sunday = DATE '2024-01-07' AS in_second_week
      FROM (SELECT event_id, work_date - CAST(isodow(work_date) % 7 AS INT) AS sunday
            FROM raw_sheet)""",
    "gated_shift_links": "SELECT location_name AS business_name, location_id, gig_id AS shift_id,"
    " gig_start_time_local AS shift_date, skill, original_allowed_confirmed_pros AS"
    " requested_pros, current_confirmed_pros_count AS confirmed_pros FROM confirmed",
    "redacted_documents": f"SELECT doc_id, lang, n_chars, md5(regexp_replace(regexp_replace(text,"
    f" '{PHONE}', '', 'g'), '{EMAIL}', '', 'gi')) AS text_md5 FROM documents",
    "pii_scan": rf"""
      SELECT lang, count(*) AS rows, count(*) FILTER (regexp_matches(text, '{PHONE}'))
        AS rows_with_phone,
        count(*) FILTER (regexp_matches(regexp_replace(text, '[\s().-]', '', 'g'), '{PHONE}'))
        AS rows_with_loose_phone,
        count(*) FILTER (len(found) > 0) AS rows_with_email,
        CAST(sum(len(found)) AS BIGINT) AS email_matches
      FROM (SELECT *, regexp_extract_all(text, '(?i){EMAIL}') AS found FROM documents)
      GROUP BY lang""",
    "duplicate_note_keys": "SELECT row_key, count(*) AS copies FROM notes GROUP BY row_key"
    " HAVING count(*) > 1",
    "malformed_keys": """
      SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN upper('mb-' || md5(CAST(doc_id AS STRING)))
        WHEN doc_id % 13 = 0 THEN 'mb-' || substr(md5(CAST(doc_id AS STRING)), 1, 23)
        END AS permanent_key
      FROM documents WHERE doc_id % 11 = 0 OR doc_id % 13 = 0 OR doc_id % 17 = 0""",
    "expected_gigs": """
      SELECT actual_rows, expected_rows, missing, actual_rows = expected_rows AND missing = 0
        AS passed
      FROM (SELECT (SELECT count(DISTINCT gig_id) FROM applications) AS actual_rows,
        (SELECT count(*) FROM gigs) AS expected_rows,
        (SELECT count(*) FROM gigs WHERE id NOT IN (SELECT gig_id FROM applications)) AS missing)
      """,
    "reconciled_counts": """
      SELECT c_custkey AS panel, c_custkey % 12 AS declared, represented,
        c_custkey % 12 = represented AS passed
      FROM (SELECT c_custkey, count(o_orderkey) FILTER (WHERE o_orderkey % 10 <> 0) AS represented
            FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey)""",
    "week_tab_title": """
      SELECT DISTINCT '1/14 - 1/20' AS title FROM raw_sheet
      WHERE work_date BETWEEN DATE '2024-01-14' AND DATE '2024-01-20'""",
    "outreach_sheet_rows": f"""
      SELECT row_key, pro_name, hours_to_start, start_time, pro_id, gig_id, market,
        CAST(NULL AS STRING) AS profile_match_source, notes, agent_name
      FROM (SELECT CASE WHEN is_title THEN 'row_key' ELSE
              CAST(l_orderkey AS STRING) || '-' || CAST(l_suppkey AS STRING) END AS row_key,
            CASE WHEN is_title THEN 'pro_name' ELSE 'Pro ' || CAST(l_suppkey AS STRING) END
              AS pro_name,
            CASE WHEN NOT is_title THEN {to_double('numbers')} END AS hours_to_start,
            CASE WHEN is_title THEN 'start_time' ELSE
              {normalized('dates', ('us12', 'us24', 'serial'))} END AS start_time,
            CASE WHEN NOT is_title THEN l_suppkey END AS pro_id,
            CASE WHEN NOT is_title THEN l_orderkey END AS gig_id,
            CASE WHEN is_title THEN 'market' END AS market
          FROM (SELECT *, min(position) FILTER (WHERE is_title) OVER (PARTITION BY sheet) AS title_at
                FROM (SELECT *, l_orderkey % 500 = 1 AND l_linenumber = 1 AS is_title,
                        year(l_shipdate) AS sheet,
                        (l_orderkey * 10 + l_linenumber) * 10000000 + l_partkey AS position,
                        {Duck().pick(lens_tables.WHOLE_TEXTS, 'l_partkey')} AS numbers,
                        {Duck().pick(lens_tables.DATE_TEXTS, 'l_partkey')} AS dates
                      FROM lineitem
                      UNION ALL BY NAME
                      SELECT true AS is_title, year(l_shipdate) AS sheet,
                        (min(l_orderkey) * 10 + 9) * 10000000 AS position
                      FROM lineitem GROUP BY year(l_shipdate)))
          WHERE position > title_at AND (is_title OR l_linenumber <> 3))
      LEFT JOIN last_notes USING (row_key)""",
    "page_checks": """
      SELECT *, agents_complete AND keys_unique AND keys_opaque AND cards_keyed AND cards_counted
        AND counts_agree AND registry_valid AND no_personal_data AND nothing_forbidden AS passed
      FROM (SELECT c_custkey AS page_id,
        c_custkey % 7 <> 0 AND c_custkey % 29 <> 0 AS agents_complete,
        c_custkey % 5 <> 0 AS keys_unique,
        c_custkey % 4 <> 1 AS keys_opaque,
        c_custkey % 4 <> 1 AS cards_keyed,
        c_custkey % 17 <> 0 AS cards_counted,
        c_custkey % 11 <> 0 AND c_custkey % 3 = CASE WHEN c_custkey % 17 = 0 THEN 0
          ELSE c_custkey % 4 END + CASE WHEN c_custkey % 4 = 1 THEN 2 ELSE 0 END AS counts_agree,
        c_custkey % 6 <> 0 AND c_custkey % 9 <> 0 AND c_custkey % 10 <> 0 AS registry_valid,
        c_custkey % 13 NOT IN (0, 1) AND c_custkey % 12 <> 6 AS no_personal_data,
        c_custkey % 13 NOT IN (2, 3) AS nothing_forbidden
      FROM customer)""",
    "emptied_pages": """
      SELECT page_id, page_id % 8 = 0 AS review_rows_empty, page_id % 12 = 5 AS outreach_rows_empty,
        page_id % 13 IN (0, 1) AS blocked,
        CASE WHEN page_id % 13 NOT IN (0, 1) THEN md5(regexp_replace(
          replace(html, '[[' || CAST(page_id AS STRING) || '],[0]];', '[];'),
          'OUTREACH_ROWS = .*;', 'OUTREACH_ROWS = [];')) END AS page_md5
      FROM markup""",
    "forbidden_phrases": "SELECT doc_id, array_to_string(found, '|') AS found FROM (SELECT doc_id,"
    " [p FOR p IN ["
    + ", ".join(
        [f"CASE WHEN contains(text, {literal(p)}) THEN {literal(p)} END" for p in EXACT_PHRASES]
        + [f"CASE WHEN text ILIKE {literal('%' + p + '%')} THEN {literal(p)} END"
           for p in ANY_CASE_PHRASES]
    )
    + "] IF p IS NOT NULL] AS found FROM documents) WHERE len(found) > 0",
    "attribute_values": """
      SELECT page_id, CAST(unnest(range(len(hits))) AS INT) AS position, unnest(hits) AS value
      FROM (SELECT page_id, regexp_extract_all(html, 'href="([^"]+)"', 1) AS hits FROM pages)""",
}

STATEMENTS["agents_one_day"] = (
    f"SELECT * FROM ({STATEMENTS['agents_on_shift']}) WHERE work_date = DATE '2024-01-22'"
)

ORACLE = {name: with_views(body) for name, body in STATEMENTS.items()}
