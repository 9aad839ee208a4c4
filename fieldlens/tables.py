"""Lens tables as one list of formulas per table, written once for both engines."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from crewlens.functions.vocabulary import BADGES, SKILL_ALIASES, SKILL_PHRASES
from crewlens.sources.tables import load

from .dialect import Duck, Spark

SKILL_LABELS = [
    *SKILL_PHRASES,
    *[spelling for spellings in SKILL_ALIASES.values() for spelling in spellings],
    "  Line Cook ", "EVENT CHEF", "Bartender", "line_cook", "sommelier", "", None, "Stage ",
]
PROFILE_TEXTS = [
    "Event Chef for large weddings", "worked as banquet chef and prep cook", None,
    "Full-Service Bartender, weekend events", "beer & wine bartender at the stadium",
    "bartender", "Housekeeper and cleaner", "front of house, coat check", "",
    "line cook / food prep", "barista, bakery counter", "server assistant", "stage hand",
    "Cafeteria and dishwashing", "event staff; concession stands", "MIXOLOGIST",
    "general labor on building sites", "bartender - fixed menu", "no restaurant work yet",
    "Event Setup crew", "restaurant server for ten years", "sommelier", "food runner",
]
CLOCK_INS = [
    "22:00:00", "22:00:00.000001", "21:59:59.999999", "23:58:01.186000", "00:02:00", "UTO",
    "9:05 PM", "Leave", "7:31", "12:00 AM", "13:05 PM", "24:00", "", "19:00", "20:00:30.5",
    "08:15:00 am", "7:61",
]
SCHEDULES = [
    "Monday - Friday 10:00 AM - 07:00 PM EST",
    "Monday-Tuesday 12 PM - 09 PM | Wednesday - Friday 10:00 AM - 7:00 PM EST",
    "Schedule pending",
    "Mon,Thur, Fri: 08:00 AM - 05:00 PM EST | Tue - Wed: 07:00 AM - 04:00 PM EST",
    "Thursday - Monday 07:00 AM - 04:00 PM EST",
    "Monday - Friday 10:00 PM - 7:00 AM MNL",
    "Sat - Sun 9 AM - 6 PM | Mon - Fri, Sun 8:30 am - 5 pm ET",
    "Mon-Mon 13:00 PM - 2 PM EST | Mon 9 AM - 5 PM EST",
    "tues 06:15 PM - 11 PM",
    "Sunday - Saturday 11:30 PM - 08:00 AM PHT",
    "",
]
SHIFT_CODES = ["12-9", "7-12", "OFF", "1-10", "", "x", "11-8", "6-3", " 9-6 ", "off", "10-7"]
WHOLE_TEXTS = ["12.9", "-12.9", "", "n/a", "1d", " 42 ", "7", "1e3", "+.5", "1_000"]
PCT_TEXTS = ["98.5%", "100 %", "", "%", "-3%%", "n/a", "12", " 0.5% "]
DATE_TEXTS = [
    "7/22/2026 5:30 PM", "2026-07-22 7:00:00", "2026-07-22", "12/1/2026 12:05 AM",
    "1/2/2026 3:04:05", "46225.5", "soon", "", "13/45/2026 1:00 pm", " 45292 ",
    "2026-07-22 17:05", "45292.999995",
]
FLAG_TEXTS = ["TRUE", "false", " True ", "", "maybe", "FALSE"]
NOTE_TEXTS = ["left voicemail", " will call back ", "", "texted", "número equivocado", "no answer"]


def _applications(d) -> list[str]:
    local = f"o_orderdate + {d.minutes('(l_orderkey % 96) * 15 - 300')}"
    return [
        "CAST((l_linenumber * 100 + CAST(l_quantity AS INT)) AS BIGINT) * 1000000 + l_partkey"
        " AS app_id",
        "l_orderkey AS gig_id",
        "CASE WHEN l_partkey % 97 <> 0 THEN l_suppkey END AS gigster_id",
        "CASE WHEN l_orderkey % 53 <> 0 THEN o_custkey END AS location_id",
        "CASE WHEN l_orderkey % 7 = 0 THEN ' ' || upper(c_mktsegment) ELSE c_mktsegment END"
        f" || ' Venue ' || CAST({d.div('o_custkey', 2)} AS STRING) AS location_name",
        "n_name AS market",
        f"{d.pick(SKILL_LABELS, 'l_partkey')} AS skill",
        f"{d.pick(['standard', 'private', 'contract'], 'l_orderkey')} AS gig_type",
        f"{d.pick(['auto', 'manual', None], 'l_suppkey')} AS selection_source",
        f"o_orderdate - {d.days('l_orderkey % 30')} AS gig_creation_time",
        f"{local} AS gig_start_time_local",
        f"o_orderdate + {d.minutes('(l_orderkey % 96) * 15')} AS start_time",
        f"CASE WHEN l_linenumber % 5 <> 0 THEN o_orderdate - {d.days('l_partkey % 20')} END"
        " AS confirmation_timestamp",
        "CASE WHEN l_linenumber <> 7 THEN l_shipdate END AS rating_timestamp",
        "CAST(l_quantity AS INT) AS original_allowed_confirmed_pros",
        "l_linenumber AS current_confirmed_pros_count",
        "CASE l_partkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS gig_auto_select_enabled",
        "CASE WHEN l_partkey % 41 <> 0 THEN l_linestatus = 'O' END AS is_confirmed",
        "CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 0 END AS is_canceled",
        "CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS is_paid",
        "CASE WHEN l_quantity < 10 THEN NULL WHEN l_quantity < 25 THEN 0 ELSE 1 END AS outreached",
        "CASE WHEN l_quantity >= 40 THEN 1 WHEN l_quantity >= 30 THEN 0 END"
        " AS outreach_pro_response",
        "CAST(l_linenumber - 1 AS DOUBLE) + CAST(l_partkey % 2 AS DOUBLE) / 2 AS rating",
        "CASE WHEN o_custkey % 19 <> 0 THEN 25 + CAST(o_custkey * 37 % 2400 AS DOUBLE) / 100 END"
        " AS location_address_latitude",
        "CAST(o_custkey * 53 % 4500 AS DOUBLE) / 100 - 120 AS location_address_longitude",
    ]


def _snapshot(d) -> list[str]:
    badges = [
        f"CASE s_suppkey % {5 + i % 11} WHEN 0 THEN 1 WHEN 1 THEN NULL ELSE 0 END AS cert_{name}"
        for i, name in enumerate(BADGES)
    ]
    return [
        "s_suppkey + CASE WHEN s_suppkey % 11 = 3 THEN 1000000 ELSE 0 END AS pro_id",
        "s_name AS full_name",
        "'+1' || CAST(5550000000 + s_suppkey AS STRING) AS phone_number",
        f"{d.pick(PROFILE_TEXTS, 's_suppkey * 3')} AS experience",
        "CASE s_suppkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS verified_pro",
        "CAST(s_suppkey % 41 AS DOUBLE) / 8 AS avg_rating",
        "CAST(s_suppkey % 90 AS INT) AS ratings",
        "CAST(s_suppkey % 101 AS DOUBLE) / 100 AS completion_percentage",
        "CASE WHEN s_suppkey % 4 <> 0 THEN CAST(s_suppkey % 57 AS DOUBLE) / 64 END"
        " AS completion_percentage_30",
        "CAST(s_suppkey % 300 AS INT) AS paid_gigs",
        "CAST(s_suppkey % 6 AS INT) AS pro_cancelled_gigs_30",
        "CAST(s_suppkey % 13 AS DOUBLE) / 16 AS pro_cancel_percentage_30",
        "CAST(s_suppkey % 3 AS INT) AS no_show_gigs_last_30",
        "CASE WHEN s_suppkey % 10 <> 0 THEN 25 + CAST(s_suppkey * 31 % 2400 AS DOUBLE) / 100 END"
        " AS pro_last_lat",
        "CASE WHEN s_suppkey % 12 <> 0 THEN CAST(s_suppkey * 59 % 4500 AS DOUBLE) / 100 - 120 END"
        " AS pro_last_long",
        f"{d.stamp('1996-12-01 00:00:00')} + {d.minutes('s_suppkey * 37')} AS pro_last_on",
        *badges,
    ]


def _profiles(d) -> list[str]:
    return [
        "s_suppkey * 3 + version AS id",
        "s_suppkey AS user_id",
        f"{d.pick(PROFILE_TEXTS, 's_suppkey * 5 + version * 7')} AS bio",
        "CASE WHEN (s_suppkey + version) % 5 <> 0 THEN"
        f" {d.stamp('1996-01-01 00:00:00')} + {d.days('(s_suppkey * 7 + version * 11) % 4')} END"
        " AS last_updated_ts",
        "CASE (s_suppkey + version) % 6 WHEN 0 THEN true WHEN 1 THEN NULL ELSE false END"
        " AS deleted",
    ]


def titled(group: str) -> str:
    """The events, and after the first of each group a title row: every sheet has its header."""
    return (
        "(SELECT event_id * 2 AS line, event_id, user_id, ts, false AS title FROM events UNION ALL"
        " SELECT min(event_id) * 2 + 1, min(event_id), max(user_id), min(ts), true FROM events"
        f" GROUP BY {group}) AS e"
    )


def _roster(d) -> list[str]:
    codes = [d.pick(SHIFT_CODES, f"event_id * 3 + {i} * 5") for i in range(7)]
    header = ["'Name'", *[literal_day(i) for i in range(7)]]
    name = (
        "CASE WHEN event_id % 29 = 0 THEN ' ' ELSE ' Agent ' || CAST(user_id AS STRING) END"
    )
    blank = ["'TEAM'", *["''"] * 7]
    return [
        "CAST(CAST(ts AS DATE) AS STRING) AS sheet",
        f"{d.div('line', 1000)} AS block",
        "line",
        f"CASE WHEN title OR event_id % 131 = 7 THEN {d.array(header)}"
        f" WHEN event_id % 37 = 0 THEN {d.array(blank)}"
        f" ELSE {d.array([name, *codes])} END AS cells",
    ]


def literal_day(i: int) -> str:
    from crewlens.functions.vocabulary import WEEKDAYS

    return f"'{WEEKDAYS[i]}'"


def _clockins(d) -> list[str]:
    sunday = d.sunday("CAST(ts AS DATE)")
    header = ["''", "'Name'", "'Schedule'"]
    cells = ["''", "'Full ' || CAST(user_id AS STRING)", d.pick(SCHEDULES, "event_id * 3")]
    for i in range(7):
        header += [d.mdy(d.add_days(sunday, i)), "''"]
        out = f"CASE WHEN (event_id + {i}) % 3 = 0 THEN '' ELSE '17:00' END"
        cells += [d.pick(CLOCK_INS, f"event_id * 7 + {i}"), out]
    return [
        f"CAST({sunday} AS STRING) AS sheet",
        f"{d.div('line', 1000)} AS block",
        "line",
        f"CASE WHEN title OR event_id % 211 = 11 THEN {d.array(header)} ELSE {d.array(cells)} END AS cells",
    ]


def _aliases(d) -> list[str]:
    return [
        "'Agent ' || CAST(user_id AS STRING) AS name",
        "'Full ' || CAST(user_id + CASE WHEN user_id % 9 = 0 THEN 1000000 ELSE 0 END AS STRING)"
        " AS full_name",
    ]


def _notes(d) -> list[str]:
    return [
        "CASE WHEN l_linenumber = 6 THEN ' ' ELSE"
        " CAST(l_orderkey AS STRING) || '-' || CAST(l_suppkey AS STRING) END AS row_key",
        f"{d.pick(NOTE_TEXTS, 'l_partkey')} AS notes",
        "'Agent ' || CAST(l_linenumber AS STRING) AS agent_name",
        "(l_partkey * 100 + l_linenumber) * 100 + CAST(l_quantity AS INT) AS row_no",
    ]


def _raw_sheet(d) -> list[str]:
    return [
        "event_id",
        f"{d.pick(WHOLE_TEXTS, 'event_id')} AS whole_text",
        f"{d.pick(PCT_TEXTS, 'event_id')} AS pct_text",
        f"{d.pick(DATE_TEXTS, 'event_id')} AS date_text",
        f"{d.pick(FLAG_TEXTS, 'event_id')} AS flag_text",
        "CASE WHEN event_id % 5 = 0 THEN '  ' ELSE ' ' || event_type || ' ' END AS free_text",
        f"{d.pick(CLOCK_INS, 'event_id')} AS clock_text",
        f"{d.pick(SCHEDULES, 'event_id')} AS schedule_text",
        f"{d.pick(SHIFT_CODES, 'event_id')} AS code_text",
        "CAST(ts AS DATE) AS work_date",
    ]


def _locations(d) -> list[str]:
    return [
        "c_custkey AS location_id",
        f"c_mktsegment || ' Venue ' || CAST({d.div('c_custkey', 2)} AS STRING) AS location_name",
        f"{d.pick(['approved', 'pending', None], 'c_custkey')} AS approval_status",
        "CASE c_mktsegment WHEN 'BUILDING' THEN 'VIP' WHEN 'MACHINERY' THEN 'NEW' END"
        " AS currently_elevated_status",
    ]


def _location_billing(d) -> list[str]:
    sources = ["LOCATION", "location", "ORGANIZATION", None, "other", "Organization"]
    return [
        "c_custkey AS id",
        f"{d.pick(sources, 'c_custkey')} AS billing_source",
        "CASE WHEN c_custkey % 7 > 2 THEN 'cus_' || CAST(c_custkey AS STRING) END"
        " AS billing_customer_id",
        "CASE WHEN c_custkey % 17 <> 0 THEN c_nationkey END AS organization_id",
    ]


def _markup(d) -> list[str]:
    def key(source: str) -> str:
        return f"'mb-' || substr(md5({source}), 1, 24)"

    own, other = key("CAST(c_custkey AS STRING)"), key("c_name")
    quote = "chr(39)"
    parts = [
        """'<div data-agent="north"></div>'""",
        """CASE WHEN c_custkey % 7 = 0 THEN '<b data-agent="east">'
           WHEN c_custkey % 29 = 0 THEN '' ELSE '<b data-agent="south">' END""",
        f"""'<article class="support-open" data-permanent-key="' || {own} || '" '""",
        """CASE WHEN c_custkey % 17 = 0 THEN '>' ELSE
           'data-support-count="' || CAST(c_custkey % 4 AS STRING) || '">' END""",
        """CASE WHEN c_custkey % 4 = 1 THEN '<article class="support-open" '
           || 'data-permanent-key="mb-x" data-support-count="2">' ELSE '' END""",
        f"""'<p data-permanent-key="' ||
           CASE WHEN c_custkey % 5 = 0 THEN {own} ELSE {other} END || '">'""",
        """CASE WHEN c_custkey % 11 = 0 THEN '' ELSE '<section class="support-panel" '
           || 'data-live-open="' || CAST(c_custkey % 3 AS STRING) || '">' END""",
        f"""CASE WHEN c_custkey % 6 = 0 THEN '' ELSE
           'const recordedPermanentRemovalKeys=new Set([' || {quote} || {own} || {quote} || ','
           || {quote} || CASE WHEN c_custkey % 9 = 0 THEN {own} WHEN c_custkey % 10 = 0
           THEN 'mb-1' ELSE {other} END || {quote} || ']);' END""",
        """CASE c_custkey % 13 WHEN 0 THEN 'call +15551234567' WHEN 1 THEN 'me@example.org'
           WHEN 2 THEN 'Catch-Up mode' WHEN 3 THEN 'http://localhost:3000' ELSE '' END""",
        "CASE WHEN c_custkey % 8 = 0 THEN 'const REVIEW_ROWS = [];'"
        " ELSE 'const REVIEW_ROWS = [[' || CAST(c_custkey AS STRING) || '],[0]];' END",
        "CASE WHEN c_custkey % 12 = 5 THEN 'const OUTREACH_ROWS = [];'"
        " WHEN c_custkey % 12 = 6 THEN 'const OUTREACH_ROWS = [[\"+15557654321\"]];'"
        " ELSE 'const OUTREACH_ROWS = [[7]];' END",
    ]
    return ["c_custkey AS page_id", f"{' || '.join(parts)} AS html"]


CUSTOMER_JOIN = " JOIN customer ON o_custkey = c_custkey"
APPLICATION_JOIN = (
    f"lineitem JOIN orders ON l_orderkey = o_orderkey{CUSTOMER_JOIN}"
    " JOIN nation ON c_nationkey = n_nationkey"
)

DEFINITIONS = {
    "applications": (_applications, APPLICATION_JOIN),
    "gigs": (
        lambda d: [
            "o_orderkey AS id",
            "CASE WHEN o_orderstatus = 'P' THEN 'CANCELLED' WHEN o_orderkey % 61 <> 0 THEN"
            " o_orderstatus END AS status",
        ],
        "orders",
    ),
    "locations": (_locations, "customer"),
    "location_billing": (_location_billing, "customer"),
    "organizations": (
        lambda d: [
            "n_nationkey AS id",
            "CASE WHEN n_nationkey % 2 <> 0 THEN 'org_' || CAST(n_nationkey AS STRING) END"
            " AS billing_customer_id",
        ],
        "nation",
    ),
    "pro_snapshot": (_snapshot, "supplier"),
    "profiles": (_profiles, None),
    "roster": (_roster, lambda d: titled("CAST(ts AS DATE)")),
    "clockins": (_clockins, lambda d: titled(d.sunday("CAST(ts AS DATE)"))),
    "aliases": (_aliases, "(SELECT DISTINCT user_id FROM events) AS u"),
    "notes": (_notes, "lineitem"),
    "raw_sheet": (_raw_sheet, "events"),
    "markup": (_markup, "customer"),
}


def _statement(name: str, dialect) -> str:
    formulas, source = DEFINITIONS[name]
    if callable(source):
        source = source(dialect)
    if name == "profiles":
        source = f"(SELECT s_suppkey, {dialect.each(3)} AS version FROM supplier) AS v"
    return f"SELECT {', '.join(formulas(dialect))} FROM {source}"


BASE_TABLES = (
    "nation", "customer", "supplier", "orders", "lineitem", "events",
)


_SCHEMAS: dict[str, dict[str, StructType]] = {}
_ROWS: dict[tuple[str, str], int] = {}

# Rows of both sides that a task of the applications' join sorts, and rows from which it is dealt so;
# fewer are left to adaptive execution, which sizes tasks by compressed bytes, many rows each.
JOINED_ROWS, FEW_JOINED_ROWS = 500_000, 4_000_000
# Customers from which their join with the orders is dealt so as well; fewer may be broadcast.
FEW_CUSTOMERS = 5_000_000
# Customers that a task makes pages of: a page is some hundred times as long as its customer in the file.
PAGES = 20_000


def base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its schema is read from the file once, as the tables never change."""
    known = _SCHEMAS.setdefault(sf_dir, {})
    if name not in known:
        known[name] = load(spark, sf_dir, [name])[name].schema
    return load(spark, sf_dir, [name], known)[name]


def row_count(spark: SparkSession, sf_dir: str, name: str) -> int:
    """The rows of a test table, by the files' footers, counted once."""
    if (sf_dir, name) not in _ROWS:
        _ROWS[sf_dir, name] = base(spark, sf_dir, name).count()
    return _ROWS[sf_dir, name]


def many_applications(spark: SparkSession, sf_dir: str) -> bool:
    return sum(row_count(spark, sf_dir, table) for table in ("lineitem", "orders")) > FEW_JOINED_ROWS


def joined_parts(spark: SparkSession, sf_dir: str, names: Iterable[str]) -> int:
    """Partitions for a join of these tables, as many as there are shuffle partitions at least: a join deals its sides
    anew if they have fewer, and adaptive execution then no longer knows the dealt rows again and deals them twice."""
    parts = -(-sum(row_count(spark, sf_dir, table) for table in names) // JOINED_ROWS)
    return max(parts, int(spark.conf.get("spark.sql.shuffle.partitions")))


def with_customers(spark: SparkSession, sf_dir: str, used: dict[str, DataFrame]) -> DataFrame:
    """The orders with their customers. They meet before the line items do: customers that are too many to be
    broadcast would otherwise have the whole applications dealt by customer, in tasks sized by bytes."""
    sides = {"orders": "o_custkey", "customer": "c_custkey"}
    orders, customers = (used[table] for table in sides)
    if row_count(spark, sf_dir, "customer") > FEW_CUSTOMERS:
        parts = joined_parts(spark, sf_dir, sides)
        orders, customers = (used[table].repartition(parts, key) for table, key in sides.items())
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))


def dealt(spark: SparkSession, sf_dir: str, name: str, used: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The test tables of a lens table, all rows of them, in as many partitions as their rows need."""
    if name == "applications" and many_applications(spark, sf_dir):
        keys = {"lineitem": "l_orderkey", "orders": "o_orderkey"}
        parts = joined_parts(spark, sf_dir, keys)
        found = used | {"orders": with_customers(spark, sf_dir, used)}
        return found | {table: found[table].repartition(parts, key) for table, key in keys.items()}
    if name == "markup" and (parts := -(-row_count(spark, sf_dir, "customer") // PAGES)) > 1:
        return used | {"customer": used["customer"].repartition(parts)}
    return used


class Lens(Mapping):
    """The lens tables by name, each built as a lazy DataFrame when asked for.

    Sheet tables get row_no = struct(block, line).
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir = spark, sf_dir
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._build(name)
        return self._built[name]

    def __iter__(self):
        return iter(DEFINITIONS)

    def __len__(self):
        return len(DEFINITIONS)

    def _build(self, name: str) -> DataFrame:
        statement, used = _statement(name, Spark()), {}
        for table in BASE_TABLES:
            named = re.sub(rf"\b(FROM|JOIN) {table}\b", rf"\1 {{{table}}}", statement)
            if named != statement:
                statement, used[table] = named, base(self._spark, self._dir, table)
        if name == "applications" and many_applications(self._spark, self._dir):
            statement = statement.replace(CUSTOMER_JOIN.replace("customer", "{customer}"), "")
        df = self._spark.sql(statement, **dealt(self._spark, self._dir, name, used))
        if name in ("roster", "clockins"):
            df = df.selectExpr(
                "sheet", "named_struct('block', block, 'line', line) AS row_no", "cells"
            )
        return df


def lens(spark: SparkSession, sf_dir: str) -> Lens:
    return Lens(spark, sf_dir)


def lens_sql(*names: str) -> str:
    """The same tables as the head of a DuckDB WITH clause."""
    parts = [f"{name} AS ({_statement(name, Duck())})" for name in names]
    return "WITH " + ", ".join(parts)
