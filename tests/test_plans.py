"""What the physical plans must and must not contain."""

from __future__ import annotations

from datetime import datetime

import pytest

from crewlens.operators.candidates import elevated_shifts, historical_paid
from crewlens.operators.ranking import first_shifts, shift_level
from crewlens.plans.qualification import first_five_qualification
from fieldlens.queries import AS_OF, QUERIES
from fieldlens.tables import lens

UNWANTED = [
    "CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
    "MapInPandas", "FlatMapGroupsInPandas", "PythonUDF",
]


def plan(spark, df, mode="FORMATTED"):
    explain_mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
    return df._jdf.queryExecution().explainString(explain_mode)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pairing_and_no_python(spark, sf_dir, name):
    text = plan(spark, QUERIES[name](spark, sf_dir))
    assert not [word for word in UNWANTED if word in text]


@pytest.fixture(scope="module")
def warehouse(spark, sf_dir, tmp_path_factory):
    from crewlens.sources.tables import TABLES, load

    folder = str(tmp_path_factory.mktemp("warehouse"))
    tables = lens(spark, sf_dir)
    for name in TABLES:
        tables[name].write.parquet(f"{folder}/{name}.parquet")
    return load(spark, folder)


def test_filters_and_columns_reach_the_scan(spark, warehouse):
    text = plan(spark, historical_paid(warehouse["applications"], AS_OF))
    assert "EqualTo(is_paid,1)" in text
    assert "Or(IsNull(is_canceled),EqualTo(is_canceled,0))" in text
    assert "LessThan(gig_start_time_local,1997-01-01T12:00)" in text
    assert "market" not in text and "location_address_latitude" not in text


def test_elevated_window_reaches_the_scan(spark, warehouse):
    text = plan(
        spark,
        elevated_shifts(warehouse["applications"], warehouse["locations"], datetime(1997, 1, 1), 3),
    )
    assert "GreaterThanOrEqual(gig_start_time_local,1997-01-01T00:00)" in text
    assert "LessThan(gig_start_time_local,1997-01-04T00:00)" in text
    assert "EqualTo(currently_elevated_status,VIP)" in text


def test_ranking_is_limited_before_the_shuffle(spark, warehouse):
    text = plan(spark, first_shifts(shift_level(warehouse["applications"], warehouse["gigs"])))
    assert "Partial" in text and text.count("WindowGroupLimit") >= 2


def test_report_from_stored_tables_matches_the_lens(spark, sf_dir, warehouse):
    from tests.support import spark_table

    stored = spark_table(first_five_qualification(warehouse, AS_OF))
    assert stored == spark_table(first_five_qualification(lens(spark, sf_dir), AS_OF))


def scans(spark, build, table):
    """Scans of a table that are planned, with exchanges reused."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return plan(spark, build(), "SIMPLE").count(f"/{table}.parquet]")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_report_reads_the_applications_three_times(spark, warehouse):
    """Twice for the candidates, which are written once, and once for the history of their pros."""
    from crewlens.plans.qualification import first_shift_candidates

    assert scans(spark, lambda: first_shift_candidates(warehouse, AS_OF), "applications") == 2
    assert scans(spark, lambda: first_five_qualification(warehouse, AS_OF), "applications") == 1


def test_lines_of_sheets_are_scanned_once(spark, tmp_path):
    """The plan reads written lines, never the files; nothing is split into lines again for headers."""
    from crewlens.plans.sheets import payment_sheet
    from crewlens.sources.sheets import read_rows

    titles = "location_id,location_name,approval_status,has_payment_information,payment_information_scope"
    (tmp_path / "a.csv").write_text(f'{titles}\n1,"x\ny",ok,Yes,z\n')
    df = payment_sheet(read_rows(spark, str(tmp_path)))
    text = plan(spark, df)
    assert "a.csv" not in text and "Scan text" not in text
    assert [tuple(r) for r in df.collect()] == [(1, "x\ny", "ok", "Yes", "z")]


def test_no_job_runs_while_gated_plans_are_built(spark, sf_dir):
    names = ["agents_one_day", "gated_shift_links", "open_clockins"]
    for name in names:
        QUERIES[name](spark, sf_dir)  # the test tables' schemas are read once
    spark.sparkContext.setJobGroup("building", "")
    try:
        for name in names:
            QUERIES[name](spark, sf_dir)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert list(jobs) == []


def test_repeated_keys_alone_are_shuffled(spark):
    """One key in a thousand repeats: the keys' shuffle gets only rows whose hash slot repeats."""
    from crewlens.operators import bitmaps, quality

    df = spark.range(20_000).selectExpr("CASE WHEN id % 1000 = 0 THEN 'twice' ELSE CAST(id AS STRING) END AS key")
    assert [tuple(r) for r in quality.duplicate_keys(df, "key").collect()] == [("twice", 20)]
    assert bitmaps.may_repeat(df, "key").count() < 60
    counts = {r.key: r.copies for r in quality.with_copies(df.limit(3).union(df.filter("key = 'twice'")), "key").collect()}
    assert counts["1"] == 1 and counts["twice"] == 21


def test_laid_out_history_is_pruned_and_not_shuffled(spark, warehouse, tmp_path):
    """Periods after the moment are not read, and the latest row per pro and gig needs no exchange."""
    import uuid

    from crewlens.sources.layout import applications_of, paid_history_before, write_applications
    from tests.support import spark_table

    apps, table = warehouse["applications"], f"laid_out_{uuid.uuid4().hex}"
    some = apps.filter("gig_start_time_local >= '1996-11-10' AND gig_start_time_local < '1997-02-20'").cache()
    write_applications(some, table, str(tmp_path / "apps"), 4)
    try:
        df = paid_history_before(spark, table, AS_OF)
        text = plan(spark, df)
        assert "PartitionFilters: [isnotnull(start_period" in text and "<= 1997-01-01)" in text
        assert "Exchange" not in text and "Bucketed: true" in text
        assert spark_table(df) == spark_table(historical_paid(some, AS_OF)) and df.count() > 20
        since = datetime(1996, 12, 30, 5)
        kept = some.filter("gig_start_time_local >= '1996-12-30 05:00:00'")
        assert spark_table(applications_of(spark, table, since=since)) == spark_table(kept)
    finally:
        some.unpersist()
        spark.sql(f"DROP TABLE {table}")
