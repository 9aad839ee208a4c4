"""Refresh jobs end to end on small exports: what is published, and what a failing gate leaves."""

from __future__ import annotations

import csv
import io
import json
from datetime import date, datetime

import pytest

from crewlens.operators.quality import GateError
from crewlens.plans import refresh
from crewlens.plans.billing import PAYMENT_COLUMNS
from crewlens.plans.qualification import PUBLISHED_NAMES, SHIFT_LINK_COLUMNS
from crewlens.plans.sheets import SECTION_HEADERS
from crewlens.sources.publish import latest_manifest
from crewlens.sources.sheets import read_rows

AS_OF, LATER = datetime(2026, 1, 1), datetime(2026, 1, 2)


def sheet(spark, folder, name, rows):
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows(rows)
    (folder / name).write_text(out.getvalue())
    return read_rows(spark, str(folder / name))


def published(spark, path, name):
    table = latest_manifest(spark, path)["tables"][name]
    return [json.loads(r.value) for r in spark.read.text(table["folder"]).collect()]


def sections(filled=True):
    rows = []
    for titles in SECTION_HEADERS.values():
        rows += [["", *titles], *([["", *(f"{i}" for i in range(len(titles)))]] if filled else []), [""]]
    return rows


def test_dashboard(spark, tmp_path):
    path = str(tmp_path / "out")
    links = sheet(spark, tmp_path, "l.csv", [SHIFT_LINK_COLUMNS, ["Biz", "5", "6", "7/22/2026 5:30 PM", "server", "2", "1"]])
    pay = sheet(spark, tmp_path, "p.csv", [PAYMENT_COLUMNS, ["5", "Biz", "ok", "Yes", "Location account"]])
    pros = sheet(spark, tmp_path, "q.csv", [list(PUBLISHED_NAMES), ["Biz", "5", "6", "7/22/2026"]])
    full = sheet(spark, tmp_path, "s.csv", sections())
    refresh.refresh_dashboard(full, links, pay, pros, path, AS_OF)
    assert published(spark, path, "PAYMENT_ROWS") == [[5, "Biz", "ok", "Yes", "Location account"]]
    assert published(spark, path, "SEC1") == [[str(i) for i in range(len(SECTION_HEADERS["SEC1"]))]]
    assert published(spark, path, "REVIEW_ROWS") == published(spark, path, "OUTREACH_ROWS") == []
    before = latest_manifest(spark, path)
    hollow = sheet(spark, tmp_path, "e.csv", sections(filled=False))
    with pytest.raises(GateError, match="SEC1 is empty"):
        refresh.refresh_dashboard(hollow, links, pay, pros, path, LATER)
    told = sheet(spark, tmp_path, "t.csv", [PAYMENT_COLUMNS, ["5", "ask a@b.org", "ok", "Yes", "x"]])
    with pytest.raises(GateError, match="personal data in PAYMENT_ROWS"):
        refresh.refresh_dashboard(full, links, told, pros, path, LATER)
    assert latest_manifest(spark, path) == before


def test_outreach_may_be_empty_but_shifts_may_not(spark, tmp_path):
    path = str(tmp_path / "out")
    shifts = sheet(spark, tmp_path, "v.csv", [["id", "x"], ["9", "46225.5", "NY", "", "", "true", "3"]])
    queue = sheet(spark, tmp_path, "o.csv", [["row_key", "pro_id", "start_time"], ["1-2", "7", "1/2/2026 3:04:05"]])
    notes = sheet(spark, tmp_path, "n.csv", [["Row_Key", "Notes", "Agent Name"], ["1-2", "called", "Ann"]])
    refresh.refresh_outreach(shifts, queue, notes, path, AS_OF)
    (row,) = published(spark, path, "OUTREACH_ROWS")
    assert row[-2:] == ["called", "Ann"] and row[0] == "1-2"
    nobody = sheet(spark, tmp_path, "o2.csv", [["row_key", "pro_id", "start_time"]])
    refresh.refresh_outreach(shifts, nobody, notes, path, LATER)
    assert published(spark, path, "OUTREACH_ROWS") == []
    with pytest.raises(GateError, match="SHIFT_ROWS is empty"):
        refresh.refresh_outreach(sheet(spark, tmp_path, "v2.csv", [["id", "x"]]), queue, notes, path, LATER)


def test_housekeeping(spark, tmp_path):
    names = [n for n in PUBLISHED_NAMES.values() if not n.startswith("position_")]
    path = str(tmp_path / "out")
    refresh.refresh_housekeeping(sheet(spark, tmp_path, "h.csv", [names, ["Biz"]]), path, AS_OF)
    assert len(published(spark, path, "ROWS")) == 1
    with pytest.raises(GateError, match="ROWS is empty"):
        refresh.refresh_housekeeping(sheet(spark, tmp_path, "h2.csv", [names]), path, LATER)


def test_agents_of_one_day(spark, tmp_path):
    day = date(2026, 8, 17)
    roster = sheet(spark, tmp_path, "r.csv", [["Name", *"MTWTFSS"], ["North", "12-9", *["OFF"] * 6], ["South", "12-9", *["OFF"] * 6]])
    clock = sheet(spark, tmp_path, "c.csv", [["", "", "", "8/17/26", ""], ["", "Ann Lee", "Monday - Friday 10:00 AM - 07:00 PM EST", "22:00:00.000001", ""]])
    aliases = spark.createDataFrame([("North", "Ann Lee"), ("South", "Bob Ray")], "name string, full_name string")
    path = str(tmp_path / "out")
    refresh.refresh_agents(roster, clock, aliases, "Asia/Manila", day, path, AS_OF)
    (row,) = published(spark, path, "AGENT_STATUS")
    assert row[0] == "North" and row[2] is True
    with pytest.raises(GateError, match="date column 2026-08-18"):
        refresh.refresh_agents(roster, clock, aliases, "Asia/Manila", date(2026, 8, 18), path, LATER)
    headless = sheet(spark, tmp_path, "r2.csv", [["North", "12-9", *["OFF"] * 6]])
    with pytest.raises(Exception, match="the row 'Name' is missing in sheet .*r2.csv"):
        refresh.refresh_agents(headless, clock, aliases, "Asia/Manila", day, path, LATER)


def test_offending_rows_are_quarantined(spark, tmp_path):
    """Each gate is counted in the write; offenders stand apart, and a later run changes no older manifest."""
    from pyspark.sql import functions as F

    from crewlens.sources.publish import publish_tables, read_quarantine, read_rows_of, read_snapshot

    path = str(tmp_path / "out")
    df = spark.createDataFrame([(1, "a"), (2, None), (-3, "b"), (-4, None)], "n int, t string")
    gates = {"T": {"negative": F.col("n") < 0, "no text": F.col("t").isNull()}}
    kept = publish_tables({"T": (df, ["n", "t"])}, path, AS_OF, gates=gates, refuse=False)
    assert kept["tables"]["T"]["rows"] == 1 and kept["tables"]["T"]["failed"] == {"negative": 2, "no text": 2}
    held = {tuple(r) for r in read_quarantine(spark, kept["tables"]["T"]).collect()}
    assert held == {("no text", "[2,null]"), ("negative", '[-3,"b"]'), ("negative", "[-4,null]"), ("no text", "[-4,null]")}
    manifests = sorted(str(f) for f in (tmp_path / "out/manifests").rglob("part-*"))
    with pytest.raises(GateError, match="T fails {'negative': 2, 'no text': 2}"):
        publish_tables({"T": (df, ["n", "t"])}, path, LATER, gates=gates)
    assert sorted(str(f) for f in (tmp_path / "out/manifests").rglob("part-*")) == manifests
    publish_tables({"T": (df.filter("n = 1"), ["n", "t"])}, path, LATER, gates=gates)
    assert set(manifests) < {str(f) for f in (tmp_path / "out/manifests").rglob("part-*")}
    assert [tuple(r) for r in read_snapshot(spark, path).collect()] == [("2026-01-02T00:00:00Z", "T", 1, '[1,"a"]')]
    assert read_rows_of(spark, latest_manifest(spark, path)["tables"]["T"], "quarantined").collect() == []
