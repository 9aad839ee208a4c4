"""Spreadsheet files against Python's csv reader."""

from __future__ import annotations

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from crewlens.plans import sheets
from crewlens.plans.qualification import PUBLISHED_NAMES
from crewlens.sources.sheets import read_rows, rows_of, sheet_columns, snake_case, split_sections


def write(folder, name, rows, blank_lines=()):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator="\n")
    for i, row in enumerate(rows):
        if i in blank_lines:
            out.write("\n")
        writer.writerow(row)
    (folder / name).write_text(out.getvalue(), encoding="utf-8")
    return out.getvalue()


def by_file(rows):
    found = {}
    for r in sorted(rows.collect(), key=lambda r: tuple(r["row_no"])):
        found.setdefault(r["sheet"].rsplit("/", 1)[1], []).append(list(r["cells"]))
    return found


def random_rows(seed):
    rng = random.Random(seed)
    pieces = ["a", "", 'say "x"', "b,c", "two\nlines", 'q"\n"r', "ñ", " pad ", "1"]
    return [[rng.choice(pieces) for _ in range(rng.randint(1, 6))] for _ in range(120)]


@pytest.mark.parametrize("block_bytes", ["134217728", "64"])
def test_rows_match_csv_reader(spark, tmp_path, block_bytes):
    """Also with blocks so small that quoted cells straddle them."""
    texts = {f"f{i}.csv": write(tmp_path, f"f{i}.csv", random_rows(i), (5,)) for i in range(3)}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", block_bytes)
        got = by_file(read_rows(spark, str(tmp_path)))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    for name, text in texts.items():
        expected = [row or [""] for row in csv.reader(io.StringIO(text))]
        assert got[name] == expected


# Quotes inside plain cells are text, and so is what follows a closing quote.
LOOSE = [
    '1,5" pipe,x', "2,y,z", '3,"q,1",w', "4,c,d", 'a""b,"c""d"e",f', '"two', 'lines"tail"x,g', '"",""",""', '5"', 'x"y,"z', '",q"r"',
]


@pytest.mark.parametrize("seed", [None, 1, 2, 3])
@pytest.mark.parametrize("block_bytes", ["134217728", "64"])
def test_loose_quotes_match_csv_reader(spark, tmp_path, block_bytes, seed):
    rng = random.Random(seed)
    lines = LOOSE if seed is None else rng.choices([*LOOSE, "plain,line", '"', '"",'], k=150)
    text = "\n".join(lines) + "\n"
    while len(_open_end(text)):
        text += '"\n'
    (tmp_path / "f.csv").write_text(text, encoding="utf-8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", block_bytes)
        got = by_file(read_rows(spark, str(tmp_path)))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got["f.csv"] == [row or [""] for row in csv.reader(io.StringIO(text))]


def _open_end(text):
    """What a closing quote at the end of the text would close; empty if nothing is open."""
    with_mark = list(csv.reader(io.StringIO(text + "\x01")))
    return with_mark[-1][-1][:-1] if with_mark[-1] != ["\x01"] else ""


def test_unclosed_quote_fails(spark, tmp_path):
    (tmp_path / "good.csv").write_text("a,b\n")
    (tmp_path / "open.csv").write_text('a,"b\n' + "c,d\n" * 50)
    with pytest.raises(Exception, match="not closed in sheet .*open.csv"):
        read_rows(spark, str(tmp_path)).collect()


def test_single_lines(spark, tmp_path):
    write(tmp_path, "a.csv", [["x", "y,z"], ["", "2"]])
    assert by_file(read_rows(spark, str(tmp_path), multiline=False)) == {
        "a.csv": [["x", "y,z"], ["", "2"]]
    }


def test_header_by_name(spark, tmp_path):
    write(tmp_path, "one.csv", [["note"], ["key", "b", "a", "b"], ["1", "x", "y", "z"], ["", "n"],
                                ["2"]])
    write(tmp_path, "two.csv", [["key", "a"], ["3", "q"]])
    write(tmp_path, "none.csv", [["nothing", "here"]])
    rows, columns = read_rows(spark, str(tmp_path)), ["key", "a", "b", "c"]
    with pytest.raises(Exception, match="header row 'key' is missing in sheet .*none.csv"):
        sheet_columns(rows, "key", columns).collect()
    picked = sheet_columns(rows, "key", columns, skip_headerless=True)
    got = picked.drop("sheet", "row_no").collect()
    assert sorted(map(tuple, got), key=str) == [
        ("1", "y", "z", None), ("2", None, None, None), ("3", "q", None, None)
    ]


def test_required_column(spark, tmp_path):
    write(tmp_path, "one.csv", [["location_id", "location_name"], ["1", "x"]])
    with pytest.raises(Exception, match="sheet lacks columns: approval_status"):
        sheets.payment_sheet(read_rows(spark, str(tmp_path))).collect()


def test_notes_sheet(spark, tmp_path):
    from crewlens.operators.ranking import notes_by_key

    write(tmp_path, "n.csv", [["x"], ["Row_Key ", "Notes", "Agent Name"], ["1-2", "a", "Ann"],
                              [" 1-2 ", " b ", ""], [" ", "c", "Bob"], ["3-4", "", "Cy"]])
    picked = sheet_columns(
        read_rows(spark, str(tmp_path)), "row_key", ["row_key", "notes", "agent_name"],
        form=snake_case,
    )
    got = {tuple(r) for r in notes_by_key(picked).collect()}
    assert got == {("1-2", "b", None), ("3-4", None, "Cy")}


def test_outreach_and_vip_sheets(spark, tmp_path):
    write(tmp_path, "o.csv", [["row_key", "pro_id", "start_time", "hours_to_start"],
                              [" 1-2 ", "7.0", "1/2/2026 3:04:05", "12.5"], ["", "1"]])
    row = sheets.outreach_sheet(read_rows(spark, str(tmp_path / "o.csv"))).first()
    assert (row.row_key, row.pro_id, row.start_time, row.hours_to_start) == (
        "1-2", 7, "2026-01-02 03:04:05", 12.5
    )
    write(tmp_path, "v.csv", [["junk"], ["id", "x"], ["9", "46225.5", " NY ", "", "", "true", "3"]])
    row = sheets.vip_shift_sheet(read_rows(spark, str(tmp_path / "v.csv"))).first()
    assert tuple(row) == (
        9, "2026-07-22 12:00:00", "NY", None, None, "On", 3, None, None, None
    )


def test_qualification_and_housekeeping_sheets(spark, tmp_path):
    write(tmp_path, "q.csv", [list(PUBLISHED_NAMES),
                              ["Biz", "5", "6", "7/22/2026 5:30 PM"]])
    row = sheets.qualification_sheet(read_rows(spark, str(tmp_path / "q.csv"))).first()
    assert len(row) == 33 and list(row.asDict()) == list(PUBLISHED_NAMES.values())
    assert (row.location_id, row.shift_date) == (5, "2026-07-22 17:30:00")
    names = [n for n in PUBLISHED_NAMES.values() if not n.startswith("position_")]
    write(tmp_path, "h.csv", [names, ["", "5.9", "x", "7/22/2026"], ["Biz"]])
    rows = sheets.housekeeping_sheet(read_rows(spark, str(tmp_path / "h.csv"))).collect()
    assert len(rows) == 2 and len(rows[0]) == 31
    first = next(r for r in rows if r.location_id == 5)
    assert (first.business_name, first.shift_id, first.shift_date) == (None, None, "7/22/2026")


def expected_sections(rows, headers):
    current, found = None, []
    for row in rows:
        body = row[1:]
        while body and body[-1] == "":
            body = body[:-1]
        if not body:
            current = None
        elif body in headers.values():
            current = next(k for k, v in headers.items() if v == body)
        elif current:
            found.append((current, body))
    return found


@pytest.mark.parametrize("width", [1, 3, 1000])
def test_sections(spark, width):
    rng = random.Random(3)
    headers = {"A": ["x", "y"], "B": ["z"]}
    choices = [["", "x", "y", ""], ["", "z"], ["", "", ""], ["q"], [""], ["", "1", "", "2"],
               ["", "", "v"], ["k", "x", "y", "n"]]
    rows = [rng.choice(choices) for _ in range(300)]
    df = spark.createDataFrame(
        [("s", (i // width, i), cells) for i, cells in enumerate(rows)],
        "sheet string, row_no struct<block:bigint,line:bigint>, cells array<string>",
    )
    got = split_sections(df, headers).orderBy("row_no").collect()
    assert [(r["section"], list(r["cells"])) for r in got] == expected_sections(rows, headers)


def test_rows_of_keeps_block_order(spark):
    lines = spark.createDataFrame(
        [("s", 0, 1, 'a,"b'), ("s", 0, 2, "c"), ("s", 9, 1, 'd"'), ("s", 9, 2, "e")],
        "sheet string, block bigint, line bigint, value string",
    )
    got = rows_of(lines).orderBy("row_no").collect()
    assert [list(r["cells"]) for r in got] == [["a", "b\nc\nd"], ["e"]]
    assert got[1]["row_no"]["block"] == 9
    assert rows_of(lines).filter(F.col("row_no.block") == 0).count() == 1
