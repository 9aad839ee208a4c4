"""Spreadsheet exports as rows of cells.

A sheet is a CSV file whose header stands at a row that depends on the data. Files are read as
splittable text, so one very large file is spread over many tasks. A row is
(sheet, row_no, cells) with row_no = struct(block, line): the file block the row starts in and a
number that increases with the lines of a block.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import strip
from ..operators.quality import require_per_sheet
from ..operators.skew import hot_from_counts, spread_join
from .staging import staged

# A quoted cell with what follows its closing quote, and a plain one, in which quotes are text.
QUOTED = r'"(?:[^"]|"")*+"[^,]*+'
PLAIN = r'(?:[^",][^,]*+)?'
# A line that starts outside quotes and ends outside quotes.
CLOSED = rf"(?s)(?:{QUOTED}|{PLAIN})(?:,(?:{QUOTED}|{PLAIN}))*+"
# A cell with its leading comma.
CELL = rf"(?s),({QUOTED}|{PLAIN})"
CLOSED_CELL = r'(?s)"((?:[^"]|"")*+)"(.*)'


def read_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Physical lines (sheet, block, line, value) of text files."""
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("sheet"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        F.col("value"),
    )


def _after(entering: Column, flips: Column, held: Column) -> Column:
    """Whether a quoted cell is open after some lines, given whether one was before them, how often
    they flip that, and the last of them that sets it (what to, and the flips up to it)."""
    odd = (flips - F.coalesce(held["flips"], F.lit(0))) % 2 == 1
    return F.coalesce(held["inside"], entering) != odd


def _line_states(lines: DataFrame) -> DataFrame:
    """Lines with whether each starts and ends inside a quoted cell and where its record begins, for a
    block entered outside quotes (`out`) and for one entered inside (`ins`).

    A quote opens a cell only at the cell's start, so a line either sets the state or, seen from both
    states, keeps or flips it.
    """
    in_block = Window.partitionBy("sheet", "block").orderBy("line")
    so_far = in_block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = in_block.rowsBetween(Window.unboundedPreceding, -1)

    def opens(text: Column) -> Column:
        return ~F.regexp_like(text, F.lit(rf"\A(?:{CLOSED})\z"))

    # Most lines have no quote at all: they keep "outside" and stay "inside".
    bare = ~F.contains("value", F.lit('"'))
    marked = lines.withColumn("if_out", F.when(bare, False).otherwise(opens(F.col("value")))).withColumn(
        "if_in", F.when(bare, True).otherwise(opens(F.concat(F.lit('"'), F.col("value"))))
    )
    flip = (F.col("if_out") & ~F.col("if_in")).cast("long")
    counted = marked.withColumn("flips", F.sum(flip).over(so_far))
    fixed = F.when(F.col("if_out") == F.col("if_in"), F.struct(F.col("if_out").alias("inside"), "flips"))
    held = counted.withColumns(
        {"set": F.last(fixed, ignorenulls=True).over(so_far), "set_before": F.last(fixed, ignorenulls=True).over(before)}
    )
    states = held
    for name, entering in (("out", F.lit(False)), ("ins", F.lit(True))):
        starts = _after(entering, F.col("flips") - flip, F.col("set_before"))
        states = states.withColumns(
            {f"{name}_starts": starts, f"{name}_ends": _after(entering, F.col("flips"), F.col("set"))}
        )
    for name in ("out", "ins"):
        begins = F.when(~F.col(f"{name}_starts"), F.col("line"))
        states = states.withColumn(f"{name}_own", F.last(begins, ignorenulls=True).over(so_far))
    parts = [f"{name}_{part}" for name in ("out", "ins") for part in ("starts", "ends", "own")]
    return states.select("sheet", "block", "line", "value", *parts)


def _entered_blocks(states: DataFrame) -> DataFrame:
    """(sheet, block, entering, carried): whether each block is entered inside a quoted cell, and the last
    record begun before it.

    A block is summed up in one row, the state it ends in and its last record for either way of entering;
    these rows compose as lines do. A file that ends inside a quoted cell fails the job.
    """
    blocks = states.groupBy("sheet", "block").agg(
        *[F.max_by(f"{name}_ends", "line").alias(f"if_{name}") for name in ("out", "ins")],
        *[F.max(f"{name}_own").alias(f"{name}_own") for name in ("out", "ins")],
    )
    by_block = Window.partitionBy("sheet").orderBy("block")
    so_far = by_block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = by_block.rowsBetween(Window.unboundedPreceding, -1)
    flip = (F.col("if_out") & ~F.col("if_ins")).cast("long")
    counted = blocks.withColumn("flips", F.sum(flip).over(so_far))
    fixed = F.when(F.col("if_out") == F.col("if_ins"), F.struct(F.col("if_out").alias("inside"), "flips"))
    outside = F.lit(False)
    entered = (
        counted.withColumns(
            {"set": F.last(fixed, ignorenulls=True).over(so_far), "set_before": F.last(fixed, ignorenulls=True).over(before)}
        )
        .withColumn("entering", _after(outside, F.col("flips") - flip, F.col("set_before")))
        .withColumn("own", F.when(F.col("entering"), F.col("ins_own")).otherwise(F.col("out_own")))
    )
    begun = F.when(F.col("own").isNotNull(), F.struct("block", F.col("own").alias("line")))
    unclosed = F.lead("block").over(by_block).isNull() & _after(outside, F.col("flips"), F.col("set"))
    message = F.concat(F.lit("a quoted cell is not closed in sheet "), F.col("sheet"))
    return (
        entered.withColumns({"carried": F.last(begun, ignorenulls=True).over(before), "unclosed": unclosed})
        .filter(F.when(~F.col("unclosed"), True).otherwise(F.raise_error(message).cast("boolean")))
        .select("sheet", "block", "entering", "carried")
    )


def join_quoted_lines(lines: DataFrame) -> DataFrame:
    """Records (sheet, row_no, value): lines inside a quoted cell join the line that opened it.

    The lines are scanned once: they are written with their states, from which both the blocks' summaries
    and the records are read. A record of one line passes as it is; only the others are grouped.
    """
    states = staged(_line_states(lines), "lines")
    located = states.join(_entered_blocks(states), ["sheet", "block"])

    def known(part: str) -> Column:
        return F.when(F.col("entering"), F.col(f"ins_{part}")).otherwise(F.col(f"out_{part}"))

    single = ~known("starts") & ~known("ends")
    own = F.when(known("own").isNotNull(), F.struct("block", known("own").alias("line")))
    joined = (
        located.filter(~single)
        .withColumn("row_no", F.coalesce(own, "carried"))
        .groupBy("sheet", "row_no")
        .agg(
            F.array_join(
                F.transform(
                    F.array_sort(F.collect_list(F.struct("block", "line", "value"))),
                    lambda part: part["value"],
                ),
                "\n",
            ).alias("value")
        )
    )
    lone = located.filter(single).select("sheet", F.struct("block", "line").alias("row_no"), "value")
    return lone.unionByName(joined)


def split_cells(record: Column) -> Column:
    """The cells of one CSV record, quotes removed; text after a closing quote belongs to the cell."""
    raw = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(CELL), F.lit(1))
    return F.transform(
        raw,
        lambda c: F.when(
            c.startswith('"'),
            F.concat(
                F.replace(F.regexp_extract(c, CLOSED_CELL, 1), F.lit('""'), F.lit('"')),
                F.regexp_extract(c, CLOSED_CELL, 2),
            ),
        ).otherwise(c),
    )


def rows_of(lines: DataFrame, multiline: bool = True) -> DataFrame:
    """Rows of cells; without `multiline` every physical line is a record."""
    records = (
        join_quoted_lines(lines)
        if multiline
        else lines.select("sheet", F.struct("block", "line").alias("row_no"), "value")
    )
    return records.select("sheet", "row_no", split_cells(F.col("value")).alias("cells"))


def read_rows(spark: SparkSession, path: str | Sequence[str], multiline: bool = True) -> DataFrame:
    return rows_of(read_lines(spark, path), multiline)


def _as_is(text: Column) -> Column:
    return text


def snake_case(text: Column) -> Column:
    return F.replace(F.lower(strip(text)), F.lit(" "), F.lit("_"))


def summary_per_sheet(rows: DataFrame, *sums: Column) -> DataFrame:
    """One row for each sheet with `sums` and `_rows`, its number of rows: its headers and the list of very
    large sheets both start from this one aggregation."""
    return rows.groupBy("sheet").agg(*sums, F.count(F.lit(1)).alias("_rows"))


def _below_header(
    rows: DataFrame,
    header_key: str | None,
    form: Callable[[Column], Column],
    describe: Callable[[DataFrame], DataFrame] = lambda headers: headers.drop("header"),
    skip_headerless: bool = False,
) -> DataFrame:
    """Rows under each sheet's header whose first cell is not blank.

    `describe` turns the table of headers, one row per sheet, into what each row should carry.

    A sheet's header is the first row whose first cell is the key. A sheet without one fails the
    job, unless `skip_headerless` says that such files are no sheets. Without a key the header is
    the sheet's first row and all rows but empty lines are kept.
    """
    first = form(F.get("cells", F.lit(0)))
    if header_key is None:
        rows = rows.filter((F.size("cells") > 1) | (first != ""))
        is_title, kept = F.lit(True), rows
    else:
        is_title, kept = first == header_key, rows.filter(first != "")
    title_no = F.when(is_title, F.col("row_no"))
    sheets = summary_per_sheet(
        rows,
        F.min(title_no).alias("header_no"),
        F.min_by("cells", title_no).alias("header"),
    )
    hot = hot_from_counts(sheets, "sheet", "_rows")
    headers = (
        sheets.filter(F.col("header_no").isNotNull())
        if skip_headerless
        else require_per_sheet(sheets, "header_no", f"the header row '{header_key}'")
    )
    headers = headers.drop("_rows").withColumn("header", F.transform("header", form))
    below = spread_join(kept, describe(headers), ["sheet"], hot, "sheet", ["row_no"])
    return below.filter(F.col("row_no") > F.col("header_no"))


def sheet_columns(
    rows: DataFrame,
    header_key: str | None,
    columns: Sequence[str],
    required: Sequence[str] = (),
    form: Callable[[Column], Column] = _as_is,
    skip_headerless: bool = False,
) -> DataFrame:
    """Columns picked by header name: (sheet, row_no, *columns).

    Short rows and absent columns give NULL; a sheet that lacks its header row or a required column
    fails the job.
    `form` is applied to header cells and to first cells before they are compared. Of two columns
    with one name the later counts.
    """

    def locate(headers: DataFrame) -> DataFrame:
        if required:
            absent = F.array_except(F.array(*map(F.lit, required)), F.col("header"))
            message = F.concat(F.lit("sheet lacks columns: "), F.array_join(absent, ", "))
            headers = headers.filter(
                # a sheet without a header fails by its header's number
                F.when(F.col("header").isNull() | (F.size(absent) == 0), True).otherwise(
                    F.raise_error(message).cast("boolean")
                )
            )
        from_end = [F.array_position(F.reverse("header"), c) for c in columns]
        places = [F.when(n > 0, F.size("header") - n).cast("int") for n in from_end]
        return headers.select("sheet", "header_no", F.array(*places).alias("places"))

    found = _below_header(rows, header_key, form, locate, skip_headerless)
    picked = [F.get("cells", F.get("places", F.lit(i))) for i in range(len(columns))]
    return found.select("sheet", "row_no", *[p.alias(c) for p, c in zip(picked, columns)])


def positional_columns(
    rows: DataFrame, header_key: str, columns: Sequence[str], skip_headerless: bool = False
) -> DataFrame:
    """Columns picked by position below the header row; short rows are padded with NULL."""
    found = _below_header(rows, header_key, strip, skip_headerless=skip_headerless)
    return found.select(
        "sheet",
        "row_no",
        *[F.get("cells", F.lit(i)).alias(name) for i, name in enumerate(columns)],
    )


def split_sections(rows: DataFrame, headers: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rows of a sheet with several tables: (sheet, row_no, section, cells).

    The leading column and trailing blanks are dropped. A row equal to a known header opens its
    section, a blank row closes it, and rows outside a section are left out. The open section is
    carried over block by block, so no window holds more than one block or one sheet's blocks.
    """
    body = F.slice("cells", F.lit(2), F.greatest(F.size("cells") - 1, F.lit(0)))
    filled = F.coalesce(
        F.array_max(F.transform("body", lambda c, i: F.when(c != "", i + 1))), F.lit(0)
    )
    marked = (
        rows.withColumn("body", body)
        .withColumn("cells", F.slice("body", F.lit(1), filled))
        .drop("body")
        .withColumn("block", F.col("row_no.block"))
    )
    mark = F.when(F.size("cells") == 0, "")
    for name, titles in headers.items():
        mark = mark.when(F.col("cells") == F.array(*map(F.lit, titles)), name)
    marked = marked.withColumn("mark", mark)
    in_block = Window.partitionBy("sheet", "block").orderBy("row_no")
    by_block = Window.partitionBy("sheet").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    carried = (
        marked.groupBy("sheet", "block")
        .agg(
            F.max_by("mark", F.when(F.col("mark").isNotNull(), F.col("row_no"))).alias("last_mark")
        )
        .select(
            "sheet", "block",
            F.last("last_mark", ignorenulls=True).over(by_block).alias("carried"),
        )
    )
    return (
        marked.withColumn("own", F.last("mark", ignorenulls=True).over(in_block))
        .join(carried, ["sheet", "block"])
        .withColumn("section", F.coalesce("own", "carried"))
        .filter(F.col("mark").isNull() & (F.col("section") != ""))
        .select("sheet", "row_no", "section", "cells")
    )
