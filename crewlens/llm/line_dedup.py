"""Lines that repeat across documents, dropped from all but the last document that holds them.

Hashes of lines are range-partitioned and sorted by document (largest first) and position; the
first document of each run keeps its lines. The result is no text but, for each document, the runs
of kept lines: its keep bitmap in run-length form.

Only hashes that occur often enough enter the sort: they are counted first with map-side combine
and sent as bitmaps of fixed size. A hash with more than an even share of the rows is dealt to
several parts by document, each streamed on its own; the parts of a hash then meet as one row each.

Defined cases: a null or empty text is one empty line; a line repeated inside the keeping document
stays there; rows of one doc_id count as one document, each row with its own bitmap; a row with a
null doc_id keeps all lines and is not counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crewlens.llm.shared import (
    SPACE_CHARS,
    ascii_lower,
    key_bitmaps,
    let,
    only_possible,
    shuffle_partitions,
    stored,
    whole,
)

MIN_CHARS = 20
MIN_DOCS = 3


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _version() -> Column:
    """Tells rows with one doc_id and different texts apart."""
    return F.xxhash64(whole(F.col("text")))


def line_hashes(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, version, pos, and a 128-bit hash of every line key that is long enough."""
    lines = docs.filter(F.col("doc_id").isNotNull()).select(
        "doc_id",
        _version().alias("version"),
        F.posexplode(_lines(ascii_lower(whole(F.col("text"))))).alias("pos", "line"),
    )
    keys = lines.withColumn("line", F.btrim("line", F.lit(SPACE_CHARS)))
    return keys.filter(F.char_length("line") >= min_chars).select(
        "doc_id", "version", "pos",
        F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), F.col("line")).alias("h2"),
    )


def repeated_lines(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS
) -> DataFrame:
    """doc_id, version, pos of every line to drop."""
    spark = docs.sparkSession
    hashes = line_hashes(docs, min_chars)
    often = stored(
        hashes.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_docs),
        "repeated_hashes",
    )
    rows = stored(only_possible(hashes, "h1", key_bitmaps(often, "h1")), "repeated_lines")

    parts = shuffle_partitions(spark)
    share = max(1, (often.agg(F.sum("n")).first()[0] or 0) // parts)
    hot = often.filter(F.col("n") > share).select(  # no more than `parts` hashes can exceed the share
        "h1", "h2", F.ceil(F.col("n") / share).cast("int").alias("parts")
    )
    rows = rows.join(F.broadcast(hot), ["h1", "h2"], "left").withColumn(
        "part", F.coalesce(F.pmod(F.xxhash64("doc_id"), F.col("parts")), F.lit(0))
    )
    run = ["h1", "h2", "part"]
    latest_first = [F.col("doc_id").desc(), F.col("version"), F.col("pos")]
    ranged = rows.repartitionByRange(parts, *run).sortWithinPartitions(*run, *latest_first)
    stream = Window.partitionBy(*run).orderBy(*latest_first)
    whole_run = stream.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    streamed = (
        ranged.withColumn("turn", F.row_number().over(stream))
        .withColumn("before", F.lag("doc_id").over(stream))
        .withColumn("opens", (F.col("turn") == 1) | (F.col("before") != F.col("doc_id")))
        .withColumn("first_doc", F.first("doc_id").over(whole_run))
        .withColumn("run_docs", F.sum(F.col("opens").cast("long")).over(whole_run))
    )
    met = (
        streamed.filter(F.col("parts").isNotNull() & (F.col("turn") == 1))
        .groupBy("h1", "h2")
        .agg(F.max("first_doc").alias("all_first"), F.sum("run_docs").alias("all_docs"))
    )
    judged = streamed.join(F.broadcast(met), ["h1", "h2"], "left")
    keeper = F.coalesce("all_first", "first_doc")
    count = F.coalesce("all_docs", "run_docs")
    return judged.filter((count >= min_docs) & (F.col("doc_id") != keeper)).select(
        "doc_id", "version", "pos"
    )


def keep_bitmaps(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS
) -> DataFrame:
    """doc_id, version, n_lines, n_dropped, keep_runs: ordered runs (first, count) of kept lines."""
    key = ["doc_id", "version"]
    dropped = repeated_lines(docs, min_chars, min_docs)
    in_doc = Window.partitionBy(*key).orderBy("pos")
    gaps = (
        dropped.withColumn("island", F.col("pos") - F.dense_rank().over(in_doc))
        .groupBy(*key, "island")
        .agg(F.min("pos").alias("first"), F.max("pos").alias("last"))
        .groupBy(*key)
        .agg(
            F.sum(F.col("last") - F.col("first") + 1).alias("n_dropped"),
            F.array_sort(F.collect_list(F.struct("first", "last"))).alias("gaps"),
        )
    )
    sizes = docs.select(
        "doc_id", _version().alias("version"), F.size(_lines(whole(F.col("text")))).alias("n_lines")
    )
    edge = F.struct(F.col("n_lines").alias("first"), F.col("n_lines").alias("last"))
    runs = F.expr(
        "filter(transform(edges, (e, i) -> named_struct('first', IF(i = 0, 0, edges[i - 1].last + 1),"
        " 'count', e.first - IF(i = 0, 0, edges[i - 1].last + 1))), r -> r.count > 0)"
    )
    return (
        sizes.join(gaps, key, "left")
        .withColumn("n_dropped", F.coalesce("n_dropped", F.lit(0)).cast("long"))
        .withColumn("edges", F.when(F.col("gaps").isNull(), F.array(edge)).otherwise(F.concat("gaps", F.array(edge))))
        .select(*key, F.col("n_lines").cast("long").alias("n_lines"), "n_dropped", runs.alias("keep_runs"))
    )


def kept_text(text: Column, keep_runs: Column) -> Column:
    """The kept lines joined by line breaks; linear in the number of lines."""
    def pick(lines: Column) -> Column:
        return F.flatten(F.transform(keep_runs, lambda r: F.slice(lines, r["first"] + 1, r["count"])))

    return F.array_join(let(_lines(whole(text)), pick), "\n")


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """The documents with n_lines, n_dropped and kept_text."""
    key = ["doc_id", "version"]
    touched = bitmaps.filter("n_dropped > 0").select(*key, "n_dropped", "keep_runs").dropDuplicates(key)
    both = docs.drop("version", "n_lines", "n_dropped", "keep_runs", "kept_text").withColumn("version", _version())
    text = whole(F.col("text"))
    return (
        both.join(touched, key, "left")
        .withColumn("n_lines", F.size(_lines(text)).cast("long"))
        .withColumn("n_dropped", F.coalesce("n_dropped", F.lit(0).cast("long")))
        .withColumn(
            "kept_text",
            F.when(F.col("keep_runs").isNull(), text).otherwise(kept_text(F.col("text"), F.col("keep_runs"))),
        )
        .drop("version", "keep_runs")
    )
