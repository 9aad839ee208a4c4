"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

Each step reads more of a text, and only of texts that the step before could not tell apart. The
sets of ambiguous lengths and prefixes travel as bitmaps of fixed size, so no text is shuffled;
a false hit costs one more hash and never changes a group. Only keys meet their groups by a shuffle, and
those of very large groups are dealt to several tasks.

Defined cases: a null text counts as empty; empty texts form one group; rows that repeat both text
and the largest doc_id all count as kept; a null doc_id is smaller than any other. An empty table
gives an empty result. Other columns are ignored unless named in `carry`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crewlens.llm.shared import ascii_lower, flag_possible, key_bitmaps, only_possible, stored, whole, with_groups

PREFIX_CHARS = 64


def normalised(text: Column) -> Column:
    """The form in which texts are compared."""
    return ascii_lower(whole(text))


def exact_groups(
    docs: DataFrame, carry: Sequence[Column] = (), prefix_chars: int = PREFIX_CHARS
) -> DataFrame:
    """One row for each row of `docs`: doc_id, the `carry` columns, keep_id, group_size, kept."""
    length = F.octet_length(whole(F.col("text"))).cast("long")
    head = F.xxhash64(length, ascii_lower(F.substring(whole(F.col("text")), 1, prefix_chars)))

    lengths = docs.select(length.alias("n")).groupBy("n").count().filter("count > 1")
    same_length = key_bitmaps(lengths, "n")
    heads = only_possible(docs.select(length.alias("n"), head.alias("head")), "n", same_length)
    same_head = key_bitmaps(heads.groupBy("head").count().filter("count > 1"), "head")

    rows = flag_possible(
        docs.select("doc_id", *carry, length.alias("n"), head.alias("head"), "text"),
        "head", same_head, "ambiguous",
    )
    full = F.when(F.col("ambiguous"), F.sha2(normalised(F.col("text")), 256)).otherwise("")
    rows = stored(rows.withColumn("full", full).drop("text", "ambiguous"), "exact_keys")

    key = ["n", "head", "full"]
    groups = stored(
        rows.groupBy(*key)
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .filter("group_size > 1"),
        "exact_groups",
    )
    alone = F.col("group_size").isNull()
    return (
        with_groups(rows, groups, key, "group_size", F.xxhash64("doc_id"))
        .withColumn("keep_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")))
        .withColumn("group_size", F.coalesce("group_size", F.lit(1)))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))
        .drop(*key)
    )
