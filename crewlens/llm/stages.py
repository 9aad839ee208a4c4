"""The pipeline's stages: each takes documents and returns documents with the same columns.

A stage calls one operator on all rows it is given and lets its decisions take effect, row by row: rows are
told apart by a 128-bit digest of doc_id and text, never by doc_id alone. Columns travel as one struct beside
that digest, whatever their names. The filtering stages ship the digests of the rows to drop, and texts only
where a row may be one of them.

Defined cases: a row with a null doc_id, or of a repeated one, is judged by its own text; a null text counts
as empty; rows that are equal in doc_id and text share one fate (of exact copies one stays); an empty table
stays empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crewlens.llm import bpe, exact_dedup, mixing, ngram_join, quality_classifier
from crewlens.llm.shared import flag_possible, key_bitmaps, stored

KEY = ["row1", "row2"]


def _keyed(docs: DataFrame) -> DataFrame:
    """row1, row2 and the whole row as a struct."""
    return docs.select(*ngram_join.row_keys(), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))


def _rows(keyed: DataFrame, docs: DataFrame) -> DataFrame:
    return keyed.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))


def _settled(docs: DataFrame, verdicts: DataFrame) -> DataFrame:
    """`docs` without the rows that `verdicts` (row1, row2, kept) drops, and once those that it keeps.

    Rows that are surely not in `verdicts` pass where they are read; only the others are shuffled.
    """
    flagged = flag_possible(_keyed(docs), "row1", key_bitmaps(verdicts, "row1"), "possible")
    met = flagged.filter("possible").join(verdicts, KEY, "left")
    turn = F.row_number().over(Window.partitionBy(*KEY).orderBy(*KEY))
    once = met.withColumn("turn", turn).filter("kept IS NULL OR (kept AND turn = 1)")
    return _rows(flagged.filter("NOT possible").select("row").unionByName(once.select("row")), docs)


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_classifier.accepted(docs, labels)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id stays, once."""
    groups = exact_dedup.exact_groups(docs, ngram_join.row_keys()).filter("group_size > 1")
    verdicts = groups.groupBy(*KEY).agg(F.max("kept").alias("kept"))
    return _settled(docs, stored(verdicts, "exact_verdicts"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that n-gram Jaccard links connect, the one with the least doc_id stays. A row with a
    null id stays unless it is linked with one that has an id."""
    joined = ngram_join.joined_rows(docs).filter("NOT doc_id <=> class_id")
    verdicts = joined.select(*KEY).distinct().withColumn("kept", F.lit(False))
    return _settled(docs, stored(verdicts, "near_verdicts"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix, in whole documents: a document of which the mix takes `taken` of its `size` words
    appears taken / size times, rounded up or down by a hash of its digest so that each source's sum
    comes out as drawn. Documents of size 0 stay."""
    source = F.col("source").alias("source") if "source" in docs.columns else F.lit(None).cast("string").alias("source")
    sized = docs.select(F.struct(*ngram_join.row_keys()).alias("doc_id"), source, F.col("text").alias("text"))
    drawn = mixing.mix(sized).groupBy("doc_id.row1", "doc_id.row2").agg(F.avg("taken").alias("taken"), F.max("size").alias("size"))
    chance = F.pmod(F.xxhash64(*KEY, F.lit("mix")), F.lit(1 << 30)) / (1 << 30)
    times = F.when(F.col("size") == 0, 1).otherwise(F.floor(F.col("taken") / F.col("size") + chance))
    counted = drawn.select(*KEY, times.cast("int").alias("times")).filter("times > 0")
    repeated = _keyed(docs).join(counted, KEY).withColumn("turn", F.explode(F.array_repeat(F.lit(1), F.col("times"))))
    return _rows(repeated, docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded text of what is left."""
    return bpe.encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"))
