"""Helpers that several corpus operators use: the shared folder, text forms, bounded key bitmaps."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from functools import reduce, wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.staging import shared_folder

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: Java regex class of the white space that separates words.
SPACE = "\\x20\\x09-\\x0D"
SPACE_CHARS = " \t\n\x0b\x0c\r"

BITMAP_BITS = 32_768  # bits of one bitmap of Spark's bitmap functions
BITMAPS = 1_024


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}/{name}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once as a table in the shared folder and read it back: later steps and lost
    executors start from there instead of from the source."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def give_back() -> None:
    """Return to the system what Arrow's pool and the C library (where it can) hold without use."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def returning_memory(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """`run` (for mapInArrow), which gives memory back at its partition's end: Spark keeps the worker for
    tasks of other stages, which come on top of whatever the allocators still hold."""

    @wraps(run)
    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return held


def whole(text: Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """`text` with only A-Z lower-cased. `lower` does just that on pure ASCII, many times faster."""
    pure = F.octet_length(text) == F.char_length(text)
    return F.when(pure, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def key_bitmaps(keys: DataFrame, key: str) -> DataFrame:
    """A set of hash keys as at most BITMAPS + 1 bitmaps of 4 KB, whatever the number of keys."""
    slot = F.pmod(F.col(key), F.lit(BITMAPS * BITMAP_BITS)) + 1
    return keys.groupBy(F.bitmap_bucket_number(slot).alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("_bits")
    )


def flag_possible(df: DataFrame, key: str, bitmaps: DataFrame, flag: str) -> DataFrame:
    """Add `flag`: false where `key` is surely not in the set, true where it may be.

    The broadcast is bounded by the form of the bitmaps (4 MB); a set too large for them only
    makes more keys possible.
    """
    slot = F.pmod(F.col(key), F.lit(BITMAPS * BITMAP_BITS)) + 1
    held = df.withColumn("_bucket", F.bitmap_bucket_number(slot)).withColumn(
        "_place", F.bitmap_bit_position(slot)
    )
    byte = F.expr("CAST(conv(hex(substring(_bits, CAST(_place DIV 8 AS INT) + 1, 1)), 16, 10) AS INT)")
    bit = F.expr("CAST(_place % 8 AS INT)")
    return (
        held.join(F.broadcast(bitmaps), "_bucket", "left")
        .withColumn(flag, F.coalesce(F.getbit(byte, bit) == 1, F.lit(False)))
        .drop("_bucket", "_place", "_bits")
    )


def only_possible(df: DataFrame, key: str, bitmaps: DataFrame) -> DataFrame:
    """Rows whose `key` may be in the set."""
    return flag_possible(df, key, bitmaps, "_maybe").filter("_maybe").drop("_maybe")


def let(value: Column, body) -> Column:
    """`body(value)` with `value` evaluated once for each row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def with_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, salt: Column, how: str = "left") -> DataFrame:
    """`rows` joined with `groups`: one row for each value of `keys` (null is a value), `size` about
    the number of its rows.

    The rows of a group with more than an even share of all grouped rows are dealt to several tasks by
    `salt`, and the group's one row is copied to each; such groups are fewer than shuffle partitions,
    so the list of them is broadcast. `groups` is read several times: give a stored table.
    """
    parts = shuffle_partitions(rows.sparkSession)
    share = (groups.agg(F.sum(size)).first()[0] or 0) // parts + 1
    dealt = F.ceil(F.col(size) / share).cast("int")
    hot = groups.filter(F.col(size) > share).select(*(F.col(k).alias(f"_hot_{k}") for k in keys), dealt.alias("_parts"))
    spread = (
        rows.join(F.broadcast(hot), _same(keys, "_hot_"), "left")
        .withColumn("_salt", F.coalesce(F.pmod(salt, F.col("_parts")), F.lit(0)).cast("int"))
        .drop("_parts", *(f"_hot_{k}" for k in keys))
    )
    copies = F.when(F.col(size) > share, dealt).otherwise(1)
    copied = groups.withColumn("_turn", F.explode(F.sequence(F.lit(0), copies - 1))).withColumnsRenamed({k: f"_key_{k}" for k in keys})
    joined = spread.join(copied, _same(keys, "_key_") & (F.col("_salt") == F.col("_turn")), how)
    return joined.drop("_salt", "_turn", *(f"_key_{k}" for k in keys))


def _same(keys: list[str], prefix: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys])
