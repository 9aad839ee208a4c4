"""Sets of keys as bitmaps of fixed size, to drop rows ahead of a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITMAP_BITS = 32_768  # of one bitmap of Spark's bitmap functions
BITMAPS = 1_024
SLOTS = BITMAP_BITS * BITMAPS


def slot_of(*keys: Column) -> Column:
    """A number from 1 to SLOTS; equal keys have equal slots."""
    return F.pmod(F.xxhash64(*keys), F.lit(SLOTS)) + 1


def bitmaps_of(slots: DataFrame, slot: str) -> DataFrame:
    """At most BITMAPS + 1 rows of 4 KB, however many slots there are."""
    return slots.groupBy(F.bitmap_bucket_number(F.col(slot)).alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col(slot))).alias("_bits")
    )


def may_hold(df: DataFrame, bitmaps: DataFrame, *keys: Column) -> DataFrame:
    """Rows whose keys may be in the set. What is broadcast is bounded by the bitmaps' number and size
    (4 MB); a set too large for them only lets more rows pass."""
    slot = slot_of(*keys)
    held = df.withColumns({"_bucket": F.bitmap_bucket_number(slot), "_place": F.bitmap_bit_position(slot)})
    byte = F.expr("CAST(conv(hex(substring(_bits, CAST(_place DIV 8 AS INT) + 1, 1)), 16, 10) AS INT)")
    bit = F.getbit(byte, F.expr("CAST(_place % 8 AS INT)"))
    return held.join(F.broadcast(bitmaps), "_bucket").filter(bit == 1).drop("_bucket", "_place", "_bits")


def may_repeat(df: DataFrame, key: str) -> DataFrame:
    """Rows whose key may stand in another row as well: its slot does. Slots are counted with map-side
    combine, so what is shuffled for that is 8 bytes a slot and task at most, never the keys."""
    seen = df.groupBy(slot_of(F.col(key)).alias("_slot")).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    return may_hold(df, bitmaps_of(seen, "_slot"), F.col(key))
