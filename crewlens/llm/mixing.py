"""Mixing sources to target weights by drawing fixed-length blocks.

The words of a source's documents stand in one row, ordered by a hash, and are packed into blocks of
fixed length. The mix has as many slots as its target words need. Each source's slots are dealt to
the output shards multinomially (a tree of binomial draws, so that any shard's draw can be found
without the others and the totals are exact). A source's slots, numbered through all shards, pass
through a pseudorandom permutation of the source's blocks, a new one for each pass; blocks then join
the documents by their index. Everything depends on fixed seeds only: reruns agree.

Targets: sources in code point order (null last) weigh 5, 2, 1 in turn and share 150% of all words;
a target stops at twice its source, and the excess is shared again by weight.

Defined cases: null or empty texts have size 0 and take nothing; repeated rows are packed and taken
each for itself; documents without a source form a source; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crewlens.llm.shared import SPACE, stored, whole

BLOCK_WORDS = 64
SHARD_SLOTS = 4096
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_PASSES = 2
BUCKETS = 4096  # parts of a source in which documents are ordered on their own
SHARD_STRIDE = 1024  # shards of one source that one row of work draws


def word_count(text: Column) -> Column:
    return F.regexp_count(whole(text), F.lit(f"[^{SPACE}]+")).cast("long")


def source_plan(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """One row for each source: number, size, target, blocks and slots. Targets are the lesser of
    twice the size and weight times a level common to all sources."""
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.array(*map(F.lit, weights))
    cap = MOST_PASSES * F.col("source_size")
    ranked = (
        sizes.withColumn("source_no", F.row_number().over(by_name) - 1)
        .withColumn("weight", F.get(turn, F.col("source_no") % len(weights)))
        .withColumn("cap", cap)
        .withColumn("fill", F.col("cap") / F.col("weight"))
    )
    by_fill = Window.orderBy("fill", "source_no")
    everything = by_fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.sum("cap").over(by_fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    behind = F.sum("weight").over(by_fill.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(everything) * share
    level = ranked.withColumn("level", (total - before) / behind).withColumn(
        "level", F.first(F.when(F.col("level") <= F.col("fill"), F.col("level")), ignorenulls=True).over(everything)
    )
    target = F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight"))
    blocks = F.ceil(F.col("source_size") / BLOCK_WORDS)
    slots = F.round(F.col("target") * F.col("blocks") / F.col("source_size")).cast("long")
    return (
        level.withColumn("target", target)
        .withColumn("blocks", blocks)
        .withColumn("slots", F.when(F.col("blocks") > 0, F.least(slots, MOST_PASSES * F.col("blocks"))).otherwise(0))
        .withColumn("shards", F.ceil(F.sum("slots").over(everything) / SHARD_SLOTS))
        .select("source", "source_no", "source_size", "target", "blocks", "slots", "shards")
    )


def _seed(*numbers: int) -> np.random.Generator:
    return np.random.Generator(np.random.Philox(np.random.SeedSequence([20_260, *numbers])))


def shard_counts(source: int, slots: int, shards: int, low: int, high: int) -> tuple[np.ndarray, int]:
    """The source's slots in each shard of [low, high), and the slots in the shards before `low`."""
    counts, before = np.zeros(high - low, np.int64), 0
    todo = [(0, shards, slots)]
    while todo:
        first, last, n = todo.pop()
        if first >= high:
            continue
        if last <= low:
            before += n
        elif last - first == 1:
            counts[first - low] = n
        else:
            middle = (first + last) // 2
            left = int(_seed(source, first, last).binomial(n, (middle - first) / (last - first)))
            todo += [(middle, last, n - left), (first, middle, left)]
    return counts, before


def permuted(places: np.ndarray, n: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of 0..n-1 at `places`: a Feistel network over the next even number
    of bits, walked on until the result is below n."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    rounds = _seed(key).integers(0, 1 << 63, 6, dtype=np.uint64)

    def step(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & mask
        for r in rounds:
            f = (right + r) * np.uint64(0xBF58476D1CE4E5B9)
            f ^= f >> np.uint64(31)
            f *= np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((f >> np.uint64(29)) & mask)
        return (left << np.uint64(half)) | right

    out = step(places.astype(np.uint64))
    while (over := out >= np.uint64(n)).any():
        out[over] = step(out[over])
    return out.astype(np.int64)


def draw_slots(plan: DataFrame) -> DataFrame:
    """source_no, shard, block: one row for each slot of the mix."""
    work = plan.filter("slots > 0").select(
        "source_no", "slots", "blocks", "shards",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1, F.lit(SHARD_STRIDE).cast("long"))).alias("low"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                source, n = row["source_no"], row["blocks"]
                high = min(row["low"] + SHARD_STRIDE, row["shards"])
                counts, before = shard_counts(source, row["slots"], row["shards"], row["low"], high)
                for at in range(0, len(counts), 16):  # some shards at a time
                    some = counts[at : at + 16]
                    slot = before + np.arange(some.sum())
                    before += int(some.sum())
                    block = np.empty(len(slot), np.int64)
                    for epoch in np.unique(slot // n).tolist():
                        mine = slot // n == epoch
                        block[mine] = permuted(slot[mine] % n, n, source * 2_654_435_761 + epoch)
                    shard = np.repeat(np.arange(row["low"] + at, row["low"] + at + len(some)), some)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(slot), source), pa.int32()), pa.array(shard), pa.array(block)],
                        ["source_no", "shard", "block"],
                    )

    return work.repartition("source_no", "low").mapInArrow(run, "source_no int, shard long, block long")


def packed(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """The rows of `sized` with their source's plan, a key of their own (source_no, part, turn) and
    the number of words that stand before them in their source."""
    numbered = sized.join(
        plan.select(F.col("source").alias("_source"), "source_no", "source_size", "target"),
        F.col("source").eqNullSafe(F.col("_source")),
    ).drop("_source", "source")
    hashed = numbered.withColumn("order", F.xxhash64("doc_id")).withColumn("part", F.pmod("order", F.lit(BUCKETS)))
    parts = hashed.groupBy("source_no", "part").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("source_no").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        "source_no", "part", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("offset")
    )
    in_part = Window.partitionBy("source_no", "part").orderBy("order", "doc_id", "size")
    before = F.coalesce(F.sum("size").over(in_part.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (
        hashed.withColumn("turn", F.row_number().over(in_part))
        .withColumn("before", before)
        .join(offsets, ["source_no", "part"])
        .withColumn("start", F.col("offset") + F.col("before"))
        .drop("order", "offset", "before")
    )


def mixture_spans(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """The mix: for each slot (source_no, shard, block) the spans of words it takes from documents."""
    first = F.expr(f"start DIV {BLOCK_WORDS}")
    last = F.expr(f"(start + size - 1) DIV {BLOCK_WORDS}")
    pieces = rows.filter("size > 0").select(
        "source_no", "part", "turn", "doc_id", "start", "size", F.explode(F.sequence(first, last)).alias("block")
    )
    from_word = F.greatest(F.col("block") * BLOCK_WORDS - F.col("start"), F.lit(0))
    to_word = F.least((F.col("block") + 1) * BLOCK_WORDS - F.col("start"), F.col("size"))
    pieces = pieces.withColumn("first_word", from_word).withColumn("n_words", to_word - F.col("first_word"))
    # The planner takes the slots for as few as the plan's rows and would broadcast them.
    return pieces.drop("start", "size").join(draw_slots(plan).hint("merge"), ["source_no", "block"])


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """doc_id, size, source_size, target, taken for every row."""
    sized = stored(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "document_sizes")
    plan = stored(source_plan(sized, weights, share), "source_plan")
    rows = stored(packed(sized, plan), "packed_documents")
    key = ["source_no", "part", "turn"]
    taken = mixture_spans(rows, plan).groupBy(*key).agg(F.sum("n_words").alias("taken"))
    return rows.join(taken, key, "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken")
    )
