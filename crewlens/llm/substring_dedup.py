"""Passages of `WINDOW` words or more that an earlier document holds, cut out.

Equal windows must meet in one shard without every document visiting every shard. A window's anchor is
the least hash of the word n-grams in it; neighbouring windows mostly share theirs, and what they span
together is a segment. Equal windows have equal anchors, and a shard takes the segments of its anchors.
Anchors that only one document holds cannot repeat: they are counted first, as 32-bit numbers packed by
bucket, and the repeated ones travel as bitmaps of fixed size, so only passages that may repeat are
shuffled. Equal segments of a batch of documents go as one, with the least and largest doc_id.

Each shard builds an FM-index of its distinct segments: the Burrows-Wheeler transform of suffixes sorted
as deep as a window, held in a wavelet matrix of packed bits, and for each range of equal windows the
least doc_id. Segments are then streamed against it: backward search, many windows in lock step, gives
their matching statistics (capped at a window), and where a whole window matches, the first document that
holds it. The documents are cut again into segments, which meet these results by a 128-bit key; windows
whose first document is smaller become intervals, and the words these cover go.

An anchor whose segments would overfill a shard (a passage common to very many documents, whose
segments differ at its ends) is taken apart into single windows, which are reduced by key and spread over all
shards by their own hash. A segment with very many copies is salted in the last join. Nothing is cut or left out.

Defined cases: words are runs of anything but \\x20 and \\x09-\\x0D, compared as they are; a null text has no
words; a text shorter than a window keeps all words; rows with one doc_id do not remove each other's
words; a row with a null doc_id keeps all its words and removes none; an empty table gives an empty
result; other columns are ignored. Words count as equal if their 64-bit hashes are.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crewlens.llm.shared import (
    BITMAP_BITS,
    BITMAPS,
    flag_possible,
    key_bitmaps,
    shuffle_partitions,
    stored,
    whole,
    with_groups,
)
from crewlens.llm.wordhash import NOT_SPACE, blocks, hashes, mix, spans

WINDOW = 13
GRAM = 5
SHARD_WORDS = 1 << 19
SEARCHED = 1 << 16  # windows searched in lock step
BATCH_BYTES = 8 << 20
_PRIME = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Segments:
    """Windows in a row that share an anchor. Words and documents are numbered within a block."""

    first: np.ndarray  # number of the first word
    windows: np.ndarray
    anchor: np.ndarray
    key: np.ndarray  # a hash of the words
    owner: np.ndarray  # number of the document

    def take(self, some: np.ndarray) -> Segments:
        return Segments(self.first[some], self.windows[some], self.anchor[some], self.key[some], self.owner[some])


def sequence_hashes(words: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A hash of each span of word hashes, the same wherever it stands."""
    powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(words), _PRIME)]), dtype=np.uint64)
    inverse = np.uint64(pow(int(_PRIME), -1, 1 << 64))
    inverses = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(words), inverse)]), dtype=np.uint64)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * powers[: len(words)], out=sums[1:])
    return mix((sums[last] - sums[first]) * inverses[first] + (last - first).astype(np.uint64))


def segments(words: np.ndarray, bounds: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> Segments:
    """The segments of documents whose words stand side by side; `bounds` has one more number than documents."""
    if len(words) < window:
        none = np.zeros(0, np.int64)
        return Segments(none, none, none.astype(np.uint64), none.astype(np.uint64), none)
    count = np.diff(bounds)
    owner = np.repeat(np.arange(len(count)), count)
    grams = np.zeros(len(words) - gram + 1, np.uint64)
    for i in range(gram):
        grams = mix(grams * _PRIME + words[i : i + len(grams)])
    wanted, span, least = window - gram + 1, 1, grams
    while span < wanted:
        step = min(span, wanted - span)
        least = np.minimum(least[: len(least) - step], least[step:])
        span += step
    inside = owner[: len(least)] == owner[window - 1 : window - 1 + len(least)]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1] | (least[1:] != least[:-1]) | (owner[1 : len(least)] != owner[: max(len(least) - 1, 0)])
    first = np.flatnonzero(opens)
    windows = np.add.reduceat(inside, first, dtype=np.int64) if len(first) else np.zeros(0, np.int64)
    return Segments(first, windows, least[first], sequence_hashes(words, first, first + windows + window - 1), owner[first])


def single_windows(words: np.ndarray, found: Segments, window: int = WINDOW) -> Segments:
    """Each window of the segments as a segment of its own, anchored at its own hash."""
    place = np.arange(found.windows.sum()) - np.repeat(np.cumsum(found.windows) - found.windows, found.windows)
    first = np.repeat(found.first, found.windows) + place
    key = sequence_hashes(words, first, first + window)
    return Segments(first, np.ones(len(first), np.int64), mix(key), key, np.repeat(found.owner, found.windows))


class FMIndex:
    """Backward search for patterns of at most `depth` numbers over a text of numbers from 1 on, in which
    0 stands after each passage."""

    def __init__(self, text: np.ndarray, depth: int):
        n = len(text)
        rank, sorted_to = text.astype(np.int64), 1
        while sorted_to < depth:
            step = min(sorted_to, depth - sorted_to)
            after = np.zeros(n, np.int64)
            after[: n - step] = rank[step:] + 1
            rank = np.unique(rank * (n + int(rank.max()) + 2) + after, return_inverse=True)[1]
            sorted_to += step
        self.order = np.argsort(rank, kind="stable")
        #: Where each range of equal beginnings of length `depth` starts.
        self.starts = np.flatnonzero(np.diff(rank[self.order], prepend=-1))
        self.counts = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=int(text.max(initial=0)) + 1))])
        rest = text[self.order - 1]
        self.levels = max(1, int(rest.max(initial=0)).bit_length())
        self.bits, self.ones, self.zeros = [], [], []
        for level in reversed(range(self.levels)):
            bit = (rest >> level) & 1
            packed = np.packbits(bit.astype(np.uint8), bitorder="little")
            packed = np.append(packed, np.zeros(8 + -len(packed) % 8, np.uint8)).view("<u8")
            self.bits.append(packed)
            self.ones.append(np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)]).astype(np.uint32))
            self.zeros.append(n - int(bit.sum()))
            rest = np.concatenate([rest[bit == 0], rest[bit == 1]])
        every = np.arange(len(self.counts) - 1)
        self.base = self._follow(every, np.zeros(len(every), np.int64))

    def _follow(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Places in the order of the last level of what stands before `places` in the first."""
        for depth, (bits, ones, zeros) in enumerate(zip(self.bits, self.ones, self.zeros)):
            word, bit = places >> 6, (places & 63).astype(np.uint64)
            below = bits[word] & ((np.uint64(1) << bit) - np.uint64(1))
            before = ones[word].astype(np.int64) + np.bitwise_count(below)
            one = (symbols >> (self.levels - 1 - depth)) & 1 == 1
            places = np.where(one, zeros + before, places - before)
        return places

    def extend(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ranges of suffixes that have `symbols` before those of the given ranges."""
        both = self._follow(np.concatenate([symbols, symbols]), np.concatenate([low, high]))
        start = self.counts[symbols] - self.base[symbols]
        return start + both[: len(low)], start + both[len(low) :]

    def match(self, text: np.ndarray, ends: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """For each end in `text`, how many of the `depth` numbers before it match, searched backwards, and
        the start of the range of suffixes that begin with them."""
        length = np.zeros(len(ends), np.int64)
        low = np.zeros(len(ends), np.int64)
        open_, high = np.arange(len(ends)), np.full(len(ends), len(self.order))
        for i in range(1, depth + 1):
            symbols = text[ends[open_] - i]
            a, b = self.extend(symbols, low[open_], high)
            found = a < b
            open_, high = open_[found], b[found]
            low[open_] = a[found]
            length[open_] = i
        return length, low


def first_holders(words: list[np.ndarray], holders: np.ndarray, window: int = WINDOW) -> list[np.ndarray]:
    """For each window of the passages (word hashes), the least of `holders` whose passage has it."""
    sizes = np.array([len(w) for w in words])
    symbols = np.unique(np.concatenate(words), return_inverse=True)[1] + 1
    text = np.zeros(len(symbols) + len(words), np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    place = np.arange(len(symbols)) + np.repeat(np.arange(len(words)), sizes)
    text[place] = symbols
    windows = sizes - window + 1
    first = np.repeat(starts - (np.cumsum(windows) - windows), windows) + np.arange(windows.sum())
    index = FMIndex(text, window)
    held = np.full(len(text), np.iinfo(np.int64).max)
    held[first] = np.repeat(holders, windows)
    least = np.minimum.reduceat(held[index.order], index.starts)
    found = np.zeros(len(first), np.int64)
    for begin in range(0, len(first), SEARCHED):
        some = first[begin : begin + SEARCHED]
        length, low = index.match(text, some + window, window)
        assert (length == window).all()  # each passage streamed is in the index
        found[begin : begin + SEARCHED] = least[np.searchsorted(index.starts, low, "right") - 1]
    return np.split(found, np.cumsum(windows)[:-1])


class Bits:
    """Bitmaps of a set of 64-bit hashes, as workers look them up."""

    def __init__(self, rows: list):
        bits = np.zeros((BITMAPS + 1, BITMAP_BITS // 8), np.uint8)
        for bucket, some in rows:
            bits[bucket] = np.frombuffer(some, np.uint8)
        self.bits = bits[1:].reshape(-1)

    def has(self, keys: np.ndarray) -> np.ndarray:
        slot = keys & np.uint64(BITMAPS * BITMAP_BITS - 1)
        return (self.bits[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _sent(spark: SparkSession, keys: DataFrame, key: str) -> Broadcast:
    """The keys as bitmaps (at most 4 MB)."""
    return spark.sparkContext.broadcast(Bits([tuple(r) for r in key_bitmaps(keys, key).collect()]))


def _worded(batch: pa.RecordBatch, column: str) -> Iterator[tuple]:
    """Blocks of some texts of a batch with their words' hashes, bounds of documents, starts and ends in bytes."""
    for block in blocks(batch, column, lower=False):
        starts, ends = spans(block, NOT_SPACE[block.data])
        words = hashes(block.data, starts, ends)
        yield block, words, np.append(np.searchsorted(starts, block.starts), len(starts)), starts, ends


def repeated_anchors(rows: DataFrame, window: int, gram: int) -> Broadcast:
    """Bitmaps of the anchors that two documents hold (and a few more): anchors are told apart by a
    bucket from their upper half and by their lower 32 bits."""
    parts = shuffle_partitions(rows.sparkSession)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spots, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for block, words, bounds, _, _ in _worded(batch, "text"):
                found = segments(words, bounds, window, gram)
                spots.append(found.anchor)
                owners.append(found.owner + block.first)
            spot, owner = np.concatenate(spots), np.concatenate(owners)
            order = np.lexsort((owner, spot))
            spot, owner = spot[order], owner[order]
            fresh = np.ones(len(spot), bool)
            fresh[1:] = (spot[1:] != spot[:-1]) | (owner[1:] != owner[:-1])
            spot = spot[fresh]
            # two of each are enough to know that it repeats
            spot = spot[np.concatenate([np.ones(min(2, len(spot)), bool), spot[2:] != spot[:-2]])]
            bucket = ((spot >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            some, first = np.unique(bucket[order], return_index=True)
            packed = [part.astype("<u4").tobytes() for part in np.split(spot[order], first[1:])] if len(some) else []
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(packed, pa.binary())], ["bucket", "packed"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_bucket: dict[int, list] = defaultdict(list)
        for batch in batches:
            for bucket, some in zip(batch.column("bucket").to_pylist(), batch.column("packed")):
                by_bucket[bucket].append(np.frombuffer(some.as_buffer(), "<u4"))
        for some in by_bucket.values():
            spots = np.sort(np.concatenate(some))
            again = np.unique(spots[1:][spots[1:] == spots[:-1]])
            yield pa.RecordBatch.from_arrays([pa.array(again.astype(np.int64))], ["spot"])

    packed = rows.select("text").mapInArrow(pack, "bucket long, packed binary")
    return _sent(rows.sparkSession, packed.repartition(parts, "bucket").mapInArrow(count, "spot long"), "spot")


def possible_segments(rows: DataFrame, repeated: Broadcast, window: int, gram: int) -> DataFrame:
    """Segments at repeated anchors, once for each batch of documents: anchor, words (joined by one space),
    windows, the least and largest doc_id, and the number of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            for block, words, bounds, starts, ends in _worded(batch, "text"):
                found = segments(words, bounds, window, gram)
                found = found.take(np.flatnonzero(repeated.value.has(found.anchor)))
                if not len(found.first):
                    continue
                order = np.lexsort((found.key, found.anchor))
                found = found.take(order)
                opens = np.ones(len(order), bool)
                opens[1:] = (found.anchor[1:] != found.anchor[:-1]) | (found.key[1:] != found.key[:-1])
                at = np.flatnonzero(opens)
                doc = ids[block.first + found.owner]
                one = found.take(at)
                data = block.data.tobytes()
                cut = zip(starts[one.first].tolist(), ends[one.first + one.windows + window - 2].tolist())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(one.anchor.view(np.int64)),
                        pa.array([b" ".join(data[a:b].split()) for a, b in cut], pa.binary()).cast(pa.string()),
                        pa.array(one.windows), pa.array(np.minimum.reduceat(doc, at)), pa.array(np.maximum.reduceat(doc, at)),
                        pa.array(np.diff(np.append(at, len(doc)))),
                    ],
                    ["anchor", "words", "windows", "least", "largest", "copies"],
                )

    return rows.select("doc_id", "text").mapInArrow(
        run, "anchor long, words string, windows long, least long, largest long, copies long"
    )


def _taken_apart(crowded: DataFrame, window: int) -> DataFrame:
    """Segments as single windows, each once."""
    names = crowded.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, words, bounds, starts, ends in _worded(batch, "words"):
                count = np.diff(bounds) - window + 1
                whole_ = Segments(bounds[:-1], count, np.zeros(block.n, np.uint64), np.zeros(block.n, np.uint64), np.arange(block.n))
                found = single_windows(words, whole_, window)
                data = block.data.tobytes()
                cut = zip(starts[found.first].tolist(), ends[found.first + window - 1].tolist())
                rows = pa.array(block.first + found.owner)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(found.anchor.view(np.int64)), pa.array([data[a:b] for a, b in cut], pa.binary()).cast(pa.string()), pa.array(found.windows),
                        *(batch.column(c).take(rows) for c in ("least", "largest", "copies")),
                    ],
                    names,
                )

    return (
        crowded.mapInArrow(run, crowded.schema)
        .groupBy("anchor", "words", "windows")
        .agg(F.min("least").alias("least"), F.max("largest").alias("largest"), F.sum("copies").alias("copies"))
    )


def searched(parts: DataFrame, shards: int, window: int) -> DataFrame:
    """anchor, key, copies and holders of the segments some of whose windows an earlier document holds;
    `holders` has the least doc_id for each window."""

    def run(table: pa.Table) -> pa.Table:
        batch = table.combine_chunks().to_batches()[0]
        words, bounds = [], []
        for _, some, first, _, _ in _worded(batch, "words"):
            words += np.split(some, first[1:-1])
        every = np.concatenate(words)
        bounds = np.concatenate([[0], np.cumsum([len(w) for w in words])])
        key = sequence_hashes(every, bounds[:-1], bounds[1:])
        anchor = batch.column("anchor").to_numpy()
        order = np.lexsort((key, anchor))
        opens = np.ones(len(order), bool)
        opens[1:] = (anchor[order][1:] != anchor[order][:-1]) | (key[order][1:] != key[order][:-1])
        at = np.flatnonzero(opens)
        least = np.minimum.reduceat(batch.column("least").to_numpy()[order], at)
        largest = np.maximum.reduceat(batch.column("largest").to_numpy()[order], at)
        copies = np.add.reduceat(batch.column("copies").to_numpy()[order], at)
        one = order[at]
        holders = first_holders([words[i] for i in one.tolist()], least, window)
        hit = [i for i, h in enumerate(holders) if h.min() < largest[i]]
        return pa.table(
            {
                "anchor": pa.array(anchor[one[hit]]), "key": pa.array(key[one[hit]].view(np.int64)),
                "copies": pa.array(copies[hit]), "holders": pa.array([holders[i] for i in hit], pa.list_(pa.int64())),
            }
        )

    shard = F.pmod("anchor", F.lit(shards)).alias("shard")
    return parts.select(shard, "anchor", "words", "least", "largest", "copies").groupBy("shard").applyInArrow(
        run, "anchor long, key long, copies long, holders array<long>"
    )


def removed_passages(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, shard_words: int = SHARD_WORDS) -> DataFrame:
    """row1, row2 (the row's digest) and gaps: spans (start, end) of words to remove, of all rows that lose some."""
    spark = docs.sparkSession
    rows = docs.filter("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"), *row_digest(), whole(F.col("text")).alias("text")
    )
    repeated = repeated_anchors(rows, window, gram)
    parts = stored(possible_segments(rows, repeated, window, gram), "segments")
    load = F.sum(F.col("windows") + window - 1)
    shards = max(1, -(-(parts.agg(load).first()[0] or 0) // shard_words))
    # no more anchors than shards can be crowded
    crowded = stored(parts.groupBy("anchor").agg(load.alias("words")).filter(F.col("words") > shard_words).select("anchor"), "crowded")
    apart = np.sort(np.array([r.anchor for r in crowded.collect()], np.int64))
    known = spark.sparkContext.broadcast(apart)
    if len(apart):
        alone = _taken_apart(parts.join(F.broadcast(crowded), "anchor", "left_semi"), window)
        parts = parts.join(F.broadcast(crowded), "anchor", "left_anti").unionByName(alone)
    results = stored(searched(parts, shards, window), "held_passages")
    held = _sent(spark, results.select("key"), "key")

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, words, bounds, _, _ in _worded(batch, "text"):
                found = segments(words, bounds, window, gram)
                found = found.take(np.flatnonzero(repeated.value.has(found.anchor)))
                if len(known.value):
                    split = np.isin(found.anchor.view(np.int64), known.value)
                    single = single_windows(words, found.take(np.flatnonzero(split)), window)
                    rest = found.take(np.flatnonzero(~split))
                    found = Segments(*(np.concatenate([getattr(rest, f), getattr(single, f)]) for f in ("first", "windows", "anchor", "key", "owner")))
                found = found.take(np.flatnonzero(held.value.has(found.key)))
                row = pa.array(block.first + found.owner)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).take(row) for c in ("doc_id", "row1", "row2")),
                        pa.array((found.first - bounds[found.owner]).astype(np.int32)),
                        pa.array(found.anchor.view(np.int64)), pa.array(found.key.view(np.int64)),
                    ],
                    ["doc_id", "row1", "row2", "first", "anchor", "key"],
                )

    def gaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            holders = batch.column("holders")
            flat, size = holders.flatten().to_numpy(), holders.value_lengths().to_numpy()
            owner = np.repeat(np.arange(len(batch)), size)
            place = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
            gone = flat < batch.column("doc_id").to_numpy()[owner]
            opens, closes = gone & (place == 0), gone & (place == size[owner] - 1)
            opens[1:] |= gone[1:] & ~gone[:-1]
            closes[:-1] |= gone[:-1] & ~gone[1:]
            first, last = np.flatnonzero(opens), np.flatnonzero(closes)
            at = batch.column("first").to_numpy()[owner[first]]
            row = pa.array(owner[first])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row1").take(row), batch.column("row2").take(row),
                    pa.array((at + place[first]).astype(np.int32)), pa.array((at + place[last] + window).astype(np.int32)),
                ],
                ["row1", "row2", "start", "end"],
            )

    occurrences = rows.mapInArrow(places, "doc_id long, row1 long, row2 long, first int, anchor long, key long")
    met = with_groups(occurrences, results, ["anchor", "key"], "copies", F.xxhash64("row1", "first"), "inner")
    return (
        met.select("doc_id", "row1", "row2", "first", "holders")
        .mapInArrow(gaps, "row1 long, row2 long, start int, end int")
        .groupBy("row1", "row2")
        .agg(F.collect_list(F.struct("start", "end")).alias("gaps"))
    )


def row_digest() -> list:
    """A 128-bit digest of a row's doc_id and text, as two numbers."""
    text = whole(F.col("text"))
    return [F.xxhash64("doc_id", text).alias("row1"), F.xxhash64(text, "doc_id", F.lit(2)).alias("row2")]


def without_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, shard_words: int = SHARD_WORDS) -> DataFrame:
    """doc_id, n_words, n_removed and kept_text (the words left, joined by one space) of every row."""
    passages = stored(removed_passages(docs, window, gram, shard_words), "passages")
    rows = docs.select("doc_id", *row_digest(), whole(F.col("text")).alias("text"))
    # only texts that may lose words are shuffled
    flagged = flag_possible(rows, "row1", key_bitmaps(passages.select("row1"), "row1"), "touched")
    joined = flagged.filter("touched").drop("touched").join(passages, ["row1", "row2"], "left").select("doc_id", "text", "gaps")
    nothing = F.lit(None).cast("array<struct<start: int, end: int>>").alias("gaps")
    untouched = flagged.filter("NOT touched").select("doc_id", "text", nothing)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, size, out = 0, 0, []
            for i, (text, gaps) in enumerate(zip(batch.column("text"), batch.column("gaps"))):
                words = text.as_buffer().to_pybytes().split()
                kept, at = words, 0
                if gaps.is_valid:
                    kept = []
                    for start, end in sorted((g["start"], g["end"]) for g in gaps.as_py()):
                        kept += words[at:start] if start > at else []
                        at = max(at, end)
                    kept += words[at:]
                joined = b" ".join(kept)
                out.append((len(words), len(words) - len(kept), joined))
                size += len(joined)
                if size > BATCH_BYTES or i + 1 == len(batch):
                    n, removed, texts = zip(*out)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("doc_id").slice(first, len(out)), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                            pa.array(texts, pa.binary()).cast(pa.string()),
                        ],
                        ["doc_id", "n_words", "n_removed", "kept_text"],
                    )
                    first, size, out = i + 1, 0, []

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, n_words long, n_removed long, kept_text string"
    return joined.unionByName(untouched).mapInArrow(cut, schema)
