"""N-gram Jaccard join: which documents share at least `threshold` of their word n-grams.

MinHash banding finds candidates. The rows of a band and the number of bands follow from a target
recall at the threshold. Documents with one n-gram set are one class from the start, with a number of its
own and the text of one of its rows; the classes' representatives meet by band hash. Within a bucket, sketches are compared with one representative
at a time, and only a spanning set of likely pairs leaves it, never all pairs. What hangs together
by likely pairs is a cluster; each representative's text goes to its cluster once, where all pairs
are verified on the full n-gram sets by a matrix product. A cluster with many n-grams is dealt to
blocks, and each pair of blocks is a task of its own.

Cost: a cluster of m different texts takes m * m / 2 comparisons (not rows): inherent in counting
every document's links. Rows and shuffles grow with the number of documents.

Words are runs of digits, letters and anything beyond ASCII, with A-Z lower-cased. A text of fewer
than n words has one n-gram, all its words.

Defined cases: a null text or one without words links to nothing and is a class of its own; rows
that repeat a doc_id count as documents of their own, each row with one result; a row with a null
doc_id belongs to its class by its text; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crewlens.llm.shared import key_bitmaps, only_possible, returning_memory, shuffle_partitions, stored, whole
from crewlens.llm.wordhash import WORD_BYTES, blocks, mix, word_hashes

N = 5
THRESHOLD = 0.8
RECALL = 0.998
ROWS = 7
BUCKET_ROWS = 1024  # a bucket with more is dealt to parts, and each pair of parts is compared
# A cluster with more n-grams or documents is dealt to blocks.
BLOCK_GRAMS = 250_000
BLOCK_DOCS = 1024
COLUMNS = 4096  # of the matrix product at a time


def bands_for(threshold: float, recall: float, rows: int = ROWS) -> int:
    """Bands that a pair at the threshold shares at least one of with probability `recall`."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))


def slack(threshold: float, hashes: int) -> float:
    """The least share of equal hashes of a likely pair: 3.5 standard errors below the threshold."""
    return threshold - 3.5 * math.sqrt(threshold * (1 - threshold) / hashes)


def gram_sets(batch: pa.RecordBatch, n: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For some documents at a time: number of the first, their distinct n-gram hashes side by side,
    and where each document's begin (one more number than documents)."""
    for block in blocks(batch):
        words, first = word_hashes(block, WORD_BYTES)
        count = np.diff(first)
        long = count >= n
        grams = np.zeros(max(len(words) - n + 1, 0), np.uint64)
        for i in range(n):
            grams = mix(grams * np.uint64(0x9E3779B97F4A7C15) + words[i : i + len(grams)])
        owner = np.repeat(np.arange(block.n), count)
        inside = owner[: len(grams)] == owner[n - 1 : n - 1 + len(grams)] if len(grams) else np.zeros(0, bool)
        grams, owner_of = grams[inside], owner[: len(grams)][inside]
        short = np.flatnonzero(~long & (count > 0))
        folded = np.zeros(len(short), np.uint64)
        for i in range(n - 1):
            more = count[short] > i
            folded[more] = mix(folded[more] * np.uint64(0xD6E8FEB86659FD93) + words[first[short[more]] + i])
        grams = np.concatenate([grams, folded])
        owner_of = np.concatenate([owner_of, short])
        order = np.lexsort((grams, owner_of))
        grams, owner_of = grams[order], owner_of[order]
        fresh = np.ones(len(grams), bool)
        fresh[1:] = (grams[1:] != grams[:-1]) | (owner_of[1:] != owner_of[:-1])
        grams, owner_of = grams[fresh], owner_of[fresh]
        yield block.first, grams, np.searchsorted(owner_of, np.arange(block.n + 1))


def row_keys() -> list[Column]:
    """A 128-bit digest of a row's doc_id and text, as two numbers."""
    text = whole(F.col("text"))
    return [F.xxhash64("doc_id", text).alias("row1"), F.xxhash64(text, "doc_id", F.lit(1)).alias("row2")]


def sketches(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """doc_id, the row's keys, a 128-bit digest of the n-gram set (null without words), its size, the band hashes,
    and one byte of each MinHash."""
    hashes = bands * rows
    multipliers = mix(np.arange(hashes, dtype=np.uint64) + np.uint64(0x1F123BB5)) | np.uint64(1)
    weights = mix(np.arange(rows, dtype=np.uint64) + np.uint64(0x77A5)) | np.uint64(1)
    salts = mix(np.arange(bands, dtype=np.uint64) + np.uint64(0x51ED27))

    @returning_memory
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.zeros(len(batch), np.int32)
            set1, set2 = np.zeros(len(batch), np.uint64), np.zeros(len(batch), np.uint64)
            least = np.zeros((len(batch), hashes), np.uint32)
            for begin, grams, first in gram_sets(batch, n):
                count = np.diff(first)
                full = np.flatnonzero(count)
                size[begin : begin + len(count)] = count
                if not len(full):
                    continue
                at, rows_ = first[full], begin + full
                set1[rows_] = np.add.reduceat(grams, at)
                set2[rows_] = np.add.reduceat(mix(grams ^ np.uint64(0xA0761D6478BD642F)), at)
                for k in range(hashes):
                    least[rows_, k] = np.minimum.reduceat(grams * multipliers[k], at) >> np.uint64(32)
            keys = mix((least.reshape(-1, bands, rows) * weights).sum(axis=2, dtype=np.uint64) ^ salts)
            empty = size == 0
            offsets = pa.array(np.arange(len(batch) + 1) * bands, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("row1"), batch.column("row2"),
                    pa.array(set1.view(np.int64), mask=empty), pa.array(set2.view(np.int64), mask=empty), pa.array(size),
                    pa.ListArray.from_arrays(offsets, pa.array(keys.view(np.int64).ravel())),
                    pa.array([row.tobytes() for row in least.astype(np.uint8)], pa.binary()),
                ],
                ["doc_id", "row1", "row2", "set1", "set2", "n_grams", "bands", "sketch"],
            )

    kept = docs.select("doc_id", *row_keys(), whole(F.col("text")).alias("text"))
    schema = "row1 long, row2 long, set1 long, set2 long, n_grams int, bands array<long>, sketch binary"
    return kept.mapInArrow(run, f"doc_id {dict(kept.dtypes)['doc_id']}, {schema}")


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Whole groups of a stream that is sorted by `keys`; several groups at a time."""
    held: list[pa.RecordBatch] = []

    def last_start(batch: pa.RecordBatch) -> int:
        new = np.zeros(len(batch), bool)
        for key in keys:
            column = batch.column(key).to_numpy(zero_copy_only=False)
            new[1:] |= column[1:] != column[:-1]
        places = np.flatnonzero(new)
        return int(places[-1]) if len(places) else 0

    def same(a: pa.RecordBatch, b: pa.RecordBatch) -> bool:
        return all(a.column(k)[len(a) - 1] == b.column(k)[0] for k in keys)

    for batch in batches:
        if not len(batch):
            continue
        if held and not same(held[-1], batch):
            yield pa.Table.from_batches(held)
            held = []
        start = last_start(batch)
        if start:
            yield pa.Table.from_batches([*held, batch.slice(0, start)])
            held = []
        held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def _group_starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    new = np.zeros(len(table), bool)
    new[:1] = True
    for key in keys:
        column = table.column(key).to_numpy()
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


def likely_edges(sketch: np.ndarray, starts: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Pairs of rows that connect all rows of a group whose sketches agree in a share of `least`.

    Rows of a group that agree with its first row join it. Of the others, those near enough to agree
    with some row that joined (the distance is a metric) are compared with these; then the others
    go on as a group of their own.
    """
    edges: list[tuple[int, int]] = []
    group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(sketch))))
    rows = np.arange(len(sketch))
    while len(rows):
        head = np.concatenate([[True], group[1:] != group[:-1]])
        hub = rows[np.flatnonzero(head)[np.cumsum(head) - 1]]
        share = (sketch[rows] == sketch[hub]).mean(axis=1)
        joined = share >= least
        edges += [(a, b) for a, b in zip(hub[joined].tolist(), rows[joined].tolist()) if a != b]
        near = ~joined & (share >= 2 * least - 1)
        for g in np.unique(group[near]).tolist():
            mine = group == g
            ball = rows[mine & joined]
            for row in rows[mine & near].tolist():
                agree = np.flatnonzero((sketch[ball] == sketch[row]).mean(axis=1) >= least)
                if len(agree):
                    edges.append((int(ball[agree[0]]), row))
        rows, group = rows[~joined], group[~joined]
    return edges


def candidate_edges(representatives: DataFrame, least: float) -> DataFrame:
    """Distinct likely pairs (a, b) of representatives that meet in a bucket."""
    banded = representatives.select("rep", "sketch", F.explode("bands").alias("bucket"))
    sizes = stored(banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1"), "buckets")
    members = only_possible(banded, "bucket", key_bitmaps(sizes, "bucket")).join(sizes, "bucket")
    parts = F.ceil(F.col("rows") / BUCKET_ROWS)
    keys = ["bucket", "first", "second"]

    @returning_memory
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in sorted_groups(batches, keys):
            sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(len(table), -1)
            ids = table.column("rep").to_numpy()
            edges = np.array(likely_edges(sketch, _group_starts(table, keys), least), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(ids[edges[:, 0]]), pa.array(ids[edges[:, 1]])], ["a", "b"])

    return (
        members.withColumn("part", F.pmod(F.xxhash64("rep"), parts))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
        .withColumn("first", F.least("part", "other"))
        .withColumn("second", F.greatest("part", "other"))
        .select(*keys, "rep", "sketch")
        .repartition(shuffle_partitions(representatives.sparkSession), *keys)
        .sortWithinPartitions(*keys, "rep")
        .mapInArrow(run, "a long, b long")
        .filter("a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """node and root, its component's least node, for all nodes of `edges` (a, b).

    Each round ties every neighbour to the least node it can see (large star, then small star); the
    number of rounds grows with the logarithm of a component's size. Rounds are written to the
    shared folder.
    """
    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())

    def towards_least(df: DataFrame) -> DataFrame:
        return df.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))

    edges = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = both.join(towards_least(both), "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.filter("a <> b").distinct()
        small = large.join(towards_least(large), "a")
        small = small.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(small.select("a", F.col("low").alias("b")))
        edges = stored(small.filter("a <> b").distinct(), "edges")
        after = state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def verify_group(
    texts: pa.RecordBatch, ids: np.ndarray, side: np.ndarray | None, copies: np.ndarray, n: int, threshold: float
) -> tuple[np.ndarray, np.ndarray]:
    """Documents linked with each row, and the least id that links connect it with.

    `side` is 0 for rows of the first block and 1 for those of the second, and pairs are of one row
    of each; without it any two rows are a pair.
    """
    grams, sizes = [], []
    for _, some, first in gram_sets(texts, n):
        grams.append(some)
        sizes.append(np.diff(first))
    size = np.concatenate(sizes)
    owner = np.repeat(np.arange(len(ids)), size)
    _, gram, count = np.unique(np.concatenate(grams), return_inverse=True, return_counts=True)
    shared = count[gram] > 1
    owner, gram = owner[shared], gram[shared]
    column = (np.cumsum(count > 1) - 1)[gram]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    if side is None:
        left = right = np.arange(len(ids))
    else:
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    common = np.zeros((len(left), len(right)), np.float32)
    for begin in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, [begin, begin + COLUMNS])
        has = np.zeros((len(ids), COLUMNS), np.float32)
        has[owner[a:b], column[a:b] - begin] = 1
        common += has[left] @ has[right].T
    together = size[left][:, None] + size[right][None, :] - common.astype(np.float64)
    linked = common / together >= threshold
    if left is right:
        np.fill_diagonal(linked, False)
    links = np.zeros(len(ids), np.int64)
    links[left] += linked @ copies[right]
    if left is not right:
        links[right] += linked.T @ copies[left]
    low = ids.copy()
    while True:
        towards = low.copy()
        towards[left] = np.minimum(towards[left], np.where(linked, low[right][None, :], np.iinfo(np.int64).max).min(axis=1, initial=np.iinfo(np.int64).max))
        towards[right] = np.minimum(towards[right], np.where(linked, towards[left][:, None], np.iinfo(np.int64).max).min(axis=0, initial=np.iinfo(np.int64).max))
        if (towards == low).all():
            return links, low
        low = towards


def verified(docs: DataFrame, clusters: DataFrame, n: int, threshold: float) -> DataFrame:
    """rep, links (documents) and least linked rep of the representatives in `clusters`
    (rep, row1, row2, root, copies, n_grams). Each has the text of its row, once."""
    blocks = F.greatest(F.ceil(F.sum("n_grams") / BLOCK_GRAMS), F.ceil(F.count(F.lit(1)) / BLOCK_DOCS))
    totals = clusters.groupBy("root").agg(blocks.alias("blocks"))
    sized = stored(clusters.join(totals, "root"), "clusters")
    texts = only_possible(
        docs.select(*row_keys(), whole(F.col("text")).alias("text")), "row1", key_bitmaps(sized.select("row1"), "row1")
    ).groupBy("row1", "row2").agg(F.first("text").alias("text"))
    block = F.pmod(F.xxhash64("rep"), F.col("blocks"))
    members = texts.join(sized, ["row1", "row2"]).withColumn("block", block).select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    )
    keys = ["root", "first", "second"]

    @returning_memory
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in sorted_groups(batches, keys):
            table = table.combine_chunks()
            starts = _group_starts(table, keys)
            out = []
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(table)]):
                group = table.slice(a, b - a).combine_chunks().to_batches()[0]
                ids = group.column("rep").to_numpy()
                two = group.column("first")[0] != group.column("second")[0]
                side = group.column("side").to_numpy() if two else None
                found = verify_group(group, ids, side, group.column("copies").to_numpy(), n, threshold)
                out.append((ids, *found, group.column("blocks").to_numpy()))
            columns = [np.concatenate(x) for x in zip(*out)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["rep", "links", "low", "blocks"])

    rows = (
        members.withColumn("first", F.least("block", "other"))
        .withColumn("second", F.greatest("block", "other"))
        .withColumn("side", (F.col("block") != F.col("first")).cast("int"))
        .select(*keys, "rep", "side", "copies", "blocks", "text")
        .repartition(shuffle_partitions(docs.sparkSession), *keys)
        .sortWithinPartitions(*keys, "rep")
        .mapInArrow(run, "rep long, links long, low long, blocks long")
    )
    rows = stored(rows, "verified")
    across = components(rows.filter("blocks > 1 AND rep <> low").select(F.col("rep").alias("a"), F.col("low").alias("b")))
    return (
        rows.groupBy("rep").agg(F.sum("links").alias("links"), F.min("low").alias("low"))
        .join(across, F.col("rep") == F.col("node"), "left")
        .select("rep", "links", F.coalesce("root", "low").alias("low"))
    )


def joined_rows(
    docs: DataFrame, n: int = N, threshold: float = THRESHOLD, recall: float = RECALL, rows: int = ROWS
) -> DataFrame:
    """row1, row2 (`row_keys`), doc_id, class_id and n_links of every row."""
    bands = bands_for(threshold, recall, rows)
    drawn = stored(sketches(docs, n, bands, rows), "sketches")
    worded = drawn.filter("n_grams > 0")
    sets = ["set1", "set2"]
    # The number of a class is drawn once: it is read from the table from here on.
    classes = stored(
        worded.groupBy(*sets)
        .agg(F.min("doc_id").alias("least"), F.min(F.struct("row1", "row2")).alias("row"), F.count(F.lit(1)).alias("copies"))
        .select(*sets, "least", "row.row1", "row.row2", "copies", F.monotonically_increasing_id().alias("rep")),
        "classes",
    )
    representatives = (
        worded.select(*sets, "row1", "row2", "n_grams", "bands", "sketch")
        .join(classes.drop("least"), [*sets, "row1", "row2"]).dropDuplicates(["rep", *sets, "row1", "row2"])
    )
    edges = candidate_edges(representatives.select("rep", "sketch", "bands"), slack(threshold, bands * rows))
    clusters = components(edges).withColumnRenamed("node", "rep").join(
        representatives.select("rep", "row1", "row2", "copies", "n_grams"), "rep"
    )
    found = stored(verified(docs, clusters, n, threshold), "found")
    least = found.join(classes.select("rep", "least"), "rep").groupBy("low").agg(F.min("least").alias("low_id"))
    found = found.join(least, "low").select("rep", "links", "low_id", F.lit(True).alias("linked"))
    of_class = classes.join(found, "rep", "left").select(
        *sets,
        F.when(F.col("linked"), F.col("low_id")).otherwise(F.col("least")).alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    columns = ["row1", "row2", "doc_id", "class_id", "n_links"]
    alone = drawn.filter("n_grams = 0").withColumns({"class_id": F.col("doc_id"), "n_links": F.lit(0).cast("long")})
    return worded.join(of_class, sets).select(*columns).unionByName(alone.select(*columns))


def jaccard_join(
    docs: DataFrame, n: int = N, threshold: float = THRESHOLD, recall: float = RECALL, rows: int = ROWS
) -> DataFrame:
    """doc_id, class_id (the least doc_id of all that links connect), n_links (documents linked)."""
    return joined_rows(docs, n, threshold, recall, rows).select("doc_id", "class_id", "n_links")
