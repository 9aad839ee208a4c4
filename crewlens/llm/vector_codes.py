"""Vectors as short codes: each of their parts is replaced by its nearest codebook entry.

Codebooks are learned by rounds of assignment and averaging in whole numbers, so a result does not
depend on how the rows are dealt. The nearest entry is found with LAESA: each part's distances to a
few fixed pivots are computed once and written beside it; in each round the pivots' distances to the
entries are computed anew, and the largest difference of the two bounds a part's distance to an entry
from below. Entries are tried in order of their bounds, and exact integer distances are computed only
while a bound does not exceed the best distance so far.

Per round, each task sends at most one row for each codebook entry it used. The driver holds the
codebooks alone (parts x entries x part length numbers).

Defined cases: vectors that are null, that hold null or non-finite components, or that are of another
length than most (ties: the longer) are dropped; a length that the number of parts does not divide is
filled up with zeros; scaled components are held within a bound at which no squared distance
overflows (134,217,728 for 64 components); rows with one id are vectors of their own, and those that
begin a codebook stand in order of id (null last), then components; with fewer vectors than entries
the codebooks are shorter; an empty table gives an empty result; other columns are carried as named.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crewlens.llm.shared import stored

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
PIVOTS = 8
BLOCK_ROWS = 1024
TRIED = 8  # entries whose exact distances are computed between two looks at the bounds


def whole_numbers(vector: Column, length: int, parts: int = PARTS, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component, filled up with zeros to a multiple of `parts`."""
    filled = -(-length // parts) * parts
    most = math.isqrt(2**62 // max(4 * filled, 4))
    scaled = F.transform(
        vector, lambda x: F.floor(F.least(F.greatest(x.cast("double") * scale, F.lit(float(-most))), F.lit(float(most)))).cast("int")
    )
    return F.concat(scaled, F.array_repeat(F.lit(0), filled - length)) if filled > length else scaled


def usable(vector: Column) -> Column:
    """True for vectors of finite components."""
    return F.coalesce(
        F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False))), F.lit(False)
    )


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distance of each row of `x` to each entry, in whole numbers."""
    out = np.zeros((len(x), len(entries)), np.int64)
    for i in range(x.shape[1]):
        gap = x[:, i, None] - entries[None, :, i]
        out += gap * gap
    return out


def choose_pivots(entries: np.ndarray, pivots: int = PIVOTS) -> np.ndarray:
    """Entries far from one another: each next one has the largest distance to its nearest pivot."""
    chosen = [0]
    nearest = distances(entries, entries[:1])[:, 0]
    while len(chosen) < min(pivots, len(entries)) and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, distances(entries, entries[chosen[-1:]])[:, 0])
    return entries[chosen]


def nearest_entries(
    x: np.ndarray, to_pivots: np.ndarray, entries: np.ndarray, pivots: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """For each row its nearest entry (ties: the first), their squared distance, and the number of
    exact distances computed in all. `to_pivots`: the rows' distances to the pivots."""
    from_pivots = np.sqrt(distances(entries, pivots).astype(np.float64))
    bound = np.zeros((len(x), len(entries)))
    for p in range(len(pivots)):
        a, b = to_pivots[:, p, None], from_pivots[None, :, p]
        # less than the difference by more than two roots can err
        np.maximum(bound, np.abs(a - b) - (a + b) * 1e-15, out=bound)
    bound *= bound * (1 - 1e-12)
    order = np.argsort(bound, axis=1, kind="stable")
    best = np.full(len(x), np.iinfo(np.int64).max)
    at = np.zeros(len(x), np.int64)
    open_, tried = np.arange(len(x)), 0
    for begin in range(0, len(entries), TRIED):
        some = order[open_, begin : begin + TRIED]
        gap = x[open_][:, None, :] - entries[some]
        exact = (gap * gap).sum(axis=2)
        tried += exact.size
        least = exact.min(axis=1)
        first = np.where(exact == least[:, None], some, len(entries)).min(axis=1)
        better = (least < best[open_]) | ((least == best[open_]) & (first < at[open_]))
        best[open_[better]], at[open_[better]] = least[better], first[better]
        if begin + TRIED >= len(entries):
            break
        open_ = open_[bound[open_, order[open_, begin + TRIED]] <= best[open_]]
        if not len(open_):
            break
    return at, best, tried


def _matrix(column: pa.Array, width: int, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(column), width)


@dataclass
class Codes:
    rows: DataFrame  # the carried columns, codes array<int>, error long
    codebooks: list[np.ndarray]  # for each part its entries, one row each

    def codebook_text(self) -> str:
        """All components by part, entry and position, separated by commas."""
        return ",".join(str(x) for book in self.codebooks for x in book.ravel().tolist())


def encode(
    df: DataFrame, vector: str = "embedding", order: str = "vec_id", carry: Sequence[str] = ("vec_id",),
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
) -> Codes:
    """Learn codebooks from all vectors of `df` and encode them."""
    fine = df.filter(usable(F.col(f"`{vector}`")))
    commonest = fine.groupBy(F.size(F.col(f"`{vector}`")).alias("length")).count().orderBy(F.desc("count"), F.desc("length"))
    length = (commonest.first() or [0])[0]
    width = -(-length // parts)  # of a part
    held = [F.col(f"`{c}`").alias(f"carry{i}") for i, c in enumerate(carry)]
    numbers = fine.filter(F.size(F.col(f"`{vector}`")) == length).select(
        F.col(f"`{order}`").alias("place"), *held, whole_numbers(F.col(f"`{vector}`"), length, parts, scale).alias("numbers")
    )
    first = numbers.orderBy(F.col("place").asc_nulls_last(), "numbers").limit(entries).select("numbers").collect()
    begun = np.array([r[0] for r in first], np.int64).reshape(len(first), parts, width)
    books = [np.ascontiguousarray(begun[:, part]) for part in range(parts)]
    fixed = [choose_pivots(book) if len(book) else book for book in books]
    edges = np.cumsum([0, *(len(p) for p in fixed)])

    def cut(batch: pa.RecordBatch, begin: int) -> list[np.ndarray]:
        some = batch.column("numbers").slice(begin, BLOCK_ROWS)
        every = _matrix(some, parts * width, np.int64)
        return [every[:, k * width : (k + 1) * width] for k in range(parts)]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.zeros((0, edges[-1]))]
            for begin in range(0, len(batch), BLOCK_ROWS):
                found.append(np.sqrt(np.hstack([distances(x, p) for x, p in zip(cut(batch, begin), fixed)]).astype(np.float64)))
            every = np.concatenate(found)
            offsets = pa.array(np.arange(len(batch) + 1) * int(edges[-1]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.ListArray.from_arrays(offsets, pa.array(every.ravel()))], [*batch.schema.names, "to_pivots"]
            )

    kept = numbers.drop("place")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema)
    measured = stored(kept.mapInArrow(measure, f"{kinds}, to_pivots array<double>"), "vector_parts")

    def assigned(batch: pa.RecordBatch, books: list[np.ndarray]) -> Iterator[tuple[list[np.ndarray], np.ndarray, np.ndarray]]:
        """Some rows at a time: their parts, codes and squared distances, one column for each part."""
        for begin in range(0, len(batch), BLOCK_ROWS):
            xs = cut(batch, begin)
            to_pivots = _matrix(batch.column("to_pivots").slice(begin, BLOCK_ROWS), int(edges[-1]), np.float64)
            found = [
                nearest_entries(x, to_pivots[:, edges[k] : edges[k + 1]], books[k], fixed[k]) for k, x in enumerate(xs)
            ]
            yield xs, np.stack([f[0] for f in found], 1), np.stack([f[1] for f in found], 1)

    sums = [f"s{i}" for i in range(width)]

    def sum_up(books: list[np.ndarray]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n = np.zeros((parts, entries), np.int64)
            total = np.zeros((parts, entries, width), np.int64)
            for batch in batches:
                for xs, codes, _ in assigned(batch, books):
                    for k, x in enumerate(xs):
                        n[k] += np.bincount(codes[:, k], minlength=entries)
                        by = np.argsort(codes[:, k], kind="stable")
                        used, starts = np.unique(codes[by, k], return_index=True)
                        total[k, used] += np.add.reduceat(x[by], starts)
            part, entry = np.nonzero(n)
            columns = [part, entry, n[part, entry], *(total[part, entry, i] for i in range(width))]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["part", "entry", "n", *sums])

        return run

    schema = "part long, entry long, n long" + "".join(f", {s} long" for s in sums)
    for _ in range(rounds if len(first) and width else 0):
        wide = [F.sum(F.col(s).cast("decimal(38,0)")).alias(s) for s in sums]
        used = measured.drop(*(f"carry{i}" for i in range(len(carry)))).mapInArrow(sum_up(books), schema)
        books = [book.copy() for book in books]
        for row in used.groupBy("part", "entry").agg(F.sum("n").alias("n"), *wide).collect():
            books[row.part][row.entry] = [int(row[s]) // row.n for s in sums]

    final = books
    outer = [f.name for f in kept.schema if f.name != "numbers"]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(assigned(batch, final))
            codes = np.concatenate([np.zeros((0, parts), np.int64), *(f[1] for f in found)]).astype(np.int32)
            error = np.concatenate([np.zeros(0, np.int64), *(f[2].sum(axis=1) for f in found)])
            offsets = pa.array(np.arange(len(batch) + 1) * parts, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in outer), pa.ListArray.from_arrays(offsets, pa.array(codes.ravel())), pa.array(error)],
                [*outer, "codes", "error"],
            )

    outer_kinds = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in kept.schema if f.name != "numbers")
    rows = measured.mapInArrow(write, f"{outer_kinds}codes array<int>, error long")
    named = [F.col(f"carry{i}").alias(c) for i, c in enumerate(carry)]
    return Codes(rows.select(*named, "codes", "error"), books)
