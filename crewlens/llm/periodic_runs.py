"""Runs: stretches of words that repeat with a period, at least `EXPONENT` times over.

Recursive frequency splitting comes first. In a run each of its words stands at least `EXPONENT`
times, so a word that stands more rarely in the segment looked at is in no run of it: it splits the
segment, and the pieces, in which words are rarer still, are split in turn until none has a rare
word. Of a split segment the smaller side is counted, so n words cost O(n log n) steps at most.

Only the segments left are scanned lag by lag. The words at a lag q are equal along a whole run of
period q, for at least (EXPONENT - 1) * q words on end; of any such stretch one block of half that
length, beginning at a multiple of it, is part. Per lag it is thus enough to compare these blocks, by
prefix hashes; what is found is extended word by word and so confirmed. That is O(m log m) for a
segment of m words. A stretch already known by a divisor of q has a smaller period and is passed over.

Each document is one row of one task; nothing is shuffled.

Defined cases: words are runs of anything but \\x20 and \\x09-\\x0D, compared as they are; a null
text, or one without words, has no run and an empty collapsed text; each row is a document of its own,
whatever its doc_id (null or repeated); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crewlens.llm.shared import whole

EXPONENT = 4
SHORTEST = 6
BATCH_BYTES = 8 << 20  # of texts returned at a time
_BASE = np.uint64(0x9E3779B97F4A7C15)

Run = tuple[int, int, int]  # start, length, period


def stable_segments(words: list, exponent: int = EXPONENT, shortest: int = SHORTEST) -> list[tuple[int, int]]:
    """Bounds of the segments in which every word stands at least `exponent` times."""
    found = []
    counts = Counter(words)
    rare = {w for w, n in counts.items() if n < exponent}
    if not rare:
        return [(0, len(words))] if len(words) >= shortest else []
    cuts = [i for i, w in enumerate(words) if w in rare]
    todo = [(0, len(words), counts, cuts)]
    places: dict = {}
    while todo:
        begin, end, counts, cuts = todo.pop()
        edges = [begin - 1, *cuts, end]
        pieces = [(a + 1, b) for a, b in zip(edges, edges[1:]) if b - a > shortest]
        if not pieces:
            continue
        large = max(pieces, key=lambda p: p[1] - p[0])
        for piece in pieces:
            if piece == large and 2 * (large[1] - large[0]) > end - begin:
                # most of the segment: take away what stands outside
                outside = Counter(words[begin : large[0]])
                outside.update(words[large[1] : end])
                counts.subtract(outside)
                own = counts
                rare = [w for w in outside if 0 < own[w] < exponent]
                for w in outside:
                    if not own[w]:
                        del own[w]
                if rare and not places:
                    places = defaultdict(list)
                    for i, w in enumerate(words):
                        places[w].append(i)
                inner = sorted(i for w in rare for i in _within(places[w], *piece))
            else:
                own = Counter(words[piece[0] : piece[1]])
                few = {w for w, n in own.items() if n < exponent}
                inner = [i for i in range(*piece) if words[i] in few] if few else []
            if inner:
                todo.append((*piece, own, inner))
            else:
                found.append(piece)
    return sorted(found)


def _within(places: list[int], begin: int, end: int) -> list[int]:
    """The places from `begin` up to `end`, of an ascending list."""
    return places[bisect_left(places, begin) : bisect_left(places, end)]


def _reach(ids: np.ndarray, at: int, lag: int, step: int) -> int:
    """How many words from `at` on (`step` 1) or before `at` (`step` -1) equal those `lag` further."""
    n, length = 0, 64
    while True:
        if step > 0:
            left, right = ids[at + n : at + n + length], ids[at + n + lag : at + n + lag + length]
            left = left[: len(right)]
        else:
            low = max(0, at - n - length)
            left, right = ids[low : at - n][::-1], ids[low + lag : at - n + lag][::-1]
        if not len(left):
            return n
        unlike = np.flatnonzero(left != right)
        if len(unlike):
            return n + int(unlike[0])
        n += len(left)
        length *= 2


def scan_lags(ids: np.ndarray, exponent: int = EXPONENT, shortest: int = SHORTEST) -> list[Run]:
    """All runs of a segment, given as numbers that are equal where its words are."""
    n = len(ids)
    powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _BASE)]), dtype=np.uint64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93) * powers[:n], out=sums[1:])
    found: list[Run] = []
    long = np.zeros((0, 3), np.int64)
    for lag in range(1, n // exponent + 1):
        same = max(shortest, exponent * lag) - lag  # words in a row that equal those at the lag, at least
        block = (same + 1) // 2
        at = np.arange(0, n - lag - block + 1, block)
        hashes = (sums[at + block] - sums[at]) * powers[lag]
        at = at[hashes == sums[at + lag + block] - sums[at + lag]]
        if not len(at):
            continue
        for start, length, period in long[lag % long[:, 2] == 0].tolist():
            at = at[(at < start) | (at + lag + block > start + length)]
        done, fresh = -1, []
        for begin in at.tolist():
            if begin + block + lag <= done:
                continue
            start = begin - _reach(ids, begin, lag, -1)
            end = begin + _reach(ids, begin, lag, 1) + lag
            if end - start >= same + lag:
                fresh.append((start, end - start, lag))
            done = max(done, end)
        found += fresh
        long = np.concatenate([long, np.array(fresh, np.int64).reshape(-1, 3)])
        long = long[long[:, 1] >= lag + block]  # shorter ones hold no block of a longer lag
    return found


def find_runs(words: list, exponent: int = EXPONENT, shortest: int = SHORTEST) -> list[Run]:
    """All runs of a document's words by start, then period."""
    found = []
    for begin, end in stable_segments(words, exponent, shortest):
        numbers: dict = {}
        ids = np.array([numbers.setdefault(w, len(numbers)) for w in words[begin:end]], np.int64)
        found += [(begin + start, length, period) for start, length, period in scan_lags(ids, exponent, shortest)]
    return sorted(found, key=lambda run: (run[0], run[2]))


def collapse(words: list, runs: list[Run]) -> list:
    """The words that no run holds after its first period."""
    kept, at = [], 0
    for begin, end in sorted((start + period, start + length) for start, length, period in runs):
        if begin > at:
            kept += words[at:begin]
        at = max(at, end)
    return kept + words[at:]


def periodic_runs(docs: DataFrame, exponent: int = EXPONENT, shortest: int = SHORTEST) -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period by start, then period) and collapsed
    (the kept words joined by one space) of every row."""
    kind = dict(docs.dtypes)["doc_id"]
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids = batch.column("doc_id")
            first, size, out = 0, 0, []
            for i, text in enumerate(batch.column("text")):
                words = text.as_buffer().to_pybytes().split() if text.is_valid else []
                runs = find_runs(words, exponent, shortest)
                kept = b" ".join(collapse(words, runs) if runs else words)
                out.append((len(words), [dict(zip(("start", "length", "period"), r)) for r in runs], kept))
                size += len(kept) + 24 * len(runs)
                if size > BATCH_BYTES or i + 1 == len(batch):
                    n, found, texts = zip(*out)
                    yield pa.RecordBatch.from_arrays(
                        [
                            doc_ids.slice(first, len(out)), pa.array(n, pa.int64()), pa.array(found, run_type),
                            pa.array(texts, pa.binary()).cast(pa.string()),
                        ],
                        ["doc_id", "n_words", "runs", "collapsed"],
                    )
                    first, size, out = i + 1, 0, []

    runs = "array<struct<start: long, length: long, period: long>>"
    rows = docs.select("doc_id", whole(F.col("text")).alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, n_words long, runs {runs}, collapsed string")
