"""Words of Arrow text batches as 64-bit hashes, found and hashed by numpy some documents at a time."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 18  # a block's arrays take some forty times this, and stay in a core's cache
_PRIME = np.uint64(0x9E3779B97F4A7C15 | 1)
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def byte_table(chars: bytes, value: bool) -> np.ndarray:
    table = np.full(256, not value)
    table[list(chars)] = value
    return table


#: Bytes of words that white space separates.
NOT_SPACE = byte_table(b" \t\n\x0b\x0c\r", False)
#: Digits, letters and everything beyond ASCII.
WORD_BYTES = byte_table(bytes(i for i in range(256) if i >= 0x80 or chr(i).isalnum()), True)
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _grow_powers(n: int) -> None:
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, BLOCK_BYTES + 1)
        _powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, _PRIME)]), dtype=np.uint64)
        inverse = np.uint64(pow(int(_PRIME), -1, 1 << 64))
        _inverses = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, inverse)]), dtype=np.uint64)


@dataclass
class Block:
    """Some documents of a batch: the lower-cased bytes and where each document begins and ends."""

    first: int  # number of the first document in the batch
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    @property
    def n(self) -> int:
        return len(self.starts)


def blocks(batch: pa.RecordBatch, column: str = "text", lower: bool = True) -> Iterator[Block]:
    texts = batch.column(column).cast(pa.large_string())
    _, offsets, values = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(values or b"", np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + BLOCK_BYTES, "right")) - 1)
        piece = data[ends[first] : ends[last]]
        edges = ends[first : last + 1] - ends[first]
        yield Block(first, LOWER[piece] if lower else piece, edges[:-1], edges[1:])
        first = last


def spans(block: Block, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of `inside` (a flag for each byte), cut at document bounds."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    bounds = block.starts[block.starts < n]
    begins[bounds] = inside[bounds]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    lasts = block.ends[(block.ends > 0) & (block.ends <= n)] - 1
    stops[lasts] = inside[lasts]
    return np.flatnonzero(begins), np.flatnonzero(stops) + 1


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes, the same wherever it stands."""
    _grow_powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers[: len(data)], out=sums[1:])
    raw = (sums[ends] - sums[starts]) * _inverses[starts]
    return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_hashes(block: Block, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the block's words and, for each document, the number of the first (n + 1 numbers)."""
    starts, ends = spans(block, table[block.data])
    words = hashes(block.data, starts, ends)
    return words, np.append(np.searchsorted(starts, block.starts), len(starts))
