"""Language-model scoring with Elias-Fano n-gram tries.

The model is a trigram model whose logarithm falls into parts of single words:

    p(w | u, v) = (c(u, v, w) + SHARE (c(v, w) + PRIOR p(w))) / (c(u, v) + SHARE (c(v) + PRIOR))

over p(w) = (c(w) + 0.1) / (N + 0.1 (V + 1)); it sums to one over the training words and one unknown.
The numerator needs only counts of n-grams that end in w, and the denominator only counts of n-grams
that end in v. Hence all counts are dealt by an n-gram's last word: a shard holds the trie of its words,
and answers for them alone. No model is broadcast or collected; it grows with the corpus.

A shard's trie has three levels. The first holds its words; the second, for each word, the words v that
stood before it, as ranks among the shard's contexts; the third, for each such pair, the words u before
that. Contexts, pointers and ranks are monotone Elias-Fano sequences (ranks made monotone by adding the
number of the entry above times the number of contexts), each with one number for every 512 bits by which
a bit is selected; nothing is unfolded to be searched. Smoothed probabilities are quantised to 16 bits. All
levels of a shard lie in one image, side by side, which is mapped and asked as it is: a query finds an
entry's range by pointer, then searches the successor of the context within that range. The images are
written as a table in the shared folder, so that a `Model` scores other documents later.

The number of shards grows with the tokens of the corpus, so that a shard's fit a task.
Tokens travel packed: a row holds what some documents have for one shard. A word with more
tokens than an even share is dealt to several shards by context; its count is known beforehand, and
no more words than shards can be of that kind, so that list is bounded.

Defined cases: a null or empty text is one end token; a row with a null doc_id counts as held out;
repeated rows count and score each for itself; an empty table gives an empty result, and one without
training rows scores with all counts zero; other columns are ignored. The documents must come in the same
partitions when they are read again, as a table's do.
"""

from __future__ import annotations

import json
import mmap
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crewlens.llm.shared import new_path, shuffle_partitions, stored, whole
from crewlens.llm.wordhash import NOT_SPACE, blocks, mix, word_hashes

FOLDS = 10
PRIOR = 200.0
SHARE = 0.01
ADDED = 0.1
END, BEGIN = np.uint64(0x9D39247E33776D41), np.uint64(0x2AF7398005AAA5C7)
SHARD_TOKENS = 2_000_000  # of all documents, for each shard on average
LEVELS = 65_535  # of quantised probabilities
#: A shard's sums for a document travel as multiples of these.
BASE_UNIT, MODEL_UNIT = 2.0**-34, 2.0**-16
CONTEXT_SPACE = 1 << 40  # of a context's hash
PIECE_BYTES = 1 << 25  # of texts whose tokens are packed together
GROUP_TOKENS = 1 << 18  # asked at once
CHUNK = 1 << 15  # numbers searched at once, within a core's cache


# ---- packed integers ----

def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays of unsigned integers, byte plane by byte plane, compressed."""
    out = [len(arrays).to_bytes(1, "little")]
    for a in arrays:
        width = max(1, (int(a.max()).bit_length() + 7) // 8) if len(a) else 1
        planes = a.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
        out += [len(a).to_bytes(5, "little"), width.to_bytes(1, "little"), np.ascontiguousarray(planes).tobytes()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def _gaps(ascending: np.ndarray) -> np.ndarray:
    """Differences of ascending numbers, which need fewer bytes; `_sums` undoes it."""
    return np.diff(ascending.astype(np.uint64), prepend=np.uint64(0))


def _sums(gaps: np.ndarray) -> np.ndarray:
    return np.cumsum(gaps, dtype=np.uint64)


def _unpack(data: bytes) -> list[np.ndarray]:
    raw, arrays = zstandard.ZstdDecompressor().decompress(data), []
    at = 1
    for _ in range(raw[0]):
        n, width = int.from_bytes(raw[at : at + 5], "little"), raw[at + 5]
        planes = np.frombuffer(raw, np.uint8, n * width, at + 6).reshape(width, n)
        size = next(x for x in (1, 2, 4, 8) if x >= width)
        wide = np.zeros((n, size), np.uint8)
        wide[:, :width] = planes.T
        arrays.append(wide.view(f"<u{size}").ravel())
        at += 6 + n * width
    return arrays


# ---- Elias-Fano ----

BLOCK_BITS = 512  # for each of which the directory holds one number


def _select(words: np.ndarray, word: np.ndarray, rest: np.ndarray, flip: bool) -> np.ndarray:
    """Place of the set bit (clear, if `flip`) that `rest` such bits precede, counted from `word` on."""
    word, rest = word.copy(), rest.copy()
    for _ in range(BLOCK_BITS // 64 - 1):
        ones = np.bitwise_count(words[word]).astype(np.int64)
        n = 64 - ones if flip else ones
        on = rest >= n
        rest -= np.where(on, n, 0)
        word += on
    bits = ~words[word] if flip else words[word]
    place = word * 64
    for half in (32, 16, 8, 4, 2, 1):
        low = bits & np.uint64((1 << half) - 1)
        n = np.bitwise_count(low).astype(np.int64)
        on = rest >= n
        rest -= np.where(on, n, 0)
        bits = np.where(on, bits >> np.uint64(half), low)
        place += np.where(on, half, 0)
    return place


@dataclass
class EliasFano:
    """A monotone sequence: low bits side by side, high bits as gaps in unary, and how many high bits
    are set before each block of them. Low parts have at most 57 bits."""

    n: int
    width: int
    low: np.ndarray  # bytes
    high: np.ndarray  # 64 bits each
    before: np.ndarray  # set bits before each block

    @classmethod
    def build(cls, values: np.ndarray, universe: int) -> EliasFano:
        n = len(values)
        width = max(0, (max(universe, 1) // max(n, 1)).bit_length() - 1)
        values = values.astype(np.uint64)
        low = np.zeros((n, width), np.uint8)
        for bit in range(width):
            low[:, bit] = (values >> np.uint64(bit)) & np.uint64(1)
        low = np.append(low.ravel(), np.zeros(64, np.uint8))  # any 8 bytes can be read at once
        size = n + (universe >> width) + 2
        high = np.zeros(-(-size // BLOCK_BITS) * BLOCK_BITS, np.uint8)
        high[(values >> np.uint64(width)).astype(np.int64) + np.arange(n)] = 1
        each = high.reshape(-1, BLOCK_BITS).sum(axis=1, dtype=np.int64)
        before = (np.cumsum(each) - each).astype(np.uint32)
        return cls(n, width, np.packbits(low, bitorder="little"), np.packbits(high, bitorder="little").view("<u8"), before)

    def __post_init__(self):
        self.wide = np.ndarray(len(self.low) - 7, "<u8", self.low, strides=(1,))  # the 8 bytes from each place on
        self.clear_before = np.arange(len(self.before)) * BLOCK_BITS - self.before.astype(np.int64)

    def _lows(self, places: np.ndarray) -> np.ndarray:
        at = places * self.width
        return ((self.wide[at >> 3] >> (at & 7).astype(np.uint64)) & np.uint64((1 << self.width) - 1)).astype(np.int64)

    def _ones_ahead(self, upper: np.ndarray) -> np.ndarray:
        """Numbers of the sequence with high parts below `upper`."""
        clear = np.maximum(upper - 1, 0)
        block = np.searchsorted(self.clear_before, clear, "right") - 1
        place = _select(self.high, block * (BLOCK_BITS // 64), clear - self.clear_before[block], True)
        return np.where(upper > 0, place - clear, 0)

    def values(self, places: np.ndarray) -> np.ndarray:
        block = np.searchsorted(self.before, places, "right") - 1
        bit = _select(self.high, block * (BLOCK_BITS // 64), places - self.before[block].astype(np.int64), False)
        return ((bit - places) << self.width) | self._lows(places)

    def successor(self, wanted: np.ndarray, least: np.ndarray | int = 0, most: np.ndarray | None = None):
        """Place of the first number that is at least `wanted`, within places [least, most), and whether it
        is `wanted`; the end of that range if there is none."""
        most = self.n if most is None else most
        upper = wanted >> self.width
        place = np.clip(self._ones_ahead(upper), least, most)
        end = np.clip(self._ones_ahead(upper + 1), least, most)
        stop, rest = end.copy(), wanted & ((1 << self.width) - 1)
        open_ = np.flatnonzero(place < stop)
        while len(open_):  # halve what is left of each bucket
            middle = (place[open_] + stop[open_]) >> 1
            smaller = self._lows(middle) < rest[open_]
            place[open_[smaller]] = middle[smaller] + 1
            stop[open_[~smaller]] = middle[~smaller]
            open_ = open_[place[open_] < stop[open_]]
        same = place < end
        same[same] = self._lows(place[same]) == rest[same]
        return place, same


# ---- images of tries ----

def _image(arrays: dict[str, np.ndarray], numbers: dict[str, float]) -> bytes:
    """Arrays side by side, each at a multiple of 8 bytes, behind a list of them."""
    head = json.dumps([numbers, [(k, a.dtype.str, len(a)) for k, a in arrays.items()]]).encode()
    out = [len(head).to_bytes(8, "little"), head + b" " * (-len(head) % 8)]
    return b"".join([*out, *(a.tobytes() + b"\0" * (-a.nbytes % 8) for a in arrays.values())])


def _opened(image: bytes) -> tuple[dict[str, np.ndarray], dict[str, float]]:
    """Views of an image in a memory map, which ends with them."""
    memory = mmap.mmap(-1, len(image))
    memory[:] = image
    size = int.from_bytes(memory[:8], "little")
    numbers, listed = json.loads(memory[8 : 8 + size])
    at, arrays = 8 + size + -size % 8, {}
    for name, kind, n in listed:
        arrays[name] = np.frombuffer(memory, kind, n, at)
        at += -(-arrays[name].nbytes // 8) * 8
    return arrays, numbers


def _quantised(logs: np.ndarray) -> tuple[np.ndarray, float, float]:
    floor = float(logs.min()) if len(logs) else 0.0
    step = max((float(logs.max()) - floor) / LEVELS, 1e-12) if len(logs) else 1e-12
    return np.round((logs - floor) / step).astype("<u2"), floor, step


def trie_image(words, counts, pairs, pair_counts, triples, triple_counts, contexts, corpus: Corpus) -> bytes:
    """The trie of `words` (sorted) with their counts; `pairs` are word * fan + context and `triples`
    pair * fan + context, both sorted, by the numbers of entries; fan is the number of contexts."""
    fan = max(1, len(contexts))
    owner, pair = pairs // fan, triples // fan
    lower = SHARE * (pair_counts + (PRIOR * corpus.unigram(counts))[owner])
    sequences = {
        "contexts": (contexts, CONTEXT_SPACE),
        "pairs": (pairs, max(1, len(words)) * fan),
        "pair_starts": (np.searchsorted(owner, np.arange(len(words) + 1)), len(pairs) + 1),
        "triples": (triples, max(1, len(pairs)) * fan),
        "triple_starts": (np.searchsorted(pair, np.arange(len(pairs) + 1)), len(triples) + 1),
    }
    logs = {
        "backed": np.log10(lower),
        "context": np.log10(pair_counts + SHARE * (counts[owner] + PRIOR)),
        "full": np.log10(triple_counts + lower[pair]),
    }
    arrays, numbers = {"words": words, "counts": counts}, {"fan": fan}
    for name, (values, universe) in sequences.items():
        built = EliasFano.build(values, universe)
        numbers |= {f"{name}.n": built.n, f"{name}.width": built.width}
        arrays |= {f"{name}.{part}": getattr(built, part) for part in ("low", "high", "before")}
    for name, values in logs.items():
        arrays[name], numbers[f"{name}.floor"], numbers[f"{name}.step"] = _quantised(values)
    return _image(arrays, numbers)


class Trie:
    """A shard's levels, opened from their image; nothing else is asked."""

    def __init__(self, image: bytes):
        self.arrays, self.numbers = _opened(image)
        self.words, self.counts, self.fan = self.arrays["words"], self.arrays["counts"], self.numbers["fan"]
        names = ("contexts", "pairs", "pair_starts", "triples", "triple_starts")
        self.contexts, self.pairs, self.pair_starts, self.triples, self.triple_starts = (
            EliasFano(
                self.numbers[f"{name}.n"], self.numbers[f"{name}.width"],
                *(self.arrays[f"{name}.{part}"] for part in ("low", "high", "before")),
            )
            for name in names
        )

    def find_words(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words and which of them are in the trie."""
        if not len(self.words):
            return np.zeros(len(words), np.int64), np.zeros(len(words), bool)
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return at, self.words[at] == words

    def find_contexts(self, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _in_chunks(self.contexts.successor, contexts.astype(np.int64))

    def _below(self, level: EliasFano, starts: EliasFano, entry: np.ndarray, context: np.ndarray):
        def find(entry, context):
            return level.successor(entry * self.fan + context, starts.values(entry), starts.values(entry + 1))

        return _in_chunks(find, entry, context)

    def find_pairs(self, word: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of (word, context) pairs in the second level and which of them are there."""
        return self._below(self.pairs, self.pair_starts, word, context)

    def find_triples(self, pair: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self._below(self.triples, self.triple_starts, pair, context)

    def log(self, name: str, places: np.ndarray) -> np.ndarray:
        return self.numbers[f"{name}.floor"] + self.arrays[name][places] * self.numbers[f"{name}.step"]


def _in_chunks(find, *arrays: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    parts = [find(*(a[i : i + CHUNK] for a in arrays)) for i in range(0, len(arrays[0]), CHUNK)]
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, bool)
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


# ---- tokens of documents ----

def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def _tokens(block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tokens (words, then one end for each document), the two tokens before each, and the document."""
    words, first = word_hashes(block, NOT_SPACE)
    sizes = np.diff(first) + 1
    ends = np.cumsum(sizes) - 1
    tokens = np.empty(len(words) + block.n, np.uint64)
    is_end = np.zeros(len(tokens), bool)
    is_end[ends] = True
    tokens[is_end] = END
    tokens[~is_end] = words
    begins = ends - sizes + 1
    before, second = np.empty_like(tokens), np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[begins] = BEGIN
    second[2:] = tokens[:-2]
    second[begins] = BEGIN
    second[np.minimum(begins + 1, len(tokens) - 1)] = BEGIN  # a second token, or the next document's first
    return tokens, before, second, np.repeat(np.arange(block.first, block.first + block.n, dtype=np.int32), sizes)


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about PIECE_BYTES of text."""
    sizes = pc.binary_length(batch.column("text")).to_numpy().astype(np.int64)
    piece = (np.cumsum(sizes) - sizes) // PIECE_BYTES
    starts = np.flatnonzero(np.diff(piece, prepend=-1))
    for a, b in zip(starts, np.append(starts[1:], len(sizes))):
        yield batch.slice(a, b - a)


def _shard_of(words: np.ndarray, shards: int) -> np.ndarray:
    return ((words >> np.uint64(33)) % np.uint64(shards)).astype(np.int32)


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order that sorts `keys`, the distinct keys, and the start of each in that order (and the end)."""
    order = np.argsort(keys, kind="stable")
    sorted_ = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return order, sorted_[starts], np.append(starts, len(keys))


def _word_counts(rows: DataFrame, shards: int) -> DataFrame:
    """Packed (word, count) of the training rows: shard, payload."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            train = ~batch.column("held_out").to_numpy(zero_copy_only=False)
            parts = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
            for block in blocks(batch):
                tokens, _, _, doc = _tokens(block)
                parts.append(np.unique(tokens[train[doc]], return_counts=True))
            words, each = (np.concatenate(x) for x in zip(*parts))
            order, distinct, starts = _runs(words)
            counts = np.add.reduceat(each[order], starts[:-1]) if len(distinct) else each
            order, numbers, starts = _runs(_shard_of(distinct, shards))
            payload = [_pack(_gaps(distinct[order[a:b]]), counts[order[a:b]]) for a, b in zip(starts, starts[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(payload, pa.binary())], ["shard", "payload"])

    return rows.select("held_out", "text").mapInArrow(count, "shard int, payload binary")


def _add_counts(payloads) -> tuple[np.ndarray, np.ndarray]:
    parts = [_unpack(p) for p in payloads]
    words = np.concatenate([np.zeros(0, np.uint64), *(_sums(p[0]) for p in parts)])
    each = np.concatenate([np.zeros(0, np.int64), *(p[1].astype(np.int64) for p in parts)])
    distinct, inverse = np.unique(words, return_inverse=True)
    return distinct, np.bincount(inverse, each, len(distinct)).astype(np.int64)


@dataclass(frozen=True)
class Corpus:
    """What all shards must know: N, V, and the words with more than an even share of the tokens."""

    tokens: int
    words: int
    hot: dict[int, int]

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        return (counts + ADDED) / self.normaliser

    @property
    def normaliser(self) -> float:
        return self.tokens + ADDED * (self.words + 1)


def corpus_counts(rows: DataFrame, shards: int) -> Corpus:
    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Totals of each shard; each of its words that could be hot is a row too."""
        gathered: dict[int, list[bytes]] = {}
        for batch in batches:
            for shard, payload in zip(batch.column("shard").to_pylist(), batch.column("payload").to_pylist()):
                gathered.setdefault(shard, []).append(payload)
        out = {"tokens": [], "words": [], "word": [], "count": []}
        for payloads in gathered.values():
            distinct, counts = _add_counts(payloads)
            top = np.flatnonzero(counts * shards > counts.sum())  # hot in the corpus, then so in the shard
            out["tokens"] += [int(counts.sum()), *[0] * len(top)]
            out["words"] += [len(distinct), *[0] * len(top)]
            out["word"] += [None, *distinct[top].astype(np.int64).tolist()]
            out["count"] += [None, *counts[top].tolist()]
        yield pa.RecordBatch.from_pydict(out, pa.schema([(k, pa.int64()) for k in out]))

    rows = stored(
        _word_counts(rows, shards).repartitionById(shards, F.col("shard"))
        .mapInArrow(total, "tokens long, words long, word long, count long"),
        "word_totals",
    )
    n, v = rows.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))).first()
    hot = rows.filter(F.col("count") * shards > n).select("word", "count").collect()  # fewer than `shards` rows
    return Corpus(n, v, {int(np.int64(w).astype(np.uint64)): c for w, c in hot})


def _packed_tokens(rows: DataFrame, shards: int, corpus: Corpus) -> DataFrame:
    """What each piece has for each shard: shard, batch, payload. A piece is named by its first row, and
    its rows travel with one of its payloads (`info`)."""
    hot = np.sort(np.array(list(corpus.hot), np.uint64))
    share = max(1, corpus.tokens // shards)
    fans = np.array([-(-corpus.hot[int(w)] // share) for w in hot], np.uint64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in (p for batch in batches for p in _pieces(batch)):
            train = ~piece.column("held_out").to_numpy(zero_copy_only=False)
            tokens, before, second, doc = (np.concatenate(x) for x in zip(*(_tokens(block) for block in blocks(piece))))
            shard = _shard_of(tokens, shards)
            if len(hot):
                at = np.minimum(np.searchsorted(hot, tokens), len(hot) - 1)
                fanned = np.flatnonzero(hot[at] == tokens)
                shift = (mix(before[fanned]) >> np.uint64(20)) % fans[at[fanned]]
                shard[fanned] = (shard[fanned] + shift.astype(np.int32)) % shards
                del at, fanned, shift
            order, numbers, starts = _runs(shard)
            payload = []
            for a, b in zip(starts, starts[1:]):
                mine = order[a:b]
                word, word_at = np.unique(tokens[mine], return_inverse=True)
                both = np.concatenate([before[mine], second[mine]]) % np.uint64(CONTEXT_SPACE)
                context, context_at = np.unique(both, return_inverse=True)
                steps = np.diff(doc[mine], prepend=0)
                payload.append(_pack(
                    _gaps(word), word_at, _gaps(context), context_at[: b - a], context_at[b - a :], steps, train[doc[mine]]
                ))
            sizes = pa.array(np.bincount(doc, minlength=len(piece)), pa.int64())
            about = pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), piece.column("held_out"), sizes], ["doc_id", "held_out", "n_tokens"]
            )
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, about.schema) as writer:
                writer.write_batch(about)
            info = [sink.getvalue().to_pybytes(), *[None] * (len(numbers) - 1)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(numbers, pa.int32()), pa.array(np.full(len(numbers), piece.column("row")[0].as_py()), pa.int64()),
                    pa.array(payload, pa.binary()), pa.array(info, pa.binary()),
                ],
                ["shard", "batch", "payload", "info"],
            )

    return rows.select("row", "doc_id", "held_out", "text").mapInArrow(
        deal, "shard int, batch long, payload binary, info binary"
    )


def _common(parts: list[list[np.ndarray]], i: int, *items: int) -> list[np.ndarray]:
    """The distinct keys that the parts list as item i, and for each of the items, which number keys
    within a part, the keys' numbers among all."""
    keys = [_sums(p[i]) for p in parts]
    distinct = np.unique(np.concatenate([np.zeros(0, np.uint64), *keys]))
    places = [np.searchsorted(distinct, k).astype(np.int32) for k in keys]
    return [distinct, *(np.concatenate([k[p[item]] for k, p in zip(places, parts)]) for item in items)]


def _learned(parts: list[list[np.ndarray]], corpus: Corpus) -> bytes:
    """The image of the trie of the training tokens of a shard."""
    words, number = _common(parts, 0, 1)
    contexts, first, second = _common(parts, 2, 3, 4)
    train = np.concatenate([p[6] for p in parts]).astype(bool)
    number, first, second = number[train], first[train], second[train]
    used = np.zeros(len(contexts), bool)
    used[first], used[second] = True, True
    rank = np.cumsum(used) - 1
    fan = max(1, int(used.sum()))
    counts = np.bincount(number, minlength=len(words)).astype(np.int64)
    for i in np.flatnonzero(np.isin(words, np.array(list(corpus.hot), np.uint64))):
        counts[i] = corpus.hot[int(words[i])]  # this shard holds a part of its tokens
    seen = counts > 0
    pairs, pair_at, pair_counts = np.unique(
        (np.cumsum(seen) - 1)[number] * fan + rank[first], return_inverse=True, return_counts=True
    )
    triples, triple_counts = np.unique(pair_at * fan + rank[second], return_counts=True)
    return trie_image(words[seen], counts[seen], pairs, pair_counts, triples, triple_counts, contexts[used], corpus)


def _score_parts(trie: Trie, parts: list[list[np.ndarray]], corpus: Corpus) -> list[tuple[np.ndarray, ...]]:
    """For each part: documents, base part, model part, known tokens (sums over the tokens)."""
    words, number = _common(parts, 0, 1)
    contexts, first, second = _common(parts, 2, 3, 4)
    fan = max(1, len(contexts))
    at, in_trie = trie.find_words(words)
    counts = np.zeros(len(words), np.int64)
    counts[in_trie] = trie.counts[at[in_trie]]
    for i in np.flatnonzero(np.isin(words, np.array(list(corpus.hot), np.uint64))):
        counts[i] = corpus.hot[int(words[i])]  # also where this shard has seen none of its tokens
    rank, met = trie.find_contexts(contexts)

    asked, asked_at = np.unique(number.astype(np.int64) * fan + first, return_inverse=True)
    word, context = asked // fan, asked % fan
    backed = np.log10(SHARE * PRIOR * corpus.unigram(counts))[word]
    following = np.log10(SHARE * (counts + PRIOR))[word]
    pair = np.full(len(asked), -1)
    may = np.flatnonzero(in_trie[word] & met[context])
    place, found = trie.find_pairs(at[word[may]], rank[context[may]])
    may, place = may[found], place[found]
    pair[may], backed[may], following[may] = place, trie.log("backed", place), trie.log("context", place)
    following[words[word] == END] = 0.0  # an end stands before nothing

    triple, triple_at = np.unique(asked_at * fan + second, return_inverse=True)
    above, context = triple // fan, triple % fan
    value = backed[above] - following[above]
    may = np.flatnonzero((pair[above] >= 0) & met[context])
    place, found = trie.find_triples(pair[above[may]], rank[context[may]])
    may, place = may[found], place[found]
    value[may] = trie.log("full", place) - following[above[may]]

    model, base, known = value[triple_at], np.log10(counts + ADDED)[number], (counts > 0)[number].astype(np.int64)
    out, begin = [], 0
    for p in parts:
        end = begin + len(p[1])
        docs, starts = np.unique(np.cumsum(p[5].astype(np.int64)), return_index=True)
        out.append((docs, *(np.add.reduceat(x[begin:end], starts) for x in (base, model, known))))
        begin = end
    return out


def _scored(image: bytes, payloads: list[bytes], corpus: Corpus) -> Iterator[bytes]:
    """What the trie of `image` says of each payload, packed."""
    trie = Trie(image)
    parts = [_unpack(p) for p in payloads]
    group = (np.cumsum([len(p[1]) for p in parts]) - 1) // GROUP_TOKENS
    for g in np.unique(group):
        for docs, base, model, known in _score_parts(trie, [parts[i] for i in np.flatnonzero(group == g)], corpus):
            yield _pack(np.diff(docs, prepend=0), known, _fixed(base, BASE_UNIT), _fixed(model, MODEL_UNIT))


def shards_for(tokens: int, least: int) -> int:
    """Shards of SHARD_TOKENS; at least as many as there are tasks to do."""
    return max(least, -(-tokens // SHARD_TOKENS))


PARTIAL = "shard int, batch long, part binary, info binary, image binary"


def _partial_batch(shard: int, names, parts, infos, image: bytes | None) -> pa.RecordBatch:
    extra = [] if image is None else [None]
    n = len(names) + len(extra)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([shard] * n, pa.int32()), pa.array([*names, *extra], pa.int64()), pa.array([*parts, *extra], pa.binary()),
            pa.array([*infos, *extra], pa.binary()), pa.array([None] * len(names) + [image] * len(extra), pa.binary()),
        ],
        ["shard", "batch", "part", "info", "image"],
    )


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict[str, list]]]:
    """The rows of each shard, from batches sorted by shard."""
    shard, held = None, {}
    for batch in batches:
        for row in batch.to_pylist():
            if row["shard"] != shard:
                if held:
                    yield shard, held
                shard, held = row["shard"], {k: [] for k in row}
            for k, v in row.items():
                held[k].append(v)
    if held:
        yield shard, held


@dataclass(frozen=True)
class Model:
    """A language model whose tries are written in `path`."""

    path: str
    shards: int
    begins: int
    corpus: Corpus

    def save(self, spark: SparkSession) -> None:
        """Write the totals beside the tries; `load` reads them."""
        told = asdict(self) | {"corpus": asdict(self.corpus) | {"hot": sorted(self.corpus.hot.items())}}
        spark.createDataFrame([(json.dumps(told),)], "model string").write.parquet(f"{self.path}/totals")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Model:
        told = json.loads(spark.read.parquet(f"{path}/totals").first()[0])
        corpus = told.pop("corpus")
        return cls(**(told | {"path": path}), corpus=Corpus(corpus["tokens"], corpus["words"], dict(map(tuple, corpus["hot"]))))

    def score(self, docs: DataFrame) -> DataFrame:
        """The columns of `score_documents` for any documents, from the written tries alone."""
        corpus = self.corpus

        def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nothing = trie_image(*[np.zeros(0, t) for t in ("<u8", *["<i8"] * 5, "<u8")], corpus)
            for shard, held in _by_shard(batches):
                image = next((i for i in held["image"] if i is not None), nothing)
                asked = [i for i, p in enumerate(held["payload"]) if p is not None]
                payloads = [held["payload"][i] for i in asked]
                parts = list(_scored(image, payloads, corpus)) if payloads else []
                yield _partial_batch(shard, [held["batch"][i] for i in asked], parts, [held["info"][i] for i in asked], None)

        images = (
            docs.sparkSession.read.schema(PARTIAL).parquet(f"{self.path}/shards").filter("image IS NOT NULL")
            .selectExpr("shard", "batch", "CAST(NULL AS BINARY) AS payload", "info", "image")
        )
        tokens = _packed_tokens(_rows(docs), self.shards, corpus).withColumn("image", F.lit(None).cast("binary"))
        partial = (
            tokens.unionByName(images).repartitionById(self.shards, F.col("shard"))
            .sortWithinPartitions("shard").mapInArrow(ask, PARTIAL)
        )
        return self.summed(partial, dict(docs.dtypes)["doc_id"])

    def summed(self, partial: DataFrame, id_type: str) -> DataFrame:
        """Rows of documents from what all shards say of them."""
        begin = float(np.log10(self.begins + SHARE * (self.begins + PRIOR)))
        constant, n_train = float(np.log10(self.corpus.normaliser)), self.corpus.tokens

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for info, parts in zip(batch.column("info").to_pylist(), batch.column("parts").to_pylist()):
                    about = pa.ipc.open_stream(info).read_all().combine_chunks().to_batches()[0]
                    all_parts = [_unpack(p) for p in sorted(parts)]  # in one order, so that reruns agree
                    doc = np.concatenate([np.cumsum(p[0].astype(np.int64)) for p in all_parts])
                    known, base, model = (
                        np.bincount(doc, np.concatenate(x), len(about))
                        for x in (
                            [p[1] for p in all_parts], [_unfixed(p[2], BASE_UNIT) for p in all_parts],
                            [_unfixed(p[3], MODEL_UNIT) for p in all_parts],
                        )
                    )
                    n_tokens = about.column("n_tokens").to_numpy()
                    yield pa.RecordBatch.from_arrays(
                        [
                            about.column("doc_id"), about.column("held_out"), about.column("n_tokens"),
                            pa.array(known.astype(np.int64)), pa.array(np.full(len(about), n_train)),
                            pa.array(base - n_tokens * constant), pa.array(model - begin),
                        ],
                        ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                    )

        return (
            partial.filter("part IS NOT NULL").groupBy("batch")
            .agg(F.collect_list("part").alias("parts"), F.first("info", ignorenulls=True).alias("info"))
            .mapInArrow(
                add,
                f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long,"
                " base_score double, score double",
            )
        )


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(
        "doc_id", F.monotonically_increasing_id().alias("row"), held_out(F.col("doc_id")).alias("held_out"),
        whole(F.col("text")).alias("text"),
    )


def fit_and_score(docs: DataFrame) -> tuple[DataFrame, Model]:
    """The rows of `score_documents`, and the model that the training rows give."""
    spark, rows = docs.sparkSession, _rows(docs)
    n_tokens = (F.regexp_count("text", F.lit("[^\\x20\\x09-\\x0D]+")) + 1).cast("long")
    # Each document begins once, after the one token that stands before all others.
    tokens, begins = rows.agg(
        F.coalesce(F.sum(n_tokens), F.lit(0)), F.count(F.when(~F.col("held_out"), 1))
    ).first()
    shards = shards_for(tokens, shuffle_partitions(spark))
    corpus = corpus_counts(rows, shards)
    model = Model(new_path(spark, "language_model"), shards, begins, corpus)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Build each shard's image, then ask it; both go into the written table."""
        for shard, held in _by_shard(batches):
            image = _learned([_unpack(p) for p in held["payload"]], corpus)
            yield _partial_batch(shard, held["batch"], list(_scored(image, held["payload"], corpus)), held["info"], image)

    tokens_of = _packed_tokens(rows, shards, corpus).repartitionById(shards, F.col("shard")).sortWithinPartitions("shard")
    tokens_of.mapInArrow(learn, PARTIAL).write.option("compression", "zstd").parquet(f"{model.path}/shards")
    model.save(spark)
    partial = spark.read.schema(PARTIAL).parquet(f"{model.path}/shards")
    return model.summed(partial, dict(docs.dtypes)["doc_id"]), model


def score_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row."""
    return fit_and_score(docs)[0]


def _fixed(x: np.ndarray, unit: float) -> np.ndarray:
    """Multiples of `unit`, the sign in the last bit."""
    n = np.round(x / unit).astype(np.int64)
    return np.where(n < 0, -2 * n - 1, 2 * n).astype(np.uint64)


def _unfixed(x: np.ndarray, unit: float) -> np.ndarray:
    n = x.astype(np.int64)
    return np.where(n & 1, -(n + 1) // 2, n // 2) * unit
