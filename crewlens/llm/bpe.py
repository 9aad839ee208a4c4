"""BPE encoding and decoding that reuses content-defined chunks.

A rolling hash cuts every text where its last 16 bytes say so, hence equal passages are cut alike
wherever they stand. Chunks that more than one document holds are encoded once; the ids then go to
the documents. A chunk encoded alone may differ from the same bytes inside a text only up to its
first and after its last break (a space or line break, where tokens never join): these edges are
kept as text, and every join is repaired by re-encoding what lies between the two breaks. Where a
chunk has no break at all the repair goes on into the next one, until both sides agree.

Which chunks are shared is told by bitmaps of fixed size, so a false hit only sends a chunk along
with the shared ones. Documents without shared chunks are encoded where they are read, and never
shuffled.

The tokenizer must be one whose pre-tokenizer drops white space (`word` vocabularies); others are
refused. Special strings inside texts become their tokens, as the library does by default.

Defined cases: null counts as empty and gives no tokens; repeated rows each get a result; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crewlens.llm.shared import BITMAP_BITS, BITMAPS, key_bitmaps, returning_memory, whole

CUT_BITS = 10  # chunks of 2**10 bytes on average
MIN_CHUNK = 256
CACHE_WORDS = 400_000  # words a worker remembers before it starts anew
SEGMENT = 1 << 20  # bytes hashed at a time

_BREAK = re.compile(r"[ \n]")
_BREAKS = re.compile(r"[ \t\n\x0b\x0c\r]+")
_PRINTABLE = re.compile(r"[!-~]*")
_ODD_SPACE = re.compile(r"[\x1c-\x1f]")  # white space to Python, not to the tokenizer


class WordEncoder:
    """Encodes texts word by word with a memory of words; equal to the library on whole texts."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        splits = [s for s in steps if s["type"] == "Split"]
        if not splits or splits[0]["behavior"] != "Removed" or not splits[0]["invert"] or spec.get("decoder"):
            raise ValueError(f"{path} does not drop white space before merging")
        self.library = Tokenizer.from_file(path)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.tokens = [self.library.id_to_token(i) for i in range(self.library.get_vocab_size())]
        self.words: dict[str, bytes] = {}
        # Printable ASCII needs no Unicode step: the same pattern, with ASCII's letters and digits.
        kinds = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        pattern = splits[0]["pattern"].get("Regex", "").replace(r"\p{L}", "a-z").replace(r"\p{N}", "0-9")
        plain = kinds == ["NFC", "Replace", "Lowercase"] and len(steps) == 2 and "\\p" not in pattern
        self.plain = re.compile(pattern) if plain else None

    def _piece(self, text: str) -> list[int]:
        if not text:
            return []
        if self.plain and text.isascii() and _PRINTABLE.fullmatch(text):
            parts = self.plain.findall(text.lower())
            return [t.id for part in parts for t in self.library.model.tokenize(part)]
        normal = self.library.normalizer.normalize_str(text)
        parts = self.library.pre_tokenizer.pre_tokenize_str(normal)
        return [t.id for part, _ in parts for t in self.library.model.tokenize(part)]

    def _learn(self, word: str) -> bytes:
        if self.special_split and "<" in word:
            parts = self.special_split.split(word)
            ids = [i for p in parts for i in ([self.special[p]] if p in self.special else self._piece(p))]
        else:
            ids = self._piece(word)
        if len(self.words) >= CACHE_WORDS:
            self.words.clear()
        known = struct.pack(f"<{len(ids)}I", *ids)
        self.words[word] = known
        return known

    def ids(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        words = _BREAKS.split(text) if _ODD_SPACE.search(text) else text.split()
        get, learn = self.words.get, self._learn
        return b"".join([get(w) or learn(w) for w in words if w])

    def decode(self, ids: bytes) -> str:
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def _gear() -> np.ndarray:
    """256 fixed pseudorandom numbers."""
    state = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    state ^= state >> np.uint64(29)
    state *= np.uint64(0xBF58476D1CE4E5B9)
    return (state >> np.uint64(32)).astype(np.uint32)


_GEAR = _gear()


def cut_places(data: np.ndarray) -> np.ndarray:
    """Places after which the rolling hash of the last 16 bytes asks for a cut."""
    found = [np.zeros(0, np.int64)]
    for begin in range(0, len(data), SEGMENT):
        start = max(0, begin - 15)
        h = _GEAR[data[start : begin + SEGMENT]]
        for step in (1, 2, 4, 8):
            if len(h) > step:
                h[step:] = h[step:] + (h[:-step] << np.uint32(step))
        found.append(np.flatnonzero((h[begin - start :] >> np.uint32(32 - CUT_BITS)) == 0) + begin + 1)
    places = np.concatenate(found)
    places = places[places < len(data)]
    return places[(data[places] & 0xC0) != 0x80]  # never inside a character


class Texts:
    """The texts of a batch as bytes, with their chunks."""

    def __init__(self, batch: pa.RecordBatch):
        column = batch.column("text").cast(pa.large_string())
        _, offsets, values = column.buffers()
        self.ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
        self.bytes = values or b""
        self.places = cut_places(np.frombuffer(self.bytes, np.uint8)[: self.ends[-1]])
        self.view = memoryview(self.bytes)

    def __len__(self) -> int:
        return len(self.ends) - 1

    def text(self, i: int) -> bytes:
        return self.view[self.ends[i] : self.ends[i + 1]].tobytes()

    def chunks(self, i: int) -> list[bytes]:
        start, end = int(self.ends[i]), int(self.ends[i + 1])
        first, last = np.searchsorted(self.places, [start + MIN_CHUNK, end])
        cuts = [start]
        for place in self.places[first:last].tolist():
            if place - cuts[-1] >= MIN_CHUNK:
                cuts.append(place)
        return [self.view[a:b].tobytes() for a, b in zip(cuts, [*cuts[1:], end]) if b > a]


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def _pair(digest: bytes) -> tuple[int, int]:
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


class SharedBits:
    """The bitmaps of shared chunks, as workers look them up."""

    def __init__(self, rows: list):
        self.bits = np.zeros((BITMAPS + 1, BITMAP_BITS // 8), np.uint8)
        for bucket, bits in rows:
            self.bits[bucket] = np.frombuffer(bits, np.uint8)

    def __contains__(self, h1: int) -> bool:
        bucket, place = divmod(h1 % (BITMAPS * BITMAP_BITS), BITMAP_BITS)
        return bool(self.bits[bucket + 1, place >> 3] >> (place & 7) & 1)


def edges(chunk: str) -> tuple[str, str | None, str]:
    """Text before the first break, between the breaks (None if there is none), after the last."""
    first = _BREAK.search(chunk)
    if first is None:
        return chunk, None, ""
    last = max(chunk.rfind(" "), chunk.rfind("\n"))
    return chunk[: first.start()], chunk[first.start() : last], chunk[last + 1 :]


def join_chunks(parts: list[tuple[str, bytes | None, str]], encode) -> bytes:
    """Ids of a whole text from its chunks' (head, body ids, tail): what lies between two bodies is
    encoded anew. A part without a break has no body, and the repair runs through it."""
    ids, open_text = [], ""
    for head, body, tail in parts:
        open_text += head
        if body is not None:
            ids += [encode(open_text), body]
            open_text = tail
    ids.append(encode(open_text))
    return b"".join(ids)


def _digests(engine: WordEncoder, ids: bytes) -> tuple[int, str, str]:
    decoded = engine.decode(ids).encode()
    return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()


def _results(doc_ids: pa.Array, at: list[int], done: list[tuple[int, str, str]]) -> pa.RecordBatch:
    columns = list(zip(*done)) or [(), (), ()]
    kinds = [pa.int64(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays(
        [doc_ids.take(pa.array(at, pa.int64())), *map(pa.array, columns, kinds)], ["doc_id", *RESULT]
    )


RESULT = ["n_tokens", "ids_sha256", "decoded_sha256"]


def _shared_bits(rows: DataFrame) -> Broadcast:
    """Bitmaps of the chunks that occur in two documents or more; 4 MB whatever the input."""

    @returning_memory
    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = Texts(batch)
            pairs = [_pair(d) for i in range(len(texts)) for d in {_digest(c) for c in texts.chunks(i)}]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], ["h1", "h2"]
            )

    counted = rows.select("text").mapInArrow(digests, "h1 long, h2 long").groupBy("h1", "h2").count()
    bits = key_bitmaps(counted.filter("count > 1"), "h1").collect()
    return rows.sparkSession.sparkContext.broadcast(SharedBits([tuple(r) for r in bits]))


def encode_decode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, n_tokens, and digests of the ids (little-endian unsigned 32-bit) and of the decoded
    text, for every row."""
    rows = docs.select("doc_id", whole(F.col("text")).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    shared = _shared_bits(rows)
    results = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    key = f"doc_id {kind}, t1 long, t2 long, seq int"

    def split(texts: Texts, i: int) -> list[tuple[bytes, int, int, bool]]:
        chunks = texts.chunks(i)
        return [(c, *(p := _pair(_digest(c))), p[0] in shared.value) for c in chunks]

    @returning_memory
    def unshared_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        engine = encoder(tokenizer)
        for batch in batches:
            texts = Texts(batch)
            mine = [i for i in range(len(texts)) if not any(c[3] for c in split(texts, i))]
            done = [_digests(engine, engine.ids(texts.text(i).decode())) for i in mine]
            yield _results(batch.column("doc_id"), mine, done)

    @returning_memory
    def own_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Runs of unshared chunks of documents that also have shared ones, encoded."""
        ids = encoder(tokenizer).ids
        for batch in batches:
            texts, out = Texts(batch), []
            doc_ids = batch.column("doc_id")
            for i in range(len(texts)):
                chunks = split(texts, i)
                if not any(c[3] for c in chunks):
                    continue
                t1, t2 = _pair(_digest(texts.text(i)))
                at = 0
                while at < len(chunks):
                    end = at
                    while end < len(chunks) and not chunks[end][3]:
                        end += 1
                    if end > at:
                        head, body, tail = edges(b"".join(c[0] for c in chunks[at:end]).decode())
                        out.append((i, t1, t2, at, head, None if body is None else _packed(ids(body)), tail))
                    at = max(end, at + 1)
            yield _pieces(doc_ids, out)

    @returning_memory
    def references(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, out = Texts(batch), []
            for i in range(len(texts)):
                chunks = split(texts, i)
                if any(c[3] for c in chunks):
                    t1, t2 = _pair(_digest(texts.text(i)))
                    out += [(i, t1, t2, n, c[1], c[2]) for n, c in enumerate(chunks) if c[3]]
            columns = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(columns[0], pa.int64())),
                    pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.int32()),
                    pa.array(columns[4], pa.int64()), pa.array(columns[5], pa.int64()),
                ],
                ["doc_id", "t1", "t2", "seq", "h1", "h2"],
            )

    @returning_memory
    def shared_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every shared chunk once for each batch that holds it."""
        for batch in batches:
            texts = Texts(batch)
            found = {(c[1], c[2]): c[0] for i in range(len(texts)) for c in split(texts, i) if c[3]}
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in found], pa.int64()), pa.array([k[1] for k in found], pa.int64()),
                    pa.array([v.decode() for v in found.values()], pa.string()),
                ],
                ["h1", "h2", "chunk"],
            )

    @returning_memory
    def encode_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = encoder(tokenizer).ids
        for batch in batches:
            parts = [edges(c.as_py()) for c in batch.column("chunk")]
            bodies = [None if b is None else _packed(ids(b)) for _, b, _ in parts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("h1"), batch.column("h2"), pa.array([p[0] for p in parts], pa.string()),
                    pa.array(bodies, pa.binary()), pa.array([p[2] for p in parts], pa.string()),
                ],
                ["h1", "h2", "head", "body", "tail"],
            )

    @returning_memory
    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        engine = encoder(tokenizer)
        for batch in batches:
            at, done = [], []
            for i, parts in enumerate(batch.column("parts")):
                parts = sorted(parts.as_py(), key=lambda p: p["seq"])
                copies = sum(p["seq"] == parts[0]["seq"] for p in parts)
                ids = join_chunks([(p["head"], _unpacked(p["body"]), p["tail"]) for p in parts[::copies]], engine.ids)
                at += [i] * copies
                done += [_digests(engine, ids)] * copies
            yield _results(batch.column("doc_id"), at, done)

    dictionary = (
        rows.select("text").mapInArrow(shared_chunks, "h1 long, h2 long, chunk string")
        .groupBy("h1", "h2").agg(F.first("chunk").alias("chunk"))
        .mapInArrow(encode_chunks, "h1 long, h2 long, head string, body binary, tail string")
    )
    part = ["seq", "head", "body", "tail"]
    reused = rows.mapInArrow(references, f"{key}, h1 long, h2 long").join(dictionary, ["h1", "h2"])
    own = rows.mapInArrow(own_pieces, f"{key}, head string, body binary, tail string")
    document = ["doc_id", "t1", "t2"]
    joined = (
        own.select(*document, *part)
        .unionByName(reused.select(*document, *part))
        .groupBy(*document)
        .agg(F.collect_list(F.struct(*part)).alias("parts"))
        .select("doc_id", "parts")
        .mapInArrow(assemble, results)
    )
    return rows.mapInArrow(unshared_documents, results).unionByName(joined)


def _packed(ids: bytes) -> bytes:
    """Two bytes an id, after a zero byte, where that suffices; else four after a one."""
    wide = np.frombuffer(ids, "<u4")
    if len(wide) and wide.max() > 0xFFFF:
        return b"\1" + ids
    return b"\0" + wide.astype("<u2").tobytes()


def _unpacked(packed: bytes | None) -> bytes | None:
    if packed is None or packed[0] == 1:
        return packed and packed[1:]
    return np.frombuffer(packed, "<u2", offset=1).astype("<u4").tobytes()


def _pieces(doc_ids: pa.Array, out: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*out)) or [()] * 7
    return pa.RecordBatch.from_arrays(
        [
            doc_ids.take(pa.array(columns[0], pa.int64())),
            pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.int32()),
            pa.array(columns[4], pa.string()), pa.array(columns[5], pa.binary()), pa.array(columns[6], pa.string()),
        ],
        ["doc_id", "t1", "t2", "seq", "head", "body", "tail"],
    )
