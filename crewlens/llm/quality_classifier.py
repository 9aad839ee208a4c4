"""Quality classifier: random-indexing word vectors, pooled, and a small two-layer network.

Every word bucket has a fixed sparse random index vector. A word's context vector is the sum of its
neighbours' index vectors over the whole corpus: sums of integers, added up by Spark in a table of
fixed size (BUCKETS x DIMENSIONS), so it can be broadcast. A document is the mean of its words'
vectors and of the vectors of their shapes (kind, case, length, repetition of the word before).

The network is fitted on at most `sample` labelled rows, those with the smallest hash of their
doc_id; a part of them sets the temperature that calibrates the probabilities. Inputs are texts
only: no label, language, source or id enters a score.

Defined cases: null and empty texts are scored as documents without words; rows without a usable
label only get scores; several labels of one document count by their mean; if the sample lacks a
class, every score is the share of label 1 (0.5 without labels); repeated rows score alike; an empty
table gives an empty result; a row with a null doc_id counts as held out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crewlens.llm.shared import key_bitmaps, only_possible, returning_memory, stored, whole
from crewlens.llm.wordhash import LOWER, blocks, hashes, mix

BUCKETS = 4096
DIMENSIONS = 32
NONZERO = 4
REACH = 2  # neighbours on either side
RETURNED_ROWS = 500  # whole rows returned at a time
SAMPLE = 20_000
HIDDEN = 24
EPOCHS = 60
FOLDS = 5
THRESHOLD = 0.3

#: Shapes take the first buckets: kind (3) x case (3) x length (8) x repeated (2).
SHAPES = 144
_KIND = np.full(256, 3, np.int8)
_KIND[[*range(48, 58)]] = 2
_KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_KIND[[9, 10, 11, 12, 13, 32]] = 0
_UPPER = np.zeros(256, np.int64)
_UPPER[65:91] = 1


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """For each bucket the places and signs of its index vector's non-zero entries."""
    seed = mix(np.arange(BUCKETS * NONZERO, dtype=np.uint64) + np.uint64(0x5851F42D4C957F2D))
    places = (seed % np.uint64(DIMENSIONS)).astype(np.int64).reshape(BUCKETS, NONZERO)
    signs = np.where(seed >> np.uint64(63), 1.0, -1.0).reshape(BUCKETS, NONZERO)
    return places, signs


def _tokens(block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word buckets, shape buckets, and each document's first token (n + 1 numbers)."""
    data = block.data
    kinds = _KIND[data]
    change = np.ones(len(data), bool)
    change[1:] = kinds[1:] != kinds[:-1]
    change[block.starts[block.starts < len(data)]] = True
    starts = np.flatnonzero(change)
    ends = np.append(starts[1:], len(data))
    real = kinds[starts] > 0 if len(starts) else np.zeros(0, bool)
    starts, ends = starts[real], ends[real]
    words = hashes(LOWER[data], starts, ends)
    uppers = np.concatenate([[0], np.cumsum(_UPPER[data])])
    upper = uppers[ends] - uppers[starts]
    length = ends - starts
    first = np.append(np.searchsorted(starts, block.starts), len(starts))
    repeated = np.zeros(len(words), np.int64)
    repeated[1:] = words[1:] == words[:-1]
    repeated[first[:-1][first[:-1] < len(words)]] = 0
    case = np.where(upper == 0, 0, np.where((upper == 1) & (length > 1), 1, 2))
    shape = (((kinds[starts].astype(np.int64) - 1) * 3 + case) * 8 + np.minimum(length, 8) - 1) * 2 + repeated
    bucket = SHAPES + (words % np.uint64(BUCKETS - SHAPES)).astype(np.int64)
    return bucket, shape, first


def context_sums(docs: DataFrame) -> np.ndarray:
    """The corpus sums of neighbours' index vectors for every bucket: at most BUCKETS rows."""
    names = [f"c{i}" for i in range(DIMENSIONS)]

    @returning_memory
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, signs = index_vectors()
        sums = np.zeros(BUCKETS * DIMENSIONS)

        def add(at: np.ndarray, of: np.ndarray) -> None:
            flat = at[:, None] * DIMENSIONS + places[of]
            np.add(sums, np.bincount(flat.ravel(), signs[of].ravel(), BUCKETS * DIMENSIONS), out=sums)

        for batch in batches:
            for block in blocks(batch, lower=False):
                words, shapes, first = _tokens(block)
                owner = np.repeat(np.arange(block.n), np.diff(first))
                for step in range(1, REACH + 1):
                    near = owner[step:] == owner[:-step]
                    left, right = words[:-step][near], words[step:][near]
                    add(np.concatenate([left, right]), np.concatenate([right, left]))
                    if step == 1:
                        left, right = shapes[:-1][near], words[1:][near]
                        add(left, right)
        table = sums.reshape(BUCKETS, DIMENSIONS).astype(np.int64)
        used = np.flatnonzero(table.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), *(pa.array(table[used, i]) for i in range(DIMENSIONS))], ["bucket", *names]
        )

    schema = "bucket int, " + ", ".join(f"{c} long" for c in names)
    added = docs.select(whole(F.col("text")).alias("text")).mapInArrow(run, schema)
    rows = added.groupBy("bucket").agg(*(F.sum(c).alias(c) for c in names)).collect()
    table = np.zeros((BUCKETS, DIMENSIONS))
    for row in rows:
        table[row[0]] = row[1:]
    return table


def word_vectors(sums: np.ndarray) -> np.ndarray:
    """Unit context vectors without their common direction, plus half the index vector."""
    norms = np.linalg.norm(sums, axis=1, keepdims=True)
    unit = np.divide(sums, norms, out=np.zeros_like(sums), where=norms > 0)
    unit -= unit.mean(axis=0)
    places, signs = index_vectors()
    own = np.zeros((BUCKETS, DIMENSIONS))
    np.add.at(own, (np.arange(BUCKETS)[:, None], places), signs / np.sqrt(NONZERO))
    return (unit + 0.5 * own).astype(np.float32)


def _means(values: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros((n, DIMENSIONS), np.float32)
    full = np.flatnonzero(np.diff(first) > 0)
    if len(full):
        out[full] = np.add.reduceat(values, first[full], axis=0) / np.diff(first)[full][:, None]
    return out


def _pooled_batch(batch: pa.RecordBatch, table: np.ndarray) -> np.ndarray:
    """The pooled vectors of a batch's texts, one row each."""
    parts = [np.zeros((0, 2 * DIMENSIONS + 1), np.float32)]
    for block in blocks(batch, lower=False):
        words, shapes, first = _tokens(block)
        length = np.log1p(np.diff(first)).astype(np.float32)[:, None]
        word, shape = (_means(table[x], first, block.n) for x in (words, shapes))
        parts.append(np.hstack([word, shape, length]))
    return np.vstack(parts)


def pooled(docs: DataFrame, vectors: np.ndarray) -> DataFrame:
    """doc_id and the pooled vector of every row."""
    table = docs.sparkSession.sparkContext.broadcast(vectors)  # BUCKETS x DIMENSIONS, half a megabyte

    @returning_memory
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = _pooled_batch(batch, table.value)
            values = pa.ListArray.from_arrays(
                pa.array(np.arange(len(flat) + 1) * flat.shape[1], pa.int32()), pa.array(flat.ravel())
            )
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), values], ["doc_id", "pooled"])

    rows = docs.select("doc_id", whole(F.col("text")).alias("text"))
    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, pooled array<float>")


@dataclass
class Network:
    """Two layers with standardised inputs and a temperature; without layers, a constant."""

    layers: tuple[np.ndarray, ...] | None
    mean: np.ndarray
    scale: np.ndarray
    temperature: float
    share: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.tanh(((x - self.mean) / self.scale) @ w1 + b1) @ w2 + b2

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        if self.layers is None:
            return np.full(len(x), self.share)
        return _sigmoid(self.logits(x) / self.temperature)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, seed: int = 7) -> Network:
    """Fit on four fifths of the rows by Adam, set the temperature on the rest."""
    share = float(y.mean()) if len(y) else 0.5
    hold = np.arange(len(y)) % 5 == 4
    if len(y) < 10 or len(set(y[~hold])) < 2:
        return Network(None, np.zeros(1), np.ones(1), 1.0, share)
    rng = np.random.default_rng(seed)
    mean, scale = x[~hold].mean(axis=0), x[~hold].std(axis=0) + 1e-3
    inputs, wanted = (x[~hold] - mean) / scale, y[~hold]
    n, d = inputs.shape
    weights = [rng.normal(0, d**-0.5, (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
    first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for _ in range(EPOCHS):
        order = rng.permutation(n)
        for begin in range(0, n, 256):
            at = order[begin : begin + 256]
            a, t = inputs[at], wanted[at]
            h = np.tanh(a @ weights[0] + weights[1])
            error = (_sigmoid(h @ weights[2] + weights[3]) - t) / len(at)
            back = np.outer(error, weights[2]) * (1 - h * h)
            grads = [a.T @ back + 1e-4 * weights[0], back.sum(axis=0), h.T @ error + 1e-4 * weights[2], error.sum(keepdims=True)]
            step += 1
            for w, g, m, v in zip(weights, grads, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= 3e-3 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    network = Network(tuple(weights), mean, scale, 1.0, share)
    z, t = network.logits(x[hold]), y[hold]

    def loss(temperature: float) -> float:
        p = np.clip(_sigmoid(z / temperature), 1e-9, 1 - 1e-9)
        return float(-(t * np.log(p) + (1 - t) * np.log(1 - p)).mean())

    network.temperature = min(np.geomspace(0.25, 8, 61).tolist(), key=loss)
    return network


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def training_rows(features: DataFrame, labels: DataFrame, sample: int) -> tuple[np.ndarray, np.ndarray]:
    """At most `sample` labelled rows outside the held-out fold."""
    marks = (
        labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("quality"))
    )
    rows = (
        features.filter(~held_out(F.col("doc_id"))).join(marks, "doc_id")
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).select("pooled", "quality").toArrow()
    )
    flat = rows.column("pooled").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    x = flat.reshape(-1, 2 * DIMENSIONS + 1).astype(np.float64)
    return x, rows.column("quality").to_numpy().astype(np.float64)


def score(features: DataFrame, network: Network) -> DataFrame:
    @returning_memory
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("pooled").flatten().to_numpy(zero_copy_only=False)
            p = network.probabilities(flat.reshape(-1, 2 * DIMENSIONS + 1).astype(np.float64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p, pa.float64())], ["doc_id", "score"])

    return features.mapInArrow(run, f"doc_id {dict(features.dtypes)['doc_id']}, score double")


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    features = stored(pooled(docs, word_vectors(context_sums(docs))), "pooled_documents")
    network = fit(*training_rows(features, labels, sample))
    return score(features, network).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def accepted(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs`, with all their columns, that the classifier accepts, each judged by its own text.

    Only documents that may be labelled are pooled to learn from. All rows are then scored and filtered where
    they are read, without a shuffle of texts.
    """
    vectors = word_vectors(context_sums(docs))
    key = F.xxhash64("doc_id").alias("label_key")
    marked = key_bitmaps(labels.filter("doc_id IS NOT NULL").select(key), "label_key")
    learnt = only_possible(docs.select("doc_id", "text", key), "label_key", marked).drop("label_key")
    network = fit(*training_rows(pooled(learnt, vectors), labels, sample))
    table = docs.sparkSession.sparkContext.broadcast(vectors)
    text_at = docs.columns.index("text")

    @returning_memory
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, len(batch), RETURNED_ROWS):
                part = batch.slice(begin, RETURNED_ROWS)
                texts = pa.RecordBatch.from_arrays([part.column(text_at).fill_null("")], ["text"])
                p = network.probabilities(_pooled_batch(texts, table.value).astype(np.float64))
                yield part.filter(pa.array(p >= threshold))

    numbered = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))  # a name may hold a dot
    return numbered.mapInArrow(run, numbered.schema).toDF(*docs.columns)
