"""Vector codes against plain whole-number arithmetic."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from crewlens.llm import vector_codes
from crewlens.llm.queries import op11_vector_codes

SCHEMA = "vec_id bigint, embedding array<float>, label int, codes string, numbers int, place int, carry0 int"


def expected(rows, parts=4, entries=256, rounds=4):
    """(vec_id, code, error, label) and the codebooks of (vec_id, embedding, label) rows, one by one."""
    kept = [(i, [math.floor(1024 * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    size = Counter(len(v) for _, v, _ in kept)
    length = max(size, key=lambda n: (size[n], n), default=0)
    kept = sorted((r for r in kept if len(r[1]) == length), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = -(-length // parts)
    filled = [v + [0] * (parts * width - length) for _, v, _ in kept]
    cut = [[v[k * width : (k + 1) * width] for v in filled] for k in range(parts)]
    books = [[list(v) for v in c[:entries]] for c in cut]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for k in range(parts):
            members = defaultdict(list)
            for x in cut[k]:
                members[nearest(x, books[k])[1]].append(x)
            for i, xs in members.items():
                books[k][i] = [sum(column) // len(xs) for column in zip(*xs)]
    out = []
    for at, (i, _, label) in enumerate(kept):
        found = [nearest(cut[k][at], books[k]) for k in range(parts)]
        out.append((i, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found), label))
    return out, books


def vectors(seed, n, length=8, near=5):
    rng = random.Random(seed)
    centres = [[rng.uniform(-1, 1) for _ in range(length)] for _ in range(near)]
    rows = []
    for i in range(n):
        v = [float(np.float32(c + rng.gauss(0, 0.1))) for c in rng.choice(centres)]
        rows.append((i * 3, v, rng.choice([1, 2, None])))
    return rows


def odd(length=8):
    nan, inf = float("nan"), float("inf")
    return [
        (5, None, 1), (6, [0.5] * (length - 1) + [None], 1), (7, [nan] * length, 2), (8, [inf] * length, 2), (9, [-inf] + [0.0] * (length - 1), 2),
        (10, [], 1), (11, [1.0], 1), (12, [-0.0] * length, None), (12, [-1e-9] * length, None), (None, [0.25] * length, 1), (13, [0.25] * length, 1), (13, [0.25] * length, 1),
    ]


@pytest.mark.parametrize("length", [8, 6, 3])
def test_query(spark, tmp_path, length):
    rows = vectors(length, 420, length) + odd(length)
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame([(*r, "x", 1, 1, 1) for r in rows], SCHEMA).repartition(5)
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    got = op11_vector_codes(spark, str(tmp_path)).collect()
    found, books = expected(rows)
    total = Counter()
    for _, _, error, label in found:
        total[label] += error
    sha = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    assert Counter((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in got) == Counter(
        (i, code, error, total[label], sha) for i, code, error, label in found
    )


@pytest.mark.parametrize("rows", [[], [(1, None, 1)], [(1, [], 1), (2, [], None)], [(4, [0.5] * 8, 1), (3, [1.5] * 8, None)]])
def test_few_vectors(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1, 1, 1) for r in rows], SCHEMA)
    codes = vector_codes.encode(df, carry=["vec_id", "codes"])
    assert sorted(tuple(r) for r in codes.rows.collect()) == sorted(
        (i, "x", [int(code[k : k + 2], 16) for k in (0, 2, 4, 6)], error) for i, code, error, _ in expected(rows)[0]
    )


def test_very_large_components(spark):
    """Held within a bound at which squared distances do not overflow."""
    rows = [(1, [1e300] * 8, "a"), (2, [-1e300] * 8, "a"), (3, [1.0] * 8, "a")]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label string")
    got = {r.vec_id: r for r in vector_codes.encode(df).rows.collect()}
    assert [got[i].codes for i in (1, 2, 3)] == [[0] * 4, [1] * 4, [2] * 4]
    assert {r.error for r in got.values()} == {0}


def test_bounds_save_distances_and_change_nothing():
    rng = np.random.default_rng(4)
    centres = rng.integers(-900, 900, (60, 16))
    entries = centres[rng.integers(0, 60, 256)] + rng.integers(-60, 60, (256, 16))
    entries[7] = entries[200]
    x = centres[rng.integers(0, 60, 3000)] + rng.integers(-60, 60, (3000, 16))
    x[:50] = entries[200]
    pivots = vector_codes.choose_pivots(entries)
    to_pivots = np.sqrt(vector_codes.distances(x, pivots).astype(float))
    at, best, tried = vector_codes.nearest_entries(x, to_pivots, entries, pivots)
    every = vector_codes.distances(x, entries)
    assert (at == every.argmin(axis=1)).all() and (best == every.min(axis=1)).all()
    assert (at[:50] == 7).all()
    assert tried < every.size / 3
