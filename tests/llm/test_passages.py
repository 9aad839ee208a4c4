"""Substring dedup and periodic runs against plain Python."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from crewlens.llm import periodic_runs, substring_dedup
from crewlens.llm.queries import op12_periodic_runs, op13_substring_dedup, planted
from tests.llm import cases


def words_of(text):
    return (text or "").encode().split()


def expected_left(data, window=13):
    holder = {}
    for doc_id, text in data:
        words = words_of(text)
        for i in range(len(words) - window + 1 if doc_id is not None else 0):
            w = tuple(words[i : i + window])
            holder[w] = min(doc_id, holder.get(w, doc_id))
    out = Counter()
    for doc_id, text in data:
        words = words_of(text)
        gone = set()
        for i in range(len(words) - window + 1 if doc_id is not None else 0):
            if holder[tuple(words[i : i + window])] < doc_id:
                gone.update(range(i, i + window))
        kept = [w for i, w in enumerate(words) if i not in gone]
        out[(doc_id, len(words), len(gone), b" ".join(kept).decode())] += 1
    return out


def odd_rows(seed=3):
    """Shared passages in many contexts, copies, long repetitions, very long and short texts."""
    rng = random.Random(seed)
    shared = [cases.passage(rng, n) for n in (12, 13, 14, 30, 200)]
    texts = [" ".join([cases.passage(rng, rng.randint(0, 40)), rng.choice(shared), cases.passage(rng, rng.randint(0, 40))]) for _ in range(80)]
    texts += [shared[4], shared[4] + " x", "word " * 3000, "word " * 500 + "end", "a b " * 700, shared[3].replace(" ", "\n\t ")]
    texts += [cases.passage(rng, 40_000) + " " + shared[2], None, "", "x y  z", "w" * 100_000]
    rows = [(i if i % 9 else i - 1, t) for i, t in enumerate(texts)]
    return rows + [rows[5], rows[5], (None, shared[4]), (None, None), (-7, shared[3])]


@pytest.mark.parametrize("shard_words", [1 << 19, 2000, 60])
def test_passages_leave_later_documents(spark, shard_words):
    """Small shards take crowded anchors apart into single windows."""
    data = odd_rows() + cases.rows(4, 20)
    data = [r[:2] for r in data]
    df = spark.createDataFrame(data, "doc_id bigint, text string")
    got = substring_dedup.without_repeats(df, shard_words=shard_words)
    assert Counter(tuple(r) for r in got.collect()) == expected_left(data)


def test_passages_with_clashing_columns_and_no_rows(spark):
    df = cases.frame(spark).withColumns({c: F.lit(1) for c in ("anchor", "row1", "row2", "gaps", "key", "first", "touched", "windows")})
    data = [tuple(r) for r in df.select("doc_id", "text").collect()]
    assert Counter(tuple(r) for r in substring_dedup.without_repeats(df).collect()) == expected_left(data)
    assert substring_dedup.without_repeats(cases.empty(spark)).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), min_size=5, max_size=40), min_size=1, max_size=8))
def test_index_finds_first_holders(passages):
    window = 5
    holders = np.arange(len(passages))[::-1]
    got = substring_dedup.first_holders([np.array(p, np.uint64) for p in passages], holders, window)
    for p, found in zip(passages, got):
        for i, h in enumerate(found):
            w = p[i : i + window]
            assert h == min(holders[k] for k, q in enumerate(passages) if any(q[j : j + window] == w for j in range(len(q))))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=60), st.lists(st.integers(1, 5), min_size=6, max_size=12))
def test_matching_statistics(text, pattern):
    """How many of the numbers before an end match somewhere in the text, for patterns of other texts as well."""
    index = substring_dedup.FMIndex(np.array([*text, 0]), 6)
    if max(pattern) > max(text):
        pattern = [min(x, max(text)) for x in pattern]
    ends = np.arange(6, len(pattern) + 1)
    length, _ = index.match(np.array(pattern), ends, 6)
    for end, n in zip(ends.tolist(), length.tolist()):
        fits = [k for k in range(7) if any(text[j : j + k] == pattern[end - k : end] for j in range(len(text) - k + 1))]
        assert n == max(fits)


def brute_runs(words, exponent=4, shortest=6):
    """Maximal stretches by definition: every start and end, smallest period by trial."""
    n, found = len(words), set()
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            stretch = words[i : i + length]
            smallest = next(p for p in range(1, q + 1) if stretch[p:] == stretch[:-p])
            if smallest == q and length >= max(shortest, exponent * q):
                found.add((i, length, q))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_collapse(words, runs):
    gone = {i for start, length, period in runs for i in range(start + period, start + length)}
    return [w for i, w in enumerate(words) if i not in gone]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=90))
def test_runs_of_few_words(words):
    runs = periodic_runs.find_runs(words)
    assert runs == brute_runs(words)
    assert periodic_runs.collapse(words, runs) == brute_collapse(words, runs)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 30), min_size=1, max_size=9), st.integers(1, 9)), max_size=8))
def test_runs_between_other_words(pieces):
    words = [w for base, times in pieces for w in base * times]
    runs = periodic_runs.find_runs(words)
    assert runs == brute_runs(words)
    assert periodic_runs.collapse(words, runs) == brute_collapse(words, runs)


def test_segments_are_stable():
    rng = random.Random(5)
    for _ in range(200):
        words = [rng.randint(0, 40) for _ in range(rng.randint(0, 300))]
        found = periodic_runs.stable_segments(words)
        for begin, end in found:
            assert min(Counter(words[begin:end]).values()) >= 4 and end - begin >= 6
        # splitting piece by piece, with every count taken anew, ends in the same segments
        todo, plain = [(0, len(words))], []
        while todo:
            begin, end = todo.pop()
            counts = Counter(words[begin:end])
            cuts = [begin - 1, *(i for i in range(begin, end) if counts[words[i]] < 4), end]
            pieces = [(a + 1, b) for a, b in zip(cuts, cuts[1:]) if b - a > 6]
            if len(cuts) == 2:
                plain += pieces
            else:
                todo += pieces
        assert found == sorted(plain)


def test_runs_of_long_documents():
    """Half a million words: one word, a long period, and three words in random order."""
    n = 500_000
    assert periodic_runs.find_runs(["a"] * n) == [(0, n, 1)]
    rng = random.Random(1)
    base = [rng.randint(0, 2) for _ in range(50_000)]
    long = [r for r in periodic_runs.find_runs(base * 5) if r[2] >= 50]
    assert long == [(0, 250_000, 50_000)]


def query_rows(spark, tmp_path, query, df):
    df.write.parquet(f"{tmp_path}/documents.parquet")
    return [tuple(r) for r in query(spark, str(tmp_path)).collect()]


def expected_runs(doc_id, text):
    words = words_of(text)
    n = len(words)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    listing = "".join(f"{s},{le},{p}\n" for s, le, p in runs)
    sha = [hashlib.sha256(x).hexdigest() for x in (listing.encode(), b" ".join(brute_collapse(words, runs)))]
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, *sha)


def test_runs_query(spark, tmp_path):
    df = cases.frame(spark).withColumns({c: F.lit("x") for c in ("runs", "longest", "collapsed")})
    data = [tuple(r) for r in df.select("doc_id", "text").collect()]
    assert any(i is not None and zlib.crc32(str(i).encode()) % 10 == 0 and words_of(t) for i, t in data)
    got = query_rows(spark, tmp_path, op12_periodic_runs, df)
    assert Counter(got) == Counter(expected_runs(*r) for r in data)


def test_runs_of_no_rows(spark):
    assert periodic_runs.periodic_runs(cases.empty(spark)).collect() == []


def test_planted_only_in_chosen_documents(spark):
    df = spark.createDataFrame([(i, " a  b\tc d e f g ") for i in range(200)], "doc_id bigint, text string")
    for r in df.select("doc_id", planted(F.col("text"), F.col("doc_id")).alias("text")).collect():
        assert (r.text != " a  b\tc d e f g ") == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0)


def test_passages_query(spark, tmp_path):
    df = cases.frame(spark, extra=False)
    data = [tuple(r) for r in df.select("doc_id", "text").collect()]
    left = Counter()
    for (doc_id, n, removed, text), times in expected_left(data).items():
        left[(doc_id, n, removed, hashlib.sha256(text.encode()).hexdigest())] += times
    assert Counter(query_rows(spark, tmp_path, op13_substring_dedup, df)) == left
