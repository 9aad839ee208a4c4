"""The n-gram join, language model, classifier and mixing against brute force."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest

from crewlens.llm import mixing, ngram_join, ngram_lm, quality_classifier, stages
from tests.llm import cases

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---- n-gram join ----

def gram_set(text, n=5):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if len(words) >= n else frozenset([tuple(words)] if words else [])


def expected_classes(data):
    """Per row: class and links, by comparing all pairs."""
    sets, parent, links = [gram_set(t) for _, t in data], list(range(len(data))), [0] * len(data)

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(data)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both / (len(sets[i]) + len(sets[j]) - both) >= 0.8:
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    members = defaultdict(list)
    for i, (doc_id, _) in enumerate(data):
        members[root(i)].append(doc_id)
    low = {r: min((d for d in ids if d is not None), default=None) for r, ids in members.items()}
    return Counter((doc_id, low[root(i)] if sets[i] else doc_id, links[i]) for i, (doc_id, _) in enumerate(data))


def near_copies(spark):
    rng, data = random.Random(4), []
    for group in range(12):
        words = [f"w{rng.randint(0, 500)}" for _ in range(rng.randint(8, 160))]
        for _ in range(rng.randint(1, 14)):
            changed = list(words)
            for _ in range(rng.randint(0, 3)):
                changed[rng.randrange(len(changed))] = f"v{rng.randint(0, 500)}"
            data.append((len(data) + 100 * group, " ".join(changed)))
    rng.shuffle(data)
    return spark.createDataFrame(data, "doc_id bigint, text string")


@pytest.mark.parametrize(("rows", "grams"), [(1024, 500_000), (3, 200)])
def test_links_and_classes(spark, monkeypatch, rows, grams):
    """Also with buckets and clusters dealt to many parts. Recall is set so high that nothing is lost."""
    monkeypatch.setattr(ngram_join, "BUCKET_ROWS", rows)
    monkeypatch.setattr(ngram_join, "BLOCK_GRAMS", grams)
    df = near_copies(spark)
    data = [tuple(r) for r in df.collect()]
    expected = expected_classes(data)
    assert any(row[2] for row in expected)
    assert Counter(map(tuple, ngram_join.jaccard_join(df, recall=0.99999).collect())) == expected


def test_join_of_odd_rows(spark):
    df = cases.frame(spark)
    data = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    assert Counter(map(tuple, ngram_join.jaccard_join(df).collect())) == expected_classes(data)
    assert ngram_join.jaccard_join(cases.empty(spark)).count() == 0


def test_null_and_repeated_ids(spark):
    """Near copies among rows with a null id, repeated rows, and an id with two texts."""
    base = [[f"{t}{i}" for i in range(60)] for t in "abcd"]
    text, near = [" ".join(w) for w in base], [" ".join(["x", *w[1:]]) for w in base]
    data = [
        (None, text[0]), (None, text[0]), (5, near[0]),  # a null class near one with an id
        (1, text[1]), (1, text[1]), (9, near[1]),  # the repeated row is the least
        (3, text[2]), (3, text[3]), (7, near[2]), (8, near[3]),  # two texts under one id
        (None, "e " * 3 + "f g h i j"), (None, None),
    ]
    df = spark.createDataFrame(data, "doc_id bigint, text string")
    assert Counter(map(tuple, ngram_join.jaccard_join(df, recall=0.99999).collect())) == expected_classes(data)
    kept = {tuple(r) for r in stages.drop_near_copies(spark, df, "").collect()}
    assert kept == {data[i] for i in (2, 3, 6, 7, 10, 11)}


def test_band_recall():
    for rows in (3, 5, 7):
        bands = ngram_join.bands_for(0.8, 0.998, rows)
        assert 1 - (1 - 0.8**rows) ** bands >= 0.998 > 1 - (1 - 0.8**rows) ** (bands - 1)


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(170)] + [(400 + i, 401 + i) for i in range(60)]
    edges = [(a, b) for a, b in edges if a != b]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in ngram_join.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in list(parent)}


# ---- language model ----

def expected_scores(data):
    tokens = [[*re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW)), None] for _, t in data]
    train = [d is not None and crc32(str(d).encode()) % 10 != 0 for d, _ in data]
    one, two, three = Counter(), Counter(), Counter()
    for t, used in zip(tokens, train):
        if used:
            one.update(t)
            two.update(zip(["<begin>", *t], t))
            three.update(zip(["<begin>", "<begin>", *t], ["<begin>", *t], t))
    n, v = sum(one.values()), len(one)
    context = Counter(one)
    context["<begin>"] = two["<begin>", "<begin>"] = sum(train)
    whole = n + 0.1 * (v + 1)
    out = []
    for (doc_id, _), t, used in zip(data, tokens, train):
        base = sum(math.log10((one[w] + 0.1) / whole) for w in t)
        model = 0.0
        for u, v, w in zip(["<begin>", "<begin>", *t], ["<begin>", *t], t):
            lower = ngram_lm.SHARE * (two[v, w] + ngram_lm.PRIOR * (one[w] + 0.1) / whole)
            model += math.log10((three[u, v, w] + lower) / (two[u, v] + ngram_lm.SHARE * (context[v] + ngram_lm.PRIOR)))
        out.append((doc_id, not used, len(t), sum(one[w] > 0 for w in t), n, base, model))
    return out


@pytest.mark.parametrize("partitions", ["2", "40"])
def test_lm_scores(spark, partitions):
    """With many shards the common words are dealt to several of them."""
    df = cases.frame(spark)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = [tuple(r) for r in ngram_lm.score_documents(df).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    expected = expected_scores([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])
    def order(rows):
        return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    for a, b in zip(order(got), order(expected), strict=True):
        assert a[:5] == b[:5]
        assert a[5] == pytest.approx(b[5], rel=1e-9) and a[6] == pytest.approx(b[6], rel=1e-4, abs=1e-3)


def test_lm_shards_grow_with_the_corpus(spark, monkeypatch):
    """No shard gets many more tokens than the budget, whatever the number of shuffle partitions."""
    df, sizes, packed_tokens = cases.frame(spark), [], ngram_lm._packed_tokens
    expected = sorted(map(str, ngram_lm.score_documents(df).select("doc_id", "n_tokens", "n_known").collect()))

    def packed(rows, shards, corpus):
        sizes.append((shards, corpus.tokens))
        return packed_tokens(rows, shards, corpus)

    monkeypatch.setattr(ngram_lm, "SHARD_TOKENS", 500)
    monkeypatch.setattr(ngram_lm, "_packed_tokens", packed)
    got = sorted(map(str, ngram_lm.score_documents(df).select("doc_id", "n_tokens", "n_known").collect()))
    ((shards, tokens),) = sizes
    assert got == expected and tokens / shards <= 500 and shards > int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_lm_without_rows(spark):
    assert ngram_lm.score_documents(cases.empty(spark)).count() == 0
    only_held_out = spark.createDataFrame([(i, "a b") for i in range(60) if crc32(str(i).encode()) % 10 == 0], "doc_id long, text string")
    rows = ngram_lm.score_documents(only_held_out).collect()
    assert rows and all(r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score) for r in rows)


@pytest.mark.parametrize("universe", [1, 50, 10_000, 1 << 40])
def test_elias_fano(universe):
    rng = np.random.default_rng(3)
    values = np.sort(rng.integers(0, universe, 700))
    search = ngram_lm.EliasFano.build(values, universe)
    assert (search.values(np.arange(700)) == values).all()
    wanted = np.concatenate([values[::7], rng.integers(0, universe, 300)])
    place, same = search.successor(wanted)
    assert (place == np.searchsorted(values, wanted)).all() and (same == np.isin(wanted, values)).all()
    least, most = rng.integers(0, 350, len(wanted)), rng.integers(350, 701, len(wanted))
    place, same = search.successor(wanted, least, most)
    expected = [a + np.searchsorted(values[a:b], w) for w, a, b in zip(wanted, least, most)]
    assert (place == expected).all()
    assert (same == [w in values[a:b] for w, a, b in zip(wanted, least, most)]).all()
    place, same = ngram_lm.EliasFano.build(values[:0], universe).successor(np.array([0]))
    assert (place == 0).all() and not same.any()


def test_written_model_scores_other_documents(spark):
    """From the written tries alone, as if the other documents had been held out of the same corpus."""
    df = cases.frame(spark).select("doc_id", "text")
    ids = [i for i in range(10**6, 10**6 + 2000) if crc32(str(i).encode()) % 10 == 0]
    texts = [r.text for r in df.limit(30).collect()] + ["words that no text holds " * 3, "", None]
    other = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    _, model = ngram_lm.fit_and_score(df)
    got = ngram_lm.Model.load(spark, model.path).score(other)
    expected = ngram_lm.score_documents(df.unionByName(other)).filter(f"doc_id >= {10**6}")
    def rows(scored):
        return sorted(map(tuple, scored.collect()))

    for a, b in zip(rows(got), rows(expected), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9) and a[6] == pytest.approx(b[6], rel=1e-4, abs=1e-3)
    assert ngram_lm.Model.load(spark, model.path).score(other.limit(0)).count() == 0


def test_packing():
    rng = np.random.default_rng(1)
    arrays = [rng.integers(0, 1 << b, 99).astype(np.uint64) for b in (1, 8, 17, 40, 63)] + [np.zeros(0, np.uint64)]
    assert all((a == b).all() for a, b in zip(ngram_lm._unpack(ngram_lm._pack(*arrays)), arrays, strict=True))


# ---- classifier ----

def test_classifier_on_held_out_rows(spark, sf_dir):
    docs, labels = (spark.read.parquet(sf_dir.replace("sf0.001", "sf0.01") + f"/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_classifier.classify(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    above = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
    assert above > 0.97
    assert sum(r.predicted for r in rows if r.quality == 1) > 0.97 * len(good)


def test_classifier_on_odd_rows(spark):
    df = cases.frame(spark)
    labels = spark.createDataFrame(
        [(i * 3, i % 2 if i % 5 else None, 0) for i in range(60)] + [(3, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int"
    )
    rows = quality_classifier.classify(df, labels).collect()
    assert len(rows) == df.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (r.doc_id is None or crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    none = quality_classifier.classify(df, labels.filter("false")).collect()
    assert {r.score for r in none} == {0.5} and {r.predicted for r in none} == {1}
    assert quality_classifier.classify(cases.empty(spark), labels).count() == 0


def test_labels_are_no_inputs(spark):
    """Held-out labels, languages and sources change no score."""
    df = cases.frame(spark, extra=False)
    labels = [(i * 3, i % 2, 0) for i in range(60)]
    flipped = [(d, 1 - q if crc32(str(d).encode()) % 5 == 0 else q, 1) for d, q, _ in labels]
    schema = "doc_id long, quality int, toxic int"
    first = quality_classifier.classify(df, spark.createDataFrame(labels, schema))
    second = quality_classifier.classify(df.selectExpr("doc_id", "text", "'q' AS lang", "'z' AS source"), spark.createDataFrame(flipped, schema))
    assert Counter(map(tuple, first.collect())) == Counter(map(tuple, second.collect()))


# ---- mixing ----

def expected_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, live = {}, set(sizes)
    while True:
        left, total = 1.5 * sum(sizes.values()) - sum(target.values()), sum(weight[s] for s in live)
        share = {s: left * weight[s] / total for s in live} if live else {}
        over = [s for s in live if share[s] > 2 * sizes[s]]
        if not over:
            return target | share
        for s in over:
            target[s] = 2.0 * sizes[s]
            live.discard(s)


def test_mix(spark):
    df = cases.frame(spark)
    source = {(r.doc_id, r.text): r.source for r in df.collect()}
    rows = mixing.mix(df).collect()
    assert len(rows) == df.count()
    by_id = defaultdict(set)
    for (doc_id, text), s in source.items():
        by_id[doc_id].add((s, len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))))
    sizes, taken, target = Counter(), Counter(), {}
    for r in rows:
        (s,) = {s for s, size in by_id[r.doc_id] if size == r.size} if r.doc_id is not None else [("s1" if r.size else None)]
        sizes[s] += r["size"]
        taken[s] += r.taken
        target[s] = r.target
        assert 0 <= r.taken <= 2 * r.size
    for s, expected in expected_targets(sizes).items():
        assert target[s] == pytest.approx(expected)
        assert abs(taken[s] - expected) <= 1.5 * mixing.BLOCK_WORDS
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(df.repartition(7)).collect()))
    assert mixing.mix(cases.empty(spark)).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000])
def test_permutations(n):
    found = mixing.permuted(np.arange(n), n, 5)
    assert sorted(found.tolist()) == list(range(n))
    assert n < 50 or found.tolist() != mixing.permuted(np.arange(n), n, 6).tolist()


def test_shard_counts_agree_with_each_other():
    whole, before = mixing.shard_counts(3, 10_000, 37, 0, 37)
    assert before == 0 and whole.sum() == 10_000
    for low, high in ((0, 5), (5, 30), (30, 37)):
        part, before = mixing.shard_counts(3, 10_000, 37, low, high)
        assert part.tolist() == whole[low:high].tolist() and before == whole[:low].sum()
    assert 150 < whole.min() and whole.max() < 400
