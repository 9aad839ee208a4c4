"""Token counts, BPE and license scans against the libraries and plain Python."""

from __future__ import annotations

import hashlib
import os
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from crewlens.llm import bpe, licenses, token_counts
from tests.llm import cases

os.environ["TOKENIZERS_PARALLELISM"] = "false"
BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def libraries():
    from tokenizers import Tokenizer

    return {path: Tokenizer.from_file(path) for path in (BYTE, WORD)}


def ids_of(libraries, path, text):
    return libraries[path].encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_token_counts(spark, libraries, tmp_path, path):
    df = cases.frame(spark)
    cache = str(tmp_path / "cache")
    expected = Counter()
    for r in df.select("doc_id", "text").collect():
        n = len(ids_of(libraries, path, r.text))
        expected[(r.doc_id, len((r.text or "").encode()), n, n > 1024)] += 1
    for _ in range(2):  # the second time from the cache
        assert Counter(map(tuple, token_counts.count_tokens(df, path, cache).collect())) == expected
    stored = spark.read.parquet(cache)
    assert stored.count() == stored.select("digest").distinct().count() == df.selectExpr("coalesce(text, '')").distinct().count()


def test_cache_is_read_and_extended(spark, tmp_path):
    cache = str(tmp_path / "cache")
    one = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    token_counts.count_tokens(one, BYTE, cache).collect()
    spark.read.parquet(cache).withColumn("n_tokens", F.lit(77).cast("long")).write.partitionBy("tokenizer").parquet(cache + "2")
    more = one.unionByName(spark.createDataFrame([(3, "new one")], "doc_id long, text string"))
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(more, BYTE, cache + "2").collect()}
    assert got == {1: 77, 2: 77, 3: 2}
    assert {r.n_tokens for r in token_counts.count_tokens(one, WORD, cache + "2").collect()} == {1, 2}


def test_very_long_white_space(spark, libraries):
    """Runs that the merge engine's pattern cannot split count as in the library."""
    texts = [" " * 1_500_000, "a" + "\n" * 1_500_000 + "b", "c d"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(df, BYTE).collect()}
    assert got == {i: len(ids_of(libraries, BYTE, t)) for i, t in enumerate(texts)}


def test_sentencepiece_counts(spark):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    df = cases.frame(spark, extra=False).filter("doc_id < 90")
    got = Counter((r.doc_id, r.n_tokens) for r in token_counts.count_tokens(df, path).collect())
    assert got == Counter((r.doc_id, len(library.encode(r.text or ""))) for r in df.collect())


def test_bpe_round_trip(spark, libraries):
    df = cases.frame(spark)
    expected = Counter()
    for r in df.select("doc_id", "text").collect():
        ids = ids_of(libraries, WORD, r.text)
        decoded = libraries[WORD].decode(ids, skip_special_tokens=False)
        digest = [hashlib.sha256(x).hexdigest() for x in (np.array(ids, "<u4").tobytes(), decoded.encode())]
        expected[(r.doc_id, len(ids), *digest)] += 1
    assert Counter(map(tuple, bpe.encode_decode(df, WORD).collect())) == expected


def test_joins_are_repaired(libraries):
    """Any cut of any text gives the ids of the whole text."""
    rng, engine = random.Random(5), bpe.WordEncoder(WORD)
    for _, text, *_ in cases.rows():
        text = (text or "")[:600]
        cuts = sorted(rng.randint(0, len(text)) for _ in range(6))
        chunks = [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]
        parts = []
        for chunk in chunks:
            head, body, tail = bpe.edges(chunk)
            parts.append((head, None if body is None else engine.ids(body), tail))
        ids = np.frombuffer(bpe.join_chunks(parts, engine.ids), "<u4").tolist()
        assert ids == ids_of(libraries, WORD, text)
        assert engine.decode(np.array(ids, "<u4").tobytes()) == libraries[WORD].decode(ids, skip_special_tokens=False)


def test_equal_passages_are_cut_alike():
    rng = random.Random(2)
    passage = cases.passage(rng, 3000).encode()
    places = [bpe.cut_places(np.frombuffer(p + passage, np.uint8)) - len(p) for p in (b"", b"some other start ")]
    assert len(places[0]) > 3
    assert set(places[0][places[0] > 16]) == set(places[1][places[1] > 16])


def test_vocabularies_that_keep_white_space_are_refused():
    with pytest.raises(ValueError):
        bpe.WordEncoder(BYTE)


BASE = [("gpl", "gnu general public license"), ("apache", "apache license"), ("cc-by", "cc by"), ("mit", "mit license")]


def test_base_phrases(spark):
    df = cases.frame(spark)
    got = Counter()
    for r in licenses.summarise(licenses.scan_licenses(df)).collect():
        got[(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)] += 1
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) or not r.base_labels
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)
    expected = Counter()
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for r in df.select("doc_id", "text").collect():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (r.text or "").translate(low))
        hits = [(i, label) for label, p in BASE for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
        places = [i for i, _ in hits]
        labels = ",".join(sorted({label for _, label in hits}))
        expected[(r.doc_id, len(words), len(hits), min(places, default=None), max(places, default=None), labels)] += 1
    assert got == expected


def pattern(markup: str) -> re.Pattern:
    """The same template as a regular expression over words that each end in a space."""
    out = ""
    for part in re.split(r"(<<[^>]*>>)", markup):
        if part == "<<optional>>":
            out += "(?:"
        elif part == "<</optional>>":
            out += ")?"
        elif part.startswith("<<any:"):
            out += rf"(?:\S+ ){{0,{part[6:-2]}}}"
        else:
            out += "".join(re.escape(w) + " " for w in licenses.words_of(part))
    return re.compile(out)


@pytest.mark.parametrize("seed", range(4))
def test_automata_accept_what_the_template_says(seed):
    rng = random.Random(seed)
    markups = ["a <<optional>>b <<optional>>c<</optional>><</optional>> d", "a <<any:2>> b", "<<optional>>c<</optional>> a b", "a <<any:1>> <<optional>>d<</optional>> b c"]
    markups += [m for _, m in licenses.TEMPLATES]
    for markup in markups:
        automaton = licenses.compile_template("x", markup)
        own = licenses.words_of(re.sub("<<[^>]*>>", " ", markup))
        for _ in range(30):
            words = rng.choices("abcd", k=9) if len(markup) < 60 else [w for w in own if rng.random() < 0.97]
            for at in range(min(len(words), 12)):
                best = 0
                for end in range(at + 1, len(words) + 1):
                    if pattern(markup).fullmatch("".join(w + " " for w in words[at:end])):
                        best = end - at
                assert automaton.longest(words, at) == best, (markup, words, at)


def test_full_grant_and_changed_wording():
    scan = licenses.scanner().scan
    grant = next(m for label, m in licenses.TEMPLATES if m.startswith("Permission is hereby"))
    text = re.sub("<<[^>]*>>", "", grant)
    assert [m[0] for m in scan("Copyright (c) 2020 Ann Lee. All rights reserved. " + text)] == ["all-rights-reserved", "mit"]
    assert scan(text.replace("without restriction", "with restriction")) == []


def filled(markup):
    """The template's text with all optional words and a name in each replaceable region."""
    return re.sub("<<any:[^>]*>>", " Ann ", re.sub("<</?optional>>", " ", markup))


@pytest.mark.parametrize(("label", "markup"), licenses.WHOLE_LICENSES)
def test_whole_licenses(label, markup):
    """Met with and without optional words; not met once any mandatory word is changed or missing."""
    scan = licenses.scanner().scan
    full = licenses.words_of(filled(markup))
    bare = licenses.words_of(re.sub("<<any:[^>]*>>", " Ann ", re.sub("<<optional>>.*?<</optional>>", " ", markup)))
    for words in (full, bare):
        found = [m for m in scan("Some Work. " + " ".join(words) + ". The end.") if m[0] == label]
        assert len(found) == 1 and found[0][2] + found[0][3] == 2 + len(words)
    for i in range(len(bare)):
        if bare[i] != "ann":
            for changed in (bare[:i] + ["qqq"] + bare[i + 1 :], bare[:i] + bare[i + 1 :]):
                assert label not in {m[0] for m in scan(" ".join(changed))}, (label, i, bare[i])


def test_license_variants_are_told_apart():
    whole = dict(licenses.WHOLE_LICENSES)
    labels = {name: {m[0] for m in licenses.scanner().scan(filled(text))} & set(whole) for name, text in whole.items()}
    assert labels == {name: {name} for name in whole}


def test_labels_and_scores_of_whole_texts(spark, sf_dir):
    """The query's labels and score against regular expressions over all words of each text, without
    anchors; licenses stand in some texts whole, in some with a word changed."""
    rng = random.Random(7)
    parts = licenses.TEMPLATES + licenses.WHOLE_LICENSES
    forms = [(label, pattern(m), len(licenses.words_of(re.sub("<<optional>>.*?<</optional>>|<<any:[^>]*>>", " ", drop_nested(m))))) for label, m in parts]
    forms += [(label, pattern(phrase), len(phrase.split())) for label, phrase in licenses.BASE_PHRASES]
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(150).collect()]
    for i in range(60):
        words = filled(rng.choice(parts)[1]).split()
        if i % 3 == 0:
            words[rng.randrange(len(words))] = "qqq"
        rows.append((10**6 + i, "Some words before.\n" + " ".join(words) + "\nand behind."))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.labels, round(r.score, 9)) for r in licenses.summarise(licenses.scan_licenses(df)).collect()}
    for doc_id, text in rows:
        words = "".join(w + " " for w in licenses.words_of(text))
        met = [(label, n) for label, form, n in forms if re.search(r"(?<!\S)" + form.pattern, words)]
        score = max((1 - 1 / (1 + n) for _, n in met), default=0.0)
        assert got[doc_id] == (",".join(sorted({label for label, _ in met})), round(score, 9)), doc_id


def drop_nested(markup):
    """The markup without optional regions that stand inside others."""
    return re.sub("(<<optional>>(?:(?!<</?optional>>).)*)<<optional>>.*?<</optional>>", r"\1", markup)


def test_empty_tables(spark):
    none = cases.empty(spark)
    assert token_counts.count_tokens(none, BYTE).count() == 0
    assert bpe.encode_decode(none, WORD).count() == 0
    assert licenses.summarise(licenses.scan_licenses(none)).count() == 0
