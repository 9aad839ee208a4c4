"""The pipeline's stages against what their operators decide, and the registered queries."""

from __future__ import annotations

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from crewlens.llm import exact_dedup, mixing, ngram_join, quality_classifier, stages
from crewlens.llm.queries import ORACLE, QUERIES
from tests.llm import cases


def test_one_query_for_each_operator():
    numbers = [int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES]
    assert numbers == list(range(1, 14)) and set(ORACLE) <= set(QUERIES)
    import __spark_entry__ as entry

    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.fixture(scope="module")
def steps(spark, sf_dir):
    docs, found = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.stored(stage(spark, docs, sf_dir), "step")
        found.append((docs, out))
        docs = out
    return found


def pairs(df):
    return Counter((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())


def test_stages_keep_the_columns(steps):
    assert all(before.columns == after.columns for before, after in steps[:-1])


def test_filtering_stages(spark, sf_dir, steps):
    (docs, good), (_, single), (_, apart), *_ = steps
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    wanted = {r.doc_id for r in quality_classifier.classify(docs, labels).collect() if r.predicted}
    assert set(pairs(good)) == {p for p in pairs(docs) if p[0] in wanted} and len(wanted) < docs.count()
    largest = {}
    for doc_id, text in pairs(good):
        key = text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        largest[key] = max(doc_id, largest.get(key, doc_id))
    assert {d for d, _ in pairs(single)} == set(largest.values())
    first = {r.class_id for r in ngram_join.jaccard_join(single).collect()}
    assert {d for d, _ in pairs(apart)} == first
    assert exact_dedup.exact_groups(apart).filter("NOT kept").count() == 0


def test_mix_follows_the_targets(steps):
    docs, mixed = steps[3]
    times, source = pairs(mixed), {r.doc_id: r.source for r in docs.collect()}
    words, target = Counter(), Counter()
    for r in mixing.mix(docs).collect():
        target[source[r.doc_id]] += r.taken
    for (doc_id, text), n in times.items():
        assert n <= 2
        words[source[doc_id]] += n * len(re.findall(r"[^\x20\x09-\x0D]+", text))
    assert sum(words.values()) == pytest.approx(sum(target.values()), rel=0.1)


def test_last_stage_encodes_every_row(steps):
    mixed, encoded = steps[4]
    assert Counter(r.doc_id for r in encoded.collect()) == Counter(r.doc_id for r in mixed.collect())


def odd_frame(spark):
    """Odd rows, with columns whose names the stages might use themselves."""
    names = ["_turn", "_row", "_row1", "_kept", "_id", "_size", "row", "row1", "row2", "kept", "times", "turn", "possible", "source_no", "copies"]
    df = cases.frame(spark)
    return df.withColumns({c: F.concat(F.lit(f"{c} "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))) for c in names})


def test_stages_on_odd_rows(spark, sf_dir):
    """Repeated rows end as one, other rows keep every column's value, an empty table stays empty."""
    df = odd_frame(spark)
    given = {(r.doc_id, r.text): tuple(r) for r in df.collect()}
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, df, sf_dir)
        assert out.columns == df.columns, name
        rows = out.collect()
        assert rows and all(given[(r.doc_id, r.text)] == tuple(r) for r in rows), name
    once = stages.drop_exact_copies(spark, df, sf_dir)
    assert max(pairs(once).values()) == 1 and (None, "a null id") in pairs(once)
    texts = Counter((t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for _, t in pairs(once))
    assert max(texts.values()) == 1 and len(texts) == len(pairs(once))
    assert stages.encode(spark, df, sf_dir).count() == df.count()
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, cases.empty(spark), sf_dir).count() == 0, name


def test_rows_of_null_ids_are_judged_by_their_own_text(spark, sf_dir):
    """Rejected texts under a null id go, accepted ones stay, alone and together."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    scored = quality_classifier.classify(docs, labels).select("doc_id", "predicted")
    known = docs.join(scored, "doc_id").select("predicted", "text").distinct().collect()
    bad = [r.text for r in known if not r.predicted][:3]
    good = [r.text for r in known if r.predicted][:3]
    extra = spark.createDataFrame([(None, t, "en", "s", 0) for t in bad + good], cases.SCHEMA)
    left = stages.reject_low_quality(spark, docs.unionByName(extra), sf_dir).filter("doc_id IS NULL").collect()
    assert Counter(r.text for r in left) == Counter(good)


def test_mix_tells_rows_of_one_id_apart(spark, sf_dir):
    """Two texts of one id and size in different sources: each comes as often as its own draw says."""
    texts = [" ".join(f"{k}{i}" for i in range(160)) for k in "ab"]
    df = spark.createDataFrame([(1, texts[0], "en", "A", 0), (1, texts[1], "en", "B", 0)], cases.SCHEMA)
    times = pairs(stages.mix_sources(spark, df, sf_dir))
    assert times == Counter({(1, texts[0]): 2, (1, texts[1]): 1})
