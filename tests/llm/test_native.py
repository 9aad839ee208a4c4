"""Exact dedup, line dedup and quality rules against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from crewlens.llm import exact_dedup, line_dedup, quality_rules
from tests.llm import cases
from tests.support import duck_table, spark_table

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACE = " \t\n\x0b\x0c\r"


def test_exact_groups(spark):
    df = cases.frame(spark)
    got = exact_dedup.exact_groups(df, [F.sha2(exact_dedup.normalised(F.col("text")), 256).alias("digest")]).collect()
    by_text = defaultdict(list)
    data = [(r.doc_id, (r.text or "").translate(LOW)) for r in df.select("doc_id", "text").collect()]
    for doc_id, text in data:
        by_text[text].append(doc_id)
    expected = Counter()
    for doc_id, text in data:
        ids = [i for i in by_text[text] if i is not None]
        keep = max(ids) if ids else None
        expected[(doc_id, keep, len(by_text[text]), doc_id == keep, hashlib.sha256(text.encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.digest) for r in got) == expected


def expected_lines(data, min_chars=20, min_docs=3):
    keys = defaultdict(set)
    for doc_id, text in data:
        for line in (text or "").split("\n"):
            key = line.strip(SPACE).translate(LOW)
            if doc_id is not None and len(key) >= min_chars:
                keys[key].add(doc_id)
    out = []
    for doc_id, text in data:
        lines, kept = (text or "").split("\n"), []
        for line in lines:
            docs = keys.get(line.strip(SPACE).translate(LOW), set())
            if doc_id is None or len(docs) < min_docs or doc_id == max(docs):
                kept.append(line)
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return Counter(out)


@pytest.mark.parametrize("partitions", ["2", "9"])
def test_line_bitmaps(spark, partitions):
    """With nine partitions the common lines count as hot and are dealt to parts."""
    df = cases.frame(spark)
    data = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        bitmaps = line_dedup.keep_bitmaps(df)
        got = line_dedup.apply_bitmaps(df, bitmaps).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in got) == expected_lines(data)
    assert sum(r.n_dropped for r in got) > 0


def expected_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 8)}
    seen, repeated = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), symbols, repeated, len(covered), failed


def test_quality_counts(spark):
    df = cases.frame(spark)
    extra = spark.createDataFrame([(9001, "x y\n" * 3 + "## | a b c d e f g h i " * 2 + "\nx y", "en", "s", 0)], cases.SCHEMA)
    df = df.select(*[c.split()[0] for c in cases.SCHEMA.split(", ")]).unionByName(extra)
    got = quality_rules.judge(df).collect()
    assert len(got) == df.count()
    expected = Counter((r.doc_id, *expected_counts(r.text)) for r in df.collect())
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert Counter((r.doc_id, *(r[n] for n in names)) for r in got) == expected
    assert all(not (r.kept and r.base_failed) for r in got)


def test_divergence_tells_junk_from_prose(spark, sf_dir):
    """Labelled documents of quality 1 stay unless a base rule fails; most of quality 0 go."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_rules.judge(docs).join(labels, "doc_id").collect()
    assert all(r.kept or r.base_failed for r in rows if r.quality == 1)
    bad = [r for r in rows if r.quality == 0]
    assert sum(not r.kept for r in bad) > 0.6 * len(bad)


def test_classes_count_characters(spark):
    """Not bytes: a character beyond ASCII counts once, whatever its length, and takes no letter away."""
    texts = ["a" * 900 + "\u4e2d" * 100, "ab \U0001F600" * 50, "\u00fcber Zwei 12!#\n", "x" * 50 + "\u4e2d" * 50, "plain", ""]
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    got = {r.doc_id: r.classes for r in quality_rules.features(df).collect()}
    patterns = ["[a-z]", "[A-Z]", "[0-9]", "[ \t-\r]", "[#*$%&|<>]", "[!\"'()+,./:;=?@\\[\\\\\\]^_`{}~-]", "[^\x00-\x7f]"]
    assert got == {i: [len(re.findall(p, t)) for p in patterns] for i, t in enumerate(texts)}


def test_mixed_scripts_are_kept(spark):
    """English with a tenth of its characters in another script stands within the limit of plain English."""
    words = "Winter rivers of the north carry stone and sand to wide plains, and in 1890 a town that is old rose there.".split()
    plain = [" ".join(words[(i + 3 * k) % len(words)] for i in range(120)) for k in range(40)]
    mixed = [t + "\u4e2d" * (len(t) // 9) for t in plain[:1]]
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(plain + mixed)], "doc_id long, text string, lang string")
    last = {r.doc_id: r.class_distance for r in quality_rules.judge(df).collect()}[len(plain)]
    assert last < quality_rules.MAX_CLASS_DISTANCE


def test_sql_counts_characters(spark, tmp_path):
    """Query, SQL and plain Python agree in `kept` on texts of mixed scripts, near the limits as well."""
    import duckdb

    from crewlens.llm.queries import ORACLE, op10_quality_rules

    rng = random.Random(2)
    words = "winter rivers of the north carry stone and sand to wide plains where a town that is old rose there".split()
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(60, 160))), "en") for i in range(300)]
    for i in range(60):
        text = rows[rng.randrange(300)][1]
        mark = rng.choice(["\u4e2d", "\U0001F600", "\u00e9"])
        rows.append((300 + i, text + " " + mark * int(len(text) * rng.uniform(0.02, 0.6)), "en"))
    path = f"{tmp_path}/documents.parquet"
    spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1).write.parquet(path)
    got = {r.doc_id: r.kept for r in op10_quality_rules(spark, str(tmp_path)).collect()}
    base = duckdb.connect()
    base.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    told = base.sql(ORACLE["op10_quality_rules"])
    at = {c: i for i, c in enumerate(told.columns)}
    assert {r[at["doc_id"]]: r[at["kept"]] for r in told.fetchall()} == got
    assert got == plain_verdicts(rows) and 0 < sum(not k for k in got.values()) < 60


def plain_verdicts(rows):
    """kept of texts of one language without base failures, by definition."""
    def shares(counts):
        return [c / sum(counts) if sum(counts) else 0.0 for c in counts]

    def distance(p, q):
        return math.sqrt(sum(a * math.log2(2 * a / (a + b)) for x, y in ((p, q), (q, p)) for a, b in zip(x, y) if a > 0) / 2)

    listed, found = quality_rules.COMMON_WORDS["en"], {}
    patterns = ["[a-z]", "[A-Z]", "[0-9]", "[ \t-\r]", "[#*$%&|<>]", "[!\"'()+,./:;=?@\\[\\\\\\]^_`{}~-]", "[^\x00-\x7f]"]
    for i, text, _ in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        common = [sum(w.lower() == c for w in words) for c in listed]
        repeated = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
        covered = {j for k in range(len(words) - 7) if repeated[tuple(words[k : k + 8])] > 1 for j in range(k, k + 8)}
        base = len(words) < 20 or 100 * len(covered) > 30 * len(words)
        found[i] = (base, shares([len(re.findall(p, text)) for p in patterns]), shares([*common, len(words) - sum(common)]))
    means = [[sum(f[k][j] for f in found.values()) / len(found) for j in range(len(next(iter(found.values()))[k]))] for k in (1, 2)]
    limits = (quality_rules.MAX_CLASS_DISTANCE, quality_rules.MAX_WORD_DISTANCE)
    return {i: not f[0] and all(distance(f[k + 1], means[k]) <= limits[k] for k in (0, 1)) for i, f in found.items()}


def test_js_distance(spark):
    row = spark.sql("SELECT array(1.0D, 0.0D) p, array(0.0D, 1.0D) q, array(0.5D, 0.5D) r")
    d = quality_rules.js_distance
    got = row.select(d(F.col("p"), F.col("q")), d(F.col("r"), F.col("r")), d(F.col("p"), F.col("r"))).first()
    assert got[0] == pytest.approx(1) and got[1] == pytest.approx(0) and got[2] == pytest.approx(0.5579, abs=1e-4)


def test_empty_tables(spark):
    none = cases.empty(spark)
    assert exact_dedup.exact_groups(none).count() == 0
    assert line_dedup.apply_bitmaps(none, line_dedup.keep_bitmaps(none)).count() == 0
    assert quality_rules.judge(none).count() == 0


@pytest.mark.parametrize("name", [
    "op1_ngram_join", "op5_line_dedup", "op9_exact_dedup", "op10_quality_rules", "op11_vector_codes", "op12_periodic_runs",
    "op13_substring_dedup",
])
def test_query_matches_sql(spark, duck, sf_dir, name):
    from crewlens.llm.queries import ORACLE, QUERIES

    df = QUERIES[name](spark, sf_dir)
    columns, expected = duck_table(duck, ORACLE[name])
    assert sorted(df.columns) == columns and spark_table(df) == expected
