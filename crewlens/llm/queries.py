"""One registered query for each corpus operator, and SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crewlens.llm import (
    bpe,
    exact_dedup,
    licenses,
    line_dedup,
    mixing,
    ngram_join,
    ngram_lm,
    periodic_runs,
    quality_classifier,
    quality_rules,
    substring_dedup,
    token_counts,
    twins,
    vector_codes,
)
from crewlens.llm.shared import SPACE, let, stored, whole, with_groups


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_join(documents(spark, sf_dir))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.summarise(licenses.scan_licenses(documents(spark, sf_dir)))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Begins with an empty cache, so that a rerun does the same work."""
    return token_counts.count_tokens(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.score_documents(documents(spark, sf_dir))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    kept = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_classifier.classify(documents(spark, sf_dir), labels)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = F.sha2(exact_dedup.normalised(F.col("text")), 256).alias("text_sha256")
    groups = exact_dedup.exact_groups(documents(spark, sf_dir), [digest])
    return groups.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(documents(spark, sf_dir)).drop("class_distance", "word_distance")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    codes = vector_codes.encode(vectors, carry=["vec_id", "label"])
    digits = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    rows = stored(codes.rows.select("vec_id", "label", digits.alias("code"), "error"), "codes")
    errors = stored(rows.groupBy("label").agg(F.try_sum("error").alias("label_error"), F.count(F.lit(1)).alias("n")), "errors")
    return with_groups(rows, errors, ["label"], "n", F.xxhash64("vec_id")).select(
        "vec_id", "code", "error", "label_error", F.sha2(F.lit(codes.codebook_text()), 256).alias("codebooks_sha256")
    )


def planted(text: Column, doc_id: Column) -> Column:
    """The text; in one document of ten, by its id's checksum, all words from a drawn one on are
    replaced by a repetition of the first few of them."""
    checksum = F.crc32(doc_id.cast("string"))
    drawn = ((checksum - checksum % 10) / 10).cast("long")

    def repeated(words: Column, first: Column, period: Column) -> Column:
        def word(i: Column) -> Column:
            return words[F.when(i < first, i).otherwise(first + (i - first) % period).cast("int")]

        return F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), F.size(words) - F.lit(1).cast("long")), word), " ")

    def rewritten(words: Column) -> Column:
        n = F.size(words).cast("long")
        return let(drawn % n, lambda first: let(
            F.floor((n - first) / (3 + drawn % 8)) + 1, lambda period: repeated(words, first, period)
        ))

    chosen = (checksum % 10 == 0) & text.rlike(f"[^{SPACE}]")
    words = F.regexp_extract_all(text, F.lit(f"[^{SPACE}]+"), 0)
    return F.when(chosen, let(words, rewritten)).otherwise(text)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", planted(F.col("text"), F.col("doc_id")).alias("text"))
    found = periodic_runs.periodic_runs(docs)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("shorter"))))
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return found.withColumn("longest", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("longest")["back"]).alias("start"),
        F.col("longest")["length"].alias("length"), (-F.col("longest")["shorter"]).alias("period"),
        F.expr("1000 * longest.length DIV -longest.shorter").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = substring_dedup.without_repeats(documents(spark, sf_dir))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


QUERIES = {
    "op1_ngram_join": op1_ngram_join,
    "op2_license_scan": op2_license_scan,
    "op3_token_counts": op3_token_counts,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_line_dedup": op5_line_dedup,
    "op6_bpe": op6_bpe,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_mixing": op8_mixing,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_quality_rules": op10_quality_rules,
    "op11_vector_codes": op11_vector_codes,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_substring_dedup": op13_substring_dedup,
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TRIM = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

_WORD = r"[^\x20\x09-\x0D]"
_LISTS = " ".join(
    f"WHEN '{lang}' THEN [{', '.join(repr(w) for w in words)}]" for lang, words in quality_rules.COMMON_WORDS.items()
)


def _sum_of(item: str, n: int) -> str:
    return f"list_sum([{item} FOR i IN range(1, {n + 1})])"


def _distance(p: str, q: str, n: int) -> str:
    """Jensen-Shannon distance of two share lists of n items."""
    def part(a: str, b: str) -> str:
        return f"(CASE WHEN {a}[i] > 0 THEN {a}[i] * log2(2 * {a}[i] / ({a}[i] + {b}[i])) ELSE 0.0 END)"

    return f"sqrt(greatest({_sum_of(f'{part(p, q)} + {part(q, p)}', n)} / 2, 0.0))"


def _means(shares: str, n: int) -> str:
    return "[" + ", ".join(f"avg({shares}[{i}])" for i in range(1, n + 1)) + "]"


_N_CLASSES, _N_WORDS = len(quality_rules.CLASSES), quality_rules.N_COMMON + 1
_QUALITY = f"""
    WITH split AS (
        SELECT doc_id, lang, coalesce(text, '') AS text,
               regexp_extract_all(coalesce(text, ''), '{_WORD}+') AS words,
               [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '{_WORD}')] AS lines
        FROM documents
    ), windows AS (
        SELECT doc_id, i, array_to_string(words[i : i + 7], ' ') AS w
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM split)
    ), repeated AS (
        SELECT doc_id, count(DISTINCT place) AS n_repeat_words
        FROM (SELECT doc_id, unnest(range(i, i + 8)) AS place
              FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, w) AS times FROM windows) WHERE times > 1)
        GROUP BY doc_id
    ), counted AS (
        SELECT doc_id, lang, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
               length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
               len(lines) - len(list_distinct(lines)) AS n_dup_lines,
               coalesce(n_repeat_words, 0) AS n_repeat_words, length(text) AS chars,
               length(regexp_replace(text, '[^0-9]', '', 'g')) AS digit,
               length(regexp_replace(text, '[^A-Z]', '', 'g')) AS upper_,
               length(regexp_replace(text, '[^!-/:-@\\[-`{{-~]', '', 'g')) AS marks,
               length(regexp_replace(text, '[\\x00-\\x7F]', '', 'g')) AS beyond,
               CASE lang {_LISTS} END AS listed, [lower(x) FOR x IN words] AS low
        FROM split LEFT JOIN repeated USING (doc_id)
    ), listed AS (
        SELECT *, [word_chars - upper_ - digit - marks - beyond, upper_, digit,
                   chars - word_chars, n_symbols, marks - n_symbols, beyond] AS classes,
               CASE WHEN listed IS NOT NULL THEN
                   [len(list_filter(low, lambda x: x = listed[i])) FOR i IN range(1, {_N_WORDS})] END AS common
        FROM counted
    ), shares AS (
        SELECT *, [CASE WHEN list_sum(classes) > 0 THEN x / list_sum(classes) ELSE 0.0 END FOR x IN classes] AS c,
               CASE WHEN common IS NOT NULL THEN [CASE WHEN n_words > 0 THEN x / n_words ELSE 0.0 END
                   FOR x IN list_append(common, n_words - list_sum(common))] END AS w
        FROM listed
    ), known AS (
        SELECT lang, {_means('c', _N_CLASSES)} AS cr, {_means('w', _N_WORDS)} AS wr
        FROM shares WHERE n_words >= {quality_rules.GUARD_WORDS} GROUP BY lang
    ), judged AS (
        SELECT s.*, n_words < {quality_rules.MIN_WORDS}
                   OR 100 * n_repeat_words > {quality_rules.MAX_REPEAT_PERCENT} * n_words AS base_failed,
               CASE WHEN cr IS NOT NULL THEN {_distance('c', 'cr', _N_CLASSES)} END AS far_c,
               CASE WHEN w IS NOT NULL AND cr IS NOT NULL THEN {_distance('w', 'wr', _N_WORDS)} END AS far_w
        FROM shares s LEFT JOIN known k ON s.lang IS NOT DISTINCT FROM k.lang
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND NOT (n_words >= {quality_rules.GUARD_WORDS} AND (
               coalesce(far_c, 0) > {quality_rules.MAX_CLASS_DISTANCE}
               OR coalesce(far_w, 0) > {quality_rules.MAX_WORD_DISTANCE})) AS kept
    FROM judged
"""

_JACCARD = f"""
    WITH RECURSIVE split AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                   '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
        FROM documents
    ), grams AS (
        SELECT DISTINCT doc_id, array_to_string(words[i : i + {ngram_join.N - 1}], ' ') AS gram
        FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - {ngram_join.N - 2}, 2))) AS i
              FROM split WHERE len(words) > 0)
    ), sizes AS (
        SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id
    ), pairs AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
        FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL
    ), links AS (
        SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
        WHERE c / (x.n + y.n - c) >= {ngram_join.THRESHOLD}
    ), reached(doc_id, other) AS (
        SELECT doc_id, doc_id FROM documents
        UNION
        SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other
    )
    SELECT doc_id, min(other) AS class_id, coalesce(any_value(n_links), 0) AS n_links
    FROM reached LEFT JOIN (SELECT a, count(*) AS n_links FROM links GROUP BY a) ON a = doc_id
    GROUP BY doc_id
"""

ORACLE = {
    "op1_ngram_join": _JACCARD,
    "op5_line_dedup": f"""
        WITH lines AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
            FROM documents
        ), keyed AS (
            SELECT *, trim(translate(line, '{_UPPER}', '{_LOWER}'), {_TRIM}) AS key FROM lines
        ), repeated AS (
            SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
            GROUP BY key HAVING count(DISTINCT doc_id) >= 3
        ), marked AS (
            SELECT k.doc_id, k.pos, k.line, r.keeper IS NOT NULL AND r.keeper <> k.doc_id AS dropped
            FROM keyed k LEFT JOIN repeated r ON k.key = r.key
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
        FROM marked GROUP BY doc_id
    """,
    "op9_exact_dedup": f"""
        WITH t AS (
            SELECT doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS norm FROM documents
        )
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, sha256(norm) AS text_sha256
        FROM t WINDOW g AS (PARTITION BY norm)
    """,
    "op10_quality_rules": _QUALITY,
} | twins.ORACLE
