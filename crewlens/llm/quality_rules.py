"""Quality rules: base counts of words, symbols and repeats, and divergence from a language.

A document's histograms of character classes and of its language's common words are compared with
the language's references by Jensen-Shannon distance. The references are the mean histograms of all
documents of the language that are long enough; shorter documents are not judged by divergence.

Defined cases: a null text has no words (and fails the base rule); a language that is null or has
no word list is judged by its character classes alone; repeated rows are judged alike; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crewlens.llm.shared import SPACE, let, stored, whole

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
#: Fewest words for which a divergence is judged.
GUARD_WORDS = 50
MAX_CLASS_DISTANCE = 0.30
MAX_WORD_DISTANCE = 0.285

# Common words of each language.
COMMON_WORDS = {
    "de": ["der", "die", "und", "das", "den", "ist", "zu", "ein", "nicht", "für"],
    "en": ["the", "of", "and", "to", "a", "in", "is", "that", "for", "it"],
    "es": ["de", "la", "que", "el", "en", "y", "los", "se", "del", "un"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "que"],
}
N_COMMON = 10
CLASSES = ["lower", "upper", "digit", "space", "symbol", "punctuation", "beyond_ascii"]
SYMBOLS = "[#*$%&|<>]"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(whole(text), f"[{SPACE}]+"), "")


def _window_hashes(words: Column) -> Column:
    n = F.size(words)
    hashes = F.transform(
        F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(words, i, WINDOW))
    )
    return F.when(n >= WINDOW, hashes).otherwise(F.array().cast("array<bigint>"))


def _covered_words(hashes: Column) -> Column:
    """Words inside windows whose hash occurs twice or more."""
    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def starts(s: Column) -> Column:
        def start(x: Column, j: Column) -> Column:
            twin = (F.get(s, j - 1)["h"] == x["h"]) | (F.get(s, j + 1)["h"] == x["h"])
            return F.when(F.coalesce(twin, F.lit(False)), x["i"])

        return F.sort_array(F.filter(F.transform(s, start), lambda x: x.isNotNull()))

    def add(acc: Column, i: Column) -> Column:
        end = i + WINDOW
        new = F.least(F.lit(WINDOW), end - acc["end"])
        return F.struct(end.alias("end"), (acc["total"] + new).alias("total"))

    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("total"))
    return F.aggregate(let(pairs, starts), zero, add, lambda acc: acc["total"])


def _repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(whole(text), "\n", -1), lambda x: F.btrim(x, F.lit(" \t\x0b\x0c\r")) != "")
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def _common_words(lang: Column) -> Column:
    listed = F.lit(None).cast("array<string>")
    for code, words in COMMON_WORDS.items():
        listed = F.when(lang == code, F.array(*map(F.lit, words))).otherwise(listed)
    return listed


def _occurrences(padded: Column, word: Column) -> Column:
    """How often `word` stands in a text that has two spaces around every word."""
    gone = F.octet_length(padded) - F.octet_length(F.replace(padded, F.concat(F.lit(" "), word, F.lit(" ")), F.lit("")))
    return (gone / (F.octet_length(word) + 2)).cast("long")


def _beyond_ascii(text: Column) -> Column:
    """Characters (not bytes) beyond ASCII."""
    pure = F.octet_length(text) == F.char_length(text)
    return F.when(pure, F.lit(0)).otherwise(F.regexp_count(text, F.lit("[^\\x00-\\x7F]")))


def features(docs: DataFrame) -> DataFrame:
    """Counts of each row: the base ones, the character classes and the common words."""
    text = F.col("text")
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    split = docs.select("doc_id", lang.alias("lang"), whole(text).alias("text")).withColumn("words", words_of(text))
    hashed = split.select(
        "*",
        F.size("words").cast("long").alias("n_words"),
        _window_hashes(F.col("words")).alias("windows"),
        F.lower(F.concat(F.lit("  "), F.array_join("words", "  "), F.lit("  "))).alias("padded"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
    ).drop("words")
    all_distinct = F.size(F.array_distinct("windows")) == F.size("windows")
    counted = hashed.select(
        "doc_id", "lang", "n_words", "word_chars",
        F.char_length("text").cast("long").alias("chars"),
        _beyond_ascii(F.col("text")).cast("long").alias("beyond_ascii"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.regexp_count("text", F.lit("[0-9]")).cast("long").alias("digit"),
        F.regexp_count("text", F.lit("[A-Z]")).cast("long").alias("upper"),
        F.regexp_count("text", F.lit("[!-/:-@\\[-`{-~]")).cast("long").alias("marks"),
        _repeated_lines(text).cast("long").alias("n_dup_lines"),
        F.when(all_distinct, F.lit(0)).otherwise(_covered_words(F.col("windows"))).cast("long").alias("n_repeat_words"),
        F.transform(_common_words(F.col("lang")), lambda w: _occurrences(F.col("padded"), w)).alias("common"),
    )
    space = F.col("chars") - F.col("word_chars")
    punctuation = F.col("marks") - F.col("n_symbols")
    rest = F.col("word_chars") - F.col("upper") - F.col("digit") - F.col("marks") - F.col("beyond_ascii")
    classes = F.array(
        rest, F.col("upper"), F.col("digit"), space, F.col("n_symbols"), punctuation, F.col("beyond_ascii"),
    )
    uncommon = F.col("n_words") - F.aggregate("common", F.lit(0).cast("long"), lambda a, x: a + x)
    return counted.select(
        "doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        classes.alias("classes"), F.concat("common", F.array(uncommon)).alias("common"),
    )


def _shares(counts: Column) -> Column:
    return let(
        F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x),
        lambda total: F.transform(counts, lambda x: F.when(total > 0, x / total).otherwise(F.lit(0.0))),
    )


def references(rows: DataFrame) -> DataFrame:
    """Mean shares for each language: of the classes, and of the common words where it has a list."""
    def mean(name: str, n: int) -> Column:
        return F.array(*(F.avg(F.get(name, F.lit(i))) for i in range(n)))

    return (
        rows.filter(F.col("n_words") >= GUARD_WORDS)
        .select("lang", _shares(F.col("classes")).alias("c"), _shares(F.col("common")).alias("w"))
        .groupBy("lang")
        .agg(mean("c", len(CLASSES)).alias("class_reference"), mean("w", N_COMMON + 1).alias("word_reference"))
    )


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (square root of the divergence to base 2) of two share arrays."""
    def part(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(F.lit(0.0))

    terms = F.zip_with(p, q, lambda a, b: part(a, b) + part(b, a))
    total = F.aggregate(terms, F.lit(0.0), lambda x, t: x + t)
    return F.sqrt(F.greatest(total / 2, F.lit(0.0)))


def judge(docs: DataFrame) -> DataFrame:
    """The counts of each row with base_failed, class_distance, word_distance and kept."""
    rows = stored(features(docs), "quality_features")
    known = references(rows)
    both = rows.withColumnRenamed("lang", "_lang").join(known, F.col("_lang").eqNullSafe(F.col("lang")), "left")
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    judged = F.col("n_words") >= GUARD_WORDS
    apart = judged & (
        (F.coalesce("class_distance", F.lit(0.0)) > MAX_CLASS_DISTANCE)
        | (F.coalesce("word_distance", F.lit(0.0)) > MAX_WORD_DISTANCE)
    )
    return (
        both.withColumn("class_distance", js_distance(_shares(F.col("classes")), F.col("class_reference")))
        .withColumn("word_distance", js_distance(_shares(F.col("common")), F.col("word_reference")))
        .withColumn("base_failed", base_failed)
        .withColumn("kept", ~base_failed & ~apart)
        .select(
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "base_failed", "class_distance", "word_distance", "kept",
        )
    )
