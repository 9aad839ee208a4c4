"""Token counts through a cache of content digests.

The cache is a table in a shared folder, partitioned by the digest of the tokenizer's file; a row
is a digest of a whole text with its number of tokens. Texts whose digest is not stored are encoded
once for each digest, whatever the number of copies, and the counts are appended.

A text is taken as it is (null as empty): the tokenizer's own normaliser belongs to its version.
Special strings inside a text count as the special token, as the tokenizers library does by default.

Defined cases: null and empty texts have no tokens; repeated rows each get the count; an empty
table gives an empty result and an empty cache; other columns are ignored. A digest that two runs
append at once is read as one. A text that the merge engine cannot split (about a million white-space
characters on end exhaust its backtracking) is counted by the tokenizers library.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crewlens.llm.shared import new_path, whole

OVER_LIMIT = 1024
CACHE_SCHEMA = "digest binary, n_tokens long, tokenizer string"


def tokenizer_version(path: str) -> str:
    """Digest of the tokenizer's file."""
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


def _byte_symbols() -> dict[str, int]:
    """The printable stand-ins by which byte-level vocabularies spell the 256 bytes."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _ranked_encoder(path: str) -> Callable[[list[str]], list[int]] | None:
    """A merge engine over the file's own vocabulary; None if its merges are not in order of id or
    the file asks for steps the engine lacks."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    byte_level = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
    if model.get("type") != "BPE" or not byte_level or spec.get("normalizer") or model.get("end_of_word_suffix"):
        return None
    if model.get("ignore_merges") or model.get("dropout") or model.get("continuing_subword_prefix"):
        return None
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", []) if t.get("special")}
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] or not t.get("special") for t in spec.get("added_tokens", [])):
        return None
    vocabulary = {token: i for token, i in model["vocab"].items() if token not in special}
    merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    first = 256
    if any(vocabulary.get(token) != first + i for i, token in enumerate(merged)):
        return None
    symbols = _byte_symbols()
    ranks = {bytes(symbols[c] for c in token): i for token, i in vocabulary.items()}
    import public_tokenizers
    import tiktoken

    encoding = tiktoken.Encoding(
        os.path.basename(path), pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special
    )

    def count(text: str) -> int:
        try:
            return len(encoding.encode(text, allowed_special="all"))
        except ValueError:  # the pattern's backtracking ran out of stack
            return _library_counter(path)([text])[0]

    return lambda texts: [count(t) for t in texts]


@lru_cache(maxsize=4)
def _library_counter(path: str) -> Callable[[list[str]], list[int]]:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return lambda texts: [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


@lru_cache(maxsize=4)
def counter(path: str) -> Callable[[list[str]], list[int]]:
    """Counts the tokens of texts with the tokenizer in `path` (.json or .model)."""
    if path.endswith(".model"):
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(ids) for ids in pieces.encode(texts, num_threads=1)]
    return _ranked_encoder(path) or _library_counter(path)


def _read_cache(spark: SparkSession, cache: str, version: str) -> DataFrame | None:
    try:
        stored = spark.read.schema(CACHE_SCHEMA).parquet(cache)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None  # nothing was stored yet
    return stored.filter(F.col("tokenizer") == version)


def store_missing(texts: DataFrame, cache: str, tokenizer: str) -> None:
    """Append counts for the digests of `texts` (digest, text) that the cache lacks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = counter(tokenizer)(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), pa.array(counts, pa.int64())], ["digest", "n_tokens"]
            )

    version = tokenizer_version(tokenizer)
    known = _read_cache(texts.sparkSession, cache, version)
    missing = texts.groupBy("digest").agg(F.first("text").alias("text"))
    if known is not None:
        missing = missing.join(known, "digest", "left_anti")
    counted = missing.select("digest", "text").mapInArrow(run, "digest binary, n_tokens long")
    counted.withColumn("tokenizer", F.lit(version)).write.mode("append").partitionBy("tokenizer").parquet(cache)


def count_tokens(docs: DataFrame, tokenizer: str, cache: str | None = None, over: int = OVER_LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit. Without `cache` a new one is begun in the shared folder."""
    spark = docs.sparkSession
    cache = cache or new_path(spark, "token_cache")
    text = whole(F.col("text"))
    digest = F.unhex(F.sha2(text, 256)).alias("digest")
    store_missing(docs.select(digest, text.alias("text")), cache, tokenizer)
    counts = (
        _read_cache(spark, cache, tokenizer_version(tokenizer))
        .groupBy("digest")
        .agg(F.max("n_tokens").alias("n_tokens"))
    )
    rows = docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), digest)
    return rows.join(counts, "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > over).alias("over_limit")
    )
