"""Tables that every operator must take: odd rows, an empty table, columns with clashing names."""

from __future__ import annotations

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = ["the", "of", "and", "Zebra", "naïve", "über", "x1", "to", "a", "river", "stone,", "Blue.", "GNU", "is"]


def passage(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", str(rng.randint(0, 99))]) for _ in range(n))


def rows(seed: int = 1, n: int = 60) -> list[tuple]:
    """Documents with copies, near copies, shared lines, null and empty texts, ties and odd characters."""
    rng = random.Random(seed)
    shared = [passage(rng, 12) for _ in range(4)]
    texts = [
        None, "", " ", "\n\n", "one", "\t tab\x0b\x0c\r\n", "\x1c\x1f a\x85b\xa0c", "İstanbul ΑΣ ﬁ ² é ‍",
        "<|endoftext|>x<|startoftext|> <|endoftext|>", "Licensed under CC BY-NC 4.0.", "gnu GENERAL public-license gnu general public license",
        "word " * 400, passage(rng, 3000), "\U0001F600 " * 30, "no" * 5000,
    ]
    base = passage(rng, 120)
    texts += [base, base.upper(), base.lower(), base.replace("river", "lake", 1), base + " end", base]
    for _ in range(n):
        lines = [passage(rng, rng.randint(1, 25)) for _ in range(rng.randint(1, 5))]
        lines.insert(rng.randint(0, len(lines)), rng.choice(shared) if rng.random() < 0.6 else " " + shared[0].upper() + "\t")
        texts.append("\n".join(lines))
    found = [(i * 3, t, rng.choice(["en", "de", None, "xx"]), rng.choice(["s1", "s2", "s3", "S", None]), None) for i, t in enumerate(texts)]
    return found


def frame(spark, extra: bool = True, seed: int = 1):
    """The rows, with a repeated row, null ids and columns whose names an operator might use itself."""
    data = rows(seed)
    data += [data[20], (None, "a null id", "en", "s1", None), (None, None, None, None, None)]
    df = spark.createDataFrame(data, SCHEMA)
    if not extra:
        return df
    clash = ["n", "head", "full", "kept", "row", "score", "size", "target", "rep", "label", "words", "version", "h1", "batch"]
    return df.selectExpr("*", *[f"'odd' AS `{c}`" for c in clash], "1 AS `text `", "2 AS `a.b`")


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
