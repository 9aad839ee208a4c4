"""SQL statements for the vector codes, the periodic runs and the substring dedup, written without their methods."""

from __future__ import annotations

from crewlens.llm import periodic_runs, substring_dedup, vector_codes

_WORD = r"[^\x20\x09-\x0D]+"

# crc32 of the id's decimal digits, bit by bit
_BIT = "CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END"
_CHECKSUM = f"""xor(list_reduce(
    list_prepend(4294967295::BIGINT, [ascii(c)::BIGINT FOR c IN string_split(doc_id::VARCHAR, '')]),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: {_BIT})
), 4294967295::BIGINT)"""

_LEAST = f"greatest({periodic_runs.SHORTEST}, {periodic_runs.EXPONENT} * q)"

PERIODIC_RUNS = f"""
    WITH split AS (
        SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS words, {_CHECKSUM} AS h FROM documents
    ), drawn AS (
        SELECT *, len(words) AS n, h // 10 AS g FROM split
    ), bent AS (
        SELECT *, g % n AS a, 1 + (n - g % n) // (3 + g % 8) AS p FROM drawn WHERE h % 10 = 0 AND n > 0
    ), texts AS (
        SELECT doc_id, n, [words[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1] FOR i IN range(0, n)] AS words FROM bent
        UNION ALL
        SELECT doc_id, n, words FROM drawn WHERE h % 10 <> 0 OR n = 0
    ), tokens AS (
        SELECT doc_id, unnest(words) AS word, unnest(range(0, n)) AS i FROM texts
    ), lags AS (
        SELECT doc_id, n, unnest(range(1, n // {periodic_runs.EXPONENT} + 1)) AS q FROM texts
    ), blocks AS (
        SELECT doc_id, q, size, unnest(range(0, n - q - size + 1, size)) AS i
        FROM (SELECT *, ({_LEAST} - q + 1) // 2 AS size FROM lags)
    ), likely AS (
        SELECT DISTINCT b.doc_id, b.q
        FROM blocks b
        JOIN tokens x ON x.doc_id = b.doc_id AND x.i = b.i
        JOIN tokens y ON y.doc_id = b.doc_id AND y.i = b.i + b.q AND y.word = x.word
        JOIN tokens u ON u.doc_id = b.doc_id AND u.i = b.i + b.size - 1
        JOIN tokens v ON v.doc_id = b.doc_id AND v.i = b.i + b.size - 1 + b.q AND v.word = u.word
    ), same AS (
        SELECT l.doc_id, l.q, x.i, x.i - row_number() OVER (PARTITION BY l.doc_id, l.q ORDER BY x.i) AS island
        FROM likely l
        JOIN tokens x ON x.doc_id = l.doc_id
        JOIN tokens y ON y.doc_id = l.doc_id AND y.i = x.i + l.q AND y.word = x.word
    ), stretches AS (
        SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM same GROUP BY doc_id, q, island
    ), runs AS (
        SELECT doc_id, start, length, min(q) AS period FROM stretches WHERE length >= {_LEAST} GROUP BY doc_id, start, length
    ), listed AS (
        SELECT doc_id, count(*) AS n_runs, max((length, -start, -period)) AS longest,
               string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listing
        FROM runs GROUP BY doc_id
    ), dropped AS (
        SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs
    ), kept AS (
        SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS collapsed FROM tokens ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id
    )
    SELECT doc_id, coalesce(n_runs, 0) AS n_runs, -longest[2] AS start, longest[1] AS length, -longest[3] AS period,
           1000 * longest[1] // -longest[3] AS exponent_milli, sha256(coalesce(listing, '')) AS runs_sha256,
           sha256(coalesce(collapsed, '')) AS collapsed_sha256
    FROM texts LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

SUBSTRING_DEDUP = f"""
    WITH split AS (
        SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS words FROM documents
    ), windows AS (
        SELECT doc_id, i, array_to_string(words[i : i + {substring_dedup.WINDOW - 1}], ' ') AS w
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - {substring_dedup.WINDOW - 2})) AS i FROM split)
    ), holders AS (
        SELECT w, min(doc_id) AS holder FROM windows GROUP BY w
    ), removed AS (
        SELECT DISTINCT doc_id, unnest(range(i, i + {substring_dedup.WINDOW})) AS i
        FROM windows JOIN holders USING (w) WHERE holder < doc_id
    ), kept AS (
        SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text
        FROM (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM split)
        ANTI JOIN removed USING (doc_id, i) GROUP BY doc_id
    )
    SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
    FROM split LEFT JOIN kept USING (doc_id)
"""


def _assigned(round_: int) -> str:
    """Each part with its nearest entry: the squared distance (exact in doubles below 2^53) and, on ties, the least index."""
    dot = "list_dot_product"
    gap = f"({dot}(x.part, x.part) - 2 * {dot}(x.part, b.part) + {dot}(b.part, b.part))::BIGINT"
    return f"""assigned{round_} AS MATERIALIZED (
        SELECT x.vec_id, x.label, x.p, x.part, min(({gap}, b.e)) AS found
        FROM parts x JOIN book{round_} b ON b.p = x.p GROUP BY ALL
    )"""


def _averaged(round_: int) -> str:
    return f"""sums{round_} AS (
        SELECT p, found[2] AS e, unnest(part) AS x, unnest(range(1, len(part) + 1)) AS i FROM assigned{round_ - 1}
    ), book{round_} AS MATERIALIZED (
        SELECT b.p, b.e, coalesce(m.part, b.part) AS part
        FROM book{round_ - 1} b LEFT JOIN (
            SELECT p, e, list(mean ORDER BY i) AS part
            FROM (SELECT p, e, i, floor(sum(x) / count(*)) AS mean FROM sums{round_} GROUP BY p, e, i) GROUP BY p, e
        ) m ON m.p = b.p AND m.e = b.e
    )"""


_ROUNDS = ",\n".join(f"{_averaged(r)}, {_assigned(r)}" for r in range(1, vector_codes.ROUNDS + 1))
_LAST = vector_codes.ROUNDS
VECTOR_CODES = f"""
    WITH kept AS (
        SELECT vec_id, label, [floor({vector_codes.SCALE} * x::DOUBLE) FOR x IN embedding] AS v
        FROM embeddings
        WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    ), parts AS MATERIALIZED (
        SELECT vec_id, label, p, v[p * len(v) // {vector_codes.PARTS} + 1 : (p + 1) * len(v) // {vector_codes.PARTS}] AS part
        FROM (SELECT *, unnest(range(0, {vector_codes.PARTS})) AS p FROM kept)
    ), book0 AS MATERIALIZED (
        SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, part
        FROM parts QUALIFY e < {vector_codes.ENTRIES}
    ), {_assigned(0)}, {_ROUNDS}, codes AS (
        SELECT vec_id, label, string_agg(printf('%02x', found[2]), '' ORDER BY p) AS code, sum(found[1])::BIGINT AS error
        FROM assigned{_LAST} GROUP BY vec_id, label
    ), books AS (
        SELECT sha256(string_agg(array_to_string([x::BIGINT FOR x IN part], ','), ',' ORDER BY p, e)) AS codebooks_sha256
        FROM book{_LAST}
    )
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
    FROM codes, books
"""

ORACLE = {
    "op11_vector_codes": VECTOR_CODES,
    "op12_periodic_runs": PERIODIC_RUNS,
    "op13_substring_dedup": SUBSTRING_DEDUP,
}
