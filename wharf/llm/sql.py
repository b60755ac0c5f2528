"""Comparison SQL of the training-data queries, where SQL can express them."""

from __future__ import annotations

from wharf.llm.quality_rules import POLICIES

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_SYMBOLS = "regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]')"

_FAILS = {
    "few_words": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "symbol_heavy": "4 * n_symbols > n_words",
    "repeated_lines": "10 * n_dup_lines > 3 * n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 20 * n_words",
}


def _any(policy: str) -> str:
    return " OR ".join(_FAILS[name] for name in POLICIES[policy])


OP9 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {_WORDS} AS w FROM documents
), lines AS (
  SELECT r, count(*) AS n, count(*) - count(DISTINCT line) AS dup
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r
), windows AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 1, 1))) AS i FROM d)
), twice AS (
  SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, g) > 1
), repeated AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY r
), m AS (
  SELECT doc_id, len(w) AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    len({_SYMBOLS}) AS n_symbols, coalesce(lines.n, 0) AS n_lines,
    coalesce(lines.dup, 0) AS n_dup_lines, coalesce(repeated.n, 0) AS n_repeat_words
  FROM d LEFT JOIN lines USING (r) LEFT JOIN repeated USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  ({_any("base")}) AS base_failed, NOT ({_any("v2")}) AS kept FROM m
"""

OP5 = rf"""
WITH d AS (
  SELECT doc_id, source, len({_WORDS}) AS size, len({_SYMBOLS})::DOUBLE AS symbols FROM documents
), k AS (
  SELECT doc_id, source, size,
    -ln((('0x' || substr(md5('0:' || coalesce(doc_id::VARCHAR, '') || ':' || size), 1, 13))::BIGINT::DOUBLE
      + 0.5) * (1.0::DOUBLE / 4503599627370496.0::DOUBLE))
    / (1.0::DOUBLE / (1.0::DOUBLE + symbols / greatest(size, 1)::DOUBLE)) AS key
  FROM d
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1]::DOUBLE AS weight
  FROM d GROUP BY source
), l AS (
  SELECT *, 2 * source_size::DOUBLE AS most,
    (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2 * source_size::DOUBLE) OVER before, 0))
    / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM s WINDOW before AS (ORDER BY 2 * source_size::DOUBLE / weight, source
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
  SELECT source, source_size, least(most, max(level) OVER () * weight) AS target FROM l
), p AS (
  SELECT k.*, source_size, target,
    coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_words,
    CASE WHEN source_size > 0 THEN least(2, floor(target / source_size))::INT ELSE 0 END AS epochs
  FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  ((epochs + CASE WHEN 2 * before_words + size < 2 * (target - epochs * source_size) THEN 1 ELSE 0 END)
    * size)::BIGINT AS taken
FROM p
"""

OP10 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.w, c.w)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, (row_number() OVER best)::INT AS rank, vec_id, score FROM s
WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER best <= 10
"""

OP11 = rf"""
WITH f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f), orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM f a
  JOIN f b ON b.f <> a.f JOIN f c ON c.f NOT IN (a.f, b.f)
  JOIN f d ON d.f NOT IN (a.f, b.f, c.f) JOIN f e ON e.f NOT IN (a.f, b.f, c.f, d.f)
), l AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
), t AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, {_WORDS} AS w FROM documents
), m AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    CASE WHEN len(w) < 200 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * len(regexp_extract_all(text, '[A-Z]')) > 3 * length(text) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN t.doc_id > min(t.doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END AS fails
  FROM t LEFT JOIN l ON l.doc_id = t.doc_id
), c AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, fails
), s AS (
  SELECT part, fails, n, good, toxic, filter_order, step, substr(filter_order, step, 1) AS f,
    len(regexp_extract_all(substr(filter_order, 1, step - 1), '[' || fails || '-]')) > 0 AS gone
  FROM c, orders, (SELECT unnest(range(1, 6))::INT AS step)
), r AS (
  SELECT part, filter_order, step, f, sum(n) FILTER (NOT gone AND NOT contains(fails, f)) AS kept,
    sum(n) FILTER (NOT gone AND contains(fails, f)) AS removed, sum(n) FILTER (gone AND contains(fails, f)) AS redundant,
    sum(n) FILTER (fails = f) AS unique_fails, sum(good) FILTER (NOT gone AND contains(fails, f)) AS good_lost,
    sum(toxic) FILTER (NOT gone AND contains(fails, f)) AS toxic_lost FROM s GROUP BY ALL
)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
  coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
  coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
  (coalesce(sum(removed) OVER (PARTITION BY part, f), 0))::BIGINT AS shapley
FROM r
"""

OP12 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS rank, {_WORDS} AS w FROM documents
), windows AS (
  SELECT r, rank, i, array_to_string(w[i:i + 12], ' ') AS g
  FROM (SELECT r, rank, w, unnest(range(1, greatest(len(w) - 11, 1))) AS i FROM d)
), found AS (
  SELECT r, i FROM windows QUALIFY rank > min(rank) OVER (PARTITION BY g)
), gone AS (
  SELECT DISTINCT r, unnest(range(i, i + 13)) AS p FROM found
), words AS (
  SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d
), kept AS (
  SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS text FROM words ANTI JOIN gone USING (r, p) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

SQL: dict[str, str] = {
    "op5_mixing": OP5,
    "op9_quality_rules": OP9,
    "op10_topk": OP10,
    "op11_filter_audit": OP11,
    "op12_substring_dedup": OP12,
}
