"""op2 and op5: repeated byte strings and repeated passages of words."""

from __future__ import annotations

from fieldlens.llm import substring_dedup, suffix_dedup
from fieldlens.llm.registry import query, table

WORDS_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents
), win AS (
  SELECT doc_id, a, array_to_string(ws[a : a + 49], ' ') AS w
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS a FROM d WHERE len(ws) >= 50)
), gone AS (
  SELECT doc_id, a FROM (SELECT doc_id, a, min(doc_id) OVER (PARTITION BY w) AS low FROM win) WHERE low < doc_id
), spots AS (
  SELECT doc_id, list(DISTINCT p) AS ps FROM (SELECT doc_id, unnest(range(a, a + 50)) AS p FROM gone) GROUP BY doc_id
)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(len(ps), 0)::BIGINT AS n_removed,
       sha256(array_to_string(CASE WHEN ps IS NULL THEN ws ELSE list_filter(ws, lambda x, i: NOT list_contains(ps, i)) END, ' ')) AS kept_sha256
FROM d LEFT JOIN spots USING (doc_id)
"""


@query("op5_substring_dedup", WORDS_SQL)
def substring_windows(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.dedup(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")


BYTES_SQL = r"""
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), win AS (
  SELECT doc_id, a, substring(h, 2 * a + 1, 100) AS w
  FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS a FROM d WHERE length(h) >= 100)
), gone AS (
  SELECT doc_id, a FROM (SELECT doc_id, a, min(doc_id) OVER (PARTITION BY w) AS low FROM win) WHERE low < doc_id
), steps AS (
  SELECT doc_id, a, lag(a) OVER (PARTITION BY doc_id ORDER BY a) AS b FROM gone
), runs AS (
  SELECT doc_id, sum(CASE WHEN b IS NULL OR a > b + 50 THEN 1 ELSE 0 END) AS n_spans,
         sum(CASE WHEN b IS NULL THEN 50 ELSE least(50, a - b) END) AS n_removed
  FROM steps GROUP BY doc_id
), cuts AS (
  SELECT doc_id, a, sum(CASE WHEN b IS NULL OR a > b + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY a) AS run FROM steps
), spans AS (
  SELECT doc_id, run, min(a) AS lo, max(a) + 50 AS hi FROM cuts GROUP BY doc_id, run
), gaps AS (
  SELECT doc_id, run, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS lo, lo AS hi FROM spans
  UNION ALL SELECT doc_id, max(run) + 1, max(hi), NULL FROM spans GROUP BY doc_id
), kept AS (
  SELECT doc_id, string_agg(substring(h, 2 * lo + 1, coalesce(2 * (hi - lo), length(h))::BIGINT), '' ORDER BY run) AS k
  FROM gaps JOIN d USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM d LEFT JOIN runs USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


@query("op2_suffix_dedup", BYTES_SQL)
def suffix_copies(spark, sf_dir):
    return suffix_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
