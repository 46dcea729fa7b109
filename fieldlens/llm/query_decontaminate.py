"""op10: benchmark decontamination of documents."""

from __future__ import annotations

from fieldlens.llm.decontaminate import find
from fieldlens.llm.registry import query, table

# Words of the lower-cased text: runs of ASCII letters and digits and of all characters beyond ASCII.
_WORDS = (
    "list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    r" '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
)

SQL = f"""
WITH i AS (SELECT item_id, {_WORDS} AS ws FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(13, len(ws)) AS n, array_to_string(ws[a : a + 12], ' ') AS w
  FROM (SELECT item_id, ws, unnest(range(1, greatest(1, len(ws) - 12) + 1)) AS a FROM i WHERE len(ws) > 0)
), d AS (
  SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS ws FROM documents
), spot AS (
  SELECT r, s.n, a, array_to_string(ws[a : a + s.n - 1], ' ') AS w
  FROM (SELECT r, ws, s, unnest(range(1, len(ws) - s.n + 2)) AS a FROM d, (SELECT DISTINCT n FROM win) s WHERE len(ws) >= s.n)
), hit AS (
  SELECT r, a, spot.n, item_id FROM spot JOIN win ON spot.w = win.w AND spot.n = win.n
), spots AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(a, a + n)) AS p FROM hit) GROUP BY r
), named AS (
  SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS names
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY r
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN spots USING (r) LEFT JOIN named USING (r)
"""


@query("op10_decontamination", SQL)
def decontamination(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return find(docs, table(spark, sf_dir, "benchmark")).select("doc_id", "__found.*")
