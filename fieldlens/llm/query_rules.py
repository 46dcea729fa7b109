"""op1: quality rules over documents."""

from __future__ import annotations

from fieldlens.llm.quality_rules import MAX_REMOVED_PCT, MIN_TEXTS, judge
from fieldlens.llm.registry import query, table

_W = r"[\x20\x09-\x0D]+"


def rules_sql(source: str = "documents") -> str:
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM {source}
), w AS (
  SELECT *, list_filter(regexp_split_to_array(text, '{_W}'), lambda x: x <> '') AS ws,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM d
), grams AS (
  SELECT r, i, array_to_string(ws[i : i + 7], ' ') AS g
  FROM (SELECT r, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8)
), twice AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM grams
), steps AS (
  SELECT r, least(8, coalesce(i - lag(i) OVER (PARTITION BY r ORDER BY i), 8)) AS fresh FROM twice WHERE n > 1
), repeats AS (
  SELECT r, sum(fresh) AS n FROM steps GROUP BY r
), lines AS (
  SELECT source, text, l, len(list_filter(regexp_split_to_array(l, '{_W}'), lambda x: x <> '')) AS n,
         lower(array_to_string(list_filter(regexp_split_to_array(l, '{_W}'), lambda x: x <> ''), ' ')) AS norm
  FROM (SELECT source, text, unnest(ls) AS l FROM (SELECT DISTINCT source, text, ls FROM w))
), held AS (
  SELECT source, text, norm, sum(n) AS n FROM lines GROUP BY ALL
), common AS (
  SELECT source, norm FROM held GROUP BY ALL HAVING count(*) >= {MIN_TEXTS}
), removed AS (
  SELECT s.source, s.text, sum(s.n) AS n
  FROM held s JOIN common c ON s.source IS NOT DISTINCT FROM c.source AND s.norm = c.norm GROUP BY ALL
), counted AS (
  SELECT w.doc_id, len(w.ws)::BIGINT AS n_words, length(array_to_string(w.ws, ''))::BIGINT AS word_chars,
         length(regexp_replace(w.text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(w.ls) - len(list_distinct(w.ls)))::BIGINT AS n_dup_lines,
         coalesce(p.n, 0)::BIGINT AS n_repeat_words, coalesce(x.n, 0)::BIGINT AS removed_words
  FROM w LEFT JOIN repeats p USING (r)
       LEFT JOIN removed x ON x.source IS NOT DISTINCT FROM w.source AND x.text = w.text
)
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words)
         AND 100 * removed_words <= {MAX_REMOVED_PCT} * n_words AS kept
FROM counted
"""


@query("op1_quality_rules", rules_sql())
def quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return judge(docs).drop("source")
