"""op12: line deduplication of documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldlens.llm.line_dedup import MIN_CHARS, MIN_DOCS, dedup
from fieldlens.llm.registry import query, table

_SPACE = " || ".join(f"chr({c})" for c in (32, 9, 10, 11, 12, 13))


def lines_sql(source: str = "documents") -> str:
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM {source}
), l AS (
  SELECT r, doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM d
), k AS (
  SELECT *, translate(trim(line, {_SPACE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), common AS (
  SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= {MIN_CHARS}
  GROUP BY key HAVING count(DISTINCT doc_id) >= {MIN_DOCS}
), judged AS (
  SELECT r, k.doc_id, pos, line, top IS NOT NULL AND top <> k.doc_id AS gone FROM k LEFT JOIN common USING (key)
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY r, doc_id
"""


@query("op12_line_dedup", lines_sql())
def line_dedup(spark, sf_dir):
    found = dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))
