"""op11: ranked lexical search of all documents for every benchmark item."""

from __future__ import annotations

from fieldlens.llm.ranked_search import TOP, search
from fieldlens.llm.registry import query, table


def search_sql(documents: str = "documents", benchmark: str = "benchmark", top: int = TOP) -> str:
    terms = (
        "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
        r" '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    )
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, {terms} AS ts FROM {documents}
), sizes AS (
  SELECT r, doc_id, len(ts)::BIGINT AS n FROM d WHERE len(ts) > 0
), total AS (
  SELECT count(*)::BIGINT AS nd, sum(n)::BIGINT AS nt FROM sizes
), i AS (
  SELECT row_number() OVER () AS q, item_id, {terms} AS ts FROM {benchmark}
), asked AS (
  SELECT q, t, count(*)::BIGINT AS times FROM (SELECT q, unnest(ts) AS t FROM i) GROUP BY ALL
), postings AS (
  SELECT r, t, count(*)::BIGINT AS tf FROM (SELECT r, unnest(ts) AS t FROM d) SEMI JOIN asked USING (t) GROUP BY ALL
), weights AS (
  SELECT t, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM postings, total GROUP BY t, nd
), impacts AS (
  SELECT r, t, w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * nd) // nt)))) AS x
  FROM postings JOIN weights USING (t) JOIN sizes USING (r), total
), scored AS (
  SELECT q, r, sum(times * x)::BIGINT AS score FROM asked JOIN impacts USING (t) GROUP BY q, r
), ranked AS (
  SELECT q, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS rank
  FROM scored JOIN sizes USING (r) WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked JOIN i USING (q) WHERE rank <= {top}
"""


@query("op11_ranked_search", search_sql())
def ranked_search(spark, sf_dir):
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
