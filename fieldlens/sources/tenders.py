"""Tender result pages as flat rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.schemas import TENDER_PAGE


def flatten_pages(pages: DataFrame, text: str, max_pages: int) -> DataFrame:
    """Records of pages ``1 .. least(max_pages, total_pages)`` per keyword (``keyword, page``); a record
    without ``brief`` keeps null title and type."""
    parsed = pages.withColumn("__p", F.from_json(text, TENDER_PAGE))
    last = F.least(F.lit(max_pages), F.coalesce("__p.total_pages", F.lit(1)))
    # The first page is always read, whatever the total says.
    rows = parsed.where(F.col("page") <= F.greatest(F.lit(1), last))
    return rows.select("keyword", "page", F.explode("__p.records").alias("r")).select(
        "keyword", "page", "r.date", "r.unit_name", F.col("r.brief.title").alias("title"),
        F.col("r.brief.type").alias("type"), "r.job_number",
    )
