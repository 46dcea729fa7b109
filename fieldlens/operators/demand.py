"""Demand evidence: reports per year, tenders per keyword."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.functions.scalars import year_of

# Search terms of the tender count.
TENDER_KEYWORDS = (
    "違章工廠", "農地違規", "航遙測", "遙測影像", "衛星影像",
    "變更偵測", "國土監測", "土地利用監測", "違規使用查報", "無人機 監測",
)


def reports_by_year(reports: DataFrame, reported_at: str) -> DataFrame:
    year = year_of(F.col(reported_at).cast("string"))
    return (
        reports.select(year.alias("year")).where("year IS NOT NULL").groupBy("year")
        .agg(F.count("*").alias("n_reports")).orderBy("year")
    )


def keyword_counts(titles: DataFrame, title: str, keywords: list[str]) -> DataFrame:
    """Matching titles per keyword, zeros included.

    The keyword list is fixed and short: each title is read once and tested against all of them inside
    the row, so only (keyword, count) pairs are shuffled.
    """
    spark = titles.sparkSession
    listed = F.array(*[F.lit(k) for k in keywords])
    hits = titles.select(F.explode(F.filter(listed, lambda k: F.col(title).contains(k))).alias("keyword"))
    counts = hits.groupBy("keyword").agg(F.count("*").alias("n"))
    asked = spark.createDataFrame([(k,) for k in keywords], "keyword string")
    return asked.join(counts, "keyword", "left").select("keyword", F.coalesce("n", F.lit(0).cast("long")).alias("n_titles"))


def demand_summary(by_year: DataFrame, by_keyword: DataFrame) -> DataFrame:
    """Totals and series as one JSON row. Both inputs hold one row per year or keyword."""
    years = by_year.agg(
        F.sum("n_reports").alias("n_reports"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("year", "n_reports")))).alias("reports_by_year"),
    )
    words = by_keyword.agg(
        F.sum("n_titles").alias("total_matching_tenders"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("keyword", "n_titles")))).alias("by_keyword"),
    )
    return years.crossJoin(words).select(F.to_json(F.struct("*")).alias("summary"))
