"""Statute corpora: ``{title, articles: [{article_no, text}]}`` per code."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.operators.tables import replace_partitions
from fieldlens.schemas import STATUTE


def explode_articles(statutes: DataFrame) -> DataFrame:
    """``pcode, law_title, article_pos, article_no, text`` from rows with ``pcode, title, articles``."""
    return statutes.select(
        "pcode", F.col("title").alias("law_title"), F.posexplode("articles").alias("article_pos", "a")
    ).select("pcode", "law_title", "article_pos", "a.article_no", "a.text")


def parse_statutes(texts: DataFrame, text: str) -> DataFrame:
    return texts.withColumn("__s", F.from_json(text, STATUTE)).select(
        *[c for c in texts.columns if c != text], "__s.title", "__s.articles"
    )


def read_statutes(spark: SparkSession, path: str) -> DataFrame:
    """One file per code; the code is the file name."""
    df = spark.read.schema(STATUTE).json(path, multiLine=True)
    return df.withColumn("pcode", F.regexp_extract(F.input_file_name(), r"([^/]+)\.json$", 1))


def missing_codes(configured: DataFrame, statutes: DataFrame) -> DataFrame:
    """Configured codes without a corpus; they are skipped."""
    return configured.join(statutes.select("pcode").distinct(), "pcode", "left_anti")


def write_chunks(chunks: DataFrame, path: str) -> None:
    """Embedded chunks of a code replace what was stored for it."""
    replace_partitions(chunks, path, ["pcode"])
