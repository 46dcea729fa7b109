"""Corpus pipeline: from documents to packed token sequences.

Each stage works on all that the one before it kept; ``run`` writes every stage to the shared folder and reads it
again, so a lost executor costs one stage at most. XXH64 and token ids have no SQL, so the stages are tested
against plain definitions instead.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.llm import decontaminate, quality_rules, simhash, suffix_dedup
from fieldlens.llm.packing import pack, token_pieces
from fieldlens.llm.tables import stored

VOCABULARY = "byte_bpe_50k.json"


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; common lines are gone from the others."""
    kept = quality_rules.clean(docs)
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every near-duplicate class stays."""
    return simhash.keep_one(docs)


def repeat_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte strings that a document with a smaller id holds are gone; no document goes."""
    found = suffix_dedup.dedup(docs, texts_too=True).withColumn("text", F.col("kept"))
    return found.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence and offset."""
    return pack(token_pieces(docs, public_tokenizers.path(VOCABULARY)))


STAGES = [
    ("quality_rules", quality_stage),
    ("simhash_near_dedup", near_duplicate_stage),
    ("suffix_dedup", repeat_stage),
    ("decontamination", benchmark_stage),
    ("packing", packing_stage),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
