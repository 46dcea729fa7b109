"""Intermediate tables of the training-data operators."""

from __future__ import annotations

import ctypes
import math
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.session import ensure_checkpoint_dir


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write rows to the folder all executors share and read them from there.

    Committed files survive lost executors, and every later job sees the same rows.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def parts_for(df: DataFrame, text: str, bytes_per_part: int, least: int | None = None) -> int:
    """Number of partitions that keeps the texts of each at about ``bytes_per_part``; one scan of the column."""
    total = df.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0
    floor = least or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, floor, math.ceil(total / bytes_per_part))


def without(docs: DataFrame, names: list[str]) -> DataFrame:
    """Input columns that an operator's result columns replace."""
    return docs.drop(*[c for c in docs.columns if c in names])


def memory_returned(result):
    """Hands what a worker process has freed back to the system; an idle worker keeps it otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
    return result
