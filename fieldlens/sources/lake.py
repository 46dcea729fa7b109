"""Object listing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def inventory(spark: SparkSession, prefix: str, pattern: str = "*") -> DataFrame:
    """Objects under a prefix with their size; contents are not read."""
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(prefix)
    )
    return files.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), "path", "length")


def object_exists(spark: SparkSession, path: str) -> bool:
    from fieldlens.operators.tables import table_exists

    return table_exists(spark, path)
