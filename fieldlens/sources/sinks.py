"""Writers of the result tables."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.operators.tables import replace_partitions

log = logging.getLogger(__name__)

_REAL = ("ndbi_delta", "ndvi_drop", "confidence", "area_m2", "overlap_area_m2", "distance_to_label_m")


def as_stored(df: DataFrame) -> DataFrame:
    """Statistics columns as float32, the width the stored tables have."""
    return df.withColumns({c: F.col(c).cast("float") for c in _REAL if c in df.columns})


def append_table(df: DataFrame, path: str, by: list[str]) -> None:
    as_stored(df).write.mode("append").partitionBy(*by).parquet(path)


def replace_runs(df: DataFrame, path: str) -> None:
    """Rows of a run replace what was stored for it."""
    replace_partitions(as_stored(df), path, ["run_id"])


def write_run_json(payloads: DataFrame, path: str) -> None:
    """JSON documents (``run_id, payload``) as text files per run; a run replaces its own."""
    (
        payloads.select("run_id", "payload").write.mode("overwrite").partitionBy("run_id")
        .option("partitionOverwriteMode", "dynamic").text(path)
    )


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").csv(path)


def export_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def emit_events(spark: SparkSession, events: DataFrame, path: str) -> bool:
    """Append event rows to the topic folder; a failing sink never fails the job."""
    try:
        events.write.mode("append").json(path)
        return True
    except Exception as exc:  # noqa: BLE001
        log.warning("could not emit events to %s: %s", path, exc)
        return False
