"""Event-driven worker: completed detections trigger join, score and documents."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fieldlens.operators.tables import read_or_empty
from fieldlens.sources.sinks import emit_events
from fieldlens.streaming.events import READY, completed_runs, event_rows

log = logging.getLogger(__name__)

DEAD_LETTER = "run_id STRING, error STRING, batch_id LONG"
HANDLED = "run_id STRING, ts TIMESTAMP, day DATE"


def unhandled(batch: DataFrame, path: str, remember_days: int | None = None) -> DataFrame:
    """Distinct ``run_id, ts`` of a batch that the stored table of handled events does not hold.

    Only days within ``remember_days`` of today are read (None: all); a repeated delivery of an older event is handled again.
    """
    held = read_or_empty(batch.sparkSession, path, HANDLED)
    if remember_days is not None:
        held = held.where(F.col("day") >= F.date_sub(F.current_date(), remember_days))
    new = batch.select("run_id", "ts").distinct().alias("n")
    same = F.col("n.run_id").eqNullSafe(F.col("h.run_id")) & F.col("n.ts").eqNullSafe(F.col("h.ts"))
    return new.join(held.alias("h"), same, "left_anti")


def remember(events: DataFrame, path: str) -> None:
    """Append events to the table of handled ones, by the day of handling."""
    events.select("run_id", "ts", F.current_date().alias("day")).write.mode("append").partitionBy("day").parquet(path)


def process_batch(
    batch: DataFrame, batch_id: int, process: Callable[[SparkSession, list[str]], None], events_path: str, dead_letter: str
) -> None:
    """One micro-batch: all its runs in one go; if that fails, run by run, so that a bad run is set aside
    in the dead-letter table and the others still finish. The sinks replace per run, so replays are safe.
    """
    spark = batch.sparkSession
    # Control messages only: one short id per run of the batch, which maxFilesPerTrigger bounds.
    runs = [r.run_id for r in batch.select("run_id").distinct().collect()]
    if not runs:
        return
    failed: list[tuple[str, str, int]] = []
    try:
        process(spark, runs)
    except Exception as exc:  # noqa: BLE001
        log.warning("batch %s failed as a whole (%s); trying run by run", batch_id, exc)
        for run in runs:
            try:
                process(spark, [run])
            except Exception as one:  # noqa: BLE001
                log.error("run %s failed: %s", run, one)
                failed.append((run, str(one), batch_id))
    bad = {f[0] for f in failed}
    if failed:
        spark.createDataFrame(failed, DEAD_LETTER).write.mode("append").parquet(dead_letter)
    good = [(r,) for r in runs if r not in bad]
    if good:
        emit_events(spark, event_rows(spark.createDataFrame(good, "run_id STRING"), READY), events_path)


def process_new(
    batch: DataFrame, batch_id: int, process: Callable[[SparkSession, list[str]], None], events_path: str, dead_letter: str, handled: str,
    remember_days: int | None = None,
) -> None:
    """One micro-batch without the events handled before; they are remembered last, so a batch that breaks off is done again as a whole."""
    new = unhandled(batch, handled, remember_days).persist()
    try:
        process_batch(new, batch_id, process, events_path, dead_letter)
        remember(new, handled)
    finally:
        new.unpersist()


def start_worker(
    events: DataFrame,
    process: Callable[[SparkSession, list[str]], None],
    events_path: str,
    dead_letter: str,
    checkpoint: str,
    once: bool = False,
    handled: str | None = None,
    remember_days: int | None = None,
) -> StreamingQuery:
    """Start the worker on a topic stream; ``once`` handles what is there and stops.

    Events may arrive in any order and late: there is no watermark to drop them. Repeated deliveries are known by run and time from the
    table ``handled`` (beside the checkpoint by default), so the stream itself keeps no state. ``remember_days`` bounds what a
    batch reads of it: a delivery repeated later than that runs again, which replaces its results with equal ones.
    """
    known = handled or checkpoint.rstrip("/") + "_handled"
    writer = (
        completed_runs(events).writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(lambda df, i: process_new(df, i, process, events_path, dead_letter, known, remember_days))
    )
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="10 seconds")).start()


def start_feed(
    events: DataFrame, path: str, checkpoint: str, types: list[str] | None = None, run_id: str | None = None, once: bool = False
) -> StreamingQuery:
    """Tail events of some types or one run into an append table for viewers."""
    df = events
    if types:
        df = df.where(F.col("type").isin(types))
    if run_id:
        df = df.where(F.col("run_id") == run_id)
    writer = df.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", path)
    return (writer.trigger(availableNow=True) if once else writer).start()
