"""Event topic as a streaming DataFrame of JSON files (or a broker topic where its package is present)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.operators.tables import read_or_empty
from fieldlens.schemas import EVENTS

COMPLETED = "detection.completed"
READY = "dossiers.ready"


def first_start(spark: SparkSession, path: str):
    """Time at which a reader was first started, kept as one row at ``path``; later starts find the first one's."""
    if not (kept := read_or_empty(spark, path, "t TIMESTAMP").take(1)):
        spark.sql("SELECT current_timestamp() AS t").write.mode("ignore").parquet(path)
        kept = spark.read.schema("t TIMESTAMP").parquet(path).take(1)
    return kept[0].t


def read_topic(
    spark: SparkSession, path: str, starting_offsets: str = "earliest", max_files: int = 100, since_path: str | None = None
) -> DataFrame:
    """Events of a topic folder. ``latest`` reads only files that arrive from the first start on, whatever their events' times.

    ``since_path`` keeps the time of the first start, beside the checkpoint of the query: a restarted reader then also gets the files that came
    while it was down (the checkpoint knows which were read). Without it every start counts as the first.
    """
    reader = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", str(max_files))
    df = reader.json(path)
    if starting_offsets == "latest":
        since = first_start(spark, since_path) if since_path else spark.sql("SELECT current_timestamp() AS t").first().t
        arrived = F.col("_metadata.file_modification_time")
        df = df.withColumn("__arrived", arrived).where(F.col("__arrived") >= F.lit(since)).drop("__arrived")
    return df


def read_kafka_topic(spark: SparkSession, servers: str, topic: str, starting_offsets: str = "earliest") -> DataFrame:
    """The same topic on a broker; needs the Spark broker package on the class path."""
    raw = (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
        .option("startingOffsets", starting_offsets).load()
    )
    return raw.select(F.from_json(F.col("value").cast("string"), EVENTS).alias("e")).select("e.*")


def completed_runs(events: DataFrame) -> DataFrame:
    """Completed detections with a usable run id."""
    return events.where((F.col("type") == COMPLETED) & (F.coalesce("run_id", F.lit("")) != ""))


def event_rows(runs: DataFrame, kind: str) -> DataFrame:
    """Event rows of one type for the runs of a batch, stamped with the current UTC time."""
    return runs.select("run_id", *[c for c in ("aoi", "n_detections", "detector") if c in runs.columns]).withColumns(
        {"type": F.lit(kind), "ts": F.current_timestamp()}
    )
