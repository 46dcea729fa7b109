"""Session set-up and durable lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Broadcast inputs are only used below this size; every caller has another way above it.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024


def build_session(app: str = "fieldlens", master: str | None = None, conf: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster; a local one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="fieldlens-ckpt-")
    sc.setCheckpointDir(configured)
    return configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows survive executor loss and the plan starts afresh."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str, **options: str | int) -> DataFrame:
    """The rows, written to the shared folder once and read from there."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread_scan(df: DataFrame) -> DataFrame:
    """Share a small file scan out over all cores before work that is heavy per row.

    Only for plain scans (asking a shuffled plan for its partitions would run it); scans that already
    have enough partitions, as all large ones do, stay as they are.
    """
    wanted = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= wanted else df.repartition(wanted)


def spread_by(df: DataFrame, *columns) -> DataFrame:
    """Deal rows out by key into all shuffle partitions before work that sorts or hashes them.

    Rows that compress well look small after a shuffle, and the adaptive plan then merges them to a few tasks a core, whose memory
    grows with the input; a number of partitions that is asked for is kept.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, wherever the job was started from.

    Spark itself carries the archive to the executors; once per context.
    """
    sc = spark.sparkContext
    if getattr(sc, "_fieldlens_shipped", False):
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="fieldlens-pkg-")) / "fieldlens.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(archive))
    sc._fieldlens_shipped = True
