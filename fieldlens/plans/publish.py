"""A whole run from stored imagery to documents, published at once.

Every publication writes its stage tables under a version of its own; the last write adds one row per run to the table ``published`` that
says which version holds. Readers look through that table, so a failure between the writes leaves the old version of
a run whole, and readers never see tables of different versions. Metrics of all versions stay as a history with their time. A document that was
there before keeps its first time and parcel data and takes the rest from the new version; documents whose flagged row is gone go with it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.functions import geometry as G
from fieldlens.functions.projection import WGS84, project_ring
from fieldlens.operators import tables as TB
from fieldlens.operators import tiles as TL
from fieldlens.operators.ranking import latest_by
from fieldlens.plans import detect as D
from fieldlens.plans import evidence as E
from fieldlens.session import cut_lineage
from fieldlens.sources.rasters import area_grids
from fieldlens.sources.sinks import as_stored, emit_events
from fieldlens.streaming.events import COMPLETED, event_rows

STAGES = ["detections", "pieces", "flagged", "metrics", "dossiers"]
DOCUMENT = ["run_id", "aoi", "detection_id", "parcel_id"]
FIRST = ["landcode", "created_at"]  # what a document keeps from its first version
_GRID = {"a": "grid_a", "c": "grid_c", "e": "grid_e", "f": "grid_f"}


def detect_stored(
    tiles: DataFrame, manifest: DataFrame, run_id: str, settings: D.Settings = D.Settings(), detector: str = "spectral",
    crs: str = "EPSG:3826", working_crs: str = "EPSG:3826",
) -> tuple[DataFrame, DataFrame]:
    """Detections and pieces like :func:`fieldlens.plans.evidence.detect`, from stored tiles of both dates.

    The grid of an area is spread over its tiles and travels with the mask, so no table of areas meets pixels or row runs.
    """
    c = F.col
    grids = area_grids(manifest)
    grid = list(_GRID.values())
    spread = TL.per_tile(grids.select("aoi", "h", "w", *[c(k).alias(v) for k, v in _GRID.items()]), settings.tile_px).drop("h", "w")
    pairs = TL.pair_dates(tiles).join(spread, ["aoi", *TL.TILE])
    keys = ["aoi", *grid]
    area = D.strip_area(*[c(n) for n in grid], crs, working_crs)
    found = D.detect_tile_pairs(pairs, keys, settings, D.DETECTORS.get(detector, D.DETECTORS["spectral"])[1] == "spectral-spark", area)
    used = D.DETECTORS.get(detector, D.DETECTORS["spectral"])[1]
    rows = found.detections.join(grids.select("aoi", "t0_date", "t1_date"), "aoi").select(
        c("component").alias("detection_id"), F.lit(run_id).alias("run_id"), "aoi", F.lit(detector).alias("detector_requested"),
        F.lit(used).alias("detector_used"), "t0_date", "t1_date", "ndbi_delta", "ndvi_drop", "confidence", "area_m2", "n_px", "rank",
    )
    kept = found.strips.join(found.detections.select("aoi", "component"), ["aoi", "component"], "left_semi")
    x0, x1 = c("grid_c") + c("c0") * c("grid_a"), c("grid_c") + (c("c1") + 1) * c("grid_a")
    y0, y1 = c("grid_f") + c("row") * c("grid_e"), c("grid_f") + (c("row") + 1) * c("grid_e")
    ring = project_ring(G.box_ring(x0, y0, x1, y1), crs, WGS84)
    pieces = kept.select(F.lit(run_id).alias("run_id"), "aoi", c("component").alias("detection_id"), ring.alias("ring"))
    pieces = pieces.withColumn("b", G.bounds(F.array("ring")))
    return as_stored(rows), pieces.select("run_id", "aoi", "detection_id", "ring", "b.minx", "b.miny", "b.maxx", "b.maxy")


# ------------------------------------------------------------------ versions


def publish(spark: SparkSession, store: E.Store, stages: dict[str, DataFrame], runs: list[str], version: str | None = None) -> str:
    """Write the tables of ``runs`` under a new version, then make that version the current one of these runs."""
    version = version or uuid.uuid4().hex
    for name, df in stages.items():
        stamped = df if "created_at" in df.columns else df.withColumn("created_at", F.current_timestamp())
        stamped.withColumn("version", F.lit(version)).write.mode("append").partitionBy("version", "run_id").parquet(store.path(name))
    rows = spark.createDataFrame([(r, version) for r in runs], "run_id string, version string")
    rows.withColumn("published_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(store.path("published"))
    return version


def current(spark: SparkSession, store: E.Store, name: str, schema=None) -> DataFrame | None:
    """Rows of the current version of every run, or None where nothing has been published."""
    if not TB.table_exists(spark, store.path("published")) or not TB.table_exists(spark, store.path(name)):
        return None
    rows = history(spark, store, name, schema)
    latest = latest_by(spark.read.parquet(store.path("published")), ["run_id"], "published_at", ["version"])
    return rows.join(latest.select("run_id", "version"), ["run_id", "version"], "left_semi").drop("version")


def history(spark: SparkSession, store: E.Store, name: str, schema=None) -> DataFrame:
    """Rows of all versions that were ever published; what a failed publication has left behind is not among them."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    rows = reader.parquet(store.path(name)).withColumns({"run_id": F.col("run_id").cast("string"), "version": F.col("version").cast("string")})
    known = spark.read.parquet(store.path("published")).select("run_id", "version").distinct()
    return rows.join(known, ["run_id", "version"], "left_semi")


def keep_first(before: DataFrame | None, docs: DataFrame) -> DataFrame:
    """New documents with the first time and parcel data of those that were there before."""
    docs = docs.withColumn("created_at", F.current_timestamp())
    if before is None:
        return docs
    old = before.groupBy(*DOCUMENT).agg(*[F.min_by(n, "created_at").alias(f"first_{n}") for n in FIRST])
    joined = docs.join(old, DOCUMENT, "left")
    known = F.col("first_created_at").isNotNull()
    return joined.select(*[F.when(known, F.col(f"first_{n}")).otherwise(F.col(n)).alias(n) if n in FIRST else F.col(n) for n in docs.columns])


def run_pipeline(
    spark: SparkSession, store: E.Store, tiles: DataFrame, manifest: DataFrame, inp: E.Inputs, run_id: str | None = None,
    settings: D.Settings = D.Settings(), detector: str = "spectral",
) -> str:
    """Detect, join, score and document one run over all stored areas and publish it; the event goes out last."""
    run_id = E.new_run_id(run_id)
    det, pieces = (cut_lineage(x) for x in detect_stored(tiles, manifest, run_id, settings, detector, inp.crs, inp.crs))
    flagged = cut_lineage(as_stored(E.flag(det, pieces, inp.parcels, inp.labels, inp.cell, inp.crs)))
    metrics = as_stored(E.score(det, pieces, flagged, inp.labels, inp.radius_m, inp.crs))
    docs = E.document(flagged, det, pieces, inp.areas, inp.chunks, inp.embedder, inp.top_k, inp.radius_m, inp.limit)
    docs = keep_first(current(spark, store, "dossiers"), docs)
    publish(spark, store, dict(zip(STAGES, (det, pieces, flagged, metrics, docs))), [run_id])
    done = det.groupBy("run_id").agg(F.count("*").alias("n_detections"), F.first("detector_used").alias("detector"))
    emit_events(spark, event_rows(done, COMPLETED), store.path("events"))
    return run_id
