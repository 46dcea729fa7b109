"""The whole chain over many areas and runs: detect, join, nearest site, rank, score, documents.

Stage results are tables partitioned by run; every stage handles all runs it is given in one job, and
replaces what was stored for them.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.functions import geometry as G
from fieldlens.functions.projection import WGS84, project_points, project_ring
from fieldlens.operators import dossiers as DO
from fieldlens.operators import metrics as M
from fieldlens.operators import retrieval as RT
from fieldlens.operators import spatial as SP
from fieldlens.operators import tables as TB
from fieldlens.operators.ranking import latest_by, rank_rows
from fieldlens.plans import detect as D
from fieldlens.session import cut_lineage
from fieldlens.sources.sinks import as_stored, emit_events, replace_runs, write_run_json
from fieldlens.streaming.events import COMPLETED, event_rows

KEY = ["run_id", "aoi"]
FACTS = [
    "detection_id", "parcel_id", "landcode", "sectname", "overlap_area_m2", "confidence", "matched_label_id",
    "distance_to_label_m", "lat", "lon", "ndbi_delta", "ndvi_drop", "area_m2", "t0_date", "t1_date", "detector",
]


def new_run_id(given: str | None = None, now: dt.datetime | None = None) -> str:
    """The given run id, else one made of the UTC time."""
    return given or "run-" + (now or dt.datetime.now(dt.UTC)).strftime("%Y%m%d-%H%M%S")


def latest_run(detections: DataFrame) -> DataFrame:
    return latest_by(detections.select("run_id", "created_at"), [], "created_at", ["run_id"]).select("run_id")


# ------------------------------------------------------------------ stages


def detect(
    pixels: DataFrame, grids: DataFrame, run_id: str, settings: D.Settings = D.Settings(), detector: str = "spectral",
    crs: str = "EPSG:3826", working_crs: str = "EPSG:3826",
) -> tuple[DataFrame, DataFrame]:
    """Detections and their pieces (row runs as lon/lat boxes) of all areas in ``pixels``.

    ``grids`` has ``aoi, h, w, a, c, e, f, t0_date, t1_date``: one row per area.
    """
    c = F.col
    area = D.strip_area(c("a"), c("c"), c("e"), c("f"), crs, working_crs)
    found = D.run_detector(
        detector, pixels, ["aoi"], settings, extents=grids.select("aoi", "h", "w"), area=area, placed=grids.select("aoi", "a", "c", "e", "f")
    )
    placed = found.detections.join(grids.select("aoi", "a", "c", "e", "f", "t0_date", "t1_date"), "aoi")
    # Component codes are unique per area; the run and the area make the key.
    rows = placed.select(
        c("component").alias("detection_id"), F.lit(run_id).alias("run_id"), "aoi", "detector_requested", "detector_used",
        "t0_date", "t1_date", "ndbi_delta", "ndvi_drop", "confidence", "area_m2", "n_px", "rank",
    )
    kept = found.strips.join(found.detections.select("aoi", "component"), ["aoi", "component"], "left_semi")
    geo = kept.join(grids.select("aoi", "a", c("c").alias("gc"), "e", "f"), "aoi")
    x0, x1 = c("gc") + c("c0") * c("a"), c("gc") + (c("c1") + 1) * c("a")
    y0, y1 = c("f") + c("row") * c("e"), c("f") + (c("row") + 1) * c("e")
    ring = project_ring(G.box_ring(x0, y0, x1, y1), crs, WGS84)
    pieces = geo.select(
        F.lit(run_id).alias("run_id"), "aoi", c("component").alias("detection_id"), ring.alias("ring")
    ).withColumn("b", G.bounds(F.array("ring")))
    pieces = pieces.select("run_id", "aoi", "detection_id", "ring", "b.minx", "b.miny", "b.maxx", "b.maxy")
    return as_stored(rows), pieces


def flag(
    detections: DataFrame, pieces: DataFrame, parcels: DataFrame, labels: DataFrame, cell: float, crs: str = "EPSG:3826",
) -> DataFrame:
    """Ranked farmland overlaps with the nearest known site.

    ``parcels`` carry a box and ``geom``; ``labels`` have ``aoi, pid, px, py`` in degrees. Work is done per
    piece and folded per detection: touching counts, overlap areas add up. The site is chosen by planar
    degree distance and reported in metres.
    """
    c = F.col
    land = parcels.where("is_farmland").select(
        "aoi", "parcel_id", "landcode", "sectname", "is_farmland", "minx", "miny", "maxx", "maxy", c("geom").alias("r_geom")
    )
    keyed = pieces.withColumn("piece", F.concat_ws(":", "run_id", c("detection_id").cast("string"), c("miny").cast("string"), c("minx").cast("string")))
    left = keyed.select("run_id", "aoi", "detection_id", "piece", "minx", "miny", "maxx", "maxy", F.array("ring").alias("l_geom"))
    hits = SP.intersect_polygons(left, land, ["aoi"], "piece", "parcel_id", cell, crs)
    folded = SP.fold_pieces(hits, [*KEY, "detection_id", "parcel_id"], ["landcode", "sectname", "is_farmland"])
    rows = folded.join(detections.select(*KEY, "detection_id", "confidence"), [*KEY, "detection_id"])
    near = nearest_site(pieces.join(folded.select(*KEY, "detection_id").distinct(), [*KEY, "detection_id"], "left_semi"), labels, crs)
    rows = as_stored(rows.join(near, [*KEY, "detection_id"], "left"))
    order = [F.desc_nulls_first("confidence"), F.desc_nulls_first("overlap_area_m2"), F.asc("aoi"), F.asc("detection_id"), F.asc("parcel_id")]
    return rank_rows(rows, ["run_id"], order)


def nearest_site(pieces: DataFrame, labels: DataFrame, crs: str) -> DataFrame:
    """Per detection the site nearest in degrees over all its pieces, and its distance in metres."""
    c = F.col
    key = [*KEY, "detection_id"]
    slim = pieces.select(*key, "ring", "minx", "miny", "maxx", "maxy").withColumn(
        "piece", F.struct("miny", "minx", "maxy", "maxx")
    )
    near = SP.nearest_point(slim, labels, ["aoi"], ["run_id", "detection_id", "piece"])
    best = near.where("pid IS NOT NULL").groupBy(*key).agg(
        F.min(F.struct("d2", "pid", "px", "py")).alias("s")
    ).select(*key, c("s.pid").alias("pid"), c("s.px").alias("px"), c("s.py").alias("py"))
    at = project_points(best, "px", "py", WGS84, crs, ("qx", "qy"))
    metres = slim.join(at, key).select(
        *key, "pid",
        G.polygon_point_distance(
            F.array(project_ring(c("ring"), WGS84, crs)), F.struct(c("qx").alias("x"), c("qy").alias("y"))
        ).alias("m"),
    )
    return metres.groupBy(*key).agg(
        F.first("pid").cast("string").alias("matched_label_id"), F.min("m").alias("distance_to_label_m")
    )


def score(
    detections: DataFrame, pieces: DataFrame, flagged: DataFrame, labels: DataFrame, radius_m: float, crs: str = "EPSG:3826"
) -> DataFrame:
    """Precision, recall and F1 per (run, area)."""
    c = F.col
    on_farm = pieces.join(flagged.select(*KEY, "detection_id").distinct(), [*KEY, "detection_id"], "left_semi")
    quads = on_farm.select("run_id", project_ring(c("ring"), WGS84, crs).alias("ring")).withColumn("b", G.bounds(F.array("ring")))
    quads = quads.select("run_id", "ring", "b.minx", "b.miny", "b.maxx", "b.maxy")
    runs = detections.select(*KEY).distinct()
    points = project_points(labels.withColumnsRenamed({"px": "lon", "py": "lat"}), "lon", "lat", WGS84, crs, ("px", "py"))
    points = points.join(runs, "aoi").select(*KEY, "pid", "px", "py")
    matched = SP.points_within(points, quads, radius_m, ["run_id"])
    counts = matched.groupBy(*KEY).agg(F.count("*").alias("n_labels_matched"))
    return M.precision_recall(runs, detections, flagged, labels, counts, radius_m)


def document(
    flagged: DataFrame, detections: DataFrame, pieces: DataFrame, areas: DataFrame, chunks: DataFrame, embedder, top_k: int,
    radius_m: float, limit: int = 12,
) -> DataFrame:
    """Documents of the worklist: query text, top-k statute chunks, rule-based draft."""
    c = F.col
    w = (c("maxx") - c("minx")) * (c("maxy") - c("miny"))
    centre = pieces.groupBy(*KEY, "detection_id").agg(
        (F.sum((c("minx") + c("maxx")) / 2 * w) / F.sum(w)).alias("lon"), (F.sum((c("miny") + c("maxy")) / 2 * w) / F.sum(w)).alias("lat")
    )
    det = detections.withColumnRenamed("detector_requested", "detector").join(centre, [*KEY, "detection_id"])
    cands = DO.candidates(flagged, det.drop("rank"), limit).join(F.broadcast(areas), "aoi")
    asked = cands.select(F.xxhash64(*KEY, "detection_id").alias("query_id"), *KEY, "detection_id", DO.query_text().alias("text"))
    vectors = RT.encode(asked.select("query_id", "text"), "text", embedder, "vector")
    top = RT.topk_cosine(chunks.select(c("chunk_id").alias("item_id"), c("embedding").alias("vector")), vectors.select("query_id", "vector"), top_k)
    cite = F.struct("rank", "law_title", "article_no", "content", "similarity")
    cited = top.join(chunks.drop("embedding"), c("item_id") == c("chunk_id")).groupBy("query_id").agg(F.sort_array(F.collect_list(cite)).alias("citations"))
    cited = asked.select("query_id", *KEY, "detection_id").join(cited, "query_id").drop("query_id")
    none = F.slice(F.array(F.struct(F.lit(0).alias("rank"), F.lit("").alias("law_title"), F.lit("").alias("article_no"), F.lit("").alias("content"), F.lit(0.0).alias("similarity"))), 1, 0)
    rows = cands.join(cited, [*KEY, "detection_id"], "left").withColumn("citations", F.coalesce("citations", none))
    return DO.build_dossiers(rows, radius_m, FACTS)


# --------------------------------------------------------------- stored run


@dataclass
class Store:
    """Locations of the stage tables below one root."""

    root: str
    names: list[str] = field(default_factory=lambda: ["detections", "pieces", "flagged", "dossiers", "metrics", "metrics_json", "events"])

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"


@dataclass
class Inputs:
    """What a run needs besides imagery."""

    parcels: DataFrame
    labels: DataFrame
    areas: DataFrame
    chunks: DataFrame
    embedder: object
    cell: float = 0.0012
    radius_m: float = 80.0
    top_k: int = 6
    limit: int = 12
    crs: str = "EPSG:3826"


def run_detection(spark: SparkSession, store: Store, pixels: DataFrame, grids: DataFrame, run_id: str, **kw) -> None:
    """Detect, store and announce one run over all areas of ``pixels``."""
    detections, pieces = detect(pixels, grids, run_id, **kw)
    stamped = detections.withColumn("created_at", F.current_timestamp())
    replace_runs(stamped, store.path("detections"))
    replace_runs(pieces, store.path("pieces"))
    stored = spark.read.schema(as_stored(stamped).schema).parquet(store.path("detections")).where(F.col("run_id") == run_id)
    done = stored.groupBy("run_id").agg(F.count("*").alias("n_detections"), F.first("detector_used").alias("detector"))
    emit_events(spark, event_rows(done, COMPLETED), store.path("events"))


def run_evidence(spark: SparkSession, store: Store, runs: list[str], inp: Inputs) -> None:
    """Join, score and document stored runs in one set-at-a-time job per stage."""
    if not runs:
        return

    def stored(name: str) -> DataFrame:
        return spark.read.parquet(store.path(name)).where(F.col("run_id").isin(runs))

    if not TB.has_rows(spark, store.path("detections")):  # no run has found anything yet
        return
    det, pieces = stored("detections"), stored("pieces")
    # All results are computed and kept aside first: a failure leaves the stored rows of the runs as they were.
    flagged = cut_lineage(as_stored(flag(det, pieces, inp.parcels, inp.labels, inp.cell, inp.crs)))
    metrics = cut_lineage(as_stored(score(det, pieces, flagged, inp.labels, inp.radius_m, inp.crs)))
    docs = cut_lineage(document(flagged, det, pieces, inp.areas, inp.chunks, inp.embedder, inp.top_k, inp.radius_m, inp.limit))
    for name in ("flagged", "dossiers"):  # a run without results drops its old ones
        TB.clear_partitions(spark, store.path(name), "run_id", runs)
    replace_runs(flagged, store.path("flagged"))
    replace_runs(metrics, store.path("metrics"))
    write_run_json(M.metrics_payload(metrics), store.path("metrics_json"))
    replace_runs(docs, store.path("dossiers"))


# ---------------------------------------------------------------- flagship


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixels of every area to precision and recall, on the derived inputs."""
    from fieldlens.plans import inputs as I

    c = F.col
    px = I.pixels(spark, sf_dir)
    found = D.detect_spectral(px, ["aoi"], D.Settings(pixel_area=I.PIXEL_AREA_M2))
    k = "cast(substring(aoi, 2) AS long)"
    x, y = F.expr(I.aoi_x(k)).cast("double"), F.expr(I.aoi_y(k)).cast("double")
    kept = found.strips.join(found.detections.select("aoi", "component", "confidence"), ["aoi", "component"])
    pieces = kept.select(
        F.lit("run-px").alias("run_id"), "aoi", c("component").alias("detection_id"), "confidence",
        (x + c("c0") * 100).alias("minx"), (y - (c("row") + 1) * 100).alias("miny"), (x + (c("c1") + 1) * 100).alias("maxx"), (y - c("row") * 100).alias("maxy"),
    )
    land = I.parcels(spark, sf_dir).where("is_farmland").select("aoi", "parcel_id", "minx", "miny", "maxx", "maxy")
    hits = SP.intersect_boxes(pieces, land, ["aoi"], I.PARCEL_SIDE, I.MICRO)
    flagged = SP.fold_pieces(hits, [*KEY, "detection_id", "parcel_id"], ["confidence"])
    near = SP.nearest_point(
        pieces.select("run_id", "aoi", "detection_id", F.struct("miny", "minx").alias("piece"), "minx", "miny", "maxx", "maxy"),
        I.sites(spark, sf_dir), ["aoi"], ["detection_id", "piece"],
    )
    gx = F.greatest(F.lit(0.0), c("px") - c("maxx"), c("minx") - c("px")) * F.lit(I.MICRO * SP.LOCAL_M_PER_DEG_LON)
    gy = F.greatest(F.lit(0.0), c("py") - c("maxy"), c("miny") - c("py")) * F.lit(I.MICRO * SP.LOCAL_M_PER_DEG_LAT)
    near = near.groupBy(*KEY, "detection_id").agg(F.min_by(F.sqrt(gx * gx + gy * gy), F.struct("d2", "pid")).alias("distance_to_label_m"))
    flagged = flagged.join(near, [*KEY, "detection_id"], "left")
    order = [F.desc_nulls_first("confidence"), F.desc_nulls_first("overlap_area_m2"), F.asc("aoi"), F.asc("detection_id"), F.asc("parcel_id")]
    flagged = rank_rows(flagged, ["run_id"], order)
    kx, ky = F.lit(I.MICRO * SP.LOCAL_M_PER_DEG_LON), F.lit(I.MICRO * SP.LOCAL_M_PER_DEG_LAT)
    on_farm = pieces.join(flagged.select(*KEY, "detection_id").distinct(), [*KEY, "detection_id"], "left_semi")
    boxes = on_farm.select("run_id", (c("minx") * kx).alias("minx"), (c("miny") * ky).alias("miny"), (c("maxx") * kx).alias("maxx"), (c("maxy") * ky).alias("maxy"))
    det = found.detections.select(F.lit("run-px").alias("run_id"), "aoi", c("component").alias("detection_id"))
    sites = I.sites(spark, sf_dir)
    points = sites.join(det.select(*KEY).distinct(), "aoi").select(*KEY, "pid", (c("px") * kx).alias("px"), (c("py") * ky).alias("py"))
    matched = SP.points_within(points, boxes, I.MATCH_RADIUS_M, ["run_id"]).groupBy(*KEY).agg(F.count("*").alias("n_labels_matched"))
    worst = flagged.groupBy(*KEY).agg(F.max("rank").alias("last_rank"), F.round(F.sum("overlap_area_m2"), 2).alias("overlap_m2"))
    scored = M.precision_recall(det, det, flagged, sites, matched, I.MATCH_RADIUS_M)
    return scored.join(worst, KEY, "left")
