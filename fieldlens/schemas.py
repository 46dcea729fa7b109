"""Declared schemas of the stored tables and documents, as DDL."""

_POLY = "ARRAY<ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>>"

PARCELS = (
    "parcel_id STRING, aoi STRING, landcode STRING, sectname STRING, sectcode STRING, "
    f"landuse_code STRING, is_farmland BOOLEAN, source STRING, geom {_POLY}, created_at TIMESTAMP"
)
LABELS = (
    "id STRING, aoi STRING, display_number INT, name STRING, landcode STRING, townname STRING, "
    "sectname STRING, sectcode STRING, source STRING, factory_type STRING, status STRING, "
    "reported_at TIMESTAMP, lon DOUBLE, lat DOUBLE, created_at TIMESTAMP"
)
DETECTIONS = (
    "detection_id LONG, run_id STRING, aoi STRING, detector_requested STRING, detector_used STRING, "
    "t0_date STRING, t1_date STRING, ndbi_delta FLOAT, ndvi_drop FLOAT, confidence FLOAT, area_m2 FLOAT, "
    "n_px LONG, minx DOUBLE, miny DOUBLE, maxx DOUBLE, maxy DOUBLE, created_at TIMESTAMP"
)
DETECTION_PIECES = (
    "run_id STRING, aoi STRING, detection_id LONG, minx DOUBLE, miny DOUBLE, maxx DOUBLE, maxy DOUBLE"
)
FLAGGED = (
    "run_id STRING, detection_id LONG, parcel_id STRING, aoi STRING, landcode STRING, sectname STRING, "
    "is_farmland BOOLEAN, overlap_area_m2 FLOAT, confidence FLOAT, rank LONG, matched_label_id STRING, "
    "distance_to_label_m FLOAT, created_at TIMESTAMP"
)
LAW_CHUNKS = (
    "pcode STRING, law_title STRING, article_no STRING, chunk_index LONG, content STRING, "
    "embedding ARRAY<FLOAT>"
)
DOSSIERS = (
    "run_id STRING, detection_id LONG, parcel_id STRING, landcode STRING, model STRING, confidence FLOAT, "
    "violated_law STRING, recommended_action STRING, dossier_md STRING, dossier_json STRING, "
    "created_at TIMESTAMP"
)
METRICS = "run_id STRING, aoi STRING, payload STRING, created_at TIMESTAMP"
MANIFEST = (
    "aoi STRING, t_label STRING, crs STRING, transform ARRAY<DOUBLE>, height INT, width INT, "
    "bands MAP<STRING, STRING>, datetime STRING, cloud_cover DOUBLE, source STRING, stac_item_id STRING"
)
RASTER_TILES = (
    "aoi STRING, t_label STRING, tile_r INT, tile_c INT, r0 INT, c0 INT, h INT, w INT, "
    "bands MAP<STRING, ARRAY<FLOAT>>"
)
EVENTS = (
    "type STRING, ts TIMESTAMP, run_id STRING, aoi STRING, n_detections LONG, detector STRING"
)
FEATURE = (
    "STRUCT<type: STRING, geometry: STRUCT<type: STRING, coordinates: STRING>, "
    "properties: MAP<STRING, STRING>>"
)
FEATURE_COLLECTION = f"type STRING, features ARRAY<{FEATURE}>"
STATUTE = "title STRING, articles ARRAY<STRUCT<article_no: STRING, text: STRING>>"
TENDER_PAGE = (
    "records ARRAY<STRUCT<date: STRING, unit_name: STRING, job_number: STRING, "
    "brief: STRUCT<title: STRING, type: STRING>>>, total_pages INT"
)
