"""Area configuration: one row per area in a small dimension table."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Defaults of the optional settings.
DEFAULTS = {
    "working_crs": "EPSG:3826",
    "label_range_km": 7.0,
    "max_cloud_cover": 25.0,
    "tile_size_m": 1280.0,
    "ndbi_delta_min": 0.06,
    "ndvi_drop_min": 0.12,
    "min_area_m2": 400.0,
    "morph_open_iter": 1,
    "max_candidates": 500,
    "match_radius_m": 80.0,
    "provider": "synthetic",
    "grid_m": 120.0,
    "farmland_fraction": 0.7,
    "seed": 20260615,
    "chunk_chars": 600,
    "chunk_overlap": 80,
    "top_k": 6,
}

AOI_SCHEMA = (
    "aoi STRING, display_name STRING, county STRING, township STRING, "
    "minx DOUBLE, miny DOUBLE, maxx DOUBLE, maxy DOUBLE, center_lon DOUBLE, center_lat DOUBLE, "
    "label_range_km DOUBLE, working_crs STRING, collection STRING, bands ARRAY<STRING>, max_cloud_cover DOUBLE, "
    "t0 STRUCT<start: STRING, end: STRING>, t1 STRUCT<start: STRING, end: STRING>, tile_size_m DOUBLE, "
    "ndbi_delta_min DOUBLE, ndvi_drop_min DOUBLE, min_area_m2 DOUBLE, morph_open_iter INT, max_candidates INT, "
    "match_radius_m DOUBLE, provider STRING, path STRING, grid_m DOUBLE, farmland_fraction DOUBLE, seed LONG, "
    "pcodes ARRAY<STRUCT<pcode: STRING, title: STRING>>, chunk_chars INT, chunk_overlap INT, top_k INT"
)


def aoi_row(raw: dict) -> dict:
    """Flatten one nested area description and fill in defaults; wrong boxes are refused."""
    d = dict(DEFAULTS)
    minx, miny, maxx, maxy = (float(v) for v in raw["bbox"])
    if not (minx < maxx and miny < maxy):
        raise ValueError(f"bbox of {raw.get('name')} is not ordered")
    stac, det, par = raw["stac"], raw.get("detection") or {}, raw.get("parcels") or {}
    laws, synth = raw["laws"], par.get("synthetic") or {}
    d.update(
        aoi=raw["name"], display_name=raw["display_name"], county=raw["county"], township=raw["township"],
        minx=minx, miny=miny, maxx=maxx, maxy=maxy,
        center_lon=float(raw["center"]["lon"]), center_lat=float(raw["center"]["lat"]),
        collection=stac.get("collection", "sentinel-2-l2a"), bands=list(stac["bands"]),
        t0=dict(stac["t0"]), t1=dict(stac["t1"]), path=par.get("path"),
        pcodes=[dict(p) for p in laws["pcodes"]],
    )
    given = {
        "working_crs": raw.get("working_crs"), "label_range_km": raw.get("disfactory_range_km"),
        "max_cloud_cover": stac.get("max_cloud_cover"), "tile_size_m": (raw.get("tiling") or {}).get("tile_size_m"),
        "provider": par.get("provider"), "chunk_chars": laws.get("chunk_chars"),
        "chunk_overlap": laws.get("chunk_overlap"), "top_k": laws.get("top_k"),
        **{k: det.get(k) for k in ("ndbi_delta_min", "ndvi_drop_min", "min_area_m2", "morph_open_iter", "max_candidates", "match_radius_m")},
        **{k: synth.get(k) for k in ("grid_m", "farmland_fraction", "seed")},
    }
    d.update({k: type(DEFAULTS[k])(v) for k, v in given.items() if v is not None})
    return d


def load_aoi_yaml(path: str) -> dict:
    import yaml

    with Path(path).open(encoding="utf-8") as fh:
        return aoi_row(yaml.safe_load(fh))


def aoi_dim(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Dimension table of all areas of a job (hand-written configuration, so always small)."""
    from pyspark.sql import types as T

    schema = T.StructType.fromDDL(AOI_SCHEMA)
    return spark.createDataFrame([{f.name: r.get(f.name) for f in schema} for r in rows], schema)
