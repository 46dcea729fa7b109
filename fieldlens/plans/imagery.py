"""Stored imagery derived from the given tables: a tile table and its manifest, written once per session."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.operators import raster as R
from fieldlens.operators import tiles as TL
from fieldlens.plans import inputs as I
from fieldlens.session import ensure_checkpoint_dir
from fieldlens.sources.rasters import read_manifest

BANDS = ["b04", "b03", "b02", "b08", "b11"]
WINDOW = ["aoi", "t_label"]
_WRITTEN: dict[tuple[str, str], tuple[str, str]] = {}


def _k() -> str:
    return "cast(substring(aoi, 2) AS long)"


def manifest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per area and date. The green band comes with the later date, the blue one only in every second area; the
    later date of every third area is not known."""
    e = I.table(spark, sf_dir, "events").selectExpr(
        f"concat('a', event_id div {I.PIXELS_PER_AOI}) AS aoi", f"cast((event_id % {I.PIXELS_PER_AOI}) div {I.RASTER_WIDTH} AS int) AS row",
        f"cast((event_id % {I.PIXELS_PER_AOI}) % {I.RASTER_WIDTH} AS int) AS col", "ts",
    )
    areas = e.groupBy("aoi").agg(
        F.max("row").alias("r"), F.max("col").alias("c"), F.min("ts").alias("first"), F.max("ts").alias("last")
    ).withColumn("k", F.expr(_k()))
    dated = areas.selectExpr("*", "explode(array('t0', 't1')) AS t_label")
    day = "date_format({}, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"
    bands = "filter(array('B04', 'B03', 'B02', 'B08', 'B11'), x -> x NOT IN ('B03', 'B02') OR (t_label = 't1' AND (x = 'B03' OR k % 2 = 0)))"
    return dated.selectExpr(
        "aoi", "t_label", "'EPSG:4326' AS crs",
        f"array({I.PIXEL_SIDE}D, 0D, cast({I.aoi_x('k')} AS double), 0D, -{I.PIXEL_SIDE}D, cast({I.aoi_y('k')} AS double)) AS transform",
        "r + 1 AS height", "c + 1 AS width", f"map_from_arrays({bands}, transform({bands}, x -> concat(aoi, '/', t_label, '/', x))) AS bands",
        f"CASE WHEN t_label = 't0' THEN {day.format('first')} WHEN k % 3 <> 2 THEN {day.format('last')} END AS datetime",
        "cast(k % 10 AS double) AS cloud_cover", "'events' AS source", "concat('scene-', aoi, '-', t_label) AS stac_item_id",
    )


def dated_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per pixel and date with all bands the window has."""
    px = I.pixels(spark, sf_dir)
    old = px.selectExpr("aoi", "'t0' AS t_label", "row", "col", "b04_t0 AS b04", "cast(null AS double) AS b03", "cast(null AS double) AS b02",
                        "b08_t0 AS b08", "b11_t0 AS b11")
    new = px.selectExpr("aoi", "'t1' AS t_label", "row", "col", "b04_t1 AS b04", "b04_t1 + 0.01D AS b03",
                        f"if({_k()} % 2 = 0, b04_t1 - 0.02D, null) AS b02", "b08_t1 AS b08", "b11_t1 AS b11")
    return old.unionByName(new)


def stored(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Tiles (``aoi, t_label``, place, one array per band) and manifest."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _WRITTEN:
        name = f"tiles_{hashlib.sha256(sf_dir.encode()).hexdigest()[:12]}"
        path = f"{ensure_checkpoint_dir(spark)}/manifest_{name}"
        manifest_rows(spark, sf_dir).write.mode("overwrite").partitionBy(*WINDOW).parquet(path)
        grids = read_manifest(spark, path).select(*WINDOW, F.col("height").alias("h"), F.col("width").alias("w"), "bands")
        TL.store_tiles(TL.cut_tiles(dated_pixels(spark, sf_dir), grids, WINDOW, BANDS, I.TILE_PX), name)
        _WRITTEN[key] = (name, path)
    name, path = _WRITTEN[key]
    return spark.table(name), read_manifest(spark, path)


def tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir)[0]


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TL.pair_dates(tiles(spark, sf_dir))


def extents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``aoi, h, w`` of all areas, from the manifest."""
    return R.check_same_grid(stored(spark, sf_dir)[1])
