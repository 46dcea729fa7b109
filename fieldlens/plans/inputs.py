"""Inputs derived from the given tables by fixed integer rules.

The given tables hold no rasters or parcels; these rules turn their keys into pixels, parcels,
detections, known sites and texts, spread over as many areas as the tables are large. Coordinates are
micro-degrees.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fieldlens.functions.scalars import HASH_I_FACTOR, HASH_J_FACTOR, HASH_MODULUS, HASH_SEED_FACTOR
from fieldlens.session import spread_scan

# Sizes of one area in each table, chosen so that areas line up at every scale factor.
PIXELS_PER_AOI = 4200
RASTER_WIDTH = 100
PARCELS_PER_AOI = 840
DETECTIONS_PER_AOI = 6300
SITES_PER_AOI = 42
RECORDS_PER_AOI = 630

MICRO = 1e-6
PIXEL_SIDE = 100
PIXEL_AREA_M2 = 100.0
ORIGIN_X, ORIGIN_Y = 120460000, 24150000
PARCEL_SIDE = 1200
PARCEL_SEED = 20260615

# Thresholds used with these inputs.
NDBI_MIN, NDVI_MIN, MIN_AREA_M2 = 0.06, 0.12, 400.0
TILE_PX = 32
MAX_CANDIDATES = 500
MATCH_RADIUS_M = 80.0
WORKLIST = 12
CHUNK, OVERLAP = 600, 80
TOP_K = 6


def aoi_x(index: str) -> str:
    """SQL text of an area's west edge; areas lie side by side, 50 to a row."""
    return f"({ORIGIN_X} + ({index} % 50) * 20000)"


def aoi_y(index: str, div: str = "div") -> str:
    return f"({ORIGIN_Y} - (({index} {div} 50) % 100) * 110000)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Text columns of a table, spread over the cores when the file is small."""
    return spread_scan(table(spark, sf_dir, name).select(*columns))


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both dates of every area's raster, one row per pixel, bands in thousandths / 1000."""
    e = spread_scan(table(spark, sf_dir, "events").select("event_id"))
    df = e.selectExpr(
        f"concat('a', event_id div {PIXELS_PER_AOI}) AS aoi",
        "event_id",
        f"cast((event_id % {PIXELS_PER_AOI}) div {RASTER_WIDTH} AS int) AS row",
        f"cast((event_id % {PIXELS_PER_AOI}) % {RASTER_WIDTH} AS int) AS col",
        "(event_id * 31) % 1009 AS h",
    ).selectExpr(
        "aoi", "row", "col", "h",
        "event_id % 997 = 0 AS z",
        "((((row div 6) * 7 + (col div 6) * 3) % 5 = 0) AND event_id % 53 <> 0) OR (event_id * 7919) % 97 = 0 AS built",
    )
    bands = {
        "b04_t0": "if(z, 0, 60 + h % 7)",
        "b08_t0": "if(z, 0, 350 + h % 11)",
        "b11_t0": "if(z, 0, 200 + h % 5)",
        "b04_t1": "if(built, 200 + h % 7, 60 + h % 7 + h % 3)",
        "b08_t1": "if(built, 220 + h % 11, 350 + h % 11)",
        "b11_t1": "if(built, 340 + h % 5, 200 + h % 5 + h % 3)",
    }
    return df.selectExpr("aoi", "row", "col", *[f"cast({v} AS double) / 1000 AS {k}" for k, v in bands.items()])


def parcels(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = spread_scan(table(spark, sf_dir, "part"))
    unit = (
        f"pmod(({PARCEL_SEED}L * {HASH_SEED_FACTOR}L) ^ (i * {HASH_I_FACTOR}L) ^ ((p_partkey div 10) * {HASH_J_FACTOR}L),"
        f" {HASH_MODULUS}L)"
    )
    return (
        p.selectExpr(
            "p_partkey", "p_name", "p_brand", "p_type",
            f"concat('a', p_partkey div {PARCELS_PER_AOI}) AS aoi",
            f"p_partkey div {PARCELS_PER_AOI} AS k",
            f"(p_partkey % {PARCELS_PER_AOI}) % 10 AS i",
            f"(p_partkey % {PARCELS_PER_AOI}) div 10 AS j",
        )
        .selectExpr(
            "p_partkey", "p_name", "aoi", "k", "i", "j",
            "format_string('%s-%03d-%03d', aoi, i, j) AS parcel_id",
            "concat('LC-', p_partkey) AS landcode",
            "p_brand AS sectname",
            f"{unit} AS unit100k",
            f"cast({aoi_x('k')} - 300 + {PARCEL_SIDE} * i AS double) AS minx",
            f"cast({aoi_y('k')} + 300 - {PARCEL_SIDE} * (j + 1) AS double) AS miny",
        )
        .selectExpr(
            "*", "unit100k < 70000 AS is_farmland",
            f"minx + {PARCEL_SIDE}D AS maxx", f"miny + {PARCEL_SIDE}D AS maxy",
        )
    )


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = spread_scan(table(spark, sf_dir, "orders"))
    k = f"(o_orderkey div {DETECTIONS_PER_AOI})"
    return o.selectExpr(
        "o_orderkey AS detection_id",
        f"concat('a', o_orderkey div {DETECTIONS_PER_AOI}) AS aoi",
        "concat('run-', o_orderkey % 4) AS run_id",
        f"{aoi_x(k)} + (o_orderkey * 7919) % 10000 AS cx",
        f"{aoi_y(k)} - (o_orderkey * 104729) % 100000 AS cy",
        "100 + o_orderkey % 150 AS hw",
        "least(0.99D, 0.05D + cast((o_orderkey * 37) % 950 AS double) / 1000) AS confidence",
        "0.06D + cast((o_orderkey * 13) % 300 AS double) / 1000 AS ndbi_delta",
        "0.12D + cast((o_orderkey * 17) % 400 AS double) / 1000 AS ndvi_drop",
        "date_format(o_orderdate, 'yyyy-MM-dd') AS t0_date",
        "date_format(date_add(o_orderdate, 1827), 'yyyy-MM-dd') AS t1_date",
        "o_orderdate AS created_at",
    ).selectExpr(
        "* except (cx, cy, hw)",
        "cast(cx - hw AS double) AS minx", "cast(cy - hw AS double) AS miny",
        "cast(cx + hw AS double) AS maxx", "cast(cy + hw AS double) AS maxy",
    )


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known sites (labels) as points."""
    k = f"(s_suppkey div {SITES_PER_AOI})"
    return table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS pid",
        f"concat('a', s_suppkey div {SITES_PER_AOI}) AS aoi",
        f"cast({aoi_x(k)} + (s_suppkey * 3571 + 13) % 10000 AS double) AS px",
        f"cast({aoi_y(k)} - (s_suppkey * 65537 + 7) % 100000 AS double) AS py",
    )


def site_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw label records as a service would answer them (untrimmed names, null positions)."""
    k = f"(c_custkey div {RECORDS_PER_AOI})"
    return spread_scan(table(spark, sf_dir, "customer")).selectExpr(
        "c_custkey AS id",
        f"{k} AS k",
        f"concat('a', c_custkey div {RECORDS_PER_AOI}) AS aoi",
        "cast(c_custkey AS int) AS display_number",
        "CASE WHEN c_custkey % 7 = 0 THEN '  ' WHEN c_custkey % 11 = 0 THEN NULL ELSE concat(' ', c_name, ' ') END AS name",
        "concat('LC-', c_custkey % 2000) AS landcode",
        "concat('town', c_nationkey) AS townname",
        "c_mktsegment AS status",
        f"CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE {aoi_x(k)} + (c_custkey * 3571 + 13) % 10000 END AS mlng",
        f"{aoi_y(k)} - (c_custkey * 65537 + 7) % 100000 AS mlat",
    ).selectExpr("* except (mlng, mlat)", "cast(mlng AS double) / 1000000 AS lng", "cast(mlat AS double) / 1000000 AS lat")


def scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue of scenes: one per order, an area per customer group."""
    return spread_scan(table(spark, sf_dir, "orders")).selectExpr(
        "concat('scene-', o_orderkey) AS item_id",
        "o_orderkey",
        "concat('c', o_custkey % 25) AS aoi",
        "o_orderdate AS dt",
        "CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE cast((o_orderkey * 37) % 1000 AS double) / 10 END AS cloud_cover",
        f"cast({ORIGIN_X} + (o_orderkey * 7919) % 10000 AS double) AS minx",
        f"cast({ORIGIN_Y} - (o_orderkey * 104729) % 100000 AS double) AS miny",
    ).selectExpr("*", "minx + 5000D AS maxx", "miny + 5000D AS maxy")


SCENE_WINDOWS = (("t0", "1995-10-01", "1996-03-31"), ("t1", "2000-10-01", "2001-03-31"))


def statutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as an article of the code named by its source."""
    return texts(spark, sf_dir, "documents", "doc_id", "source", "text").selectExpr(
        "source AS pcode",
        "concat('Law ', source) AS law_title",
        "doc_id AS article_pos",
        "concat('Art. ', doc_id) AS article_no",
        "text",
    )
