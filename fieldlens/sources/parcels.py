"""Parcel layers: a deterministic grid per area, or GeoJSON features."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.functions import geometry as G
from fieldlens.functions import scalars as S
from fieldlens.functions.projection import WGS84, project_ring
from fieldlens.operators.spatial import candidate_pairs
from fieldlens.schemas import FEATURE, FEATURE_COLLECTION
from fieldlens.sources.rasters import grid_from_bbox

# Texts of the grid parcels.
GRID_SECTION = "示範段 (synthetic)"
GRID_SECTION_CODE = "SIM"
USE_FARM = "農牧用地"
USE_BUILT = "甲種建築用地"


def grid_parcels(areas: DataFrame, crs: str) -> DataFrame:
    """Cells of ``grid_m`` metres over each area box, the last ones clipped, back in lon/lat.

    ``areas`` has ``aoi, minx..maxy, grid_m, farmland_fraction, seed``. Rows of cells are spread over the
    cluster before the columns are exploded.
    """
    c = F.col
    box = grid_from_bbox(areas, crs).withColumns(
        {
            "nx": F.ceil((c("gx1") - c("gx0")) / c("grid_m")).cast("int"),
            "ny": F.ceil((c("gy1") - c("gy0")) / c("grid_m")).cast("int"),
        }
    )
    rows = box.withColumn("j", F.explode(F.sequence(F.lit(0), c("ny") - 1))).repartition("aoi", "j")
    cells = rows.withColumn("i", F.explode(F.sequence(F.lit(0), c("nx") - 1)))
    x0, y0 = c("gx0") + c("i") * c("grid_m"), c("gy0") + c("j") * c("grid_m")
    x1, y1 = F.least(x0 + c("grid_m"), c("gx1")), F.least(y0 + c("grid_m"), c("gy1"))
    farm = S.hash_unit(c("seed"), c("i"), c("j")) < c("farmland_fraction")
    ring = project_ring(G.box_ring(x0, y0, x1, y1), crs, WGS84)
    return cells.select(
        S.padded_id(c("aoi"), c("i"), c("j")).alias("parcel_id"),
        "aoi",
        F.format_string("SIM-%03d%03d", c("i"), c("j")).alias("landcode"),
        F.lit(GRID_SECTION).alias("sectname"),
        F.lit(GRID_SECTION_CODE).alias("sectcode"),
        F.when(farm, USE_FARM).otherwise(USE_BUILT).alias("landuse_code"),
        farm.alias("is_farmland"),
        F.lit("synthetic").alias("source"),
        F.array(ring).alias("geom"),
    )


def parse_collections(texts: DataFrame, text: str) -> DataFrame:
    """Features of GeoJSON collections held one per row, with their position."""
    parsed = texts.withColumn("__fc", F.from_json(text, FEATURE_COLLECTION))
    keep = [c for c in texts.columns if c != text]
    return parsed.select(*keep, F.posexplode("__fc.features").alias("pos", "feature"))


def read_collections(spark: SparkSession, path: str) -> DataFrame:
    """Whole-file GeoJSON collections; for large layers store one feature per line instead."""
    return parse_collections(spark.read.text(path, wholetext=True), "value")


def read_feature_lines(spark: SparkSession, path: str) -> DataFrame:
    """Newline-delimited features: splittable, for layers of any size. ``pos`` is unique, not dense."""
    lines = spark.read.text(path)
    return lines.select(F.monotonically_increasing_id().alias("pos"), F.from_json("value", FEATURE).alias("feature"))


def features_to_parcels(
    features: DataFrame, areas: DataFrame, strict_flag: bool = False, cell: float = 0.05
) -> DataFrame:
    """Clip features to their area box and map their properties to parcel columns.

    ``features`` has ``pos`` and ``feature`` (and ``aoi`` when collections belong to areas); ``areas`` has
    ``aoi, minx..maxy, provider``. Features meet areas by grid cells of ``cell`` coordinate units. Parts
    without area are dropped; polygons of one MultiPolygon share their parcel id.
    """
    c = F.col
    # Coordinates come as text, since their depth follows the type; a MultiPolygon gives one row per polygon.
    text, one, many = c("feature.geometry.coordinates"), "array<array<array<double>>>", "array<array<array<array<double>>>>"
    polygons = F.when(c("feature.geometry.type") == "MultiPolygon", F.from_json(text, many)).otherwise(F.array(F.from_json(text, one)))
    rings = G.from_geojson_coordinates(c("__polygon"))
    boxed = features.withColumn("__polygon", F.explode(polygons)).withColumn("__rings", rings).withColumn("__b", G.bounds(c("__rings"))).select("*", "__b.*").drop("__b")
    on = ["aoi"] if "aoi" in features.columns else []
    near = candidate_pairs(boxed, areas.select("aoi", "minx", "miny", "maxx", "maxy", "provider"), on, cell)
    clipped = near.withColumn(
        "geom", G.clip_polygon_to_box(c("__rings"), c("r_minx"), c("r_miny"), c("r_maxx"), c("r_maxy"))
    ).where(F.size("geom") > 0)

    def prop(name: str):
        return c("feature.properties").getItem(name)

    by_words = S.farmland_by_words(*[prop(p) for p in S.LANDUSE_PROPERTIES])
    has_flag = F.map_contains_key(c("feature.properties"), "is_farmland")
    return clipped.select(
        F.coalesce(
            S.first_truthy(prop("parcel_id"), prop("landcode")), F.concat(c("aoi"), F.lit("-gj-"), c("pos").cast("string"))
        ).alias("parcel_id"),
        "aoi",
        S.first_truthy(prop("landcode"), prop("地號")).alias("landcode"),
        S.first_truthy(prop("sectname"), prop("段名")).alias("sectname"),
        prop("sectcode").alias("sectcode"),
        S.first_truthy(prop("landuse_code"), prop("編定")).alias("landuse_code"),
        F.when(F.coalesce(has_flag, F.lit(False)), S.truthy(prop("is_farmland"), strict_flag))
        .otherwise(F.coalesce(by_words, F.lit(False)))
        .alias("is_farmland"),
        c("provider").alias("source"),
        "geom",
    )


def _geojson_provider(spark: SparkSession, areas: DataFrame, path: str | None, crs: str) -> DataFrame:
    if not path:
        raise ValueError("this provider needs a path")
    return features_to_parcels(read_collections(spark, path), areas)


PROVIDERS: dict[str, Callable] = {
    "synthetic": lambda spark, areas, path, crs: grid_parcels(areas, crs),
    "geojson": _geojson_provider,
    "landuse": _geojson_provider,
}


def load_parcels(
    spark: SparkSession, areas: DataFrame, provider: str, path: str | None, crs: str, fallback: bool = True
) -> DataFrame:
    """Parcels of one provider; when it fails and ``fallback`` is allowed, the grid (its rows keep
    ``source = 'synthetic'``)."""
    if provider not in PROVIDERS:
        if fallback:
            return grid_parcels(areas, crs)
        raise ValueError(f"unknown parcel provider: {provider}")
    try:
        return PROVIDERS[provider](spark, areas, path, crs)
    except Exception:
        if not fallback:
            raise
        return grid_parcels(areas, crs)


def farmland_stats(parcels: DataFrame) -> DataFrame:
    return parcels.groupBy("aoi").agg(
        F.count("*").alias("n_parcels"),
        F.count_if("is_farmland").alias("n_farmland"),
        (F.count_if("is_farmland") / F.count("*")).alias("farmland_fraction"),
    )
