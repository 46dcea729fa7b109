"""Raster windows as tile tables partitioned by (aoi, t_label), with a manifest table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.functions.geometry import box_ring
from fieldlens.functions.projection import WGS84, project_ring
from fieldlens.functions.scalars import date_prefix
from fieldlens.operators.raster import check_same_grid
from fieldlens.operators.tables import replace_partitions
from fieldlens.schemas import MANIFEST, RASTER_TILES


def read_tiles(spark: SparkSession, path: str, aoi: str | None = None, t_label: str | None = None) -> DataFrame:
    """All tiles, or those of one area / date: both filters prune partitions."""
    df = spark.read.schema(RASTER_TILES).parquet(path)
    if aoi is not None:
        df = df.where(F.col("aoi") == aoi)
    return df.where(F.col("t_label") == t_label) if t_label is not None else df


def write_window(tiles: DataFrame, manifest: DataFrame, path: str, manifest_path: str) -> None:
    """Replace the windows contained in ``tiles``; their manifest rows follow the data."""
    replace_partitions(tiles.sortWithinPartitions("tile_r", "tile_c"), path, ["aoi", "t_label"])
    replace_partitions(manifest, manifest_path, ["aoi", "t_label"])


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(path)


def window_dates(manifest: DataFrame) -> DataFrame:
    """``aoi, t0_date, t1_date``: first ten characters of each date, empty when unknown."""
    day = date_prefix(F.col("datetime"))
    return manifest.groupBy("aoi").agg(
        F.coalesce(F.max(F.when(F.col("t_label") == "t0", day)), F.lit("")).alias("t0_date"),
        F.coalesce(F.max(F.when(F.col("t_label") == "t1", day)), F.lit("")).alias("t1_date"),
    )


def area_grids(manifest: DataFrame) -> DataFrame:
    """Grid of every area with both dates: ``aoi, h, w, a, c, e, f, t0_date, t1_date``; differing grids raise."""
    place = manifest.groupBy("aoi").agg(F.first("transform").alias("t"))
    at = lambda k, name: F.element_at("t", k).alias(name)
    same = check_same_grid(manifest).join(place, "aoi").join(window_dates(manifest), "aoi")
    return same.select("aoi", "h", "w", at(1, "a"), at(3, "c"), at(5, "e"), at(6, "f"), "t0_date", "t1_date")


def windows_present(areas: DataFrame, manifest: DataFrame) -> DataFrame:
    """Areas and dates that have a stored window."""
    return areas.join(manifest.select("aoi", "t_label").distinct(), "aoi", "left_semi")


def grid_from_bbox(
    areas: DataFrame, crs: str, resolution: float = 10.0, smallest: int = 1, densify: bool = False
) -> DataFrame:
    """Grid of an area box (``minx..maxy`` in degrees): size and north-up transform.

    The box edges are projected by their corners, or with 21 points per edge when ``densify`` is set
    (edges bend in the projection).
    """
    c = F.col
    if densify:
        k = F.sequence(F.lit(0), F.lit(20))
        fx = F.transform(k, lambda i: c("minx") + (c("maxx") - c("minx")) * i / 20)
        fy = F.transform(k, lambda i: c("miny") + (c("maxy") - c("miny")) * i / 20)
        edges = [
            F.transform(fx, lambda x: F.struct(x.alias("x"), c("miny").alias("y"))),
            F.transform(fx, lambda x: F.struct(x.alias("x"), c("maxy").alias("y"))),
            F.transform(fy, lambda y: F.struct(c("minx").alias("x"), y.alias("y"))),
            F.transform(fy, lambda y: F.struct(c("maxx").alias("x"), y.alias("y"))),
        ]
        ring = F.concat(*edges)
    else:
        ring = box_ring(c("minx"), c("miny"), c("maxx"), c("maxy"))
    at = areas.withColumn("__p", project_ring(ring, WGS84, crs))
    xs, ys = F.transform("__p", lambda p: p["x"]), F.transform("__p", lambda p: p["y"])
    at = at.withColumns(
        {"gx0": F.array_min(xs), "gy0": F.array_min(ys), "gx1": F.array_max(xs), "gy1": F.array_max(ys)}
    )

    def count(low: str, high: str):
        return F.greatest(F.lit(smallest), F.bround((c(high) - c(low)) / resolution, 0).cast("int"))

    at = at.withColumns({"w": count("gx0", "gx1"), "h": count("gy0", "gy1")})
    return at.select(
        *areas.columns, "h", "w",
        ((c("gx1") - c("gx0")) / c("w")).alias("a"), c("gx0").alias("c"),
        ((c("gy0") - c("gy1")) / c("h")).alias("e"), c("gy1").alias("f"),
        "gx0", "gy0", "gx1", "gy1",
    )
