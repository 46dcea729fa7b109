"""Known-site records: radius and box selection, radius ladder, normalisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlens.functions.scalars import blank_to_null, haversine_km

# Smaller radii (km) tried after the configured one.
LADDER_KM = (5.0, 3.0, 1.0)
UPDATE_COLUMNS = ["display_number", "name", "landcode", "status", "reported_at", "lon", "lat"]


def distance_to_center(records: DataFrame, areas: DataFrame) -> DataFrame:
    """Records joined with their area; adds ``dist_km`` from the area centre. Null positions drop out."""
    joined = records.where("lng IS NOT NULL AND lat IS NOT NULL").join(areas, "aoi")
    return joined.withColumn(
        "dist_km", haversine_km(F.col("center_lon"), F.col("center_lat"), F.col("lng"), F.col("lat"))
    )


def in_box() -> Column:
    return F.col("lng").between(F.col("minx"), F.col("maxx")) & F.col("lat").between(F.col("miny"), F.col("maxy"))


def around_center(records: DataFrame, areas: DataFrame) -> DataFrame:
    """Records within the configured range of the centre and inside the box (inclusive)."""
    return distance_to_center(records, areas).where(F.col("dist_km") <= F.col("range_km")).where(in_box())


def ladder(configured: Column) -> Column:
    """Radii to try, largest first, never above the configured one."""
    steps = F.array(configured, *[F.lit(v) for v in LADDER_KM])
    return F.sort_array(F.array_distinct(F.filter(steps, lambda v: v <= configured)), asc=False)


def first_answered(records: DataFrame, areas: DataFrame, answered: DataFrame) -> DataFrame:
    """Records of the first radius of the ladder that was answered, even when it was empty.

    ``answered`` holds ``aoi, range_km`` of the answers that arrived.
    """
    tried = areas.select("aoi", F.explode(ladder(F.col("range_km"))).alias("range_km"))
    picked = tried.join(answered, ["aoi", "range_km"], "left_semi").groupBy("aoi").agg(F.max("range_km").alias("range_km"))
    return around_center(records, areas.drop("range_km").join(picked, "aoi"))


def normalise(records: DataFrame) -> DataFrame:
    return records.withColumn("name", blank_to_null(F.col("name")))
