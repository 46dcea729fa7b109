"""Scene catalogue: search by window, box and cloud; least cloudy scene per window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tag_windows(catalog: DataFrame, windows: list[tuple[str, str, str]], ts: str = "dt") -> DataFrame:
    """Add ``t_label`` of the date window (whole days, both ends included) a scene falls into."""
    label = F.lit(None).cast("string")
    for name, start, end in windows:
        inside = (F.col(ts) >= F.lit(start).cast("timestamp_ntz")) & (
            F.col(ts) < F.date_add(F.lit(end).cast("date"), 1).cast("timestamp_ntz")
        )
        label = F.when(inside, name).otherwise(label)
    return catalog.withColumn("t_label", label).where("t_label IS NOT NULL")


def search(
    catalog: DataFrame, windows: list[tuple[str, str, str]], max_cloud: float, areas: DataFrame | None = None
) -> DataFrame:
    """Scenes in a window with cloud below the limit (strict; unknown cloud fails) whose box meets the
    area's box (``aoi, aminx, aminy, amaxx, amaxy``)."""
    hits = tag_windows(catalog, windows).where(F.col("cloud_cover") < F.lit(max_cloud))
    if areas is None:
        return hits
    meets = "minx <= amaxx AND aminx <= maxx AND miny <= amaxy AND aminy <= maxy"
    return hits.join(areas, "aoi").where(meets).drop("aminx", "aminy", "amaxx", "amaxy")


def best_scene(hits: DataFrame, tie: str = "item_id") -> DataFrame:
    """Least cloudy scene per (aoi, t_label); unknown cloud counts as 100."""
    rest = [c for c in hits.columns if c not in ("aoi", "t_label")]
    rank = F.struct(F.coalesce("cloud_cover", F.lit(100.0)), F.col(tie))
    return hits.groupBy("aoi", "t_label").agg(F.min_by(F.struct(*rest), rank).alias("s")).select("aoi", "t_label", "s.*")


def read_catalog(spark, path: str) -> DataFrame:
    """Catalogue pages stored as JSON lines."""
    schema = (
        "item_id STRING, aoi STRING, dt TIMESTAMP_NTZ, cloud_cover DOUBLE, "
        "minx DOUBLE, miny DOUBLE, maxx DOUBLE, maxy DOUBLE"
    )
    return spark.read.schema(schema).json(path)
