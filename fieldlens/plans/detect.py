"""Change detectors: pixels of two dates to ranked candidate regions."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlens.functions.geometry import box_ring, signed_area
from fieldlens.functions.projection import WGS84, project_ring
from fieldlens.functions.spectral import confidence
from fieldlens.operators import raster as R
from fieldlens.operators import tiles as TL
from fieldlens.operators.components import DEFAULT_BLOCK, component_stats, label_strips
from fieldlens.operators.ranking import top_per_group

VALUES = ["ndbi_delta", "ndvi_drop"]


@dataclass(frozen=True)
class Settings:
    ndbi_delta_min: float = 0.06
    ndvi_drop_min: float = 0.12
    min_area_m2: float = 400.0
    morph_open_iter: int = 1
    max_candidates: int = 500
    tile_px: int = 128
    pixel_area: float | None = None
    edge: str = "wrap"
    block: int = DEFAULT_BLOCK
    mask_nodata: bool = False


@dataclass
class Detected:
    """Ranked regions and the row runs (``component``, ``row``, ``c0``, ``c1``) they are made of."""

    detections: DataFrame
    strips: DataFrame


def strip_area(a: Column, c: Column, e: Column, f: Column, crs: str, working_crs: str) -> Column:
    """Area in m2 of one row run on a north-up grid, measured in the working CRS after a round through
    lon/lat when the raster has another CRS."""
    if crs == working_crs:
        return F.col("n_px") * F.abs(a * e)
    x0, x1 = c + F.col("c0") * a, c + (F.col("c1") + 1) * a
    y0, y1 = f + F.col("row") * e, f + (F.col("row") + 1) * e
    ring = project_ring(project_ring(box_ring(x0, y0, x1, y1), crs, WGS84), WGS84, working_crs)
    return F.abs(signed_area(ring))


def _rank(strips: DataFrame, keys: list[str], s: Settings, area: Column | None, placed: DataFrame | None) -> Detected:
    """``placed`` (one row per area: keys, a, c, e, f) gives :func:`strip_area` the grid of every area."""
    measured = strips if placed is None else strips.join(placed, keys)
    if area is None:
        area = F.col("n_px") * F.lit(float(s.pixel_area if s.pixel_area is not None else 100.0))
    stats = component_stats(measured, keys, VALUES, area).where(F.col("area_m2") >= F.lit(s.min_area_m2))
    scored = stats.withColumn("confidence", confidence(F.col("ndbi_delta"), F.col("ndvi_drop")))
    # Many regions share the confidence ceiling: ties go to the larger, then to the first in scan order.
    order = [F.desc(F.round("confidence", 9)), F.desc("area_m2"), F.asc("component")]
    return Detected(top_per_group(scored, keys, order, s.max_candidates, "rank"), strips)


def detect_spectral(
    pixels: DataFrame, keys: list[str], s: Settings = Settings(), extents: DataFrame | None = None, area: Column | None = None,
    placed: DataFrame | None = None,
) -> Detected:
    """Whole-area detector: mask, opening, regions, zonal means, score, cap."""
    changed = R.index_change(pixels, mask_nodata=s.mask_nodata)
    mask = R.change_mask(changed, s.ndbi_delta_min, s.ndvi_drop_min)
    if s.morph_open_iter > 0:
        grid = extents if extents is not None else R.grid_extents(pixels, keys)
        mask = R.binary_open(mask, grid, keys, VALUES, s.morph_open_iter, s.edge, s.block)
    return _rank(label_strips(mask, keys, VALUES, s.block), keys, s, area, placed)


def detect_tiled(
    pixels: DataFrame, keys: list[str], s: Settings = Settings(), extents: DataFrame | None = None, area: Column | None = None,
    placed: DataFrame | None = None,
) -> Detected:
    """Tiled detector: no opening, regions end at tile borders and are measured per fragment."""
    changed = R.index_change(pixels, mask_nodata=s.mask_nodata)
    mask = R.change_mask(changed, s.ndbi_delta_min, s.ndvi_drop_min).select(*keys, "row", "col", *VALUES)
    return _rank(label_strips(mask, keys, VALUES, s.tile_px, merge=False), keys, s, area, placed)


def detect_tile_pairs(
    pairs: DataFrame, keys: list[str], s: Settings = Settings(), tiled: bool = False, area: Column | None = None,
) -> Detected:
    """Both detectors on tile pairs (:func:`fieldlens.operators.tiles.pair_dates`): the mask is computed on the arrays and carries
    the size of its grid. Columns of the grid that ``area`` uses travel as further ``keys``, so no table of areas is joined."""
    mask = TL.change_pixels(pairs, keys, s.ndbi_delta_min, s.ndvi_drop_min, s.mask_nodata)
    if tiled:
        return _rank(label_strips(mask.select(*keys, "row", "col", *VALUES), keys, VALUES, s.tile_px, merge=False), keys, s, area, None)
    if s.morph_open_iter > 0:
        mask = R.binary_open(mask, None, keys, VALUES, s.morph_open_iter, s.edge, s.block)
    return _rank(label_strips(mask, keys, VALUES, s.block), keys, s, area, None)


# Requested detector name -> (function, name of what runs).
DETECTORS: dict[str, tuple[Callable, str]] = {
    "spectral": (detect_spectral, "spectral"),
    "spectral-spark": (detect_tiled, "spectral-spark"),
    # Not provided here: runs the spectral detector under the requested name.
    "torchgeo": (detect_spectral, "spectral"),
}


def run_detector(name: str, pixels: DataFrame, keys: list[str], s: Settings = Settings(), **more) -> Detected:
    fn, used = DETECTORS.get(name, DETECTORS["spectral"])
    found = fn(pixels, keys, s, **more)
    named = found.detections.withColumns({"detector_requested": F.lit(name), "detector_used": F.lit(used)})
    return Detected(named, found.strips)
