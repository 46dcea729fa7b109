"""Raster queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldlens.functions import spectral as X
from fieldlens.operators import components as C
from fieldlens.operators import raster as R
from fieldlens.operators import tiles as TL
from fieldlens.operators.outlines import outline_stats
from fieldlens.plans import detect as D
from fieldlens.plans import imagery as IM
from fieldlens.plans import inputs as I
from fieldlens.plans import oracle_inputs as O
from fieldlens.plans.registry import query
from fieldlens.functions.projection import WGS84, project_points
from fieldlens.sources.rasters import grid_from_bbox

AOI = ["aoi"]


def rc():
    return [F.col("row").cast("long").alias("px_row"), F.col("col").cast("long").alias("px_col")]


def changed(spark, d):
    return R.index_change(I.pixels(spark, d))


def masked(spark, d):
    return R.change_mask(changed(spark, d), I.NDBI_MIN, I.NDVI_MIN)


def opened(spark, d):
    return R.binary_open(masked(spark, d), R.grid_extents(I.pixels(spark, d), AOI), AOI, ["ndbi_delta", "ndvi_drop"])


@query("nd_index", f"""WITH {O.PX}
SELECT aoi, r AS px_row, c AS px_col, round({O.nd('b08_t0', 'b04_t0')}, 6) AS ndvi_t0, round({O.nd('b11_t0', 'b08_t0')}, 6) AS ndbi_t0,
 round({O.nd('b08_t1', 'b04_t1')}, 6) AS ndvi_t1, round({O.nd('b11_t1', 'b08_t1')}, 6) AS ndbi_t1 FROM px""")
def nd_index(spark, d):
    c = F.col
    return I.pixels(spark, d).select(
        "aoi", *rc(),
        F.round(X.ndvi(c("b08_t0"), c("b04_t0")), 6).alias("ndvi_t0"),
        F.round(X.ndbi(c("b11_t0"), c("b08_t0")), 6).alias("ndbi_t0"),
        F.round(X.ndvi(c("b08_t1"), c("b04_t1")), 6).alias("ndvi_t1"),
        F.round(X.ndbi(c("b11_t1"), c("b08_t1")), 6).alias("ndbi_t1"),
    )


@query("change_mask", f"""WITH {O.IDX}
SELECT aoi, count(*) AS n_pixels, count(*) FILTER (dn >= 0.06 AND dv >= 0.12) AS n_flagged,
 round(sum(CASE WHEN dn >= 0.06 AND dv >= 0.12 THEN dn END), 6) AS sum_delta FROM idx GROUP BY aoi""")
def change_mask(spark, d):
    """On stored tile pairs: three arrays a date, no row per pixel."""
    counts = TL.change_counts(IM.pairs(spark, d), AOI, I.NDBI_MIN, I.NDVI_MIN)
    return counts.groupBy("aoi").agg(
        F.sum("n_pixels").alias("n_pixels"), F.sum("n_flagged").alias("n_flagged"),
        F.round(F.sum(F.when(F.col("n_flagged") > 0, F.col("sum_delta"))), 6).alias("sum_delta"),
    )


@query("confidence_score", f"""WITH {O.MASK}
SELECT aoi, r AS px_row, c AS px_col, round({O.CONF.replace('md', 'dn').replace('mv', 'dv')}, 6) AS confidence FROM mask""")
def confidence_score(spark, d):
    return masked(spark, d).select("aoi", *rc(), F.round(X.confidence(F.col("ndbi_delta"), F.col("ndvi_drop")), 6).alias("confidence"))


_STORED = f"""{O.PX},
st AS (SELECT aoi, r, c, 't0' AS t_label, unnest([b04_t0, b08_t0, b11_t0]) AS v, unnest(['B04', 'B08', 'B11']) AS band FROM px
 UNION ALL SELECT aoi, r, c, 't1', unnest([b04_t1, b08_t1, b11_t1, b04_t1 + 0.01::DOUBLE]), unnest(['B04', 'B08', 'B11', 'B03']) FROM px
 UNION ALL SELECT aoi, r, c, 't1', b04_t1 - 0.02::DOUBLE, 'B02' FROM px WHERE k % 2 = 0)"""


@query("raster_scan", f"""WITH {_STORED}
SELECT aoi, t_label, band, count(*) AS n_px, min(v) AS low, max(v) AS high, round(avg(v), 6) AS mean FROM st GROUP BY ALL""")
def raster_scan(spark, d):
    """All bands of all stored windows."""
    by = ["aoi", "t_label", "band"]
    return TL.band_stats(IM.tiles(spark, d), by[:2], IM.BANDS).groupBy(*by).agg(
        F.sum("n_px").alias("n_px"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.round(F.sum("total") / F.sum("n_px"), 6).alias("mean"),
    )


@query("binary_open", f"WITH {O.OPEN} SELECT aoi, r AS px_row, c AS px_col FROM op")
def binary_open(spark, d):
    return opened(spark, d).select("aoi", *rc())


_TILES = f"""{O.PX}, ext AS (SELECT aoi, max(r) + 1 AS hh, max(c) + 1 AS ww FROM px GROUP BY aoi),
tr AS (SELECT *, unnest(range(0, hh, {I.TILE_PX})) AS r0 FROM ext),
tg AS (SELECT *, unnest(range(0, ww, {I.TILE_PX})) AS c0 FROM tr)"""


@query("tile_grid", f"""WITH {_TILES}
SELECT aoi, r0, least(r0 + {I.TILE_PX}, hh) AS r1, c0, least(c0 + {I.TILE_PX}, ww) AS c1 FROM tg""")
def tile_grid(spark, d):
    grid = R.tile_grid(R.grid_extents(I.pixels(spark, d), AOI), I.TILE_PX, AOI)
    return grid.select("aoi", *[F.col(n).cast("long").alias(n) for n in ("r0", "r1", "c0", "c1")])


@query("tile_coverage", f"""WITH {_TILES}
SELECT p.aoi, count(*) AS n_pixels, count(t.r0) AS n_covered, count(*) - count(t.r0) AS n_missing
FROM px p LEFT JOIN tg t ON t.aoi = p.aoi AND p.r >= t.r0 AND p.r < t.r0 + {I.TILE_PX} AND p.c >= t.c0 AND p.c < t.c0 + {I.TILE_PX}
GROUP BY p.aoi""")
def tile_coverage(spark, d):
    """The pixels of all tiles, taken from all pixels, must leave nothing."""
    px = I.pixels(spark, d).select("aoi", "row", "col")
    tiles = R.tile_grid(R.grid_extents(px, AOI), I.TILE_PX, AOI)
    cells = (
        tiles.withColumn("row", F.explode(F.sequence(F.col("r0"), F.col("r1") - 1)))
        .withColumn("col", F.explode(F.sequence(F.col("c0"), F.col("c1") - 1)))
        .select("aoi", "row", "col")
    )
    left = px.exceptAll(cells).groupBy("aoi").agg(F.count("*").alias("n_missing"))
    return (
        px.groupBy("aoi").agg(F.count("*").alias("n_pixels")).join(left, "aoi", "left")
        .withColumn("n_missing", F.coalesce("n_missing", F.lit(0).cast("long")))
        .select("aoi", "n_pixels", (F.col("n_pixels") - F.col("n_missing")).alias("n_covered"), "n_missing")
    )


_STATS = "JOIN mask m USING (aoi, r, c) GROUP BY aoi, component"


@query("components", f"""WITH RECURSIVE {O.OPEN}, {O.components('op')}
SELECT aoi, component, count(*) AS n_px, min(r) AS min_row, max(r) AS max_row, min(c) AS min_col, max(c) AS max_col
FROM comp GROUP BY aoi, component""")
def components(spark, d):
    strips = C.label_strips(opened(spark, d), AOI)
    return C.component_stats(strips, AOI)


@query("zonal_stats", f"""WITH RECURSIVE {O.OPEN}, {O.components('op')}
SELECT aoi, component, count(*) AS n_px, round(avg(dn), 6) AS ndbi_delta, round(avg(dv), 6) AS ndvi_drop FROM comp {_STATS}""")
def zonal_stats(spark, d):
    values = ["ndbi_delta", "ndvi_drop"]
    stats = C.component_stats(C.label_strips(opened(spark, d), AOI, values), AOI, values)
    return stats.select("aoi", "component", "n_px", *[F.round(v, 6).alias(v) for v in values])


@query("outline_stats", f"""WITH RECURSIVE {O.OPEN}, {O.components('op')},
nb AS (SELECT a.aoi, a.component, count(b.r) AS shared FROM comp a CROSS JOIN (VALUES (1, 0), (-1, 0), (0, 1), (0, -1)) d(dr, dc)
 LEFT JOIN comp b ON b.aoi = a.aoi AND b.r = a.r + dr AND b.c = a.c + dc GROUP BY a.aoi, a.component)
SELECT aoi, component, 4 * n - shared AS perimeter_px, n AS area_px
FROM nb JOIN (SELECT aoi, component, count(*) AS n FROM comp GROUP BY ALL) USING (aoi, component)""")
def outline(spark, d):
    """Ring outlines of the regions: total edge length and signed ring area per region."""
    return outline_stats(C.label_strips(opened(spark, d), AOI), AOI)


def _ranked(comp_cte: str) -> str:
    return f"""st AS (SELECT aoi, component, {comp_cte} count(*) AS n_px, count(*) * 100.0::DOUBLE AS area_m2, avg(dn) AS md, avg(dv) AS mv,
  min(r) AS min_row FROM comp JOIN mask m USING (aoi, r, c) GROUP BY ALL HAVING count(*) * 100 >= 400),
rk AS (SELECT *, round({O.CONF}, 9) AS conf FROM st)
SELECT aoi, component, n_px, area_m2, round(md, 6) AS ndbi_delta, round(mv, 6) AS ndvi_drop, round(conf, 6) AS confidence,
 row_number() OVER (PARTITION BY aoi ORDER BY conf DESC, area_m2 DESC, component) AS rank
FROM rk QUALIFY rank <= {I.MAX_CANDIDATES}"""


def _shown(found):
    return found.select(
        "aoi", "component", "n_px", "area_m2", F.round("ndbi_delta", 6).alias("ndbi_delta"),
        F.round("ndvi_drop", 6).alias("ndvi_drop"), F.round("confidence", 6).alias("confidence"),
        F.col("rank").cast("long").alias("rank"),
    )


@query("detect_spectral", f"WITH RECURSIVE {O.OPEN}, {O.components('op')}, {_ranked('')}")
def detect_spectral(spark, d):
    return _shown(D.detect_tile_pairs(IM.pairs(spark, d), AOI, D.Settings(pixel_area=I.PIXEL_AREA_M2)).detections)


@query("detect_tiled", f"WITH RECURSIVE {O.MASK}, {O.components('mask', I.TILE_PX)}, {_ranked('')}")
def detect_tiled(spark, d):
    settings = D.Settings(pixel_area=I.PIXEL_AREA_M2, tile_px=I.TILE_PX)
    return _shown(D.detect_tile_pairs(IM.pairs(spark, d), AOI, settings, tiled=True).detections)


_POINTS = f"{O.RECORDS}, pts AS (SELECT id, aoi, lng, lat FROM re WHERE lng IS NOT NULL)"


@query("lonlat_to_pixel", f"""WITH {_POINTS}, {O.forward('pts', 'pj', [('lng', 'lat', 'x', 'y')])}
SELECT id, CAST(trunc((y - 2672000) / -10) AS BIGINT) AS px_row, CAST(trunc((x - 195000) / 10) AS BIGINT) AS px_col FROM pj""")
def lonlat_to_pixel(spark, d):
    pts = I.site_records(spark, d).where("lng IS NOT NULL")
    at = project_points(pts, "lng", "lat", WGS84, "EPSG:3826", ("x", "y"))
    return at.select(
        "id", ((F.col("y") - 2672000.0) / -10.0).cast("long").alias("px_row"),
        ((F.col("x") - 195000.0) / 10.0).cast("long").alias("px_col"),
    )


_CORNERS = [("minx", "miny", "x0", "y0"), ("maxx", "miny", "x1", "y1"), ("maxx", "maxy", "x2", "y2"), ("minx", "maxy", "x3", "y3")]


@query("grid_from_bbox", f"""WITH {_POINTS}, bb AS (SELECT aoi, min(lng) AS minx, min(lat) AS miny, max(lng) AS maxx, max(lat) AS maxy
 FROM pts GROUP BY aoi), {O.forward('bb', 'pj', _CORNERS)},
g AS (SELECT aoi, least(x0, x1, x2, x3) AS gx0, least(y0, y1, y2, y3) AS gy0, greatest(x0, x1, x2, x3) AS gx1, greatest(y0, y1, y2, y3) AS gy1 FROM pj),
s AS (SELECT *, greatest(1, CAST(round_even((gx1 - gx0) / 10, 0) AS BIGINT)) AS w, greatest(1, CAST(round_even((gy1 - gy0) / 10, 0) AS BIGINT)) AS h FROM g)
SELECT aoi, w, h, round((gx1 - gx0) / w, 6) AS a, round(gx0, 3) AS c, round((gy0 - gy1) / h, 6) AS e, round(gy1, 3) AS f FROM s""")
def grid_of_points(spark, d):
    box = I.site_records(spark, d).where("lng IS NOT NULL").groupBy("aoi").agg(
        F.min("lng").alias("minx"), F.min("lat").alias("miny"), F.max("lng").alias("maxx"), F.max("lat").alias("maxy")
    )
    g = grid_from_bbox(box, "EPSG:3826")
    return g.select(
        "aoi", F.col("w").cast("long").alias("w"), F.col("h").cast("long").alias("h"), F.round("a", 6).alias("a"),
        F.round("c", 3).alias("c"), F.round("e", 6).alias("e"), F.round("f", 3).alias("f"),
    )


def _raster_origin(k: str, y_div: str) -> tuple[str, str]:
    return I.aoi_x(k), I.aoi_y(k, y_div)


@query("raster_crop", f"""WITH {O.PX}, {O.SITES},
ext AS (SELECT aoi, k, max(r) + 1 AS hh, max(c) + 1 AS ww FROM px GROUP BY aoi, k),
bd AS (SELECT aoi, min(px) + 1000 AS bx0, max(px) - 1000 AS bx1, max(py) - 2000 AS by0, max(py) AS by1 FROM si GROUP BY aoi),
wi AS (SELECT aoi, hh, ww, greatest(0, trunc((bx0 - {I.aoi_x('k')}) / 100.0)) AS c0, least(ww, trunc((bx1 - {I.aoi_x('k')}) / 100.0)) AS c1,
  greatest(0, trunc((by1 - {I.aoi_y('k', '//')}) / -100.0)) AS r0, least(hh, trunc((by0 - {I.aoi_y('k', '//')}) / -100.0)) AS r1 FROM ext LEFT JOIN bd USING (aoi)),
w2 AS (SELECT *, bx IS NOT NULL AND r1 > r0 AND c1 > c0 AS ok FROM (SELECT wi.*, bd.bx0 AS bx FROM wi LEFT JOIN bd USING (aoi)))
SELECT p.aoi, p.r AS px_row, p.c AS px_col, p.b04_t1 AS value FROM px p JOIN w2 USING (aoi)
WHERE NOT coalesce(ok, false) OR (p.r >= r0 AND p.r < r1 AND p.c >= c0 AND p.c < c1)""")
def raster_crop(spark, d):
    """Parts of stored tiles inside the window of their area."""
    ext = IM.extents(spark, d).withColumn("k", F.substring("aoi", 2, 9).cast("long"))
    bound = I.sites(spark, d).groupBy("aoi").agg(
        F.struct(
            (F.min("px") + 1000).alias("minx"), (F.max("py") - 2000).alias("miny"),
            (F.max("px") - 1000).alias("maxx"), F.max("py").alias("maxy"),
        ).alias("b")
    )
    x, y = (F.expr(e).cast("double") for e in _raster_origin("k", "div"))
    side = F.lit(float(I.PIXEL_SIDE))
    win = R.window_of_bounds(side, x, -side, y, F.col("h"), F.col("w"), F.col("b"))
    windows = ext.join(bound, "aoi", "left").withColumn("win", win).select("aoi", "h", "w", "win.*")
    later = IM.tiles(spark, d).where("t_label = 't1'").select("aoi", *TL.TILE, *TL.PLACE, "b04")
    parts = TL.crop_tiles(later, windows, ["b04"], I.TILE_PX)
    return TL.pixel_rows(parts, AOI, ["b04"]).select("aoi", *rc(), F.col("b04").alias("value"))


@query("bilinear_regrid", f"""WITH {O.PX}, ext AS (SELECT aoi, max(r) + 1 AS hh, max(c) + 1 AS ww FROM px GROUP BY aoi),
tr AS (SELECT *, unnest(range(0, hh * 2)) AS tr FROM ext), tg AS (SELECT *, unnest(range(0, ww * 2)) AS tc FROM tr),
po AS (SELECT *, (tr + 0.5::DOUBLE) / 2 - 0.5::DOUBLE AS y, (tc + 0.5::DOUBLE) / 2 - 0.5::DOUBLE AS x FROM tg),
nb AS (SELECT aoi, tr, tc, x, y, CAST(floor(y) AS BIGINT) + dr AS r, CAST(floor(x) AS BIGINT) + dc AS c FROM po, (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) d(dr, dc))
SELECT nb.aoi, tr AS px_row, tc AS px_col, round(coalesce(sum(b11_t1 * (1 - abs(y - nb.r)) * (1 - abs(x - nb.c))), 0), 9) AS value
FROM nb LEFT JOIN px USING (aoi, r, c) GROUP BY nb.aoi, tr, tc""")
def bilinear_regrid(spark, d):
    return _resampled(spark, d, "2 * h", "2 * w", 0.5, 0.5, 0.0, 0.0)


def _resampled(spark, d, th, tw, sy, sx, oy, ox):
    areas = IM.extents(spark, d).selectExpr(
        "aoi", "h", "w", f"cast({th} AS int) AS th", f"cast({tw} AS int) AS tw", f"{sy}D AS sy", f"{sx}D AS sx", f"{oy}D AS oy", f"{ox}D AS ox")
    later = IM.tiles(spark, d).where("t_label = 't1'")
    fine = TL.resample_tiles(later, areas, ["b11"], I.TILE_PX)
    return TL.pixel_rows(fine, AOI, ["b11"]).select("aoi", *rc(), F.round("b11", 9).alias("value"))


# Steps and offsets of a grid that is finer in one direction, coarser in the other, shifted, and reaches beyond the source.
_RESAMPLE = {"th": "h * 3 div 2 + 1", "tw": "w div 2 + 1", "sy": 0.7, "sx": 2.6, "oy": -1.35, "ox": 4.2}


def _taps(axis: str, size: str) -> str:
    step, off = (f"{_RESAMPLE[n + axis]}::DOUBLE" for n in ("s", "o"))
    reach = f"greatest(1.0::DOUBLE, {step})"
    centre = f"((i + 0.5::DOUBLE) * {step} + {off})"
    n = _RESAMPLE["th" if axis == "y" else "tw"].replace("h *", "hh *").replace("w div", "ww div").replace("div", "//")
    return f"""t{axis}0 AS (SELECT aoi, hh, ww, unnest(range(CAST({n} AS BIGINT))) AS i FROM ext),
t{axis}1 AS (SELECT *, unnest(range(CAST(floor({centre} - 0.5 - {reach}) AS BIGINT), CAST(ceil({centre} - 0.5 + {reach}) AS BIGINT) + 1)) AS u FROM t{axis}0),
t{axis}2 AS (SELECT aoi, {size}, i, u, greatest(0.0::DOUBLE, 1 - abs(u + 0.5::DOUBLE - {centre}) / {reach}) AS wt FROM t{axis}1),
t{axis} AS (SELECT aoi, i, u, wt / sum(wt) OVER (PARTITION BY aoi, i) AS wt FROM t{axis}2)"""


@query("resample_grid", f"""WITH {O.PX}, ext AS (SELECT aoi, max(r) + 1 AS hh, max(c) + 1 AS ww FROM px GROUP BY aoi),
{_taps('y', 'hh')}, {_taps('x', 'ww')},
along AS (SELECT p.aoi, ty.i, p.c, sum(ty.wt * p.b11_t1) AS v FROM px p JOIN ty ON ty.aoi = p.aoi AND ty.u = p.r GROUP BY p.aoi, ty.i, p.c),
hit AS (SELECT l.aoi, l.i, tx.i AS j, sum(tx.wt * l.v) AS v FROM along l JOIN tx ON tx.aoi = l.aoi AND tx.u = l.c GROUP BY l.aoi, l.i, tx.i),
cells AS (SELECT a.aoi, a.i, b.i AS j FROM (SELECT DISTINCT aoi, i FROM ty) a JOIN (SELECT DISTINCT aoi, i FROM tx) b USING (aoi))
SELECT aoi, i AS px_row, j AS px_col, round(coalesce(v, 0), 9) AS value FROM cells LEFT JOIN hit USING (aoi, i, j)""")
def resample_grid(spark, d):
    """Any target grid: shifted, finer along columns, coarser along rows (widened kernel), partly outside the source."""
    return _resampled(spark, d, **_RESAMPLE)


def _stretch(v: str) -> str:
    lim = "CASE WHEN hi <= lo THEN lo + 1e-6 ELSE hi END"
    return f"CAST(trunc(greatest(0, least(255, ({v} - lo) / ({lim} - lo) * 255))) AS BIGINT)"


@query("percentile_stretch", f"""WITH {O.PX},
li AS (SELECT aoi, quantile_cont(b04_t1, 0.02) AS lo, quantile_cont(b04_t1, 0.98) AS hi FROM px GROUP BY aoi)
SELECT aoi, {_stretch('b04_t1')} AS level, count(*) AS n FROM px JOIN li USING (aoi) GROUP BY ALL""")
def percentile_stretch(spark, d):
    later, ext = IM.tiles(spark, d).where("t_label = 't1'"), IM.extents(spark, d)
    limits = TL.tile_percentiles(later, ext, AOI, ["b04"], {"lo": 0.02, "hi": 0.98}, I.TILE_PX)
    levels = TL.stretch_tiles(later, ext, limits, AOI, ["b04"], I.TILE_PX)
    # Cells without data are 0 in the picture; only pixels with data are counted here.
    both = levels.join(later.select("aoi", *TL.TILE, F.col("b04").alias("v")), ["aoi", *TL.TILE])
    cells = both.select("aoi", F.explode(F.arrays_zip("b04", "v")).alias("x")).where("x.v IS NOT NULL")
    return cells.groupBy("aoi", F.col("x.b04").cast("long").alias("level")).agg(F.count("*").alias("n"))


@query("rgb_composite", f"""WITH {O.PX},
bs AS (SELECT aoi, r, c, unnest(CASE WHEN k % 2 = 0 THEN [b04_t1, b04_t1 + 0.01::DOUBLE, b04_t1 - 0.02::DOUBLE] ELSE [b04_t1, b04_t1, b04_t1] END) AS v,
 unnest(['red', 'green', 'blue']) AS band FROM px),
li AS (SELECT aoi, band, quantile_cont(v, 0.02) AS lo, quantile_cont(v, 0.98) AS hi FROM bs GROUP BY ALL),
sv AS (SELECT aoi, r, c, band, {_stretch('v')} AS level FROM bs JOIN li USING (aoi, band))
SELECT aoi, r AS px_row, c AS px_col, max(level) FILTER (band = 'red') AS red, max(level) FILTER (band = 'green') AS green,
 max(level) FILTER (band = 'blue') AS blue FROM sv GROUP BY aoi, r, c""")
def rgb_composite(spark, d):
    """Stored bands of the later date; windows without a blue band show their first band three times."""
    rgb, ext = TL.rgb_tiles(IM.tiles(spark, d).where("t_label = 't1'")), IM.extents(spark, d)
    bands = ["red", "green", "blue"]
    limits = TL.tile_percentiles(rgb, ext, AOI, bands, {"lo": 0.02, "hi": 0.98}, I.TILE_PX)
    levels = TL.stretch_tiles(rgb, ext, limits, AOI, bands, I.TILE_PX)
    seen = rgb.select("aoi", *TL.TILE, F.col("red").alias("seen"))
    shown = TL.pixel_rows(levels.join(seen, ["aoi", *TL.TILE]), AOI, [*bands, "seen"]).where("seen IS NOT NULL")
    return shown.select("aoi", *rc(), *[F.col(b).cast("long").alias(b) for b in bands])
