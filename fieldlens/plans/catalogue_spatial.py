"""Geometry, spatial join and worklist queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldlens.functions import geometry as G
from fieldlens.functions import scalars as S
from fieldlens.functions.projection import WGS84, project_many, project_points
from fieldlens.operators import dossiers as DO
from fieldlens.operators import metrics as M
from fieldlens.operators import ranking as K
from fieldlens.operators import spatial as SP
from fieldlens.plans import inputs as I
from fieldlens.plans import oracle_inputs as O
from fieldlens.plans.registry import query
from fieldlens.session import spread_by
from fieldlens.sources.parcels import farmland_stats, grid_parcels

CRS = "EPSG:3826"
UNIT = I.MICRO


def farmland(spark, d):
    return I.parcels(spark, d).where("is_farmland").select(
        "aoi", "parcel_id", "landcode", "sectname", "is_farmland", "minx", "miny", "maxx", "maxy"
    )


def boxes(spark, d):
    return I.detections(spark, d)


def pairs(spark, d, crs=None):
    """Detections on farmland with their overlap."""
    return SP.intersect_boxes(boxes(spark, d), farmland(spark, d), ["aoi"], I.PARCEL_SIDE, UNIT, crs)


def nearest(spark, d):
    return SP.nearest_point(_slim(boxes(spark, d)), I.sites(spark, d), ["aoi"], ["detection_id"])


def _slim(det):
    return det.select("aoi", "run_id", "detection_id", "minx", "miny", "maxx", "maxy")


def local_distance():
    """Distance of the box to the chosen point in the local metric."""
    c = F.col
    gx = F.greatest(F.lit(0.0), c("px") - c("maxx"), c("minx") - c("px")) * F.lit(UNIT * SP.LOCAL_M_PER_DEG_LON)
    gy = F.greatest(F.lit(0.0), c("py") - c("maxy"), c("miny") - c("py")) * F.lit(UNIT * SP.LOCAL_M_PER_DEG_LAT)
    return F.sqrt(gx * gx + gy * gy)


def chosen_label(spark, d, det):
    """Label of each detection (with an area and an id) and its distance (local metric)."""
    known = _slim(det).where("aoi IS NOT NULL AND detection_id IS NOT NULL")
    return SP.nearest_point(known, I.sites(spark, d), ["aoi"], ["detection_id"]).select(
        "aoi", "detection_id", F.col("pid").alias("matched_label_id"), local_distance().alias("distance_to_label_m")
    )


def flagged(spark, d):
    """Flagged pairs with the chosen label and its distance (local metric)."""
    # The labels are dealt out by the same two columns, so only the pairs are shuffled here.
    key = ["aoi", "detection_id"]
    return spread_by(pairs(spark, d), *key).join(chosen_label(spark, d, boxes(spark, d)), key, "left").select(
        "run_id", "aoi", "detection_id", "parcel_id", "landcode", "sectname", "is_farmland", "confidence",
        "overlap_area_m2", "matched_label_id", "distance_to_label_m", "l_minx", "l_miny", "l_maxx", "l_maxy",
    )


def ranked(spark, d):
    """Rank per run by the stored (float32) confidence and overlap."""
    order = [
        F.desc_nulls_first(F.col("confidence").cast("float")), F.desc_nulls_first(F.col("overlap_area_m2").cast("float")),
        F.asc("detection_id"), F.asc("parcel_id"),
    ]
    return K.rank_rows(pairs(spark, d).select("run_id", "aoi", "detection_id", "parcel_id", "confidence", "overlap_area_m2"), ["run_id"], order)


def candidates(spark, d):
    """Worklist candidates with the columns the documents use."""
    c = F.col
    det = boxes(spark, d).withColumns(
        {
            "area_m2": (c("maxx") - c("minx")) * F.lit(UNIT * SP.LOCAL_M_PER_DEG_LON)
            * ((c("maxy") - c("miny")) * F.lit(UNIT * SP.LOCAL_M_PER_DEG_LAT)),
            "lon": (c("minx") + c("maxx")) / 2 * F.lit(UNIT),
            "lat": (c("miny") + c("maxy")) / 2 * F.lit(UNIT),
        }
    )
    # The worklist does not depend on the labels, so they are looked up for its rows only.
    hits = pairs(spark, d).select(
        "run_id", "aoi", "detection_id", "parcel_id", "landcode", "sectname", "is_farmland", "confidence", "overlap_area_m2"
    )
    found = DO.candidates(hits, det, I.WORKLIST)
    label = chosen_label(spark, d, found.dropDuplicates(["aoi", "detection_id"]))
    return found.join(label, ["aoi", "detection_id"], "left").withColumns(
        {
            "display_name": F.concat(F.lit("Area "), c("aoi")), "county": F.lit("County "), "township": c("aoi"),
            "detector": F.lit("spectral"),
        }
    )


# ---------------------------------------------------------------- geometry

_PTS = f"{O.RECORDS}, pts AS (SELECT id, lng, lat FROM re WHERE lng IS NOT NULL)"


@query("reproject_points", f"""WITH {_PTS}, {O.forward('pts', 'pj', [('lng', 'lat', 'x', 'y')])},
{O.inverse('pj', 'bk', [('x', 'y', 'lon2', 'lat2')])}
SELECT id, round(x, 3) AS x, round(y, 3) AS y, round(lon2, 9) AS lon_back, round(lat2, 9) AS lat_back FROM bk""")
def reproject_points(spark, d):
    pts = I.site_records(spark, d).where("lng IS NOT NULL").select("id", "lng", "lat")
    at = project_points(pts, "lng", "lat", WGS84, CRS, ("x", "y"))
    back = project_points(at, "x", "y", CRS, WGS84, ("lon2", "lat2"))
    return back.select(
        "id", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"), F.round("lon2", 9).alias("lon_back"),
        F.round("lat2", 9).alias("lat_back"),
    )


def _corners(p: str = "") -> list[tuple[str, str, str, str]]:
    x0, y0, x1, y1 = (f"{n} * {UNIT!r}" for n in ("minx", "miny", "maxx", "maxy"))
    return [(x0, y0, "x0", "y0"), (x1, y0, "x1", "y1"), (x1, y1, "x2", "y2"), (x0, y1, "x3", "y3")]


@query("parcel_area", f"""WITH {O.PARCELS}, {O.forward('pa', 'pj', _corners())}
SELECT parcel_id, round({O.quad_area('')}, 1) AS area_m2 FROM pj""")
def parcel_area(spark, d):
    c = F.col
    ring = G.box_ring(c("minx") * UNIT, c("miny") * UNIT, c("maxx") * UNIT, c("maxy") * UNIT)
    return I.parcels(spark, d).select(
        "parcel_id", F.round(G.polygon_area_m2(F.array(ring), WGS84, CRS), 1).alias("area_m2")
    )


def _l_shape():
    """An L-shaped ring inside a parcel, so that shapes are not just boxes."""
    c = F.col
    t = c("miny") + 400 + c("i") * 10
    pts = [
        (c("minx"), c("miny")), (c("maxx"), c("miny")), (c("maxx"), t), (c("minx") + 500, t),
        (c("minx") + 500, c("maxy")), (c("minx"), c("maxy")), (c("minx"), c("miny")),
    ]
    return F.array(*[G.point(x, y) for x, y in pts])


@query("centroid", f"""WITH {O.PARCELS}, s AS (SELECT *, 400 + i * 10 AS t FROM pa)
SELECT parcel_id, 1200 * t + 500 * (1200 - t) AS area,
 round(minx + (1200 * t * 600.0::DOUBLE + 500 * (1200 - t) * 250.0::DOUBLE) / (1200 * t + 500 * (1200 - t)), 3) AS cx,
 round(miny + (1200 * t * (t / 2.0::DOUBLE) + 500 * (1200 - t) * ((1200 + t) / 2.0::DOUBLE)) / (1200 * t + 500 * (1200 - t)), 3) AS cy FROM s""")
def centroid(spark, d):
    shaped = I.parcels(spark, d).withColumn("rings", F.array(_l_shape())).withColumn("ctr", G.centroid(F.col("rings")))
    return shaped.select(
        "parcel_id", F.round(G.polygon_area(F.col("rings")), 0).cast("long").alias("area"),
        F.round("ctr.x", 3).alias("cx"), F.round("ctr.y", 3).alias("cy"),
    )


@query("bounds", f"""WITH {O.PARCELS}
SELECT parcel_id, minx AS b_minx, miny AS b_miny, maxx AS b_maxx, maxy AS b_maxy, round(minx - 1440, 3) AS p_minx,
 round(miny - 1440, 3) AS p_miny, round(maxx + 1440, 3) AS p_maxx, round(maxy + 1440, 3) AS p_maxy FROM pa""")
def bounds(spark, d):
    b = I.parcels(spark, d).withColumn("b", G.bounds(F.array(_l_shape()))).withColumn("p", G.padded_bounds(F.col("b")))
    names = ("minx", "miny", "maxx", "maxy")
    return b.select(
        "parcel_id", *[F.col(f"b.{n}").alias(f"b_{n}") for n in names], *[F.round(f"p.{n}", 3).alias(f"p_{n}") for n in names]
    )


def _num(e: str) -> str:
    return f"regexp_replace(printf('%.7f', {e} / 1000000), '\\.?0+$', '')"


@query("wkt_roundtrip", f"""WITH {O.PARCELS}, t AS (SELECT *, {_num('minx')} AS a, {_num('miny')} AS b, {_num('maxx')} AS c, {_num('maxy')} AS e FROM pa)
SELECT parcel_id, 'POLYGON ((' || a || ' ' || b || ', ' || c || ' ' || b || ', ' || c || ' ' || e || ', ' || a || ' ' || e || ', ' || a || ' ' || b || '))' AS wkt,
 5 AS n_points, 1.44::DOUBLE AS area_e6, true AS same FROM t""")
def wkt_roundtrip(spark, d):
    c = F.col
    ring = G.box_ring(c("minx") / 1e6, c("miny") / 1e6, c("maxx") / 1e6, c("maxy") / 1e6)
    t = I.parcels(spark, d).select("parcel_id", G.to_wkt(F.array(ring)).alias("wkt"))
    t = t.withColumn("back", G.from_wkt(c("wkt")))
    return t.select(
        "parcel_id", "wkt", F.size(c("back")[0]).alias("n_points"),
        F.round(G.polygon_area(c("back")) * 1e6, 2).alias("area_e6"), (G.to_wkt(c("back")) == c("wkt")).alias("same"),
    )


_AREAS = f"""{O.PARCELS}, ab AS (SELECT aoi, min(minx) AS minx, min(miny) AS miny, max(maxx) AS maxx, max(maxy) AS maxy FROM pa GROUP BY aoi)"""
_CELL = [("cx0", "cy0", "a0", "b0"), ("cx1", "cy0", "a1", "b1"), ("cx1", "cy1", "a2", "b2"), ("cx0", "cy1", "a3", "b3")]


@query("parcel_grid", f"""WITH {_AREAS}, {O.forward('ab', 'pj', _corners())},
g AS (SELECT aoi, least(x0, x1, x2, x3) AS gx0, least(y0, y1, y2, y3) AS gy0, greatest(x0, x1, x2, x3) AS gx1, greatest(y0, y1, y2, y3) AS gy1 FROM pj),
gi AS (SELECT *, unnest(range(0, CAST(ceil((gx1 - gx0) / 120) AS BIGINT))) AS i FROM g),
gj AS (SELECT *, unnest(range(0, CAST(ceil((gy1 - gy0) / 120) AS BIGINT))) AS j FROM gi),
ce AS (SELECT *, gx0 + i * 120 AS cx0, gy0 + j * 120 AS cy0, least(gx0 + i * 120 + 120, gx1) AS cx1, least(gy0 + j * 120 + 120, gy1) AS cy1,
  xor(xor({I.PARCEL_SEED} * 73856093::BIGINT, i * 19349663::BIGINT), j * 83492791::BIGINT) % 100000 AS u FROM gj),
{O.inverse('ce', 'bk', _CELL)}
SELECT printf('%s-%03d-%03d', aoi, i, j) AS parcel_id, aoi, printf('SIM-%03d%03d', i, j) AS landcode, u < 70000 AS is_farmland,
 CASE WHEN u < 70000 THEN '農牧用地' ELSE '甲種建築用地' END AS landuse_code, round(least(a0, a3), 8) AS min_lon, round(greatest(b2, b3), 8) AS max_lat FROM bk""")
def parcel_grid(spark, d):
    areas = I.parcels(spark, d).groupBy("aoi").agg(
        *[(f(n) * UNIT).alias(n) for f, n in ((F.min, "minx"), (F.min, "miny"), (F.max, "maxx"), (F.max, "maxy"))]
    )
    areas = areas.withColumns(
        {"grid_m": F.lit(120.0), "farmland_fraction": F.lit(0.7), "seed": F.lit(I.PARCEL_SEED).cast("long")}
    )
    cells = grid_parcels(areas, CRS).withColumn("b", G.bounds(F.col("geom")))
    return cells.select(
        "parcel_id", "aoi", "landcode", "is_farmland", "landuse_code", F.round("b.minx", 8).alias("min_lon"),
        F.round("b.maxy", 8).alias("max_lat"),
    )


@query("hash_unit", f"WITH {O.PARCELS} SELECT p_partkey, CAST(unit100k AS DOUBLE) / 100000 AS u FROM pa")
def hash_unit(spark, d):
    p = I.parcels(spark, d)
    return p.select("p_partkey", S.hash_unit(F.lit(I.PARCEL_SEED), F.col("i"), F.expr("p_partkey div 10")).alias("u"))


@query("parcel_stats", f"""WITH {O.PARCELS} SELECT aoi, count(*) AS n_parcels, count(*) FILTER (is_farmland) AS n_farmland,
 round(count(*) FILTER (is_farmland) / count(*), 6) AS farmland_fraction FROM pa GROUP BY aoi""")
def parcel_stats(spark, d):
    return farmland_stats(I.parcels(spark, d)).withColumn("farmland_fraction", F.round("farmland_fraction", 6))


# ------------------------------------------------------------------- joins


@query("farmland_flagged", f"WITH {O.FLAGGED} SELECT run_id, aoi, detection_id, parcel_id, round(overlap_area_m2, 2) AS overlap_area_m2 FROM fl")
def farmland_flagged(spark, d):
    return pairs(spark, d).select("run_id", "aoi", "detection_id", "parcel_id", F.round("overlap_area_m2", 2).alias("overlap_area_m2"))


_IX = f"""{O.DET},{O.PARCELS}, pr AS (SELECT d.run_id, d.aoi, greatest(d.minx, p.minx) AS minx, greatest(d.miny, p.miny) AS miny,
  least(d.maxx, p.maxx) AS maxx, least(d.maxy, p.maxy) AS maxy FROM de d JOIN pa p ON p.aoi = d.aoi AND p.is_farmland
  AND d.minx <= p.maxx AND p.minx <= d.maxx AND d.miny <= p.maxy AND p.miny <= d.maxy), {O.forward('pr', 'pj', _corners())}"""


@query("overlap_area", f"""WITH {_IX}, ar AS (SELECT run_id, aoi, {O.quad_area('')} AS a FROM pj)
SELECT run_id, aoi, count(*) AS n_pairs, count(*) FILTER (a = 0) AS n_touching, round(sum(a), 1) AS overlap_m2, round(max(a), 3) AS largest_m2
FROM ar GROUP BY run_id, aoi""")
def overlap_area(spark, d):
    """Overlap measured after projecting the common box, totalled per run and area."""
    p = pairs(spark, d, CRS)
    return p.groupBy("run_id", "aoi").agg(
        F.count("*").alias("n_pairs"), F.count_if(F.col("overlap_area_m2") == 0).alias("n_touching"),
        F.round(F.sum("overlap_area_m2"), 1).alias("overlap_m2"), F.round(F.max("overlap_area_m2"), 3).alias("largest_m2"),
    )


_NEAR = f"""{O.DET},{O.SITES}, cd AS (SELECT d.detection_id, d.minx, d.miny, d.maxx, d.maxy, s.pid, s.px, s.py,
  greatest(0, s.px - d.maxx, d.minx - s.px) AS gx, greatest(0, s.py - d.maxy, d.miny - s.py) AS gy FROM de d LEFT JOIN si s ON s.aoi = d.aoi),
nn AS (SELECT * FROM cd QUALIFY row_number() OVER (PARTITION BY detection_id ORDER BY gx * gx + gy * gy, pid) = 1),
{O.forward('nn', 'pj', _corners() + [(f'px * {UNIT!r}', f'py * {UNIT!r}', 'qx', 'qy')])}"""
_SIDES = ", ".join(O.segment_distance("qx", "qy", f"x{i}", f"y{i}", f"x{(i + 1) % 4}", f"y{(i + 1) % 4}") for i in range(4))


@query("nearest_label", f"""WITH {_NEAR} SELECT detection_id, pid AS matched_label_id,
 round(CASE WHEN gx = 0 AND gy = 0 THEN 0 ELSE least({_SIDES}) END, 3) AS distance_m FROM pj""")
def nearest_label(spark, d):
    """Label chosen by planar degree distance, reported by its distance in projected metres."""
    found = nearest(spark, d)
    corners = SP.project_box(found, ("minx", "miny", "maxx", "maxy"), UNIT, CRS)
    near = project_many(corners, [(F.col("px") * UNIT, F.col("py") * UNIT, "sx", "sy")], WGS84, CRS)
    dist = F.when(F.col("d2") == 0, 0.0).otherwise(SP.quad_point_distance("sx", "sy"))
    return near.select("detection_id", F.col("pid").alias("matched_label_id"), F.round(dist, 3).alias("distance_m"))


_RECALL = f"""lr AS (SELECT DISTINCT f.run_id, s.aoi, s.pid FROM si s JOIN fl f ON
   greatest(0, s.px - f.dx1, f.dx0 - s.px) * 0.1016 <= 80 AND greatest(0, s.py - f.dy1, f.dy0 - s.py) * 0.11075 <= 80
   AND sqrt(power(greatest(0, s.px - f.dx1, f.dx0 - s.px) * 0.1016, 2) + power(greatest(0, s.py - f.dy1, f.dy0 - s.py) * 0.11075, 2)) <= 80
   JOIN (SELECT DISTINCT run_id, aoi FROM de) r ON r.run_id = f.run_id AND r.aoi = s.aoi)"""


def matched_labels(spark, d):
    """Labels with any flagged detection of the run within the radius; the flagged side is not limited
    to the label's area."""
    c = F.col
    kx, ky = F.lit(UNIT * SP.LOCAL_M_PER_DEG_LON), F.lit(UNIT * SP.LOCAL_M_PER_DEG_LAT)
    det = boxes(spark, d)
    hit = farmland(spark, d)
    on_farm = SP.candidate_pairs(det, hit, ["aoi"], I.PARCEL_SIDE).select(
        "run_id", (c("l_minx") * kx).alias("minx"), (c("l_miny") * ky).alias("miny"), (c("l_maxx") * kx).alias("maxx"),
        (c("l_maxy") * ky).alias("maxy"),
    )
    runs = det.select("run_id", "aoi").distinct()
    labels = I.sites(spark, d).join(runs, "aoi").select("run_id", "aoi", "pid", (c("px") * kx).alias("px"), (c("py") * ky).alias("py"))
    return SP.points_within(labels, on_farm, I.MATCH_RADIUS_M, ["run_id"])


@query("label_recall", f"WITH {O.FLAGGED}, {_RECALL} SELECT run_id, aoi, pid AS label_id FROM lr")
def label_recall(spark, d):
    return matched_labels(spark, d).select("run_id", "aoi", F.col("pid").alias("label_id"))


@query("precision_recall", f"""WITH {O.FLAGGED}, {_RECALL},
f AS (SELECT run_id, aoi, count(DISTINCT detection_id) AS nf, count(DISTINCT CASE WHEN distance_to_label_m <= 80 THEN detection_id END) AS tp FROM fl GROUP BY ALL),
d AS (SELECT run_id, aoi, count(*) AS n FROM de GROUP BY ALL), l AS (SELECT aoi, count(*) AS nl FROM si GROUP BY aoi),
m AS (SELECT run_id, aoi, count(*) AS nm FROM lr GROUP BY ALL),
j AS (SELECT d.run_id, d.aoi, n, coalesce(nf, 0) AS nf, coalesce(tp, 0) AS tp, coalesce(nl, 0) AS nl, coalesce(nm, 0) AS nm
 FROM d LEFT JOIN f USING (run_id, aoi) LEFT JOIN l USING (aoi) LEFT JOIN m USING (run_id, aoi)),
s AS (SELECT *, CASE WHEN nf > 0 THEN tp / nf ELSE 0 END AS p, CASE WHEN nl > 0 THEN nm / nl ELSE 0 END AS r FROM j)
SELECT run_id, aoi, 80.0::DOUBLE AS match_radius_m, n AS n_detections, nf AS n_flagged_detections, tp AS n_true_positive_detections, nl AS n_labels,
 nm AS n_labels_matched, CAST(printf('%.4f', p) AS DOUBLE) AS precision, CAST(printf('%.4f', r) AS DOUBLE) AS recall,
 CAST(printf('%.4f', CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END) AS DOUBLE) AS f1 FROM s""")
def precision_recall(spark, d):
    det = boxes(spark, d)
    matched = matched_labels(spark, d).groupBy("run_id", "aoi").agg(F.count("*").alias("n_labels_matched"))
    return M.precision_recall(det.select("run_id", "aoi"), det, flagged(spark, d), I.sites(spark, d), matched, I.MATCH_RADIUS_M)


_RANKED = f"""{O.FLAGGED}, rk AS (SELECT run_id, aoi, detection_id, parcel_id, confidence, overlap_area_m2, row_number() OVER (PARTITION BY run_id
  ORDER BY CAST(confidence AS REAL) DESC NULLS FIRST, CAST(overlap_area_m2 AS REAL) DESC NULLS FIRST, detection_id, parcel_id) AS rank FROM fl)"""


@query("rank_flagged", f"WITH {_RANKED} SELECT run_id, detection_id, parcel_id, rank FROM rk")
def rank_flagged(spark, d):
    return ranked(spark, d).select("run_id", "detection_id", "parcel_id", "rank")


@query("topk_detections", f"""WITH {O.DET} SELECT run_id, aoi, detection_id, confidence, row_number() OVER (PARTITION BY run_id, aoi ORDER BY confidence DESC, detection_id) AS rank
FROM de QUALIFY rank <= {I.MAX_CANDIDATES}""")
def topk_detections(spark, d):
    order = [F.desc("confidence"), F.asc("detection_id")]
    top = K.top_per_group(boxes(spark, d).select("run_id", "aoi", "detection_id", "confidence"), ["run_id", "aoi"], order, I.MAX_CANDIDATES, "rank")
    return top.withColumn("rank", F.col("rank").cast("long"))


@query("dossier_candidates", f"""WITH {O.CANDS} SELECT run_id, aoi, detection_id, parcel_id, matched_label_id, round(overlap_area_m2, 2) AS overlap_area_m2,
 round(area_m2, 2) AS area_m2, round(lon, 7) AS lon, round(lat, 7) AS lat, pos AS worklist_pos FROM ca""")
def dossier_candidates(spark, d):
    return candidates(spark, d).select(
        "run_id", "aoi", "detection_id", "parcel_id", "matched_label_id", F.round("overlap_area_m2", 2).alias("overlap_area_m2"),
        F.round("area_m2", 2).alias("area_m2"), F.round("lon", 7).alias("lon"), F.round("lat", 7).alias("lat"),
        F.col("worklist_pos").cast("long").alias("worklist_pos"),
    )


@query("confidence_bucket", f"""WITH {O.DET} SELECT detection_id, CASE WHEN confidence >= 0.66 THEN 'high' WHEN confidence >= 0.4 THEN 'medium' ELSE 'low' END AS label FROM de""")
def confidence_bucket(spark, d):
    return boxes(spark, d).select("detection_id", S.confidence_class(F.col("confidence")).alias("label"))


@query("corroboration", f"""WITH {O.FLAGGED} SELECT DISTINCT detection_id, distance_to_label_m IS NOT NULL AND distance_to_label_m <= 80 AS within_80,
 distance_to_label_m IS NOT NULL AND distance_to_label_m <= 100 AS within_100 FROM fl""")
def corroboration(spark, d):
    dist = F.col("distance_to_label_m")
    return flagged(spark, d).select(
        "detection_id", S.corroborated(dist, 80.0).alias("within_80"), S.corroborated(dist, 100.0).alias("within_100")
    ).distinct()


def _dossier_rows(spark, d):
    """One document per worklist candidate."""
    return candidates(spark, d).select("run_id", "aoi", "detection_id", "parcel_id", "landcode", "confidence")


@query("flagged_layer", f"""WITH {_RANKED},
w AS (SELECT run_id, aoi, detection_id, parcel_id FROM (SELECT * FROM fl QUALIFY row_number() OVER (PARTITION BY run_id, aoi, detection_id ORDER BY overlap_area_m2 DESC NULLS FIRST, parcel_id) = 1)
 QUALIFY row_number() OVER (PARTITION BY run_id, aoi ORDER BY confidence DESC, detection_id) <= {I.WORKLIST})
SELECT rk.run_id, rk.detection_id, rk.parcel_id, rank, w.parcel_id IS NOT NULL AS has_dossier FROM rk LEFT JOIN w USING (run_id, detection_id, parcel_id)""")
def flagged_layer(spark, d):
    docs = _dossier_rows(spark, d).select("run_id", "detection_id", "parcel_id", F.lit(True).alias("has"))
    rows = ranked(spark, d).join(docs, ["run_id", "detection_id", "parcel_id"], "left")
    return rows.select(
        "run_id", "detection_id", "parcel_id", "rank", F.col("has").isNotNull().alias("has_dossier")
    ).orderBy(F.asc_nulls_last("rank"), "run_id")


@query("dossier_list", f"""WITH {_RANKED},
w AS (SELECT run_id, aoi, detection_id, parcel_id, landcode FROM (SELECT * FROM fl QUALIFY row_number() OVER (PARTITION BY run_id, aoi, detection_id ORDER BY overlap_area_m2 DESC NULLS FIRST, parcel_id) = 1)
 QUALIFY row_number() OVER (PARTITION BY run_id, aoi ORDER BY confidence DESC, detection_id) <= {I.WORKLIST})
SELECT run_id, detection_id, parcel_id, landcode, rank FROM w JOIN rk USING (run_id, detection_id, parcel_id)""")
def dossier_list(spark, d):
    docs = _dossier_rows(spark, d).select("run_id", "detection_id", "parcel_id", "landcode")
    key = ["run_id", "detection_id", "parcel_id"]
    return docs.join(ranked(spark, d).select(*key, "rank"), key).select(
        "run_id", "detection_id", "parcel_id", "landcode", "rank"
    ).orderBy(F.asc_nulls_last("rank"), "run_id")


@query("run_summary", f"""WITH {O.CANDS}, dl AS (SELECT run_id, max(created_at) AS latest, count(*) AS n FROM de GROUP BY run_id)
SELECT run_id, strftime(latest, '%Y-%m-%d %H:%M:%S') AS created_at, n AS n_detections, (SELECT count(*) FROM fl f WHERE f.run_id = dl.run_id) AS n_flagged,
 (SELECT count(*) FROM ca c WHERE c.run_id = dl.run_id) AS n_dossiers FROM dl""")
def run_summary(spark, d):
    return M.run_summary(boxes(spark, d), pairs(spark, d), _dossier_rows(spark, d))
