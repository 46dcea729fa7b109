import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fieldlens.functions import geometry as G
from fieldlens.operators import dossiers as DO
from fieldlens.operators import metrics as M
from fieldlens.operators import ranking as K
from fieldlens.operators import spatial as SP
from fieldlens.plans import catalogue_spatial as Q


def boxes(spark, rows, ident):
    return spark.createDataFrame(rows, f"aoi string, {ident} long, minx double, miny double, maxx double, maxy double")


def random_boxes(rng, n, size, extent=100.0):
    x, y, w, h = rng.random(n) * extent, rng.random(n) * extent, rng.random(n) * size, rng.random(n) * size
    return [(f"a{i % 2}", int(i), float(a), float(b), float(a + c), float(b + d)) for i, (a, b, c, d) in enumerate(zip(x, y, w, h))]


def test_box_join_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    left, right = random_boxes(rng, 300, 4), random_boxes(rng, 200, 30)
    right.append(("a0", 999, 10.0, 10.0, 20.0, 20.0))
    left.append(("a0", 998, 20.0, 12.0, 25.0, 14.0))  # shares an edge only
    left.append(("a1", 997, -7.0, -9.0, 120.0, 130.0))  # much larger than a cell
    got = {(r.lid, r.rid): r.overlap_area_m2 for r in SP.intersect_boxes(boxes(spark, left, "lid"), boxes(spark, right, "rid"), ["aoi"], 5.0).collect()}
    want = {}
    for a, i, x0, y0, x1, y1 in left:
        for b, j, u0, v0, u1, v1 in right:
            if a == b and x0 <= u1 and u0 <= x1 and y0 <= v1 and v0 <= y1:
                want[i, j] = (min(x1, u1) - max(x0, u0)) * (min(y1, v1) - max(y0, v0)) * 101600.0 * 110750.0
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) <= 1e-9 * max(1, want[k]) for k in want)
    assert got[998, 999] == 0


def test_join_plans_have_no_cross_product(spark):
    rng = np.random.default_rng(6)
    left, right = boxes(spark, random_boxes(rng, 50, 4), "lid"), boxes(spark, random_boxes(rng, 50, 4), "rid")
    pts = spark.createDataFrame([("a0", 1, 1.0, 1.0)], "aoi string, pid long, px double, py double")
    near = SP.nearest_point(left, pts, ["aoi"], ["lid"])
    within = SP.points_within(pts, left.drop("lid"), 3.0, ["aoi"])
    for df in (SP.intersect_boxes(left, right, ["aoi"], 5.0), near, within):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


RINGS = "array<array<struct<x:double,y:double>>>"


def polygons(spark, rows, ident, geom):
    df = spark.createDataFrame(rows, f"aoi string, {ident} string, {geom} {RINGS}")
    return df.withColumn("b", G.bounds(F.col(geom))).select("aoi", ident, geom, "b.*")


L_SHAPE = [[(0.0, 0.0), (0.04, 0.0), (0.04, 0.01), (0.01, 0.01), (0.01, 0.04), (0.0, 0.04), (0.0, 0.0)]]
HOLED = [[(0.0, 0.0), (0.03, 0.0), (0.03, 0.03), (0.0, 0.03), (0.0, 0.0)], [(0.01, 0.01), (0.02, 0.01), (0.02, 0.02), (0.01, 0.02), (0.01, 0.01)]]


def box(x0, y0, x1, y1):
    return [[(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]]


def test_polygon_overlap(spark):
    """Overlaps near the central meridian at the equator, where a degree is nearly square in the plane."""
    shift = lambda g: [[(121 + x, y) for x, y in r] for r in g]
    left = [("a", n, shift(g)) for n, g in (("L", L_SHAPE), ("H", HOLED), ("far", box(1.0, 1.0, 1.1, 1.1)))]
    right = [("a", n, shift(g)) for n, g in (("wide", box(0.0, 0.0, 0.05, 0.05)), ("notch", box(0.02, 0.02, 0.03, 0.03)), ("inhole", box(0.012, 0.012, 0.018, 0.018)), ("touch", box(0.04, 0.0, 0.06, 0.01)))]
    right.append(("b", "other", shift(box(0.0, 0.0, 0.05, 0.05))))
    out = SP.intersect_polygons(polygons(spark, left, "lid", "l_geom"), polygons(spark, right, "rid", "r_geom"), ["aoi"], "lid", "rid", 0.01, "EPSG:3826")
    got = {(r.lid, r.rid): r.overlap_area_m2 for r in out.collect()}
    unit = got["L", "wide"] / 0.0007
    want = {("L", "wide"): 0.0007, ("L", "touch"): 0.0, ("H", "wide"): 0.0008, ("H", "notch"): 0.0001}
    assert set(got) == set(want)  # the box in the notch of L and the one in the hole of H do not meet them
    assert all(abs(got[k] - want[k] * unit) < 1.0 for k in want)
    back = SP.intersect_polygons(
        polygons(spark, right, "lid", "l_geom"), polygons(spark, left, "rid", "r_geom"), ["aoi"], "lid", "rid", 0.01, "EPSG:3826"
    )
    assert all(abs(got[r.rid, r.lid] - r.overlap_area_m2) < 1.0 for r in back.collect())


@pytest.mark.parametrize("leaf", [1, 3, 64])
def test_nearest_equals_brute_force(spark, leaf):
    rng = np.random.default_rng(8)
    dense = rng.normal(50, 1e-4, (120, 2))  # most points at one spot
    spread = rng.random((60, 2)) * 100
    copies = np.repeat([[70.0, 70.0]], 40, axis=0)  # one position many times over
    pts = [("a0", int(i), float(x), float(y)) for i, (x, y) in enumerate(np.vstack([dense, spread, copies]))]
    pts += [("a1", 7, 3.0, 4.0)]
    left = random_boxes(rng, 120, 3) + [("a0", 500, 69.0, 69.0, 71.0, 71.0), ("none", 501, 0.0, 0.0, 1.0, 1.0)]
    out = SP.nearest_point(boxes(spark, left, "lid"), spark.createDataFrame(pts, "aoi string, pid long, px double, py double"), ["aoi"], ["lid"], leaf=leaf)
    got = {r.lid: (r.pid, r.d2) for r in out.collect()}
    assert len(got) == len(left)
    for a, i, x0, y0, x1, y1 in left:
        best = min(
            ((max(0, x - x1, x0 - x) ** 2 + max(0, y - y1, y0 - y) ** 2, pid) for b, pid, x, y in pts if b == a), default=(None, None)
        )
        assert got[i] == (best[1], best[0])


def test_nearest_without_any_point(spark):
    none = spark.createDataFrame([], "aoi string, pid long, px double, py double")
    assert SP.nearest_point(boxes(spark, [("a", 1, 0.0, 0.0, 1.0, 1.0)], "lid"), none, ["aoi"], ["lid"]).first().pid is None


def test_degree_nearest_need_not_be_metre_nearest(spark):
    """A degree of longitude is shorter than one of latitude: the choice is planar, as stored."""
    det = boxes(spark, [("a", 1, 0.0, 0.0, 0.0, 0.0)], "lid")
    pts = [("a", 1, 0.0, 1.0), ("a", 2, 1.05, 0.0)]
    assert SP.nearest_point(det, spark.createDataFrame(pts, "aoi string, pid long, px double, py double"), ["aoi"], ["lid"]).first().pid == 1
    scaled = [(a, p, x * SP.LOCAL_M_PER_DEG_LON, y * SP.LOCAL_M_PER_DEG_LAT) for a, p, x, y in pts]
    assert SP.nearest_point(det, spark.createDataFrame(scaled, "aoi string, pid long, px double, py double"), ["aoi"], ["lid"]).first().pid == 2


@pytest.mark.parametrize("hot_rows", [5, 100_000])
def test_points_within_equals_brute_force(spark, hot_rows):
    rng = np.random.default_rng(9)
    shapes = random_boxes(rng, 150, 6)
    pts = [(f"a{i % 2}", int(i), float(x), float(y)) for i, (x, y) in enumerate(rng.random((400, 2)) * 110 - 5)]
    rows = SP.points_within(spark.createDataFrame(pts, "aoi string, pid long, px double, py double"), boxes(spark, shapes, "sid").drop("sid"), 4.0, ["aoi"], hot_rows).collect()
    got = {r.pid for r in rows}
    assert len(got) == len(rows)
    want = {p for a, p, x, y in pts if any(a == b and max(0, x - x1, x0 - x) ** 2 + max(0, y - y1, y0 - y) ** 2 <= 16 for b, _, x0, y0, x1, y1 in shapes)}
    assert got == want


def test_rank_and_running_total_with_a_hot_group(spark):
    df = spark.range(4000).selectExpr("id", "if(id % 3 = 0, 'hot', concat('g', id % 40)) AS g", "(id * 7919) % 11 AS v")
    order = [F.desc("v"), F.asc("id")]
    got = {r.id: (r.rank, r.total) for r in K.running_total(K.rank_rows(df, ["g"], order), ["g"], order, F.col("v") + 1, "total", partitions=7).collect()}
    w = Window.partitionBy("g").orderBy(*order)
    want = df.withColumn("rank", F.row_number().over(w)).withColumn("total", F.sum(F.col("v") + 1).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    assert got == {r.id: (r.rank, r.total) for r in want.collect()}


def test_descending_rank_puts_nulls_first(spark):
    df = spark.createDataFrame([(1, 0.5), (2, None), (3, 0.9)], "id long, conf double")
    got = {r.id: r.rank for r in K.rank_rows(df.withColumn("g", F.lit(1)), ["g"], [F.desc_nulls_first("conf"), F.asc("id")]).collect()}
    assert got == {2: 1, 3: 2, 1: 3}


def test_latest_by(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 3, 2), ("a", 3, 4), ("b", 2, 0)], "k string, ts long, v long")
    assert {r.k: r.v for r in K.latest_by(df, ["k"], "ts", ["v"]).collect()} == {"a": 4, "b": 0}
    assert K.latest_by(df, [], "ts", ["v"]).first().v == 4


def test_nearest_point_gives_out_no_row_per_point(spark):
    """One row per geometry and leaf reaches the sort of the aggregate, however many points a leaf holds."""
    pts = spark.range(60).selectExpr("'a' AS aoi", "id AS pid", "cast(id AS double) AS px", "cast(id % 7 AS double) AS py")
    left = spark.range(500).selectExpr("'a' AS aoi", "id AS lid", "id / 10D AS minx", "2D AS miny", "id / 10D + 1 AS maxx", "3D AS maxy")
    near = SP.nearest_point(left, pts, ["aoi"], ["lid"])
    assert near.count() == 500
    plan = near._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan.split("Repartition", 1)[0] and "array_min" in plan


def test_nearest_point_in_a_leaf_of_very_many_points(spark):
    """Points so close that no level parts them are dealt out to rows of bounded size."""
    pts = spark.range(2000).selectExpr("'a' AS aoi", "2000 - id AS pid", "cast(id AS double) * 1e-12D AS px", "0D AS py")
    pts = pts.unionByName(spark.createDataFrame([("a", 9999, 1000.0, 1000.0)], "aoi string, pid long, px double, py double"))
    left = spark.createDataFrame([("a", 1, -2.0, 0.0, -1.0, 0.0), ("a", 2, 1.0, 0.0, 2.0, 0.0)], "aoi string, lid long, minx double, miny double, maxx double, maxy double")
    _, held, _, _, _ = SP._point_tree(pts, ["aoi"], 64)
    assert held.selectExpr("max(size(points)) AS n").first().n < 200
    assert {r.lid: r.pid for r in SP.nearest_point(left, pts, ["aoi"], ["lid"]).collect()} == {1: 2000, 2: 1}


def test_partitions_of_pairs_are_kept(spark):
    """Rows that compress well are not merged to a few large tasks after the shuffle."""
    box = spark.range(20000).selectExpr("'a' AS aoi", "id AS lid", "id % 100 * 10D AS minx", "id div 100 * 10D AS miny", "id % 100 * 10D + 3 AS maxx", "id div 100 * 10D + 3 AS maxy")
    found = SP.candidate_pairs(box, box.withColumnRenamed("lid", "rid"), ["aoi"], 10.0)
    assert found.count() == 20000
    assert found.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_points_within_multiplies_shapes_little(spark, monkeypatch):
    """Shapes go to the cells they touch, not to all cells within the radius, and corners and edges are still met."""
    made = []
    cover = SP.cover
    monkeypatch.setattr(SP, "cover", lambda df, cell, grow=0.0: made.append(cover(df, cell, grow)) or made[-1])
    shapes = spark.range(1000).selectExpr("'a' AS aoi", "id * 7D AS minx", "id % 31 * 5D AS miny", "id * 7D + 3 AS maxx", "id % 31 * 5D + 3 AS maxy")
    pts = spark.createDataFrame(
        [("a", 1, -8.0, 0.0), ("a", 2, -8.0001, 0.0), ("a", 3, 3.0 + 8.0, -8.0), ("a", 4, 6996.0 + 4.8, 21.0), ("a", 5, None, 0.0)],
        "aoi string, pid long, px double, py double",
    )
    got = {r.pid for r in SP.points_within(pts, shapes, 8.0, ["aoi"]).collect()}
    held = [(r.minx, r.miny, r.maxx, r.maxy) for r in shapes.collect()]
    want = {
        r.pid for r in pts.where("px IS NOT NULL").collect()
        if any(max(0, r.px - x1, x0 - r.px) ** 2 + max(0, r.py - y1, y0 - r.py) ** 2 <= 64 for x0, y0, x1, y1 in held)
    }
    assert got == want and 1 in got and 2 not in got
    assert made[0].count() < 2 * 1000


def test_nearest_point_shuffles_geometries_once(spark):
    """With a broadcast tree the fold and the last join need no further shuffle of the geometries."""
    pts = spark.range(60).selectExpr("'a' AS aoi", "100 - id AS pid", "cast(id % 10 AS double) AS px", "cast(id % 7 AS double) AS py")
    left = spark.range(500).selectExpr("'a' AS aoi", "id AS lid", "id / 10D AS minx", "2D AS miny", "id / 10D + 1 AS maxx", "3D AS maxy")
    near = SP.nearest_point(left, pts, ["aoi"], ["lid"])
    rows = near.collect()
    all_pts = [(r.pid, r.px, r.py) for r in pts.collect()]
    for r in rows:
        best = min((max(0, x - r.maxx, r.minx - x) ** 2 + max(0, y - r.maxy, r.miny - y) ** 2, p) for p, x, y in all_pts)
        assert (r.d2, r.pid) == best
    plan = near._jdf.queryExecution().optimizedPlan().toString()
    assert len(rows) == 500 and plan.count("RepartitionByExpression") == 2  # the same rows, on both sides of the last join


def test_precision_recall_counts_each_detection_once(spark):
    """Pairs are folded per detection; nothing is doubled for two distinct counts."""
    flagged = spark.createDataFrame(
        [("r", "a", 1, 5.0), ("r", "a", 1, 5.0), ("r", "a", 2, None), ("r", "a", 3, 80.0), ("r", "a", 4, 81.0), ("r", "a", None, 1.0)],
        "run_id string, aoi string, detection_id long, distance_to_label_m double",
    )
    sites = spark.createDataFrame([("a", 1), ("a", 2)], "aoi string, pid long")
    matched = spark.createDataFrame([("r", "a", 1)], "run_id string, aoi string, n_labels_matched long")
    got = M.precision_recall(flagged, flagged, flagged, sites, matched, 80.0)
    row = got.first()
    assert (row.n_flagged_detections, row.n_true_positive_detections, row.precision) == (4, 2, 0.5)
    assert "Expand" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_worklist_is_cut_before_the_detections_come_in(spark):
    """The cut equals that of the joined rows, also where detections repeat or are missing; no wide row is shuffled for it."""
    flagged = spark.range(400).selectExpr(
        "concat('r', id % 2) AS run_id", "'a' AS aoi", "CASE WHEN id = 7 THEN NULL ELSE id div 4 END AS detection_id", "concat('p', id % 3) AS parcel_id",
        "cast(id % 5 AS double) AS overlap_area_m2", "CASE WHEN id div 4 % 9 = 0 THEN NULL ELSE (id div 4 * 37 % 50) / 50D END AS confidence",
    )
    det = spark.range(100).where("id % 13 <> 5").selectExpr("explode(array('r0', 'r1')) AS run_id", "'a' AS aoi", "id AS detection_id", "id * 2 AS wide")
    det = det.unionByName(det.where("detection_id % 10 = 4"))
    got = DO.candidates(flagged, det, 6)
    best, conf = {}, {}
    for r in flagged.where("detection_id IS NOT NULL").collect():
        k, one = (r.run_id, r.detection_id), (-r.overlap_area_m2, r.parcel_id)
        best[k] = min(best.get(k, one), one)
        conf[k] = -(r.confidence or 0.0)
    held = [(r.run_id, r.detection_id) for r in det.collect()]
    for run in ("r0", "r1"):
        want = sorted((conf[k], k[1]) for k in held if k[0] == run and k in conf)[:6]
        rows = sorted(got.where(f"run_id = '{run}'").collect(), key=lambda r: r.worklist_pos)
        assert [(-(r.confidence or 0.0), r.detection_id, r.wide) for r in rows] == [(a, i, 2 * i) for a, i in want]
        assert all((-r.overlap_area_m2, r.parcel_id) == best[run, r.detection_id] for r in rows)
    assert "LeftSemi" in got._jdf.queryExecution().optimizedPlan().toString()


def test_labels_are_looked_up_for_the_worklist_only(spark, tmp_path, monkeypatch):
    d = str(tmp_path)
    spark.range(2000).selectExpr("id AS o_orderkey", "timestamp'1996-01-01' AS o_orderdate").write.parquet(f"{d}/orders.parquet")
    spark.range(800).selectExpr("id AS p_partkey", "'n' AS p_name", "'b' AS p_brand", "'t' AS p_type").write.parquet(f"{d}/part.parquet")
    spark.range(40).selectExpr("id AS s_suppkey").write.parquet(f"{d}/supplier.parquet")
    asked, nearest = [], SP.nearest_point
    monkeypatch.setattr(SP, "nearest_point", lambda left, *a, **k: asked.append(left) or nearest(left, *a, **k))
    key = ["run_id", "detection_id", "parcel_id", "matched_label_id", "distance_to_label_m"]
    rows = {tuple(r) for r in Q.candidates(spark, d).select(*key).collect()}
    assert len(rows) == 4 * Q.I.WORKLIST and asked[0].count() == len(rows)
    assert rows <= {tuple(r) for r in Q.flagged(spark, d).select(*key).collect()}
