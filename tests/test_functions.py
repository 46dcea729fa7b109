import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldlens.functions import geometry as G
from fieldlens.functions import scalars as S
from fieldlens.functions import spectral as X
from fieldlens.functions import vectors as V
from fieldlens.functions.projection import WGS84, project_points, project_ring


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first()


def ring(*pts):
    return F.array(*[G.point(F.lit(x), F.lit(y)) for x, y in pts])


SQUARE = [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0), (0.0, 0.0)]
HOLE = [(0.5, 0.5), (1.5, 0.5), (1.5, 1.5), (0.5, 1.5), (0.5, 0.5)]


def test_index_math(spark):
    r = one(spark, v=X.ndvi(F.lit(0.35), F.lit(0.06)), b=X.ndbi(F.lit(0.20), F.lit(0.35)), z=X.ndvi(F.lit(0.0), F.lit(0.0)))
    assert abs(r.v - 0.29 / 0.41) < 1e-12 and r.b < 0 and r.z == 0


def test_index_float32_parity(spark):
    rng = np.random.default_rng(1)
    a, b = rng.random(500, dtype="float32"), rng.random(500, dtype="float32")
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, b)], "a float, b float")
    got = np.array([r.v for r in df.select(X.normalized_difference(F.col("a"), F.col("b"), "float").alias("v")).collect()], dtype="float32")
    assert np.array_equal(got, (a - b) / (a + b))


def test_change_limits_are_inclusive_and_confidence_clips(spark):
    r = one(
        spark, on=X.change_predicate(F.lit(0.06), F.lit(0.12), 0.06, 0.12), top=X.confidence(F.lit(9.0), F.lit(9.0)),
        low=X.confidence(F.lit(-9.0), F.lit(0.0)), mid=X.confidence(F.lit(0.15), F.lit(0.25)),
    )
    assert r.on and r.top == 0.99 and r.low == 0.05 and abs(r.mid - 0.5) < 1e-12


def test_scalars(spark):
    r = one(
        spark, h=S.hash_unit(F.lit(20260615), F.lit(3), F.lit(5)), pid=S.padded_id(F.lit("a"), F.lit(7), F.lit(1234)),
        blank=S.blank_to_null(F.lit("  ")), first=S.first_truthy(F.lit(""), F.lit("x")), f=S.truthy(F.lit("false")),
        text_false=S.truthy(F.lit("no")), strict=S.truthy(F.lit("no"), strict=True), day=S.date_prefix(F.lit(None).cast("string")),
        year=S.year_of(F.lit("2021-01-01")), noyear=S.year_of(F.lit("n/a")), words=S.farmland_by_words(F.lit("特定農業區"), F.lit(None)),
        none=S.confidence_class(F.lit(None).cast("double")), far=S.corroborated(F.lit(80.01), 80.0), at=S.corroborated(F.lit(80.0), 80.0),
    )
    assert r.h == 0.55877 and r.pid == "a-007-1234" and r.blank is None and r.first == "x"
    assert not r.f and r.text_false and not r.strict and r.day == "" and r.year == "2021" and r.noyear is None
    assert r.words and r.none == "low" and not r.far and r.at


@pytest.mark.parametrize("digits", [0, 2, 4])
def test_rounding_is_that_of_exact_binary_values(spark, digits):
    values = [0.165, 0.125, 0.285, 1 / 32, 2.5, 3.5, 0.5, 1.005, 2469 / 20000, 0.0, 0.99, 12345.675] + list(np.random.default_rng(2).random(300))
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = [(r.t, r.n) for r in df.select(S.fixed(F.col("v"), digits).alias("t"), S.round_half_even(F.col("v"), digits).alias("n")).collect()]
    assert [g[0] for g in got] == [f"{v:.{digits}f}" for v in values]
    assert [g[1] for g in got] == [round(v, digits) for v in values]


def test_projection(spark):
    pts = spark.createDataFrame([(121.0, 0.0), (120.5, 24.12)], "x double, y double")
    rows = project_points(pts, "x", "y", WGS84, "EPSG:3826", ("e", "n")).collect()
    assert abs(rows[0].e - 250000) < 1e-6 and abs(rows[0].n) < 1e-6
    assert abs(rows[1].e - 199176.050) < 2e-3 and abs(rows[1].n - 2668403.510) < 2e-3
    there = project_points(pts, "x", "y", WGS84, "EPSG:32651", ("e", "n"))
    back = project_points(there, "e", "n", "EPSG:32651", WGS84, ("lon", "lat")).collect()
    assert all(abs(r.lon - r.x) < 1e-10 and abs(r.lat - r.y) < 1e-10 for r in back)


def test_area_of_known_box_and_round_trip(spark):
    box = G.box_ring(F.lit(120.50), F.lit(24.10), F.lit(120.51), F.lit(24.11))
    again = project_ring(project_ring(box, WGS84, "EPSG:3826"), "EPSG:3826", WGS84)
    r = one(spark, a=G.polygon_area_m2(F.array(box), WGS84, "EPSG:3826"), b=G.bounds(F.array(again)))
    assert abs(r.a - 1125928.9) < 0.1
    assert abs(r.b.minx - 120.50) < 1e-9 and abs(r.b.maxy - 24.11) < 1e-9


def test_polygon_measures(spark):
    rings = F.array(ring(*SQUARE), ring(*HOLE))
    turned = F.array(F.reverse(ring(*SQUARE)), ring(*HOLE))
    r = one(spark, a=G.polygon_area(rings), c=G.centroid(rings), c2=G.centroid(turned), o=G.signed_area(G.oriented(turned)[0]))
    assert r.a == 3.0 and (r.c.x, r.c.y) == (1.0, 1.0) and (r.c2.x, r.c2.y) == (1.0, 1.0) and r.o > 0


def test_point_relations(spark):
    rings = F.array(ring(*SQUARE), ring(*HOLE))
    p = lambda x, y: G.point(F.lit(x), F.lit(y))
    r = one(
        spark, inside=G.point_in_polygon(p(0.2, 0.2), rings), hole=G.point_in_polygon(p(1.0, 1.0), rings), edge=G.point_in_polygon(p(2.0, 1.0), rings),
        d0=G.polygon_point_distance(rings, p(0.2, 0.2)), dh=G.polygon_point_distance(rings, p(1.0, 1.0)), dc=G.polygon_point_distance(rings, p(5.0, 6.0)),
    )
    assert r.inside and not r.hole and r.edge and r.d0 == 0 and r.dh == 0.5 and r.dc == 5.0


def test_clip_to_box(spark):
    tri = ring((0.0, 0.0), (4.0, 0.0), (0.0, 4.0), (0.0, 0.0))
    part = G.clip_ring_to_box(tri, F.lit(1.0), F.lit(1.0), F.lit(10.0), F.lit(10.0))
    away = G.clip_polygon_to_box(F.array(tri), F.lit(5.0), F.lit(5.0), F.lit(6.0), F.lit(6.0))
    touch = G.clip_polygon_to_box(F.array(tri), F.lit(4.0), F.lit(0.0), F.lit(6.0), F.lit(6.0))
    r = one(spark, a=F.abs(G.signed_area(part)), n=F.size(away), t=F.size(touch))
    assert abs(r.a - 2.0) < 1e-12 and r.n == 0 and r.t == 0


def test_wkt_round_trip(spark):
    rings = F.array(ring((120.5, 24.0), (120.51, 24.0), (120.51, 24.1234567), (120.5, 24.0)), ring(*HOLE))
    r = one(spark, t=G.to_wkt(rings), again=G.to_wkt(G.from_wkt(G.to_wkt(rings))))
    assert r.t.startswith("POLYGON ((120.5 24, 120.51 24, 120.51 24.1234567, 120.5 24), (0.5 0.5,") and r.again == r.t


def test_padded_bounds(spark):
    r = one(spark, b=G.padded_bounds(G.bounds(F.array(ring(*SQUARE)))))
    assert (r.b.minx, r.b.maxx) == (-2.4, 4.4)


def test_vectors(spark):
    v = F.array(*[F.lit(x) for x in (3.0, 4.0)])
    zero = F.array(F.lit(0.0), F.lit(0.0))
    r = one(spark, p=V.l2_pad(v, 4), c=V.l2_pad(v, 1), z=V.l2_pad(zero, 3), s=V.cosine(v, v), n=V.cosine(v, zero))
    assert r.p == [0.6, 0.8, 0, 0] and r.c == [1.0] and r.z == [0, 0, 0] and abs(r.s - 1) < 1e-12 and math.isnan(r.n)
