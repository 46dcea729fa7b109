"""Planar geometry on native arrays: a ring is a closed ``ARRAY<STRUCT<x, y>>``, a polygon an array
of rings with the shell first."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldlens.functions.projection import let, project_ring


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def box_ring(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.array(point(x0, y0), point(x1, y0), point(x1, y1), point(x0, y1), point(x0, y0))


def _edges(ring: Column, body) -> Column:
    """``body(p, q)`` for each edge of a closed ring."""
    n = F.size(ring)
    return F.zip_with(F.slice(ring, F.lit(1), n - 1), F.slice(ring, F.lit(2), n - 1), body)


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


def signed_area(ring: Column) -> Column:
    """Shoelace area relative to the first vertex; positive when counter-clockwise."""

    def shoelace(r):
        o = r[0]
        return _total(
            _edges(r, lambda p, q: (p["x"] - o["x"]) * (q["y"] - o["y"]) - (q["x"] - o["x"]) * (p["y"] - o["y"]))
        ) / F.lit(2.0)

    return let(ring, lambda r: F.when(F.size(r) >= 4, shoelace(r)).otherwise(F.lit(0.0)))


def polygon_area(rings: Column) -> Column:
    return F.aggregate(
        F.slice(rings, F.lit(2), F.size(rings)),
        F.abs(signed_area(rings[0])),
        lambda acc, hole: acc - F.abs(signed_area(hole)),
    )


def polygon_area_m2(rings: Column, src: str, crs: str) -> Column:
    return polygon_area(F.transform(rings, lambda r: project_ring(r, src, crs)))


def oriented(rings: Column) -> Column:
    """Shell counter-clockwise, holes clockwise, rings without area dropped."""
    turned = F.transform(
        rings, lambda r, i: F.when((signed_area(r) > 0) == (i == 0), r).otherwise(F.reverse(r))
    )
    return F.filter(turned, lambda r: signed_area(r) != 0)


def ring_centroid_moments(ring: Column) -> Column:
    """Signed area and first moments relative to the first vertex."""

    def moments(r):
        o = r[0]
        terms = _edges(
            r,
            lambda p, q: F.struct(
                ((p["x"] - o["x"]) * (q["y"] - o["y"]) - (q["x"] - o["x"]) * (p["y"] - o["y"])).alias("w"),
                (p["x"] + q["x"] - o["x"] * 2).alias("sx"),
                (p["y"] + q["y"] - o["y"] * 2).alias("sy"),
            ),
        )
        zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("mx"), F.lit(0.0).alias("my"))
        return F.aggregate(
            terms,
            zero,
            lambda acc, t: F.struct(
                (acc["a"] + t["w"] / 2).alias("a"),
                (acc["mx"] + t["w"] * t["sx"] / 6).alias("mx"),
                (acc["my"] + t["w"] * t["sy"] / 6).alias("my"),
            ),
        )

    return let(ring, moments)


def centroid(rings: Column) -> Column:
    """Area-weighted centroid of a polygon; holes are subtracted whatever their orientation."""

    def shifted(r, i):
        def absolute(m):
            sign = F.when((m["a"] > 0) == (i == 0), 1.0).otherwise(-1.0)
            return F.struct(
                (sign * m["a"]).alias("a"),
                (sign * (m["mx"] + m["a"] * r[0]["x"])).alias("mx"),
                (sign * (m["my"] + m["a"] * r[0]["y"])).alias("my"),
            )

        return let(ring_centroid_moments(r), absolute)

    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("mx"), F.lit(0.0).alias("my"))
    total = F.aggregate(
        F.transform(rings, shifted),
        zero,
        lambda acc, m: F.struct(
            (acc["a"] + m["a"]).alias("a"), (acc["mx"] + m["mx"]).alias("mx"), (acc["my"] + m["my"]).alias("my")
        ),
    )
    return let(total, lambda t: F.struct((t["mx"] / t["a"]).alias("x"), (t["my"] / t["a"]).alias("y")))


def bounds(rings: Column) -> Column:
    xs = F.transform(rings[0], lambda p: p["x"])
    ys = F.transform(rings[0], lambda p: p["y"])
    return F.struct(
        F.array_min(xs).alias("minx"),
        F.array_min(ys).alias("miny"),
        F.array_max(xs).alias("maxx"),
        F.array_max(ys).alias("maxy"),
    )


def padded_bounds(b: Column, ratio: float = 1.2) -> Column:
    """Bounds grown by ``ratio`` times their own side on every side."""
    dx, dy = (b["maxx"] - b["minx"]) * ratio, (b["maxy"] - b["miny"]) * ratio
    return F.struct(
        (b["minx"] - dx).alias("minx"),
        (b["miny"] - dy).alias("miny"),
        (b["maxx"] + dx).alias("maxx"),
        (b["maxy"] + dy).alias("maxy"),
    )


# ---------------------------------------------------------------- clipping


def _clip_half_plane(ring: Column, side, cut) -> Column:
    """Keep the part of a closed ring where ``side(p) >= 0``; ``cut(p, q)`` is the crossing point."""

    def clipped(r):
        pieces = F.flatten(
            _edges(
                r,
                lambda p, q: F.when(
                    side(q) >= 0, F.when(side(p) >= 0, F.array(q)).otherwise(F.array(cut(p, q), q))
                ).otherwise(F.when(side(p) >= 0, F.array(cut(p, q))).otherwise(F.slice(F.array(q), 1, 0))),
            )
        )
        return let(pieces, lambda v: F.when(F.size(v) > 0, F.concat(v, F.slice(v, 1, 1))).otherwise(v))

    return let(ring, lambda r: F.when(F.size(r) > 0, clipped(r)).otherwise(r))


def clip_ring_to_box(ring: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Axis-aligned clip by four half-planes; the result is empty when nothing is left."""

    def at_x(limit):
        return lambda p, q: F.struct(
            limit.cast("double").alias("x"),
            (p["y"] + (q["y"] - p["y"]) * (limit - p["x"]) / (q["x"] - p["x"])).alias("y"),
        )

    def at_y(limit):
        return lambda p, q: F.struct(
            (p["x"] + (q["x"] - p["x"]) * (limit - p["y"]) / (q["y"] - p["y"])).alias("x"),
            limit.cast("double").alias("y"),
        )

    r = _clip_half_plane(ring, lambda p: p["x"] - x0, at_x(x0))
    r = _clip_half_plane(r, lambda p: x1 - p["x"], at_x(x1))
    r = _clip_half_plane(r, lambda p: p["y"] - y0, at_y(y0))
    return _clip_half_plane(r, lambda p: y1 - p["y"], at_y(y1))


def clip_polygon_to_box(rings: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    parts = F.transform(rings, lambda r: clip_ring_to_box(r, x0, y0, x1, y1))

    def with_area(rs):
        kept = F.filter(rs, lambda r: F.abs(signed_area(r)) > 0)
        return F.when(F.abs(signed_area(rs[0])) > 0, kept).otherwise(F.slice(rs, 1, 0))

    return let(parts, with_area)


def fan_triangles(rings: Column) -> Column:
    """Signed triangles whose signed sum is the polygon (valid for concave shells and holes)."""

    def fan(r):
        return F.when(
            F.size(r) >= 4,
            F.transform(
                F.sequence(F.lit(1), F.size(r) - 3),
                lambda k: F.array(r[0], F.get(r, k), F.get(r, k + 1), r[0]),
            ),
        )

    triangles = F.flatten(F.filter(F.transform(oriented(rings), fan), lambda t: t.isNotNull()))
    signed = F.transform(
        triangles,
        lambda t: F.struct(
            F.signum(signed_area(t)).alias("sign"),
            F.when(signed_area(t) < 0, F.reverse(t)).otherwise(t).alias("tri"),
        ),
    )
    return F.filter(signed, lambda t: t["sign"] != 0)


def clip_triangle(subject: Column, clip: Column) -> Column:
    """Intersection ring of two counter-clockwise triangles (may be empty)."""
    out = subject
    for k in range(3):
        a, b = clip[k], clip[k + 1]

        def side(p, a=a, b=b):
            return (b["x"] - a["x"]) * (p["y"] - a["y"]) - (b["y"] - a["y"]) * (p["x"] - a["x"])

        def cut(p, q, side=side):
            t = side(p) / (side(p) - side(q))
            return F.struct(
                (p["x"] + (q["x"] - p["x"]) * t).alias("x"), (p["y"] + (q["y"] - p["y"]) * t).alias("y")
            )

        out = _clip_half_plane(out, side, cut)
    return out


# ------------------------------------------------------- predicates, distance


def _cross(o: Column, a: Column, b: Column) -> Column:
    return (a["x"] - o["x"]) * (b["y"] - o["y"]) - (a["y"] - o["y"]) * (b["x"] - o["x"])


def _between(o: Column, a: Column, p: Column) -> Column:
    return (
        (p["x"] >= F.least(o["x"], a["x"]))
        & (p["x"] <= F.greatest(o["x"], a["x"]))
        & (p["y"] >= F.least(o["y"], a["y"]))
        & (p["y"] <= F.greatest(o["y"], a["y"]))
    )


def point_in_polygon(p: Column, rings: Column) -> Column:
    """Even-odd rule over all rings; points on an edge count as inside."""

    def crossing(a, b):
        hit = ((a["y"] > p["y"]) != (b["y"] > p["y"])) & (
            p["x"] < (b["x"] - a["x"]) * (p["y"] - a["y"]) / (b["y"] - a["y"]) + a["x"]
        )
        return F.when(hit, 1).otherwise(0)

    crossings = F.aggregate(
        F.flatten(F.transform(rings, lambda r: _edges(r, crossing))), F.lit(0), lambda acc, v: acc + v
    )
    on_edge = F.exists(
        F.flatten(F.transform(rings, lambda r: _edges(r, lambda a, b: (_cross(a, b, p) == 0) & _between(a, b, p)))),
        lambda v: v,
    )
    return on_edge | (crossings % 2 == 1)


def _segments_meet(a: Column, b: Column, c: Column, d: Column) -> Column:
    d1, d2, d3, d4 = _cross(a, b, c), _cross(a, b, d), _cross(c, d, a), _cross(c, d, b)
    proper = (d1 * d2 < 0) & (d3 * d4 < 0)
    touch = (
        ((d1 == 0) & _between(a, b, c))
        | ((d2 == 0) & _between(a, b, d))
        | ((d3 == 0) & _between(c, d, a))
        | ((d4 == 0) & _between(c, d, b))
    )
    return proper | touch


def polygons_intersect(left: Column, right: Column) -> Column:
    """True when the closed polygons share at least one point."""
    edges_meet = F.exists(
        F.flatten(
            F.flatten(
                F.transform(
                    left,
                    lambda lr: _edges(
                        lr,
                        lambda a, b: F.flatten(
                            F.transform(right, lambda rr: _edges(rr, lambda c, d: _segments_meet(a, b, c, d)))
                        ),
                    ),
                )
            )
        ),
        lambda v: v,
    )
    return edges_meet | point_in_polygon(left[0][0], right) | point_in_polygon(right[0][0], left)


def segment_distance_sq(p: Column, a: Column, b: Column) -> Column:
    dx, dy = b["x"] - a["x"], b["y"] - a["y"]
    length = dx * dx + dy * dy
    t = F.when(
        length > 0,
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((p["x"] - a["x"]) * dx + (p["y"] - a["y"]) * dy) / length)),
    ).otherwise(F.lit(0.0))
    ex, ey = p["x"] - a["x"] - t * dx, p["y"] - a["y"] - t * dy
    return ex * ex + ey * ey


def polygon_point_distance(rings: Column, p: Column) -> Column:
    """Distance from a polygon to a point, 0 inside."""
    nearest = F.array_min(F.flatten(F.transform(rings, lambda r: _edges(r, lambda a, b: segment_distance_sq(p, a, b)))))
    return F.when(point_in_polygon(p, rings), F.lit(0.0)).otherwise(F.sqrt(nearest))


# -------------------------------------------------------------- text forms


def _number(v: Column) -> Column:
    return F.regexp_replace(F.format_string("%.7f", v), r"\.?0+$", "")


def to_wkt(rings: Column) -> Column:
    """``POLYGON ((x y, ...))`` with at most 7 decimals."""
    texts = F.transform(
        rings,
        lambda r: F.concat(
            F.lit("("),
            F.array_join(F.transform(r, lambda p: F.concat(_number(p["x"]), F.lit(" "), _number(p["y"]))), ", "),
            F.lit(")"),
        ),
    )
    return F.concat(F.lit("POLYGON ("), F.array_join(texts, ", "), F.lit(")"))


def from_wkt(text: Column) -> Column:
    body = F.regexp_extract(text, r"^\s*POLYGON\s*\(\s*\((.*)\)\s*\)\s*$", 1)
    return F.transform(
        F.split(body, r"\)\s*,\s*\("),
        lambda ring: F.transform(
            F.split(F.trim(ring), r"\s*,\s*"),
            lambda pair: let(
                F.split(F.trim(pair), r"\s+"),
                lambda xy: F.struct(xy[0].cast("double").alias("x"), xy[1].cast("double").alias("y")),
            ),
        ),
    )


def to_geojson_geometry(rings: Column) -> Column:
    return F.struct(
        F.lit("Polygon").alias("type"),
        F.transform(rings, lambda r: F.transform(r, lambda p: F.array(p["x"], p["y"]))).alias("coordinates"),
    )


def from_geojson_coordinates(coordinates: Column) -> Column:
    return F.transform(
        coordinates,
        lambda r: F.transform(r, lambda xy: F.struct(xy[0].alias("x"), xy[1].alias("y"))),
    )
