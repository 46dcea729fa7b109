"""Transverse Mercator (Krueger series, Karney 2011, to n^4) as Column arithmetic.

Working CRS EPSG:3826 and the UTM zones share one parametrised series; the step between WGS84 and
the working datum is null.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# GRS80 ellipsoid.
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257222101

WGS84 = "EPSG:4326"


@dataclass(frozen=True)
class TransverseMercator:
    lon0: float
    k0: float
    false_easting: float
    false_northing: float = 0.0


def crs_parameters(crs: str) -> TransverseMercator:
    code = int(crs.split(":")[1])
    if code == 3826:  # Fixed values: TWD97 / TM2 zone 121
        return TransverseMercator(121.0, 0.9999, 250000.0)
    if 32601 <= code <= 32660:
        return TransverseMercator(-183.0 + 6.0 * (code - 32600), 0.9996, 500000.0)
    if 32701 <= code <= 32760:
        return TransverseMercator(-183.0 + 6.0 * (code - 32700), 0.9996, 500000.0, 10000000.0)
    raise ValueError(f"unsupported CRS {crs}")


N3 = FLATTENING / (2 - FLATTENING)
_n = N3
ECC = 2 * math.sqrt(_n) / (1 + _n)
RECTIFYING = SEMI_MAJOR / (1 + _n) * (1 + _n**2 / 4 + _n**4 / 64)
ALPHA = (
    _n / 2 - 2 * _n**2 / 3 + 5 * _n**3 / 16 + 41 * _n**4 / 180,
    13 * _n**2 / 48 - 3 * _n**3 / 5 + 557 * _n**4 / 1440,
    61 * _n**3 / 240 - 103 * _n**4 / 140,
    49561 * _n**4 / 161280,
)
BETA = (
    _n / 2 - 2 * _n**2 / 3 + 37 * _n**3 / 96 - _n**4 / 360,
    _n**2 / 48 + _n**3 / 15 - 437 * _n**4 / 1440,
    17 * _n**3 / 480 - 37 * _n**4 / 840,
    4397 * _n**4 / 161280,
)
DELTA = (
    2 * _n - 2 * _n**2 / 3 - 2 * _n**3 + 116 * _n**4 / 45,
    7 * _n**2 / 3 - 8 * _n**3 / 5 - 227 * _n**4 / 45,
    56 * _n**3 / 15 - 136 * _n**4 / 35,
    4279 * _n**4 / 630,
)


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it several times inside ``body``."""
    return F.transform(F.array(value), body)[0]


def _conformal(lon: Column, lat: Column, tm: TransverseMercator) -> Column:
    s = F.sin(F.radians(lat))
    return F.struct(
        F.sinh(F.atanh(s) - F.lit(ECC) * F.atanh(F.lit(ECC) * s)).alias("t"),
        F.radians(lon - F.lit(tm.lon0)).alias("dl"),
    )


def _sphere(c: Column) -> Column:
    return F.struct(
        F.atan2(c["t"], F.cos(c["dl"])).alias("xi"),
        F.atanh(F.sin(c["dl"]) / F.sqrt(F.lit(1.0) + c["t"] * c["t"])).alias("eta"),
    )


def _series(xi: Column, eta: Column, coefficients, sign: float) -> tuple[Column, Column]:
    dx, dy = xi, eta
    for j, a in enumerate(coefficients, start=1):
        k = F.lit(2.0 * j)
        dx = dx + F.lit(sign * a) * F.sin(k * xi) * F.cosh(k * eta)
        dy = dy + F.lit(sign * a) * F.cos(k * xi) * F.sinh(k * eta)
    return dx, dy


def _to_plane(s: Column, tm: TransverseMercator) -> Column:
    xi, eta = _series(s["xi"], s["eta"], ALPHA, 1.0)
    scale = F.lit(tm.k0 * RECTIFYING)
    return F.struct(
        (F.lit(tm.false_easting) + scale * eta).alias("x"),
        (F.lit(tm.false_northing) + scale * xi).alias("y"),
    )


def _from_plane(p: Column, tm: TransverseMercator) -> Column:
    scale = F.lit(tm.k0 * RECTIFYING)
    return F.struct(
        ((p["y"] - F.lit(tm.false_northing)) / scale).alias("xi"),
        ((p["x"] - F.lit(tm.false_easting)) / scale).alias("eta"),
    )


def _unwind(s: Column) -> Column:
    xi, eta = _series(s["xi"], s["eta"], BETA, -1.0)
    return F.struct(xi.alias("xi"), eta.alias("eta"))


def _to_lonlat(s: Column, tm: TransverseMercator) -> Column:
    chi = F.asin(F.sin(s["xi"]) / F.cosh(s["eta"]))
    lon = F.lit(tm.lon0) + F.degrees(F.atan2(F.sinh(s["eta"]), F.cos(s["xi"])))
    return F.struct(lon.alias("lon"), chi.alias("chi"))


def _geodetic(s: Column) -> Column:
    lat = s["chi"]
    for j, d in enumerate(DELTA, start=1):
        lat = lat + F.lit(d) * F.sin(F.lit(2.0 * j) * s["chi"])
    return F.struct(s["lon"].alias("x"), F.degrees(lat).alias("y"))


def project_ring(ring: Column, src: str, dst: str) -> Column:
    """Reproject every vertex of an ``ARRAY<STRUCT<x, y>>``; identity when the CRS is the same."""
    if src == dst:
        return ring
    if src == WGS84:
        tm = crs_parameters(dst)
        step = F.transform(ring, lambda p: _conformal(p["x"], p["y"], tm))
        step = F.transform(step, _sphere)
        return F.transform(step, lambda s: _to_plane(s, tm))
    if dst == WGS84:
        tm = crs_parameters(src)
        step = F.transform(ring, lambda p: _from_plane(p, tm))
        step = F.transform(step, _unwind)
        step = F.transform(step, lambda s: _to_lonlat(s, tm))
        return F.transform(step, _geodetic)
    return project_ring(project_ring(ring, src, WGS84), WGS84, dst)


def project_many(df: DataFrame, points: list[tuple], src: str, dst: str) -> DataFrame:
    """Reproject several points per row: ``(x column, y column, out x name, out y name)``.

    Every stage of the series is one projection for all points, so the work stays inside codegen and no
    subexpression is repeated.
    """
    if src == dst:
        return df.withColumns({n: v for x, y, ox, oy in points for n, v in ((ox, x), (oy, y))})
    if src != WGS84 and dst != WGS84:
        mid = [(x, y, f"__lon{i}", f"__lat{i}") for i, (x, y, _, _) in enumerate(points)]
        back = [(F.col(f"__lon{i}"), F.col(f"__lat{i}"), ox, oy) for i, (_, _, ox, oy) in enumerate(points)]
        out = project_many(project_many(df, mid, src, WGS84), back, WGS84, dst)
        return out.drop(*[n for _, _, a, b in mid for n in (a, b)])
    if src == WGS84:
        tm = crs_parameters(dst)
        stages = [_sphere, lambda s: _to_plane(s, tm)]
        first = [_conformal(x, y, tm) for x, y, _, _ in points]
    else:
        tm = crs_parameters(src)
        stages = [_unwind, lambda s: _to_lonlat(s, tm), _geodetic]
        first = [_from_plane(F.struct(x.alias("x"), y.alias("y")), tm) for x, y, _, _ in points]
    names = [f"__s{i}" for i in range(len(points))]
    out = df.withColumns(dict(zip(names, first)))
    for stage in stages:
        out = out.withColumns({n: stage(F.col(n)) for n in names})
    placed = {}
    for n, (_, _, ox, oy) in zip(names, points):
        placed[ox], placed[oy] = F.col(n)["x"], F.col(n)["y"]
    return out.withColumns(placed).drop(*names)


def project_points(df: DataFrame, x: str, y: str, src: str, dst: str, out: tuple[str, str]) -> DataFrame:
    """Reproject one point column pair."""
    return project_many(df, [(F.col(x), F.col(y), *out)], src, dst)
