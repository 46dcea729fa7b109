"""Spatial joins as equi-joins on grid cells.

Geometries carry a bounding box (``minx, miny, maxx, maxy``). A detection may be stored as many boxes
(row runs of a region): joins then work per piece and are folded per detection, so no row grows with
the size of a region.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldlens.functions import geometry as G
from fieldlens.functions.projection import WGS84, project_many, project_ring
from fieldlens.session import BROADCAST_LIMIT_BYTES, cut_lineage, spread_by

BOX = ("minx", "miny", "maxx", "maxy")

# Metres per degree of the local metric (about 24 degrees north).
LOCAL_M_PER_DEG_LON = 101600.0
LOCAL_M_PER_DEG_LAT = 110750.0


def _cells(low: Column, high: Column, cell: float) -> Column:
    return F.sequence(F.floor(low / cell).cast("long"), F.floor(high / cell).cast("long"))


def cover(df: DataFrame, cell: float, grow: float = 0.0) -> DataFrame:
    """One row per grid cell (``cx, cy``) that the bounding box, grown by ``grow``, touches."""
    c = F.col
    return df.withColumn("cx", F.explode(_cells(c("minx") - grow, c("maxx") + grow, cell))).withColumn(
        "cy", F.explode(_cells(c("miny") - grow, c("maxy") + grow, cell))
    )


def _named(df: DataFrame, side: str) -> DataFrame:
    return df.withColumnsRenamed({b: f"{side}_{b}" for b in BOX})


def candidate_pairs(left: DataFrame, right: DataFrame, on: list[str], cell: float) -> DataFrame:
    """Pairs whose closed bounding boxes meet, each once.

    Choose ``cell`` near the size of the geometries that tile the plane. A pair is kept only in the cell
    of the lower-left corner of the common box, so no distinct is needed.
    """
    lhs, rhs = _named(cover(left, cell), "l"), _named(cover(right, cell), "r")
    c = F.col
    x, y = F.greatest("l_minx", "r_minx"), F.greatest("l_miny", "r_miny")
    meets = (
        (c("l_minx") <= c("r_maxx"))
        & (c("r_minx") <= c("l_maxx"))
        & (c("l_miny") <= c("r_maxy"))
        & (c("r_miny") <= c("l_maxy"))
    )
    once = (c("cx") == F.floor(x / cell)) & (c("cy") == F.floor(y / cell))
    return spread_by(lhs, *on, "cx", "cy").join(rhs, [*on, "cx", "cy"]).where(meets & once).drop("cx", "cy")


def common_box(pairs: DataFrame) -> DataFrame:
    return pairs.withColumns(
        {
            "ix0": F.greatest("l_minx", "r_minx"),
            "iy0": F.greatest("l_miny", "r_miny"),
            "ix1": F.least("l_maxx", "r_maxx"),
            "iy1": F.least("l_maxy", "r_maxy"),
        }
    )


def project_box(df: DataFrame, box: tuple[str, str, str, str], unit: float, crs: str, prefix: str = "q") -> DataFrame:
    """Corners of a lon/lat box in the plane as columns ``{prefix}x0, {prefix}y0 .. {prefix}x3, {prefix}y3``."""
    x0, y0, x1, y1 = (F.col(n) * F.lit(unit) for n in box)
    corners = [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]
    return project_many(df, [(x, y, f"{prefix}x{i}", f"{prefix}y{i}") for i, (x, y) in enumerate(corners)], WGS84, crs)


def quad_columns(prefix: str = "q") -> list[str]:
    return [f"{prefix}{a}{i}" for i in range(4) for a in "xy"]


def quad_area(prefix: str = "q") -> Column:
    """Area of a projected box, relative to its first corner."""

    def rel(axis: str, i: int) -> Column:
        return F.col(f"{prefix}{axis}{i}") - F.col(f"{prefix}{axis}0")

    twice = sum((rel("x", i) * rel("y", i + 1) - rel("x", i + 1) * rel("y", i) for i in (1, 2)), F.lit(0.0))
    return F.abs(twice) / 2


def quad_point_distance(px: str, py: str, prefix: str = "q") -> Column:
    """Distance of a point outside a projected box to its outline."""
    p = {"x": F.col(px), "y": F.col(py)}
    corner = [{a: F.col(f"{prefix}{a}{i}") for a in "xy"} for i in range(4)]
    return F.sqrt(F.least(*[G.segment_distance_sq(p, corner[i], corner[(i + 1) % 4]) for i in range(4)]))


def intersect_boxes(
    left: DataFrame, right: DataFrame, on: list[str], cell: float, unit: float = 1.0, crs: str | None = None,
    out: str = "overlap_area_m2",
) -> DataFrame:
    """Inner join on ``on`` and touching-or-overlapping boxes, with the overlap area (0 when touching).

    The area is measured after projecting the common box to ``crs``, or in the local metric without one;
    ``unit`` is degrees per coordinate unit.
    """
    pairs = common_box(candidate_pairs(left, right, on, cell))
    if crs is not None:
        measured = project_box(pairs, ("ix0", "iy0", "ix1", "iy1"), unit, crs)
        return measured.withColumn(out, quad_area()).drop(*quad_columns())
    dx, dy = F.col("ix1") - F.col("ix0"), F.col("iy1") - F.col("iy0")
    return pairs.withColumn(out, dx * F.lit(unit * LOCAL_M_PER_DEG_LON) * (dy * F.lit(unit * LOCAL_M_PER_DEG_LAT)))


def fold_pieces(pairs: DataFrame, by: list[str], carry: list[str], out: str = "overlap_area_m2") -> DataFrame:
    """Add up piece overlaps to one row per pair of whole geometries."""
    return pairs.groupBy(*by).agg(F.sum(out).alias(out), *[F.first(c).alias(c) for c in carry])


def intersect_polygons(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    left_id: str,
    right_id: str,
    cell: float,
    crs: str,
    out: str = "overlap_area_m2",
) -> DataFrame:
    """Inner join of polygons (``l_geom`` / ``r_geom``, rings in lon/lat) that share at least a point.

    The overlap is the signed sum of triangle intersections, each measured after projection. Triangles
    are rows, so a polygon with many vertices is shared out over tasks.
    """
    pairs = candidate_pairs(left, right, on, cell).where(G.polygons_intersect(F.col("l_geom"), F.col("r_geom")))
    keys = [*on, left_id, right_id]
    payload = [c for c in pairs.columns if c not in keys]
    tri = (
        pairs.select(*keys, F.explode_outer(G.fan_triangles(F.col("l_geom"))).alias("a"), "r_geom")
        .select(*keys, "a", F.explode_outer(G.fan_triangles(F.col("r_geom"))).alias("b"))
        .withColumn("part", G.clip_triangle(F.col("a.tri"), F.col("b.tri")))
        .withColumn(
            "area",
            F.when(F.size("part") >= 4, F.abs(G.signed_area(project_ring(F.col("part"), WGS84, crs)))).otherwise(0.0)
            * F.col("a.sign")
            * F.col("b.sign"),
        )
    )
    areas = tri.groupBy(*keys).agg(F.greatest(F.lit(0.0), F.coalesce(F.sum("area"), F.lit(0.0))).alias(out))
    return pairs.select(*keys, *payload).join(areas, keys)


# ----------------------------------------------------------------- nearest

_FANOUT = 8
_MAX_LEVEL = 7


def _point_tree(points: DataFrame, on: list[str], leaf: int):
    """Occupied cells of a grid that is refined eightfold wherever a cell holds more than ``leaf`` points."""
    box = points.agg(
        F.min("px").alias("x0"), F.min("py").alias("y0"), F.max("px").alias("x1"), F.max("py").alias("y1")
    ).first()
    if box.x0 is None:
        return None
    side = max(box.x1 - box.x0, box.y1 - box.y0, 1e-9) * (1 + 1e-9)
    sizes = [side / _FANOUT**lvl for lvl in range(_MAX_LEVEL + 1)]
    size = F.element_at(F.array(*[F.lit(s) for s in sizes]), F.col("level") + 1)
    placed = points.withColumn("level", F.explode(F.array(*[F.lit(v) for v in range(_MAX_LEVEL + 1)])))
    placed = placed.withColumns(
        {
            "ix": F.floor((F.col("px") - box.x0) / size).cast("long"),
            "iy": F.floor((F.col("py") - box.y0) / size).cast("long"),
        }
    )
    counts = placed.groupBy(*on, "level", "ix", "iy").agg(F.count("*").alias("n"))
    heavy = counts.where(f"n > {leaf} AND level < {_MAX_LEVEL}").select(
        *on, (F.col("level") + 1).alias("level"), F.col("ix").alias("up_x"), F.col("iy").alias("up_y")
    )
    under = counts.withColumns({"up_x": F.expr(f"ix div {_FANOUT}"), "up_y": F.expr(f"iy div {_FANOUT}")})
    nodes = under.where("level = 0").unionByName(under.join(heavy, [*on, "level", "up_x", "up_y"], "left_semi"))
    nodes = cut_lineage(nodes.withColumn("is_leaf", F.expr(f"n <= {leaf} OR level = {_MAX_LEVEL}")))
    stats = nodes.agg(F.count("*").alias("n"), F.max("level").alias("depth")).first()
    cell = [*on, "level", "ix", "iy"]
    # The points of a leaf in one row; only leaves of the last level hold more than ``leaf`` and are cut into parts.
    held = placed.join(nodes.where("is_leaf").select(*cell, "n"), cell)
    part = F.pmod(F.xxhash64("px", "py"), F.greatest(F.lit(1), F.expr(f"n div {leaf}")))
    held = held.groupBy(*cell, part.alias("part")).agg(F.sort_array(F.collect_list(F.struct("pid", "px", "py"))).alias("points")).drop("part")
    held = held.withColumns({"xs": F.transform("points", lambda p: p["px"]), "ys": F.transform("points", lambda p: p["py"])})
    return nodes, held, stats, (box.x0, box.y0), sizes


def nearest_point(
    left: DataFrame, points: DataFrame, on: list[str], left_key: list[str], leaf: int = 64, distance_sq=None
) -> DataFrame:
    """Nearest point of the same group for every left geometry, exact for any density.

    ``left`` has ``on``, ``left_key`` and a bounding box; ``points`` has ``on``, ``pid``, ``px``, ``py``.
    Ties go to the smallest ``pid``. The search descends a grid tree of the points: in each round the
    cells that cannot hold the nearest point are dropped, so the candidates per geometry stay few even
    when one group or spot holds most points. ``distance_sq(row columns)`` may refine the box distance
    for other shapes (it must not be below the box distance, nor above that to the box's far corners).
    Returns ``left`` with ``pid, px, py, d2``, null where the group has no points.
    """
    own = points.groupBy(*on, "px", "py").agg(F.min("pid").alias("pid"))
    tree = _point_tree(own, on, leaf)
    none = {"pid": points.schema["pid"].dataType, "px": "double", "py": "double", "d2": "double"}
    if tree is None:
        return left.withColumns({k: F.lit(None).cast(t) for k, t in none.items()})
    nodes, held, stats, (ox, oy), sizes = tree
    key = list(dict.fromkeys([*on, *left_key]))
    small = stats.n * 96 <= BROADCAST_LIMIT_BYTES
    extra = [c for c in left.columns if c not in (*key, *BOX)] if distance_sq is not None else []
    # A broadcast tree leaves the rows where they are: dealt out by key once, they need no shuffle for the rounds, the fold and the last join.
    left = spread_by(left, *key) if small else left
    slim = left.select(*key, *BOX, *extra)
    c = F.col

    def pruned(frontier: DataFrame) -> DataFrame:
        size = F.element_at(F.array(*[F.lit(s) for s in sizes]), c("level") + 1)
        x0, y0 = F.lit(ox) + c("ix") * size, F.lit(oy) + c("iy") * size
        x1, y1 = x0 + size, y0 + size
        gap_x = F.greatest(F.lit(0.0), x0 - c("maxx"), c("minx") - x1)
        gap_y = F.greatest(F.lit(0.0), y0 - c("maxy"), c("miny") - y1)
        far_x = F.greatest(F.abs(x0 - c("minx")), F.abs(x1 - c("minx")), F.abs(x0 - c("maxx")), F.abs(x1 - c("maxx")))
        far_y = F.greatest(F.abs(y0 - c("miny")), F.abs(y1 - c("miny")), F.abs(y0 - c("maxy")), F.abs(y1 - c("maxy")))
        bounded = frontier.withColumns(
            {"near": (gap_x * gap_x + gap_y * gap_y) * (1 - 1e-9), "far": far_x * far_x + far_y * far_y}
        ).withColumn("limit", F.min("far").over(Window.partitionBy(*key)))
        return bounded.where("near <= limit").drop("near", "far", "limit")

    root = nodes.where("level = 0").select(*on, "level", "ix", "iy", "is_leaf")
    frontier = slim.join(F.broadcast(root) if small else root, on) if on else slim.crossJoin(F.broadcast(root))
    for n in range(1, (stats.depth or 0) + 1):
        # A left join opens the cells of the level above and keeps the others: a union would read the rows twice a round.
        below = nodes.where(c("level") == n).select(
            *on, (c("level") - 1).alias("level"), c("up_x").alias("ix"), c("up_y").alias("iy"),
            c("ix").alias("sub_x"), c("iy").alias("sub_y"), c("is_leaf").alias("sub_leaf"),
        )
        opened = frontier.join(F.broadcast(below) if small else below, [*on, "level", "ix", "iy"], "left").select(
            *key, *BOX, *extra, F.when(c("sub_x").isNull(), c("level")).otherwise(n).alias("level"),
            F.coalesce("sub_x", "ix").alias("ix"), F.coalesce("sub_y", "iy").alias("iy"), F.coalesce("sub_leaf", "is_leaf").alias("is_leaf"),
        )
        frontier = pruned(opened)
    found = frontier.join(F.broadcast(held) if small else held, [*on, "level", "ix", "iy"])

    def gap(low: str, high: str):
        return lambda v: F.greatest(F.lit(0.0), v - c(high), c(low) - v)

    # One row per geometry and leaf goes on, not one per point: the aggregate of a struct sorts its rows. Each gap is worked out once a point;
    # points are in order of their id, so the first at the least distance is the one of the smallest id.
    if distance_sq is None:
        gaps = F.zip_with(F.transform("xs", gap("minx", "maxx")), F.transform("ys", gap("miny", "maxy")), lambda a, b: a * a + b * b)
        found = found.select(*key, "points", gaps.alias("gaps")).withColumn("d2", F.array_min("gaps"))
        first = F.element_at("points", F.array_position("gaps", c("d2")).cast("int"))
        found = found.select(*key, F.struct("d2", first.alias("p")).alias("best"))
    else:
        at = F.struct("pid", "px", "py").alias("p")
        found = found.drop("xs", "ys").select("*", F.inline("points")).select(*key, F.struct(distance_sq().alias("d2"), at).alias("best"))
    best = (found if small else spread_by(found, *key)).groupBy(*key).agg(F.min("best").alias("best"))
    return left.join(best.select(*key, "best.p.pid", "best.p.px", "best.p.py", "best.d2"), key, "left")


# ------------------------------------------------------------ within radius


HOT_CELL_ROWS = 100_000


def points_within(
    points: DataFrame, shapes: DataFrame, radius: float, on: list[str], hot_rows: int = HOT_CELL_ROWS
) -> DataFrame:
    """Points of ``px, py`` with at least one shape within ``radius`` (inclusive), as a semi-join.

    Shapes carry a bounding box and, when they are not boxes, a ``ring`` in the same metric plane. They are
    spread over the cells they touch, of twice the radius; a point looks into the (at most four) cells within
    the radius, so the many shapes are multiplied little and the few points a bounded number of times. Equal
    shapes count once. A semi-join cannot split its right side, so a cell with more than ``hot_rows`` shapes
    is cut into parts and its points look into each part; the list of such cells has at most
    rows / ``hot_rows`` entries. Rows of ``points`` are distinct (they carry an id).
    """
    side = 2 * radius
    near = cover(shapes.dropDuplicates(), side)
    cell = [*on, "cx", "cy"]
    hot = near.groupBy(*cell).agg(F.count("*").alias("n")).where(F.col("n") > hot_rows)
    hot = F.broadcast(hot.select(*cell, F.ceil(F.col("n") / hot_rows).cast("int").alias("parts")))
    near = near.join(hot, cell, "left").withColumn(
        "part", F.pmod(F.xxhash64(*shapes.columns), F.coalesce("parts", F.lit(1))).cast("int")
    )
    # A little more than the radius, so that rounding of the sum hides no cell; the distance decides.
    reach = F.lit(radius * (1 + 1e-6))
    at = points.withColumn("cx", F.explode(_cells(F.col("px") - reach, F.col("px") + reach, side)))
    at = at.withColumn("cy", F.explode(_cells(F.col("py") - reach, F.col("py") + reach, side))).join(hot, cell, "left")
    at = at.withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)))
    at, near = at.alias("p"), near.alias("s")
    c = F.col
    cond = c("p.part") == c("s.part")
    for k in cell:
        cond = cond & (c(f"p.{k}") == c(f"s.{k}"))
    dx = F.greatest(F.lit(0.0), c("p.px") - c("s.maxx"), c("s.minx") - c("p.px"))
    dy = F.greatest(F.lit(0.0), c("p.py") - c("s.maxy"), c("s.miny") - c("p.py"))
    cond = cond & (dx * dx + dy * dy <= F.lit(radius * radius))
    if "ring" in shapes.columns:
        p = F.struct(c("p.px").alias("x"), c("p.py").alias("y"))
        cond = cond & (G.polygon_point_distance(F.array(c("s.ring")), p) <= F.lit(radius))
    found = at.join(near, cond, "left_semi")
    return found.select(*points.columns).dropDuplicates()
