"""Ring outlines of pixel regions as vertex tables.

Unit edges that two pixels of a region share cancel out; the rest are chained into rings by pointer
doubling, so a ring of n edges takes about log2(n) joins and is never walked by one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.session import cut_lineage

# Directions: 0 east, 1 south, 2 west, 3 north (rows grow southwards); the region lies to the right.
_DR = (0, 1, 0, -1)
_DC = (1, 0, -1, 0)


def boundary_edges(strips: DataFrame, keys: list[str]) -> DataFrame:
    """Directed unit edges (start corner ``r, c`` and direction ``d``) around each region, clockwise."""
    by = [*keys, "component"]
    cells = strips.select(*by, "row", F.explode(F.sequence("c0", "c1")).alias("col"))
    edge = F.array(
        F.struct(F.col("row").alias("r"), F.col("col").alias("c"), F.lit(0).alias("d")),
        F.struct(F.col("row").alias("r"), (F.col("col") + 1).alias("c"), F.lit(1).alias("d")),
        F.struct((F.col("row") + 1).alias("r"), (F.col("col") + 1).alias("c"), F.lit(2).alias("d")),
        F.struct((F.col("row") + 1).alias("r"), F.col("col").alias("c"), F.lit(3).alias("d")),
    )
    edges = cells.select(*by, F.explode(edge).alias("e")).select(*by, "e.*")
    # The undirected edge: an east edge and the west edge ending at its start are the same segment.
    low_r = F.when(F.col("d") == 3, F.col("r") - 1).otherwise(F.col("r"))
    low_c = F.when(F.col("d") == 2, F.col("c") - 1).otherwise(F.col("c"))
    return (
        edges.withColumns({"lr": low_r, "lc": low_c, "vertical": F.col("d") % 2})
        .groupBy(*by, "lr", "lc", "vertical")
        .agg(F.count("*").alias("n"), F.min("r").alias("r"), F.min("c").alias("c"), F.min("d").alias("d"))
        .where("n = 1")
        .select(*by, "r", "c", "d")
    )


def trace_rings(edges: DataFrame, keys: list[str]) -> DataFrame:
    """Give every edge its ring (smallest edge code in it) and its position along the ring.

    Where two pixels of a region touch at a corner only, the right turn is taken, so rings never join
    diagonal neighbours.
    """
    by = [*keys, "component"]
    coded = edges.withColumn("code", F.col("r") * F.lit(1 << 33) + F.col("c") * 4 + F.col("d"))
    end_r = F.element_at(F.array(*[F.lit(v) for v in _DR]), F.col("d") + 1) + F.col("r")
    end_c = F.element_at(F.array(*[F.lit(v) for v in _DC]), F.col("d") + 1) + F.col("c")
    tail = coded.select(*by, "code", "d", end_r.alias("r"), end_c.alias("c"))
    head = coded.select(*by, "r", "c", F.col("code").alias("next"), F.col("d").alias("nd"))
    # Right turn first, then straight on, then left.
    turn = F.pmod(F.col("nd") - F.col("d"), F.lit(4))
    turn_rank = F.when(turn == 1, 0).when(turn == 0, 1).otherwise(2)
    follow = tail.join(head, [*by, "r", "c"]).groupBy(*by, "code").agg(F.min_by("next", turn_rank).alias("jump"))
    state = cut_lineage(follow.select(*by, "code", "jump", F.col("code").alias("low"), F.lit(0).cast("long").alias("steps")))
    span = 1
    while True:
        other = state.select(*by, F.col("code").alias("jump"), F.col("jump").alias("j2"), F.col("low").alias("l2"), F.col("steps").alias("s2"))
        joined = state.join(other, [*by, "jump"])
        better = F.col("l2") < F.col("low")
        state2 = cut_lineage(
            joined.select(
                *by, "code", F.col("j2").alias("jump"), F.when(better, F.col("l2")).otherwise(F.col("low")).alias("low"),
                F.when(better, F.col("s2") + span).otherwise(F.col("steps")).alias("steps"), better.alias("moved"),
            )
        )
        span *= 2
        settled = state2.where("moved").isEmpty()
        state = state2.drop("moved")
        if settled:
            break
    size = state.groupBy(*by, "low").agg(F.count("*").alias("len"))
    rings = state.join(size, [*by, "low"]).withColumn("seq", F.pmod(F.col("len") - F.col("steps"), F.col("len")))
    code = F.col("code")
    return rings.select(
        *by, F.col("low").alias("ring"), "seq", F.shiftright(code, 33).alias("r"),
        F.shiftright(code.bitwiseAND((1 << 33) - 1), 2).alias("c"), code.bitwiseAND(3).cast("int").alias("d"),
    )


def ring_vertices(edges: DataFrame, keys: list[str]) -> DataFrame:
    """Corner vertices of the rings in order (collinear points dropped): ``ring, seq, x (col), y (row)``."""
    by = [*keys, "component", "ring"]
    rings = trace_rings(edges, keys)
    size = rings.groupBy(*by).agg(F.count("*").alias("len"))
    before = rings.join(size, by).select(*by, F.pmod(F.col("seq") + 1, F.col("len")).alias("seq"), F.col("d").alias("pd"))
    return (
        rings.join(before, [*by, "seq"])
        .where("d <> pd")
        .select(*by, "seq", F.col("c").cast("double").alias("x"), F.col("r").cast("double").alias("y"))
    )


def rings_to_polygons(vertices: DataFrame, keys: list[str], a: float, c: float, e: float, f: float) -> DataFrame:
    """One polygon per region (shell first, then holes) in map coordinates of the affine grid.

    A polygon value has to fit a row; for regions too large for that keep the vertex table.
    """
    by = [*keys, "component"]
    ordered = vertices.groupBy(*by, "ring").agg(
        F.sort_array(F.collect_list(F.struct("seq", (F.lit(c) + F.col("x") * a).alias("x"), (F.lit(f) + F.col("y") * e).alias("y")))).alias("v")
    )
    closed = F.transform(F.concat("v", F.slice("v", 1, 1)), lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))
    rings = ordered.select(*by, "ring", closed.alias("ring_points"))
    # The shell holds the region's first pixel corner, the smallest edge code.
    return rings.groupBy(*by).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("ring", "ring_points"))), lambda s: s["ring_points"]).alias("geom")
    )


def outline_stats(strips: DataFrame, keys: list[str]) -> DataFrame:
    """Outline length and signed area per region, from the ordered ring edges."""
    by = [*keys, "component"]
    rings = trace_rings(boundary_edges(strips, keys), keys)
    dr = F.element_at(F.array(*[F.lit(v) for v in _DR]), F.col("d") + 1)
    dc = F.element_at(F.array(*[F.lit(v) for v in _DC]), F.col("d") + 1)
    cross = F.col("c") * (F.col("r") + dr) - (F.col("c") + dc) * F.col("r")
    return rings.groupBy(*by).agg(
        F.count("*").alias("perimeter_px"), (F.sum(cross) / 2).cast("long").alias("area_px")
    )
