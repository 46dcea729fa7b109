"""Connected components: of pixels (block-local labels merged over block borders) and of graphs.

Pixels are labelled inside bounded blocks first, so only regions that touch a block border enter the
iterative graph step, and no task ever holds more than one block.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldlens.session import cut_lineage, ship_package

DEFAULT_BLOCK = 128


def connected_components(edges: DataFrame, keys: list[str], max_rounds: int = 60) -> DataFrame:
    """Large-star / small-star label contraction (Kiveris et al. 2014).

    ``edges`` has ``keys``, ``src`` and ``dst`` (LONG). Returns ``keys``, ``node`` and ``component``,
    the smallest node of each component. Every round is cut by a reliable checkpoint. Hubs appear only
    on the many side of many-to-one joins, which the skew-join rule can split.
    """
    current = cut_lineage(
        edges.where("src <> dst")
        .select(*keys, F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v"))
        .distinct()
    )
    seen = _fingerprint(current)
    for _ in range(max_rounds):
        both = current.unionByName(current.select(*keys, F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy(*keys, "u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = (
            both.where("v > u").join(low, [*keys, "u"]).select(*keys, F.col("v").alias("u"), F.col("m").alias("v"))
        ).distinct()
        low = large.groupBy(*keys, "u").agg(F.min("v").alias("m"))
        small = large.join(low, [*keys, "u"])
        merged = (
            small.where("v <> m")
            .select(*keys, F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select(*keys, "u", F.col("m").alias("v")))
            .distinct()
        )
        current = cut_lineage(merged)
        now = _fingerprint(current)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("component labels did not settle")
    roots = current.select(*keys, F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(*keys, F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(
            F.count("*"), F.sum(F.pmod(F.xxhash64(*edges.columns), F.lit(1 << 40))), F.sum(F.col("v") % (1 << 30))
        ).first()
    )


def _strips_of_block(row: np.ndarray, col: np.ndarray, reach: int):
    """Row runs of one block and the label (smallest run index) of the region each belongs to."""
    order = np.lexsort((col, row))
    row, col = row[order], col[order]
    fresh = np.ones(len(row), dtype=bool)
    fresh[1:] = (row[1:] != row[:-1]) | (col[1:] != col[:-1] + 1)
    start = np.flatnonzero(fresh)
    r, c0 = row[start], col[start]
    c1 = col[np.append(start[1:], len(row)) - 1]
    begin, end = (r << 32) | c0, (r << 32) | c1
    below = (r + 1) << 32
    lo = np.searchsorted(end, below | np.maximum(c0 - reach, 0), "left")
    hi = np.searchsorted(begin, below | (c1 + reach), "right")
    width = np.maximum(hi - lo, 0)
    a = np.repeat(np.arange(len(r)), width)
    b = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width) + np.repeat(lo, width)
    label = np.arange(len(r))
    while True:
        low = np.minimum(label[a], label[b])
        nxt = label.copy()
        for at in (a, b, label[a], label[b]):
            np.minimum.at(nxt, at, low)
        nxt = nxt[nxt]
        if np.array_equal(nxt, label):
            return order, start, r, c0, c1, label
        label = nxt


def block_strips(
    mask: DataFrame, keys: list[str], values: list[str], block: int, connectivity: int = 4
) -> DataFrame:
    """Row runs of every block with block-local region codes.

    ``mask`` holds one row per set pixel (``keys``, ``row``, ``col``, ``values`` and, when it comes out
    of :func:`fieldlens.operators.raster.binary_open`, ``blk_r``/``blk_c`` whose partitioning is reused).
    The region code is ``row * 2^32 + col`` of its first pixel.
    """
    ship_package(mask.sparkSession)
    if "blk_r" not in mask.columns:
        mask = mask.withColumns({"blk_r": F.expr(f"row div {block}"), "blk_c": F.expr(f"col div {block}")})
    mask = mask.select(*keys, "blk_r", "blk_c", F.col("row").cast("long"), F.col("col").cast("long"), *values)
    schema = T.StructType(
        [f for f in mask.schema.fields if f.name in (*keys, "blk_r", "blk_c")]
        + [T.StructField(n, T.LongType()) for n in ("node", "row", "c0", "c1", "n_px")]
        + [T.StructField(v, T.DoubleType()) for v in values]
    )
    reach = 0 if connectivity == 4 else 1

    def label(pdf: pd.DataFrame) -> pd.DataFrame:
        order, start, r, c0, c1, lab = _strips_of_block(pdf["row"].to_numpy(), pdf["col"].to_numpy(), reach)
        out = {k: [pdf[k].iat[0]] * len(r) for k in (*keys, "blk_r", "blk_c")}
        out.update(node=(r[lab] << 32) | c0[lab], row=r, c0=c0, c1=c1, n_px=c1 - c0 + 1)
        for v in values:
            out[v] = np.add.reduceat(pdf[v].to_numpy(dtype="float64")[order], start)
        return pd.DataFrame(out)

    return mask.groupBy(*keys, "blk_r", "blk_c").applyInPandas(label, schema)


def border_links(strips: DataFrame, keys: list[str], block: int) -> DataFrame:
    """Pairs of local regions that meet across a block border (4-neighbours)."""
    right = strips.where(f"(c1 + 1) % {block} = 0").select(
        *keys, "row", (F.col("c1") + 1).alias("c0"), F.col("node").alias("src")
    )
    left = strips.where(f"c0 % {block} = 0").select(*keys, "row", "c0", F.col("node").alias("dst"))
    across = right.join(left, [*keys, "row", "c0"]).select(*keys, "src", "dst")
    upper = strips.where(f"(row + 1) % {block} = 0").select(
        *keys, (F.col("row") + 1).alias("row"), "blk_c", F.col("c0").alias("a0"), F.col("c1").alias("a1"),
        F.col("node").alias("src"),
    )
    lower = strips.where(f"row % {block} = 0").select(
        *keys, "row", "blk_c", F.col("c0").alias("b0"), F.col("c1").alias("b1"), F.col("node").alias("dst")
    )
    down = (
        upper.join(lower, [*keys, "row", "blk_c"]).where("a0 <= b1 AND b0 <= a1").select(*keys, "src", "dst")
    )
    return across.unionByName(down).distinct()


def label_strips(
    mask: DataFrame,
    keys: list[str],
    values: list[str] = (),
    block: int = DEFAULT_BLOCK,
    merge: bool = True,
) -> DataFrame:
    """4-connected regions of a pixel set as row runs with a ``component`` code.

    ``merge=False`` keeps regions apart at block borders: the tiled detector, with ``block`` as its tile.
    """
    strips = block_strips(mask, keys, list(values), block)
    if not merge:
        return strips.withColumn("component", F.col("node"))
    strips = cut_lineage(strips)
    links = cut_lineage(border_links(strips, keys, block))
    if links.isEmpty():
        return strips.withColumn("component", F.col("node"))
    labels = connected_components(links, keys)
    return strips.join(labels, [*keys, "node"], "left").withColumn("component", F.coalesce("component", "node"))


def component_stats(strips: DataFrame, keys: list[str], values: list[str] = (), area=None) -> DataFrame:
    """Size, extent and zonal means per region. ``area`` is the area Column of one strip."""
    by = [*keys, "component"]
    aggs = [
        F.sum("n_px").alias("n_px"),
        F.min("row").alias("min_row"),
        F.max("row").alias("max_row"),
        F.min("c0").alias("min_col"),
        F.max("c1").alias("max_col"),
    ]
    if area is not None:
        aggs.append(F.sum(area).alias("area_m2"))
    aggs += [(F.sum(v) / F.sum("n_px")).alias(v) for v in values]
    return strips.groupBy(*by).agg(*aggs)
