"""Raster operators over pixel and tile tables, keyed by area and run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldlens.functions.spectral import change_predicate, ndbi, ndvi
from fieldlens.operators.components import DEFAULT_BLOCK


def _zipped(arrays: list[Column]) -> Column:
    """``arrays_zip`` that refuses arrays of different lengths instead of padding them."""
    unequal = F.lit(False)
    for a in arrays[1:]:
        unequal = unequal | F.coalesce(F.size(a) != F.size(arrays[0]), F.lit(False))
    size = F.when(unequal, F.raise_error(F.lit("band arrays of a tile differ in length")).cast("int")).otherwise(F.size(arrays[0]))
    return F.slice(F.arrays_zip(*arrays), 1, size)


def tiles_to_pixels(tiles: DataFrame, bands: list[str], keys: list[str], needed: Column | None = None) -> DataFrame:
    """One row per pixel from tile rows holding a band array map (row-major arrays)."""
    arrays = [F.element_at("bands", b).alias(b) for b in bands]
    df = tiles.select(*keys, "r0", "c0", "w", *arrays)
    df = df.select(*keys, "r0", "c0", "w", _zipped([F.col(b) for b in bands]).alias("px"))
    df = df.select(*keys, "r0", "c0", "w", F.posexplode("px").alias("pos", "v"))
    out = df.select(
        *keys,
        (F.col("r0") + F.expr("pos div w")).cast("int").alias("row"),
        (F.col("c0") + F.expr("pos % w")).cast("int").alias("col"),
        *[F.col(f"v.{b}").alias(b) for b in bands],
    )
    return out.where(needed) if needed is not None else out


def check_same_grid(manifest: DataFrame) -> DataFrame:
    """Areas whose two dates share one grid; differing grids raise instead of losing pixels."""
    grid = F.struct("crs", "transform", "height", "width")
    pairs = manifest.groupBy("aoi").agg(
        F.count_distinct("t_label").alias("n_dates"), F.count_distinct(grid).alias("n_grids"),
        F.first("height").alias("h"), F.first("width").alias("w"),
    )
    return (
        pairs.where("n_dates >= 2")
        .withColumn(
            "h",
            F.when(
                F.col("n_grids") > 1,
                F.raise_error(F.concat(F.lit("dates of area "), F.col("aoi"), F.lit(" have different grids"))).cast("int"),
            ).otherwise(F.col("h")),
        )
        .select("aoi", "h", "w")
    )


def pair_tiles(tiles: DataFrame) -> DataFrame:
    """Align the tiles of both dates; a tile missing on one date raises."""
    names = ["aoi", "tile_r", "tile_c", "r0", "c0", "h", "w"]
    t0 = tiles.where("t_label = 't0'").select(*names, F.col("bands").alias("bands_t0"))
    t1 = tiles.where("t_label = 't1'").select(*names, F.col("bands").alias("bands_t1"))
    joined = t0.join(t1, names, "full")
    missing = F.col("bands_t0").isNull() | F.col("bands_t1").isNull()
    return joined.withColumn(
        "bands_t0",
        F.when(missing, F.raise_error(F.lit("tile present on one date only")).cast(joined.schema["bands_t0"].dataType))
        .otherwise(F.col("bands_t0")),
    )


def paired_tiles_to_pixels(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Pixels of both dates from aligned tiles with the three index bands."""
    cols = [
        F.element_at(f"bands_{t}", band).alias(f"{band.lower()}_{t}")
        for t in ("t0", "t1")
        for band in ("B04", "B08", "B11")
    ]
    names = [f"{b}_{t}" for t in ("t0", "t1") for b in ("b04", "b08", "b11")]
    pairs = pairs.select(*keys, "r0", "c0", "w", *[c.alias(n) for c, n in zip(cols, names)])
    pairs = pairs.select(*keys, "r0", "c0", "w", _zipped([F.col(n) for n in names]).alias("px"))
    df = pairs.select(*keys, "r0", "c0", "w", F.posexplode("px").alias("pos", "v"))
    return df.select(
        *keys,
        (F.col("r0") + F.expr("pos div w")).cast("int").alias("row"),
        (F.col("c0") + F.expr("pos % w")).cast("int").alias("col"),
        *[F.col(f"v.{n}").alias(n) for n in names],
    )


def index_change(pixels: DataFrame, dtype: str = "double", mask_nodata: bool = False) -> DataFrame:
    """Add ``ndbi_delta`` and ``ndvi_drop``. A pixel without data counts as index 0, as plain band
    arithmetic has it; ``mask_nodata`` drops pixels without data on either date instead."""
    c = F.col
    if mask_nodata:
        pixels = pixels.where("b04_t0 + b08_t0 + b11_t0 <> 0 AND b04_t1 + b08_t1 + b11_t1 <> 0")
    delta = ndbi(c("b11_t1"), c("b08_t1"), dtype) - ndbi(c("b11_t0"), c("b08_t0"), dtype)
    drop = ndvi(c("b08_t0"), c("b04_t0"), dtype) - ndvi(c("b08_t1"), c("b04_t1"), dtype)
    return pixels.withColumns({"ndbi_delta": delta, "ndvi_drop": drop})


def change_mask(pixels: DataFrame, ndbi_min: float, ndvi_min: float) -> DataFrame:
    return pixels.where(change_predicate(F.col("ndbi_delta"), F.col("ndvi_drop"), ndbi_min, ndvi_min))


def grid_extents(pixels: DataFrame, keys: list[str]) -> DataFrame:
    return pixels.groupBy(*keys).agg(
        (F.max("row") + 1).cast("int").alias("h"), (F.max("col") + 1).cast("int").alias("w")
    )


# ------------------------------------------------------------- morphology

_CROSS = ((0, 0), (1, 0), (-1, 0), (0, 1), (0, -1))


def _shift(name: str, by: int, size: str, edge: str) -> Column:
    moved = F.col(name) + F.lit(by)
    return (F.pmod(moved, F.col(size)) if edge == "wrap" else moved).cast("int")


def _with_halo_blocks(mask: DataFrame, block: int, edge: str) -> DataFrame:
    """Send each pixel to its own block and to the blocks that see it within two pixels."""

    def blocks(name: str, size: str) -> Column:
        def block_of(by: int) -> Column:
            at = _shift(name, by, size, edge)
            if edge != "wrap":
                at = F.greatest(F.lit(0), F.least(at, F.col(size) - 1))
            return F.floor(at / block).cast("int")

        inner = (F.col(name) % block).between(2, block - 3) & (F.col(name) >= 2) & (F.col(name) < F.col(size) - 2)
        around = F.array_distinct(F.array(*[block_of(by) for by in range(-2, 3)]))
        return F.explode(F.when(inner, F.array(block_of(0))).otherwise(around))

    return mask.withColumn("blk_r", blocks("row", "h")).withColumn("blk_c", blocks("col", "w"))


def binary_open(
    mask: DataFrame,
    extents: DataFrame | None,
    keys: list[str],
    values: list[str] = (),
    iters: int = 1,
    edge: str = "wrap",
    block: int = DEFAULT_BLOCK,
) -> DataFrame:
    """4-neighbour erosion then dilation of a sparse mask (one row per set pixel).

    A pixel survives the erosion when it receives all five contributions of its cross; ``edge='wrap'``
    lets the grid wrap around, ``'clip'`` treats the outside as unset. Opening is idempotent, so one pass
    equals any number of ``iters >= 1``. The mask is shuffled once, by block with a halo of two pixels:
    both groupings below group by finer keys and stay inside their block. A mask that carries the size of its
    grid (``h``, ``w``), as those from tiles do, needs no ``extents``.
    """
    values = list(values)
    if iters <= 0:
        return mask.select(*keys, "row", "col", *values)
    if extents is None:
        sized = mask.select(*keys, "row", "col", *values, "h", "w")
    else:
        sized = mask.select(*keys, "row", "col", *values).join(extents, keys)
    blocked = _with_halo_blocks(sized, block, edge).select(
        *keys, "h", "w", "blk_r", "blk_c", "row", "col",
        *[F.col(v).cast("double").alias(v) for v in values],
    )
    place = [*keys, "h", "w", "blk_r", "blk_c"]
    blocked = blocked.repartition(*keys, "blk_r", "blk_c")

    def target(dr: int, dc: int, hit: Column) -> Column:
        own = (dr, dc) == (0, 0)
        return F.struct(
            _shift("row", dr, "h", edge).alias("row"),
            _shift("col", dc, "w", edge).alias("col"),
            F.lit(1 if own else 0).alias("own"),
            hit.alias("hit"),
            *[(F.col(v) if own else F.lit(None).cast("double")).alias(v) for v in values],
        )

    def spread(df: DataFrame, targets: Column, fold) -> DataFrame:
        exploded = df.select(*place, F.explode(targets).alias("t")).select(*place, "t.*")
        return (
            exploded.groupBy(*place, "row", "col")
            .agg(F.max("own").alias("own"), fold("hit").alias("hit"), *[F.max(v).alias(v) for v in values])
            .where("own = 1")
        )

    one = F.lit(1)
    eroded = spread(blocked, F.array(*[target(r, c, one) for r, c in _CROSS]), F.sum)
    kept = F.when(F.col("hit") == 5, 1).otherwise(0)
    dilate = F.when(F.col("hit") == 5, F.array(*[target(r, c, one) for r, c in _CROSS])).otherwise(
        F.array(target(0, 0, kept))
    )
    opened = spread(eroded, dilate, F.max).where("hit = 1")
    home = (F.floor(F.col("row") / block) == F.col("blk_r")) & (F.floor(F.col("col") / block) == F.col("blk_c"))
    return opened.where(home).select(*keys, "blk_r", "blk_c", "row", "col", *values)


# ------------------------------------------------------------------- tiles


def tile_pixels(tile_size_m: float, resolution_m: float = 10.0) -> int:
    return max(8, round(tile_size_m / resolution_m))


def tile_grid(extents: DataFrame, tile_px: int, keys: list[str]) -> DataFrame:
    """Tiles covering each h x w grid; the last ones are ragged."""
    rows = extents.withColumn("r0", F.explode(F.sequence(F.lit(0), F.col("h") - 1, F.lit(tile_px))))
    cells = rows.withColumn("c0", F.explode(F.sequence(F.lit(0), F.col("w") - 1, F.lit(tile_px))))
    return cells.select(
        *keys,
        "r0",
        F.least(F.col("r0") + tile_px, F.col("h")).alias("r1"),
        "c0",
        F.least(F.col("c0") + tile_px, F.col("w")).alias("c1"),
    )


def window_of_bounds(a: Column, c: Column, e: Column, f: Column, h: Column, w: Column, b: Column) -> Column:
    """Pixel window of bounds in the raster CRS, clamped to the grid; the whole grid when empty or null."""

    def px(v: Column) -> Column:  # cast truncates towards zero
        return v.cast("int")

    c0 = F.greatest(F.lit(0), px((b["minx"] - c) / a))
    c1 = F.least(w, px((b["maxx"] - c) / a))
    r0 = F.greatest(F.lit(0), px((b["maxy"] - f) / e))
    r1 = F.least(h, px((b["miny"] - f) / e))
    given = b["minx"].isNotNull() & b["miny"].isNotNull() & b["maxx"].isNotNull() & b["maxy"].isNotNull()
    ok = given & (r1 > r0) & (c1 > c0)
    return F.struct(
        F.when(ok, r0).otherwise(F.lit(0)).alias("r0"),
        F.when(ok, r1).otherwise(h).alias("r1"),
        F.when(ok, c0).otherwise(F.lit(0)).alias("c0"),
        F.when(ok, c1).otherwise(w).alias("c1"),
    )


def crop(pixels: DataFrame, windows: DataFrame, keys: list[str]) -> DataFrame:
    """Pixels inside the window (``r0 <= row < r1``, ``c0 <= col < c1``) of their area."""
    return (
        pixels.join(windows, keys)
        .where("row >= r0 AND row < r1 AND col >= c0 AND col < c1")
        .drop("r0", "r1", "c0", "c1")
    )


# ----------------------------------------------------------------- regrid


def bilinear_upsample(
    pixels: DataFrame, keys: list[str], value: str, factor: int, extents: DataFrame
) -> DataFrame:
    """Bilinear resampling to a grid ``factor`` times finer (pixel-centre convention, outside is 0).

    Every source pixel sends its weighted value to the target pixels in its support, so one grouping
    does the whole job. For coarser targets average instead; the kernel is not widened.
    """
    half = 1.0 / factor

    def reach(name: str) -> Column:
        first = F.ceil((F.col(name) - 0.5) * factor - 0.5 + half * 1e-6)
        last = F.floor((F.col(name) + 1.5) * factor - 0.5 - half * 1e-6)
        return F.sequence(first.cast("int"), last.cast("int"))

    def weight(target: str, source: str) -> Column:
        return F.lit(1.0) - F.abs((F.col(target) + 0.5) / factor - 0.5 - F.col(source))

    spread = (
        pixels.select(*keys, "row", "col", F.col(value).cast("double").alias("__v"))
        .withColumn("__r", F.explode(reach("row")))
        .withColumn("__c", F.explode(reach("col")))
    )
    part = spread.select(
        *keys, F.col("__r").alias("row"), F.col("__c").alias("col"),
        (F.col("__v") * weight("__r", "row") * weight("__c", "col")).alias(value),
    )
    grid = extents.select(*keys, (F.col("h") * factor).alias("__h"), (F.col("w") * factor).alias("__w"))
    zero = (
        grid.withColumn("row", F.explode(F.sequence(F.lit(0), F.col("__h") - 1)))
        .withColumn("col", F.explode(F.sequence(F.lit(0), F.col("__w") - 1)))
        .select(*keys, "row", "col", F.lit(0.0).alias(value))
    )
    inside = part.join(grid, keys).where("row >= 0 AND col >= 0 AND row < __h AND col < __w").select(*zero.columns)
    return inside.unionByName(zero).groupBy(*keys, "row", "col").agg(F.sum(value).alias(value))


def reference_band(bands: Column, first_band: str) -> Column:
    """Name of the band whose grid is used: near infrared when present, else the first listed."""
    return F.when(F.map_contains_key(bands, "B08"), "B08").otherwise(first_band)


# ---------------------------------------------------------------- display

_BINS = 4096


def exact_percentiles(df: DataFrame, keys: list[str], value: str, quantiles: dict[str, float]) -> DataFrame:
    """Linear-interpolated percentiles per key without holding a group's values in one place.

    A histogram of fixed width locates the bins that hold the wanted ranks; only the value counts of
    those bins are then walked.
    """
    v = F.col(value)
    clean = df.where(v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))).select(*keys, v.alias("__v"))
    counts = clean.groupBy(*keys, "__v").agg(F.count("*").alias("__k"))
    span = counts.groupBy(*keys).agg(
        F.min("__v").alias("__lo"), F.max("__v").alias("__hi"), F.sum("__k").alias("__n")
    )
    width = F.when(F.col("__hi") > F.col("__lo"), (F.col("__v") - F.col("__lo")) / (F.col("__hi") - F.col("__lo")))
    binned = counts.join(span, keys).withColumn(
        "__bin", F.least(F.lit(_BINS - 1), F.floor(F.coalesce(width, F.lit(0.0)) * _BINS).cast("int"))
    )
    hist = binned.groupBy(*keys, "__bin", "__n").agg(F.sum("__k").alias("__bk"))
    w = Window.partitionBy(*keys).orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    hist = hist.withColumn("__before", F.coalesce(F.sum("__bk").over(w), F.lit(0)))
    wanted = F.array(
        *[
            F.struct(F.lit(name).alias("name"), side(F.lit(q) * (F.col("__n") - 1)).cast("long").alias("rank"))
            for name, q in quantiles.items()
            for side in (F.floor, F.ceil)
        ]
    )
    bins = (
        hist.withColumn("__want", F.filter(F.array_distinct(wanted), lambda s: (s["rank"] >= F.col("__before"))
                                           & (s["rank"] < F.col("__before") + F.col("__bk"))))
        .where(F.size("__want") > 0)
        .select(*keys, "__bin", "__before", "__want")
    )
    inner = Window.partitionBy(*keys, "__bin").orderBy("__v").rowsBetween(Window.unboundedPreceding, -1)
    walked = (
        binned.join(bins, [*keys, "__bin"])
        .withColumn("__from", F.col("__before") + F.coalesce(F.sum("__k").over(inner), F.lit(0)))
        .withColumn("__q", F.explode("__want"))
        .where("__q.rank >= __from AND __q.rank < __from + __k")
    )
    aggs = []
    for name, q in quantiles.items():
        pos = F.lit(q) * (F.max("__n") - 1)
        frac = pos - F.floor(pos)
        mine = F.when(F.col("__q.name") == name, F.col("__v"))
        aggs.append((F.min(mine) + (F.max(mine) - F.min(mine)) * frac).alias(name))
    return walked.groupBy(*keys).agg(*aggs)


def percentile_stretch(
    pixels: DataFrame, keys: list[str], value: str, out: str, lo: float = 0.02, hi: float = 0.98
) -> DataFrame:
    """Scale values between two percentiles to 0..255, truncated; non-finite input gives 0."""
    limits = exact_percentiles(pixels, keys, value, {"__plo": lo, "__phi": hi})
    limits = limits.withColumn("__phi", F.when(F.col("__phi") <= F.col("__plo"), F.col("__plo") + 1e-6).otherwise(F.col("__phi")))
    scaled = (F.col(value) - F.col("__plo")) / (F.col("__phi") - F.col("__plo")) * 255
    level = F.greatest(F.lit(0.0), F.least(F.lit(255.0), scaled))
    usable = F.col("__plo").isNotNull() & F.col(value).isNotNull() & ~F.isnan(value)
    return (
        pixels.join(limits, keys, "left")
        .withColumn(out, F.when(usable, level).otherwise(F.lit(0.0)).cast("int"))
        .drop("__plo", "__phi")
    )


def rgb_bands(bands: Column, first_band: str) -> list[Column]:
    """Red, green, blue arrays of a band map; the first band three times when one is missing."""
    names = ("B04", "B03", "B02")
    complete = F.map_contains_key(bands, names[0])
    for n in names[1:]:
        complete = complete & F.map_contains_key(bands, n)
    return [F.when(complete, F.element_at(bands, n)).otherwise(F.element_at(bands, first_band)) for n in names]


def composite(pixels: DataFrame, keys: list[str], bands: list[str], lo: float = 0.02, hi: float = 0.98) -> DataFrame:
    """Stretch several band columns to 0..255, each by its own percentiles.

    All bands share one pass for the limits; the limits (one row per area) are joined once.
    """
    pairs = ", ".join(f"'{b}', {b}" for b in bands)
    stacked = pixels.selectExpr(*keys, f"stack({len(bands)}, {pairs}) AS (band, v)")
    limits = exact_percentiles(stacked, [*keys, "band"], "v", {"plo": lo, "phi": hi})
    wide = limits.groupBy(*keys).agg(
        *[F.max(F.when(F.col("band") == b, F.col(p))).alias(f"__{p}_{b}") for b in bands for p in ("plo", "phi")]
    )

    def level(b: str) -> Column:
        low, high = F.col(f"__plo_{b}"), F.col(f"__phi_{b}")
        high = F.when(high <= low, low + 1e-6).otherwise(high)
        scaled = F.greatest(F.lit(0.0), F.least(F.lit(255.0), (F.col(b) - low) / (high - low) * 255))
        usable = low.isNotNull() & F.col(b).isNotNull() & ~F.isnan(b)
        return F.when(usable, scaled).otherwise(F.lit(0.0)).cast("int").alias(b)

    rest = [c for c in pixels.columns if c not in bands]
    return pixels.join(wide, keys, "left").select(*rest, *[level(b) for b in bands])
