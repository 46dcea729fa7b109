"""Tile tables: one row per tile with one array column per band, and kernels on Arrow batches of them.

A tile row has its keys, ``tile_r``, ``tile_c``, its window (``r0, c0, h, w``), the size of its grid (``grid_h, grid_w``) and a
row-major array per band; null entries are pixels without data, a null array is a band the window does not have. Kernels work on
whole arrays and give out set pixels, histograms or smaller tiles, so no row per pixel exists before a mask.

Tables with one row per area are spread over the tiles of their area (:func:`per_tile`) before they meet tile rows: joins are on
area and tile, which is also how stored tiles are bucketed, so a very large area is no hot key and stored tiles are not shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldlens.functions.spectral import normalized_difference_array
from fieldlens.session import cut_lineage, ensure_checkpoint_dir, ship_package

TILE = ["tile_r", "tile_c"]
PLACE = ["r0", "c0", "h", "w", "grid_h", "grid_w"]
INDEX_BANDS = ["b04", "b08", "b11"]


def _ints(names) -> list[T.StructField]:
    return [T.StructField(n, T.IntegerType()) for n in names]


def _kept(df: DataFrame, names: list[str]) -> list[T.StructField]:
    return [df.schema[n] for n in names]


# ------------------------------------------------------------ tiles of areas


def per_tile(areas: DataFrame, tile_px: int, window: tuple[str, str, str, str] | None = None) -> DataFrame:
    """Each row of ``areas`` (with ``h``, ``w``) once per tile of its grid, or of a window (names of r0, r1, c0, c1) inside it."""
    r0, r1, c0, c1 = [F.col(n) for n in window] if window else [F.lit(0), F.col("h"), F.lit(0), F.col("w")]

    def tiles(first: Column, end: Column, size: str) -> Column:
        low, high = F.greatest(first, F.lit(0)), F.least(end, F.col(size)) - 1
        low, high = F.floor(low / tile_px).cast("int"), F.floor(high / tile_px).cast("int")
        return F.explode(F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>")))

    rows = areas.withColumn("tile_r", tiles(r0, r1, "h"))
    return rows.withColumn("tile_c", tiles(c0, c1, "w"))


def tile_places(grids: DataFrame, tile_px: int) -> DataFrame:
    """All tiles of each grid with their windows; the last ones of a row or column are ragged. Other columns of ``grids`` stay."""
    rest = [c for c in grids.columns if c not in ("h", "w")]
    at = per_tile(grids, tile_px)
    r0, c0 = F.col("tile_r") * tile_px, F.col("tile_c") * tile_px
    return at.select(
        *rest, *TILE, r0.cast("int").alias("r0"), c0.cast("int").alias("c0"),
        F.least(F.lit(tile_px), F.col("h") - r0).cast("int").alias("h"), F.least(F.lit(tile_px), F.col("w") - c0).cast("int").alias("w"),
        F.col("h").cast("int").alias("grid_h"), F.col("w").cast("int").alias("grid_w"),
    )


def cut_tiles(pixels: DataFrame, grids: DataFrame, keys: list[str], bands: list[str], tile_px: int) -> DataFrame:
    """Tile rows from a pixel table (``keys, row, col`` and the bands). ``grids`` has ``keys, h, w`` and columns to carry along;
    every tile of a grid appears, also without pixels. With a column ``bands`` (a map by band name, as in a manifest) ``grids``
    also says which bands a window has; the others are null arrays there."""
    ship_package(pixels.sparkSession)
    if "bands" in grids.columns:
        have = F.transform(F.map_keys("bands"), lambda x: F.lower(x))
        grids = grids.withColumn("__lacks", F.array_except(F.array(*[F.lit(b) for b in bands]), have)).drop("bands")
    else:
        grids = grids.withColumn("__lacks", F.array().cast("array<string>"))
    places = tile_places(grids, tile_px)
    by = [*keys, *TILE]
    at = pixels.withColumns({
        "tile_r": F.expr(f"cast(row div {tile_px} AS int)"), "tile_c": F.expr(f"cast(col div {tile_px} AS int)"),
    }).select(*by, "row", "col", *[F.col(b).cast("double").alias(b) for b in bands])
    shown = [f for f in places.schema.fields if f.name != "__lacks"]
    schema = T.StructType(shown + [T.StructField(b, T.ArrayType(T.DoubleType())) for b in bands])

    def scatter(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            raise ValueError("pixels outside the grid of their area")
        r0, c0, h, w = (left.column(n)[0].as_py() for n in ("r0", "c0", "h", "w"))
        row, col = right.column("row").to_numpy() - r0, right.column("col").to_numpy() - c0
        if len(row) and (row.max() >= h or col.max() >= w):
            raise ValueError("pixels outside the grid of their area")
        out, lacks = left, left.column("__lacks")[0].as_py()
        for b in bands:
            values = right.column(b).to_numpy()
            if b in lacks:
                out = out.append_column(b, pa.array([None], pa.list_(pa.float64())))
                continue
            full = np.full(h * w, np.nan)
            full[row * w + col] = values
            cells = pa.array(full, mask=np.isnan(full))
            out = out.append_column(b, pa.ListArray.from_arrays(pa.array([0, h * w], pa.int32()), cells))
        return out.select([f.name for f in schema.fields])

    return places.groupBy(*by).cogroup(at.groupBy(*by)).applyInArrow(scatter, schema)


def store_tiles(tiles: DataFrame, table: str, buckets: int | None = None) -> DataFrame:
    """Store tiles as a table partitioned by date label and bucketed by area and tile; joins on these need no shuffle.

    ``buckets`` defaults to the shuffle partitions: one file per bucket and date, sorted, so that a scan of one area skips row groups.
    """
    spark = tiles.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = ["aoi", *TILE]
    (
        tiles.repartition(n, *by).write.mode("overwrite").partitionBy("t_label").bucketBy(n, *by).sortBy(*by)
        .option("path", f"{ensure_checkpoint_dir(spark)}/{table}").saveAsTable(table)
    )
    return spark.table(table)


def pair_dates(tiles: DataFrame, bands: list[str] = INDEX_BANDS, carry: list[str] = ()) -> DataFrame:
    """Tiles of both dates side by side (``<band>_t0``, ``<band>_t1``). A tile on one date only, windows that differ, and a band
    that is missing on a date raise."""
    by = ["aoi", *TILE]

    def side(label: str) -> DataFrame:
        place = F.struct(*PLACE).alias(f"place_{label}")
        more = list(carry) if label == "t0" else []
        return tiles.where(F.col("t_label") == label).select(*by, *more, place, *[F.col(b).alias(f"{b}_{label}") for b in bands])

    both = side("t0").join(side("t1"), by, "full")
    wrong = F.when(F.col("place_t0").isNull() | F.col("place_t1").isNull(), "tile present on one date only").when(
        ~F.col("place_t0").eqNullSafe(F.col("place_t1")), "dates of a tile have different grids"
    )
    for b in bands:
        for t in ("t0", "t1"):
            wrong = wrong.when(F.col(f"{b}_{t}").isNull(), f"band {b} is missing on {t}")
    place = F.when(wrong.isNotNull(), F.raise_error(wrong).cast(both.schema["place_t0"].dataType)).otherwise(F.col("place_t0"))
    both = both.withColumn("place", place)
    return both.select(*by, *carry, *[F.col(f"place.{n}").alias(n) for n in PLACE], *[f"{b}_{t}" for t in ("t0", "t1") for b in bands])


# -------------------------------------------------------------- kernels


class Cells:
    """Bands of a batch of tiles as flat arrays; null pixels are NaN."""

    def __init__(self, batch: pa.RecordBatch, bands: list[str]):
        size = batch.column("h").to_numpy().astype(np.int64) * batch.column("w").to_numpy()
        self.begin = np.concatenate([[0], np.cumsum(size)])
        self.values = {}
        for b in bands:
            col = batch.column(b)
            lengths = np.diff(col.offsets.to_numpy())
            have = col.is_valid().to_numpy(zero_copy_only=False)
            if (lengths[have] != size[have]).any():
                raise ValueError("a band array of a tile does not have the tile's size")
            flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            if not have.all():
                full = np.full(self.begin[-1], np.nan)
                full[np.repeat(have, size)] = flat
                flat = full
            self.values[b] = flat
        self.r0, self.c0, self.w = (batch.column(n).to_numpy().astype(np.int64) for n in ("r0", "c0", "w"))

    def places(self, at: np.ndarray):
        """Tile, row and column of flat positions."""
        tile = np.searchsorted(self.begin, at, "right") - 1
        within = at - self.begin[tile]
        return tile, self.r0[tile] + within // self.w[tile], self.c0[tile] + within % self.w[tile]

    def per_tile(self, values: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(values)])
        return sums[self.begin[1:]] - sums[self.begin[:-1]]


def map_tiles(tiles: DataFrame, kernel: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: T.StructType) -> DataFrame:
    ship_package(tiles.sparkSession)

    def run(batches):
        for b in batches:
            if b.num_rows:
                yield from kernel(b)

    return tiles.mapInArrow(run, schema)


def _changes(cells: Cells, mask_nodata: bool):
    v = cells.values
    old, new = ({b: v[f"{b}_{t}"] for b in INDEX_BANDS} for t in ("t0", "t1"))
    nd = normalized_difference_array
    delta = nd(new["b11"], new["b08"]) - nd(old["b11"], old["b08"])
    drop = nd(old["b08"], old["b04"]) - nd(new["b08"], new["b04"])
    seen = ~np.isnan(delta) & ~np.isnan(drop)
    if mask_nodata:
        seen &= (sum(old.values()) != 0) & (sum(new.values()) != 0)
    return delta, drop, seen


def _date_bands() -> list[str]:
    return [f"{b}_{t}" for t in ("t0", "t1") for b in INDEX_BANDS]


def change_pixels(
    pairs: DataFrame, keys: list[str], ndbi_min: float, ndvi_min: float, mask_nodata: bool = False
) -> DataFrame:
    """The set pixels of the change mask with ``ndbi_delta`` and ``ndvi_drop``, and the size ``h, w`` of their grid."""
    names = [*keys, "h", "w", "row", "col", "ndbi_delta", "ndvi_drop"]
    schema = T.StructType(
        _kept(pairs, keys) + _ints(names[len(keys) : len(keys) + 4]) + [T.StructField(n, T.DoubleType()) for n in names[-2:]]
    )

    def kernel(batch):
        cells = Cells(batch, _date_bands())
        delta, drop, seen = _changes(cells, mask_nodata)
        with np.errstate(invalid="ignore"):
            at = np.flatnonzero(seen & (delta >= ndbi_min) & (drop >= ndvi_min))
        tile, row, col = cells.places(at)
        own = pa.array(tile)
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(k).take(own) for k in keys], batch.column("grid_h").take(own), batch.column("grid_w").take(own),
             pa.array(row, pa.int32()), pa.array(col, pa.int32()), pa.array(delta[at]), pa.array(drop[at])], names=names,
        )

    return map_tiles(pairs.select(*keys, *PLACE, *_date_bands()), kernel, schema)


def change_counts(pairs: DataFrame, keys: list[str], ndbi_min: float, ndvi_min: float, mask_nodata: bool = False) -> DataFrame:
    """Per tile: pixels with data, flagged pixels, and the sum of ``ndbi_delta`` over the flagged ones."""
    schema = T.StructType(_kept(pairs, keys) + T.StructType.fromDDL("n_pixels long, n_flagged long, sum_delta double").fields)

    def kernel(batch):
        cells = Cells(batch, _date_bands())
        delta, drop, seen = _changes(cells, mask_nodata)
        with np.errstate(invalid="ignore"):
            hit = seen & (delta >= ndbi_min) & (drop >= ndvi_min)
        columns = [cells.per_tile(seen), cells.per_tile(hit), cells.per_tile(np.where(hit, delta, 0.0))]
        yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in keys], *map(pa.array, columns)], names=schema.names)

    return map_tiles(pairs.select(*keys, *PLACE, *_date_bands()), kernel, schema)


def band_stats(tiles: DataFrame, keys: list[str], bands: list[str]) -> DataFrame:
    """Per tile and band that it has: number of pixels, least, greatest and sum."""
    schema = T.StructType(_kept(tiles, keys) + T.StructType.fromDDL("band string, n_px long, low double, high double, total double").fields)

    def kernel(batch):
        cells = Cells(batch, bands)
        for b in bands:
            v = cells.values[b]
            some = ~np.isnan(v)
            n = cells.per_tile(some)
            have = np.flatnonzero(n)
            if not len(have):
                continue
            # Tiles without pixels hold no place among the first places of the others.
            first = np.concatenate([[0], np.cumsum(n)])[:-1][have]
            own, kept = pa.array(have), v[some]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k).take(own) for k in keys], pa.array([b.upper()] * len(have)), pa.array(n[have]),
                 pa.array(np.minimum.reduceat(kept, first)), pa.array(np.maximum.reduceat(kept, first)), pa.array(np.add.reduceat(kept, first))],
                names=schema.names,
            )

    return map_tiles(tiles.select(*keys, "r0", "c0", "h", "w", *bands), kernel, schema)


def pixel_rows(tiles: DataFrame, keys: list[str], bands: list[str]) -> DataFrame:
    """One row per pixel that has data in some band."""
    none = F.array_repeat(F.lit(None).cast("double"), F.col("h") * F.col("w"))  # a missing band would make the zip null
    arrays = [F.coalesce(F.col(b), none.cast(tiles.schema[b].dataType)).alias(b) for b in bands]
    cells = tiles.select(*keys, "r0", "c0", "h", "w", *arrays).select(
        *keys, "r0", "c0", "w", F.posexplode(F.arrays_zip(*bands)).alias("pos", "v"))
    row, col = F.col("r0") + F.expr("pos div w"), F.col("c0") + F.expr("pos % w")
    out = cells.select(*keys, row.cast("int").alias("row"), col.cast("int").alias("col"), *[F.col(f"v.{b}").alias(b) for b in bands])
    return out.where(F.coalesce(*bands).isNotNull())


# --------------------------------------------------------- windows of tiles


def _part(batch: pa.RecordBatch, k: int, bands: list[str], r0: int, r1: int, c0: int, c1: int) -> list[pa.Array | None]:
    """Arrays of the part r0..r1 x c0..c1 (of the grid) of tile ``k``."""
    tr, tc, h, w = (batch.column(n)[k].as_py() for n in ("r0", "c0", "h", "w"))
    out = []
    for b in bands:
        cells = batch.column(b)[k]
        if not cells.is_valid:
            out.append(None)
            continue
        v = cells.values.to_numpy(zero_copy_only=False).astype(np.float64).reshape(h, w)[r0 - tr : r1 - tr, c0 - tc : c1 - tc].reshape(-1)
        out.append(pa.array(v, mask=np.isnan(v)))
    return out


def _lists(parts: list[pa.Array | None]) -> pa.Array:
    return pa.array([None if p is None else p.to_pylist() for p in parts], pa.list_(pa.float64()))


def crop_tiles(tiles: DataFrame, windows: DataFrame, bands: list[str], tile_px: int) -> DataFrame:
    """The parts of tiles inside the window of their area. ``windows``: ``aoi, h, w`` (of the grid) and ``r0, r1, c0, c1``."""
    sized = windows.select("aoi", "h", "w", *[F.col(n).cast("int").alias(f"win_{n}") for n in ("r0", "r1", "c0", "c1")])
    spread = per_tile(sized, tile_px, ("win_r0", "win_r1", "win_c0", "win_c1")).drop("h", "w")
    rows = tiles.join(spread, ["aoi", *TILE])
    keys = [c for c in tiles.columns if c not in (*PLACE, *bands)]
    schema = T.StructType([f for f in tiles.schema.fields if f.name not in bands] + [T.StructField(b, T.ArrayType(T.DoubleType())) for b in bands])

    def kernel(batch):
        places, parts = [], []
        for k in range(batch.num_rows):
            tr, tc, h, w = (batch.column(n)[k].as_py() for n in ("r0", "c0", "h", "w"))
            r0, r1, c0, c1 = (batch.column(f"win_{n}")[k].as_py() for n in ("r0", "r1", "c0", "c1"))
            r0, r1, c0, c1 = max(r0, tr), min(r1, tr + h), max(c0, tc), min(c1, tc + w)
            places.append((r0, c0, r1 - r0, c1 - c0))
            parts.append(_part(batch, k, bands, r0, r1, c0, c1))
        own = dict(zip(("r0", "c0", "h", "w"), (pa.array(x, pa.int32()) for x in zip(*places))))
        own |= {b: _lists(list(x)) for b, x in zip(bands, zip(*parts))}
        yield pa.RecordBatch.from_arrays([own[n] if n in own else batch.column(n) for n in schema.names], names=schema.names)

    return map_tiles(rows.select(*keys, *PLACE, *bands, "win_r0", "win_r1", "win_c0", "win_c1"), kernel, schema)


# ----------------------------------------------------------------- regrid


def _weights(first: int, n: int, step: float, offset: float, low: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Triangle weights of source cells ``low ..`` for ``n`` targets, and the sum over all cells, also those outside."""
    reach = max(1.0, step)
    centre = (first + np.arange(n) + 0.5) * step + offset
    inside = np.maximum(0.0, 1.0 - np.abs(low + np.arange(size) + 0.5 - centre[:, None]) / reach)
    taps = np.floor(centre - 0.5 - reach)[:, None] + np.arange(int(np.ceil(2 * reach)) + 2)
    return inside, np.maximum(0.0, 1.0 - np.abs(taps + 0.5 - centre[:, None]) / reach).sum(axis=1)


def resample_tiles(tiles: DataFrame, areas: DataFrame, bands: list[str], tile_px: int, fill: float = 0.0) -> DataFrame:
    """Bilinear resampling of every area to any grid; cells outside the source and without data count as ``fill``.

    ``areas``: ``aoi, h, w`` of the source grid, ``th, tw`` of the target, and per axis the step and offset of the target in source
    cells: the centre of target cell ``i`` lies at ``(i + 0.5) * sy + oy`` (``sx, ox`` for columns). Steps up to 1 blend the two
    neighbours per axis; for coarser targets the kernel widens to the step and is normalised.

    Target tiles name the source tiles they need, with the reach of the kernel; those send only the part that is needed. Target tiles
    shrink as steps grow, so the cells gathered for one stay near the cells of a tile.
    """
    ship_package(tiles.sparkSession)
    c = F.col
    wide = F.ceil(F.greatest(F.lit(1.0), c("sy"), c("sx")))
    cut = areas.select("aoi", "h", "w", "th", "tw", "sy", "sx", "oy", "ox", F.greatest(F.lit(1), F.floor(F.lit(tile_px) / wide)).cast("int").alias("cut"))
    at = cut.withColumn("i0", F.explode(F.sequence(F.lit(0), c("th") - 1, c("cut")))).withColumn(
        "j0", F.explode(F.sequence(F.lit(0), c("tw") - 1, c("cut"))))
    at = at.withColumns({"ih": F.least("cut", c("th") - c("i0")), "jw": F.least("cut", c("tw") - c("j0"))})

    def need(first: str, n: str, step: str, offset: str, size: str) -> tuple[Column, Column]:
        reach = F.greatest(F.lit(1.0), c(step))
        low = F.floor((c(first) + 0.5) * c(step) + c(offset) - 0.5 - reach)
        high = F.ceil((c(first) + c(n) - 0.5) * c(step) + c(offset) - 0.5 + reach)
        return F.greatest(low, F.lit(0)).cast("int"), F.least(high, c(size) - 1).cast("int")

    (u0, u1), (v0, v1) = need("i0", "ih", "sy", "oy", "h"), need("j0", "jw", "sx", "ox", "w")
    at = at.withColumns({"u0": u0, "u1": u1, "v0": v0, "v1": v1}).drop("h", "w", "th", "tw", "cut")
    seen = (c("u0") <= c("u1")) & (c("v0") <= c("v1"))

    def source(low: str, high: str) -> Column:
        return F.when(seen, F.sequence(F.floor(c(low) / tile_px).cast("int"), F.floor(c(high) / tile_px).cast("int")))

    asked = at.withColumn("tile_r", F.explode_outer(source("u0", "u1"))).withColumn("tile_c", F.explode_outer(source("v0", "v1")))
    places = ["aoi", "i0", "j0", "ih", "jw", "sy", "sx", "oy", "ox", "u0", "u1", "v0", "v1"]
    rows = asked.join(tiles.select("aoi", *TILE, "r0", "c0", "h", "w", *bands), ["aoi", *TILE], "left")
    lists = [T.StructField(b, T.ArrayType(T.DoubleType())) for b in bands]
    sent = T.StructType(_kept(at, places) + _ints(("r0", "c0", "h", "w")) + lists)

    def send(batch):
        spots, parts = [], []
        for k in range(batch.num_rows):
            if not batch.column("r0")[k].is_valid:
                spots.append((None,) * 4)
                parts.append([None] * len(bands))
                continue
            tr, tc, h, w, a0, a1, b0, b1 = (batch.column(n)[k].as_py() for n in ("r0", "c0", "h", "w", "u0", "u1", "v0", "v1"))
            r0, r1, c0, c1 = max(a0, tr), min(a1 + 1, tr + h), max(b0, tc), min(b1 + 1, tc + w)
            spots.append((r0, c0, r1 - r0, c1 - c0))
            parts.append(_part(batch, k, bands, r0, r1, c0, c1))
        own = dict(zip(("r0", "c0", "h", "w"), (pa.array(x, pa.int32()) for x in zip(*spots))))
        own |= {b: _lists(list(x)) for b, x in zip(bands, zip(*parts))}
        yield pa.RecordBatch.from_arrays([own[n] if n in own else batch.column(n) for n in sent.names], names=sent.names)

    parts = map_tiles(rows.select(*places, "r0", "c0", "h", "w", *bands), send, sent)
    schema = T.StructType([at.schema["aoi"], *_ints(("r0", "c0", "h", "w")), *lists])

    def gather(table: pa.Table) -> pa.Table:
        one = {n: table.column(n)[0].as_py() for n in places}
        nu, nv = max(0, one["u1"] - one["u0"] + 1), max(0, one["v1"] - one["v0"] + 1)
        rows_w, rows_sum = _weights(one["i0"], one["ih"], one["sy"], one["oy"], one["u0"], nu)
        cols_w, cols_sum = _weights(one["j0"], one["jw"], one["sx"], one["ox"], one["v0"], nv)
        out = {"aoi": [one["aoi"]], "r0": [one["i0"]], "c0": [one["j0"]], "h": [one["ih"]], "w": [one["jw"]]}
        for b in bands:
            patch = np.zeros((nu, nv))
            for k in range(table.num_rows):
                cells = table.column(b)[k]
                if cells.is_valid:
                    r0, c0, h, w = (table.column(n)[k].as_py() for n in ("r0", "c0", "h", "w"))
                    v = cells.values.to_numpy(zero_copy_only=False).astype(np.float64).reshape(h, w)
                    r0, c0 = r0 - one["u0"], c0 - one["v0"]
                    patch[r0 : r0 + h, c0 : c0 + w] = np.where(np.isnan(v), 0.0, v - fill)
            got = rows_w @ patch @ cols_w.T / (rows_sum[:, None] * cols_sum) + fill
            out[b] = [got.reshape(-1)]
        return pa.table([pa.array(out[f.name], type=pa.list_(pa.float64()) if f.name in bands else None) for f in schema.fields],
                        names=schema.names).cast(pa.schema([
                            (f.name, pa.list_(pa.float64()) if f.name in bands else pa.int32() if f.name != "aoi" else table.column("aoi").type)
                            for f in schema.fields]))

    return parts.groupBy("aoi", "i0", "j0").applyInArrow(gather, schema)


# ------------------------------------------------------------ percentiles

_ROUND_BITS = 16
_ROUNDS = 4


def _codes(values: np.ndarray) -> np.ndarray:
    """Unsigned integers in the order of the doubles."""
    bits = (values + 0.0).view(np.int64)  # -0.0 becomes 0.0
    return (bits ^ ((bits >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))).view(np.uint64) ^ np.uint64(1 << 63)


def tile_percentiles(tiles: DataFrame, grids: DataFrame, keys: list[str], bands: list[str], quantiles: dict[str, float], tile_px: int) -> DataFrame:
    """Linear-interpolated percentiles per key and band over all finite pixels: ``keys, band`` and one column per quantile.

    Ranks are found digit by digit: doubles as ordered 64-bit codes, 16 bits a round. A round counts the next digit of the
    values that share the digits found so far, tile by tile, so no window holds more than 65536 counts whatever the values. Rounds end
    when the wanted values are known. ``keys`` begin with ``aoi``; ``grids`` (``aoi, h, w``) spread what is found over the tiles.
    """
    by = [*keys, "band"]
    counted = T.StructType(_kept(tiles, keys) + T.StructType.fromDDL("band string, parent long, digit int, n long, low double, high double").fields)
    names = ["h", "w", "r0", "c0", *bands]

    def count(done: int):
        def kernel(batch):
            cells = Cells(batch, bands)
            tile_of = np.repeat(np.arange(batch.num_rows), np.diff(cells.begin))
            for b in bands:
                v = cells.values[b]
                some = np.flatnonzero(np.isfinite(v))
                value, tile = v[some], tile_of[some]
                code = _codes(value)
                parent = np.zeros(len(code), np.int64)
                if done:
                    parent = (code >> np.uint64(64 - done)).astype(np.int64)
                    asked = [(k, x["parent"]) for k, own in enumerate(batch.column("asked").to_pylist()) for x in own if x["band"] == b]
                    if not asked:
                        continue
                    asked = np.unique(np.array(asked, np.int64), axis=0)
                    # Digits found so far stay below 2^48, tiles of a batch below 2^15.
                    pair = lambda t, p: t << np.int64(48) | p
                    keep = np.isin(pair(tile, parent), pair(asked[:, 0], asked[:, 1]))
                    value, tile, code, parent = value[keep], tile[keep], code[keep], parent[keep]
                if not len(value):
                    continue
                digit = (code >> np.uint64(64 - done - _ROUND_BITS)).astype(np.int64) & 0xFFFF
                order = np.lexsort((value, digit, parent, tile))
                tile, parent, digit, value = tile[order], parent[order], digit[order], value[order]
                fresh = np.ones(len(order), bool)
                fresh[1:] = (tile[1:] != tile[:-1]) | (parent[1:] != parent[:-1]) | (digit[1:] != digit[:-1])
                first = np.flatnonzero(fresh)
                n = np.diff(np.append(first, len(order)))
                own = pa.array(tile[first])
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(k).take(own) for k in keys], pa.array([b] * len(first)), pa.array(parent[first]), pa.array(digit[first], pa.int32()),
                     pa.array(n), pa.array(value[first]), pa.array(value[first + n - 1])], names=counted.names,
                )

        return kernel

    wanted = None
    for r in range(_ROUNDS):
        rows = tiles.select(*keys, *TILE, *names)
        if wanted is not None:
            asked = wanted.where("low < high").select(*keys, F.struct("band", "parent").alias("x"))
            asked = asked.groupBy(*keys).agg(F.collect_set("x").alias("asked")).join(grids.select("aoi", "h", "w"), "aoi")
            rows = rows.join(per_tile(asked, tile_px).drop("h", "w"), [*keys, *TILE])
        counts = map_tiles(rows.drop(*TILE), count(r * _ROUND_BITS), counted).groupBy(*by, "parent", "digit").agg(
            F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
        over = Window.partitionBy(*by, "parent").orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.withColumn("before", F.coalesce(F.sum("n").over(over), F.lit(0)))
        if wanted is None:
            all_n = Window.partitionBy(*by)
            ranks = F.array(*[
                F.struct(F.lit(name).alias("name"), F.lit(q).alias("q"), F.lit(side).alias("side"),
                         (F.floor if side == "lo" else F.ceil)(F.lit(q) * (F.col("total") - 1)).cast("long").alias("rest"))
                for name, q in quantiles.items() for side in ("lo", "hi")
            ])
            hits = counts.withColumn("total", F.sum("n").over(all_n)).withColumn("rank", F.explode(ranks)).select("*", "rank.*").drop("rank")
        else:
            open_ = wanted.where("low < high").drop("low", "high")
            hits = counts.join(open_, [*by, "parent"])
        found = hits.where("rest >= before AND rest < before + n").select(
            *by, F.shiftleft("parent", _ROUND_BITS).bitwiseOR(F.col("digit").cast("long")).alias("parent"), "name", "q", "side", "total",
            (F.col("rest") - F.col("before")).alias("rest"), "low", "high",
        )
        wanted = cut_lineage(found if wanted is None else found.unionByName(wanted.where("low = high").select(found.columns)))
        if r == _ROUNDS - 1 or wanted.where("low < high").isEmpty():
            break
    low = F.max(F.when(F.col("side") == "lo", F.col("low")))
    high = F.max(F.when(F.col("side") == "hi", F.col("low")))
    at = F.first("q") * (F.first("total") - 1)
    values = wanted.groupBy(*by, "name").agg((low + (high - low) * (at - F.floor(at))).alias("value"))
    return values.groupBy(*by).agg(*[F.max(F.when(F.col("name") == n, F.col("value"))).alias(n) for n in quantiles])


def stretch_tiles(tiles: DataFrame, grids: DataFrame, limits: DataFrame, keys: list[str], bands: list[str], tile_px: int) -> DataFrame:
    """Bands scaled to 0..255 between their limits (``keys, band, lo, hi``), truncated; cells without finite values give 0."""
    wide = limits.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("band", F.struct("lo", "hi")))).alias("limits"))
    spread = per_tile(wide.join(grids.select("aoi", "h", "w"), "aoi"), tile_px).drop("h", "w")
    rows = tiles.select(*keys, *TILE, *PLACE, *bands).join(spread, [*keys, *TILE], "left")
    schema = T.StructType(_kept(tiles, [*keys, *TILE, *PLACE]) + [T.StructField(b, T.ArrayType(T.IntegerType())) for b in bands])

    def kernel(batch):
        cells = Cells(batch, bands)
        sizes = np.diff(cells.begin)
        limit = [dict(x) if x else {} for x in batch.column("limits").to_pylist()]
        out = []
        for b in bands:
            lo, hi = (np.array([x[b][side] if b in x else np.nan for x in limit], np.float64) for side in ("lo", "hi"))
            hi = np.where(hi <= lo, lo + 1e-6, hi)
            lo, hi, v = np.repeat(lo, sizes), np.repeat(hi, sizes), cells.values[b]
            with np.errstate(invalid="ignore", over="ignore"):
                level = np.clip((v - lo) / (hi - lo) * 255, 0, 255)
            level = np.where(np.isnan(level) | ~np.isfinite(v), 0, level).astype(np.int32)
            none = ~batch.column(b).is_valid().to_numpy(zero_copy_only=False)
            offsets = pa.array(cells.begin.astype(np.int32), mask=np.append(none, False)) if none.any() else pa.array(cells.begin.astype(np.int32))
            out.append(pa.ListArray.from_arrays(offsets, pa.array(level)))
        yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in schema.names[: -len(bands)]], *out], names=schema.names)

    return map_tiles(rows, kernel, schema)


def rgb_tiles(tiles: DataFrame, first_band: str = "b04", names: tuple[str, str, str] = ("b04", "b03", "b02")) -> DataFrame:
    """Red, green and blue arrays; the window's first band three times where one of them is missing. All tiles of a window
    have the same bands, so the choice needs no look at other tiles."""
    complete = F.lit(True)
    for n in names:
        complete = complete & F.col(n).isNotNull()
    colours = [F.when(complete, F.col(n)).otherwise(F.col(first_band)).alias(c) for n, c in zip(names, ("red", "green", "blue"))]
    rest = [c for c in tiles.columns if not (c.startswith("b") and c[1:].isdigit())]
    return tiles.select(*rest, *colours)
