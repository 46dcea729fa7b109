import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldlens.operators import raster as R
from fieldlens.operators import tiles as TL
from fieldlens.plans import detect as D
from fieldlens.plans import imagery as IM

BANDS = ["b04", "b08", "b11"]
RNG = np.random.default_rng(11)


def frames(spark, sizes, bands=BANDS, gaps=0.0, tile=8, labels=("t0", "t1")):
    """Random rasters per area and date: tiles, grids and the arrays."""
    rows, arrays = [], {}
    for k, (h, w) in enumerate(sizes):
        for t in labels:
            a = {b: np.round(RNG.random((h, w)) * 4, 3) for b in bands}
            hole = RNG.random((h, w)) < gaps
            for v in a.values():
                v[hole] = np.nan
            arrays[f"a{k}", t] = a
            rows += [(f"a{k}", t, r, c, *[float(a[b][r, c]) for b in bands]) for r in range(h) for c in range(w) if not hole[r, c]]
    px = spark.createDataFrame(rows, "aoi string, t_label string, row int, col int, " + ", ".join(f"{b} double" for b in bands))
    grids = spark.createDataFrame([(f"a{k}", t, h, w) for k, (h, w) in enumerate(sizes) for t in labels], "aoi string, t_label string, h int, w int")
    return TL.cut_tiles(px, grids, ["aoi", "t_label"], bands, tile), grids.where(F.col("t_label") == labels[0]).drop("t_label"), arrays


def raster_of(rows, band, h, w):
    out = np.full((h, w), np.nan)
    for r in rows:
        v = np.array([np.nan if x is None else x for x in r[band]], float).reshape(r.h, r.w)
        out[r.r0 : r.r0 + r.h, r.c0 : r.c0 + r.w] = v
    return out


def test_cut_and_pair_without_shuffle(spark):
    tiles, _, arrays = frames(spark, [(20, 13), (8, 8), (1, 30)], gaps=0.2)
    stored = TL.store_tiles(tiles, "tiles_of_test", 4)
    for (aoi, t), a in arrays.items():
        rows = stored.where((F.col("aoi") == aoi) & (F.col("t_label") == t)).collect()
        assert np.array_equal(raster_of(rows, "b08", *a["b08"].shape), a["b08"], equal_nan=True)
    pairs = TL.pair_dates(stored)
    plan = TL.change_pixels(pairs, ["aoi"], 0.0, 0.0)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" not in plan
    schema = "ReadSchema: struct<aoi:string,tile_r:int,tile_c:int,r0:int,c0:int,h:int,w:int,grid_h:int,grid_w:int,b04:array<double>,b08:array<double>,b11:array<double>>"
    full = pairs._jdf.queryExecution().explainString(pairs._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert full.count(schema) == 2
    assert pairs.count() == 6 + 1 + 4


def test_masks_equal_the_pixel_path(spark):
    tiles, _, arrays = frames(spark, [(20, 13), (9, 17)], gaps=0.1)
    pairs = TL.pair_dates(tiles)
    rows = []
    for k in ("a0", "a1"):
        old, new = arrays[k, "t0"], arrays[k, "t1"]
        for r, c in np.ndindex(old["b04"].shape):
            if not np.isnan(old["b04"][r, c] + new["b04"][r, c]):
                rows.append((k, r, c, *[float(x[b][r, c]) for x in (old, new) for b in BANDS]))
    names = [f"{b}_{t}" for t in ("t0", "t1") for b in BANDS]
    px = spark.createDataFrame(rows, "aoi string, row int, col int, " + ", ".join(f"{n} double" for n in names))
    want = R.change_mask(R.index_change(px), 0.1, 0.05).select("aoi", "row", "col", "ndbi_delta", "ndvi_drop").collect()
    got = TL.change_pixels(pairs, ["aoi"], 0.1, 0.05)
    assert sorted(map(tuple, got.select("aoi", "row", "col", "ndbi_delta", "ndvi_drop").collect())) == sorted(map(tuple, want)) and len(want) > 20
    assert {(r.aoi, r.h, r.w) for r in got.collect()} == {("a0", 20, 13), ("a1", 9, 17)}
    counts = {r.aoi: r for r in TL.change_counts(pairs, ["aoi"], 0.1, 0.05).groupBy("aoi").agg(
        F.sum("n_pixels").alias("n"), F.sum("n_flagged").alias("f"), F.sum("sum_delta").alias("s")).collect()}
    for k in ("a0", "a1"):
        mine = [r for r in want if r.aoi == k]
        assert (counts[k].n, counts[k].f) == (sum(r[0] == k for r in rows), len(mine))
        assert counts[k].s == pytest.approx(sum(r.ndbi_delta for r in mine))
    s = D.Settings(ndbi_delta_min=-0.7, ndvi_drop_min=-0.7, min_area_m2=0.0, pixel_area=1.0, tile_px=8)
    for tiled, fn in ((False, D.detect_spectral), (True, D.detect_tiled)):
        a = D.detect_tile_pairs(pairs, ["aoi"], s, tiled).detections.collect()
        b = fn(px, ["aoi"], s, extents=spark.createDataFrame([("a0", 20, 13), ("a1", 9, 17)], "aoi string, h int, w int")).detections.collect()
        key = lambda r: (r.aoi, r.component, r.n_px, round(r.confidence, 9), r["rank"])
        assert sorted(map(key, a)) == sorted(map(key, b)) and a


def test_no_data_and_refused_pairs(spark):
    tiles, _, _ = frames(spark, [(9, 9)])
    with pytest.raises(Exception, match="one date only"):
        TL.pair_dates(tiles.where("NOT (t_label = 't1' AND tile_r = 1)")).collect()
    other = tiles.withColumn("grid_h", F.expr("if(t_label = 't1', 10, grid_h)"))
    with pytest.raises(Exception, match="different grids"):
        TL.pair_dates(other).collect()
    with pytest.raises(Exception, match="band b11 is missing on t1"):
        TL.pair_dates(tiles.withColumn("b11", F.expr("if(t_label = 't1', null, b11)"))).collect()
    short = tiles.withColumn("b11", F.slice("b11", 1, 3))
    with pytest.raises(Exception, match="tile's size"):
        TL.change_pixels(TL.pair_dates(short), ["aoi"], 0, 0).collect()
    dark = tiles.withColumns({b: F.transform(b, lambda x: x * 0) for b in BANDS})
    pairs = TL.pair_dates(dark)
    assert TL.change_counts(pairs, ["aoi"], 0, 0).agg(F.sum("n_flagged"), F.sum("n_pixels")).first() == (81, 81)
    assert TL.change_counts(pairs, ["aoi"], 0, 0, mask_nodata=True).agg(F.sum("n_flagged"), F.sum("n_pixels")).first() == (0, 0)
    assert TL.change_pixels(pairs.limit(0), ["aoi"], 0, 0).count() == 0
    outside = spark.createDataFrame([("a", "t0", 50, 1, 1.0)], "aoi string, t_label string, row int, col int, b04 double")
    with pytest.raises(Exception, match="outside the grid"):
        TL.cut_tiles(outside, spark.createDataFrame([("a", "t0", 9, 9)], "aoi string, t_label string, h int, w int"), ["aoi", "t_label"], ["b04"], 8).collect()


def test_stats_and_pixels(spark):
    tiles, _, arrays = frames(spark, [(20, 13), (7, 9)], gaps=0.4)
    tiles = tiles.withColumn("b11", F.expr("if(aoi = 'a1', null, b11)"))
    got = {(r.aoi, r.t_label, r.band): r for r in TL.band_stats(tiles, ["aoi", "t_label"], BANDS).groupBy("aoi", "t_label", "band").agg(
        F.sum("n_px").alias("n"), F.min("low").alias("lo"), F.max("high").alias("hi"), F.sum("total").alias("s")).collect()}
    assert len(got) == 10
    for (aoi, t, band), r in got.items():
        v = arrays[aoi, t][band.lower()]
        v = v[~np.isnan(v)]
        assert (r.n, r.lo, r.hi) == (len(v), v.min(), v.max()) and r.s == pytest.approx(v.sum())
    px = TL.pixel_rows(tiles.where("t_label = 't0'"), ["aoi"], ["b04", "b11"]).collect()
    assert {(r.aoi, r.row, r.col): r.b04 for r in px} == {
        (k, int(r), int(c)): arrays[k, "t0"]["b04"][r, c] for k in ("a0", "a1") for r, c in np.argwhere(~np.isnan(arrays[k, "t0"]["b04"]))}
    assert {r.b11 is None for r in px if r.aoi == "a1"} == {True}


def test_crop(spark):
    tiles, _, arrays = frames(spark, [(20, 13), (7, 9), (16, 16)], ["b04"], gaps=0.1, labels=("t0",))
    windows = spark.createDataFrame(
        [("a0", 20, 13, 3, 17, 5, 13), ("a1", 7, 9, -4, 99, 0, 1), ("a2", 16, 16, 8, 8, 0, 16)], "aoi string, h int, w int, r0 int, r1 int, c0 int, c1 int")
    got = TL.crop_tiles(tiles, windows, ["b04"], 8)
    assert got.columns == [*tiles.columns[:-1], "b04"]
    rows = got.collect()
    assert {r.aoi for r in rows} == {"a0", "a1"}
    for aoi, (r0, r1, c0, c1) in {"a0": (3, 17, 5, 13), "a1": (0, 7, 0, 1)}.items():
        whole = arrays[aoi, "t0"]["b04"]
        want = np.full(whole.shape, np.nan)
        want[r0:r1, c0:c1] = whole[r0:r1, c0:c1]
        assert np.array_equal(raster_of([r for r in rows if r.aoi == aoi], "b04", *whole.shape), want, equal_nan=True)


def resampled(src, th, tw, sy, sx, oy, ox, fill):
    """Every target cell as the weighted mean of all cells of an endless source."""
    out = np.zeros((th, tw))
    ry, rx = max(1.0, sy), max(1.0, sx)
    for i in range(th):
        for j in range(tw):
            y, x = (i + 0.5) * sy + oy, (j + 0.5) * sx + ox
            total = value = 0.0
            for u in range(int(np.floor(y - ry)) - 1, int(np.ceil(y + ry)) + 2):
                for v in range(int(np.floor(x - rx)) - 1, int(np.ceil(x + rx)) + 2):
                    wt = max(0.0, 1 - abs(u + 0.5 - y) / ry) * max(0.0, 1 - abs(v + 0.5 - x) / rx)
                    inside = 0 <= u < src.shape[0] and 0 <= v < src.shape[1] and not np.isnan(src[u, v])
                    total += wt
                    value += wt * (src[u, v] if inside else fill)
            out[i, j] = value / total
    return out


@pytest.mark.parametrize("th,tw,sy,sx,oy,ox,fill", [
    (40, 26, 0.5, 0.5, 0.0, 0.0, 0.0), (20, 13, 1.0, 1.0, 0.0, 0.0, 0.0), (9, 30, 2.3, 0.41, -1.7, 2.25, 0.0),
    (3, 2, 7.0, 6.5, 0.0, 0.0, 5.0), (5, 40, 1.0, 1.0, -3.5, -20.0, -1.0), (4, 4, 1.0, 1.0, 100.0, 0.0, 2.0), (1, 1, 20.0, 13.0, 0.0, 0.0, 0.0),
])
def test_resampling_equals_plain_weights(spark, th, tw, sy, sx, oy, ox, fill):
    tiles, grids, arrays = frames(spark, [(20, 13), (6, 11)], ["b04", "b11"], gaps=0.05, labels=("t0",))
    areas = grids.withColumns({
        "th": F.lit(th), "tw": F.lit(tw), "sy": F.lit(sy), "sx": F.lit(sx), "oy": F.lit(oy), "ox": F.lit(ox)})
    rows = TL.resample_tiles(tiles, areas, ["b04", "b11"], 8, fill).collect()
    for aoi in ("a0", "a1"):
        for b in ("b04", "b11"):
            got = raster_of([r for r in rows if r.aoi == aoi], b, th, tw)
            assert np.allclose(got, resampled(arrays[aoi, "t0"][b], th, tw, sy, sx, oy, ox, fill), atol=1e-12)


def ancestors(plan, node):
    """Lines of a plan's tree above the first line with ``node``, nearest first."""
    lines = plan.splitlines()
    depth = lambda x: len(x) - len(x.lstrip(" :+-"))
    at = next(k for k, x in enumerate(lines) if node in x)
    out, now = [], depth(lines[at])
    for x in reversed(lines[:at]):
        if depth(x) < now:
            out.append(x)
            now = depth(x)
    return out


def test_no_join_on_the_area_alone(spark):
    """A very large area is no key of its own: tile rows are joined by area and tile."""
    tiles, grids, _ = frames(spark, [(20, 13)], ["b04"], labels=("t0",))
    tiles = TL.store_tiles(tiles, "tiles_for_plans", 4)
    areas = grids.selectExpr("*", "20 AS th", "20 AS tw", "0.5D AS sy", "0.5D AS sx", "0D AS oy", "0D AS ox")
    windows = grids.selectExpr("*", "0 AS r0", "9 AS r1", "0 AS c0", "9 AS c1")
    limits = spark.createDataFrame([("a0", "b04", 0.0, 1.0)], "aoi string, band string, lo double, hi double")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (
            TL.resample_tiles(tiles, areas, ["b04"], 8), TL.crop_tiles(tiles, windows, ["b04"], 8),
            TL.stretch_tiles(tiles, grids, limits, ["aoi"], ["b04"], 8),
        ):
            plan = df._jdf.queryExecution().executedPlan().toString()
            above = ancestors(plan, "FileScan parquet spark_catalog.default.tiles_for_plans")
            join = next(k for k, x in enumerate(above) if "Join" in x)
            assert "[aoi" in above[join] and "tile_r" in above[join] and not any("Exchange" in x for x in above[:join])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_percentiles_with_outliers(spark):
    shapes = {"a0": np.append(RNG.normal(size=299), 1e9), "a1": np.full(80, 5.0), "a2": np.round(RNG.random(400), 2),
              "a3": np.array([1.0, 9.0]), "a4": np.concatenate([RNG.normal(size=500) * 1e-300, [-1e300, 0.0, -0.0, 1e300]]), "a5": np.array([np.nan])}
    rows, grids = [], []
    for k, v in shapes.items():
        v = np.append(v, [np.nan, np.inf, -np.inf]) if k == "a0" else v
        rows += [(k, i // 20, i % 20, float(x)) for i, x in enumerate(v)]
        grids.append((k, (len(v) + 19) // 20, 20))
    grids = spark.createDataFrame(grids, "aoi string, h int, w int")
    tiles = TL.cut_tiles(spark.createDataFrame(rows, "aoi string, row int, col int, b04 double"), grids, ["aoi"], ["b04"], 8)
    tiles = tiles.withColumn("b11", F.transform("b04", lambda x: x * 2))
    got = {(r.aoi, r.band): r for r in TL.tile_percentiles(tiles, grids, ["aoi"], ["b04", "b11"], {"lo": 0.02, "mid": 0.5, "hi": 0.98}, 8).collect()}
    assert {k for k, _ in got} == set(shapes) - {"a5"}
    for k, v in shapes.items():
        for band, times in (("b04", 1), ("b11", 2)):
            if k != "a5":
                want = np.percentile(v * times, [2, 50, 98])
                assert np.allclose([got[k, band].lo, got[k, band].mid, got[k, band].hi], want, rtol=1e-12, atol=0)
    limits = TL.tile_percentiles(tiles, grids, ["aoi"], ["b04"], {"lo": 0.02, "hi": 0.98}, 8)
    levels = TL.stretch_tiles(tiles, grids, limits, ["aoi"], ["b04"], 8)
    lo, hi = np.percentile(shapes["a2"], [2, 98])
    out = raster_of(levels.where("aoi = 'a2'").collect(), "b04", 20, 20).reshape(-1)
    assert (out == np.clip((shapes["a2"] - lo) / (hi - lo) * 255, 0, 255).astype(int)).all()
    assert set(raster_of(levels.where("aoi = 'a5'").collect(), "b04", 1, 20).reshape(-1)) == {0}
    bare = TL.cut_tiles(tiles.limit(0).selectExpr("aoi", "r0 AS row", "c0 AS col", "0D AS b04", "0D AS b11"), grids.withColumn(
        "bands", F.create_map(F.lit("B04"), F.lit("x"))), ["aoi"], ["b04", "b11"], 8)
    assert bare.where("b11 IS NULL AND size(b04) = h * w AND NOT exists(b04, x -> x IS NOT NULL)").count() == bare.count() == tiles.count()


def test_codes_keep_order():
    v = np.sort(np.concatenate([RNG.normal(size=500) * 10.0 ** RNG.integers(-300, 300, 500), [0.0, -0.0, 5e-324, -5e-324, 1.7e308, -1.7e308]]))
    c = TL._codes(v)
    assert ((c[1:] > c[:-1]) == (v[1:] > v[:-1])).all() and ((c[1:] == c[:-1]) == (v[1:] == v[:-1])).all()


def test_rgb_fallback(spark):
    rows = [("a", [4.0], [3.0], [2.0]), ("b", [4.0], [3.0], None), ("c", [7.0], None, None)]
    df = spark.createDataFrame(rows, "aoi string, b04 array<double>, b03 array<double>, b02 array<double>")
    got = {r.aoi: (r.red, r.green, r.blue) for r in TL.rgb_tiles(df).collect()}
    assert got == {"a": ([4.0], [3.0], [2.0]), "b": ([4.0],) * 3, "c": ([7.0],) * 3}


def test_stored_imagery_of_the_queries(spark, sf):
    tiles, manifest = IM.stored(spark, sf)
    again, _ = IM.stored(spark, sf)
    assert tiles.count() == again.count() > 0
    assert {r.t_label for r in manifest.collect()} == {"t0", "t1"}
    blue = {r.aoi: r.n for r in tiles.where("t_label = 't1'").groupBy("aoi").agg(F.count("b02").alias("n")).collect()}
    assert all((n > 0) == (int(k[1:]) % 2 == 0) for k, n in blue.items())
