"""Inputs that once lost or corrupted rows."""

import json

import pytest
from pyspark.sql import functions as F

from fieldlens.operators import raster as R
from fieldlens.operators import retrieval as RT
from fieldlens.operators.spatial import points_within
from fieldlens.plans import detect as D
from fieldlens.sources import parcels
from fieldlens.streaming.events import COMPLETED, read_topic
from fieldlens.streaming.worker import start_worker


def test_topk_without_queries_and_with_nulls(spark):
    items = spark.createDataFrame([(1, [1.0, 0.0]), (2, None)], "item_id long, vector array<double>")
    asked = spark.createDataFrame([(5, [1.0, 0.0]), (6, None)], "query_id long, vector array<double>")
    assert RT.topk_cosine(items, asked.limit(0), 3).collect() == []
    assert [(r.query_id, r.item_id, r["rank"]) for r in RT.topk_cosine(items, asked, 3).collect()] == [(5, 1, 1)]
    texts = spark.createDataFrame([(1, "some words of a text"), (2, None)], "item_id long, text string")
    model = RT.fit_tfidf(texts, "text")
    ask = texts.select(F.col("item_id").alias("query_id"), "text")
    assert RT.topk_tfidf(texts, ask.limit(0), 2, model).count() == 0
    best = [r for r in RT.topk_tfidf(texts, ask, 2, model).collect() if r.query_id == 1 and r["rank"] == 1]
    assert best[0].item_id == 1


def test_rings_with_one_box_are_two_shapes(spark):
    low = [(0.0, 0.0), (10.0, 0.0), (0.0, 10.0), (0.0, 0.0)]
    high = [(10.0, 10.0), (0.0, 10.0), (10.0, 0.0), (10.0, 10.0)]
    rows = [("a", 0.0, 0.0, 10.0, 10.0, ring) for ring in (low, high)]
    kind = "k string, minx double, miny double, maxx double, maxy double, ring array<struct<x: double, y: double>>"
    points = spark.createDataFrame([("a", 1, 1.0, 1.0), ("a", 2, 9.0, 9.0)], "k string, pid long, px double, py double")
    for hot in (100_000, 1):
        got = points_within(points, spark.createDataFrame(rows, kind), 0.5, ["k"], hot_rows=hot).collect()
        assert sorted(r.pid for r in got) == [1, 2]


def test_area_follows_the_grid(spark):
    flat = [("a", r, c, 0.1, 0.5, 0.1, 0.1, 0.5, 0.1) for r in range(12) for c in range(12)]
    names = "aoi string, row int, col int, b04_t0 double, b08_t0 double, b11_t0 double, b04_t1 double, b08_t1 double, b11_t1 double"
    built = [(*p[:6], 0.3, 0.3, 0.6) if 3 <= p[1] <= 5 and 3 <= p[2] <= 6 else p for p in flat]
    pixels = spark.createDataFrame(built, names)
    grids = spark.createDataFrame([("a", 12, 12, 20.0, 0.0, -20.0, 0.0)], "aoi string, h int, w int, a double, c double, e double, f double")
    area = D.strip_area(F.col("a"), F.col("c"), F.col("e"), F.col("f"), "EPSG:3826", "EPSG:3826")
    found = D.run_detector("spectral", pixels, ["aoi"], D.Settings(morph_open_iter=0), extents=grids.select("aoi", "h", "w"), area=area, placed=grids.drop("h", "w"))
    assert [r.area_m2 for r in found.detections.collect()] == [12 * 400.0]


def test_multipolygons_keep_all_parts(spark):
    def square(x):
        return [[[x, 0.0], [x + 1, 0.0], [x + 1, 1.0], [x, 1.0], [x, 0.0]]]

    features = [
        {"type": "Feature", "geometry": {"type": "MultiPolygon", "coordinates": [square(0.0), square(3.0)]}, "properties": {"parcel_id": "m"}},
        {"type": "Feature", "geometry": {"type": "Polygon", "coordinates": square(6.0)}, "properties": {}},
    ]
    text = spark.createDataFrame([(json.dumps({"type": "FeatureCollection", "features": features}),)], "fc string")
    areas = spark.createDataFrame([("a", -1.0, -1.0, 9.0, 9.0, "geojson")], "aoi string, minx double, miny double, maxx double, maxy double, provider string")
    got = parcels.features_to_parcels(parcels.parse_collections(text, "fc"), areas, cell=5.0).collect()
    assert sorted(r.parcel_id for r in got) == ["a-gj-1", "m", "m"]


def test_unequal_bands_are_refused(spark):
    tile = [("a", 0, 0, 2, {"B04": [1.0, 2.0], "B08": [1.0]})]
    df = spark.createDataFrame(tile, "aoi string, r0 int, c0 int, w int, bands map<string, array<double>>")
    assert R.tiles_to_pixels(df, ["B04"], ["aoi"]).count() == 2
    with pytest.raises(Exception, match="differ in length"):
        R.tiles_to_pixels(df, ["B04", "B08"], ["aoi"]).collect()


def test_late_events_are_processed(spark, tmp_path):
    topic, done = tmp_path / "topic", []
    topic.mkdir()

    def deliver(name, ts, run):
        (topic / name).write_text(json.dumps({"type": COMPLETED, "ts": ts, "run_id": run, "aoi": "a"}) + "\n")
        q = start_worker(read_topic(spark, str(topic)), lambda s, runs: done.extend(runs), str(tmp_path / "out"), str(tmp_path / "dead"), str(tmp_path / "cp"), once=True)
        q.awaitTermination(90)

    deliver("a.json", "2026-05-12T00:00:00Z", "new")
    deliver("b.json", "2026-05-01T00:00:00Z", "old")
    assert done == ["new", "old"]
