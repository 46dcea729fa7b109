import json

import pytest
from pyspark.sql import functions as F

from fieldlens import config
from fieldlens.operators import demand as DM
from fieldlens.operators import tables as TB
from fieldlens.sources import labels as L
from fieldlens.sources import lake, laws, parcels, scenes, sinks, tenders

AREA = {
    "name": "hemei", "display_name": "Hemei pilot", "county": "彰化縣", "township": "和美鎮", "bbox": [120.460, 24.090, 120.545, 24.150],
    "center": {"lon": 120.5025, "lat": 24.120}, "stac": {"bands": ["B04", "B08", "B11"], "t0": {"start": "2019-10-01", "end": "2020-03-31"},
    "t1": {"start": "2024-10-01", "end": "2025-03-31"}}, "laws": {"pcodes": [{"pcode": "J1", "title": "工廠管理輔導法"}, {"pcode": "D2", "title": "區域計畫法"}]},
}


def test_upsert_keeps_first_and_updates_last(spark, tmp_path):
    target = spark.createDataFrame([(1, "t1", "old"), (2, "t2", "old")], "id long, town string, status string")
    batch = spark.createDataFrame([(2, "x", "a", 0), (2, "y", "b", 1), (3, "p", "c", 2), (3, "q", None, 3)], "id long, town string, status string, pos long")
    merged = TB.merge_upsert(target, batch, ["id"], ["status"], "pos")
    want = {(1, "t1", "old"), (2, "t2", "b"), (3, "p", None)}
    assert {tuple(r) for r in merged.collect()} == want
    assert {tuple(r) for r in TB.merge_upsert(merged, batch, ["id"], ["status"], "pos").collect()} == want
    path = str(tmp_path / "up")
    for _ in range(2):
        TB.upsert_table(spark, path, batch.withColumn("aoi", F.lit("a")), ["id"], ["status"], "pos", ["aoi"])
    assert {(r.id, r.town, r.status) for r in spark.read.parquet(path).collect()} == {(2, "x", "b"), (3, "p", None)}


def test_replace_runs_and_cascade(spark, tmp_path):
    path = str(tmp_path / "flagged")
    rows = lambda run, ids: spark.createDataFrame([(run, i, 0.1) for i in ids], "run_id string, id long, confidence double")
    sinks.replace_runs(rows("r1", [1, 2]), path)
    sinks.replace_runs(rows("r2", [3]), path)
    sinks.replace_runs(rows("r1", [4]), path)
    stored = spark.read.parquet(path)
    assert {(r.run_id, r.id) for r in stored.collect()} == {("r1", 4), ("r2", 3)}
    assert dict(stored.dtypes)["confidence"] == "float"
    TB.clear_partitions(spark, path, "run_id", ["r1", "absent"])
    assert spark.read.parquet(path).count() == 1
    kids = spark.createDataFrame([(1, "p"), (2, "q")], "id long, parcel_id string")
    assert TB.cascade_delete(kids, spark.createDataFrame([(1,)], "id long"), ["id"]).count() == 1
    nulled = TB.null_missing_reference(kids, spark.createDataFrame([("p",)], "parcel_id string"), "parcel_id")
    assert {tuple(r) for r in nulled.collect()} == {(1, "p"), (2, None)}
    assert TB.row_count(spark, "nothing").first().n == 0


def test_exports_events_and_listing(spark, tmp_path):
    df = spark.createDataFrame([("2020", 6)], "year string, n_reports long")
    sinks.export_csv(df, str(tmp_path / "csv"))
    assert spark.read.option("header", "true").csv(str(tmp_path / "csv")).columns == ["year", "n_reports"]
    sinks.export_json(df, str(tmp_path / "json"))
    assert sinks.emit_events(spark, df, str(tmp_path / "ev")) is True
    (tmp_path / "file").write_text("x")
    assert sinks.emit_events(spark, df, str(tmp_path / "file" / "below")) is False  # a dead sink is not an error
    assert "part-" in lake.inventory(spark, str(tmp_path / "json"), "*.json").first().name
    assert lake.object_exists(spark, str(tmp_path / "json")) and not lake.object_exists(spark, str(tmp_path / "no"))


def test_area_config(spark, tmp_path):
    row = config.aoi_row(AREA)
    assert row["working_crs"] == "EPSG:3826" and row["top_k"] == 6 and row["max_candidates"] == 500
    with pytest.raises(ValueError):
        config.aoi_row({**AREA, "bbox": [2, 0, 1, 1]})
    yaml = pytest.importorskip("yaml")
    (tmp_path / "a.yaml").write_text(yaml.safe_dump({**AREA, "detection": {"min_area_m2": 900}}, allow_unicode=True), encoding="utf-8")
    dim = config.aoi_dim(spark, [row, config.load_aoi_yaml(str(tmp_path / "a.yaml"))])
    assert [r.min_area_m2 for r in dim.select("min_area_m2").collect()] == [400.0, 900.0] and len(dim.first().pcodes) == 2


def test_grid_parcels(spark):
    areas = config.aoi_dim(spark, [config.aoi_row(AREA)]).select("aoi", "minx", "miny", "maxx", "maxy", "grid_m", "farmland_fraction", "seed")
    grid = parcels.grid_parcels(areas, "EPSG:3826")
    stats = parcels.farmland_stats(grid).first()
    assert stats.n_parcels == 4088 and 0.55 < stats.farmland_fraction < 0.85
    first = grid.where("parcel_id = 'hemei-003-005'").first()
    assert first.landcode == "SIM-003005" and first.is_farmland and first.landuse_code == "農牧用地"


def feature(props, x=0.0):
    ring = [[x, 0.0], [x + 2, 0.0], [x + 2, 2.0], [x, 2.0], [x, 0.0]]
    return {"type": "Feature", "geometry": {"type": "Polygon", "coordinates": [ring]}, "properties": props}


def test_geojson_parcels(spark, tmp_path):
    feats = [
        feature({"parcel_id": "", "landcode": "L1", "is_farmland": "false"}), feature({"地號": "L2", "編定": "特定農業區"}),
        feature({"landuse": "Paddy"}, 1.5), feature({"parcel_id": "out"}, 50.0), feature({"parcel_id": "edge", "is_farmland": True}, 3.0),
    ]
    (tmp_path / "fc.json").write_text(json.dumps({"type": "FeatureCollection", "features": feats}, ensure_ascii=False), encoding="utf-8")
    areas = spark.createDataFrame([("a", 1.0, 1.0, 3.0, 3.0, "geojson")], "aoi string, minx double, miny double, maxx double, maxy double, provider string")
    got = {r.parcel_id: r for r in parcels.load_parcels(spark, areas, "geojson", str(tmp_path), "EPSG:3826").collect()}
    # the feature that only touches the box has no area left and is dropped
    assert set(got) == {"L1", "a-gj-1", "a-gj-2"}
    assert got["a-gj-1"].landcode == "L2" and got["a-gj-1"].is_farmland and got["a-gj-2"].is_farmland and got["L1"].source == "geojson"
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "f.jsonl").write_text("\n".join(json.dumps(f, ensure_ascii=False) for f in feats), encoding="utf-8")
    assert parcels.features_to_parcels(parcels.read_feature_lines(spark, str(tmp_path / "lines")), areas).count() == 3


def test_provider_fallback(spark):
    areas = config.aoi_dim(spark, [config.aoi_row(AREA)])
    with pytest.raises(ValueError):
        parcels.load_parcels(spark, areas, "landuse", None, "EPSG:3826", fallback=False)
    with pytest.raises(ValueError):
        parcels.load_parcels(spark, areas, "cadastre", None, "EPSG:3826", fallback=False)
    assert parcels.load_parcels(spark, areas, "landuse", None, "EPSG:3826").first().source == "synthetic"


def test_labels_and_ladder(spark):
    areas = spark.createDataFrame([("a", 120.5, 24.1, 120.4, 24.0, 120.6, 24.2, 7.0), ("b", 120.5, 24.1, 120.4, 24.0, 120.6, 24.2, 4.0)],
                                  "aoi string, center_lon double, center_lat double, minx double, miny double, maxx double, maxy double, range_km double")
    rec = spark.createDataFrame([(1, "a", 120.5, 24.1), (2, "a", 120.53, 24.1), (3, "a", None, 24.1), (4, "a", 120.61, 24.1), (5, "b", 120.5, 24.1)],
                                "id long, aoi string, lng double, lat double")
    assert {r.id for r in L.around_center(rec, areas).collect()} == {1, 2, 5}
    rungs = {r.aoi: r.l for r in areas.select("aoi", L.ladder(F.col("range_km")).alias("l")).collect()}
    assert rungs == {"a": [7.0, 5.0, 3.0, 1.0], "b": [4.0, 3.0, 1.0]}
    answered = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 1.0)], "aoi string, range_km double")
    assert {(r.id, r.range_km) for r in L.first_answered(rec, areas, answered).collect()} == {(1, 3.0), (5, 1.0)}
    names = L.normalise(spark.createDataFrame([(" x ",), ("  ",), (None,)], "name string")).collect()
    assert [r.name for r in names] == ["x", None, None]


def test_scenes(spark):
    cat = spark.createDataFrame(
        [("s1", "a", "2020-01-01", 25.0), ("s2", "a", "2020-03-31", 24.9), ("s3", "a", "2020-01-05", None), ("s4", "a", "2024-12-01", None), ("s5", "a", "2022-01-01", 0.0)],
        "item_id string, aoi string, d string, cloud_cover double",
    ).withColumn("dt", F.col("d").cast("timestamp_ntz"))
    win = [("t0", "2019-10-01", "2020-03-31"), ("t1", "2024-10-01", "2025-03-31")]
    assert {r.item_id for r in scenes.search(cat, win, 25.0).collect()} == {"s2"}
    best = {r.t_label: r.item_id for r in scenes.best_scene(scenes.tag_windows(cat, win)).collect()}
    assert best == {"t0": "s2", "t1": "s4"}


def test_statutes_and_tenders(spark, tmp_path):
    body = {"title": "工廠管理輔導法", "articles": [{"article_no": "第28-1條", "text": "停止供電"}, {"text": "無條號"}]}
    (tmp_path / "J1.json").write_text(json.dumps(body, ensure_ascii=False, indent=1), encoding="utf-8")
    statutes = laws.read_statutes(spark, str(tmp_path))
    arts = laws.explode_articles(statutes).orderBy("article_pos").collect()
    assert [(a.pcode, a.article_no) for a in arts] == [("J1", "第28-1條"), ("J1", None)]
    codes = spark.createDataFrame([("J1",), ("D2",)], "pcode string")
    assert [r.pcode for r in laws.missing_codes(codes, statutes).collect()] == ["D2"]
    chunks = spark.createDataFrame([("J1", 0, "x"), ("J1", 1, "y"), ("D2", 0, "z")], "pcode string, chunk_index long, content string")
    for df in (chunks, chunks.where("pcode = 'J1' AND chunk_index = 0")):
        laws.write_chunks(df, str(tmp_path / "chunks"))
    assert {(r.pcode, r.content) for r in spark.read.parquet(str(tmp_path / "chunks")).collect()} == {("J1", "x"), ("D2", "z")}
    page = json.dumps({"records": [{"date": "1", "unit_name": "u", "brief": None}, {"brief": {"title": "t", "type": "y"}}], "total_pages": 2})
    pages = spark.createDataFrame([("k", 1, page), ("k", 2, page), ("k", 3, page)], "keyword string, page int, body string")
    rows = tenders.flatten_pages(pages, "body", 5).collect()
    assert len(rows) == 4 and {r.title for r in rows} == {None, "t"}


def test_demand(spark):
    reports = spark.createDataFrame([("2021-01-01",), ("2020-05-05",), ("2021-02-02",), ("soon",), (None,)], "reported_at string")
    years = DM.reports_by_year(reports, "reported_at")
    assert [tuple(r) for r in years.collect()] == [("2020", 1), ("2021", 2)]
    titles = spark.createDataFrame([("衛星影像 變更偵測",), ("道路",), (None,)], "title string")
    words = DM.keyword_counts(titles, "title", list(DM.TENDER_KEYWORDS))
    assert {r.keyword: r.n_titles for r in words.where("n_titles > 0").collect()} == {"衛星影像": 1, "變更偵測": 1} and words.count() == 10
    assert json.loads(DM.demand_summary(years, words).first().summary)["n_reports"] == 3
