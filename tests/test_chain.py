"""The offline sample with a known answer, as tables: 6 new buildings, 5 known sites, 4 of them at buildings."""

import json
import os

import pytest
from pyspark.sql import functions as F

from fieldlens import config
from fieldlens.functions import geometry as G
from fieldlens.operators import retrieval as RT
from fieldlens.plans import evidence as E
from fieldlens.sources import parcels as SP
from fieldlens.sources.rasters import grid_from_bbox
from fieldlens.functions.projection import WGS84, project_points
from fieldlens.streaming import events as EV
from fieldlens.streaming import imagery as IM
from fieldlens.streaming import worker as WK
from tests.test_tables import AREA

# Building centres, known sites and band signatures of the sample.
PATCHES = [(120.5000, 24.1200), (120.5100, 24.1150), (120.4900, 24.1300), (120.5200, 24.1000), (120.4950, 24.1050), (120.5150, 24.1250)]
SITES = [*PATCHES[:4], (120.4750, 24.1400)]
VEG = {"b04": 0.06, "b08": 0.35, "b11": 0.20}
BUILT = {"b04": 0.20, "b08": 0.22, "b11": 0.34}
LAWS = [
    ("J1", "工廠管理輔導法", 0, "第28-1條", "未登記工廠 停止供電供水 拆除"), ("D2", "區域計畫法", 0, "第21條", "違反土地使用管制 罰鍰 恢復原狀"),
    ("M9", "農業發展條例", 0, "第3條", "農業用地 農地農用"), ("D7", "非都市土地使用管制規則", 0, "第6條", "農牧用地 容許使用項目"),
]
CRS = "EPSG:3826"


@pytest.fixture(scope="module")
def world(spark):
    areas = config.aoi_dim(spark, [config.aoi_row(AREA)])
    grid = grid_from_bbox(areas.select("aoi", "minx", "miny", "maxx", "maxy"), CRS, smallest=8).withColumns(
        {"t0_date": F.lit("2020-01-15"), "t1_date": F.lit("2024-12-15")}
    )
    g = grid.first()
    assert (g.w, g.h) == (866, 668)
    at = project_points(spark.createDataFrame(PATCHES, "lon double, lat double"), "lon", "lat", WGS84, CRS, ("x", "y")).collect()
    centres = [(int((p.y - g.f) / g.e), int((p.x - g.c) / g.a)) for p in at]
    hit = " OR ".join(f"(row >= {r - 3} AND row < {r + 3} AND col >= {c - 3} AND col < {c + 3})" for r, c in centres)
    noise = lambda salt: f"(pmod(xxhash64(id, {salt}), 1000) / 1000.0 - 0.5D) * 0.03D"
    px = spark.range(g.w * g.h).selectExpr("id", "'hemei' AS aoi", f"cast(id div {g.w} AS int) AS row", f"cast(id % {g.w} AS int) AS col")
    px = px.selectExpr("*", f"{hit} AS built").selectExpr(
        "aoi", "row", "col",
        *[f"{v}D + {noise(i)} AS {b}_t0" for i, (b, v) in enumerate(VEG.items())],
        *[f"if(built, {BUILT[b]}D, {v}D) + {noise(9 + i)} AS {b}_t1" for i, (b, v) in enumerate(VEG.items())],
    )
    land = SP.grid_parcels(areas.select("aoi", "minx", "miny", "maxx", "maxy", "grid_m", "farmland_fraction", "seed"), CRS)
    land = land.withColumn("b", G.bounds(F.col("geom"))).select("*", "b.*").drop("b").persist()
    labels = spark.createDataFrame([("hemei", f"sample-{i}", x, y) for i, (x, y) in enumerate(SITES)], "aoi string, pid string, px double, py double")
    arts = spark.createDataFrame(LAWS, "pcode string, law_title string, article_pos long, article_no string, text string")
    chunks = RT.chunk_articles(arts).withColumn("chunk_id", F.xxhash64("pcode", "chunk_index"))
    model = RT.fit_lsa(chunks, "content")
    inputs = E.Inputs(land, labels, areas.select("aoi", "display_name", "county", "township"), RT.encode(chunks, "content", model).persist(), model)
    return px, grid, inputs


@pytest.fixture(scope="module")
def store(spark, world, tmp_path_factory):
    px, grid, inputs = world
    s = E.Store(str(tmp_path_factory.mktemp("store")))
    E.run_detection(spark, s, px, grid, "run-1", settings=E.D.Settings(pixel_area=100.0))
    return s


def read(spark, store, name):
    return spark.read.parquet(store.path(name))


def test_known_answer(spark, world, store):
    px, grid, inputs = world
    E.run_evidence(spark, store, ["run-1"], inputs)
    m = read(spark, store, "metrics").collect()
    assert len(m) == 1
    m = m[0]
    assert (m.n_detections, m.n_flagged_detections, m.n_true_positive_detections, m.n_labels, m.n_labels_matched) == (6, 6, 4, 5, 4)
    assert (m.precision, m.recall, m.f1) == (0.6667, 0.8, 0.7273)
    assert json.loads(spark.read.text(store.path("metrics_json")).first().value)["f1"] == 0.7273
    det = read(spark, store, "detections").collect()
    assert all(3000 <= d.area_m2 <= 3600 and d.confidence > 0.9 and d.t1_date == "2024-12-15" for d in det)
    flagged = read(spark, store, "flagged")
    assert sorted(r["rank"] for r in flagged.collect()) == list(range(1, flagged.count() + 1))
    total = {r.detection_id: r.s for r in flagged.groupBy("detection_id").agg(F.sum("overlap_area_m2").alias("s")).collect()}
    assert all(0 < total[d.detection_id] < d.area_m2 + 2 for d in det)
    docs = read(spark, store, "dossiers").collect()
    assert len(docs) == 6 and all(d.violated_law.count(";") == 2 for d in docs)
    assert sum("Corroborated by" in d.dossier_md for d in docs) == 4
    assert len(json.loads(docs[0].dossier_json)["citations"]) == 4
    # running the stage again changes nothing
    before = {n: sorted(map(str, read(spark, store, n).drop("created_at").collect())) for n in ("flagged", "metrics", "dossiers")}
    E.run_evidence(spark, store, ["run-1"], inputs)
    assert before == {n: sorted(map(str, read(spark, store, n).drop("created_at").collect())) for n in before}
    assert E.latest_run(read(spark, store, "detections")).first().run_id == "run-1"


def test_pieces_and_area_in_another_zone(spark, world):
    """A raster in a UTM zone: areas are measured in the working CRS."""
    px, grid, _ = world
    box = grid.select("aoi", "minx", "miny", "maxx", "maxy")
    utm = grid_from_bbox(box, "EPSG:32651", densify=True).withColumns({"t0_date": F.lit(""), "t1_date": F.lit("")})
    g = grid.first()
    sized = utm.withColumns({"h": F.lit(g.h), "w": F.lit(g.w), "a": F.lit(10.0), "e": F.lit(-10.0)})
    det, pieces = E.detect(px, sized, "run-u", crs="EPSG:32651")
    rows = det.collect()
    assert len(rows) == 6 and all(abs(r.area_m2 / (r.n_px * 100.0) - 1) < 0.003 and r.area_m2 != r.n_px * 100.0 for r in rows)
    assert pieces.count() >= 36


def test_run_ids():
    import datetime as dt

    assert E.new_run_id(now=dt.datetime(2024, 5, 6, 7, 8, 9)) == "run-20240506-070809" and E.new_run_id("mine") == "mine"


def write_events(path, name, rows):
    path.mkdir(exist_ok=True)
    (path / name).write_text("\n".join(json.dumps(r) for r in rows))


def test_worker_stream(spark, world, store, tmp_path):
    topic = tmp_path / "topic"
    ts = "2024-05-01T00:00:00Z"
    write_events(topic, "1.json", [
        {"type": "detection.completed", "ts": ts, "run_id": "run-1"}, {"type": "detection.completed", "ts": ts, "run_id": "run-1"},
        {"type": "detection.completed", "ts": ts, "run_id": ""}, {"type": "other", "ts": ts, "run_id": "run-9"}, {"type": "detection.completed", "ts": ts, "run_id": "bad"},
    ])
    seen = []

    def process(sp, runs):
        seen.append(sorted(runs))
        if "bad" in runs:
            raise RuntimeError("no such run")
        E.run_evidence(sp, store, runs, world[2])

    out, dead, ckpt = str(tmp_path / "ready"), str(tmp_path / "dead"), str(tmp_path / "ckpt")

    def go():
        q = WK.start_worker(EV.read_topic(spark, str(topic)), process, out, dead, ckpt, once=True)
        q.awaitTermination(300)
        assert q.exception() is None

    go()
    assert seen == [["bad", "run-1"], ["bad"], ["run-1"]] or seen == [["bad", "run-1"], ["run-1"], ["bad"]]
    assert [r.run_id for r in spark.read.parquet(dead).collect()] == ["bad"]
    ready = spark.read.json(out).collect()
    assert [(r.type, r.run_id) for r in ready] == [("dossiers.ready", "run-1")]
    assert read(spark, store, "dossiers").where("run_id = 'run-1'").count() == 6
    # the same event delivered again is dropped; nothing is left to do
    write_events(topic, "2.json", [{"type": "detection.completed", "ts": ts, "run_id": "run-1"}])
    go()
    assert len(seen) == 3


def test_feed_and_latest(spark, tmp_path):
    topic = tmp_path / "t"
    write_events(topic, "a.json", [{"type": "dossiers.ready", "ts": "2024-01-01T00:00:00Z", "run_id": r} for r in ("r1", "r2")])
    q = WK.start_feed(EV.read_topic(spark, str(topic)), str(tmp_path / "feed"), str(tmp_path / "c"), ["dossiers.ready"], "r2", once=True)
    q.awaitTermination(120)
    assert [r.run_id for r in spark.read.parquet(str(tmp_path / "feed")).collect()] == ["r2"]
    late = WK.start_feed(EV.read_topic(spark, str(topic), "latest"), str(tmp_path / "feed2"), str(tmp_path / "c2"), once=True)
    late.awaitTermination(120)
    assert spark.read.schema("run_id string").parquet(str(tmp_path / "feed2")).count() == 0


def test_latest_keeps_its_first_start(spark, tmp_path):
    topic, since = tmp_path / "t", str(tmp_path / "since")

    def event(run):
        return [{"type": "dossiers.ready", "ts": "2024-01-01T00:00:00Z", "run_id": run}]

    def go():
        q = WK.start_feed(EV.read_topic(spark, str(topic), "latest", since_path=since), str(tmp_path / "feed"), str(tmp_path / "c"), once=True)
        q.awaitTermination(120)
        return sorted(r.run_id for r in spark.read.schema("run_id string").parquet(str(tmp_path / "feed")).collect())

    write_events(topic, "old.json", event("old"))
    os.utime(topic / "old.json", (1.7e9, 1.7e9))
    assert go() == []
    first = EV.first_start(spark, since)
    write_events(topic, "down.json", event("down"))  # comes while no reader is up
    assert go() == ["down"] and EV.first_start(spark, since) == first
    write_events(topic, "next.json", event("next"))
    assert go() == ["down", "next"]


def test_worker_remembers_handled_events_in_a_table(spark, tmp_path):
    topic, handled, seen = tmp_path / "topic", str(tmp_path / "handled"), []

    def event(run, ts="2024-05-01T00:00:00Z"):
        return {"type": "detection.completed", "ts": ts, "run_id": run}

    def go(name, rows, days=None, process=lambda sp, runs: seen.append(sorted(runs))):
        write_events(topic, name, rows)
        events = EV.read_topic(spark, str(topic))
        q = WK.start_worker(events, process, str(tmp_path / "ready"), str(tmp_path / "dead"), str(tmp_path / "c"), True, handled, days)
        q.awaitTermination(120)
        assert q.exception() is None and not q.lastProgress["stateOperators"]

    go("1.json", [event("a"), event("a"), event("b", None)])
    assert seen == [["a", "b"]]
    go("2.json", [event("a"), event("b", None), event("c", "2001-01-01T00:00:00Z")])  # repeated, and one far behind the others
    assert seen[1:] == [["c"]]
    go("3.json", [event("a", "2024-05-02T00:00:00Z")])  # the run once more
    assert seen[2:] == [["a"]]
    # what was handled long ago is no longer read
    spark.sql("SELECT 'z' run_id, timestamp'2024-05-01 00:00:00' ts, date'2020-01-01' day").write.mode("append").partitionBy("day").parquet(handled)
    batch = spark.sql("SELECT 'z' run_id, timestamp'2024-05-01 00:00:00' ts")
    assert WK.unhandled(batch, handled).count() == 0 and WK.unhandled(batch, handled, 30).count() == 1
    # a batch that breaks off before its events are remembered is done again
    def broken(new, path):
        raise RuntimeError("lost")

    keep, WK.remember = WK.remember, broken
    try:
        with pytest.raises(RuntimeError):
            WK.process_new(spark.createDataFrame([("d", None)], "run_id string, ts timestamp"), 9, lambda sp, runs: seen.append(runs), str(tmp_path / "ready"), str(tmp_path / "dead"), handled)
    finally:
        WK.remember = keep
    assert WK.unhandled(spark.createDataFrame([("d", None)], "run_id string, ts timestamp"), handled).count() == 1


def test_imagery_watcher(spark, tmp_path):
    src = tmp_path / "manifests"
    got = []

    def run():
        q = IM.start_watcher(
            IM.read_manifests(spark, str(src)), lambda df, i: got.extend((r.aoi, r.t0_item, r.t1_item) for r in df.collect()), str(tmp_path / "c"), once=True
        )
        q.awaitTermination(120)
        assert q.exception() is None

    write_events(src, "1.json", [{"aoi": "a", "t_label": "t0", "stac_item_id": "s0"}, {"aoi": "b", "t_label": "t1", "stac_item_id": "x1"}])
    run()
    assert got == []
    write_events(src, "2.json", [{"aoi": "a", "t_label": "t1", "stac_item_id": "s1"}])
    run()
    write_events(src, "3.json", [{"aoi": "a", "t_label": "t1", "stac_item_id": "s1"}])
    run()
    assert got == [("a", "s0", "s1")]
    write_events(src, "4.json", [{"aoi": "a", "t_label": "t1", "stac_item_id": "s2"}])
    run()
    assert got[1:] == [("a", "s0", "s2")]
