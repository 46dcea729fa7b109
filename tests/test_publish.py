import pytest
from pyspark.sql import functions as F

from fieldlens.operators import tiles as TL
from fieldlens.plans import evidence as E
from fieldlens.plans import publish as P
from tests.test_chain import world  # noqa: F401

TILE = 128


@pytest.fixture(scope="module")
def imagery(spark, world):  # noqa: F811
    """The offline sample as stored tiles and a manifest."""
    px, grid, _ = world
    dates = [px.selectExpr("aoi", f"'{t}' AS t_label", "row", "col", *[f"{b}_{t} AS {b}" for b in TL.INDEX_BANDS]) for t in ("t0", "t1")]
    both = dates[0].unionByName(dates[1])
    grids = grid.select("aoi", F.explode(F.array(F.lit("t0"), F.lit("t1"))).alias("t_label"), "h", "w")
    tiles = TL.store_tiles(TL.cut_tiles(both, grids, ["aoi", "t_label"], TL.INDEX_BANDS, TILE), "tiles_of_sample", 4)
    manifest = grid.select("*", F.explode(F.array(F.lit("t0"), F.lit("t1"))).alias("t_label")).selectExpr(
        "aoi", "t_label", "'EPSG:3826' AS crs", "array(a, 0D, c, 0D, e, f) AS transform", "h AS height", "w AS width",
        "map('B04', 'x') AS bands", "if(t_label = 't0', concat(t0_date, 'T00:00:00Z'), concat(t1_date, 'T00:00:00Z')) AS datetime",
        "1D AS cloud_cover", "'sample' AS source", "t_label AS stac_item_id")
    return tiles, manifest


def test_run_is_published_whole_or_not_at_all(spark, world, imagery, tmp_path, monkeypatch):  # noqa: F811
    tiles, manifest = imagery
    store, inputs = E.Store(str(tmp_path)), world[2]
    assert P.current(spark, store, "metrics") is None
    settings = E.D.Settings(tile_px=TILE)
    assert P.run_pipeline(spark, store, tiles, manifest, inputs, "run-1", settings) == "run-1"
    m = P.current(spark, store, "metrics").first()
    assert (m.n_detections, m.n_flagged_detections, m.n_true_positive_detections, m.n_labels, m.n_labels_matched) == (6, 6, 4, 5, 4)
    assert (m.precision, m.recall, m.f1) == (0.6667, 0.8, 0.7273)
    det = P.current(spark, store, "detections").collect()
    assert len(det) == 6 and {(d.t0_date, d.t1_date, d.detector_used) for d in det} == {("2020-01-15", "2024-12-15", "spectral")}
    assert all(3000 <= d.area_m2 <= 3600 for d in det)
    docs = {r.detection_id: r for r in P.current(spark, store, "dossiers").collect()}
    assert len(docs) == 6 and spark.read.json(store.path("events")).count() == 1

    # A failure between the writes: readers still see the old version of all tables.
    frame = type(P.current(spark, store, "metrics"))
    plain = frame.write.fget
    before = {n: sorted(map(str, P.current(spark, store, n).collect())) for n in P.STAGES}
    writes = []

    def failing(self):
        writes.append(1)
        if len(writes) > 2:
            raise OSError("disk")
        return plain(self)

    stages = {n: P.current(spark, store, n).withColumn("created_at", F.current_timestamp()) for n in P.STAGES}
    with monkeypatch.context() as mp:
        mp.setattr(frame, "write", property(failing))
        with pytest.raises(OSError):
            P.publish(spark, store, stages, ["run-1"])
    assert before == {n: sorted(map(str, P.current(spark, store, n).collect())) for n in P.STAGES}
    assert P.history(spark, store, "detections").count() == 6  # what was left behind belongs to no version

    # The same run again, over fewer known sites: metrics get a second entry, documents keep their first time.
    other = E.Inputs(**{**inputs.__dict__, "labels": inputs.labels.where("pid <> 'sample-0'")})
    P.run_pipeline(spark, store, tiles, manifest, other, "run-1", settings)
    assert P.current(spark, store, "metrics").first().n_true_positive_detections == 3
    assert P.history(spark, store, "metrics").count() == 2 and P.current(spark, store, "detections").count() == 6
    again = {r.detection_id: r for r in P.current(spark, store, "dossiers").collect()}
    assert {k: r.created_at for k, r in again.items()} == {k: r.created_at for k, r in docs.items()}
    assert sum("Corroborated by" in r.dossier_md for r in again.values()) == 3


def test_documents_without_a_flagged_row_go(spark):
    kind = "run_id string, aoi string, detection_id long, parcel_id string, landcode string, dossier_md string"
    old = spark.createDataFrame([("r", "a", 1, "p", "first", "x"), ("r", "a", 2, "q", "gone", "y")], kind).withColumn("created_at", F.lit("2020-01-01").cast("timestamp"))
    new = spark.createDataFrame([("r", "a", 1, "p", "second", "new"), ("r", "a", 3, "s", "own", "z")], kind)
    got = {r.detection_id: r for r in P.keep_first(old, new).collect()}
    assert set(got) == {1, 3} and (got[1].landcode, got[1].dossier_md, got[1].created_at.year) == ("first", "new", 2020)
    assert got[3].landcode == "own" and got[3].created_at.year > 2020
