"""Headline queries, timed. Prints one JSON line."""

from __future__ import annotations

import json
import os
import shutil
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "nd_index", "tile_store", "change_mask", "raster_scan", "resample_grid", "binary_open", "components", "zonal_stats", "detect_spectral", "detect_tiled", "bilinear_regrid",
    "percentile_stretch", "rgb_composite", "parcel_grid", "parcel_area", "farmland_flagged", "overlap_area", "nearest_label",
    "label_recall", "precision_recall", "rank_flagged", "flagged_layer", "dossier_candidates", "upsert_partial", "best_scene",
    "geojson_parcels", "chunk_text", "char_ngrams", "tfidf_vocab", "tfidf_weights", "vector_topk", "rag_retrieve",
    "dossier_markdown", "grounding_audit", "statute_articles", "keyword_counts",
]


def main() -> int:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    from fieldlens.plans.catalogue import QUERIES
    from fieldlens.plans import imagery
    from fieldlens.plans.evidence import flagship
    from fieldlens.session import build_session

    ckpt = tempfile.mkdtemp(prefix="fieldlens-bench-")
    spark = build_session(
        "bench", f"local[{cpus}]",
        {"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "12g",
         "spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": ckpt},
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Cutting and storing the tiles has a time of its own; the queries after it read the stored tiles.
    todo = dict(QUERIES) | {"flagship": flagship, "tile_store": imagery.tiles}
    names = sys.argv[1:] or ["flagship", *HEADLINE]
    took: dict[str, float] = {}
    todo["table_counts"](spark, sf_dir).collect()  # start the JVM side before timing
    for name in names:
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            todo[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        took[name] = round(statistics.median(times), 3)
        print(f"{name}: {took[name]}", file=sys.stderr, flush=True)
    spark.stop()
    shutil.rmtree(ckpt, ignore_errors=True)
    print(json.dumps({
        "metric": "headline queries, total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
