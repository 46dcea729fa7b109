import math

import duckdb
import pytest

import __spark_entry__ as entry_module
from fieldlens.plans.catalogue import ORACLES, QUERIES
from tools.check import TABLES, rows_of

# A cross-section of all catalogues; tools/check.py runs every query.
SAMPLE = [
    "components", "detect_spectral", "detect_tiled", "bilinear_regrid", "rgb_composite", "raster_crop", "parcel_grid", "overlap_area",
    "nearest_label", "precision_recall", "rank_flagged", "upsert_partial", "geojson_parcels", "tender_flatten", "chunk_text",
    "tfidf_weights", "rag_retrieve", "vector_topk", "dossier_markdown", "grounding_audit",
]


def test_entry(spark):
    df = entry_module.entry(spark)
    rows = df.collect()
    assert rows and all(r.n_flagged_detections > 0 for r in rows)


def test_every_check_has_a_query():
    queries, oracles = entry_module.queries(), entry_module.oracle_sql()
    assert set(oracles) <= set(queries) and len(QUERIES) >= 79
    assert set(QUERIES) - set(ORACLES) == {"lsa_embed", "lsa_query"}


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, sf, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    df = entry_module.queries()[name](spark, sf)
    cur = con.execute(entry_module.oracle_sql()[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(names, cur.fetchall())


def test_lsa_queries_have_unit_rows(spark, sf):
    rows = entry_module.queries()["lsa_embed"](spark, sf).collect()
    assert len(rows) == 200
    assert all(abs(math.sqrt(sum(v * v for v in r.embedding)) - 1) < 1e-4 or not any(r.embedding) for r in rows)


def test_workers_find_the_package_from_any_folder(sf, tmp_path):
    """Python workers start in the job's folder, which need not be this repository."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.abspath(entry_module.__file__))
    code = (
        f"import sys; sys.path.insert(0, {root!r})\n"
        "import __spark_entry__ as e\n"
        "from fieldlens.session import build_session\n"
        "s = build_session('away', 'local[2]', {'spark.ui.enabled': 'false', 'spark.sql.shuffle.partitions': '2'})\n"
        f"print('rows', e.queries()['tfidf_weights'](s, {sf!r}).count(), e.queries()['components'](s, {sf!r}).count())\n"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "rows 200 " in done.stdout, done.stderr[-2000:]
