import random
from collections import defaultdict

import duckdb
import pytest

from fieldlens.llm.line_dedup import dedup, keep_bitmaps
from fieldlens.llm.queries import QUERIES
from fieldlens.llm.query_lines import lines_sql
from pyspark.sql import functions as F
from tools.check import rows_of

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(rows, min_chars=40, min_docs=5):
    """Per row: id, lines, dropped positions, text left. A null id is one document, smaller than all others."""
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(LOW)

    held = defaultdict(set)
    for i, t in rows:
        for x in (t or "").split("\n"):
            held[key(x)].add(i)
    out = []
    for i, t in rows:
        lines, gone = (t or "").split("\n"), []
        for p, x in enumerate(lines):
            ids = held[key(x)]
            if len(key(x)) >= min_chars and len(ids) >= min_docs:
                top = max((d for d in ids if d is not None), default=None)
                if i != top:
                    gone.append(p)
        out.append((i, len(lines), gone, "\n".join(x for p, x in enumerate(lines) if p not in gone)))
    return out


def corpus(seed):
    rng = random.Random(seed)
    long = ["A common Line that many pages hold, number " + str(k) for k in range(6)] + ["é" * 39 + "Z", "x" * 39, "Ä" + "b" * 40]
    rows = []
    for d in range(40):
        lines = []
        for _ in range(rng.randint(0, 8)):
            x = rng.choice(long)
            lines.append(rng.choice(["", " ", "\t", "\x0b "]) + (x.upper() if rng.random() < 0.3 and x.isascii() else x) + rng.choice(["", "\r", "\x0c"]))
            if rng.random() < 0.4:
                lines.append(rng.choice(["", "own", "\xa0" + long[0], f"an own line of this document with the number {d}"]))
        rows.append((d * 7 % 41, "\n".join(lines)))
    rows += [(100, None), (101, ""), (102, "\n\n"), rows[3], rows[3], (rows[4][0], rows[5][1]), (None, rows[6][1]), (None, long[0] + "\n" + long[1])]
    rows += [(103, "\n".join([long[2]] * 300) + "\n" + "y" * 100_000)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame([(i, t, "k", 7) for i, t in rows], "doc_id long, text string, kept string, h1 int")
    want = brute(rows)
    got = dedup(docs)
    assert got.columns == ["doc_id", "h1", "n_lines", "n_dropped", "kept"]
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in got.collect()), key=str) == sorted(
        ((i, n, len(g), k) for i, n, g, k in want), key=str)
    bitmaps = []
    for r in keep_bitmaps(docs).collect():
        gone, at = [], 0
        for k, n in enumerate(r.keep_runs):
            gone += range(at, at + n) if k % 2 else []
            at += n
        assert at == r.n_lines and len(gone) == r.n_dropped and all(r.keep_runs[1:-1])
        bitmaps.append((r.doc_id, at, gone))
    assert sorted(bitmaps, key=str) == sorted(((i, n, g) for i, n, g, _ in want), key=str)


def test_sql(spark):
    rows = [r for r in corpus(3) if r[0] is not None]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    cur = con.execute(lines_sql())
    names = [c[0] for c in cur.description]
    got = dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    got = got.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))
    assert rows_of(names, cur.fetchall()) == rows_of(got.columns, [tuple(r) for r in got.collect()])


def test_text_ids_and_empty_table(spark):
    line = "a line of the site that stands on every page of it"
    docs = spark.createDataFrame([(f"d{k}", f"{line}\n{k}") for k in range(6)], "doc_id string, text string")
    assert {r.doc_id: r.n_dropped for r in dedup(docs).collect()} == {f"d{k}": int(k < 5) for k in range(6)}
    assert {r.n_dropped for r in dedup(docs, min_docs=7).collect()} == {0}
    assert dedup(docs.limit(0)).count() == 0 and keep_bitmaps(docs.limit(0)).count() == 0


def test_hot_key_is_spread(spark):
    """No hash and salt holds more than a small part of a key that every document holds."""
    from fieldlens.llm.line_dedup import line_entries

    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("the same long line on every page of the site\n"), "id").alias("text"))
    most = line_entries(docs, "doc_id", "text", 40).groupBy("h1", "h2", "salt").count().agg(F.max("count")).first()[0]
    assert most < 20_000 / 100
    got = dedup(docs)
    assert got.where("n_dropped = 0").select("doc_id").collect() == [(19_999,)] and got.where("n_dropped = 1").count() == 19_999


def test_query_plan_is_native(spark, sf):
    plan = QUERIES["op12_line_dedup"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
