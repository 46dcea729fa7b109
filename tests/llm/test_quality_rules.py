import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fieldlens.llm.queries import QUERIES
from fieldlens.llm.query_rules import rules_sql
from fieldlens.llm.quality_rules import clean, judge
from tools.check import rows_of


def corpus():
    body = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
    rows = [(k, f"Menu  of THE site\n{body} body{k} and more of it\nlast line number {k}", "h") for k in range(40)]
    rows += [(100 + k, "menu of the site\n" * 9 + f"tail {k}", "h") for k in range(3)]  # depleted
    rows += [(200 + k, "a copied text\n" + body + " and words to pass the limit of twenty", "h") for k in range(60)]  # copies are one text
    rows += [(300, None, "h"), (301, "", None), (302, "Menu of the site\n" + body + " q w e r t", None), (1, rows[1][1], "h")]
    rows += [(303, "é ÀB\x85c \x0b d" * 30, "h"), (304, "x" * 100_000 + " y" * 5, "h")]
    return rows


def test_edges_equal_sql(spark):
    rows = corpus()
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    cur = con.execute(rules_sql())
    names = [c[0] for c in cur.description]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = judge(docs).drop("source")
    assert rows_of(names, cur.fetchall()) == rows_of(got.columns, [tuple(r) for r in got.collect()])
    by = {r.doc_id: r for r in got.collect()}
    assert by[0].removed_words == 4 and by[0].kept and not by[100].kept and by[200].removed_words == 0 and by[200].kept


def test_clean_takes_common_lines_out(spark):
    docs = spark.createDataFrame([(*r, 5) for r in corpus()], "doc_id long, text string, source string, n_words int")
    kept = clean(docs)
    assert kept.columns == docs.columns
    rows = {r.doc_id: r for r in kept.collect()}
    want = {r.doc_id for r in judge(docs).collect() if r.kept}
    assert set(rows) == want and rows[0].n_words == 5
    assert rows[0].text.split("\n")[1:] == ["last line number 0"] and "Menu" not in rows[0].text
    assert "Menu" in rows[302].text  # another host
    assert clean(docs.limit(0)).count() == 0 and judge(docs.limit(0)).count() == 0


def test_hot_and_other_lines_count_alike(spark, monkeypatch):
    rows = [(k, f"hot line\n{'rare' if k % 3 else 'seldom'} line\nonly {k} here", "h") for k in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for share in (1, 3, 2000):  # no line is hot; only the first one; all common ones
        monkeypatch.setattr("fieldlens.llm.quality_rules.HOT_SHARE", share)
        assert {r.removed_words for r in judge(docs).collect()} == {4}


def test_long_lines_are_counted(spark):
    notice = " ".join(f"cookie{i}" for i in range(35))  # too short for 50-word windows
    rows = [(k, f"{notice}\nown word{k}", "h") for k in range(25)]
    rows += [(100 + k, notice + "\n" + " ".join(f"text{k}x{i}" for i in range(60)), "h") for k in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in judge(docs).collect()}
    assert all(r.removed_words == 35 and r.kept == (r.doc_id >= 100) for r in got.values())
    kept = corpus_pipeline.quality_stage(spark, docs.withColumn("n_chars", F.length("text").cast("long")), "").collect()
    assert sorted(r.doc_id for r in kept) == list(range(100, 105)) and all("cookie" not in r.text for r in kept)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    cur = con.execute(rules_sql())
    names = [c[0] for c in cur.description]
    mine = judge(docs).drop("source")
    assert rows_of(names, cur.fetchall()) == rows_of(mine.columns, [tuple(r) for r in mine.collect()])


@pytest.mark.parametrize("name", ["op1_quality_rules"])
def test_query_plan_is_native(spark, sf, name):
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
