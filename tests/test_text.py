import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldlens.functions import text as X
from fieldlens.operators import dossiers as DO
from fieldlens.operators import retrieval as RT
from fieldlens.operators import topk as TK

CORPUS = [
    "工廠管理輔導法 第28-1條 新增建未登記工廠 停止供電供水 拆除",
    "區域計畫法 第21條 違反非都市土地使用管制 罰鍰 拆除地上物",
    "農業發展條例 農地農用 農業用地 定義",
    "non-urban land use control regulations agricultural land factory prohibited",
]


def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id long, text string")


def plain_chunks(text, size, overlap):
    text = text.strip()
    step = max(1, size - overlap)
    return [text] if len(text) <= size else [text[s : s + size] for s in range(0, len(text), step)]


@pytest.mark.parametrize("size,overlap", [(10, 3), (7, 7), (600, 80), (5, 0)])
def test_chunks(spark, size, overlap):
    texts = ["", "  a ", "x" * size, "法" * (size + 1), "農地abc " * 40, "tail" * 26 + "　\n"]
    df = docs(spark, texts).withColumn("body", X.strip(F.col("text")))
    rows = df.select("id", X.chunks(F.col("body"), size, overlap).alias("c"), X.chunk_count(F.col("body"), size, overlap).alias("n")).collect()
    for r in rows:
        assert r.c == plain_chunks(texts[r.id], size, overlap) and r.n == len(r.c)


def test_chunk_index_runs_per_code(spark):
    arts = [("p", "T", 0, "1", "a" * 25), ("p", "T", 1, None, "b"), ("q", "U", 0, "1", "c" * 12), ("p", "T", 2, "3", "d" * 30)]
    df = spark.createDataFrame(arts, "pcode string, law_title string, article_pos long, article_no string, text string")
    got = sorted((r.pcode, r.chunk_index, r.article_no, r.content) for r in RT.chunk_articles(df, 10, 2).collect())
    want = []
    for code in ("p", "q"):
        pieces = [(no, c) for p, t, _, no, x in arts if p == code for c in plain_chunks(f"{t} {no or ''}：{x}", 10, 2)]
        want += [(code, i, no, c) for i, (no, c) in enumerate(pieces)]
    assert got == sorted(want)


def grams_by_definition(text):
    out = {}
    for w in text.lower().split():
        w = f" {w} "
        for n in range(2, 5):
            offset = 0
            out[w[:n]] = out.get(w[:n], 0) + 1
            while offset + n < len(w):
                offset += 1
                out[w[offset : offset + n]] = out.get(w[offset : offset + n], 0) + 1
            if offset == 0:
                break
    return out


def dense_tfidf(texts, vocab=None):
    counts = [grams_by_definition(t) for t in texts]
    terms = sorted({t for c in counts for t in c})
    x = np.array([[c.get(t, 0) for t in terms] for c in counts], dtype=float)
    idf = np.log((1 + len(texts)) / (1 + (x > 0).sum(0))) + 1
    x *= idf
    return terms, x / np.linalg.norm(x, axis=1, keepdims=True), idf


def test_ngrams_and_weights(spark):
    texts = [*CORPUS, "a", "A bb  a\nfactory"]
    assert all(RT.gram_counts(t) == grams_by_definition(t) for t in texts)
    df = docs(spark, texts)
    terms, x, idf = dense_tfidf(texts)
    got = {(r.id, r.term): r.tf for r in RT.term_counts(df, "id", "text").collect()}
    assert got == {(i, t): k for i, text in enumerate(texts) for t, k in grams_by_definition(text).items()}
    vocab = {r.term: r.idf for r in RT.vocabulary(df, "text").collect()}
    assert sorted(vocab) == terms and np.allclose([vocab[t] for t in terms], idf)
    w = {(r.id, r.term): r.weight for r in RT.tfidf_weights(df, "id", "text", RT.fit_tfidf(df, "text")).collect()}
    assert all(abs(w[i, t] - x[i, j]) < 1e-12 for i in range(len(texts)) for j, t in enumerate(terms) if x[i, j])
    small = RT.vocabulary(df, "text", 5).collect()
    order = sorted(((-sum(grams_by_definition(t).get(g, 0) for t in texts), g) for g in terms))[:5]
    assert {r.term for r in small} == {g for _, g in order}


def test_lsa_shape_norm_and_determinism(spark, tmp_path):
    df = docs(spark, CORPUS)
    model = RT.fit_lsa(df, "text")
    vec = np.array([r.embedding for r in RT.encode(df, "text", model).orderBy("id").collect()])
    assert vec.shape == (4, 384) and np.allclose(np.linalg.norm(vec, axis=1), 1, atol=1e-4) and model.rank == 3
    again = RT.encode(df, "text", RT.fit_lsa(df.orderBy(F.desc("id")), "text")).orderBy("id").collect()
    assert np.allclose(vec, [r.embedding for r in again], atol=1e-5)
    model.save(spark, str(tmp_path / "lsa"))
    loaded = RT.encode(df, "text", RT.LsaModel.load(spark, str(tmp_path / "lsa"))).orderBy("id").collect()
    assert np.allclose(vec, [r.embedding for r in loaded], atol=1e-6)


def test_lsa_similarities_equal_numpy_svd(spark):
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(60)]
    texts = [" ".join(rng.choice(words[10 * (i % 6) : 10 * (i % 6) + 12], 25)) for i in range(40)]
    df = docs(spark, texts)
    k = 5
    model = RT.fit_lsa(df, "text", dim=k)
    got = np.array([r.embedding for r in RT.encode(df, "text", model).orderBy("id").collect()], dtype=float)
    _, x, _ = dense_tfidf(texts)
    z = x @ np.linalg.svd(x, full_matrices=False)[2][:k].T
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    assert np.abs(got @ got.T - z @ z.T).max() < 2e-2


@pytest.mark.parametrize("item_bytes,query_bytes", [(32 << 20, 8 << 20), (6000, 2000), (1, 1500)])
def test_topk_equals_brute_force(spark, item_bytes, query_bytes):
    rng = np.random.default_rng(11)
    x, q = rng.normal(size=(500, 16)), rng.normal(size=(90, 16))
    x[7] = x[3]
    x[9] = 0
    items = spark.createDataFrame([(int(i), [float(v) for v in r]) for i, r in enumerate(x)], "item_id long, vector array<double>")
    queries = spark.createDataFrame([(int(i), [float(v) for v in r]) for i, r in enumerate(q)], "query_id long, vector array<double>")
    got = {}
    for r in TK.topk_vectors(items.repartition(5), queries, 6, item_bytes, query_bytes).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = r.item_id
    with np.errstate(invalid="ignore", divide="ignore"):
        sim = np.round(x @ q.T / (np.linalg.norm(x, axis=1)[:, None] * np.linalg.norm(q, axis=1)), 12)
    sim[9] = -9
    for j in range(90):
        best = sorted(range(500), key=lambda i: (-sim[i, j], i))[:6]
        assert [got[j][k] for k in range(1, 7)] == best


def test_zero_vector_comes_last(spark):
    items = spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 0.0])], "item_id long, vector array<double>")
    q = spark.createDataFrame([(0, [1.0, 1.0])], "query_id long, vector array<double>")
    rows = RT.topk_cosine(items, q, 6).orderBy("rank").collect()
    assert [(r.item_id, r.similarity is None) for r in rows] == [(2, False), (1, True)]


def test_tfidf_topk(spark):
    texts = [*CORPUS, "agricultural land", "factory"]
    df = docs(spark, texts)
    asked = spark.createDataFrame([(0, "factory on agricultural land"), (1, "zzzz")], "query_id long, text string")
    rows = RT.topk_tfidf(df.withColumnRenamed("id", "item_id"), asked, 3, RT.fit_tfidf(df, "text")).collect()
    assert {r.item_id for r in rows if r.query_id == 0} == {3, 4, 5}


@pytest.mark.parametrize("item_bytes,query_bytes", [(32 << 20, 8 << 20), (9000, 3000)])
def test_sparse_topk_equals_brute_force(spark, item_bytes, query_bytes):
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("abcdefgh"), rng.integers(2, 7))) for _ in range(80)]
    share = 1 / np.arange(1, 81)
    texts = [" ".join(rng.choice(words, rng.integers(0, 40), p=share / share.sum())) for _ in range(150)] + ["abc abc", "abc abc"]
    df = docs(spark, texts)
    model = RT.fit_tfidf(df, "text")
    asked = [texts[3] + " zz", texts[9], words[70], "", "qqqq"]
    queries = spark.createDataFrame(list(enumerate(asked)), "query_id long, text string")

    def vectorise(batch):
        return (model.sparse(t.as_py() or "") for t in batch)

    got = TK.topk_sparse(df.withColumnRenamed("id", "item_id").repartition(4), queries, 7, vectorise, item_bytes, query_bytes).collect()
    x = np.zeros((len(texts), len(model.index)))
    for row, t in zip(x, texts):
        cols, w = model.sparse(t)
        row[cols] = w
    for j, t in enumerate(asked):
        cols, w = model.sparse(t)
        score = np.round(x[:, cols] @ w, 12)
        best = sorted(range(len(texts)), key=lambda i: (-score[i], i))[:7]
        mine = sorted((r["rank"], r.item_id, r.similarity) for r in got if r.query_id == j)
        assert [m[1] for m in mine] == best and np.allclose([m[2] for m in mine], score[best], atol=1e-11)


def test_bounds_leave_most_items_out():
    """Frequent light terms are not followed for items that cannot reach the best any more."""
    rng = np.random.default_rng(2)
    n = 3000
    x = np.zeros((n, 40))
    x[:, :30] = rng.random((n, 30)) * 0.05
    x[rng.integers(0, n, 60), rng.integers(30, 40, 60)] = 1.0
    cols, rows = np.nonzero(x.T)
    index = TK.Postings(n, rows.astype(np.int32), cols.astype(np.int32), x.T[cols, rows])
    w = np.where(np.arange(40) < 30, 0.1, 1.0)
    at, score, done = index.best(np.arange(40), w, 5)
    exact = np.round(x @ w, 12)
    assert at.tolist() == sorted(range(n), key=lambda i: (-exact[i], i))[:5] and np.allclose(score, exact[at]) and done < n / 10


def test_topk_keeps_queries_off_the_driver(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    items = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(50)], "item_id long, vector array<double>")
    for name in ("toPandas", "collect", "toArrow", "toLocalIterator"):
        monkeypatch.setattr(DataFrame, name, lambda self, *a, **k: pytest.fail("rows went to the driver"))
    RT.topk_cosine(items, items.withColumnRenamed("item_id", "query_id"), 3).write.format("noop").mode("overwrite").save()


def test_vocabulary_cut_and_joined_weights(spark, monkeypatch):
    rng = np.random.default_rng(8)
    texts = [" ".join("".join(rng.choice(list("abcde"), rng.integers(1, 5))) for _ in range(30)) for _ in range(25)]
    df = docs(spark, texts)
    whole = {r.term: (r.corpus_tf, r.idf) for r in RT.vocabulary(df, "text", None).collect()}
    order = sorted(whole, key=lambda t: (-whole[t][0], t))
    for limit in (1, 7, 50, len(whole) - 1, len(whole), len(whole) + 5):
        assert {r.term for r in RT.vocabulary(df, "text", limit).collect()} == set(order[:limit])
    plain = {(r.id, r.term): r.weight for r in RT.tfidf_weights(df, "id", "text", RT.fit_tfidf(df, "text")).collect()}
    for hot in (1, 40, 10**9):  # no term is hot, some, all
        monkeypatch.setattr(RT, "HOT_TERMS", hot)
        got = {(r.id, r.term): r.weight for r in RT.joined_weights(df, "id", "text", RT.vocabulary(df, "text", None)).collect()}
        assert set(got) == set(plain) and all(abs(got[k] - plain[k]) < 1e-12 for k in got)


CITE = "array<struct<rank:int,law_title:string,article_no:string,content:string,similarity:double>>"


def candidate(spark, distance, cites, conf=0.7):
    row = ("彰化縣", "和美鎮", "Pilot", None, "段", 3600.4, 3500.5, "2020-01-15", "2024-12-15", 0.25, 0.4, "spectral", conf, 24.12, 120.5, "L1", distance, cites)
    return spark.createDataFrame(
        [row],
        "county string, township string, display_name string, landcode string, sectname string, area_m2 double, overlap_area_m2 double, t0_date string, t1_date string, "
        f"ndbi_delta double, ndvi_drop double, detector string, confidence double, lat double, lon double, matched_label_id string, distance_to_label_m double, citations {CITE}",
    )


def test_documents(spark):
    cites = [(i, f"Law{i}", None if i == 2 else f"第{i}條", "text", 0.165) for i in (1, 2, 3, 4)]
    df = candidate(spark, 79.5, cites).withColumn("d", DO.template_dossier(F.col("citations"), 80.0))
    r = df.select(
        "d", DO.facts_block(80.0).alias("facts"), DO.statutes_block(F.col("citations")).alias("st"), DO.violated_law(F.col("d")).alias("law"),
        DO.render_markdown(F.col("d"), F.col("citations"), F.lit("m")).alias("md"), DO.query_text().alias("q"),
        DO.payload_json(["landcode", "lat"], F.col("d"), F.col("citations"), F.lit("m")).alias("js"),
        DO.grounding_issues(F.col("d.violated_statutes"), F.col("citations"), F.col("d.evidence"), DO.facts_block(80.0), F.col("d.summary")).alias("issues"),
    ).first()
    assert len(r.d.evidence) == 3 and len(r.d.violated_statutes) == 3 and r.d.confidence_label == "high"
    assert r.law == "Law1 第1條; Law2; Law3 第3條" and "(地號 landcode): None  Section" in r.facts and "~3600 m²" in r.d.evidence[0]
    assert "at 80 m" in r.facts and "(overlap on farmland 3500 m²)" in r.facts  # halves go to the even number
    assert r.st.startswith("[1] Law1 第1條\ntext\n\n[2] Law2 \ntext") and "- [4] Law4 第4條 (sim 0.17)" in r.md and r.issues == []
    assert r.md.splitlines()[0] == "# Enforcement Dossier — Parcel None (彰化縣和美鎮)" and '"landcode":null' in r.js and r.q.startswith("農地（彰化縣和美鎮 段 地號 ）")
    empty = candidate(spark, None, [], None).withColumn("d", DO.template_dossier(F.col("citations"), 80.0))
    e = empty.select("d", DO.statutes_block(F.col("citations")).alias("st"), DO.facts_block(80.0).alias("facts"), DO.violated_law(F.col("d")).alias("law")).first()
    assert len(e.d.evidence) == 2 and e.d.confidence_label == "low" and e.st == "(no statute excerpts retrieved)" and e.law == ""
    assert e.facts.endswith("corroboration: none")


@pytest.mark.parametrize("limit", [1000, 20000])
def test_a_batch_goes_out_in_pieces(limit, monkeypatch):
    """What a worker gives out at once is bounded by characters, not by the rows of an Arrow batch."""
    import pyarrow as pa

    monkeypatch.setattr(RT, "_PIECE_CHARS", limit)
    texts = ["aa bb", None, "", "x" * 50_000, *["some words of a text"] * 3000]
    batch = pa.RecordBatch.from_pydict({"id": list(range(len(texts))), "text": texts})
    parts = list(RT._pieces([batch], "text"))
    assert [i for part, _ in parts for i in part.column("id").to_pylist()] == list(range(len(texts)))
    assert [t for _, own in parts for t in own] == texts
    assert all(len(own) == 1 or sum(len(t or "") for t in own) <= limit for _, own in parts) and len(parts) >= 3000 * 20 / limit


def test_words_learnt_together_equal_definition(monkeypatch):
    monkeypatch.setattr(RT, "_WORD_MEMO", 3)
    texts = ["a bb ccc", "x\x00 \x00\x00 y", "農地 上 新增 𝔘𝔫𝔦 é", "", None, "İstanbul ß a bb", "ccc ccc bb"]
    table = RT.GramTable()
    for group in (texts, texts[::-1], texts[2:5]):
        rows = list(table.rows(group))
        names = list(table.index)
        assert [{names[i]: k for i, k in zip(*r)} for r in rows] == [grams_by_definition(t or "") for t in group]
    closed = RT.GramTable({" a": 0, "bb": 1, "農地": 2})
    assert [dict(zip(i.tolist(), k.tolist())) for i, k in closed.rows(texts)] == [
        {c: grams_by_definition(t or "")[g] for g, c in closed.index.items() if g in grams_by_definition(t or "")} for t in texts]
    many = "".join(map(chr, range(0x10000, 0x10000 + 66000)))  # more characters than fit a key of four
    assert RT.gram_counts(many) == grams_by_definition(many)


def test_item_blocks_are_texts_and_row_groups_small(spark):
    """Blocks hold texts, not vectors, and a reader never loads more than a few of them at once."""
    import pyarrow.parquet as pq

    rng = np.random.default_rng(6)
    texts = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz "), 3000)) for _ in range(64)]
    df = docs(spark, texts).withColumnRenamed("id", "item_id").coalesce(1)
    blocks = TK.pack_texts(df.crossJoin(spark.range(200).select("id")).select("item_id", "text").coalesce(1), "item_id", TK.ITEM_TEXT_BYTES, "test_blocks")
    at = blocks.inputFiles()[0].removeprefix("file:").replace("///", "/")
    meta = pq.ParquetFile(at).metadata
    assert blocks.count() > 30 and max(meta.row_group(i).total_byte_size for i in range(meta.num_row_groups)) < 80 << 20
    assert blocks.selectExpr("max(aggregate(texts, 0L, (s, t) -> s + octet_length(t))) AS n").first().n <= TK.ITEM_TEXT_BYTES


def test_products_of_a_block_equal_the_definition():
    rng = np.random.default_rng(12)
    n, terms, width = 40, 30, 5
    tf = rng.integers(0, 3, (n, terms)) * (rng.random((n, terms)) < np.linspace(0.02, 0.9, terms))
    tf[7] = 0
    idf, m = 1 + rng.random(terms), rng.normal(size=(terms, width))
    a = tf * idf
    a = a / np.maximum(np.linalg.norm(a, axis=1, keepdims=True), 1e-300)
    own, cols = np.nonzero(tf)
    z = np.zeros((terms, width))
    for products in (1, 1 << 22):
        RT._PRODUCTS, kept = products, RT._PRODUCTS
        z[:] = 0
        RT._add_products(z, m, idf, np.cumsum(np.bincount(own, minlength=n)), cols, tf[own, cols])
        RT._PRODUCTS = kept
        assert np.allclose(z, a.T @ (a @ m), atol=1e-12)


def test_only_a_piece_of_a_batch_is_made_to_strings(monkeypatch):
    """Texts are made Python objects piece by piece, so a worker's memory does not grow with the batch."""
    import tracemalloc

    import pyarrow as pa

    monkeypatch.setattr(RT, "_PIECE_CHARS", 100_000)
    batch = pa.RecordBatch.from_pydict({"id": list(range(400)), "text": ["農" + "x" * 19_999] * 400})
    tracemalloc.start()
    assert sum(len(own) for _, own in RT._pieces([batch], "text")) == 400
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 2_000_000  # all texts at once: 16 MB


def shuffled_rows(df):
    """Rows that the exchanges of an executed query wrote."""
    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        own = node.metrics().get("shuffleRecordsWritten").get().value() if name == "ShuffleExchangeExec" else 0
        return own + sum(walk(node.children().apply(i)) for i in range(node.children().size()))

    return walk(df._jdf.queryExecution().executedPlan())


def test_rows_of_frequent_terms_are_not_shuffled(spark):
    rng = np.random.default_rng(21)
    words = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(60)]
    df = docs(spark, [" ".join(rng.choice(words, 30)) for _ in range(200)]).repartition(4).localCheckpoint()
    weights = RT.joined_weights(df, "id", "text", RT.vocabulary(df, "text", None))
    assert len(weights.collect()) > 200 * 60 > 5 * shuffled_rows(weights)


@pytest.mark.parametrize("hot", [1, 40, 1 << 19])
def test_texts_of_one_key_share_a_norm(spark, monkeypatch, hot):
    """Repeated and missing keys; null and empty texts have no rows."""
    monkeypatch.setattr(RT, "HOT_TERMS", hot)
    rows = [(1, "aa bb"), (1, "bb ccc"), (1, "bb ccc"), (None, "aa"), (None, "ddd a"), (2, None), (3, ""), (4, "aa ddd ddd")]
    df = spark.createDataFrame(rows, "id long, text string")
    idf = {r.term: r.idf for r in RT.vocabulary(df, "text", None).collect()}
    w = [(i, g, k * idf[g]) for i, t in rows for g, k in grams_by_definition(t or "").items()]
    norm = {i: sum(x * x for j, _, x in w if j == i) ** 0.5 for i, _, _ in w}
    want = sorted((str(i), g, round(x / norm[i], 9)) for i, g, x in w)
    got = RT.joined_weights(df, "id", "text", RT.vocabulary(df, "text", None)).collect()
    assert sorted((str(r.id), r.term, round(r.weight, 9)) for r in got) == want


@pytest.mark.parametrize("places", [1, 1 << 22])
def test_grams_of_a_block_equal_definition(monkeypatch, places):
    """Keys in a table or hashed, long texts counted and short ones ordered."""
    monkeypatch.setattr(RT, "_PLACES", places)
    rng = np.random.default_rng(3)
    long = [" ".join("".join(rng.choice(list("abc農\U0001D518."), rng.integers(1, 7))) for _ in range(400)) for _ in range(6)]
    short = [None, "", " ", "a", "a\u2003b\x1cc\x85 ", "İ ß", *["".join(rng.choice(list("abcdefghij "), 4)) for _ in range(300)]]
    for texts in (long, short, [*long, *short], [None, ""], []):
        grams, ends, ids, tf = RT.gram_block(texts)
        got = list(RT._per_text(ends, ids, tf))
        assert [{grams[i]: k for i, k in zip(*r)} for r in got] == [grams_by_definition(t or "") for t in texts]
        assert len(set(grams)) == len(grams) and all((np.diff(i) > 0).all() for i, _ in got)


def test_texts_are_counted_once_for_the_fit(spark, monkeypatch):
    """The vocabulary and the rows of the fit come from the same stored counts, in blocks of a few texts here."""
    monkeypatch.setattr(RT, "_BLOCK_ENTRIES", 50)
    monkeypatch.setattr(RT, "_PIECE_CHARS", 100)
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(text):
        read.add(1)
        return text

    df = docs(spark, [*CORPUS * 3, None, ""])
    model = RT.fit_lsa(df.withColumn("text", seen.asNondeterministic()("text")), "text", dim=3, max_features=60)
    assert read.value == 14
    plain = RT.fit_tfidf(df, "text", 60)
    assert model.tfidf.index == plain.index and np.allclose(model.tfidf.idf, plain.idf, rtol=1e-14)


@pytest.mark.parametrize("cells", [1, 1 << 20])
def test_products_of_frequent_and_rare_columns(monkeypatch, cells):
    monkeypatch.setattr(RT, "_DENSE_CELLS", cells)
    rng = np.random.default_rng(13)
    n, terms, width = 700, 90, 6
    tf = rng.integers(1, 4, (n, terms)) * (rng.random((n, terms)) < np.linspace(0.001, 0.9, terms) ** 2)
    tf[[0, 5, n - 1]] = 0
    idf, m = 1 + rng.random(terms), rng.normal(size=(terms, width))
    a = tf * idf
    a = a / np.maximum(np.linalg.norm(a, axis=1, keepdims=True), 1e-300)
    own, cols = np.nonzero(tf)
    z = np.zeros((terms, width))
    RT._add_products(z, m, idf, np.cumsum(np.bincount(own, minlength=n)), cols, tf[own, cols])
    assert np.allclose(z, a.T @ (a @ m), atol=1e-11)


def test_texts_are_projected_once(spark):
    """A filter on the vectors does not project the texts again."""
    df = docs(spark, CORPUS)
    model = RT.LsaModel(RT.TfidfModel({"農地": 0, "on": 1}, np.ones(2)), np.eye(2), 2)
    kept = RT.encode(df, "text", model, "vector").where("vector IS NOT NULL AND size(vector) > 0").select("id", "vector")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert sum("EvalPython [" in line for line in plan.splitlines()) == 1 and plan.count("project(text") == 1
    assert kept.count() == 4
