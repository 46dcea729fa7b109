import math
import random
from collections import Counter

import duckdb
import numpy as np
import pytest

from fieldlens.llm import ranked_search
from fieldlens.llm.query_search import search_sql
from fieldlens.llm.ranked_search import Items, length_factor, search, terms_of
from tools.check import rows_of


def brute(docs, items, top):
    texts = [(i, Counter(terms_of((t or "").encode()))) for i, t in docs]
    texts = [(i, c, sum(c.values())) for i, c in texts if c]
    n_docs, n_terms = len(texts), sum(n for _, _, n in texts)
    df = Counter(t for _, c, _ in texts for t in c)
    out = []
    for name, text in items:
        scored = []
        for i, c, n in texts:
            m = 100 - 25 + (25 * n * n_docs) // n_terms
            score = 0
            for t in terms_of((text or "").encode()):
                if t in c:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 12 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(name, k + 1, s[3], -s[0]) for k, s in enumerate(sorted(scored)[:top])]
    return out


def corpus(seed, n=300):
    rng = random.Random(seed)
    vocab = ["the", "of", "X9", "Éa", "日本", "a_b", "end."] + [f"w{k}" for k in range(60)]
    weights = [1 / (k + 1) for k in range(len(vocab))]
    items = [(k, " ".join(rng.choices(vocab, weights, k=rng.choice([1, 3, 12, 40])))) for k in range(14)]
    docs = [(d * 13 % n, " ".join(rng.choices(vocab, weights, k=rng.choice([0, 2, 30, 200])))) for d in range(n)]
    docs += [(1000 + k, docs[7][1] + " " + items[2][1]) for k in range(60)]  # ties
    docs += [(2000, None), (2001, ""), (2002, "?!"), (None, items[3][1]), (None, items[3][1]), (5, docs[3][1]), (2003, items[5][1] * 300)]
    return docs, items + [(50, None), (51, ""), (52, "zzz unknown"), (53, items[2][1]), (53, items[4][1]), (None, items[1][1])]


@pytest.mark.parametrize("seed,block_bytes,block_terms", [(1, 1 << 20, 1_000_000), (2, 900, 1_000_000), (3, 4000, 60)])
def test_equals_brute_force(spark, seed, block_bytes, block_terms):
    docs, items = corpus(seed)
    df = spark.createDataFrame([(i, t, 1, "z") for i, t in docs], "doc_id long, text string, score int, item_id string").repartition(3)
    bench = spark.createDataFrame([(i, t, 9) for i, t in items], "item_id long, text string, rank int")
    for top in (1, 20):
        got = search(df, bench, top, block_bytes=block_bytes, block_terms=block_terms)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        assert sorted(map(tuple, got.collect()), key=str) == sorted(brute(docs, items, top), key=str)


def test_sql(spark):
    docs, items = corpus(4)
    docs, items = [d for d in docs if d[0] is not None], [i for i in items if i[0] is not None]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.execute("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", docs)
    con.executemany("INSERT INTO benchmark VALUES (?, ?)", items)
    cur = con.execute(search_sql())
    names = [c[0] for c in cur.description]
    got = search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert rows_of(names, cur.fetchall()) == rows_of(got.columns, [tuple(r) for r in got.collect()])


def test_edges(spark):
    docs = spark.createDataFrame([("b", "one two"), ("a", "two one"), ("c", "three")], "doc_id string, text string")
    bench = spark.createDataFrame([("q", "One")], "item_id string, text string")
    got = search(docs, bench).collect()
    assert [(r.item_id, r["rank"], r.doc_id) for r in sorted(got, key=lambda r: r["rank"])] == [("q", 1, "a"), ("q", 2, "b")]
    assert search(docs.limit(0), bench).count() == 0 and search(docs, bench.limit(0)).count() == 0
    everywhere = spark.createDataFrame([(k, "same") for k in range(50)], "doc_id long, text string")
    assert search(everywhere, spark.createDataFrame([(1, "same")], "item_id long, text string")).collect()[0].doc_id == 0


def test_bounds_and_work():
    """Bounds are the exact sums of range maxima, and the search scores few documents where a floor is known."""
    rng = np.random.default_rng(0)
    items = Items([[b"a", b"b", b"a"], [b"c"], [b"d", b"b"]])
    n, counts = np.sort(rng.integers(5, 90, 500))[::-1].copy(), rng.poisson(0.4, (4, 500))
    term, place = np.nonzero(counts)
    row = {
        "n": n.astype("<i8").tobytes(), "id_rank": rng.permutation(500).astype("<i4").tobytes(), "terms": np.arange(4),
        "df": (counts > 0).sum(axis=1), "places": place.astype("<i4").tobytes(), "tf": counts[term, place].astype("<i4").tobytes(),
    }
    weights = np.array([700, 900, 40, 5000])
    block = ranked_search.Block(row, weights, items, 500, int(n.sum()))
    m = length_factor(n, 500, int(n.sum()))
    impact = weights[:, None] * (1_000_000_000 * counts // (1000 * counts + 12 * m))
    times = np.array([[2, 1, 0, 0], [0, 0, 1, 0], [0, 1, 0, 1]])
    lo = rng.integers(0, 500, 300)
    hi = lo + 1 + rng.integers(0, 500 - lo)
    item = rng.integers(0, 3, 300)
    bound, doc = block.bounds(item, lo, hi)
    for q, a, b, x, d in zip(item, lo, hi, bound, doc):
        parts = (times[q][:, None] * impact)[:, a:b]
        assert x == parts.max(axis=1).sum()
        assert x == 0 or (a <= d < b and (times[q][:, None] * impact)[:, d].max() == parts.max())
    exact = times @ impact
    for top in (1, 20):
        got = block.search(np.zeros(3, np.int64), top)
        for q in range(3):
            own = got[0] == q
            assert sorted(got[2][own])[::-1] == sorted(exact[q])[::-1][:top]
    scored = []
    plain = block.scores
    block.scores = lambda i, d: (scored.append(len(i)), plain(i, d))[1]
    floor = np.sort(exact, axis=1)[:, -20]
    block.search(floor, 20)
    assert sum(scored) < 700 and ranked_search.weight(500, 500) >= 0
    block.scores = plain


def test_length_factor_of_huge_corpora():
    n = np.array([3, 10**12], np.int64)
    assert length_factor(n, 10**11, 10**14).tolist() == [75, 75 + 25 * 10**12 * 10**11 // 10**14]
