import random

import numpy as np
import pytest
import xxhash

from fieldlens.llm.queries import QUERIES
from fieldlens.llm.simhash import _blanked, classes, fingerprint, keep_one, links, with_fingerprints


def brute_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", low) if w]
    if not words:
        return 0
    n = min(3, len(words))
    h = [xxhash.xxh64_intdigest(" ".join(words[i : i + n]).encode(), seed=42) for i in range(len(words) - n + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(rows):
    """rows: (id, fp); smallest id reachable."""
    best = {i: i for i, _ in rows}
    changed = True
    while changed:
        changed = False
        for i, a in rows:
            for j, b in rows:
                if bin(a ^ b).count("1") <= 2 and best[j] < best[i]:
                    best[i], changed = best[j], True
    return best


def test_fingerprint():
    rng = random.Random(1)
    for n in (0, 1, 2, 3, 4, 50, 400):
        t = "\t ".join(rng.choices(["Aé", "b", "C", "dd\x0b", "\x85x", "Ü"], k=n))
        assert fingerprint(t.encode()) == brute_fingerprint(t)
    assert fingerprint(b"") == 0 and fingerprint(b"a" * 100 + b" b c " * 40000) == fingerprint(b"a" * 100 + b" B C " * 40000)


@pytest.mark.parametrize("limit", [20_000, 3])
def test_classes_equal_brute_force(spark, limit):
    rng = random.Random(4)
    base = [rng.getrandbits(64) for _ in range(25)]
    rows = []
    for i in range(200):
        f = rng.choice(base)
        for b in rng.sample(range(64), rng.choice([0, 0, 1, 2, 3])):
            f ^= 1 << b
        rows.append((i, f))
    rows += [(7, rows[7][1]), (300, 0), (301, 3), (302, 15), (303, 255)]
    df = spark.createDataFrame([(i, int(np.uint64(f).view(np.int64))) for i, f in rows], "doc_id long, fp long")
    want = components(rows)
    got = classes(df, cell_limit=limit).collect()
    assert len(got) == len(rows)
    assert all(r.component_id == want[r.doc_id] for r in got)


def test_links_are_few_and_close(spark):
    fps = [(1 << k) for k in range(60)] + [0]
    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    rows = links(df).distinct().collect()
    assert all(bin((r.src ^ r.dst) & (2**64 - 1)).count("1") <= 2 for r in rows)
    assert len(rows) < 15 * len(fps)
    assert _blanked(df, 2).count() > 0


def test_edges_and_keep_one(spark):
    text = " ".join(f"word{i}" for i in range(300))
    rows = [(5, text, "a"), (3, text, "b"), (9, None, None), (8, "", "c"), (2, "quite another text", "d"), (3, text, "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    kept = keep_one(docs.withColumnRenamed("fp", "fp2"))
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 8] and kept.columns == ["doc_id", "text", "fp2"]
    assert classes(with_fingerprints(docs.select("doc_id", "text").limit(0))).count() == 0


def test_keep_one_with_null_and_repeated_ids(spark):
    a, b, c, d = (" ".join(f"{w}{i}" for i in range(300)) for w in "abcd")
    rows = [(None, a, "x"), (None, a, "y"), (None, b, None), (1, c, "x"), (1, d, "x"), (1, d, None), (None, d, "x"), (2, c, "x"), (1, c, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = keep_one(docs).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == sorted([(0, a), (0, b), (1, c), (1, d)])
    assert all(tuple(r) in rows for r in kept)


def test_query(spark, sf):
    rows = QUERIES["op8_simhash_near_dedup"](spark, sf).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        assert r.fingerprint == f"{brute_fingerprint(texts[r.doc_id]):016x}"
    want = components([(r.doc_id, int(r.fingerprint, 16)) for r in rows])
    assert {r.doc_id: r.component_id for r in rows} == want
