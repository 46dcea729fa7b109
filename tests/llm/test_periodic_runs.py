import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from fieldlens.llm.periodic_runs import best_of, collapse, dropped, find_runs
from fieldlens.llm.queries import QUERIES
from fieldlens.llm.recompression import Extensions


def brute(words, least=6, exponent=4):
    """All maximal stretches with smallest period q and at least max(least, exponent q) words."""
    n, stretches = len(words), {}
    for q in range(1, n // exponent + 1):
        at = 0
        while at + q < n:
            if words[at] != words[at + q]:
                at += 1
                continue
            end = at
            while end + q < n and words[end] == words[end + q]:
                end += 1
            if end + q - at >= max(least, exponent * q):
                stretches.setdefault((at, end + q - at), q)
            at = end
    return sorted((s, length, q) for (s, length), q in stretches.items())


def brute_row(doc_id, text):
    words = (text or "").encode().split()
    h, n = zlib.crc32(str(doc_id).encode()), len((text or "").encode().split())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    return (
        doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()).hexdigest(),
        hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest(),
    )


def sequence(rng):
    out = []
    for _ in range(rng.randint(0, 5)):
        kind = rng.random()
        if kind < 0.4:
            unit = [rng.randint(0, 4) for _ in range(rng.randint(1, 9))]
            out += (unit * 12)[: rng.randint(0, 70)]
        elif kind < 0.6:
            out += [rng.randint(0, 1)] * rng.randint(0, 30)
        else:
            out += [rng.randint(0, rng.choice([1, 2, 30])) for _ in range(rng.randint(0, 40))]
    return out


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_brute_force(seed):
    rng = random.Random(seed)
    texts = [sequence(rng) for _ in range(150)] + [[], [1] * 5, [1] * 6, [1, 2] * 4, [1, 2] * 3 + [1], [3] * 400]
    # Runs inside runs: fibonacci words, powers of powers.
    a, b = [0], [0, 1]
    for _ in range(9):
        a, b = b, b + a
    texts += [b, ([1, 1, 1, 1, 1, 1, 2] * 5 + [3]) * 5]
    for got, want in zip(find_runs([np.array(t, np.int64) for t in texts]), texts):
        assert [tuple(r) for r in got.tolist()] == brute(want)


def test_extensions_equal_plain_comparison():
    rng = random.Random(5)
    for size in (3, 40, 700):
        body = []
        while len(body) < size:
            body += rng.choice([[rng.randint(0, 2)] * rng.randint(1, 20), [0, 1] * rng.randint(1, 9), [rng.randint(0, 2) for _ in range(6)]])
        x = np.array([10, *body, 11], np.int64)
        n = len(x)
        i, j = np.array([(a, b) for a in range(n) for b in range(a + 1, n) if rng.random() < 4000 / n / n]).reshape(-1, 2).T
        e = Extensions(x)
        right, left = e.right(i, j), e.left(i, j)
        for a, b, r, le in zip(i, j, right, left):
            k = 0
            while b + k < n and x[a + k] == x[b + k]:
                k += 1
            assert r == k
            k = 0
            while a - k >= 0 and x[a - k] == x[b - k]:
                k += 1
            assert le == k


def test_long_sequences_in_reasonable_time():
    """n log n candidates: 200 000 equal words, and a long period over them."""
    ones = np.zeros(200_000, np.int64)
    unit = np.random.default_rng(1).integers(0, 1000, 30_011)
    got = find_runs([ones, np.tile(unit, 6)[: 30_011 * 5 + 7], unit])
    assert got[0].tolist() == [[0, 200_000, 1]] and got[1].tolist() == [[0, 30_011 * 5 + 7, 30_011]] and not len(got[2])


def test_best_and_dropped():
    runs = np.array([[0, 8, 2], [5, 12, 3], [20, 4_000_001, 1_000_000], [30, 8, 2]])
    assert best_of(runs) == 2 and best_of(runs[[0, 1, 3]]) == 0
    assert dropped(np.array([[1, 6, 1]]), 9).tolist() == [False, False] + [True] * 5 + [False, False]


def test_rows(spark):
    rng = random.Random(9)
    rows = [(k, rng.choice([" ", "\n", " \t "]).join(rng.choice(["é", "b\xa0", "c", "日"]) + str(w) for w in sequence(rng))) for k in range(120)]
    rows += [(500, None), (501, ""), (502, " \n "), rows[3], rows[3], (-7, "x\x85y " * 50), (503, "w " * 30_000)]
    docs = spark.createDataFrame([(i, t, "s", 1) for i, t in rows], "doc_id long, text string, source string, runs int")
    for part in (300, 1 << 22):
        got = collapse(docs, part_bytes=part)
        assert got.columns == ["doc_id", "source", "n_words", "runs", "best", "collapsed"]
        by = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got.collect()), key=str)
        want = []
        for i, t in rows:
            words = (t or "").encode().split()
            runs = brute(words) if i != 503 else [(0, 30_000, 1)]
            gone = {k for s, length, q in runs for k in range(s + q, s + length)}
            want.append((i, len(words), runs, b" ".join(w for k, w in enumerate(words) if k not in gone).decode()))
        assert by == sorted(want, key=str)
    assert collapse(docs.limit(0)).count() == 0
    null_id = spark.createDataFrame([(None, "a b")], "doc_id long, text string")
    assert collapse(null_id).first().n_words == 2


def test_query_equals_brute_force(spark, sf):
    got = QUERIES["op13_periodic_runs"](spark, sf)
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").where("length(text) < 4000").collect()
    small = {r.doc_id for r in rows}
    have = sorted((tuple(r) for r in got.collect() if r.doc_id in small), key=str)
    assert have == sorted((brute_row(*r) for r in rows), key=str)
    assert sum(r[1] > 0 for r in have) >= 10
