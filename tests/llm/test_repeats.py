import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from fieldlens.llm import repeats as R
from fieldlens.llm import substring_dedup, suffix_dedup
from fieldlens.llm.repeats import Texts, pack_ids, pack_keys, unpack_ids, unpack_keys
from fieldlens.llm.suffix_dedup import Factors, Variety, nearest_smaller, previous_factors


def brute(rows, split, join, size):
    """rows: (id, text); per row: units, removed, spans, sha of the rest, rest."""
    units = [split(t or "") for _, t in rows]
    low = {}
    for (i, _), u in zip(rows, units):
        for a in range(len(u) - size + 1):
            w = tuple(u[a : a + size])
            low[w] = min(low.get(w, i), i)
    out = []
    for (i, _), u in zip(rows, units):
        gone = [False] * len(u)
        for a in range(len(u) - size + 1):
            if low[tuple(u[a : a + size])] < i:
                gone[a : a + size] = [True] * size
        rest = join([x for x, g in zip(u, gone) if not g])
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(u), sum(gone), spans, hashlib.sha256(rest).hexdigest(), rest.decode("utf-8", "ignore")))
    return out


def test_ids_beside_a_null_stay_exact():
    big = 2**53
    texts = Texts(pa.table({"i": pa.array([None, big + 1, big, -1], pa.int64()), "t": ["n", "b", "a", "z"]}), "i", "t")
    assert texts.ids.tolist() == [-1, big, big + 1, 2**63 - 1]
    assert texts.table.column("t").to_pylist() == ["z", "a", "b", "n"]


def sample(seed):
    rng = random.Random(seed)
    words = ["a", "bb", "the", "é", "日本", "long" * 30, "x\x00y", "of"]
    passages = [" ".join(rng.choices(words, k=rng.randint(40, 120))) for _ in range(6)]
    rows = []
    for i in range(70):
        parts = []
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(passages)
            parts.append(p[rng.randint(0, 30) : len(p) - rng.randint(0, 30)] if rng.random() < 0.5 else " ".join(rng.choices(words, k=rng.randint(1, 80))))
        rows.append((i * 7 % 71, rng.choice([" ", "\n", "\t  "]).join(parts)))
    rows += [(200, None), (201, ""), (5, rows[3][1]), (5, rows[3][1]), (300, "ab" * 400), (301, "ab" * 400), (302, "q" * 49), (303, "q" * 49), (304, "q" * 51), (-4, "q" * 50)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_bytes(spark, seed):
    rows = sample(seed)
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, n_bytes int")
    for block in (1 << 20, 3000):
        got = suffix_dedup.dedup(docs, texts_too=True, block_bytes=block)
        want = brute(rows, lambda t: [bytes([b]) for b in t.encode()], b"".join, 50)
        assert sorted(tuple(r) for r in got.collect()) == sorted(want)


@pytest.mark.parametrize("seed", [1, 2])
def test_words(spark, seed):
    rows = sample(seed)
    docs = spark.createDataFrame([(i, t, "z") for i, t in rows], "doc_id long, text string, kept string")
    for window, block in ((50, 1 << 20), (9, 2000)):
        got = substring_dedup.dedup(docs, window=window, texts_too=True, block_bytes=block)
        want = brute(rows, lambda t: t.encode().split(), b" ".join, window)
        assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_dedup.dedup(none).count() == 0 and substring_dedup.dedup(none).count() == 0


def test_packing_of_keys():
    rng = np.random.default_rng(0)
    for n, top in ((0, 9), (1, 9), (5, 2), (1000, 1 << 40), (5000, 1 << 60), (3, 1 << 63)):
        keys = np.sort(rng.integers(0, top, n, dtype=np.uint64))
        data = pack_keys(keys)
        back, at = unpack_keys(data + b"tail")
        assert np.array_equal(back, keys) and at == len(data)
    ids = rng.integers(-(1 << 62), 1 << 62, 777)
    assert np.array_equal(unpack_ids(pack_ids(ids)), ids)


def test_nearest_smaller():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 50, 400):
        owner = rng.integers(0, 9, n)
        before, after = nearest_smaller(owner)
        for k in range(n):
            left = [j for j in range(k) if owner[j] < owner[k]]
            right = [j for j in range(k + 1, n) if owner[j] < owner[k]]
            assert before[k] == (left[-1] if left else -1) and after[k] == (right[0] if right else -1)


def test_factor_lengths_equal_brute_force():
    """The longest prefix shared with any string of a smaller owner, over the whole order."""
    rng = np.random.default_rng(4)
    for n, width, letters in ((1, 5, 2), (60, 7, 2), (200, 50, 3), (120, 16, 2)):
        rows = rng.integers(0, letters, (n, width)).astype(np.uint8)
        rows[n // 2 :] = rows[rng.integers(0, max(1, n // 2), n - n // 2)]
        rows[rng.random(rows.shape) < 0.02] ^= 1
        owner = rng.integers(0, 20, n)
        got = previous_factors(rows, owner)
        for k in range(n):
            shared = [int((rows[k] != rows[j]).argmax()) if (rows[k] != rows[j]).any() else width for j in range(n) if owner[j] < owner[k]]
            assert got[k] == max(shared, default=0)


def test_text_ids_and_repeated_ids(spark):
    passage = "the same words in several documents, long enough for a window of fifty bytes"
    rows = [("b", passage + " of b"), ("a", passage + " of a"), ("c", passage), (None, passage), (None, "x " + passage), ("c", passage + " again")]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    want = {"a": 0, "b": len(passage), "c": len(passage), None: len(passage)}
    for r in suffix_dedup.dedup(docs, block_bytes=100).collect():
        assert r.n_removed - want[r.doc_id] in (0, 1, 2, 4)  # a shared space may go as well
        assert (r.n_removed == 0) == (r.doc_id == "a")
    got = substring_dedup.dedup(docs, window=5, block_bytes=100).collect()
    assert sorted((str(r.doc_id), r.n_removed) for r in got) == sorted((str(i), 0 if i == "a" else 14 + (i == "b")) for i, t in rows)


def test_rows_without_id_are_spread(spark):
    docs = spark.range(2000).selectExpr("cast(null AS long) AS doc_id", "concat('text ', id) AS text")
    at = docs.selectExpr("pmod(xxhash64(doc_id, text), 50) AS b").groupBy("b").count().collect()
    assert len(at) == 50 and max(r["count"] for r in at) < 100
    assert suffix_dedup.dedup(docs, block_bytes=500).count() == 2000


def random_questions(rng, n_blocks, bits, kind):
    """Payloads of blocks that share keys, and the answers by plain rules."""
    blocks = []
    for b in range(n_blocks):
        keys = np.unique(rng.integers(0, 1 << bits, 60, dtype=np.uint64) >> np.uint64(3) << np.uint64(3))
        ids = rng.integers(0, 1000, len(keys)) * n_blocks + b
        blocks.append((keys, ids, keys * np.uint64(7) + rng.integers(0, 2, len(keys)).astype(np.uint64), rng.random(len(keys)) < 0.05))
    return blocks


KINDS = {
    "presence": (R.Presence, lambda second, ids, flag, strings: [flag]), "first": (R.First, lambda second, ids, flag, strings: [second, ids]),
    "variety": (Variety, lambda second, ids, flag, strings: [second, flag]), "factors": (Factors, lambda second, ids, flag, strings: [ids, strings]),
}


def asked_by(spark, n, kind, bits=8):
    cls, columns = KINDS[kind]
    rows = []
    for b, (keys, ids, second, flag) in enumerate(random_questions(np.random.default_rng(n), n, bits, kind)):
        strings = (keys[:, None] >> np.arange(0, bits, dtype=np.uint64) & np.uint64(1)).astype(np.uint8)
        part = suffix_dedup.SharedSuffixes(keys)
        rows += [(k, b, 1, bytearray(p)) for k, p in R.asked_parts(cls, part, columns(second, ids, flag, strings), bits, R.ranges(n))]
        rows.append((b, b, R.CARRIED, bytearray(b"kept")))
    return cls, rows, spark.createDataFrame(rows, "bucket long, block int, phase int, payload binary").coalesce(1)


@pytest.fixture
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_two_questions_in_one_round():
    kind, rng = R.two(R.Presence, R.First), np.random.default_rng(1)
    blocks = random_questions(rng, 3, 8, "first")
    sides = [], []
    for k, (keys, ids, second, flag) in enumerate(blocks):
        sides[0].append(R.Presence.payload(keys, flag) if k != 1 else b"")
        sides[1].append(R.First.payload(keys, second, ids) if k != 2 else b"")
    got = [R.unpack_two(a) for a in kind([R.pack_two(*p) for p in zip(*sides)]).final()]
    assert [a for a, _ in got if a] == R.Presence([p for p in sides[0] if p]).final() and got[1][0] == b""
    assert [b for _, b in got if b] == R.First([p for p in sides[1] if p]).final() and got[2][1] == b""


@pytest.mark.parametrize("kind", list(KINDS))
def test_routers_answer_like_one_reducer(spark, monkeypatch, few_partitions, kind):
    monkeypatch.setattr(R, "FANOUT", 2)
    cls, rows, asked = asked_by(spark, 5, kind)
    got = R.exchange(asked, cls, 1, 8, 5, R.ranges(5)).collect()
    assert sorted(bytes(r.payload) for r in got if r.phase == R.CARRIED) == [b"kept"] * 5
    payloads = [(r[1], r[0], bytes(r[3])) for r in rows if r[2] == 1]
    want = cls([p for _, _, p in payloads]).final()
    assert {(r.block, r.bucket): bytes(r.payload) for r in got if r.phase == 1} == {(b, k): a for (b, k, _), a in zip(payloads, want)}


def test_rows_of_a_round_are_linear(spark, monkeypatch, few_partitions):
    """At four numbers of blocks: no level has more rows than twice the fan-out times the blocks."""
    monkeypatch.setattr(R, "FANOUT", 2)
    for n, levels in ((2, 1), (4, 2), (7, 3), (12, 4)):
        cls, rows, asked = asked_by(spark, n, "first")
        watch = []
        R.exchange(asked, cls, 1, 8, n, R.ranges(n), watch)
        counts = [df.where("phase = 1").count() for df in watch]
        assert len(counts) == levels and counts[0] <= 2 * n and max(counts) <= 4 * n


def test_many_blocks_and_few_ranges(spark, monkeypatch, few_partitions):
    monkeypatch.setattr(R, "FANOUT", 3)
    rows = sample(3)[:40]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    size = sum(len((t or "").encode()) for _, t in rows) // 7
    got = suffix_dedup.dedup(docs, texts_too=True, block_bytes=size).collect()
    assert sorted(map(tuple, got)) == sorted(brute(rows, lambda t: [bytes([b]) for b in t.encode()], b"".join, 50))
    got = substring_dedup.dedup(docs, window=9, texts_too=True, block_bytes=size).collect()
    assert sorted(map(tuple, got)) == sorted(brute(rows, lambda t: t.encode().split(), b" ".join, 9))
