"""Document quality by random indexing and a small neural network.

Tokens are lower-cased words, marks for words in capitals, and runs of symbols. Every token has a sparse random
index vector that follows from its hash; the context vector of a token is the sum of the index vectors beside
it, over all documents. Tokens share ``rows`` hashed rows, so the vectors are one fixed table (4 MB) whatever the
vocabulary; tasks add up their own tables and the sums are merged by row block in a stream.

A document is the mean of its tokens' unit vectors, with the log of its length. A two-layer network in numpy is
fitted on a bounded sample of labelled documents, and a temperature found on a part of the sample that the network
has not seen turns its output into probabilities.

Defined cases: null and empty texts have the zero vector and get a score like any other; without labels of both
classes every text scores the share of the class seen (0 without labels); repeated rows are scored one by one;
an empty table gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.llm.labels import MAX_PER_CLASS, fold, training_sample
from fieldlens.session import ship_package

ROWS, SIZE, ENTRIES = 1 << 14, 64, 4
BLOCK_ROWS = 16
STEP = 1 << 18  # tokens handled at once
TOKEN = re.compile(r"[^\W_]+|[^\w\s]+|_+")
CAPITALS = zlib.crc32(b"\x00capitals")

_cache: dict[str, int] = {}


def _token_hash(token: str) -> int:
    if len(token) > 1 and token.isupper():
        return -1 - zlib.crc32(token.lower().encode())
    return zlib.crc32(token.lower().encode())


def token_rows(text: str | None) -> np.ndarray:
    """Table row of every token in order; a word in capitals is followed by the mark for capitals."""
    tokens = TOKEN.findall(text) if text else []
    if len(_cache) > 400_000:
        _cache.clear()
    h = list(map(_cache.get, tokens))
    if None in h:
        for t, x in zip(tokens, h):
            if x is None and t not in _cache:
                _cache[t] = _token_hash(t)
        h = [_cache[t] for t in tokens]
    out = np.array(h, dtype=np.int64)
    marked = out < 0
    if marked.any():
        out = np.where(marked, -1 - out, out)
        at = np.flatnonzero(marked)
        out = np.insert(out, at + 1, CAPITALS)
    return (out * 0x9E3779B1 & 0xFFFFFFFF) >> 18


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the non-zero entries of every row's index vector."""
    rng = np.random.default_rng(9)
    return rng.integers(0, SIZE, (ROWS, ENTRIES)), rng.choice([-1.0, 1.0], (ROWS, ENTRIES))


def add_contexts(table: np.ndarray, rows: np.ndarray, joined: np.ndarray, index) -> None:
    """Adds the index vectors of direct neighbours; ``joined[i]`` tells whether i and i + 1 are in one text."""
    places, signs = index
    left, right = rows[:-1][joined], rows[1:][joined]
    for own, other in ((left, right), (right, left)):
        cell = (own[:, None] * SIZE + places[other]).ravel()
        table += np.bincount(cell, signs[other].ravel(), ROWS * SIZE).astype(np.int64)


def context_table(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Unit context vectors per row over all documents."""
    ship_package(docs.sparkSession)

    def count(batches):
        table, index = np.zeros(ROWS * SIZE, np.int64), index_vectors()
        held, size = [], 0

        def flush():
            rows = np.concatenate(held)
            joined = np.ones(len(rows) - 1, bool)
            ends = np.cumsum([len(h) for h in held])[:-1] - 1
            joined[ends] = False
            add_contexts(table, rows, joined, index)

        for b in batches:
            for t in b.column(0):
                rows = token_rows(t.as_py())
                if len(rows):
                    held.append(rows)
                    size += len(rows)
                if size >= STEP:
                    flush()
                    held, size = [], 0
        if held:
            flush()
        blocks = table.reshape(ROWS // BLOCK_ROWS, -1)
        some = np.flatnonzero(blocks.any(axis=1))
        yield pa.record_batch([pa.array(some.astype(np.int32)), pa.array([blocks[k].astype("<i8").tobytes() for k in some], pa.binary())], names=["block", "sums"])

    def merge(batches):
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for k, s in zip(b.column(0).to_pylist(), b.column(1)):
                part = np.frombuffer(s.as_buffer(), "<i8")
                sums[k] = sums[k] + part if k in sums else part.copy()
        yield pa.record_batch([pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], names=["block", "sums"])

    kind = "block int, sums binary"
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    merged = docs.select(text).mapInArrow(count, kind).repartition(parts, "block").mapInArrow(merge, kind)
    out = np.zeros((ROWS // BLOCK_ROWS, BLOCK_ROWS * SIZE))
    for r in merged.toArrow().to_pylist():  # at most ROWS * SIZE numbers
        out[r["block"]] = np.frombuffer(r["sums"], "<i8")
    out = out.reshape(ROWS, SIZE)
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return (out / np.where(norm > 0, norm, 1)).astype(np.float32)


def pooled(text: str | None, table: np.ndarray) -> np.ndarray:
    """Mean unit vector and scaled log length; long texts are summed by counts per row."""
    rows = token_rows(text)
    if not len(rows):
        return np.zeros(SIZE + 1, np.float32)
    used, n = np.unique(rows, return_counts=True)
    return np.append(n.astype(np.float32) @ table[used] / len(rows), np.log1p(len(rows)) / 10).astype(np.float32)


@dataclass
class Network:
    mean: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]  # w1, b1, w2, b2
    temperature: float = 1.0
    constant: float | None = None

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return (np.tanh((x - self.mean) / self.scale @ w1 + b1) @ w2 + b2)[:, 0]

    def probability(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, hidden: int = 32, epochs: int = 60, seed: int = 1) -> Network:
    """Adam on log loss; every fifth row is kept for the temperature."""
    if not len(y) or y.min() == y.max():
        zero = np.zeros(SIZE + 1)
        return Network(zero, zero + 1, [], constant=float(y[0]) if len(y) else 0.0)
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    x, y = x[order].astype(float), y[order].astype(float)
    check = np.arange(len(y)) % 5 == 0
    if y[check].min() == y[check].max() or y[~check].min() == y[~check].max():
        check = np.zeros(len(y), bool)
    xt, yt = x[~check], y[~check]
    net = Network(xt.mean(0), xt.std(0) + 1e-3, [
        rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], hidden)), np.zeros(hidden), rng.normal(0, 1 / np.sqrt(hidden), (hidden, 1)), np.zeros(1)])
    m, v, step = [np.zeros_like(p) for p in net.layers], [np.zeros_like(p) for p in net.layers], 0
    z = (xt - net.mean) / net.scale
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(len(yt)), max(1, len(yt) // 64)):
            w1, b1, w2, b2 = net.layers
            h = np.tanh(z[part] @ w1 + b1)
            p = 1 / (1 + np.exp(-np.clip((h @ w2 + b2)[:, 0], -40, 40)))
            d = (p - yt[part])[:, None] / len(part)
            dh = d @ w2.T * (1 - h * h)
            grads = [z[part].T @ dh + 1e-4 * w1, dh.sum(0), h.T @ d + 1e-4 * w2, d.sum(0)]
            step += 1
            for k, g in enumerate(grads):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                net.layers[k] = net.layers[k] - 0.003 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    if check.any():
        logits, yc = net.logits(x[check]), y[check]
        heat = np.geomspace(0.25, 8, 60)
        loss = [np.logaddexp(0, -np.where(yc == 1, 1, -1) * logits / t).mean() for t in heat]
        net.temperature = float(heat[int(np.argmin(loss))])
    return net


def _pool(rows: DataFrame, table: np.ndarray, key: str, kind: str) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        for b in batches:
            got = [pooled(t.as_py(), shared.value) for t in b.column(1)]
            yield pa.record_batch([b.column(0), pa.array(got, pa.list_(pa.float32()))], names=[key, "x"])

    return rows.mapInArrow(run, f"{key} {kind}, x array<float>")


def score(docs: DataFrame, table: np.ndarray, net: Network, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The id and score of every row."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((table, net))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))

    def run(batches):
        vectors, net = shared.value
        for b in batches:
            x = np.array([pooled(t.as_py(), vectors) for t in b.column(1)]).reshape(-1, SIZE + 1)
            yield pa.record_batch([b.column(0), pa.array(net.probability(x).astype(float))], names=["doc_id", "score"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")


def classify(docs: DataFrame, labels: DataFrame, max_per_class: int = MAX_PER_CLASS) -> DataFrame:
    """doc_id, held_out, score and predicted; fold 1 of 3 is never learned from."""
    table = context_table(docs)
    sample = training_sample(docs, labels, "quality", fold("doc_id", 3) != 1, max_per_class)
    got = _pool(sample, table, "y", "int").toArrow()
    x = np.array(got.column("x").to_pylist(), dtype=float).reshape(-1, SIZE + 1)
    y = got.column("y").to_numpy().astype(float)
    order = np.lexsort((*x.T, y)) if len(y) else []  # the sample arrives in any order
    net = fit(x[order], y[order]) if len(y) else fit(x, y)
    found = score(docs, table, net)
    return found.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
