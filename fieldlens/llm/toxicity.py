"""Toxicity by a factorization machine over hashed terms.

Terms of a text are its distinct lower-cased words and the first five characters of longer words, hashed to 32
bits. From a bounded sample of labelled texts (``max_per_class``) all terms that ``LEAST_TEXTS`` of its texts hold are kept
(``max_terms`` can keep only those that tell the classes apart best); the machine learns a weight and a short vector per term, so that pairs of terms (an insult with a group word, say) add what no
sum of single weights can. Fitting is a few seconds of numpy on the sample; scoring runs in Arrow batches with
the model (some hundred kilobytes) as a broadcast.

Defined cases: null and empty texts score the bias; very long texts count as their distinct terms; sample rows are put in the order of their
terms before the fit, so ties change nothing; without labels of both classes every text scores the share of
the class seen (0 without labels); repeated rows are scored one by one; an empty table gives an empty result; other
columns of the input are not read.
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

WORD = re.compile(r"[^\W_]+")
STEM = 5
LEAST_TEXTS = 5
FACTORS = 8


def terms_of(text: str | None) -> np.ndarray:
    """Sorted distinct term hashes."""
    words = set(WORD.findall(text.lower())) if text else set()
    words |= {"^" + w[:STEM] for w in words if len(w) > STEM}
    return np.unique(np.fromiter((zlib.crc32(w.encode()) for w in words), np.int64, len(words)))


@dataclass
class Machine:
    terms: np.ndarray  # ascending hashes
    bias: float
    weight: np.ndarray
    factor: np.ndarray

    def score(self, rows: list[np.ndarray]) -> np.ndarray:
        known = []
        for r in rows:
            at = np.minimum(np.searchsorted(self.terms, r), max(len(self.terms) - 1, 0))
            known.append(at[self.terms[at] == r] if len(self.terms) and len(r) else at[:0])
        return sigmoid(_logits(self, known)[0])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _logits(m: Machine, rows: list[np.ndarray]):
    """Logits, with the flat term list, the row of each entry and the factor sums for the gradient."""
    size = np.array([len(r) for r in rows], dtype=np.int64)
    flat = np.concatenate(rows) if size.sum() else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(rows)), size)
    linear = np.bincount(row, m.weight[flat], len(rows))
    v = m.factor[flat]
    sums = np.stack([np.bincount(row, v[:, f], len(rows)) for f in range(v.shape[1])], axis=1)
    squares = np.bincount(row, (v * v).sum(1), len(rows))
    return m.bias + linear + 0.5 * ((sums * sums).sum(1) - squares), flat, row, sums


def fit(rows: list[np.ndarray], y: np.ndarray, max_terms: int | None = None, factors: int = FACTORS, epochs: int = 40, seed: int = 6) -> Machine:
    """AdaGrad on balanced log loss with weight decay, from sorted term hashes and 0/1 labels."""
    none = Machine(np.zeros(0, np.int64), -40.0, np.zeros(0), np.zeros((0, factors)))
    if not len(y):
        return none
    share = float(y.mean())
    if share in (0.0, 1.0):
        none.bias = 40.0 if share else -40.0
        return none
    flat = np.concatenate(rows)
    label = np.repeat(y, [len(r) for r in rows])
    terms, at = np.unique(flat, return_inverse=True)
    held = np.bincount(at, minlength=len(terms))
    toxic = np.bincount(at, label, minlength=len(terms))
    expected = held * share
    z = (toxic - expected) / np.sqrt(expected * (1 - share) + 1)
    enough = np.flatnonzero(held >= LEAST_TEXTS)
    best = np.sort(enough[np.argsort(-np.abs(z[enough]), kind="stable")[:max_terms]])
    terms = terms[best]
    if not len(terms):
        none.bias = float(np.log(share / (1 - share)))
        return none
    known = []
    for r in rows:
        k = np.minimum(np.searchsorted(terms, r), len(terms) - 1)
        known.append(k[terms[k] == r] if len(r) else k[:0])
    rng = np.random.default_rng(seed)
    m = Machine(terms, 0.0, np.zeros(len(terms)), rng.normal(0, 0.02, (len(terms), factors)))
    cost = np.where(y == 1, 0.5 / share, 0.5 / (1 - share))
    gw, gv, gb, rate, decay = np.full(len(terms), 1e-6), np.full(m.factor.shape, 1e-6), 1e-6, 0.1, 1e-4
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(len(y)), max(1, len(y) // 256)):
            logits, f, row, sums = _logits(m, [known[k] for k in part])
            err = (sigmoid(logits) - y[part]) * cost[part] / len(part)
            d = np.bincount(f, err[row], len(terms)) + decay * m.weight
            inner = (sums[row] - m.factor[f]) * err[row, None]
            dv = np.stack([np.bincount(f, inner[:, k], len(terms)) for k in range(factors)], axis=1) + decay * m.factor
            gb += err.sum() ** 2
            gw += d * d
            gv += dv * dv
            m.bias -= rate * err.sum() / np.sqrt(gb)
            m.weight -= rate * d / np.sqrt(gw)
            m.factor -= 0.3 * rate * dv / np.sqrt(gv)
    return m


def train(sample: DataFrame, max_terms: int | None = None) -> Machine:
    """Machine from a bounded sample (y, text)."""
    ship_package(sample.sparkSession)

    def hashed(batches):
        for b in batches:
            yield pa.record_batch(
                [b.column(0), pa.array([terms_of(t) for t in b.column(1).to_pylist()], pa.list_(pa.int64()))], names=["y", "terms"]
            )

    got = sample.select("y", "text").mapInArrow(hashed, "y int, terms array<bigint>").toArrow()
    rows = [np.array(t, dtype=np.int64) for t in got.column("terms").to_pylist()]
    y = got.column("y").to_numpy().astype(float)
    # Any order that depends on nothing but the rows: the sample arrives in any order.
    keys = [(zlib.crc32(r.tobytes()), r.tobytes(), float(v)) for r, v in zip(rows, y)]
    order = sorted(range(len(rows)), key=keys.__getitem__)
    return fit([rows[k] for k in order], y[order] if order else y, max_terms)


def score(docs: DataFrame, model: Machine, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The id and score of every row."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))

    def run(batches):
        for b in batches:
            out = [np.zeros(0)]
            for at in range(0, b.num_rows, 512):
                out.append(shared.value.score([terms_of(t.as_py()) for t in b.column(1).slice(at, 512)]))
            yield pa.record_batch([b.column(0), pa.array(np.concatenate(out))], names=["doc_id", "score"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")


def classify(docs: DataFrame, labels: DataFrame, max_per_class: int = MAX_PER_CLASS) -> DataFrame:
    """doc_id, held_out, score and predicted; fold 0 of 5 is never learned from."""
    sample = training_sample(docs, labels, "toxic", fold("doc_id", 5) != 0, max_per_class)
    found = score(docs, train(sample))
    return found.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
