import random
import zlib

import numpy as np

from fieldlens.llm import quality_model, toxicity
from fieldlens.llm.toxicity import fit, terms_of

WORDS = [f"w{k}" for k in range(300)]


def labelled(spark, n=1200, seed=1):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        ws, toxic, good = rng.choices(WORDS, k=60), int(rng.random() < 0.3), int(rng.random() < 0.6)
        if toxic:
            ws[5] = ws[40] = rng.choice(["idiot", "moron", "scum"])
        if not good:
            ws = [w + rng.choice(["%%%", "$$$", "!!"]) for w in ws]
        docs.append((i, " ".join(ws), 0.5))
        labels.append((i, good, toxic))
    docs += [(5000, None, 0.5), (5001, "", 0.5), (5002, "idiot moron " * 20000, 0.5), (3, docs[3][1], 0.5)]
    labels += [(7, None, None), (9, labels[9][1], labels[9][2])]
    return (
        spark.createDataFrame(docs, "doc_id long, text string, score double"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), docs, {i: (q, t) for i, q, t in labels[:n]},
    )


def check(rows, docs, truth, which, folds, held):
    assert len(rows) == len(docs) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == held) for r in rows)
    own = [r for r in rows if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id][which] for r in own]) > 0.97


def test_toxicity(spark):
    docs, labels, raw, truth = labelled(spark)
    rows = toxicity.classify(docs, labels).collect()
    check(rows, raw, truth, 1, 5, 0)
    assert next(r for r in rows if r.doc_id == 5002).predicted == 1
    assert toxicity.classify(docs.limit(0), labels).count() == 0
    assert {r.score < 0.01 for r in toxicity.classify(docs, labels.limit(0)).collect()} == {True}


def test_quality(spark):
    docs, labels, raw, truth = labelled(spark)
    check(quality_model.classify(docs, labels).collect(), raw, truth, 0, 3, 1)
    assert quality_model.classify(docs.limit(0), labels).count() == 0
    assert {r.score for r in quality_model.classify(docs, labels.limit(0)).collect()} == {0.0}


def test_pairs_of_terms_are_learned():
    """Only insult and group word together are toxic: no sum of single weights can tell."""
    rng = random.Random(2)
    rows, y = [], []
    for _ in range(3000):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        rows.append(terms_of(" ".join(rng.choices(WORDS[:40], k=4) + ["insult"] * a + ["group"] * b + ["calm"] * (not a) + ["other"] * (not b))))
        y.append(float(a == b))
    y = np.array(y)
    m = fit(rows[:2400], y[:2400])
    assert np.mean((m.score(rows[2400:]) >= 0.5) == y[2400:]) > 0.95
