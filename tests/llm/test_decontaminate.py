import random
import time

import pytest

from fieldlens.llm.decontaminate import WindowIndex, brute_force, clean, find


@pytest.mark.parametrize("block", [1_000_000, 7])
def test_equals_brute_force(spark, block):
    rng = random.Random(2)
    vocab = ["the", "Éa", "of", "X9", "a-b", "日本", "end."]
    items = [(k, " ".join(rng.choices(vocab, k=n))) for k, n in enumerate([20, 13, 15, 5, 1, 2, 40])]
    items += [(50, None), (51, ""), (52, " .,! "), (53, items[0][1]), (None, items[2][1]), (None, "lone words " + items[6][1])]
    items += [(60 + k, "a preamble that many items share and that is longer than one window of words " + str(k)) for k in range(30)]
    docs = []
    for d in range(60):
        t = " ".join(rng.choices(vocab + ["pad", "more", "stuff"], k=rng.choice([0, 3, 30, 300])))
        if d % 3 == 0:
            t += " " + rng.choice(items[:7])[1].upper() + " tail"
        docs.append((d, t, "x"))
    docs += [(60, None, "x"), (61, "", "x"), (1, docs[1][1], "x"), (62, items[6][1], "x"), (63, "x " + items[14][1], "x"), (64, "of " * 60, "x"), (None, items[1][1], "x")]
    items.append((90, "of " * 30))
    df = spark.createDataFrame(docs, "doc_id long, text string, n_words string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = find(df, bench, block_windows=block).select("doc_id", "__found.*").collect()
    want = brute_force([(d, t) for d, t, _ in docs], items)
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    kept = clean(df, bench, block_windows=block)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(w[0] for w in want if not w[5])


def test_equal_words_and_shared_preambles_are_quick():
    """20 000 equal words against an item of equal words, and one preamble in many items."""
    preamble = b"these rules hold for every task of this set and must be read before work begins now"
    items = [("same", [b"word"] * 20_000), ("mixed", [b"word", b"other"] * 3000)]
    items += [(f"p{k}", preamble.split() + [b"task%d" % k] * 5) for k in range(3000)]
    index = WindowIndex(items)
    index.order({})
    begin = time.time()
    mask, found = index.match([b"word"] * 20_000)
    assert mask.all() and found.tolist() == [0]
    mask, found = index.match([b"x"] * 5 + preamble.split() + [b"y"] * 5)
    assert len(found) == 3000 and mask.tolist() == [False] * 5 + [True] * 17 + [False] * 5
    assert index.match([b"word", b"other"] * 10_000)[0].all()
    assert time.time() - begin < 5


def test_names_that_clash(spark):
    df = spark.createDataFrame([(1, "one two", 5), (2, "three", 6)], "doc_id long, text string, __found int")
    bench = spark.createDataFrame([(None, "one two")], "item_id long, text string")
    kept = clean(df, bench)
    assert kept.columns == df.columns and kept.collect() == [(2, "three", 6)]
    assert find(df, bench).where("doc_id = 1").first()["__found"]["n_items"] == 1


def test_empty_sides(spark):
    df = spark.createDataFrame([(1, "one two")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    assert clean(df, bench.limit(0)).count() == 1
    assert find(df.limit(0), bench).count() == 0
    assert find(df, bench).first()["__found"]["contaminated"]
