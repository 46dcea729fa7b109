import corpus_pipeline
from fieldlens.llm.decontaminate import brute_force
from fieldlens.llm.quality_rules import judge
from fieldlens.llm.tables import stored

from .test_repeats import brute
from .test_simhash import brute_fingerprint, components


def test_stages_against_plain_definitions(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("doc_id < 120")
    columns, seen = docs.columns, {}
    verdict = {r.doc_id: r.kept for r in judge(docs.select("doc_id", "source", "text")).collect()}
    frame = docs
    for name, stage in corpus_pipeline.STAGES:
        frame = stored(stage(spark, frame, sf), name)
        seen[name] = frame.collect()
        if name != "packing":
            assert frame.columns == columns
            assert all(r.n_chars == len(r.text) for r in seen[name])
    texts = {k: {r.doc_id: r.text for r in v} for k, v in seen.items() if k != "packing"}
    assert set(texts["quality_rules"]) == {i for i, k in verdict.items() if k}
    low = components([(i, brute_fingerprint(t)) for i, t in texts["quality_rules"].items()])
    assert texts["simhash_near_dedup"] == {i: texts["quality_rules"][i] for i in set(low.values())}
    cut = brute(sorted(texts["simhash_near_dedup"].items()), lambda t: [bytes([b]) for b in t.encode()], b"".join, 50)
    assert texts["suffix_dedup"] == {r[0]: r[5] for r in cut}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    dirty = {r[0] for r in brute_force(list(texts["suffix_dedup"].items()), items) if r[5]}
    assert texts["decontamination"] == {i: t for i, t in texts["suffix_dedup"].items() if i not in dirty}
    assert {r.doc_id for r in seen["packing"]} == set(texts["decontamination"])


def test_empty_input(spark, sf):
    frame = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        frame = stored(stage(spark, frame, sf), name)
        assert frame.count() == 0
