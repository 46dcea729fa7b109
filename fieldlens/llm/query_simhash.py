"""op8: SimHash near-duplicate classes of documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldlens.llm.registry import query, table
from fieldlens.llm.simhash import classes, with_fingerprints


@query("op8_simhash_near_dedup")
def simhash_near_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = classes(with_fingerprints(docs))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
