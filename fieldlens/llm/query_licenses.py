"""op4: license families of documents."""

from __future__ import annotations

from fieldlens.llm.license_scan import fit, sample_paragraphs, scan
from fieldlens.llm.registry import query, table


@query("op4_license_scan")
def license_families(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan(docs, fit(sample_paragraphs(docs)))
