"""op6 and op9: toxicity and quality of documents."""

from __future__ import annotations

from fieldlens.llm import quality_model, toxicity
from fieldlens.llm.registry import query, table


@query("op6_toxicity")
def toxic_documents(spark, sf_dir):
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op9_quality_classifier")
def quality_of_documents(spark, sf_dir):
    return quality_model.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
