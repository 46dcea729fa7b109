"""All training-data queries."""

from fieldlens.llm import (  # noqa: F401
    query_classifiers, query_decontaminate, query_licenses, query_lines, query_repeats, query_rules, query_runs, query_search, query_simhash, query_tokens,
)
from fieldlens.llm.registry import ORACLES, QUERIES  # noqa: F401
