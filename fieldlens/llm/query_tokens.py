"""op3 and op7: packing and token counts."""

from __future__ import annotations

import public_tokenizers

from fieldlens.llm.packing import pack, token_pieces
from fieldlens.llm.registry import query, table
from fieldlens.llm.token_counts import count_tokens

VOCABULARY = "byte_bpe_50k.json"


@query("op3_best_fit_packing")
def best_fit_packing(spark, sf_dir):
    return pack(token_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY)))


@query("op7_token_counts")
def token_counts(spark, sf_dir):
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
