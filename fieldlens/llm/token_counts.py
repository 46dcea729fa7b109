"""Token counts of whole texts.

Arrow batches go through :class:`fieldlens.llm.token_units.UnitEncoder`; only lengths come back.

Defined cases: a null text has 0 bytes and 0 tokens; an empty table gives an empty result; repeated rows are
counted one by one; long texts are cut at safe boundaries, so memory does not follow the longest text; other
columns of the input are not read.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.session import ship_package


def count_tokens(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text: str = "text", limit: int = 512) -> DataFrame:
    """Returns the id, n_bytes, n_tokens and over_limit of every row."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).cast("string").alias("text"))

    def count(batches):
        from fieldlens.llm.token_units import encoder

        enc = encoder(vocabulary)
        for b in batches:
            texts = b.column(1)
            n = [len(ids) // 4 for ids in enc.encode(t.as_py() for t in texts)]
            sizes = [len(t.as_buffer()) if t.is_valid else 0 for t in texts]
            yield pa.record_batch(
                [b.column(0), pa.array(sizes, pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
