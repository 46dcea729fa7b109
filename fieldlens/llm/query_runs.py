"""op13: periodic runs of words."""

from __future__ import annotations

import zlib

from pyspark.sql import functions as F

from fieldlens.llm.periodic_runs import collapse
from fieldlens.llm.registry import query, table


def planted(doc_id: int | None, n: int) -> list[int] | None:
    """The contract's change of one text in ten: from word a on, words repeat with period p."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [*range(a), *(a + k % p for k in range(n - a))]


@query("op13_periodic_runs")
def periodic_runs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = collapse(docs, edit=("doc_id", planted))
    line = lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
