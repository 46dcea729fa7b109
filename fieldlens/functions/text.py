"""Text chunking as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space.
SPACE_CLASS = r"[\t-\r\x1c-\x20\x85\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"^{SPACE_CLASS}+|{SPACE_CLASS}+$", "")


def chunk_body(title: Column, article_no: Column, text: Column) -> Column:
    return F.concat(title, F.lit(" "), F.coalesce(article_no, F.lit("")), F.lit("："), text)


def chunk_count(body: Column, size: int, overlap: int) -> Column:
    step = max(1, size - overlap)
    n = F.char_length(body)
    return F.when(n <= size, F.lit(1)).otherwise(F.ceil(n / F.lit(step))).cast("long")


def chunks(body: Column, size: int, overlap: int) -> Column:
    """Overlapping pieces of a stripped text; a tail inside its predecessor is kept."""
    step = max(1, size - overlap)
    n = F.char_length(body)
    cut = F.transform(F.sequence(F.lit(1), n, F.lit(step)), lambda at: F.substring(body, at, F.lit(size)))
    return F.when(n <= size, F.array(body)).otherwise(cut)
