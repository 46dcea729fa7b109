"""Line deduplication over documents, in built-in functions only.

The key of a line is the line without white space at its ends and with A-Z in lower case. A key of at least
``min_chars`` code points that at least ``min_docs`` documents hold is common: all its lines go, except those of the
document with the largest id that holds it.

1. Every long line becomes an entry: document, position and a 128-bit hash of its key; no text is shuffled for it.
2. Entries are range-partitioned by hash and salt (a part of the documents) and sorted within by document, largest
   first, and position. One pass over that order streams the first occurrences: the first entry of each document.
   They give the number of documents and the largest one per hash and salt, and, over a few salts, per hash.
3. Entries of common keys in other documents than the largest become one run-length bitmap per document; texts are
   read again only to apply it.

A key that very many documents hold is spread over the salts, and meets itself only as one row per salt. One document's
own lines stay together, as its text does.

Defined cases: a null or empty text is one empty line; rows with one id are one document for the counts, and each keeps or
loses its own lines; rows with a null id are one document, smaller than all others; repeated rows give repeated result rows; there are no ties, since a document holds a key or
not; a very long text is split within one row, so a task needs memory for its longest text; an empty table gives an empty result;
other columns pass by unread, and those with the names of result columns are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldlens.llm.tables import stored, without

# White space and limits of the contract.
SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_CHARS = 40
MIN_DOCS = 5

LEAST_SALTS = 256
RESULT = ["n_lines", "n_dropped", "keep_runs", "kept"]
ROW = ["__id", "__text", "__size"]
KEY = ["h1", "h2", "salt"]


def _lines(text: str) -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)


def _with_row_key(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """Equal rows share a key, and with it their bitmap."""
    return docs.withColumns({
        "__id": F.col(id_col), "__text": F.xxhash64(text), "__size": F.octet_length(F.coalesce(F.col(text), F.lit(""))),
    })


def line_entries(docs: DataFrame, id_col: str, text: str, min_chars: int) -> DataFrame:
    """Document row, position, key hashes and salt of every line that is long enough."""
    salts = max(LEAST_SALTS, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # No line of a shorter text is long enough; the split is skipped there.
    long_enough = docs.where(F.length(text) >= min_chars)
    lines = _with_row_key(long_enough, id_col, text).select(*ROW, F.posexplode(_lines(text)).alias("pos", "line"))
    key = F.btrim("line", F.lit(SPACE))
    lines = lines.where(F.length("line") >= min_chars).withColumn("key", key).where(F.length("key") >= min_chars)
    # ASCII lines take the fast lower(); in the others only A-Z change.
    low = F.when(F.length("key") == F.octet_length("key"), F.lower("key")).otherwise(F.translate("key", UPPER, LOWER))
    return lines.withColumn("key", low).select(
        *ROW, "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), F.col("key")).alias("h2"),
        F.pmod(F.xxhash64("__id"), F.lit(salts)).cast("int").alias("salt"),
    )


def common_groups(entries: DataFrame, min_docs: int) -> DataFrame:
    """Hash, salt and largest document of the keys that ``min_docs`` documents hold."""
    order = [F.col("__id").desc_nulls_last(), F.col("pos")]
    ranged = entries.select(*KEY, "__id", "pos").repartitionByRange(*KEY).sortWithinPartitions(*KEY, *order)
    stream = Window.partitionBy(*KEY).orderBy(*order)
    same = F.lag("__id").over(stream).eqNullSafe(F.col("__id"))
    begun = F.lag(F.lit(True)).over(stream).isNotNull()
    first = ranged.withColumn("first", ~(begun & same)).where("first")
    groups = first.groupBy(*KEY).agg(F.count("*").alias("n"), F.max("__id").alias("top"))
    over = Window.partitionBy("h1", "h2")
    whole = groups.select(*KEY, F.sum("n").over(over).alias("n_docs"), F.max("top").over(over).alias("top"))
    return whole.where(F.col("n_docs") >= min_docs).select(*KEY, "top")


def _runs(places: Column) -> Column:
    """Ascending positions as runs (begin, end)."""
    alone = lambda step: lambda x, k: F.when(
        F.coalesce(F.get(places, k + F.lit(step)) != x + F.lit(step), F.lit(True)), x)
    begin = F.filter(F.transform(places, alone(-1)), lambda x: x.isNotNull())
    end = F.filter(F.transform(places, alone(1)), lambda x: x.isNotNull())
    return F.zip_with(begin, end, lambda a, b: F.struct(a.alias("begin"), (b + 1).alias("end")))


def dropped_runs(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
) -> DataFrame:
    """Per document row that loses lines: runs of dropped positions."""
    entries = stored(line_entries(docs, id_col, text, min_chars), "line_entries")
    dropped = entries.join(common_groups(entries, min_docs), KEY).where(~F.col("__id").eqNullSafe(F.col("top")))
    # Equal rows have equal entries; one of each is enough.
    places = dropped.groupBy(*ROW).agg(F.sort_array(F.collect_set("pos")).alias("places"))
    return places.select(*ROW, F.size("places").cast("long").alias("__n"), _runs(F.col("places")).alias("__runs"))


def _matched(docs: DataFrame, runs: DataFrame) -> DataFrame:
    same = [docs["__id"].eqNullSafe(runs["__id"]), docs["__text"] == runs["__text"], docs["__size"] == runs["__size"]]
    return docs.join(runs, same[0] & same[1] & same[2], "left").drop(*[runs[c] for c in ROW])


def keep_bitmaps(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
) -> DataFrame:
    """Input columns but the text, ``n_lines``, ``n_dropped`` and ``keep_runs``: the bitmap of kept lines as run lengths,
    kept and dropped in turn, beginning with kept. Only hashes, ids and bitmaps are shuffled."""
    runs = dropped_runs(docs, id_col, text, min_chars, min_docs)
    rows = _with_row_key(without(docs, RESULT), id_col, text).withColumn("n_lines", F.size(_lines(text)).cast("long")).drop(text)
    n = F.col("n_lines").cast("int")
    some = F.col("__runs")
    turns = F.flatten(F.transform(some, lambda x, k: F.array(
        x["begin"] - F.coalesce(F.get(some, k - 1)["end"], F.lit(0)), x["end"] - x["begin"])))
    lengths = F.when(some.isNull(), F.array(n)).otherwise(F.concat(turns, F.array(n - F.element_at(some, -1)["end"])))
    return _matched(rows, runs).withColumns({
        "n_dropped": F.coalesce("__n", F.lit(0)).cast("long"), "keep_runs": lengths,
    }).drop(*ROW, "__n", "__runs")


def dedup(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
) -> DataFrame:
    """Input columns but the text, ``n_lines``, ``n_dropped`` and ``kept``: the lines left, joined by \\n."""
    runs = dropped_runs(docs, id_col, text, min_chars, min_docs)
    rows = _matched(_with_row_key(without(docs, RESULT), id_col, text), runs)
    some = F.col("__runs")
    rows = rows.withColumn("__lines", _lines(text)).withColumn("n_lines", F.size("__lines").cast("long"))
    parts = F.transform(some, lambda x, k: F.slice(
        F.col("__lines"), F.coalesce(F.get(some, k - 1)["end"], F.lit(0)) + 1,
        x["begin"] - F.coalesce(F.get(some, k - 1)["end"], F.lit(0))))
    tail = F.slice(F.col("__lines"), F.element_at(some, -1)["end"] + 1, F.size("__lines"))
    left = F.array_join(F.concat(F.flatten(parts), tail), "\n")
    return rows.withColumns({
        "n_dropped": F.coalesce("__n", F.lit(0)).cast("long"),
        "kept": F.when(some.isNull(), F.coalesce(F.col(text), F.lit(""))).otherwise(left),
    }).drop(*ROW, "__n", "__runs", "__lines", text)
