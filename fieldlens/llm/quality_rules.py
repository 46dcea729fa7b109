"""Quality rules: per-text counts and cross-document line frequency, in built-in functions only.

Lines are normalised (words in lower case, single spaces) and hashed. For every host the distinct texts
that hold a line are counted; a line that ``min_texts`` or more texts of the host hold is *common* and is
removed. A document that loses more than ``max_removed_pct`` per cent of its words this way is depleted and
rejected, as is one that fails the base limits.

Two points of the definition:

* exact copies of a text count once, so a copied document does not turn its own lines into boilerplate;
* every line is counted, whatever its length; a very long text is split within one row, so a task needs memory for its longest text.

Defined cases: a null text has no words and no lines; a null host is a host of its own; repeated rows give
repeated result rows; an empty table gives an empty result; other columns of the input are not read, and
those with the names of result columns are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlens.llm.tables import stored, without

# Separators and symbols of the contract.
SPACE = "[\\x20\\x09-\\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8

RESULT = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "removed_words", "base_failed", "kept"]
MIN_TEXTS = 20
MAX_REMOVED_PCT = 70
HOT_SHARE = 2000


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE, -1), "")


def _normal(line: Column) -> Column:
    return F.lower(F.array_join(words_of(line), " "))


def base_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words to each row."""
    kept = F.coalesce(F.col(text), F.lit(""))
    bare = kept
    for s in SYMBOLS:
        bare = F.replace(bare, F.lit(s), F.lit(""))
    lines = F.filter(F.split(kept, "\n", -1), lambda x: F.length(F.btrim(x, F.lit(SPACE_CHARS))) > 0)
    counted = (
        docs.withColumns({"__words": words_of(F.col(text)), "__lines": lines})
        .withColumns({
            "n_words": F.size("__words").cast("long"),
            "word_chars": F.length(F.array_join("__words", "")).cast("long"),
            "n_symbols": (F.octet_length(kept) - F.octet_length(bare)).cast("long"),
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
            "__hashes": F.transform("__words", lambda w: F.xxhash64(w)),
        })
        .drop("__words", "__lines")
    )
    windows = F.when(
        F.col("n_words") >= WINDOW,
        F.transform(
            F.sequence(F.lit(1), F.size("__hashes") - (WINDOW - 1)),
            lambda i: F.xxhash64(F.slice("__hashes", i, WINDOW)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    counted = counted.withColumn("__windows", windows).drop("__hashes")
    # Sorting brings equal windows together; it only runs where some window occurs twice.
    ordered = F.when(
        F.size("__windows") > F.size(F.array_distinct("__windows")),
        F.sort_array(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    )
    counted = counted.withColumn("__ordered", ordered).drop("__windows")
    found = F.transform(
        "__ordered",
        lambda x, k: F.when(
            (F.get("__ordered", k - 1)["h"] == x["h"]) | (F.get("__ordered", k + 1)["h"] == x["h"]), x["i"]
        ),
    )
    places = F.sort_array(F.filter(found, lambda p: p.isNotNull()))
    covered = F.aggregate(
        places,
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
        lambda a, p: F.struct(
            (a["n"] + p + WINDOW - F.greatest(p.cast("long"), a["end"])).alias("n"),
            (p + WINDOW).cast("long").alias("end"),
        ),
        lambda a: a["n"],
    )
    return counted.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("__ordered")


def _text_key(docs: DataFrame, text: str, host: str) -> DataFrame:
    return docs.withColumns({
        "__host": F.coalesce(F.col(host).cast("string"), F.lit("\x00")),
        "__text": F.xxhash64(text),
        "__size": F.octet_length(F.coalesce(F.col(text), F.lit(""))),
    })


def common_lines(
    docs: DataFrame, text: str = "text", host: str = "source", min_texts: int = MIN_TEXTS,
) -> DataFrame:
    """Per distinct text of a host: number of words in common lines and the hashes of those lines.

    Texts are split and hashed once; what a text holds of each line is written and read by the count and the join. Counts are pre-aggregated before each shuffle. A line with more than one in ``HOT_SHARE`` of all holdings of
    common lines is hot; there are fewer than ``HOT_SHARE`` of them whatever the input, so they are broadcast, and no
    line of the shuffled join is a large group.
    """
    worded = F.filter(
        F.transform(
            F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1),
            lambda x: F.struct(F.xxhash64(_normal(x)).alias("line"), F.size(words_of(x)).alias("words")),
        ),
        lambda x: x["words"] > 0,
    )
    key = ["__host", "__text", "__size"]
    lines = _text_key(docs, text, host).select(*key, F.posexplode(worded).alias("at", "x"))
    held = lines.select(*key, "at", F.col("x.line").alias("line"), F.col("x.words").alias("words")).distinct()
    held = stored(held.groupBy(*key, "line").agg(F.sum("words").alias("words")), "held_lines")
    counts = held.groupBy("__host", "line").agg(F.count("*").alias("n_texts")).where(F.col("n_texts") >= min_texts)
    total = counts.agg(F.sum("n_texts")).scalar()
    counts = counts.withColumn("hot", F.col("n_texts") * HOT_SHARE > total)
    hot = F.broadcast(counts.where("hot").select("__host", "line", "hot"))
    cold = counts.where(~F.col("hot")).select("__host", F.col("line").alias("__probe"), F.lit(True).alias("cold"))
    # Rows of hot lines are dealt out by their text in the second join; what they meet there does not matter.
    probe = F.when(F.col("hot"), F.col("__text")).otherwise(F.col("line"))
    return (
        held.join(hot, ["__host", "line"], "left")
        .withColumn("__probe", probe)
        .join(cold, ["__host", "__probe"], "left")
        .where(F.coalesce("hot", "cold"))
        .groupBy(*key)
        .agg(F.sum("words").alias("removed_words"), F.collect_list("line").alias("__common"))
    )


def judge(
    docs: DataFrame, text: str = "text", host: str = "source", min_texts: int = MIN_TEXTS,
    max_removed_pct: int = MAX_REMOVED_PCT,
) -> DataFrame:
    """The counts, ``removed_words``, ``base_failed`` and ``kept`` of every row, with the input's columns but the text."""
    docs = without(docs, RESULT)
    removed = common_lines(docs, text, host, min_texts).drop("__common")
    counted = base_counts(_text_key(docs, text, host), text).drop(text)
    n = F.col("n_words")
    return (
        counted.join(removed, ["__host", "__text", "__size"], "left")
        .drop("__host", "__text", "__size")
        .withColumns({
            "removed_words": F.coalesce("removed_words", F.lit(0)).cast("long"),
            "base_failed": (n < 20) | (100 * F.col("n_repeat_words") > 30 * n),
        })
        .withColumn("kept", ~F.col("base_failed") & (100 * F.col("removed_words") <= max_removed_pct * n))
    )


def clean(
    docs: DataFrame, text: str = "text", host: str = "source", min_texts: int = MIN_TEXTS,
    max_removed_pct: int = MAX_REMOVED_PCT,
) -> DataFrame:
    """The kept rows with all their columns; common lines are gone from the text."""
    removed = common_lines(docs, text, host, min_texts)
    # Input columns with the names of the counts travel under other names meanwhile.
    columns = docs.columns
    moved = {c: f"__in_{c}" for c in columns if c in RESULT}
    counted = base_counts(_text_key(docs.withColumnsRenamed(moved), text, host), text)
    # The row number keeps the filter above the counts: pushed below, it would compute them again inside its condition.
    counted = counted.withColumn("__row", F.monotonically_increasing_id())
    n = F.col("n_words")
    failed = (n < 20) | (100 * F.col("n_repeat_words") > 30 * n)
    lines = F.filter(
        F.split(F.col(text), "\n", -1), lambda x: ~F.array_contains(F.col("__common"), F.xxhash64(_normal(x)))
    )
    return (
        counted.where(~failed & (F.col("__row") >= 0))
        .join(removed, ["__host", "__text", "__size"], "left")
        .where(100 * F.coalesce("removed_words", F.lit(0)) <= max_removed_pct * n)
        .withColumn(text, F.when(F.col("__common").isNull(), F.col(text)).otherwise(F.array_join(lines, "\n")))
        .select(*[F.col(moved.get(c, c)).alias(c) for c in columns])
    )
