"""Folds and bounded training samples of labelled documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_PER_CLASS = 4000


def fold(id_col: str, folds: int) -> Column:
    return (F.crc32(F.col(id_col).cast("string").cast("binary")) % folds).cast("int")


def training_sample(
    docs: DataFrame, labels: DataFrame, label: str, train: Column, max_per_class: int = MAX_PER_CLASS,
    id_col: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Texts of at most ``max_per_class`` labelled rows per class, taken in the order of a hash of their ids.

    Rows without a label are not used; a document labelled twice counts as its larger label. The chosen ids are
    few enough to be broadcast, so the texts are read by one scan. Rows that share an id count one by one, with ties
    in the order of a hash of their texts, so the number of rows is bounded whatever the ids; their lengths are not.
    """
    known = labels.where(F.col(label).isNotNull()).groupBy(id_col).agg(F.max(label).cast("int").alias("y")).where(train)
    order = [F.xxhash64(id_col), F.col(id_col)]
    picked = [known.where(F.col("y") == y).orderBy(*order).limit(max_per_class) for y in (0, 1)]
    chosen = reduce(DataFrame.unionByName, picked)
    rows = docs.select(id_col, text).join(F.broadcast(chosen), id_col)
    # Every task keeps at most max_per_class rows of a class before they meet.
    place = F.row_number().over(Window.partitionBy("y").orderBy(*order, F.xxhash64(text)))
    return rows.withColumn("__place", place).where(F.col("__place") <= max_per_class).select("y", F.col(text).alias("text"))
