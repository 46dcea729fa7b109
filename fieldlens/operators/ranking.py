"""Ranks and running totals that never put a whole group into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldlens.session import cut_lineage


def running_total(
    df: DataFrame, by: list[str], order: list[Column], weight: Column, out: str, partitions: int | None = None
) -> DataFrame:
    """Sum of ``weight`` over the rows of the group up to and including this one.

    The rows are range-partitioned by (group, order), so one huge group is spread over many tasks; each
    range adds the totals of the ranges before it. ``order`` must be a total order within the group. The
    range numbers are fixed by a checkpoint, so a recomputed task cannot see other ranges.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut_lineage(
        df.withColumn("__w", weight.cast("long"))
        .repartitionByRange(n, *[F.col(c) for c in by], *order)
        .withColumn("__range", F.spark_partition_id())
    )
    totals = ranged.groupBy(*by, "__range").agg(F.sum("__w").alias("__t"))
    before = Window.partitionBy(*by).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("__before", F.coalesce(F.sum("__t").over(before), F.lit(0))).drop("__t")
    inside = Window.partitionBy(*by, "__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        ranged.withColumn("__in", F.sum("__w").over(inside))
        .join(totals, [*by, "__range"])
        .withColumn(out, F.col("__in") + F.col("__before"))
        .drop("__w", "__range", "__in", "__before")
    )


def rank_rows(df: DataFrame, by: list[str], order: list[Column], out: str = "rank") -> DataFrame:
    """``row_number() over (partition by .. order by ..)`` for groups of any size."""
    return running_total(df, by, order, F.lit(1), out)


def top_per_group(df: DataFrame, by: list[str], order: list[Column], k: int, out: str | None = None) -> DataFrame:
    """First ``k`` rows per group; the window group limit prunes each partition before the shuffle."""
    ranked = df.withColumn("__rn", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(
        F.col("__rn") <= k
    )
    return ranked.withColumnRenamed("__rn", out) if out else ranked.drop("__rn")


def latest_by(df: DataFrame, key: list[str], ts: str, tie: list[str] = ()) -> DataFrame:
    """Row with the greatest ``ts`` (then ``tie``) per key, by partial aggregation."""
    rest = [c for c in df.columns if c not in key]
    picked = F.max_by(F.struct(*rest), F.struct(ts, *tie)).alias("__row")
    grouped = df.groupBy(*key).agg(picked) if key else df.agg(picked)
    return grouped.select(*key, "__row.*")
