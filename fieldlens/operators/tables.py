"""Keyed writes: partial upsert, replace per partition, cascades, existence and counts."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.session import spread_by


def collapse_batch(batch: DataFrame, key: list[str], update_cols: list[str], pos: str) -> DataFrame:
    """One row per key: inserted columns from its first occurrence, updated columns from its last."""
    rest = [c for c in batch.columns if c not in (*key, pos, *update_cols)]
    first, last = F.struct(F.lit(0), *rest), F.struct(F.lit(0), *update_cols)
    folded = batch.groupBy(*key).agg(
        F.min_by(first, F.col(pos)).alias("__first"), F.max_by(last, F.col(pos)).alias("__last")
    )
    return folded.select(
        *key, *[F.col(f"__first.{c}").alias(c) for c in rest], *[F.col(f"__last.{c}").alias(c) for c in update_cols]
    )


def merge_upsert(target: DataFrame, batch: DataFrame, key: list[str], update_cols: list[str], pos: str) -> DataFrame:
    """Insert new keys; on known keys change ``update_cols`` only, keeping the first value of the rest."""
    src = collapse_batch(batch, key, update_cols, pos)
    t = target.withColumn("__in_t", F.lit(True)).alias("t")
    s = src.withColumn("__in_s", F.lit(True)).alias("s")
    cond = F.lit(True)
    for k in key:
        cond = cond & (F.col(f"t.{k}") == F.col(f"s.{k}"))
    joined = t.join(s, cond, "full")

    def pick(c: str) -> Column:
        if c in key:
            return F.coalesce(f"t.{c}", f"s.{c}")
        if c not in src.columns:
            return F.col(f"t.{c}")
        new, old = F.col(f"s.{c}"), F.col(f"t.{c}")
        source_wins = F.col("s.__in_s").isNotNull() if c in update_cols else F.col("t.__in_t").isNull()
        return F.when(source_wins, new).otherwise(old)

    return joined.select(*[pick(c).alias(c) for c in target.columns])


def replace_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """Rewrite only the partitions present in ``df`` (replace per run, per code, per area and date)."""
    df.write.mode("overwrite").partitionBy(*by).option("partitionOverwriteMode", "dynamic").parquet(path)


def clear_partitions(spark: SparkSession, path: str, by: str, values: list[str]) -> None:
    """Remove the partitions of ``values``: a replace that brought no rows still drops the old ones."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for v in values:
        fs.delete(jvm.org.apache.hadoop.fs.Path(root, f"{by}={v}"), True)


def upsert_table(spark: SparkSession, path: str, batch: DataFrame, key: list[str], update_cols: list[str], pos: str,
                 by: list[str]) -> None:
    """Upsert a stored table partition by partition: only partitions the batch touches are read and rewritten."""
    from fieldlens.session import cut_lineage

    if not table_exists(spark, path):
        first = collapse_batch(batch, key, update_cols, pos)
        replace_partitions(first, path, by)
        return
    target = spark.read.parquet(path)
    touched = target.join(batch.select(*by).distinct(), by, "left_semi")
    merged = cut_lineage(merge_upsert(touched, batch, key, update_cols, pos))
    replace_partitions(merged, path, by)


def table_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Stored rows, or none where nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def has_rows(spark: SparkSession, path: str) -> bool:
    """Whether a partitioned table holds any data file (an empty one has no schema to read)."""
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(path, "*/*.parquet")
    found = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern)
    return found is not None and len(found) > 0


def row_count(spark: SparkSession, name: str, path: str | None = None) -> DataFrame:
    """``table_name, n`` of a table; 0 when it does not exist."""
    if path is not None and table_exists(spark, path):
        df = spark.read.parquet(path)
    elif path is None and spark.catalog.tableExists(name):
        df = spark.table(name)
    else:
        return spark.range(1).select(F.lit(name).alias("table_name"), F.lit(0).cast("long").alias("n"))
    return df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")


def cascade_delete(children: DataFrame, parents: DataFrame, keys: list[str]) -> DataFrame:
    """Children whose parent still exists."""
    return spread_by(children, *keys).join(parents.select(*keys), keys, "left_semi")


def null_missing_reference(children: DataFrame, parents: DataFrame, column: str) -> DataFrame:
    """Children with ``column`` set to null where the parent row is gone."""
    alive = parents.select(F.col(column).alias("__ref")).distinct()
    joined = spread_by(children, column).join(alive, F.col(column) == F.col("__ref"), "left")
    return joined.withColumn(column, F.when(F.col("__ref").isNotNull(), F.col(column))).drop("__ref").select(children.columns)
