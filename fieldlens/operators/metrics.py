"""Precision / recall of flagged detections against known sites, and run summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlens.functions.scalars import corroborated, round_half_even

NOTE = "Known-site labels are crowd-reported and incomplete; treat as indicative."


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def precision_recall(
    runs: DataFrame, detections: DataFrame, flagged: DataFrame, labels: DataFrame, matched: DataFrame, radius_m: float
) -> DataFrame:
    """One row per (run_id, aoi) of ``runs``.

    Precision uses the distance of each flagged detection to its chosen label, recall the labels with any
    flagged detection within the radius (``matched``: run_id, aoi, n_labels_matched). F1 is built from the
    unrounded values; all three are rounded half to even.
    """
    key = ["run_id", "aoi"]
    # Once per detection first: two distinct counts would double the rows and shuffle them all.
    hit = F.coalesce(corroborated(F.col("distance_to_label_m"), radius_m), F.lit(False))
    each = flagged.where("detection_id IS NOT NULL").groupBy(*key, "detection_id").agg(F.max(hit).alias("hit"))
    f = each.groupBy(*key).agg(
        F.count("*").alias("n_flagged_detections"), F.count_if("hit").alias("n_true_positive_detections")
    )
    d = detections.groupBy(*key).agg(F.count("*").alias("n_detections"))
    lab = labels.groupBy("aoi").agg(F.count("*").alias("n_labels"))
    names = ["n_detections", "n_flagged_detections", "n_true_positive_detections", "n_labels", "n_labels_matched"]
    joined = (
        runs.select(*key)
        .distinct()
        .join(d, key, "left")
        .join(f, key, "left")
        .join(lab, "aoi", "left")
        .join(matched.select(*key, "n_labels_matched"), key, "left")
        .select(*key, *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in names])
    )
    scored = joined.withColumns(
        {
            "__p": _ratio(F.col("n_true_positive_detections"), F.col("n_flagged_detections")),
            "__r": _ratio(F.col("n_labels_matched"), F.col("n_labels")),
        }
    )
    f1 = _ratio(F.lit(2.0) * F.col("__p") * F.col("__r"), F.col("__p") + F.col("__r"))
    return scored.select(
        *key, F.lit(float(radius_m)).alias("match_radius_m"), *names,
        round_half_even(F.col("__p"), 4).alias("precision"), round_half_even(F.col("__r"), 4).alias("recall"), round_half_even(f1, 4).alias("f1"),
    )


def metrics_payload(metrics: DataFrame) -> DataFrame:
    """JSON payload rows as stored and exported."""
    body = F.struct(*[F.col(c) for c in metrics.columns], F.lit(NOTE).alias("note"))
    return metrics.select("run_id", "aoi", F.to_json(body).alias("payload"))


def run_summary(detections: DataFrame, flagged: DataFrame, dossiers: DataFrame) -> DataFrame:
    """Per run: newest detection time as text and row counts. Counts are grouped before joining."""
    d = detections.groupBy("run_id").agg(F.max("created_at").alias("latest"), F.count("*").alias("n_detections"))
    f = flagged.groupBy("run_id").agg(F.count("*").alias("n_flagged"))
    s = dossiers.groupBy("run_id").agg(F.count("*").alias("n_dossiers"))
    zero = F.lit(0).cast("long")
    return (
        d.join(f, "run_id", "left")
        .join(s, "run_id", "left")
        .select(
            "run_id",
            F.date_format("latest", "yyyy-MM-dd HH:mm:ss").alias("created_at"),
            "n_detections",
            F.coalesce("n_flagged", zero).alias("n_flagged"),
            F.coalesce("n_dossiers", zero).alias("n_dossiers"),
        )
        .orderBy(F.desc("created_at"), F.asc("run_id"))
    )


def summary_tiles(metrics: DataFrame) -> DataFrame:
    """Whole percentages and counts as the overview shows them."""
    return metrics.select(
        "run_id", "aoi", "n_detections", "n_flagged_detections", "n_labels",
        F.round(F.col("precision") * 100).cast("long").alias("precision_pct"),
        F.round(F.col("recall") * 100).cast("long").alias("recall_pct"),
        F.round("f1", 2).alias("f1"),
    )
