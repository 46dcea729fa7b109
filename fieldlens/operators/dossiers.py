"""Evidence documents: candidates, facts, statutes, the rule-based draft, rendering and audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlens.functions.scalars import confidence_class, corroborated, fixed
from fieldlens.operators import wording as T
from fieldlens.operators.ranking import top_per_group
from fieldlens.session import BROADCAST_LIMIT_BYTES, cut_lineage, spread_by


# Bytes reckoned for one key of the worklist when it is broadcast.
KEY_BYTES = 96


def candidates(flagged: DataFrame, detections: DataFrame, limit: int = 12) -> DataFrame:
    """Worklist: per detection the parcel with the largest overlap, then the first ``limit`` by confidence
    per (run_id, aoi). A null overlap sorts first, as a descending order does in the reference tables.

    The list is cut on the rows of ``flagged`` (with ``confidence``) that have a detection, before the columns
    of the detections come in; the second cut counts where a detection is held more than once.
    """
    key = ["run_id", "aoi", "detection_id"]
    best = top_per_group(spread_by(flagged, *key), key, [F.desc_nulls_first("overlap_area_m2"), F.asc("parcel_id")], 1)
    taken = {c.lower() for c in best.columns}
    extra = [c for c in detections.columns if c.lower() not in taken]
    order = [F.desc(F.coalesce("confidence", F.lit(0.0))), F.asc("detection_id")]
    known = best.join(detections.select(*key), key, "left_semi")
    first = cut_lineage(top_per_group(known, ["run_id", "aoi"], order, limit))
    wide = detections.select(*key, *extra)
    if first.count() * KEY_BYTES <= BROADCAST_LIMIT_BYTES:
        wide = wide.join(F.broadcast(first.select(*key)), key, "left_semi")
    return top_per_group(first.join(wide, key), ["run_id", "aoi"], order, limit, "worklist_pos")


def _text(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit("None"))


def _num(c: str, digits: int) -> Column:
    return fixed(F.coalesce(F.col(c), F.lit(0.0)), digits)


def query_text(county: str = "county", township: str = "township") -> Column:
    empty = F.lit("")
    return F.concat(
        F.lit(T.QUERY_HEAD), F.col(county), F.col(township), F.lit(" "), F.coalesce("sectname", empty),
        F.lit(T.QUERY_PLOT), F.coalesce("landcode", empty), F.lit(T.QUERY_TAIL),
    )


def facts_block(radius_m: float) -> Column:
    near = corroborated(F.col("distance_to_label_m"), radius_m)
    support = F.when(
        near,
        F.concat(
            F.lit(f"corroborated by {T.REPORT_SOURCE} report "), _text("matched_label_id"), F.lit(" at "),
            _num("distance_to_label_m", 0), F.lit(" m"),
        ),
    ).otherwise("none")
    return F.concat_ws(
        "\n",
        F.concat(F.lit("- AOI / region: "), F.col("display_name")),
        F.concat(F.lit("- Parcel (地號 landcode): "), _text("landcode"), F.lit("  Section (段): "), _text("sectname")),
        F.lit("- Parcel zoning: agricultural farmland (is_farmland=TRUE)"),
        F.concat(
            F.lit("- New-structure footprint area: "), _num("area_m2", 0), F.lit(" m² (overlap on farmland "),
            _num("overlap_area_m2", 0), F.lit(" m²)"),
        ),
        F.concat(
            F.lit("- Imagery dates: before "), _text("t0_date"), F.lit(" → after "), _text("t1_date"),
            F.lit(" (Sentinel-2 L2A)"),
        ),
        F.concat(
            F.lit("- Built-up index rise (ΔNDBI): "), _num("ndbi_delta", 3), F.lit("; vegetation drop (ΔNDVI): "),
            _num("ndvi_drop", 3),
        ),
        F.concat(F.lit("- Detector: "), _text("detector"), F.lit("; model confidence: "), _num("confidence", 2)),
        F.concat(F.lit("- Centroid (lat, lon): "), fixed(F.col("lat"), 5), F.lit(", "), fixed(F.col("lon"), 5)),
        F.concat(F.lit("- Ground-truth corroboration: "), support),
    )


def _article(c: Column) -> Column:
    return F.concat(c["law_title"], F.lit(" "), F.coalesce(c["article_no"], F.lit("")))


def statutes_block(citations: Column) -> Column:
    """Numbered excerpts; a fixed text when nothing was retrieved."""
    body = F.transform(
        citations,
        lambda c, i: F.concat(F.lit("["), (i + 1).cast("string"), F.lit("] "), _article(c), F.lit("\n"), c["content"]),
    )
    return F.when(F.size(citations) > 0, F.array_join(body, "\n\n")).otherwise(T.NO_STATUTES)


def template_dossier(citations: Column, radius_m: float) -> Column:
    """Rule-based draft as a struct."""
    evidence = F.array(
        F.concat(
            F.lit("New built structure of ~"), _num("area_m2", 0), F.lit(" m² appeared on agricultural parcel "),
            _text("landcode"), F.lit(" between "), _text("t0_date"), F.lit(" and "), _text("t1_date"),
            F.lit(" (Sentinel-2)."),
        ),
        F.concat(
            F.lit("Built-up index rose by "), _num("ndbi_delta", 3), F.lit(" while vegetation index fell by "),
            _num("ndvi_drop", 3), F.lit(", consistent with construction replacing crops."),
        ),
    )
    support = F.array(
        F.concat(
            F.lit(f"Corroborated by {T.REPORT_SOURCE} report "), _text("matched_label_id"), F.lit(" ~"),
            _num("distance_to_label_m", 0), F.lit(" m away."),
        )
    )
    near = corroborated(F.col("distance_to_label_m"), radius_m)
    return F.struct(
        F.concat(
            F.lit("A suspected new structure was detected on agricultural farmland parcel "), _text("landcode"),
            F.lit(" in "), F.col("county"), F.col("township"),
            F.lit(". This is a candidate violation pending field verification."),
        ).alias("summary"),
        F.lit(T.ZONING).alias("zoning_status"),
        F.when(near, F.concat(evidence, support)).otherwise(evidence).alias("evidence"),
        F.transform(
            F.slice(citations, 1, T.MAX_STATUTES),
            lambda c: F.struct(
                c["law_title"].alias("law_title"),
                F.coalesce(c["article_no"], F.lit("")).alias("article_no"),
                F.lit(T.WHY).alias("why"),
            ),
        ).alias("violated_statutes"),
        F.lit(T.ACTION).alias("recommended_action"),
        confidence_class(F.col("confidence")).alias("confidence_label"),
        F.lit(T.CAVEATS).alias("caveats"),
    )


def violated_law(d: Column) -> Column:
    return F.array_join(F.transform(d["violated_statutes"], lambda v: F.trim(_article(v))), "; ")


def render_markdown(d: Column, citations: Column, model: Column, generator: str = T.GENERATOR) -> Column:
    def line(*parts):
        return F.array(F.concat(*parts) if len(parts) > 1 else parts[0])

    blank = F.array(F.lit(""))
    statutes = F.transform(
        d["violated_statutes"], lambda v: F.concat(F.lit("- **"), v["law_title"], F.lit(" "), v["article_no"], F.lit("** — "), v["why"])
    )
    sources = F.transform(
        citations,
        lambda c, i: F.concat(
            F.lit("- ["), (i + 1).cast("string"), F.lit("] "), _article(c), F.lit(" (sim "),
            fixed(F.coalesce(c["similarity"], F.lit(0.0)), 2), F.lit(")"),
        ),
    )
    head = line(
        F.lit("# Enforcement Dossier — Parcel "), _text("landcode"), F.lit(" ("), F.col("county"), F.col("township"), F.lit(")")
    )
    note = line(
        F.lit(f"*Decision-support artifact generated by {generator} ("), model,
        F.lit("). Not a legal determination — for inspector review before filing.*"),
    )
    lines = F.concat(
        head, blank, note, blank,
        line(F.lit("## Summary")), line(d["summary"]), blank,
        line(F.lit("**Zoning status:** "), d["zoning_status"]),
        line(F.lit("**Confidence:** "), d["confidence_label"]), blank,
        line(F.lit("## Evidence")), F.transform(d["evidence"], lambda e: F.concat(F.lit("- "), e)), blank,
        line(F.lit("## Statutes implicated")), statutes, blank,
        line(F.lit("## Recommended action")), line(d["recommended_action"]), blank,
        line(F.lit("## Caveats")), line(d["caveats"]), blank,
        line(F.lit("## Retrieved statute excerpts (RAG sources)")), sources,
    )
    return F.array_join(lines, "\n")


def payload_json(facts: list[str], d: Column, citations: Column, model: Column) -> Column:
    """Stored document: every fact column, the draft, the citations and the model name."""
    cites = F.transform(
        citations,
        lambda c: F.struct(c["law_title"].alias("law_title"), c["article_no"].alias("article_no"),
                           c["similarity"].alias("similarity")),
    )
    body = F.struct(
        F.struct(*facts).alias("facts"), d.alias("dossier"), cites.alias("citations"), model.alias("model")
    )
    return F.to_json(body, {"ignoreNullFields": "false"})


def build_dossiers(cands: DataFrame, radius_m: float, facts: list[str], model: str = T.TEMPLATE_MODEL) -> DataFrame:
    """Documents for candidates that carry ``citations`` and the area columns; one row each."""
    c = F.col
    drafted = cands.withColumn("draft", template_dossier(c("citations"), radius_m))
    name = F.lit(model)
    return drafted.select(
        "run_id", "aoi", "detection_id", "parcel_id", "landcode", name.alias("model"),
        F.coalesce("confidence", F.lit(0.0)).cast("float").alias("confidence"),
        violated_law(c("draft")).alias("violated_law"),
        c("draft.recommended_action").alias("recommended_action"),
        render_markdown(c("draft"), c("citations"), name).alias("dossier_md"),
        payload_json(facts, c("draft"), c("citations"), name).alias("dossier_json"),
    )


NUMBER = r"[0-9]+(?:\.[0-9]+)?"


def grounding_issues(cited: Column, retrieved: Column, evidence: Column, facts: Column, wording: Column) -> Column:
    """Checkable review rules: citations must be among the retrieved articles, numbers in the evidence
    must occur in the facts, and the wording must not state an offence as a fact."""
    not_retrieved = F.transform(
        F.array_except(F.transform(cited, lambda v: F.trim(_article(v))), F.transform(retrieved, lambda v: F.trim(_article(v)))),
        lambda s: F.concat(F.lit("citation not retrieved: "), s),
    )
    numbers = F.flatten(F.transform(evidence, lambda e: F.regexp_extract_all(e, F.lit(NUMBER), F.lit(0))))
    unknown = F.transform(
        F.array_except(numbers, F.regexp_extract_all(facts, F.lit(NUMBER), F.lit(0))),
        lambda n: F.concat(F.lit("number not in facts: "), n),
    )
    said = F.filter(F.array(*[F.lit(p) for p in T.OVER_CERTAIN]), lambda p: F.lower(wording).contains(p))
    certain = F.transform(said, lambda p: F.concat(F.lit("over-certain wording: "), p))
    return F.concat(not_retrieved, unknown, certain)


def feature_json(geometry: Column, properties: list) -> Column:
    """One GeoJSON Feature; null geometry and null properties are written out."""
    body = F.struct(
        F.lit("Feature").alias("type"), geometry.alias("geometry"), F.struct(*properties).alias("properties")
    )
    return F.to_json(body, {"ignoreNullFields": "false"})
