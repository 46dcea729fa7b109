"""Text, vector and document queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldlens.functions import text as X
from fieldlens.functions import vectors as V
from fieldlens.operators import dossiers as DO
from fieldlens.operators import metrics as M
from fieldlens.operators import retrieval as RT
from fieldlens.operators import wording as T
from fieldlens.plans import inputs as I
from fieldlens.plans import oracle_inputs as O
from fieldlens.plans.catalogue_spatial import candidates, precision_recall
from fieldlens.plans.registry import ORACLES, query

# ------------------------------------------------------------------- texts


@query("chunk_text", f"""WITH {O.CHUNKS} SELECT pcode, law_title, article_no, row_number() OVER (PARTITION BY pcode ORDER BY article_pos, piece) - 1 AS chunk_index,
 length(content)::BIGINT AS n_chars, md5(content) AS digest FROM chunks""")
def chunk_text(spark, d):
    c = RT.chunk_articles(I.statutes(spark, d), I.CHUNK, I.OVERLAP)
    return c.select(
        "pcode", "law_title", "article_no", "chunk_index", F.char_length("content").cast("long").alias("n_chars"), F.md5("content").alias("digest")
    )


_TERMS = O.term_counts("documents", "doc_id")


@query("char_ngrams", f"WITH {_TERMS} SELECT doc_id, n::BIGINT AS n, sum(tf)::BIGINT AS n_grams, count(*) AS n_distinct FROM terms GROUP BY doc_id, n")
def char_ngrams(spark, d):
    t = RT.term_counts(I.texts(spark, d, "documents", "doc_id", "text"), "doc_id", "text")
    return t.groupBy("doc_id", F.char_length("term").cast("long").alias("n")).agg(F.sum("tf").alias("n_grams"), F.count("*").alias("n_distinct"))


_VOCAB = f"""{_TERMS}, vo AS (SELECT term, count(*) AS df, sum(tf)::BIGINT AS corpus_tf, ln((1 + (SELECT count(*) FROM documents)) / (1 + count(*))) + 1 AS idf
 FROM terms GROUP BY term ORDER BY corpus_tf DESC, term LIMIT {RT.MAX_FEATURES})"""


@query("tfidf_vocab", f"WITH {_VOCAB} SELECT term, df, corpus_tf, round(idf, 6) AS idf FROM vo")
def tfidf_vocab(spark, d):
    return RT.vocabulary(I.texts(spark, d, "documents", "text"), "text").select("term", "df", "corpus_tf", F.round("idf", 6).alias("idf"))


@query("tfidf_weights", f"""WITH {_VOCAB}, w AS (SELECT doc_id, term, tf * idf AS w FROM terms JOIN vo USING (term)),
n AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM w GROUP BY doc_id)
SELECT doc_id, count(*) AS n_terms, round(sum(w / norm), 6) AS total, round(max(w / norm), 6) AS heaviest, round(sum((w / norm) * (w / norm)), 6) AS length_sq
FROM w JOIN n USING (doc_id) GROUP BY doc_id""")
def tfidf_weights(spark, d):
    """Weights of all documents, folded per document."""
    docs = I.texts(spark, d, "documents", "doc_id", "text")
    w = RT.tfidf_weights(docs, "doc_id", "text", RT.fit_tfidf(docs, "text"))
    return w.groupBy("doc_id").agg(
        F.count("*").alias("n_terms"), F.round(F.sum("weight"), 6).alias("total"), F.round(F.max("weight"), 6).alias("heaviest"),
        F.round(F.sum(F.col("weight") * F.col("weight")), 6).alias("length_sq"),
    )


_ALL_TERMS = f"""{_TERMS}, vo AS (SELECT term, count(*) AS df, sum(tf)::BIGINT AS corpus_tf, ln((1 + (SELECT count(*) FROM documents)) / (1 + count(*))) + 1 AS idf
 FROM terms GROUP BY term)"""


@query("tfidf_vocab_full", f"WITH {_ALL_TERMS} SELECT term, df, corpus_tf, round(idf, 6) AS idf FROM vo")
def tfidf_vocab_full(spark, d):
    """The vocabulary without a limit."""
    vocab = RT.vocabulary(I.texts(spark, d, "documents", "text"), "text", None)
    return vocab.select("term", "df", "corpus_tf", F.round("idf", 6).alias("idf"))


@query("tfidf_weights_full", f"""WITH {_ALL_TERMS}, w AS (SELECT doc_id, term, tf * idf AS w FROM terms JOIN vo USING (term)),
n AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM w GROUP BY doc_id)
SELECT doc_id, count(*) AS n_terms, round(sum(w / norm), 6) AS total, round(max(w / norm), 6) AS heaviest, round(sum((w / norm) * (w / norm)), 6) AS length_sq
FROM w JOIN n USING (doc_id) GROUP BY doc_id""")
def tfidf_weights_full(spark, d):
    """Weights over the whole vocabulary, by joins."""
    docs = I.texts(spark, d, "documents", "doc_id", "text")
    w = RT.joined_weights(docs, "doc_id", "text", RT.vocabulary(docs, "text", None))
    return w.groupBy("doc_id").agg(
        F.count("*").alias("n_terms"), F.round(F.sum("weight"), 6).alias("total"), F.round(F.max("weight"), 6).alias("heaviest"),
        F.round(F.sum(F.col("weight") * F.col("weight")), 6).alias("length_sq"),
    )


def _chunk_items(spark, d):
    """Chunks with an id made of article and piece."""
    body = X.strip(X.chunk_body(F.col("law_title"), F.col("article_no"), F.col("text")))
    arts = I.statutes(spark, d).select("article_pos", body.alias("body"))
    pieces = arts.select("article_pos", F.posexplode(X.chunks(F.col("body"), I.CHUNK, I.OVERLAP)).alias("piece", "text"))
    return pieces.select((F.col("article_pos").cast("long") * (1 << 32) + F.col("piece")).alias("item_id"), "text")


_CHUNK_ITEMS = f"{O.CHUNKS}, items AS (SELECT article_pos::BIGINT * 4294967296 + piece AS item_id, content AS text FROM chunks)"


@query("rag_retrieve", f"""WITH {_CHUNK_ITEMS}, {O.term_counts('items', 'item_id')},
vo AS (SELECT term, count(*) AS df, sum(tf)::BIGINT AS corpus_tf, ln((1 + (SELECT count(*) FROM items)) / (1 + count(*))) + 1 AS idf
 FROM terms GROUP BY term ORDER BY corpus_tf DESC, term LIMIT {RT.MAX_FEATURES}),
{O.term_counts('benchmark', 'item_id').replace('wc AS', 'qwc AS').replace('FROM wc', 'FROM qwc').replace('gr AS', 'qgr AS').replace('FROM gr', 'FROM qgr').replace('terms AS', 'qterms AS')},
iw AS (SELECT item_id, term, tf * idf AS w FROM terms JOIN vo USING (term)), inorm AS (SELECT item_id, sqrt(sum(w * w)) AS n FROM iw GROUP BY item_id),
qw AS (SELECT item_id AS query_id, term, tf * idf AS w FROM qterms JOIN vo USING (term)), qnorm AS (SELECT query_id, sqrt(sum(w * w)) AS n FROM qw GROUP BY query_id),
dt AS (SELECT query_id, item_id, sum(qw.w * iw.w) AS s FROM qw JOIN iw USING (term) GROUP BY query_id, item_id),
sm AS (SELECT query_id, item_id, round(s / (qnorm.n * inorm.n), 12) AS similarity FROM dt JOIN qnorm USING (query_id) JOIN inorm USING (item_id))
SELECT query_id, item_id, round(similarity, 6) AS similarity, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, item_id) AS rank FROM sm QUALIFY rank <= {I.TOP_K}""")
def rag_retrieve(spark, d):
    """For every benchmark text the most similar chunks of all documents."""
    items = _chunk_items(spark, d)
    queries = I.table(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    model = RT.fit_tfidf(items, "text")
    top = RT.topk_tfidf(items, queries, I.TOP_K, model)
    return top.select("query_id", "item_id", F.round("similarity", 6).alias("similarity"), F.col("rank").cast("long").alias("rank"))


LSA_DIM = 64


@query("lsa_embed")
def lsa_embed(spark, d):
    docs = I.texts(spark, d, "documents", "doc_id", "text")
    model = RT.fit_lsa(docs, "text", LSA_DIM)
    return RT.encode(docs, "text", model).select("doc_id", "embedding")


@query("lsa_query")
def lsa_query(spark, d):
    """Benchmark texts against all documents in the fitted space."""
    docs = I.texts(spark, d, "documents", "doc_id", "text")
    model = RT.fit_lsa(docs, "text", LSA_DIM)
    items = RT.encode(docs, "text", model, "vector").select(F.col("doc_id").alias("item_id"), "vector")
    asked = I.table(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    queries = RT.encode(asked, "text", model, "vector").select("query_id", "vector")
    return RT.topk_cosine(items, queries, I.TOP_K)


# ----------------------------------------------------------------- vectors


@query("l2_pad", """WITH a AS (SELECT vec_id, list_concat(embedding::DOUBLE[], [0.0::DOUBLE, 0, 0, 0, 0, 0, 0, 0])[1:72] AS p, embedding[1:40]::DOUBLE[] AS c FROM embeddings),
n AS (SELECT *, sqrt(list_dot_product(p, p)) AS np, sqrt(list_dot_product(c, c)) AS nc FROM a)
SELECT vec_id, len(p)::BIGINT AS padded_dim, round(p[1] / np, 6) AS padded_first, round(p[72], 6) AS padded_last, len(c)::BIGINT AS cut_dim, round(c[1] / nc, 6) AS cut_first, round(c[40] / nc, 6) AS cut_last FROM n""")
def l2_pad(spark, d):
    e = I.table(spark, d, "embeddings").select("vec_id", V.l2_pad(F.col("embedding"), 72).alias("p"), V.l2_pad(F.col("embedding"), 40).alias("c"))
    c = F.col
    return e.select(
        "vec_id", F.size("p").cast("long").alias("padded_dim"), F.round(c("p")[0], 6).alias("padded_first"), F.round(c("p")[71], 6).alias("padded_last"),
        F.size("c").cast("long").alias("cut_dim"), F.round(c("c")[0], 6).alias("cut_first"), F.round(c("c")[39], 6).alias("cut_last"),
    )


def _topics(spark, d):
    """Nearest vectors to the mean vector of each label."""
    e = I.table(spark, d, "embeddings")
    parts = e.select("label", F.posexplode("embedding").alias("p", "v")).groupBy("label", "p").agg(F.avg(F.col("v").cast("double")).alias("m"))
    mean = parts.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("p", "m"))).alias("s"))
    queries = mean.select(F.col("label").cast("long").alias("query_id"), F.transform("s", lambda x: x["m"]).alias("vector"))
    items = e.select(F.col("vec_id").alias("item_id"), F.col("embedding").alias("vector"))
    return RT.topk_cosine(items, queries, I.TOP_K)


@query("vector_topk", f"WITH {O.TOPK} SELECT query_id::BIGINT AS query_id, item_id, round(similarity, 6) AS similarity, rank FROM topk")
def vector_topk(spark, d):
    return _topics(spark, d).select("query_id", "item_id", F.round("similarity", 6).alias("similarity"), F.col("rank").cast("long").alias("rank"))


# --------------------------------------------------------------- documents


def _citations(spark, d):
    """Citations per topic: the documents behind the nearest vectors, in rank order (at most top-k)."""
    docs = I.table(spark, d, "documents").select(F.col("doc_id").alias("item_id"), "source", "text")
    joined = _topics(spark, d).join(docs, "item_id")
    cite = F.struct(
        "rank", F.concat(F.lit("Law "), F.col("source")).alias("law_title"), F.concat(F.lit("Art. "), F.col("item_id").cast("string")).alias("article_no"),
        F.col("text").alias("content"), "similarity",
    )
    return joined.groupBy(F.col("query_id").alias("topic")).agg(F.sort_array(F.collect_list(cite)).alias("citations"))


def cited_candidates(spark, d):
    cands = candidates(spark, d).withColumn("topic", F.col("detection_id") % 10)
    joined = cands.join(_citations(spark, d), "topic", "left")
    none = F.slice(F.array(F.struct(F.lit(0).alias("rank"), F.lit("").alias("law_title"), F.lit("").alias("article_no"), F.lit("").alias("content"),
                                    F.lit(0.0).alias("similarity"))), 1, 0)
    return joined.withColumn("citations", F.coalesce("citations", none))


FACTS = [
    "detection_id", "parcel_id", "landcode", "sectname", "overlap_area_m2", "confidence", "matched_label_id", "distance_to_label_m", "lat", "lon",
    "ndbi_delta", "ndvi_drop", "area_m2", "t0_date", "t1_date", "detector",
]


@query("query_text", f"""WITH {O.CANDS} SELECT run_id, detection_id, '{T.QUERY_HEAD}County ' || aoi || ' ' || coalesce(sectname, '') || '{T.QUERY_PLOT}' || coalesce(landcode, '') || '{T.QUERY_TAIL}' AS query_text FROM ca""")
def query_text(spark, d):
    return candidates(spark, d).select("run_id", "detection_id", DO.query_text().alias("query_text"))


_NEAR80 = "distance_to_label_m IS NOT NULL AND distance_to_label_m <= 80"
_FACTS_SQL = f"""'- AOI / region: Area ' || aoi || chr(10) || '- Parcel (地號 landcode): ' || landcode || '  Section (段): ' || sectname || chr(10)
 || '- Parcel zoning: agricultural farmland (is_farmland=TRUE)' || chr(10)
 || '- New-structure footprint area: ' || printf('%.0f', area_m2) || ' m² (overlap on farmland ' || printf('%.0f', overlap_area_m2) || ' m²)' || chr(10)
 || '- Imagery dates: before ' || t0_date || ' → after ' || t1_date || ' (Sentinel-2 L2A)' || chr(10)
 || '- Built-up index rise (ΔNDBI): ' || printf('%.3f', ndbi_delta) || '; vegetation drop (ΔNDVI): ' || printf('%.3f', ndvi_drop) || chr(10)
 || '- Detector: spectral; model confidence: ' || printf('%.2f', confidence) || chr(10)
 || '- Centroid (lat, lon): ' || printf('%.5f', lat) || ', ' || printf('%.5f', lon) || chr(10)
 || '- Ground-truth corroboration: ' || CASE WHEN {_NEAR80} THEN 'corroborated by {T.REPORT_SOURCE} report ' || matched_label_id || ' at ' || printf('%.0f', distance_to_label_m) || ' m' ELSE 'none' END"""


@query("facts_block", f"WITH {O.CANDS} SELECT run_id, detection_id, {_FACTS_SQL} AS facts FROM ca")
def facts_block(spark, d):
    return candidates(spark, d).select("run_id", "detection_id", DO.facts_block(I.MATCH_RADIUS_M).alias("facts"))


_CITED = f"""{O.CANDS}, {O.CITES},
cs AS (SELECT topic, string_agg('[' || rank || '] ' || law_title || ' ' || article_no || chr(10) || content, chr(10) || chr(10) ORDER BY rank) AS block,
  string_agg(law_title || ' ' || article_no, '; ' ORDER BY rank) FILTER (rank <= 3) AS violated,
  string_agg('- **' || law_title || ' ' || article_no || '** — {T.WHY}', chr(10) ORDER BY rank) FILTER (rank <= 3) AS stat_md,
  string_agg('- [' || rank || '] ' || law_title || ' ' || article_no || ' (sim ' || printf('%.2f', similarity) || ')', chr(10) ORDER BY rank) AS src_md
  FROM (SELECT topic, row_number() OVER (PARTITION BY topic ORDER BY rank) AS rank, law_title, article_no, content, similarity FROM ci) GROUP BY topic),
cc AS (SELECT ca.*, cs.* EXCLUDE (topic) FROM ca LEFT JOIN cs ON cs.topic = ca.detection_id % 10)"""


@query("statutes_block", f"WITH {_CITED} SELECT run_id, detection_id, coalesce(block, '{T.NO_STATUTES}') AS statutes FROM cc")
def statutes_block(spark, d):
    return cited_candidates(spark, d).select("run_id", "detection_id", DO.statutes_block(F.col("citations")).alias("statutes"))


@query("violated_law", f"WITH {_CITED} SELECT run_id, detection_id, coalesce(violated, '') AS violated_law FROM cc")
def violated_law(spark, d):
    draft = cited_candidates(spark, d).withColumn("draft", DO.template_dossier(F.col("citations"), I.MATCH_RADIUS_M))
    return draft.select("run_id", "detection_id", DO.violated_law(F.col("draft")).alias("violated_law"))


_EV1 = "'New built structure of ~' || printf('%.0f', area_m2) || ' m² appeared on agricultural parcel ' || landcode || ' between ' || t0_date || ' and ' || t1_date || ' (Sentinel-2).'"
_EV2 = "'Built-up index rose by ' || printf('%.3f', ndbi_delta) || ' while vegetation index fell by ' || printf('%.3f', ndvi_drop) || ', consistent with construction replacing crops.'"
_EV3 = f"'Corroborated by {T.REPORT_SOURCE} report ' || matched_label_id || ' ~' || printf('%.0f', distance_to_label_m) || ' m away.'"
_SUMMARY = "'A suspected new structure was detected on agricultural farmland parcel ' || landcode || ' in County ' || aoi || '. This is a candidate violation pending field verification.'"
_LABEL = "CASE WHEN confidence >= 0.66 THEN 'high' WHEN confidence >= 0.4 THEN 'medium' ELSE 'low' END"


@query("template_dossier", f"""WITH {_CITED} SELECT run_id, detection_id, {_SUMMARY} AS summary, '{T.ZONING}' AS zoning_status,
 {_EV1} || ' | ' || {_EV2} || CASE WHEN {_NEAR80} THEN ' | ' || {_EV3} ELSE '' END AS evidence, least(3, CASE WHEN violated IS NULL THEN 0 ELSE length(violated) - length(replace(violated, ';', '')) + 1 END)::BIGINT AS n_statutes,
 '{T.ACTION}' AS recommended_action, {_LABEL} AS confidence_label, '{T.CAVEATS}' AS caveats FROM cc""")
def template_dossier(spark, d):
    draft = cited_candidates(spark, d).withColumn("draft", DO.template_dossier(F.col("citations"), I.MATCH_RADIUS_M))
    return draft.select(
        "run_id", "detection_id", "draft.summary", "draft.zoning_status", F.array_join("draft.evidence", " | ").alias("evidence"),
        F.size("draft.violated_statutes").cast("long").alias("n_statutes"), "draft.recommended_action", "draft.confidence_label", "draft.caveats",
    )


@query("dossier_markdown", f"""WITH {_CITED} SELECT run_id, detection_id,
 '# Enforcement Dossier — Parcel ' || landcode || ' (County ' || aoi || ')' || chr(10) || chr(10)
 || '*Decision-support artifact generated by {T.GENERATOR} ({T.TEMPLATE_MODEL}). Not a legal determination — for inspector review before filing.*' || chr(10) || chr(10)
 || '## Summary' || chr(10) || {_SUMMARY} || chr(10) || chr(10) || '**Zoning status:** {T.ZONING}' || chr(10) || '**Confidence:** ' || {_LABEL} || chr(10) || chr(10)
 || '## Evidence' || chr(10) || '- ' || {_EV1} || chr(10) || '- ' || {_EV2} || CASE WHEN {_NEAR80} THEN chr(10) || '- ' || {_EV3} ELSE '' END || chr(10) || chr(10)
 || '## Statutes implicated' || coalesce(chr(10) || stat_md, '') || chr(10) || chr(10) || '## Recommended action' || chr(10) || '{T.ACTION}' || chr(10) || chr(10)
 || '## Caveats' || chr(10) || '{T.CAVEATS}' || chr(10) || chr(10) || '## Retrieved statute excerpts (RAG sources)' || coalesce(chr(10) || src_md, '') AS dossier_md FROM cc""")
def dossier_markdown(spark, d):
    docs = DO.build_dossiers(cited_candidates(spark, d), I.MATCH_RADIUS_M, FACTS)
    return docs.select("run_id", "detection_id", "dossier_md")


@query("dossier_payload", f"""WITH {_CITED} SELECT run_id, detection_id, parcel_id, landcode, matched_label_id, t0_date, {_LABEL} AS confidence_label, '{T.TEMPLATE_MODEL}' AS model,
 (SELECT count(*) FROM ci WHERE topic = detection_id % 10) AS n_citations, (SELECT min(article_no) FROM ci WHERE topic = detection_id % 10) AS first_article FROM cc""")
def dossier_payload(spark, d):
    """The stored JSON document, read back field by field."""
    docs = DO.build_dossiers(cited_candidates(spark, d), I.MATCH_RADIUS_M, FACTS)
    schema = (
        "facts STRUCT<detection_id: LONG, parcel_id: STRING, landcode: STRING, matched_label_id: LONG, t0_date: STRING>, "
        "dossier STRUCT<confidence_label: STRING>, citations ARRAY<STRUCT<law_title: STRING, article_no: STRING, similarity: DOUBLE>>, model STRING"
    )
    read = docs.withColumn("j", F.from_json("dossier_json", schema))
    return read.select(
        "run_id", "j.facts.detection_id", "j.facts.parcel_id", "j.facts.landcode", "j.facts.matched_label_id", "j.facts.t0_date",
        "j.dossier.confidence_label", "j.model", F.size("j.citations").cast("long").alias("n_citations"),
        F.array_min("j.citations.article_no").alias("first_article"),
    )


_AUDIT_TITLE = "CASE WHEN detection_id % 5 = 0 THEN 'Law invented' ELSE law_title END"


@query("grounding_audit", f"""WITH {_CITED},
ct AS (SELECT run_id, detection_id, count(DISTINCT CASE WHEN detection_id % 5 = 0 THEN 'Law invented ' || article_no END) AS bad FROM ca JOIN ci ON topic = detection_id % 10
  WHERE ci.rank IN (SELECT rank FROM ci c2 WHERE c2.topic = ci.topic ORDER BY rank LIMIT 3) GROUP BY ALL)
SELECT run_id, detection_id, coalesce(bad, 0)::BIGINT AS bad_citations, CASE WHEN detection_id % 7 = 0 THEN 1 ELSE 0 END::BIGINT AS bad_numbers, CASE WHEN detection_id % 11 = 0 THEN 1 ELSE 0 END::BIGINT AS bad_wording,
 coalesce(bad, 0) = 0 AND detection_id % 7 <> 0 AND detection_id % 11 <> 0 AS ok FROM cc LEFT JOIN ct USING (run_id, detection_id)""")
def grounding_audit(spark, d):
    """Audit of drafts into which faults were planted: a wrong title, a made-up number, a verdict."""
    c = F.col
    rows = cited_candidates(spark, d).withColumns(
        {"draft": DO.template_dossier(c("citations"), I.MATCH_RADIUS_M), "facts": DO.facts_block(I.MATCH_RADIUS_M)}
    )
    cited = F.transform(
        c("draft.violated_statutes"),
        lambda v: F.struct(
            F.when(c("detection_id") % 5 == 0, "Law invented").otherwise(v["law_title"]).alias("law_title"), v["article_no"].alias("article_no")
        ),
    )
    evidence = F.when(c("detection_id") % 7 == 0, F.concat(c("draft.evidence"), F.array(F.lit("about 987654321 trees")))).otherwise(c("draft.evidence"))
    said = F.when(c("detection_id") % 11 == 0, F.concat(c("draft.summary"), F.lit(" The owner has violated the act."))).otherwise(c("draft.summary"))
    rows = rows.withColumn("issues", DO.grounding_issues(cited, c("citations"), evidence, c("facts"), said))

    def count(prefix: str):
        return F.size(F.filter("issues", lambda i: i.startswith(prefix))).cast("long")

    return rows.select(
        "run_id", "detection_id", count("citation").alias("bad_citations"), count("number").alias("bad_numbers"),
        count("over-certain").alias("bad_wording"), (F.size("issues") == 0).alias("ok"),
    )


@query("metrics_payload_json", f"""WITH m AS ({ORACLES['precision_recall']})
SELECT run_id, aoi, '{{"run_id":"' || run_id || '","aoi":"' || aoi || '","match_radius_m":80.0,"n_detections":' || n_detections || ',"n_flagged_detections":' || n_flagged_detections
 || ',"n_true_positive_detections":' || n_true_positive_detections || ',"n_labels":' || n_labels || ',"n_labels_matched":' || n_labels_matched || ',"precision":' || precision || ',"recall":' || recall || ',"f1":' || f1
 || ',"note":"{M.NOTE}"}}' AS payload FROM m""")
def metrics_payload_json(spark, d):
    return M.metrics_payload(precision_recall(spark, d))


@query("summary_tiles", f"""WITH m AS ({ORACLES['precision_recall']})
SELECT run_id, aoi, n_detections, n_flagged_detections, n_labels, round(precision * 100)::BIGINT AS precision_pct, round(recall * 100)::BIGINT AS recall_pct, round(f1, 2) AS f1 FROM m""")
def summary_tiles(spark, d):
    return M.summary_tiles(precision_recall(spark, d))
