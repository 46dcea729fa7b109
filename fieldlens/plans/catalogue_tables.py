"""Source, table and demand queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.functions import geometry as G
from fieldlens.functions import scalars as S
from fieldlens.operators import demand as DM
from fieldlens.operators import ranking as K
from fieldlens.operators import tables as TB
from fieldlens.operators import tiles as TL
from fieldlens.operators.dossiers import feature_json
from fieldlens.plans import imagery as IM
from fieldlens.plans import inputs as I
from fieldlens.plans import oracle_inputs as O
from fieldlens.plans.registry import query
from fieldlens.sources import labels as L
from fieldlens.sources import laws, parcels, rasters, scenes, tenders
from fieldlens.streaming.events import completed_runs

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

_AREA_BOX = "aminx <= maxx AND minx <= amaxx AND aminy <= maxy AND miny <= amaxy"


def _catalog_areas(spark, d):
    """Box of each catalogue area: the middle half of its scenes' extent."""
    box = I.scenes(spark, d).groupBy("aoi").agg(
        F.min("minx").alias("x0"), F.max("maxx").alias("x1"), F.min("miny").alias("y0"), F.max("maxy").alias("y1")
    )
    return box.selectExpr(
        "aoi", "x0 + (x1 - x0) / 4 AS aminx", "y0 + (y1 - y0) / 4 AS aminy", "x1 - (x1 - x0) / 4 AS amaxx", "y1 - (y1 - y0) / 4 AS amaxy"
    )


@query("scene_search", f"""WITH {O.SCENES}, b AS (SELECT aoi, min(minx) AS x0, max(maxx) AS x1, min(miny) AS y0, max(maxy) AS y1 FROM sc GROUP BY aoi),
a AS (SELECT aoi, x0 + (x1 - x0) / 4 AS aminx, y0 + (y1 - y0) / 4 AS aminy, x1 - (x1 - x0) / 4 AS amaxx, y1 - (y1 - y0) / 4 AS amaxy FROM b)
SELECT item_id, aoi, t_label, cloud_cover FROM sc JOIN a USING (aoi) WHERE t_label IS NOT NULL AND cloud_cover < 25 AND {_AREA_BOX}""")
def scene_search(spark, d):
    hits = scenes.search(I.scenes(spark, d), I.SCENE_WINDOWS, 25.0, _catalog_areas(spark, d))
    return hits.select("item_id", "aoi", "t_label", "cloud_cover")


@query("best_scene", f"""WITH {O.SCENES} SELECT aoi, t_label, item_id, cloud_cover FROM sc WHERE t_label IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY aoi, t_label ORDER BY coalesce(cloud_cover, 100), o_orderkey) = 1""")
def best_scene(spark, d):
    """Least cloudy scene per area and window over all scenes, unknown cloud included."""
    tagged = scenes.tag_windows(I.scenes(spark, d), I.SCENE_WINDOWS)
    return scenes.best_scene(tagged, "o_orderkey").select("aoi", "t_label", "item_id", "cloud_cover")


@query("scene_days", f"""WITH {O.SCENES} SELECT item_id, left(coalesce(CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE strftime(dt, '%Y-%m-%dT%H:%M:%SZ') END, ''), 10) AS day,
 t_label IS NOT NULL AS in_window FROM sc""")
def scene_days(spark, d):
    sc = I.scenes(spark, d)
    text = F.when(F.col("o_orderkey") % 19 != 0, F.date_format("dt", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    inside = scenes.tag_windows(sc, I.SCENE_WINDOWS).select("item_id", F.lit(True).alias("hit"))
    return sc.select("item_id", S.date_prefix(text).alias("day")).join(inside, "item_id", "left").select(
        "item_id", "day", F.col("hit").isNotNull().alias("in_window")
    )


_DAY = "strftime({}(ts), '%Y-%m-%d')"


@query("manifest_dates", f"""SELECT 'a' || k AS aoi, {_DAY.format('min')} AS t0_date, CASE WHEN k % 3 = 2 THEN '' ELSE {_DAY.format('max')} END AS t1_date,
 count(*) AS n_pixels FROM (SELECT event_id // {I.PIXELS_PER_AOI} AS k, ts FROM events) GROUP BY k""")
def manifest_dates(spark, d):
    """Dates of all stored windows from the manifest, and the pixels with data of their earlier date."""
    tiles, manifest = IM.stored(spark, d)
    seen = TL.band_stats(tiles.where("t_label = 't0'"), ["aoi"], ["b04"]).groupBy("aoi").agg(F.sum("n_px").alias("n_pixels"))
    return rasters.window_dates(manifest).join(seen, "aoi")


@query("table_counts", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in TABLES) + " UNION ALL SELECT 'absent', 0")
def table_counts(spark, d):
    parts = [TB.row_count(spark, t, f"{d}/{t}.parquet") for t in TABLES] + [TB.row_count(spark, "absent", f"{d}/absent.parquet")]
    return reduce(DataFrame.unionByName, parts)


# ------------------------------------------------------------------ labels

_KM = f"2 * 6371.0088 * asin(sqrt(power(sin(radians(lat - clat) / 2), 2) + cos(radians(clat)) * cos(radians(lat)) * power(sin(radians(lng - clon) / 2), 2)))"
_LABEL_AREAS = f"""{O.RECORDS}, la AS (SELECT DISTINCT k, aoi, {I.aoi_x('k')} / 1000000 + 0.005 AS clon, {I.aoi_y('k', '//')} / 1000000 - 0.05 AS clat,
 {I.aoi_x('k')} / 1000000 + 0.001 AS bx0, {I.aoi_x('k')} / 1000000 + 0.009 AS bx1, {I.aoi_y('k', '//')} / 1000000 - 0.09 AS by0, {I.aoi_y('k', '//')} / 1000000 - 0.01 AS by1 FROM re)"""


def _label_areas(spark, d, range_km: float):
    x, y = f"({I.aoi_x('k')} / 1000000D)", f"({I.aoi_y('k')} / 1000000D)"
    return I.site_records(spark, d).select("k", "aoi").distinct().selectExpr(
        "k", "aoi", f"{x} + 0.005D AS center_lon", f"{y} - 0.05D AS center_lat", f"{x} + 0.001D AS minx", f"{x} + 0.009D AS maxx",
        f"{y} - 0.09D AS miny", f"{y} - 0.01D AS maxy", f"{range_km}D AS range_km",
    )


@query("labels_radius_clip", f"""WITH {_LABEL_AREAS}, j AS (SELECT re.*, {_KM} AS km, bx0, bx1, by0, by1 FROM re JOIN la USING (aoi))
SELECT id, aoi, round(km, 6) AS dist_km FROM j WHERE lng IS NOT NULL AND km <= 4 AND lng BETWEEN bx0 AND bx1 AND lat BETWEEN by0 AND by1""")
def labels_radius_clip(spark, d):
    areas = _label_areas(spark, d, 4.0).drop("k")
    return L.around_center(I.site_records(spark, d).drop("k"), areas).select("id", "aoi", F.round("dist_km", 6).alias("dist_km"))


@query("radius_ladder", f"""WITH {_LABEL_AREAS}, tr AS (SELECT aoi, k, unnest([7.0, 5.0, 3.0, 1.0])::DOUBLE AS range_km FROM la),
pk AS (SELECT aoi, max(range_km) AS range_km FROM tr WHERE (k + CAST(range_km AS BIGINT)) % 3 <> 0 GROUP BY aoi),
j AS (SELECT re.*, {_KM} AS km, bx0, bx1, by0, by1, range_km FROM re JOIN la USING (aoi) JOIN pk USING (aoi))
SELECT aoi, range_km, count(*) AS n_records FROM j WHERE lng IS NOT NULL AND km <= range_km AND lng BETWEEN bx0 AND bx1 AND lat BETWEEN by0 AND by1 GROUP BY ALL""")
def radius_ladder(spark, d):
    areas = _label_areas(spark, d, 7.0)
    rungs = areas.select("k", "aoi", F.explode(F.array(*[F.lit(v) for v in (7.0, 5.0, 3.0, 1.0)])).alias("range_km"))
    answered = rungs.where("(k + cast(range_km AS long)) % 3 <> 0").select("aoi", "range_km")
    found = L.first_answered(I.site_records(spark, d).drop("k"), areas.drop("k"), answered)
    return found.groupBy("aoi", "range_km").agg(F.count("*").alias("n_records"))


@query("label_normalise", f"WITH {O.RECORDS} SELECT id, nullif(regexp_replace(name, '^\\s+|\\s+$', '', 'g'), '') AS name FROM re")
def label_normalise(spark, d):
    return L.normalise(I.site_records(spark, d)).select("id", "name")


_SHIFT = 75
_BATCH = f"""tg AS (SELECT id, aoi, display_number, landcode, status, townname FROM re),
ba AS (SELECT id + {_SHIFT} AS id, aoi, display_number, landcode, status, townname, id AS pos FROM re
 UNION ALL SELECT id + {_SHIFT}, aoi || 'x', display_number + 1, landcode || '-v2', lower(status), townname || '-v2', id + 1000000000 FROM re)"""


@query("upsert_partial", f"""WITH {O.RECORDS}, {_BATCH},
f AS (SELECT * FROM ba QUALIFY row_number() OVER (PARTITION BY id ORDER BY pos) = 1),
l AS (SELECT * FROM ba QUALIFY row_number() OVER (PARTITION BY id ORDER BY pos DESC) = 1)
SELECT coalesce(t.id, f.id) AS id, CASE WHEN t.id IS NULL THEN f.aoi ELSE t.aoi END AS aoi, CASE WHEN t.id IS NULL THEN f.townname ELSE t.townname END AS townname,
 CASE WHEN f.id IS NOT NULL THEN l.display_number ELSE t.display_number END AS display_number, CASE WHEN f.id IS NOT NULL THEN l.landcode ELSE t.landcode END AS landcode,
 CASE WHEN f.id IS NOT NULL THEN l.status ELSE t.status END AS status FROM tg t FULL JOIN f ON f.id = t.id LEFT JOIN l ON l.id = f.id""")
def upsert_partial(spark, d):
    """Upsert a shifted copy of the records twice over: half of the keys are known, every key repeats."""
    target = I.site_records(spark, d).select("id", "aoi", "townname", "display_number", "landcode", "status")
    one = target.withColumns({"id": F.col("id") + _SHIFT, "pos": F.col("id")})
    two = target.select(
        (F.col("id") + _SHIFT).alias("id"), F.concat("aoi", F.lit("x")).alias("aoi"), F.concat("townname", F.lit("-v2")).alias("townname"),
        (F.col("display_number") + 1).alias("display_number"), F.concat("landcode", F.lit("-v2")).alias("landcode"),
        F.lower("status").alias("status"), (F.col("id") + 1000000000).alias("pos"),
    )
    return TB.merge_upsert(target, one.unionByName(two), ["id"], ["display_number", "landcode", "status"], "pos")


@query("cascade_semi", f"""WITH {O.FLAGGED} SELECT f.run_id, f.detection_id, CASE WHEN p.parcel_id IS NULL THEN NULL ELSE f.parcel_id END AS parcel_id
FROM fl f LEFT JOIN (SELECT parcel_id FROM pa WHERE unit100k < 60000) p USING (parcel_id) WHERE f.detection_id IN (SELECT detection_id FROM de WHERE confidence >= 0.4)""")
def cascade_semi(spark, d):
    """Flagged rows survive with their detection; a parcel that is gone leaves a null."""
    from fieldlens.plans.catalogue_spatial import boxes, pairs

    rows = pairs(spark, d).select("run_id", "detection_id", "parcel_id")
    kept = TB.cascade_delete(rows, boxes(spark, d).where("confidence >= 0.4D"), ["detection_id"])
    return TB.null_missing_reference(kept, I.parcels(spark, d).where("unit100k < 60000"), "parcel_id").select("run_id", "detection_id", "parcel_id")


# ----------------------------------------------------------------- parcels

_FLAG = "CASE WHEN p_partkey % 3 = 0 THEN CASE WHEN p_partkey % 2 = 0 THEN 'false' WHEN p_partkey % 5 = 0 THEN '' ELSE 'true' END END"
_USE = "CASE WHEN is_farmland THEN '農牧用地' WHEN p_partkey % 5 = 0 THEN 'Farm ' || p_name ELSE p_name END"


@query("farmland_classify", f"""WITH {O.PARCELS}, s AS (SELECT parcel_id, {_FLAG} AS flag, {_USE} AS use FROM pa)
SELECT parcel_id, CASE WHEN flag IS NOT NULL THEN flag NOT IN ('false', '') ELSE regexp_matches(lower(use), '農|agric|farm|paddy|crop') END AS is_farmland FROM s""")
def farmland_classify(spark, d):
    p = I.parcels(spark, d).selectExpr("parcel_id", f"{_FLAG} AS flag", f"{_USE} AS use")
    return p.select(
        "parcel_id", F.when(F.col("flag").isNotNull(), S.truthy(F.col("flag"))).otherwise(S.farmland_by_words(F.col("use"))).alias("is_farmland")
    )


_CLIP = f"""{O.PARCELS}, ab AS (SELECT aoi, min(minx) + 500 AS ax0, min(miny) + 500 AS ay0, max(maxx) - 700 AS ax1, max(maxy) - 700 AS ay1 FROM pa GROUP BY aoi),
cl AS (SELECT pa.*, greatest(minx, ax0) AS cx0, greatest(miny, ay0) AS cy0, least(maxx, ax1) AS cx1, least(maxy, ay1) AS cy1 FROM pa JOIN ab USING (aoi))"""


@query("geojson_parcels", f"""WITH {_CLIP} SELECT CASE WHEN p_partkey % 7 = 0 THEN aoi || '-gj-0' ELSE parcel_id END AS parcel_id, aoi,
 CASE WHEN p_partkey % 2 = 0 THEN NULL ELSE landcode END AS landcode, sectname, {_USE} AS landuse_code,
 regexp_matches(lower({_USE}), '農|agric|farm|paddy|crop') AS is_farmland, 'geojson' AS source, round((cx1 - cx0) * (cy1 - cy0), 0) AS area
FROM cl WHERE cx1 > cx0 AND cy1 > cy0""")
def geojson_parcels(spark, d):
    """Parcels written as GeoJSON text, read back, clipped to a smaller area box and mapped."""
    p = I.parcels(spark, d).selectExpr("*", f"{_USE} AS use")
    c = F.col
    xy = [("minx", "miny"), ("maxx", "miny"), ("maxx", "maxy"), ("minx", "maxy"), ("minx", "miny")]
    ring = F.array(*[F.array(c(a), c(b)) for a, b in xy])
    props = F.struct(
        F.when(c("p_partkey") % 7 != 0, c("parcel_id")).otherwise("").alias("parcel_id"),
        F.lit("").alias("landcode"),
        F.when(c("p_partkey") % 2 != 0, c("landcode")).alias("地號"), c("sectname").alias("段名"), c("use").alias("編定"),
    )
    feature = F.struct(
        F.lit("Feature").alias("type"), F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry"),
        props.alias("properties"),
    )
    text = p.select("aoi", F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), F.array(feature).alias("features"))).alias("fc"))
    areas = p.groupBy("aoi").agg(
        (F.min("minx") + 500).alias("minx"), (F.min("miny") + 500).alias("miny"), (F.max("maxx") - 700).alias("maxx"), (F.max("maxy") - 700).alias("maxy")
    ).withColumn("provider", F.lit("geojson"))
    out = parcels.features_to_parcels(parcels.parse_collections(text, "fc"), areas, cell=5000.0)
    return out.select(
        "parcel_id", "aoi", "landcode", "sectname", "landuse_code", "is_farmland", "source", F.round(G.polygon_area(c("geom")), 0).alias("area")
    )


@query("geojson_export", f"""WITH {O.PARCELS}, t AS (SELECT *, minx / 1000000 AS a, miny / 1000000 AS b, maxx / 1000000 AS c, maxy / 1000000 AS e FROM pa)
SELECT parcel_id, '{{"type":"Feature","geometry":{{"type":"Polygon","coordinates":[[[' || a || ',' || b || '],[' || c || ',' || b || '],[' || c || ',' || e || '],[' || a || ',' || e || '],[' || a || ',' || b
 || ']]]}},"properties":{{"parcel_id":"' || parcel_id || '","landcode":' || CASE WHEN p_partkey % 9 = 0 THEN 'null' ELSE '"' || landcode || '"' END || ',"is_farmland":' || is_farmland || '}}}}' AS feature FROM t""")
def geojson_export(spark, d):
    c = F.col
    ring = G.box_ring(c("minx") / 1e6, c("miny") / 1e6, c("maxx") / 1e6, c("maxy") / 1e6)
    p = I.parcels(spark, d).withColumns({"ring": ring, "landcode": F.when(c("p_partkey") % 9 != 0, c("landcode"))})
    return p.select("parcel_id", feature_json(G.to_geojson_geometry(F.array("ring")), ["parcel_id", "landcode", "is_farmland"]).alias("feature"))


LAYER_ROWS = 8000  # of one area


@query("parcels_layer", f"""WITH {O.PARCELS} SELECT aoi, parcel_id, landcode, sectname, is_farmland FROM pa WHERE is_farmland
QUALIFY row_number() OVER (PARTITION BY aoi ORDER BY parcel_id) <= {LAYER_ROWS}""")
def parcels_layer(spark, d):
    layer = I.parcels(spark, d).where("is_farmland").select("aoi", "parcel_id", "landcode", "sectname", "is_farmland")
    return K.top_per_group(layer, ["aoi"], [F.asc("parcel_id")], LAYER_ROWS)


# -------------------------------------------------------- documents, pages


@query("statute_articles", """WITH a AS (SELECT source AS pcode, 'Law ' || source AS law_title, doc_id, unnest(string_split(text, chr(10))) AS line,
 generate_subscripts(string_split(text, chr(10)), 1) - 1 AS article_pos FROM documents)
SELECT pcode, law_title, doc_id, article_pos::BIGINT AS article_pos, 'Art. ' || doc_id || '-' || (article_pos + 1) AS article_no, length(line)::BIGINT AS n_chars, md5(line) AS digest FROM a""")
def statute_articles(spark, d):
    """Documents written as statute JSON (a line is an article), read back and exploded."""
    docs = I.texts(spark, d, "documents", "doc_id", "source", "text")
    lines = F.transform(
        F.split("text", "\n"),
        lambda line, i: F.struct(
            F.concat(F.lit("Art. "), F.col("doc_id").cast("string"), F.lit("-"), (i + 1).cast("string")).alias("article_no"), line.alias("text")
        ),
    )
    body = F.to_json(F.struct(F.concat(F.lit("Law "), F.col("source")).alias("title"), lines.alias("articles")))
    texts = docs.select(F.col("source").alias("pcode"), "doc_id", body.alias("body"))
    parsed = laws.parse_statutes(texts, "body")
    arts = parsed.select("pcode", "doc_id", F.col("title").alias("law_title"), F.posexplode("articles").alias("article_pos", "a"))
    return arts.select(
        "pcode", "law_title", "doc_id", F.col("article_pos").cast("long").alias("article_pos"), "a.article_no",
        F.char_length("a.text").cast("long").alias("n_chars"), F.md5("a.text").alias("digest"),
    )


@query("tender_flatten", """WITH p AS (SELECT page_id, page_id % 5 + 1 AS page, page_id % 4 + 1 AS total_pages, regexp_extract(url, '^https?://([^/]+)', 1) AS host,
 regexp_extract(html, '<title>(.*?)</title>', 1) AS title FROM pages)
SELECT page_id, 'kw' || (page_id % 3) AS keyword, page, host AS unit_name, CASE WHEN page_id % 9 = 0 THEN NULL ELSE title END AS title, CASE WHEN page_id % 9 = 0 THEN NULL ELSE 'open' END AS type
FROM p WHERE page <= greatest(1, least(3, total_pages))""")
def tender_flatten(spark, d):
    c = F.col
    src = I.table(spark, d, "pages").selectExpr(
        "page_id", "concat('kw', page_id % 3) AS keyword", "page_id % 5 + 1 AS page", "cast(page_id % 4 + 1 AS int) AS total_pages",
        r"regexp_extract(url, '^https?://([^/]+)', 1) AS host", r"regexp_extract(html, '<title>(.*?)</title>', 1) AS title",
    )
    brief = F.when(c("page_id") % 9 != 0, F.struct(c("title"), F.lit("open").alias("type")))
    record = F.struct(F.lit("2024-01-01").alias("date"), c("host").alias("unit_name"), c("page_id").cast("string").alias("job_number"), brief.alias("brief"))
    text = src.select("keyword", "page", F.to_json(F.struct(F.array(record).alias("records"), "total_pages")).alias("body"))
    rows = tenders.flatten_pages(text, "body", 3)
    return rows.select(c("job_number").cast("long").alias("page_id"), "keyword", "page", "unit_name", "title", "type")


KEYWORDS = ["the", "ation", "eau", "ung", "que", "er", "http", "License", "und", "con", "zzzzqx", "qqjjvv"]


@query("keyword_counts", "WITH k AS (SELECT unnest([" + ", ".join(f"'{k}'" for k in KEYWORDS) + """]) AS keyword)
SELECT keyword, count(doc_id) AS n_titles FROM k LEFT JOIN documents ON contains(text, keyword) GROUP BY keyword""")
def keyword_counts(spark, d):
    return DM.keyword_counts(I.texts(spark, d, "documents", "text"), "text", KEYWORDS)


_YEARS = "SELECT strftime(o_orderdate, '%Y') AS year, count(*) AS n_reports FROM orders GROUP BY year"


@query("reports_by_year", _YEARS)
def reports_by_year(spark, d):
    return DM.reports_by_year(I.table(spark, d, "orders"), "o_orderdate")


@query("demand_summary", f"""WITH y AS ({_YEARS}), w AS (SELECT keyword, count(page_id) AS n_titles FROM (SELECT unnest(['error', 'the', 'example', 'zzzzqx']) AS keyword) LEFT JOIN pages ON contains(html, keyword) GROUP BY keyword)
SELECT '{{"n_reports":' || (SELECT sum(n_reports)::BIGINT FROM y) || ',"reports_by_year":{{' || (SELECT string_agg('"' || year || '":' || n_reports, ',' ORDER BY year) FROM y) || '}},"total_matching_tenders":'
 || (SELECT sum(n_titles)::BIGINT FROM w) || ',"by_keyword":{{' || (SELECT string_agg('"' || keyword || '":' || n_titles, ',' ORDER BY keyword) FROM w) || '}}}}' AS summary""")
def demand_summary(spark, d):
    words = DM.keyword_counts(I.texts(spark, d, "pages", "html"), "html", ["error", "the", "example", "zzzzqx"])
    return DM.demand_summary(reports_by_year(spark, d), words)


# ------------------------------------------------------------------ events


@query("latest_metrics", """SELECT user_id AS run_id, event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def latest_metrics(spark, d):
    e = I.table(spark, d, "events").select(F.col("user_id").alias("run_id"), "event_id", "ts", "props")
    newest = K.latest_by(e, ["run_id"], "ts", ["event_id"])
    return newest.select("run_id", "event_id", F.from_json("props", "k LONG")["k"].alias("k"))


@query("latest_run", """SELECT 'run-' || (event_id % 4) AS run_id, event_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 1""")
def latest_run(spark, d):
    e = I.table(spark, d, "events").select(F.expr("concat('run-', event_id % 4)").alias("run_id"), "event_id", "ts")
    return K.latest_by(e, [], "ts", ["event_id"]).select("run_id", "event_id")


@query("event_filter", """SELECT event_id, 'run-' || CAST(json_extract(props, '$.k') AS BIGINT) AS run_id FROM events
WHERE event_type = 'purchase' AND CAST(json_extract(props, '$.k') AS BIGINT) % 10 <> 0""")
def event_filter(spark, d):
    """Batch twin of the stream filter: completed detections with a run id."""
    k = F.from_json("props", "k LONG")["k"]
    topic = I.table(spark, d, "events").select(
        "event_id", F.when(F.col("event_type") == "purchase", "detection.completed").otherwise(F.col("event_type")).alias("type"),
        F.when(k % 10 != 0, F.concat(F.lit("run-"), k.cast("string"))).otherwise("").alias("run_id"),
    )
    return completed_runs(topic).select("event_id", "run_id")
