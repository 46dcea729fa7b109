"""SQL text of the derived inputs, for checking the queries with another engine."""

from __future__ import annotations

from fieldlens.functions import projection as P
from fieldlens.plans import inputs as I


def _ay(k: str) -> str:
    return I.aoi_y(k, "//")


def nd(a: str, b: str) -> str:
    return f"CASE WHEN {a} + {b} <> 0 THEN ({a} - {b}) / ({a} + {b}) ELSE 0 END"


def _band(e: str) -> str:
    return f"CAST({e} AS DOUBLE) / 1000"


PX = f"""
px0 AS (SELECT event_id // {I.PIXELS_PER_AOI} AS k, 'a' || (event_id // {I.PIXELS_PER_AOI}) AS aoi,
               (event_id % {I.PIXELS_PER_AOI}) // {I.RASTER_WIDTH} AS r,
               (event_id % {I.PIXELS_PER_AOI}) % {I.RASTER_WIDTH} AS c, event_id, (event_id * 31) % 1009 AS h FROM events),
px1 AS (SELECT *, event_id % 997 = 0 AS z,
               (((r // 6) * 7 + (c // 6) * 3) % 5 = 0 AND event_id % 53 <> 0) OR (event_id * 7919) % 97 = 0 AS built FROM px0),
px AS (SELECT k, aoi, r, c,
  {_band('CASE WHEN z THEN 0 ELSE 60 + h % 7 END')} AS b04_t0,
  {_band('CASE WHEN z THEN 0 ELSE 350 + h % 11 END')} AS b08_t0,
  {_band('CASE WHEN z THEN 0 ELSE 200 + h % 5 END')} AS b11_t0,
  {_band('CASE WHEN built THEN 200 + h % 7 ELSE 60 + h % 7 + h % 3 END')} AS b04_t1,
  {_band('CASE WHEN built THEN 220 + h % 11 ELSE 350 + h % 11 END')} AS b08_t1,
  {_band('CASE WHEN built THEN 340 + h % 5 ELSE 200 + h % 5 + h % 3 END')} AS b11_t1 FROM px1)"""

IDX = f"""{PX},
idx AS (SELECT *, ({nd('b11_t1', 'b08_t1')}) - ({nd('b11_t0', 'b08_t0')}) AS dn,
               ({nd('b08_t0', 'b04_t0')}) - ({nd('b08_t1', 'b04_t1')}) AS dv FROM px)"""

MASK = f"""{IDX},
mask AS (SELECT k, aoi, r, c, dn, dv FROM idx WHERE dn >= 0.06 AND dv >= 0.12)"""

OFFSETS = "(VALUES (0, 0), (1, 0), (-1, 0), (0, 1), (0, -1)) d(dr, dc)"

OPEN = f"""{MASK},
ext AS (SELECT aoi, max(r) + 1 AS hh, max(c) + 1 AS ww FROM px GROUP BY aoi),
er AS (SELECT aoi, r, c FROM (
         SELECT m.aoi, (m.r + dr + hh) % hh AS r, (m.c + dc + ww) % ww AS c FROM mask m JOIN ext USING (aoi), {OFFSETS})
       GROUP BY aoi, r, c HAVING count(*) = 5),
op AS (SELECT DISTINCT aoi, (r + dr + hh) % hh AS r, (c + dc + ww) % ww AS c FROM er JOIN ext USING (aoi), {OFFSETS})"""


def components(source: str, tile: int | None = None) -> str:
    """CTEs giving ``comp(aoi, r, c, component)`` for the pixels of ``source``."""
    same = "" if tile is None else f"AND o.r // {tile} = x.r // {tile} AND o.c // {tile} = x.c // {tile}"
    return f"""
reach AS (SELECT aoi, r, c, r * 4294967296 + c AS root FROM {source}
  UNION SELECT o.aoi, o.r, o.c, x.root
  FROM (SELECT aoi, root, r + dr AS r2, c + dc AS c2, r, c FROM reach, {OFFSETS}) x
  JOIN {source} o ON o.aoi = x.aoi AND o.r = x.r2 AND o.c = x.c2 {same}),
comp AS (SELECT aoi, r, c, min(root) AS component FROM reach GROUP BY aoi, r, c)"""


CONF = "greatest(0.05, least(0.99, 0.5 * least(md / 0.30, 1.0) + 0.5 * least(mv / 0.50, 1.0)))"

_UNIT = (
    f"xor(xor({I.PARCEL_SEED} * 73856093::BIGINT, i * 19349663::BIGINT), (p_partkey // 10) * 83492791::BIGINT) % 100000"
)
PARCELS = f"""
pa0 AS (SELECT *, p_partkey // {I.PARCELS_PER_AOI} AS k, 'a' || (p_partkey // {I.PARCELS_PER_AOI}) AS aoi,
               (p_partkey % {I.PARCELS_PER_AOI}) % 10 AS i, (p_partkey % {I.PARCELS_PER_AOI}) // 10 AS j FROM part),
pa AS (SELECT p_partkey, p_name, k, aoi, i, j, printf('%s-%03d-%03d', aoi, i, j) AS parcel_id,
              'LC-' || p_partkey AS landcode, p_brand AS sectname, {_UNIT} AS unit100k, {_UNIT} < 70000 AS is_farmland,
              CAST({I.aoi_x('k')} - 300 + 1200 * i AS DOUBLE) AS minx,
              CAST({_ay('k')} + 300 - 1200 * (j + 1) AS DOUBLE) AS miny,
              CAST({I.aoi_x('k')} - 300 + 1200 * i + 1200 AS DOUBLE) AS maxx,
              CAST({_ay('k')} + 300 - 1200 * (j + 1) + 1200 AS DOUBLE) AS maxy FROM pa0)"""

_K = f"(o_orderkey // {I.DETECTIONS_PER_AOI})"
DET = f"""
de0 AS (SELECT o_orderkey AS detection_id, 'a' || {_K} AS aoi, 'run-' || (o_orderkey % 4) AS run_id,
   {I.aoi_x(_K)} + (o_orderkey * 7919) % 10000 AS cx, {_ay(_K)} - (o_orderkey * 104729) % 100000 AS cy,
   100 + o_orderkey % 150 AS hw,
   least(0.99::DOUBLE, 0.05::DOUBLE + CAST((o_orderkey * 37) % 950 AS DOUBLE) / 1000) AS confidence,
   0.06::DOUBLE + CAST((o_orderkey * 13) % 300 AS DOUBLE) / 1000 AS ndbi_delta,
   0.12::DOUBLE + CAST((o_orderkey * 17) % 400 AS DOUBLE) / 1000 AS ndvi_drop,
   strftime(o_orderdate, '%Y-%m-%d') AS t0_date,
   strftime(o_orderdate + INTERVAL 1827 DAY, '%Y-%m-%d') AS t1_date, o_orderdate AS created_at FROM orders),
de AS (SELECT * EXCLUDE (cx, cy, hw), CAST(cx - hw AS DOUBLE) AS minx, CAST(cy - hw AS DOUBLE) AS miny,
              CAST(cx + hw AS DOUBLE) AS maxx, CAST(cy + hw AS DOUBLE) AS maxy FROM de0)"""

_S = f"(s_suppkey // {I.SITES_PER_AOI})"
SITES = f"""
si AS (SELECT s_suppkey AS pid, 'a' || {_S} AS aoi,
   CAST({I.aoi_x(_S)} + (s_suppkey * 3571 + 13) % 10000 AS DOUBLE) AS px,
   CAST({_ay(_S)} - (s_suppkey * 65537 + 7) % 100000 AS DOUBLE) AS py FROM supplier)"""

_C = f"(c_custkey // {I.RECORDS_PER_AOI})"
RECORDS = f"""
re0 AS (SELECT c_custkey AS id, {_C} AS k, 'a' || {_C} AS aoi, CAST(c_custkey AS INTEGER) AS display_number,
   CASE WHEN c_custkey % 7 = 0 THEN '  ' WHEN c_custkey % 11 = 0 THEN NULL ELSE ' ' || c_name || ' ' END AS name,
   'LC-' || (c_custkey % 2000) AS landcode, 'town' || c_nationkey AS townname, c_mktsegment AS status,
   CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE {I.aoi_x(_C)} + (c_custkey * 3571 + 13) % 10000 END AS mlng,
   {_ay(_C)} - (c_custkey * 65537 + 7) % 100000 AS mlat FROM customer),
re AS (SELECT * EXCLUDE (mlng, mlat), CAST(mlng AS DOUBLE) / 1000000 AS lng, CAST(mlat AS DOUBLE) / 1000000 AS lat FROM re0)"""

SCENES = f"""
sc0 AS (SELECT 'scene-' || o_orderkey AS item_id, o_orderkey, 'c' || (o_custkey % 25) AS aoi, o_orderdate AS dt,
   CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST((o_orderkey * 37) % 1000 AS DOUBLE) / 10 END AS cloud_cover,
   CAST({I.ORIGIN_X} + (o_orderkey * 7919) % 10000 AS DOUBLE) AS minx,
   CAST({I.ORIGIN_Y} - (o_orderkey * 104729) % 100000 AS DOUBLE) AS miny FROM orders),
sc AS (SELECT *, minx + 5000 AS maxx, miny + 5000 AS maxy,
   CASE WHEN dt >= TIMESTAMP '1995-10-01' AND dt < TIMESTAMP '1996-04-01' THEN 't0'
        WHEN dt >= TIMESTAMP '2000-10-01' AND dt < TIMESTAMP '2001-04-01' THEN 't1' END AS t_label FROM sc0)"""

# Flagged pairs with the local metric, the label chosen by planar distance and its distance in metres.
FLAGGED = f"""{DET},{PARCELS},{SITES},
fl0 AS (SELECT d.run_id, d.aoi, d.detection_id, p.parcel_id, p.landcode, p.sectname, d.confidence,
   d.minx AS dx0, d.miny AS dy0, d.maxx AS dx1, d.maxy AS dy1,
   (least(d.maxx, p.maxx) - greatest(d.minx, p.minx)) * ({1e-6!r} * 101600::DOUBLE)
   * ((least(d.maxy, p.maxy) - greatest(d.miny, p.miny)) * ({1e-6!r} * 110750::DOUBLE)) AS overlap_area_m2
   FROM de d JOIN pa p ON p.aoi = d.aoi AND p.is_farmland
    AND d.minx <= p.maxx AND p.minx <= d.maxx AND d.miny <= p.maxy AND p.miny <= d.maxy),
nn0 AS (SELECT d.detection_id, s.pid, s.px, s.py,
   greatest(0, s.px - d.maxx, d.minx - s.px) AS gx, greatest(0, s.py - d.maxy, d.miny - s.py) AS gy
   FROM de d JOIN si s ON s.aoi = d.aoi),
nn AS (SELECT detection_id, pid, px, py, sqrt((gx * 0.1016) * (gx * 0.1016) + (gy * 0.11075) * (gy * 0.11075)) AS dist
   FROM nn0 QUALIFY row_number() OVER (PARTITION BY detection_id ORDER BY gx * gx + gy * gy, pid) = 1),
fl AS (SELECT fl0.*, nn.pid AS matched_label_id, nn.dist AS distance_to_label_m FROM fl0 LEFT JOIN nn USING (detection_id))"""

# Worklist candidates with the columns the documents use.
CANDS = f"""{FLAGGED},
ca0 AS (SELECT * FROM fl QUALIFY row_number() OVER (PARTITION BY run_id, aoi, detection_id
          ORDER BY overlap_area_m2 DESC NULLS FIRST, parcel_id) = 1),
ca AS (SELECT ca0.*, d.ndbi_delta, d.ndvi_drop, d.t0_date, d.t1_date,
   (d.maxx - d.minx) * 0.1016 * ((d.maxy - d.miny) * 0.11075) AS area_m2,
   (d.minx + d.maxx) / 2 * 0.000001 AS lon, (d.miny + d.maxy) / 2 * 0.000001 AS lat,
   row_number() OVER (PARTITION BY ca0.run_id, ca0.aoi ORDER BY coalesce(ca0.confidence, 0) DESC, ca0.detection_id) AS pos
   FROM ca0 JOIN de d USING (detection_id)
   QUALIFY pos <= {I.WORKLIST})"""

TOPK = f"""
ev AS (SELECT vec_id, label, unnest(embedding::DOUBLE[]) AS v, generate_subscripts(embedding, 1) AS p FROM embeddings),
ce AS (SELECT label, list(m ORDER BY p) AS q FROM (SELECT label, p, avg(v) AS m FROM ev GROUP BY label, p) GROUP BY label),
tk AS (SELECT label AS query_id, vec_id AS item_id, round(list_cosine_similarity(embedding::DOUBLE[], q), 12) AS similarity
   FROM (SELECT vec_id, embedding FROM embeddings), ce),
topk AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC NULLS LAST, item_id) AS rank
   FROM tk QUALIFY rank <= {I.TOP_K})"""

CITES = f"""{TOPK},
ci AS (SELECT query_id AS topic, rank, 'Law ' || source AS law_title, 'Art. ' || doc_id AS article_no, text AS content, similarity
   FROM topk JOIN documents ON doc_id = item_id)"""


def _lit(v: float) -> str:
    return f"({v:.17e})"


def forward(src: str, out: str, points: list[tuple[str, str, str, str]], crs: str = "EPSG:3826") -> str:
    """CTEs ending in ``out``: ``src`` plus projected columns for ``(lon, lat, x name, y name)``."""
    tm = P.crs_parameters(crs)
    a, b, c = [], [], []
    for n, (lon, lat, ox, oy) in enumerate(points):
        s = f"sin(radians({lat}))"
        a.append(f"sinh(atanh({s}) - {_lit(P.ECC)} * atanh({_lit(P.ECC)} * {s})) AS t{n}, radians(({lon}) - {_lit(tm.lon0)}) AS l{n}")
        b.append(f"atan2(t{n}, cos(l{n})) AS xi{n}, atanh(sin(l{n}) / sqrt(1 + t{n} * t{n})) AS et{n}")
        x, y = f"et{n}", f"xi{n}"
        for j, al in enumerate(P.ALPHA, start=1):
            x += f" + {_lit(al)} * cos({2 * j} * xi{n}) * sinh({2 * j} * et{n})"
            y += f" + {_lit(al)} * sin({2 * j} * xi{n}) * cosh({2 * j} * et{n})"
        k = _lit(tm.k0 * P.RECTIFYING)
        c.append(f"{_lit(tm.false_easting)} + {k} * ({x}) AS {ox}, {_lit(tm.false_northing)} + {k} * ({y}) AS {oy}")
    return (
        f"{out}_1 AS (SELECT *, {', '.join(a)} FROM {src}),\n{out}_2 AS (SELECT *, {', '.join(b)} FROM {out}_1),\n"
        f"{out} AS (SELECT *, {', '.join(c)} FROM {out}_2)"
    )


def inverse(src: str, out: str, points: list[tuple[str, str, str, str]], crs: str = "EPSG:3826") -> str:
    tm = P.crs_parameters(crs)
    a, b, c, d = [], [], [], []
    k = _lit(tm.k0 * P.RECTIFYING)
    for n, (px, py, ox, oy) in enumerate(points):
        a.append(f"(({py}) - {_lit(tm.false_northing)}) / {k} AS wi{n}, (({px}) - {_lit(tm.false_easting)}) / {k} AS we{n}")
        x, y = f"we{n}", f"wi{n}"
        for j, be in enumerate(P.BETA, start=1):
            x += f" - {_lit(be)} * cos({2 * j} * wi{n}) * sinh({2 * j} * we{n})"
            y += f" - {_lit(be)} * sin({2 * j} * wi{n}) * cosh({2 * j} * we{n})"
        b.append(f"{y} AS u{n}, {x} AS v{n}")
        c.append(
            f"asin(sin(u{n}) / cosh(v{n})) AS ch{n}, {_lit(tm.lon0)} + degrees(atan2(sinh(v{n}), cos(u{n}))) AS {ox}"
        )
        lat = f"ch{n}"
        for j, de in enumerate(P.DELTA, start=1):
            lat += f" + {_lit(de)} * sin({2 * j} * ch{n})"
        d.append(f"degrees({lat}) AS {oy}")
    return (
        f"{out}_1 AS (SELECT *, {', '.join(a)} FROM {src}),\n{out}_2 AS (SELECT *, {', '.join(b)} FROM {out}_1),\n"
        f"{out}_3 AS (SELECT *, {', '.join(c)} FROM {out}_2),\n{out} AS (SELECT *, {', '.join(d)} FROM {out}_3)"
    )


def quad_area(p: str) -> str:
    """Area of the quadrilateral of columns ``{p}x0, {p}y0 .. {p}x3, {p}y3`` relative to its first corner."""
    terms = []
    for i in range(1, 3):
        terms.append(
            f"(({p}x{i} - {p}x0) * ({p}y{i + 1} - {p}y0) - ({p}x{i + 1} - {p}x0) * ({p}y{i} - {p}y0))"
        )
    return f"abs({' + '.join(terms)}) / 2"


def segment_distance(px: str, py: str, ax: str, ay: str, bx: str, by: str) -> str:
    dx, dy = f"({bx} - {ax})", f"({by} - {ay})"
    t = f"greatest(0, least(1, (({px} - {ax}) * {dx} + ({py} - {ay}) * {dy}) / ({dx} * {dx} + {dy} * {dy})))"
    ex, ey = f"({px} - {ax} - {t} * {dx})", f"({py} - {ay} - {t} * {dy})"
    return f"sqrt({ex} * {ex} + {ey} * {ey})"


SPACES = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def term_counts(src: str, key: str, text: str = "text") -> str:
    """CTE ``terms(key, n, term, tf)`` of character n-grams inside padded words."""
    return f"""
wc AS (SELECT {key}, ' ' || w || ' ' AS w, count(*) AS k FROM (
         SELECT {key}, unnest(string_split_regex(lower({text}), '{SPACES}')) AS w FROM {src}) WHERE w <> '' GROUP BY ALL),
gr AS (SELECT {key}, k, n, substr(w, i, n) AS term FROM (
         SELECT {key}, k, w, n, unnest(range(1, length(w) - n + 2)) AS i FROM wc, (VALUES (2), (3), (4)) t(n))),
terms AS (SELECT {key}, n, term, sum(k)::BIGINT AS tf FROM gr GROUP BY ALL)"""


CHUNKS = f"""
ar AS (SELECT source AS pcode, doc_id AS article_pos, 'Law ' || source AS law_title, 'Art. ' || doc_id AS article_no,
   regexp_replace(regexp_replace('Law ' || source || ' Art. ' || doc_id || '：' || text, '^{SPACES}', ''), '{SPACES}$', '') AS body
   FROM documents),
ck AS (SELECT *, unnest(CASE WHEN length(body) <= {I.CHUNK} THEN [1] ELSE range(1, length(body) + 1, {I.CHUNK - I.OVERLAP}) END) AS pos0 FROM ar),
chunks AS (SELECT pcode, article_pos, law_title, article_no, (pos0 - 1) // {I.CHUNK - I.OVERLAP} AS piece,
   CASE WHEN length(body) <= {I.CHUNK} THEN body ELSE substr(body, pos0, {I.CHUNK}) END AS content FROM ck)"""
