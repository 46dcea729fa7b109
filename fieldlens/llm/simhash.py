"""SimHash near-duplicates by segment popcounts and a grid range join.

Every fingerprint of 64 bits is cut into segments of two bits; the number of set bits per segment is its point
in a grid. The Manhattan distance of two points is a lower bound of the Hamming distance, so fingerprints within
``distance`` bits have points within ``distance``. The range join puts the segments into ``distance + 4`` bands:
at most ``distance`` bands of two such points differ, so for some choice of ``distance`` bands all the other
bands are equal. One cell per choice and fingerprint therefore meets every partner exactly (no pair is lost), and
each cell keeps four bands of the point, which makes chance meetings rare.

Copies share one fingerprint, so only distinct fingerprints are joined. Inside a cell the links of a search tree
are kept (they reach whatever all pairs would reach, with fewer rows than members), each checked on the full
fingerprints. A cell of more than ``cell_limit`` fingerprints is not searched in one task: its members
meet through their fingerprints with every ``distance`` bits blanked, which is exact too and splits freely.

Defined cases: a null or empty text has fingerprint zero and links like any other; repeated rows get the same
class; a null id is no smallest id unless all ids of its class are null; an empty table gives an empty result; other
columns pass by unread (:func:`keep_one` hashes them), and those with the names of result columns are replaced.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldlens.llm.tables import stored, without
from fieldlens.operators.components import connected_components
from fieldlens.session import ship_package

DISTANCE = 2
SHINGLE = 3
SEED = 42
CELL_LIMIT = 20_000
_PAIRS = np.uint64(0x5555555555555555)


def fingerprint(raw: bytes, shingle: int = SHINGLE) -> int:
    """Majority of the bits of the shingles' XXH64; a bit set in exactly half of them is 0."""
    import xxhash

    words = raw.lower().split()  # bytes: only A-Z and the six ASCII separators
    if not words:
        return 0
    n = min(shingle, len(words))
    text = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(text[a:b], SEED) for a, b in zip(starts[: len(words) - n + 1].tolist(), ends[n - 1 :].tolist())), np.uint64
    )
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 15):  # bounded memory for long texts
        part = hashes[at : at + (1 << 15)].astype("<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits((2 * ones > len(hashes)).astype(np.uint8), bitorder="little")
    return int(bits.view("<u8")[0])


def with_fingerprints(docs: DataFrame, text: str = "text", out: str = "fp") -> DataFrame:
    """All columns of the input but the text, and the fingerprint as a signed long."""
    ship_package(docs.sparkSession)
    rest = [c for c in docs.columns if c not in (text, out)]
    rows = docs.select(*rest, F.col(text).cast("string").alias(text))

    def hash_texts(batches):
        from fieldlens.llm.simhash import fingerprint

        for b in batches:
            fps = [fingerprint(t.as_buffer().to_pybytes()) if t.is_valid else 0 for t in b.columns[-1]]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(np.array(fps, dtype=np.uint64).view(np.int64))], names=[*b.schema.names[:-1], out]
            )

    fields = [f for f in rows.schema.fields if f.name != text]
    return rows.mapInArrow(hash_texts, T.StructType([*fields, T.StructField(out, T.LongType())]))


def popcounts(fps: np.ndarray) -> np.ndarray:
    """Set bits per two-bit segment, still packed as 32 two-bit numbers."""
    return (fps & _PAIRS) + ((fps >> np.uint64(1)) & _PAIRS)


def band_masks(distance: int = DISTANCE) -> list[np.uint64]:
    """The bits of the kept bands, one mask per choice of left-out bands."""
    bands = distance + 4
    cut = [round(32 * k / bands) * 2 for k in range(bands + 1)]
    band = [((1 << cut[k + 1]) - 1) ^ ((1 << cut[k]) - 1) for k in range(bands)]
    return [np.uint64(sum(b for k, b in enumerate(band) if k not in out)) for out in combinations(range(bands), distance)]


def near(x: np.uint64, others: np.ndarray, distance: int = DISTANCE) -> np.ndarray:
    """Manhattan bound on the packed popcounts first, then the exact distance."""
    a, b = popcounts(np.array([x]))[0], popcounts(others)
    spread = np.zeros(len(others), dtype=np.int64)
    differs = np.flatnonzero(np.bitwise_count(a ^ b) <= 2 * distance)  # each unit of difference flips one or two bits
    for s in range(0, 64, 2):
        mine = int(a >> np.uint64(s)) & 3
        spread[differs] += np.abs(((b[differs] >> np.uint64(s)) & np.uint64(3)).astype(np.int64) - mine)
    within = differs[spread[differs] <= distance]
    return within[np.bitwise_count(others[within] ^ x) <= distance]


def tree_links(fps: np.ndarray, distance: int = DISTANCE) -> list[tuple[int, int]]:
    """Links of a search forest over distinct fingerprints: same components as all pairs within ``distance``."""
    left, links = fps.copy(), []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            hit = near(x, left, distance)
            if len(hit):
                links += [(x, y) for y in left[hit]]
                queue += list(left[hit])
                left = np.delete(left, hit)
    return links


def _cells(fps: DataFrame, distance: int) -> DataFrame:
    masks = band_masks(distance)

    def spread(batches):
        for b in batches:
            own = b.column(0).to_numpy().view(np.uint64)
            points = popcounts(own)
            for k, m in enumerate(masks):
                yield pa.record_batch(
                    [pa.array(np.full(len(own), k, np.int32)), pa.array((points & m).view(np.int64)), b.column(0)],
                    names=["choice", "cell", "fp"],
                )

    return fps.select("fp").mapInArrow(spread, "choice int, cell long, fp long")


def _search_cells(cells: DataFrame, distance: int) -> DataFrame:
    """Links inside cells; a partition is sorted by cell and read in one stream."""

    def search(batches):
        def links_of(held):
            out = tree_links(np.unique(np.concatenate(held)).view(np.uint64), distance) if held else []
            pairs = np.array(out, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            return pa.record_batch([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["src", "dst"])

        key, held = None, []
        for b in batches:
            choice, cell, fp = (c.to_numpy() for c in b.columns)
            if not len(fp):
                continue
            cut = np.flatnonzero((np.diff(cell) != 0) | (np.diff(choice) != 0)) + 1
            sizes = np.diff(np.concatenate([[0], cut, [len(fp)]]))
            begins = np.concatenate([[0], cut])
            last = len(begins) - 1
            for k in range(len(begins)):
                if 0 < k < last and sizes[k] == 1:
                    continue  # alone in its cell
                at = begins[k]
                here = (choice[at], cell[at])
                part = fp[at : at + sizes[k]]
                if here == key:
                    held.append(part)
                    continue
                if sum(map(len, held)) > 1:
                    yield links_of(held)
                key, held = here, [part]
        if sum(map(len, held)) > 1:
            yield links_of(held)

    return cells.mapInArrow(search, "src long, dst long")


def _blanked(fps: DataFrame, distance: int) -> DataFrame:
    """Exact links for crowded cells: partners agree once some ``distance`` bits are blanked."""
    masks = [int(np.uint64(~np.uint64(sum(1 << i for i in out))).view(np.int64)) for out in combinations(range(64), distance)]
    keyed = fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("choice", "cell"))
    low = keyed.groupBy("choice", "cell").agg(F.min("fp").alias("src"), F.max("fp").alias("top")).where("src < top")
    return keyed.join(low, ["choice", "cell"]).where("fp > src").select("src", F.col("fp").alias("dst")).distinct()


def links(fps: DataFrame, distance: int = DISTANCE, cell_limit: int = CELL_LIMIT) -> DataFrame:
    """Links (src, dst) between distinct fingerprints whose components are those of all pairs within ``distance``."""
    ship_package(fps.sparkSession)
    cells = _cells(fps, distance)
    crowded = cells.groupBy("choice", "cell").count().where(F.col("count") > cell_limit)
    crowded = stored(crowded.select("choice", "cell"), "crowded")
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = None
    if crowded.limit(1).count():
        hot = cells.join(crowded, ["choice", "cell"], "left_semi").select("fp").distinct()
        cells = cells.join(crowded, ["choice", "cell"], "left_anti")
    found = _search_cells(cells.repartition(parts, "choice", "cell").sortWithinPartitions("choice", "cell"), distance)
    return found if hot is None else found.unionByName(_blanked(hot, distance))


def _classed(docs: DataFrame, id_col: str, distance: int, cell_limit: int) -> DataFrame:
    """``docs`` (with ``fp``), component_id and __component, a fingerprint of the class (never null)."""
    spark = docs.sparkSession
    docs = stored(without(docs, ["component_id"]), "fingerprints")
    fps = docs.groupBy("fp").agg(F.min(id_col).alias("__low"))
    found = stored(links(fps, distance, cell_limit).distinct(), "links")
    if not found.limit(1).count():
        return docs.join(fps.select("fp", F.col("fp").alias("__component"), F.col("__low").alias("component_id")), "fp")
    members = connected_components(found, [])
    low = fps.join(members.withColumnsRenamed({"node": "fp"}), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp")
    )
    smallest = low.groupBy("component").agg(F.min("__low").alias("component_id"))
    named = low.join(smallest, "component").select("fp", F.col("component").alias("__component"), "component_id")
    return docs.join(named, "fp")


def classes(docs: DataFrame, id_col: str = "doc_id", distance: int = DISTANCE, cell_limit: int = CELL_LIMIT) -> DataFrame:
    """``docs`` (with ``fp``) and component_id, the smallest id reachable over links."""
    return _classed(docs, id_col, distance, cell_limit).drop("__component")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text", distance: int = DISTANCE) -> DataFrame:
    """One row per near-duplicate class with all its columns: the smallest id, nulls last, then the smallest hash of the row.

    Rows are told apart by two hashes of all their columns, not by the id, so null and repeated ids lose no class.
    """
    columns = docs.columns
    every = [*[F.col(c).isNull() for c in columns], *[F.col(c) for c in columns]]  # hashes skip nulls
    key = ["__h1", "__h2"]
    rows = docs.withColumns({"__h1": F.xxhash64(*every), "__h2": F.xxhash64(F.lit(1), *every)})
    found = _classed(with_fingerprints(rows.select(*dict.fromkeys([id_col, text, *key])), text), id_col, distance, CELL_LIMIT)
    lowest = found.where(F.col(id_col).eqNullSafe(F.col("component_id")))
    leaders = lowest.groupBy("__component").agg(F.min(F.struct(*key)).alias("__low")).select("__low.*")
    return (
        rows.join(leaders, key, "left_semi").groupBy(*key).agg(F.min(F.struct(*columns)).alias("__row")).select("__row.*")
    )
