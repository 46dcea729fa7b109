"""Ranked lexical search with range maxima: the best documents of every item, exactly.

1. One scan cuts the documents into blocks of about ``block_bytes`` of text and writes an inverted index of the terms that the items use:
   per block the postings of each term. Document counts per term, the number of documents and of terms are summed from it in Spark.
2. In a block every posting has an impact, and a sparse table gives the greatest impact of any range of a posting list. The documents of
   the block, longest first, are one interval. For an item an interval is bounded by the sum of the range maxima of its terms.
   The best interval is split at the document with the greatest impact in it: that document is scored exactly and the two rests
   are bounded anew. Intervals whose bound is below the k-th best score so far go. Intervals of all items of a block take their steps together.
3. A first pass stops after k documents per item and block. The k-th best of these scores over all blocks is a floor that
   holds for the whole corpus; with it the second pass rules most blocks out at their first bound.

Equal bounds are followed up, so ties are found; the last choice (score, then id) is a ranked window in Spark, which limits its groups per task. Items come to the driver in
blocks of at most ``block_terms`` terms, so what is broadcast is bounded; documents are read once per block of items. A frequent term is a long
posting list in every block and no group anywhere; equal texts only add rows.

Integers throughout but for the logarithm in a term's weight.

Defined cases: a null or empty text has no terms and is never ranked; an item without terms has no rows; repeated items are ranked alike, each
with its own rows; repeated document rows are ranked as several documents; equal scores go by ascending id, null ids last; ids of any type
that Spark and Arrow can order; a task needs memory for its longest text's terms; empty tables give an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldlens.llm.tables import memory_returned, stored
from fieldlens.session import ship_package

TOP = 20
BLOCK_BYTES = 8 << 20
BLOCK_TERMS = 1_000_000
LEAF = 6
STEP = 64  # intervals of an item that are split together

# Lower-cases A-Z and blanks every ASCII byte that is no letter or digit; other bytes stay.
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def terms_of(raw: bytes) -> list[bytes]:
    return raw.translate(_TABLE).split()


def weight(n_docs: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding + 1)))


def length_factor(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """100 - 25 + 25 n N / L, rounded down."""
    if len(n) and 25 * int(n.max()) * n_docs >= 1 << 63:
        return np.array([75 + 25 * int(x) * n_docs // n_terms for x in n], np.int64)
    return 75 + 25 * n * n_docs // n_terms


class Items:
    """A block of items: distinct terms with their number in each item."""

    def __init__(self, items: list[list[bytes]]):
        self.vocabulary = {t: k for k, t in enumerate(sorted({t for ts in items for t in ts}))}
        rows = []
        for k, ts in enumerate(items):
            code, times = np.unique(np.array([self.vocabulary[t] for t in ts], np.int64), return_counts=True)
            rows.append(np.stack([np.full(len(code), k), code, times], axis=1))
        self.item, self.term, self.times = np.concatenate(rows).T.copy() if rows else np.zeros((3, 0), np.int64)
        self.n = len(items)


def item_blocks(items: DataFrame, item_id: str, text: str, block_terms: int):
    """Ids and terms of the items that have terms, streamed partition by partition to the driver."""
    block, size = [], 0
    for r in items.select(F.col(item_id).alias("i"), F.col(text).cast("string").alias("t")).toLocalIterator():
        ts = terms_of((r.t or "").encode())
        if not ts:
            continue
        if block and size + len(ts) > block_terms:
            yield block
            block, size = [], 0
        block.append((r.i, ts))
        size += len(ts)
    if block:
        yield block


def build_index(docs: DataFrame, id_col: str, text: str, items: Items, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per block of documents: ids by place (longest text first), their order, lengths, and postings by term."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(items.vocabulary)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).cast("string").alias("text"))
    schema = T.StructType([
        T.StructField("ids", T.ArrayType(rows.schema["id"].dataType)),
        *T.StructType.fromDDL(
            "id_rank binary, n binary, terms array<int>, df array<int>, places binary, tf binary, n_docs long, n_terms long").fields,
    ])

    def block(ids, lengths, found):
        ids = pa.concat_arrays(ids)
        n = np.array(lengths, np.int64)
        by_id = pc.sort_indices(ids, sort_keys=[("", "ascending")], null_placement="at_end").to_numpy()
        rank = np.empty(len(n), np.int64)
        rank[by_id] = np.arange(len(n))
        order = np.lexsort((rank, -n))
        place = np.empty(len(n), np.int64)
        place[order] = np.arange(len(n))
        terms = np.concatenate(found)
        doc = np.repeat(place, [len(f) for f in found])
        key, tf = np.unique(terms * len(n) + doc, return_counts=True)
        term, df = np.unique(key // len(n), return_counts=True)
        return pa.RecordBatch.from_arrays([
            pa.ListArray.from_arrays(pa.array([0, len(n)], pa.int32()), ids.take(pa.array(order))),
            pa.array([rank[order].astype("<i4").tobytes()], pa.binary()), pa.array([n[order].astype("<i8").tobytes()], pa.binary()),
            pa.array([term], pa.list_(pa.int32())), pa.array([df], pa.list_(pa.int32())),
            pa.array([(key % len(n)).astype("<i4").tobytes()], pa.binary()), pa.array([tf.astype("<i4").tobytes()], pa.binary()),
            pa.array([len(n)], pa.int64()), pa.array([int(n.sum())], pa.int64()),
        ], names=[f.name for f in schema.fields])

    def index(batches):
        number = shared.value.get
        ids, lengths, found, size = [], [], [], 0
        for b in batches:
            texts, from_ = b.column("text"), 0
            for k in range(b.num_rows):
                raw = texts[k].as_buffer().to_pybytes() if texts[k].is_valid else b""
                ts = terms_of(raw)
                if not ts:
                    ids.append(b.column("id").slice(from_, k - from_))
                    from_ = k + 1
                    continue
                codes = np.fromiter(map(number, ts, repeat(-1)), np.int64, len(ts))
                found.append(codes[codes >= 0])
                lengths.append(len(ts))
                size += len(raw)
                if size >= block_bytes:
                    ids.append(b.column("id").slice(from_, k + 1 - from_))
                    from_ = k + 1
                    yield block(ids, lengths, found)
                    ids, lengths, found, size = [], [], [], 0
            ids.append(b.column("id").slice(from_))
        if lengths:
            yield memory_returned(block(ids, lengths, found))

    return stored(rows.mapInArrow(index, schema), "postings")


class Block:
    """Postings of one block with impacts and range maxima, for the terms of the items."""

    def __init__(self, row: dict, weights: np.ndarray, items: Items, n_docs: int, n_terms: int):
        n = np.frombuffer(row["n"], "<i8")
        self.size = len(n)
        self.id_rank = np.frombuffer(row["id_rank"], "<i4")
        terms, df = row["terms"], row["df"]
        self.cuts = np.concatenate([[0], np.cumsum(df)]).astype(np.int64)
        place = np.frombuffer(row["places"], "<i4").astype(np.int64)
        tf = np.frombuffer(row["tf"], "<i4").astype(np.int64)
        term = np.repeat(np.arange(len(terms)), df)
        m = length_factor(n, n_docs, n_terms)[place]
        self.impact = weights[terms][term] * (1_000_000_000 * tf // (1000 * tf + 12 * m))
        self.key = term * self.size + place
        self.place = place
        # Greatest impact of 2^k postings from each one on. A range is inside one list, so lists can share the tables.
        self.most = [np.arange(len(place), dtype=np.int32)]
        width, longest = 1, int(df.max(initial=0))
        while 2 * width <= longest:
            a, b = self.most[-1][:-width], self.most[-1][width:]
            self.most.append(np.where(self.impact[a] >= self.impact[b], a, b))
            width *= 2
        # Terms of each item that occur here, item by item.
        local = np.full(len(weights), -1)
        local[terms] = np.arange(len(terms))
        here = local[items.term] >= 0
        self.term, self.times = local[items.term[here]], items.times[here]
        self.item_cuts = np.searchsorted(items.item[here], np.arange(items.n + 1))

    def _spread(self, item: np.ndarray):
        """Rows (interval, term of its item): the interval of each row, the place of the item's term, first row of each interval."""
        n = self.item_cuts[item + 1] - self.item_cuts[item]
        first = np.concatenate([[0], np.cumsum(n)])
        own = np.repeat(np.arange(len(item)), n)
        at = np.arange(first[-1]) - np.repeat(first[:-1] - self.item_cuts[item], n)
        return own, at, first[:-1]

    def bounds(self, item: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sum of the terms' greatest impacts in each interval, and the document with the greatest one."""
        own, at, first = self._spread(item)
        base = self.term[at] * self.size
        left = np.searchsorted(self.key, base + lo[own])
        n = np.searchsorted(self.key, base + hi[own]) - left
        some = np.flatnonzero(n > 0)
        left, n = left[some], n[some]
        level = np.frexp(n.astype(np.float64))[1] - 1
        best = np.empty(len(some), np.int64)
        for k in np.unique(level).tolist():
            own_level = np.flatnonzero(level == k)
            a = self.most[k][left[own_level]]
            b = self.most[k][left[own_level] + n[own_level] - (1 << k)]
            best[own_level] = np.where(self.impact[a] >= self.impact[b], a, b)
        value = np.zeros(len(own), np.int64)
        value[some] = self.impact[best] * self.times[at[some]]
        doc = np.zeros(len(own), np.int64)
        doc[some] = self.place[best]
        total = np.add.reduceat(value, first) if len(first) else value
        top = np.maximum.reduceat(value, first) if len(first) else value
        is_top = np.flatnonzero(value == top[own])
        _, at_first = np.unique(own[is_top], return_index=True)
        return total, doc[is_top[at_first]]

    def scores(self, item: np.ndarray, doc: np.ndarray) -> np.ndarray:
        own, at, first = self._spread(item)
        want = self.term[at] * self.size + doc[own]
        p = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
        value = np.where(self.key[p] == want, self.impact[p] * self.times[at], 0)
        return np.add.reduceat(value, first) if len(first) else value

    def search(self, floor: np.ndarray, top: int, first_only: bool = False):
        """Items, documents and scores of the best documents here, of those that reach the floor of their item."""
        item = np.flatnonzero(np.diff(self.item_cuts) > 0)
        lo, hi = np.zeros(len(item), np.int64), np.full(len(item), self.size)
        bound, doc = self.bounds(item, lo, hi)
        limit = np.maximum(floor, 1)
        got = [np.zeros(0, np.int64)] * 3  # item, document, score
        while True:
            open_ = bound >= limit[item]
            item, lo, hi, bound, doc = (x[open_] for x in (item, lo, hi, bound, doc))
            if not len(item):
                break
            order = np.lexsort((-bound, item))
            heads = np.searchsorted(item[order], item[order])
            now = np.zeros(len(item), bool)
            now[order[np.arange(len(order)) - heads < STEP]] = True
            leaf = now & (hi - lo <= LEAF)
            split = now & ~leaf
            n = (hi - lo)[leaf]
            whole = np.repeat(lo[leaf], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            seen_item = np.concatenate([item[split], np.repeat(item[leaf], n)])
            seen_doc = np.concatenate([doc[split], whole])
            seen = [seen_item, seen_doc, self.scores(seen_item, seen_doc)]
            got = [np.concatenate(x) for x in zip(got, seen)]
            order = np.lexsort((self.id_rank[got[1]], -got[2], got[0]))
            got = [x[order] for x in got]
            rank = np.arange(len(order)) - np.searchsorted(got[0], got[0])
            last = rank == top - 1
            limit[got[0][last]] = np.maximum(limit[got[0][last]], got[2][last])
            keep = (rank < top) & (got[2] >= limit[got[0]])
            got = [x[keep] for x in got]
            parts = [
                (item[split], lo[split], doc[split]), (item[split], doc[split] + 1, hi[split]),
            ]
            new_item, new_lo, new_hi = (np.concatenate(x) for x in zip(*parts))
            some = new_hi > new_lo
            if first_only:  # an item is done once it has ``top`` scores
                some &= limit[new_item] <= np.maximum(floor, 1)[new_item]
                now |= limit[item] > np.maximum(floor, 1)[item]
            new_item, new_lo, new_hi = new_item[some], new_lo[some], new_hi[some]
            new_bound, new_doc = self.bounds(new_item, new_lo, new_hi)
            item, lo, hi, bound, doc = (
                np.concatenate([a[~now], b])
                for a, b in zip((item, lo, hi, bound, doc), (new_item, new_lo, new_hi, new_bound, new_doc))
            )
        return got


def _blocks_of(batches, weights, items, n_docs, n_terms):
    for b in batches:
        for k in range(b.num_rows):
            row = {c: b.column(c)[k].as_buffer() for c in ("id_rank", "n", "places", "tf")}
            row |= {c: b.column(c)[k].values.to_numpy().astype(np.int64) for c in ("terms", "df")}
            if len(row["terms"]):
                yield Block(row, weights, items, n_docs, n_terms), b.column("ids")[k].values


def _highest(found: list[np.ndarray], top: int) -> list[np.ndarray]:
    order = np.lexsort((-found[1], found[0]))
    found = [x[order] for x in found]
    keep = np.arange(len(order)) - np.searchsorted(found[0], found[0]) < top
    return [x[keep] for x in found]


def search(
    docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", block_bytes: int = BLOCK_BYTES, block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """Per item its ``top`` documents with a score above 0: item id, rank from 1, document id, score."""
    results = [
        _search_block(docs, block, items.schema[item_id].dataType, top, id_col, text, item_id, block_bytes)
        for block in item_blocks(items, item_id, item_text, block_terms)
    ]
    if not results:
        types = items.schema[item_id].dataType.simpleString(), docs.schema[id_col].dataType.simpleString()
        return docs.sparkSession.createDataFrame([], f"`{item_id}` {types[0]}, rank int, `{id_col}` {types[1]}, score long")
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    return out


def _search_block(docs, block, item_type, top, id_col, text, item_id, block_bytes) -> DataFrame:
    spark = docs.sparkSession
    items = Items([ts for _, ts in block])
    index = build_index(docs, id_col, text, items, block_bytes)
    n_docs, n_terms = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    holding = index.select(F.explode(F.arrays_zip("terms", "df")).alias("x")).groupBy("x.terms").agg(F.sum("x.df").alias("df"))
    weights = np.zeros(len(items.vocabulary), np.int64)
    for t, df in holding.toLocalIterator():  # no more rows than the items have terms
        weights[t] = weight(n_docs, df)
    shared = spark.sparkContext.broadcast((items, weights, n_docs or 0, n_terms or 0))
    blocks = index.drop("n_docs", "n_terms")

    def first_scores(batches):
        its, ws, nd, nt = shared.value
        found = [np.zeros(0, np.int64)] * 2
        for one, _ in _blocks_of(batches, ws, its, nd, nt):
            item, _, score = one.search(np.zeros(its.n, np.int64), top, first_only=True)
            found = _highest([np.concatenate(x) for x in zip(found, (item, score))], top)
        yield memory_returned(pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["item", "score"]))

    ranked = Window.partitionBy("item").orderBy(F.col("score").desc())
    firsts = blocks.drop("ids").withColumn("ids", F.expr("array()").cast(index.schema["ids"].dataType))
    firsts = firsts.mapInArrow(first_scores, "item long, score long").withColumn("rank", F.row_number().over(ranked))
    floor = np.zeros(items.n, np.int64)
    for r in firsts.where(F.col("rank") == top).toLocalIterator():  # one row per item
        floor[r["item"]] = r["score"]
    floors = spark.sparkContext.broadcast(floor)
    kind = index.schema["ids"].dataType.elementType

    def best(batches):
        its, ws, nd, nt = shared.value
        low = floors.value.copy()
        found = [np.zeros(0, np.int64)] * 2
        for one, ids in _blocks_of(batches, ws, its, nd, nt):
            item, doc, score = one.search(low, top)
            yield pa.RecordBatch.from_arrays([pa.array(item), ids.take(pa.array(doc)), pa.array(score)], names=["item", "id", "score"])
            # What this task has found so far is a floor for its other blocks.
            found = _highest([np.concatenate(x) for x in zip(found, (item, score))], top)
            last = np.flatnonzero(np.arange(len(found[0])) - np.searchsorted(found[0], found[0]) == top - 1)
            low[found[0][last]] = np.maximum(low[found[0][last]], found[1][last])

    schema = T.StructType([T.StructField("item", T.LongType()), T.StructField("id", kind), T.StructField("score", T.LongType())])
    ranked = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    hits = blocks.mapInArrow(best, schema).withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)
    named = T.StructType([T.StructField("item", T.LongType()), T.StructField("name", item_type)])
    names = spark.createDataFrame([(k, i) for k, (i, _) in enumerate(block)], named)
    return hits.join(F.broadcast(names), "item").select(
        F.col("name").alias(item_id), F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")
