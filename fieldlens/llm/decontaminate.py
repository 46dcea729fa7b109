"""Benchmark decontamination by a prefix-filtered set join.

An item's windows are its runs of 13 consecutive words (a shorter item is one window). A window can only occur
where all of its shingles do, so its rarest shingle is a necessary prefix: shingles are counted over all
documents, each window is indexed under its rarest shingle, and documents are probed with their shingles.
A hit gives the place where the window would have to lie; length and position bounds rule out places that
do not fit, and the words of the window are compared there.

The benchmark side is indexed in blocks of at most ``block_windows`` windows, so what is broadcast is bounded
whatever the size of the benchmark; every block passes over all documents. Documents are read by narrow scans;
only hits are shuffled.

Equal windows are one entry whoever holds them, candidates are compared in parts of bounded size, and hits are kept as masks, so texts of
equal words and passages that many items share cost no more than others.

Defined cases: null texts have no words, and items without words have no windows; equal items with different ids are separate items, items
with one id (or without an id: their name is empty) count once; a very long text is compared as a whole, so a task needs memory for its longest
text; repeated document rows give repeated result rows; an empty benchmark leaves all documents clean; other columns pass through unread.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldlens.llm.tables import without
from fieldlens.session import ship_package

WINDOW = 13
SHINGLE = 3
BLOCK_WINDOWS = 1_000_000
CANDIDATES = 1 << 18

# Lower-cases A-Z and blanks every ASCII byte that is no letter or digit; other bytes stay.
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(_TABLE).split()


class WindowIndex:
    """Distinct windows of one block of items, keyed by a shingle of each window.

    A window that many items share is one window with a list of items.
    """

    def __init__(self, items: list[tuple[str, list[bytes]]]):
        self.ids = [i for i, _ in items]
        vocabulary = sorted({w for _, ws in items for w in ws})
        self.code = {w: k for k, w in enumerate(vocabulary)}
        self.base = len(vocabulary) + 1
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for k, (_, ws) in enumerate(items):
            if ws:
                codes, n = self.encode(ws), min(WINDOW, len(ws))
                rows = np.lib.stride_tricks.sliding_window_view(codes, n)
                held.setdefault(n, []).append((rows, np.full(len(rows), k)))
        self.groups: dict[int, WindowGroup] = {}
        for n, parts in sorted(held.items()):
            self.groups[n] = WindowGroup(np.concatenate([r for r, _ in parts]), np.concatenate([k for _, k in parts]))
        self.sizes = sorted({min(SHINGLE, n) for n in self.groups})

    def shingles(self, codes: np.ndarray, size: int) -> np.ndarray:
        """One number per run of ``size`` codes along the last axis; -1 where a word is in no item."""
        n = codes.shape[-1] - size + 1
        if n <= 0:
            return np.empty((*codes.shape[:-1], 0), dtype=np.int64)
        part = lambda j: codes[..., j : j + n]
        if self.base ** size >= 1 << 62:  # too many words to number all runs: mix instead, the comparison decides
            out = part(0).astype(np.uint64)
            for j in range(1, size):
                out = (out * np.uint64(0x9E3779B97F4A7C15)) ^ part(j).astype(np.uint64)
            out = (out >> np.uint64(2)).astype(np.int64)
        else:
            out = part(0).copy()
            for j in range(1, size):
                out = out * self.base + part(j)
        known = part(0) >= 0
        for j in range(1, size):
            known &= part(j) >= 0
        return np.where(known, out, -1)

    def encode(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.code.get, words, _MINUS), dtype=np.int64, count=len(words))

    def all_shingles(self) -> dict[int, np.ndarray]:
        found: dict[int, list] = {s: [] for s in self.sizes}
        for n, g in self.groups.items():
            found[min(SHINGLE, n)].append(np.unique(self.shingles(g.codes, min(SHINGLE, n))))
        return {s: np.unique(np.concatenate(v)) for s, v in found.items()}

    def order(self, counts: dict[tuple[int, int], int]) -> None:
        """Index every window under its rarest shingle."""
        for n, g in self.groups.items():
            s = min(SHINGLE, n)
            own = self.shingles(g.codes, s)
            names, at = np.unique(own, return_inverse=True)
            often = np.array([counts.get((s, int(x)), 0) for x in names])[at].reshape(own.shape)
            g.index(own, often.argmin(axis=1))

    def match(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Mask of the hit words of a document, and the items whose windows occur."""
        codes = self.encode(words)
        steps, found = np.zeros(len(codes) + 1, np.int32), []
        shingles = {s: self.shingles(codes, s) for s in self.sizes}
        for n, g in self.groups.items():
            if n <= len(codes):
                at, windows = g.occurrences(codes, shingles[min(SHINGLE, n)])
                np.add.at(steps, at, 1)
                np.add.at(steps, at + n, -1)
                found += [g.items_of(w) for w in windows.tolist()]
        return np.cumsum(steps[:-1]) > 0, np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


class WindowGroup:
    """Distinct windows of one length with the items that hold them, in the order of their keys."""

    def __init__(self, codes: np.ndarray, item: np.ndarray):
        self.codes, which = np.unique(codes, axis=0, return_inverse=True)
        pairs = np.unique(np.stack([which.reshape(-1), item], axis=1), axis=0)
        self.items, self.first_item = pairs[:, 1], np.searchsorted(pairs[:, 0], np.arange(len(self.codes) + 1))

    def items_of(self, window: int) -> np.ndarray:
        return self.items[self.first_item[window] : self.first_item[window + 1]]

    def index(self, shingles: np.ndarray, offset: np.ndarray) -> None:
        key = shingles[np.arange(len(offset)), offset]
        self.by_key = np.lexsort((offset, key))
        self.offset = offset[self.by_key]
        self.keys, first = np.unique(key[self.by_key], return_index=True)
        self.first = np.append(first, len(key))

    def occurrences(self, codes: np.ndarray, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places where windows occur, and the distinct windows that do."""
        n = self.codes.shape[1]
        slot = np.minimum(np.searchsorted(self.keys, shingles), len(self.keys) - 1)
        spots = np.flatnonzero(self.keys[slot] == shingles)
        places, windows = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        per = (self.first[1:] - self.first[:-1])[slot[spots]]
        # Candidate pairs in parts of bounded size; word after word thins them out.
        cuts = np.searchsorted(np.cumsum(per), np.arange(0, per.sum(), CANDIDATES), "right")
        for lo, hi in zip(cuts, [*cuts[1:], len(spots)]):
            own = np.repeat(np.arange(lo, hi), per[lo:hi])
            entry = np.arange(len(own)) - np.repeat(np.cumsum(per[lo:hi]) - per[lo:hi], per[lo:hi]) + self.first[slot[spots[own]]]
            begin, window = spots[own] - self.offset[entry], self.by_key[entry]
            live = np.flatnonzero((begin >= 0) & (begin + n <= len(codes)))
            for j in range(n):
                live = live[codes[begin[live] + j] == self.codes[window[live], j]]
            places.append(np.unique(begin[live]))
            windows.append(np.unique(window[live]))
        return np.unique(np.concatenate(places)), np.unique(np.concatenate(windows))


class _Always:
    def __iter__(self):
        return self

    def __next__(self):
        return -1


_MINUS = _Always()


def intervals(mask: np.ndarray) -> list[list[int]]:
    """Maximal runs of set places."""
    edge = np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8))
    return np.stack([np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)], axis=1).tolist()


def _blocks(items: DataFrame, item_id: str, text: str, block_windows: int):
    """Items in blocks of bounded windows, streamed partition by partition to the driver."""
    block, size = [], 0
    named = F.coalesce(F.col(item_id).cast("string"), F.lit(""))
    for r in items.select(named.alias("i"), F.col(text).alias("t")).toLocalIterator():
        ws = words_of((r.t or "").encode())
        if not ws:
            continue
        n = max(1, len(ws) - WINDOW + 1)
        if block and size + n > block_windows:
            yield block
            block, size = [], 0
        block.append((r.i, ws))
        size += n
    if block:
        yield block


def _shingle_counts(rows: DataFrame, index: WindowIndex) -> dict[tuple[int, int], int]:
    """Occurrences of the block's shingles over all documents, summed per task before the shuffle."""
    known = index.all_shingles()
    shared = rows.sparkSession.sparkContext.broadcast((index, known))

    def count(batches):
        idx, keys = shared.value
        sums = {s: np.zeros(len(k), dtype=np.int64) for s, k in keys.items()}
        for b in batches:
            for t in b.column("text"):
                if not t.is_valid:
                    continue
                codes = idx.encode(words_of(t.as_buffer().to_pybytes()))
                for s, k in keys.items():
                    own = idx.shingles(codes, s)
                    own = own[own >= 0]
                    at = np.minimum(np.searchsorted(k, own), len(k) - 1)
                    np.add.at(sums[s], at[k[at] == own], 1)
        for s, k in keys.items():
            some = sums[s] > 0
            yield pa.record_batch(
                [pa.array(np.full(some.sum(), s, dtype=np.int32)), pa.array(k[some]), pa.array(sums[s][some])],
                names=["size", "shingle", "n"],
            )

    counted = rows.mapInArrow(count, "size int, shingle long, n long").groupBy("size", "shingle").agg(F.sum("n").alias("n"))
    return {(r["size"], r["shingle"]): r["n"] for r in counted.toLocalIterator()}


def _probe(rows: DataFrame, text: str, index: WindowIndex) -> DataFrame:
    """Adds ``__found``: number of words, hit intervals and the items found in this block."""
    shared = rows.sparkSession.sparkContext.broadcast(index)
    kind = pa.struct([("n_words", pa.int64()), ("hits", pa.list_(pa.list_(pa.int64()))), ("items", pa.list_(pa.string()))])

    def probe(batches):
        idx = shared.value
        for b in batches:
            found = []
            for t in b.column(text):
                ws = words_of(t.as_buffer().to_pybytes()) if t.is_valid else []
                mask, items = idx.match(ws)
                found.append({"n_words": len(ws), "hits": intervals(mask), "items": sorted({idx.ids[k] for k in items.tolist()})})
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, kind)], names=[*b.schema.names, "__found"])

    extra = T.StructField("__found", T.StructType.fromDDL("n_words long, hits array<array<bigint>>, items array<string>"))
    return rows.mapInArrow(probe, T.StructType([*rows.schema.fields, extra]))


def _join_blocks(parts: list[DataFrame], columns: list[str]) -> DataFrame:
    """Hits of one row in several blocks meet by the row's contents; equal rows are counted and repeated."""
    one = None
    for k, p in enumerate(parts):
        p = p.groupBy(*columns).agg(F.first("__found").alias("__found"), (F.count("*") if k == 0 else F.lit(0)).alias("__n"))
        one = p if one is None else one.unionByName(p)
    one = one.groupBy(*columns).agg(
        F.struct(
            F.first("__found.n_words").alias("n_words"),
            F.flatten(F.collect_list("__found.hits")).alias("hits"),
            F.array_distinct(F.flatten(F.collect_list("__found.items"))).alias("items"),
        ).alias("__found"),
        F.sum("__n").alias("__n"),
    )
    return one.select(
        *columns, "__found",
        F.explode(F.array_repeat(F.lit(0), F.col("__n").cast("int"))).alias("__n"),
    ).drop("__n")


def find(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """Every input row with ``__found``: n_words, n_hit, n_items, items_sha256 and contaminated. An input column of that name is replaced."""
    ship_package(docs.sparkSession)
    docs = without(docs, ["__found"])
    parts = []
    for block in _blocks(benchmark, item_id, item_text, block_windows):
        index = WindowIndex(block)
        index.order(_shingle_counts(docs.select(F.col(text).alias("text")), index))
        parts.append(_probe(docs, text, index))
    if not parts:
        parts = [_probe(docs, text, WindowIndex([]))]
    found = parts[0] if len(parts) == 1 else _join_blocks(parts, docs.columns)
    ordered = F.array_sort(F.transform("__found.hits", lambda h: F.struct(h[0].alias("a"), h[1].alias("b"))))
    zero = F.lit(0).cast("long")
    n_hit = F.aggregate(
        ordered,
        F.struct(zero.alias("n"), zero.alias("end")),
        lambda s, h: F.struct(
            (s["n"] + F.greatest(zero, h["b"] - F.greatest(h["a"], s["end"]))).alias("n"), F.greatest(s["end"], h["b"]).alias("end")
        ),
        lambda s: s["n"],
    )
    n_words = F.col("__found.n_words")
    return found.withColumn("__hit", n_hit).withColumn("__found", F.struct(
        n_words.alias("n_words"),
        F.col("__hit").alias("n_hit"),
        F.size("__found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("__found.items"), ","), 256).alias("items_sha256"),
        ((F.col("__hit") > 0) & (20 * F.col("__hit") >= n_words)).alias("contaminated"),
    )).drop("__hit")


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", **kwargs) -> DataFrame:
    """The rows that are not contaminated, with all their columns."""
    moved = {"__found": "__in_found"} if "__found" in docs.columns else {}
    kept = find(docs.withColumnsRenamed(moved), benchmark, text, **kwargs).where("NOT __found.contaminated").drop("__found")
    return kept.withColumnsRenamed({v: k for k, v in moved.items()})


def brute_force(docs: list[tuple], items: list[tuple]) -> list[tuple]:
    """Plain definition, for tests: (id, n_words, n_hit, n_items, items_sha256, contaminated)."""
    split = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    windows = {}
    for i, t in items:
        ws = split.findall((t or "").translate(low))
        for a in range(max(1, len(ws) - WINDOW + 1) if ws else 0):
            windows.setdefault(tuple(ws[a : a + WINDOW]), []).append("" if i is None else i)
    out = []
    for d, t in docs:
        ws, hit, found = split.findall((t or "").translate(low)), set(), []
        for w, ids in windows.items():
            for a in range(len(ws) - len(w) + 1):
                if tuple(ws[a : a + len(w)]) == w:
                    hit.update(range(a, a + len(w)))
                    found += ids
        names = ",".join(sorted({str(i) for i in found}))
        out.append((d, len(ws), len(hit), len(set(found)), hashlib.sha256(names.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(ws)))
    return out
