"""Text retrieval: chunks, TF-IDF, latent semantic vectors and cosine top-k."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldlens.functions import text as X
from fieldlens.operators.ranking import rank_rows, running_total
from fieldlens.operators.topk import stored_blocks, topk_sparse, topk_vectors
from fieldlens.session import cut_lineage, ship_package, stored

# N-gram lengths, vocabulary limit, vector length.
NGRAM_LOW, NGRAM_HIGH = 2, 4
MAX_FEATURES = 60000
EMBED_DIM = 384


# ------------------------------------------------------------------ chunks


def chunk_articles(articles: DataFrame, size: int = 600, overlap: int = 80) -> DataFrame:
    """Chunk articles (``pcode, law_title, article_pos, article_no, text``) with a running index per code.

    The index comes from running totals over slim rows, so a code that holds most articles is not
    collected anywhere, and texts do not take part in the ordering.
    """
    body = X.strip(X.chunk_body(F.col("law_title"), F.col("article_no"), F.col("text")))
    bodies = articles.select("pcode", "law_title", "article_pos", "article_no", body.alias("body"))
    counts = bodies.select("pcode", "article_pos", X.chunk_count(F.col("body"), size, overlap).alias("n"))
    starts = running_total(counts, ["pcode"], [F.col("article_pos")], F.col("n"), "until")
    starts = starts.select("pcode", "article_pos", (F.col("until") - F.col("n")).alias("start"))
    return (
        bodies.join(starts, ["pcode", "article_pos"])
        .select(
            "pcode", "law_title", "article_pos", "article_no", "start",
            F.posexplode(X.chunks(F.col("body"), size, overlap)).alias("piece", "content"),
        )
        .select(
            "pcode", "law_title", "article_no", (F.col("start") + F.col("piece")).alias("chunk_index"), "content"
        )
    )


# ------------------------------------------------------------------ TF-IDF


_WORD_MEMO = 300_000  # Nothing is remembered per word any more; a test still sets this name.
_FLUSH_TERMS = 200_000
_PIECE_CHARS = 1 << 19
_PLACES = 1 << 22


def _numbered(key: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, all below ``size``, numbered in order, and a place where each stands. Keys are looked up in a table where it is small."""
    places = np.arange(len(key), dtype=np.int32)
    if size > max(_PLACES, 4 * len(key)):
        ids, distinct = pd.factorize(key, sort=True)
        at = np.empty(len(distinct), dtype=np.int32)
        at[ids] = places
        return ids.astype(np.int32), at
    table = np.full(size, -1, dtype=np.int32)
    table[key] = places
    found = np.flatnonzero(table >= 0)
    at = table[found]
    table[found] = np.arange(len(found), dtype=np.int32)
    return table[key], at


def gram_block(texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """The distinct character n-grams of texts, by length and character; where the numbers of each text end, these numbers (ascending in a text), and
    their counts.

    N-grams are taken inside words padded with one space on both sides; a word no longer than n gives itself once and no longer grams
    (padded words have at least three characters). An n-gram is numbered from the number of its first n - 1 characters and its last one.
    """
    padded = [f" {' '.join(words)} " if (words := (t or "").lower().split()) else "" for t in texts]
    joined = "".join(padded)
    code = np.frombuffer(joined.encode("utf-32-le"), "<u4")
    present = np.zeros(int(code.max(initial=ord(" "))) + 1, dtype=bool)
    present[code] = True
    number = np.cumsum(present, dtype=np.int32) - np.int32(1)
    code, space, chars = number[code], number[ord(" ")], int(number[-1]) + 1
    blank = code == space
    starts = np.cumsum([0, *map(len, padded)])
    # Words share the space between them and texts meet at two, so a window is inside a word if no blank stands inside it and it is not two blanks.
    at = np.flatnonzero(~(blank[:-1] & blank[1:])).astype(np.int32)
    ids, size = code[at], chars
    terms, levels, cuts = [], [], []
    for n in range(2, NGRAM_HIGH + 1):
        if n > 2:
            inside = ~blank[at + np.int32(n - 2)]
            at, ids = at[inside], ids[inside]
        wide = np.int32 if size * chars < 1 << 31 else np.int64
        ids, first = _numbered(ids.astype(wide, copy=False) * wide(chars) + code[at + np.int32(n - 1)], size * chars)
        size = len(first)
        if n >= NGRAM_LOW:
            levels.append(ids + np.int32(len(terms)))
            cuts.append(np.searchsorted(at, starts).tolist())
            terms += [joined[i : i + n] for i in at[first].tolist()]
    ends, cols, tf = _counted(levels, cuts, len(texts), len(terms))
    return terms, ends, cols, tf


def _counted(levels: list[np.ndarray], cuts: list[list[int]], n: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct numbers below ``size`` and their counts for each of ``n`` texts, whose numbers stand between their cuts in every level."""
    if n * size > 16 * sum(map(len, levels)):  # short texts: ordered, since a count of all numbers a text would be long
        own = [np.repeat(np.arange(n), np.diff(c)) for c in cuts]
        key, tf = np.unique(np.concatenate(own) * max(1, size) + np.concatenate(levels), return_counts=True)
        own, cols = np.divmod(key, max(1, size))
        return np.cumsum(np.bincount(own, minlength=n)), cols, tf
    found, tf = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    for d in range(n):
        per = np.bincount(np.concatenate([ids[c[d] : c[d + 1]] for ids, c in zip(levels, cuts)]))
        found.append(np.flatnonzero(per != 0))
        tf.append(per[found[-1]])
    return np.cumsum([len(f) for f in found])[1:], np.concatenate(found), np.concatenate(tf)


def _renumbered(number: np.ndarray, ends: np.ndarray, ids: np.ndarray, tf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The counts of a block under other numbers of its terms; terms with a number below zero go."""
    cols = number[ids]
    known = cols >= 0
    if known.all():
        return ends, cols, tf
    return np.concatenate([[0], np.cumsum(known)])[ends], cols[known], tf[known]


def _per_text(ends: np.ndarray, *values: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    at = [0, *ends.tolist()]
    return (tuple(v[a:b] for v in values) for a, b in zip(at, at[1:]))


class GramTable:
    """Numbers of character n-grams. With a given index unknown grams are ignored, otherwise every new gram gets the next number."""

    def __init__(self, index: dict[str, int] | None = None):
        self.open = index is None
        self.index = defaultdict() if index is None else index
        if self.open:
            self.index.default_factory = self.index.__len__

    def numbers(self, grams: list[str]) -> np.ndarray:
        index = self.index
        return np.array([index[g] for g in grams] if self.open else [index.get(g, -1) for g in grams], dtype=np.int32)

    def rows(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Distinct gram numbers of every text, ascending, and their counts. The grams of all these texts are looked up together."""
        grams, *block = gram_block(texts)
        for cols, tf in _per_text(*_renumbered(self.numbers(grams), *block)):
            by = np.argsort(cols)
            yield cols[by], tf[by]

    def counts(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Distinct gram numbers of a text, ascending, and their counts."""
        return next(self.rows([text]))


def _cuts(sizes: Iterable[int]) -> Iterator[tuple[int, int]]:
    """Ranges of texts, of these numbers of characters, with about ``_PIECE_CHARS`` at most (or one text), so that what a worker
    holds does not depend on the size of a batch."""
    start = size = stop = 0
    for i, own in enumerate(sizes):
        if i > start and size + own > _PIECE_CHARS:
            yield start, i
            start, size = i, 0
        size += own
        stop = i + 1
    if stop:
        yield start, stop


def _pieces(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """The batches in slices of bounded size, and their texts; only the texts of one slice are Python objects at a time."""
    for b in batches:
        sizes = pc.fill_null(pc.utf8_length(b.column(text)), 0).to_pylist()
        for start, stop in _cuts(sizes):
            part = b.slice(start, stop - start)
            yield part, part.column(text).to_pylist()


def _by_term(part: pa.RecordBatch, key: str, terms: pa.Array, rows: list, name: str) -> pa.RecordBatch:
    """``key, term`` and the values of ``rows`` (term numbers, values), one row per text and term."""
    own = np.repeat(np.arange(len(rows)), [len(i) for i, _ in rows])
    ids = np.concatenate([i for i, _ in rows])
    return pa.RecordBatch.from_arrays(
        [part.column(key).take(pa.array(own)), terms.take(pa.array(ids)), pa.array(np.concatenate([v for _, v in rows]))], names=[key, "term", name]
    )


def gram_counts(text: str) -> dict[str, int]:
    table = GramTable()
    ids, tf = table.counts(text)
    names = list(table.index)
    return {names[i]: int(k) for i, k in zip(ids, tf)}


def term_counts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``key, term, tf`` per document: counted inside the Arrow batch, so nothing is shuffled; a batch goes out in pieces.

    (Exploding the grams JVM-side took twice as long and shuffles ten times the text.)
    """
    ship_package(docs.sparkSession)
    schema = f"{key} {docs.schema[key].dataType.simpleString()}, term string, tf long"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _pieces(batches, text):
            grams, *block = gram_block(texts)
            yield _by_term(part, key, pa.array(grams, pa.string()), list(_per_text(*block)), "tf")

    return docs.select(key, text).mapInArrow(count, schema)


def _totals(blocks: Iterable[tuple[list[str], np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """``term, df, tf`` added up over blocks of terms, texts that have them and counts; a table of many terms goes out."""

    def out() -> pa.RecordBatch:
        n = len(table.index)
        return pa.RecordBatch.from_arrays(
            [pa.array(list(table.index), pa.string()), pa.array(total[0, :n]), pa.array(total[1, :n])], names=["term", "df", "tf"]
        )

    table, total = GramTable(), np.zeros((2, 1 << 16), dtype=np.int64)
    for grams, df, tf in blocks:
        ids = table.numbers(grams)
        if len(table.index) > total.shape[1]:
            total = np.pad(total, ((0, 0), (0, len(table.index))))
        total[0, ids] += df
        total[1, ids] += tf
        if len(table.index) > _FLUSH_TERMS:
            yield out()
            table, total = GramTable(), np.zeros((2, 1 << 16), dtype=np.int64)
    if table.index:
        yield out()


def _sums(grams: list[str], ids: np.ndarray, tf: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
    return grams, np.bincount(ids, minlength=len(grams)), np.bincount(ids, tf, len(grams)).astype(np.int64)


def _added(totals: DataFrame) -> DataFrame:
    return totals.groupBy("term").agg(F.sum("df").alias("df"), F.sum("tf").alias("corpus_tf"))


_TOTALS = "term string, df long, tf long"


def term_stats(docs: DataFrame, text: str) -> DataFrame:
    """``term, df, corpus_tf`` over all documents; each task adds up before it emits."""
    ship_package(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted = (gram_block(texts) for _, texts in _pieces(batches, text))
        return _totals(_sums(grams, ids, tf) for grams, _, ids, tf in counted)

    return _added(docs.select(text).mapInArrow(count, _TOTALS))


def vocabulary(docs: DataFrame, text: str, max_features: int | None = MAX_FEATURES) -> DataFrame:
    """``term, df, corpus_tf, idf`` of all terms, or of the ``max_features`` most frequent ones (ties by term).

    The cut is found from a histogram of the counts; only the terms that share the count at the cut are ordered, by ranges. No task
    and no driver sees the candidates of all partitions.
    """
    return _with_idf(cut_lineage(term_stats(docs, text)), docs.agg(F.count("*").alias("n_docs")), max_features)


def _with_idf(stats: DataFrame, total: DataFrame, max_features: int | None) -> DataFrame:
    kept = stats if max_features is None else _most_frequent(stats, max_features)
    idf = F.log((F.lit(1.0) + F.col("n_docs")) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)
    return kept.crossJoin(F.broadcast(total)).withColumn("idf", idf).drop("n_docs")


def _most_frequent(stats: DataFrame, limit: int) -> DataFrame:
    hist = stats.groupBy("corpus_tf").agg(F.count("*").alias("n"))
    reached = running_total(hist, [], [F.desc("corpus_tf")], F.col("n"), "until").where(F.col("until") >= limit)
    at = reached.agg(F.max_by(F.struct("corpus_tf", "n", "until"), F.col("corpus_tf")).alias("cut")).first().cut
    if at is None:  # fewer terms than the limit
        return stats
    above = stats.where(F.col("corpus_tf") > at.corpus_tf)
    ties = stats.where(F.col("corpus_tf") == at.corpus_tf)
    if at.until > limit:
        rest = limit - (at.until - at.n)
        ties = rank_rows(ties, [], [F.col("term")], "__rank").where(F.col("__rank") <= rest).drop("__rank")
    return above.unionByName(ties.select(above.columns))


HOT_TERMS = 1 << 19


def joined_weights(docs: DataFrame, key: str, text: str, vocab: DataFrame) -> DataFrame:
    """``key, term, weight``: L2-normalised TF-IDF weights for a vocabulary of any size; texts that share a key share its norm.

    Terms of more than one in ``HOT_TERMS`` of all (document, term) rows are fewer than ``HOT_TERMS`` whatever the input: all workers have
    them, so their rows are weighed where they are counted and never shuffled. Only rows of the rarer terms meet their terms by shuffle. The norms
    go to the texts, which are counted again, as a text is a small part of its rows.
    """
    spark = docs.sparkSession
    ship_package(spark)
    total = vocab.agg(F.sum("df")).first()[0] or 0
    is_hot = F.col("df") * HOT_TERMS > total
    shared = spark.sparkContext.broadcast(_model(vocab.where(is_hot)))
    kind = docs.schema[key].dataType.simpleString()

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for part, texts in _pieces(batches, text):
            grams, ends, ids, tf = gram_block(texts)
            cols = m.columns(grams)[ids]
            own, hot = _owners(ends), cols >= 0
            w = tf[hot] * m.idf[cols[hot]]
            square = np.bincount(own[hot], w * w, len(texts)).astype(np.float64)
            rows = [part.column(key), pa.nulls(len(texts), pa.string()), pa.nulls(len(texts), pa.int64()), pa.array(square)]
            yield pa.RecordBatch.from_arrays(rows, names=[key, "term", "tf", "square"])
            own, ids, tf = own[~hot], ids[~hot], tf[~hot]
            rows = [part.column(key).take(pa.array(own)), pa.array(grams, pa.string()).take(pa.array(ids)), pa.array(tf), pa.nulls(len(own), pa.float64())]
            yield pa.RecordBatch.from_arrays(rows, names=[key, "term", "tf", "square"])

    # A row per text with the square of its hot part, and the rows of the rarer terms.
    slim = docs.select(key, text)
    parts = stored(slim.mapInArrow(split, f"{key} {kind}, term string, tf long, square double"), "tfidf_parts")
    rare = parts.where("term IS NOT NULL").join(vocab.where(~is_hot).select("term", "idf"), "term").select(key, "term", (F.col("tf") * F.col("idf")).alias("w"))
    squares = parts.where("term IS NULL").select(key, "square").unionByName(rare.select(key, (F.col("w") * F.col("w")).alias("square")))
    norms = squares.groupBy(F.col(key).alias("__key")).agg(F.sqrt(F.sum("square")).alias("norm"))

    def with_norm(df: DataFrame) -> DataFrame:
        # The norms are hashed, so texts are dealt out but not sorted.
        return df.join(norms.hint("shuffle_hash"), F.col(key).eqNullSafe(F.col("__key"))).drop("__key")

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for part, texts in _pieces(batches, text):
            grams, ends, ids, tf = gram_block(texts)
            cols = m.columns(grams)[ids]
            hot = cols >= 0
            own = _owners(ends)[hot]
            w = tf[hot] * m.idf[cols[hot]] / part.column("norm").to_numpy(zero_copy_only=False)[own]
            rows = [part.column(key).take(pa.array(own)), pa.array(grams, pa.string()).take(pa.array(ids[hot])), pa.array(w)]
            yield pa.RecordBatch.from_arrays(rows, names=[key, "term", "weight"])

    common = with_norm(slim).mapInArrow(weigh, f"{key} {kind}, term string, weight double")
    return common.unionByName(with_norm(rare).select(key, "term", (F.col("w") / F.col("norm")).alias("weight")))


def _owners(ends: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))


@dataclass
class TfidfModel:
    """Fitted vocabulary: term -> (column, idf); at most ``max_features`` entries."""

    index: dict[str, int] = field(repr=False)
    idf: np.ndarray = field(repr=False)

    table: GramTable | None = field(default=None, repr=False)

    def __getstate__(self):
        return {"index": self.index, "idf": self.idf, "table": None}

    def counts(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Columns and term counts of every text; terms outside the vocabulary are ignored."""
        if self.table is None:
            self.table = GramTable(self.index)
        return self.table.rows(texts)

    def columns(self, grams: list[str]) -> np.ndarray:
        """Columns of terms, below zero outside the vocabulary."""
        return GramTable(self.index).numbers(grams)

    def weigh(self, cols: np.ndarray, tf: np.ndarray) -> np.ndarray:
        w = tf * self.idf[cols]
        size = np.sqrt(w @ w)
        return w / size if size > 0 else w

    def sparse_rows(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Columns and unit-length weights of every text."""
        return ((cols, self.weigh(cols, tf)) for cols, tf in self.counts(texts))

    def sparse(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Columns and unit-length weights of a text; terms outside the vocabulary are ignored."""
        return next(self.sparse_rows([text]))


def fit_tfidf(docs: DataFrame, text: str, max_features: int = MAX_FEATURES) -> TfidfModel:
    """Fit on all documents; only the bounded vocabulary reaches the driver."""
    return _model(vocabulary(docs, text, max_features))


def _model(vocab: DataFrame) -> TfidfModel:
    rows = vocab.select("term", "idf").toPandas().sort_values("term")
    return TfidfModel({t: i for i, t in enumerate(rows["term"])}, rows["idf"].to_numpy(dtype="float64"))


def tfidf_weights(docs: DataFrame, key: str, text: str, model: TfidfModel) -> DataFrame:
    """``key, term, weight``: L2-normalised TF-IDF weights in one narrow pass."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = f"{key} {docs.schema[key].dataType.simpleString()}, term string, weight double"

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        names = pa.array(sorted(m.index, key=m.index.get), pa.string())
        for part, texts in _pieces(batches, text):
            yield _by_term(part, key, names, list(m.sparse_rows(texts)), "weight")

    return docs.select(key, text).mapInArrow(weigh, schema)


# --------------------------------------------------------------------- LSA


@dataclass
class LsaModel:
    """TF-IDF vocabulary and the right singular vectors (columns x rank)."""

    tfidf: TfidfModel
    components: np.ndarray = field(repr=False)
    dim: int = EMBED_DIM

    @property
    def rank(self) -> int:
        return self.components.shape[1]

    def save(self, spark: SparkSession, path: str) -> None:
        terms = sorted(self.tfidf.index, key=self.tfidf.index.get)
        pdf = pd.DataFrame({"term": terms, "idf": self.tfidf.idf, "v": list(self.components.astype("float64"))})
        spark.createDataFrame(pdf, "term string, idf double, v array<double>").write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str, dim: int = EMBED_DIM) -> LsaModel:
        pdf = spark.read.parquet(path).orderBy("term").toPandas()
        tfidf = TfidfModel({t: i for i, t in enumerate(pdf["term"])}, pdf["idf"].to_numpy())
        return LsaModel(tfidf, np.stack(pdf["v"].to_numpy()), dim)


_BLOCK_ENTRIES = 1 << 20


def _sparse_rows(docs: DataFrame, text: str) -> DataFrame:
    """Term counts of all documents in packed blocks of bounded size with the terms of their own, stored in the shared folder.

    Texts are counted once, before there is a vocabulary; numbers take as few bytes as they need; weights follow from the counts."""

    def small(x: np.ndarray) -> np.ndarray:
        return x.astype(np.min_scalar_type(x.max(initial=0)))

    def packed(table: GramTable, some: list) -> pa.RecordBatch:
        sizes, cols, tf = (np.concatenate(x) for x in zip(*some))
        # No n-gram holds a line end, as words are cut there.
        packs = [pa.array([small(x).tobytes()], pa.binary()) for x in (np.cumsum(sizes), cols, tf)]
        return pa.RecordBatch.from_arrays([pa.array([len(sizes)], pa.int32()), pa.array(["\n".join(table.index)], pa.string()), *packs], names=_PACKED)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, some, size = GramTable(), [], 0
        for _, texts in _pieces(batches, text):
            grams, ends, ids, tf = gram_block(texts)
            some.append((np.diff(ends, prepend=0), table.numbers(grams)[ids], small(tf)))
            size += len(ids)
            if size >= _BLOCK_ENTRIES:
                yield packed(table, some)
                table, some, size = GramTable(), [], 0
        if some:
            yield packed(table, some)

    return stored_blocks(docs.select(F.col(text).cast("string").alias(text)), pack, "n int, terms string, ends binary, cols binary, tf binary", "tfidf_rows")


_PACKED = ["n", "terms", "ends", "cols", "tf"]


def _unpack(packed: bytes, n: int) -> np.ndarray:
    return np.frombuffer(packed, f"<u{len(packed) // n}" if n else "u1").astype(np.int64)


def _stored_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[str], np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks as :func:`gram_block` gave them, unpacked one at a time."""
    for b in batches:
        for i in range(b.num_rows):
            r = {c: b.column(c)[i].as_py() for c in _PACKED}
            ends = _unpack(r["ends"], r["n"])
            yield r["terms"].split("\n") if r["terms"] else [], ends, _unpack(r["cols"], ends[-1]), _unpack(r["tf"], ends[-1])


def _stored_stats(rows: DataFrame) -> DataFrame:
    """As :func:`term_stats`, from stored blocks."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _totals(_sums(grams, ids, tf) for grams, _, ids, tf in _stored_rows(batches))

    return _added(rows.select(*_PACKED).mapInArrow(count, _TOTALS))


_BLOCK_ROWS = 2048
_PRODUCTS = 1 << 16
_DENSE = 32
_DENSE_CELLS = 1 << 20


def _unit_rows(idf: np.ndarray, ends: np.ndarray, cols: np.ndarray, tf: np.ndarray) -> np.ndarray:
    w, own = tf * idf[cols], _owners(ends)
    size = np.sqrt(np.bincount(own, w * w, len(ends)))
    return w / np.where(size > 0, size, 1.0)[own]


def _rows_times(m: np.ndarray, ends: np.ndarray, cols: np.ndarray, w: np.ndarray, z: np.ndarray | None = None) -> np.ndarray:
    """A m for the rows A of a block; A^T (A m) is added to ``z``, if given.

    Columns that one in ``_DENSE`` rows or more has are a dense matrix, a few rows at a time; the others are gathered in parts that fit a cache."""
    n, width = len(ends), m.shape[1]
    y = np.zeros((n, width))
    hot = np.flatnonzero(np.bincount(cols, minlength=len(m)) > max(8, n / _DENSE))
    slot = np.full(len(m), -1)
    slot[hot] = np.arange(len(hot))
    own, at = _owners(ends), slot[cols]
    rare = np.flatnonzero(at < 0)
    cold, cold_w, cold_own = cols[rare], w[rare], own[rare]
    until = np.cumsum(np.bincount(cold_own, minlength=n)).tolist()
    for d, (a, b) in enumerate(zip([0, *until], until)):
        if b > a:
            y[d] = cold_w[a:b] @ m[cold[a:b]]
    used, back = m[hot], np.zeros((len(hot), width))
    step = min(n, max(1, _DENSE_CELLS // max(1, len(hot))))
    cells = np.empty((step, len(hot)))
    for r in range(0, n if len(hot) else 0, step):
        k = slice(int(ends[r - 1]) if r else 0, int(ends[min(n, r + step) - 1]))
        of = at[k] >= 0
        x = cells[: n - r]
        x[:] = 0
        x[own[k][of] - r, at[k][of]] = w[k][of]
        y[r : r + step] += x @ used
        if z is not None:
            back += x.T @ y[r : r + step]
    if z is not None:
        z[hot] += back
        by = np.argsort(cold.astype(np.min_scalar_type(len(m))), kind="stable")
        cold, cold_w, cold_own = cold[by], cold_w[by, None], cold_own[by]
        step = max(1, _PRODUCTS // width)
        for s in range(0, len(by), step):
            k = slice(s, s + step)
            first = np.flatnonzero(np.diff(cold[k], prepend=-1))
            z[cold[k][first]] += np.add.reduceat(y[cold_own[k]] * cold_w[k], first)
    return y


def _add_products(z: np.ndarray, m: np.ndarray, idf: np.ndarray, ends: np.ndarray, cols: np.ndarray, tf: np.ndarray) -> None:
    """Add A^T (A m) to ``z`` for the unit-length rows A of a block. The n-grams of a text come in an order that does not depend on its block,
    and so do the sums of A m over columns that few rows have."""
    _rows_times(m, ends, cols, _unit_rows(idf, ends, cols, tf), z)


def _gram_times(rows: DataFrame, model: TfidfModel, q: np.ndarray) -> np.ndarray:
    """(A^T A) q for the distributed sparse rows A: each task sums its part, then the parts of a block of
    matrix rows are added up in two levels, so no task receives the parts of all others. A few tasks a core keep these parts few."""
    from pyspark import TaskContext

    sc = rows.sparkSession.sparkContext
    shared = sc.broadcast((q, model))
    tasks = 4 * sc.defaultParallelism
    slots = max(1, round(tasks**0.5))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, tfidf = shared.value
        z = np.zeros(m.shape)
        for grams, *block in _stored_rows(batches):
            _add_products(z, m, tfidf.idf, *_renumbered(tfidf.columns(grams), *block))
        slot = TaskContext.get().partitionId() % slots
        for s in range(0, len(m), _BLOCK_ROWS):
            yield pa.RecordBatch.from_pydict({"block": pa.array([s], pa.int32()), "slot": pa.array([slot], pa.int32()), "z": pa.array([z[s : s + _BLOCK_ROWS].tobytes()], pa.binary())})

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(z) for z in pdf["z"]], axis=0)
        return pdf.iloc[:1].assign(z=total.tobytes())

    schema = "block int, slot int, z binary"
    parts = rows.select(*_PACKED).coalesce(tasks).mapInArrow(partial, schema)
    once = parts.groupBy("block", "slot").applyInPandas(add, schema)
    pdf = once.groupBy("block").applyInPandas(add, schema).toPandas().sort_values("block")
    shared.unpersist()
    return np.concatenate([np.frombuffer(z) for z in pdf["z"]]).reshape(q.shape)


def fit_lsa(
    docs: DataFrame, text: str, dim: int = EMBED_DIM, max_features: int = MAX_FEATURES, n_iter: int = 5, seed: int = 42
) -> LsaModel:
    """Truncated SVD of the TF-IDF matrix by randomised subspace iteration (Halko et al. 2011).

    Rank is ``max(1, min(dim, terms - 1, max(1, documents - 1)))``. The documents stay on the executors;
    the driver holds one vocabulary x rank matrix, which the vocabulary limit bounds. One job per pass.
    """
    rows = _sparse_rows(docs, text)
    total = rows.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_docs"))
    model = _model(_with_idf(cut_lineage(_stored_stats(rows)), total, max_features))
    n_terms = len(model.index)
    rank = max(1, min(dim, n_terms - 1, max(1, total.first().n_docs - 1)))
    width = min(n_terms, rank + 10)
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((n_terms, width)))[0]
    for _ in range(n_iter):
        q = np.linalg.qr(_gram_times(rows, model, q))[0]
    small = q.T @ _gram_times(rows, model, q)
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    top = np.argsort(values)[::-1][:rank]
    v = q @ vectors[:, top]
    # Fixed sign: the largest entry of each direction is positive.
    v *= np.sign(v[np.abs(v).argmax(axis=0), np.arange(v.shape[1])])
    return LsaModel(model, np.ascontiguousarray(v), dim)


def encode(docs: DataFrame, text: str, model: LsaModel, out: str = "embedding") -> DataFrame:
    """Project texts with the fitted model: one narrow pass, unit float vectors padded to ``dim``."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("array<float>")
    def project(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = shared.value
        for texts in batches:
            texts = texts.tolist()
            rows = np.zeros((len(texts), m.dim))
            for start, stop in _cuts([len(t or "") for t in texts]):
                grams, *block = gram_block(texts[start:stop])
                ends, cols, tf = _renumbered(m.tfidf.columns(grams), *block)
                rows[start:stop, : m.rank] = _rows_times(m.components, ends, cols, _unit_rows(m.tfidf.idf, ends, cols, tf))
            size = np.linalg.norm(rows, axis=1, keepdims=True)
            size[size == 0] = 1.0
            yield pd.Series(list((rows / size).astype("float32")))

    # Else a filter on the vectors is pushed below and the texts are projected once for it and once more for the rows.
    return docs.withColumn(out, project.asNondeterministic()(F.col(text)))


EMBEDDERS: dict[str, Callable] = {"tfidf-svd": fit_lsa}


# ------------------------------------------------------------------- top-k


def topk_cosine(items: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Exact cosine top-k of dense vectors: ``item_id, vector`` against ``query_id, vector``; null vectors take no part.

    Both sides stay on the executors, see :mod:`fieldlens.operators.topk`.
    """
    return topk_vectors(items, queries, k)


def topk_tfidf(items: DataFrame, queries: DataFrame, k: int, model: TfidfModel) -> DataFrame:
    """Exact cosine top-k of TF-IDF vectors: ``item_id, text`` against ``query_id, text``, on inverted blocks of items."""
    fitted = items.sparkSession.sparkContext.broadcast(model)

    def vectorise(texts):
        return fitted.value.sparse_rows(texts.to_pylist())

    return topk_sparse(items, queries, k, vectorise)
