"""Repeated passages of words: Rabin-Karp hashes of every window of 50 words, counted over all documents.

Round 1 counts the hashes (cut to a width that follows the input) and finds those that several documents hold.
Round 2 compares those windows by a further 64-bit hash, another polynomial of the same 64-bit word hashes, and finds the smallest
document id of each. A word goes if some window over it also starts in a document with a smaller id; overlapping windows merge
into maximal intervals. Windows are judged on the input.

Defined cases: a null text has no words; a very long text is handled within one block, which then needs memory in proportion to it; ids of any
ordered type, null ids count as one document after all others; equal ids are one document for the comparison (rows with the same id do
not remove each other); an empty table gives an empty result; other columns pass by unread, and those with
the names of result columns are replaced.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldlens.llm import repeats as R
from fieldlens.llm.tables import without

WINDOW = 50
RESULT = ["n_words", "n_removed", "n_spans", "kept_sha256", "kept"]
LONG_WORD = 64
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_RANDOM = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)
_STEP = np.uint64(0x9FB21C651E98DF25)
_BASES = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def inverse(base: np.uint64) -> np.uint64:
    return np.uint64(pow(int(base), -1, 1 << 64))


def words(texts: R.Texts):
    """Start, end and row of every word of the block."""
    raw, offsets = texts.raw, texts.offsets
    if not len(raw):
        none = np.zeros(0, np.int64)
        return none, none, none
    space = _SPACE[raw]
    border = np.zeros(len(raw) + 1, bool)
    border[offsets] = True
    start = ~space
    start[1:] &= space[:-1] | border[1:-1]
    end = ~space
    end[:-1] &= space[1:] | border[1:-1]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sizes = ends - starts
    h = sizes.astype(np.uint64)
    live = np.flatnonzero(sizes <= LONG_WORD)
    at = 0
    while len(live):
        h[live] = h[live] * _STEP + _RANDOM[raw[starts[live] + at]]
        at += 1
        live = live[sizes[live] > at]
    for k in np.flatnonzero(sizes > LONG_WORD).tolist():
        digest = hashlib.blake2b(raw[starts[k] : ends[k]].tobytes(), digest_size=8).digest()
        h[k] = np.frombuffer(digest, "<u8")[0]
    return R.mix(h)


def window_hashes(h: np.ndarray, n: int, base: np.uint64) -> np.ndarray:
    """Rolling polynomial hash of every run of ``n`` hashes."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(h * _powers(base, len(h)), dtype=np.uint64)])
    return R.mix((sums[n:] - sums[:-n]) * _powers(inverse(base), len(h) - n + 1))


class WordWindows:
    def __init__(self, texts: R.Texts, window: int, bits: int):
        self.texts, self.window, self.bits = texts, window, bits
        self.starts, self.ends, self.row = words(texts)
        self.hash = word_hashes(texts.raw, self.starts, self.ends)
        n = len(self.row) - window + 1
        self.valid = np.flatnonzero(self.row[: max(n, 0)] == self.row[window - 1 :]) if n > 0 else np.zeros(0, np.int64)
        self.keys = window_hashes(self.hash, window, _BASES[0])[self.valid] >> np.uint64(64 - bits)

    def present(self) -> R.Question:
        return R.Question(self.keys, self.row[self.valid])

    def shared(self, flags: np.ndarray) -> tuple[R.Question, np.ndarray]:
        """Question about the windows that several documents hold, and their places."""
        some = np.flatnonzero(flags)
        at = self.valid[some]
        second = window_hashes(self.hash ^ (self.hash << np.uint64(29)), self.window, _BASES[1])[at]
        return R.Question(self.keys[some], self.row[at], second), at


def dedup(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", window: int = WINDOW, texts_too: bool = False,
    block_bytes: int = R.BLOCK_BYTES,
) -> DataFrame:
    """Input columns but the text, n_words, n_removed, n_spans and kept_sha256; with ``texts_too`` also kept, the
    words left joined by spaces."""
    blocks, bits = R.parts_of(docs, text, block_bytes)
    cuts = R.ranges(blocks)
    docs = without(docs, RESULT).withColumn(text, F.col(text).cast("string"))

    def ask_presence(texts, answers):
        w = WordWindows(texts, window, bits)
        return R.presence_payloads(w.present(), texts.ids, bits, cuts)

    def shared(texts, answers):
        w = WordWindows(texts, window, bits)
        q = w.present()
        flags = R.read_bits(q, answers.get(0, {}), bits, cuts)
        return w, *w.shared(flags[q.entry])

    def ask_first(texts, answers):
        _, q, _ = shared(texts, answers)
        return R.first_payloads(q, texts.ids, bits, cuts)

    rest = [f for f in docs.schema.fields if f.name != text]
    schema = T.StructType([*rest, *T.StructType.fromDDL(
        "n_words long, n_removed long, n_spans long, kept_sha256 string" + ", kept string" * texts_too).fields])

    def finish(texts, answers):
        w, q, at = shared(texts, answers)
        later = R.read_bits(q, answers.get(1, {}), bits, cuts)
        gone = later[q.entry] | (texts.ids[w.row[at]] > texts.ids[q.first][q.entry])
        removed = R.cover(at[gone], len(w.row), window)
        first = np.searchsorted(w.row, np.arange(len(texts) + 1))
        edge = removed.copy()
        edge[1:] &= ~removed[:-1] | (w.row[1:] != w.row[:-1])
        n_removed = np.concatenate([[0], np.cumsum(removed)])[first]
        n_spans = np.concatenate([[0], np.cumsum(edge)])[first]
        kept, sha = [], []
        raw = texts.raw.tobytes()
        for k in range(len(texts)):
            own = raw[texts.offsets[k] : texts.offsets[k + 1]].split()
            if n_removed[k + 1] > n_removed[k]:
                own = [x for x, r in zip(own, removed[first[k] : first[k + 1]].tolist()) if not r]
            joined = b" ".join(own)
            if texts_too:
                kept.append(joined.decode())
            sha.append(hashlib.sha256(joined).hexdigest())
        out = texts.table
        for name, values in (("n_words", np.diff(first)), ("n_removed", np.diff(n_removed)), ("n_spans", np.diff(n_spans))):
            out = out.append_column(name, pa.array(values, pa.int64()))
        out = out.append_column("kept_sha256", pa.array(sha, pa.string()))
        return out.append_column("kept", pa.array(kept, pa.string())) if texts_too else out

    return R.run_rounds(
        docs, id_col, text, blocks, bits, [ask_presence, ask_first], [R.Presence, R.First], finish, schema
    )
