"""Periodic runs of words, found on a harmonic grid and extended by recompression.

A run is a stretch of consecutive words with smallest period q that no neighbouring word extends. Runs of at least
``exponent`` periods (4 or more) and ``least`` words are found; the words after a run's first period are dropped by
``collapse``.

* **Candidates.** A run of four periods q holds four consecutive multiples of q, with equal words. For each q the grid of its
  multiples (n/q places, n log n over all q) is compared with itself; places where three equalities follow one another
  are candidates.
* **Extension.** A candidate at p and p + q is extended to both sides by common extensions on a run-length grammar
  (:mod:`fieldlens.llm.recompression`), built once for the texts that have candidates; no suffix arrays.
* A stretch that was found for several multiples of its period keeps the smallest.

Texts of a batch are numbered and compared together, longest first, in parts of about ``part_bytes``; a longer text is a part of its own, so a
task needs memory in proportion to its longest text (about 60 times its bytes if it is periodic). Every row is judged alone: nothing is
shuffled, and hot ids or copies make no group.

Defined cases: a null or empty text has no words and no runs; repeated rows give repeated result rows; of runs with one exponent the
smallest start, then the smallest period is ``best``; an empty table gives an empty result; other columns pass by unread, and those with the
names of result columns are replaced.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from fieldlens.llm.recompression import Extensions
from fieldlens.llm.tables import without
from fieldlens.session import ship_package

LEAST = 6
EXPONENT = 4
PART_BYTES = 4 << 20
QUERIES_AT_ONCE = 1 << 20
RESULT = ["n_words", "runs", "best", "collapsed"]
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def candidates(symbols: np.ndarray, ends: np.ndarray, sizes: np.ndarray, least: int, exponent: int):
    """Places and periods where ``exponent`` consecutive multiples of the period hold one symbol.

    ``sizes`` descend; text k ends before ``ends[k]``. Symbols between texts occur once.
    """
    places, periods = [], []
    q, n = 1, len(sizes)
    while True:
        n = int(np.searchsorted(-sizes[:n], -max(least, exponent * q), "right"))
        if not n:
            break
        grid = symbols[: ends[n - 1] : q]
        same = grid[1:] == grid[:-1]
        if same.any():
            row = same[: len(same) - exponent + 2].copy()
            for k in range(1, exponent - 1):
                row &= same[k : k + len(row)]
            at = np.flatnonzero(row) * q
            # Every place from the first to the last of these multiples repeats after q; try some before the exact test.
            for off in (q // 2, q + q // 3, 2 * q - 1):
                at = at[symbols[at + off] == symbols[at + off + q]]
            if len(at):
                places.append(at)
                periods.append(np.full(len(at), q))
        q += 1
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(places), np.concatenate(periods)


def find_runs(texts: list[np.ndarray], least: int = LEAST, exponent: int = EXPONENT) -> list[np.ndarray]:
    """Per sequence of numbers its runs (start, length, period), by start, then period."""
    if exponent < 4:
        raise ValueError("the grid needs four multiples of a period in every run")
    out = [np.zeros((0, 3), np.int64)] * len(texts)
    order = sorted((k for k in range(len(texts)) if len(texts[k]) >= least), key=lambda k: -len(texts[k]))
    if not order:
        return out
    symbols, begins, ends, sizes = _joined([texts[k] for k in order])
    place, period = candidates(symbols, ends, sizes, least, exponent)
    if not len(place):
        return out
    # The grammar is built for the texts with candidates only.
    own = np.searchsorted(ends, place, "right")
    some, slot = np.unique(own, return_inverse=True)
    place -= begins[own]
    symbols, begins, _, _ = _joined([texts[order[k]] for k in some.tolist()])
    extend, base = Extensions(symbols), begins[slot]
    found = []
    for a in range(0, len(place), QUERIES_AT_ONCE):
        p, q = (base + place)[a : a + QUERIES_AT_ONCE], period[a : a + QUERIES_AT_ONCE]
        right, left = extend.right(p, p + q), extend.left(p - 1, p + q - 1)
        length = left + right + q
        keep = length >= np.maximum(least, exponent * q)
        rows = np.stack([slot[a : a + QUERIES_AT_ONCE], p - left - begins[slot[a : a + QUERIES_AT_ONCE]], length, q], axis=1)
        found.append(_smallest_periods(rows[keep]))
    rows = _smallest_periods(np.concatenate(found))
    rows = rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]
    cuts = np.searchsorted(rows[:, 0], np.arange(len(some) + 1))
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
        out[order[some[k]]] = rows[a:b, 1:]
    return out


def _smallest_periods(rows: np.ndarray) -> np.ndarray:
    """One row per text, start and length, with the smallest period; by text, start and length."""
    rows = rows[np.lexsort(rows.T[::-1])]
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:, :3] != rows[:-1, :3]).any(axis=1)
    return rows[first]


def _joined(texts: list[np.ndarray]):
    """All sequences in one, each between symbols that occur once; first places, ends and sizes."""
    sizes = np.array([len(t) for t in texts])
    fresh = 1 + max(int(t.max()) for t in texts)
    ends = np.cumsum(sizes + 1)
    symbols = np.empty(int(ends[-1]) + 1, np.int64)
    symbols[0] = fresh
    symbols[ends] = fresh + 1 + np.arange(len(texts))
    begins = ends - sizes
    for t, a, b in zip(texts, begins.tolist(), ends.tolist()):
        symbols[a:b] = t
    return symbols, begins, ends, sizes


def best_of(runs: np.ndarray) -> int:
    """Row of the greatest length/period; ties: smallest start, then period. Quotients of numbers below 2^26 differ as doubles."""
    return int(np.lexsort((runs[:, 2], runs[:, 0], -(runs[:, 1] / runs[:, 2])))[0])


def dropped(runs: np.ndarray, n: int) -> np.ndarray:
    """Mask of the words after the first period of some run."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, runs[:, 0] + runs[:, 2], 1)
    np.add.at(steps, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(steps[:-1]) > 0


def collapse(
    docs: DataFrame, text: str = "text", least: int = LEAST, exponent: int = EXPONENT,
    edit: tuple[str, Callable] | None = None, part_bytes: int = PART_BYTES,
) -> DataFrame:
    """Input columns but the text, ``n_words``, ``runs`` (start, length, period), ``best`` and ``collapsed``: the words left,
    joined by spaces. ``edit`` = (column, function of its value and the number of words) gives the words to judge instead, as
    their numbers in the text, or None for the text as it is."""
    ship_package(docs.sparkSession)
    rows = without(docs, RESULT)
    rest = [f for f in rows.schema.fields if f.name != text]
    names = [f.name for f in rest]
    run = "struct<start:bigint,length:bigint,period:bigint>"
    schema = T.StructType([*rest, *T.StructType.fromDDL(f"n_words long, runs array<{run}>, best {run}, collapsed string").fields])

    def judged(batches):
        for batch in batches:
            col = batch.column(text)
            begin, size = 0, 0
            for k in range(batch.num_rows):
                own = len(v.as_buffer()) if (v := col[k]).is_valid else 0
                if k > begin and size + own > part_bytes:
                    yield _judge(batch.slice(begin, k - begin), text, names, least, exponent, edit)
                    begin, size = k, 0
                size += own
            if batch.num_rows > begin:
                yield _judge(batch.slice(begin), text, names, least, exponent, edit)

    return rows.mapInArrow(judged, schema)


def _judge(batch: pa.RecordBatch, text: str, names: list[str], least: int, exponent: int, edit) -> pa.RecordBatch:
    numbers: dict[bytes, int] = defaultdict(count().__next__)
    words = [v.as_buffer().to_pybytes().split() if v.is_valid else [] for v in batch.column(text)]
    if edit is not None:
        for k, v in enumerate(batch.column(edit[0]).to_pylist()):
            at = edit[1](v, len(words[k]))
            if at is not None:
                words[k] = [words[k][p] for p in at]
    texts = [np.fromiter(map(numbers.__getitem__, w), np.int64, len(w)) for w in words]
    runs, best, left = find_runs(texts, least, exponent), [], []
    for k, r in enumerate(runs):
        if not len(r):
            best.append(None)
            left.append(b" ".join(words[k]))
            continue
        best.append(dict(zip(("start", "length", "period"), r[best_of(r)].tolist())))
        gone = dropped(r, len(words[k])).tolist()
        left.append(b" ".join([w for w, g in zip(words[k], gone) if not g]))
    table = np.concatenate([*runs, np.zeros((0, 3), np.int64)])
    offsets = np.cumsum([0, *map(len, runs)]).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(
        [pa.array(np.ascontiguousarray(table[:, c])) for c in range(3)], fields=list(_RUN)))
    own = [pa.array(list(map(len, words)), pa.int64()), lists, pa.array(best, _RUN), pa.array(left, pa.binary()).cast(pa.string())]
    return pa.RecordBatch.from_arrays([batch.column(c) for c in names] + own, names=[*names, *RESULT])
