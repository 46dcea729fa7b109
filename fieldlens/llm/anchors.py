"""Anchored windows of bytes.

Every window of ``window`` bytes is assigned to the smallest k-gram (by hash, leftmost) among its first
``span`` k-grams. Equal windows have their anchor at the same offset, so windows need only be compared where
their anchors agree, and about one position in ``span / 2`` is an anchor. Consecutive windows with one anchor
form a *strip*: the bytes from the first window's start to the last window's end.
"""

from __future__ import annotations

import numpy as np

from fieldlens.llm import repeats as R

GRAM = 32  # a power of two; long enough that texts rarely share one by chance
CHUNK = 1 << 17
_RANDOM = np.random.default_rng(16).integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = 0x9E6C63D0676A9A99
_LONGEST = 1 << 9
_SPANS = [(np.random.default_rng(40 + k).integers(1, 1 << 63, 256, dtype=np.uint64), b) for k, b in enumerate(
    (np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xFF51AFD7ED558CCD)))]
_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def span_hashes(raw: np.ndarray, begin: np.ndarray, end: np.ndarray, which: int) -> np.ndarray:
    """Hash of the bytes of every span; ``begin`` ascends and spans have at most 512 bytes."""
    values, base = _SPANS[which]
    if which not in _TABLES:
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        _TABLES[which] = tuple(
            np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(CHUNK + _LONGEST, b)])) for b in (base, inverse)
        )
    up, down = _TABLES[which]
    out = np.empty(len(begin), np.uint64)
    for at in range(0, len(raw), CHUNK):
        lo, hi = np.searchsorted(begin, [at, at + CHUNK])
        if hi > lo:
            part = values[raw[at : at + CHUNK + _LONGEST]]
            sums = np.concatenate([[np.uint64(0)], np.cumsum(part * up[: len(part)], dtype=np.uint64)])
            b, e = begin[lo:hi] - at, end[lo:hi] - at
            out[lo:hi] = (sums[e] - sums[b]) * down[b] + (e - b).astype(np.uint64)
    return R.mix(out)


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from every position (the last GRAM - 1 positions have none)."""
    h, base, size = _RANDOM[raw], _BASE, 1
    while size < GRAM:
        h = h[:-size] * np.uint64(base) + h[size:]
        base, size = base * base % (1 << 64), 2 * size
    return R.mix(h)


def strips(raw: np.ndarray, offsets: np.ndarray, window: int):
    """First window start, number of windows, anchor position and anchor hash of every strip, and its row.

    ``offsets`` cut ``raw`` into rows; windows do not cross them.
    """
    span = window - GRAM + 1
    none = np.zeros(0, np.int64)
    out = []
    for at in range(0, len(raw) - window + 1, CHUNK):
        grams = gram_hashes(raw[at : at + CHUNK + window - 1])
        low = (grams & np.uint64(0xFFFFFFFFFFF00000)) | np.arange(len(grams), dtype=np.uint64)
        size = 1
        while 2 * size <= span:
            low = np.minimum(low[:-size], low[size:])
            size *= 2
        if size < span:
            low = np.minimum(low[: len(low) - (span - size)], low[span - size :])
        anchor = (low & np.uint64(0xFFFFF)).astype(np.int64)
        start = np.arange(at, at + len(anchor))
        row = _rows(offsets, at, len(anchor))
        inside = start + window <= offsets[row + 1]
        start, anchor, row = start[inside], anchor[inside], row[inside]
        if not len(start):
            continue
        fresh = np.ones(len(start), bool)
        fresh[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
        begin = np.flatnonzero(fresh)
        out.append((start[begin], np.diff(np.append(begin, len(start))), anchor[begin] + at, grams[anchor[begin]], row[begin]))
    if not out:
        return none, none, none, np.zeros(0, np.uint64), none
    first, n, anchor, key, row = (np.concatenate(c) for c in zip(*out))
    # A strip that runs over a chunk border was cut there: join its halves again.
    joins = np.zeros(len(first), bool)
    joins[1:] = (anchor[1:] == anchor[:-1]) & (row[1:] == row[:-1])
    head = np.flatnonzero(~joins)
    return first[head], np.add.reduceat(n, head), anchor[head], key[head], row[head]


def _rows(offsets: np.ndarray, at: int, n: int) -> np.ndarray:
    """Row of each position from ``at`` on; empty rows hold none."""
    lo, hi = np.searchsorted(offsets, [at, at + n], "right")
    marks = np.zeros(n, np.int64)
    inner = offsets[lo:hi] - at
    np.add.at(marks, inner[inner < n], 1)
    return np.cumsum(marks) + lo - 1
