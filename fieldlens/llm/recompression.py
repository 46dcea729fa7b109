"""Run-length grammars by recompression, and exact common extensions on them.

Block compression replaces every maximal block of one symbol by a new symbol; pair compression deals the symbols
out to a left and a right side and replaces every pair (left, right). In turn they shrink a sequence to one symbol. Where both
steps cut depends on neighbouring symbols only, so equal stretches are cut alike except near their ends. A common extension
climbs from two places as long as the symbols agree and comes down along the first difference, a
bounded number of steps per level. All queries of a call go through the levels together.

The rules mirror, so the same grammar read backwards answers extensions to the left.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Level:
    """A sequence, and how it is cut into the symbols of the next one."""

    symbols: np.ndarray
    parent: np.ndarray  # place in the next sequence
    start: np.ndarray  # first place of each symbol of the next sequence, and the end
    blocks: bool

    def mirrored(self) -> Level:
        n, above = len(self.symbols), len(self.start) - 1
        return Level(self.symbols[::-1].copy(), above - 1 - self.parent[::-1], n - self.start[::-1], self.blocks)


def _side(symbols: np.ndarray, turn: int) -> np.ndarray:
    """True for the left side; another dealing at every turn."""
    h = symbols.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(turn * 0xD1B54A32D192ED03 % (1 << 64))
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(40)) & np.uint64(1) == 0


def _level(symbols: np.ndarray, head: np.ndarray, blocks: bool) -> Level:
    start = np.append(np.flatnonzero(head), len(symbols))
    return Level(symbols, np.cumsum(head) - 1, start, blocks)


def _named(level: Level, second: np.ndarray, fresh: int) -> tuple[np.ndarray, int]:
    """Symbols of the next sequence: single ones stay, equal (first, second) get one new number."""
    first = level.symbols[level.start[:-1]]
    several = np.flatnonzero(np.diff(level.start) > 1)
    key = first[several] << np.int64(32) | second[several]
    names, which = np.unique(key, return_inverse=True)
    first = first.copy()
    first[several] = fresh + which
    return first, fresh + len(names)


def recompress(symbols: np.ndarray) -> list[Level]:
    """Levels from ``symbols`` (0 and up) to one symbol. Numbers stay below 2^32, so a pair is one 64-bit key."""
    levels: list[Level] = []
    fresh = int(symbols.max()) + 1 if len(symbols) else 0
    turn = 0
    while len(symbols) > 1:
        head = np.ones(len(symbols), bool)
        head[1:] = symbols[1:] != symbols[:-1]
        if not head.all():
            level = _level(symbols, head, True)
            levels.append(level)
            symbols, fresh = _named(level, np.diff(level.start), fresh)
            continue
        left = _side(symbols, turn)
        turn += 1
        paired = left[:-1] & ~left[1:]
        if not paired.any():
            continue
        head[1:] = ~paired
        level = _level(symbols, head, False)
        levels.append(level)
        symbols, fresh = _named(level, symbols[level.start[1:] - 1], fresh)
    levels.append(Level(symbols, np.zeros(len(symbols), np.int64), np.array([0, len(symbols)]), True))
    return levels


def common_extension(levels: list[Level], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Length of the longest common stretch from ``i`` and from ``j`` (``i`` != ``j``).

    The sequence must hold a symbol that occurs once at or after each pair's later place, so that every stretch ends.
    """
    a, b = i.astype(np.int64), j.astype(np.int64)
    found = np.zeros(len(a), np.int64)  # level of the first difference
    live = np.arange(len(a))
    for at, v in enumerate(levels):
        if not len(live):
            break
        x, y = a[live], b[live]
        differ = v.symbols[x] != v.symbols[y]
        found[live[differ]] = at
        live, x, y = live[~differ], x[~differ], y[~differ]
        px, py = v.parent[x], v.parent[y]
        ragged = (v.start[px] != x) | (v.start[py] != y)
        if ragged.any():
            some = np.flatnonzero(ragged)
            p, q = x[some], y[some]
            stop = np.zeros(len(some), bool)
            if v.blocks:
                left, right = v.start[px[some] + 1] - p, v.start[py[some] + 1] - q
                step = np.minimum(left, right)
                p, q = p + step, q + step
                stop = left != right  # the longer block goes on where the shorter one has ended
            else:
                p, q = p + 1, q + 1
                inner = (v.start[v.parent[p]] != p) | (v.start[v.parent[q]] != q)
                stop = inner & (v.symbols[p] != v.symbols[q])
                more = inner & ~stop
                p, q = p + more, q + more
            x[some], y[some] = p, q
            a[live[some]], b[live[some]] = p, q
            ended = live[some[stop]]
            found[ended] = at
            keep = np.ones(len(live), bool)
            keep[some[stop]] = False
            live, x, y = live[keep], x[keep], y[keep]
        a[live], b[live] = v.parent[x], v.parent[y]
    for at in range(int(found.max(initial=0)), 0, -1):
        v = levels[at - 1]
        down = np.flatnonzero(found >= at)
        x, y = v.start[a[down]], v.start[b[down]]
        same = v.symbols[x] == v.symbols[y]
        if v.blocks:
            step = np.minimum(v.start[a[down] + 1] - x, v.start[b[down] + 1] - y)
        else:
            step = 1
        a[down], b[down] = x + same * step, y + same * step
    return a - i


class Extensions:
    """Common extensions to both sides on one sequence that begins and ends with symbols that occur once."""

    def __init__(self, symbols: np.ndarray):
        self.n = len(symbols)
        self.levels = recompress(symbols)
        self.back = [v.mirrored() for v in self.levels]

    def right(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return common_extension(self.levels, i, j)

    def left(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest common stretch that ends at ``i`` and at ``j``, both included."""
        return common_extension(self.back, self.n - 1 - i, self.n - 1 - j)
