"""Best-fit packing of token pieces into sequences.

1. Texts are tokenised in Arrow batches and cut into pieces of at most ``capacity`` tokens.
2. The histogram of piece lengths (at most ``capacity`` numbers, whatever the input) goes to the driver, which
   solves the configuration linear program over it: multiplicative weights set a price per length, a knapsack
   dynamic program finds the configuration of the highest price, and configurations are added in fractions. With few lengths the
   steps are small and go on until the fractions lie within ``GAP`` of the lower bound that the prices give; the fractions then are
   moved to as few configurations as there are lengths. With many lengths (``WORK``) a step covers a length as a whole. The fractions are rounded
   down; what is left goes best fit decreasing into the open sequences and new ones, and the plan of the fewest sequences is
   kept, pure best fit included. The size of the plan depends on ``capacity`` and the number of rounds only.
3. Every piece gets its rank among the pieces of its length (spread over buckets, so a common length is no
   single group) and reads its sequence and offset from the plan.

Defined cases: a null or empty text is one piece (its end token); a very long text is encoded as a whole, so a task needs memory for its longest
text's ids; repeated rows are packed one by one; an empty
table gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldlens.llm.tables import stored
from fieldlens.session import ship_package

CAPACITY = 2048
ROUNDS = 3000
RATE = 0.5
GAP = 0.004  # small steps end when the fractional plan is this close to the lower bound
STEP = 0.4  # first rate of the small steps
WORK = 120_000  # rounds of small steps times lengths
FULL = 0.998  # one of the plans compared leaves configurations with more waste to the best-fit step


def token_pieces(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Pieces of every text: doc_id, piece, start, length, ids_crc32. The first piece of a long text may be shorter."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def cut(batches):
        from fieldlens.llm.token_units import encoder

        enc = encoder(vocabulary)
        for b in batches:
            at, piece, start, length, crc = [], [], [], [], []
            for row, ids in enumerate(enc.encode(t.as_py() for t in b.column(1))):
                raw = memoryview(ids + b"\0\0\0\0")
                n = len(raw) // 4
                begin, size, k = 0, n if n <= capacity else n % capacity or capacity, 0
                while begin < n:
                    at.append(row)
                    piece.append(k)
                    start.append(begin)
                    length.append(size)
                    crc.append(zlib.crc32(raw[4 * begin : 4 * (begin + size)]))
                    begin, size, k = begin + size, capacity, k + 1
            yield pa.record_batch(
                [b.column(0).take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return rows.mapInArrow(cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


@dataclass
class Bins:
    """``count`` sequences that all hold ``parts``: (length, copies) in the order they are laid out."""

    count: int
    parts: list[tuple[int, int]]


def best_configuration(price: np.ndarray, lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Copies of every length in the fill of at most ``capacity`` with the highest total price (knapsack).

    ``lengths`` ascend. With few lengths whole arrays of rooms are compared for 1, 2, 4, ... further copies of each length; with
    many, all lengths are compared for each room.
    """
    if len(lengths) * 8 < capacity:
        return _by_length(price, lengths, capacity)
    best = np.zeros(capacity + 1)
    took = np.full(capacity + 1, -1)
    fits = np.searchsorted(lengths, np.arange(capacity + 1), "right")
    for room in range(int(lengths[0]), capacity + 1):
        k = fits[room]
        total = best[room - lengths[:k]] + price[:k]
        took[room] = pick = int(total.argmax())
        best[room] = total[pick]
    copies = np.zeros(len(lengths), dtype=np.int64)
    room = capacity
    while room > 0 and took[room] >= 0:
        copies[took[room]] += 1
        room -= int(lengths[took[room]])
    return copies


def _by_length(price: np.ndarray, lengths: np.ndarray, capacity: int) -> np.ndarray:
    best, steps = np.zeros(capacity + 1), []
    for k, size in enumerate(lengths.tolist()):
        times = 1
        while times * size <= capacity:
            shift = times * size
            more = best[:-shift] + times * price[k]
            took = more > best[shift:]
            best[shift:] = np.where(took, more, best[shift:])
            steps.append((k, times, shift, took))
            times *= 2
    copies, room = np.zeros(len(lengths), dtype=np.int64), capacity
    for k, times, shift, took in reversed(steps):
        if room >= shift and took[room - shift]:
            copies[k] += times
            room -= shift
    return copies


def small_steps(lengths: np.ndarray, counts: np.ndarray, capacity: int, gap: float = GAP, work: int = WORK):
    """Multiplicative weights in small steps: (copies, fraction of sequences) per configuration, and a lower bound of the sequences.

    A price is the weight of a length over its count, and the weight falls by ``exp(-rate)`` whenever the length is covered once
    more. Any prices bound the program from below: no sequence can hold more than the best configuration costs. A round adds the
    best configuration until one of its lengths is covered once; what a phase has added, over the least cover, is a plan. The next phase starts
    from the weights of the last one with half its rate and twice its rounds. Without enough work for a plan there are no configurations.
    """
    rounds, rate, bound = work // len(lengths), STEP, 0.0
    log_weight, plan, fewest = np.zeros(len(lengths)), [], math.inf
    phase = math.ceil(4 * len(lengths) / rate)
    while rounds >= phase:
        cover, total = np.zeros(len(lengths)), 0.0
        chosen: dict[bytes, list] = {}
        for _ in range(phase):
            now = log_weight - rate * cover
            weight = np.exp(now - now.max())
            price = weight / counts
            copies = best_configuration(price, lengths, capacity)
            bound = max(bound, float(weight.sum() / (price @ copies)))
            used = copies > 0
            share = float((counts[used] / copies[used]).min())
            cover[used] += copies[used] * share / counts[used]
            total += share
            chosen.setdefault(copies.tobytes(), [copies, 0.0])[1] += share
        least = cover.min()
        if least > 0 and total / least < fewest:
            fewest, plan = total / least, [(copies, share / least) for copies, share in chosen.values()]
        if fewest <= (1 + gap) * bound:
            break
        log_weight, rounds = log_weight - rate * cover, rounds - phase
        rate, phase = rate / 2, 2 * phase
    return fewer_configurations(plan) if plan else [], bound


def fewer_configurations(plan: list[tuple]) -> list[tuple]:
    """The same cover by the same number of sequences with at most one configuration more than there are lengths."""
    plan = list(plan)
    m = len(plan[0][0]) + 1
    while len(plan) > m:
        part = plan[: m + 1]
        matrix = np.stack([np.append(copies, 1) for copies, _ in part], axis=1).astype(float)
        move = np.linalg.svd(matrix)[2][-1]  # changes neither the cover nor the number of sequences
        share = np.array([x for _, x in part])
        if not (move < -1e-12).any():
            move = -move
        down = move < -1e-12
        share = share + move * (share[down] / -move[down]).min()
        share[np.flatnonzero(down)[np.argmin(share[down])]] = 0.0
        plan = [(copies, max(0.0, float(x))) for (copies, _), x in zip(part, share) if x > 1e-9] + plan[m + 1 :]
    return plan


def fractional_plan(lengths: np.ndarray, counts: np.ndarray, capacity: int, rounds: int = ROUNDS, rate: float = RATE):
    """Multiplicative weights for the covering program; (copies, fraction of sequences) per configuration.

    The weights start at the tokens a length has, so that a price is the share of a sequence the length fills,
    and fall by ``exp(-rate * covered)``. A round adds the configuration of the highest price until one of its
    lengths is covered, so there are about as many rounds as lengths.
    """
    covered = np.zeros(len(lengths))
    chosen: dict[bytes, list] = {}
    for _ in range(rounds):
        open_ = covered < 1
        if not open_.any():
            break
        price = lengths / capacity * np.exp(-rate * covered)
        copies = np.zeros(len(lengths), dtype=np.int64)
        copies[open_] = best_configuration(price[open_], lengths[open_], capacity)
        used = copies > 0
        share = float(((1 - covered[used]) * counts[used] / copies[used]).min())
        covered[used] += copies[used] * share / counts[used]
        covered[covered > 1 - 1e-9] = 1
        chosen.setdefault(copies.tobytes(), [copies, 0.0])[1] += share
    return [tuple(c) for c in chosen.values()]


def best_fit(lengths: np.ndarray, counts: np.ndarray, capacity: int, open_bins: list[Bins] = ()) -> list[Bins]:
    """Best fit decreasing on the histogram, into ``open_bins`` and new ones: equal sequences are filled together."""
    room: list[list[Bins]] = [[] for _ in range(capacity + 1)]
    for b in open_bins:
        room[capacity - sum(size * copies for size, copies in b.parts)].append(b)
    for at in np.argsort(-lengths):
        size, left = int(lengths[at]), int(counts[at])
        while left:
            space = next((r for r in range(size, capacity) if room[r]), None)
            if space is None:
                per = capacity // size
                group, space = Bins(max(1, left // per), []), capacity
            else:
                group, per = room[space].pop(), space // size
            per = min(per, left)
            full = min(group.count, left // per)
            if full < group.count:
                room[space].append(Bins(group.count - full, group.parts)) if group.parts else None
            room[space - per * size].append(Bins(full, [*group.parts, (size, per)]))
            left -= full * per
    return [g for groups in room for g in groups]


def rounded(chosen: list[tuple], lengths: np.ndarray, counts: np.ndarray, capacity: int, least: int) -> list[Bins]:
    """Configurations of ``least`` tokens or more, rounded down, the fullest first; best fit for what is left.

    Where pieces of a length run out, the configuration goes on without them and its sequences stay open for the best fit."""
    left, bins = counts.copy(), []
    for copies, share in chosen:
        n = math.floor(share + 1e-9)
        if int(copies @ lengths) < least:
            continue
        while n > 0:
            copies = np.minimum(copies, left)
            used = copies > 0
            if not used.any():
                break
            now = min(n, int((left[used] // copies[used]).min()))
            left -= now * copies
            bins.append(Bins(now, [(int(lengths[i]), int(copies[i])) for i in np.flatnonzero(used)[::-1]]))
            n -= now
    rest = left > 0
    return best_fit(lengths[rest], left[rest], capacity, bins)


def solve(histogram: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS) -> list[Bins]:
    """Sequences for a histogram of lengths, every piece placed exactly once.

    Of the plans with the configurations of small steps, with those of whole steps, with the full ones of them, and best fit alone, the
    plan of the fewest sequences is taken: which is best depends on the histogram.
    """
    lengths = np.array(sorted(histogram), dtype=np.int64)
    counts = np.array([histogram[int(n)] for n in lengths], dtype=np.int64)
    if not len(lengths):
        return []
    chosen = sorted(fractional_plan(lengths, counts, capacity, rounds), key=lambda c: -int(c[0] @ lengths))
    plans = [rounded(chosen, lengths, counts, capacity, least) for least in (0, math.ceil(FULL * capacity), capacity + 1)]
    fine, _ = small_steps(lengths, counts, capacity)
    if fine:
        fine = sorted(fine, key=lambda c: -int(c[0] @ lengths))
        plans += [rounded(fine, lengths, counts, capacity, 0)]
    return min(plans, key=lambda bins: sum(b.count for b in bins))


def seats(bins: list[Bins]) -> np.ndarray:
    """Rows (length, first rank, first sequence, copies, first offset) that tell where a ranked piece goes."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for b in bins:
        offset = 0
        for size, copies in b.parts:
            rank = taken.get(size, 0)
            rows.append((size, rank, sequence, copies, offset))
            taken[size] = rank + b.count * copies
            offset += size * copies
        sequence += b.count
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, capacity: int = CAPACITY, rounds: int = ROUNDS) -> DataFrame:
    """Adds sequence_id and offset to the pieces of :func:`token_pieces`."""
    ship_package(pieces.sparkSession)
    pieces = stored(pieces, "pieces")
    histogram = {int(n): int(c) for n, c in pieces.groupBy("length").count().collect()}
    total = sum(histogram.values())
    plan = seats(solve(histogram, capacity, rounds))
    buckets = math.isqrt(total) + 1
    marked = pieces.withColumn("__b", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    before = Window.partitionBy("length").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        marked.groupBy("length", "__b").agg(F.count("*").alias("__n"))
        .withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    )
    inside = Window.partitionBy("length", "__b").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = (
        marked.withColumn("__in", F.row_number().over(inside))
        .join(starts, ["length", "__b"])
        .select(*pieces.columns, (F.col("__before") + F.col("__in") - 1).alias("__rank"))
    )
    key = (plan[:, 0] << 44) | plan[:, 1]

    def place(batches):
        for b in batches:
            size, rank = (b.column(b.schema.get_field_index(c)).to_numpy() for c in ("length", "__rank"))
            row = plan[np.searchsorted(key, (size << 44) | rank, "right") - 1] if len(size) else plan[:0]
            seat = rank - row[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(row[:, 2] + seat // row[:, 3]), pa.array(row[:, 4] + seat % row[:, 3] * size)],
                names=[*b.schema.names[:-1], "sequence_id", "offset"],
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return ranked.mapInArrow(place, f"{schema}, sequence_id long, offset long")
