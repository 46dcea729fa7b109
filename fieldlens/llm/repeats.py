"""Rounds of questions about keys that occur in several documents, asked from blocks of documents.

Documents are shuffled once into blocks; every round reads the same shuffle files. In a round a block asks
about its distinct keys (window hashes, say), packed per range of keys; the reducer of a range sees all blocks
that hold a key and answers with bits in the same order, so an answer costs bits and not rows. A key that very
many documents share is one entry per block.

A block sends at most ``FANOUT`` rows. Up to ``FANOUT`` blocks, their ranges are the reducers. Beyond that, routers stand between: a router
merges what a group of ``FANOUT`` blocks asks about one range and sends the merged entries on, again as at most ``FANOUT`` rows, and so on until
one group is left; answers come back the same way. There are fewer than twice as many routers of a level as blocks, so the rows of a round are
at most ``2 * FANOUT`` times the blocks, per level, and levels grow with the logarithm of the blocks. No reducer or router sees more than about what one block asks.

Blocks are dealt out by id and text, so neither rows without an id nor rows that share one are a block of their own (equal rows with
equal ids are: they cannot be told apart). Ids may be of any type that can be ordered; other than whole numbers are ranked first.

Keys are uniform hashes cut to a width that follows the input (``key_bits``), so sorted keys of a block are
stored as small differences.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldlens.llm.tables import memory_returned
from fieldlens.operators.ranking import rank_rows
from fieldlens.session import ship_package

BLOCK_BYTES = 6 << 20  # a worker needs about 30 times as much memory; raise it with the memory of the executors
FANOUT = 256  # rows a block or router sends in a round, and blocks or routers one router serves
ROWS = "bucket long, block int, phase int, payload binary"
CARRIED = -1  # phase of the row that carries a block's earlier answers
STATE = 1 << 20  # what a block remembers instead of them, as if it were an answer


def pack_keys(keys: np.ndarray) -> bytes:
    """Ascending unsigned keys as differences: whole low bytes raw, the rest compressed."""
    n = len(keys)
    gaps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    mean = int(keys[-1]) // n if n else 0
    low = max(0, (mean.bit_length() - 1) // 8)
    raw = gaps.view(np.uint8).reshape(-1, 8)[:, :low].tobytes()
    high = gaps >> np.uint64(8 * low)
    large = np.flatnonzero(high >= 255)
    small = np.minimum(high, np.uint64(255)).astype(np.uint8)
    small = zstandard.compress(small.tobytes(), 1)
    return struct.pack("<IBII", n, low, len(large), len(small)) + small + high[large].tobytes() + raw


def unpack_keys(data: bytes) -> tuple[np.ndarray, int]:
    """The keys and the number of bytes read."""
    n, low, n_large, n_small = struct.unpack_from("<IBII", data)
    at = struct.calcsize("<IBII")
    high = np.frombuffer(zstandard.decompress(data[at : at + n_small]), np.uint8).astype(np.uint64)
    at += n_small
    high[np.flatnonzero(high == 255)] = np.frombuffer(data, "<u8", n_large, at)
    at += 8 * n_large
    gaps = np.zeros((n, 8), np.uint8)
    gaps[:, :low] = np.frombuffer(data, np.uint8, n * low, at).reshape(n, low)
    gaps = gaps.reshape(-1).view("<u8") + (high << np.uint64(8 * low))
    return np.cumsum(gaps, dtype=np.uint64), at + n * low


def pack_ids(ids: np.ndarray) -> bytes:
    """Integer ids by byte plane, compressed: the planes that hardly vary cost nothing."""
    return zstandard.compress(np.ascontiguousarray(ids.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def unpack_ids(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1).T).view("<i8").reshape(-1)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash, so that any of its bits may be used."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


class Question:
    """Distinct entries of a block: key, optionally a second 64-bit hash, and the first document of each entry."""

    def __init__(self, keys: np.ndarray, docs: np.ndarray, second: np.ndarray | None = None):
        """``docs`` are row numbers in ascending order of id, one per occurrence."""
        order = np.argsort(keys, kind="stable") if second is None else np.lexsort((docs, second, keys))
        k, d = keys[order], docs[order]
        fresh = np.ones(len(k), bool)
        fresh[1:] = k[1:] != k[:-1]
        self.second = None
        if second is not None:
            s = second[order]
            fresh[1:] |= s[1:] != s[:-1]
            self.second = s[fresh]
        self.entry = np.empty(len(k), np.int64)  # entry of each occurrence
        self.entry[order] = np.cumsum(fresh) - 1
        begin = np.flatnonzero(fresh)
        self.keys = k[fresh]
        self.first = d[begin]
        self.last = d[np.append(begin[1:], len(d)) - 1] if len(d) else d
        self.place = order[begin]  # first occurrence of each entry



def cut_places(keys: np.ndarray, bits: int, buckets: int, first: int = 0, n: int | None = None) -> np.ndarray:
    """Where ranges ``first .. first + n`` of ``buckets`` equal ranges begin in ascending keys."""
    n = buckets if n is None else n
    edges = np.array([(b << bits) // buckets for b in range(first + 1, first + n)], dtype=np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]]).astype(np.int64)


def split_bits(bits: np.ndarray, sizes: list[int]) -> list[bytes]:
    cuts = np.cumsum([0, *sizes])
    return [np.packbits(bits[a:b]).tobytes() for a, b in zip(cuts, cuts[1:])]


class Kind:
    """What a reducer or router makes of the payloads it gets: merged entries with ascending ``keys``; ``part`` packs some of them,
    ``root`` answers them where nobody stands above, and ``back`` gives the answer of every payload from those of the entries."""

    def parts(self, bits: int, buckets: int, first: int, n: int):
        """(range, payload) of the entries in ranges ``first .. first + n``."""
        cuts = cut_places(self.keys, bits, buckets, first, n)
        for b in range(n):
            if cuts[b + 1] > cuts[b]:
                yield first + b, self.part(slice(cuts[b], cuts[b + 1]))

    def answers(self, bits: int, buckets: int, first: int, n: int, found: dict[int, bytes]) -> list[bytes]:
        return self.back(bits_of(self.keys, {b - first: a for b, a in found.items()}, bits, buckets, first, n))

    def final(self) -> list[bytes]:
        return self.back(self.root())


def pack_two(a: bytes, b: bytes) -> bytes:
    return struct.pack("<I", len(a)) + a + b


def unpack_two(data: bytes) -> tuple[bytes, bytes]:
    (n,) = struct.unpack_from("<I", data)
    return data[4 : 4 + n], data[4 + n :]


def two(one: type, other: type) -> type:
    """Two questions asked in one round; payloads and answers travel in pairs, either side may be empty."""

    class Two(Kind):
        def __init__(self, payloads: list[bytes]):
            self.n, pairs = len(payloads), [unpack_two(p) for p in payloads]
            self.at = [[k for k, p in enumerate(pairs) if p[side]] for side in (0, 1)]
            self.sides = [kind([pairs[k][side] for k in at]) if at else None for side, (kind, at) in enumerate(zip((one, other), self.at))]

        def parts(self, *where):
            a, b = (dict(s.parts(*where)) if s else {} for s in self.sides)
            for k in sorted({*a, *b}):
                yield k, pack_two(a.get(k, b""), b.get(k, b""))

        def _paired(self, lists) -> list[bytes]:
            out = [[b"", b""] for _ in range(self.n)]
            for side, (at, found) in enumerate(zip(self.at, lists)):
                for k, a in zip(at, found):
                    out[k][side] = a
            return [pack_two(*x) for x in out]

        def answers(self, bits, buckets, first, n, found):
            split = {b: unpack_two(a) for b, a in found.items()}
            return self._paired([
                s.answers(bits, buckets, first, n, {b: a[side] for b, a in split.items()}) if s else [] for side, s in enumerate(self.sides)
            ])

        def final(self):
            return self._paired([s.final() if s else [] for s in self.sides])

    return Two


def two_payloads(a, b):
    """(range, pair) of two questions' payloads."""
    a, b = dict(a), dict(b)
    for k in sorted({*a, *b}):
        yield k, pack_two(a.get(k, b""), b.get(k, b""))


class Presence(Kind):
    """Keys with a mark for those that several documents hold. Answer: at least two documents hold it."""

    @staticmethod
    def payload(keys: np.ndarray, several: np.ndarray) -> bytes:
        return pack_keys(keys) + np.packbits(several).tobytes()

    def __init__(self, payloads: list[bytes]):
        keys, flags = [], []
        for p in payloads:
            k, at = unpack_keys(p)
            keys.append(k)
            flags.append(np.unpackbits(np.frombuffer(p, np.uint8, offset=at), count=len(k)).astype(bool))
        self.lists = keys
        ordered = np.sort(np.concatenate(keys))
        fresh = np.ones(len(ordered), bool)
        fresh[1:] = ordered[1:] != ordered[:-1]
        begin = np.flatnonzero(fresh)
        self.keys = ordered[begin]
        self.several = np.diff(np.append(begin, len(ordered))) > 1
        for k, f in zip(keys, flags):
            self.several[np.searchsorted(self.keys, k[f])] = True

    def part(self, cut: slice) -> bytes:
        return self.payload(self.keys[cut], self.several[cut])

    def root(self) -> np.ndarray:
        return self.several

    def back(self, bits: np.ndarray) -> list[bytes]:
        """Answers for every payload from those for the merged entries."""
        bits = bits | self.several
        return [np.packbits(bits[np.searchsorted(self.keys, k)]).tobytes() for k in self.lists]


class First(Kind):
    """Entries (key, second hash) with the smallest id that holds each. Answer: a smaller id holds it elsewhere."""

    @staticmethod
    def payload(keys: np.ndarray, second: np.ndarray, ids: np.ndarray) -> bytes:
        packed, first = pack_keys(keys), pack_ids(ids)
        return struct.pack("<II", len(packed), len(first)) + packed + first + second.astype("<u8").tobytes()

    def __init__(self, payloads: list[bytes]):
        keys, ids, seconds = [], [], []
        for p in payloads:
            n_keys, n_ids = struct.unpack_from("<II", p)
            k, _ = unpack_keys(p[8 : 8 + n_keys])
            keys.append(k)
            ids.append(unpack_ids(p[8 + n_keys : 8 + n_keys + n_ids]))
            seconds.append(np.frombuffer(p, "<u8", len(k), 8 + n_keys + n_ids))
        self.sizes, self.own = list(map(len, keys)), np.concatenate(ids)
        k, s = np.concatenate(keys), np.concatenate(seconds)
        order = np.lexsort((self.own, s, k))
        k, s = k[order], s[order]
        fresh = np.ones(len(k), bool)
        fresh[1:] = (k[1:] != k[:-1]) | (s[1:] != s[:-1])
        self.entry = np.empty(len(k), np.int64)
        self.entry[order] = np.cumsum(fresh) - 1
        self.keys, self.second, self.ids = k[fresh], s[fresh], self.own[order][fresh]

    def part(self, cut: slice) -> bytes:
        return self.payload(self.keys[cut], self.second[cut], self.ids[cut])

    def root(self) -> np.ndarray:
        return np.zeros(len(self.keys), bool)

    def back(self, bits: np.ndarray) -> list[bytes]:
        return split_bits(bits[self.entry] | (self.ids[self.entry] < self.own), self.sizes)


def asked_parts(kind, q: Question, columns: list[np.ndarray], bits: int, buckets: int):
    """(range, payload) of a question's entries."""
    cuts = cut_places(q.keys, bits, buckets)
    for b in range(buckets):
        if cuts[b + 1] > cuts[b]:
            yield b, kind.payload(q.keys[cuts[b] : cuts[b + 1]], *[c[cuts[b] : cuts[b + 1]] for c in columns])


def presence_payloads(q: Question, ids: np.ndarray, bits: int, buckets: int):
    """Keys and whether two documents of the block hold them."""
    return asked_parts(Presence, q, [ids[q.first] != ids[q.last]], bits, buckets)


def first_payloads(q: Question, ids: np.ndarray, bits: int, buckets: int):
    """Entries (key, second hash) and the smallest id of the block that holds each."""
    return asked_parts(First, q, [q.second, ids[q.first]], bits, buckets)


def read_bits(q: Question, answers: dict[int, bytes], bits: int, buckets: int) -> np.ndarray:
    """Answers of all ranges put back in the order of the question's entries."""
    return bits_of(q.keys, answers, bits, buckets)


def bits_of(keys: np.ndarray, answers: dict[int, bytes], bits: int, buckets: int, first: int = 0, n_ranges: int | None = None) -> np.ndarray:
    cuts = cut_places(keys, bits, buckets, first, n_ranges)
    out = np.zeros(len(keys), bool)
    for b in range(len(cuts) - 1):
        if n := int(cuts[b + 1] - cuts[b]):
            out[cuts[b] : cuts[b + 1]] = np.unpackbits(np.frombuffer(answers[b], np.uint8), count=n)
    return out


def cover(at: np.ndarray, n: int, window: int) -> np.ndarray:
    """Mask of the ``n`` positions under windows that start at ``at``."""
    steps = np.zeros(n + 1, np.int32)
    np.add.at(steps, at, 1)
    np.add.at(steps, np.minimum(at + window, n), -1)
    return np.cumsum(steps[:-1], dtype=np.int32) > 0


def parts_of(docs: DataFrame, text: str, block_bytes: int) -> tuple[int, int]:
    """Number of blocks and key width for these texts (one scan of their lengths)."""
    total = docs.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-total // block_bytes)), key_bits(total)


class Texts:
    """Rows of a block by ascending id, with all texts in one buffer."""

    def __init__(self, table: pa.Table, id_col: str, text: str):
        # Filled in Arrow: numpy would turn ids beside a null into floats. Rows with a null id are one document, the last.
        ids = table.column(id_col).cast(pa.int64()).fill_null(np.iinfo(np.int64).max).to_numpy()
        order = np.argsort(ids, kind="stable")
        self.table = table.take(pa.array(order))
        self.ids = ids[order]
        col = self.table.column(text).cast(pa.large_string()).fill_null("")
        arr = col.combine_chunks()
        if isinstance(arr, pa.ChunkedArray):
            arr = pa.concat_arrays(arr.chunks) if arr.num_chunks else pa.array([], pa.large_string())
        buffers = arr.buffers()
        offsets = np.frombuffer(buffers[1], np.int64)[arr.offset : arr.offset + len(arr) + 1] if len(arr) else np.zeros(1, np.int64)
        raw = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
        self.raw = raw[offsets[0] : offsets[-1]]
        self.offsets = offsets - offsets[0]

    def __len__(self) -> int:
        return len(self.ids)


def pack_answers(answers: dict[int, dict[int, bytes]]) -> bytes:
    """All answers a block has so far, in one row."""
    return b"".join(struct.pack("<III", phase, b, len(p)) + p for phase, by in answers.items() for b, p in by.items())


def unpack_answers(data: bytes):
    at = 0
    while at < len(data):
        phase, bucket, n = struct.unpack_from("<III", data, at)
        yield phase, bucket, data[at + 12 : at + 12 + n]
        at += 12 + n


def _payload_rows(rows: list[tuple]) -> pa.Table:
    cols = list(zip(*rows)) if rows else [(), (), (), ()]
    return pa.table({
        "bucket": pa.array(cols[0], pa.int64()), "block": pa.array(cols[1], pa.int32()),
        "phase": pa.array(cols[2], pa.int32()), "payload": pa.array(cols[3], pa.binary()),
    })


def exchange(asked: DataFrame, kind, phase: int, bits: int, blocks: int, buckets: int, watch: list | None = None) -> DataFrame:
    """Questions of ``phase`` (``bucket, block, phase, payload``) with their payloads replaced by answers; other rows stay.

    ``blocks`` senders number from 0 and ask about ``buckets`` ranges. ``watch`` collects the rows of every level.
    """
    if watch is not None:
        watch.append(asked)

    def now(table: pa.Table) -> tuple[list[int], list[bytes]]:
        at = np.flatnonzero(table.column("phase").to_numpy() == phase).tolist()
        payloads = table.column("payload")
        return at, [payloads[k].as_py() for k in at]

    def answered(table: pa.Table, at: list[int], found: list[bytes]) -> pa.Table:
        payloads = table.column("payload").to_pylist()
        for k, a in zip(at, found):
            payloads[k] = a
        return table.set_column(table.schema.get_field_index("payload"), "payload", pa.array(payloads, pa.binary()))

    if blocks <= FANOUT:
        def answering(key, table: pa.Table) -> pa.Table:
            at, payloads = now(table)
            return memory_returned(answered(table, at, kind(payloads).final()) if at else table)

        return asked.groupBy("bucket").applyInArrow(lambda key, table: answering(key, table), ROWS)

    groups, finer = -(-blocks // FANOUT), buckets * FANOUT
    # The same columns both times, so that the questions are shuffled once and read twice.
    router = [F.col("bucket"), F.expr(f"block div {FANOUT}")]

    def routing(key, table: pa.Table) -> pa.Table:
        at, payloads = now(table)
        if not at:
            return _payload_rows([])
        first, group = key[0].as_py() * FANOUT, int(key[1].as_py())
        return memory_returned(_payload_rows([(b, group, phase, p) for b, p in kind(payloads).parts(bits, finer, first, FANOUT)]))

    routed = asked.groupBy(*router).applyInArrow(lambda key, table: routing(key, table), ROWS)
    deeper = exchange(routed, kind, phase, bits, groups, finer, watch)

    def returning(key, table: pa.Table, found: pa.Table) -> pa.Table:
        at, payloads = now(table)
        if not at:
            return table
        first = key[0].as_py() * FANOUT
        got = dict(zip(found.column("bucket").to_pylist(), found.column("payload").to_pylist()))
        return memory_returned(answered(table, at, kind(payloads).answers(bits, finer, first, FANOUT, got)))

    above = deeper.groupBy(F.expr(f"bucket div {FANOUT}"), F.col("block").cast("long"))
    return asked.groupBy(*router).cogroup(above).applyInArrow(lambda key, a, b: returning(key, a, b), ROWS)


def ranges(blocks: int) -> int:
    """Ranges a block cuts its keys into: the rows it sends in a round."""
    return min(blocks, FANOUT)


def _order_ids(docs: DataFrame, id_col: str) -> DataFrame:
    """Adds ``__order``: whole numbers in the order of the ids; null ids have none."""
    if isinstance(docs.schema[id_col].dataType, T.IntegralType):
        return docs.withColumn("__order", F.col(id_col).cast("long"))
    names = docs.select(F.col(id_col).alias("__name")).where("__name IS NOT NULL").distinct()
    ranked = rank_rows(names, [], [F.col("__name")], "__order").withColumn("__order", F.col("__order").cast("long"))
    return docs.join(ranked, docs[id_col] == ranked["__name"], "left").drop("__name")


def run_rounds(
    docs: DataFrame, id_col: str, text: str, blocks: int, bits: int,
    ask: list[Callable], kinds: list, finish: Callable, schema: T.StructType,
) -> DataFrame:
    """``ask[r](texts, answers)`` yields (range, payload) of the kind ``kinds[r]``; ``finish(texts, answers)`` gives the result
    table of a block. ``answers[r]`` is range -> answer.

    Answers of earlier rounds travel with the questions of the next one, so every round is read once. A question (``STATE``, bytes) replaces
    them: later rounds find the bytes as ``answers[STATE][0]``.
    """
    ship_package(docs.sparkSession)
    at = F.pmod(F.xxhash64(id_col, text), F.lit(blocks)).cast("int")
    spread = _order_ids(docs, id_col).withColumn("__block", at).repartition(blocks, "__block")

    def sorted_answers(table: pa.Table) -> dict[int, dict[int, bytes]]:
        out: dict[int, dict[int, bytes]] = {}
        for phase, bucket, payload in zip(*(table.column(c).to_pylist() for c in ("phase", "bucket", "payload"))):
            for ph, bu, pay in unpack_answers(payload) if phase == CARRIED else [(phase, bucket, payload)]:
                out.setdefault(ph, {})[bu] = pay
        return out

    def asking(r: int):
        def run(key, left: pa.Table, right: pa.Table | None = None) -> pa.Table:
            got = sorted_answers(right) if right is not None else {}
            block = key[0].as_py()
            asks = list(ask[r](Texts(left, "__order", text), got)) if left.num_rows else []
            rows = [(b, block, r, p) for b, p in asks if b != STATE]
            for b, p in asks:
                if b == STATE:
                    got = {STATE: {0: p}}
            if got:
                rows.append((block, block, CARRIED, pack_answers(got)))
            return _payload_rows(rows)

        if r == 0:
            return lambda key, left: memory_returned(run(key, left))
        return lambda key, left, right: memory_returned(run(key, left, right))

    answers = None
    for r in range(len(ask)):
        if answers is None:
            asked = spread.groupBy("__block").applyInArrow(asking(r), ROWS)
        else:
            asked = spread.groupBy("__block").cogroup(answers.groupBy("block")).applyInArrow(asking(r), ROWS)
        answers = exchange(asked, kinds[r], r, bits, blocks, ranges(blocks))

    def finishing(key, left: pa.Table, right: pa.Table) -> pa.Table:
        out = finish(Texts(left, "__order", text), sorted_answers(right))
        return memory_returned(out).select([f.name for f in schema.fields])

    return spread.groupBy("__block").cogroup(answers.groupBy("block")).applyInArrow(finishing, schema)


def key_bits(total_bytes: int) -> int:
    """Width that leaves about one chance meeting per thousand keys."""
    return min(60, max(24, math.ceil(math.log2(total_bytes + 2)) + 10))
