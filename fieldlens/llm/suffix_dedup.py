"""Removal of later copies of byte strings by longest-previous-factor arrays.

A byte goes if a string of 50 bytes over it also starts in a document with a smaller id: if the longest previous factor of the suffix that
starts there, the longest prefix it shares with a suffix of a smaller owner, has 50 bytes or more. In suffix order the previous and the
next suffix with a smaller owner are the two candidates for it, so the longer of the two common prefixes is the factor.

Not all suffixes need to be ordered. They are grouped into strips (see :mod:`fieldlens.llm.anchors`):

1. Strips whose anchor no second document has hold no repeats.
2. Equal strips are compared as wholes: in all documents but the first, all their suffixes repeat. In the same round, anchors that several
   different strips share are marked.
3. Of the strips left (each the first of its kind) with marked anchors, suffixes whose first 50 bytes a second document has, by hash,
4. are put in suffix order with the bytes that can matter (50). Previous and next smaller owners, the common prefixes to them and so the
   factor lengths are computed over the whole order of a range; bytes under factors of 50 go.

Every round spreads by hashes of the strings themselves, so no common passage or anchor is a group of its own, equal
strings meet, and a block asks once for what it holds often. Strips are compared by two hashes of together 90 bits or
more, suffixes byte by byte.

Defined cases: a null text is empty; rows with one id are one document for the comparison, rows without an id are one document after all
others; ids of any ordered type; texts shorter than 50 bytes stay; a very long text is handled within one block, which then needs memory in
proportion to it; a cut may split a character, and then the broken bytes stay in the byte results and are dropped from
``kept``; an empty table gives an empty result; other columns pass by unread, and
those with the names of result columns are replaced.
"""

from __future__ import annotations

import hashlib
import struct
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldlens.llm import repeats as R
from fieldlens.llm.anchors import span_hashes, strips
from fieldlens.llm.tables import without

WINDOW = 50
FACTOR_ROWS = 1 << 16  # rows compared at once
RESULT = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]


def nearest_smaller(owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Previous and next position with a smaller owner, or -1, by pointer jumping.

    Between a position and its pointer all owners are at least its own, so following the pointer of a
    position with no smaller owner keeps that true.
    """

    def previous(own):
        at = np.arange(len(own)) - 1
        open_ = np.arange(len(own))
        while len(open_):
            to = at[open_]
            open_, to = open_[to >= 0], to[to >= 0]
            wait = own[to] >= own[open_]
            open_, to = open_[wait], to[wait]
            at[open_] = at[to]
        return at

    back = previous(owner[::-1])[::-1]
    return previous(owner), np.where(back >= 0, len(owner) - 1 - back, -1)


def suffix_order(strings: np.ndarray) -> np.ndarray:
    """Order of byte strings, given as rows."""
    width = -(-strings.shape[1] // 8) * 8
    padded = np.zeros((len(strings), width), np.uint8)
    padded[:, : strings.shape[1]] = strings
    words = padded.view(">u8").astype(np.uint64)
    return np.lexsort(words.T[::-1])


def previous_factors(strings: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Per row the length of the longest prefix it shares with a row of a smaller owner."""
    order = suffix_order(strings)
    own, rows = owner[order], strings[order]
    length = np.zeros(len(order), np.int64)
    for near in nearest_smaller(own):
        some = np.flatnonzero(near >= 0)
        for at in range(0, len(some), FACTOR_ROWS):
            k = some[at : at + FACTOR_ROWS]
            differ = rows[k] != rows[near[k]]
            shared = np.where(differ.any(axis=1), differ.argmax(axis=1), strings.shape[1])
            length[k] = np.maximum(length[k], shared)
    out = np.empty(len(order), np.int64)
    out[order] = length
    return out


class Factors(R.Kind):
    """Suffixes by hash, with the smallest owner and the bytes of each. Answer: the longest previous factor has all the bytes."""

    @staticmethod
    def payload(keys: np.ndarray, ids: np.ndarray, strings: np.ndarray) -> bytes:
        packed, first = R.pack_keys(keys), R.pack_ids(ids)
        raw = zstandard.compress(strings.tobytes(), 1)
        return struct.pack("<III", len(packed), len(first), strings.shape[1]) + packed + first + raw

    def __init__(self, payloads: list[bytes]):
        keys, ids, strings = [], [], []
        for p in payloads:
            n_keys, n_ids, width = struct.unpack_from("<III", p)
            keys.append(R.unpack_keys(p[12 : 12 + n_keys])[0])
            ids.append(R.unpack_ids(p[12 + n_keys : 12 + n_keys + n_ids]))
            strings.append(np.frombuffer(zstandard.decompress(p[12 + n_keys + n_ids :]), np.uint8).reshape(-1, width))
        self.sizes = list(map(len, keys))
        self.own, rows, k = np.concatenate(ids), np.concatenate(strings), np.concatenate(keys)
        self.length = previous_factors(rows, self.own)
        self.width = rows.shape[1]
        # Distinct strings, by hash; equal strings have equal hashes.
        by = suffix_order(rows)
        fresh = np.ones(len(by), bool)
        fresh[1:] = (rows[by[1:]] != rows[by[:-1]]).any(axis=1)
        number = np.empty(len(by), np.int64)
        number[by] = np.cumsum(fresh) - 1
        first = by[fresh]
        least = np.full(len(first), np.iinfo(np.int64).max)
        np.minimum.at(least, number, self.own)
        rank = np.argsort(k[first], kind="stable")
        place = np.empty(len(rank), np.int64)
        place[rank] = np.arange(len(rank))
        self.entry = place[number]
        self.keys, self.ids, self.strings = k[first][rank], least[rank], rows[first][rank]

    def part(self, cut: slice) -> bytes:
        return self.payload(self.keys[cut], self.ids[cut], self.strings[cut])

    def root(self) -> np.ndarray:
        return np.zeros(len(self.keys), bool)

    def back(self, bits: np.ndarray) -> list[bytes]:
        return R.split_bits(bits[self.entry] | (self.length >= self.width), self.sizes)


class Variety(R.Kind):
    """Anchors with one of their strips and a mark for those with several. Answer: it has at least two different strips."""

    @staticmethod
    def payload(keys: np.ndarray, one: np.ndarray, several: np.ndarray) -> bytes:
        return R.pack_keys(keys) + one.astype("<u8").tobytes() + np.packbits(several).tobytes()

    def __init__(self, payloads: list[bytes]):
        keys, one, several = [], [], []
        for p in payloads:
            k, at = R.unpack_keys(p)
            keys.append(k)
            one.append(np.frombuffer(p, "<u8", len(k), at))
            several.append(np.unpackbits(np.frombuffer(p, np.uint8, offset=at + 8 * len(k)), count=len(k)).astype(bool))
        self.sizes = list(map(len, keys))
        k, o, s = np.concatenate(keys), np.concatenate(one), np.concatenate(several)
        self.keys, first, self.entry = np.unique(k, return_index=True, return_inverse=True)
        self.one, self.mixed = o[first], np.zeros(len(first), bool)
        self.mixed[self.entry[s | (o != self.one[self.entry])]] = True

    def part(self, cut: slice) -> bytes:
        return self.payload(self.keys[cut], self.one[cut], self.mixed[cut])

    def root(self) -> np.ndarray:
        return self.mixed

    def back(self, bits: np.ndarray) -> list[bytes]:
        return R.split_bits((bits | self.mixed)[self.entry], self.sizes)


def _variety_payloads(q: R.Question, strip: np.ndarray, bits: int, buckets: int):
    """Per distinct anchor: whether the block has several strips of it, and the hash of one."""
    one = strip[q.first]
    several = np.zeros(len(q.keys), bool)
    several[q.entry[strip != one[q.entry]]] = True
    return R.asked_parts(Variety, q, [one, several], bits, buckets)


@dataclass
class SharedSuffixes:
    keys: np.ndarray


class StripState:
    """What a block knows about its strips after the rounds answered so far."""

    def __init__(self, texts: R.Texts, answers: dict, window: int, bits: int, buckets: int):
        self.cut = np.uint64(64 - bits)
        self.raw, self.ids, self.window = texts.raw, texts.ids, window
        if R.STATE in answers:
            self._recall(answers[R.STATE][0])
        else:
            self._find(texts, answers, bits, buckets)
            if 1 not in answers:
                return
        first, n = self.mixed
        self.at = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        self.at_row = np.repeat(np.searchsorted(texts.offsets, first, "right") - 1, n)
        self.suffixes = q = R.Question(
            span_hashes(self.raw, self.at, self.at + window, 0) >> self.cut, self.at_row,
            span_hashes(self.raw, self.at, self.at + window, 1),
        )
        if 2 in answers:
            self.shared = np.flatnonzero(R.read_bits(q, answers[2], bits, buckets))
            self.shared_keys = q.keys[self.shared]

    def _find(self, texts: R.Texts, answers: dict, bits: int, buckets: int) -> None:
        """Strips, as far as the answers go: ``whole`` ones that repeat an earlier one, ``mixed`` ones whose suffixes count."""
        first, n, _, gram, row = strips(texts.raw, texts.offsets, self.window)
        anchor = R.mix(gram ^ np.uint64(0x5851F42D4C957F2D)) >> self.cut  # anchors are small hashes: spread them again
        self.anchors = R.Question(anchor, row)
        if 0 not in answers:
            return
        keep = R.read_bits(self.anchors, answers[0], bits, buckets)[self.anchors.entry]
        first, n, row, anchor = first[keep], n[keep], row[keep], anchor[keep]
        end = first + n + self.window - 1
        self.strip = span_hashes(self.raw, first, end, 0)
        self.equal = R.Question(self.strip >> self.cut, row, span_hashes(self.raw, first, end, 1))
        self.varied = R.Question(anchor, np.arange(len(anchor)))
        if 1 not in answers:
            return
        pairs = {b: R.unpack_two(a) for b, a in answers[1].items()}
        q = self.equal
        later = R.read_bits(q, {b: a for b, (a, _) in pairs.items()}, bits, buckets)
        later = later[q.entry] | (self.ids[row] > self.ids[q.first][q.entry])
        several = R.read_bits(self.varied, {b: a for b, (_, a) in pairs.items()}, bits, buckets)[self.varied.entry]
        self.whole, self.mixed = (first[later], n[later]), (first[~later & several], n[~later & several])

    def remembered(self) -> bytes:
        """What later rounds need of the strips."""
        parts = [R.pack_keys(first.astype(np.uint64)) + zstandard.compress(n.astype("<u2").tobytes(), 1) for first, n in (self.whole, self.mixed)]
        return R.pack_two(*parts)

    def _recall(self, data: bytes) -> None:
        out = []
        for part in R.unpack_two(data):
            first, at = R.unpack_keys(part)
            out.append((first.astype(np.int64), np.frombuffer(zstandard.decompress(part[at:]), "<u2").astype(np.int64)))
        self.whole, self.mixed = out

    def strings(self) -> np.ndarray:
        """The bytes of the shared suffixes, one row each."""
        first = self.at[self.suffixes.place[self.shared]]
        return self.raw[first[:, None] + np.arange(self.window)]


def dedup(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", window: int = WINDOW, texts_too: bool = False,
    block_bytes: int = R.BLOCK_BYTES,
) -> DataFrame:
    """Input columns but the text, n_bytes, n_removed, n_spans and kept_sha256; with ``texts_too`` also kept."""
    blocks, bits = R.parts_of(docs, text, block_bytes)
    cuts = R.ranges(blocks)
    docs = without(docs, RESULT).withColumn(text, F.col(text).cast("string"))

    def state(texts, answers, done):
        return StripState(texts, {**{r: {} for r in range(done)}, **answers}, window, bits, cuts)

    def ask_anchors(texts, answers):
        return R.presence_payloads(state(texts, answers, 0).anchors, texts.ids, bits, cuts)

    def ask_strips(texts, answers):
        s = state(texts, answers, 1)
        return R.two_payloads(
            R.first_payloads(s.equal, texts.ids, bits, cuts), _variety_payloads(s.varied, s.strip, bits, cuts))

    def ask_suffixes(texts, answers):
        s = state(texts, answers, 2)
        yield R.STATE, s.remembered()
        yield from R.presence_payloads(s.suffixes, texts.ids, bits, cuts)

    def ask_factors(texts, answers):
        s = state(texts, answers, 3)
        part = SharedSuffixes(s.shared_keys)
        return R.asked_parts(Factors, part, [texts.ids[s.suffixes.first[s.shared]], s.strings()], bits, cuts)

    rest = [f for f in docs.schema.fields if f.name != text]
    schema = T.StructType([*rest, *T.StructType.fromDDL(
        "n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept string" * texts_too).fields])

    def finish(texts, answers):
        s = state(texts, answers, 3)
        q = s.suffixes
        later = np.zeros(len(q.keys), bool)
        later[s.shared] = R.bits_of(s.shared_keys, answers.get(3, {}), bits, cuts)
        hit = later[q.entry] | (s.ids[s.at_row] > s.ids[q.first][q.entry])
        whole, n = s.whole
        runs = np.repeat(whole, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        removed = R.cover(np.concatenate([runs, s.at[hit]]), len(s.raw), window)
        edge = removed.copy()
        edge[1:] &= ~removed[:-1]
        heads = texts.offsets[:-1][texts.offsets[:-1] < len(removed)]
        edge[heads] = removed[heads]
        sums = np.concatenate([[0], np.cumsum(removed, dtype=np.int32)])[texts.offsets]
        spans = np.concatenate([[0], np.cumsum(edge, dtype=np.int32)])[texts.offsets]
        sha, kept = [], []
        for a, b, gone in zip(texts.offsets[:-1].tolist(), texts.offsets[1:].tolist(), np.diff(sums).tolist()):
            left = (s.raw[a:b][~removed[a:b]] if gone else s.raw[a:b]).tobytes()
            sha.append(hashlib.sha256(left).hexdigest())
            if texts_too:
                kept.append(left.decode("utf-8", "ignore"))
        out = texts.table
        for name, values in (("n_bytes", np.diff(texts.offsets)), ("n_removed", np.diff(sums)), ("n_spans", np.diff(spans))):
            out = out.append_column(name, pa.array(values.astype(np.int64), pa.int64()))
        out = out.append_column("kept_sha256", pa.array(sha, pa.string()))
        return out.append_column("kept", pa.array(kept, pa.string())) if texts_too else out

    return R.run_rounds(
        docs, id_col, text, blocks, bits,
        [ask_anchors, ask_strips, ask_suffixes, ask_factors],
        [R.Presence, R.two(R.First, Variety), R.Presence, Factors], finish, schema,
    )
