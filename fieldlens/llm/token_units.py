"""Token ids through a vocabulary file, with texts cut at boundaries where tokens cannot cross.

The byte-level pattern of the vocabulary starts a new piece at every space that stands before a visible
character, so the text between two such spaces has the same tokens wherever it occurs. Equal units are
encoded once per worker and kept in a bounded cache; the units that are missing are put together and encoded
in batches of about equal bytes.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator

import numpy as np

BATCH_CHARS = 1 << 18
CACHE_UNITS = 100_000
LONGEST_CACHED = 64
SAFE = re.compile(" (?=[!-~\u00a1-\u0fff])")
UNSAFE = re.compile(" (?![!-~\u00a1-\u0fff])")
# Fixed value: the public pattern of this vocabulary's byte-level pre-tokenizer.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_encoders: dict[str, "UnitEncoder"] = {}


def encoder(path: str) -> "UnitEncoder":
    """One encoder per vocabulary and worker process."""
    if path not in _encoders:
        _encoders[path] = UnitEncoder(path)
    return _encoders[path]


class UnitEncoder:
    def __init__(self, path: str, cache_units: int = CACHE_UNITS, batch_chars: int = BATCH_CHARS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.cache_units, self.batch_chars = cache_units, batch_chars
        self.inner: dict[str, bytes] = {}  # units that follow a space
        self.first: dict[str, bytes] = {}  # units at the start of a text
        size = self.tok.get_vocab_size(with_added_tokens=True)
        self.opens = np.zeros(size, dtype=bool)
        for piece, i in self.tok.get_vocab(with_added_tokens=True).items():
            self.opens[i] = piece.startswith("Ġ")  # the byte-level form of a space
        self.special = {t.content: np.uint32(i).tobytes() for i, t in self.tok.get_added_tokens_decoder().items()}
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.fast = self._ranked()

    def _ranked(self):
        """The same vocabulary as merge ranks, which encodes rare words several times faster.

        Only used when ids follow the merge order, which a probe over the vocabulary confirms.
        """
        import tiktoken

        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in visible]
        to_byte = {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}
        vocab = {p: i for p, i in self.tok.get_vocab(with_added_tokens=False).items() if p not in self.special}
        if any(c not in to_byte for p in vocab for c in p):
            return None
        ranks = {bytes(to_byte[c] for c in p): i for p, i in vocab.items()}
        fast = tiktoken.Encoding("units", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        probe = [b.decode("utf-8", "ignore") for b in list(ranks)[::50]]
        same = all(fast.encode_ordinary(t) == self.tok.encode(t, add_special_tokens=False).ids for t in probe)
        return fast if same else None

    def _plain(self, text: str) -> bytes:
        return np.asarray(self.tok.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _encode_inner(self, units: list[str]) -> dict[str, bytes]:
        """Units are joined by single spaces: each token that begins with a space begins a unit."""
        found = {u: self._plain(" " + u) for u in units if " " in u or not u}
        simple = [u for u in units if u not in found]
        batches, batch, chars = [], [], 0
        for u in simple:
            if batch and chars + len(u) > self.batch_chars // 16:
                batches.append(batch)
                batch, chars = [], 0
            batch.append(u)
            chars += len(u) + 1
        if batch:
            batches.append(batch)
        for b, coded in zip(batches, self._batch([" " + " ".join(b) for b in batches])):
            ids = np.asarray(coded, dtype="<u4")
            starts = np.flatnonzero(self.opens[ids])
            if len(starts) != len(b):
                found.update((u, self._plain(" " + u)) for u in b)
                continue
            raw, cuts = ids.tobytes(), [*(4 * starts).tolist(), 4 * len(ids)]
            found.update((u, raw[i:j]) for u, i, j in zip(b, cuts, cuts[1:]))
        return found

    def _encode_first(self, units: list[str]) -> dict[str, bytes]:
        return {u: np.asarray(ids, dtype="<u4").tobytes() for u, ids in zip(units, self._batch(units))}

    def _batch(self, texts: list[str]) -> list[list[int]]:
        if self.fast is not None:
            return [self.fast.encode_ordinary(t) for t in texts]
        return [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _resolve(self, units: list[str], cache: dict[str, bytes], encode) -> list[bytes]:
        if len(cache) > self.cache_units:
            cache.clear()
        out = list(map(cache.get, units))
        if None in out:
            new = encode(sorted({u for u, o in zip(units, out) if o is None}))
            cache.update((u, b) for u, b in new.items() if len(u) <= LONGEST_CACHED)
            out = [new[u] if o is None else o for u, o in zip(units, out)]
        return out

    def _slices(self, text: str) -> Iterator[tuple[bool, str]]:
        """Cuts a long text at safe boundaries; says whether a slice starts the text."""
        at, first = 0, True
        while len(text) - at > self.batch_chars:
            m = SAFE.search(text, at + self.batch_chars)
            if m is None:
                break
            yield first, text[at : m.start()]
            at, first = m.end(), False
        yield first, text[at:]

    def _segments(self, text: str) -> Iterator[tuple[bool, str]]:
        """The text between special strings, and those strings."""
        if self.split_special is None or not any(s in text for s in self.special):
            yield False, text
            return
        for part in self.split_special.split(text):
            if part:
                yield part in self.special, part

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of every text, in order; a null text has none."""
        jobs: list[tuple[int, bytes | None, str | None, int]] = []
        waiting, chars, units = 0, 0, []
        for text in texts:
            for special, part in self._segments(text or ""):
                if special:
                    jobs.append((waiting, self.special[part], None, 0))
                    continue
                for first, s in self._slices(part):
                    cut = s.split(" ") if UNSAFE.search(s) is None else SAFE.split(s)
                    jobs.append((waiting, None, cut[0] if first else None, len(cut) - first))
                    units += cut[1:] if first else cut
                    chars += len(s)
                    if chars >= self.batch_chars and waiting == 0:  # a long text by itself: do not gather its units
                        jobs, units, chars = [(0, b"".join(self._finish(jobs, units, 1)), None, 0)], [], 0
            waiting += 1
            if chars >= self.batch_chars:
                yield from self._finish(jobs, units, waiting)
                jobs, waiting, chars, units = [], 0, 0, []
        yield from self._finish(jobs, units, waiting)

    def _finish(self, jobs, units: list[str], n: int) -> list[bytes]:
        firsts = [j[2] for j in jobs if j[2] is not None]
        inner = self._resolve(units, self.inner, self._encode_inner)
        head = iter(self._resolve(firsts, self.first, self._encode_first))
        parts: list[list[bytes]] = [[] for _ in range(n)]
        at = 0
        for k, ready, first, count in jobs:
            if ready is not None:
                parts[k].append(ready)
                continue
            if first is not None:
                parts[k].append(next(head))
            parts[k].append(b"".join(inner[at : at + count]))
            at += count
        return [b"".join(p) for p in parts]
