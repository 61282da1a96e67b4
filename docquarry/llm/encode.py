"""Token ids of Arrow text columns by a tokenizers file, each distinct chunk encoded once.

Texts are cut only where both tokenizers in use start anew: before a single blank, and around a
single line feed, that stand between characters that are no white space. Chunks are told apart
within a slice by a 64-bit hash and their length, and across slices by a second hash as well.
"""

from __future__ import annotations

import os
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa

from docquarry.llm.words import span_hashes, text_bytes

#: Chunks, and ids of chunks, that a worker remembers, about 100 MB; beyond, it forgets them all and goes on.
REMEMBERED = 2_000_000
REMEMBERED_IDS = 8_000_000

_OTHER_BYTES = np.random.default_rng(20250117).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

_PLAIN = np.zeros(256, bool)
_PLAIN[0x21:0x7F] = True
_TWO_BYTE_LEAD = np.zeros(256, bool)
_TWO_BYTE_LEAD[0xC3:0xE0] = True  # no white space has such a first byte


def cuts(raw: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """Ascending starts of the chunks; the borders of rows are among them."""
    if not len(raw):
        return np.empty(0, np.int64)
    solid_before = np.zeros(len(raw), bool)  # the character before is no white space
    solid_before[1:] = _PLAIN[raw[:-1]]
    solid_before[2:] |= (raw[1:-1] >= 0x80) & _TWO_BYTE_LEAD[raw[:-2]]
    solid_after = np.zeros(len(raw), bool)
    solid_after[:-1] = _PLAIN[raw[1:]] | _TWO_BYTE_LEAD[raw[1:]]
    alone = solid_before & solid_after
    edges = borders[:-1][borders[:-1] < len(raw)]
    inner = edges[edges > 0]
    alone[edges] = False
    alone[inner - 1] = False
    start = alone & ((raw == 0x20) | (raw == 0x0A))
    start[1:] |= alone[:-1] & (raw[:-1] == 0x0A)
    start[edges] = True
    return np.flatnonzero(start)


class _Slots:
    """Numbers of known chunks by two 64-bit hashes; sorted arrays, a large one and a recent one."""

    def __init__(self) -> None:
        empty = np.empty(0, np.uint64)
        self._levels = [(empty, empty, np.empty(0, np.int64))] * 2

    def find(self, keys: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of each chunk, -1 if it is not known; and whether its key is taken."""
        slot, taken = np.full(len(keys), -1, np.int64), np.zeros(len(keys), bool)
        for known, others, slots in self._levels:
            if len(known):
                at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                same = known[at] == keys
                taken |= same
                slot = np.where(same & (others[at] == checks), slots[at], slot)
        return slot, taken

    def add(self, keys: np.ndarray, checks: np.ndarray, slots: np.ndarray) -> None:
        old, recent = self._levels[0], self._sorted(self._levels[1], (keys, checks, slots))
        if len(recent[0]) * 4 > len(old[0]):
            old, recent = self._sorted(old, recent), tuple(x[:0] for x in recent)
        self._levels = [old, recent]

    @staticmethod
    def _sorted(a: tuple, b: tuple) -> tuple:
        order = np.argsort(keys := np.concatenate([a[0], b[0]]), kind="stable")
        return keys[order], np.concatenate([a[1], b[1]])[order], np.concatenate([a[2], b[2]])[order]


class Encoder:
    """Encodes columns with a tokenizer file. Strings of special tokens in a text are ordinary text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True
        self._forget()

    def _forget(self) -> None:
        self._slots, self._n = _Slots(), 0
        self._flat, self._starts = np.empty(1 << 16, np.uint32), np.zeros(1 << 16, np.int64)

    def _append(self, chunks: list[str]) -> None:
        """Encode chunks; their ids follow those of the chunks before them, in buffers that double."""
        lists = [e.ids for e in self._tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        first, n = int(self._starts[self._n]), self._n + len(lists)
        last = first + int(sizes.sum())
        if last > len(self._flat):
            self._flat = np.concatenate([self._flat[:first], np.empty(2 * last - first, np.uint32)])
        if n >= len(self._starts):
            self._starts = np.concatenate([self._starts[: self._n + 1], np.zeros(2 * n, np.int64)])
        self._flat[first:last] = np.fromiter(chain.from_iterable(lists), np.uint32, last - first)
        self._starts[self._n + 1 : n + 1] = first + np.cumsum(sizes)
        self._n = n

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all rows as uint32, and the row borders among them. A null has none."""
        raw, borders = text_bytes(column)
        starts = cuts(raw, borders)
        if not len(starts):
            return np.empty(0, np.uint32), np.zeros(len(borders), np.int64)
        if self._n > REMEMBERED or self._starts[self._n] > REMEMBERED_IDS:
            self._forget()
        ends = np.append(starts[1:], len(raw))
        keys = span_hashes(raw, starts, ends) + (ends - starts).astype(np.uint64)
        code, keys = pd.factorize(keys)
        first_at = np.empty(len(keys), np.int64)
        first_at[code[::-1]] = np.arange(len(code) - 1, -1, -1)
        checks = span_hashes(raw, starts[first_at], ends[first_at], _OTHER_BYTES)
        slot, taken = self._slots.find(keys, checks)
        new = np.flatnonzero(slot < 0)
        slot[new] = self._n + np.arange(len(new))
        data, at = raw.tobytes(), first_at[new]
        self._append([data[a:b].decode() for a, b in zip(starts[at].tolist(), ends[at].tolist())])
        free = new[~taken[new]]
        self._slots.add(keys[free], checks[free], slot[free])
        at, size = self._starts[slot][code], (self._starts[slot + 1] - self._starts[slot])[code]
        sums = np.concatenate([[0], np.cumsum(size)])
        ids = self._flat[np.repeat(at - sums[:-1], size) + np.arange(sums[-1])]
        return ids, sums[np.searchsorted(starts, borders)]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One for each worker process: what it remembers outlives the task."""
    return Encoder(path)
