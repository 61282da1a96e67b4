"""Words of Arrow text columns as 64-bit hashes, computed over whole batches with numpy.

A word is hashed as a polynomial over its bytes, read off one running sum of the batch, so the cost
does not depend on the number of words. Everything wraps modulo 2**64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20
#: Bytes of text hashed at once where memory counts: the running sums of a slice take many times its bytes.
HASHED = 1 << 19

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes that words(text) of the contracts, ``[^\x20\x09-\x0D]+``, leave out.
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True

#: Letters, digits and every byte of a non-ASCII character.
WORDLIKE = np.zeros(256, bool)
WORDLIKE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTES = np.random.default_rng(20240229).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit over all output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(which: str, n: int) -> np.ndarray:
    have = _powers.get(which)
    if have is None or len(have) < n:
        steps = np.full(max(n, HASHED + 1), _BASE if which == "up" else _INVERSE, np.uint64)
        steps[0] = 1
        have = _powers[which] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def text_slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes each, so that memory follows the slice and not the batch."""
    sizes = np.zeros(len(column), np.int64)
    if len(column):
        sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(column), 0), dtype=np.int64)
    part = np.cumsum(sizes) // most
    edges = np.flatnonzero(np.diff(part)) + 1
    for lo, hi in zip([0, *edges.tolist()], [*edges.tolist(), len(column)]):
        if hi > lo:
            yield lo, hi


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all rows, and the row borders in them. A null is an empty text."""
    column = pa.compute.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    borders = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[borders[0] : borders[-1]] if data is not None else np.empty(0, np.uint8)
    return raw, borders - borders[0]


def spans(is_word: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each maximal run of word bytes; no run crosses a row border."""
    if not len(is_word):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    inner = borders[(borders > 0) & (borders < len(is_word))]
    before = np.empty_like(is_word)
    before[0], before[1:] = False, is_word[:-1]
    before[inner] = False
    after = np.empty_like(is_word)
    after[-1], after[:-1] = False, is_word[1:]
    after[inner - 1] = False
    return np.flatnonzero(is_word & ~before), np.flatnonzero(is_word & ~after) + 1


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, of_byte: np.ndarray = _BYTES) -> np.ndarray:
    """A 64-bit hash of each span of ``raw``; equal bytes have equal hashes. ``of_byte`` chooses the hash."""
    sums = np.empty(len(raw) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(of_byte[raw] * _power("up", len(raw)), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _power("down", len(raw) + 1)[starts])


def words(column: pa.Array, of: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased (A-Z) words of all rows, in order, and the row borders among them.

    ``of`` marks the bytes of words; without it they are all but blanks.
    """
    raw, borders = text_bytes(column)
    raw = LOWER[raw]
    starts, ends = spans(~BLANK[raw] if of is None else of[raw], borders)
    return span_hashes(raw, starts, ends), np.searchsorted(starts, borders)


def shingle_sets(column: pa.Array, size: int) -> list[np.ndarray]:
    """Per row the distinct shingles of ``size`` words, as ascending hashes.

    With fewer words the whole sequence is one shingle; without words the set is empty.
    """
    hashes, borders = words(column)
    factors = mix(np.arange(1, size + 1, dtype=np.uint64))
    rolled = np.zeros(max(0, len(hashes) - size + 1), np.uint64)
    for j, factor in enumerate(factors):
        rolled += hashes[j : j + len(rolled)] * factor
    rolled = mix(rolled)
    out = []
    for lo, hi in zip(borders[:-1].tolist(), borders[1:].tolist()):
        if hi - lo >= size:
            out.append(np.unique(rolled[lo : hi - size + 1]))
        elif hi > lo:
            out.append(mix((hashes[lo:hi] * factors[: hi - lo]).sum(keepdims=True, dtype=np.uint64) + np.uint64(hi - lo)))
        else:
            out.append(np.empty(0, np.uint64))
    return out
