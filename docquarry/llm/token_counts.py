"""Token counts by byte-pair merging with a heap and a linked list; no identifiers are made.

A piece of text (what the tokenizer's pattern finds) starts as its bytes, linked to their
neighbours. The adjacent pair of lowest rank, the leftmost of equals, is popped from a heap and
merged, and the pairs its merged symbol forms are pushed. A piece of n bytes that took m merges has
n - m tokens, in O(n log n) whatever the piece's length.
"""

from __future__ import annotations

import json
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquarry.llm.common import bounded_batches

#: Counts that a worker remembers, and the longest piece it does so for; beyond, it forgets them all and goes on.
REMEMBERED = 400_000
REMEMBERED_LENGTH = 64

# Fixed value: the pieces of the byte-level pre-tokenizer.
_PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def byte_symbols() -> dict[str, int]:
    """The printable stand-ins of the 256 bytes in a byte-level vocabulary."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    out = {chr(b): b for b in plain}
    out.update({chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(plain))})
    return out


@lru_cache(maxsize=1)
def _unsettled() -> np.ndarray:
    """Marks code points this Python's tables do not know: pattern libraries of other ages may class them differently."""
    return np.fromiter((unicodedata.category(chr(c)) == "Cn" for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def _settled(text: str) -> bool:
    return text.isascii() or not _unsettled()[np.frombuffer(text.encode("utf-32-le"), "<u4")].any()


class Merges:
    """The merges of a byte-level BPE file: rank and merged symbol of each pair."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as handle:
            spec = json.load(handle)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        plain = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        if not plain or spec["normalizer"] or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex"):
            raise ValueError(f"{path} is no plain byte-level BPE file")
        special = [t for t in spec["added_tokens"]]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in special):
            raise ValueError("added tokens that take blanks or word ends into account are not supported")
        names = sorted((t["content"] for t in special), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, names))) if names else None
        symbols = byte_symbols()
        self.ranks: dict[int, int] = {}
        self.merged: list[int] = []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks.setdefault(symbols[left] << 32 | symbols[right], rank)
            self.merged.append(symbols.setdefault(left + right, len(symbols)))
        self._path, self._library = path, None

    def pieces(self, text: str) -> list[str]:
        if _settled(text):
            return _PIECE.findall(text)
        # Newer characters are classed as the tokenizer's own library classes them.
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self._path).pre_tokenizer
        return [text[a:b] for _, (a, b) in self._library.pre_tokenize_str(text)]

    def count(self, piece: bytes) -> int:
        """Tokens of one piece: its bytes less the merges that can be made."""
        ranks, merged, n = self.ranks, self.merged, len(piece)
        symbol = list(piece)
        heap = []
        for i in range(n - 1):
            rank = ranks.get(symbol[i] << 32 | symbol[i + 1])
            if rank is not None:
                heap.append(rank << 32 | i)
        if not heap:
            return n
        heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        left = n
        while heap:
            top = heappop(heap)
            rank, i = top >> 32, top & 0xFFFFFFFF
            j = after[i]
            # Stale: the symbol was merged away, or one of the two is another by now.
            if symbol[i] < 0 or j >= n or ranks.get(symbol[i] << 32 | symbol[j]) != rank:
                continue
            new, k, h = merged[rank], after[j], before[i]
            symbol[i], symbol[j], after[i] = new, -1, k
            left -= 1
            if k < n:
                before[k] = i
                found = ranks.get(new << 32 | symbol[k])
                if found is not None:
                    heappush(heap, found << 32 | i)
            if h >= 0:
                found = ranks.get(symbol[h] << 32 | new)
                if found is not None:
                    heappush(heap, found << 32 | h)
        return left


class _Known(dict):
    """Counts of pieces, worked out when they are first asked for."""

    def __init__(self, merges: Merges):
        super().__init__()
        self._merges = merges

    def __missing__(self, piece: str) -> int:
        n = self._merges.count(piece.encode())
        if len(piece) <= REMEMBERED_LENGTH:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = n
        return n


class Counter:
    """Counts tokens of whole texts; a special token's string is one token, as the library has it."""

    def __init__(self, path: str):
        self._merges = Merges(path)
        self._known = _Known(self._merges)

    def __call__(self, text: str) -> int:
        special = self._merges.special
        parts = special.split(text) if special else [text]
        return len(parts) - 1 + sum(sum(map(self._known.__getitem__, self._merges.pieces(part))) for part in parts)


@lru_cache(maxsize=2)
def _counter(path: str) -> Counter:
    """One for each worker process: its memory of pieces outlives the task."""
    return Counter(path)


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 512) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every whole text of ``docs`` (doc_id, text).

    ``tokenizer`` is the path of a byte-level BPE file of the tokenizers library, present on every
    executor. Nothing is added to the texts, none is cut. ``n_bytes`` counts UTF-8.

    Defined cases: a null or empty text has no bytes and no tokens. Every row counts for itself, with
    whatever id, null or repeated. An empty table gives an empty result. Other columns are ignored.
    """
    bounded_batches(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(tokenizer)
        for batch in batches:
            found = [count(text.as_py()) for text in batch.column("text")]
            yield pa.record_batch([batch.column("doc_id"), batch.column("n_bytes"), pa.array(found, pa.int64())], schema=schema)

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    return read.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
