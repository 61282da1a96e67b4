"""Spelling variants of a vocabulary: words one edit apart, found through Bloom filters.

The vocabulary's hashes fill blocked Bloom filters, one for each word length, that are broadcast.
Every word's edits are hashed without being spelt out, from running sums of a polynomial hash, and
probed in the filter of the length they would have. Only edits that the filter holds are spelt and
shuffled, to an exact join with the vocabulary that removes the false positives.

A pair is looked for once: the longer word finds the shorter by a deletion, and of two words of a
length the one with the lesser character finds the other by a replacement.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquarry.llm.common import Scratch, bounded_batches
from docquarry.llm.words import mix

#: Words from this length on share a shard.
LONGEST_SHARD = 64
#: A block is 8 lanes of 32 bits, and each key sets one bit of each lane of its block.
_LANES = 8
#: Blocks of a filter that are built in one task: 1 MB.
_CHUNK = 1 << 15
_PROBES = 1 << 20

_RNG = np.random.default_rng(20240713)
_CHAR = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LANE = _RNG.integers(0, 1 << 31, _LANES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = np.uint64(pow(_BASE, -1, 1 << 64))

#: Characters of words: a to z, and U+00C0 to U+00FF, which keep their case.
_LETTERS = np.array([*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)], np.uint8)


@dataclass(frozen=True)
class VariantParams:
    """``filter_bytes`` bounds what is broadcast; a larger vocabulary is gone through in several
    passes, each with the filters of a part of it, and each probing all edits."""

    least_length: int = 7
    least_count: int = 2
    times: int = 10
    bits_per_word: int = 20
    filter_bytes: int = 32 << 20


def vocabulary(docs: DataFrame, least_length: int = 7, least_count: int = 2, drop_one_in: int = 31) -> DataFrame:
    """(word, n): lower-cased (A-Z) runs of letters of all whole texts, with their occurrences.

    A run whose crc32 with its document's id is divisible by ``drop_one_in`` loses a character.
    Occurrences are counted in each task before they are shuffled.
    """
    # A shorter run cannot give a word that is long enough, and a match of this pattern is a maximal run.
    runs = F.regexp_extract_all(F.col("text").cast("string"), F.lit(f"[A-Za-zÀ-ÿ]{{{least_length},}}"), F.lit(0))
    low = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    low = low.select("id", F.translate("run", string.ascii_uppercase, string.ascii_lowercase).alias("run"))
    hashed = low.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))
    words = hashed.select(F.when(F.col("h") % drop_one_in == 0, shorter).otherwise(F.col("run")).alias("word"))
    counted = words.where(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= least_count)


class _Words:
    """Words of a batch as code points (all are under 256), with running sums of their hash."""

    def __init__(self, words: list[str]):
        self.words = words
        self.raw = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
        self.length = np.fromiter(map(len, words), np.int64, len(words))
        self.ends = np.cumsum(self.length)
        self.starts = self.ends - self.length
        self.word = np.repeat(np.arange(len(words)), self.length)
        self.place = np.arange(len(self.raw)) - self.starts[self.word]
        steps = np.full(max(int(self.length.max(initial=0)), 1), _BASE, np.uint64)
        steps[0] = 1
        self.power = np.cumprod(steps, dtype=np.uint64)[self.place]
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(_CHAR[self.raw] * self.power, dtype=np.uint64)])
        self.hashes = self.sums[self.ends] - self.sums[self.starts]

    def keys(self) -> np.ndarray:
        return mix(self.hashes)

    def deletions(self) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the words without one character, and the place in ``raw`` of that character.

        Of a run of equal characters only the last is deleted, so that no edit comes twice.
        """
        last = np.ones(len(self.raw), bool)
        last[:-1] = (self.raw[:-1] != self.raw[1:]) | (self.word[:-1] != self.word[1:])
        at = np.flatnonzero(last)
        word = self.word[at]
        before = self.sums[at] - self.sums[self.starts[word]]
        return mix(before + (self.sums[self.ends[word]] - self.sums[at + 1]) * _INVERSE), at

    def replacements(self) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """For each letter, keys of the words with it for a lesser character, and the place of that."""
        whole = self.hashes[self.word]
        for letter in _LETTERS.tolist():
            at = np.flatnonzero(self.raw < letter)
            yield mix(whole[at] + (_CHAR[letter] - _CHAR[self.raw[at]]) * self.power[at]), at, letter

    def spelt(self, at: int, letter: str) -> str:
        word = self.words[self.word[at]]
        return word[: self.place[at]] + letter + word[self.place[at] + 1 :]


def _shard(length):
    return np.minimum(length, LONGEST_SHARD)


def _bit_of(keys: np.ndarray, lane: int) -> np.ndarray:
    return (keys.astype(np.uint32) * _LANE[lane]) >> np.uint32(27)


@dataclass(frozen=True)
class Shards:
    """Where in the filter the blocks of each shard are: ``first[s]`` and ``n[s]``, none for an empty shard."""

    first: np.ndarray
    n: np.ndarray

    @staticmethod
    def of(counts: dict[int, int], bits_per_word: int) -> "Shards":
        n = np.zeros(LONGEST_SHARD + 1, np.int64)
        for shard, words in counts.items():
            n[shard] = -(-words * bits_per_word // (32 * _LANES))
        return Shards(np.cumsum(n) - n, n)

    def block(self, keys: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The block of each key; -1 where its shard is empty."""
        shard = _shard(length)
        n = self.n[shard].astype(np.uint64)
        at = ((keys >> np.uint64(32)) * n) >> np.uint64(32)
        return np.where(n > 0, self.first[shard] + at.astype(np.int64), -1)


def _pass_of(keys: np.ndarray, passes: int) -> np.ndarray:
    # Other bits than those that choose the block.
    return (mix(keys) % np.uint64(passes)).astype(np.int64)


def held(filters: np.ndarray, shards: Shards, keys: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Places of the keys that the filters (blocks, lanes) hold; lane by lane, of those still left."""
    block = shards.block(keys, length)
    left = np.flatnonzero(block >= 0)
    for lane in range(_LANES):
        left = left[(filters[block[left], lane] >> _bit_of(keys[left], lane)) & np.uint32(1) == 1]
    return left


def build_filters(words: DataFrame, shards: Shards, passes: int, which: int) -> np.ndarray:
    """The filters (blocks, lanes) of one pass; chunks of blocks are filled in tasks of their own."""

    def keys_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = _Words(batch.column("word").to_pylist())
            keys = some.keys()
            mine = np.flatnonzero(_pass_of(keys, passes) == which)
            block = shards.block(keys[mine], some.length[mine])
            yield pa.record_batch({"chunk": pa.array(block // _CHUNK, pa.int32()), "block": pa.array(block % _CHUNK, pa.int32()), "key": pa.array(keys[mine].astype(np.uint32), pa.int64())})

    def fill(table: pa.Table) -> pa.Table:
        lanes = np.zeros((_CHUNK, _LANES), np.uint32)
        block, keys = table.column("block").to_numpy(), table.column("key").to_numpy().astype(np.uint64)
        for lane in range(_LANES):
            np.bitwise_or.at(lanes[:, lane], block, np.uint32(1) << _bit_of(keys, lane))
        return pa.table({"chunk": table.column("chunk").slice(0, 1), "lanes": pa.array([lanes.astype("<u4").tobytes()], pa.binary())})

    chunks = words.select("word").mapInArrow(keys_of, "chunk int, block int, key long").groupBy("chunk").applyInArrow(fill, "chunk int, lanes binary")
    n_blocks = int(shards.n.sum())
    out = np.zeros((-(-n_blocks // _CHUNK) * _CHUNK, _LANES), np.uint32)
    for row in chunks.toLocalIterator():
        out[row.chunk * _CHUNK : (row.chunk + 1) * _CHUNK] = np.frombuffer(row.lanes, "<u4").reshape(-1, _LANES)
    return out[:n_blocks]


def _candidates(words: DataFrame, filters: np.ndarray, shards: Shards, passes: int, which: int) -> DataFrame:
    """(word, n, other): edits of all words that the filters of one pass hold."""
    send = words.sparkSession.sparkContext.broadcast(filters)
    schema = pa.schema([("word", pa.string()), ("n", pa.int64()), ("other", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(some: _Words, counts: np.ndarray, keys: np.ndarray, at: np.ndarray, shorter: int, letter: str) -> pa.RecordBatch:
            mine = np.flatnonzero(_pass_of(keys, passes) == which) if passes > 1 else np.arange(len(keys))
            hits = at[mine[held(send.value, shards, keys[mine], some.length[some.word[at[mine]]] - shorter)]].tolist()
            columns = [[some.words[some.word[i]] for i in hits], counts[some.word[hits]], [some.spelt(i, letter) for i in hits]]
            return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        for batch in batches:
            # Blocks of words with a bounded number of characters.
            sizes = np.cumsum(np.asarray(pa.compute.binary_length(batch.column("word"))))
            for block in np.split(np.arange(len(batch)), np.flatnonzero(np.diff(sizes // _PROBES)) + 1):
                if len(block):
                    part = batch.slice(int(block[0]), len(block))
                    some, counts = _Words(part.column("word").to_pylist()), part.column("n").to_numpy()
                    keys, at = some.deletions()
                    yield found(some, counts, keys, at, 1, "")
                    for keys, at, letter in some.replacements():
                        yield found(some, counts, keys, at, 0, chr(letter))

    return words.select("word", "n").mapInArrow(run, "word string, n long, other string")


def near_words(words: DataFrame, scratch: Scratch, params: VariantParams = VariantParams()) -> DataFrame:
    """(word, n, other, other_n): all ordered pairs of words of ``words`` (word, n) one edit apart.

    An edit is one inserted, deleted or replaced code point. Words must be distinct.
    """
    length = F.least(F.length("word"), F.lit(LONGEST_SHARD)).alias("shard")
    # One row for each shard, 64 at most.
    counts = {r.shard: r["count"] for r in words.groupBy(length).count().collect()}
    passes = max(1, -(-sum(counts.values()) * params.bits_per_word // (8 * params.filter_bytes)))
    shards = Shards.of({s: -(-c // passes) for s, c in counts.items()}, params.bits_per_word)
    found = None
    for which in range(passes):
        some = scratch.keep(_candidates(words, build_filters(words, shards, passes, which), shards, passes, which))
        found = some if found is None else found.unionByName(some)
    exact = found.join(words.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other")
    exact = scratch.keep(exact.select("word", "n", "other", "other_n"))
    back = exact.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    return exact.unionByName(back)


def _roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, root) by following (word, form) to the end; pointers double, so rounds are few.

    A form is at least twice as frequent as its word, so there is no circle, and 64 steps are the most.
    """
    now = scratch.keep(forms.select("word", F.col("form").alias("root")))
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        after = scratch.keep(now.join(further, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")))
        if after.where("moved").isEmpty():
            return after.drop("moved")
        now = after.drop("moved")


def spelling_variants(docs: DataFrame, params: VariantParams = VariantParams()) -> DataFrame:
    """Words of all whole texts of ``docs`` (doc_id, text), grouped with their spelling variants.

    One row per word: ``word``, ``form`` (its near word of largest count, the smallest of equals in
    code-point order, if that is at least ``times`` the word's own; else null), ``root`` (where forms
    lead; the word itself without one), ``n``, ``n_near`` and ``form_n``.

    Defined cases: a null or empty text has no words. A null id counts as an empty text. Every row
    counts, also those that repeat an id. An empty table gives an empty result. Other columns are ignored.
    """
    if params.times < 2:
        raise ValueError("a form must be at least twice as frequent as its word")
    spark = docs.sparkSession
    bounded_batches(spark)
    scratch = Scratch(spark, "spelling-variants")
    words = scratch.keep(vocabulary(docs, params.least_length, params.least_count))
    near = near_words(words, scratch, params)
    # The least of (-n, word) is the largest count, then the smallest word; strings compare by code point.
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("form"))).alias("best"))
    known = words.join(best, "word", "left")
    big = -F.col("best.n") >= params.times * F.col("n")
    known = scratch.keep(
        known.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(big, F.col("best.form")).alias("form"), F.when(big, -F.col("best.n")).alias("form_n"))
    )
    roots = _roots(known.where("form IS NOT NULL"), scratch)
    return known.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
