"""Token files: ids coded by one canonical length-limited Huffman code, in independent blocks.

A folder holds three parquet tables. ``codes`` has the code length of every id that occurs, from
the global counts; canonical codes follow from the lengths. ``blocks`` has a row per block of
consecutive documents (ascending doc_id): its ids as one bit string, the ids' number per document,
and the bit offset of every ``CHECKPOINT``-th id, from which decoding can start. ``starts`` has the
number of ids before each block. Spark writes and reads the folder, so any store will do and a
block is the unit of recovery.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docquarry.llm.common import Scratch, bounded_batches
from docquarry.llm.encode import encoder
from docquarry.llm.words import text_slices

BLOCK_IDS = 1 << 16
CHECKPOINT = 128

_BLOCK = [("part", pa.int64()), ("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64()))]
_BLOCK_SQL = "part long, block long, doc_ids array<long>, sizes array<long>"


def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits for positive ``counts`` (package-merge)."""
    n = len(counts)
    if n <= 1:
        return np.ones(n, np.int64)
    if limit < (n - 1).bit_length():
        raise ValueError(f"{n} symbols do not fit into codes of {limit} bits")
    order = np.argsort(counts, kind="stable")
    weights = counts[order].astype(np.float64)
    leaf_masks, packages = [], np.empty(0)
    for _ in range(limit):
        both = np.concatenate([weights, packages])
        rank = np.argsort(both, kind="stable")
        leaf_masks.append(rank < n)
        both = both[rank]
        packages = both[0 : len(both) // 2 * 2 : 2] + both[1 : len(both) // 2 * 2 : 2]
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for is_leaf in reversed(leaf_masks):
        leaves = int(is_leaf[:take].sum())
        lengths[:leaves] += 1
        take = 2 * (take - leaves)
    out = np.empty(n, np.int64)
    out[order] = lengths
    return out


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes of symbols 0, 1, ...: ascending by length, then symbol. Length 0 has no code."""
    codes, code, before = np.zeros(len(lengths), np.uint64), 0, 0
    for length in range(1, int(lengths.max(initial=0)) + 1):
        code <<= length - before
        before = length
        same = np.flatnonzero(lengths == length)
        codes[same] = np.arange(code, code + len(same), dtype=np.uint64)
        code += len(same)
    return codes


def encode_block(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The bit string, as big-endian 64-bit words, and the bit offset of every checkpoint."""
    size = lengths[ids]
    ends = np.cumsum(size)
    starts = ends - size
    words = np.zeros(int(ends[-1] + 63) // 64 + 1 if len(ids) else 1, np.uint64)
    if len(ids):
        at, room, code = starts >> 6, 64 - (starts & 63) - size, codes[ids]
        whole = np.where(room >= 0, code << np.maximum(room, 0).astype(np.uint64), code >> np.maximum(-room, 0).astype(np.uint64))
        firsts = np.flatnonzero(np.diff(at, prepend=-1))
        words[at[firsts]] = np.add.reduceat(whole, firsts)  # codes share no bit, so sums are unions
        over = np.flatnonzero(room < 0)
        words[at[over] + 1] += code[over] << (64 + room[over]).astype(np.uint64)
    return words.astype(">u8").tobytes(), starts[::CHECKPOINT]


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """For every value of the next ``limit`` bits, the symbol they begin with and its length."""
    limit = int(lengths.max(initial=1))
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    fill = np.int64(1) << (limit - lengths[order])
    symbol = np.zeros(1 << limit, np.uint32)
    symbol[: fill.sum()] = np.repeat(order, fill)
    return symbol, lengths[symbol], limit


def decode_block(payload: bytes, checkpoints: np.ndarray, n: int, table: tuple[np.ndarray, np.ndarray, int]) -> np.ndarray:
    """The ``n`` ids of a block; all checkpoints are followed side by side."""
    symbol, size, limit = table
    words = np.append(np.frombuffer(payload, ">u8").astype(np.uint64), np.uint64(0))
    at = np.asarray(checkpoints, np.int64).copy()
    out = np.zeros((CHECKPOINT, len(at)), np.uint32)
    top = np.uint64(64 - limit)
    for step in range(min(CHECKPOINT, n)):
        lanes = len(at) if step < n - CHECKPOINT * (len(at) - 1) else len(at) - 1
        here = at[:lanes]
        word, bit = here >> 6, (here & 63).astype(np.uint64)
        # A shift by 64 is undefined, so the second word is shifted in two steps.
        window = (words[word] << bit) | ((words[word + 1] >> np.uint64(1)) >> (np.uint64(63) - bit))
        key = (window >> top).astype(np.int64)
        out[step, :lanes] = symbol[key]
        at[:lanes] = here + size[key]
    return out.T.reshape(-1)[:n]


def _blocks(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Blocks of whole documents in ascending doc_id; a block closes once it has ``BLOCK_IDS`` ids."""
    schema = pa.schema([*_BLOCK, ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(tokenizer).encode, TaskContext.get().partitionId()
        block, n, doc_ids, sizes, data = 0, 0, [], [], []

        def closed() -> pa.RecordBatch:
            ids = np.concatenate(data).astype("<u4")
            # Ids of a vocabulary under 65,536 are kept in two bytes until they are coded.
            blob = (ids.astype("<u2") if ids.max() < 1 << 16 else ids).tobytes()
            row = [[part], [block], [doc_ids], [sizes], [blob]]
            return pa.record_batch([pa.array(x, f.type) for x, f in zip(row, schema)], schema=schema)

        for batch in batches:
            for lo, hi in text_slices(batch.column("text")):
                column = batch.slice(lo, hi - lo)
                ids, borders = encode(column.column("text"))
                for doc_id, a, b in zip(column.column("doc_id").to_pylist(), borders[:-1].tolist(), borders[1:].tolist()):
                    doc_ids.append(doc_id)
                    sizes.append(b - a + 1)
                    data += [ids[a:b], np.array([end_id], np.uint32)]
                    n += sizes[-1]
                    if n >= BLOCK_IDS:
                        yield closed()
                        block, n, doc_ids, sizes, data = block + 1, 0, [], [], []
        if doc_ids:
            yield closed()

    return docs.mapInArrow(run, f"{_BLOCK_SQL}, ids binary")


def _block_ids(blob, sizes) -> np.ndarray:
    return np.frombuffer(blob.as_buffer(), "<u4" if len(blob.as_buffer()) == 4 * sum(sizes) else "<u2")


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int, folder: str) -> None:
    """Encode every whole text of ``docs`` (doc_id, text), ended by ``end_id``, into ``folder``.

    Documents stand in ascending doc_id, a null id first; rows that repeat an id stand in the order
    of their texts. A null or empty text is the end id alone. An empty table gives empty tables.
    Other columns are ignored.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    scratch = Scratch(spark, "token-files")
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    blocks = _blocks(read.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text"), tokenizer, end_id)
    blocks.write.option("compression", "zstd").parquet(path := f"{scratch.folder}/ids")
    blocks = spark.read.schema(blocks.schema).parquet(path)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for blob, sizes in zip(batch.column("ids"), batch.column("sizes").to_pylist()):
                seen = np.bincount(_block_ids(blob, sizes))
                total = np.pad(total, (0, max(0, len(seen) - len(total))))
                total[: len(seen)] += seen
        ids = np.flatnonzero(total)
        yield pa.record_batch({"id": pa.array(ids), "n": pa.array(total[ids])})

    # One row for each id of the vocabulary at most.
    counts = blocks.mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).orderBy("id").collect()
    used, n = np.array([r.id for r in counts], np.int64), np.array([r.n for r in counts], np.int64)
    size = int(used.max(initial=0)) + 1
    lengths = np.zeros(size, np.int64)
    lengths[used] = code_lengths(n, max(16, len(used).bit_length() + 2))
    coded = [(int(i), int(lengths[i])) for i in used]
    spark.createDataFrame(coded, "id long, bits long").coalesce(1).write.parquet(f"{folder}/codes")

    shared = spark.sparkContext.broadcast((canonical_codes(lengths), lengths))
    schema = pa.schema([*_BLOCK, ("payload", pa.binary()), ("checkpoints", pa.list_(pa.int64()))])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [encode_block(_block_ids(blob, sizes), *shared.value) for blob, sizes in zip(batch.column("ids"), batch.column("sizes").to_pylist())]
            columns = [batch.column(name) for name, _ in _BLOCK]
            yield pa.record_batch([*columns, pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.list_(pa.int64()))], schema=schema)

    blocks.mapInArrow(code, f"{_BLOCK_SQL}, payload binary, checkpoints array<long>").write.parquet(f"{folder}/blocks")

    # Sums run over the blocks of a part, and over the parts.
    sizes = scratch.keep(blocks.select("part", "block", F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x).alias("n")))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("within", F.coalesce(F.sum("n").over(within), F.lit(0))).join(parts, "part")
    starts.select("part", "block", (F.col("before") + F.col("within")).alias("start")).write.parquet(f"{folder}/starts")


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document; ids are little-endian unsigned 32-bit."""
    bounded_batches(spark)
    coded = spark.read.schema("id long, bits long").parquet(f"{folder}/codes").collect()
    lengths = np.zeros(max((r.id for r in coded), default=0) + 1, np.int64)
    lengths[[r.id for r in coded]] = [r.bits for r in coded]
    table = spark.sparkContext.broadcast(decode_table(lengths))
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                sizes = np.asarray(row["sizes"], np.int64)
                borders = np.concatenate([[0], np.cumsum(sizes)])
                data = decode_block(row["payload"], row["checkpoints"], int(borders[-1]), table.value).astype("<u4").tobytes()
                blobs = [data[4 * a : 4 * b] for a, b in zip(borders[:-1].tolist(), borders[1:].tolist())]
                yield pa.record_batch([pa.array(row["doc_ids"], pa.int64()), pa.array(row["start"] + borders[:-1]), pa.array(sizes), pa.array(blobs, pa.binary())], schema=schema)

    blocks = spark.read.schema(f"{_BLOCK_SQL}, payload binary, checkpoints array<long>").parquet(f"{folder}/blocks")
    starts = spark.read.schema("part long, block long, start long").parquet(f"{folder}/starts")
    return blocks.join(starts, ["part", "block"]).mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")
