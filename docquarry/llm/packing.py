"""Harmonic packing of token sequences.

A document is cut into whole sequences and pieces of a half, a quarter, and so on down to
``capacity / 32`` tokens, and one tail of fewer. A piece of length in (capacity / (k + 1),
capacity / k] is of class k, and a bin of class k takes exactly k pieces. Workers fill the bins of
each class independently of each other. Pieces left over in a worker's last bins, fewer than k per
class, are few: buckets of workers fill further bins with them in the same way, and the rest of a
bucket, again fewer than k per class, is packed first-fit by falling length.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docquarry.llm.common import Scratch, bounded_batches
from docquarry.llm.encode import encoder
from docquarry.llm.words import HASHED, text_slices

#: Workers whose left-over pieces are packed together.
WORKERS_PER_BUCKET = 64

_PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids", pa.binary()),
        ("worker", pa.int64()),
        ("piece", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
    ]
)
_PIECES_SQL = "doc_id long, doc_tokens long, start long, length long, ids binary, worker long, piece long, sequence_id long, offset long"


def piece_lengths(n: int, capacity: int) -> list[int]:
    """Lengths of the pieces of a document of ``n`` tokens, in order."""
    out = [capacity] * (n // capacity)
    rest, half = n % capacity, capacity // 2
    while half * 32 >= capacity and half:
        if rest >= half:
            out.append(half)
            rest -= half
        half //= 2
    while rest:  # one tail of less than capacity / 32; several only if the capacity is no multiple of 32
        out.append(min(rest, max(1, capacity // 32)))
        rest -= out[-1]
    return out


def _pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, worker = encoder(tokenizer).encode, TaskContext.get().partitionId()
        open_bins: dict[int, list[tuple]] = defaultdict(list)
        n_pieces = n_sequences = 0
        for batch in batches:
            for lo, hi in text_slices(batch.column("text"), HASHED):
                part = batch.slice(lo, hi - lo)
                ids, borders = encode(part.column("text"))
                done = []
                for doc_id, a, b in zip(part.column("doc_id").to_pylist(), borders[:-1].tolist(), borders[1:].tolist()):
                    data = np.append(ids[a:b], np.uint32(end_id)).astype("<u4").tobytes()
                    n, start = len(data) // 4, 0
                    for length in piece_lengths(n, capacity):
                        piece = (doc_id, n, start, length, data[4 * start : 4 * (start + length)], worker, n_pieces)
                        start += length
                        n_pieces += 1
                        k = capacity // length
                        same = open_bins[k]
                        same.append(piece)
                        if len(same) == k:
                            sequence, offset = (worker << 33) + n_sequences, 0
                            for x in same:
                                done.append((*x, sequence, offset))
                                offset += x[3]
                            n_sequences += 1
                            same.clear()
                yield _batch(done)
        yield _batch([(*x, None, None) for same in open_bins.values() for x in same])

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return read.mapInArrow(run, _PIECES_SQL)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[] for _ in _PIECES]
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, _PIECES)], schema=_PIECES)


def _place_left(left: DataFrame, capacity: int) -> DataFrame:
    """(worker, piece, sequence_id, offset) of the pieces that filled no bin of their worker."""
    left = left.select("worker", "piece", "length")
    left = left.withColumn("k", F.floor(F.lit(capacity) / F.col("length"))).withColumn("bucket", F.floor(F.col("worker") / WORKERS_PER_BUCKET))
    same = Window.partitionBy("bucket", "k")
    at = left.withColumn("at", F.row_number().over(same.orderBy("worker", "piece")) - 1).withColumn("n", F.count("*").over(same))
    at = at.withColumn("bin", F.floor(F.col("at") / F.col("k"))).withColumn("filled", (F.col("bin") + 1) * F.col("k") <= F.col("n"))
    in_bin = Window.partitionBy("bucket", "k", "bin").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    filled = at.where("filled").select(
        "worker",
        "piece",
        # A bucket's sequences: the class, then the bin, within a range of their own.
        (F.lit(1 << 62) + F.col("bucket") * (1 << 40) + F.col("k") * (1 << 28) + F.col("bin")).alias("sequence_id"),
        F.coalesce(F.sum("length").over(in_bin), F.lit(0)).alias("offset"),
    )

    def first_fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "worker", "piece"], ascending=[False, True, True])
        free, where, offset = np.empty(0, np.int64), [], []
        for length in pdf["length"].tolist():
            fits = np.flatnonzero(free >= length)
            if not len(fits):
                free, fits = np.append(free, capacity), [len(free)]
            where.append(int(fits[0]))
            offset.append(int(capacity - free[fits[0]]))
            free[fits[0]] -= length
        base = (1 << 62) + int(pdf["bucket"].iloc[0]) * (1 << 40)
        return pd.DataFrame({"worker": pdf["worker"], "piece": pdf["piece"], "sequence_id": [base + w for w in where], "offset": offset})

    rest = at.where("NOT filled").select("bucket", "worker", "piece", "length")
    return filled.unionByName(rest.groupBy("bucket").applyInPandas(first_fit, "worker long, piece long, sequence_id long, offset long"))


def pack(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 1024) -> DataFrame:
    """Pack every whole text of ``docs`` (doc_id, text), encoded and ended by ``end_id``, into sequences.

    One row per piece: ``doc_id``, ``doc_tokens``, ``start`` (ids of its document before it),
    ``length``, ``ids`` (little-endian unsigned 32-bit), ``sequence_id``, ``offset`` (place in the
    sequence, gapless from 0). Sequences hold at most ``capacity`` ids.

    Defined cases: a null or empty text is the end id alone. Rows that repeat an id, or have a null
    one, are packed each on their own. An empty table gives no pieces. Other columns are ignored.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    bounded_batches(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "packing")
    pieces = scratch.keep(_pieces(docs, tokenizer, end_id, capacity))
    columns = ["doc_id", "doc_tokens", "start", "length", "ids", "sequence_id", "offset"]
    left = pieces.where("sequence_id IS NULL").drop("sequence_id", "offset")
    placed = left.join(scratch.keep(_place_left(left, capacity)), ["worker", "piece"])
    return pieces.where("sequence_id IS NOT NULL").select(columns).unionByName(placed.select(columns))
