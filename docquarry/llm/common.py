"""What several operators share: scratch tables, bounded bitmaps, connected components."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.settings import bounded_batches, shared_dir
from docquarry.sources.tables import stored

#: Bits of a broadcast bitmap: 8 MB whatever the input's size. Where it fills up, more rows pass
#: a filter, which an exact join then repeats.
BITMAP_BITS = 26
_BLOCK_BITS = 20


class Scratch:
    """A fresh folder on shared storage for the tables of one run."""

    def __init__(self, spark: SparkSession, label: str):
        self._spark, self.folder, self._n = spark, shared_dir(spark, label), itertools.count()

    def keep(self, df: DataFrame) -> DataFrame:
        """Write ``df`` and go on from the file: cuts the lineage, gives the real size."""
        return stored(df, f"{self.folder}/t{next(self._n)}")

    def drop(self) -> None:
        """Delete the tables, once nothing reads them any more. Whichever store the folder is in, Spark reaches it."""
        path = self._spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self._spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*columns)


def fold(doc_id: str, folds: int):
    """Remainder of the crc32 of the id's text; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds


def bitmap(df: DataFrame, column: str, bits: int = BITMAP_BITS) -> np.ndarray:
    """A bitmap of fixed size in which the low ``bits`` bits of each value are set."""
    blocks = 1 << (bits - _BLOCK_BITS)

    def block_of(pdf: pd.DataFrame) -> pd.DataFrame:
        marks = np.zeros(1 << _BLOCK_BITS, bool)
        marks[pdf["at"].to_numpy()] = True
        return pd.DataFrame({"block": pdf["block"].iloc[:1], "marks": [np.packbits(marks).tobytes()]})

    low = df.select(F.col(column).bitwiseAND(F.lit((1 << bits) - 1)).alias("low")).distinct()
    rows = (
        low.select(F.shiftright("low", _BLOCK_BITS).cast("int").alias("block"), F.col("low").bitwiseAND(F.lit((1 << _BLOCK_BITS) - 1)).cast("int").alias("at"))
        .groupBy("block")
        .applyInPandas(block_of, "block int, marks binary")
        .collect()
    )
    out = np.zeros((blocks, 1 << (_BLOCK_BITS - 3)), np.uint8)
    for row in rows:
        out[row.block] = np.frombuffer(row.marks, np.uint8)
    return out.reshape(-1)


def in_bitmap(marks: np.ndarray, values: np.ndarray) -> np.ndarray:
    low = values.astype(np.uint64) & np.uint64(len(marks) * 8 - 1)
    return (marks[low >> np.uint64(3)] >> (np.uint64(7) - (low & np.uint64(7))).astype(np.uint8)) & 1 == 1


def summed(df: DataFrame, column: str, n_values: int, of_batch, block: int = 1 << 14) -> np.ndarray:
    """The sum over all rows of a vector of fixed size: added up in each worker, then block by block."""
    schema = pa.schema([("at", pa.int64()), ("part", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(n_values), False
        for batch in batches:
            if len(batch):
                total += of_batch(batch.column(column))
                seen = True
        starts = list(range(0, n_values, block)) if seen else []
        yield pa.record_batch([pa.array(starts, pa.int64()), pa.array([total[a : a + block].tobytes() for a in starts], pa.binary())], schema=schema)

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_buffer(), np.float64) for x in table.column("part"))
        return pa.table([table.column("at").slice(0, 1), pa.chunked_array([[total.tobytes()]], pa.binary())], schema=schema)

    parts = df.select(column).mapInArrow(run, "at long, part binary").groupBy("at").applyInArrow(add, "at long, part binary")
    out = np.zeros(n_values)
    for row in parts.collect():
        values = np.frombuffer(row.part, np.float64)
        out[row.at : row.at + len(values)] = values
    return out


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b): root is the least node it is connected with.

    Alternates two star contractions, each a minimum per node and a join, until nothing changes:
    rounds grow with the logarithm of the longest path. No component is ever gathered in a task.
    """
    edges = scratch.keep(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = scratch.keep(large)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        edges = scratch.keep(small)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return scratch.keep(roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct()))
