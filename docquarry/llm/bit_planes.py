"""Centroid clustering of integer vectors by popcounts of bit planes.

The 64 components of a vector are integers in two's complement. Plane p packs bit p of all of them
into one unsigned 64-bit integer, so a vector is as many integers as its components have bits. The
exact dot product of two vectors is the sum over pairs of planes (p, q) of
popcount(x[p] & c[q]) * 2**(p + q), negative where exactly one of the two is the sign plane, and
squared distances follow from dot products. Sums per cluster are counts of set bits by plane.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquarry.llm.common import Scratch, bounded_batches

DIM = 64
#: Components of at most this many bits: squared distances of 64 of them stay within 63 bits.
MOST_PLANES = 28
_BLOCK = 4096

_PACKED_SQL = "vec_id long, norm long, planes binary"


def planes_of(values: np.ndarray, n_planes: int) -> np.ndarray:
    """Bit planes (n_planes, rows) of integers (rows, 64); bit i of a plane belongs to component i."""
    out = np.empty((n_planes, len(values)), np.uint64)
    for p in range(n_planes):
        bits = np.packbits(((values >> p) & 1).astype(np.uint8), axis=1, bitorder="little")
        out[p] = np.ascontiguousarray(bits).view("<u8")[:, 0]
    return out


def values_of(planes: np.ndarray) -> np.ndarray:
    """The integers (rows, 64) of bit planes."""
    out = np.zeros((planes.shape[1], DIM), np.int64)
    for p, weight in enumerate(plane_weights(len(planes))):
        out += weight * _bits(planes[p]).astype(np.int64)
    return out


def plane_weights(n_planes: int) -> list[int]:
    return [*(1 << p for p in range(n_planes - 1)), -(1 << (n_planes - 1))]


def _bits(plane: np.ndarray) -> np.ndarray:
    return np.unpackbits(plane.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def dot_products(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Dot products of the vectors ``x`` with ``c``, planes (n_planes, rows) and (n_planes, rows or 1)."""
    n, top = len(x), len(x) - 1
    # Popcounts of equal weight are added up before they are shifted: at most 64 * 28 each.
    by_weight = np.zeros((2 * n - 1, x.shape[1]), np.int16)
    for p in range(n):
        for q in range(n):
            if c.shape[1] == 1 and not c[q, 0]:
                continue
            found = np.bitwise_count(x[p] & c[q])
            if (p == top) == (q == top):
                by_weight[p + q] += found
            else:
                by_weight[p + q] -= found
    total = np.zeros(x.shape[1], np.int64)
    for weight, counts in enumerate(by_weight):
        total += counts.astype(np.int64) << weight
    return total


def nearest(x: np.ndarray, norm: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid, the smaller of equals, and the squared distance to it.

    ``centroids`` are planes (n_planes, k), ``norm`` the squared lengths of the vectors.
    """
    own = dot_products(centroids, centroids)
    distance = np.stack([norm - 2 * dot_products(x, centroids[:, j : j + 1]) + own[j] for j in range(centroids.shape[1])])
    best = distance.argmin(axis=0)
    return best, distance[best, np.arange(len(best))]


def _unpacked(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of (ids' place in the batch, norms, planes)."""
    blobs, norms = batch.column("planes"), batch.column("norm").to_numpy(zero_copy_only=False)
    for lo in range(0, len(batch), _BLOCK):
        data = np.frombuffer(b"".join(blobs[lo : lo + _BLOCK].to_pylist()), "<u8")
        n = min(_BLOCK, len(batch) - lo)
        yield np.arange(lo, lo + n), norms[lo : lo + n], np.ascontiguousarray(data.reshape(n, -1).T)


def pack_vectors(vectors: DataFrame, n_planes: int) -> DataFrame:
    """(vec_id, norm, planes) of (vec_id, values): squared length, and the planes one after another."""
    schema = pa.schema([("vec_id", pa.int64()), ("norm", pa.int64()), ("planes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                values = batch.column("values").flatten().to_numpy(zero_copy_only=False).reshape(-1, DIM)
                planes = planes_of(values, n_planes)
                blobs = [row.tobytes() for row in np.ascontiguousarray(planes.T).astype("<u8")]
                yield pa.record_batch([batch.column("vec_id"), pa.array(dot_products(planes, planes)), pa.array(blobs, pa.binary())], schema=schema)

    return vectors.mapInArrow(run, _PACKED_SQL)


def _cluster_sums(packed: DataFrame, centroids: np.ndarray) -> tuple[np.ndarray, list[list[int]]]:
    """Members of each cluster, and the sums of their components: k * 65 numbers, whatever the input."""
    k = centroids.shape[1]
    send = packed.sparkSession.sparkContext.broadcast(centroids)
    schema = pa.schema([("cluster", pa.int32()), ("place", pa.int32()), ("total", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((k, DIM + 1), np.int64)
        for batch in batches:
            for _, norm, x in _unpacked(batch):
                best, _ = nearest(x, norm, send.value)
                member = (best == np.arange(k)[:, None]).astype(np.float64)
                totals[:, DIM] += member.sum(axis=1).astype(np.int64)
                for plane, weight in zip(x, plane_weights(len(x))):
                    totals[:, :DIM] += weight * (member @ _bits(plane)).astype(np.int64)
        cluster, place = np.divmod(np.arange(totals.size), DIM + 1)
        yield pa.record_batch([pa.array(cluster, pa.int32()), pa.array(place, pa.int32()), pa.array(totals.reshape(-1))], schema=schema)

    parts = packed.select("norm", "planes").mapInArrow(run, "cluster int, place int, total long")
    sums = [[0] * (DIM + 1) for _ in range(k)]
    for row in parts.groupBy("cluster", "place").agg(F.sum("total").alias("total")).collect():
        sums[row.cluster][row.place] = row.total
    return np.array([s[DIM] for s in sums]), [s[:DIM] for s in sums]


def _assigned(packed: DataFrame, centroids: np.ndarray) -> DataFrame:
    send = packed.sparkSession.sparkContext.broadcast(centroids)
    schema = pa.schema([("vec_id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, norm, x in _unpacked(batch):
                best, distance = nearest(x, norm, send.value)
                yield pa.record_batch([batch.column("vec_id").slice(int(at[0]), len(at)), pa.array(best, pa.int32()), pa.array(distance)], schema=schema)

    return packed.mapInArrow(run, "vec_id long, cluster int, distance long")


def kept_vectors(table: DataFrame, scale: int = 1024, vector: str = "embedding") -> DataFrame:
    """(vec_id, values) of the vectors of exactly 64 components, none null, infinite or not a number: floor(scale * x)."""
    x = F.col(vector).cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    kept = table.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")).where((F.size("x") == DIM) & F.coalesce(finite, F.lit(False)))
    return kept.select("vec_id", F.transform("x", lambda v: F.floor(v * F.lit(float(scale)))).alias("values"))


def cluster_planes(table: DataFrame, k: int = 8, rounds: int = 10, scale: int = 1024, salt: str = "3", vector: str = "embedding") -> DataFrame:
    """Cluster the vectors of ``table`` (vec_id, ``vector``) in ``rounds`` exact rounds around ``k`` centroids.

    Components become floor(``scale`` * x). Centroids start as the vectors with the smallest SHA-256 of
    ``salt:vec_id``; each round replaces a centroid by the floor of its vectors' mean, an empty one
    stays. One row per vector kept: ``vec_id``, ``cluster``, ``distance`` (squared), ``cluster_inertia``,
    ``inertia``, ``centroid_sha256`` (of the final centroid's components).

    Defined cases: vectors that are null, of another length, or with a null or non-finite component
    are left out. With fewer than ``k`` vectors there are fewer centroids. A null id counts as an
    empty text; rows that repeat an id are vectors of their own, ordered by their components where
    the hash ties. Components beyond 28 bits are an error, as their distances would not fit into a long.
    An empty table gives an empty result. Other columns are ignored.
    """
    spark = table.sparkSession
    bounded_batches(spark)
    scratch = Scratch(spark, "bit-planes")
    vectors = kept_vectors(table, scale, vector)
    low, high = vectors.agg(F.min(F.array_min("values")), F.max(F.array_max("values"))).first()
    n_planes = 1 + max(int(v if v >= 0 else ~v).bit_length() for v in (low or 0, high or 0))
    if n_planes > MOST_PLANES:
        raise ValueError(f"components from {low} to {high}: only {MOST_PLANES} bits are supported")
    packed = scratch.keep(pack_vectors(vectors, n_planes))

    digest = F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = packed.select(digest.alias("digest"), "planes").orderBy("digest", "planes").limit(k).collect()
    columns = [np.frombuffer(bytes(r.planes), "<u8") for r in first]
    centroids = np.stack(columns, axis=1).astype(np.uint64) if columns else np.zeros((n_planes, 0), np.uint64)
    for _ in range(rounds if columns else 0):
        members, sums = _cluster_sums(packed, centroids)
        means = values_of(centroids)
        for j, n in enumerate(members.tolist()):
            if n:
                means[j] = [s // n for s in sums[j]]
        centroids = planes_of(means, n_planes)

    if not columns:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    rows = scratch.keep(_assigned(packed, centroids))
    totals = {r.cluster: int(r.total) for r in rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    inertia = sum(totals.values())
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in values_of(centroids).tolist()]
    # One row for each centroid.
    known = spark.createDataFrame(
        [(j, totals.get(j, 0), inertia, d) for j, d in enumerate(digests)], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    return rows.join(known, "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
