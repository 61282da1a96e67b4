"""Jaccard join of documents on word n-grams by token-combination prefixes.

A token is a shingle of words. Two sets of Jaccard similarity t or more share at least k of the
first d + k tokens of each in any common order, d being the tokens a set may lack. The common order
puts tokens of the rare class first and tokens of the frequent class last, by hash within a class.

* A set with more than d rare tokens is indexed by its first d + 1 rare tokens, singly.
* A set with fewer (most of it is frequent) is indexed by all its rare tokens singly, and by the
  combinations of k = 2 of the frequent tokens among its first d + 2. If the first two tokens that
  two such sets share are both frequent, they meet in that combination, else in a rare token.
* A prefix of a long set would have very many combinations, so frequent tokens of sets of over
  ``COMBINED`` tokens are indexed singly (k = 1). Sets within reach of that border have both kinds.

The frequent class is a bitmap of fixed size of tokens that stand in many prefixes. It steers the
cost only: the result is the same for any class, so its false positives do no harm. Candidates that
share a key are held against a lower bound of their difference, the Hamming distance of parity
sketches, then verified on their whole sets.

Equal sets are one node. In a bucket of frequent tokens every node first meets one pivot, and only
nodes that the links found so far leave in different components meet each other. So a group of
copies costs a row for each, not for each pair. The links inside such a component are counted
afterwards: its sets meet block by block, and each pair of blocks returns counts, not pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docquarry.llm.common import Scratch, bitmap, bounded_batches, components, in_bitmap
from docquarry.llm.words import HASHED, mix, shingle_sets, text_slices

FREQUENT = 16
COMBINED = 400
TOGETHER = 64
SKETCH_WORDS = 8
#: Sets and tokens of a block in which the links of a component are counted.
BLOCK_SETS, BLOCK_TOKENS = 512, 1 << 19


def _needed(n, num: int, den: int):
    return (num * n + den - 1) // den


def _columns(rows: dict[str, list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.record_batch([pa.array(rows[f.name], f.type) for f in schema], schema=schema)


def _cells(tokens: np.ndarray) -> np.ndarray:
    """The parity of the tokens in each cell of a set: sets that differ in s tokens differ in s cells at most.

    There are four times as many cells as tokens or more, a power of two.
    """
    size = max(SKETCH_WORDS * 64, 1 << (4 * len(tokens)).bit_length())
    cells = np.bincount((tokens >> np.uint64(20)).astype(np.int64) & (size - 1), minlength=size) & 1
    return np.packbits(cells.astype(np.uint8))


def _folded(cells: np.ndarray, n_bytes: int) -> np.ndarray:
    """The same parities for fewer cells."""
    while len(cells) > n_bytes:
        half = len(cells) // 2
        cells = cells[:half] ^ cells[half:]
    return cells


def _sketch(cells: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(_folded(cells, SKETCH_WORDS * 8)).view(np.int64)


def _not_far(pairs: DataFrame, sketches: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) that the full sketches do not prove to differ too much."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y, total in zip(batch.column("x"), batch.column("y"), batch.column("total").to_pylist()):
                left, right = np.frombuffer(x.as_buffer(), np.uint8), np.frombuffer(y.as_buffer(), np.uint8)
                size = min(len(left), len(right))
                differ = int(np.bitwise_count(_folded(left, size) ^ _folded(right, size)).sum())
                keep.append(differ * (num + den) <= total * (den - num))
            yield pa.record_batch([batch.column("a"), batch.column("b")], schema=schema).filter(pa.array(keep, pa.bool_()))

    left = sketches.select(F.col("doc_id").alias("a"), F.col("n").alias("a_n"), F.col("cells").alias("x"))
    right = sketches.select(F.col("doc_id").alias("b"), F.col("n").alias("b_n"), F.col("cells").alias("y"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y", (F.col("a_n") + F.col("b_n")).alias("total"))
    return both.mapInArrow(run, "a long, b long").distinct()


def shingle_prefixes(docs: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """Per document: set size, a 128-bit signature of the set, its parity cells, and the first tokens by hash."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n", pa.int64()), ("sig_a", pa.int64()), ("sig_b", pa.int64()), ("cells", pa.binary()), ("prefix", pa.list_(pa.int64()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in text_slices(batch.column("text"), HASHED):
                part = batch.slice(lo, hi - lo)
                rows: dict[str, list] = {name: [] for name in schema.names}
                for doc_id, tokens in zip(part.column("doc_id").to_pylist(), shingle_sets(part.column("text"), size)):
                    n = len(tokens)
                    first = n - _needed(n, num, den) + 1
                    with np.errstate(over="ignore"):
                        signature = mix(tokens ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64), mix(tokens + np.uint64(n)).sum(dtype=np.uint64)
                    for name, value in zip(
                        schema.names,
                        (doc_id, n, *(int(s.astype(np.int64)) for s in signature), _cells(tokens).tobytes(), tokens[: first + first // 2 + 8].view(np.int64)),
                    ):
                        rows[name].append(value)
                yield _columns(rows, schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n long, sig_a long, sig_b long, cells binary, prefix array<long>"
    )


def whole_sets(docs: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """(doc_id, tokens) of the documents in ``ids``: a bitmap spares the others, a semi-join is exact."""
    schema = pa.schema([("doc_id", pa.int64()), ("tokens", pa.binary())])
    marks = docs.sparkSession.sparkContext.broadcast(bitmap(ids.select(F.xxhash64("doc_id").alias("h")), "h"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(in_bitmap(marks.value, batch.column("h").to_numpy())))
            for lo, hi in text_slices(batch.column("text"), HASHED):
                part = batch.slice(lo, hi - lo)
                sets = [tokens.tobytes() for tokens in shingle_sets(part.column("text"), size)]
                yield pa.record_batch([part.column("doc_id"), pa.array(sets, pa.binary())], schema=schema)

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id IS NOT NULL")
    found = read.withColumn("h", F.xxhash64("doc_id")).mapInArrow(run, "doc_id long, tokens binary")
    return found.join(ids, "doc_id", "left_semi")


def _rare_first(prefixes: DataFrame, marks, shared, num: int, den: int) -> DataFrame:
    """(doc_id, n, singles, crowded): the first d + 1 rare tokens, or crowded if the prefix has fewer.

    With ``shared``, a bitmap, only those of them that are marked there are returned.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("singles", pa.list_(pa.int64())), ("crowded", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: dict[str, list] = {name: [] for name in schema.names}
            prefix = batch.column("prefix")
            borders, flat = prefix.offsets.to_numpy() - prefix.offsets[0].as_py(), prefix.flatten().to_numpy()
            frequent = in_bitmap(marks.value, flat) if len(flat) else np.empty(0, bool)
            for i, n in enumerate(batch.column("n").to_pylist()):
                tokens = flat[borders[i] : borders[i + 1]]
                rare = tokens[~frequent[borders[i] : borders[i + 1]]]
                first = n - _needed(n, num, den) + 1
                crowded = len(rare) < min(first, n)
                rows["doc_id"].append(batch.column("doc_id")[i].as_py())
                rows["n"].append(n)
                singles = rare[:first] if shared is not None and not crowded else rare[:0]
                rows["singles"].append(singles[in_bitmap(shared.value, singles)] if len(singles) else singles)
                rows["crowded"].append(crowded)
            yield _columns(rows, schema)

    return prefixes.mapInArrow(run, "doc_id long, n long, singles array<long>, crowded boolean")


def _crowded_keys(sets: DataFrame, marks, num: int, den: int) -> DataFrame:
    """Keys of the crowded documents: rare tokens singly, frequent ones combined, or singly if the set is long."""
    schema = pa.schema([("key", pa.int64()), ("frequent", pa.bool_()), ("doc_id", pa.int64()), ("n", pa.int64()), ("rare", pa.int64()), ("sketch", pa.list_(pa.int64()))])

    def keys_of(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, marked = len(tokens), in_bitmap(marks.value, tokens)
        lack = n - _needed(n, num, den)
        rare = tokens[~marked][: lack + 1]
        if len(rare) > lack:
            return rare, rare[:0]
        hot = tokens[marked]
        keys = []
        if n * num <= COMBINED * den:
            hot_2 = hot[: lack + 2 - len(rare)]
            i, j = np.triu_indices(len(hot_2), 1)
            keys.append(mix(hot_2[i] * np.uint64(3) + hot_2[j]))
        if n >= COMBINED:
            keys.append(mix(hot[: lack + 1 - len(rare)] ^ np.uint64(0x5851F42D4C957F2D)))
        return rare, np.concatenate(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, blob in zip(batch.column("doc_id").to_pylist(), batch.column("tokens").to_pylist()):
                tokens = np.frombuffer(blob, np.uint64)
                rare, hot = keys_of(tokens)
                keys = np.concatenate([rare, hot])
                if not len(keys):
                    continue
                sketch = pa.array([_sketch(_cells(tokens))], pa.list_(pa.int64()))
                yield pa.record_batch(
                    [
                        pa.array(keys.view(np.int64)),
                        pa.array(np.arange(len(keys)) >= len(rare)),
                        pa.array(np.full(len(keys), doc_id)),
                        pa.array(np.full(len(keys), len(tokens))),
                        pa.array(np.full(len(keys), len(rare))),
                        sketch.take(pa.array(np.zeros(len(keys), np.int64))),
                    ],
                    schema=schema,
                )

    return sets.mapInArrow(run, "key long, frequent boolean, doc_id long, n long, rare long, sketch array<long>")


def _near(a_n: Column, b_n: Column, a: Column, b: Column, num: int, den: int) -> Column:
    """True unless the sketches prove that the sets differ in more tokens than the threshold allows."""
    cells = sum((F.bit_count(a[i].bitwiseXOR(b[i])) for i in range(SKETCH_WORDS)), F.lit(0))
    return (cells * (num + den) <= (a_n + b_n) * (den - num)) & _sizes(a_n, b_n, num, den)


def _sizes(a_n: Column, b_n: Column, num: int, den: int) -> Column:
    return (a_n * den >= b_n * num) & (b_n * den >= a_n * num)


def verified(pairs: DataFrame, docs: DataFrame, size: int, num: int, den: int, scratch: Scratch) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the threshold: den * |intersection| >= num * |union|.

    Pairs that hang together in a group of at most ``TOGETHER`` documents are verified together, so
    a set is moved once for the group. Pairs of larger groups are verified one by one.
    """
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def reaches(x: np.ndarray, y: np.ndarray) -> bool:
        common = len(np.intersect1d(x, y, assume_unique=True))
        return den * common >= num * (len(x) + len(y) - common)

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[int, int]] = []
            for members, of_group in zip(batch.column("members"), batch.column("pairs").to_pylist()):
                sets: dict[int, list[np.ndarray]] = {}
                for member in members:
                    sets.setdefault(member["doc_id"].as_py(), []).append(np.frombuffer(member["tokens"].as_buffer(), np.uint64))
                found += [(p["a"], p["b"]) for p in of_group if any(reaches(x, y) for x in sets[p["a"]] for y in sets[p["b"]])]
            yield pa.record_batch([pa.array([p[0] for p in found], pa.int64()), pa.array([p[1] for p in found], pa.int64())], schema=schema)

    def singly(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = ((np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)) for x, y in zip(batch.column("x"), batch.column("y")))
            keep = [reaches(x, y) for x, y in sets]
            yield pa.record_batch([batch.column("a"), batch.column("b")], schema=schema).filter(pa.array(keep, pa.bool_()))

    roots = components(pairs, scratch)
    sizes = roots.groupBy("root").agg(F.count("*").alias("together"))
    roots = scratch.keep(roots.join(sizes, "root").select(F.col("node").alias("doc_id"), "root", "together"))
    small, large = roots.where(F.col("together") <= TOGETHER), roots.where(F.col("together") > TOGETHER)

    members = whole_sets(docs, small.select("doc_id"), size).join(small.select("doc_id", "root"), "doc_id")
    members = members.groupBy("root").agg(F.collect_list(F.struct("doc_id", "tokens")).alias("members"))
    of_group = pairs.join(small.select(F.col("doc_id").alias("a"), "root"), "a").groupBy("root").agg(F.collect_list(F.struct("a", "b")).alias("pairs"))
    found = members.join(of_group, "root").select("members", "pairs").mapInArrow(groups, "a long, b long")

    sets = scratch.keep(whole_sets(docs, large.select("doc_id"), size))
    left = sets.select(F.col("doc_id").alias("a"), F.col("tokens").alias("x"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("tokens").alias("y"))
    found = found.unionByName(pairs.select("a", "b").join(left, "a").join(right, "b").mapInArrow(singly, "a long, b long"))
    return scratch.keep(found.distinct())


def _links_of_blocks(left: list[tuple[int, np.ndarray]], right: list[tuple[int, np.ndarray]] | None, num: int, den: int) -> dict[int, int]:
    """Links of each node between two blocks of (node, tokens), or inside one; a node may have several sets."""
    both = left + (right or [])
    nodes, of = np.unique(np.array([node for node, _ in both], np.int64), return_inverse=True)
    sizes = np.array([len(tokens) for _, tokens in both])
    _, column, times = np.unique(np.concatenate([tokens for _, tokens in both]), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(both)), sizes)
    # A token of one set only is in no intersection.
    row, column = row[times[column] > 1], column[times[column] > 1]
    column = np.unique(column, return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    cut = len(left)
    other = slice(cut, None) if right is not None else slice(None)
    common = np.zeros((cut, len(both) - cut if right is not None else cut), np.float32)
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        a, b = np.searchsorted(column, (lo, lo + 4096))
        some = np.zeros((len(both), 4096), np.float32)
        some[row[a:b], column[a:b] - lo] = 1
        common += some[:cut] @ some[other].T
    common = common.astype(np.int64)
    x, y = np.nonzero((common > 0) & (den * common >= num * (sizes[:cut, None] + sizes[other][None, :] - common)))
    a, b = of[:cut][x], of[other][y]
    pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1)[a != b], axis=0)
    degree = np.bincount(pairs.reshape(-1), minlength=len(nodes))
    return {int(nodes[i]): int(degree[i]) for i in np.flatnonzero(degree)}


def links_inside(members: DataFrame, docs: DataFrame, size: int, num: int, den: int, scratch: Scratch) -> DataFrame:
    """(class_id, n_links) of all links between ``members`` (doc_id, root, n) of one component each.

    Every pair of sets is compared, in blocks of bounded size that are dealt by pairs of blocks.
    """
    blocks = members.groupBy("root").agg(
        F.ceil(F.greatest(F.count("*") / F.lit(BLOCK_SETS), F.sum("n") / F.lit(BLOCK_TOKENS), F.lit(1.0))).cast("int").alias("blocks")
    )
    placed = scratch.keep(members.join(blocks, "root").withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")).drop("n"))
    sets = whole_sets(docs, placed.select("doc_id"), size).join(placed, "doc_id")
    met = sets.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("doc_id", "tokens", "root", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    schema = pa.schema([("class_id", pa.int64()), ("n_links", pa.int64())])

    def count(table: pa.Table) -> pa.Table:
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        sides: dict[int, list] = {low: [], high: []}
        for node, block, tokens in zip(table.column("doc_id").to_pylist(), table.column("block").to_pylist(), table.column("tokens").to_pylist()):
            sides[block].append((node, np.frombuffer(tokens, np.uint64)))
        found = {} if not sides[low] or not sides[high] else _links_of_blocks(sides[low], sides[high] if high > low else None, num, den)
        return pa.table([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.int64())], schema=schema)

    counted = met.groupBy("root", "low", "high").applyInArrow(count, "class_id long, n_links long")
    return counted.groupBy("class_id").agg(F.sum("n_links").alias("n_links"))


def ngram_join(docs: DataFrame, size: int = 5, num: int = 8, den: int = 10, scratch: Scratch | None = None) -> DataFrame:
    """Link documents whose shingle sets have a Jaccard similarity of ``num / den`` or more.

    One row per input row: ``doc_id``, ``n_shingles``, ``class_id`` (least doc_id with an equal set),
    ``n_links`` (links of its class to classes of other sets that were verified), ``component_id``
    (least doc_id reachable by links). All links between different sets are counted. A caller that
    hands in ``scratch`` may drop it once the result is written.

    Defined cases: a null or blank text has an empty set and is linked with nothing, so it is its
    own class and component. Fewer words than ``size`` are one shingle. Rows that repeat a doc_id
    are one node. A null doc_id is linked with nothing; its class and component are null. An empty
    table gives an empty result. Other columns are ignored.
    """
    if not den < 2 * num <= 2 * den:
        raise ValueError("the similarity must be over 1/2 and at most 1: two sets that link then share two tokens or are equal")
    spark = docs.sparkSession
    bounded_batches(spark)
    scratch = scratch or Scratch(spark, "ngram-join")
    docs = docs.select("doc_id", "text")
    rows = scratch.keep(shingle_prefixes(docs, size, num, den))
    nodes = rows.where("n > 0 AND doc_id IS NOT NULL")
    classes = scratch.keep(nodes.groupBy("n", "sig_a", "sig_b").agg(F.min("doc_id").alias("class_id")))
    firsts = nodes.join(classes.select(F.col("class_id").alias("doc_id"), "n", "sig_a", "sig_b"), ["doc_id", "n", "sig_a", "sig_b"], "left_semi")
    firsts = scratch.keep(firsts.dropDuplicates(["doc_id", "n", "sig_a", "sig_b"]).select("doc_id", "n", "cells", "prefix"))

    def counted(tokens: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """Bitmaps of the tokens that stand there more than once, and of the frequent ones."""
        counts = scratch.keep(tokens.groupBy("token").count().where("count > 1"))
        return bitmap(counts, "token"), bitmap(counts.where(F.col("count") >= FREQUENT), "token")

    send = spark.sparkContext.broadcast
    shared, marks = counted(firsts.select(F.explode("prefix").alias("token")))
    crowded = scratch.keep(_rare_first(firsts, send(marks), None, num, den).where("crowded").select("doc_id").distinct())
    crowded_sets = scratch.keep(whole_sets(docs, crowded, size))
    marks = marks | counted(_exploded(crowded_sets))[1]
    now_crowded = _rare_first(firsts, send(marks), None, num, den).where("crowded").select("doc_id").distinct()
    more = scratch.keep(now_crowded.join(crowded, "doc_id", "left_anti"))
    crowded_sets = scratch.keep(crowded_sets.unionByName(whole_sets(docs, more, size)))
    keys = scratch.keep(_crowded_keys(crowded_sets, send(marks), num, den))

    # A token that no other prefix has, and no crowded document, finds no partner.
    of_crowded = keys.where("NOT frequent").select(F.col("key").alias("token"), "doc_id", "n")
    shared = shared | bitmap(of_crowded, "token")
    placed = _rare_first(firsts, send(marks), send(shared), num, den).where("NOT crowded")
    singles = scratch.keep(placed.select(F.explode("singles").alias("token"), "doc_id", "n").unionByName(of_crowded))
    a = singles.select("token", F.col("doc_id").alias("a"), F.col("n").alias("a_n"))
    b = singles.select("token", F.col("doc_id").alias("b"), F.col("n").alias("b_n"))
    met = a.join(b, "token").where((F.col("a") < F.col("b")) & _sizes(F.col("a_n"), F.col("b_n"), num, den)).select("a", "b").distinct()
    buckets = keys.where("frequent").select("key", "doc_id", "n", "rare", "sketch")
    pivots = buckets.groupBy("key").agg(F.min(F.struct("rare", "doc_id", "n", "sketch")).alias("pivot"), F.count("*").alias("members")).where("members > 1")
    to_pivot = buckets.join(pivots, "key").where(
        (F.col("doc_id") != F.col("pivot.doc_id")) & _near(F.col("n"), F.col("pivot.n"), F.col("sketch"), F.col("pivot.sketch"), num, den)
    )
    to_pivot = to_pivot.select(F.least("doc_id", "pivot.doc_id").alias("a"), F.greatest("doc_id", "pivot.doc_id").alias("b")).distinct()
    tried = scratch.keep(_not_far(met.unionByName(to_pivot).distinct(), firsts, num, den))
    links = verified(tried, docs, size, num, den, scratch)
    roots = components(links, scratch)

    placed_keys = scratch.keep(
        buckets.join(pivots.select("key"), "key", "left_semi")
        .join(roots, buckets["doc_id"] == roots["node"], "left")
        .select("key", "doc_id", "n", "sketch", F.coalesce("root", "doc_id").alias("root"))
    )
    # A key whose members are all in one component is done.
    open_keys = placed_keys.groupBy("key").agg((F.min("root") < F.max("root")).alias("open")).where("open").select("key")
    placed_keys = scratch.keep(placed_keys.join(open_keys, "key", "left_semi"))
    a = placed_keys.select("key", *(F.col(c).alias(f"a_{c}") for c in ("doc_id", "n", "sketch", "root")))
    b = placed_keys.select("key", *(F.col(c).alias(f"b_{c}") for c in ("doc_id", "n", "sketch", "root")))
    apart = (F.col("a_doc_id") < F.col("b_doc_id")) & (F.col("a_root") != F.col("b_root"))
    near = _near(F.col("a_n"), F.col("b_n"), F.col("a_sketch"), F.col("b_sketch"), num, den)
    across = a.join(b, (a["key"] == b["key"]) & apart & near).select(F.col("a_doc_id").alias("a"), F.col("b_doc_id").alias("b")).distinct()
    across = scratch.keep(_not_far(across.join(tried, ["a", "b"], "left_anti"), firsts, num, den))
    links = links.unionByName(verified(across, docs, size, num, den, scratch))
    roots = components(links, scratch)

    # Two members of a bucket that were in one component before they met were not compared.
    in_bucket = roots.join(buckets.select(F.col("doc_id").alias("node")).distinct(), "node", "left_semi").groupBy("root").agg(F.count("*").alias("hot"))
    partly = roots.groupBy("root").agg(F.count("*").alias("together")).join(in_bucket, "root").where("together > 2 AND hot > 1").select("root")
    lengths = firsts.groupBy(F.col("doc_id").alias("node")).agg(F.sum("n").alias("n"))
    partly = scratch.keep(roots.join(partly, "root", "left_semi").join(lengths, "node").select(F.col("node").alias("doc_id"), "root", "n"))
    degree = links.select(F.explode(F.array("a", "b")).alias("class_id")).groupBy("class_id").agg(F.count("*").alias("n_links"))
    degree = degree.join(partly.select(F.col("doc_id").alias("class_id")), "class_id", "left_anti").unionByName(links_inside(partly, docs, size, num, den, scratch))
    known = classes.join(degree, "class_id", "left").join(roots.withColumnRenamed("node", "class_id"), "class_id", "left")
    known = scratch.keep(known.select("n", "sig_a", "sig_b", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("root", "class_id").alias("component_id")))
    out = rows.select("doc_id", "n", "sig_a", "sig_b").join(known, ["n", "sig_a", "sig_b"], "left")
    linked = F.col("doc_id").isNotNull() & (F.col("n") > 0)
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(linked, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.coalesce(F.when(linked, F.col("n_links")), F.lit(0)).alias("n_links"),
        F.when(linked, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def _exploded(sets: DataFrame) -> DataFrame:
    """(token) of every set, one row each."""
    schema = pa.schema([("token", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column("tokens").to_pylist():
                yield pa.record_batch([pa.array(np.frombuffer(blob, np.int64))], schema=schema)

    return sets.mapInArrow(run, "token long")
