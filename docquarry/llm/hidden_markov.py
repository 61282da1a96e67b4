"""A hidden Markov language model over all tokens of a corpus.

Tokens are lower-cased words and an end after each text. Every training token is counted. The most
frequent words and the end are symbols of their own, other words share a symbol by their last
character; within a symbol a word has the probability of its smoothed count. The model of the
symbols is trained by Baum-Welch: workers take expected counts over segments of the texts, their
sums give the next parameters. The forward recursion with scaling then gives the exact likelihood
of each whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquarry.llm.common import Scratch, bounded_batches, fold, summed
from docquarry.llm.words import BLANK, LOWER, mix, span_hashes, spans, text_bytes, text_slices

#: Symbols for words that have none of their own: a letter, full stop, comma, digit, other, non-ASCII.
SHARED = 31
END = np.int64(mix(np.array([0xE0D], np.uint64)).view(np.int64)[0])
_LAST = np.full(256, 29, np.int64)
_LAST[97:123] = np.arange(26)
_LAST[ord(".")], _LAST[ord(",")], _LAST[48:58], _LAST[128:] = 26, 27, 28, 30


@dataclass(frozen=True)
class MarkovParams:
    """``broadcast_words``: most words whose counts are sent to the workers; counts of others are joined.

    ``segment``: tokens of a training segment. The size of what a worker holds follows from these.
    """

    states: int = 8
    own_symbols: int = 2048
    broadcast_words: int = 1 << 17
    iterations: int = 4
    segment: int = 64
    folds: int = 7
    held_out: int = 2


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and shared symbol of every token of all rows (the end's symbol is -1), and the row borders."""
    raw, borders = text_bytes(column)
    raw = LOWER[raw]
    starts, ends = spans(~BLANK[raw], borders)
    edges = np.searchsorted(starts, borders)
    hashes = np.insert(span_hashes(raw, starts, ends).view(np.int64), edges[1:], END)
    last = np.insert(_LAST[raw[ends - 1]] if len(starts) else np.empty(0, np.int64), edges[1:], -1)
    return hashes, last, edges + np.arange(len(edges))


def count_tokens(docs: DataFrame) -> DataFrame:
    """(hash, last, c) of every token of ``docs`` (text), counted in the worker before the shuffle."""
    schema = pa.schema([("hash", pa.int64()), ("last", pa.int64()), ("c", pa.int64())])

    def merged(parts: list[tuple]) -> tuple:
        hashes, last, c = (np.concatenate(x) for x in zip(*parts))
        unique, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        return unique, last[first], np.bincount(inverse, weights=c).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            for lo, hi in text_slices(batch.column("text")):
                hashes, last, _ = tokens(batch.column("text").slice(lo, hi - lo))
                parts.append(merged([(hashes, last, np.ones(len(hashes), np.int64))]))
                held += len(parts[-1][0])
                if held > 1 << 20:
                    parts = [merged(parts)]
                    held = len(parts[0][0])
                    if held > 1 << 19:
                        yield pa.record_batch([pa.array(x) for x in parts[0]], schema=schema)
                        parts, held = [], 0
        if parts:
            yield pa.record_batch([pa.array(x) for x in merged(parts)], schema=schema)

    return docs.select("text").mapInArrow(run, "hash long, last long, c long").groupBy("hash").agg(F.min("last").alias("last"), F.sum("c").alias("c"))


@dataclass(frozen=True)
class Vocabulary:
    """What a worker needs to turn tokens into symbols; ``log_in``: log10 probability within the symbol."""

    hashes: np.ndarray
    counts: np.ndarray
    symbols: np.ndarray
    log_in: np.ndarray
    log_total: np.ndarray
    n_symbols: int
    n_tokens: int
    n_words: int


def vocabulary(counts: DataFrame, params: MarkovParams) -> tuple[Vocabulary, int]:
    """The vocabulary, and the least count of the words in it."""
    total = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    n, v = total.n or 0, total.v
    size = F.floor(F.log2(F.col("c")) * 8)
    by_size = counts.groupBy(size.alias("size")).agg(F.count("*").alias("words"), F.min("c").alias("least")).orderBy(F.desc("size")).collect()
    least, held = (n or 0) + 1, 0
    for row in by_size:
        held += row.words
        if held > params.broadcast_words:
            break
        least = row.least
    rows = counts.where((F.col("c") >= least) | (F.col("hash") == int(END))).toPandas().sort_values(["c", "hash"], ascending=[False, True])
    is_end = rows["hash"].to_numpy() == END
    own = is_end | (np.cumsum(~is_end) <= params.own_symbols)
    shared = counts.groupBy("last").agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()
    in_shared, words_of = np.zeros(SHARED), np.zeros(SHARED)
    for row in shared:
        if row["last"] >= 0:
            in_shared[row["last"]], words_of[row["last"]] = row["n"], row["v"]
    c, last = rows["c"].to_numpy(np.int64), rows["last"].to_numpy(np.int64)
    named = own & (last >= 0)
    np.subtract.at(in_shared, last[named], c[named])
    np.subtract.at(words_of, last[named], 1)
    log_total = np.log10(in_shared + words_of + 1)
    symbols = np.where(own, SHARED + np.cumsum(own) - 1, last)
    log_in = np.where(own, 0.0, np.log10(c + 1.0) - log_total[np.maximum(last, 0)])
    order = np.argsort(rows["hash"].to_numpy())
    hashes = rows["hash"].to_numpy(np.int64)
    # Without a training text the end still needs a symbol.
    if not is_end.any():
        order, hashes, c, symbols, log_in = np.array([0]), np.array([END]), np.array([0]), np.array([SHARED]), np.array([0.0])
    n_symbols = SHARED + max(1, int(own.sum()))
    return Vocabulary(hashes[order], c[order], symbols[order], log_in[order], log_total, n_symbols, n, v), least


def encode(docs: DataFrame, words, params: MarkovParams) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, held_out): its symbols, what the sent counts give, and its other words."""
    schema = pa.schema(
        [("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("known", pa.int64()), ("base", pa.float64()), ("inside", pa.float64())]
        + [("symbols", pa.binary()), ("rare", pa.list_(pa.int64())), ("rare_n", pa.list_(pa.int32())), ("rare_last", pa.list_(pa.int32()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, at = words.value, TaskContext.get().partitionId() << 33
        log_c = np.log10(v.counts + 1.0)
        for batch in batches:
            for lo, hi in text_slices(batch.column("text")):
                part = batch.slice(lo, hi - lo)
                hashes, last, borders = tokens(part.column("text"))
                place = np.minimum(np.searchsorted(v.hashes, hashes), len(v.hashes) - 1)
                sent = v.hashes[place] == hashes
                symbol = np.where(sent, v.symbols[place], last).astype("<u2")
                sums = [np.concatenate([[0], np.cumsum(x)]) for x in (sent & (v.counts[place] > 0), np.where(sent, log_c[place], 0.0), np.where(sent, v.log_in[place], 0.0))]
                known, base, inside = (s[borders[1:]] - s[borders[:-1]] for s in sums)
                rare: list[list] = [[], [], []]
                for a, b in zip(borders[:-1].tolist(), borders[1:].tolist()):
                    other = np.flatnonzero(~sent[a:b]) + a
                    unique, first, n = np.unique(hashes[other], return_index=True, return_counts=True)
                    for out, x in zip(rare, (unique, n, last[other][first])):
                        out.append(x)
                columns = [np.arange(at, at + len(part)), part.column("doc_id"), part.column("held_out"), np.diff(borders), known, base, inside]
                columns += [[symbol[a:b].tobytes() for a, b in zip(borders[:-1], borders[1:])], *rare]
                at += len(part)
                yield pa.record_batch([x if isinstance(x, pa.Array) else pa.array(x, f.type) for x, f in zip(columns, schema)], schema=schema)

    return docs.mapInArrow(
        run,
        "row long, doc_id long, held_out boolean, n_tokens long, known long, base double, inside double, symbols binary, rare array<long>, rare_n array<int>, rare_last array<int>",
    )


def _segments(blobs: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols by place and segment (-1: none), and which segments begin a text, longest first."""
    texts = [np.frombuffer(b.as_buffer(), "<u2") for b in blobs]
    sizes = np.array([len(t) for t in texts])
    flat = np.concatenate(texts).astype(np.int64)
    borders = np.concatenate([[0], np.cumsum(sizes)])
    per = -(-sizes // length)
    first = np.concatenate([[0], np.cumsum(per)])
    nth = np.arange(first[-1]) - np.repeat(first[:-1], per)
    starts = np.repeat(borders[:-1], per) + nth * length
    lengths = np.minimum(length, np.repeat(borders[1:], per) - starts)
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    grid = starts[None, :] + np.arange(length)[:, None]
    return np.where(np.arange(length)[:, None] < lengths, flat[np.minimum(grid, len(flat) - 1)], -1), nth[order] == 0, lengths


def expected_counts(blobs: pa.Array, model: tuple, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Expected counts of a set of texts: first states, states at segment starts, moves, and emissions."""
    start, inner, move, emit = model
    grid, begins, lengths = _segments(blobs, length)
    n_steps, n = int(lengths.max()), len(lengths)
    active = [int((lengths > t).sum()) for t in range(n_steps)] + [0]
    seen = [emit[:, grid[t, : active[t]]].T for t in range(n_steps)]
    alpha, scale = [], []
    for t in range(n_steps):
        now = (np.where(begins[:, None], start, inner) if t == 0 else alpha[-1][: active[t]] @ move) * seen[t]
        scale.append(now.sum(1, keepdims=True))
        alpha.append(now / scale[-1])
    moves, emissions = np.zeros_like(move), np.zeros((emit.shape[1], len(start)))
    beta = np.ones((n, len(start)))
    for t in range(n_steps - 1, -1, -1):
        m = active[t + 1]
        if m:
            ahead = seen[t + 1] * beta[:m] / scale[t + 1]
            moves += alpha[t][:m].T @ ahead
            beta[:m] = ahead @ move.T
        state = alpha[t] * beta[: active[t]]
        for s in range(len(start)):
            emissions[:, s] += np.bincount(grid[t, : active[t]], weights=state[:, s], minlength=emit.shape[1])
    return state[begins].sum(0), state[~begins].sum(0), moves * move, emissions.T


def log10_likelihood(blobs: pa.Array, model: tuple) -> np.ndarray:
    """log10 probability of each symbol sequence: the scaled forward recursion over whole texts, side by side."""
    start, _, move, emit = model
    texts = [np.frombuffer(b.as_buffer(), "<u2") for b in blobs]
    sizes = np.array([len(t) for t in texts])
    order = np.argsort(-sizes, kind="stable")
    flat = np.concatenate(texts).astype(np.int64)
    at = np.concatenate([[0], np.cumsum(sizes)])[:-1][order]
    falling, total = -sizes[order], np.zeros(len(texts))
    state = np.tile(start, (len(texts), 1))
    for t in range(int(sizes.max(initial=0))):
        m = int(np.searchsorted(falling, -t))
        state = (state[:m] if t == 0 else state[:m] @ move) * emit[:, flat[at[:m] + t]].T
        scale = state.sum(1)
        total[:m] += np.log10(scale)
        state /= scale[:, None]
    out = np.empty(len(texts))
    out[order] = total
    return out


def _first_model(coded: DataFrame, n_symbols: int, params: MarkovParams) -> tuple:
    """States from clusters of symbols that have like right neighbours, over all training texts."""
    width = 16
    rng = np.random.default_rng(17)
    project = rng.normal(size=(n_symbols, width))

    def neighbours(blobs: pa.Array) -> np.ndarray:
        texts = [np.frombuffer(b.as_buffer(), "<u2") for b in blobs]
        flat = np.concatenate(texts).astype(np.int64)
        left = np.delete(np.arange(len(flat)), np.cumsum([len(t) for t in texts]) - 1)
        out = np.zeros((width + 1, n_symbols))
        out[0] = np.bincount(flat, minlength=n_symbols)
        for k in range(width):
            out[k + 1] = np.bincount(flat[left], weights=project[flat[left + 1], k], minlength=n_symbols)
        return out.reshape(-1)

    sums = summed(coded, "symbols", (width + 1) * n_symbols, neighbours).reshape(width + 1, n_symbols)
    count, context = sums[0], sums[1:].T / np.maximum(1, sums[0])[:, None]
    context -= (context * count[:, None]).sum(0) / max(1, count.sum())
    k = params.states
    centres = context[[int(np.argmax(count))]]
    for _ in range(k - 1):
        far = ((context[:, None] - centres) ** 2).sum(2).min(1) * np.sqrt(count)
        centres = np.concatenate([centres, context[[int(np.argmax(far))]]])
    for _ in range(20):
        nearest = ((context[:, None] - centres) ** 2).sum(2).argmin(1)
        for s in range(k):
            weight = np.where(nearest == s, count, 0)
            if weight.sum():
                centres[s] = weight @ context / weight.sum()
    share = np.full((k, n_symbols), 0.3 / k)
    share[nearest, np.arange(n_symbols)] += 0.7
    emit = share * (count + 0.1)
    even = np.full(k, 1 / k)
    return even, even, np.full((k, k), 0.5 / k) + np.eye(k) * 0.5, emit / emit.sum(1, keepdims=True)


def train(coded: DataFrame, n_symbols: int, params: MarkovParams) -> tuple:
    """(start, segment start, move, emit) after ``params.iterations`` rounds over all of ``coded`` (symbols)."""
    k = params.states
    model = _first_model(coded, n_symbols, params)
    for _ in range(params.iterations):
        sent = coded.sparkSession.sparkContext.broadcast(model)

        def expected(blobs: pa.Array, sent=sent) -> np.ndarray:
            return np.concatenate([x.reshape(-1) for x in expected_counts(blobs, sent.value, params.segment)])

        sums = summed(coded, "symbols", 2 * k + k * k + k * n_symbols, expected)
        start, inner, move, emit = np.split(sums, np.cumsum([k, k, k * k]))
        # A little of every symbol in every state, so that no text is impossible.
        emit = emit.reshape(k, n_symbols)
        emit = emit + 0.01 * (emit.sum(0) + 1) / (emit.sum() + n_symbols) + 1e-4
        model = tuple(x / x.sum(-1, keepdims=True) for x in (start + 0.1, inner + 0.1, move.reshape(k, k) + 0.1, emit))
    return model


def markov_scores(docs: DataFrame, params: MarkovParams = MarkovParams()) -> DataFrame:
    """Score every whole text of ``docs`` (doc_id, text) by a model of those outside the held-out fold.

    One row per input row: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known`` (tokens that occur in
    training), ``train_tokens``, ``base_score`` (log10 of the smoothed unigram model), ``score``
    (log10 probability of the text by the hidden Markov model).

    Defined cases: a null or blank text is the end alone. Rows with a null id are trained on and are
    not held out. Rows that repeat an id count each. Without a training text every state is alike, and an empty
    table gives an empty result. Other columns are ignored.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    scratch = Scratch(spark, "hidden-markov")
    held_out = F.coalesce(fold("doc_id", params.folds) == params.held_out, F.lit(False)).alias("held_out")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).select("*", held_out)
    counts = scratch.keep(count_tokens(docs.where("NOT held_out")))
    v, least = vocabulary(counts, params)
    words = spark.sparkContext.broadcast(v)
    coded = scratch.keep(encode(docs, words, params))
    model = spark.sparkContext.broadcast(train(coded.where("NOT held_out"), v.n_symbols, params))

    rare = coded.select("row", F.explode(F.arrays_zip("rare", "rare_n", "rare_last")).alias("w")).select("row", F.col("w.rare").alias("hash"), F.col("w.rare_n").alias("n"), F.col("w.rare_last").alias("last"))
    totals = F.array(*[F.lit(float(x)) for x in v.log_total])
    found = rare.join(counts.where(F.col("c") < least).select("hash", "c"), "hash", "left")
    log_c = F.log10(F.coalesce("c", F.lit(0)) + 1.0)
    found = found.groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("rare_known"),
        F.sum(F.col("n") * log_c).alias("rare_base"),
        F.sum(F.col("n") * (log_c - totals[F.col("last")])).alias("rare_inside"),
    )
    schema = pa.schema([("row", pa.int64()), ("forward", pa.float64())])

    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                yield pa.record_batch([batch.column("row"), pa.array(log10_likelihood(batch.column("symbols"), model.value))], schema=schema)

    scored = coded.select("row", "symbols").mapInArrow(forward, "row long, forward double")
    out = coded.select("row", "doc_id", "held_out", "n_tokens", "known", "base", "inside").join(scored, "row").join(found, "row", "left")
    zero = F.lit(0.0)
    return out.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(v.n_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", zero) - F.col("n_tokens") * float(np.log10(v.n_tokens + v.n_words + 1))).alias("base_score"),
        (F.col("inside") + F.coalesce("rare_inside", zero) + F.col("forward")).alias("score"),
    )
