"""Language identification: averaged embeddings of hashed subwords and a linear softmax.

Subwords are the 3- and 4-byte pieces of the lower-cased text, in which runs of ASCII characters
that are no letters count as one blank. Their embeddings and the softmax are trained together by
stochastic gradient descent on a bounded sample per language. A temperature, fitted on rows of the
sample kept out of training, calibrates the score; below the score at which those rows reach the
wanted precision, a prediction is marked as rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docquarry.llm.common import Scratch, bounded_batches, fold
from docquarry.llm.words import LOWER, text_bytes, text_slices

BUCKET_BITS = 15
#: Ids ranked for the sample, over those it takes: more than the rough counts are out by.
SPARE = 4

_LETTER = np.zeros(256, bool)
_LETTER[[*range(97, 123), *range(128, 256)]] = True


@dataclass(frozen=True)
class LanguageParams:
    """``most_per_language``: rows of the training sample for each language, the least by a hash of the id."""

    most_per_language: int = 400
    folds: int = 3
    held_out: int = 1
    width: int = 16
    epochs: int = 6
    rate: float = 0.5
    precision: float = 0.99


@dataclass(frozen=True)
class LanguageModel:
    """``table``: per bucket its embedding times the softmax weights, over the temperature."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    reject_below: float


def subwords(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every subword of all rows, and the row borders among them."""
    raw, borders = text_bytes(column)
    raw = LOWER[raw]
    letter = _LETTER[raw]
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first of a run of other characters stands for all
    keep[borders[:-1][borders[:-1] < len(raw)]] = True
    symbols = np.where(letter, raw, np.uint8(32))[keep].astype(np.uint32)
    edges = np.concatenate([[0], np.cumsum(keep)])[borders]
    if len(symbols) < 3:
        return np.empty(0, np.int64), np.zeros(len(borders), np.int64)
    three = symbols[:-2] | symbols[1:-1] << 8 | symbols[2:] << 16
    four = np.append(three[:-1] | symbols[3:] << 24, np.uint32(0))
    both = np.stack([three * np.uint32(2654435761), four * np.uint32(2246822519)], 1) >> np.uint32(32 - BUCKET_BITS)
    # A subword that would cross a row border belongs to no row.
    last = np.repeat(edges[1:], np.diff(edges))[: len(three)]
    at = np.arange(len(three))
    inside = np.stack([at + 3 <= last, at + 4 <= last], 1)
    counts = np.concatenate([[0], np.cumsum(inside.sum(1))])
    return both[inside].astype(np.int64), counts[np.minimum(edges, len(three))]


def _sample(docs: DataFrame, params: LanguageParams) -> list:
    learn = F.coalesce(fold("doc_id", params.folds) != params.held_out, F.lit(False)) & F.col("lang").isNotNull()
    first = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    # Ids come in the order of their hash. A bound on it, from the languages' counts, leaves a few times the
    # sample to be ranked, however many ids a language and tasks there are; the counts may be rough for that.
    counts = docs.where(learn).groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("ids"))
    share = F.lit(SPARE * params.most_per_language) / F.col("ids")
    near = F.xxhash64("doc_id") / F.lit(2.0**64) + 0.5 <= F.col("share")
    shares = Scratch(docs.sparkSession, "language-id").keep(counts.select("lang", share.alias("share")))
    chosen = docs.where(learn).select("doc_id", "lang").join(shares, "lang").where(near).select("doc_id", "lang").distinct()
    chosen = chosen.withColumn("at", F.row_number().over(first)).where(F.col("at") <= params.most_per_language).drop("at")
    # Written, its size is known: a few rows are broadcast, and the texts stay where they are.
    chosen = Scratch(docs.sparkSession, "language-id").keep(chosen)
    schema = pa.schema([("lang", pa.string()), ("at", pa.int64()), ("buckets", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in text_slices(batch.column("text")):
                part = batch.slice(lo, hi - lo)
                bucket, borders = subwords(part.column("text"))
                pairs = [np.unique(bucket[a:b], return_counts=True) for a, b in zip(borders[:-1], borders[1:])]
                yield pa.record_batch(
                    [part.column("lang"), part.column("doc_id"), pa.array([x for x, _ in pairs], pa.list_(pa.int32())), pa.array([c for _, c in pairs], pa.list_(pa.int32()))],
                    schema=schema,
                )

    joined = docs.join(chosen, ["doc_id", "lang"]).select("doc_id", "lang", "text")
    found = joined.mapInArrow(run, "lang string, at long, buckets array<int>, counts array<int>")
    # One row per chosen id, whatever number of rows repeat it; less than any other, so that runs agree.
    rows = found.where(F.size("buckets") > 0).groupBy("lang", "at").agg(F.min(F.struct("buckets", "counts")).alias("one"))
    rows = rows.select("lang", "at", "one.buckets", "one.counts").collect()
    return sorted((r for r in rows if r.buckets), key=lambda r: (r.at, r.lang))


def fit(sample: list, params: LanguageParams) -> LanguageModel | None:
    """None if there is no row to learn from."""
    languages = sorted({r.lang for r in sample})
    if not languages:
        return None
    rng = np.random.default_rng(11)
    rows = [(np.asarray(r.buckets, np.int64), np.asarray(r.counts, np.float64) / sum(r.counts), languages.index(r.lang)) for r in sample]
    order = rng.permutation(len(rows))
    kept_out = order[: len(rows) // 5]
    train = order[len(rows) // 5 :]
    embed = rng.normal(0, 1 / params.width, (1 << BUCKET_BITS, params.width))
    soft, bias = np.zeros((params.width, len(languages))), np.zeros(len(languages))
    total, done = params.epochs * len(train), 0
    for _ in range(params.epochs):
        for i in rng.permutation(train):
            bucket, share, y = rows[i]
            rate = params.rate * (1 - done / total)
            hidden = share @ embed[bucket]
            logit = hidden @ soft + bias
            wrong = np.exp(logit - logit.max())
            wrong /= wrong.sum()
            wrong[y] -= 1
            back = soft @ wrong
            soft -= rate * np.outer(hidden, wrong)
            bias -= rate * 0.1 * wrong
            # A document's mean moves by about one step, however many subwords share it.
            embed[bucket] -= rate * (share / max(1e-9, float(share @ share)))[:, None] * back / np.sqrt(len(bucket))
            done += 1
    table = embed @ soft
    check = kept_out if len(kept_out) >= 10 else order
    logits = np.array([rows[i][1] @ table[rows[i][0]] + bias for i in check])
    truth = np.array([rows[i][2] for i in check])

    def probability(t: float) -> np.ndarray:
        z = logits / t
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)

    heat = min(np.geomspace(0.2, 5, 33), key=lambda t: -np.log(probability(t)[np.arange(len(truth)), truth] + 1e-12).mean())
    best = probability(heat)
    score, right = best.max(1), best.argmax(1) == truth
    down = np.argsort(-score)
    precise = np.cumsum(right[down]) / np.arange(1, len(down) + 1) >= params.precision
    reject_below = float(score[down][np.flatnonzero(precise)[-1]]) if precise.any() else 1.0
    return LanguageModel(languages, (table / heat).astype(np.float32), bias / heat, min(reject_below, 0.5) if precise.all() else reject_below)


def identify_language(docs: DataFrame, params: LanguageParams = LanguageParams()) -> DataFrame:
    """Predict the language of every whole text of ``docs`` (doc_id, text, lang).

    One row per input row: ``doc_id``, ``held_out``, ``lang_pred`` (a learned language; ``und`` if
    the text is null or has no letter), ``score`` (calibrated probability; 0 for ``und``),
    ``rejected`` (the score is below the calibrated bound). Only the text enters a prediction.

    Defined cases: null languages and null ids are not learned from; a null id is not held out.
    Texts too short for a subword get the prediction of the bias. A table without a row to learn
    from gives ``und`` everywhere. Rows that repeat an id are each predicted. Other columns are ignored.
    """
    bounded_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    model = docs.sparkSession.sparkContext.broadcast(fit(_sample(docs, params), params))
    schema = pa.schema([("doc_id", pa.int64()), ("lettered", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = model.value
        for batch in batches:
            for lo, hi in text_slices(batch.column("text")):
                part = batch.slice(lo, hi - lo)
                if known is None:
                    label, score, bound = np.full(len(part), "und"), np.zeros(len(part)), 1.0
                else:
                    bucket, borders = subwords(part.column("text"))
                    logits = np.empty((len(part), len(known.languages)))
                    for k in range(len(known.languages)):
                        sums = np.concatenate([[0.0], np.cumsum(known.table[:, k][bucket], dtype=np.float64)])
                        logits[:, k] = (sums[borders[1:]] - sums[borders[:-1]]) / np.maximum(1, np.diff(borders)) + known.bias[k]
                    z = np.exp(logits - logits.max(1, keepdims=True))
                    z /= z.sum(1, keepdims=True)
                    label, score, bound = np.array(known.languages, object)[z.argmax(1)], z.max(1), known.reject_below
                columns = [part.column("doc_id"), part.column("lettered"), pa.array(label, pa.string()), pa.array(score), pa.array(score < bound)]
                yield pa.record_batch(columns, schema=schema)

    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("lettered")
    found = docs.select("doc_id", "text", lettered).mapInArrow(run, "doc_id long, lettered boolean, lang_pred string, score double, rejected boolean")
    return found.select(
        "doc_id",
        F.coalesce(fold("doc_id", params.folds) == params.held_out, F.lit(False)).alias("held_out"),
        F.when(F.col("lettered"), F.col("lang_pred")).otherwise("und").alias("lang_pred"),
        F.when(F.col("lettered"), F.col("score")).otherwise(0.0).alias("score"),
        (F.col("rejected") | ~F.col("lettered")).alias("rejected"),
    )
