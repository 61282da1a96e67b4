"""Toxicity scores by non-negative positive-unlabelled learning.

A linear classifier over hashed words and stems is fitted to confirmed toxic documents (P) and unlabelled
text (U), of which a share ``prior`` is toxic too. The risk of calling U negative is corrected by
that prior, ``R_u(-) - prior * R_p(-)``, and never pushed below zero: where it would be, the step
goes back up instead, which keeps a flexible model from memorizing P. Labelled rows then calibrate
the margin to a probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquarry.llm.common import Scratch, bounded_batches, fold
from docquarry.llm.words import HASHED, LOWER, WORDLIKE, mix, span_hashes, spans, text_bytes, text_slices

FEATURE_BITS = 22
#: Lengths in bytes of the beginnings of words that count beside the words: stems of inflected words.
STEMS = (4, 5, 6, 7, 8)


@dataclass(frozen=True)
class ToxicityParams:
    """``most_positive``, ``most_unlabelled``: rows of the training sample, the least by a hash of the id.

    ``contrasts``: standard errors by which a word's share of P must differ from that of U to count, of
    which the one with the least loss on labelled rows kept out of training is taken;
    ``lift``: the least ratio of the two. Toxic documents that are merely longer have more of all words.
    ``folds``, ``held_out``: rows whose id falls in that fold are never learned from.
    """

    most_positive: int = 2000
    most_unlabelled: int = 6000
    folds: int = 4
    held_out: int = 2
    contrasts: tuple[float, ...] = (4.0, 6.0, 9.0, 13.0)
    lift: float = 2.5
    cut: float = 0.3
    steps: int = 160
    rate: float = 0.08
    decay: float = 2e-3


@dataclass(frozen=True)
class ToxicityModel:
    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def __reduce__(self):
        # Few of the weights differ from zero; only these are sent to the workers.
        some = np.flatnonzero(self.weights)
        return _dense, (len(self.weights), some.astype(np.int32), self.weights[some], self.bias, self.slope, self.offset)

    def scores(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.offset, -500, 500)))


def _dense(size: int, some: np.ndarray, values: np.ndarray, bias: float, slope: float, offset: float) -> ToxicityModel:
    weights = np.zeros(size, values.dtype)
    weights[some] = values
    return ToxicityModel(weights, bias, slope, offset)


def _counts(rows: list[np.ndarray]) -> np.ndarray:
    """In how many rows each feature stands, row by row: no copy of all rows is made."""
    total = np.zeros(1 << FEATURE_BITS, np.int32)
    for row in rows:
        total[row] += 1  # features are distinct within a row
    return total


def features(column: pa.Array, useful: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of every distinct hashed word and stem of each row, of the ``useful`` ones only if given."""
    raw, borders = text_bytes(column)
    raw = LOWER[raw]
    starts, ends = spans(WORDLIKE[raw], borders)
    row = np.searchsorted(borders, starts, side="right") - 1
    found = []
    for length in (None, *STEMS):
        long = slice(None) if length is None else ends - starts > length
        at, stop = starts[long], ends[long] if length is None else starts[long] + length
        hashes = span_hashes(raw, at, stop)
        if length is not None:
            hashes = mix(hashes + np.uint64(length))
        feature = (hashes >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)
        of = row[long]
        if useful is not None:
            of, feature = of[useful[feature]], feature[useful[feature]]
        found.append((of << FEATURE_BITS) | feature)
    both = np.unique(np.concatenate(found))
    return both >> FEATURE_BITS, both & ((1 << FEATURE_BITS) - 1)


def _sample(docs: DataFrame, labels: DataFrame, params: ToxicityParams) -> tuple[list, tuple[int, int]]:
    """(toxic, unlabelled, features) of the training sample, whose size is bounded by ``params``, and the
    number of ids of either label (0, 1) it was drawn from."""
    learn = F.coalesce(fold("doc_id", params.folds) != params.held_out, F.lit(False))
    marked = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    marked = Scratch(docs.sparkSession, "toxicity").keep(marked.where(learn).join(docs.select("doc_id"), "doc_id", "left_semi"))
    counts = dict(marked.groupBy("toxic").count().collect())
    first = (F.xxhash64("doc_id"), "doc_id")
    parts = [marked.where(F.col("toxic") == y).orderBy(*first).limit(params.most_positive).select("doc_id", "toxic", F.lit(False).alias("free")) for y in (1, 0)]
    free = docs.where(learn).select("doc_id").distinct().orderBy(*first).limit(params.most_unlabelled)
    chosen = parts[0].unionByName(parts[1]).unionByName(free.select("doc_id", F.lit(None).cast("int").alias("toxic"), F.lit(True).alias("free")))
    chosen = chosen.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.max("free").alias("free"))
    schema = pa.schema([("doc_id", pa.int64()), ("toxic", pa.int32()), ("free", pa.bool_()), ("features", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in text_slices(batch.column("text"), HASHED):
                part = batch.slice(lo, hi - lo)
                row, feature = features(part.column("text"))
                borders = np.searchsorted(row, np.arange(len(part) + 1))
                blobs = [feature[a:b].astype(np.int32).tobytes() for a, b in zip(borders[:-1], borders[1:])]
                yield pa.record_batch([part.column("doc_id"), part.column("toxic"), part.column("free"), pa.array(blobs, pa.binary())], schema=schema)

    joined = docs.join(chosen, "doc_id").select("doc_id", "toxic", "free", "text")
    found = joined.mapInArrow(run, "doc_id long, toxic int, free boolean, features binary")
    # One row per chosen id, whatever number of rows repeat it; less than any other, so that runs agree.
    rows = found.groupBy("doc_id").agg(F.min(F.struct("toxic", "free", "features")).alias("one")).select("doc_id", "one.*").collect()
    return sorted(rows, key=lambda r: (r.doc_id, r.features)), (counts.get(0, 0), counts.get(1, 0))


def fit(sample: list, counts: tuple[int, int], params: ToxicityParams) -> ToxicityModel:
    """Fit to rows (toxic or null, free, features). ``free`` rows make up the unlabelled text.

    ``counts``: the labels 0 and 1 the labelled rows were drawn from. They give the prior, and what a
    sampled row of either label counts for in the calibration and the choice of the contrast. Without a confirmed toxic row every score is that of the smallest prior.
    """
    known = [i for i, r in enumerate(sample) if r.toxic is not None]
    # Every fourth labelled row of each label is kept out while the contrast is chosen.
    kept_out = {i for y in (0, 1) for i in [i for i in known if sample[i].toxic == y][::4]}
    rest = [r for i, r in enumerate(sample) if i not in kept_out]
    check = [sample[i] for i in sorted(kept_out)]
    stands_for = [counts[y] / max(1, sum(sample[i].toxic == y for i in known)) for y in (0, 1)]
    prior = float(np.clip(counts[1] / max(1, sum(counts)), 1e-3, 0.9))

    def loss(contrast: float) -> float:
        model = _fit(rest, contrast, prior, stands_for, params)
        total = 0.0
        for r in check:
            p = float(model.scores(np.array([model.weights[np.frombuffer(r.features, np.int32)].sum() + model.bias]))[0])
            total -= stands_for[r.toxic] * np.log(max(1e-6, p if r.toxic == 1 else 1 - p))
        return total

    best = min(params.contrasts, key=loss) if any(sample[i].toxic == 1 for i in known) else params.contrasts[0]
    return _fit(sample, best, prior, stands_for, params)


def _fit(sample: list, contrast: float, prior: float, stands_for: list[float], params: ToxicityParams) -> ToxicityModel:
    size = 1 << FEATURE_BITS
    blobs = [np.frombuffer(r.features, np.int32) for r in sample]
    known = [i for i, r in enumerate(sample) if r.toxic is not None]
    positive = [blobs[i] for i in known if sample[i].toxic == 1]
    unlabelled = [blobs[i] for i, r in enumerate(sample) if r.free]
    if not positive or not unlabelled:
        return ToxicityModel(np.zeros(size, np.float32), 0.0, 1.0, float(np.log(prior / (1 - prior)) if positive else -7.0))
    # Words that stand as often in toxic as in any text only add noise to long documents.
    in_p = _counts(positive)
    some = np.flatnonzero(in_p >= 2)
    in_p, in_u = in_p[some], _counts(unlabelled)[some]
    pooled = (in_p + in_u) / (len(positive) + len(unlabelled))
    error = np.sqrt(pooled * (1 - pooled) * (1 / len(positive) + 1 / len(unlabelled))) + 1e-12
    share_p, share_u = in_p / len(positive), in_u / len(unlabelled)
    lifted = (share_p >= params.lift * share_u) | (share_u >= params.lift * share_p)
    kept = np.zeros(size, bool)
    kept[some[lifted & (np.abs(share_p - share_u) >= contrast * error)]] = True
    chosen = np.flatnonzero(kept)
    width = len(chosen)

    def matrix(rows: list) -> tuple[np.ndarray, np.ndarray, int]:
        found = [r[kept[r]] for r in rows]
        return np.repeat(np.arange(len(rows)), [len(r) for r in found]), np.searchsorted(chosen, np.concatenate(found)), len(rows)

    def margins(m: tuple[np.ndarray, np.ndarray, int]) -> np.ndarray:
        return np.bincount(m[0], weights=w[m[1]], minlength=m[2]) + b

    def gradient(m: tuple[np.ndarray, np.ndarray, int], slope: np.ndarray) -> tuple[np.ndarray, float]:
        return np.bincount(m[1], weights=slope[m[0]], minlength=width) / m[2], float(slope.mean())

    p, u = matrix(positive), matrix(unlabelled)
    w, b = np.zeros(width), float(np.log(prior / (1 - prior)))
    moment, spread, b_moment, b_spread = np.zeros(width), np.zeros(width), 0.0, 0.0
    for step in range(1, params.steps + 1):
        fp, fu = margins(p), margins(u)
        sp, su = 1 / (1 + np.exp(-fp)), 1 / (1 + np.exp(-fu))
        negative_risk = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        as_positive = gradient(p, prior * (sp - 1))
        from_u, from_p = gradient(u, su), gradient(p, prior * sp)
        sign = 1.0 if negative_risk >= 0 else -1.0
        gw = sign * (from_u[0] - from_p[0]) + (as_positive[0] if sign > 0 else 0) + params.decay * w
        gb = sign * (from_u[1] - from_p[1]) + (as_positive[1] if sign > 0 else 0)
        moment, spread = 0.9 * moment + 0.1 * gw, 0.99 * spread + 0.01 * gw * gw
        b_moment, b_spread = 0.9 * b_moment + 0.1 * gb, 0.99 * b_spread + 0.01 * gb * gb
        fix = np.sqrt(1 - 0.99**step) / (1 - 0.9**step) * params.rate
        w -= fix * moment / (np.sqrt(spread) + 1e-6)
        b -= fix * b_moment / (np.sqrt(b_spread) + 1e-6)
    slope, offset = _calibrate(margins(matrix([blobs[i] for i in known])), np.array([sample[i].toxic for i in known], float), stands_for)
    weights = np.zeros(size, np.float32)
    weights[kept] = w
    return ToxicityModel(weights, b, slope, offset)


def _calibrate(margin: np.ndarray, toxic: np.ndarray, stands_for: list[float]) -> tuple[float, float]:
    """Slope and offset of the logistic curve from margin to probability, by damped Newton steps.

    A row of label y counts ``stands_for[y]`` times. Targets are smoothed, so separable rows give finite values.
    """
    n_1, n_0 = toxic.sum(), len(toxic) - toxic.sum()
    target = np.where(toxic == 1, (n_1 + 1) / (n_1 + 2), 1 / (n_0 + 2))
    times = np.where(toxic == 1, stands_for[1], stands_for[0])
    odds = float(np.log((n_1 * stands_for[1] + 1) / (n_0 * stands_for[0] + 1)))
    centre, width = margin.mean(), margin.std() + 1e-6
    x = np.stack([(margin - centre) / width, np.ones(len(margin))], 1)

    def loss(v: np.ndarray) -> float:
        z = x @ v
        return float((times * (np.logaddexp(0, z) - target * z)).sum() + 1e-3 * v @ v)

    v = np.array([1.0, odds])
    for _ in range(100):
        q = 1 / (1 + np.exp(-np.clip(x @ v, -500, 500)))
        step = np.linalg.solve((x * (times * q * (1 - q))[:, None]).T @ x + 2e-3 * np.eye(2), x.T @ (times * (q - target)) + 2e-3 * v)
        size = 1.0
        while loss(v - size * step) > loss(v) and size > 1e-6:
            size /= 2
        v = v - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    if v[0] <= 0:
        return 0.0, odds
    return float(v[0] / width), float(v[1] - v[0] * centre / width)


def toxicity(docs: DataFrame, labels: DataFrame, params: ToxicityParams = ToxicityParams(), row: str | None = None) -> DataFrame:
    """Score every whole text of ``docs`` (doc_id, text); learn from ``labels`` (doc_id, toxic).

    One row per input row: ``doc_id``, ``held_out``, ``score`` (0 to 1), ``predicted`` (score at
    least ``params.cut``). Only the text enters a score. ``row`` names a column of ``docs``, a long, that is
    returned too.

    Defined cases: a null or empty text has no features and gets the score of the bias alone. A null
    doc_id is scored, never learned from, and not held out. Null labels are no labels; of several
    labels of one id the largest holds. Empty tables of labels give every document one low score. Other
    columns are ignored.
    """
    bounded_batches(docs.sparkSession)
    kept = [row] if row else []
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *kept)
    labels = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic")
    model = docs.sparkSession.sparkContext.broadcast(fit(*_sample(docs, labels, params), params))
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), *((c, pa.int64()) for c in kept)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        useful = model.value.weights != 0
        for batch in batches:
            for lo, hi in text_slices(batch.column("text"), HASHED):
                part = batch.slice(lo, hi - lo)
                row, feature = features(part.column("text"), useful)
                margin = np.bincount(row, weights=model.value.weights[feature], minlength=len(part)) + model.value.bias
                yield pa.record_batch([part.column("doc_id"), pa.array(model.value.scores(margin)), *(part.column(c) for c in kept)], schema=schema)

    scored = docs.mapInArrow(run, ", ".join(["doc_id long, score double", *(f"{c} long" for c in kept)]))
    return scored.select(
        "doc_id",
        F.coalesce(fold("doc_id", params.folds) == params.held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= params.cut).cast("int").alias("predicted"),
        *kept,
    )
