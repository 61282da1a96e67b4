"""Benchmark decontamination by latent semantic retrieval.

Words are hashed to a fixed number of terms. Passages of all documents, weighted by TF-IDF, give
the term space: one pass multiplies their Gram matrix by a random matrix (each worker adds up its
part), and the Nystroem form of that product gives its leading eigenvectors. Every window of every
document is projected onto them and compared by cosine with the benchmark items of like length.
Candidates whose words in common weigh enough are then checked on their words: the longest common subsequence with the item must cover
most of it, or, for a paraphrase, half of it and hold the item's answer.

The cosine a candidate needs is set for each item by its length and scale (``_bounds``): edits that
the check still accepts are drawn at random, and the bound lies under the cosines of their windows.
Edits of another kind may move a window farther away. A region that passes the check must hold
enough of the item's rare words, so an index of these (``_Probes``) names the regions that could pass;
of them only windows are added that the latent space has lost, and such finds are marked.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquarry.llm.common import Scratch, bounded_batches, summed
from docquarry.llm.words import LOWER, WORDLIKE, span_hashes, spans, text_bytes, text_slices

TERM_BITS = 13
PASSAGE = 32
SCALES = (8, 16, 32, 64, 128)


@dataclass(frozen=True)
class ContaminationParams:
    """``cosine``, ``least_cosine``: the range of the bounds of candidates of the latent space, each under the
    cosines of the share ``recalled`` of ``draws`` random edits. ``copied``: share of an item's words in common order that is a copy.

    ``paraphrased``: the share that is enough together with the answer, the ``answer`` column if
    there is one, else the item's ``rarest`` rarest words. ``block``: items a pass compares with, on average.
    ``latent``: without it only what the index adds is returned.
    """

    rank: int = 48
    cosine: float = 0.65
    least_cosine: float = 0.4
    draws: int = 64
    recalled: float = 0.95
    latent: bool = True
    copied: float = 0.75
    paraphrased: float = 0.5
    rarest: int = 3
    block: int = 2048


def _word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    raw, borders = text_bytes(column)
    raw = LOWER[raw]
    starts, ends = spans(WORDLIKE[raw], borders)
    return span_hashes(raw, starts, ends), np.searchsorted(starts, borders)


def _terms(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - TERM_BITS)).astype(np.int64)


def _term_table(docs: DataFrame) -> DataFrame:
    """(terms) of every text, as 16-bit integers."""
    schema = pa.schema([("terms", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in text_slices(batch.column("text")):
                hashes, borders = _word_hashes(batch.column("text").slice(lo, hi - lo))
                terms = _terms(hashes).astype("<u2")
                yield pa.record_batch([pa.array([terms[a:b].tobytes() for a, b in zip(borders[:-1], borders[1:])], pa.binary())], schema=schema)

    return docs.select("text").mapInArrow(run, "terms binary")


def _passages(blobs: pa.Array) -> np.ndarray:
    """The passages of all texts, a row each; places after the end hold the term after the last."""
    none = 1 << TERM_BITS
    rows = []
    for blob in blobs:
        terms = np.frombuffer(blob.as_buffer(), "<u2").astype(np.int64)
        rows.append(np.append(terms, np.full(-len(terms) % PASSAGE, none)))
    return np.concatenate(rows).reshape(-1, PASSAGE)


def term_space(terms: DataFrame, rank: int) -> tuple[np.ndarray, np.ndarray]:
    """(idf, projection): the inverse passage frequency of each term, and its whitened latent vector."""
    n_terms = 1 << TERM_BITS

    def frequencies(blobs: pa.Array) -> np.ndarray:
        rows = np.sort(_passages(blobs), 1)
        new = np.ones(rows.shape, bool)
        new[:, 1:] = rows[:, 1:] != rows[:, :-1]
        return np.append(np.bincount(rows[new], minlength=n_terms + 1)[:n_terms], len(rows)).astype(np.float64)

    found = summed(terms, "terms", n_terms + 1, frequencies)
    idf = np.log((found[-1] + 1) / (found[:-1] + 1)) + 0.1
    omega = np.linalg.qr(np.random.default_rng(29).normal(size=(n_terms, rank)))[0]
    sent = terms.sparkSession.sparkContext.broadcast((np.append(idf, 0).astype(np.float32), np.vstack([omega, np.zeros(rank)]).astype(np.float32)))

    def gram(blobs: pa.Array) -> np.ndarray:
        weights, directions = sent.value
        out = np.zeros((rank, n_terms + 1))
        passages = _passages(blobs)
        for lo in range(0, len(passages), 2048):
            rows = passages[lo : lo + 2048]
            w = weights[rows]
            w = w / np.maximum(1e-9, np.sqrt((w * w).sum(1, keepdims=True)))
            latent = np.matmul(w[:, None, :], directions[rows])[:, 0, :]
            flat = rows.reshape(-1)
            for k in range(rank):
                out[k] += np.bincount(flat, weights=(w * latent[:, k, None]).reshape(-1), minlength=n_terms + 1)
        return out[:, :n_terms].reshape(-1)

    product = summed(terms, "terms", rank * n_terms, gram).reshape(rank, n_terms).T
    # Nystroem: G ~ Y (W'Y)^-1 Y' for Y = G W; a small shift keeps the Cholesky factor real.
    shift = 1e-7 * np.linalg.norm(product) + 1e-12
    core = omega.T @ (product + shift * omega)
    factor = np.linalg.solve(np.linalg.cholesky((core + core.T) / 2 + shift * np.eye(rank)), (product + shift * omega).T).T
    left, sigma, _ = np.linalg.svd(factor, full_matrices=False)
    scale = np.where(sigma > 1e-6 * sigma.max(), 1 / np.maximum(sigma, 1e-12), 0)
    return idf, (left * scale).astype(np.float32)


def common_subsequence(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, a bit of one integer per word of ``a``."""
    places: dict[int, int] = {}
    for i, word in enumerate(a):
        places[word] = places.get(word, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for word in b:
        at = places.get(word)
        if at:
            u = row & at
            row = ((row + u) | (row - u)) & full
    return len(a) - row.bit_count()


@dataclass(frozen=True)
class _Probes:
    """Sets of words, ``need`` of which stand within ``reach`` words wherever the check of ``item`` passes.

    A region with at least k of an item's n words in order lacks n - k of its places at most, so of
    any m places it has m - (n - k). The probe for copies is the rarer half or so of the places, that
    for paraphrases the answer.
    """

    #: Sorted words, and the sets each is in: sets[first[i] : first[i + 1]].
    words: np.ndarray
    first: np.ndarray
    sets: np.ndarray
    item: np.ndarray
    need: np.ndarray
    reach: np.ndarray


@dataclass(frozen=True)
class _Items:
    ids: list[int]
    words: list[list[int]]
    answers: list[list[int]]
    #: Number of words and their idf, and which terms an item has.
    sizes: np.ndarray
    weights: np.ndarray
    has: np.ndarray
    #: The scales of each item's parts.
    scales: list[set[int]]
    #: Per scale: the item of each query vector, the vectors, and the cosine a candidate of each needs.
    queries: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]
    probes: _Probes


def _scale(n: int) -> int:
    return min(SCALES, key=lambda s: abs(np.log2(max(1, n) / s)))


def _margin(n: int) -> int:
    """Words before and after a window that are checked with it."""
    return max(8, n // 2) if n <= 192 else n


def _probes(words: list[list[int]], answers: list[list[int]], scales: list[set[int]], idf: np.ndarray, params: ContaminationParams) -> _Probes:
    pairs, item, need, reach = set(), [], [], []
    for i, of_item in enumerate(words):
        n = len(of_item)
        hashes = np.array(of_item, np.uint64)
        least = max(1, int(np.ceil(params.copied * n - 1e-9)))
        spare = max(1, least // 3)
        rarest = hashes[np.argsort(-idf[_terms(hashes)], kind="stable")][: n - least + spare]
        for probe, enough in ((rarest.tolist(), spare), (answers[i], len(set(answers[i])))):
            pairs |= {(word, len(item)) for word in probe}
            item.append(i)
            need.append(enough)
            reach.append(max(scales[i]) + 2 * _margin(n))
    ordered = sorted(pairs)
    unique, first = np.unique(np.array([w for w, _ in ordered], np.uint64), return_index=True)
    return _Probes(unique, np.append(first, len(ordered)), np.array([q for _, q in ordered], np.int64), *(np.array(x, np.int64) for x in (item, need, reach)))


def _probed(hashes: np.ndarray, borders: np.ndarray, items: _Items) -> tuple[np.ndarray, ...]:
    """(row, item, first, last): spans of places of a text that hold enough words of a probe of an item."""
    probes = items.probes
    at = np.minimum(np.searchsorted(probes.words, hashes), max(0, len(probes.words) - 1))
    place = np.flatnonzero(probes.words[at] == hashes) if len(probes.words) else np.empty(0, np.int64)
    at = at[place]
    times = probes.first[at + 1] - probes.first[at]
    nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    of, place = probes.sets[np.repeat(probes.first[at], times) + nth], np.repeat(place, times)
    order = np.argsort(of, kind="stable")
    of, place = of[order], place[order]
    start = np.arange(len(of))
    stop = start + probes.need[of] - 1
    start, stop = start[stop < len(of)], stop[stop < len(of)]
    row = np.searchsorted(borders, place, side="right") - 1
    good = (of[start] == of[stop]) & (row[start] == row[stop]) & (place[stop] - place[start] < probes.reach[of[start]])
    start, stop = start[good], stop[good]
    return row[start], probes.item[of[start]], place[start], place[stop]


def _passes(item: list[int], answer: list[int], region: list[int], params: ContaminationParams) -> tuple[bool, float, bool]:
    """(whether the check passes, share, answered)."""
    share, answered = common_subsequence(item, region) / len(item), set(answer) <= set(region)
    return share >= params.copied or (share >= params.paraphrased and answered), share, answered


def _windows_to_check(hashes: np.ndarray, borders: np.ndarray, items: _Items, params: ContaminationParams) -> dict[int, list[tuple[int, int, int, int]]]:
    """Per scale: (row, item, first, last) of runs of windows that can pass by the probes."""
    runs: dict[tuple[int, int, int], list[tuple[int, int]]] = {}
    for row, item, lo, hi in zip(*(x.tolist() for x in _probed(hashes, borders, items))):
        margin, begin, size = _margin(len(items.words[item])), int(borders[row]), int(borders[row + 1] - borders[row])
        for scale in items.scales[item]:
            step = scale // 4
            a = max(0, (hi - begin - scale - margin) // step + 1)
            b = min((lo - begin + margin) // step, max(0, -(-size // step) - 4))
            if a <= b:
                runs.setdefault((row, item, scale), []).append((a, b))
    out: dict[int, list[tuple[int, int, int, int]]] = {}
    for (row, item, scale), spans_ in runs.items():
        merged: list[list[int]] = []
        for a, b in sorted(spans_):
            if merged and a <= merged[-1][1] + 1:
                merged[-1][1] = max(b, merged[-1][1])
            else:
                merged.append([a, b])
        margin, begin, end = _margin(len(items.words[item])), int(borders[row]), int(borders[row + 1])
        for a, b in merged:
            # What the whole run does not hold none of its windows does.
            whole = hashes[max(begin, begin + a * (scale // 4) - margin) : min(end, begin + b * (scale // 4) + scale + margin)].tolist()
            if _passes(items.words[item], items.answers[item], whole, params)[0]:
                out.setdefault(scale, []).append((row, item, a, b))
    return out


def _bound(part: np.ndarray, answer: np.ndarray, scale: int, vector: np.ndarray, idf: np.ndarray, weighted: np.ndarray, drawn: np.ndarray, params: ContaminationParams) -> float:
    """The cosine that windows of ``scale`` over edited copies of the terms ``part`` keep to ``vector``.

    Half of the copies keep the share of a copy, half that of a paraphrase and the answer; what they
    lose, and what stands around them, are terms of the corpus (``drawn``, a row a copy). Windows begin
    at multiples of a quarter of their length, so the best one is off by an eighth at most.
    """
    n, n_copies = len(part), len(drawn)
    rng = np.random.default_rng(n)
    rank = np.argsort(np.argsort(rng.random((n_copies, n)), 1), 1)
    least = np.where(np.arange(n_copies) % 2 == 0, params.copied, params.paraphrased)
    kept = rank < np.ceil(least * n)[:, None]
    kept |= np.isin(part, answer) & (np.arange(n_copies) % 2 == 1)[:, None]
    text = drawn[:, : n + 2 * scale].copy()
    text[:, scale : scale + n] = np.where(kept, part, text[:, scale : scale + n])
    off = rng.integers(-(scale // 8), scale // 8 + 1, n_copies)
    first = scale + (n - scale) // 2 + off
    windows = np.take_along_axis(text, first[:, None] + np.arange(scale), 1)
    found = weighted[windows].sum(1)
    cosines = found @ vector / np.maximum(1e-9, np.linalg.norm(found, axis=1))
    return float(np.clip(np.quantile(cosines, 1 - params.recalled), params.least_cosine, params.cosine))


def _items(rows: list, idf: np.ndarray, projection: np.ndarray, params: ContaminationParams) -> _Items:
    ids, words, answers, vectors, scales = [], [], [], {}, []
    weighted = (projection * idf[:, None]).astype(np.float32)
    # Terms as often as passages of the corpus have them; those of none, never.
    often = np.exp(-idf) - np.exp(-idf.max())
    shares = np.cumsum(often) / often.sum() if often.sum() > 0 else np.arange(1, len(idf) + 1) / len(idf)
    drawn = np.random.default_rng(7).random((params.draws, 2 * SCALES[-1] + 2 * SCALES[-1]))
    drawn = np.minimum(np.searchsorted(shares, drawn), len(idf) - 1)
    for row in rows:
        hashes, borders = _word_hashes(pa.array([row.text, row.answer], pa.string()))
        item, answer = hashes[: borders[1]], hashes[borders[1] :]
        if not len(item):
            continue
        terms = _terms(item)
        if not len(answer):
            unique, first = np.unique(item, return_index=True)
            answer = unique[np.lexsort((unique, -idf[terms[first]]))[: params.rarest]]
        n_parts = -(-len(item) // (SCALES[-1] + SCALES[-1] // 2))
        scales.append({_scale(len(part)) for part in np.array_split(terms, n_parts)})
        for part in np.array_split(terms, n_parts):
            vector = idf[part] @ projection[part]
            vector, scale = vector / max(1e-9, np.linalg.norm(vector)), _scale(len(part))
            bound = _bound(part, _terms(answer), scale, vector, idf, weighted, drawn, params)
            vectors.setdefault(scale, []).append((len(ids), vector, bound))
        ids.append(row.item_id)
        words.append(item.tolist())
        answers.append(answer.tolist())
    has = np.zeros((len(ids), len(idf)), bool)
    weights = np.zeros(len(ids))
    for i, item in enumerate(words):
        terms = _terms(np.array(item, np.uint64))
        has[i, terms] = True
        weights[i] = idf[terms].sum()
    queries = {s: (np.array([i for i, _, _ in v]), np.array([x for _, x, _ in v], np.float32), np.array([b for _, _, b in v], np.float32)) for s, v in vectors.items()}
    return _Items(ids, words, answers, np.array([len(w) for w in words]), weights, has, scales, queries, _probes(words, answers, scales, idf, params))


def _overlaps(terms: np.ndarray, idf: np.ndarray, items: _Items, starts: np.ndarray, ends: np.ndarray, of: np.ndarray, scale: int, params: ContaminationParams) -> np.ndarray:
    """Whether a window's words that the item has weigh enough for a paraphrase of what it can hold of the item."""
    at = starts[:, None] + np.arange(scale)
    inside = at < ends[:, None]
    here = terms.take(at, mode="clip")
    hit = np.flatnonzero(items.has.reshape(-1).take((of * items.has.shape[1])[:, None] + here) & inside)
    weight = np.bincount(hit // scale, weights=idf.take(here.reshape(-1).take(hit)), minlength=len(of))
    share = np.minimum(1, scale / items.sizes[of])
    return weight >= 0.8 * params.paraphrased * share * items.weights[of]


def _matches(hashes: np.ndarray, borders: np.ndarray, items: _Items, idf: np.ndarray, weighted: np.ndarray, params: ContaminationParams) -> Iterator[tuple]:
    """(row, item, start, end, cosine, share, answered, by_index) of the texts' windows that match an item."""
    terms = _terms(hashes)
    # Texts are padded to whole numbers of the largest step, so sums over steps never mix two texts.
    largest = SCALES[-1] // 4
    sizes = np.diff(borders)
    padded = np.concatenate([[0], np.cumsum(-(-sizes // largest) * largest)])
    if not padded[-1]:
        return
    source = np.full(padded[-1], len(terms))
    source[np.arange(len(terms)) + np.repeat(padded[:-1] - borders[:-1], sizes)] = np.arange(len(terms))
    sums = np.vstack([weighted, np.zeros(weighted.shape[1], np.float32)])[np.append(terms, len(weighted))[source]]
    of_step, step = {}, 1
    while step < largest:
        sums, step = sums[0::2] + sums[1::2], 2 * step
        of_step[step] = sums
    checked: dict[tuple[int, int], list[tuple]] = {}
    probed = _windows_to_check(hashes, borders, items, params)
    for scale, (owner, queries, bounds) in items.queries.items():
        step = scale // 4
        sums = of_step[step]
        # Steps that hold a word, by text and number within it.
        per = -(-sizes // step)
        first = np.concatenate([[0], np.cumsum(per)])
        nth = np.arange(first[-1]) - np.repeat(first[:-1], per)
        sums = sums[np.repeat(padded[:-1] // step, per) + nth]
        starts = np.repeat(borders[:-1], per) + nth * step
        ends = np.repeat(borders[1:], per)
        window = sums.copy()
        left = np.repeat(first[1:], per) - np.arange(first[-1])
        for j in range(1, 4):
            more = np.flatnonzero(left > j)
            window[more] += sums[more + j]
        # A window that only repeats the end of the one before adds nothing.
        use = np.flatnonzero((nth == 0) | (left >= 4))
        window = window[use] / np.maximum(1e-9, np.linalg.norm(window[use], axis=1, keepdims=True))
        for lo in range(0, len(use) if params.latent else 0, 8192):
            near = window[lo : lo + 8192] @ queries.T
            at, q = np.nonzero(near >= bounds)
            k, of = use[lo + at], owner[q]
            fits = np.zeros(len(k), bool)
            for a in range(0, len(k), 16384):
                fits[a : a + 16384] = _overlaps(terms, idf, items, starts[k[a : a + 16384]], ends[k[a : a + 16384]], of[a : a + 16384], scale, params)
            for at, q, k in zip(at[fits], q[fits], k[fits]):
                row = int(np.searchsorted(borders, starts[k], side="right")) - 1
                item = int(owner[q])
                margin = _margin(len(items.words[item]))
                a, b = max(int(borders[row]), int(starts[k]) - margin), min(int(ends[k]), int(starts[k]) + scale + margin)
                checked.setdefault((row, item), []).append((float(near[at, q]), False, a, b))
        for row, item, a, b in probed.get(scale, ()):
            margin, begin, end = _margin(len(items.words[item])), int(borders[row]), int(borders[row + 1])
            places = np.searchsorted(use, first[row] + np.arange(a, b + 1))
            near = window[places] @ queries[owner == item].T
            k = use[places]
            candidate = (near >= bounds[owner == item]).any(1)
            candidate &= _overlaps(terms, idf, items, starts[k], ends[k], np.full(len(k), item), scale, params)
            regions = [(cosine, True, max(begin, at - margin), min(end, at + scale + margin)) for at, cosine in zip(starts[k].tolist(), near.max(1).tolist())]
            # A run with a candidate that passes is the latent space's; of the others, what it did not see is added.
            found = (_passes(items.words[item], items.answers[item], hashes[regions[i][2] : regions[i][3]].tolist(), params)[0] for i in np.flatnonzero(candidate))
            if not any(found):
                checked.setdefault((row, item), []).extend(regions[i] for i in np.flatnonzero(~candidate))
    for (row, item), regions in checked.items():
        best = None
        for cosine, by_index, a, b in sorted(set(regions), reverse=True):
            region = hashes[a:b].tolist()
            passes, share, answered = _passes(items.words[item], items.answers[item], region, params)
            if passes:
                # What the latent space has found counts before what the index adds.
                best = max(best or (False, -1.0), (not by_index, share, cosine, answered, a - int(borders[row]), b - int(borders[row])))
        if best:
            latent, share, cosine, answered, a, b = best
            yield row, items.ids[item], a, b, cosine, share, answered, not latent


def contamination(docs: DataFrame, benchmark: DataFrame, params: ContaminationParams = ContaminationParams()) -> DataFrame:
    """Where ``docs`` (doc_id, text) hold items of ``benchmark`` (item_id, text, and answer if there).

    One row per document and item: ``doc_id``, ``item_id``, ``start_word`` and ``end_word`` (the
    region of the best match, words from 0, end exclusive), ``cosine``, ``share`` (of the item's
    words in common order), ``answered``, ``by_index`` (the latent space gave no window that passes, the index
    did). Every item is held against every window of every text, in blocks
    of items, so memory does not grow with the benchmark.

    Defined cases: a null or blank text matches nothing, nor does an item without a word. Null ids
    are returned as they are. Rows that repeat an id are each searched, and those that repeat all
    of a result return it once. Empty tables give an empty result. Other columns are ignored.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    scratch = Scratch(spark, "decontaminate")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    answer = F.col("answer").cast("string") if "answer" in benchmark.columns else F.lit(None).cast("string")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"), answer.alias("answer"))
    # Rows that repeat all of an item give the same finds, so each is taken once; the hash parts what differs.
    items = scratch.keep(items.distinct())
    n_blocks = max(1, -(-items.count() // params.block))
    items = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text", "answer"), F.lit(n_blocks)))
    idf, projection = term_space(scratch.keep(_term_table(docs)), params.rank)
    weighted = (projection * idf[:, None]).astype(np.float32)
    schema = pa.schema(
        [("doc_id", pa.int64()), ("item_id", pa.int64()), ("start_word", pa.int64()), ("end_word", pa.int64()), ("cosine", pa.float64()), ("share", pa.float64()), ("answered", pa.bool_()), ("by_index", pa.bool_())]
    )

    def of_block(rows: list) -> DataFrame:
        sent = spark.sparkContext.broadcast((_items(rows, idf, projection, params), idf, weighted))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block, rarity, vectors = sent.value
            for batch in batches:
                for lo, hi in text_slices(batch.column("text"), 1 << 20):
                    part = batch.slice(lo, hi - lo)
                    hashes, borders = _word_hashes(part.column("text"))
                    ids = part.column("doc_id").to_pylist()
                    found = [(ids[m[0]], *m[1:]) for m in _matches(hashes, borders, block, rarity, vectors, params)]
                    columns = list(zip(*found)) or [[] for _ in schema]
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        return docs.mapInArrow(run, "doc_id long, item_id long, start_word long, end_word long, cosine double, share double, answered boolean, by_index boolean")

    out = of_block(items.where("block = 0").collect())
    for block in range(1, n_blocks):
        out = out.unionByName(of_block(items.where(F.col("block") == block).collect()))
    return out.distinct()

