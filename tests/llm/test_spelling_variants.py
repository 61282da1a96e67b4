import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from docquarry.llm.common import Scratch
from docquarry.llm.spelling_variants import Shards, VariantParams, _Words, build_filters, held, near_words, spelling_variants


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_force(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += len(run) >= 7
    counts = {w: n for w, n in counts.items() if n >= 2}
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= 10 * counts[w] else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(out)


def corpus(seed):
    rng = random.Random(seed)
    stems = ["aaaaaaa", "abababab", "straßenbahn", "Übergröße", "naïveté", "ÀÀÀÀÀÀÀ", "zusammen", "zÿzÿzÿzÿ", "x" * 70, "wörterbuch"]

    def varied(w):
        for _ in range(rng.choice([0, 0, 0, 1, 2])):
            i = rng.randrange(len(w))
            w = rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice("abzßÿé") + w[i + 1 :], w[:i] + rng.choice("abß") + w[i:]])
        return w

    docs = []
    for k in range(60):
        words = [rng.choice(stems[:4])] * rng.randrange(60) + [varied(rng.choice(stems)) for _ in range(60)]
        docs.append((rng.choice([None, k, k, 7]), rng.choice([" ", ", ", "1", "—"]).join(words)))
    chain = " ".join(["kettenglied"] * 50 + ["kettenglieb"] * 4)
    docs += [(k, chain) for k in range(60)] + [(100, "kettenglueb, kettenglueb kettenglueb")]
    return docs + [(1, None), (2, ""), (3, "short"), (4, "wört" * 4000), (4, "wört" * 4000), (5, "𝒳abcdefgh abcdefgh\U0001f642")]


def test_variants_against_brute_force(spark):
    rows = corpus(3)
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, word string, n int").repartition(4)
    got = sorted(tuple(r) for r in spelling_variants(docs).collect())
    want = brute_force(rows)
    assert sum(r[1] is not None for r in want) > 20 and any(r[1] and r[1] != r[2] for r in want)  # and a chain of forms
    assert got == want


def test_passes_change_nothing(spark):
    words = sorted({w for _, t in corpus(5) for w in re.findall("[a-zÀ-ÿ]{7,}", t or "") if len(w) < 100})
    table = spark.createDataFrame([(w, i + 1) for i, w in enumerate(words)], "word string, n long").repartition(3)
    pairs = {(a, b) for a in words for b in words if one_edit(a, b)}
    for params in (VariantParams(), VariantParams(filter_bytes=100), VariantParams(bits_per_word=1)):
        got = [(r.word, r.other) for r in near_words(table, Scratch(spark, "near"), params).collect()]
        assert len(got) == len(set(got)) and set(got) == pairs
    with pytest.raises(ValueError):
        spelling_variants(table, VariantParams(times=1))


def test_filters_hold_their_words_and_little_else(spark):
    rng = random.Random(1)
    make = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(7, 90)))
    inside, outside = [make() for _ in range(6000)], [make() for _ in range(6000)]
    counts = Counter(min(len(w), 64) for w in inside)
    shards = Shards.of(counts, 20)
    filters = build_filters(spark.createDataFrame([(w,) for w in inside], "word string"), shards, 1, 0)
    assert filters.nbytes <= 20 * 6000 / 8 + 32 * 64
    for words, share in ((inside, 1.0), (outside, 0.0)):
        some = _Words(words)
        assert abs(len(held(filters, shards, some.keys(), some.length)) / 6000 - share) < 0.01


def test_edits_are_hashed_as_if_they_were_spelt():
    some = _Words(["aabbccd", "zßzßzßz", "x" * 200])
    keys, at = some.deletions()
    assert np.array_equal(keys, _Words([some.spelt(i, "") for i in at]).keys()) and len(at) == 4 + 7 + 1
    for keys, at, letter in some.replacements():
        assert np.array_equal(keys, _Words([some.spelt(i, chr(letter)) for i in at]).keys())


def test_empty_table(spark):
    assert spelling_variants(spark.createDataFrame([], "doc_id long, text string")).collect() == []
