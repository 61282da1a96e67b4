import random

import pytest

from docquarry.llm import ngram_join as module
from docquarry.llm.ngram_join import ngram_join


def shingles(text, size):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) or (frozenset([tuple(w)]) if w else frozenset())


def brute_force(docs, size, num, den):
    sets = {i: shingles(t, size) for i, t in docs.items()}
    root = {i: i for i in docs}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(docs)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            common = len(sets[a] & sets[b])
            if common and den * common >= num * (len(sets[a]) + len(sets[b]) - common):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {i: (len(sets[i]), find(i)) for i in ids}


def families(rng):
    """Near copies of a few base texts with few to many edits, some long, some around a shared passage."""
    word = lambda: f"w{rng.randrange(3000)}"
    passage = [word() for _ in range(60)]
    docs = {}
    for n_words, copies in ((120, 40), (450, 14), (900, 10), (12, 25), (8, 10)):
        base = [word() for _ in range(n_words)]
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3, 4, 6, n_words // 60, n_words // 40])):
                text[rng.randrange(len(text))] = word()
            docs[len(docs)] = " ".join(text)
    for _ in range(30):
        own = [word() for _ in range(rng.randrange(2, 200))]
        at = rng.randrange(len(own))
        docs[len(docs)] = " ".join(own[:at] + passage + own[at:])
    docs |= {900: None, 901: "", 902: "one", 903: "One", 904: "two words", 905: " \t\n"}
    return docs


@pytest.mark.parametrize("size,num,den,frequent,together,combined", [(3, 90, 100, 4, 5, 400), (5, 8, 10, 16, 64, 100)])
def test_families_against_brute_force(spark, monkeypatch, size, num, den, frequent, together, combined):
    monkeypatch.setattr(module, "FREQUENT", frequent)
    monkeypatch.setattr(module, "TOGETHER", together)
    monkeypatch.setattr(module, "COMBINED", combined)
    docs = families(random.Random(frequent))
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join(frame, size, num, den).collect()}
    want = brute_force(docs, size, num, den)
    assert {i: (got[i], want[i]) for i in want if got[i] != want[i]} == {}


def test_a_similarity_of_a_half_is_refused(spark):
    with pytest.raises(ValueError):
        ngram_join(spark.createDataFrame([], "doc_id long, text string"), 3, 1, 2)


def test_texts_are_hashed_in_small_slices_with_the_same_sets():
    import pyarrow as pa

    from docquarry.llm.ngram_join import HASHED
    from docquarry.llm.words import shingle_sets, text_slices

    texts = pa.array([" ".join(f"w{i}x{j}" for j in range(2000)) for i in range(100)])
    slices = list(text_slices(texts, HASHED))
    assert max(sum(len(t) for t in texts[lo:hi].to_pylist()) for lo, hi in slices) <= 2 * HASHED <= 1 << 20
    assert [s.tolist() for lo, hi in slices for s in shingle_sets(texts[lo:hi], 3)] == [s.tolist() for s in shingle_sets(texts, 3)]
