import random

import pytest

from docquarry.llm import ngram_join as module
from docquarry.llm.ngram_join import ngram_join
from tests.llm.test_ngram_join import families, shingles


def links(docs, size, num, den):
    """Links of each document's set to other sets, by brute force."""
    sets = {s for i, t in docs.items() if (s := shingles(t, size))}
    degree = {s: 0 for s in sets}
    ordered = list(sets)
    for x, a in enumerate(ordered):
        for b in ordered[x + 1 :]:
            common = len(a & b)
            if den * common >= num * (len(a) + len(b) - common):
                degree[a] += 1
                degree[b] += 1
    return {i: degree.get(shingles(t, size), 0) for i, t in docs.items()}


@pytest.mark.parametrize("size,num,den,frequent,block", [(3, 90, 100, 4, 7), (5, 8, 10, 16, 512)])
def test_links_of_families_against_brute_force(spark, monkeypatch, size, num, den, frequent, block):
    monkeypatch.setattr(module, "FREQUENT", frequent)
    if hasattr(module, "BLOCK_SETS"):
        monkeypatch.setattr(module, "BLOCK_SETS", block)
    docs = families(random.Random(frequent))
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.n_links for r in ngram_join(frame, size, num, den).collect()}
    want = links(docs, size, num, den)
    assert max(want.values()) > 10
    wrong = {i: (got[i], want[i]) for i in want if got[i] != want[i]}
    assert not wrong, f"{len(wrong)} of {len(want)}, links {sum(got.values())} of {sum(want.values())}"
