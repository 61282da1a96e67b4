import random

import pytest

from docquarry.llm.decontaminate import ContaminationParams, contamination


def subsequence(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = list(row)
        for j, y in enumerate(b):
            row[j + 1] = before[j] + 1 if x == y else max(before[j + 1], row[j])
    return row[-1]


def edited():
    """(items, answers, docs): items of lengths at, under and over the scales, and texts that hold them with up to half of the words replaced."""
    rng = random.Random(11)
    common = [f"c{i}" for i in range(40)]
    word = lambda: rng.choice(common) if rng.random() < 0.5 else f"w{rng.randrange(3000)}"
    items = {i: [word() for _ in range(n)] for i, n in enumerate((9, 15, 16, 22, 23, 30, 38, 45, 45, 59, 90, 130, 210))}
    answer = {i: [w for w in words if w[0] == "w"][:2] for i, words in items.items()}
    docs = {}
    for share in (0.0, 0.2, 0.25, 0.3, 0.4, 0.45, 0.5):
        for i, words in items.items():
            for kind in range(2):
                own = [w if rng.random() >= share or (kind and w in answer[i]) else word() for w in words]
                before, after = ([word() for _ in range(rng.randrange(0, 70))] for _ in range(2))
                docs[len(docs)] = before + own + after
    return items, answer, docs


def frames(spark):
    items, answer, docs = edited()
    rows = [(i, " ".join(w), " ".join(answer[i])) for i, w in items.items()]
    frame = spark.createDataFrame(rows, "item_id long, text string, answer string")
    texts = spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "doc_id long, text string").repartition(4)
    return texts, frame


@pytest.mark.parametrize("answers", [True, False])
def test_edited_items_against_every_window(spark, answers):
    """Items of which up to half of the words are replaced, of lengths at, under and over the scales."""
    items, answer, docs = edited()
    texts, frame = frames(spark)
    got = contamination(texts, frame if answers else frame.drop("answer")).collect()
    for r in got:
        item, region = items[r.item_id], docs[r.doc_id][r.start_word : r.end_word]
        assert abs(subsequence(item, region) / len(item) - r.share) < 1e-9 and (r.share >= 0.75 or (r.share >= 0.5 and r.answered))
    want = set()
    for d, text in docs.items():
        i = d // 2 % len(items)
        item, n = items[i], len(items[i])
        for at in range(0, max(1, len(text) - n + 1)):
            window = text[at : at + n]
            share = subsequence(item, window) / n if len(set(item) & set(window)) * 4 >= len(set(item)) else 0
            if share >= 0.75 or (answers and share >= 0.5 and set(answer[i]) <= set(window)):
                want.add((d, i))
                break
    missed = want - {(r.doc_id, r.item_id) for r in got}
    assert len(want) > 70 and not missed, f"{len(missed)} of {len(want)}"


def test_the_latent_space_finds_and_the_index_adds(spark):
    """Nine of ten finds, at least, are those of the latent space and are lost without it; the index adds the rest."""
    texts, frame = frames(spark)
    every = contamination(texts, frame).collect()
    latent = {(r.doc_id, r.item_id) for r in every if not r.by_index}
    rest = {(r.doc_id, r.item_id) for r in every if r.by_index}
    assert len(latent) >= 0.9 * len(every), f"{len(latent)} of {len(every)}"
    alone = {(r.doc_id, r.item_id) for r in contamination(texts, frame, ContaminationParams(latent=False)).collect()}
    assert rest <= alone and len(alone) <= 0.1 * len(every), f"{len(rest)}, {len(alone)} of {len(every)}"


def test_many_blocks_and_repeated_items(spark):
    """Blocks of two items, and items that stand many times, give what one block of single ones gives."""
    texts, frame = frames(spark)
    one = {(r.doc_id, r.item_id, r.share) for r in contamination(texts, frame).collect()}
    many = frame.unionByName(frame).unionByName(frame)
    assert {(r.doc_id, r.item_id, r.share) for r in contamination(texts, many, ContaminationParams(block=2)).collect()} == one
