import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from docquarry.llm.queries import QUERIES
from tests.llm.test_secret_scan import base_spans
from tests.llm.test_tokens import check_pieces, crc, expected_ids

SF = "/root/testdata/sf0.001"


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def survivors(docs):
    """One of each component of 5-word sets of similarity 0.8 or more, by brute force."""
    sets = {i: shingles(t) for i, t in docs.items()}
    root = {i: i for i in docs}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(docs)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            if sets[a] and sets[b] and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {i for i in ids if find(i) == i}


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts, before = dict(docs.select("doc_id", "text").collect()), docs
    toxic = {r.doc_id for r in QUERIES["op9_toxicity"](spark, SF).where("predicted = 1").collect()}
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, before, SF).write.parquet(path := str(tmp_path / str(k)))
        after = spark.read.parquet(path)
        if name != "packing":
            assert sorted(after.columns) == sorted(docs.columns)
            got = dict(after.select("doc_id", "text").collect())
        if name == "toxicity":
            assert set(got) == set(texts) - toxic
        elif name == "near_copies":
            assert set(got) == survivors(texts)
        elif name == "benchmark":
            assert set(got) == {i for i, t in texts.items() if not any(x in t for x in items)}
        elif name == "secrets":
            assert set(got) == set(texts)
            for i, t in got.items():
                for _, a, b in base_spans(texts[i]):
                    assert texts[i][a:b] not in t
                assert (t == texts[i]) or corpus_pipeline.MARK in t
        else:
            pieces = [r.asDict() for r in after.withColumn("ids_crc32", F.crc32("ids")).collect()]
            ids = expected_ids("byte_bpe_50k.json", list(texts.values()), 0)
            check_pieces(pieces, list(zip(texts, ids)), 1024)
        texts, before = got, after


@pytest.mark.parametrize("name", ["op8_hidden_markov", "op9_toxicity", "op4_language_id", "op10_decontamination", "op1_ngram_join"])
def test_odd_tables(spark, tmp_path, name):
    rows = [(1, "a b c", "en", "s", 3), (2, None, None, None, None), (2, "", "en", "s", 0), (None, "du bist", "de", "s", 7), (5, "wort " * 4000, "de", "s", 1), (5, "wort " * 4000, "de", "s", 1), (6, "\U0001f642 ...", "en", "s", 5)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for k, some in enumerate((rows, [])):
        folder = str(tmp_path / str(k))
        spark.createDataFrame(some, schema).withColumn("n", F.lit(1)).withColumn("row", F.lit("x")).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(1, 1), (None, 1), (9, None)] if some else [], "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
        spark.createDataFrame([(1, "du bist"), (2, None), (3, "")] if some else [], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
        got = QUERIES[name](spark, folder).collect()
        if name == "op10_decontamination":
            assert [(r.doc_id, r.item_id) for r in got] == ([(None, 1)] if some else [])
        else:
            assert len(got) == len(some)
            assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in some)


def test_held_out_quality(spark):
    folder = "/root/testdata/sf0.01"
    truth = {r.doc_id: r for r in spark.read.parquet(f"{folder}/documents.parquet").join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id", "left").collect()}
    languages = [r for r in QUERIES["op4_language_id"](spark, folder).collect() if r.held_out]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in languages)
    assert np.mean([r.lang_pred == truth[r.doc_id].lang for r in languages]) > 0.98
    scores = QUERIES["op8_hidden_markov"](spark, folder).collect()
    held = [r for r in scores if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    toxic = [r for r in QUERIES["op9_toxicity"](spark, folder).collect() if r.held_out and truth[r.doc_id].toxic is not None]
    assert np.mean([r.predicted == truth[r.doc_id].toxic for r in toxic]) > 0.85


def test_forward_recursion_and_counts_against_sums_over_all_paths():
    import itertools

    import pyarrow as pa

    from docquarry.llm.hidden_markov import expected_counts, log10_likelihood

    rng = np.random.default_rng(0)
    start, move, emit = rng.dirichlet(np.ones(3)), rng.dirichlet(np.ones(3), 3), rng.dirichlet(np.ones(5), 3)
    texts = [[0, 3, 2, 4], [1], [2, 2, 0, 1, 3]]
    blobs = pa.array([np.array(t, "<u2").tobytes() for t in texts], pa.binary())
    total, moves, emissions, firsts = [], np.zeros((3, 3)), np.zeros((3, 5)), np.zeros(3)
    for t in texts:
        paths = {p: start[p[0]] * emit[p[0], t[0]] * np.prod([move[a, b] * emit[b, x] for a, b, x in zip(p, p[1:], t[1:])]) for p in itertools.product(range(3), repeat=len(t))}
        total.append(sum(paths.values()))
        for p, weight in paths.items():
            firsts[p[0]] += weight / total[-1]
            for a, b in zip(p, p[1:]):
                moves[a, b] += weight / total[-1]
            for a, x in zip(p, t):
                emissions[a, x] += weight / total[-1]
    assert np.allclose(log10_likelihood(blobs, (start, start, move, emit)), np.log10(total))
    got = expected_counts(blobs, (start, start, move, emit), 64)
    assert np.allclose(got[0], firsts) and np.allclose(got[2], moves) and np.allclose(got[3], emissions)
    assert crc([1]) == zlib.crc32(b"\x01\x00\x00\x00")
