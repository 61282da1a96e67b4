import pickle
import random
import tracemalloc

import numpy as np
from pyspark.sql import Row

from docquarry.llm.toxicity import ToxicityParams, _calibrate, _sample, fit


def labelled(spark, n):
    """Texts of which a tenth is toxic; every second toxic text reads like a clean one."""
    rng = random.Random(3)
    rows = []
    for i in range(n):
        toxic = int(i % 10 == 0)
        words = [f"w{rng.randrange(200)}" for _ in range(20)]
        if toxic and i % 20 == 0:
            words[3:6] = ["vile", "awful", "nasty"]
        rows.append((i, " ".join(words), toxic))
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(4)
    return frame.select("doc_id", "text"), frame.select("doc_id", "toxic")


def test_the_size_of_the_sample_moves_no_probability(spark):
    docs, labels = labelled(spark, 2000)
    means = []
    for most in (100, 2000):
        params = ToxicityParams(most_positive=most, most_unlabelled=1000)
        sample, counts = _sample(docs, labels, params)
        assert abs(counts[1] / sum(counts) - 0.1) < 0.02 and sum(counts) > 1200
        model = fit(sample, counts, params)
        free = [model.weights[np.frombuffer(r.features, np.int32)].sum() + model.bias for r in sample if r.free]
        means.append(float(model.scores(np.array(free)).mean()))
    assert np.allclose(means, 0.1, atol=0.03), means


def test_calibration_counts_rows_for_what_they_stand_for():
    rng = np.random.default_rng(5)
    margin = np.concatenate([rng.normal(0, 1, 9000), rng.normal(1, 1, 1000)])
    toxic = np.repeat([0.0, 1.0], [9000, 1000])
    every = _calibrate(margin, toxic, [1.0, 1.0])
    some = np.concatenate([np.arange(0, 9000, 9), np.arange(9000, 10000)])
    assert np.allclose(_calibrate(margin[some], toxic[some], [9.0, 1.0]), every, atol=0.15)


def test_the_fit_holds_no_copies_of_the_sample_and_sends_few_weights():
    rng = np.random.default_rng(7)
    rows = [np.unique(rng.integers(0, 1 << 22, 1500)).astype(np.int32) for _ in range(3000)]
    rows = [np.union1d(r, [5]).astype(np.int32) if i < 400 else r for i, r in enumerate(rows)]
    sample = [Row(doc_id=i, toxic=int(i < 400) if i < 800 else None, free=i >= 800, features=r.tobytes()) for i, r in enumerate(rows)]
    tracemalloc.start()
    model = fit(sample, (900, 100), ToxicityParams())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert model.weights[5] > 0 and peak < 70e6, peak
    sent = pickle.dumps(model)
    again = pickle.loads(sent)
    assert len(sent) < 1e6 and again.bias == model.bias and np.array_equal(again.weights, model.weights)
