"""Texts of the pipeline's scans are hashed in slices of ``HASHED`` bytes, so that a worker's memory stays with them."""

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from docquarry.llm import packing, toxicity, words


def _short_slices(column, most=words.SLICE_BYTES):
    assert most <= 1 << 19, f"a slice of {most} bytes"
    return words.text_slices(column, most)


@pytest.mark.parametrize("module", [toxicity, packing])
def test_texts_are_hashed_in_short_slices(spark, monkeypatch, module):
    monkeypatch.setattr(module, "text_slices", _short_slices)
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.concat(F.lit("plain words of "), F.col("id"), F.when(F.col("id") % 2 == 0, " vile")).alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2 == 0).cast("int").alias("toxic"))
    if module is toxicity:
        assert toxicity.toxicity(docs, labels).count() == 40
    else:
        assert packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0).select("doc_id").distinct().count() == 40


def test_powers_follow_the_longest_slice(monkeypatch):
    monkeypatch.setattr(words, "_powers", {})
    raw = np.frombuffer(b"some words", np.uint8)
    short = words.span_hashes(raw, np.array([0, 5]), np.array([4, 10]))
    assert {len(p) for p in words._powers.values()} == {(1 << 19) + 1}
    long = words.span_hashes(np.resize(raw, 3 << 19), np.array([0, 5]), np.array([4, 10]))
    assert (long == short).all() and max(len(p) for p in words._powers.values()) == (3 << 19) + 1
