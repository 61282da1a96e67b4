import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from docquarry.llm import token_counts
from docquarry.llm.queries import QUERIES
from docquarry.llm.token_counts import Counter, count_tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")


def library(texts):
    tokenizer = Tokenizer.from_file(PATH)
    return [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_query_against_the_library(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in QUERIES["op11_token_counts"](spark, "/root/testdata/sf0.001").collect()}
    texts = [r.text or "" for r in rows]
    assert got == {r.doc_id: (len(t.encode()), n, n > 512) for r, t, n in zip(rows, texts, library(texts))}


def test_pieces_and_merges_against_the_library():
    rng = random.Random(7)
    alphabets = ["ab", "aAbB .,'", "the and ing ", "éß日本̀🙂 ", " \t\n\r  \u0085\x1c", "0123 ½Ⅷ٣", "Ᲊ՘\U0003d000࢏ \U00011de0", "<|endoftext|>"]
    texts = ["".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.randrange(80))) for _ in range(3000)]
    texts += ["a" * 5000, "ab" * 4000, "don't we'll I'M 'S", "<|endoftext|>", "x<|endoftext|><|endoftext|> y", " <|endoftext|", "\x00\x00", "é" * 999]
    texts += [rng.choice(["", " "]) + "<|endoftext|>".join("".join(rng.choices("ab \n", k=4)) for _ in range(3)) for _ in range(200)]
    count = Counter(PATH)
    assert [count(t) for t in texts] == library(texts)


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(token_counts, "REMEMBERED", 3)
    texts = ["one two three four five six one two", "seven one"] * 3
    count = Counter(PATH)
    assert [count(t) for t in texts] == library(texts)
    assert len(count._known) <= 3


def test_odd_rows(spark):
    rows = [(1, None, "x"), (None, "", "x"), (2, "wort " * 30000, "x"), (2, "wort " * 30000, "x"), (2, "é", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = sorted(count_tokens(docs, PATH, 100).collect(), key=lambda r: (r.n_bytes, str(r.doc_id)))
    n = library(["wort " * 30000, "é"])
    assert [tuple(r) for r in got] == [(1, 0, 0, False), (None, 0, 0, False), (2, 2, n[1], False), (2, 150000, n[0], True), (2, 150000, n[0], True)]
    assert count_tokens(docs.limit(0), PATH).collect() == []


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        Counter(public_tokenizers.path("word_bpe_49k.json"))
