import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from docquarry.llm import encode
from docquarry.llm.encode import Encoder

ALPHABET = ["a", "Bc", "é", "ß", "1", "23", ".", "'s", "'", " ", " ", "  ", "\n", "\n\n", "\t", "\r", "\x1c", "\x85", "\xa0", " ", "　", "́", "Σ", "İ", "日本", "🙂", "|", "<|endoftext|>"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_chunks_give_the_ids_of_whole_texts(name):
    path = public_tokenizers.path(name)
    rng = random.Random(5)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(40))) for _ in range(3000)] + ["", None, "x" * 5000]
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    encoder = Encoder(path)
    for part in (texts[:1500], texts[1500:], texts[:10]):
        ids, borders = encoder.encode(pa.array(part, pa.string()))
        for text, a, b in zip(part, borders[:-1], borders[1:]):
            assert ids[a:b].tolist() == plain.encode(text or "", add_special_tokens=False).ids, repr(text)


def test_forgetting_and_colliding_hashes_change_nothing(monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.json")
    rng = random.Random(6)
    texts = [" ".join(rng.choice("abcdefgh") * rng.randrange(1, 9) for _ in range(30)) for _ in range(60)]
    plain = Tokenizer.from_file(path)
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]

    def got(encoder):
        out = []
        for lo in range(0, 60, 7):
            ids, borders = encoder.encode(pa.array(texts[lo : lo + 7]))
            out += [ids[a:b].tolist() for a, b in zip(borders[:-1], borders[1:])]
        return out

    monkeypatch.setattr(encode, "REMEMBERED", 20)
    assert got(Encoder(path)) == want
    monkeypatch.undo()
    # Every known chunk has the key that is asked for, and another check.
    find = encode._Slots.find
    monkeypatch.setattr(encode._Slots, "find", lambda self, keys, checks: (np.full(len(keys), -1, np.int64), np.ones(len(keys), bool)))
    assert got(Encoder(path)) == want
    monkeypatch.setattr(encode._Slots, "find", find)
    slots = encode._Slots()
    u = lambda *x: np.array(x, np.uint64)
    slots.add(u(9, 4), u(1, 2), np.array([0, 1]))
    slots.add(u(7), u(3), np.array([2]))
    assert [x.tolist() for x in slots.find(u(4, 7, 9, 9, 5), u(2, 3, 1, 8, 1))] == [[1, 2, 0, -1, -1], [True, True, True, True, False]]
