import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from docquarry.llm import token_files
from docquarry.llm.packing import pack, piece_lengths
from docquarry.llm.queries import QUERIES
from docquarry.llm.token_files import canonical_codes, code_lengths, decode_block, decode_table, encode_block

ROWS = [(3, "a b\n c"), (1, None), (2, ""), (2, "word " * 3000), (None, "no id"), (7, "same"), (7, "same"), (-4, "é ß 日本")]


def expected_ids(name, texts, end_id):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    tokenizer.encode_special_tokens = True
    return [[*tokenizer.encode(t or "", add_special_tokens=False).ids, end_id] for t in texts]


def crc(ids):
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "x", 5) for i, t in rows], "doc_id long, text string, ids string, start long").repartition(3)


def check_pieces(pieces, docs, capacity):
    """Every id lies in one piece; sequences are gapless and hold at most ``capacity`` ids. Returns the padding."""
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault((p["doc_id"], p["doc_tokens"]), []).append(p)
        by_sequence.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    assert sum(p["length"] for p in pieces) == sum(len(ids) for _, ids in docs)
    for doc_id, ids in docs:
        mine = {(p["start"], p["length"], p["ids_crc32"]) for p in by_doc[(doc_id, len(ids))]}
        at = 0
        for start, length, digest in sorted(mine):
            assert start == at and digest == crc(ids[start : start + length])
            at += length
        assert at == len(ids)
    padding = 0
    for bins in by_sequence.values():
        at = 0
        for offset, length in sorted(bins):
            assert offset == at
            at += length
        assert at <= capacity
        padding += capacity - at
    return padding


def test_packing_query(spark):
    pieces = [r.asDict() for r in QUERIES["op3_harmonic_packing"](spark, "/root/testdata/sf0.001").collect()]
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    ids = expected_ids("byte_bpe_50k.json", [r.text for r in rows], 0)
    padding = check_pieces(pieces, [(r.doc_id, i) for r, i in zip(rows, ids)], 1024)
    assert padding <= 0.05 * sum(map(len, ids))


def test_packing_of_odd_rows(spark):
    from pyspark.sql import functions as F

    out = pack(documents(spark, ROWS), public_tokenizers.path("byte_bpe_50k.json"), 0, capacity=64).withColumn("ids_crc32", F.crc32("ids"))
    pieces = [r.asDict() for r in out.collect()]
    unique = [r for r in ROWS if r[0] != 7]
    ids = expected_ids("byte_bpe_50k.json", [t for _, t in unique], 0)
    sevens = [p for p in pieces if p["doc_id"] == 7]
    check_pieces(pieces, [(i, x) for (i, _), x in zip(unique, ids)] + [(7, expected_ids("byte_bpe_50k.json", ["same"], 0)[0])] * 2, 64)
    assert len(sevens) % 2 == 0
    assert pack(documents(spark, ROWS).limit(0), public_tokenizers.path("byte_bpe_50k.json"), 0).count() == 0


@pytest.mark.parametrize("capacity", [1, 7, 32, 100, 1024])
def test_piece_lengths_add_up(capacity):
    for n in range(1, 3 * capacity + 2):
        lengths = piece_lengths(n, capacity)
        assert sum(lengths) == n and max(lengths) <= capacity and min(lengths) > 0


def test_codes_are_optimal_prefix_codes():
    rng = np.random.default_rng(3)
    for n, limit in ((1, 4), (2, 4), (9, 4), (300, 9), (300, 20)):
        counts = rng.zipf(1.3, n).clip(max=10**9)
        lengths = code_lengths(counts, limit)
        assert lengths.max() <= limit and np.sum(0.5**lengths) <= 1
        codes = canonical_codes(lengths)
        assert len({format(int(c), f"0{k}b") for c, k in zip(codes, lengths)}) == n
        ids = rng.integers(0, n, 1000)
        payload, checkpoints = encode_block(ids, codes, lengths)
        assert decode_block(payload, checkpoints, len(ids), decode_table(lengths)).tolist() == ids.tolist()
        # The bit string is the codes, one after the other.
        bits = "".join(format(int(codes[i]), f"0{lengths[i]}b") for i in ids)
        assert "".join(format(b, "08b") for b in payload).startswith(bits)
        assert checkpoints.tolist() == [sum(int(lengths[i]) for i in ids[:k]) for k in range(0, 1000, token_files.CHECKPOINT)]
    # Without a limit that bites, the cost is that of Huffman's algorithm.
    import heapq

    counts = rng.integers(1, 1000, 50)
    heap, cost = list(map(int, counts)), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        merged = heapq.heappop(heap) + heapq.heappop(heap)
        cost += merged
        heapq.heappush(heap, merged)
    assert int((counts * code_lengths(counts, 40)).sum()) == cost


def test_token_files_query(spark):
    got = {r.doc_id: r for r in QUERIES["op7_token_files"](spark, "/root/testdata/sf0.001").collect()}
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    at = 0
    for row, ids in zip(rows, expected_ids("word_bpe_49k.json", [r.text for r in rows], 1)):
        r = got.pop(row.doc_id)
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), crc(ids))
        at += len(ids)
    assert not got


def test_token_files_of_odd_rows(spark, tmp_path):
    path = public_tokenizers.path("word_bpe_49k.json")
    token_files.write_token_files(documents(spark, ROWS), path, 1, str(tmp_path / "a"))
    got = sorted(token_files.read_token_files(spark, str(tmp_path / "a")).collect(), key=lambda r: r.start)
    want = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    assert [r.doc_id for r in got] == [i for i, _ in want]
    at = 0
    for r, ids in zip(got, expected_ids("word_bpe_49k.json", [t for _, t in want], 1)):
        assert r.start == at and np.frombuffer(r.ids, "<u4").tolist() == ids
        at += len(ids)
    token_files.write_token_files(documents(spark, ROWS).limit(0), path, 1, str(tmp_path / "b"))
    assert token_files.read_token_files(spark, str(tmp_path / "b")).count() == 0
