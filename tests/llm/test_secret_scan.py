import hashlib
import random
import re

from pyspark.sql import functions as F

from docquarry.llm.queries import QUERIES
from docquarry.llm.secret_scan import redact, running_starts, scan_secrets

BASE = [
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 12),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 16),
]


def base_spans(text):
    found = [(m.start(), no, m.end(), kind) for no, (kind, pattern, group, least) in enumerate(BASE) for m in pattern.finditer(text or "") if len(m[group]) >= least]
    return [(kind, start, end) for start, _, end, kind in sorted(found)]


def check(rows, texts):
    for r in rows:
        want = base_spans(texts[r.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), (r.doc_id, joined)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == kind for k, _, _ in want) for kind, *_ in BASE)
        spans = [tuple(s.split(":")) for s in r.spans.split(",")] if r.spans else []
        assert [(k, int(a), int(b)) for k, a, b in spans if k != "random"] == want
        assert [int(a) for _, a, _ in spans] == sorted(int(a) for _, a, _ in spans)


def test_query_against_plain_patterns(spark):
    texts = dict(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect())
    rows = QUERIES["op2_secret_scan"](spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(texts)
    check(rows, texts)


def test_odd_texts(spark, tmp_path):
    rng = random.Random(1)
    parts = ["token=", "SECRET: '", "api_key =", "apiKEY", "abcdefghijkl", "mnop-", "AKIA", "ABCDEFGH1234", "0123456789", "deadbeef", " ", "é", "🙂", "\n", "=", "\"", "İ", "ſ", "K"]
    texts = {i: "".join(rng.choice(parts) for _ in range(rng.randrange(30))) for i in range(400)}
    texts |= {400: None, 401: "", 402: "0123456789abcdef " * 2000, 403: "x" * 100_000, 404: "token=secret: abcdefghijklmnop", 405: "toKen=abcdefghijklmnop"}
    folder = str(tmp_path / "t")
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumn("spans", F.lit("clash")).write.parquet(f"{folder}/documents.parquet")
    check(QUERIES["op2_secret_scan"](spark, folder).collect(), texts)
    assert scan_secrets(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_random_runs_are_told_from_ordered_ones(spark):
    rng = random.Random(2)
    code = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    secret = {i: "".join(rng.choice(code) for _ in range(40)) for i in range(300)}
    ordered = {1000 + i: ("Ab1" * 14)[: 40 + i % 2] for i in range(300)} | {2000 + i: "version2Of" + "Documentation" * 3 for i in range(50)}
    rows = [(i, f"see {s} here") for i, s in (secret | ordered).items()]
    found = {r.doc_id: r.spans for r in scan_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(found[i] == "random:4:44" for i in secret) >= 0.9 * len(secret)
    assert not any(found[i] for i in ordered)


def test_redaction_and_running_sums(spark):
    rows = [(1, "a token=abcdefghijklmnop b 0123456789abcdef0123 c", ), (2, None), (3, "nothing")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = docs.join(scan_secrets(docs).select("doc_id", "found"), "doc_id")
    assert [r[0] for r in found.orderBy("doc_id").select(redact(F.col("text"), F.col("found"), "[S]")).collect()] == ["a [S] b [S] c", None, "nothing"]
    lengths = [random.Random(3).randrange(9) for _ in range(1000)]
    got = spark.createDataFrame([(lengths,)], "x array<long>").select(running_starts(F.col("x"))).first()[0]
    assert got == [sum(lengths[:i]) for i in range(1000)]
