import hashlib
import random
import re

import duckdb
from pyspark.sql import functions as F

from docquarry.llm.license_scan import NOTICES, PHRASES as PHRASE_TEMPLATES, TEXTS, Template, license_spans, scan_licenses
from docquarry.llm.queries import QUERIES, SQL
from docquarry.llm.spot_signatures import spot_duplicates

PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
ROWS = [
    (3, "Licensed under CC BY-NC 4.0. All Rights Reserved, all rights\nreserved!"),
    (1, None),
    (2, ""),
    (9, "the cat was the dog is here " * 3000),
    (4, "GNU General Public License general public license É general public"),
    (4, "GNU General Public License general public license É general public"),
    (None, "cc by"),
    (7, "same text the quick brown fox is over"),
    (8, "same text the quick brown fox is over"),
    (6, "🙂 odd lengths ü"),
]


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def check_licenses(rows, docs):
    rows = sorted(rows, key=str)
    for r in rows:
        text = next(t for i, t in docs if i == r.doc_id)
        words = [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text)) if w]
        found = [(i, label) for phrase, label in PHRASES.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
        starts = [i for i, _ in found]
        want = (len(words), len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in found})))
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == want, r
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def texts_of(spark, folder):
    return [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]


def folder_of(spark, path, rows):
    spark.createDataFrame(rows, "doc_id long, text string").withColumn("words", F.lit("clash")).withColumn("range", F.lit(1)).write.parquet(f"{path}/documents.parquet")
    return str(path)


def test_license_query(spark, tmp_path):
    for folder in ("/root/testdata/sf0.001", folder_of(spark, tmp_path / "t", ROWS)):
        docs = texts_of(spark, folder)
        rows = QUERIES["op5_license_scan"](spark, folder).collect()
        assert len(rows) == len(docs)
        check_licenses(rows, docs)
    assert scan_licenses(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_neighbouring_diagonals_are_merged(spark):
    templates = [Template("x", "a b c d e f g h i j")]
    rows = [(1, "z a b c d e f g h i j"), (2, "a b c NEW d e f g h i j"), (3, "a b c d f g h i j"), (4, "a b z z z z z z z z z z i j"), (5, "a c e g i"), (6, "a b c d e f g h i j " * 2)]
    found = license_spans(spark.createDataFrame(rows, "doc_id long, text string"), templates).collect()
    assert sorted((r.doc_id, r.first_word, r.last_word) for r in found) == [(1, 1, 10), (2, 0, 10), (3, 0, 8), (6, 0, 9), (6, 10, 19)]


def test_a_pair_that_the_template_repeats_splits_no_span(spark):
    """One word put in, or one left out, at every place of every notice: the notice is still found, whole."""
    rows, wanted = [], {}
    for t in (n for n in NOTICES if len(n.text.split()) >= 15):
        words = t.text.split()
        for at in range(1, len(words)):
            for changed in ([*words[:at], "x", *words[at:]], [*words[:at], *words[at + 1 :]]):
                wanted[len(rows)] = t.label, len(changed)
                rows.append((len(rows), " ".join(["before", *changed, "after"])))
    found = {}
    for r in license_spans(spark.createDataFrame(rows, "doc_id long, text string"), NOTICES).collect():
        found.setdefault(r.doc_id, []).append((r.label, r.first_word, r.last_word))
    lost = [i for i, (label, n) in wanted.items() if not any(f[0] == label and f[1] <= 3 and f[2] >= n - 2 for f in found.get(i, []))]
    assert len(rows) > 200 and lost == []


def test_short_notices(spark):
    texts = {
        "MIT License": "mit",
        "Apache License, Version 2.0": "apache-2.0",
        "SPDX-License-Identifier: Apache-2.0": "apache-2.0",
        "SPDX-License-Identifier: MIT": "mit",
        "GNU GPL v3": "gpl-3.0",
        "SPDX-License-Identifier: ISC": "",
        "a licence to publish, version 2.0": "",
    }
    rows = scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {list(texts)[r.doc_id]: r.labels for r in rows} == texts


def check_spots(rows, docs):
    order = sorted(((i, t or "") for i, t in docs), key=lambda d: (d[0] is not None, d[0] or 0, d[1]))
    want = {}
    for at, (i, t) in enumerate(order):
        after, half = order[(at + 1) % len(order)][1], len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        want.setdefault((i, t), []).append((len(t), hashlib.sha256(edited.encode()).hexdigest(), after, edited))
    prints = {}
    got = {}
    for r in rows:
        got.setdefault(r.doc_id, []).append(r)
    for (i, t), cases in want.items():
        assert {(n, sha) for n, sha, _, _ in cases} <= {(r.n_chars, r.edited_sha256) for r in got[i]}
        for r in got[i]:
            if (r.n_chars, r.edited_sha256) in {(n, sha) for n, sha, _, _ in cases}:
                assert prints.setdefault(t, r.fingerprint) == r.fingerprint
    for i, t in order:
        for r in got[i]:
            a, b = set(r.fingerprint.split()), set(r.edited_fingerprint.split())
            assert abs(r.near_edited - len(a & b) / len(a | b)) < 1e-12 and 0 <= r.near_next <= 1
    return prints


def test_spot_query(spark, tmp_path):
    for folder in ("/root/testdata/sf0.001", folder_of(spark, tmp_path / "t", ROWS), folder_of(spark, tmp_path / "one", [(5, "the only one")])):
        docs = texts_of(spark, folder)
        rows = QUERIES["op6_spot_signatures"](spark, folder).collect()
        assert len(rows) == len(docs)
        prints = check_spots(rows, docs)
    assert len(prints) == 1


def test_spot_duplicates_against_brute_force(spark):
    text = " ".join(f"the w{i} v{i}" for i in range(40))
    rows = [(1, text), (2, text), (3, text.replace("w7", "other")), (4, text + " the tail end"), (5, "the cat sat"), (6, " ".join(f"the x{i} y{i}" for i in range(40))), (None, text)]
    found = {(r.a, r.b): round(r.likeness, 6) for r in spot_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 0.8).collect()}
    assert found == {(1, 2): 1.0, (1, 3): round(39 / 41, 6), (1, 4): round(40 / 41, 6), (3, 4): round(39 / 42, 6)}


def test_whole_license_texts_with_edits(spark):
    """Every twelfth word replaced, between other words, twice: each text is found at both places, to within an edit of its ends."""
    rows, wanted = [], {}
    for t in TEXTS:
        words = [w if i % 12 != 6 else f"new{i}" for i, w in enumerate(t.text.split())]
        noise = [f"n{i}" for i in range(300)]
        wanted[len(rows)] = t.label, len(words)
        rows.append((len(rows), " ".join([*noise, *words, *noise, *words, *noise])))
    found = license_spans(spark.createDataFrame(rows, "doc_id long, text string"), TEXTS).collect()
    for i, (label, n) in wanted.items():
        spans = sorted((r.first_word, r.last_word) for r in found if r.doc_id == i and r.label == label)
        assert len(spans) == 2, (label, spans)
        for (first, last), at in zip(spans, (300, 600 + n)):
            assert at <= first <= at + 8 and at + n - 9 <= last <= at + n - 1, (label, first, last)


def test_a_short_notice_counts_whole_only(spark):
    texts = {
        "GNU General Public License version 2.0": "gpl",
        "the mozilla license, version 2.0": "",
        "released under the MIT press": "",
        "Released under the MIT license": "mit",
        "apache license (the) version 2.0": "",
    }
    rows = scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {list(texts)[r.doc_id]: r.labels for r in rows} == texts


def test_license_query_against_sql_on_edited_notices(spark, tmp_path):
    """Notices with words put in, left out and replaced, two to a text, so that every branch of the rule is taken."""
    rng = random.Random(17)
    rows = []
    for i in range(150):
        words = []
        for t in rng.sample(NOTICES + PHRASE_TEMPLATES, 2):
            share = rng.choice((0.0, 0.03, 0.08, 0.15))
            for w in t.text.split():
                edit = rng.random() / share if share else 1
                words += [] if edit < 0.33 else [w, "extra"] if edit < 0.66 else ["other"] if edit < 1 else [w]
            words += rng.choices(["the", "of", "license", "software", "x"], k=rng.randrange(6))
        rows.append((i, " ".join(words)))
    folder = folder_of(spark, tmp_path / "t", rows)
    got = QUERIES["op5_license_scan"](spark, folder)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet/*.parquet')")
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({SQL['op5_license_scan']})").fetchall()
    rounded = lambda rows: sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in rows), key=lambda r: r[0])
    assert [r for r, w in zip(rounded(map(tuple, got.sort("doc_id").collect())), rounded(want)) if str(r) != str(w)] == [] and len(want) == 150
    assert got.where("labels = ''").count() < 75 < got.where("score < 1 OR labels LIKE '%,%'").count()
