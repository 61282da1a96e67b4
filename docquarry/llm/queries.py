"""The registered queries of this package: each applies one operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.llm.bit_planes import cluster_planes
from docquarry.llm.common import documents
from docquarry.llm.decontaminate import contamination
from docquarry.llm.hidden_markov import markov_scores
from docquarry.llm.language_id import identify_language
from docquarry.llm.license_scan import NOTICES, PHRASES, scan_licenses
from docquarry.llm.ngram_join import ngram_join
from docquarry.llm.packing import pack
from docquarry.llm.secret_scan import KINDS, scan_secrets
from docquarry.llm.spelling_variants import spelling_variants
from docquarry.llm.spot_signatures import fingerprint, likeness, spot_fingerprints
from docquarry.llm.token_files import read_token_files, write_token_files
from docquarry.llm.token_counts import count_tokens
from docquarry.llm.toxicity import toxicity
from docquarry.settings import shared_dir


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(documents(spark, sf_dir, "doc_id", "text"), size=3, num=90, den=100)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(documents(spark, sf_dir, "doc_id", "text"))
    counts = [_of_kind(no).alias(f"n_{kind}") for no, kind in enumerate(KINDS[:3])]
    return found.select("doc_id", *counts, F.sha2("base_spans", 256).alias("base_sha256"), "spans")


def _of_kind(no: int) -> Column:
    return F.size(F.filter("base", lambda s: s["no"] == no)).cast("long")


def op3_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    pieces = pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0, capacity=1024)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_language(documents(spark, sf_dir, "doc_id", "text", "lang"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(documents(spark, sf_dir, "doc_id", "text"))


def op6_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spot_fingerprints(documents(spark, sf_dir, "doc_id", "text"))
    return rows.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited_text", 256).alias("edited_sha256"),
        fingerprint(F.col("spots")).alias("fingerprint"),
        fingerprint(F.col("edited_spots")).alias("edited_fingerprint"),
        likeness(F.col("spots"), F.col("edited_spots")).alias("near_edited"),
        likeness(F.col("spots"), F.col("next_spots")).alias("near_next"),
    )


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark, "token-files")
    write_token_files(documents(spark, sf_dir, "doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"), end_id=1, folder=folder)
    return read_token_files(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op8_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markov_scores(documents(spark, sf_dir, "doc_id", "text"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(documents(spark, sf_dir, "doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(documents(spark, sf_dir, "doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(documents(spark, sf_dir, "doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"), limit=512)


def op12_bit_plane_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_planes(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), k=8, rounds=10, scale=1024, salt="3")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(documents(spark, sf_dir, "doc_id", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_join": op1_ngram_join,
    "op2_secret_scan": op2_secret_scan,
    "op3_harmonic_packing": op3_harmonic_packing,
    "op4_language_id": op4_language_id,
    "op5_license_scan": op5_license_scan,
    "op6_spot_signatures": op6_spot_signatures,
    "op7_token_files": op7_token_files,
    "op8_hidden_markov": op8_hidden_markov,
    "op9_toxicity": op9_toxicity,
    "op10_decontamination": op10_decontamination,
    "op11_token_counts": op11_token_counts,
    "op12_bit_plane_clusters": op12_bit_plane_clusters,
    "op13_spelling_variants": op13_spelling_variants,
}

_WORDS = r"""
words AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
    FROM documents
)"""

_TEMPLATES = ", ".join(f"({i}, '{t.label}', {t.exact}, string_split('{t.text}', ' '))" for i, t in enumerate(PHRASES + NOTICES))

_ROUNDS = 10


def _cluster_round(r: int) -> str:
    """Vectors with their nearest centroid of round ``r``, and the centroids of the next."""
    return f"""
a{r} AS MATERIALIZED (
    SELECT vec_id, v, j, distance FROM (
        SELECT vec_id, k.v, c.j, CAST(list_sum(list_transform(list_zip(k.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS bigint) AS distance,
            row_number() OVER (PARTITION BY vec_id ORDER BY list_sum(list_transform(list_zip(k.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), c.j) AS place
        FROM kept k CROSS JOIN c{r} c) t
    WHERE place = 1
),
s{r} AS (SELECT j, i, sum(v[i]) AS s, count(*) AS n FROM a{r}, unnest(range(1, 65)) u(i) GROUP BY j, i),
m{r} AS (SELECT j, list(CAST((s - (s % n + n) % n) // n AS bigint) ORDER BY i) AS v FROM s{r} GROUP BY j),
c{r + 1} AS MATERIALIZED (SELECT c.j, coalesce(m.v, c.v) AS v FROM c{r} c LEFT JOIN m{r} m USING (j))"""


SQL: dict[str, str] = {
    "op12_bit_plane_clusters": f"""
WITH kept AS MATERIALIZED (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS double)) AS bigint)) AS v
    FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS j, v FROM kept ORDER BY sha256('3:' || vec_id) LIMIT 8),
{",".join(_cluster_round(r) for r in range(_ROUNDS + 1))}
SELECT vec_id, CAST(j AS int) AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY j) AS bigint) AS cluster_inertia, CAST(sum(distance) OVER () AS bigint) AS inertia,
    sha256(array_to_string(list_transform(c.v, lambda x: CAST(x AS varchar)), ',')) AS centroid_sha256
FROM a{_ROUNDS} JOIN c{_ROUNDS} c USING (j)""",
    "op13_spelling_variants": r"""
WITH RECURSIVE crc_table AS (
    SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY i) AS t
    FROM range(256) r(i)
),
runs AS (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
    FROM documents
),
bytes AS (
    SELECT run, flatten(list_transform(string_split(doc_id || ':' || run, ''),
        lambda ch: CASE WHEN unicode(ch) < 128 THEN [CAST(unicode(ch) AS bigint)] ELSE [CAST(192 + unicode(ch) // 64 AS bigint), CAST(128 + unicode(ch) % 64 AS bigint)] END)) AS b
    FROM runs WHERE length(run) >= 7
),
hashed AS (
    SELECT run, xor(list_reduce(list_prepend(CAST(4294967295 AS bigint), b), lambda c, x: xor(c // 256, t[(xor(c, x) % 256) + 1])), CAST(4294967295 AS bigint)) AS h
    FROM bytes, crc_table
),
words AS MATERIALIZED (
    SELECT word, count(*) AS n
    FROM (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed) t
    WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2
),
lacking AS MATERIALIZED (SELECT word, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b FROM words, unnest(range(1, length(word) + 1)) u(i)),
near AS (
    SELECT x.word, y.word AS other FROM lacking x JOIN lacking y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
    UNION SELECT x.word, w.word FROM lacking x JOIN words w ON w.word = x.a || x.b
    UNION SELECT w.word, x.word FROM lacking x JOIN words w ON w.word = x.a || x.b
),
ranked AS (
    SELECT near.word, other, w.n AS other_n, count(*) OVER (PARTITION BY near.word) AS n_near,
        row_number() OVER (PARTITION BY near.word ORDER BY w.n DESC, other) AS place
    FROM near JOIN words w ON w.word = near.other
),
known AS MATERIALIZED (
    SELECT w.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 10 * n THEN other END AS form, CASE WHEN other_n >= 10 * n THEN other_n END AS form_n
    FROM words w LEFT JOIN ranked r ON r.word = w.word AND place = 1
),
follow AS (SELECT word, word AS here FROM words UNION ALL SELECT f.word, k.form FROM follow f JOIN known k ON k.word = f.here WHERE k.form IS NOT NULL)
SELECT k.word, k.form, f.here AS root, k.n, k.n_near, k.form_n
FROM known k JOIN follow f USING (word) JOIN known l ON l.word = f.here WHERE l.form IS NULL""",
    "op5_license_scan": rf"""
WITH texts AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
    FROM documents
),
templates(template, label, exact, w) AS (VALUES {_TEMPLATES}),
sized AS (SELECT *, CASE WHEN exact OR len(w) < 3 THEN 2 ELSE 3 END AS k FROM templates),
known AS (SELECT template, label, exact, len(w) - k + 1 AS n_grams, i AS place, array_to_string(w[i + 1:i + k], ' ') AS gram FROM sized, unnest(range(0, len(w) - k + 1)) u(i)),
every AS (SELECT doc_id, i AS pos, array_to_string(w[i + 1:i + k], ' ') AS gram FROM texts, (VALUES (2), (3)) sizes(k), unnest(range(0, len(w) - k + 1)) u(i)),
votes AS (SELECT DISTINCT doc_id, template, label, exact, n_grams, pos - place AS diagonal, pos, place FROM every JOIN known USING (gram)),
lines AS (
    SELECT doc_id, template, label, exact, n_grams, diagonal, min(pos) AS f, max(pos) AS l, list(DISTINCT place) AS places
    FROM votes GROUP BY ALL
),
placed AS (
    SELECT *, lag(diagonal) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS beside FROM lines WHERE NOT exact
),
numbered AS (
    SELECT *, sum(CASE WHEN beside IS NULL OR diagonal - beside > 3 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS span
    FROM placed
),
merged AS (
    SELECT doc_id, template, label, n_grams, span, min(f) AS f, max(l) AS l, CAST(len(list_distinct(flatten(list(places)))) AS double) / n_grams AS covered
    FROM numbered GROUP BY doc_id, template, label, n_grams, span
),
finds AS (
    SELECT doc_id, label, true AS exact, f, 1.0 AS covered FROM lines WHERE exact AND len(places) = n_grams
    UNION ALL SELECT doc_id, label, false, f, covered FROM merged WHERE covered >= CASE WHEN n_grams < 8 THEN 1.0 ELSE 0.6 END AND l - f < 2 * n_grams
),
found AS (
    SELECT doc_id, count(*) FILTER (exact) AS n_base, min(f) FILTER (exact) AS first_word, max(f) FILTER (exact) AS last_word,
        string_agg(DISTINCT label, ',' ORDER BY label) FILTER (exact) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(covered) AS score
    FROM finds GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
    coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS double) AS score
FROM texts LEFT JOIN found USING (doc_id)""",
    "op1_ngram_join": rf"""
WITH RECURSIVE {_WORDS},
sets AS (
    SELECT doc_id, CASE
        WHEN len(w) >= 3 THEN list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s
    FROM words
),
classes AS (SELECT doc_id, len(s) AS n, min(doc_id) OVER (PARTITION BY list_sort(s)) AS class_id FROM sets),
tokens AS (SELECT doc_id, len(s) AS n, unnest(s) AS token FROM sets WHERE doc_id IN (SELECT class_id FROM classes)),
pairs AS (
    SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS an, any_value(b.n) AS bn, count(*) AS c
    FROM tokens a JOIN tokens b ON a.token = b.token AND a.doc_id < b.doc_id AND 100 * a.n >= 90 * b.n AND 100 * b.n >= 90 * a.n
    GROUP BY a.doc_id, b.doc_id
),
links AS (SELECT a, b FROM pairs WHERE 100 * c >= 90 * (an + bn - c)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT a, b FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a),
roots AS (SELECT a, least(a, min(b)) AS root FROM reach GROUP BY a),
degree AS (SELECT a, count(*) AS n_links FROM both_ways GROUP BY a)
SELECT c.doc_id, c.n AS n_shingles,
    CASE WHEN n = 0 THEN c.doc_id ELSE class_id END AS class_id,
    CASE WHEN n = 0 THEN 0 ELSE coalesce(n_links, 0) END AS n_links,
    CASE WHEN n = 0 THEN c.doc_id ELSE coalesce(root, class_id) END AS component_id
FROM classes c LEFT JOIN roots r ON r.a = c.class_id LEFT JOIN degree d ON d.a = c.class_id""",
}
