"""Keyword matching, cleaning, dedup, extraction."""

import datetime
import io
import zipfile
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.functions.cells import trimmed_parts
from docquarry.functions.text import CLEAN_RULES, clean_text, filter_keyword_matches, match_keywords
from docquarry.operators.dedup import dedup_keep_last, dedup_stats
from docquarry.operators.extract import chosen_format, extract_errors, extract_payloads, todo
from docquarry.plans.mine import MineParams, transform_documents
from queries import Query
from queries.fixtures import fixture, table, with_fixtures

KEYWORDS = ("thing", "Ononst", "that in", "ÉMENT", "copernicus", "c++")

# Unicode white space, and the four separators a strip removes besides it.
_WS = r"\t-\r\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
STRIP_WS = _WS + r"\x{1c}-\x{1f}"
_WORD = r"[\pL\pM\p{Nd}\p{Pc}]"

_MATCHES = r"""
  regexp_matches(text, '(?i)thing') AS match_thing, regexp_matches(text, '(?i)ononst') AS match_ononst,
  regexp_matches(text, '(?i)that in') AS match_that_in, regexp_matches(text, '(?i)ément') AS "match_ément",
  regexp_matches(text, '(?i)copernicus') AS match_copernicus, regexp_matches(text, '(?i)c\+\+') AS "match_c++"
"""


def keyword_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return match_keywords(clean_text(docs), KEYWORDS).drop("text")


def keyword_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return filter_keyword_matches(match_keywords(docs, KEYWORDS[:4]), KEYWORDS[:4])


def _dedup(spark: SparkSession, sf_dir: str, keep_empty_keys: bool) -> DataFrame:
    docs = fixture(spark, sf_dir, "docs").drop("source", "mtypes")
    return dedup_keep_last(docs, "celex", ["ord"], ["date"], keep_empty_keys)


def dedup_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dedup(spark, sf_dir, False)


def dedup_keep_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dedup(spark, sf_dir, True)


def dedup_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_stats(fixture(spark, sf_dir, "docs"), "celex", ["date"])


def mine_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fixture(spark, sf_dir, "docs").select("ord", "url", "celex", "date", "text")
    params = MineParams(
        today=datetime.date(2024, 1, 30),
        days=30,
        keywords=KEYWORDS,
        only_matches=True,
        unique_on="celex",
        order_by=("ord",),
    )
    return transform_documents(docs, params, within=("date",))


def clean_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_text(fixture(spark, sf_dir, "noisy"), tuple(CLEAN_RULES))


def format_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    formats = trimmed_parts(F.col("mtypes"))
    return fixture(spark, sf_dir, "docs").select("url", chosen_format(formats).alias("format"))


def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    payloads = pages.select("page_id", F.lit("html").alias("format"), F.col("html").alias("content"))
    return extract_payloads(payloads).select("page_id", "text").filter("text IS NOT NULL")


def html_hard_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page's id inside Latin-1 markup with comment marks in a script, quoted brackets and a script never closed."""
    before = '<meta charset="iso-8859-1"><script>if(x<!--y){}</script><p>kept \u00e9 '
    after = """</p><!-- <b>c</b> --><a title="a>b" alt='>'> it's</a><i x=o'k>!</i><style>p>q{}</STYLE ><script>never "closed"""
    pages = table(spark, sf_dir, "pages")
    html = F.encode(F.concat(F.lit(before), F.col("page_id").cast("string"), F.lit(after)), "ISO-8859-1")
    payloads = pages.select("page_id", F.lit("html").alias("format"), html.alias("content"))
    return extract_payloads(payloads).select("page_id", "text")


def _as_docx(text: str) -> bytes:
    paragraphs = "".join(f"<w:p><w:r><w:t>{escape(line)}</w:t></w:r></w:p>" for line in text.split("\n"))
    namespace = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as archive:
        archive.writestr("word/document.xml", f'<w:document xmlns:w="{namespace}"><w:body>{paragraphs}</w:body></w:document>')
    return out.getvalue()


def _docx_rows(batches):
    for batch in batches:
        yield batch.assign(content=batch["text"].map(_as_docx)).drop(columns="text")


def docx_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document wrapped as a DOCX payload, then extracted."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    archives = docs.mapInPandas(_docx_rows, "doc_id long, content binary").withColumn("format", F.lit("docx"))
    return extract_payloads(archives).select("doc_id", "text", "error")


def extract_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text is no DOCX archive, PDF has no extractor, and so on: errors by format, others kept."""
    docs = fixture(spark, sf_dir, "docs").withColumn("formats", trimmed_parts(F.col("mtypes")))
    payloads = docs.select(
        "url", "lang", chosen_format(F.col("formats")).alias("format"), F.col("text").alias("content")
    ).filter("format IS NOT NULL")
    results = extract_payloads(payloads)
    failed = extract_errors(results).withColumn("error", F.substring_index("error", ":", 1))
    return failed.select("url", "format", "error")


def incremental_todo(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fixture(spark, sf_dir, "docs").withColumn("formats", trimmed_parts(F.col("mtypes")))
    before = fixture(spark, sf_dir, "docs_before").withColumn("formats", trimmed_parts(F.col("mtypes")))
    done = before.filter(F.col("date") < "2024-01-15").select("url", chosen_format(F.col("formats")).alias("format"), "lang")
    return todo(docs, done).select("url", "format", "lang")


_HTML_SQL = "html"
for _pattern in (
    "(?s)<!--.*?-->",
    r"(?is)<script\b.*?</script\s*>",
    r"(?is)<style\b.*?</style\s*>",
    r"(?is)<template\b.*?</template\s*>",
    "(?s)<[!/?a-zA-Z][^>]*>",
):
    _HTML_SQL = f"regexp_replace({_HTML_SQL}, '{_pattern}', '', 'g')"
for _entity, _char in (("&quot;", '"'), ("&middot;", "·"), ("&copy;", "©"), ("&amp;", "&")):
    _HTML_SQL = f"replace({_HTML_SQL}, '{_entity}', '{_char}')"

_FORMAT_SQL = """CASE WHEN list_contains(string_split(mtypes, '|||'), 'pdf') THEN 'pdf'
  WHEN list_contains(string_split(mtypes, '|||'), 'xhtml') THEN 'xhtml'
  WHEN list_contains(string_split(mtypes, '|||'), 'html') THEN 'html'
  WHEN list_contains(string_split(mtypes, '|||'), 'docx') THEN 'docx' END"""

_CLEAN_SQL = "text"
for _pattern, _to in (
    (rf"[{_WS}]+\.", "."),
    (r"\.([A-Z])", r". \1"),
    (" {2,}", " "),
    (rf"({_WORD})-[{_WS}]+({_WORD})", r"\1\2"),
    ("ﬁ", "fi"),
    ("ﬂ", "fl"),
    (rf"\A[{_WS}]+|[{_WS}]+\z", ""),
):
    _CLEAN_SQL = f"regexp_replace({_CLEAN_SQL}, '{_pattern}', '{_to}', 'g')"

QUERIES = {
    "keyword_match": Query(keyword_match, f"SELECT doc_id, {_MATCHES} FROM documents", "K1 K2 K6 C1"),
    "keyword_filter": Query(
        keyword_filter,
        r"""SELECT * FROM (SELECT doc_id, text, regexp_matches(text, '(?i)thing') AS match_thing,
              regexp_matches(text, '(?i)ononst') AS match_ononst, regexp_matches(text, '(?i)that in') AS match_that_in,
              regexp_matches(text, '(?i)ément') AS "match_ément" FROM documents) t
            WHERE match_thing OR match_ononst OR match_that_in OR "match_ément" """,
        "K3 F6",
    ),
    "dedup_keep_last": Query(
        dedup_last,
        with_fixtures(
            "docs",
            """SELECT ord, url, celex, date, lang, text FROM docs d
               WHERE ord = (SELECT max(ord) FROM docs e WHERE e.date = d.date AND e.celex = d.celex)""",
        ),
        "D1 D4",
    ),
    "dedup_keep_empty_keys": Query(
        dedup_keep_empty,
        with_fixtures(
            "docs",
            """SELECT ord, url, celex, date, lang, text FROM docs d WHERE celex = ''
               OR ord = (SELECT max(ord) FROM docs e WHERE e.date = d.date AND e.celex = d.celex)""",
        ),
        "D4",
    ),
    "dedup_stats": Query(
        dedup_counts,
        with_fixtures(
            "docs",
            """SELECT (SELECT count(*) FROM docs) AS n_before,
                      (SELECT count(*) FROM (SELECT DISTINCT date, celex FROM docs) t) AS n_after""",
        ),
        "D3",
    ),
    "mine_documents": Query(
        mine_documents,
        with_fixtures(
            "docs",
            f"""WITH last AS (SELECT date, celex, max(ord) AS ord FROM docs GROUP BY date, celex),
                matched AS (SELECT ord, url, celex, date, text, {_MATCHES} FROM docs)
                SELECT m.* FROM matched m JOIN last USING (date, celex, ord)
                WHERE match_thing OR match_ononst OR match_that_in OR "match_ément" OR match_copernicus OR "match_c++" """,
        ),
        "C1 K1 K2 D1 F6 order of section 2.8",
    ),
    "clean_rules": Query(clean_rules, with_fixtures("noisy", f"SELECT doc_id, {_CLEAN_SQL} AS text FROM noisy"), "C2-C7"),
    "format_dispatch": Query(format_dispatch, with_fixtures("docs", f"SELECT url, {_FORMAT_SQL} AS format FROM docs"), "T1 F7 R3"),
    "html_text": Query(
        html_text,
        f"""SELECT page_id, text FROM (SELECT page_id, {_HTML_SQL} AS text FROM pages) t
            WHERE regexp_matches(text, '[^{STRIP_WS}]')""",
        "S8 T2 T4 F5",
    ),
    "html_hard_cases": Query(html_hard_cases, "SELECT page_id, 'kept \u00e9 ' || page_id || ' it''s!' AS text FROM pages", "T2"),
    "docx_text": Query(
        docx_text,
        rf"""SELECT doc_id, CASE WHEN text <> '' THEN text END AS text, CASE WHEN text = '' THEN 'blank text' END AS error
             FROM (SELECT doc_id, regexp_replace(replace(text, chr(10), chr(10) || chr(10)),
                     '\A[{STRIP_WS}]+|[{STRIP_WS}]+\z', '', 'g') AS text FROM documents) t""",
        "T3 T4 T5 T9",
    ),
    "extract_failures": Query(
        extract_failures,
        with_fixtures(
            "docs",
            f"""SELECT url, format, CASE format WHEN 'pdf' THEN 'no extractor for pdf' ELSE 'BadZipFile' END AS error
                FROM (SELECT url, {_FORMAT_SQL} AS format FROM docs) t WHERE format IN ('pdf', 'docx')""",
        ),
        "T4 T9",
    ),
    "incremental_todo": Query(
        incremental_todo,
        with_fixtures(
            "docs docs_before",
            f"""SELECT url, {_FORMAT_SQL} AS format, lang FROM docs
                WHERE {_FORMAT_SQL} IS NOT NULL
                  AND (url, lang) NOT IN (SELECT (url, lang) FROM docs_before WHERE date < '2024-01-15')""",
        ),
        "T6",
    ),
}
