"""Inputs derived from the given tables, in one SQL text that Spark and DuckDB both run.

Every fixture keeps all rows of the tables it is made from; gaps, empty cells and the like are
made by mapping values, not by leaving rows out.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.settings import shared_dir
from docquarry.sources.buckets import read_payloads, write_payloads
from docquarry.sources.quads import read_quads, write_quads, write_quads_by_subject

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# A day 4 or 11 becomes the next day, so that those days are gaps.
_DOC_DAY = "CASE doc_id % 30 WHEN 4 THEN 5 WHEN 11 THEN 12 ELSE doc_id % 30 END"
_ORDER_DAY = (
    "CAST(CAST(o_orderdate AS date) + CASE WHEN extract(day FROM o_orderdate) IN (4, 11) THEN 1 ELSE 0 END AS string)"
)

_DOCS = """
SELECT doc_id AS ord, 'doc:' || CAST(doc_id AS string) AS url,
       CASE WHEN doc_id % 7 = 0 THEN '' ELSE 'C' || CAST(doc_id % 50 AS string) END AS celex,
       {day} AS date, lang, source, {text} AS text,
       CASE doc_id % 5 WHEN 0 THEN 'pdf|||html' WHEN 1 THEN 'xhtml' WHEN 2 THEN 'docx'
                       WHEN 3 THEN 'pdfa1a|||html' ELSE 'fmx4' END AS mtypes
FROM {{documents}}
"""

_BINDINGS = """
SELECT 'work:' || CAST(p_partkey AS string) AS cellarURIs,
       CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE 'C' || CAST(p_partkey AS string) || '|||D' END AS celexIds,
       {title} AS title,
       CAST(DATE '2024-01-01' + CAST(p_partkey % 30 AS int) AS string) AS date,
       'ENG' AS langIdentifier,
       CASE WHEN p_partkey % 11 = 0 THEN '' WHEN p_partkey % 13 = 0 THEN ' ||| '
            ELSE p_type || chr(160) || '||| ' || lower(p_name) || ' ||||||' || p_brand || '|||' || p_type END AS subjects,
       CASE WHEN p_size % 4 = 0 THEN NULL ELSE p_brand || '||| ' END AS authors,
       CASE WHEN p_size % 5 = 0 THEN '' ELSE ' pdf |||html' END AS mtypes,
       CASE WHEN p_size % 3 = 0 THEN NULL ELSE ' reg. |||' || chr(160) || 'dir. ' END AS workTypes,
       CASE WHEN p_size % 7 = 0 THEN NULL ELSE 'eli/' || CAST(p_partkey AS string) || '|||eli/x' END AS eliIds
FROM {{part}}
"""
_TITLE = "p_name || '|||second title'"
_DATED = "CAST(DATE '2024-01-01' + CAST(p_partkey % 30 AS int) AS string)"
_ODD_DATES = _BINDINGS.replace(_DATED, f"CASE p_partkey % 40 WHEN 7 THEN '2024-02-15' WHEN 8 THEN '2024-13-45' WHEN 9 THEN '20 January' ELSE {_DATED} END")

FIXTURES = {
    "docs": _DOCS.format(day=f"CAST(DATE '2024-01-01' + CAST({_DOC_DAY} AS int) AS string)", text="text"),
    # An earlier state of docs: day 20 was filed under an earlier date, texts of day 7 differed.
    "docs_before": _DOCS.format(
        day="CAST(CASE WHEN doc_id % 30 = 20 THEN DATE '2023-12-31' ELSE DATE '2024-01-01' "
        f"+ CAST({_DOC_DAY} AS int) END AS string)",
        text="CASE WHEN doc_id % 30 = 7 THEN text || ' (draft)' ELSE text END",
    ),
    "noisy": """
SELECT doc_id,
       chr(9) || replace(replace(replace(replace(replace(text, ',', chr(160) || ' .'), '. ', '.'),
         'in ', 'in   '), 'ti', 'tﬁ'), 'on', 'o-' || chr(160) || chr(10) || 'n') || ' ' || chr(160) || chr(10) AS text
FROM {documents}
""",
    # Every part is an entry for its type, so keys conflict and the last entry has to win.
    "taxonomy_raw": """
SELECT p_partkey AS ord, 'voc:' || p_type || CAST(p_size AS string) AS value, p_type || ' / alternative' AS documentation FROM {part}
UNION ALL
SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'voc:N' || p_name ELSE 'malformed' END, ' ' || upper(p_name) FROM {part}
""",
    "bindings": _BINDINGS.format(title=_TITLE),
    "bindings_draft": _BINDINGS.format(title="'draft ' || p_name || '|||second title'"),
    "bindings_flawed": _BINDINGS.format(title=f"CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE {_TITLE} END"),
    "bindings_stream": _ODD_DATES.format(title=_TITLE),
    "bindings_stream_draft": _ODD_DATES.format(title="'draft ' || p_name || '|||second title'"),
    # Payloads of these documents; those of a ninth have not landed.
    "part_payloads": """
SELECT 'work:' || CAST(p_partkey AS string) AS url, 'pdf' AS format, 'eng' AS lang, 'part ' || CAST(p_partkey AS string) || ' is ' || p_name AS content
FROM {part} WHERE p_partkey % 9 <> 0
""",
    "file_names": f"""
SELECT 'files/' || substr(d, 1, 4) || '/dataset_' || d || '_eng.parquet' AS name FROM (SELECT {_ORDER_DAY} AS d FROM {{orders}}) t
UNION ALL
SELECT 'files/' || substr(d, 1, 4) || '/dataset_history' || d || '_to_' || d || '_eng.parquet' FROM (SELECT {_ORDER_DAY} AS d FROM {{orders}}) t
""",
    "listing": f"""
SELECT 'files/' || substr(d, 1, 4) || '/dataset_' || d || '_eng.parquet' AS path,
       CASE WHEN k % 17 = 0 THEN 0 WHEN k % 23 = 0 THEN NULL ELSE n END AS num_rows
FROM (SELECT {_ORDER_DAY} AS d, count(*) AS n, min(o_orderkey) AS k FROM {{orders}} GROUP BY 1) t
UNION ALL
SELECT 'files/dataset_' || d || '_eng.parquet', CASE WHEN substr(d, 9, 2) = '20' THEN 1000000 ELSE 1 END
FROM (SELECT DISTINCT {_ORDER_DAY} AS d FROM {{orders}}) t WHERE substr(d, 9, 2) IN ('20', '21', '22')
UNION ALL
SELECT 'files/' || substr(d, 1, 4) || '/dataset_' || d || '_to_' || d || '_eng.parquet', 9
FROM (SELECT DISTINCT {_ORDER_DAY} AS d FROM {{orders}}) t
UNION ALL
SELECT 'files/' || substr(d, 1, 4) || '/dataset_' || d || '_fra.parquet', 9
FROM (SELECT DISTINCT {_ORDER_DAY} AS d FROM {{orders}}) t
""",
    "run_log": f"""
SELECT d AS date, CASE WHEN k % 2 = 0 THEN 'missing' ELSE 'empty' END AS reason,
       CASE WHEN k % 5 = 0 THEN 'errors' WHEN k % 3 = 0 THEN 'empty' ELSE 'rows' END AS status,
       n AS n_rows, 'files' AS path, CASE WHEN k % 5 = 0 THEN 'failed ' || CAST(k AS string) END AS error
FROM (SELECT {_ORDER_DAY} AS d, count(*) AS n, min(o_orderkey) AS k FROM {{orders}} GROUP BY 1) t
""",
    "snapshots": """
SELECT lower(p_name) || CAST(p_partkey AS string) AS term_key, p_type AS concept_id,
       TIMESTAMP '2024-01-01 00:00:00' + p_size * INTERVAL '10' MINUTE AS loaded_at
FROM {part}
""",
}

_WORK = "'gw' || CAST(o_orderkey % 2 AS string), 'work:' || CAST(o_orderkey AS string)"
_OTHER_WORK = "'gw' || CAST(1 - o_orderkey % 2 AS string), 'work:' || CAST(o_orderkey AS string)"
_DAY_OF, _MONTH_OF = "extract(day FROM o_orderdate)", "extract(month FROM o_orderdate)"
_DATE = "CAST(CAST(o_orderdate AS date) AS string)"
_EXPRESSIONS = "{orders} CROSS JOIN (VALUES ('ENG', 12), ('FRA', 6), ('DEU', 4)) v(lg, m)"
_EXP = "'exp:' || CAST(o_orderkey AS string) || ':' || lg"
_MANIFESTATIONS = _EXPRESSIONS + " CROSS JOIN (VALUES ('pdf', 15), ('xhtml', 20), ('docx', 9)) w(f, k)"
_MAN = "'man:' || CAST(o_orderkey AS string) || ':' || lg || ':' || f"
_HAS_MAN = f"{_MONTH_OF} <= m AND {_DAY_OF} <= k"

# Works are orders, all of them; subjects are part types, agents suppliers and customers. Which
# properties a work has depends on the order's date, status and priority: there are works in two
# graphs, with a second date, without subject or manifestation, with labels in another language or
# graph only.
FIXTURES["quads"] = "\nUNION ALL ".join(
    [
        f"SELECT {_WORK.replace(', ', ' AS g, ', 1)} AS s, 'rdf:type' AS p, 'cdm:work' AS o, CAST(NULL AS string) AS o_lang FROM {{orders}}",
        f"SELECT {_WORK}, 'work_date_document', {_DATE}, NULL FROM {{orders}}",
        f"SELECT {_WORK}, 'work_date_document', '2030-01-01', NULL FROM {{orders}} WHERE {_DAY_OF} = 14",
        f"SELECT {_WORK}, 'work_id_document', 'id:' || CAST(o_orderkey AS string), NULL FROM {{orders}}",
        f"SELECT {_WORK}, 'resource_legal_id_celex', '3' || CAST(o_orderkey AS string), NULL FROM {{orders}} WHERE {_MONTH_OF} IN (1, 4, 7, 10)",
        f"SELECT {_WORK}, 'resource_legal_celex_number', '5' || CAST(o_orderkey AS string), NULL FROM {{orders}} WHERE o_orderstatus <> 'F'",
        f"SELECT {_WORK}, 'work_id_celex', '6' || CAST(o_orderkey AS string), NULL FROM {{orders}} WHERE o_orderpriority LIKE '1%'",
        f"SELECT {_WORK}, 'resource_legal_eli', 'eli/' || CAST(o_orderkey AS string), NULL FROM {{orders}} WHERE o_orderpriority LIKE '2%'",
        f"SELECT {_WORK}, 'procedure_id', 'proc/' || CAST(o_custkey AS string), NULL FROM {{orders}} WHERE o_orderstatus = 'P'",
        f"SELECT {_WORK}, 'work_has_resource-type', 'rt:' || o_orderpriority, NULL FROM {{orders}}",
        "SELECT DISTINCT 'gw' || CAST(o_orderkey % 2 AS string), 'rt:' || o_orderpriority, 'prefLabel', o_orderpriority, "
        "CASE WHEN o_orderpriority LIKE '5%' THEN 'de' ELSE 'en' END FROM {orders}",
        f"SELECT {_WORK}, 'resource_legal_is_about_concept_directory_code', 'dc:' || o_orderstatus, NULL FROM {{orders}} WHERE {_MONTH_OF} > 4",
        "SELECT DISTINCT 'gw0', 'dc:' || o_orderstatus, 'prefLabel', 'dir ' || o_orderstatus, 'en' FROM {orders}",
        "SELECT DISTINCT 'gw' || CAST(l_orderkey % 2 AS string), 'work:' || CAST(l_orderkey AS string), "
        "'work_is_about_concept_eurovoc', 'sub:' || p_type, NULL FROM {lineitem} JOIN {part} ON l_partkey = p_partkey",
        f"SELECT {_OTHER_WORK}, 'rdf:type', 'cdm:work', NULL FROM {{orders}} WHERE {_DAY_OF} = 15",
        f"SELECT {_OTHER_WORK}, 'work_date_document', {_DATE}, NULL FROM {{orders}} WHERE {_DAY_OF} = 15",
        f"SELECT {_OTHER_WORK}, 'work_id_document', 'id2:' || CAST(o_orderkey AS string), NULL FROM {{orders}} WHERE {_DAY_OF} = 15",
        f"SELECT {_OTHER_WORK}, 'resource_legal_celex_number', 'X' || CAST(o_orderkey AS string), NULL FROM {{orders}} WHERE {_DAY_OF} = 15",
        f"SELECT {_OTHER_WORK}, 'work_is_about_concept_eurovoc', 'sub:STANDARD', NULL FROM {{orders}} WHERE {_DAY_OF} = 15",
        "SELECT DISTINCT 'gs', 'sub:' || p_type, 'prefLabel', p_type, 'en' FROM {part}",
        "SELECT DISTINCT 'gs', 'sub:' || p_type, 'prefLabel', 'xx ' || p_type, 'fr' FROM {part}",
        "SELECT DISTINCT 'gagent', 'work:' || CAST(l_orderkey AS string), 'work_created_by_agent', "
        "'agent:' || CAST(l_suppkey AS string), NULL FROM {lineitem} WHERE l_returnflag <> 'N'",
        "SELECT 'gagent', 'work:' || CAST(o_orderkey AS string), 'work_authored_by_agent', "
        "'cust:' || CAST(o_custkey AS string), NULL FROM {orders} WHERE o_orderpriority LIKE '1%'",
        "SELECT 'gagent', 'work:' || CAST(o_orderkey AS string), 'work_contributed_to_by_agent', "
        "'cust:' || CAST(o_custkey AS string), NULL FROM {orders} WHERE o_orderpriority LIKE '3%'",
        "SELECT 'ga', 'agent:' || CAST(s_suppkey AS string), 'prefLabel', s_name, 'en' FROM {supplier}",
        "SELECT 'ga', 'cust:' || CAST(c_custkey AS string), 'prefLabel', c_name, 'en' FROM {customer}",
        f"SELECT 'eg', {_EXP}, 'expression_belongs_to_work', 'work:' || CAST(o_orderkey AS string), NULL FROM {_EXPRESSIONS} WHERE {_MONTH_OF} <= m",
        f"SELECT 'eg', {_EXP}, 'expression_title', 'title ' || CAST(o_orderkey AS string) || ' ' || lg, NULL FROM {_EXPRESSIONS} WHERE {_MONTH_OF} <= m",
        f"SELECT 'eg', {_EXP}, 'expression_uses_language', 'lang:' || lg, NULL FROM {_EXPRESSIONS} WHERE {_MONTH_OF} <= m",
        "SELECT 'lgc', 'lang:' || lg, 'identifier', lg, NULL FROM (VALUES ('ENG'), ('FRA'), ('DEU')) v(lg)",
        f"SELECT 'gm', {_MAN}, 'manifestation_manifests_expression', {_EXP}, NULL FROM {_MANIFESTATIONS} WHERE {_HAS_MAN}",
        f"SELECT 'gm', {_MAN}, 'manifestation_type', f, NULL FROM {_MANIFESTATIONS} WHERE {_HAS_MAN}",
    ]
)

FIXTURES["payloads"] = f"""
SELECT 'work:' || CAST(o_orderkey AS string) AS url, f AS format, lower(lg) AS lang,
       '<p>title ' || CAST(o_orderkey AS string) || '</p> <b>' || lg || '</b>' AS content
FROM {_EXPRESSIONS} CROSS JOIN (VALUES ('pdf'), ('xhtml')) w(f) WHERE {_MONTH_OF} <= m
"""

# Of a fifth of the works no payload has landed, and of a seventh the payloads are blank.
FIXTURES["payloads_flawed"] = f"""
SELECT 'work:' || CAST(o_orderkey AS string) AS url, f AS format, lower(lg) AS lang,
       CASE WHEN o_orderkey % 7 = 0 THEN ' ' ELSE '<p>title ' || CAST(o_orderkey AS string) || '</p> <b>' || lg || '</b>' END AS content
FROM {_EXPRESSIONS} CROSS JOIN (VALUES ('pdf'), ('xhtml')) w(f) WHERE {_MONTH_OF} <= m AND o_orderkey % 5 <> 0
"""

# What a job is told of its source: the seventh of a month was never asked, on the 13th there was no answer.
FIXTURES["landed_days"] = """
SELECT DISTINCT d AS day, CASE WHEN substr(d, 9, 2) = '13' THEN 'source gave no answer' END AS error
FROM (SELECT CAST(CAST(o_orderdate AS date) AS string) AS d FROM {orders} UNION ALL
      SELECT CAST(CAST(o_orderdate AS date) + 1 AS string) FROM {orders} UNION ALL
      SELECT CAST(CAST(o_orderdate AS date) - 1 AS string) FROM {orders}) t
WHERE substr(d, 9, 2) <> '07'
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived input on the Spark side; lazy, like any other frame."""
    sql = FIXTURES[name]
    used = {t: table(spark, sf_dir, t) for t in BASE_TABLES if "{" + t + "}" in sql}
    return spark.sql(sql, **used)


def with_fixtures(names: str, body: str) -> str:
    """The same inputs on the SQL side, as common table expressions in front of ``body``."""
    tables = {t: t for t in BASE_TABLES}
    ctes = ",\n".join(f"{n} AS ({FIXTURES[n].format(**tables)})" for n in names.split())
    joint = "," if body.lstrip().startswith("WITH ") else ""
    return f"WITH {ctes}{joint}\n{body.lstrip().removeprefix('WITH ') if joint else body}"


_LANDED: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    """Where an input is stored: written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _LANDED:
        write(path := shared_dir(spark, name))
        _LANDED[key] = path
    return _LANDED[key]


def landed_quads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quads fixture as the stored table that jobs read."""
    return read_quads(spark, _once(spark, sf_dir, "quads", lambda path: write_quads(fixture(spark, sf_dir, "quads"), path)))


def landed_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quads fixture in buckets of the subject, a table of the catalog."""

    def write(path: str) -> None:
        write_quads_by_subject(fixture(spark, sf_dir, "quads"), _table_name(path), path, 16)

    return spark.table(_table_name(_once(spark, sf_dir, "quads_by_subject", write)))


def _table_name(path: str) -> str:
    return path.rsplit("/", 1)[1].replace("-", "_")


def landed_payloads(spark: SparkSession, sf_dir: str, name: str = "payloads") -> DataFrame:
    """A payloads fixture as the stored table that jobs read, in buckets."""
    rows = fixture(spark, sf_dir, name).withColumn("content", F.col("content").cast("binary"))
    return read_payloads(spark, _once(spark, sf_dir, name, lambda path: write_payloads(rows, path, 64)))
