"""Metadata assembly, shaping and concept mapping."""

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.functions.cells import join_cell
from docquarry.operators import graph
from docquarry.operators.shape import binding_lists, quarantine_rows, shape_documents, shape_rows, subject_terms
from docquarry.operators.taxonomy import current_taxonomy, taxonomy_keys, unmatched_terms
from docquarry.settings import shared_dir
from docquarry.sources.tables import stored
from queries import Query
from queries.fixtures import fixture, landed_quads, landed_subjects, with_fixtures
from queries.text_queries import STRIP_WS

START, END = "1995-01-01", "2001-07-01"
TODAY, TOTAL_DAYS, STEP = datetime.date(2001, 8, 1), 2405, 7


def _quads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed_quads(spark, sf_dir)


def _names(spark: SparkSession, quads: DataFrame) -> graph.Names:
    return graph.stored_names(quads, shared_dir(spark, "names"))


def assemble_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    quads = _quads(spark, sf_dir)
    return graph.as_bindings(graph.assemble_metadata(quads, START, END, names=_names(spark, quads)))


def lang_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.as_bindings(graph.assemble_metadata(_quads(spark, sf_dir), START, END, lang="FRA"))


def assemble_by_subject(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over quads in subject buckets, where a work's properties meet without a shuffle."""
    quads = landed_subjects(spark, sf_dir)
    return graph.as_bindings(graph.assemble_metadata(quads, START, END, names=_names(spark, quads)))


def lang_by_subject(spark: SparkSession, sf_dir: str) -> DataFrame:
    quads = landed_subjects(spark, sf_dir)
    works = graph.works_in_language(quads, graph.dated_works(quads, START, END), "FRA")
    return graph.as_bindings(graph.assemble_metadata(quads, START, END, "FRA", works=stored(works, shared_dir(spark, "works"))))


def metadata_by_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    quads = _quads(spark, sf_dir)
    rows = graph.metadata_by_window(quads, TODAY, TOTAL_DAYS, STEP, names=_names(spark, quads))
    return rows.select(
        F.get("cellar_uris", F.lit(0)).alias("work"), "date", "lang_id", "window_no", "window_start", "window_end"
    )


def window_works(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.window_works(_quads(spark, sf_dir), START, END)


def window_works_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature of a page of works: 50 of them after the first 20, in order."""
    return graph.window_works(_quads(spark, sf_dir), START, END, limit=50, offset=20)


def celex_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    quads = _quads(spark, sf_dir)
    per_graph = graph.work_properties(quads, graph.dated_works(quads, START, END))
    return per_graph.select("g", "work", join_cell(F.col("celex_ids")).alias("celex_ids"))


def agents_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    quads = _quads(spark, sf_dir)
    agents = graph.work_agents(quads, graph.dated_works(quads, START, END))
    return agents.select("work", join_cell(F.col("authors")).alias("authors"))


def triple_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = graph.pattern(_quads(spark, sf_dir), graph.VOCABULARY.label)
    return found.groupBy("g", "o_lang").agg(F.count("*").alias("n_labels"))


def _taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxonomy_keys(fixture(spark, sf_dir, "taxonomy_raw"))


def taxonomy_key_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _taxonomy(spark, sf_dir)


_LISTS = ("institutions", "work_types", "procedure_ids", "directory_codes", "formats", "eurovoc_concepts", "eurovoc_concepts_ids")


def _joined(docs: DataFrame) -> DataFrame:
    return docs.withColumns({c: join_cell(F.col(c)) for c in _LISTS})


def shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(shape_documents(binding_lists(fixture(spark, sf_dir, "bindings")), _taxonomy(spark, sf_dir)))


def concept_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shape_rows(binding_lists(fixture(spark, sf_dir, "bindings")), _taxonomy(spark, sf_dir))
    return _joined(rows).select("url", "eurovoc_concepts", "eurovoc_concepts_ids")


def misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = binding_lists(fixture(spark, sf_dir, "bindings"))
    terms = lists.select(subject_terms(F.col("subjects")).alias("terms"))
    return unmatched_terms(terms, _taxonomy(spark, sf_dir), "terms")


def quarantine_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sides of the split: no row is lost to another one's missing field."""
    lists = binding_lists(fixture(spark, sf_dir, "bindings_flawed"))
    taxonomy = _taxonomy(spark, sf_dir)
    kept = shape_documents(lists, taxonomy).select("url", "title", F.lit("").alias("missing"))
    held = quarantine_rows(lists, taxonomy).select("url", "title", join_cell(F.col("missing")).alias("missing"))
    return kept.unionByName(held)


def taxonomy_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = datetime.datetime(2024, 1, 1, 8, 25)
    current = current_taxonomy(fixture(spark, sf_dir, "snapshots"), now)
    return current.withColumn("loaded_at", F.date_format("loaded_at", "yyyy-MM-dd HH:mm"))


def _trim(cell: str) -> str:
    return rf"regexp_replace({cell}, '\A[{STRIP_WS}]+|[{STRIP_WS}]+\z', '', 'g')"


def _parts(cell: str) -> str:
    return f"list_filter(list_transform(string_split(coalesce({cell}, ''), '|||'), lambda x: {_trim('x')}), lambda x: x <> '')"


def _cell(cell: str) -> str:
    return f"array_to_string({_parts(cell)}, '|||')"


# The mapping in SQL: unnest the terms with their position, join, keep the first position per id.
_TAXONOMY_SQL = f"""
keyed AS (SELECT lower({_trim("split_part(documentation, '/', 1)")}) AS term_key, string_split(value, ':')[2] AS concept_id, ord
          FROM taxonomy_raw),
taxonomy AS (SELECT term_key, max_by(concept_id, ord) AS concept_id FROM keyed WHERE concept_id IS NOT NULL GROUP BY term_key)"""


def _mapping_sql(bindings: str) -> str:
    subjects = _parts("replace(subjects, chr(160), ' ')")
    return f"""{_TAXONOMY_SQL},
listed AS (SELECT *, {subjects} AS terms FROM {bindings}),
pairs AS (SELECT cellarURIs, unnest(terms) AS term, unnest(range(len(terms))) AS pos FROM listed),
first_hit AS (SELECT cellarURIs, concept_id, min(pos) AS pos FROM pairs JOIN taxonomy ON lower({_trim("term")}) = term_key GROUP BY 1, 2),
mapped AS (SELECT cellarURIs, string_agg(concept_id, '|||' ORDER BY pos) AS ids FROM first_hit GROUP BY 1)"""


# Assembly in SQL, by the full join of all properties with distinct aggregates on top.
_ASSEMBLY_SQL = """
works AS (SELECT DISTINCT d.s AS work FROM quads d WHERE d.p = 'work_date_document' AND d.o >= '{start}' AND d.o < '{end}'
          AND EXISTS (SELECT 1 FROM quads t WHERE t.s = d.s AND t.p = 'rdf:type')
          AND EXISTS (SELECT 1 FROM quads i WHERE i.s = d.s AND i.p = 'work_id_document')),
english AS (SELECT g, s, o FROM quads WHERE p = 'prefLabel' AND o_lang = 'en'),
core AS (
  SELECT w.work, d.o AS date, rl.o AS res_label, coalesce(c1.o, c2.o, c3.o) AS celex, e.o AS eli, pr.o AS proc, dl.o AS dir_label, sl.o AS subject
  FROM works w
  JOIN quads t ON t.s = w.work AND t.p = 'rdf:type'
  JOIN quads d ON d.s = w.work AND d.g = t.g AND d.p = 'work_date_document'
  JOIN quads i ON i.s = w.work AND i.g = t.g AND i.p = 'work_id_document'
  LEFT JOIN (SELECT r.g, r.s, l.o FROM quads r JOIN english l ON l.g = r.g AND l.s = r.o WHERE r.p = 'work_has_resource-type') rl
    ON rl.s = w.work AND rl.g = t.g
  LEFT JOIN quads c1 ON c1.s = w.work AND c1.g = t.g AND c1.p = 'resource_legal_id_celex'
  LEFT JOIN quads c2 ON c2.s = w.work AND c2.g = t.g AND c2.p = 'resource_legal_celex_number'
  LEFT JOIN quads c3 ON c3.s = w.work AND c3.g = t.g AND c3.p = 'work_id_celex'
  LEFT JOIN quads e ON e.s = w.work AND e.g = t.g AND e.p = 'resource_legal_eli'
  LEFT JOIN quads pr ON pr.s = w.work AND pr.g = t.g AND pr.p = 'procedure_id'
  LEFT JOIN (SELECT r.g, r.s, l.o FROM quads r JOIN english l ON l.g = r.g AND l.s = r.o
             WHERE r.p = 'resource_legal_is_about_concept_directory_code') dl ON dl.s = w.work AND dl.g = t.g
  JOIN quads sub ON sub.s = w.work AND sub.g = t.g AND sub.p = 'work_is_about_concept_eurovoc'
  JOIN english sl ON sl.s = sub.o),
spoken AS (
  SELECT b.o AS work, ti.o AS title, id.o AS lang_id, mt.o AS mtype
  FROM quads b
  JOIN quads ti ON ti.g = b.g AND ti.s = b.s AND ti.p = 'expression_title'
  JOIN quads ul ON ul.g = b.g AND ul.s = b.s AND ul.p = 'expression_uses_language'
  JOIN quads id ON id.s = ul.o AND id.p = 'identifier'
  JOIN quads mm ON mm.o = b.s AND mm.p = 'manifestation_manifests_expression'
  JOIN quads mt ON mt.g = mm.g AND mt.s = mm.s AND mt.p = 'manifestation_type'
  WHERE b.p = 'expression_belongs_to_work'),
agents AS (
  SELECT a.s AS work, l.o AS author FROM quads a JOIN english l ON l.s = a.o
  WHERE a.p IN ('work_contributed_to_by_agent', 'work_created_by_agent', 'work_authored_by_agent')),
solutions AS (SELECT * FROM core JOIN spoken USING (work) LEFT JOIN agents USING (work))"""

_ASSEMBLED_SQL = (
    "WITH "
    + _ASSEMBLY_SQL.lstrip()
    + """
SELECT work AS "cellarURIs", string_agg(DISTINCT title, '|||' ORDER BY title) AS title,
  string_agg(DISTINCT mtype, '|||' ORDER BY mtype) AS mtypes,
  coalesce(string_agg(DISTINCT res_label, '|||' ORDER BY res_label), '') AS "workTypes",
  coalesce(string_agg(DISTINCT author, '|||' ORDER BY author), '') AS authors,
  string_agg(DISTINCT subject, '|||' ORDER BY subject) AS subjects,
  coalesce(string_agg(DISTINCT celex, '|||' ORDER BY celex), '') AS "celexIds",
  coalesce(string_agg(DISTINCT eli, '|||' ORDER BY eli), '') AS "eliIds",
  coalesce(string_agg(DISTINCT proc, '|||' ORDER BY proc), '') AS "procedureIds",
  coalesce(string_agg(DISTINCT dir_label, '|||' ORDER BY dir_label), '') AS "directoryCodes",
  lang_id AS "langIdentifier", date
FROM solutions {where} GROUP BY work, date, lang_id"""
)


def _assembled(where: str = "") -> str:
    return with_fixtures("quads", _ASSEMBLED_SQL.format(start=START, end=END, where=where))


_BY_WINDOW_SQL = (
    "WITH "
    + _ASSEMBLY_SQL.lstrip().format(start="1995-01-02", end="2001-08-02")
    + f"""
, days AS (SELECT DISTINCT s AS work, date_diff('day', CAST(CASE WHEN p = 'work_date_document' THEN o END AS date), DATE '{TODAY}') AS back
  FROM quads WHERE p = 'work_date_document'),
members AS (SELECT DISTINCT work, CAST(back // {STEP} AS int) AS window_no FROM days WHERE back >= 0 AND back < {TOTAL_DAYS})
SELECT DISTINCT work, date, lang_id, window_no,
  CAST(DATE '{TODAY}' - CAST(least(window_no * {STEP} + {STEP}, {TOTAL_DAYS}) - 1 AS int) AS string) AS window_start,
  CAST(DATE '{TODAY}' - CAST(window_no * {STEP} AS int) AS string) AS window_end
FROM core JOIN spoken USING (work) JOIN members USING (work)"""
).replace("1995-01-02", str(TODAY - datetime.timedelta(days=TOTAL_DAYS - 1)))

_SHAPE_SQL = f"""
SELECT split_part(b.cellarURIs, '|||', 1) AS url, split_part(coalesce(celexIds, ''), '|||', 1) AS celex,
  split_part(coalesce(eliIds, ''), '|||', 1) AS eli, split_part(title, '|||', 1) AS title, date,
  lower(langIdentifier) AS lang, {_cell("authors")} AS institutions, {_cell("workTypes")} AS work_types,
  '' AS procedure_ids, '' AS directory_codes,
  array_to_string(list_transform(string_split(mtypes, '|||'), lambda x: {_trim("x")}), '|||') AS formats,
  array_to_string(terms, '|||') AS eurovoc_concepts, ids AS eurovoc_concepts_ids
FROM listed b JOIN mapped USING (cellarURIs)"""

QUERIES = {
    "assemble_metadata": Query(assemble_metadata, _assembled(), "S3 G1-G6 G8-G12 F1 F2 D5"),
    "lang_filtered": Query(lang_filtered, _assembled("WHERE lang_id = 'FRA'"), "G7"),
    "assemble_by_subject": Query(assemble_by_subject, _assembled(), "S3 G1-G6 G8-G12 F1 F2 D5"),
    "lang_by_subject": Query(lang_by_subject, _assembled("WHERE lang_id = 'FRA'"), "G7"),
    "metadata_by_window": Query(metadata_by_window, with_fixtures("quads", _BY_WINDOW_SQL), "G1 W1 W2 O1"),
    "window_works": Query(
        window_works,
        with_fixtures("quads", "WITH " + _ASSEMBLY_SQL.lstrip().split("),\nenglish")[0].format(start=START, end=END) + ") SELECT work FROM works"),
        "G1 F1",
    ),
    "window_works_page": Query(
        window_works_page,
        with_fixtures("quads", "WITH " + _ASSEMBLY_SQL.lstrip().split("),\nenglish")[0].format(start=START, end=END) + ") SELECT DISTINCT work FROM works ORDER BY work LIMIT 50 OFFSET 20"),
        "G13",
    ),
    "celex_fallback": Query(
        celex_fallback,
        with_fixtures(
            "quads",
            f"""SELECT t.g, t.s AS work, coalesce(string_agg(DISTINCT coalesce(c1.o, c2.o, c3.o), '|||' ORDER BY coalesce(c1.o, c2.o, c3.o)), '') AS celex_ids
            FROM quads t
            JOIN quads d ON d.g = t.g AND d.s = t.s AND d.p = 'work_date_document'
            JOIN quads i ON i.g = t.g AND i.s = t.s AND i.p = 'work_id_document'
            JOIN quads sub ON sub.g = t.g AND sub.s = t.s AND sub.p = 'work_is_about_concept_eurovoc'
            JOIN quads sl ON sl.s = sub.o AND sl.p = 'prefLabel' AND sl.o_lang = 'en'
            LEFT JOIN quads c1 ON c1.s = t.s AND c1.g = t.g AND c1.p = 'resource_legal_id_celex'
            LEFT JOIN quads c2 ON c2.s = t.s AND c2.g = t.g AND c2.p = 'resource_legal_celex_number'
            LEFT JOIN quads c3 ON c3.s = t.s AND c3.g = t.g AND c3.p = 'work_id_celex'
            WHERE t.p = 'rdf:type'
              AND t.s IN (SELECT s FROM quads WHERE p = 'work_date_document' AND o >= '{START}' AND o < '{END}')
            GROUP BY 1, 2""",
        ),
        "G2 G3 G5 G10",
    ),
    "agents_union": Query(
        agents_union,
        with_fixtures(
            "quads",
            f"""SELECT a.s AS work, string_agg(DISTINCT l.o, '|||' ORDER BY l.o) AS authors
            FROM (SELECT s, o FROM quads WHERE p = 'work_contributed_to_by_agent'
                  UNION ALL SELECT s, o FROM quads WHERE p = 'work_created_by_agent'
                  UNION ALL SELECT s, o FROM quads WHERE p = 'work_authored_by_agent') a
            JOIN quads l ON l.s = a.o AND l.p = 'prefLabel' AND l.o_lang = 'en'
            WHERE a.s IN (SELECT s FROM quads WHERE p = 'work_date_document' AND o >= '{START}' AND o < '{END}')
            GROUP BY 1""",
        ),
        "G9 D5",
    ),
    "triple_pattern": Query(
        triple_pattern,
        with_fixtures("quads", "SELECT g, o_lang, count(*) AS n_labels FROM quads WHERE p = 'prefLabel' GROUP BY 1, 2"),
        "S3",
    ),
    "taxonomy_keys": Query(
        taxonomy_key_table,
        with_fixtures("taxonomy_raw", "WITH " + _TAXONOMY_SQL.lstrip() + "\nSELECT term_key, concept_id FROM taxonomy"),
        "R7 R9",
    ),
    "shape_documents": Query(
        shape,
        with_fixtures("bindings taxonomy_raw", "WITH " + _mapping_sql("bindings").lstrip() + _SHAPE_SQL),
        "R1-R6 R11 F3 F4",
    ),
    "concept_mapping": Query(
        concept_mapping,
        with_fixtures(
            "bindings taxonomy_raw",
            "WITH "
            + _mapping_sql("bindings").lstrip()
            + """ SELECT cellarURIs AS url, array_to_string(terms, '|||') AS eurovoc_concepts, ids AS eurovoc_concepts_ids
                  FROM listed JOIN mapped USING (cellarURIs)""",
        ),
        "R8 D8 F4",
    ),
    "unmatched_terms": Query(
        misses,
        with_fixtures(
            "bindings taxonomy_raw",
            "WITH "
            + _mapping_sql("bindings").lstrip()
            + f""" SELECT term, count(*) AS n_misses FROM pairs
                   WHERE lower({_trim("term")}) NOT IN (SELECT term_key FROM taxonomy) GROUP BY term""",
        ),
        "R10",
    ),
    "quarantine_split": Query(
        quarantine_split,
        with_fixtures(
            "bindings_flawed taxonomy_raw",
            "WITH "
            + _mapping_sql("bindings_flawed").lstrip()
            + """ SELECT cellarURIs AS url, split_part(title, '|||', 1) AS title,
                         CASE WHEN title IS NULL THEN 'title' ELSE '' END AS missing
                  FROM listed JOIN mapped USING (cellarURIs)""",
        ),
        "R13",
    ),
    "taxonomy_snapshot": Query(
        taxonomy_snapshot,
        with_fixtures(
            "snapshots",
            """SELECT term_key, concept_id, strftime(loaded_at, '%Y-%m-%d %H:%M') AS loaded_at FROM snapshots
               WHERE loaded_at = (SELECT max(loaded_at) FROM snapshots
                                  WHERE loaded_at BETWEEN TIMESTAMP '2024-01-01 06:25:00' AND TIMESTAMP '2024-01-01 08:25:00')""",
        ),
        "T7",
    ),
}
