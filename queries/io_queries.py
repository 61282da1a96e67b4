"""Sources and sinks: every query writes what it needs from the given tables and reads it back."""

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.operators.calendar import calendar_between, lookback_windows, with_window
from docquarry.operators.extract import DEFAULT_EXTRACTORS
from docquarry.operators.taxonomy import taxonomy_keys
from docquarry.plans.mine import MineParams
from docquarry.schemas import BINDING_VARIABLES
from docquarry.settings import shared_dir
from docquarry.sinks.daily import Corpus, planned_days, read_days, read_problems, read_ranges, sql_over_days, write_days, write_ranges
from docquarry.sinks.publish import publish_changes
from docquarry.sinks.upkeep import compact_manifest, drop_superseded
from docquarry.sources.bindings import read_bindings, stream_bindings
from docquarry.sources.files import scan_partitions, sql_over_files
from docquarry.sources.tables import stored
from docquarry.sources.taxonomy_xml import read_taxonomy_entries, write_taxonomy_entries
from docquarry.streaming.ingest import ingest_stream, merge_days, read_aside, read_late
from queries import Query
from queries.fixtures import fixture, landed_payloads, with_fixtures
from queries.graph_queries import _joined, _mapping_sql, _taxonomy

FIRST, TODAY = datetime.date(2024, 1, 1), datetime.date(2024, 1, 30)


def _docs(spark: SparkSession, sf_dir: str, name: str = "docs") -> DataFrame:
    docs = fixture(spark, sf_dir, name).select("ord", "url", "celex", "date", "lang", "text")
    return docs.withColumn("day", F.col("date"))


def _plan(spark: SparkSession, docs: DataFrame, errors: DataFrame | None = None) -> DataFrame:
    days = calendar_between(spark, FIRST - datetime.timedelta(days=1), TODAY).withColumnRenamed("date", "day")
    return planned_days(days, docs.groupBy("day").agg(F.count("*").alias("discovered")), errors)


def _write_twice(spark: SparkSession, sf_dir: str) -> tuple[Corpus, DataFrame]:
    """An older state, then today's: days are replaced, and one day becomes empty."""
    corpus = Corpus(shared_dir(spark, "corpus"))
    for run, name in (("run-1", "docs_before"), ("run-2", "docs")):
        docs = _docs(spark, sf_dir, name)
        write_days(docs, _plan(spark, docs), corpus, run)
    return corpus, docs


def daily_write_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus, docs = _write_twice(spark, sf_dir)
    return read_days(spark, corpus, docs.schema)


def clean_up_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After two states: the files of the older go, the manifest becomes one file, and the rows read are the same."""
    corpus, docs = _write_twice(spark, sf_dir)
    drop_superseded(spark, corpus, shared_dir(spark, "dropped"))
    compact_manifest(spark, corpus)
    return read_days(spark, corpus, docs.schema)


def empty_day_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last day fails, the gaps are empty, all others have rows."""
    corpus = Corpus(shared_dir(spark, "corpus"))
    docs = _docs(spark, sf_dir)
    failed = docs.agg(F.max("day").alias("day"))
    errors = failed.withColumn("error", F.lit("source gave no answer"))
    good = docs.join(failed, "day", "left_anti")
    return write_days(good, _plan(spark, good, errors), corpus, "run-1").drop("run_id", "seq", "attempt", "columns")


def crashed_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second run writes its files and dies before its manifest entries: the first run's rows are read."""
    corpus = Corpus(shared_dir(spark, "corpus"))
    before, docs = _docs(spark, sf_dir, "docs_before"), _docs(spark, sf_dir)
    write_days(before, _plan(spark, before), corpus, "run-1")
    files = docs.withColumns({"year": F.substring("day", 1, 4), "scope": F.lit("all"), "_run": F.lit("run-2~died")})
    files.write.mode("append").partitionBy("year", "day", "scope", "_run").parquet(corpus.files)
    return read_days(spark, corpus)


def stream_then_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lookback after a stream run counts, though its id sorts before; the replay of its id counts again."""
    corpus = Corpus(shared_dir(spark, "corpus"))
    for run, name in (("stream-000000000000", "docs"), ("2024-01-30T06", "docs_before"), ("2024-01-30T06", "docs")):
        docs = _docs(spark, sf_dir, name)
        write_days(docs, _plan(spark, docs), corpus, run)
    return read_days(spark, corpus)


def stream_over_mined_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata without text lands on mined days: the new ids are taken over, every text stays."""
    corpus = Corpus(shared_dir(spark, "corpus"))
    docs = _docs(spark, sf_dir).withColumn("match_thing", F.col("text").contains("thing"))
    write_days(docs, _plan(spark, docs), corpus, "run-1")
    batch = docs.filter("ord % 3 = 0").drop("text", "match_thing").withColumn("celex", F.concat(F.lit("new-"), F.col("ord").cast("string")))
    merge_days(stored(batch, shared_dir(spark, "batch")), corpus, "stream-1", key=("ord",))
    return read_days(spark, corpus).drop("scope")


def ranges_after_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second run of the same ranges, in which the second week has no documents any more."""
    corpus = Corpus(shared_dir(spark, "corpus"))
    docs = with_window(_docs(spark, sf_dir).drop("day"), TODAY, 30, 7)
    windows = lookback_windows(spark, TODAY, 30, 7)
    write_ranges(docs.drop("window_no"), corpus, "run-1", windows)
    write_ranges(docs.filter("window_no <> 1").drop("window_no"), corpus, "run-2", windows)
    return read_ranges(spark, corpus).select("window_start", "window_end", "url", "text")


def sql_after_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL over a corpus whose last day became empty in a second run."""
    corpus = Corpus(shared_dir(spark, "corpus"))
    docs = _docs(spark, sf_dir)
    write_days(docs, _plan(spark, docs), corpus, "run-1")
    fewer = docs.join(docs.agg(F.max("day").alias("day")), "day", "left_anti")
    write_days(fewer, _plan(spark, fewer), corpus, "run-2")
    return sql_over_days(spark, corpus, "SELECT day, count(*) AS n_docs, sum(length(text)) AS n_chars FROM documents GROUP BY day")


def inventory_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts from the footers of the written files, a day with several files included."""
    corpus = Corpus(shared_dir(spark, "corpus"))
    docs = _docs(spark, sf_dir)
    write_days(docs, _plan(spark, docs), corpus, "run-1", "all")
    return scan_partitions(spark, corpus.files).select("date", "num_rows")


def range_write_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus = Corpus(shared_dir(spark, "corpus"))
    docs = with_window(_docs(spark, sf_dir).drop("day"), TODAY, 30, 7).drop("window_no")
    write_ranges(docs, corpus, "run-1")
    return read_ranges(spark, corpus).select("year", "window_start", "window_end", "url", "text")


def sql_on_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus = Corpus(shared_dir(spark, "corpus"))
    docs = _docs(spark, sf_dir)
    write_days(docs, _plan(spark, docs), corpus, "run-1")
    return sql_over_files(
        spark,
        corpus.files,
        "SELECT lang, count(*) AS n_docs, sum(length(text)) AS n_chars, max(date) AS last_date FROM documents GROUP BY lang",
    )


def publish_changed_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish twice; the published tree after the second time, with the status of each day."""
    base = shared_dir(spark, "publish")
    for run, name in (("1", "docs_before"), ("2", "docs")):
        docs = _docs(spark, sf_dir, name).withColumn("year", F.substring("day", 1, 4))
        status = publish_changes(docs, f"{base}/tree", f"{base}/digests", run)
    tree = spark.read.parquet(f"{base}/tree").withColumn("day", F.col("day").cast("string"))
    counts = tree.groupBy("day").agg(F.count("*").alias("n_rows"), F.sum(F.length("text")).alias("n_chars"))
    return status.select("day", "status").join(counts, "day", "left")


def _land_bindings(bindings: DataFrame, path: str) -> None:
    """Result files, one JSON document per line; unbound variables are absent."""
    cells = [
        F.when(F.col(v).isNotNull(), F.struct(F.lit(v), F.struct(F.lit("literal").alias("type"), F.col(v).alias("value"))))
        for v in bindings.columns
    ]
    row = F.map_from_entries(F.array_compact(F.array(*cells)))
    bindings.select(F.struct(F.array(row).alias("bindings")).alias("results")).write.json(path)


def json_bindings(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "results")
    bindings = fixture(spark, sf_dir, "bindings")
    _land_bindings(bindings, path)
    return read_bindings(spark, path, multi_line=False)


def xml_taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries written as XML in their order and read back: the last entry of a key still wins."""
    path = shared_dir(spark, "taxonomy")
    write_taxonomy_entries(fixture(spark, sf_dir, "taxonomy_raw").orderBy("ord"), path)
    return taxonomy_keys(read_taxonomy_entries(spark, path))


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rounds of landed files: drafts first, then corrections of the same documents. Days
    before the lookback go to the late table."""
    base = shared_dir(spark, "stream")
    corpus, taxonomy = Corpus(f"{base}/corpus"), _taxonomy(spark, sf_dir)
    for i, name in enumerate(("bindings_draft", "bindings")):
        _land_bindings(fixture(spark, sf_dir, name), f"{base}/landed/round={i}")
        rows = stream_bindings(spark, f"{base}/landed/round=*", multi_line=False)
        ingest_stream(rows, taxonomy, corpus, TODAY, 20, f"{base}/checkpoint").awaitTermination()
    late = read_late(spark, corpus)
    kept = read_days(spark, corpus, late.drop("batch").schema)
    columns = ["url", "title", "date", "lang", "eurovoc_concepts", "eurovoc_concepts_ids"]
    kept = _joined(kept).select(*columns, F.lit("kept").alias("place"))
    return kept.unionByName(_joined(late).select(*columns, F.lit("late").alias("place")))


def stream_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drafts, then corrections, mined as they land: kept documents with text and matches, one for each
    CELEX and day over both rounds; rows of no day by the reason; documents whose payload has not landed."""
    base = shared_dir(spark, "stream")
    corpus, taxonomy = Corpus(f"{base}/corpus"), stored(_taxonomy(spark, sf_dir), f"{base}/taxonomy")
    payloads = landed_payloads(spark, sf_dir, "part_payloads")
    params = MineParams(today=TODAY, keywords=("part 1", "steel"), unique_on="celex")
    extractors = DEFAULT_EXTRACTORS.register("pdf", bytes.decode)
    for i, name in enumerate(("bindings_stream_draft", "bindings_stream")):
        _land_bindings(fixture(spark, sf_dir, name), f"{base}/landed/round={i}")
        rows = stream_bindings(spark, f"{base}/landed/round=*", multi_line=False)
        ingest_stream(rows, taxonomy, corpus, TODAY, 20, f"{base}/checkpoint", payloads=payloads, params=params, extractors=extractors).awaitTermination()
    columns = ["url", "celex", "title", "date", "text", "match_part_1", "match_steel"]
    kept = read_days(spark, corpus).select(F.lit("day").alias("place"), *columns)
    nothing = [F.lit(None).cast("string").alias("text"), F.lit(None).cast("boolean").alias("match_part_1"), F.lit(None).cast("boolean").alias("match_steel")]
    aside = read_aside(spark, corpus).select("place", *columns[:4], *nothing)
    failed = read_problems(spark, corpus).select(F.col("error").alias("place"), *columns[:4], *nothing)
    return kept.unionByName(aside).unionByName(failed)


_VARIABLES = ("cellarURIs", "celexIds", "title", "date", "langIdentifier", "subjects", "authors", "mtypes", "workTypes", "eliIds")

QUERIES = {
    "daily_write_roundtrip": Query(
        daily_write_roundtrip,
        with_fixtures("docs", "SELECT ord, url, celex, date, lang, text, date AS day, 'all' AS scope FROM docs"),
        "O1 O3",
    ),
    "clean_up_roundtrip": Query(clean_up_roundtrip, with_fixtures("docs", "SELECT ord, url, celex, date, lang, text, date AS day, 'all' AS scope FROM docs"), "O1 O3"),
    "crashed_run": Query(crashed_run, with_fixtures("docs_before", "SELECT ord, url, celex, date, lang, text, date AS day, 'all' AS scope FROM docs_before"), "O1 O3"),
    "stream_then_lookback": Query(stream_then_lookback, with_fixtures("docs", "SELECT ord, url, celex, date, lang, text, date AS day, 'all' AS scope FROM docs"), "O1 O3"),
    "stream_over_mined_days": Query(
        stream_over_mined_days,
        with_fixtures(
            "docs",
            """SELECT ord, url, CASE WHEN ord % 3 = 0 THEN 'new-' || ord ELSE celex END AS celex, date, lang, text, date AS day,
                      contains(text, 'thing') AS match_thing FROM docs""",
        ),
        "O1 ST1",
    ),
    "ranges_after_rerun": Query(
        ranges_after_rerun,
        with_fixtures(
            "docs",
            """SELECT CAST(DATE '2024-01-30' - CAST(least(k * 7 + 7, 30) - 1 AS int) AS string) AS window_start,
                      CAST(DATE '2024-01-30' - CAST(k * 7 AS int) AS string) AS window_end, url, text
               FROM (SELECT *, date_diff('day', CAST(date AS date), DATE '2024-01-30') // 7 AS k FROM docs) t WHERE k <> 1""",
        ),
        "O2",
    ),
    "sql_after_rerun": Query(
        sql_after_rerun,
        with_fixtures("docs", "SELECT date AS day, count(*) AS n_docs, CAST(sum(length(text)) AS bigint) AS n_chars FROM docs WHERE date < (SELECT max(date) FROM docs) GROUP BY date"),
        "S4",
    ),
    "empty_day_manifest": Query(
        empty_day_manifest,
        with_fixtures(
            "docs",
            """SELECT day, 'all' AS scope,
              CASE WHEN day = (SELECT max(date) FROM docs) THEN 'errors' WHEN n > 0 THEN 'rows' ELSE 'empty' END AS status,
              CASE WHEN day <> (SELECT max(date) FROM docs) THEN n END AS n_rows,
              CASE WHEN day = (SELECT max(date) FROM docs) THEN 'source gave no answer' END AS error
            FROM (SELECT CAST(CAST(s.d AS date) AS string) AS day, (SELECT count(*) FROM docs WHERE date = CAST(CAST(s.d AS date) AS string)) AS n
                  FROM generate_series(DATE '2023-12-31', DATE '2024-01-30', INTERVAL 1 DAY) s(d)) t""",
        ),
        "O3 O5",
    ),
    "inventory_scan": Query(
        inventory_scan, with_fixtures("docs", "SELECT date, count(*) AS num_rows FROM docs GROUP BY date"), "S5"
    ),
    "range_write_roundtrip": Query(
        range_write_roundtrip,
        with_fixtures(
            "docs",
            """SELECT '2024' AS year, CAST(DATE '2024-01-30' - CAST(least(k * 7 + 7, 30) - 1 AS int) AS string) AS window_start,
                      CAST(DATE '2024-01-30' - CAST(k * 7 AS int) AS string) AS window_end, url, text
               FROM (SELECT *, date_diff('day', CAST(date AS date), DATE '2024-01-30') // 7 AS k FROM docs) t""",
        ),
        "O2",
    ),
    "sql_over_files": Query(
        sql_on_files,
        with_fixtures("docs", "SELECT lang, count(*) AS n_docs, CAST(sum(length(text)) AS bigint) AS n_chars, max(date) AS last_date FROM docs GROUP BY lang"),
        "S4",
    ),
    "publish_changed_days": Query(
        publish_changed_days,
        with_fixtures(
            "docs docs_before",
            """WITH a AS (SELECT date, count(*) AS n, sum(length(text)) AS c, string_agg(url || text, '§' ORDER BY ord) AS h FROM docs GROUP BY 1),
               b AS (SELECT date, count(*) AS n, sum(length(text)) AS c, string_agg(url || text, '§' ORDER BY ord) AS h FROM docs_before GROUP BY 1)
               SELECT date AS day, CASE WHEN b.h IS NULL THEN 'new' WHEN a.h IS NULL THEN 'gone' WHEN a.h = b.h THEN 'unchanged' ELSE 'changed' END AS status,
                 coalesce(a.n, b.n) AS n_rows, CAST(coalesce(a.c, b.c) AS bigint) AS n_chars FROM a FULL JOIN b USING (date)""",
        ),
        "O4",
    ),
    "json_bindings": Query(
        json_bindings,
        with_fixtures(
            "bindings",
            "SELECT " + ", ".join(f'"{v}"' if v in _VARIABLES else f'CAST(NULL AS string) AS "{v}"' for v in BINDING_VARIABLES) + " FROM bindings",
        ),
        "S1",
    ),
    "xml_taxonomy": Query(
        xml_taxonomy,
        with_fixtures(
            "taxonomy_raw",
            """SELECT lower(trim(split_part(documentation, '/', 1))) AS term_key, max_by(string_split(value, ':')[2], ord) AS concept_id
               FROM taxonomy_raw WHERE contains(value, ':') GROUP BY 1""",
        ),
        "S2 R7 R9",
    ),
    "stream_ingest": Query(
        stream_ingest,
        with_fixtures(
            "bindings bindings_draft taxonomy_raw",
            "WITH "
            + _mapping_sql("bindings").lstrip()
            + """, shaped AS (SELECT b.cellarURIs AS url, split_part(b.title, '|||', 1) AS title, split_part(r.title, '|||', 1) AS draft, b.date,
                    lower(b.langIdentifier) AS lang, array_to_string(terms, '|||') AS eurovoc_concepts, ids AS eurovoc_concepts_ids
                  FROM listed b JOIN mapped USING (cellarURIs) JOIN bindings_draft r USING (cellarURIs))
                  SELECT url, title, date, lang, eurovoc_concepts, eurovoc_concepts_ids,
                    CASE WHEN date >= '2024-01-11' THEN 'kept' ELSE 'late' END AS place FROM shaped
                  UNION ALL SELECT url, draft, date, lang, eurovoc_concepts, eurovoc_concepts_ids, 'late' FROM shaped WHERE date < '2024-01-11'""",
        ),
        "ST1",
    ),
    "stream_pipeline": Query(
        stream_pipeline,
        with_fixtures(
            "bindings_stream bindings_stream_draft taxonomy_raw part_payloads",
            "WITH "
            + _mapping_sql("bindings_stream").lstrip()
            + """, shaped AS (SELECT b.cellarURIs AS url, coalesce(split_part(b.celexIds, '|||', 1), '') AS celex, split_part(b.title, '|||', 1) AS title,
                    split_part(r.title, '|||', 1) AS draft, b.date, contains(b.mtypes, 'pdf') AS has_pdf,
                    CASE WHEN try_cast(b.date AS date) IS NULL THEN 'unparsable' WHEN b.date > '2024-01-30' THEN 'future' WHEN b.date < '2024-01-11' THEN 'late' ELSE 'day' END AS place
                  FROM listed b JOIN mapped USING (cellarURIs) JOIN bindings_stream_draft r USING (cellarURIs)),
                  asked AS (SELECT s.*, p.content AS text FROM shaped s LEFT JOIN part_payloads p USING (url) WHERE place = 'day' AND has_pdf),
                  kept AS (SELECT *, row_number() OVER (PARTITION BY date, celex ORDER BY url DESC) AS rn FROM asked WHERE text IS NOT NULL)
                  SELECT place, url, celex, title, date, text, regexp_matches(text, '(?i)part 1') AS match_part_1, regexp_matches(text, '(?i)steel') AS match_steel FROM kept WHERE rn = 1
                  UNION ALL SELECT place, url, celex, title, date, NULL, NULL, NULL FROM shaped WHERE place <> 'day'
                  UNION ALL SELECT place, url, celex, draft, date, NULL, NULL, NULL FROM shaped WHERE place <> 'day'
                  UNION ALL SELECT 'no payload', url, celex, title, date, NULL, NULL, NULL FROM asked WHERE text IS NULL""",
        ),
        "ST1 T6 K2 D1 R13",
    ),
}
