"""Calendar, gaps, backfill planning, reports, changed partitions."""

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.functions.cells import join_cell
from docquarry.operators import gaps
from docquarry.operators.calendar import calendar_between, distinct_dates, lookback_windows, window_metrics, with_window
from docquarry.operators.changes import changed_partitions, partition_digests
from docquarry.plans.backfill import BackfillParams, plan_backfill
from docquarry.sources.files import daily_inventory, dates_in_names
from queries import Query
from queries.fixtures import fixture, with_fixtures

TODAY = datetime.date(2024, 1, 30)
TOTAL_DAYS, STEP = 30, 7
BACKFILL_TODAY = datetime.date(2001, 8, 15)


def windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_window(fixture(spark, sf_dir, "docs").select("date"), TODAY, TOTAL_DAYS, STEP)
    counts = docs.groupBy("window_no").agg(F.count("*").alias("n"))
    joined = lookback_windows(spark, TODAY, TOTAL_DAYS, STEP).join(counts, "window_no", "left")
    return joined.select("window_no", "start", "end", "n_days", F.coalesce("n", F.lit(0)).alias("n_docs"))


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_window(fixture(spark, sf_dir, "docs").select("date", "text"), TODAY, TOTAL_DAYS, STEP)
    return window_metrics(docs, F.col("text").contains("thing"))


def _found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dates_in_names(fixture(spark, sf_dir, "file_names"))


def found_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_dates(_found(spark, sf_dir))


def calendar_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gaps.calendar_gaps(_found(spark, sf_dir))


def completeness_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gaps.completeness_report(_found(spark, sf_dir))


def first_20_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gaps.first_gaps(_found(spark, sf_dir), 20)


def _inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_inventory(fixture(spark, sf_dir, "listing"), "dataset_", "_eng")


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _inventory(spark, sf_dir)


def backfill_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan_backfill(_inventory(spark, sf_dir), BackfillParams(), BACKFILL_TODAY).days


_RETRY = BackfillParams(from_date="1994-12-25", to_date="2030-01-01", retry_empty=True)


def backfill_retry_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan_backfill(_inventory(spark, sf_dir), _RETRY, BACKFILL_TODAY).days


def backfill_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    without = plan_backfill(_inventory(spark, sf_dir), BackfillParams(), BACKFILL_TODAY).summary
    retry = plan_backfill(_inventory(spark, sf_dir), _RETRY, BACKFILL_TODAY).summary
    return without.withColumn("mode", F.lit("missing")).unionByName(retry.withColumn("mode", F.lit("retry")))


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = gaps.run_summary(fixture(spark, sf_dir, "run_log"))
    errored = F.transform("errored", lambda e: F.concat(e["date"], F.lit(": "), e["error"]))
    return summary.withColumns({"errored": join_cell(errored), "empty_dates": join_cell(F.col("empty_dates"))})


def backfill_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of the days that an older state of the corpus lacks or has empty."""
    known = fixture(spark, sf_dir, "docs_before").groupBy("date").agg(F.count("*").alias("n"))
    odd = F.dayofmonth("date") % 2
    known = known.select("date", F.lit("x").alias("path"), F.when(odd == 1, 0).otherwise(F.col("n")).alias("num_rows"))
    days = calendar_between(spark, datetime.date(2024, 1, 1), TODAY)
    plan = gaps.plan_days(gaps.classify_days(days, known), retry_empty=True)
    return gaps.select_planned(fixture(spark, sf_dir, "docs").select("url", "date", "text"), plan)


def changed_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = partition_digests(fixture(spark, sf_dir, "docs"), ["date"])
    before = partition_digests(fixture(spark, sf_dir, "docs_before"), ["date"])
    return changed_partitions(now, before, ["date"])


_FOUND_SQL = r"""found AS (SELECT regexp_extract(name, 'dataset_(\d{4}-\d{2}-\d{2})', 1) AS date FROM file_names
  WHERE regexp_matches(name, 'dataset_\d{4}-\d{2}-\d{2}')),
days AS (SELECT CAST(CAST(d AS date) AS string) AS date FROM generate_series(
  (SELECT CAST(min(date) AS date) FROM found), (SELECT CAST(max(date) AS date) FROM found), INTERVAL 1 DAY) s(d)),
gaps AS (SELECT date FROM days WHERE date NOT IN (SELECT date FROM found))"""

_INVENTORY_SQL = r"""inventory AS (
  SELECT date, path, num_rows FROM (
    SELECT *, row_number() OVER (PARTITION BY date ORDER BY num_rows DESC NULLS LAST, path) AS rn FROM (
      SELECT regexp_extract(path, '(^|/)dataset_(\d{4}-\d{2}-\d{2})_eng\.parquet$', 2) AS date, path, num_rows FROM listing) a
    WHERE date <> '') b WHERE rn = 1)"""


def _days_sql(first: str, last: str) -> str:
    return f"""{_INVENTORY_SQL},
classified AS (SELECT CAST(CAST(d AS date) AS string) AS date,
    CASE WHEN path IS NULL OR num_rows IS NULL THEN 'missing' WHEN num_rows = 0 THEN 'empty' ELSE 'present' END AS status
  FROM generate_series({first}, {last}, INTERVAL 1 DAY) s(d) LEFT JOIN inventory i ON i.date = CAST(CAST(d AS date) AS string))"""


_EARLIEST = "(SELECT CAST(min(date) AS date) FROM inventory)"
_LAST = f"DATE '{BACKFILL_TODAY}'"


def _counts_sql(mode: str, retry: bool) -> str:
    fetched = "status IN ('missing', 'empty')" if retry else "status = 'missing'"
    return f"""SELECT count(*) AS n_total, count(*) FILTER ({fetched}) AS to_fetch,
      count(*) FILTER (status = 'missing') AS n_missing, count(*) FILTER (status = 'empty' AND {retry}) AS n_empty_retry,
      count(*) FILTER (status = 'present') AS skipped_present, count(*) FILTER (status = 'empty' AND NOT {retry}) AS skipped_empty,
      '{mode}' AS mode FROM classified"""


_WINDOWS_SQL = f"""
wins AS (SELECT CAST(k AS int) AS window_no, DATE '{TODAY}' - CAST(k * {STEP} AS int) AS last,
           DATE '{TODAY}' - CAST(least(k * {STEP} + {STEP}, {TOTAL_DAYS}) - 1 AS int) AS first
         FROM generate_series(0, {(TOTAL_DAYS - 1) // STEP}) s(k))"""

QUERIES = {
    "lookback_windows": Query(
        windows,
        with_fixtures(
            "docs",
            f"""WITH {_WINDOWS_SQL.lstrip()}
            SELECT window_no, CAST(first AS string) AS start, CAST(last AS string) AS "end", CAST(last - first + 1 AS int) AS n_days,
              (SELECT count(*) FROM docs WHERE CAST(date AS date) BETWEEN first AND last) AS n_docs FROM wins""",
        ),
        "W1 W2",
    ),
    "window_metrics": Query(
        metrics,
        with_fixtures(
            "docs",
            f"""WITH {_WINDOWS_SQL.lstrip()}
            SELECT window_no, CAST(first AS string) AS window_start, CAST(last AS string) AS window_end, count(*) AS discovered,
              count(*) FILTER (contains(text, 'thing')) AS saved
            FROM wins JOIN docs ON CAST(date AS date) BETWEEN first AND last GROUP BY 1, 2, 3""",
        ),
        "W2 W3",
    ),
    "found_dates": Query(found_dates, with_fixtures("file_names", f"WITH {_FOUND_SQL} SELECT DISTINCT date FROM found"), "S7 R12 D7"),
    "calendar_gaps": Query(calendar_gaps, with_fixtures("file_names", f"WITH {_FOUND_SQL} SELECT date FROM gaps"), "S7 W4 D6"),
    "completeness_report": Query(
        completeness_report,
        with_fixtures(
            "file_names",
            f"""WITH {_FOUND_SQL} SELECT min(date) AS first_date, max(date) AS last_date, count(DISTINCT date) AS unique_days,
            (SELECT count(*) FROM gaps) AS n_gaps FROM found""",
        ),
        "B9",
    ),
    "first_20_gaps": Query(
        first_20_gaps,
        with_fixtures(
            "file_names",
            f"""WITH {_FOUND_SQL} SELECT * FROM (SELECT date, CAST(NULL AS bigint) AS n_more FROM gaps ORDER BY date LIMIT 20) t
            UNION ALL SELECT NULL, count(*) - 20 FROM gaps HAVING count(*) > 20""",
        ),
        "B10",
    ),
    "inventory": Query(inventory, with_fixtures("listing", f"WITH {_INVENTORY_SQL} SELECT date, path, num_rows FROM inventory"), "S5 S6 R12"),
    "backfill_plan": Query(
        backfill_plan,
        with_fixtures("listing", f"WITH {_days_sql(_EARLIEST, _LAST)} SELECT date, status AS reason FROM classified WHERE status = 'missing'"),
        "B1 B2 B3 B4 B6",
    ),
    "backfill_retry_empty": Query(
        backfill_retry_empty,
        with_fixtures(
            "listing", f"WITH {_days_sql("DATE '1994-12-25'", _LAST)} SELECT date, status AS reason FROM classified WHERE status <> 'present'"
        ),
        "B1 B2 B4",
    ),
    "backfill_summary": Query(
        backfill_summary,
        with_fixtures(
            "listing",
            f"""WITH {_days_sql(_EARLIEST, _LAST)} {_counts_sql("missing", False)} UNION ALL
            SELECT * FROM (WITH {_days_sql("DATE '1994-12-25'", _LAST)} {_counts_sql("retry", True)}) t""",
        ),
        "B5",
    ),
    "run_summary": Query(
        run_summary,
        with_fixtures(
            "run_log",
            """SELECT count(*) AS attempted, count(*) FILTER (status = 'rows') AS with_rows,
              count(*) FILTER (status = 'empty') AS still_empty, count(*) FILTER (status = 'errors') AS n_errors,
              coalesce(string_agg(date || ': ' || error, '|||' ORDER BY date) FILTER (status = 'errors'), '') AS errored,
              coalesce(string_agg(date, '|||' ORDER BY date) FILTER (status = 'empty'), '') AS empty_dates FROM run_log""",
        ),
        "B7",
    ),
    "backfill_select": Query(
        backfill_select,
        with_fixtures(
            "docs docs_before",
            """SELECT url, date, text FROM docs WHERE CAST(substr(date, 9, 2) AS int) % 2 = 1
               OR date NOT IN (SELECT date FROM docs_before)""",
        ),
        "B8",
    ),
    "changed_partitions": Query(
        changed_days,
        with_fixtures(
            "docs docs_before",
            """WITH a AS (SELECT date, string_agg(url || text || celex || lang || mtypes, '§' ORDER BY ord) AS h FROM docs GROUP BY 1),
               b AS (SELECT date, string_agg(url || text || celex || lang || mtypes, '§' ORDER BY ord) AS h FROM docs_before GROUP BY 1)
               SELECT date, CASE WHEN b.h IS NULL THEN 'new' WHEN a.h IS NULL THEN 'gone' WHEN a.h = b.h THEN 'unchanged' ELSE 'changed' END AS status
               FROM a FULL JOIN b USING (date)""",
        ),
        "O4",
    ),
}
