"""Documents by day or by range, with a manifest that tells empty, failed and missing days apart.

Layout: ``files/year=/day=/scope=/_run=``, where ``day`` is the mined day (a document's own date may
differ), ``scope`` the language filter of the run, or ``all``, and ``_run`` one attempt of a run.
Attempts only ever add files. The manifest entry, written last, is the switch: a run that dies
before it leaves everything as it was, and a day that became empty has an entry that says so.
Entries are ordered by a number, one above the largest so far, never by the text of run ids; one
writer at a time is assumed. Files of superseded attempts stay until ``superseded`` is cleaned up.
"""

import json
import posixpath
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquarry.operators.ranking import keep_first
from docquarry.schemas import MANIFEST_SCHEMA, PROBLEM_SCHEMA, RANGE_MANIFEST_SCHEMA, conform
from docquarry.settings import shared_dir, shuffles_dropped
from docquarry.sources.tables import read_or_empty, stored

RUN = "_run"
ALL_LANGUAGES = "all"
_TO = " to "


@dataclass(frozen=True)
class Corpus:
    """Where one corpus keeps its tables."""

    root: str
    #: Buckets of the extraction results; the corpus keeps the number it began with.
    buckets: int = 256

    @property
    def files(self) -> str:
        return posixpath.join(self.root, "files")

    @property
    def ranges(self) -> str:
        return posixpath.join(self.root, "ranges")

    @property
    def manifest(self) -> str:
        return posixpath.join(self.root, "manifest")

    @property
    def range_manifest(self) -> str:
        return posixpath.join(self.root, "range-manifest")

    @property
    def extracted(self) -> str:
        return posixpath.join(self.root, "extracted")

    @property
    def problems(self) -> str:
        return posixpath.join(self.root, "problems")

    @property
    def late(self) -> str:
        return posixpath.join(self.root, "late")


def scope_of(lang: str | None) -> str:
    """Partition label of a language filter."""
    return lang.lower() if lang else ALL_LANGUAGES


#: Partitions that one write counts on its way: 134 years of days. The sketch is exact up to three quarters of its size.
COUNTED = 49_152


def _write_partitions(df: DataFrame, path: str, partition_by: Sequence[str], counted: Column | None = None) -> dict[str, int] | None:
    """Add the rows; with ``counted`` also return how many were written for each of its values, null left out.

    The rows are counted by the tasks that write them, so nothing is listed or read again. None is
    returned for more values than can be counted so.
    """
    # Rebalancing gives a small day one file and splits a day that holds much of the data over
    # several tasks; a plain repartition by day would put such a day into one task.
    balanced = df.hint("rebalance", *partition_by)
    seen = Observation()
    if counted is not None:
        size = COUNTED // 3 * 4
        # Above the shuffle, in the tasks of the write: a map stage run again would count twice.
        balanced = balanced.observe(seen, F.call_function("approx_top_k", counted, F.lit(COUNTED), F.lit(size)).alias("counts"))
    with shuffles_dropped(df.sparkSession):
        balanced.write.mode("append").partitionBy(*partition_by).parquet(path)
    if counted is None:
        return None
    counts = seen.get["counts"] or []
    return None if len(counts) >= COUNTED else {c["item"]: c["count"] for c in counts if c["item"] is not None}


def _counted_in_files(spark: SparkSession, path: str, keys: Sequence[str], attempt: str) -> DataFrame:
    """The stored rows of an attempt, partition columns only."""
    return read_or_empty(spark, path, T.StructType([T.StructField(c, T.StringType()) for c in keys])).filter(F.col(RUN) == attempt)


def _attempt(manifest: DataFrame, run_id: str) -> tuple[int, str]:
    """The number and the label of the next attempt. A replayed run gets new ones."""
    return (manifest.agg(F.max("seq")).first()[0] or 0) + 1, f"{run_id}~{uuid.uuid4().hex[:12]}"


def _stamped(entries: DataFrame, docs: DataFrame, scope: str, run_id: str, seq: int, attempt: str) -> DataFrame:
    """Manifest columns that all entries of an attempt share; ``columns`` is the schema of its rows."""
    return entries.select(
        "*", F.lit(scope).alias("scope"), F.lit(run_id).alias("run_id"), F.lit(seq).cast("long").alias("seq"), F.lit(attempt).alias("attempt"), F.lit(docs.schema.json()).alias("columns")
    )


def planned_days(days: DataFrame, discovered: DataFrame | None = None, errors: DataFrame | None = None) -> DataFrame:
    """``(day, discovered, error)``: days of a run, documents found per day, failed days.

    ``discovered`` is ``(day, discovered)``, ``errors`` is ``(day, error)``; both may be left out.
    """
    out = days.select("day")
    out = out.join(discovered, "day", "left") if discovered is not None else out.withColumn("discovered", F.lit(None))
    out = out.join(errors, "day", "left") if errors is not None else out.withColumn("error", F.lit(None))
    return out.select("day", F.col("discovered").cast("long"), F.col("error").cast("string"))


_PROBLEM_KEYS = ("year", "window_start", "scope", RUN)


def _write_problems(problems: DataFrame | None, corpus: Corpus, scope: str, attempt: str) -> None:
    """What the attempt set aside, ``PROBLEM_SCHEMA`` with ``window_start``; the attempt's entry makes it count."""
    if problems is not None:
        rows = conform(problems, T.StructType([*PROBLEM_SCHEMA, T.StructField("window_start", T.StringType())]))
        rows = rows.withColumns({"scope": F.lit(scope), RUN: F.lit(attempt), "year": F.substring("window_start", 1, 4)})
        _write_partitions(rows, corpus.problems, _PROBLEM_KEYS)


def read_problems(spark: SparkSession, corpus: Corpus) -> DataFrame:
    """What the latest attempt at each day or range set aside, with its ``window_start`` and ``scope``."""
    schema = T.StructType([*PROBLEM_SCHEMA, *[T.StructField(c, T.StringType()) for c in _PROBLEM_KEYS]])
    days = current_manifest(spark, corpus, with_errors=True).select(F.col("day").alias("window_start"), "scope", F.col("attempt").alias(RUN))
    ranges = keep_first(read_or_empty(spark, corpus.range_manifest, RANGE_MANIFEST_SCHEMA), ["window_start", "window_end", "scope"], [F.desc("seq")])
    latest = days.unionByName(ranges.select("window_start", "scope", F.col("attempt").alias(RUN)))
    rows = read_or_empty(spark, corpus.problems, schema).join(latest, ["window_start", "scope", RUN], "left_semi")
    return rows.select("window_start", "scope", *PROBLEM_SCHEMA.fieldNames())


def write_days(
    docs: DataFrame, planned: DataFrame, corpus: Corpus, run_id: str, scope: str = ALL_LANGUAGES, problems: DataFrame | None = None
) -> DataFrame:
    """Add the days in ``docs``, then record every planned day; returns this attempt's entries.

    A planned day without documents gets an ``empty`` entry, one with an error an ``errors`` entry
    that leaves the stored day as it was. A run id may come again: the later attempt counts.
    ``docs`` must not hold days that are not planned. ``problems`` is stored with the same attempt.
    """
    spark = docs.sparkSession
    seq, attempt = _attempt(_entries(spark, corpus), run_id)
    rows = docs.withColumns({"scope": F.lit(scope), RUN: F.lit(attempt), "year": F.substring("day", 1, 4)})
    keys = ("year", "day", "scope", RUN)
    seen = _write_partitions(rows, corpus.files, keys, F.col("day").cast("string"))
    _write_problems(problems, corpus, scope, attempt)
    if seen is None:
        counts = _counted_in_files(spark, corpus.files, keys, attempt).groupBy("day").agg(F.count("*").alias("n"))
    else:
        counts = spark.createDataFrame(list(seen.items()), "day string, n long")
    entries = planned.join(counts, "day", "left")
    status = (
        F.when(F.col("error").isNotNull(), "errors")
        .when((F.coalesce("discovered", F.lit(0)) > 0) | (F.col("n") > 0), "rows")
        .otherwise("empty")
    )
    entries = entries.select("day", status.alias("status"), F.when(F.col("error").isNull(), F.coalesce("n", F.lit(0))).alias("n_rows"), "error")
    entries = _stamped(entries, docs, scope, run_id, seq, attempt).select(*MANIFEST_SCHEMA.fieldNames())
    entries.coalesce(1).write.mode("append").parquet(corpus.manifest)
    return _entries(spark, corpus).filter(F.col("attempt") == attempt)


def _entries(spark: SparkSession, corpus: Corpus) -> DataFrame:
    return read_or_empty(spark, corpus.manifest, MANIFEST_SCHEMA)


def read_manifest(spark: SparkSession, corpus: Corpus) -> DataFrame:
    """One entry per run, day and scope: of a run that was replayed, the last."""
    return keep_first(_entries(spark, corpus), ["run_id", "day", "scope"], [F.desc("seq")])


def current_manifest(spark: SparkSession, corpus: Corpus, with_errors: bool = False) -> DataFrame:
    """The latest entry per day and scope; failed attempts count only ``with_errors``."""
    entries = _entries(spark, corpus)
    if not with_errors:
        entries = entries.filter("status <> 'errors'")
    return keep_first(entries, ["day", "scope"], [F.desc("seq")])


def superseded(spark: SparkSession, corpus: Corpus) -> DataFrame:
    """(day, scope, _run) of stored partitions that no entry points to any more, for a clean-up to drop."""
    names = ("year", "day", "scope", RUN)
    stored_parts = read_or_empty(spark, corpus.files, T.StructType([T.StructField(c, T.StringType()) for c in names]))
    valid = current_manifest(spark, corpus).select("day", "scope", F.col("attempt").alias(RUN))
    return stored_parts.select("day", "scope", RUN).distinct().join(valid, ["day", "scope", RUN], "left_anti")


def manifest_inventory(spark: SparkSession, corpus: Corpus, scope: str = ALL_LANGUAGES) -> DataFrame:
    """Inventory ``(date, path, num_rows)`` from the manifest, no file touched; failed days have
    no row count."""
    current = current_manifest(spark, corpus, with_errors=True).filter(F.col("scope") == scope)
    return current.select(F.col("day").alias("date"), F.lit(corpus.files).alias("path"), F.col("n_rows").alias("num_rows"))


def corpus_schema(spark: SparkSession, corpus: Corpus, days: DataFrame | None = None) -> T.StructType:
    """All columns that the valid days have, or those of ``days`` (day); jobs may differ in their keywords."""
    entries = current_manifest(spark, corpus)
    if days is not None:
        entries = entries.join(days.select("day"), "day", "left_semi")
    # One row per set of columns. The later attempt settles a type.
    rows = entries.groupBy("columns").agg(F.max("seq").alias("seq")).orderBy(F.desc("seq")).collect()
    return union_schema(*[T.StructType.fromJson(json.loads(r["columns"])) for r in rows])


def union_schema(*schemas: T.StructType) -> T.StructType:
    """The fields of all schemas by name, the first of a name."""
    fields: dict[str, T.StructField] = {}
    for schema in schemas:
        for field in schema:
            fields.setdefault(field.name, T.StructField(field.name, field.dataType))
    return T.StructType(list(fields.values()))


def read_days(spark: SparkSession, corpus: Corpus, schema: T.StructType | None = None) -> DataFrame:
    """Documents of all valid days, with ``day`` and ``scope``; by default with every column stored."""
    schema = corpus_schema(spark, corpus) if schema is None else schema
    keys = ("day", "scope", RUN)
    names = [n for n in schema.fieldNames() if n not in (*keys, "year")]
    full = T.StructType([*[schema[n] for n in names], *[T.StructField(n, T.StringType()) for n in ("year", "day", "scope", RUN)]])
    rows = read_or_empty(spark, corpus.files, full)
    valid = current_manifest(spark, corpus).select("day", "scope", F.col("attempt").alias(RUN))
    return rows.join(valid, list(keys), "left_semi").select(*names, "day", "scope")


def sql_over_days(spark: SparkSession, corpus: Corpus, query: str, view: str = "documents") -> DataFrame:
    """Run ``query`` over the valid days of a corpus, seen as the view ``view``."""
    read_days(spark, corpus).createOrReplaceTempView(view)
    return spark.sql(query)


def write_ranges(
    docs: DataFrame,
    corpus: Corpus,
    run_id: str,
    windows: DataFrame | None = None,
    scope: str = ALL_LANGUAGES,
    errors: DataFrame | None = None,
    problems: DataFrame | None = None,
) -> DataFrame:
    """Windows wider than a day: one partition per window and attempt, in the year of its first day.

    ``windows`` (start, end) names all windows of the run, so that one without documents gets an ``empty``
    entry; by default they are those of ``docs``. A window in ``errors`` (day: its start, error) gets an
    ``errors`` entry, which hides no older documents. Range partitions have no ``day`` and so are
    invisible to inventory and backfill. Returns this attempt's entries.
    """
    spark = docs.sparkSession
    seq, attempt = _attempt(read_or_empty(spark, corpus.range_manifest, RANGE_MANIFEST_SCHEMA), run_id)
    rows = docs.withColumns({"scope": F.lit(scope), RUN: F.lit(attempt), "year": F.substring("window_start", 1, 4)})
    keys = ("year", "window_start", "window_end", "scope", RUN)
    seen = _write_partitions(rows, corpus.ranges, keys, F.concat("window_start", F.lit(_TO), "window_end"))
    _write_problems(problems, corpus, scope, attempt)
    if seen is None:
        counts = _counted_in_files(spark, corpus.ranges, keys, attempt).groupBy("window_start", "window_end").agg(F.count("*").alias("n_rows"))
    else:
        windows_seen = [(*window.split(_TO), n) for window, n in seen.items()]
        counts = spark.createDataFrame(windows_seen, "window_start string, window_end string, n_rows long")
    entries = counts if windows is None else windows.select(F.col("start").alias("window_start"), F.col("end").alias("window_end")).join(counts, ["window_start", "window_end"], "left")
    if errors is None:
        entries = entries.withColumn("error", F.lit(None).cast("string"))
    else:
        entries = entries.join(errors.select(F.col("day").alias("window_start"), F.col("error").cast("string")), "window_start", "left")
    n, good = F.coalesce("n_rows", F.lit(0)).cast("long"), F.col("error").isNull()
    status = F.when(~good, "errors").when(n > 0, "rows").otherwise("empty")
    entries = entries.select("window_start", "window_end", status.alias("status"), F.when(good, n).alias("n_rows"), "error")
    entries = _stamped(entries, docs, scope, run_id, seq, attempt).select(*RANGE_MANIFEST_SCHEMA.fieldNames())
    entries.coalesce(1).write.mode("append").parquet(corpus.range_manifest)
    return read_or_empty(spark, corpus.range_manifest, RANGE_MANIFEST_SCHEMA).filter(F.col("attempt") == attempt)


def range_entries(spark: SparkSession, corpus: Corpus) -> DataFrame:
    """All entries of all attempts at ranges."""
    return read_or_empty(spark, corpus.range_manifest, RANGE_MANIFEST_SCHEMA)


def read_ranges(spark: SparkSession, corpus: Corpus, date: str = "date") -> DataFrame:
    """Documents of the valid ranges.

    The last attempt that covers a day gives its documents: a row of an older window counts if its
    ``date`` (outside the window, the window's start) lies in no window of a later attempt of its scope. So a
    window that became empty hides its older rows, and windows that a later run shifts do not
    overlap.
    """
    entries = range_entries(spark, corpus).filter("status <> 'errors'")
    entries = keep_first(entries, ["window_start", "window_end", "scope", "attempt"], [F.desc("seq")])
    schemas = entries.groupBy("columns").agg(F.max("seq").alias("seq")).orderBy(F.desc("seq")).collect()
    schema = union_schema(*[T.StructType.fromJson(json.loads(r["columns"])) for r in schemas])
    keys = ("year", "window_start", "window_end", "scope", RUN)
    names = [n for n in schema.fieldNames() if n not in keys]
    rows = read_or_empty(spark, corpus.ranges, T.StructType([*[schema[n] for n in names], *[T.StructField(n, T.StringType()) for n in keys]]))
    later = entries.select(F.col("window_start").alias("from"), F.col("window_end").alias("to"), F.col("scope").alias("of"), F.col("seq").alias("later"))
    overlaps = (F.col("of") == F.col("scope")) & (F.col("later") > F.col("seq")) & (F.col("from") <= F.col("window_end")) & (F.col("to") >= F.col("window_start"))
    # A row per entry; windows are as many as the calendar and the runs make them. A written table, so that Spark sees how
    # small it is: by the estimate of the overlap join, all documents would be shuffled by window, each window into one task.
    known = entries.join(later, overlaps, "left").groupBy("window_start", "window_end", "scope", F.col("attempt").alias(RUN)).agg(
        F.collect_list(F.when(F.col("from").isNotNull(), F.struct("from", "to"))).alias("_later")
    )
    known = stored(known, shared_dir(spark, "known-ranges"))
    day = F.col("window_start")
    if date in names:
        day = F.when(F.col(date).between(F.col("window_start"), F.col("window_end")), F.col(date)).otherwise(day)
    valid = rows.join(known, ["window_start", "window_end", "scope", RUN]).withColumn("_day", day)
    valid = valid.filter(~F.exists("_later", lambda w: (w["from"] <= F.col("_day")) & (w["to"] >= F.col("_day"))))
    return valid.select(*names, "year", "window_start", "window_end", "scope")
