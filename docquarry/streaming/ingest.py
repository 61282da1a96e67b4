"""Incremental mining of landed metadata results with Structured Streaming.

A batch goes through the steps of the mining job: shape, extract, clean, match, dedup. Its rows are
merged into the stored days, so a day that arrives in several batches ends as if it had come at once.
"""

import datetime
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docquarry.functions.dates import as_date
from docquarry.functions.text import filter_keyword_matches
from docquarry.operators.calendar import window_no
from docquarry.operators.dedup import dedup_keep_last
from docquarry.operators.extract import DEFAULT_EXTRACTORS, Extractors
from docquarry.operators.shape import binding_lists, quarantine_rows, shape_documents
from docquarry.plans.mine import MineParams, add_matches, attach_text, drop_repeated, extract_new, extraction_errors, located, set_aside
from docquarry.settings import shared_dir
from docquarry.sinks.daily import ALL_LANGUAGES, Corpus, corpus_schema, planned_days, read_days, union_schema, write_days
from docquarry.sources.tables import stored

DOCUMENT_KEY = ("url", "date", "lang")


def merge_days(
    docs: DataFrame,
    corpus: Corpus,
    run_id: str,
    key: Sequence[str] = DOCUMENT_KEY,
    scope: str = ALL_LANGUAGES,
    dedup: Callable[[DataFrame], DataFrame] | None = None,
    problems: DataFrame | None = None,
) -> DataFrame:
    """Merge ``docs`` (a stored table with ``day``) into the stored days they touch; a newer row
    replaces an older one with the same key. Running it twice gives the same days. ``dedup`` is applied
    to the merged days, stored rows included; ``problems`` is stored with the attempt.

    Only the partitions of the affected days are read (the days pass through the driver; there are
    no more of them than the calendar has), and the merged rows are staged, as they replace what
    they were read from.
    """
    spark = docs.sparkSession
    days = docs.select("day").distinct()
    if problems is not None:
        # A day that has only problems is merged too: its entry must not hide what is stored.
        days = days.union(problems.select(F.col("window_start").alias("day"))).distinct()
    touched = F.col("day").isin([row.day for row in days.collect()])
    # The stored days may have columns that the batch lacks, as text and matches. They stay: a day
    # is never written with fewer columns, and a newer row keeps what it does not know itself.
    schema = union_schema(docs.schema, corpus_schema(spark, corpus, days))
    lacking = [c for c in schema.fieldNames() if c not in docs.columns]
    old = read_days(spark, corpus, schema).filter((F.col("scope") == scope) & touched).drop("scope")
    both = old.withColumn("_new", F.lit(0)).unionByName(docs.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    both = both.withColumn("_key", F.struct(*key))
    # Rows of one batch with one key differ at most in content; a digest settles which stays.
    both = both.withColumn("_tie", F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))
    if lacking:
        same = Window.partitionBy("day", "_key").orderBy("_new", "_tie").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        both = both.withColumns({c: F.coalesce(F.col(f"`{c}`"), F.last(F.col(f"`{c}`"), ignorenulls=True).over(same)) for c in lacking})
    merged = dedup_keep_last(both, "_key", ("_new", "_tie"), within=("day",)).drop("_key", "_new", "_tie")
    merged = stored(merged if dedup is None else dedup(merged), shared_dir(spark, f"merge-{run_id}"))
    return write_days(merged, planned_days(days), corpus, run_id, scope, problems)


def place_of(date: Column, today: datetime.date, lookback_days: int) -> Column:
    """Where a row goes by its date: ``day`` in the lookback, else ``late``, ``future`` or ``unparsable``."""
    day = as_date(date)
    return (
        F.when(day.isNull(), "unparsable")
        .when(day > F.lit(today), "future")
        .when(window_no(day, today, lookback_days, 1).isNull(), "late")
        .otherwise("day")
    )


def _mined_batch(docs: DataFrame, payloads: DataFrame, params: MineParams, corpus: Corpus, run_id: str, extractors: Extractors) -> tuple[DataFrame, DataFrame]:
    """Documents of a batch with text and matches, and those without text."""
    results = extract_new(docs, payloads, corpus, run_id, extractors)
    found = stored(located(docs, results), shared_dir(docs.sparkSession, f"located-{run_id}"))
    return add_matches(attach_text(found, results), params), extraction_errors(docs, results, run_id)


def ingest_batch(
    bindings: DataFrame,
    batch_id: int,
    taxonomy: DataFrame,
    corpus: Corpus,
    today: datetime.date,
    lookback_days: int,
    run_prefix: str,
    payloads: DataFrame | None = None,
    params: MineParams | None = None,
    extractors: Extractors = DEFAULT_EXTRACTORS,
) -> None:
    """Mine one batch: merge days inside the lookback, set other rows aside by the reason.

    Without ``payloads`` only metadata are merged. With them rows get their text and matches as
    ``params`` says; a document without text is a problem of its day, and so is a row that lacks required
    fields. Keep-last runs over the merged days. The filter on matches comes last, so it may drop a
    survivor, as in the job; a row dropped by it is not there to survive a later batch.
    """
    spark = bindings.sparkSession
    run_id, base = f"{run_prefix}-{batch_id:012d}", shared_dir(spark, f"batch-{batch_id}")
    # Read once: the files of the batch are parsed here and nowhere else.
    metadata = stored(binding_lists(bindings), f"{base}/bindings")
    where = place_of(F.col("date"), today, lookback_days)
    placed = stored(shape_documents(metadata, taxonomy).withColumn("place", where), f"{base}/documents")
    flawed = stored(quarantine_rows(metadata, taxonomy).withColumn("place", where), f"{base}/quarantine")
    # One folder per batch: a batch that is replayed overwrites its own rows.
    aside = placed.unionByName(flawed, allowMissingColumns=True).filter("place <> 'day'")
    aside.write.mode("overwrite").partitionBy("place").parquet(f"{corpus.late}/batch={batch_id}")

    docs = placed.filter("place = 'day'").drop("place")
    problems = flawed.filter("place = 'day'").withColumn("window_start", F.col("date"))
    dedup, failed = None, problems.limit(0)
    if payloads is not None:
        params = params or MineParams(today=today)
        docs, failed = _mined_batch(docs, payloads, params, corpus, run_id, extractors)
        failed = failed.withColumn("window_start", F.col("date"))

        def dedup(days: DataFrame) -> DataFrame:
            kept = drop_repeated(days, params, ("day",))
            return filter_keyword_matches(kept, params.keywords) if params.only_matches else kept

    problems = stored(set_aside(problems, failed, ("window_start",)), f"{base}/problems")
    docs = stored(docs.withColumn("day", F.col("date")), f"{base}/mined")
    if docs.isEmpty() and problems.isEmpty():
        return
    merge_days(docs, corpus, run_id, dedup=dedup, problems=problems)


def ingest_stream(
    bindings: DataFrame,
    taxonomy: DataFrame,
    corpus: Corpus,
    today: datetime.date,
    lookback_days: int,
    checkpoint: str,
    run_prefix: str = "stream",
    payloads: DataFrame | None = None,
    params: MineParams | None = None,
    extractors: Extractors = DEFAULT_EXTRACTORS,
) -> StreamingQuery:
    """Process all newly landed files, then stop. Restarting goes on where the last run ended."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        ingest_batch(batch, batch_id, taxonomy, corpus, today, lookback_days, run_prefix, payloads, params, extractors)

    writer = bindings.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def read_aside(spark: SparkSession, corpus: Corpus) -> DataFrame:
    """Rows of no day of the lookback, with ``batch`` and ``place``: ``late``, ``future`` or ``unparsable``;
    ``missing`` names the required fields that a row lacks, null if none."""
    return spark.read.parquet(corpus.late)


def read_late(spark: SparkSession, corpus: Corpus) -> DataFrame:
    """Rows that arrived for days before the lookback."""
    return read_aside(spark, corpus).filter("place = 'late' AND missing IS NULL").drop("place", "missing")
