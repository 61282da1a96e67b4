"""Gap detection, backfill plan, completeness and run reports."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docquarry.functions.dates import as_date, iso
from docquarry.operators.calendar import calendar


def found_range(dates: DataFrame) -> DataFrame:
    """One row with the first and the last date of a frame of ISO dates."""
    return dates.agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"))


def _full_calendar(dates: DataFrame) -> DataFrame:
    return calendar(
        found_range(dates).select(
            as_date(F.col("first_date")).alias("first_day"), as_date(F.col("last_date")).alias("last_day")
        )
    )


def calendar_gaps(dates: DataFrame) -> DataFrame:
    """Days between the first and the last date that do not occur."""
    return _full_calendar(dates).join(dates.select("date").distinct(), "date", "left_anti")


def completeness_report(dates: DataFrame) -> DataFrame:
    """First and last date, unique days, number of gaps: the range less the days found."""
    return dates.agg(
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.count_distinct("date").alias("unique_days"),
    ).withColumn(
        "n_gaps",
        F.datediff(as_date(F.col("last_date")), as_date(F.col("first_date"))) + 1 - F.col("unique_days"),
    )


def first_gaps(dates: DataFrame, n: int = 20) -> DataFrame:
    """The report's gap lines: the first ``n`` gaps, then one row with how many more there are."""
    gaps = calendar_gaps(dates)
    shown = gaps.orderBy("date").limit(n).select("date", F.lit(None).cast("long").alias("n_more"))
    rest = gaps.agg((F.count("*") - n).alias("n_more")).filter(F.col("n_more") > 0)
    return shown.unionByName(rest.select(F.lit(None).cast("string").alias("date"), "n_more"))


def classify_days(days: DataFrame, inventory: DataFrame, unreadable_is_present: bool = False) -> DataFrame:
    """Each calendar day with its status: ``missing``, ``empty``, ``present`` or ``unreadable``.

    A file whose row count cannot be read is ``unreadable`` and planned like a missing one;
    ``unreadable_is_present`` counts it present.
    """
    unreadable = "present" if unreadable_is_present else "unreadable"
    known = inventory.select("date", "num_rows", F.lit(True).alias("has_file"))
    status = (
        F.when(F.col("has_file").isNull(), "missing")
        .when(F.col("num_rows").isNull(), unreadable)
        .when(F.col("num_rows") == 0, "empty")
        .otherwise("present")
    )
    return days.join(known, "date", "left").select("date", status.alias("status"))


def _planned(status: Column, retry_empty: bool) -> Column:
    reason = F.when(status.isin("missing", "unreadable"), "missing")
    return reason.when(status == "empty", "empty") if retry_empty else reason


def plan_days(classified: DataFrame, retry_empty: bool = False) -> DataFrame:
    """``(date, reason)`` of the days to fetch, oldest first."""
    return (
        classified.select("date", _planned(F.col("status"), retry_empty).alias("reason"))
        .filter("reason IS NOT NULL")
        .orderBy("date")
    )


def plan_summary(classified: DataFrame, retry_empty: bool = False) -> DataFrame:
    """One row of counts over the whole range."""
    reason = _planned(F.col("status"), retry_empty)
    return classified.agg(
        F.count("*").alias("n_total"),
        F.count(reason).alias("to_fetch"),
        F.count_if(reason == "missing").alias("n_missing"),
        F.count_if(reason == "empty").alias("n_empty_retry"),
        F.count_if(F.col("status") == "present").alias("skipped_present"),
        F.count_if((F.col("status") == "empty") & reason.isNull()).alias("skipped_empty"),
    )


def run_summary(run_log: DataFrame) -> DataFrame:
    """One row: days attempted, by outcome, and the dates that failed or stayed empty."""
    return run_log.agg(
        F.count("*").alias("attempted"),
        F.count_if(F.col("status") == "rows").alias("with_rows"),
        F.count_if(F.col("status") == "empty").alias("still_empty"),
        F.count_if(F.col("status") == "errors").alias("n_errors"),
        F.array_sort(F.collect_list(F.when(F.col("status") == "errors", F.struct("date", "error")))).alias("errored"),
        F.array_sort(F.collect_list(F.when(F.col("status") == "empty", F.col("date")))).alias("empty_dates"),
    )


def select_planned(docs: DataFrame, plan: DataFrame, day: str = "date") -> DataFrame:
    """Documents of the planned days only, for one job over all of them."""
    return docs.join(plan.select(F.col("date").alias(day)), day, "left_semi")


def iso_days(timestamps: Column) -> Column:
    return iso(timestamps.cast("date"))
