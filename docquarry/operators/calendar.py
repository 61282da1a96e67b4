"""Lookback windows and calendars."""

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.functions.dates import as_date, iso


def _days_back(date: Column, today: datetime.date) -> Column:
    return F.datediff(F.lit(today), date)


def window_no(date: Column, today: datetime.date, total_days: int, step: int) -> Column:
    """Number of the window a date falls into, 0 the newest; null outside the lookback.

    Plain arithmetic, so window work is an equi-key ``groupBy`` and never a range join.
    """
    back = _days_back(date, today)
    return F.when((back >= 0) & (back < total_days), F.floor(back / step).cast("int"))


def window_start(no: Column, today: datetime.date, total_days: int, step: int) -> Column:
    """First day of a window as ISO text; the oldest window may be short."""
    oldest = F.least(no * step + step, F.lit(total_days)) - 1
    return iso(F.date_sub(F.lit(today), oldest.cast("int")))


def window_end(no: Column, today: datetime.date, step: int) -> Column:
    return iso(F.date_sub(F.lit(today), (no * step).cast("int")))


def lookback_windows(spark: SparkSession, today: datetime.date, total_days: int, step: int = 1) -> DataFrame:
    """``(window_no, start, end, n_days)`` for ``total_days`` up to today, newest first."""
    no = F.col("id").cast("int")
    return spark.range(0, -(-total_days // step)).select(
        no.alias("window_no"),
        window_start(no, today, total_days, step).alias("start"),
        window_end(no, today, step).alias("end"),
        F.least(F.lit(step), F.lit(total_days) - no * step).cast("int").alias("n_days"),
    )


def with_window(
    df: DataFrame, today: datetime.date, total_days: int, step: int = 1, date: str = "date"
) -> DataFrame:
    """Rows inside the lookback with their ``window_no``, ``window_start`` and ``window_end``."""
    no = window_no(as_date(F.col(date)), today, total_days, step)
    return with_window_bounds(df.withColumn("window_no", no).filter("window_no IS NOT NULL"), today, total_days, step)


def with_window_bounds(df: DataFrame, today: datetime.date, total_days: int, step: int = 1) -> DataFrame:
    """Bounds for rows that carry a ``window_no``."""
    return df.withColumns(
        {
            "window_start": window_start(F.col("window_no"), today, total_days, step),
            "window_end": window_end(F.col("window_no"), today, step),
        }
    )


def window_metrics(discovered: DataFrame, saved: Column) -> DataFrame:
    """Per window: documents discovered, and records for which ``saved`` holds."""
    return discovered.groupBy("window_no", "window_start", "window_end").agg(
        F.count("*").alias("discovered"), F.count_if(saved).alias("saved")
    )


def calendar(bounds: DataFrame, first: str = "first_day", last: str = "last_day") -> DataFrame:
    """One row per day, both ends included, from a one-row frame of two dates; none if they are
    in the wrong order or null."""
    end = F.greatest(first, last)  # a sequence must not run backwards
    days = bounds.select(last, F.explode(F.sequence(F.col(first), end, F.expr("interval 1 day"))).alias("day"))
    return days.filter(F.col("day") <= F.col(last)).select(iso(F.col("day")).alias("date"))


def calendar_between(spark: SparkSession, first: datetime.date, last: datetime.date) -> DataFrame:
    bounds = spark.range(1).select(F.lit(first).alias("first_day"), F.lit(last).alias("last_day"))
    return calendar(bounds)


def distinct_dates(df: DataFrame, date: Column | str = "date") -> DataFrame:
    """Distinct dates as ISO text, in order."""
    column = F.col(date) if isinstance(date, str) else date
    return df.select(column.alias("date")).filter("date IS NOT NULL").distinct().orderBy("date")
