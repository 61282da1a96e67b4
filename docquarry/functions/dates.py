"""Dates: driver-side parameters as ``datetime.date``, columns as ISO text."""

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_DATE = r"\d{4}-\d{2}-\d{2}"


def parse_iso(value: str | datetime.date, name: str) -> datetime.date:
    """A job parameter as a date; anything but YYYY-MM-DD is an error that names the parameter."""
    if isinstance(value, datetime.date):
        return value
    try:
        return datetime.datetime.strptime(value, "%Y-%m-%d").date()
    except (TypeError, ValueError) as exc:
        raise ValueError(f"invalid {name} {value!r}: expected YYYY-MM-DD") from exc


def iso(col: Column) -> Column:
    """A date column as ``yyyy-MM-dd`` text."""
    return F.date_format(col, "yyyy-MM-dd")


def as_date(col: Column) -> Column:
    """ISO text as a date; null where it is none."""
    return F.try_to_date(col, "yyyy-MM-dd")


def date_in_name(name: Column, prefix: str = "dataset_") -> Column:
    """First date that directly follows ``prefix`` anywhere in a file name, else null."""
    found = F.regexp_extract(name, rf"\Q{prefix}\E({ISO_DATE})", 1)
    return F.when(found != "", found)


def day_of_file(path: Column, prefix: str, suffix: str = "") -> Column:
    """Date of a daily file ``{prefix}{date}{suffix}.parquet``; null for range files and others."""
    base = F.element_at(F.split(path, "/"), -1)
    found = F.regexp_extract(base, rf"\A\Q{prefix}\E({ISO_DATE})\Q{suffix}.parquet\E\z", 1)
    return F.when(found != "", found)
