import datetime

import pytest

from docquarry.functions.dates import parse_iso
from docquarry.operators.calendar import calendar_between, lookback_windows, with_window
from docquarry.operators.gaps import calendar_gaps, classify_days, completeness_report, first_gaps, plan_days, plan_summary, run_summary
from docquarry.plans.backfill import BackfillParams, plan_backfill, resolve_range
from docquarry.schemas import INVENTORY_SCHEMA, RUN_LOG_SCHEMA
from docquarry.sources.files import daily_inventory, dates_in_names

TODAY = datetime.date(2024, 1, 10)


def inventory(spark, *rows):
    return spark.createDataFrame([(d, "p", n) for d, n in rows], INVENTORY_SCHEMA)


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize(("total", "step"), [(1, 1), (10, 1), (10, 3), (7, 7), (5, 9), (0, 1)])
def test_windows_tile_the_lookback(spark, total, step):
    windows = lookback_windows(spark, TODAY, total, step).orderBy("window_no").collect()
    want = []
    for i in range(0, total, step):
        n = min(step, total - i)
        start = TODAY - datetime.timedelta(days=i + n - 1)
        want.append((start.isoformat(), (start + datetime.timedelta(days=n - 1)).isoformat(), n))
    assert [(w.start, w.end, w.n_days) for w in windows] == want


@pytest.mark.parametrize("step", [1, 3, 30])
def test_every_date_falls_into_its_window(spark, step):
    days = calendar_between(spark, datetime.date(2023, 12, 1), datetime.date(2024, 2, 1))
    placed = with_window(days, TODAY, 20, step)
    assert placed.count() == 20
    assert placed.filter("date < window_start OR date > window_end").count() == 0


def test_gaps_and_report(spark):
    dates = spark.createDataFrame([("2024-01-01",), ("2024-01-05",), ("2024-01-05",), ("2024-01-03",)], "date string")
    assert sorted(rows(calendar_gaps(dates))) == [("2024-01-02",), ("2024-01-04",)]
    assert rows(completeness_report(dates)) == [("2024-01-01", "2024-01-05", 3, 2)]
    assert rows(first_gaps(dates, 1)) == [("2024-01-02", None), (None, 1)]
    assert rows(first_gaps(dates, 20)) == [("2024-01-02", None), ("2024-01-04", None)]
    empty = dates.filter("false")
    assert rows(calendar_gaps(empty)) == [] and rows(first_gaps(empty)) == []


def test_dates_in_names_take_the_first_date_right_after_the_prefix(spark):
    names = spark.createDataFrame(
        [("files/2024/dataset_2024-01-01_eng.parquet",), ("dataset_2024-02-01_to_2024-02-03.parquet",), ("dataset_history2024-03-01.parquet",), (".gitkeep",)],
        "name string",
    )
    assert sorted(rows(dates_in_names(names))) == [("2024-01-01",), ("2024-02-01",)]


def test_inventory_matches_names_exactly_and_prefers_the_larger_file(spark):
    files = spark.createDataFrame(
        [
            ("r/dataset_2024-01-01_eng.parquet", None),
            ("r/2024/dataset_2024-01-01_eng.parquet", 0),
            ("r/2024/dataset_2024-01-02_eng.parquet", 5),
            ("r/dataset_2024-01-02_eng.parquet", 5),
            ("r/dataset_2024-01-03_fra.parquet", 5),
            ("r/dataset_2024-01-03_to_2024-01-04_eng.parquet", 5),
            ("r/xdataset_2024-01-05_eng.parquet", 5),
            ("r/dataset_2024-01-06_eng.parquet.tmp", 5),
        ],
        "path string, num_rows long",
    )
    assert sorted(rows(daily_inventory(files, "dataset_", "_eng"))) == [
        ("2024-01-01", "r/2024/dataset_2024-01-01_eng.parquet", 0),
        ("2024-01-02", "r/2024/dataset_2024-01-02_eng.parquet", 5),
    ]
    assert rows(daily_inventory(files, "dataset_", "")) == []


STATES = (("2024-01-01", 3), ("2024-01-02", 0), ("2024-01-04", None))


def test_days_are_classified_and_planned(spark):
    days = calendar_between(spark, datetime.date(2024, 1, 1), datetime.date(2024, 1, 4))
    classified = classify_days(days, inventory(spark, *STATES))
    assert sorted(rows(classified)) == [("2024-01-01", "present"), ("2024-01-02", "empty"), ("2024-01-03", "missing"), ("2024-01-04", "unreadable")]
    assert rows(plan_days(classified)) == [("2024-01-03", "missing"), ("2024-01-04", "missing")]
    assert rows(plan_days(classified, retry_empty=True)) == [("2024-01-02", "empty"), ("2024-01-03", "missing"), ("2024-01-04", "missing")]
    assert rows(plan_summary(classified)) == [(4, 2, 2, 0, 1, 1)]
    assert rows(plan_summary(classified, retry_empty=True)) == [(4, 3, 2, 1, 1, 0)]
    lenient = classify_days(days, inventory(spark, *STATES), unreadable_is_present=True)
    assert rows(plan_days(lenient)) == [("2024-01-03", "missing")]


def test_range_rules(spark):
    known = inventory(spark, ("2024-01-03", 1), ("2024-01-02", None))
    resolve = lambda window_days=1, **kw: resolve_range(BackfillParams(**kw), known, TODAY, window_days)
    assert resolve() == (datetime.date(2024, 1, 2), TODAY)
    assert resolve(from_date="2023-12-31", to_date="2024-01-05") == (datetime.date(2023, 12, 31), datetime.date(2024, 1, 5))
    assert resolve(to_date="2030-01-01")[1] == TODAY
    for kwargs, message in (
        ({"window_days": 2}, "one-day"),
        ({"to_date": "2024-1-x"}, "to_date"),
        ({"from_date": "nonsense"}, "from_date"),
        ({"retry_empty": True}, "explicit from_date"),
        ({"from_date": "2024-01-09", "to_date": "2024-01-08"}, "before"),
    ):
        with pytest.raises(ValueError, match=message):
            resolve(**kwargs)
    with pytest.raises(ValueError, match="nothing"):
        resolve_range(BackfillParams(), known.filter("false"), TODAY)


def test_a_range_wholly_in_the_future_gives_an_empty_plan(spark):
    plan = plan_backfill(inventory(spark), BackfillParams("2024-02-01", "2024-02-03"), TODAY)
    assert plan.days.count() == 0
    assert tuple(plan.summary.first())[:2] == (0, 0)


def test_plan_present_and_skipped_cover_the_calendar(spark):
    plan = plan_backfill(inventory(spark, *STATES), BackfillParams("2023-12-25", "2024-01-08"), TODAY)
    s = plan.summary.first()
    assert s.n_total == 15 == s.to_fetch + s.skipped_present + s.skipped_empty
    assert plan.days.count() == s.to_fetch


def test_bad_iso_text():
    with pytest.raises(ValueError, match="from_date 'x'"):
        parse_iso("x", "from_date")
    with pytest.raises(ValueError):
        parse_iso("2024-02-30", "d")


def test_run_summary_lists_failed_and_empty_days(spark):
    log = spark.createDataFrame(
        [("2024-01-02", "missing", "errors", None, None, "boom"), ("2024-01-03", "missing", "empty", 0, None, None), ("2024-01-01", "empty", "rows", 0, "p", None)],
        RUN_LOG_SCHEMA,
    )
    row = run_summary(log).first()
    assert (row.attempted, row.with_rows, row.still_empty, row.n_errors) == (3, 1, 1, 1)
    assert [tuple(e) for e in row.errored] == [("2024-01-02", "boom")]
    assert row.empty_dates == ["2024-01-03"]
