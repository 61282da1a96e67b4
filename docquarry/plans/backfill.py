"""Backfill: find the days to fetch in a range, fetch them in one job, report."""

import datetime
import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquarry.functions.dates import parse_iso
from docquarry.operators.calendar import calendar_between
from docquarry.operators.extract import DEFAULT_EXTRACTORS, Extractors
from docquarry.operators.gaps import classify_days, plan_days, plan_summary
from docquarry.operators.graph import VOCABULARY, Vocabulary
from docquarry.plans.mine import MineParams, mine_windows
from docquarry.schemas import RUN_LOG_SCHEMA, conform
from docquarry.sinks.daily import Corpus, manifest_inventory, scope_of
from docquarry.sources.tables import stored
from docquarry.settings import shared_dir

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class BackfillParams:
    from_date: str | datetime.date | None = None
    to_date: str | datetime.date | None = None
    retry_empty: bool = False
    dry_run: bool = False
    unreadable_is_present: bool = False


def resolve_range(
    params: BackfillParams, inventory: DataFrame, today: datetime.date, window_days: int = 1
) -> tuple[datetime.date, datetime.date]:
    """First and last day to look at. The last is clamped to today after the order check, so a
    range wholly in the future is empty rather than an error."""
    if window_days != 1:
        raise ValueError("backfill needs one-day windows: gaps are found by day")
    last = parse_iso(params.to_date, "to_date") if params.to_date else today
    if params.from_date:
        first = parse_iso(params.from_date, "from_date")
    elif params.retry_empty:
        raise ValueError("retry_empty needs an explicit from_date")
    else:
        earliest = inventory.agg(F.min("date")).first()[0]
        if earliest is None:
            raise ValueError("nothing written yet and no from_date given: nothing to backfill")
        first = parse_iso(earliest, "earliest date")
    if last < first:
        raise ValueError(f"to_date {last} is before from_date {first}")
    if last > today:
        log.warning("to_date %s is in the future; clamped to %s", last, today)
        last = today
    return first, last


@dataclass(frozen=True)
class BackfillPlan:
    first: datetime.date
    last: datetime.date
    days: DataFrame
    summary: DataFrame


def plan_backfill(
    inventory: DataFrame, params: BackfillParams, today: datetime.date, window_days: int = 1
) -> BackfillPlan:
    """The plan and its summary; nothing is fetched."""
    first, last = resolve_range(params, inventory, today, window_days)
    days = calendar_between(inventory.sparkSession, first, last)
    classified = classify_days(days, inventory, params.unreadable_is_present)
    return BackfillPlan(
        first, last, plan_days(classified, params.retry_empty), plan_summary(classified, params.retry_empty)
    )


def run_backfill(
    quads: DataFrame,
    taxonomy: DataFrame,
    payloads: DataFrame,
    params: MineParams,
    backfill: BackfillParams,
    corpus: Corpus,
    run_id: str,
    extractors: Extractors = DEFAULT_EXTRACTORS,
    vocabulary: Vocabulary = VOCABULARY,
    inventory: DataFrame | None = None,
    landed: DataFrame | None = None,
) -> DataFrame:
    """Fetch the planned days with the options of the normal job; returns the run log.

    With ``dry_run`` the plan is returned instead. The inventory comes from the manifest unless
    one is given. Days that ``landed`` (day, error) lacks or gives an error for are logged as errors,
    as are those of a group of days that failed; the next backfill plans them again.
    """
    spark = quads.sparkSession
    scope = scope_of(params.lang)
    known = manifest_inventory(spark, corpus, scope) if inventory is None else inventory
    plan = plan_backfill(known, backfill, params.today, params.window_days)
    if backfill.dry_run:
        return plan.days
    # The plan reads the manifest this run is about to extend.
    days = stored(plan.days, f"{shared_dir(spark, f'plan-{run_id}')}/days")
    windows = [(r.date, r.date) for r in days.orderBy("date").collect()]
    _, entries = mine_windows(quads, taxonomy, payloads, params, corpus, run_id, windows, extractors, vocabulary, landed)
    logged = entries.withColumnRenamed("window_start", "date").join(days, "date").withColumn("path", F.lit(corpus.files))
    return conform(logged, RUN_LOG_SCHEMA)
