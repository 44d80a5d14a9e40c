"""Snapshot calendar, the grid of records by snapshot, and totals to date."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import as_of, is_month_end

# Run types, and the date that stands for "still open".
FULL, INCREMENTAL, SINCE = "H", "I", "S"
RUN_TYPES = (FULL, INCREMENTAL, SINCE)
FAR_DATE = dt.date(2041, 1, 1)
# Where a full run starts, and an incremental run before any completed one.
FULL_RUN_START = dt.date(2022, 7, 1)
FIRST_RUN_START = dt.date(2013, 1, 1)


def check_run_type(run_type: str) -> str:
    if run_type not in RUN_TYPES:
        raise ValueError(f"unknown run type {run_type!r}")
    return run_type


def start_date(
    run_type: str,
    high_water: dt.date | None = None,
    given: dt.date | None = None,
    full_start: dt.date = FULL_RUN_START,
) -> dt.date:
    """Where a run starts: full at a fixed date, incremental at the last completion."""
    check_run_type(run_type)
    if run_type == FULL:
        return full_start
    if run_type == INCREMENTAL:
        return high_water or FIRST_RUN_START
    if given is None:
        raise ValueError("a run of type S needs a start date")
    return given


@dataclass(frozen=True)
class Span:
    """The snapshot dates of one run: month ends from ``start`` on, and the day before the run."""

    run_type: str
    start: dt.date
    run_date: dt.date

    def __post_init__(self) -> None:
        check_run_type(self.run_type)

    @property
    def yesterday(self) -> dt.date:
        return self.run_date - dt.timedelta(days=1)

    @property
    def last(self) -> dt.date:
        return self.yesterday if self.run_type == FULL else self.run_date

    @staticmethod
    def ends_month(day: dt.date) -> bool:
        return (day + dt.timedelta(days=1)).day == 1

    def month_ends(self) -> list[dt.date]:
        """Ends of the months from the start's to the last day's."""
        ends = []
        year, month = self.start.year, self.start.month
        while (year, month) <= (self.last.year, self.last.month):
            year, month = (year + 1, 1) if month == 12 else (year, month + 1)
            ends.append(dt.date(year, month, 1) - dt.timedelta(days=1))
        return ends or [self.start]

    def holds(self, day: Column) -> Column:
        """Is ``day`` a snapshot date? The bounds are literals, so a scan can use them."""
        point = is_month_end(day) | (day == F.lit(self.yesterday))
        return day.between(F.lit(self.start), F.lit(self.last)) & point

    def first_seen(self, day: Column) -> Column:
        """The first date that can be a snapshot and is not before ``day``.

        Days before the start fall together on the start, so each key keeps at most one total
        per snapshot however long its past is.
        """
        yesterday = F.lit(self.yesterday)
        this_month = F.trunc(day, "MM") == F.trunc(yesterday, "MM")
        point = F.when(this_month & (day <= yesterday), yesterday).otherwise(F.last_day(day))
        return F.greatest(point, F.lit(self.start))


def snapshot_calendar(calendar: DataFrame, span: Span, day: str = "calendar_date") -> DataFrame:
    """The snapshot dates a calendar table has."""
    return calendar.where(span.holds(F.col(day))).select(F.col(day).alias("snapshot_date"))


def expand(
    df: DataFrame, span: Span, start: str = "from_date", end: str = "thru_date"
) -> DataFrame:
    """Each row once per snapshot date in its interval, without a join.

    A range join with the calendar is a nested loop. Here the month ends of the span are a
    literal list, as long as the span has months, and a row takes its slice by month number.
    """
    low = F.greatest(F.col(start), F.lit(span.start))
    high = F.least(F.col(end), F.lit(span.last))
    ends = F.array(*[F.lit(d) for d in span.month_ends()])
    first = _months_after(low, span.start)
    # The month of ``high`` counts only when ``high`` is its end.
    until = _months_after(F.date_add(high, 1), span.start)
    slices = F.slice(ends, first + 1, F.greatest(until - first, F.lit(0)))
    points = slices
    if not span.ends_month(span.yesterday):
        has_extra = F.lit(span.yesterday).between(low, high)
        extra = F.when(has_extra, F.array(F.lit(span.yesterday))).otherwise(
            F.array().cast("array<date>")
        )
        points = F.concat(slices, extra)
    bounded = F.col(start).isNotNull() & F.col(end).isNotNull() & (low <= high)
    return df.withColumn("snapshot_date", F.explode(F.when(bounded, points)))


def _months_after(day: Column, start: dt.date) -> Column:
    return F.year(day) * 12 + F.month(day) - F.lit(start.year * 12 + start.month)


def snapshot_grid(
    records: DataFrame,
    span: Span,
    calendar: DataFrame | None = None,
    start: str = "from_date",
    end: str = "thru_date",
) -> DataFrame:
    """Records by snapshot date; with a calendar, only the dates it holds.

    The distinct snapshot dates are at most the months of the span and one day, whatever the
    calendar table's size, so they may be broadcast.
    """
    grid = expand(records, span, start, end)
    if calendar is None:
        return grid
    days = snapshot_calendar(calendar, span).distinct()
    return grid.join(F.broadcast(days), "snapshot_date", "left_semi")


def running_steps(
    changes: DataFrame, keys: Sequence[str], measures: Sequence[str], point: str
) -> DataFrame:
    """Changes per key and date, summed up to each date, as intervals.

    A row says what the totals are from ``step_from`` to ``step_thru``. A key has at most one
    row per date, so the window is bounded by the calendar.
    """
    per_point = changes.groupBy(*keys, point).agg(*[F.sum(m).alias(m) for m in measures])
    order = Window.partitionBy(*keys).orderBy(point)
    totals = {m: F.sum(m).over(order.rowsBetween(Window.unboundedPreceding, 0)) for m in measures}
    until = F.coalesce(F.date_sub(F.lead(point).over(order), 1), F.lit(FAR_DATE))
    return per_point.select(
        *keys,
        F.col(point).alias("step_from"),
        until.alias("step_thru"),
        *[total.alias(m) for m, total in totals.items()],
    )


def fact_as_of(
    grid: DataFrame,
    fact: DataFrame,
    keys: Sequence[str],
    start: str,
    end: str,
    at: str = "snapshot_date",
    how: str = "left",
) -> DataFrame:
    """Join a dated fact: same key, and the snapshot inside the fact's interval."""
    names = {k: f"__f_{k}" for k in keys}
    dates = {start: "__f_start", end: "__f_end"}
    side = fact.withColumnsRenamed({**names, **dates})
    test = as_of(F.col(at), F.col("__f_start"), F.col("__f_end"))
    for key, name in names.items():
        test = (F.col(key) == F.col(name)) & test
    return grid.join(side, test, how).drop(*names.values(), "__f_start", "__f_end")


def grid_with_steps(
    records: DataFrame,
    steps: DataFrame,
    span: Span,
    keys: Sequence[str],
    measures: Sequence[str],
    calendar: DataFrame | None = None,
) -> DataFrame:
    """Records by snapshot with the totals of their key; NULL before its first step.

    A record meets each step of its key once and is spread over the snapshots the two share.
    Spreading it first would hold every snapshot against every step.
    """
    order = Window.partitionBy(*keys).orderBy("step_from")
    side = steps.withColumn(
        "__cover",
        F.when(F.row_number().over(order) == 1, F.lit(span.start)).otherwise(F.col("step_from")),
    ).withColumnsRenamed({k: f"__s_{k}" for k in keys})
    test = (F.col("__cover") <= F.col("thru_date")) & (F.col("step_thru") >= F.col("from_date"))
    for key in keys:
        test = (F.col(key) == F.col(f"__s_{key}")) & test
    joined = records.join(side, test, "left").withColumns(
        {
            "__lo": F.greatest("from_date", "__cover"),
            "__hi": F.least("thru_date", "step_thru"),
        }
    )
    grid = snapshot_grid(joined, span, calendar, "__lo", "__hi")
    known = F.col("snapshot_date") >= F.col("step_from")
    return grid.withColumns({m: F.when(known, F.col(m)) for m in measures}).drop(
        *[f"__s_{k}" for k in keys], "__cover", "__lo", "__hi", "step_from", "step_thru"
    )


def totals_to_date(
    records: DataFrame,
    detail: DataFrame,
    span: Span,
    keys: Sequence[str],
    day: str,
    measures: Mapping[str, Column],
    calendar: DataFrame | None = None,
) -> DataFrame:
    """Per key and snapshot the detail summed to date, once per record that covers the snapshot;
    absent before the first detail row.

    Records are counted like detail, one more where they begin and one less after they end. So
    detail and records need no join: both run through one running sum, whose steps are spread
    over the snapshots at the end.
    """
    valid = records.where(F.col("from_date") <= F.col("thru_date"))
    after = F.date_add("thru_date", 1)
    begins = valid.select(*keys, span.first_seen(F.col("from_date")).alias("point"))
    ends = valid.select(*keys, span.first_seen(after).alias("point"))
    seen = detail.where(F.col(day) <= F.lit(span.last)).select(
        *keys,
        span.first_seen(F.col(day)).alias("point"),
        *[m.alias(n) for n, m in measures.items()],
        F.lit(1).alias("__rows"),
    )
    changes = seen
    for side, sign in ((begins, 1), (ends, -1)):
        inside = side.where(F.col("point") <= F.lit(span.last))
        changes = changes.unionByName(
            inside.withColumn("__cover", F.lit(sign)), allowMissingColumns=True
        )
    steps = running_steps(changes, keys, [*measures, "__rows", "__cover"], "point")
    held = steps.where((F.col("__rows") > 0) & (F.col("__cover") > 0))
    grid = snapshot_grid(held, span, calendar, "step_from", "step_thru")
    return grid.select(
        *keys, "snapshot_date", *[(F.col(m) * F.col("__cover")).alias(m) for m in measures]
    )


def valid_at(
    history: DataFrame, day: dt.date, start: str = "from_date", end: str = "thru_date"
) -> DataFrame:
    """The rows of an effective-dated table that hold on ``day``."""
    return history.where(as_of(day, F.col(start), F.col(end)))


def class_counts(
    records: DataFrame, history: DataFrame, keys: Sequence[str], label: str, day: dt.date
) -> DataFrame:
    """How many records hold on ``day``, by the class their history gives them then."""
    known = valid_at(history, day).select(*keys, label)
    return (
        valid_at(records, day)
        .join(known, list(keys), "left")
        .groupBy(label)
        .agg(F.count(F.lit(1)).alias("records"))
    )
