"""Date expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_month_end(day: Column) -> Column:
    return day == F.last_day(day)


def replace_date(day: Column, sentinel: dt.date, value: Column) -> Column:
    """``value`` where ``day`` is the sentinel, otherwise ``day``."""
    return F.when(day == F.lit(sentinel), value).otherwise(day)


def as_of(day: Column | dt.date, start: Column, end: Column) -> Column:
    """True when ``day`` lies in the closed interval ``[start, end]``."""
    point = day if isinstance(day, Column) else F.lit(day)
    return point.between(start, end)
