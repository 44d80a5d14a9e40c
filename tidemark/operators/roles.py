"""Column roles of a report: captions, dimensions and measures, and the query they stand for."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIMENSION, MEASURE = "dimension", "measure"
COUNT, YEAR, SUM = "count", "year", "sum"
ROLE, DEFAULT, CAPTION = "role", "aggregation", "caption"

# Aggregations of a value; the year is none of them, it coarsens a date that rows are grouped by.
_AGGREGATES: Mapping[str, Callable[[str], Column]] = {COUNT: F.count, SUM: F.sum}


def default_roles(schema: T.StructType) -> dict[str, tuple[str, str]]:
    """Role and default aggregation by type: numbers are summed, dates are years, texts counted."""
    def of(kind: T.DataType) -> tuple[str, str]:
        if isinstance(kind, T.NumericType):
            return MEASURE, SUM
        if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return DIMENSION, YEAR
        return DIMENSION, COUNT

    return {f.name: of(f.dataType) for f in schema.fields}


def with_roles(
    df: DataFrame,
    roles: Mapping[str, tuple[str, str]] | None = None,
    captions: Mapping[str, str] | None = None,
) -> DataFrame:
    """The columns with role, default aggregation and caption as metadata, which writes keep.

    What ``roles`` and ``captions`` do not name has the defaults of its type, and its name in words.
    """
    chosen = default_roles(df.schema) | dict(roles or {})
    for column, (role, default) in chosen.items():
        if role not in (DIMENSION, MEASURE) or default not in (COUNT, YEAR, SUM):
            raise ValueError(f"{column}: unknown role {role} or aggregation {default}")
    named = captions or {}
    for column, (role, default) in chosen.items():
        caption = named.get(column, column.replace("_", " ").title())
        facts = {ROLE: role, DEFAULT: default, CAPTION: caption}
        df = df.withMetadata(column, {**df.schema[column].metadata, **facts})
    return df


def roles_of(df: DataFrame) -> DataFrame:
    """One row per column: its role, default aggregation and caption."""
    rows = [
        (f.name, *[f.metadata.get(k) for k in (ROLE, DEFAULT, CAPTION)]) for f in df.schema.fields
    ]
    names = ("column_name", ROLE, DEFAULT, CAPTION)
    return df.sparkSession.createDataFrame(rows, ", ".join(f"{n} string" for n in names))


def report_by_roles(df: DataFrame, by: Sequence[str], values: Sequence[str]) -> DataFrame:
    """The query that a sheet with these columns stands for, from the columns' metadata.

    A column in ``by`` groups, a date by its year (``order_date`` as ``order_date_year``); one in
    ``values`` is aggregated by its default (``runtime`` as ``sum_runtime``). A date has no
    aggregate as a value and is refused there, as is a measure in ``by``.
    """
    facts = {f.name: f.metadata for f in df.schema.fields}
    if lost := [c for c in [*by, *values] if DEFAULT not in facts.get(c, {})]:
        raise ValueError(f"columns without a role: {lost}")
    if wrong := [c for c in by if facts[c][ROLE] != DIMENSION]:
        raise ValueError(f"measures do not group: {wrong}")
    if wrong := [c for c in values if facts[c][DEFAULT] not in _AGGREGATES]:
        raise ValueError(f"no values: {wrong}")
    groups = [
        F.year(c).alias(f"{c}_year") if facts[c][DEFAULT] == YEAR else F.col(c) for c in by
    ]
    totals = [
        _AGGREGATES[facts[c][DEFAULT]](c).alias(f"{facts[c][DEFAULT]}_{c}") for c in values
    ]
    if not totals:
        return df.select(*groups).distinct()
    return df.groupBy(*groups).agg(*totals)
