"""Table checks: keys, NULLs, defaults."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class CheckFailed(ValueError):
    """A table broke a rule the next step depends on."""


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each key held by more than one row, with its number of rows.

    Counting starts in the map tasks, so a key with very many rows is one row per task.
    """
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def uniqueness(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows, distinct keys, keys with several rows, and rows beyond the first."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("row_count"),
        F.count(F.lit(1)).alias("key_count"),
        F.count_if(F.col("n") > 1).alias("duplicate_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("surplus_rows"),
    )


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: how many of its values are NULL."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "null_count")


def with_defaults(df: DataFrame, defaults: Mapping[str, Any]) -> DataFrame:
    """NULL replaced by the declared default, the column type kept."""
    types = dict(df.dtypes)
    filled = {c: F.coalesce(F.col(c), F.lit(v).cast(types[c])) for c, v in defaults.items()}
    return df.withColumns(filled)


def require_unique(df: DataFrame, keys: Sequence[str], what: str) -> None:
    """Raise when a key occurs twice."""
    sample = duplicate_keys(df, keys).limit(3).collect()
    if sample:
        shown = "; ".join(str(tuple(row)) for row in sample)
        raise CheckFailed(f"{what}: key {tuple(keys)} is not unique, e.g. {shown}")


def has_no_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which every named column has a value."""
    return df.dropna(how="any", subset=list(columns))


def rows_with_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which a named column is NULL: the ones a keyed load must set aside."""
    return df.where(F.greatest(*[F.col(c).isNull() for c in columns], F.lit(False)))
