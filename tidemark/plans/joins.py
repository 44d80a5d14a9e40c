"""Joins whose shape depends on size or skew."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A code map beyond this many rows is not sent to every executor.
BROADCAST_ROWS = 200_000
SALTS = 32


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """True when ``df`` was counted to have at most ``max_rows`` rows.

    The count stops at ``max_rows + 1``, so a large frame is not read to its end.
    """
    return df.limit(max_rows + 1).count() <= max_rows


def lookup_join(
    fact: DataFrame,
    table: DataFrame,
    keys: Sequence[tuple[str, str]],
    residual: Column | None = None,
    how: str = "left",
    max_rows: int = BROADCAST_ROWS,
    salts: int = SALTS,
    null_safe: bool = False,
    small: bool | None = None,
) -> DataFrame:
    """Join a large fact to a lookup table on ``keys`` (pairs fact column, table column).

    A table counted to be small is broadcast, which no hot code can skew. Beyond that bound
    the rows of one code are spread over ``salts`` tasks and the table is repeated per salt.
    ``small`` is the answer of ``fits_broadcast`` where the caller has it, for the table itself
    or for one it is a part of. Column names of the two sides must not clash.
    """
    if small is None:
        small = fits_broadcast(table, max_rows)
    if small:
        return _join(fact, F.broadcast(table), keys, residual, how, null_safe)
    return salted_join(fact, table, keys, residual, how, salts, null_safe)


def salted_join(
    fact: DataFrame,
    table: DataFrame,
    keys: Sequence[tuple[str, str]],
    residual: Column | None = None,
    how: str = "left",
    salts: int = SALTS,
    null_safe: bool = False,
) -> DataFrame:
    """Shuffle join in which one key's fact rows go to ``salts`` tasks.

    The salt is a hash of the fact row and of the partition it was read in: copies of one row
    spread too, and a task that runs again on its partition salts alike.
    """
    if how not in ("inner", "left"):
        raise ValueError("only the fact side is salted: use inner or left")
    mixed = F.xxhash64(*[F.col(f"`{c}`") for c in fact.columns], F.spark_partition_id())
    salt = F.pmod(mixed, F.lit(salts)).cast("int")
    spread = fact.withColumn("__salt_l", salt)
    copies = table.withColumn("__salt_r", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    both = [*keys, ("__salt_l", "__salt_r")]
    return _join(spread, copies, both, residual, how, null_safe).drop("__salt_l", "__salt_r")


def _join(
    fact: DataFrame,
    table: DataFrame,
    keys: Sequence[tuple[str, str]],
    residual: Column | None,
    how: str,
    null_safe: bool,
) -> DataFrame:
    def same(left: str, right: str) -> Column:
        a, b = F.col(left), F.col(right)
        return a.eqNullSafe(b) if null_safe else a == b

    tests = [same(left, right) for left, right in keys]
    if residual is not None:
        tests.append(residual)
    return fact.join(table, functools.reduce(lambda a, b: a & b, tests), how)


def either_key_matches(
    left: DataFrame,
    right: DataFrame,
    alternatives: Sequence[Sequence[tuple[str, str]]],
    keep: Sequence[str],
) -> DataFrame:
    """Distinct ``keep`` columns of left rows that match right on one of several key lists.

    ``OR`` between equalities would be planned as a nested loop; each alternative by itself is
    a hash join, and a semi join, so no pair is ever built.
    """
    parts = []
    for keys in alternatives:
        names = [r for _, r in keys]
        side = right.select(*[F.col(r).alias(f"__k{i}") for i, r in enumerate(names)]).distinct()
        tests = [F.col(lcol) == F.col(f"__k{i}") for i, (lcol, _) in enumerate(keys)]
        condition = functools.reduce(lambda a, b: a & b, tests)
        parts.append(left.join(side, condition, "left_semi").select(*keep))
    return functools.reduce(DataFrame.union, parts).distinct()


def not_in(left: DataFrame, column: str, right: DataFrame, right_column: str) -> DataFrame:
    """``column NOT IN (SELECT right_column ...)`` with the SQL treatment of NULL.

    One NULL in the list leaves nothing, and a NULL on the left is only kept for an empty list.
    The list is not broadcast: a NULL-free part is an ordinary anti join.
    """
    listed = right.select(F.col(right_column).alias("__listed"))
    state = listed.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("__listed").isNull()).alias("nulls")
    )
    rows = state.select("rows").scalar()
    nulls = state.select("nulls").scalar()
    kept = left.join(
        listed.where(F.col("__listed").isNotNull()).distinct(),
        F.col(column) == F.col("__listed"),
        "left_anti",
    )
    return kept.where((rows == 0) | ((nulls == 0) & F.col(column).isNotNull()))
