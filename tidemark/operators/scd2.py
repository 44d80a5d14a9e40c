"""Type-2 history: close, insert and retire versions against a full staged extract.

One full outer join of the open rows with the stage decides everything: what to close, what
to add, and the change metrics. Closed rows never take part in it and are not shuffled.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import any_differs
from tidemark.operators.checks import has_no_null

# The termination date of an open row, and the names of the change types.
OPEN_DATE = "9999-12-31"
INSERT, UPDATE, NO_CHANGE, DELETE = "Insert", "Update", "NoChange", "Delete"


@dataclass(frozen=True)
class Versioned:
    """How a history table is keyed, compared and dated.

    ``compared`` lists the columns whose change makes a new version; None means every column of
    both sides that is neither key nor date nor in ``uncompared``.
    """

    keys: Sequence[str]
    compared: Sequence[str] | None = None
    uncompared: Sequence[str] = ()
    effective: str = "effective_date"
    termination: str = "termination_date"
    open_date: str = OPEN_DATE
    null_safe: bool = False

    def dates(self) -> list[str]:
        return [self.effective, self.termination]

    def compared_columns(self, target: DataFrame, stage: DataFrame) -> list[str]:
        if self.compared is not None:
            if lost := [c for c in self.compared if c not in stage.columns]:
                raise ValueError(f"the stage lacks compared columns {lost}")
            return list(self.compared)
        skip = {*self.keys, *self.dates(), *self.uncompared}
        return [c for c in target.columns if c in stage.columns and c not in skip]


def project_present(df: DataFrame, wanted: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The wanted columns that exist, in the wanted order, and the names of the missing ones."""
    present = [c for c in wanted if c in df.columns]
    return df.select(*present), [c for c in wanted if c not in df.columns]


def with_audit_dates(
    stage: DataFrame, run_date: dt.date, spec: Versioned, termination_type: str = "string"
) -> DataFrame:
    """The stage with today as effective date and the open date as termination date."""
    return stage.withColumns(
        {
            spec.effective: F.lit(run_date),
            spec.termination: F.lit(spec.open_date).cast(termination_type),
        }
    )


def column_order(df: DataFrame, spec: Versioned) -> DataFrame:
    """Keys first, then the dates, then the rest."""
    lead = [*spec.keys, *[c for c in spec.dates() if c in df.columns]]
    return df.select(*lead, *[c for c in df.columns if c not in lead])


def open_rows(target: DataFrame, spec: Versioned) -> DataFrame:
    return target.where(F.col(spec.termination) == F.lit(spec.open_date))


def closed_rows(target: DataFrame, spec: Versioned) -> DataFrame:
    is_open = F.col(spec.termination) == F.lit(spec.open_date)
    return target.where(~F.coalesce(is_open, F.lit(False)))


def rows_as_of(target: DataFrame, spec: Versioned, day: dt.date) -> DataFrame:
    """The version valid on ``day``: started by then, and ending later."""
    return target.where(
        (F.col(spec.effective) <= F.lit(day))
        & (F.col(spec.termination).cast("date") > F.lit(day))
    )


def missing_from_stage(target: DataFrame, stage: DataFrame, spec: Versioned) -> DataFrame:
    """Open rows whose key the stage no longer has."""
    return open_rows(target, spec).join(stage.select(*spec.keys), list(spec.keys), "left_anti")


def compare(
    target: DataFrame,
    stage: DataFrame,
    spec: Versioned,
    run_date: dt.date,
    null_keys: str = "reject",
) -> DataFrame:
    """One row per open or staged key: ``action``, ``before`` and ``after``.

    ``before`` is the open row and ``after`` the version the stage would open, both as structs
    of the target's columns. The stage must hold each key once. Rows with a NULL key match
    nothing: ``reject`` leaves them out, ``insert`` adds them on every run.
    """
    if null_keys not in ("reject", "insert"):
        raise ValueError("null_keys is 'reject' or 'insert'")
    staged = has_no_null(stage, spec.keys) if null_keys == "reject" else stage
    types = dict(target.dtypes)
    dated = with_audit_dates(staged, run_date, spec, types[spec.termination])

    def staged_value(name: str) -> Column:
        source = F.col(name) if name in dated.columns else F.lit(None)
        return source.cast(types[name]).alias(name)

    before = open_rows(target, spec).select(
        *[F.col(k).alias(f"__b_{k}") for k in spec.keys],
        F.struct(*target.columns).alias("before"),
    )
    after = dated.select(
        *[F.col(k).alias(f"__a_{k}") for k in spec.keys],
        F.struct(*[staged_value(c) for c in target.columns]).alias("after"),
    )
    # NULL keys match nothing; kept out of the join, they are no hot key of it
    def keyed(side: str) -> Column:
        return reduce(and_, [F.col(f"{side}_{k}").isNotNull() for k in spec.keys])

    same_key = [F.col(f"__b_{k}") == F.col(f"__a_{k}") for k in spec.keys]
    pairs = [
        (F.col(f"before.{c}"), F.col(f"after.{c}")) for c in spec.compared_columns(target, stage)
    ]
    action = (
        F.when(F.col("before").isNull(), INSERT)
        .when(F.col("after").isNull(), DELETE)
        .when(any_differs(pairs, spec.null_safe), UPDATE)
        .otherwise(NO_CHANGE)
    )
    joined = before.where(keyed("__b")).join(after.where(keyed("__a")), same_key, "full_outer")
    alone = before.where(~keyed("__b")).unionByName(
        after.where(~keyed("__a")), allowMissingColumns=True
    )
    return joined.unionByName(alone).select(action.alias("action"), "before", "after")


def versions(
    compared: DataFrame,
    spec: Versioned,
    run_date: dt.date,
    mode: str = "two_pass",
    retire_missing: bool = False,
) -> DataFrame:
    """The rows that follow from ``compare``: kept, closed and newly opened.

    ``two_pass`` opens the new version of a changed key at once. ``one_pass`` only closes the
    old one, so that the next run opens it. ``retire_missing`` closes keys the stage lacks.
    """
    if mode not in ("one_pass", "two_pass"):
        raise ValueError("mode is 'one_pass' or 'two_pass'")
    action = F.col("action")
    ended = action == UPDATE
    if retire_missing:
        keyed = F.lit(True)
        for key in spec.keys:
            keyed = keyed & F.col(f"before.{key}").isNotNull()
        ended = ended | ((action == DELETE) & keyed)
    opened = action == INSERT if mode == "one_pass" else action.isin(INSERT, UPDATE)

    fields = compared.schema["before"].dataType.fieldNames()
    types = {f.name: f.dataType for f in compared.schema["before"].dataType.fields}
    end = F.when(ended, F.lit(run_date).cast(types[spec.termination]))
    old = F.struct(
        *[
            (
                F.coalesce(end, F.col(f"before.{c}")) if c == spec.termination
                else F.col(f"before.{c}")
            ).alias(c)
            for c in fields
        ]
    )
    old_row = F.when(F.col("before").isNotNull(), old)
    new_row = F.when(opened, F.col("after"))
    rows = compared.select(F.explode(F.array_compact(F.array(old_row, new_row))).alias("row"))
    return rows.select("row.*")


def apply_stage(
    target: DataFrame,
    stage: DataFrame,
    spec: Versioned,
    run_date: dt.date,
    mode: str = "two_pass",
    retire_missing: bool = False,
    null_keys: str = "reject",
) -> DataFrame:
    """The whole history after the load."""
    compared = compare(target, stage, spec, run_date, null_keys)
    moved = versions(compared, spec, run_date, mode, retire_missing)
    return closed_rows(target, spec).unionByName(moved)


def change_types(compared: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per staged key, what the load does with it."""
    staged = compared.where(F.col("action") != DELETE)
    return staged.select(
        *[F.col(f"after.{k}").alias(k) for k in keys], F.col("action").alias("change_type")
    )


def metric_columns(keys: Sequence[str] = (), rejected: int = 0) -> list[Column]:
    """Counts over the rows of ``compare``, for an aggregation or an observation of a write.

    With ``keys``, open rows with a NULL key, which no load closes, are no deletions.
    ``rejected`` rows of the source that were set aside count as source rows.
    """
    closable = reduce(and_, [F.col(f"before.{k}").isNotNull() for k in keys], F.lit(True))

    def count(name: str) -> Column:
        return F.count_if(F.col("action") == name)

    return [
        (F.count_if(F.col("action") != DELETE) + F.lit(rejected)).alias("source_count"),
        count(INSERT).alias("insert_count"),
        count(UPDATE).alias("update_count"),
        F.count_if((F.col("action") == DELETE) & closable).alias("delete_count"),
        count(NO_CHANGE).alias("no_change_count"),
    ]


def change_metrics(
    compared: DataFrame, keys: Sequence[str] = (), rejected: int = 0
) -> DataFrame:
    """One row of counts; a change type that does not occur counts 0."""
    return compared.agg(*metric_columns(keys, rejected))
