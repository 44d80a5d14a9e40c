"""Loads on tables stored by slices: each reads and writes no more than it has to change.

The type-2 load keeps open rows in one slice and the rows that a load closes in a slice of that
load, so closed rows are never read again. The history load keeps a slice per tenant. Counts of what
a statement changed come from the write itself.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.operators import history as H
from tidemark.operators import scd2
from tidemark.operators import workqueue as W
from tidemark.operators.checks import has_no_null, require_unique, rows_with_null
from tidemark.operators.latest import latest_rows
from tidemark.operators.runlog import RunLog, control_row, parameters
from tidemark.plans.joins import fits_broadcast
from tidemark.sources import slices as P
from tidemark.sources import tables as S

# The slice column of a type-2 table, and the slices of open and of earlier rows.
LOADED, OPEN, EARLIER = "closed_by", "open", "earlier"


def _with_slice(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(LOADED, T.StringType())])


def lay_out_versions(history: DataFrame, path: str, spec: scd2.Versioned) -> None:
    """A given history as a table of slices: open rows apart from closed ones."""
    is_open = F.coalesce(F.col(spec.termination) == F.lit(spec.open_date), F.lit(False))
    placed = history.withColumn(LOADED, F.when(is_open, OPEN).otherwise(EARLIER))
    placed.write.mode("errorifexists").partitionBy(LOADED).parquet(path)


def read_versions(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows, open and closed."""
    return P.read_slices(spark, path, _with_slice(schema)).drop(LOADED)


def read_open(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return P.read_slice(spark, path, _with_slice(schema), LOADED, OPEN).drop(LOADED)


def load_versions(
    spark: SparkSession,
    stage: DataFrame,
    path: str,
    control_path: str,
    schema: T.StructType,
    spec: scd2.Versioned,
    run_date: dt.date,
    source_file: str,
    mode: str = "two_pass",
    retire_missing: bool = True,
    newest_first: list | None = None,
) -> DataFrame:
    """Apply a staged extract to the open rows of a stored history; returns the control row.

    One job compares, writes and counts. The open slice is replaced; rows closed by this load go to a
    slice of their own. A load that is repeated finds the rows open as the first attempt left them,
    so it closes nothing twice. Keys are checked before anything is written. Rows with a NULL key
    replace those that the same file left in ``<path>_rejected`` on that day, and count as source rows.
    """
    started = dt.datetime.now()
    keyed = has_no_null(stage, spec.keys)
    if newest_first:
        keyed = latest_rows(keyed, list(spec.keys), newest_first)
    else:
        require_unique(keyed, spec.keys, "stage")
    aside = rows_with_null(stage, spec.keys).withColumns(
        {"rejected_on": F.lit(run_date), "source_file": F.lit(source_file)}
    )
    seen = Observation()
    aside.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("rejected_on", "source_file").parquet(f"{path}_rejected")

    compared = scd2.compare(read_open(spark, path, schema), keyed, spec, run_date)
    counted = Observation()
    rejected = int(seen.get["n"] or 0)
    compared = compared.observe(counted, *scd2.metric_columns(spec.keys, rejected))
    moved = scd2.versions(compared, spec, run_date, mode, retire_missing)
    is_open = F.coalesce(F.col(spec.termination) == F.lit(spec.open_date), F.lit(False))
    own = f"{run_date.isoformat()}.{uuid.uuid4().hex[:12]}"
    placed = moved.withColumn(LOADED, F.when(is_open, OPEN).otherwise(own))
    P.replace_slices(placed, path, LOADED, [OPEN])
    names = [f.name for f in schemas.CONTROL.fields if f.name.endswith("_count")]
    found = counted.get
    metrics = S.from_rows(
        spark,
        [tuple(int(found[n] or 0) for n in names)],
        T.StructType([T.StructField(n, T.LongType()) for n in names]),
    )
    row = control_row(metrics, started, dt.datetime.now(), source_file)
    S.append(row, control_path, schemas.CONTROL)
    return row


@dataclass(frozen=True)
class Affected:
    """Rows of a tenant's history that a load cut, inserted, updated, or left as they were."""

    cut: int
    inserted: int
    updated: int
    passed_by: int

    @property
    def total(self) -> int:
        return self.cut + self.inserted + self.updated


def changed_history(
    stored: DataFrame,
    staged: DataFrame,
    values: Sequence[str],
    start: dt.date | None,
    now: dt.datetime,
    job_id: int,
    parity: bool = False,
    change: str = "__change",
) -> DataFrame:
    """One tenant's history after the load, cut rows included, with what became of each row.

    ``change`` is ``insert``, ``update``, ``stored`` or ``cut``, or ``apart`` for the rows of records
    that have neither staged nor cut rows: these are not shuffled with the others and keep the ends
    they have.
    """
    keys = list(H.KEYS)
    left = H.cut_after(stored, start)
    late = stored.where(F.lit(False)) if start is None else stored.where(F.col(H.FROM) > F.lit(start))
    touched = staged.select(*keys).unionByName(late.select(*keys)).distinct()
    if fits_broadcast(touched):
        touched = F.broadcast(touched)
    apart = stored.join(touched, keys, "left_anti").withColumn(change, F.lit("apart"))
    remaining = left.join(touched, keys, "left_semi")
    if not parity:
        remaining = H.rechain(remaining)
    kept = H.only_changes(staged.repartition(*keys), values, as_text=True)
    added = H.beyond_stored(kept, remaining, values, as_text=True)
    merged = H.rechain(H.upsert(remaining, added, values, now, job_id, change=change))
    return merged.unionByName(apart).unionByName(late.withColumn(change, F.lit("cut")))


def load_tenant_history(
    spark: SparkSession,
    staged: DataFrame,
    path: str,
    schema: T.StructType,
    tenant: str,
    values: Sequence[str],
    start: dt.date | None,
    now: dt.datetime,
    job_id: int,
    parity: bool = False,
    log: RunLog | None = None,
) -> Affected:
    """Load one tenant's staged rows into a history stored by tenant.

    Only that tenant's slice is read and written. One job writes it and counts the rows affected,
    which are logged as the step's rows.
    """
    text = f"history: {parameters('S', tenant, start)}"
    if log is not None:
        log.step(text, phase="start")
    mine = staged.where(F.col("tenant") == F.lit(tenant))
    require_unique(mine, [*H.KEYS, H.FROM], "staged history")
    stored = P.read_slice(spark, path, schema, "tenant", tenant)
    rows = changed_history(stored, mine, values, start, now, job_id, parity)
    change = F.col("__change")
    found = P.replace_slices(
        rows,
        path,
        "tenant",
        [tenant],
        {
            "cut": F.count_if(change == "cut"),
            "inserted": F.count_if(change == "insert"),
            "updated": F.count_if(change == "update"),
            "passed_by": F.count_if(change == "apart"),
        },
        change != "cut",
        ["__change"],
    )
    affected = Affected(**found)
    if log is not None:
        log.step(text, affected.total)
    return affected


def load_queue(
    spark: SparkSession,
    path: str,
    recent: DataFrame,
    missing: DataFrame,
    run_date: dt.date,
    run_ts: dt.datetime,
    job_id: int,
) -> dict[str, int]:
    """The next version of the stored queue, and the rows requeued and inserted as its write saw them."""
    queue = S.read_version(spark, path)
    merged = W.requeue_and_insert(queue, recent, missing, run_date, run_ts, job_id, mark="__what")
    seen = Observation()
    kinds = ("requeued", "inserted")
    counted = merged.observe(seen, *[F.count_if(F.col("__what") == k).alias(k) for k in kinds])
    S.write_version(counted.drop("__what"), path)
    return {k: int(seen.get[k] or 0) for k in kinds}
