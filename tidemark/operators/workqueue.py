"""The work queue: what is pending, queueing again, queueing anew, marking done."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.latest import latest_rows
from tidemark.operators.snapshot import FAR_DATE, FULL, SINCE, check_run_type
from tidemark.plans.joins import either_key_matches

KEYS = ("tenant", "record_id")
# Fixed value: how many days back new charges put a record into the queue again.
RECENT_DAYS = 31


def never_or_stale(extracted: Column, done: Column) -> Column:
    return done.isNull() | (done < extracted)


def is_pending(run_type: str, start: dt.date) -> Column:
    """Never done or stale; a full or dated run also takes what was done on or after the start."""
    check_run_type(run_type)
    test = never_or_stale(F.col("extract_date"), F.col("result_date"))
    if run_type in (FULL, SINCE):
        test = test | (F.coalesce(F.col("result_date"), F.lit(FAR_DATE)) >= F.lit(start))
    return test


def pending_keys(queue: DataFrame, run_type: str, start: dt.date) -> DataFrame:
    return queue.where(is_pending(run_type, start)).select(*KEYS).distinct()


def only_pending(df: DataFrame, pending: DataFrame) -> DataFrame:
    return df.join(pending, list(KEYS), "left_semi")


def recently_charged(
    records: DataFrame, charges: DataFrame, run_date: dt.date, days: int = RECENT_DAYS
) -> DataFrame:
    """Keys of open records with a positive quantity posted in the last days.

    Charges are reduced to distinct keys before they meet the records.
    """
    since = run_date - dt.timedelta(days=days)
    posted = charges.where(
        (F.col("post_date") >= F.lit(since)) & (F.coalesce(F.col("quantity"), F.lit(0)) > 0)
    )
    still_open = records.where(F.col("thru_date") == F.lit(FAR_DATE))
    return (
        posted.select(*KEYS).distinct().join(still_open.select(*KEYS), list(KEYS), "left_semi")
    )


def _stamp(
    queue: DataFrame, hit: Column, result: Column, run_ts: dt.datetime, job_id: int
) -> DataFrame:
    types = dict(queue.dtypes)
    new = {
        "result_date": result,
        "modified_at": F.lit(run_ts).cast(types["modified_at"]),
        "job_id": F.lit(job_id).cast(types["job_id"]),
    }
    return queue.withColumns(
        {c: F.when(hit, v).otherwise(F.col(c)) for c, v in new.items()}
    )


def requeue(
    queue: DataFrame, keys: DataFrame, run_ts: dt.datetime, job_id: int
) -> DataFrame:
    """The queue with the result date of the given keys taken back."""
    marks = keys.select(*KEYS).distinct().withColumn("__hit", F.lit(True))
    joined = queue.join(marks, list(KEYS), "left")
    hit = F.coalesce(F.col("__hit"), F.lit(False))
    nothing = F.lit(None).cast("date")
    return _stamp(joined, hit, nothing, run_ts, job_id).select(*queue.columns)


def already_queued(sources: DataFrame, queue: DataFrame) -> DataFrame:
    """Ids of newest source records that the queue holds, under its id or its negated source key."""
    newest = latest_rows(
        sources,
        ["source_key", "tenant"],
        [F.col("modified_at").desc(), F.col("added_at").desc(), F.col("record_id").desc()],
    ).withColumn("__negated", -F.col("source_key").try_cast("bigint"))
    return either_key_matches(
        newest,
        queue,
        [
            [("tenant", "tenant"), ("record_id", "record_id")],
            [("tenant", "tenant"), ("__negated", "record_id")],
        ],
        ["tenant", "record_id"],
    )


def missing_work(
    records: DataFrame,
    history: DataFrame,
    queue: DataFrame,
    sources: DataFrame,
) -> DataFrame:
    """Open records with a positive id that have no history and are not queued yet."""
    wanted = records.where(
        (F.col("thru_date") == F.lit(FAR_DATE)) & (F.col("record_id") > 0)
    )
    return (
        wanted.join(history.select(*KEYS), list(KEYS), "left_anti")
        .join(already_queued(sources, queue), list(KEYS), "left_anti")
        .select("record_id", "authority", "tenant")
        .distinct()
    )


def new_items(
    missing: DataFrame, columns: Sequence[str], run_date: dt.date, run_ts: dt.datetime, job_id: int
) -> DataFrame:
    """Missing work as queue rows, in the order of the queue's columns."""
    return missing.withColumns(
        {
            "job_id": F.lit(job_id).cast("bigint"),
            "added_at": F.lit(run_ts).cast("timestamp_ntz"),
            "modified_at": F.lit(run_ts).cast("timestamp_ntz"),
            "extract_date": F.lit(run_date),
            "result_date": F.lit(None).cast("date"),
        }
    ).select(*columns)


def requeue_and_insert(
    queue: DataFrame,
    recent: DataFrame,
    missing: DataFrame,
    run_date: dt.date,
    run_ts: dt.datetime,
    job_id: int,
    mark: str | None = None,
) -> DataFrame:
    """``requeue`` and ``new_items`` in one pass: one full outer join of the queue with its changes.

    A recent key takes its queue row's result date back; a missing record that the queue does not
    hold becomes a row, one for each of its authorities. A key that the queue holds is not added
    again, since (tenant, record_id) is its key. ``mark`` names a column that says what happened to
    the row: ``kept``, ``requeued`` or ``inserted``.
    """
    # a struct keeps a NULL authority, which is a row of its own
    new = missing.select(*KEYS, F.lit(False).alias("__hit"), F.struct("authority").alias("__new"))
    nothing = F.lit(None).cast(new.schema["__new"].dataType)
    again = recent.select(*KEYS).distinct().withColumns({"__hit": F.lit(True), "__new": nothing})
    # a key's set holds its authorities, of which a record has few
    changes = again.unionByName(new).groupBy(*KEYS).agg(
        F.max("__hit").alias("__hit"), F.collect_set("__new").alias("__new")
    )
    held = queue.withColumn("__held", F.lit(True))
    joined = held.join(changes, list(KEYS), "full")
    kept = F.coalesce("__held", F.lit(False))
    joined = joined.where(kept | (F.size("__new") > 0))
    each = F.when(kept, F.array(nothing)).otherwise(F.col("__new"))
    joined = joined.withColumn("__one", F.explode(each))
    hit = F.coalesce("__hit", F.lit(False))
    stamped = _stamp(joined, ~kept | hit, F.lit(None).cast("date"), run_ts, job_id)
    types = dict(queue.dtypes)
    added = {
        "authority": F.col("__one.authority"),
        "added_at": F.lit(run_ts),
        "extract_date": F.lit(run_date),
    }
    out = stamped.withColumns(
        {c: F.when(kept, F.col(c)).otherwise(v.cast(types[c])) for c, v in added.items()}
    )
    if mark is None:
        return out.select(*queue.columns)
    what = F.when(~kept, "inserted").when(hit, "requeued").otherwise("kept")
    return out.select(*queue.columns, what.alias(mark))


def mark_done(
    queue: DataFrame, history: DataFrame, run_date: dt.date, run_ts: dt.datetime, job_id: int
) -> DataFrame:
    """The queue with today as result date where history exists and the item was due."""
    known = history.select(*KEYS).distinct().withColumn("__known", F.lit(True))
    joined = queue.join(known, list(KEYS), "left")
    due = never_or_stale(F.col("extract_date"), F.col("result_date"))
    hit = F.coalesce(F.col("__known"), F.lit(False)) & due
    return _stamp(joined, hit, F.lit(run_date), run_ts, job_id).select(*queue.columns)


def high_water_mark(
    job_log: DataFrame, script: str, tenant: str | None, default: dt.date
) -> DataFrame:
    """One row: when the last completed run of a script started, or the default."""
    done = job_log.where((F.col("script") == script) & (F.col("state") == "C"))
    if tenant is not None:
        done = done.where(F.col("tenant") == tenant)
    return done.agg(F.coalesce(F.max("start_date"), F.lit(default)).alias("high_water"))
