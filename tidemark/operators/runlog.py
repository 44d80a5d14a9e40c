"""Run control: job rows, step rows and the control row of a load."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators.snapshot import start_date
from tidemark.sources.slices import exists
from tidemark.sources.tables import align, append, empty_table, from_rows

# Job states.
RUNNING, COMPLETE, ERROR = "R", "C", "E"


@dataclass
class RunLog:
    """Appends the rows of one run to a job log and a step log.

    As a context manager it writes running, then complete or error; an error is raised again.
    """

    spark: SparkSession
    folder: str
    job_id: int
    script: str
    tenant: str
    start_date: dt.date
    steps_done: int = 0
    rows: int = 0
    clock: object = field(default=dt.datetime.now)

    def _job_row(self, state: str, message: str | None = None) -> None:
        row = (
            self.job_id, self.script, self.tenant, state, self.start_date,
            self.clock(), self.rows, message,
        )
        append(from_rows(self.spark, [row], schemas.JOB_LOG), f"{self.folder}/jobs")

    def __enter__(self) -> RunLog:
        self._job_row(RUNNING)
        return self

    def __exit__(self, kind, error, trace) -> bool:
        if error is None:
            self._job_row(COMPLETE)
        else:
            self._job_row(ERROR, f"{self.script} failed with error {error}")
        return False

    def step(self, description: str, row_count: int | None = None, phase: str = "end") -> None:
        """One step row; ``row_count`` is what this step itself changed."""
        if phase == "start":
            self.steps_done += 1
        row = (self.job_id, self.steps_done, phase, self.clock(), row_count, description)
        append(from_rows(self.spark, [row], schemas.JOB_STEPS), f"{self.folder}/steps")
        if row_count is not None:
            self.rows = row_count


class RunRefused(Exception):
    """Another run of the script and tenant has not ended yet."""


def last_runs(jobs: DataFrame, script: str, tenant: str) -> DataFrame:
    """Each run of a script and tenant: job_id, state (of its last row), began, start_date."""
    ended = F.max(F.when(F.col("state") != RUNNING, F.col("state")))
    return (
        jobs.where((F.col("script") == script) & (F.col("tenant") == tenant))
        .groupBy("job_id")
        .agg(
            F.coalesce(ended, F.lit(RUNNING)).alias("state"),
            F.min("logged_at").alias("began"),
            F.min("start_date").alias("start_date"),
        )
    )


def begin_run(
    spark: SparkSession,
    folder: str,
    script: str,
    tenant: str,
    run_type: str,
    run_date: dt.date,
    given: dt.date | None = None,
    stale_after: dt.timedelta = dt.timedelta(hours=12),
    clock: object = dt.datetime.now,
) -> tuple[RunLog, dt.date]:
    """The log of the next run of a script and tenant, and the date its data starts from.

    A run is running until it logs that it completed or failed. A run that is running refuses
    another one until it is ``stale_after`` old; then it counts as failed and is logged so. An
    incremental run starts where the last complete one was started, so a run after failed ones
    takes what they missed. The log is a table and no lock: two runs that begin in the same moment
    are not kept apart.
    """
    path = f"{folder}/jobs"
    jobs = spark.read.schema(schemas.JOB_LOG).parquet(path) if exists(spark, path) else empty_table(spark, schemas.JOB_LOG)
    for run in last_runs(jobs, script, tenant).where(F.col("state") == RUNNING).collect():
        if clock() - run.began < stale_after:
            raise RunRefused(f"run {run.job_id} of {script} for {tenant} is running since {run.began}")
        gone = RunLog(spark, folder, run.job_id, script, tenant, run.start_date, clock=clock)
        gone._job_row(ERROR, f"{script} was given up, running since {run.began}")
    job_id = (jobs.agg(F.max("job_id")).first()[0] or 0) + 1
    done = jobs.where((F.col("script") == script) & (F.col("tenant") == tenant) & (F.col("state") == COMPLETE))
    start = start_date(run_type, done.agg(F.max("start_date")).first()[0], given)
    return RunLog(spark, folder, job_id, script, tenant, run_date, clock=clock), start


def parameters(run_type: str, tenant: str, start: dt.date | None) -> str:
    """The text a step row gives for its parameters."""
    shown = start.isoformat() if start else " NO DATE "
    return f"run type: {run_type}; tenant: {tenant}; start: {shown}"


def control_row(
    metrics: DataFrame, started: dt.datetime, ended: dt.datetime, source_file: str
) -> DataFrame:
    """Metrics of a load as one row of the control table."""
    return align(
        metrics.withColumns(
            {
                "job_start_time": F.lit(started),
                "job_end_time": F.lit(ended),
                "source_file": F.lit(source_file),
            }
        ),
        schemas.CONTROL,
    )
