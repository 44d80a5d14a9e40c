"""Job-run report: row fields, measures and sheets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.rules import Rule, first_match

# The delay threshold in seconds, the failed text, states and colours.
DELAY_SECONDS = 1800
FAILED_TEXT = "ended not ok"
FAILURE, DELAYED, SUCCESS = "Failure", "Delayed", "Success"
RED, ORANGE, GREEN = "Red", "Orange", "Green"
YES, NO = "Yes", "No"
MEASURES = ("Total Jobs", "Total Delayed Jobs", "% Delayed Jobs", "Avg Runtime (Min)")


def is_delayed() -> Column:
    return F.col("runtime") > DELAY_SECONDS


def mean_minutes() -> Column:
    """Mean of the rounded minutes, rounded again. The sum is a decimal, so its order is free."""
    minutes = F.sum("runtime_minutes").cast("double")
    return F.round(F.try_divide(minutes, F.count("runtime_minutes")), 1)


def run_fields(runs: DataFrame) -> DataFrame:
    """Delay flag, minutes, status and colour of each run."""
    failed = (F.col("completion_status") == FAILED_TEXT) | F.col("completion_status").isNull()
    minutes = F.round(F.col("runtime").cast("decimal(18,6)") / F.lit(60), 1)
    status = first_match([Rule(FAILURE, failed), Rule(DELAYED, is_delayed())], SUCCESS)
    color = first_match(
        [Rule(RED, F.col("status") == FAILURE), Rule(ORANGE, F.col("status") == DELAYED)], GREEN
    )
    return runs.withColumns(
        {
            "delay_flag": F.when(is_delayed(), YES).otherwise(NO),
            "runtime_minutes": minutes.cast("decimal(18,1)"),
            "status": status,
        }
    ).withColumn("status_color", color)


def measures(runs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The four measures, in total or by columns. Runs without a name are not counted."""
    total = F.count("job_member_name")
    delayed = F.sum(F.when(F.col("delay_flag") == YES, 1).otherwise(0))
    return runs.groupBy(*by).agg(
        total.alias("total_jobs"),
        delayed.alias("delayed_jobs"),
        F.try_divide(delayed.cast("double"), total).alias("delayed_share"),
        mean_minutes().alias("avg_minutes"),
    )


def measures_by_color(runs: DataFrame) -> DataFrame:
    """The overview sheet: one row per colour and measure."""
    columns = ("total_jobs", "delayed_jobs", "delayed_share", "avg_minutes")
    pairs = ", ".join(
        f"'{name}', cast({column} as double)" for name, column in zip(MEASURES, columns)
    )
    return measures(runs, ["status_color"]).selectExpr(
        "status_color", f"stack(4, {pairs}) as (measure, value)"
    )


def runtime_trend(runs: DataFrame) -> DataFrame:
    """Runs and mean minutes by application and day."""
    day = F.col("start_time").cast("date").alias("run_day")
    return runs.groupBy("application", day).agg(
        F.count(F.lit(1)).alias("runs"),
        mean_minutes().alias("avg_minutes"),
    )


def top_slowest(runs: DataFrame, n: int) -> DataFrame:
    """The n longest runs; ties go to the lower run id. Each task keeps n rows, no full sort."""
    return runs.orderBy(F.col("runtime").desc(), F.col("run_id").asc()).limit(n)


def runtime_quartiles(runs: DataFrame) -> DataFrame:
    """Exact quartiles of the runtime in seconds by application.

    Runtimes are whole seconds: counting equal ones first bounds what an application's
    percentile holds by the range of runtimes instead of the number of runs.
    """
    counted = runs.groupBy("application", "runtime").agg(F.count(F.lit(1)).alias("n"))
    at = F.percentile("runtime", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.col("n"))
    return counted.groupBy("application").agg(at.alias("q"), F.sum("n").alias("runs")).select(
        "application",
        "runs",
        *[F.col("q")[i].alias(name) for i, name in enumerate(("q1", "median", "q3"))],
    )


def delay_heatmap(runs: DataFrame) -> DataFrame:
    """Delayed runs by day of the week (1 Monday) and hour."""
    start = F.col("start_time")
    weekday = (F.weekday(start) + 1).alias("weekday")
    return runs.groupBy(weekday, F.hour(start).alias("hour")).agg(
        F.count(F.lit(1)).alias("runs"), F.count_if(is_delayed()).alias("delayed")
    )


def sla_summary(runs: DataFrame, limit: float) -> DataFrame:
    """Failure and delay rates by job, with an alert where their sum passes the limit."""
    per_job = runs.groupBy("application", "job_member_name").agg(
        F.count(F.lit(1)).alias("runs"),
        F.count_if(F.col("status") == FAILURE).alias("failures"),
        F.count_if(F.col("status") == DELAYED).alias("delays"),
    )
    bad = (F.col("failures") + F.col("delays")).cast("double") / F.col("runs")
    return per_job.withColumns(
        {"missed_share": bad, "alert": bad > F.lit(limit)}
    )
