"""Calendar, grid, totals to date and dated facts."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.catalog.fixtures import RUN_DATE, SPAN
from tidemark.catalog.registry import Inputs, query
from tidemark.operators import snapshot as N
from tidemark.operators import workqueue as W

KEYS = ["tenant", "record_id"]
POINT = """(calendar_date = last_day(calendar_date) OR calendar_date = DATE '2001-06-15')"""
ME = f"""SELECT calendar_date AS snapshot_date FROM period_calendar WHERE {POINT}
    AND calendar_date BETWEEN DATE '2000-06-30' AND DATE '2001-06-16'"""


@query(f"""
    SELECT calendar_date AS snapshot_date FROM period_calendar WHERE {POINT}
    AND calendar_date BETWEEN DATE '1998-07-01' AND DATE '2001-06-15'
""")
def snapshot_calendar_h(t: Inputs):
    start = N.start_date("H", full_start=dt.date(1998, 7, 1))
    return N.snapshot_calendar(t.period_calendar, N.Span("H", start, RUN_DATE))


@query(f"""
    SELECT calendar_date AS snapshot_date FROM period_calendar WHERE {POINT}
    AND calendar_date <= DATE '2001-06-16' AND calendar_date >= (
      SELECT coalesce(max(CAST(ts AS DATE)) - 9000, DATE '2013-01-01') FROM events
      WHERE event_type = 'purchase')
""")
def snapshot_calendar_i(t: Inputs):
    """Incremental: from the last completed run, which the event log tells."""
    log = t.events.select(
        F.col("event_type").alias("script"),
        F.lit("C").alias("state"),
        F.date_sub(F.col("ts").cast("date"), 9000).alias("start_date"),
    )
    mark = W.high_water_mark(log, "purchase", None, N.FIRST_RUN_START).first()["high_water"]
    start = N.start_date("I", high_water=mark)
    return N.snapshot_calendar(t.period_calendar, N.Span("I", start, RUN_DATE))


@query(ME)
def snapshot_calendar_s(t: Inputs):
    return N.snapshot_calendar(t.period_calendar, SPAN)


@query(f"""
    SELECT r.tenant, r.record_id, r.authority, r.class_code, m.snapshot_date
    FROM records r JOIN ({ME}) m ON m.snapshot_date BETWEEN r.from_date AND r.thru_date
""")
def record_snapshots(t: Inputs):
    grid = N.snapshot_grid(t.records, SPAN, t.period_calendar)
    return grid.select(*KEYS, "authority", "class_code", "snapshot_date")


@query("""
    SELECT r.tenant, r.record_id, m.snapshot_date
    FROM records r JOIN (
      SELECT CAST(d AS DATE) AS snapshot_date
      FROM generate_series(DATE '1999-01-01', DATE '2001-06-15', INTERVAL 1 DAY) AS g(d)
      WHERE CAST(d AS DATE) = last_day(d) OR CAST(d AS DATE) = DATE '2001-06-15') m
    ON m.snapshot_date BETWEEN r.from_date AND r.thru_date
""")
def record_snapshots_no_calendar(t: Inputs):
    """The grid without a calendar table: every month end of the span."""
    span = N.Span("H", dt.date(1999, 1, 1), RUN_DATE)
    return N.snapshot_grid(t.records, span).select(*KEYS, "snapshot_date")


@query(f"""
    SELECT r.tenant, r.record_id, m.snapshot_date,
           CAST(sum(c.quantity) AS DECIMAL(38, 3)) AS quantity, count(*) AS charge_rows
    FROM records r JOIN ({ME}) m ON m.snapshot_date BETWEEN r.from_date AND r.thru_date
    JOIN charges c ON c.tenant = r.tenant AND c.record_id = r.record_id
      AND c.post_date <= m.snapshot_date
    GROUP BY r.tenant, r.record_id, m.snapshot_date
""")
def charges_to_date(t: Inputs):
    measures = {"quantity": F.col("quantity"), "charge_rows": F.lit(1)}
    totals = N.totals_to_date(
        t.records, t.charges, SPAN, KEYS, "post_date", measures, t.period_calendar
    )
    return totals.withColumn("quantity", F.col("quantity").cast("decimal(38,3)"))


@query(f"""
    SELECT r.tenant, r.record_id, m.snapshot_date, b.total_charge
    FROM records r JOIN ({ME}) m ON m.snapshot_date BETWEEN r.from_date AND r.thru_date
    LEFT JOIN balances b ON b.tenant = r.tenant AND b.record_id = r.record_id
      AND m.snapshot_date BETWEEN b.from_date AND b.thru_date
""")
def dated_fact_lookup(t: Inputs):
    grid = N.snapshot_grid(t.records, SPAN, t.period_calendar).select(*KEYS, "snapshot_date")
    return N.fact_as_of(grid, t.balances, KEYS, "from_date", "thru_date")


@query("""
    SELECT h.patient_class, count(*) AS records
    FROM active_customers r LEFT JOIN stored_days h ON h.tenant = r.tenant AND h.record_id = r.record_id
      AND DATE '2000-03-15' BETWEEN h.from_date AND h.thru_date
    WHERE DATE '2000-03-15' BETWEEN r.from_date AND r.thru_date
    GROUP BY h.patient_class
""")
def class_counts_asof(t: Inputs):
    return N.class_counts(
        t.active_customers, t.stored_days, KEYS, "patient_class", dt.date(2000, 3, 15)
    )


@query("""
    SELECT event_type AS script, coalesce(max(CASE WHEN value < 400 THEN CAST(ts AS DATE) END),
      DATE '2013-01-01') AS high_water
    FROM events WHERE event_type = 'click' GROUP BY event_type
""")
def high_water_mark(t: Inputs):
    log = t.events.select(
        F.col("event_type").alias("script"),
        F.when(F.col("value") < 400, "C").otherwise("E").alias("state"),
        F.col("ts").cast("date").alias("start_date"),
    )
    return W.high_water_mark(log, "click", None, N.FIRST_RUN_START).withColumn(
        "script", F.lit("click")
    )
