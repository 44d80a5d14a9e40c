"""Job-run report over the event table."""

from tidemark.catalog.registry import Inputs, query
from tidemark.operators import jobs as J

FIELDS = """
    SELECT *, CASE WHEN runtime > 1800 THEN 'Yes' ELSE 'No' END AS delay_flag,
           CAST(round(CAST(runtime AS DECIMAL(18, 6)) / 60, 1) AS DECIMAL(18, 1))
             AS runtime_minutes,
           CASE WHEN completion_status = 'ended not ok' OR completion_status IS NULL
                THEN 'Failure' WHEN runtime > 1800 THEN 'Delayed' ELSE 'Success' END AS status,
           CASE WHEN completion_status = 'ended not ok' OR completion_status IS NULL THEN 'Red'
                WHEN runtime > 1800 THEN 'Orange' ELSE 'Green' END AS status_color
    FROM jobs
"""
KPIS = """
    count(job_member_name) AS total_jobs,
    CAST(sum(CASE WHEN delay_flag = 'Yes' THEN 1 ELSE 0 END) AS BIGINT) AS delayed_jobs,
    CAST(sum(CASE WHEN delay_flag = 'Yes' THEN 1 ELSE 0 END) AS DOUBLE)
      / count(job_member_name) AS delayed_share,
    round(CAST(sum(runtime_minutes) AS DOUBLE) / count(runtime_minutes), 1) AS avg_minutes
"""


@query(f"""
    SELECT run_id, application, job_member_name, runtime, completion_status, delay_flag,
           runtime_minutes, status, status_color FROM ({FIELDS})
""")
def job_status_rows(t: Inputs):
    return J.run_fields(t.jobs).drop("start_time")


@query(f"SELECT {KPIS} FROM ({FIELDS})")
def job_kpis(t: Inputs):
    return J.measures(J.run_fields(t.jobs))


@query(f"""
    WITH k AS (SELECT status_color, {KPIS} FROM ({FIELDS}) GROUP BY status_color)
    SELECT status_color, 'Total Jobs' AS measure, CAST(total_jobs AS DOUBLE) AS value FROM k
    UNION ALL SELECT status_color, 'Total Delayed Jobs', CAST(delayed_jobs AS DOUBLE) FROM k
    UNION ALL SELECT status_color, '% Delayed Jobs', delayed_share FROM k
    UNION ALL SELECT status_color, 'Avg Runtime (Min)', avg_minutes FROM k
""")
def job_kpis_by_color(t: Inputs):
    return J.measures_by_color(J.run_fields(t.jobs))


@query(f"""
    SELECT application, CAST(start_time AS DATE) AS run_day, count(*) AS runs,
           round(CAST(sum(runtime_minutes) AS DOUBLE) / count(runtime_minutes), 1) AS avg_minutes
    FROM ({FIELDS}) GROUP BY ALL
""")
def job_runtime_trend(t: Inputs):
    return J.runtime_trend(J.run_fields(t.jobs))


@query("""
    SELECT run_id, job_member_name, runtime FROM jobs ORDER BY runtime DESC, run_id LIMIT 25
""")
def job_top_slowest(t: Inputs):
    return J.top_slowest(t.jobs.select("run_id", "job_member_name", "runtime"), 25)


@query("""
    SELECT application, count(*) AS runs, quantile_cont(CAST(runtime AS DOUBLE), 0.25) AS q1,
           quantile_cont(CAST(runtime AS DOUBLE), 0.5) AS median,
           quantile_cont(CAST(runtime AS DOUBLE), 0.75) AS q3
    FROM jobs GROUP BY application
""")
def job_runtime_quartiles(t: Inputs):
    return J.runtime_quartiles(t.jobs)


@query("""
    SELECT CAST(isodow(start_time) AS INT) AS weekday, CAST(hour(start_time) AS INT) AS hour,
           count(*) AS runs, CAST(count(*) FILTER (runtime > 1800) AS BIGINT) AS delayed
    FROM jobs GROUP BY ALL
""")
def job_delay_heatmap(t: Inputs):
    return J.delay_heatmap(t.jobs)


@query(f"""
    SELECT application, job_member_name, count(*) AS runs,
           count(*) FILTER (status = 'Failure') AS failures,
           count(*) FILTER (status = 'Delayed') AS delays,
           CAST(count(*) FILTER (status <> 'Success') AS DOUBLE) / count(*) AS missed_share,
           CAST(count(*) FILTER (status <> 'Success') AS DOUBLE) / count(*) > 0.25 AS alert
    FROM ({FIELDS}) GROUP BY application, job_member_name
""")
def job_sla_summary(t: Inputs):
    return J.sla_summary(J.run_fields(t.jobs), 0.25)
