"""Plain forms of rewritten operators, for comparison only: the join as it is written."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from tidemark.catalog.registry import Inputs

_CALENDAR = """(SELECT calendar_date AS snapshot_date FROM {period_calendar}
    WHERE (calendar_date = last_day(calendar_date) OR calendar_date = DATE '2001-06-15')
    AND calendar_date BETWEEN DATE '2000-06-30' AND DATE '2001-06-16') m"""

PLAIN = {
    "record_snapshots": f"""
    SELECT r.tenant, r.record_id, r.authority, r.class_code, m.snapshot_date
    FROM {{records}} r JOIN {_CALENDAR} ON m.snapshot_date BETWEEN r.from_date AND r.thru_date
    """,
    "charges_to_date": f"""
    SELECT r.tenant, r.record_id, m.snapshot_date, sum(c.quantity) AS quantity,
           count(*) AS charge_rows
    FROM {{records}} r JOIN {_CALENDAR} ON m.snapshot_date BETWEEN r.from_date AND r.thru_date
    JOIN {{charges}} c ON c.tenant = r.tenant AND c.record_id = r.record_id
      AND c.post_date <= m.snapshot_date
    GROUP BY r.tenant, r.record_id, m.snapshot_date
    """,
    "or_key_join": """
    SELECT DISTINCT e.tenant, e.record_id FROM (SELECT *, row_number() OVER (
      PARTITION BY source_key, tenant ORDER BY modified_at DESC, added_at DESC, record_id DESC) AS place
      FROM {sources}) e JOIN {queue} q ON e.place = 1 AND q.tenant = e.tenant
      AND (q.record_id = e.record_id OR q.record_id = -TRY_CAST(e.source_key AS BIGINT))
    """,
    # closing, then inserting: both join the whole table, closed rows included
    "scd2_with_deletes": """
    WITH after_close AS (
      SELECT o.client_id, o.claim_id, o.status, o.first_status, o.segment, o.effective_date,
             CASE WHEN o.termination_date = '9999-12-31' AND (
               o.status <> s.status OR o.first_status <> s.first_status OR o.segment <> s.segment
               OR (s.client_id IS NULL AND o.client_id IS NOT NULL AND o.claim_id IS NOT NULL))
             THEN '2002-01-01' ELSE o.termination_date END AS termination_date
      FROM {target} o LEFT JOIN {stage} s ON s.client_id = o.client_id AND s.claim_id = o.claim_id)
    SELECT * FROM after_close
    UNION ALL
    SELECT s.client_id, s.claim_id, s.status, s.first_status, s.segment, DATE '2002-01-01', '9999-12-31'
    FROM {stage} s LEFT ANTI JOIN after_close o ON o.client_id = s.client_id
      AND o.claim_id = s.claim_id AND o.termination_date = '9999-12-31'
    """,
}
# Quadratic in a tenant's rows: timed on the small tables, with the rewritten form beside it.
QUADRATIC = ("or_key_join",)


def plain_frame(name: str, spark: SparkSession, folder: str) -> DataFrame:
    inputs = Inputs(spark, folder)
    text = PLAIN[name]
    names = set(re.findall(r"{(\w+)}", text))
    return spark.sql(text, **{n: getattr(inputs, n) for n in names})
