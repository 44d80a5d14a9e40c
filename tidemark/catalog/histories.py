"""Effective-dated history over customers' order days."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.catalog.registry import Inputs, query
from tidemark.operators import history as H
from tidemark.sources import tables as S

NOW = dt.datetime(2001, 6, 16)
START = dt.date(1999, 12, 31)
VALUES = ["patient_class", "service_line_1"]
W3 = "(PARTITION BY tenant, record_id, authority ORDER BY from_date)"
CONCAT = "coalesce({0}patient_class, 'NA') || coalesce({0}service_line_1, 'NA')"

BY_VALUE = f"""
    SELECT * FROM staged_days QUALIFY row_number() OVER {W3} = 1
      OR lag(patient_class) OVER {W3} IS DISTINCT FROM patient_class
      OR lag(service_line_1) OVER {W3} IS DISTINCT FROM service_line_1
"""
BY_TEXT = f"""
    SELECT * FROM {{0}} QUALIFY coalesce(lag({CONCAT.format('')}) OVER {W3}, 'N/A')
      <> {CONCAT.format('')}
"""


@query(BY_VALUE.replace("staged_days", "all_days"))
def compress_history(t: Inputs):
    return H.only_changes(t.all_days, VALUES)


@query(BY_TEXT.format("all_days"))
def compress_concat_key(t: Inputs):
    return H.only_changes(t.all_days, VALUES, as_text=True)


@query("""
    SELECT tenant, record_id, from_date, CAST(row_number() OVER
      (PARTITION BY tenant, record_id ORDER BY from_date) AS INT) AS row_num FROM all_days
""")
def numbered_rows(t: Inputs):
    return H.numbered(t.all_days).select("tenant", "record_id", "from_date", "row_num")


def _boundary(kept: str, stored: str) -> str:
    return f"""
    SELECT k.* EXCLUDE (row_num) FROM (
      SELECT *, row_number() OVER (PARTITION BY tenant, record_id ORDER BY from_date) AS row_num
      FROM ({kept})) k
    LEFT JOIN {stored} s ON k.row_num = 1 AND s.tenant = k.tenant AND s.record_id = k.record_id
      AND s.thru_date = DATE '2041-01-01'
    WHERE {CONCAT.format('s.')} <> {CONCAT.format('k.')} OR k.row_num <> 1
    """


@query(_boundary(BY_TEXT.format("staged_days"), "stored_before"))
def boundary_check(t: Inputs):
    kept = H.only_changes(t.staged_days, VALUES, as_text=True)
    return H.beyond_stored(kept, t.stored_before, VALUES, as_text=True)


@query("""
    SELECT tenant, record_id, from_date, patient_class, coalesce(lead(from_date) OVER
      (PARTITION BY tenant, record_id ORDER BY from_date) - 1, DATE '2041-01-01') AS thru_date
    FROM all_days
""")
def rechain_intervals(t: Inputs):
    return H.rechain(t.all_days).select(
        "tenant", "record_id", "from_date", "patient_class", "thru_date"
    )


def _upserted(stored: str, incoming: str) -> str:
    return f"""
    SELECT coalesce(s.tenant, n.tenant) AS tenant, coalesce(s.record_id, n.record_id) AS record_id,
      coalesce(s.from_date, n.from_date) AS from_date,
      coalesce(s.authority, n.authority) AS authority,
      CASE WHEN n.tenant IS NULL THEN s.job_id ELSE 7 END AS job_id,
      coalesce(s.added_at, TIMESTAMP '2001-06-16 00:00:00') AS added_at,
      CASE WHEN n.tenant IS NULL THEN s.modified_at
           ELSE TIMESTAMP '2001-06-16 00:00:00' END AS modified_at,
      coalesce(s.thru_date, n.thru_date) AS thru_date,
      CASE WHEN n.tenant IS NULL THEN s.patient_class ELSE n.patient_class END AS patient_class,
      CASE WHEN n.tenant IS NULL THEN s.service_line_1 ELSE n.service_line_1 END AS service_line_1
    FROM {stored} s FULL JOIN {incoming} n ON n.tenant = s.tenant AND n.record_id = s.record_id
      AND n.from_date = s.from_date
    """


@query(_upserted("stored_days", "staged_days"))
def upsert_history(t: Inputs):
    return H.upsert(t.stored_days, t.staged_days, VALUES, NOW, 7)


@query("SELECT * FROM stored_days WHERE NOT (from_date > DATE '1999-12-31')")
def cut_history(t: Inputs):
    return H.cut_after(t.stored_days, START)


@query("""
    SELECT * FROM stored_days WHERE NOT (from_date >= DATE '1999-12-31' AND tenant = 'MACHINERY')
""")
def cut_tenant_inclusive(t: Inputs):
    return H.cut_after(t.stored_days, START, tenant="MACHINERY", inclusive=True)


CHAIN = """coalesce(lead(from_date) OVER (PARTITION BY tenant, record_id ORDER BY from_date) - 1,
    DATE '2041-01-01')"""
LOADED = f"""
    SELECT * EXCLUDE (thru_date), {CHAIN} AS thru_date FROM ({_upserted("remaining", "added")})
"""


@query(f"""
    WITH remaining AS (SELECT * FROM stored_days WHERE from_date <= DATE '1999-12-31'),
    added AS ({_boundary(BY_TEXT.format("staged_days"), "remaining")})
    {LOADED}
""")
def history_load_full(t: Inputs):
    """Cut, compress, boundary, upsert, chain; a stored row the cut left closed is not seen."""
    return H.load_history(t.stored_days, t.staged_days, VALUES, START, NOW, 7)


@query(f"""
    WITH remaining AS (SELECT * EXCLUDE (thru_date), {CHAIN} AS thru_date FROM stored_days
      WHERE from_date <= DATE '1999-12-31'),
    added AS ({_boundary(BY_TEXT.format("staged_days"), "remaining")})
    {LOADED}
""")
def history_load_rechained(t: Inputs):
    """The same with the remaining history chained again before the boundary check."""
    return H.load_history(
        t.stored_days, t.staged_days, VALUES, START, NOW, 7, parity=False
    )


def _class_rows(t: Inputs):
    return t.month_rows.select("tenant", "record_id", "from_date", "authority", "patient_class")


def _line_rows(t: Inputs):
    return t.month_rows.select("tenant", "record_id", "from_date", "line_1", "line_2")


@query("""
    SELECT tenant, record_id, from_date, authority, patient_class,
           CAST(NULL AS VARCHAR) AS line_1, CAST(NULL AS VARCHAR) AS line_2 FROM month_rows
    UNION ALL
    SELECT tenant, record_id, from_date, NULL, NULL, line_1, line_2 FROM month_rows
""")
def union_sparse(t: Inputs):
    return S.unite([_class_rows(t), _line_rows(t)])


@query("""
    SELECT DISTINCT c.tenant, c.record_id, c.from_date, c.authority, c.patient_class, a.line_1,
           b.line_2
    FROM month_rows c
    LEFT JOIN month_rows a ON a.tenant = c.tenant AND a.record_id = c.record_id
      AND a.from_date = c.from_date AND a.line_1 IS NOT NULL
    LEFT JOIN month_rows b ON b.tenant = c.tenant AND b.record_id = c.record_id
      AND b.from_date = c.from_date AND b.line_2 IS NOT NULL
""")
def pivot_sparse_rows(t: Inputs):
    rows = S.unite([_class_rows(t), _line_rows(t)])
    return H.fold_sparse_rows(
        rows,
        ["tenant", "record_id", "from_date"],
        ["authority", "patient_class"],
        "patient_class",
        ["line_1", "line_2"],
    )


@query("""
    SELECT * FROM stored_days WHERE tenant <> 'BUILDING'
    UNION ALL BY NAME
    SELECT record_id, from_date, authority, tenant, CAST(7 AS BIGINT) AS job_id,
      TIMESTAMP '2001-06-16 00:00:00' AS added_at, TIMESTAMP '2001-06-16 00:00:00' AS modified_at,
      thru_date, patient_class, service_line_1 FROM all_days WHERE tenant = 'BUILDING'
""")
def replace_slice(t: Inputs):
    """One tenant's rows deleted and loaded again."""
    stamp = F.lit(NOW).cast("timestamp_ntz")
    new = t.all_days.withColumns(
        {"job_id": F.lit(7).cast("bigint"), "added_at": stamp, "modified_at": stamp}
    )
    return S.replace_slice(t.stored_days, new, "tenant", "BUILDING")


@query("""
    SELECT tenant AS a, record_id AS b, from_date AS c, patient_class AS d FROM all_days
""")
def positional_insert(t: Inputs):
    rows = t.all_days.select("tenant", "record_id", "from_date", "patient_class")
    return S.by_position(rows, ["a", "b", "c", "d"])
