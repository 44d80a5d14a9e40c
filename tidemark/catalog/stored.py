"""Loads and reads of tables stored by slices, each over a whole table."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.catalog.histories import BY_TEXT, LOADED, NOW, START, VALUES, _boundary
from tidemark.catalog.registry import Inputs, query
from tidemark.catalog.storage import _scratch
from tidemark.catalog.versions import COLS, PLAIN, SPEC, _load, _metrics
from tidemark.operators import activity, runlog
from tidemark.plans import stored_loads as L
from tidemark.sources import slices as P
from tidemark.sources import tables as S

FIRST, SECOND = "2002-01-01", "2002-02-01"
ONCE = _load(PLAIN, reopen=True, retire=True)
TWICE = _load(PLAIN, reopen=True, retire=True, target="once", stage="open_extract", day=SECOND)


def _two_loads(t: Inputs) -> tuple[str, str]:
    """The stored history after two loads, and the control table they appended to."""
    path, control = _scratch(t, "versions"), _scratch(t, "control")
    L.lay_out_versions(t.target, path, SPEC)
    for stage, day in ((t.stage, FIRST), (t.open_extract, SECOND)):
        day = dt.date.fromisoformat(day)
        L.load_versions(t.spark, stage, path, control, t.target.schema, SPEC, day, f"{day}.csv")
    return path, control


@query(f"WITH once AS ({ONCE}) SELECT {COLS} FROM ({TWICE})")
def scd2_load_stored(t: Inputs):
    """Two loads of a stored history; neither reads a closed row."""
    return L.read_versions(t.spark, _two_loads(t)[0], t.target.schema)


@query(f"""
    WITH once AS ({ONCE})
    SELECT *, '{FIRST}.csv' AS source_file FROM ({_metrics("target", "stage")})
    UNION ALL SELECT *, '{SECOND}.csv' FROM ({_metrics("once", "open_extract")})
""")
def scd2_load_stored_control(t: Inputs):
    """The control rows of both loads, counted by the jobs that wrote the rows."""
    rows = S.read_path(t.spark, _two_loads(t)[1])
    return rows.drop("job_start_time", "job_end_time")


TENANTS = ("MACHINERY", "BUILDING")
_IN = ", ".join(f"'{x}'" for x in TENANTS)
_REMAINING = f"""SELECT * FROM stored_days WHERE from_date <= DATE '1999-12-31' AND tenant IN ({_IN})"""
_ADDED = _boundary(BY_TEXT.format(f"(SELECT * FROM staged_days WHERE tenant IN ({_IN}))"), "remaining")


def _tenant_loads(t: Inputs) -> tuple[str, dict[str, L.Affected]]:
    path = _scratch(t, "history")
    P.replace_slices(t.stored_days, path, "tenant", [])
    schema = t.stored_days.schema
    found = {
        tenant: L.load_tenant_history(
            t.spark, t.staged_days, path, schema, tenant, VALUES, START, NOW, 7, parity=True
        )
        for tenant in TENANTS
    }
    return path, found


@query(f"""
    WITH remaining AS ({_REMAINING}), added AS ({_ADDED})
    SELECT * FROM ({LOADED})
    UNION ALL BY NAME SELECT * FROM stored_days WHERE tenant NOT IN ({_IN})
""")
def history_load_tenant(t: Inputs):
    """Two tenants' loads on a history stored by tenant; the others' slices stay as they are."""
    path, _ = _tenant_loads(t)
    return P.read_slices(t.spark, path, t.stored_days.schema)


@query(f"""
    WITH remaining AS ({_REMAINING}), added AS ({_ADDED}),
    late AS (SELECT * FROM stored_days WHERE from_date > DATE '1999-12-31'),
    touched AS (SELECT tenant, record_id FROM staged_days UNION SELECT tenant, record_id FROM late),
    same AS (SELECT a.tenant FROM added a JOIN remaining r ON r.tenant = a.tenant
      AND r.record_id = a.record_id AND r.from_date = a.from_date)
    SELECT x.tenant,
      (SELECT count(*) FROM late WHERE late.tenant = x.tenant) AS cut,
      (SELECT count(*) FROM added WHERE added.tenant = x.tenant)
        - (SELECT count(*) FROM same WHERE same.tenant = x.tenant) AS inserted,
      (SELECT count(*) FROM same WHERE same.tenant = x.tenant) AS updated,
      (SELECT count(*) FROM stored_days s WHERE s.tenant = x.tenant AND NOT EXISTS (SELECT 1
        FROM touched t WHERE t.tenant = s.tenant AND t.record_id = s.record_id)) AS passed_by
    FROM (VALUES {", ".join(f"('{x}')" for x in TENANTS)}) AS x(tenant)
""")
def history_rows_affected(t: Inputs):
    """What each tenant's load changed, as counted by its write."""
    _, found = _tenant_loads(t)
    rows = [(k, a.cut, a.inserted, a.updated, a.passed_by) for k, a in found.items()]
    kinds = [("tenant", T.StringType()), *((c, T.LongType()) for c in ("cut", "inserted", "updated", "passed_by"))]
    return S.from_rows(t.spark, rows, T.StructType([T.StructField(*k) for k in kinds]))


RUNS = [("1998-01-15", False), ("1998-02-15", True), ("1998-02-16", False), ("1998-03-15", False)]
STARTS = ["2013-01-01", "1998-01-15", "1998-01-15", "1998-02-16"]


class _Broken(Exception):
    pass


def _run_rows() -> str:
    out = []
    for i, ((day, fails), start) in enumerate(zip(RUNS, STARTS, strict=True), 1):
        n = f"(SELECT count(*) FROM charges WHERE post_date >= DATE '{start}' AND post_date < DATE '{day}')"
        message = "'charges failed with error the disk is full'" if fails else "CAST(NULL AS VARCHAR)"
        out += [
            f"SELECT {i} AS job_id, 'R' AS state, DATE '{day}' AS start_date, CAST(0 AS BIGINT) AS row_count, CAST(NULL AS VARCHAR) AS message",
            f"SELECT {i}, '{'E' if fails else 'C'}', DATE '{day}', {n}, {message}",
        ]
    return " UNION ALL ".join(out).replace("SELECT 1 AS job_id", "SELECT CAST(1 AS BIGINT) AS job_id")


@query(_run_rows())
def run_restart_log(t: Inputs):
    """Job rows of incremental runs, of which one fails: the next one starts where it had started."""
    folder = _scratch(t, "log")
    for day, fails in RUNS:
        day = dt.date.fromisoformat(day)
        log, start = runlog.begin_run(t.spark, folder, "charges", "ALL", "I", day)
        try:
            with log:
                text = runlog.parameters("I", "ALL", start)
                log.step(text, phase="start")
                posted = (F.col("post_date") >= F.lit(start)) & (F.col("post_date") < F.lit(day))
                log.step(text, t.charges.where(posted).count())
                if fails:
                    raise _Broken("the disk is full")
        except _Broken:
            pass
    return S.read_path(t.spark, f"{folder}/jobs").drop("script", "tenant", "logged_at")


@query("""
    SELECT tenant, record_id, CAST(sum(quantity) AS DECIMAL(29, 3)) AS quantity,
      CAST(sum(CASE WHEN procedure_code IN (SELECT source_key FROM terms WHERE term_key LIKE 'PX%')
        THEN quantity ELSE 0 END) AS DECIMAL(29, 3)) AS mapped,
      CAST(sum(CASE WHEN item_code IN (SELECT max(p_type) FROM part GROUP BY p_brand)
        THEN quantity ELSE 0 END) AS DECIMAL(29, 3)) AS last_of_brand,
      CAST(sum(CASE WHEN item_code NOT IN (SELECT p_type FROM part WHERE p_size < 3)
        THEN quantity ELSE 0 END) AS DECIMAL(29, 3)) AS not_small
    FROM charges GROUP BY tenant, record_id
""")
def subquery_counters(t: Inputs):
    """Quantities by code lists that are tables, a list of absent codes among them."""
    by_procedure = {"mapped": t.terms.where("term_key LIKE 'PX%'").select("source_key")}
    brands = t.part.groupBy("p_brand").agg(F.max("p_type").alias("p_type")).select("p_type")
    by_item = {"last_of_brand": brands, "not_small": t.part.where("p_size < 3").select("p_type")}
    keys = ["tenant", "record_id"]
    one = activity.subquery_counters(t.charges, keys, "procedure_code", by_procedure)
    two = activity.subquery_counters(t.charges, keys, "item_code", by_item, absent=["not_small"])
    kind = "decimal(29,3)"
    return one.join(two.drop("quantity"), keys).select(
        *keys, *[F.col(c).cast(kind).alias(c) for c in ("quantity", "mapped", "last_of_brand", "not_small")]
    )


@query("""
    SELECT tenant, record_id, post_date, quantity, item_code FROM charges
    WHERE tenant = '2-HIGH' AND post_date BETWEEN DATE '1998-03-10' AND DATE '1998-04-20'
""")
def layout_pruned_read(t: Inputs):
    """Charges written by tenant slot and month; one tenant's days read from their folders only."""
    rows = t.charges.select("tenant", "record_id", "post_date", "quantity", "item_code")
    path = _scratch(t, "layout")
    P.write_layout(rows, path, "tenant", "post_date")
    days = ("post_date", dt.date(1998, 3, 10), dt.date(1998, 4, 20))
    return P.read_layout(t.spark, path, rows.schema, ("tenant", "2-HIGH"), days)
