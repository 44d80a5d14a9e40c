"""Tables as they are declared: catalog tables, texts compared without case, column roles."""

import uuid
from dataclasses import fields, replace

from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.catalog.fixtures import SETTINGS, SPAN
from tidemark.catalog.registry import Inputs, query
from tidemark.catalog.classes import ALL, _pending, _tables
from tidemark.catalog.storage import _scratch
from tidemark.catalog.versions import RUN_DATE, SPEC
from tidemark.catalog.work import NEWEST, NOW, RECENT
from tidemark.functions.text import cased, caseless, folded, like
from tidemark.operators import classify as C
from tidemark.operators import fixed as X
from tidemark.operators import lookup as L
from tidemark.operators import roles as R
from tidemark.operators import scd2
from tidemark.operators import workqueue as W
from tidemark.plans import stored_loads
from tidemark.sources import tables as S

TARGET_COLUMNS = ", ".join(schemas.TARGET.names)


def _table(t: Inputs, schema) -> str:
    """A new catalog table of the schema."""
    name = f"tidemark_{uuid.uuid4().hex}"
    S.create_empty(t.spark, name, schema)
    return name


def _bootstrapped(t: Inputs) -> str:
    """The 33-column target, filled by name from rows whose columns lie in another order."""
    name = _table(t, schemas.TARGET)
    rows = t.old_surveys
    S.insert_into(rows.select(*reversed(rows.columns)), name)
    return name


@query(f"""
    SELECT {TARGET_COLUMNS} FROM old_surveys
    UNION ALL SELECT *, DATE '2002-01-01', NULL FROM surveys
""")
def catalog_target(t: Inputs):
    """The declared target created empty, filled by name and by position, read from the catalog."""
    name = _bootstrapped(t)
    later = t.surveys.withColumns(
        {"effective_date": F.lit(RUN_DATE), "termination_date": F.lit(None).cast("string")}
    )
    unnamed = later.toDF(*[f"c{i}" for i in range(len(later.columns))])
    S.insert_into(S.by_position(unnamed, schemas.TARGET.names), name)
    return S.read_table(t.spark, name).select(*schemas.TARGET.names)


KEYS33 = " AND ".join(f"s.{k} = o.{k}" for k in schemas.TARGET_KEYS)
CHANGED33 = " OR ".join(
    f"o.{c} <> s.{c}"
    for c in schemas.TARGET_TEXT_COLUMNS
    if c not in (*schemas.TARGET_KEYS, "file_name")
)


@query(f"""
    WITH closed AS (
      SELECT o.* REPLACE (CASE WHEN EXISTS (SELECT 1 FROM surveys s WHERE {KEYS33}
        AND ({CHANGED33})) THEN '2002-01-01' ELSE o.termination_date END AS termination_date)
      FROM old_surveys o)
    SELECT * FROM closed
    UNION ALL
    SELECT s.*, DATE '2002-01-01', '9999-12-31' FROM surveys s WHERE NOT EXISTS (
      SELECT 1 FROM closed o WHERE {KEYS33} AND o.termination_date = '9999-12-31')
""")
def catalog_target_load(t: Inputs):
    """A type-2 load of the 33-column target from one catalog table into the next."""
    spec = scd2.Versioned(keys=schemas.TARGET_KEYS, uncompared=("file_name",))
    before = S.read_table(t.spark, _bootstrapped(t))
    wanted, missing = scd2.project_present(t.surveys, schemas.TARGET_TEXT_COLUMNS)
    if missing:
        raise ValueError(f"the extract lacks {missing}")
    after = _table(t, schemas.TARGET)
    S.insert_into(S.align(scd2.apply_stage(before, wanted, spec, RUN_DATE), schemas.TARGET), after)
    return S.read_table(t.spark, after)


def _same(left: str, right: str) -> str:
    return f"rtrim(upper({left})) = rtrim(upper({right}))"


@query(f"""
    SELECT c.tenant, c.record_id, c.post_date, c.item_code, g.group_code AS item_group,
           s.group_code AS procedure_group
    FROM mixed_charges c
    LEFT JOIN mixed_groups g ON {_same("g.source_key", "c.item_code")}
      AND g.family = '{X.F_CHARGE}' AND c.post_date BETWEEN g.start_date AND g.end_date
    LEFT JOIN mixed_terms m ON {_same("m.source_key", "c.procedure_code")}
    LEFT JOIN mixed_groups s ON {_same("s.source_key", "m.term_key")}
      AND s.family = '{X.F_SERVICE}' AND c.post_date BETWEEN s.start_date AND s.end_date
""")
def caseless_lookup(t: Inputs):
    """Codes in either case and with blanks: one hop by a broadcast, two by salted shuffles."""
    groups = caseless(t.mixed_groups, [L.SOURCE])
    rows = caseless(
        t.mixed_charges.select("tenant", "record_id", "post_date", "item_code", "procedure_code"),
        ["item_code", "procedure_code"],
    )
    one = L.dated_lookup(rows, groups, X.F_CHARGE, "item_code", "item_group", "post_date")
    two = L.conformed_lookup(
        one, caseless(t.mixed_terms), groups, X.F_SERVICE, "procedure_code", "procedure_group",
        "post_date", small=False,
    )
    return cased(two.drop("procedure_code"))


@query("""
    SELECT person_id, name_type, family_name, given_name FROM mixed_names
    WHERE rtrim(upper(name_type)) = 'GVN_NM' AND (rtrim(upper(family_name)) IN ('TEST', 'ZZTEST')
      OR family_name || given_name ILIKE '%HNAM%TEST%' OR given_name ILIKE 'MACH%')
      AND rtrim(upper(family_name)) <> 'CUSTOMER#000000009'
""")
def caseless_names(t: Inputs):
    """Comparison, ``IN`` and ``LIKE`` on texts declared without case."""
    names = caseless(t.mixed_names)
    full = F.concat("family_name", "given_name")
    hits = names.where((F.col("name_type") == "Gvn_Nm") & (F.col("family_name") != "customer#000000009"))
    return cased(hits.where(
        F.col("family_name").isin("Test", "Zztest")
        | like(names, full, "%HNAM%test%")
        | like(names, "given_name", "mach%")
    ))


@query("""
    SELECT rtrim(upper(item_code)) AS item_code, count(*) AS charges,
           CAST(sum(quantity) AS DECIMAL(29, 3)) AS quantity
    FROM mixed_charges GROUP BY 1
""")
def caseless_totals(t: Inputs):
    """Grouping of texts folded where they are read, which stays a hash aggregate."""
    return folded(t.mixed_charges, ["item_code"]).groupBy("item_code").agg(
        F.count(F.lit(1)).alias("charges"), F.sum("quantity").cast("decimal(29,3)").alias("quantity")
    )


_ON = f"s.client_id = o.client_id AND {_same('s.claim_id', 'o.claim_id')}"


@query(f"""
    WITH closed AS (
      SELECT o.* REPLACE (CASE WHEN o.termination_date = '9999-12-31' AND EXISTS (
        SELECT 1 FROM mixed_stage s WHERE {_ON} AND NOT ({_same("o.status", "s.status")}
          AND {_same("o.first_status", "s.first_status")} AND {_same("o.segment", "s.segment")}))
        THEN '2002-01-01' ELSE o.termination_date END AS termination_date) FROM target o)
    SELECT * FROM closed
    UNION ALL
    SELECT s.*, DATE '2002-01-01', '9999-12-31' FROM mixed_stage s WHERE NOT EXISTS (
      SELECT 1 FROM closed o WHERE {_ON} AND o.termination_date = '9999-12-31')
""")
def caseless_versions(t: Inputs):
    """A type-2 load in which neither case nor trailing blanks make a new key or version."""
    return cased(scd2.apply_stage(caseless(t.target), caseless(t.mixed_stage), SPEC, RUN_DATE))


@query(f"{ALL} SELECT * FROM classified")
def caseless_classes(t: Inputs):
    """The classification of tables whose texts are in either case, half of them with blanks.

    Tenants, codes and patterns meet as declared, so the classes are those of the clean tables.
    """
    def mixed(df, but=()):
        texts = [c for c, kind in df.dtypes if kind == "string" and c not in but]
        lower = F.pmod(F.xxhash64(*df.columns), F.lit(2)) == 0
        return caseless(df.withColumns({
            c: F.when(lower, F.concat(F.lower(c), F.lit("  "))).otherwise(F.upper(c)) for c in texts
        }), texts)

    clean = _tables(t)
    tables = replace(
        clean,
        **{
            f.name: mixed(getattr(clean, f.name)) for f in fields(clean)
            if f.name not in ("calendar", "groups")
        },
        # families are names of this library, not data
        groups=mixed(clean.groups, [L.FAMILY]),
    )
    pending = caseless(_pending(t))
    out = C.classify(tables, pending, SPAN, replace(SETTINGS, caseless=True))
    return folded(cased(out), ["tenant"])


MISSING = f"""SELECT DISTINCT r.record_id, r.authority, r.tenant FROM records r
    LEFT JOIN known_history h ON h.tenant = r.tenant AND h.record_id = r.record_id
    WHERE r.thru_date = DATE '2041-01-01' AND h.record_id IS NULL AND r.record_id > 0
    AND (r.tenant, r.record_id) NOT IN (SELECT e.tenant, e.record_id FROM ({NEWEST}) e
      JOIN queue q ON q.tenant = e.tenant
      AND (q.record_id = e.record_id OR q.record_id = -TRY_CAST(e.source_key AS BIGINT)))
    AND NOT EXISTS (SELECT 1 FROM queue q WHERE q.tenant = r.tenant AND q.record_id = r.record_id)"""


def _queue_step(t: Inputs):
    path = _scratch(t, "queue")
    S.write_version(t.queue, path)
    found = stored_loads.load_queue(
        t.spark,
        path,
        W.recently_charged(t.records, t.charges, SPAN.run_date),
        W.missing_work(t.records, t.known_history, t.queue, t.sources),
        SPAN.run_date,
        NOW,
        7,
    )
    return path, found


@query(f"""
    SELECT q.record_id, q.authority, q.tenant,
           CASE WHEN r.record_id IS NULL THEN q.job_id ELSE 7 END AS job_id, q.added_at,
           CASE WHEN r.record_id IS NULL THEN q.modified_at
                ELSE TIMESTAMP '2001-06-16 00:00:00' END AS modified_at,
           q.extract_date, CASE WHEN r.record_id IS NULL THEN q.result_date END AS result_date
    FROM queue q LEFT JOIN ({RECENT}) r ON r.tenant = q.tenant AND r.record_id = q.record_id
    UNION ALL
    SELECT record_id, authority, tenant, 7, TIMESTAMP '2001-06-16 00:00:00',
           TIMESTAMP '2001-06-16 00:00:00', DATE '2001-06-16', NULL FROM ({MISSING})
""")
def queue_merged(t: Inputs):
    """Recent records queued again and missing ones added, in one pass over the stored queue."""
    path, _ = _queue_step(t)
    return S.read_version(t.spark, path)


@query(f"""
    SELECT 'requeued' AS step, count(*) AS rows FROM queue q JOIN ({RECENT}) r
      ON r.tenant = q.tenant AND r.record_id = q.record_id
    UNION ALL SELECT 'inserted', count(*) FROM ({MISSING})
""")
def queue_rows_affected(t: Inputs):
    """What the pass changed, as counted by its write."""
    _, found = _queue_step(t)
    return t.spark.createDataFrame(list(found.items()), "step string, rows bigint")


CAPTIONS = {"run_as_user": "Run As User"}


@query("""
    SELECT application, completion_status, CAST(year(order_date) AS INT) AS order_date_year,
           count(job_member_name) AS count_job_member_name, count(run_as_user) AS count_run_as_user,
           CAST(sum(runtime) AS BIGINT) AS sum_runtime
    FROM job_runs GROUP BY 1, 2, 3
""")
def job_report_by_roles(t: Inputs):
    """A sheet generated from the columns' roles; runs without an order date are a year of their own."""
    runs = R.with_roles(S.align(t.job_runs, schemas.RUNS), captions=CAPTIONS)
    return R.report_by_roles(
        runs,
        ["application", "completion_status", "order_date"],
        ["job_member_name", "run_as_user", "runtime"],
    )
