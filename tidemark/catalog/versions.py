"""Type-2 history over customers' extracts of three days."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.catalog.registry import Inputs, query
from tidemark.operators import checks, runlog, scd2
from tidemark.sources import tables as S

RUN_DATE = dt.date(2002, 1, 1)
SPEC = scd2.Versioned(keys=("client_id", "claim_id"))
SAFE = scd2.Versioned(keys=("client_id", "claim_id"), null_safe=True)

COLS = "client_id, claim_id, status, first_status, segment, effective_date, termination_date"
PLAIN = "o.status <> s.status OR o.first_status <> s.first_status OR o.segment <> s.segment"
DISTINCT = """o.status IS DISTINCT FROM s.status
    OR o.first_status IS DISTINCT FROM s.first_status OR o.segment IS DISTINCT FROM s.segment"""


def _load(
    differs: str, reopen: bool, retire: bool, target="target", stage="stage", day="2002-01-01"
) -> str:
    """The two statements of the load one after the other: close, then insert."""
    gone = f"""EXISTS (SELECT 1 FROM {stage} s WHERE s.client_id = o.client_id
        AND s.claim_id = o.claim_id AND ({differs}))"""
    absent = f"""(o.client_id IS NOT NULL AND o.claim_id IS NOT NULL AND NOT EXISTS
        (SELECT 1 FROM {stage} s WHERE s.client_id = o.client_id AND s.claim_id = o.claim_id))"""
    ends = f"({gone} OR {absent})" if retire else gone
    seen = "after_close" if reopen else target
    return f"""
    WITH after_close AS (
      SELECT o.client_id, o.claim_id, o.status, o.first_status, o.segment, o.effective_date,
             CASE WHEN o.termination_date = '9999-12-31' AND {ends} THEN '{day}'
                  ELSE o.termination_date END AS termination_date
      FROM {target} o)
    SELECT * FROM after_close
    UNION ALL
    SELECT s.client_id, s.claim_id, s.status, s.first_status, s.segment, DATE '{day}',
           '9999-12-31'
    FROM {stage} s WHERE NOT EXISTS (SELECT 1 FROM {seen} o WHERE o.client_id = s.client_id
      AND o.claim_id = s.claim_id AND o.termination_date = '9999-12-31')
    """


def _apply(t: Inputs, spec=SPEC, **options):
    return scd2.apply_stage(t.target, t.stage, spec, RUN_DATE, **options)


@query(_load(PLAIN, reopen=False, retire=False))
def scd2_one_pass(t: Inputs):
    return _apply(t, mode="one_pass")


@query(_load(PLAIN, reopen=True, retire=False))
def scd2_two_pass(t: Inputs):
    return _apply(t)


@query(_load(DISTINCT, reopen=True, retire=False))
def scd2_two_pass_null_safe(t: Inputs):
    return _apply(t, SAFE)


@query(_load(PLAIN, reopen=True, retire=True))
def scd2_with_deletes(t: Inputs):
    return _apply(t, retire_missing=True)


SINGLE = """
    SELECT client_id, max(claim_id) AS claim_id, max(status) AS status,
           min(first_status) AS first_status, max(segment) AS segment{dates}
    FROM {source} GROUP BY client_id{more}
"""
ONE_KEY = {
    "single_stage": SINGLE.format(dates="", source="stage", more=""),
    "single_target": SINGLE.format(
        dates=", effective_date, termination_date",
        source="target",
        more=", effective_date, termination_date",
    ),
}


@query(f"""
    WITH single_stage AS ({ONE_KEY['single_stage']}),
    single_target AS ({ONE_KEY['single_target']}),
    after_close AS (
      SELECT o.client_id, o.claim_id, o.status, o.first_status, o.segment, o.effective_date,
             CASE WHEN o.termination_date = '9999-12-31' AND EXISTS (
               SELECT 1 FROM single_stage s WHERE s.client_id = o.client_id
               AND (o.claim_id <> s.claim_id OR {PLAIN})) THEN '2002-01-01'
             ELSE o.termination_date END AS termination_date
      FROM single_target o)
    SELECT * FROM after_close
    UNION ALL
    SELECT s.client_id, s.claim_id, s.status, s.first_status, s.segment, DATE '2002-01-01',
           '9999-12-31' FROM single_stage s
    WHERE NOT EXISTS (SELECT 1 FROM single_target o WHERE o.client_id = s.client_id
      AND o.termination_date = '9999-12-31')
""")
def scd2_single_key(t: Inputs):
    """One key column; the other former key is an attribute like any."""
    def one(df, *dates):
        return df.groupBy("client_id", *dates).agg(
            F.max("claim_id").alias("claim_id"),
            F.max("status").alias("status"),
            F.min("first_status").alias("first_status"),
            F.max("segment").alias("segment"),
        )

    target = one(t.target, "effective_date", "termination_date").select(*t.target.columns)
    spec = scd2.Versioned(keys=("client_id",))
    return scd2.apply_stage(target, one(t.stage), spec, RUN_DATE, mode="one_pass")


@query(_load(PLAIN, True, True, "null_target", "(SELECT * FROM null_stage WHERE claim_id IS NOT NULL)"))
def scd2_null_keys_rejected(t: Inputs):
    return scd2.apply_stage(
        t.null_target, t.null_stage, SPEC, RUN_DATE, retire_missing=True, null_keys="reject"
    )


@query(_load(PLAIN, True, True, "null_target", "null_stage"))
def scd2_null_keys_inserted(t: Inputs):
    return scd2.apply_stage(
        t.null_target, t.null_stage, SPEC, RUN_DATE, retire_missing=True, null_keys="insert"
    )


@query("SELECT * FROM null_stage WHERE client_id IS NULL OR claim_id IS NULL")
def scd2_quarantine(t: Inputs):
    return checks.rows_with_null(t.null_stage, SPEC.keys)


def _changes(target: str, stage: str) -> str:
    return f"""
    SELECT s.client_id, s.claim_id,
           CASE WHEN o.client_id IS NULL THEN 'Insert' WHEN {PLAIN} THEN 'Update'
                ELSE 'NoChange' END AS change_type
    FROM {stage} s LEFT JOIN (SELECT * FROM {target} WHERE termination_date = '9999-12-31') o
      ON o.client_id = s.client_id AND o.claim_id = s.claim_id
    """


CHANGES = _changes("target", "stage")


@query(CHANGES)
def scd2_change_types(t: Inputs):
    return scd2.change_types(scd2.compare(t.target, t.stage, SPEC, RUN_DATE), SPEC.keys)


def _metrics(target: str, stage: str) -> str:
    return f"""
    SELECT count(*) AS source_count,
           count(*) FILTER (change_type = 'Insert') AS insert_count,
           count(*) FILTER (change_type = 'Update') AS update_count,
           (SELECT count(*) FROM {target} o WHERE termination_date = '9999-12-31' AND NOT EXISTS
             (SELECT 1 FROM {stage} s WHERE s.client_id = o.client_id
              AND s.claim_id = o.claim_id)) AS delete_count,
           count(*) FILTER (change_type = 'NoChange') AS no_change_count
    FROM ({_changes(target, stage)})
    """


METRICS = _metrics("target", "stage")


@query(METRICS)
def scd2_change_metrics(t: Inputs):
    return scd2.change_metrics(scd2.compare(t.target, t.stage, SPEC, RUN_DATE))


@query(f"SELECT *, 'customers.csv' AS source_file FROM ({METRICS})")
def scd2_control_row(t: Inputs):
    """The control row without its two clock times."""
    metrics = scd2.change_metrics(scd2.compare(t.target, t.stage, SPEC, RUN_DATE))
    now = dt.datetime(2002, 1, 1)
    row = runlog.control_row(metrics, now, now, "customers.csv")
    return row.drop("job_start_time", "job_end_time")


@query("""
    SELECT client_id, claim_id FROM target o WHERE termination_date = '9999-12-31'
    AND NOT EXISTS (SELECT 1 FROM stage s WHERE s.client_id = o.client_id
                    AND s.claim_id = o.claim_id)
""")
def scd2_missing_keys(t: Inputs):
    return scd2.missing_from_stage(t.target, t.stage, SPEC).select(*SPEC.keys).distinct()


@query(f"SELECT {COLS} FROM target WHERE termination_date = '9999-12-31'")
def scd2_open_rows(t: Inputs):
    return scd2.open_rows(t.target, SPEC)


@query(f"""
    SELECT {COLS} FROM target WHERE effective_date <= DATE '1999-03-31'
    AND CAST(termination_date AS DATE) > DATE '1999-03-31'
""")
def scd2_rows_as_of(t: Inputs):
    return scd2.rows_as_of(t.target, SPEC, dt.date(1999, 3, 31))


@query("""
    SELECT client_id, claim_id, DATE '2002-01-01' AS effective_date,
           '9999-12-31' AS termination_date, status, first_status, segment FROM stage
""")
def scd2_bootstrap(t: Inputs):
    """First load into an empty target: inserts only."""
    dated = scd2.column_order(scd2.with_audit_dates(t.stage, RUN_DATE, SPEC), SPEC)
    empty = S.empty_table(t.spark, dated.schema)
    return scd2.apply_stage(empty, t.stage, SPEC, RUN_DATE)


@query("""
    SELECT client_id, claim_id, status, segment, 'first_status_2,room' AS missing FROM stage
""")
def tolerant_projection(t: Inputs):
    wanted = ["client_id", "claim_id", "status", "first_status_2", "segment", "room"]
    kept, missing = scd2.project_present(t.stage, wanted)
    return kept.withColumn("missing", F.lit(",".join(missing)))


@query("""
    SELECT CAST(count(*) AS BIGINT) AS source_count, CAST(0 AS BIGINT) AS insert_count,
           'x' AS source_file FROM stage
""")
def control_row_types(t: Inputs):
    """Counts of whatever integer type become the declared one."""
    found = t.stage.agg(F.count(F.lit(1)).cast("int").alias("source_count")).withColumns(
        {"insert_count": F.lit(0), "source_file": F.lit("x")}
    )
    fields = [schemas.CONTROL[c] for c in ("source_count", "insert_count", "source_file")]
    return S.align(found, type(schemas.CONTROL)(fields))


@query("""
    SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""")
def stage_duplicate_keys(t: Inputs):
    return checks.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("""
    SELECT CAST(sum(n) AS BIGINT) AS row_count, count(*) AS key_count,
           count(*) FILTER (n > 1) AS duplicate_keys, CAST(sum(n - 1) AS BIGINT) AS surplus_rows
    FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
""")
def table_unique_check(t: Inputs):
    return checks.uniqueness(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("""
    SELECT 'first_status' AS column_name, count(*) FILTER (first_status IS NULL) AS null_count
    FROM null_stage
    UNION ALL SELECT 'claim_id', count(*) FILTER (claim_id IS NULL) FROM null_stage
    UNION ALL SELECT 'status', count(*) FILTER (status IS NULL) FROM null_stage
""")
def null_check(t: Inputs):
    return checks.null_counts(t.null_stage, ["first_status", "claim_id", "status"])


@query("""
    SELECT tenant, record_id, post_date, coalesce(quantity, CAST(0 AS DECIMAL(19, 3))) AS quantity
    FROM charges
""")
def defaults_applied(t: Inputs):
    rows = t.charges.select("tenant", "record_id", "post_date", "quantity")
    return checks.with_defaults(rows, {"quantity": 0})
