"""Whole loads on stored tables."""

import datetime as dt

import pytest
from conftest import as_set
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.catalog.classes import _tables
from tidemark.catalog.fixtures import SETTINGS, SPAN
from tidemark.catalog.registry import Inputs
from tidemark.operators import checks, scd2
from tidemark.plans import loads
from tidemark.sources import tables as S

FOLDER = "/root/testdata/sf0.001"
SPEC = scd2.Versioned(keys=("client_id", "claim_id"))


def test_scd2_load_three_times(spark, tmp_path):
    t = Inputs(spark, FOLDER)
    target, control = f"{tmp_path}/target", f"{tmp_path}/control"

    def load(stage, day):
        return loads.run_scd2_load(spark, stage, target, control, SPEC, day, "extract.csv")

    assert load(t.open_extract, dt.date(1999, 6, 30)) == 2
    load(t.stage, dt.date(2000, 1, 1))
    load(t.stage, dt.date(2000, 1, 2))
    rows = S.read_path(spark, control).orderBy("job_start_time").collect()
    first, second, third = [
        (r.source_count, r.insert_count, r.update_count, r.delete_count, r.no_change_count)
        for r in rows
    ]
    n = t.open_extract.count()
    assert first == (n, n, 0, 0, 0)
    assert second[1] > 0 and second[2] > 0 and second[3] > 0 and second[4] > 0
    assert third == (t.stage.count(), 0, 0, 0, t.stage.count())
    history = S.read_version(spark, target)
    assert scd2.open_rows(history, SPEC).count() == t.stage.count()
    assert history.count() == n + second[1] + second[2]


def test_scd2_load_refuses_or_reduces_duplicates(spark, tmp_path):
    stage = spark.createDataFrame(
        [("1", "a", "old", 1), ("1", "a", "new", 2)],
        "client_id string, claim_id string, status string, seq int",
    )
    paths = (f"{tmp_path}/target", f"{tmp_path}/control")
    day = dt.date(2000, 1, 1)
    with pytest.raises(checks.CheckFailed):
        loads.run_scd2_load(spark, stage, *paths, SPEC, day, "x.csv")
    loads.run_scd2_load(
        spark, stage, *paths, SPEC, day, "x.csv", newest_first=[F.col("seq").desc()]
    )
    assert as_set(S.read_version(spark, paths[0]), "status") == [("new",)]


def test_scd2_load_sets_null_keys_aside_and_counts_them(spark, tmp_path):
    spec = scd2.Versioned(keys=("k",))
    stage = spark.createDataFrame(
        [(None, "a"), (None, "b"), ("1", "c"), ("2", "d")], "k string, v string"
    )
    target, control = f"{tmp_path}/target", f"{tmp_path}/control"
    for day in (dt.date(2000, 1, 1), dt.date(2000, 1, 2)):
        loads.run_scd2_load(spark, stage, target, control, spec, day, "x.csv")
    counts = ("source_count", "insert_count", "update_count", "delete_count", "no_change_count")
    rows = S.read_path(spark, control).orderBy("job_start_time").select(*counts).collect()
    assert [tuple(r) for r in rows] == [(4, 2, 0, 0, 0), (4, 0, 0, 0, 2)]
    assert S.read_version(spark, target).count() == 2
    aside = spark.read.parquet(f"{target}_rejected")
    assert as_set(aside, "v", "rejected_on") == [
        (v, d) for v in ("a", "b") for d in ("2000-01-01", "2000-01-02")
    ]


def test_missing_compared_column_is_refused(spark):
    spec = scd2.Versioned(keys=("k",), compared=("v", "w"))
    target = spark.createDataFrame(
        [], "k string, v string, w string, effective_date date, termination_date string"
    )
    with pytest.raises(ValueError, match="w"):
        scd2.compare(target, target.select("k", "v"), spec, dt.date(2000, 1, 1))


def test_history_load_of_one_tenant(spark, tmp_path):
    t = Inputs(spark, FOLDER)
    tenant = "2-HIGH"
    history, queue, log = (f"{tmp_path}/{n}" for n in ("history", "queue", "log"))
    S.write_version(S.empty_table(spark, schemas.HISTORY), history)
    S.write_version(S.align(t.queue, schemas.QUEUE), queue)
    # A type in two groups gives a record two classes on a snapshot, which the load refuses.
    groups = t.groups.where("not (source_key = 'TY2' and group_code = 'BEHAVIORAL HEALTH')")
    tables = _tables(t)
    tables = type(tables)(**{**tables.__dict__, "groups": groups})

    loads.run_history_load(
        spark, tables, t.grouper, history, queue, log, tenant, SPAN, 11, SETTINGS
    )
    rows = S.read_version(spark, history)
    assert rows.count() > 0
    assert as_set(rows.select("tenant").distinct()) == [(tenant,)]
    assert checks.duplicate_keys(rows, ["tenant", "record_id", "from_date"]).count() == 0
    last = rows.groupBy("record_id").agg(F.max("thru_date").alias("d")).select("d").distinct()
    assert as_set(last) == [("2041-01-01",)]
    after = S.read_version(spark, queue)
    assert after.count() >= t.queue.count()
    known = rows.select("tenant", "record_id").distinct()
    stale = after.join(known, ["tenant", "record_id"], "left_semi").where(
        "result_date is null or result_date < extract_date"
    )
    assert stale.count() == 0
    assert as_set(S.read_path(spark, f"{log}/jobs"), "state") == [("C",), ("R",)]

    # The same run once more finds the same classes and adds nothing.
    loads.run_history_load(
        spark, tables, t.grouper, history, queue, log, tenant, SPAN, 12, SETTINGS
    )
    again = S.read_version(spark, history)
    columns = ["record_id", "from_date", "thru_date", *schemas.HISTORY_VALUES]
    assert as_set(again, *columns) == as_set(rows, *columns)


def test_history_load_logs_its_error(spark, tmp_path):
    t = Inputs(spark, FOLDER)
    paths = [f"{tmp_path}/{n}" for n in ("history", "queue", "log")]
    with pytest.raises(FileNotFoundError):
        loads.run_history_load(spark, _tables(t), t.grouper, *paths, "2-HIGH", SPAN, 11, SETTINGS)
    assert as_set(S.read_path(spark, f"{paths[2]}/jobs"), "state") == [("E",), ("R",)]
