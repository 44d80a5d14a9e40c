"""Loads on tables stored by slices: what they read, what they leave alone, what they count."""

import datetime as dt
import glob
import os
from concurrent.futures import ThreadPoolExecutor

import duckdb
import pytest
from conftest import as_set
from pyspark.sql import functions as F

from tidemark.catalog.histories import NOW, START, VALUES
from tidemark.catalog.registry import Inputs
from tidemark.operators import activity, checks, runlog, scd2
from tidemark.operators import history as H
from tidemark.plans import stored_loads as L
from tidemark.sources import slices as P
from tidemark.sources import tables as S

FOLDER = "/root/testdata/sf0.001"
SPEC = scd2.Versioned(keys=("k",))
SCHEMA = "k string, v string, effective_date date, termination_date string"
DAY = dt.date(2000, 1, 1)


def files(path):
    found = glob.glob(f"{path}/**/*.parquet", recursive=True)
    return {f: os.stat(f).st_mtime_ns for f in found}


@pytest.fixture
def history(spark, tmp_path):
    rows = [("1", "a", DAY, "9999-12-31"), ("2", "b", DAY, "9999-12-31"), ("1", "old", DAY, "1999-01-01"), (None, "n", DAY, "9999-12-31")]
    df = spark.createDataFrame(rows, SCHEMA)
    L.lay_out_versions(df, f"{tmp_path}/t", SPEC)
    return f"{tmp_path}/t", df.schema


def load(spark, path, schema, stage, day, **options):
    staged = spark.createDataFrame(stage, "k string, v string")
    return L.load_versions(spark, staged, path, f"{path}_control", schema, SPEC, day, "x.csv", **options)


def test_type2_load_reads_and_writes_open_rows_only(spark, history):
    path, schema = history
    closed = files(f"{path}/{L.LOADED}={L.EARLIER}")
    plan = L.read_open(spark, path, schema)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(closed_by" in plan and "= open)" in plan
    load(spark, path, schema, [("1", "a2"), ("3", "c"), (None, "x"), (None, "y")], dt.date(2000, 1, 2))
    load(spark, path, schema, [("1", "a2"), ("3", "c"), (None, "x")], dt.date(2000, 1, 3))
    assert files(f"{path}/{L.LOADED}={L.EARLIER}") == closed
    assert as_set(L.read_versions(spark, path, schema), "k", "v", "termination_date") == sorted([
        ("1", "a", "2000-01-02"), ("1", "a2", "9999-12-31"), ("1", "old", "1999-01-01"), ("2", "b", "2000-01-02"),
        ("3", "c", "9999-12-31"), ("None", "n", "9999-12-31"),
    ])
    counts = ("source_count", "insert_count", "update_count", "delete_count", "no_change_count")
    assert as_set(S.read_path(spark, f"{path}_control"), *counts) == [
        ("3", "0", "0", "0", "2"), ("4", "1", "1", "1", "0"),
    ]
    rejected = spark.read.parquet(f"{path}_rejected")
    assert as_set(rejected, "v", "rejected_on") == [("x", "2000-01-02"), ("x", "2000-01-03"), ("y", "2000-01-02")]


def test_type2_load_equals_the_plain_form(spark, tmp_path):
    t = Inputs(spark, FOLDER)
    spec = scd2.Versioned(keys=("client_id", "claim_id"))
    L.lay_out_versions(t.null_target, f"{tmp_path}/t", spec)
    L.load_versions(
        spark, t.null_stage, f"{tmp_path}/t", f"{tmp_path}/c", t.null_target.schema, spec, DAY, "x", mode="one_pass"
    )
    plain = scd2.apply_stage(t.null_target, t.null_stage, spec, DAY, "one_pass", True)
    found = L.read_versions(spark, f"{tmp_path}/t", t.null_target.schema)
    assert as_set(found.select(*plain.columns)) == as_set(plain)


def test_type2_load_checks_keys_before_it_writes(spark, history):
    path, schema = history
    before = files(path)
    stage = [("1", "a"), ("1", "b"), (None, "x")]
    for _ in range(2):
        with pytest.raises(checks.CheckFailed):
            load(spark, path, schema, stage, dt.date(2000, 1, 2))
    assert files(path) == before and not os.path.exists(f"{path}_rejected")
    for _ in range(2):
        load(spark, path, schema, stage, dt.date(2000, 1, 2), newest_first=[F.col("v").desc()])
    assert as_set(spark.read.parquet(f"{path}_rejected"), "v") == [("x",)]
    assert as_set(L.read_open(spark, path, schema).where("k is not null"), "k", "v") == [("1", "b")]


def test_type2_load_into_nothing_and_out_of_everything(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    path = f"{tmp_path}/new"
    load(spark, path, schema, [("1", "a"), ("2", "b")], DAY)
    assert L.read_versions(spark, path, schema).count() == 2
    load(spark, path, schema, [], dt.date(2000, 1, 2))
    assert L.read_open(spark, path, schema).count() == 0
    assert as_set(L.read_versions(spark, path, schema), "termination_date") == [("2000-01-02",)] * 2


def laid_out(t, tmp_path):
    path = f"{tmp_path}/history"
    P.replace_slices(t.stored_days, path, "tenant", [])
    return path


def tenant_load(t, path, tenant, staged=None, start=START):
    staged = t.staged_days if staged is None else staged
    return L.load_tenant_history(t.spark, staged, path, t.stored_days.schema, tenant, VALUES, start, NOW, 7, parity=True)


def test_tenant_load_leaves_other_tenants_files(spark, tmp_path):
    t = Inputs(spark, FOLDER)
    path = laid_out(t, tmp_path)
    before = files(path)
    affected = tenant_load(t, path, "MACHINERY")
    after = files(path)
    others = {f: m for f, m in before.items() if "tenant=MACHINERY" not in f}
    assert others and others == {f: m for f, m in after.items() if "tenant=MACHINERY" not in f}
    assert not set(before) & {f for f in after if "tenant=MACHINERY" in f}
    assert affected.cut and affected.inserted
    plan = P.read_slice(spark, path, t.stored_days.schema, "tenant", "MACHINERY")._jdf.queryExecution()
    assert "PartitionFilters: [isnotnull(tenant" in plan.executedPlan().toString()


def test_two_tenants_at_once_lose_nothing(spark, tmp_path):
    t = Inputs(spark, FOLDER)
    t.stored_days, t.staged_days  # noqa: B018  read once, before the threads
    path = laid_out(t, tmp_path)
    tenants = ["MACHINERY", "BUILDING", "FURNITURE"]
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda x: tenant_load(t, path, x), tenants))
    found = P.read_slices(spark, path, t.stored_days.schema)
    inside = F.col("tenant").isin(tenants)
    plain = H.load_history(
        t.stored_days.where(inside), t.staged_days.where(inside), VALUES, START, NOW, 7, parity=True
    ).unionByName(t.stored_days.where(~inside))
    assert as_set(found.select(*plain.columns)) == as_set(plain)
    assert not [d for d in os.listdir(path) if d.startswith(".spark-staging")]


def test_untouched_records_are_not_shuffled_with_the_others(spark, tmp_path):
    t = Inputs(spark, FOLDER)
    path = laid_out(t, tmp_path)
    few = t.staged_days.where("record_id % 7 = 1")
    affected = tenant_load(t, path, "MACHINERY", few, start=None)
    assert affected.passed_by > 0 and affected.cut == 0 and affected.total == affected.inserted + affected.updated
    mine = F.col("tenant") == "MACHINERY"
    plain = H.load_history(t.stored_days.where(mine), few.where(mine), VALUES, None, NOW, 7, parity=True)
    found = P.read_slice(spark, path, t.stored_days.schema, "tenant", "MACHINERY")
    assert as_set(found.select(*plain.columns)) == as_set(plain)


def test_a_tenant_that_loses_all_its_rows(spark, tmp_path):
    t = Inputs(spark, FOLDER)
    path = laid_out(t, tmp_path)
    n = t.stored_days.where("tenant = 'MACHINERY'").count()
    affected = tenant_load(t, path, "MACHINERY", t.staged_days.limit(0), start=dt.date(1980, 1, 1))
    assert (affected.cut, affected.inserted, affected.passed_by) == (n, 0, 0)
    assert P.read_slices(spark, path, t.stored_days.schema).where("tenant = 'MACHINERY'").count() == 0


def test_slice_values_that_look_like_numbers_or_paths(spark, tmp_path):
    path = f"{tmp_path}/odd"
    df = spark.createDataFrame([("007", 1), ("7", 2), ("a/b=c", 3), (None, 4)], "tenant string, n int")
    counted = P.replace_slices(df, path, "tenant", ["007"], {"n": F.sum("n")}, F.col("n") != 2)
    assert counted == {"n": 10}
    assert as_set(P.read_slices(spark, path, df.schema), "tenant", "n") == [("007", "1"), ("None", "4"), ("a/b=c", "3")]
    P.replace_slices(df.where("tenant = 'a/b=c'"), path, "tenant", ["a/b=c"], written=F.col("n") < 0)
    assert as_set(P.read_slice(spark, path, df.schema, "tenant", "a/b=c")) == []


def test_layout_is_written_in_folders_and_read_from_few(spark, tmp_path):
    t = Inputs(spark, FOLDER)
    rows = t.charges.select("tenant", "record_id", "post_date", "quantity")
    undated = rows.limit(5).withColumn("post_date", F.lit(None).cast("date"))
    path = f"{tmp_path}/layout"
    P.write_layout(rows.unionByName(undated), path, "tenant", "post_date", files=2)
    one = P.read_layout(spark, path, rows.schema, ("tenant", "2-HIGH"), ("post_date", dt.date(1998, 3, 1), dt.date(1998, 3, 31)))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "tenant_slot" in plan and "post_month" in plan
    assert len(one.inputFiles()) == len(files(path))  # the whole table's, before folders are pruned
    read = one.select(F.input_file_name().alias("f")).distinct().collect()
    assert 1 <= len(read) <= 2 and all("post_month=1998-03" in r.f for r in read)
    wanted = rows.where("tenant = '2-HIGH' and post_date between '1998-03-01' and '1998-03-31'")
    assert as_set(one) == as_set(wanted) and one.count() > 0
    assert P.read_layout(spark, path, rows.schema).count() == rows.count() + 5
    late = P.read_layout(spark, path, rows.schema, day=("post_date", dt.date(1998, 3, 15), None))
    assert as_set(late) == as_set(rows.where("post_date >= '1998-03-15'"))


def test_a_run_that_is_running_refuses_another(spark, tmp_path):
    at = [dt.datetime(2000, 1, 1, 8)]
    begin = lambda: runlog.begin_run(spark, f"{tmp_path}/log", "s", "t", "I", at[0].date(), clock=lambda: at[0])
    log, start = begin()
    assert (log.job_id, start) == (1, dt.date(2013, 1, 1))
    log.__enter__()
    at[0] = dt.datetime(2000, 1, 1, 12)
    with pytest.raises(runlog.RunRefused):
        begin()
    other, _ = runlog.begin_run(spark, f"{tmp_path}/log", "s", "another", "I", at[0].date())
    assert other.job_id == 2
    at[0] = dt.datetime(2000, 1, 2, 12)
    log, start = begin()
    assert (log.job_id, start) == (2, dt.date(2013, 1, 1))
    with log:
        pass
    at[0] = dt.datetime(2000, 1, 3, 12)
    assert begin()[1] == dt.date(2000, 1, 2)
    states = S.read_path(spark, f"{tmp_path}/log/jobs")
    assert as_set(states, "job_id", "state") == [("1", "E"), ("1", "R"), ("2", "C"), ("2", "R")]


@pytest.mark.parametrize("listed", [["a", "b"], ["a", None], [None], []])
@pytest.mark.parametrize("small", [True, False])
def test_subquery_counters_with_nulls(spark, listed, small):
    rows = [(k, c, 1 if k == "x" else 10) for k in "xy" for c in ("a", "b", "c", None, "a")]
    charges = spark.createDataFrame(rows, "k string, code string, quantity int")
    table = spark.createDataFrame([(v,) for v in listed], "code string")
    found = activity.subquery_counters(
        charges, ["k"], "code", {"inside": table, "outside": table}, absent=["outside"], small=small
    )
    con = duckdb.connect()
    con.execute("CREATE TABLE charges(k VARCHAR, code VARCHAR, quantity INT); CREATE TABLE listed(code VARCHAR)")
    con.executemany("INSERT INTO charges VALUES (?, ?, ?)", rows)
    if listed:
        con.executemany("INSERT INTO listed VALUES (?)", [(v,) for v in listed])
    wanted = con.execute("""
        SELECT k, sum(quantity), sum(CASE WHEN code IN (SELECT code FROM listed) THEN quantity ELSE 0 END),
          sum(CASE WHEN code NOT IN (SELECT code FROM listed) THEN quantity ELSE 0 END) FROM charges GROUP BY k
    """).fetchall()
    assert as_set(found) == sorted(tuple(map(str, r)) for r in wanted)
