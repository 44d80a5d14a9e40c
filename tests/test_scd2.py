import datetime as dt

import pytest
from conftest import as_set
from pyspark.sql import functions as F

from tidemark.operators import checks, scd2
from tidemark.operators.scd2 import Versioned

DAY = dt.date(2024, 2, 1)
SPEC = Versioned(keys=("k",))
TARGET = "k string, a string, b string, effective_date date, termination_date string"
STAGE = "k string, a string, b string"


@pytest.fixture
def target(rows):
    return rows(
        TARGET,
        ("same", "1", "x", "2024-01-01", "9999-12-31"),
        ("changed", "1", "x", "2024-01-01", "9999-12-31"),
        ("gone", "1", "x", "2024-01-01", "9999-12-31"),
        ("to_null", "1", "x", "2024-01-01", "9999-12-31"),
        ("from_null", None, "x", "2024-01-01", "9999-12-31"),
        ("closed", "0", "x", "2023-01-01", "2023-06-01"),
        ("reopened", "0", "x", "2023-01-01", "2023-06-01"),
    )


@pytest.fixture
def stage(rows):
    return rows(
        STAGE,
        ("same", "1", "x"),
        ("changed", "2", "x"),
        ("to_null", None, "x"),
        ("from_null", "1", "x"),
        ("new", "1", None),
        ("reopened", "5", "x"),
    )


def versions_of(df, key):
    return as_set(df.where(F.col("k") == key), "a", "effective_date", "termination_date")


def test_two_pass_closes_and_opens(target, stage):
    out = scd2.apply_stage(target, stage, SPEC, DAY)
    assert versions_of(out, "changed") == [
        ("1", "2024-01-01", "2024-02-01"),
        ("2", "2024-02-01", "9999-12-31"),
    ]
    assert versions_of(out, "same") == [("1", "2024-01-01", "9999-12-31")]
    assert versions_of(out, "new") == [("1", "2024-02-01", "9999-12-31")]
    assert versions_of(out, "gone") == [("1", "2024-01-01", "9999-12-31")]
    assert versions_of(out, "closed") == [("0", "2023-01-01", "2023-06-01")]
    assert len(versions_of(out, "reopened")) == 2


def test_one_pass_opens_the_new_version_on_the_next_run(target, stage):
    out = scd2.apply_stage(target, stage, SPEC, DAY, mode="one_pass")
    assert versions_of(out, "changed") == [("1", "2024-01-01", "2024-02-01")]
    again = scd2.apply_stage(out, stage, SPEC, dt.date(2024, 2, 2), mode="one_pass")
    assert ("2", "2024-02-02", "9999-12-31") in versions_of(again, "changed")


def test_plain_comparison_misses_null_and_null_safe_does_not(target, stage):
    plain = scd2.apply_stage(target, stage, SPEC, DAY)
    assert len(versions_of(plain, "to_null")) == len(versions_of(plain, "from_null")) == 1
    safe = scd2.apply_stage(target, stage, Versioned(keys=("k",), null_safe=True), DAY)
    assert len(versions_of(safe, "to_null")) == len(versions_of(safe, "from_null")) == 2


def test_deletes_close_only_when_asked(target, stage):
    out = scd2.apply_stage(target, stage, SPEC, DAY, retire_missing=True)
    assert versions_of(out, "gone") == [("1", "2024-01-01", "2024-02-01")]


def test_metrics_add_up_and_come_before_the_load(target, stage):
    compared = scd2.compare(target, stage, SPEC, DAY)
    row = scd2.change_metrics(compared).first()
    assert row.source_count == 6
    assert row.insert_count + row.update_count + row.no_change_count == row.source_count
    assert (row.insert_count, row.update_count, row.delete_count) == (2, 1, 1)


def test_no_change_types_found_count_zero(target):
    empty = target.limit(0)
    row = scd2.change_metrics(scd2.compare(empty, empty.select("k", "a", "b"), SPEC, DAY)).first()
    assert set(row.asDict().values()) == {0}


def test_running_again_changes_nothing(target, stage):
    spec = Versioned(keys=("k",), null_safe=True)
    once = scd2.apply_stage(target, stage, spec, DAY, retire_missing=True)
    twice = scd2.apply_stage(once, stage, spec, dt.date(2024, 3, 1), retire_missing=True)
    assert as_set(once) == as_set(twice)
    open_keys = scd2.open_rows(twice, spec)
    assert checks.duplicate_keys(open_keys, ["k"]).count() == 0


def test_null_keys(rows, target):
    stage = rows(STAGE, (None, "1", "x"), ("same", "1", "x"))
    kept = scd2.apply_stage(target, stage, SPEC, DAY)
    assert kept.where("k is null").count() == 0
    first = scd2.apply_stage(target, stage, SPEC, DAY, null_keys="insert")
    second = scd2.apply_stage(
        first, stage, SPEC, DAY, null_keys="insert", retire_missing=True
    )
    assert second.where("k is null").count() == 2
    assert second.where("k is null and termination_date <> '9999-12-31'").count() == 0
    assert checks.rows_with_null(stage, ["k"]).count() == 1


def test_quotes_in_keys_are_text(rows):
    target = rows(TARGET, ("o'k", "1", "x", "2024-01-01", "9999-12-31"))
    out = scd2.apply_stage(target, rows(STAGE, ("z", "1", "x")), SPEC, DAY, retire_missing=True)
    assert versions_of(out, "o'k") == [("1", "2024-01-01", "2024-02-01")]


def test_columns_the_stage_lacks_become_null(rows, target):
    stage = rows("k string, a string", ("fresh", "1"), ("same", "1"))
    out = scd2.apply_stage(target, stage, SPEC, DAY)
    assert as_set(out.where("k = 'fresh'"), "a", "b") == [("1", "None")]
    assert len(versions_of(out, "same")) == 1


def test_uncompared_columns(rows, target):
    spec = Versioned(keys=("k",), uncompared=("b",))
    out = scd2.apply_stage(target, rows(STAGE, ("same", "1", "other file")), spec, DAY)
    assert len(versions_of(out, "same")) == 1


def test_unknown_modes_are_refused(target, stage):
    compared = scd2.compare(target, stage, SPEC, DAY)
    with pytest.raises(ValueError):
        scd2.versions(compared, SPEC, DAY, mode="three_pass")
    with pytest.raises(ValueError):
        scd2.compare(target, stage, SPEC, DAY, null_keys="drop")


def test_closed_rows_are_not_shuffled(spark, target, stage, tmp_path):
    target.write.parquet(f"{tmp_path}/t")
    stage.write.parquet(f"{tmp_path}/s")
    out = scd2.apply_stage(
        spark.read.parquet(f"{tmp_path}/t"), spark.read.parquet(f"{tmp_path}/s"), SPEC, DAY
    )
    plan = out._jdf.queryExecution().executedPlan().toString()
    union = plan[plan.index("Union"):]
    closed_part = union[: union.index("Exchange")]
    assert "FileScan" in closed_part
    # every scan of the open side leaves closed rows in the file; a NULL key is filtered there too
    scans = [x for x in plan.splitlines() if "FileScan" in x and "effective_date" in x]
    opened = [x for x in scans if "EqualTo(termination_date,9999-12-31)" in x]
    assert len(opened) == len(scans) - 1
    assert any("IsNotNull(k)" in x for x in opened)
