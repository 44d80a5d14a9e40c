import datetime as dt
import os

import pytest
from conftest import as_set
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import checks, jobs, runlog
from tidemark.session import materialize, shared_folder
from tidemark.sources import tables as S


def test_delimited_text_with_commas_quotes_and_accents(spark, tmp_path):
    path = tmp_path / "places.csv"
    path.write_text(
        'Day,Location Name,Address\nDay 1,Kirkja,"Gata 28, 101 Bær"\nDay 2,"The ""Old"" Quay",\n',
        encoding="utf-8",
    )
    df = S.read_delimited(spark, str(path), schemas.PLACES)
    assert df.columns == ["Day", "Location Name", "Address"]
    assert as_set(df) == [
        ("Day 1", "Kirkja", "Gata 28, 101 Bær"), ("Day 2", 'The "Old" Quay', "None"),
    ]


def test_versions_switch_only_when_complete(spark, tmp_path):
    path = f"{tmp_path}/table"
    assert S.current_version(spark, path) is None
    with pytest.raises(FileNotFoundError):
        S.read_version(spark, path)
    S.write_version(spark.range(3), path)
    S.write_version(S.read_version(spark, path).unionByName(spark.range(3, 5)), path)
    assert S.read_version(spark, path).count() == 5
    assert S.read_version(spark, path, 1).count() == 3
    os.remove(f"{path}/v2/_SUCCESS")
    assert S.current_version(spark, path) == 1
    assert S.write_version(spark.range(9), path) == 2
    assert S.read_version(spark, path).count() == 9


def test_empty_table_insert_by_name_and_position(spark):
    schema = schemas.CLASSES
    S.create_empty(spark, "empty_classes", schema)
    assert spark.read.table("empty_classes").count() == 0
    swapped = spark.createDataFrame([("I", "x")], "class_kind string, source_key string")
    S.insert_into(swapped, "empty_classes")
    assert as_set(S.read_table(spark, "empty_classes")) == [("x", "I")]
    placed = S.by_position(spark.createDataFrame([("y", "O")], "a string, b string"),
                           schema.names)
    S.insert_into(placed, "empty_classes")
    assert as_set(S.read_table(spark, "empty_classes")) == [("x", "I"), ("y", "O")]
    with pytest.raises(ValueError):
        S.by_position(swapped, ["only"])


def test_target_schema():
    assert len(schemas.TARGET) == 33
    assert set(schemas.TARGET_KEYS) <= set(schemas.TARGET.names)


def test_identity_is_dense_and_continues(spark):
    out = S.with_identity(spark.range(0, 1000, 1, 7), "n", after=50)
    row = out.agg(F.min("n"), F.max("n"), F.count_distinct("n"), F.count_distinct("id")).first()
    assert tuple(row) == (51, 1050, 1000, 1000)


def test_one_slice_is_replaced(spark, tmp_path):
    path = f"{tmp_path}/slices"
    S.overwrite_partitions(spark.createDataFrame([("a", 1), ("b", 2)], "t string, v int"), path, "t")
    S.overwrite_partitions(spark.createDataFrame([("a", 9)], "t string, v int"), path, "t")
    assert as_set(S.read_path(spark, path), "t", "v") == [("a", "9"), ("b", "2")]


def test_replace_slice_keeps_rows_without_tenant(spark):
    stored = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "t string, v int")
    new = spark.createDataFrame([("a", 9), ("b", 8)], "t string, v int")
    assert as_set(S.replace_slice(stored, new, "t", "a")) == [("None", "3"), ("a", "9"), ("b", "2")]


def test_hot_folder_is_written_by_several_tasks(spark):
    df = spark.range(0, 3000, 1, 8).withColumn("t", F.lit("hot"))
    # So few rows would be put together again by the adaptive planner.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spread = S.spread_for_write(df, ["t"], 4)
        parts = spread.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(parts) > 1 and sum(p["count"] for p in parts) == 3000


def test_materialize_cuts_the_plan_and_stores(spark):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    kept = materialize(df)
    assert kept.count() == 10
    assert "Range" not in kept._jdf.queryExecution().optimizedPlan().toString()
    assert shared_folder(spark)


def test_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "b")], "k int, v string")
    assert as_set(checks.duplicate_keys(df, ["k"])) == [("1", "2")]
    assert tuple(checks.uniqueness(df, ["k"]).first()) == (3, 2, 1, 1)
    assert as_set(checks.null_counts(df, ["k", "v"])) == [("k", "0"), ("v", "1")]
    assert as_set(checks.with_defaults(df, {"v": "z"}), "v") == [("a",), ("b",), ("z",)]
    with pytest.raises(checks.CheckFailed):
        checks.require_unique(df, ["k"], "test")
    checks.require_unique(df, ["k", "v"], "test")


def test_run_log_tells_errors(spark, tmp_path):
    path = str(tmp_path / "log")
    with pytest.raises(RuntimeError):
        with runlog.RunLog(spark, path, 4, "s", "t", dt.date(2020, 1, 1)) as log:
            log.step("one", phase="start")
            log.step("one", 7)
            raise RuntimeError("broken")
    found = as_set(S.read_path(spark, f"{path}/jobs"), "state", "row_count", "message")
    assert found == [("E", "7", "s failed with error broken"), ("R", "0", "None")]
    assert S.read_path(spark, f"{path}/steps").count() == 2
    assert runlog.parameters("H", "t", None).endswith("NO DATE ")


def test_job_fields(spark):
    runs = spark.createDataFrame(
        [("a", 1800, "ended ok"), ("b", 1801, "ended ok"), ("c", 1801, None),
         (None, None, "ended not ok"), ("e", None, "ended ok")],
        "job_member_name string, runtime int, completion_status string",
    )
    out = jobs.run_fields(runs)
    assert [tuple(r) for r in out.select("delay_flag", "status", "status_color").collect()] == [
        ("No", "Success", "Green"), ("Yes", "Delayed", "Orange"), ("Yes", "Failure", "Red"),
        ("No", "Failure", "Red"), ("No", "Success", "Green"),
    ]
    total = jobs.measures(out).first()
    assert (total.total_jobs, total.delayed_jobs, total.delayed_share) == (4, 2, 0.5)
    assert total.avg_minutes == 30.0
