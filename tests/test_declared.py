import datetime as dt

import pytest
from conftest import as_set
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.text import cased, caseless, folded, like
from tidemark.operators import roles as R
from tidemark.operators import workqueue as W
from tidemark.plans import stored_loads
from tidemark.sources import tables as S

NOW = dt.datetime(2001, 6, 16)
QUEUE = (
    "record_id bigint, authority smallint, tenant string, job_id bigint, added_at timestamp_ntz, "
    "modified_at timestamp_ntz, extract_date date, result_date date"
)


def test_case_and_blanks_do_not_count(spark):
    left = caseless(spark.createDataFrame([("ab ", 1), ("AB", 2), ("b", 3), (None, 4)], "k string, n int"))
    right = caseless(spark.createDataFrame([("Ab  ",), (None,)], "j string"))
    assert as_set(left.join(right, F.col("k") == F.col("j")), "n") == [("1",), ("2",)]
    assert as_set(left.where(F.col("k").isin("aB")), "n") == [("1",), ("2",)]
    assert as_set(left.groupBy("k").count(), "count") == [("1",), ("1",), ("2",)]
    assert as_set(left.where(like(left, "k", "a%")), "n") == [("1",), ("2",)]
    assert as_set(left.where(like(left, "k", "%b")), "n") == [("2",), ("3",)]
    plain = cased(left)
    assert dict(plain.dtypes)["k"] == "string" and as_set(plain, "k") == as_set(left, "k")
    assert as_set(plain.where(like(plain, "k", "A%")), "n") == [("2",)]
    assert as_set(folded(plain, ["k"]).groupBy("k").count()) == [("AB", "2"), ("B", "1"), ("None", "1")]
    plan = folded(plain, ["k"]).groupBy("k").count()._jdf.queryExecution().toString()
    assert "HashAggregate" in plan
    with pytest.raises(ValueError):
        caseless(plain, ["n"])


def test_catalog_types_are_enforced(spark):
    S.create_empty(spark, "declared_target", schemas.TARGET)
    row = {c: F.lit("x") for c in schemas.TARGET.names}
    good = spark.range(2).select(
        *[v.alias(c) for c, v in (row | {"effective_date": F.lit(dt.date(2020, 1, 1))}).items()]
    )
    S.insert_into(good.select(*reversed(good.columns)), "declared_target")
    table = S.read_table(spark, "declared_target")
    assert table.schema.names == schemas.TARGET.names and table.count() == 2
    with pytest.raises(AnalysisException):
        S.insert_into(good.withColumn("effective_date", F.lit(True)), "declared_target")
    with pytest.raises(AnalysisException):
        S.insert_into(good.drop("Bed"), "declared_target")
    assert S.read_table(spark, "declared_target").count() == 2


def test_queue_changes_in_one_pass(spark, rows, tmp_path):
    old, day = "2001-01-01 00:00:00", "2001-01-02"
    queue = rows(
        QUEUE, (1, 1, "a", 1, old, old, day, day), (2, 1, "a", 1, old, old, day, day),
        (3, 1, None, 1, old, old, day, day),
    )
    recent = rows("tenant string, record_id bigint", ("a", 1), ("a", 1), ("a", 9), (None, 3))
    missing = rows(
        "record_id bigint, authority smallint, tenant string",
        (5, 2, "a"), (5, 3, "a"), (6, None, "b"), (2, 7, "a"),
    )
    out = W.requeue_and_insert(queue, recent, missing, NOW.date(), NOW, 7, mark="what")
    assert as_set(out, "tenant", "record_id", "authority", "job_id", "result_date", "what") == sorted([
        ("a", "1", "1", "7", "None", "requeued"), ("a", "2", "1", "1", day, "kept"),
        ("None", "3", "1", "1", day, "kept"), ("a", "5", "2", "7", "None", "inserted"),
        ("a", "5", "3", "7", "None", "inserted"), ("b", "6", "None", "7", "None", "inserted"),
    ])
    assert out.columns[:-1] == queue.columns
    assert out.drop("what").dtypes == queue.dtypes
    path = str(tmp_path / "queue")
    S.write_version(queue, path)
    found = stored_loads.load_queue(spark, path, recent, missing, NOW.date(), NOW, 7)
    assert found == {"requeued": 1, "inserted": 3}
    assert S.read_version(spark, path).count() == 6
    empty = stored_loads.load_queue(spark, path, recent.limit(0), missing.limit(0), NOW.date(), NOW, 8)
    assert empty == {"requeued": 0, "inserted": 0} and S.read_version(spark, path).count() == 6


def test_report_from_column_roles(spark, tmp_path):
    runs = spark.createDataFrame(
        [("a", dt.datetime(2020, 5, 1), "x", 3), ("a", dt.datetime(2020, 7, 1), None, 4),
         ("b", None, "y", None)],
        "application string, start_time timestamp, folder string, runtime int",
    )
    known = R.with_roles(runs, captions={"runtime": "Seconds"})
    known.write.parquet(str(tmp_path / "runs"))
    back = S.read_path(spark, str(tmp_path / "runs"))
    assert as_set(R.roles_of(back)) == [
        ("application", "dimension", "count", "Application"), ("folder", "dimension", "count", "Folder"),
        ("runtime", "measure", "sum", "Seconds"), ("start_time", "dimension", "year", "Start Time"),
    ]
    report = R.report_by_roles(back, ["application", "start_time"], ["folder", "runtime"])
    assert report.columns == ["application", "start_time_year", "count_folder", "sum_runtime"]
    assert as_set(report) == [("a", "2020", "1", "7"), ("b", "None", "1", "None")]
    assert R.report_by_roles(back, ["application"], []).count() == 2
    for by, values in ((["runtime"], []), (["application"], ["start_time"]), (["nothing"], [])):
        with pytest.raises(ValueError):
            R.report_by_roles(back, by, values)
    with pytest.raises(ValueError):
        R.report_by_roles(runs, ["application"], [])
