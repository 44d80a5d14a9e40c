"""Sources and sinks, each over a whole table."""

import datetime as dt
import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.catalog.registry import Inputs, query
from tidemark.catalog.versions import METRICS, RUN_DATE, SPEC
from tidemark.operators import runlog, scd2
from tidemark.session import shared_folder
from tidemark.sources import tables as S


def _scratch(t: Inputs, name: str) -> str:
    """A new folder on the storage all executors share."""
    return f"{shared_folder(t.spark)}/{name}-{uuid.uuid4().hex}"


@query("""
    SELECT c_custkey, 'No. ' || CAST(c_custkey AS VARCHAR) || ', "' || c_mktsegment || '"'
      AS address, c_name FROM customer
""")
def csv_roundtrip(t: Inputs):
    """Text with commas and quotes written as a delimited file and read back."""
    address = F.concat(
        F.lit("No. "), F.col("c_custkey").cast("string"), F.lit(', "'), "c_mktsegment", F.lit('"')
    )
    rows = t.customer.select("c_custkey", address.alias("address"), "c_name")
    path = _scratch(t, "csv")
    S.write_delimited(rows, path)
    schema = T.StructType(
        [
            T.StructField("c_custkey", T.LongType()),
            T.StructField("address", T.StringType()),
            T.StructField("c_name", T.StringType()),
        ]
    )
    return S.read_delimited(t.spark, path, schema)


@query("SELECT * FROM (SELECT tenant, record_id, post_date, quantity FROM charges)")
def append_rows(t: Inputs):
    """A table written by two appends, by tenant."""
    rows = t.charges.select("tenant", "record_id", "post_date", "quantity")
    path = _scratch(t, "append")
    S.append(rows.where("tenant < '3'"), path)
    S.append(rows.where("tenant >= '3'"), path)
    return S.read_path(t.spark, path)


@query(f"SELECT *, 'load.csv' AS source_file FROM ({METRICS})")
def append_control(t: Inputs):
    """The control row of a load, appended and read back."""
    path = _scratch(t, "control")
    S.append(S.empty_table(t.spark, schemas.CONTROL), path, schemas.CONTROL)
    metrics = scd2.change_metrics(scd2.compare(t.target, t.stage, SPEC, RUN_DATE))
    now = dt.datetime(2000, 1, 1)
    S.append(runlog.control_row(metrics, now, now, "load.csv"), path, schemas.CONTROL)
    return S.read_path(t.spark, path).drop("job_start_time", "job_end_time")


@query("SELECT * FROM stage UNION ALL SELECT * FROM stage WHERE status = 'F'")
def version_switch(t: Inputs):
    """Two versions of a table; a reader sees the last complete one."""
    path = _scratch(t, "versions")
    S.write_version(t.stage, path)
    first = S.read_version(t.spark, path)
    S.write_version(first.unionByName(first.where("status = 'F'")), path)
    return S.read_version(t.spark, path)


@query("""
    SELECT tenant, record_id, CASE WHEN tenant = '2-HIGH' THEN DATE '2001-06-16'
      ELSE from_date END AS from_date FROM records
""")
def partition_overwrite(t: Inputs):
    """One tenant's partition replaced on disk, the others untouched."""
    path = _scratch(t, "slices")
    rows = t.records.select("tenant", "record_id", "from_date")
    S.overwrite_partitions(S.spread_for_write(rows, ["tenant"], 2), path, "tenant")
    again = rows.where("tenant = '2-HIGH'").withColumn("from_date", F.lit("2001-06-16").cast("date"))
    S.overwrite_partitions(again, path, "tenant")
    return S.read_path(t.spark, path).select("tenant", "record_id", "from_date")


@query("""
    SELECT post_month, count(*) AS rows FROM (
      SELECT coalesce(strftime(post_date, '%Y-%m'), 'unknown') AS post_month FROM charges
      UNION ALL SELECT 'unknown' FROM charges WHERE quantity IS NULL) GROUP BY post_month
""")
def partition_layout(t: Inputs):
    """Detail laid out by tenant slot and month, with a partition for the unknown day."""
    day = F.when(F.col("quantity").isNotNull(), F.col("post_date"))
    undated = t.charges.where("quantity IS NULL").withColumn("post_date", day)
    rows = S.with_layout(t.charges.unionByName(undated), day="post_date")
    return rows.groupBy("post_month").agg(F.count(F.lit(1)).alias("rows"))


@query("""
    SELECT count(*) AS rows, CAST(101 AS BIGINT) AS first_id, count(*) + 100 AS last_id,
      count(*) AS distinct_ids, CAST(sum(quantity) AS DECIMAL(29, 3)) AS quantity FROM charges
""")
def identity_column(t: Inputs):
    """Numbers from 101 on without a gap; which row gets which is the storage's order."""
    rows = S.with_identity(t.charges.select("tenant", "record_id", "quantity"), "id", after=100)
    return rows.agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("id").alias("first_id"),
        F.max("id").alias("last_id"),
        F.count_distinct("id").alias("distinct_ids"),
        F.sum("quantity").cast("decimal(29,3)").alias("quantity"),
    )


@query("""
    SELECT 'open' AS step, count(*) FILTER (termination_date = '9999-12-31') AS row_count
    FROM target
    UNION ALL SELECT 'staged', count(*) FROM stage
""")
def job_log_rows(t: Inputs):
    """Step rows of a run with the rows each step found."""
    path = _scratch(t, "log")
    log = runlog.RunLog(t.spark, path, 1, "customers", "ALL", RUN_DATE)
    with log:
        log.step("open", phase="start")
        log.step("open", scd2.open_rows(t.target, SPEC).count())
        log.step("staged", phase="start")
        log.step("staged", t.stage.count())
    steps = S.read_path(t.spark, f"{path}/steps").where("phase = 'end'")
    return steps.select(F.col("description").alias("step"), "row_count")
