"""Sources and sinks: files, catalog tables, versions, tenant slices, identity numbers."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import materialize


def read_path(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A lake table by path; ``delta`` works where the session has that format."""
    return spark.read.format(fmt).load(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def read_delimited(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A comma-separated UTF-8 file with a header row and quoted fields."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )


def write_delimited(df: DataFrame, path: str) -> None:
    df.write.option("header", True).option("escape", '"').mode("errorifexists").csv(path)


def read_warehouse(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    lower: int,
    upper: int,
    partitions: int,
    **options: str,
) -> DataFrame:
    """A remote table read in parallel by ranges of a number column."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, **options)
        .option("partitionColumn", column)
        .option("lowerBound", lower)
        .option("upperBound", upper)
        .option("numPartitions", partitions)
        .load()
    )


def from_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def create_empty(spark: SparkSession, name: str, schema: T.StructType) -> None:
    """A catalog table with this schema and no rows; an old one of the name is replaced."""
    empty_table(spark, schema).write.mode("overwrite").format("parquet").saveAsTable(name)


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns, in its order and cast to its types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def by_position(df: DataFrame, target_columns: Sequence[str]) -> DataFrame:
    """The columns renamed in order, as an insert without a column list reads them."""
    if len(df.columns) != len(target_columns):
        raise ValueError(f"{len(df.columns)} columns for {len(target_columns)}")
    return df.toDF(*target_columns)


def append(df: DataFrame, path: str, schema: T.StructType | None = None) -> None:
    (align(df, schema) if schema else df).write.mode("append").parquet(path)


def insert_into(df: DataFrame, name: str) -> None:
    """Insert by column name into a catalog table."""
    columns = df.sparkSession.read.table(name).columns
    df.select(*columns).write.insertInto(name)


# Versions of a table: each load writes a new folder, and readers take the last complete one.


def _folders(spark: SparkSession, path: str) -> tuple[Any, Any]:
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def current_version(spark: SparkSession, path: str) -> int | None:
    """The highest version whose write was completed, or None."""
    fs, where = _folders(spark, path)
    if not fs.exists(where):
        return None
    done = []
    for entry in fs.listStatus(where):
        name = entry.getPath().getName()
        marker = spark._jvm.org.apache.hadoop.fs.Path(entry.getPath(), "_SUCCESS")
        if name.startswith("v") and name[1:].isdigit() and fs.exists(marker):
            done.append(int(name[1:]))
    return max(done, default=None)


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    number = current_version(spark, path) if version is None else version
    if number is None:
        raise FileNotFoundError(f"no complete version in {path}")
    return spark.read.parquet(f"{path}/v{number}")


def write_version(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> int:
    """Write the next version. The version being read is never overwritten, and a write that
    was broken off has no completion marker, so readers keep to the one before."""
    number = (current_version(df.sparkSession, path) or 0) + 1
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{path}/v{number}")
    return number


# Slices of a table.


def replace_slice(stored: DataFrame, new: DataFrame, column: str, value: Any) -> DataFrame:
    """The table with one tenant's rows replaced."""
    others = stored.where(~F.coalesce(F.col(column) == F.lit(value), F.lit(False)))
    return others.unionByName(new.where(F.col(column) == F.lit(value)).select(*stored.columns))


def overwrite_partitions(df: DataFrame, path: str, column: str) -> None:
    """Replace only the partitions that ``df`` has rows for; the others are not touched."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(path)
    )


def unite(parts: Sequence[DataFrame]) -> DataFrame:
    """Rows of producers with different columns; a column a producer lacks is NULL."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


# Layout and identity.

# Fixed value: hash slots of the tenant layout.
TENANT_SLOTS = 32


def tenant_slot(tenant: Column, slots: int = TENANT_SLOTS) -> Column:
    return F.pmod(F.xxhash64(tenant), F.lit(slots)).cast("int")


def with_layout(df: DataFrame, tenant: str = "tenant", day: str | None = None) -> DataFrame:
    """Partition columns: the tenant's slot and, for dated detail, the month (NULL day: unknown).

    ``slices.write_layout`` writes it, and ``slices.read_layout`` reads only a tenant's and days' folders.
    """
    out = df.withColumn("tenant_slot", tenant_slot(F.col(tenant)))
    if day is None:
        return out
    month = F.coalesce(F.date_format(F.col(day), "yyyy-MM"), F.lit("unknown"))
    return out.withColumn("post_month", month)


def spread_for_write(df: DataFrame, columns: Sequence[str], files: int) -> DataFrame:
    """Rows placed by partition folder and then over ``files`` tasks per folder.

    A folder that holds a third of the rows is written by that many tasks and not by one.
    """
    rest = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    lane = F.pmod(F.xxhash64(*rest, F.spark_partition_id()), F.lit(files)).cast("int")
    return df.withColumn("__lane", lane).repartition(*columns, "__lane").drop("__lane")


def with_identity(df: DataFrame, name: str, after: int = 0) -> DataFrame:
    """Numbers ``after + 1, after + 2, ...`` without gaps, in storage order.

    The rows are stored once with their place in their task, so that the numbers cannot shift
    when a task runs again. Only one count per task is then summed up; no row is sorted or sent
    to another task.
    """
    # The id is (task << 33) + place in the task.
    placed = materialize(df.withColumn("__place", F.monotonically_increasing_id()))
    task = F.shiftright("__place", 33).alias("__task")
    place = F.col("__place").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(task).agg((F.max(place) + 1).alias("__size"))
    before = Window.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "__task", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__offset")
    )
    # One row per task of the write: bounded by its number of tasks.
    numbered = placed.withColumn("__task", F.shiftright("__place", 33)).join(
        F.broadcast(offsets), "__task"
    )
    number = (F.col("__offset") + place + 1 + F.lit(after)).cast("bigint")
    return numbered.withColumn(name, number).drop("__task", "__place", "__offset")
