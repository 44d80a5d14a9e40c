"""Tables stored as one folder per value of a column, of which a load touches its own.

A write replaces the slices it names in one job and counts what it writes on the way. It goes to a
staging folder of its own first, so a slice can be replaced by rows made from it, two loads can
replace different slices at once, and a broken job leaves the old rows. The switch at the end is a
removal and a rename per slice, which readers of that slice may see half done.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.tables import align, spread_for_write, tenant_slot, with_layout


def _folder(spark: SparkSession, path: str, column: str, value: str) -> Any:
    escaped = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)
    return spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{column}={escaped}")


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def read_slices(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The whole table; the schema keeps values such as ``007`` from being read as numbers."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def read_slice(spark: SparkSession, path: str, schema: T.StructType, column: str, value: str) -> DataFrame:
    """One slice; the others' files are neither listed for the scan nor read."""
    return read_slices(spark, path, schema).where(F.col(column) == F.lit(value))


def replace_slices(
    df: DataFrame,
    path: str,
    column: str,
    whole: Sequence[str],
    counts: dict[str, Column] | None = None,
    written: Column | None = None,
    helpers: Sequence[str] = (),
) -> dict[str, int]:
    """Replace the slices that ``df`` has rows for, in one job, and return ``counts`` over its rows.

    ``df`` must hold all rows of the slices in ``whole``; one of them that gets none is removed. Only
    rows of ``written`` are stored, without the columns ``helpers``; the others just count.
    """
    spark = df.sparkSession
    stored = F.lit(True) if written is None else F.coalesce(written, F.lit(False))
    kept = [F.count_if(stored & (F.col(column) == F.lit(v))).alias(f"kept_{i}") for i, v in enumerate(whole)]
    named = [c.alias(n) for n, c in (counts or {}).items()]
    seen = Observation()
    watched = df.observe(seen, F.count(F.lit(1)).alias("all_rows"), *kept, *named)
    (
        watched.where(stored)
        .drop(*helpers)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(path)
    )
    found = seen.get
    for i, value in enumerate(whole):
        if not found[f"kept_{i}"]:
            at = _folder(spark, path, column, value)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    return {n: int(found[n] or 0) for n in counts or {}}


# Detail laid out by tenant slot and month.

LAYOUT = ("tenant_slot", "post_month")


def write_layout(df: DataFrame, path: str, tenant: str, day: str, files: int = 1) -> None:
    """``df`` in folders of tenant slot and month, ``files`` tasks to a folder."""
    placed = spread_for_write(with_layout(df, tenant, day), LAYOUT, files)
    placed.write.mode("errorifexists").partitionBy(*LAYOUT).parquet(path)


def read_layout(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    tenant: tuple[str, str] | None = None,
    day: tuple[str, Any, Any] | None = None,
) -> DataFrame:
    """Rows of a laid-out table with ``tenant`` (column, value) and ``day`` (column, first, last).

    Each predicate on a column is joined by the one on folders that follows from it: the tenant's
    slot, and the months from the first day's to the last day's. A bound may be None. Rows whose day
    is unknown are read only without ``day``.
    """
    laid = T.StructType([*schema.fields, T.StructField("tenant_slot", T.IntegerType()), T.StructField("post_month", T.StringType())])
    out = spark.read.schema(laid).parquet(path)
    if tenant is not None:
        out = out.where((F.col("tenant_slot") == tenant_slot(F.lit(tenant[1]))) & (F.col(tenant[0]) == F.lit(tenant[1])))
    if day is not None:
        column, first, last = day
        if first is not None:
            out = out.where((F.col("post_month") >= f"{first:%Y-%m}") & (F.col(column) >= F.lit(first)))
        if last is not None:
            out = out.where((F.col("post_month") <= f"{last:%Y-%m}") & (F.col(column) <= F.lit(last)))
        out = out.where(F.col("post_month") != "unknown")
    return align(out, schema)
