"""Session settings and lineage cuts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Spark's setting that removes a statement's shuffle files when the statement has ended.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Settings the operators are planned for. None of them is needed for right results.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app: str = "tidemark", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the recommended settings; ``extra`` uses ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Where none is named it lies in the warehouse, which executors share as well.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    made = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_stored"
    sc.setCheckpointDir(made)
    return made


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and keep it on shared storage, so that it outlives lost executors.

    This is what a session temp table is in the source system: later steps read the stored
    rows instead of running the plan again.
    """
    spark = df.sparkSession
    folder = shared_folder(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def store(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet on shared storage and read back: a step of a plan too wide to run whole.

    The shuffle files of the job that writes it go with the job, so the disk holds the shuffles of one
    step at a time, and the columns are stored encoded. The files are removed when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/step-{uuid.uuid4().hex}"
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(FREE_SHUFFLES) if before is None else spark.conf.set(FREE_SHUFFLES, before)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    return spark.read.schema(df.schema).parquet(path)
