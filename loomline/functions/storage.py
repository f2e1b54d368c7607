"""Cuts of the lineage, and files on storage that all executors share."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def _base(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``.  On one machine, where the
    setting is missing, a local folder takes its place; a cluster has to name one."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        base = "file://" + os.path.join(tempfile.gettempdir(), "loomline-shared")
    return f"{base.rstrip('/')}/loomline-{spark.sparkContext.applicationId}"


def shared_dir(spark: SparkSession, what: str) -> str:
    """A new folder for this application, shared by driver and executors."""
    return f"{_base(spark)}/{what}-{uuid.uuid4().hex}"


#: Rows of a narrow table that go to a file, where their number is known beforehand.
ROWS_A_FILE = 1 << 16


def written(df: DataFrame, what: str, rows: int | None = None) -> DataFrame:
    """``df`` written as Parquet to shared storage and read back: a cut of the
    lineage that survives lost executors and is computed once.  ``rows``, the most
    that a narrow table made of others of that size can have, keeps a small one in
    few files: on a local disk, Hadoop starts two processes for every file."""
    if rows is not None:
        df = df.coalesce(1 + rows // ROWS_A_FILE)
    path = shared_dir(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once.  (A checkpoint would compute it twice, and hide its size from the planner.)"""
    return written(df, "cut")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of shared storage."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def clear(spark: SparkSession) -> None:
    """Delete all that this application has cut or written between steps.  Its
    lazy results read these files, so call this when they are no longer needed."""
    remove(spark, _base(spark))


#: Tables up to this many bytes are dealt out anew: they may be one row group, which one task reads.
#: Only where rows lie changes with it; no operator's result depends on that.
SMALL_BYTES = 24 << 20


def spread(df: DataFrame) -> DataFrame:
    """A small table over all cores; a larger one as its files are split."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism) if size <= SMALL_BYTES else df
