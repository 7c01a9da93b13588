"""Where intermediate results go, and how lineage is cut.

Executors may be lost at any time, so an intermediate result that several
branches read is written to storage all of them can reach. The folder is the
one the session names in ``spark.checkpoint.dir``, or else one in its warehouse.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, without a trailing slash."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (named or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/serplens/{name}-{uuid.uuid4().hex}"


def discard_at_exit(spark: SparkSession, path: str) -> None:
    """Have the file system remove a scratch table when the application ends."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back.

    Unlike a checkpoint, the Parquet table still prunes columns for each reader. It
    stays until the application ends, or until ``release``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    discard_at_exit(spark, path)
    written = spark.read.schema(df.schema).parquet(path)
    written.scratch = path
    return written


def release(*written: DataFrame) -> None:
    """Remove tables of ``materialize`` that no later job reads."""
    for df in written:
        spark = df.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(df.scratch)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def let_go(spark: SparkSession) -> None:
    """Have the driver collect its garbage, between the steps of a long job.

    Spark drops the shuffles and broadcasts of past plans when the driver's collector finds
    them unused; until then they hold disk, and memory of the driver and of executors, and
    the driver's heap grows to its limit meanwhile.
    """
    spark._jvm.System.gc()
