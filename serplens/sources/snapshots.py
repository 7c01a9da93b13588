"""Dated snapshots of the reports: ``<base>/<table>/filter_tag=../run_date=../run=..``.

Every run writes a folder of its own, even when it is empty, and adds one row to the
``runs`` table last. "Latest" is therefore a lookup in a table with one row per run
instead of a listing of file names. A run that repeats a date replaces the earlier
one at the moment it is registered: until then, and if it fails, readers see the rows
of the earlier run, whose files are left alone.
"""

from __future__ import annotations

import time
import uuid
from datetime import date
from urllib.parse import quote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

RUNS = T.StructType([
    T.StructField("table", T.StringType()),
    T.StructField("filter_tag", T.StringType()),
    T.StructField("run_date", T.DateType()),
    T.StructField("rows", T.LongType()),
    T.StructField("run", T.StringType()),
])


class SnapshotMismatch(ValueError):
    """Two inputs of one step come from different runs."""


def latest_snapshot(table: DataFrame, tag: str | None = None) -> DataFrame:
    """Rows of the newest ``run_date``, within one filter tag when given."""
    rows = table if tag is None else table.where(F.col("filter_tag") == tag)
    newest = rows.agg(F.max("run_date").alias("newest"))
    return rows.where(F.col("run_date") == newest.scalar())


def new_run() -> str:
    """Id of a run; later ones sort behind earlier ones."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def write_snapshot(df: DataFrame, base: str, table: str, tag: str, run_date: date) -> int:
    """Write one dated run and register it; returns its number of rows.

    The row count is observed while writing, not by a second pass.
    """
    spark, run = df.sparkSession, new_run()
    seen = Observation()
    observed = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    observed.write.parquet(f"{_partition(base, table, tag, run_date)}/run={run}")
    rows = seen.get["rows"]
    spark.createDataFrame([(table, tag, run_date, rows, run)], RUNS).coalesce(1) \
        .write.mode("append").json(f"{base}/runs")
    return rows


def _runs(spark: SparkSession, base: str, table: str, tag: str) -> DataFrame:
    try:
        runs = spark.read.schema(RUNS).json(f"{base}/runs")
    except AnalysisException as missing:
        raise FileNotFoundError(f"no runs registered under {base}") from missing
    return runs.where((F.col("table") == table) & (F.col("filter_tag") == tag))


def read_snapshot(spark: SparkSession, base: str, table: str, tag: str, run_date: date,
                  schema: T.StructType) -> DataFrame:
    """Rows of the run of ``run_date`` that was registered last."""
    run = _runs(spark, base, table, tag).where(F.col("run_date") == F.lit(run_date)).agg(F.max("run")).first()[0]
    if run is None:
        raise FileNotFoundError(f"no snapshot of {table!r} with filter tag {tag!r} of {run_date} under {base}")
    return spark.read.schema(schema).parquet(f"{_partition(base, table, tag, run_date)}/run={run}")


def latest_run(spark: SparkSession, base: str, table: str, tag: str) -> date:
    """Newest run of a table within one filter tag."""
    newest = _runs(spark, base, table, tag).agg(F.max("run_date")).first()[0]
    if newest is None:
        raise FileNotFoundError(f"no snapshot of {table!r} with filter tag {tag!r} under {base}")
    return newest


def common_run(spark: SparkSession, base: str, tables: list[str], tag: str) -> date:
    """Newest run, which has to be the same one for all tables."""
    newest = {t: latest_run(spark, base, t, tag) for t in tables}
    if len(set(newest.values())) > 1:
        raise SnapshotMismatch(f"inputs come from different runs: {newest}")
    return next(iter(newest.values()))


def _partition(base: str, table: str, tag: str, run_date: date) -> str:
    return f"{tag_folder(base, table, tag)}/run_date={run_date.isoformat()}"


def tag_folder(base: str, table: str, tag: str) -> str:
    return f"{base}/{table}/filter_tag={quote(tag, safe='')}"
