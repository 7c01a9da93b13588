"""Search facts kept by day: sums and query sketches, of which only changed days are made again.

Landed responses lie in folders ``run_date=<day>``. A refresh compares names, sizes and
times of their files with those it registered, without opening one, and reads only the days
that differ: new ones, and late ones whose files were added to, replaced or removed. A day
that is read again replaces its earlier sums as a whole. Windows of any length then merge
stored days. As with snapshots, a refresh writes a folder of its own and registers it last.

Layout: ``<base>/days/sums/run=<id>/run_date=<day>``, ``<base>/days/sketches/..`` alike.
"""

from __future__ import annotations

import math
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from serplens.operators import facts
from serplens.sources import landing
from serplens.sources.snapshots import new_run
from serplens.sources.storage import materialize, release

SUMS = T.StructType([
    T.StructField("query", T.StringType()), T.StructField("page", T.StringType()),
    T.StructField("clicks", T.LongType()), T.StructField("impressions", T.LongType()),
    T.StructField("weighted_position", T.DoubleType()), T.StructField("run_date", T.DateType()),
])
SKETCHES = T.StructType([
    T.StructField("page", T.StringType()), T.StructField("queries", T.BinaryType()),
    T.StructField("run_date", T.DateType()),
])
_REGISTERED = T.StructType([
    T.StructField("run", T.StringType()), T.StructField("run_date", T.DateType()),
    T.StructField("files", T.StringType()),
])
#: Sketches have 2 ** SKETCH_BITS registers, which sets their relative standard error once merged.
SKETCH_BITS = 12
STANDARD_ERROR = 1.04 / math.sqrt(1 << SKETCH_BITS)
#: Estimates count as near a threshold within so many standard errors of it.
ERRORS = 6


def _landed(spark: SparkSession, path: str) -> dict[date, str]:
    """A digest of the names, sizes and times of each day's files; one row per day comes back."""
    file = F.concat_ws("|", "path", "length", F.unix_micros("modificationTime"))
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.json*").load(path)
    day = F.regexp_extract("path", r"/run_date=([0-9-]+)/[^/]*$", 1).try_cast("date")
    found = listed.groupBy(day.alias("run_date")) \
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(file).cast("decimal(38,0)")).alias("digest"))
    return {r["run_date"]: f"{r['n']}:{r['digest']}" for r in found.where("run_date IS NOT NULL").collect()}


def _registered(spark: SparkSession, base: str) -> dict:
    """The row that registered each day last."""
    try:
        rows = spark.read.schema(_REGISTERED).json(f"{base}/days/registered")
    except AnalysisException:
        return {}
    last = rows.groupBy("run_date").agg(F.max(F.struct("run", "files")).alias("last"))
    return {r["run_date"]: r for r in last.select("run_date", "last.*").collect()}


def refresh(spark: SparkSession, landed: str, base: str, window: tuple[date, date]) -> list[date]:
    """Bring the stored days of ``window`` up to date with the landed files; returns the days read or emptied."""
    first, last = window
    now = {day: files for day, files in _landed(spark, landed).items() if first <= day <= last}
    before = {day: row["files"] for day, row in _registered(spark, base).items() if first <= day <= last}
    changed = sorted(day for day in now.keys() | before.keys() if now.get(day, "") != before.get(day, ""))
    if not changed:
        return []
    run = new_run()
    # Files that land while this runs are read or not; either way they differ from what is registered.
    rows = landing.read_days(spark, landed).where(F.col("run_date").isin(changed))
    flat = landing.flatten_responses(rows, ["query", "page"], keep=["run_date"])
    sums = facts.sum_facts(flat, ["run_date", "query", "page"])
    sums.write.partitionBy("run_date").parquet(f"{base}/days/sums/run={run}")
    written = spark.read.schema(SUMS).parquet(f"{base}/days/sums/run={run}")
    written.groupBy("run_date", "page").agg(F.hll_sketch_agg("query", F.lit(SKETCH_BITS)).alias("queries")) \
        .write.partitionBy("run_date").parquet(f"{base}/days/sketches/run={run}")
    spark.createDataFrame([(run, day, now.get(day, "")) for day in changed], _REGISTERED) \
        .coalesce(1).write.mode("append").json(f"{base}/days/registered")
    return changed


def _read(spark: SparkSession, base: str, table: str, window: tuple[date, date], schema: T.StructType) -> DataFrame:
    runs: dict[str, list[date]] = {}
    for day, row in _registered(spark, base).items():
        if window[0] <= day <= window[1] and row["files"]:
            runs.setdefault(row["run"], []).append(day)
    read = spark.createDataFrame([], schema)
    for run, days in sorted(runs.items()):
        # Partitions are pruned by date; days without rows have none.
        read = read.unionByName(spark.read.schema(schema).parquet(f"{base}/days/{table}/run={run}").where(F.col("run_date").isin(days)))
    return read


def read_sums(spark: SparkSession, base: str, window: tuple[date, date]) -> DataFrame:
    """``SUMS`` of the stored days of ``window``, a row per day, query and page."""
    return _read(spark, base, "sums", window, SUMS)


def query_estimates(spark: SparkSession, base: str, window: tuple[date, date]) -> DataFrame:
    """(page, query_count): distinct queries of the window, estimated from the stored sketches alone.

    The relative standard error is ``STANDARD_ERROR``; small counts are exact.
    """
    return _read(spark, base, "sketches", window, SKETCHES).groupBy("page") \
        .agg(F.hll_sketch_estimate(F.hll_union_agg("queries")).alias("query_count"))


def pages_with_queries(spark: SparkSession, base: str, window: tuple[date, date], at_least: int) -> DataFrame:
    """(page) of the pages with at least so many distinct queries in the window.

    Sketches decide all pages whose estimate is clear of the threshold; the queries
    of the others are counted exactly.
    """
    estimates = materialize(query_estimates(spark, base, window), "query_estimates")
    band = ERRORS * STANDARD_ERROR * at_least
    near = F.abs(F.col("query_count") - at_least) <= F.lit(band) + 1
    doubtful = estimates.where(near).select("page")
    exact = read_sums(spark, base, window).join(doubtful, "page", "left_semi") \
        .groupBy("page").agg(F.count_distinct("query").alias("query_count")).where(F.col("query_count") >= at_least)
    clear = estimates.where(~near & (F.col("query_count") > at_least))
    pages = materialize(clear.select("page").unionByName(exact.select("page")), "pages_with_queries")
    release(estimates)
    return pages
