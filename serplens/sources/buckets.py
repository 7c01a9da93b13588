"""Tables merged run by run: rows in buckets by key, of which a run rewrites those it touches.

Layout: ``<base>/<table>/filter_tag=../run=<id>/bucket=<k>``. A run writes its buckets
into a folder of its own and then registers them; a reader takes every bucket from the
run that registered it last. So nothing a reader may be reading is overwritten, a run
that fails leaves the table as it was, and buckets without new rows keep their files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from serplens.sources.snapshots import new_run, tag_folder

BUCKETS = 64
_REGISTERED = T.StructType([
    T.StructField("run", T.StringType()),
    T.StructField("buckets", T.IntegerType()),
    T.StructField("bucket", T.IntegerType()),
    T.StructField("rows", T.LongType()),
])


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _current(spark: SparkSession, root: str) -> list:
    """(bucket, buckets, run, rows) of every bucket; run ids ascend in time."""
    try:
        registered = spark.read.schema(_REGISTERED).json(f"{root}/registered")
    except AnalysisException:
        return []
    return registered.groupBy("bucket").agg(
        F.max(F.struct("run", "buckets", "rows")).alias("last")).select("bucket", "last.*").collect()


def _read(spark: SparkSession, root: str, current: list, schema: T.StructType) -> DataFrame:
    if not current:
        return spark.createDataFrame([], schema)
    folders = [f"{root}/run={r['run']}/bucket={r['bucket']}" for r in current]
    return spark.read.schema(schema).parquet(*folders)


def read_merged(spark: SparkSession, base: str, table: str, tag: str, schema: T.StructType) -> DataFrame:
    """All rows of a merged table as of its last registered run; none before the first."""
    root = tag_folder(base, table, tag)
    return _read(spark, root, _current(spark, root), schema)


def merge_rows(rows: DataFrame, base: str, table: str, tag: str, key: str, buckets: int = BUCKETS) -> int:
    """Put ``rows`` into a merged table; a key already there takes the new row. Returns the table's size.

    ``buckets`` counts for a table's first run and is kept. Rows of untouched buckets are
    neither read nor written. ``rows`` has each key once and is read twice.
    """
    spark = rows.sparkSession
    root, schema = tag_folder(base, table, tag), rows.schema
    current = _current(spark, root)
    buckets = current[0]["buckets"] if current else buckets
    placed = rows.withColumn("bucket", bucket_of(key, buckets))
    # At most one row per bucket, here and below.
    touched = {r["bucket"] for r in placed.select("bucket").distinct().collect()}
    old = _read(spark, root, [r for r in current if r["bucket"] in touched], schema)
    kept = old.join(rows.select(key), key, "left_anti").withColumn("bucket", bucket_of(key, buckets))
    run = new_run()
    kept.unionByName(placed).repartition("bucket").write.partitionBy("bucket").parquet(f"{root}/run={run}")
    sizes = {r["bucket"]: r["rows"] for r in current}
    if touched:
        written = spark.read.parquet(f"{root}/run={run}").groupBy("bucket").agg(F.count(F.lit(1)).alias("rows")).collect()
        spark.createDataFrame([(run, buckets, r["bucket"], r["rows"]) for r in written], _REGISTERED) \
            .coalesce(1).write.mode("append").json(f"{root}/registered")
        sizes |= {r["bucket"]: r["rows"] for r in written}
    return sum(sizes.values())
