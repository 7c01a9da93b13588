"""The driver's tables as these operators read them, and joins by row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def keyed(docs: DataFrame, *columns: str) -> DataFrame:
    """(doc_id, text_hash, text, columns): a row is known by its id and its text.

    Rows that repeat both are one row to a join; ids alone need not be unique.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.xxhash64("text").alias("text_hash"), "text", *columns)


def join_rows(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join on (doc_id, text_hash), null ids included; right's keys are dropped."""
    other = right.withColumnsRenamed({"doc_id": "_doc_id", "text_hash": "_text_hash"})
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("text_hash") == F.col("_text_hash"))
    return left.join(other, same, how).drop("_doc_id", "_text_hash")
