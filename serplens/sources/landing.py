"""Landed search-analytics responses and the date window to read."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from serplens import params, schemas


def date_window(spec: str, as_of: date) -> tuple[date, date]:
    """First and last day of ``7d`` / ``3m`` / ``2026-01-01,2026-03-01``.

    Relative windows end a few days before ``as_of``, because search data
    arrives late; a month counts as 30 days.
    """
    relative = re.fullmatch(r"(\d+)([dm])", spec.strip())
    if relative:
        amount, unit = relative.groups()
        end = as_of - timedelta(days=params.SEARCH_LAG_DAYS)
        return end - timedelta(days=int(amount) * (30 if unit == "m" else 1)), end
    if "," in spec:
        first, last = spec.split(",")[:2]
        return date.fromisoformat(first.strip()), date.fromisoformat(last.strip())
    raise ValueError(f"unrecognised date range {spec!r}: use 7d, 3m or 'YYYY-MM-DD,YYYY-MM-DD'")


def in_window(facts: DataFrame, window: tuple[date, date], day: str = "run_date") -> DataFrame:
    """Rows of the window; on a date-partitioned table this prunes partitions."""
    return facts.where(F.col(day).between(F.lit(window[0]), F.lit(window[1])))


def read_responses(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Landed responses, one JSON object per line."""
    return spark.read.schema(schemas.RESPONSE).json(path)


def read_days(spark: SparkSession, path: str) -> DataFrame:
    """Landed responses in folders ``run_date=<day>``, which filters by day prune."""
    dated = T.StructType([*schemas.RESPONSE.fields, T.StructField("run_date", T.DateType())])
    return spark.read.schema(dated).json(path)


def flatten_responses(responses: DataFrame, dimensions: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """One row per result row; the j-th key is the j-th dimension, ``keep`` are columns of the response.

    Missing keys become ``""`` and missing metrics 0. A response without rows
    contributes nothing, so no rows at all give an empty frame with full schema.
    """
    row = F.col("row")
    keys = [
        F.coalesce(F.get(row["keys"], F.lit(j)), F.lit("")).alias(name)
        for j, name in enumerate(dimensions)
    ]
    metrics = [
        F.coalesce(row[f.name], F.lit(0).cast(f.dataType)).alias(f.name)
        for f in schemas.METRIC_FIELDS
    ]
    return responses.select(*keep, F.explode("rows").alias("row")).select(*keep, *keys, *metrics)
