"""Reports over extracted page metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from serplens.functions import labels
from serplens.functions.numbers import percent_of, round_exact

MISSING_SAMPLE = 10


def present(value: Column) -> Column:
    """True for non-empty text."""
    return F.coalesce(F.length(value) > 0, F.lit(False))


def present_list(value: Column) -> Column:
    return F.coalesce(F.size(value) > 0, F.lit(False))


def in_priority_order(pages: DataFrame, ranked: DataFrame) -> DataFrame:
    """Pages with their rank; pages outside the ranking are dropped."""
    return pages.join(ranked.select("path", "priority_rank"), "path")


def crawl_rows(pages: DataFrame, base_url: str) -> DataFrame:
    """Status, timing and presence flags per page, unordered."""
    return pages.select(
        "priority_rank", "path",
        labels.full_url(base_url, F.col("path")).alias("url"),
        "status",
        round_exact(F.col("elapsed_s"), 2).alias("elapsed_s"),
        present(F.col("title")).alias("has_title"),
        present(F.col("meta_description")).alias("has_description"),
        present(F.col("og_title")).alias("has_og"),
        present_list(F.col("schema_json_ld")).alias("has_schema"),
        F.col("error").isNotNull().alias("has_error"),
        F.coalesce("title", F.lit("")).alias("title"),
        F.coalesce("error", F.lit("")).alias("error"),
    )


def crawl_report(pages: DataFrame, ranked: DataFrame, base_url: str) -> DataFrame:
    """Crawl rows of the ranked pages, best page first."""
    return crawl_rows(in_priority_order(pages, ranked), base_url).orderBy("priority_rank", "path")


#: Counter: (column it looks at, test).
COVERAGE = {
    "title": ("title", present),
    "meta_description": ("meta_description", present),
    "meta_keywords": ("meta_keywords", present),
    "og_tags": ("og_title", present),
    "schema_json_ld": ("schema_json_ld", present_list),
    "canonical": ("canonical", present),
    "h1": ("h1", present_list),
}


def coverage(pages: DataFrame) -> DataFrame:
    """How many pages carry each kind of metadata: one row, one pass."""
    counts = [F.count_if(test(F.col(column))).alias(name) for name, (column, test) in COVERAGE.items()]
    counted = pages.agg(
        F.count(F.lit(1)).alias("total_pages"), *counts,
        F.count_if(F.col("error").isNotNull()).alias("errors"),
    )
    shares = {
        f"{name}_pct": percent_of(F.col(name), F.col("total_pages")) for name in (*COVERAGE, "errors")
    }
    return counted.withColumns(shares)


def missing_samples(pages: DataFrame, n: int = MISSING_SAMPLE) -> DataFrame:
    """The first ``n`` pages without a title and without a description.

    Each comes with the number of all such pages of its kind. ``pages`` is read twice per kind.
    """
    def sample(column: str) -> DataFrame:
        missing = pages.where(~present(F.col(column)))
        total = missing.agg(F.count(F.lit(1)).alias("n")).scalar()
        first = missing.orderBy(F.asc_nulls_last("priority_rank"), "path").limit(n)
        return first.select(F.lit(column).alias("field"), "priority_rank", "path",
                            total.alias("missing_total"))

    return sample("title").unionAll(sample("meta_description"))
