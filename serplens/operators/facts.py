"""Search facts: roll-up, filters, zero-click and ranking reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from serplens import params
from serplens.functions import labels
from serplens.params import Site


def sum_facts(facts: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """Additive metrics per combination of dimensions.

    Accepts facts as well as earlier sums, so that a coarser grain can be had
    from a finer one without reading the facts again.
    """
    weighted = F.col("weighted_position") if "weighted_position" in facts.columns \
        else F.col("impressions") * F.col("position")
    return facts.groupBy(*dimensions).agg(
        F.sum("clicks").alias("clicks"),
        F.sum("impressions").alias("impressions"),
        F.sum(weighted).alias("weighted_position"),
    )


def as_metrics(sums: DataFrame) -> DataFrame:
    """Click-through rate and impression-weighted position of summed facts."""
    dimensions = [c for c in sums.columns if c not in ("clicks", "impressions", "weighted_position")]
    return sums.select(
        *dimensions, "clicks", "impressions",
        F.coalesce(F.try_divide("clicks", "impressions"), F.lit(0.0)).alias("ctr"),
        F.coalesce(F.try_divide("weighted_position", "impressions"), F.lit(0.0)).alias("position"),
    )


def roll_up(facts: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """Metrics per combination of dimensions."""
    return as_metrics(sum_facts(facts, dimensions))


def filter_pages(df: DataFrame, page_filter: str | None = None, exclude: Sequence[str] = ()) -> DataFrame:
    """Rows whose ``path`` matches the filter and none of the exclusions."""
    if page_filter:
        df = df.where(labels.matches_any(F.col("path"), [page_filter]))
    if exclude:
        df = df.where(~labels.matches_any(F.col("path"), exclude))
    return df


def page_totals(facts: DataFrame) -> DataFrame:
    """Impressions and clicks per page over all its queries."""
    return facts.groupBy("page").agg(
        F.sum("impressions").alias("page_impressions"),
        F.sum("clicks").alias("page_clicks"),
    )


def top_queries(facts: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` queries of each key with most impressions, ties by query.

    The rank limit is applied before the shuffle as well, so a key with very
    many rows sends at most ``n`` of them per input partition.
    """
    order = Window.partitionBy(key).orderBy(F.desc("impressions"), F.asc("query"))
    return facts.withColumn("query_rank", F.row_number().over(order)) \
        .where(F.col("query_rank") <= n)


def zero_click_rows(query_page: DataFrame, site: Site, top_n: int = params.ZERO_CLICK_TOP_N) -> DataFrame:
    """Top queries of the pages that were shown but never clicked, unordered.

    Rows are cut to the top queries before they meet the page totals: a page
    that owns a large share of all rows then brings only a few into the join.
    """
    facts = filter_pages(
        query_page.withColumn("path", labels.path_of(F.col("page"), site.origin)),
        site.page_filter, site.exclude_patterns,
    )
    unclicked = page_totals(facts).where(F.col("page_clicks") == 0)
    best = top_queries(facts, "page", top_n)
    return best.join(unclicked, "page").select(
        "page", "path", "query", "impressions", "position", "page_impressions", "page_clicks",
    )


def zero_click_order() -> list[Column]:
    """Order of the zero-click report: pages by total impressions, each with its top queries."""
    return [F.desc("page_impressions"), F.desc("impressions"), F.asc("page"), F.asc("query")]


def ranking_order() -> list[Column]:
    return [F.desc("impressions"), F.asc("path")]


def zero_click_report(query_page: DataFrame, site: Site, top_n: int = params.ZERO_CLICK_TOP_N) -> DataFrame:
    """Zero-click pages by total impressions, each with its top queries."""
    return zero_click_rows(query_page, site, top_n).orderBy(*zero_click_order()).drop("page")


def label_pages(pages: DataFrame, site: Site) -> DataFrame:
    """Page-grain facts with path, page type, rank bin and priority label."""
    path = labels.path_of(F.col("page"), site.origin)
    return pages.select(
        path.alias("path"),
        "position",
        labels.rank_bin(F.col("position")).alias("rank_bin"),
        labels.priority_label(F.col("position")).alias("priority_label"),
        "clicks", "impressions", "ctr", "page",
        labels.page_type(path, site.page_type_rules).alias("page_type"),
    )


#: Ranges that one pass of a selection counts.
SELECTION_RANGES = 4096


def values_at(df: DataFrame, column: str, places: Sequence[int], low: int, high: int) -> list[int]:
    """The integers at the given places, from 0, of ``column`` in ascending order, all between two bounds.

    Selection by counting: the values between the bounds are counted in
    ``SELECTION_RANGES`` equal ranges, the range that holds a place is divided again,
    until it is one value wide. Every task sends one count per range and the driver
    sees no more, however many rows or values there are. Two places are usually in one range.
    """
    wanted = {place: (low, high, place) for place in places}
    while any(lo < hi for lo, hi, _ in wanted.values()):
        spans = sorted({(lo, hi) for lo, hi, _ in wanted.values() if lo < hi})
        widths = {span: -(-(span[1] - span[0] + 1) // SELECTION_RANGES) for span in spans}
        inside = " ".join(f"WHEN {column} BETWEEN {lo}L AND {hi}L THEN struct({i} AS span, ({column} - {lo}L) div {widths[lo, hi]}L AS part)"
                          for i, (lo, hi) in enumerate(spans))
        counted = df.select(F.expr(f"CASE {inside} END").alias("at")).where("at IS NOT NULL") \
            .groupBy("at.span", "at.part").agg(F.count(F.lit(1)).alias("n")).orderBy("span", "part").collect()
        for place, (lo, hi, rest) in wanted.items():
            if lo == hi:
                continue
            width = widths[lo, hi]
            for row in (r for r in counted if spans[r["span"]] == (lo, hi)):
                if rest < row["n"]:
                    start = lo + row["part"] * width
                    wanted[place] = (start, min(hi, start + width - 1), rest)
                    break
                rest -= row["n"]
    return [wanted[place][0] for place in places]


def median_of(df: DataFrame, column: str) -> float | None:
    """Exact, interpolated median of an integer column, by distributed selection; None without values.

    ``df`` is read once for its bounds and once per division, so it should be written already.
    """
    n, low, high = df.agg(F.count(column), F.min(column), F.max(column)).first()
    if n == 0:
        return None
    middle = sorted({(n - 1) // 2, n // 2})
    return sum(values_at(df, column, middle, low, high)) / len(middle)


def segment_pages(labelled: DataFrame) -> DataFrame:
    """Demand segment of each page against the median page of the same frame."""
    median = F.lit(median_of(labelled, "impressions")).cast("double")
    return labelled.withColumn(
        "segment", labels.demand_segment(F.col("impressions"), F.col("clicks"), median)
    )


def ranking_rows(pages: DataFrame, site: Site) -> DataFrame:
    """Labelled, filtered and segmented pages, unordered."""
    labelled = label_pages(pages, site)
    return segment_pages(filter_pages(labelled, site.page_filter, site.exclude_patterns))


def ranking_report(pages: DataFrame, site: Site) -> DataFrame:
    """Ranking rows by impressions."""
    return ranking_rows(pages, site).orderBy(*ranking_order())
