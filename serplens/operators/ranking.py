"""Priority ranking of pages by missed opportunity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from serplens import params
from serplens.functions import labels
from serplens.operators.facts import top_queries
from serplens.params import Site
from serplens.sources.storage import materialize

_QUERY = "struct<query:string,impressions:bigint,position:double>"


def nested_queries(zero_click: DataFrame, n: int = params.NESTED_TOP_N) -> DataFrame:
    """Per path, the list of its ``n`` top queries, best first."""
    entry = F.struct("query_rank", F.struct("query", "impressions", "position").alias("q"))
    return top_queries(zero_click, "path", n).groupBy("path").agg(
        F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["q"]).alias("top_queries")
    )


def query_counts(zero_click: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct queries per path."""
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return zero_click.groupBy("path").agg(distinct("query").alias("query_count"))


def path_queries(zero_click: DataFrame, n: int = params.NESTED_TOP_N) -> DataFrame:
    """Top queries and number of distinct queries per path.

    Two aggregates instead of one, so that neither has to bring all rows of a
    path together: the list is cut and the count combined before the shuffle.
    Both end up partitioned by path, which leaves nothing to move for the join.
    """
    return query_counts(zero_click).join(nested_queries(zero_click, n), "path")


def attach_counts(ranking: DataFrame, counts: DataFrame) -> DataFrame:
    """Ranking rows with their number of queries, 0 for pages without any."""
    return ranking.join(counts, "path", "left") \
        .withColumn("query_count", F.coalesce("query_count", F.lit(0)).cast("long"))


def attach_queries(ranking: DataFrame, queries: DataFrame) -> DataFrame:
    """Ranking rows with counts and top queries; pages without any get an empty list."""
    return attach_counts(ranking, queries) \
        .withColumn("top_queries", F.coalesce("top_queries", F.array().cast(f"array<{_QUERY}>")))


def score_pages(counted: DataFrame, site: Site) -> DataFrame:
    """Actionable pages with content type, language and opportunity score."""
    return (
        counted
        .withColumns({
            "seo_page_type": labels.content_type(F.col("path"), site.content_segments),
            "language": labels.language_of(F.col("path")),
        })
        .where(F.col("seo_page_type").isin(*params.ACTIONABLE_CONTENT) & (F.col("query_count") > 0))
        .withColumn("priority_score", labels.opportunity_score(F.col("impressions"), F.col("ctr")))
    )


RANKED_COLUMNS = (
    "path", "seo_page_type", "language", "priority_score", "impressions", "ctr", "position",
    "priority_label", "query_count",
)


def _score_order() -> list[Column]:
    return [F.desc("priority_score"), F.asc("path")]


def with_global_rank(df: DataFrame, order: Sequence[Column], rank: str = "priority_rank",
                     partitions: int | None = None) -> DataFrame:
    """Position of each row in the total order, without a one-task window.

    Range partitions are sorted in parallel and each row keeps its partition
    and place in it. Only the row count per partition reaches the driver, and
    turns into the rank of each partition's first row. Sampled range bounds may
    differ between runs of the same plan, so the placed rows are written before
    they are counted.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The id holds the partition in the upper 31 bits and the place in the lower 33.
    placed = materialize(
        df.repartitionByRange(n, *order).sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id()), "placed")
    part = F.shiftright("_place", 33).cast("int")
    sizes = {r["part"]: r["n"] for r in
             placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
    starts, total = [], 0
    for i in range(max(sizes, default=-1) + 1):
        starts.append(total)
        total += sizes.get(i, 0)
    first = F.get(F.expr(f"array({', '.join(f'{n}L' for n in starts or [0])})"), part)
    within = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.withColumn(rank, first + within + 1).drop("_place")


def priority_ranking(ranking: DataFrame, zero_click: DataFrame, site: Site) -> DataFrame:
    """Actionable pages with an explicit ``priority_rank``, unordered.

    Only the number of queries matters here, so their lists are not built.
    """
    scored = score_pages(attach_counts(ranking, query_counts(zero_click)), site)
    ranked = with_global_rank(scored.select(*RANKED_COLUMNS), _score_order())
    return ranked.select("priority_rank", *RANKED_COLUMNS)


def top_pages(scored: DataFrame, n: int) -> DataFrame:
    """The ``n`` best pages with their rank, for reports that need only the top.

    Each task keeps ``n`` rows and those are merged; nothing is sorted in full.
    """
    best = scored.orderBy(*_score_order()).limit(n)
    nth = F.row_number().over(Window.orderBy(*_score_order()))
    return best.withColumn("priority_rank", nth.cast("long"))


def rank_range(ranked: DataFrame, first: int, last: int,
               batch_size: int = params.REWRITE_BATCH_SIZE) -> DataFrame:
    """Ranks ``first`` to ``last``, with the number of the batch each belongs to."""
    rank = F.col("priority_rank")
    return ranked.where(rank.between(first, last)).withColumn(
        "batch_id", F.floor((rank - F.lit(first)) / F.lit(batch_size)).cast("long")
    )


def parse_range(spec: str | int) -> tuple[int, int]:
    """``50`` means the top 50, ``31-60`` those ranks."""
    first, dash, last = str(spec).partition("-")
    return (int(first), int(last)) if dash else (1, int(first))


def by_type(ranked: DataFrame) -> DataFrame:
    return ranked.groupBy("seo_page_type").agg(
        F.count(F.lit(1)).alias("pages"),
        F.avg("priority_score").alias("avg_score"),
        F.sum("impressions").alias("total_impressions"),
    )


def by_language(ranked: DataFrame) -> DataFrame:
    return ranked.groupBy("language").agg(F.count(F.lit(1)).alias("pages"))


def ranking_summary(ranking: DataFrame, ranked: DataFrame) -> DataFrame:
    """Pages before and after the filter and the best score, in one row."""
    total = ranking.agg(F.count(F.lit(1)).alias("n")).scalar()
    return ranked.agg(
        F.count(F.lit(1)).alias("ranked_pages"),
        F.coalesce(F.max("priority_score"), F.lit(0.0)).alias("top_score"),
    ).select(total.alias("total_pages"), "ranked_pages", "top_score")
