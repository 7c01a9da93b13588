"""Rewrite contexts, post-processing and the incremental merge of metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from serplens import params, schemas
from serplens.functions import jsonld, labels, text
from serplens.operators import audit, ranking
from serplens.operators.facts import top_queries
from serplens.params import Site


def rewrite_queries(zero_click: DataFrame, k: int = params.REWRITE_TOP_QUERIES) -> DataFrame:
    """The ``k`` top queries per path; full URLs are reduced to their path."""
    by_path = zero_click.withColumn("path", labels.url_path(F.col("path")))
    entry = F.struct("query_rank", F.struct("query", "impressions").alias("q"))
    return top_queries(by_path, "path", k).groupBy("path").agg(
        F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["q"]).alias("top_queries")
    )


def rewrite_targets(ranked: DataFrame, spec: str | int,
                    batch_size: int = params.REWRITE_BATCH_SIZE) -> DataFrame:
    """Ranked pages of a selection such as ``30`` or ``31-60``, in batches."""
    return ranking.rank_range(ranked, *ranking.parse_range(spec), batch_size)


def rewrite_context(targets: DataFrame, pages: DataFrame, zero_click: DataFrame,
                    audited: DataFrame | None = None) -> DataFrame:
    """Everything a rewriter needs per target; targets without metadata are left out.

    Issues are part of it if ``audited`` is given. Applying rewrites needs none.
    """
    empty = F.array().cast("array<struct<query:string,impressions:bigint>>")
    rows = (
        targets.join(pages.select("path", *schemas.META_VALUES.names), "path")
        .join(rewrite_queries(zero_click), "path", "left")
        .withColumn("top_queries", F.coalesce("top_queries", empty))
    )
    if audited is None:
        return rows
    return rows.join(audited.select("path", "issues"), "path", "left") \
        .withColumn("issues", F.coalesce("issues", F.array().cast("array<string>")))


def skipped_targets(targets: DataFrame, pages: DataFrame) -> DataFrame:
    """Targets for which no metadata exists."""
    return targets.join(pages.select("path"), "path", "left_anti")


def _keywords(top_queries: Column) -> Column:
    supplied = F.trim(F.col("new_keywords"))
    fallback = F.array_join(F.transform(top_queries, lambda q: q["query"]), ", ")
    return F.coalesce(F.nullif(supplied, F.lit("")), fallback)


def apply_rewrites(context: DataFrame, rewritten: DataFrame, site: Site, date: Column) -> DataFrame:
    """Updated metadata of the rewritten pages, in the layout of ``page_meta``.

    Titles and descriptions are fitted to their limits, social tags and
    structured data follow them, and everything else keeps its value. ``date``
    fills publication dates that structured data lacks.
    """
    renamed = rewritten.select(
        "path",
        *(F.col(c).alias(f"new_{c}") for c in rewritten.columns if c != "path"),
    )
    rows = context.join(renamed, "path")
    title = text.branded_title(
        text.or_empty(F.trim("new_title")), site.brand_suffix, site.max_title_length
    )
    description = text.clamp(
        text.or_empty(F.trim("new_description")), site.max_description_length
    )
    rows = rows.withColumns({
        "title": title,
        "meta_description": description,
        "meta_keywords": _keywords(F.col("top_queries")),
    })
    headline = text.without_suffix(F.col("title"), site.brand_suffix)
    rows = rows.withColumns({
        "og_title": F.col("title"),
        "og_description": F.col("meta_description"),
        "og_url": F.coalesce("canonical", labels.full_url(site.base_url, F.col("path"))),
        "og_type": F.coalesce("og_type", F.lit("article")),
        "twitter_title": F.col("title"),
        "twitter_description": F.col("meta_description"),
        "schema_json_ld": jsonld.enrich(
            F.col("schema_json_ld"),
            headline=headline,
            description=F.col("meta_description"),
            date=date,
            content=F.col("seo_page_type"),
            term_name=F.coalesce("new_term_name", headline),
            subject=F.coalesce("new_subject", F.lit("")),
        ),
    })
    return rows.select(*schemas.PAGE_META.names)


def merge_metadata(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Both runs together; a path in both keeps the current row."""
    return previous.join(current.select("path"), "path", "left_anti").unionByName(current)


def backup_originals(pages: DataFrame, targets: DataFrame) -> DataFrame:
    """Original metadata of the processed paths."""
    return pages.join(targets.select("path"), "path", "left_semi")


def update_statistics(before: DataFrame, after: DataFrame, skipped: DataFrame) -> DataFrame:
    """What a rewrite changed, from audited originals and audited results."""
    kept = ("title_length", "desc_length", "language_mismatch", "issues")

    def side(df: DataFrame, prefix: str) -> DataFrame:
        return df.select("path", *(F.col(c).alias(f"{prefix}_{c}") for c in kept))

    both = side(before, "old").join(side(after, "new"), "path")
    n_skipped = skipped.agg(F.count(F.lit(1)).alias("n")).scalar()

    def fixed(issue: str) -> Column:
        gone = F.array_contains("old_issues", issue) & ~F.array_contains("new_issues", issue)
        return F.count_if(gone)

    def broken_schema(issues: str) -> Column:
        return F.exists(issues, lambda i: i.startswith("schema:"))

    rules = ("desc_too_long", "title_too_long", "generic_opening", "missing_keywords")
    return both.agg(
        F.count(F.lit(1)).alias("processed"),
        *(fixed(rule).alias(f"fixed_{rule}") for rule in rules),
        fixed("language_mismatch").alias("fixed_language"),
        F.count_if(broken_schema("old_issues") & ~broken_schema("new_issues")).alias("fixed_schema"),
        F.coalesce(F.sum("old_title_length"), F.lit(0)).alias("title_chars_before"),
        F.coalesce(F.sum("new_title_length"), F.lit(0)).alias("title_chars_after"),
        F.coalesce(F.sum("old_desc_length"), F.lit(0)).alias("desc_chars_before"),
        F.coalesce(F.sum("new_desc_length"), F.lit(0)).alias("desc_chars_after"),
    ).withColumn("skipped", n_skipped)


def acceptance(updated: DataFrame, site: Site, zero_click: DataFrame) -> DataFrame:
    """Which output rules each updated page meets.

    The description alone has to cover every top query, title and keywords do not count.
    A page without queries covers them all.
    """
    path, title, desc = F.col("path"), F.col("title"), F.col("meta_description")
    english, nothing = path.startswith("/en/"), F.lit(None).cast("string")
    queries = F.coalesce("queries", F.array().cast("array<string>"))
    uncovered = text.uncovered_queries(nothing, desc, nothing, queries)
    return updated.join(audit.coverage_queries(zero_click), "path", "left").select(
        "path",
        (~text.too_long(title, site.max_title_length)).alias("title_fits"),
        (~text.too_long(desc, site.max_description_length)).alias("description_fits"),
        text.or_empty(title).endswith(site.brand_suffix).alias("branded"),
        text.generic_opener(text.or_empty(desc), site.generic_openers).isNull().alias("specific_opening"),
        # English pages carry no Chinese text, the others some.
        F.when(english, ~text.has_cjk(title) & ~text.has_cjk(desc))
        .otherwise(~text.language_mismatch(path, title, desc)).alias("language_matches"),
        (F.size(uncovered) == 0).alias("covers_queries"),
    )
