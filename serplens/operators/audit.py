"""Rule-based audit of page metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from serplens import params
from serplens.functions import jsonld, text
from serplens.functions.numbers import percent_of, round_exact
from serplens.operators.facts import top_queries
from serplens.params import Site


def coverage_queries(zero_click: DataFrame, k: int = params.COVERAGE_TOP_K) -> DataFrame:
    """The ``k`` top query texts of each path, best first."""
    entry = F.struct("query_rank", "query")
    return top_queries(zero_click, "path", k).groupBy("path").agg(
        F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["query"]).alias("queries")
    )


def with_context(pages: DataFrame, zero_click: DataFrame, ranked: DataFrame) -> DataFrame:
    """Pages with their top queries and their rank, both optional."""
    return (
        pages.join(coverage_queries(zero_click), "path", "left")
        .join(ranked.select("path", "priority_rank"), "path", "left")
        .withColumn("queries", F.coalesce("queries", F.array().cast("array<string>")))
    )


def rule_columns(site: Site, *names: str) -> dict[str, Column]:
    """Outcome of the named rules, or of all, for a page with ``queries``."""
    path, title, desc = F.col("path"), F.col("title"), F.col("meta_description")
    rules = {
        "title_length": lambda: text.n_chars(title),
        "title_too_long": lambda: text.too_long(title, site.max_title_length),
        "desc_length": lambda: text.n_chars(desc),
        "desc_too_long": lambda: text.too_long(desc, site.max_description_length),
        "generic_opener": lambda: text.generic_opener(desc, site.generic_openers),
        "language_mismatch": lambda: text.language_mismatch(path, title, desc),
        "missing_keywords": lambda: text.uncovered_queries(
            title, desc, F.col("meta_keywords"), F.col("queries")
        ),
        "schema_issues": lambda: jsonld.completeness_issues(path, F.col("schema_json_ld")),
    }
    return {name: rules[name]() for name in names or rules}


def _flag(condition: Column, label: str) -> Column:
    return F.when(condition, F.lit(label))


def issue_list() -> Column:
    """Labels of all broken rules in rule order, structured-data ones per occurrence."""
    fixed = F.array_compact(F.array(
        _flag(F.col("desc_too_long"), "desc_too_long"),
        _flag(F.col("title_too_long"), "title_too_long"),
        _flag(F.col("generic_opener").isNotNull(), "generic_opening"),
        _flag(F.col("language_mismatch"), "language_mismatch"),
        _flag(F.size("missing_keywords") > 0, "missing_keywords"),
    ))
    return F.concat(fixed, F.transform("schema_issues", lambda i: F.concat(F.lit("schema:"), i)))


def audit_pages(pages: DataFrame, site: Site) -> DataFrame:
    """Pages with every rule's outcome and the list of issues.

    Expects ``queries`` on each row; see :func:`with_context`.
    """
    return pages.withColumns(rule_columns(site)).withColumn("issues", issue_list())


def audit_rows(audited: DataFrame, *more: str) -> DataFrame:
    """The columns of the audit report and ``more``, unordered."""
    return audited.select(
        *more,
        F.coalesce("priority_rank", F.lit(params.UNRANKED)).cast("long").alias("priority_rank"),
        "path",
        F.size("issues").cast("long").alias("issues_count"),
        F.array_join("issues", ", ").alias("issues"),
        "title_length",
        F.when(F.col("title_too_long"), "too_long").otherwise("ok").alias("title_issue"),
        text.or_empty(F.col("title")).alias("original_title"),
        "desc_length",
        F.when(F.col("desc_too_long"), "too_long").otherwise("ok").alias("desc_issue"),
        text.or_empty(F.col("meta_description")).alias("original_description"),
        text.or_empty(F.col("generic_opener")).alias("generic_opener"),
        F.when(F.col("language_mismatch"), "yes").otherwise("").alias("language_mismatch"),
        F.array_join("missing_keywords", " | ").alias("missing_keywords"),
        F.array_join("schema_issues", " | ").alias("schema_issues"),
    )


def audit_report(audited: DataFrame) -> DataFrame:
    """Audit rows by rank; unranked pages come last, also behind rank 999."""
    return audit_rows(audited.orderBy(*audit_order()))


def audit_order() -> list[Column]:
    return [F.asc_nulls_last("priority_rank"), F.asc("path")]


def issue_breakdown(audited: DataFrame) -> DataFrame:
    """Occurrences of each issue and their number per hundred pages, most frequent first."""
    pages = audited.agg(F.count(F.lit(1)).alias("n")).scalar()
    return (
        audited.select(F.explode("issues").alias("issue"))
        .groupBy("issue").agg(F.count(F.lit(1)).alias("occurrences"))
        .withColumn("share_pct", round_exact(percent_of(F.col("occurrences"), pages), 1))
        .orderBy(F.desc("occurrences"), "issue")
    )


def audit_summary(audited: DataFrame) -> DataFrame:
    """Page counts and length statistics in one row and one pass."""
    def lengths(prefix: str) -> list[Column]:
        return [
            F.count_if(f"{prefix}_too_long").alias(f"{prefix}_too_long_count"),
            F.coalesce(F.max(f"{prefix}_length"), F.lit(0)).alias(f"{prefix}_max_length"),
            F.coalesce(F.sum(f"{prefix}_length"), F.lit(0)).alias(f"{prefix}_total_length"),
        ]

    totals = audited.agg(
        F.count(F.lit(1)).alias("total_pages"),
        F.count_if(F.size("issues") > 0).alias("pages_with_issues"),
        *lengths("desc"), *lengths("title"),
    )
    total = F.col("total_pages")
    out = [total, F.col("pages_with_issues"), (total - F.col("pages_with_issues")).alias("pages_clean"),
           round_exact(percent_of(F.col("pages_with_issues"), total), 1).alias("pages_with_issues_pct")]
    for prefix in ("desc", "title"):
        count, chars = F.col(f"{prefix}_too_long_count"), F.col(f"{prefix}_total_length")
        out += [
            count,
            round_exact(percent_of(count, total), 1).alias(f"{prefix}_too_long_pct"),
            F.col(f"{prefix}_max_length"),
            round_exact(F.coalesce(F.try_divide(chars, total), F.lit(0.0)), 1).alias(f"{prefix}_avg_length"),
            chars,
        ]
    return totals.select(*out)
