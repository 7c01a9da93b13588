"""The dated runs a site goes through, from search facts to rewritten metadata.

Each step reads the newest snapshots of its inputs under ``base``, writes its own
and returns a small summary. Steps only share tables, so they can run in
separate jobs, and every one can be repeated for the same date.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from serplens import params, schemas
from serplens.operators import audit, crawl, extract, facts, narrow, ranking, update
from serplens.params import Site
from serplens.sources import buckets, days, landing, snapshots
from serplens.sources.storage import materialize


def fetch_landed(site: Site, base: str, landed: DataFrame, as_of: date, run_date: date) -> dict:
    """Reports from landed responses (run_date, rows) of the site's date range before ``as_of``."""
    window = landing.date_window(site.date_range, as_of)
    rows = landing.flatten_responses(landing.in_window(landed, window), ["query", "page"])
    return _fetch_sums(site, base, window, facts.sum_facts(rows, ["query", "page"]), run_date)


def fetch_days(spark: SparkSession, site: Site, base: str, landed: str, as_of: date, run_date: date) -> dict:
    """As ``fetch_landed``, from a folder by day of which only days that changed since the last run are read."""
    window = landing.date_window(site.date_range, as_of)
    changed = days.refresh(spark, landed, base, window)
    sums = facts.sum_facts(days.read_sums(spark, base, window), ["query", "page"])
    return {"days_read": changed} | _fetch_sums(site, base, window, sums, run_date)


def _fetch_sums(site: Site, base: str, window: tuple[date, date], sums: DataFrame, run_date: date) -> dict:
    # Both grains from one pass: the finer sums are written, the coarser are taken from
    # them, and both are counted as they are written.
    fine, coarse = Observation(), Observation()
    sums = materialize(sums.observe(fine, F.count(F.lit(1)).alias("n")), "landed_sums")
    page = materialize(facts.roll_up(sums, ["page"]).observe(coarse, F.count(F.lit(1)).alias("n")), "landed_pages")
    counts = {"query_page_rows": fine.get["n"], "page_rows": coarse.get["n"]}
    window_of = {"site": site.site_url, "first_day": window[0], "last_day": window[1]}
    return window_of | counts | fetch(site, base, facts.as_metrics(sums), page, run_date)


def _write_ranked(df: DataFrame, order: list[Column], site: Site, base: str, table: str, run_date: date) -> int:
    """Write a report with its order as a column, for files have none of their own."""
    ranked = ranking.with_global_rank(df, order, "report_rank")
    return snapshots.write_snapshot(ranked, base, table, site.filter_tag, run_date)


def fetch(site: Site, base: str, query_page: DataFrame, page: DataFrame, run_date: date) -> dict:
    """Zero-click and ranking reports from search facts of both grains; ``page`` is read several times."""
    def write(df: DataFrame, order: list[Column], table: str) -> int:
        return _write_ranked(df, order, site, base, table, run_date)

    return {
        "filter": site.filter_tag,
        "zero_click_rows": write(facts.zero_click_rows(query_page, site), facts.zero_click_order(), "zero_click"),
        "ranking_rows": write(facts.ranking_rows(page, site), facts.ranking_order(), "ranking"),
    }


def rank(spark: SparkSession, site: Site, base: str) -> dict:
    """Priority ranking from the newest reports, which have to be of one date."""
    tag = site.filter_tag
    run_date = snapshots.common_run(spark, base, ["zero_click", "ranking"], tag)
    zero = snapshots.read_snapshot(spark, base, "zero_click", tag, run_date, schemas.ZERO_CLICK)
    pages = snapshots.read_snapshot(spark, base, "ranking", tag, run_date, schemas.RANKING)
    rows = snapshots.write_snapshot(
        ranking.priority_ranking(pages, zero, site), base, "priority_ranked", tag, run_date
    )
    ranked = snapshots.read_snapshot(
        spark, base, "priority_ranked", tag, run_date, schemas.PRIORITY_RANKED
    )
    summary = ranking.ranking_summary(pages, ranked).first().asDict()
    # One row per content type and per language.
    summary["types"] = [r.asDict() for r in ranking.by_type(ranked).collect()]
    summary["languages"] = [r.asDict() for r in ranking.by_language(ranked).collect()]
    return summary | {"run_date": run_date, "rows": rows}


def _ranked(spark: SparkSession, site: Site, base: str) -> tuple[date, DataFrame]:
    run_date = snapshots.latest_run(spark, base, "priority_ranked", site.filter_tag)
    return run_date, snapshots.read_snapshot(
        spark, base, "priority_ranked", site.filter_tag, run_date, schemas.PRIORITY_RANKED
    )


def crawl_pages(site: Site, base: str, raw_pages: DataFrame, fetched: str | None = None) -> dict:
    """Metadata of the ranked pages out of landed HTML, and the crawl report.

    Only pages whose path is ranked are parsed. ``fetched`` names the column that orders
    repeated fetches of a path; without it, a successful one counts. The summary lists
    the first pages without a title and without a description, and how many there are.
    """
    spark = raw_pages.sparkSession
    run_date, ranked = _ranked(spark, site, base)
    parsed = extract.extract_metadata(narrow.maybe_in(raw_pages, ranked, "path"))
    # Ranked for certain, on rows without HTML.
    pages = materialize(crawl.in_priority_order(extract.latest_per_path(parsed, fetched), ranked), "ranked_pages")
    tag = site.filter_tag
    snapshots.write_snapshot(pages.select(*schemas.PAGE_META.names), base, "page_meta", tag, run_date)
    _write_ranked(crawl.crawl_rows(pages, site.base_url), [F.asc("priority_rank"), F.asc("path")],
                  site, base, "crawl_report", run_date)
    # Ten rows per kind.
    missing = crawl.missing_samples(pages).collect()
    samples = {}
    for kind in ("title", "meta_description"):
        rows = sorted((r for r in missing if r["field"] == kind), key=lambda r: (r["priority_rank"], r["path"]))
        samples[f"without_{kind}"] = [r["path"] for r in rows]
        samples[f"without_{kind}_total"] = rows[0]["missing_total"] if rows else 0
    return crawl.coverage(pages).first().asDict() | samples


def _inputs(spark: SparkSession, site: Site, base: str) -> tuple[date, DataFrame, DataFrame, DataFrame]:
    """Date and rows of the newest metadata, and the newest zero-click rows and ranking.

    An audit needs metadata only: without query data its rules on queries find nothing.
    """
    tag = site.filter_tag

    def newest(table: str, schema) -> tuple[date, DataFrame]:
        day = snapshots.latest_run(spark, base, table, tag)
        return day, snapshots.read_snapshot(spark, base, table, tag, day, schema)

    def optional(table: str, schema) -> DataFrame:
        try:
            return newest(table, schema)[1]
        except FileNotFoundError:
            return spark.createDataFrame([], schema)

    run_date, meta = newest("page_meta", schemas.PAGE_META)
    return run_date, meta, optional("zero_click", schemas.ZERO_CLICK), optional("priority_ranked", schemas.PRIORITY_RANKED)


def _audited(site: Site, meta: DataFrame, zero: DataFrame, ranked: DataFrame) -> DataFrame:
    return audit.audit_pages(audit.with_context(meta, zero, ranked), site)


def audit_metadata(spark: SparkSession, site: Site, base: str) -> dict:
    """Audit report and summary of the newest metadata."""
    run_date, meta, zero, ranked = _inputs(spark, site, base)
    audited = materialize(_audited(site, meta, zero, ranked), "audited")
    tag = site.filter_tag
    placed = ranking.with_global_rank(audited, audit.audit_order(), "report_rank")
    snapshots.write_snapshot(audit.audit_rows(placed, "report_rank"), base, "audit_report", tag, run_date)
    snapshots.write_snapshot(audit.audit_summary(audited), base, "audit_summary", tag, run_date)
    snapshots.write_snapshot(audit.issue_breakdown(audited), base, "issue_breakdown", tag, run_date)
    summary = audit.audit_summary(audited).first().asDict()
    # One row per kind of issue.
    summary["issue_breakdown"] = {
        r["issue"]: r["occurrences"] for r in audit.issue_breakdown(audited).collect()
    }
    return summary


def _targets(ranked: DataFrame, meta: DataFrame, selection: str | int,
             batch_size: int = params.REWRITE_BATCH_SIZE) -> tuple[DataFrame, DataFrame]:
    """The selected pages, and the usable metadata of these alone."""
    targets = materialize(update.rewrite_targets(ranked, selection, batch_size), "targets")
    usable = meta.where(F.col("error").isNull()).join(targets.select("path"), "path", "left_semi")
    return targets, usable


def prepare_rewrite(spark: SparkSession, site: Site, base: str, selection: str | int = 30,
                    batch_size: int = params.REWRITE_BATCH_SIZE) -> tuple[DataFrame, DataFrame]:
    """Rewrite contexts of the selected pages, and the targets without metadata; only these pages are audited."""
    _, meta, zero, ranked = _inputs(spark, site, base)
    targets, usable = _targets(ranked, meta, selection, batch_size)
    context = update.rewrite_context(targets, usable, zero, _audited(site, usable, zero, targets))
    return context, update.skipped_targets(targets, usable)


def write_batches(context: DataFrame, path: str) -> None:
    """Contexts as JSON rows, one folder per batch for the rewriters to share out."""
    context.hint("rebalance", "batch_id").write.mode("overwrite").partitionBy("batch_id").json(path)


def finish_rewrite(site: Site, base: str, rewritten: DataFrame, selection: str | int = 30) -> dict:
    """Post-process rewritten texts and merge them into the optimised metadata.

    Of the optimised metadata, a table merged run by run, only the buckets of the
    rewritten pages are read and written.
    """
    spark = rewritten.sparkSession
    tag = site.filter_tag
    run_date, meta, zero, ranked = _inputs(spark, site, base)
    targets, usable = _targets(ranked, meta, selection)
    usable = materialize(usable, "usable")
    # Applying rewrites needs no audit.
    context = update.rewrite_context(targets, usable, zero)
    current = materialize(
        update.apply_rewrites(context, rewritten, site, F.lit(run_date.isoformat())), "updated"
    )
    originals = update.backup_originals(usable, current)
    snapshots.write_snapshot(originals, base, "original_metadata", tag, run_date)
    total = buckets.merge_rows(current, base, "optimized_metadata", tag, "path")
    stats = update.update_statistics(
        _audited(site, originals, zero, targets), _audited(site, current, zero, targets),
        update.skipped_targets(targets, usable)
    )
    return stats.first().asDict() | {"total": total}
