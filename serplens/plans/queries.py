"""One registered query per operation, over the driver's whole tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import timedelta
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from serplens import params, schemas
from serplens.functions import jsonld
from serplens.operators import audit, crawl, extract, facts, ranking, update
from serplens.plans import derived as d
from serplens.plans import steps
from serplens.sources import buckets, days, landing, reports, snapshots
from serplens.sources.storage import discard_at_exit, materialize, scratch_path

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

#: The last pattern refers back to its own group.
FILTERED_SITE = replace(
    d.SITE, page_filter="/GLOSSARY/", exclude_patterns=("(k)eyword/3", r"blog\.", r"d/(\d)\1"))
RANGE, BATCH = (6, 15), 4
TOP_PAGES = 5
NEW_DATE = "2024-02-01"


def query(run: Query) -> Query:
    REGISTRY[run.__name__] = run
    return run


def _joined(values: Column, sep: str = " | ") -> Column:
    return F.coalesce(F.array_join(values, sep), F.lit(""))


# --- search facts ------------------------------------------------------------

@query
def fact_rollup(spark, sf_dir):
    log = landing.in_window(d.search_log(spark, sf_dir), d.WINDOW)
    return facts.roll_up(log, ["query", "page"])


@query
def page_rollup(spark, sf_dir):
    return facts.roll_up(landing.in_window(d.search_log(spark, sf_dir), d.WINDOW), ["page"])


@query
def response_flatten(spark, sf_dir):
    """Landed responses with whole, shortened and absent keys, metrics and rows."""
    log = d.search_log(spark, sf_dir)
    kind = F.col("page_id") % 4
    metrics = [F.col(c).alias(c) for c in ("clicks", "impressions", "ctr", "position")]
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.METRIC_FIELDS]
    whole = F.struct(F.array("query", "page").alias("keys"), *metrics)
    short = F.struct(F.array("query").alias("keys"), none[0], *metrics[1:])
    bare = F.struct(F.lit(None).cast("array<string>").alias("keys"), *metrics[:1], *none[1:])
    rows = F.when(kind == 1, F.array(whole)).when(kind == 2, F.array(short, whole)) \
        .when(kind == 3, F.array(bare, short, whole))
    path = scratch_path(spark, "responses")
    log.select(rows.alias("rows")).write.json(path)
    discard_at_exit(spark, path)
    return landing.flatten_responses(landing.read_responses(spark, path), ["query", "page"])


@query
def snapshot_latest(spark, sf_dir):
    """The newest day within one filter tag of a partitioned table."""
    page_id = F.col("page_id")
    tags = F.when(page_id % 3 == 0, params.filter_tag(None)) \
        .when(page_id % 3 == 1, params.filter_tag("/blog/posts/")).otherwise(params.filter_tag("wiki"))
    log = d.search_log(spark, sf_dir).withColumn("filter_tag", tags) \
        .where((F.col("filter_tag") != "blog_posts") | (F.col("run_date") <= F.lit(d.WINDOW[1])))
    path = scratch_path(spark, "snapshots")
    log.hint("rebalance", "filter_tag", "run_date") \
        .write.partitionBy("filter_tag", "run_date").parquet(path)
    discard_at_exit(spark, path)
    latest = snapshots.latest_snapshot(
        spark.read.schema(log.schema).parquet(path), params.filter_tag("/blog/posts/")
    )
    return facts.roll_up(latest, ["filter_tag", "run_date", "page"])


@query
def snapshot_mismatch(spark, sf_dir):
    """Whether two tables have their newest run on one day; the second depends on the number of pages."""
    base = scratch_path(spark, "runs")
    pages = d.table(spark, sf_dir, "pages").select("page_id")
    other = d.RUN_DATE + timedelta(days=pages.count() % 2)
    rows = snapshots.write_snapshot(pages, base, "one", "all", d.RUN_DATE)
    snapshots.write_snapshot(pages, base, "two", "all", other)
    discard_at_exit(spark, base)
    try:
        same = snapshots.common_run(spark, base, ["one", "two"], "all") == d.RUN_DATE
    except snapshots.SnapshotMismatch:
        same = False
    return pages.agg(F.lit(same).alias("same_run"), F.lit(rows).cast("long").alias("pages"))


@query
def table_roundtrip(spark, sf_dir):
    """The ranking report as a dated, tagged partition of a table, read back."""
    path = scratch_path(spark, "ranking")
    report = d.SearchFacts(spark, sf_dir).ranking().withColumns({
        "filter_tag": F.lit(d.SITE.filter_tag), "run_date": F.lit(d.RUN_DATE),
    })
    report.write.partitionBy("filter_tag", "run_date").parquet(path)
    discard_at_exit(spark, path)
    return snapshots.latest_snapshot(spark.read.schema(report.schema).parquet(path), d.SITE.filter_tag)


@query
def csv_roundtrip(spark, sf_dir):
    """The zero-click report as CSV under its published headers, read back."""
    path = scratch_path(spark, "zero_click_csv")
    report = facts.zero_click_report(d.SearchFacts(spark, sf_dir).query_page, d.SITE)
    reports.write_csv(reports.with_report_headers(report), path)
    discard_at_exit(spark, path)
    back = reports.read_csv(spark, path, reports.without_report_headers(schemas.ZERO_CLICK))
    return back.toDF(*schemas.ZERO_CLICK.names)


@query
def csv_quoted_breaks(spark, sf_dir):
    """Page texts as another tool's CSV, line breaks inside quotes, read back by many tasks."""
    path = scratch_path(spark, "page_texts_csv")
    texts = [F.coalesce(c, F.lit("")).alias(c) for c in ("title", "meta_description")]
    meta = d.page_meta(spark, sf_dir).select("path", *texts) \
        .withColumn("both", F.concat_ws("\n", "title", F.lit('"'), "meta_description"))
    meta.write.options(
        header=True, quoteAll=True, escape='"', emptyValue="",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    discard_at_exit(spark, path)
    return reports.read_csv(spark, path, meta.schema, multi_line=True, escaped=False)


@query
def keyed_json_minified(spark, sf_dir):
    """Page metadata as objects keyed by path on one line each, some 1,024 pages an object, read back by brackets."""
    path = scratch_path(spark, "page_meta_minified")
    meta = materialize(d.page_meta(spark, sf_dir).select(*schemas.PAGE_META.names), "page_meta")
    entry = F.struct("path", F.struct(*[c for c in meta.columns if c != "path"]))
    objects = meta.groupBy(F.pmod(F.crc32("path"), F.lit(1 + meta.count() // 1024)).alias("part")) \
        .agg(F.map_from_entries(F.collect_list(entry)).alias("pages"))
    # A file holds one object, so every object has a folder of its own.
    objects.select("part", F.to_json("pages").alias("line")).write.partitionBy("part").text(path)
    discard_at_exit(spark, path)
    return _flat_meta(reports.import_keyed_json(
        spark, path, T.StructType([f for f in schemas.PAGE_META.fields if f.name != "path"]), indented=False))


@query
def keyed_json_import(spark, sf_dir):
    """Page metadata as one object keyed by path, indented by two, read back entry by entry."""
    path = scratch_path(spark, "page_meta_keyed")
    meta = materialize(d.page_meta(spark, sf_dir).select(*schemas.PAGE_META.names), "page_meta")
    fields = [c for c in meta.columns if c != "path"]

    def json(column: str) -> Column:
        """A value as JSON: what stands between ``{"v":`` and ``}``."""
        text = F.to_json(F.struct(F.col(column).alias("v")))
        return F.when(F.col(column).isNull(), "null").otherwise(F.substr(text, F.lit(6), F.length(text) - 6))

    values = [F.concat(F.lit(f'    "{c}": '), json(c)) for c in fields]
    entry = F.concat(F.lit("  "), json("path"), F.lit(": {\n"), F.concat_ws(",\n", *values), F.lit("\n  }"))
    first, last = meta.agg(F.min("path"), F.max("path")).first()
    line = F.concat(F.when(F.col("path") == first, "{\n").otherwise(""), entry,
                    F.when(F.col("path") == last, "\n}").otherwise(","))
    # One object in part files, in order of paths: the first opens it, the last closes it.
    meta.repartitionByRange("path").sortWithinPartitions("path").select(line.alias("line")).write.text(path)
    discard_at_exit(spark, path)
    return _flat_meta(reports.import_keyed_json(
        spark, path, T.StructType([f for f in schemas.PAGE_META.fields if f.name != "path"])))


@query
def json_roundtrip(spark, sf_dir):
    """Page metadata as one JSON row per path, read back."""
    path = scratch_path(spark, "page_meta_json")
    meta = d.page_meta(spark, sf_dir).select(*schemas.PAGE_META.names)
    reports.write_rows(meta, path)
    discard_at_exit(spark, path)
    return _flat_meta(reports.read_rows(spark, path, schemas.PAGE_META))


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.roll_up(d.search_log(spark, sf_dir), ["page"])


@query
def page_labels(spark, sf_dir):
    return facts.label_pages(_pages(spark, sf_dir), d.SITE)


@query
def page_filter(spark, sf_dir):
    labelled = facts.label_pages(_pages(spark, sf_dir), FILTERED_SITE)
    kept = facts.filter_pages(labelled, FILTERED_SITE.page_filter, FILTERED_SITE.exclude_patterns)
    return kept.select("path", "page", "impressions")


@query
def page_totals(spark, sf_dir):
    return facts.page_totals(facts.roll_up(d.search_log(spark, sf_dir), ["query", "page"]))


@query
def zero_click_report(spark, sf_dir):
    return facts.zero_click_report(d.SearchFacts(spark, sf_dir).query_page, d.SITE)


@query
def zero_click_filtered(spark, sf_dir):
    return facts.zero_click_report(d.SearchFacts(spark, sf_dir).query_page, FILTERED_SITE)


@query
def page_segments(spark, sf_dir):
    return facts.ranking_report(d.SearchFacts(spark, sf_dir).page, d.SITE)


@query
def zero_click_order(spark, sf_dir):
    """The place of every row in the zero-click report, kept as a column."""
    rows = facts.zero_click_rows(d.SearchFacts(spark, sf_dir).query_page, d.SITE)
    return ranking.with_global_rank(rows, facts.zero_click_order(), "report_rank").select("report_rank", "path", "query")


@query
def ranking_order(spark, sf_dir):
    rows = d.SearchFacts(spark, sf_dir).ranking()
    return ranking.with_global_rank(rows, facts.ranking_order(), "report_rank").select("report_rank", "path")


@query
def landed_fetch(spark, sf_dir):
    """The zero-click report of a run that starts from landed responses."""
    keys = F.array("query", "page").alias("keys")
    metrics = [F.col(c) for c in ("clicks", "impressions", "ctr", "position")]
    log = d.search_log(spark, sf_dir).select("run_date", F.array(F.struct(keys, *metrics)).alias("rows"))
    path, base = scratch_path(spark, "landed"), scratch_path(spark, "run")
    log.write.json(path)
    landed = spark.read.schema(T.StructType([T.StructField("run_date", T.DateType()), *schemas.RESPONSE.fields])).json(path)
    steps.fetch_landed(d.SITE, base, landed, d.AS_OF, d.RUN_DATE)
    for folder in (path, base):
        discard_at_exit(spark, folder)
    return snapshots.read_snapshot(spark, base, "zero_click", d.SITE.filter_tag, d.RUN_DATE, schemas.ZERO_CLICK)


def _land_days(spark: SparkSession, sf_dir: str) -> tuple[str, str, Callable[[], None]]:
    """Folders of landed days without their late rows and of a site's runs, and what lands those rows."""
    entry = F.struct(F.array("query", "page").alias("keys"), "clicks", "impressions", "ctr", "position")
    log = d.search_log(spark, sf_dir).select(
        "run_date", F.array(entry).alias("rows"), (F.pmod(F.dayofyear("run_date"), F.lit(5)) == 0).alias("has_late"))
    log = materialize(log.withColumn("late", F.col("has_late") & (F.pmod(F.crc32(F.col("rows")[0]["keys"][1]), F.lit(3)) == 0)), "log")
    landed, base = scratch_path(spark, "landed_days"), scratch_path(spark, "run")
    for folder in (landed, base):
        discard_at_exit(spark, folder)

    def land(late: bool) -> None:
        log.where(F.col("late") == late).select("run_date", "rows") \
            .write.mode("append").partitionBy("run_date").json(landed)

    land(False)
    return landed, base, lambda: land(True)


@query
def incremental_fetch(spark, sf_dir):
    """The zero-click report of a second run, which reads only the days that got late rows."""
    landed, base, land_late = _land_days(spark, sf_dir)
    steps.fetch_days(spark, d.SITE, base, landed, d.AS_OF, d.RUN_DATE - timedelta(days=1))
    land_late()
    steps.fetch_days(spark, d.SITE, base, landed, d.AS_OF, d.RUN_DATE)
    return snapshots.read_snapshot(spark, base, "zero_click", d.SITE.filter_tag, d.RUN_DATE, schemas.ZERO_CLICK)


@query
def pages_with_queries(spark, sf_dir):
    """Pages with at least 20 queries in the window, from stored sketches and counts near the threshold."""
    landed, base, land_late = _land_days(spark, sf_dir)
    land_late()
    window = landing.date_window(d.SITE.date_range, d.AS_OF)
    days.refresh(spark, landed, base, window)
    return days.pages_with_queries(spark, base, window, 20)


@query
def fetch_summary(spark, sf_dir):
    """Rows in and out of the fetch run, in one row."""
    def rows(df: DataFrame) -> Column:
        return df.agg(F.count(F.lit(1)).alias("n")).scalar()

    search = d.SearchFacts(spark, sf_dir)
    return search.page.agg(F.count(F.lit(1)).alias("page_rows")).select(
        rows(search.query_page).alias("query_page_rows"),
        "page_rows",
        rows(search.zero_click()).alias("zero_click_rows"),
        rows(search.ranking()).alias("ranking_rows"),
        F.lit(d.SITE.filter_tag).alias("filter_tag"),
    )


# --- ranking -----------------------------------------------------------------

@query
def path_queries(spark, sf_dir):
    search = d.SearchFacts(spark, sf_dir)
    merged = ranking.attach_queries(search.ranking(), ranking.path_queries(search.landed_zero_click()))
    return merged.select("path", "query_count", F.posexplode_outer("top_queries").alias("nth", "q")) \
        .select("path", "query_count", (F.col("nth") + 1).cast("long").alias("nth"),
                "q.query", "q.impressions", "q.position")


@query
def priority_ranking(spark, sf_dir):
    return d.ranked(spark, sf_dir).orderBy("priority_rank")


@query
def rank_range(spark, sf_dir):
    return ranking.rank_range(d.ranked(spark, sf_dir), *RANGE, BATCH) \
        .select("priority_rank", "path", "batch_id")


@query
def top_pages(spark, sf_dir):
    return ranking.top_pages(_scored(spark, sf_dir), TOP_PAGES) \
        .select("priority_rank", "path", "priority_score")


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    search = d.SearchFacts(spark, sf_dir)
    return search.scored(search.zero_click())


@query
def ranking_by_type(spark, sf_dir):
    return ranking.by_type(_scored(spark, sf_dir))


@query
def ranking_by_language(spark, sf_dir):
    return ranking.by_language(_scored(spark, sf_dir))


@query
def ranking_summary(spark, sf_dir):
    search = d.SearchFacts(spark, sf_dir)
    return ranking.ranking_summary(search.ranking(), search.scored(search.zero_click()))


# --- extraction --------------------------------------------------------------

@query
def page_metadata(spark, sf_dir):
    """Title and headings of every landed page as it is."""
    pages = d.landed_pages(spark, sf_dir).select(
        "page_id", "html", F.lit(200).alias("status"), F.lit(None).cast("string").alias("error"),
    )
    return extract.extract_metadata(pages).select("page_id", "title", _joined(F.col("h1")).alias("h1"))


def _flat_meta(meta: DataFrame) -> DataFrame:
    """Every value of the metadata, lists as text."""
    links = F.transform("alternates", lambda a: F.concat_ws("@", a["href"], a["hreflang"]))
    plain = [f.name for f in schemas.META_VALUES.fields if f.dataType.simpleString() == "string" and f.name != "error"]
    return meta.select(
        "path", *plain,
        F.array_join(links, " ").alias("alternates"),
        F.when(F.col("schema_json_ld").isNotNull(), F.size("schema_json_ld")).cast("long").alias("blocks"),
        F.array_join("schema_json_ld", " ; ").alias("schema_text"),
        F.array_join("h1", " | ").alias("h1"),
        "error",
    )


@query
def page_metadata_full(spark, sf_dir):
    return _flat_meta(d.page_meta(spark, sf_dir))


@query
def crawl_report(spark, sf_dir):
    search = d.SearchFacts(spark, sf_dir)
    ranked = materialize(search.ranked(search.zero_click()), "ranked")
    return crawl.crawl_report(d.page_meta(spark, sf_dir, ranked), ranked, d.SITE.base_url)


@query
def metadata_coverage(spark, sf_dir):
    return crawl.coverage(d.page_meta(spark, sf_dir))


@query
def missing_samples(spark, sf_dir):
    search = d.SearchFacts(spark, sf_dir)
    meta = d.page_meta(spark, sf_dir).select("path", "title", "meta_description")
    ranked = search.ranked(search.zero_click()).select("path", "priority_rank")
    pages = materialize(meta.join(ranked, "path", "left"), "ranked_meta")
    return crawl.missing_samples(pages)


# --- audit -------------------------------------------------------------------

def _ruled(spark: SparkSession, sf_dir: str, *rules: str) -> DataFrame:
    """Pages with the named rules only."""
    columns = audit.rule_columns(d.SITE, *rules)
    return d.page_meta(spark, sf_dir).select("path", *(c.alias(name) for name, c in columns.items()))


def _with_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with their top queries."""
    search = d.SearchFacts(spark, sf_dir)
    queries = audit.coverage_queries(search.zero_click())
    return d.page_meta(spark, sf_dir).join(queries, "path", "left")


@query
def audit_lengths(spark, sf_dir):
    return _ruled(spark, sf_dir, "title_length", "title_too_long", "desc_length", "desc_too_long")


@query
def audit_generic_opening(spark, sf_dir):
    return _ruled(spark, sf_dir, "generic_opener")


@query
def audit_language(spark, sf_dir):
    return _ruled(spark, sf_dir, "language_mismatch")


@query
def audit_keyword_coverage(spark, sf_dir):
    pages = _with_queries(spark, sf_dir)
    missing = audit.rule_columns(d.SITE, "missing_keywords")["missing_keywords"]
    return pages.select("path", _joined(missing).alias("missing_keywords"))


@query
def audit_schema(spark, sf_dir):
    issues = _ruled(spark, sf_dir, "schema_issues")
    return issues.select("path", _joined(F.col("schema_issues")).alias("schema_issues"))


@query
def audit_report(spark, sf_dir):
    return audit.audit_report(d.audited(spark, sf_dir))


@query
def audit_order(spark, sf_dir):
    """The place of every page in the audit report; only path and rank are sorted."""
    search = d.SearchFacts(spark, sf_dir)
    ranked = search.ranked(search.landed_zero_click()).select("path", "priority_rank")
    rows = d.page_meta(spark, sf_dir).select("path").join(ranked, "path", "left")
    return ranking.with_global_rank(rows, audit.audit_order(), "report_rank").select("report_rank", "path", "priority_rank")


def _audited_unranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit outcome where the rank is of no interest."""
    return audit.audit_pages(_with_queries(spark, sf_dir), d.SITE)


@query
def audit_issue_breakdown(spark, sf_dir):
    return audit.issue_breakdown(_audited_unranked(spark, sf_dir))


@query
def audit_summary(spark, sf_dir):
    return audit.audit_summary(_audited_unranked(spark, sf_dir))


# --- update ------------------------------------------------------------------

class _Rewrite:
    """Inputs of the update queries; the ones read repeatedly are written once.

    Only the targets' pages are parsed and audited.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        search = d.SearchFacts(spark, sf_dir)
        self.zero = search.landed_zero_click()
        ranked = search.ranked(self.zero)
        self.targets = materialize(ranked.withColumn(
            "batch_id", F.floor((F.col("priority_rank") - 1) / params.REWRITE_BATCH_SIZE).cast("long")), "targets")

    def _meta(self, only: DataFrame | None = None) -> DataFrame:
        meta = d.page_meta(self.spark, self.sf_dir, only).where(F.col("error").isNull())
        return meta.select(*schemas.PAGE_META.names)

    @cached_property
    def pages(self) -> DataFrame:
        """Metadata of the targets."""
        return materialize(self._meta(self.targets), "page_meta")

    def all_pages(self) -> DataFrame:
        return self._meta()

    def audited(self, pages: DataFrame) -> DataFrame:
        queries = audit.coverage_queries(self.zero)
        return audit.audit_pages(pages.join(queries, "path", "left"), d.SITE)

    def context(self) -> DataFrame:
        return update.rewrite_context(self.targets, self.pages, self.zero, self.audited(self.pages))

    @cached_property
    def updated(self) -> DataFrame:
        context = update.rewrite_context(self.targets, self.pages, self.zero)
        rewritten = d.rewritten(self.spark, self.sf_dir)
        return materialize(update.apply_rewrites(context, rewritten, d.SITE, F.lit(NEW_DATE)), "updated")


@query
def rewrite_context(spark, sf_dir):
    top = F.transform("top_queries", lambda q: q["query"])
    return _Rewrite(spark, sf_dir).context().select(
        "priority_rank", "batch_id", "path", "seo_page_type", "language", "title", "meta_description",
        _joined(F.col("issues"), ", ").alias("issues"), _joined(top).alias("top_queries"),
    )


@query
def rewrite_skipped(spark, sf_dir):
    run = _Rewrite(spark, sf_dir)
    return update.skipped_targets(run.targets, run.pages).select("priority_rank", "path")


@query
def metadata_update(spark, sf_dir):
    return _Rewrite(spark, sf_dir).updated.select(
        "path", "title", "meta_description", "meta_keywords", "og_title", "og_description", "og_url",
        "og_type", "og_image", "og_site_name", "twitter_card", "twitter_title", "twitter_description",
        "twitter_image", "twitter_site", "canonical",
    )


@query
def schema_enrichment(spark, sf_dir):
    """The Article block of every rewritten page, field by field."""
    updated = _Rewrite(spark, sf_dir).updated
    found = updated.select("path", jsonld.objects(F.col("schema_json_ld")).alias("objects"))
    article = F.get(F.filter("objects", lambda o: jsonld.has_type(o, "Article")), F.lit(0))
    one = found.select("path", F.size("objects").cast("long").alias("blocks"), article.alias("o"))
    o = F.col("o")

    def text(key: str, at: str = "$") -> Column:
        return F.try_variant_get(o[key], at, "string")

    return one.select(
        "path", "blocks", text("headline").alias("headline"), text("description").alias("description"),
        text("datePublished").alias("date_published"), text("dateModified").alias("date_modified"),
        F.array_join(F.coalesce(F.try_variant_get(o["@type"], "$", "array<string>"),
                                F.array(text("@type"))), ",").alias("types"),
        text("isPartOf", "$.name").alias("part_of"),
        text("about", "$.name").alias("about"),
        text("about", "$.inDefinedTermSet").alias("about_set"),
    )


@query
def metadata_merge(spark, sf_dir):
    """A table merged in two runs, all pages and then the rewritten ones, read back."""
    run = _Rewrite(spark, sf_dir)
    base = scratch_path(spark, "merged")
    discard_at_exit(spark, base)
    for rows in (materialize(run.all_pages(), "all_pages"), run.updated):
        buckets.merge_rows(rows, base, "optimized_metadata", d.SITE.filter_tag, "path")
    merged = buckets.read_merged(spark, base, "optimized_metadata", d.SITE.filter_tag, schemas.PAGE_META)
    return merged.select("path", "title", "meta_description", "og_title", "og_type")


@query
def metadata_backup(spark, sf_dir):
    run = _Rewrite(spark, sf_dir)
    return update.backup_originals(run.pages, run.targets).select("path", "title", "meta_description")


@query
def update_stats(spark, sf_dir):
    run = _Rewrite(spark, sf_dir)
    skipped = update.skipped_targets(run.targets, run.pages)
    return update.update_statistics(run.audited(run.pages), run.audited(run.updated), skipped)


@query
def update_acceptance(spark, sf_dir):
    run = _Rewrite(spark, sf_dir)
    return update.acceptance(run.updated, d.SITE, run.zero)
