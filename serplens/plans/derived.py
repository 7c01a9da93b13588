"""Inputs derived from the driver's tables.

Those hold no search facts, so a search log is derived from ``events`` and
``benchmark``, and landed pages from ``pages`` and ``documents``. Every rule is
integer arithmetic or plain text, so that SQL gives the same rows.
"""

from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from serplens.operators import audit, extract, facts, narrow, ranking
from serplens.params import Site
from serplens.sources.storage import materialize

#: Sections of an invented site.
PAGE_TYPES = (
    ("Guides", ("/guides/", "/en/guides/")),
    ("Glossary", ("/en/glossary/", "/glossary/")),
    ("Events", ("/events", "/en/events")),
    ("Press", ("/press/",)),
    ("Labs", ("/labs/", "/en/labs/")),
)
CONTENT = (
    ("keyword", "/keyword/"),
    ("course_article", "/guides/"),
    ("lab", "/labs/"),
)
SITE = Site(
    site_url="https://www.example.com/",
    base_url="https://www.example.com",
    page_type_rules=PAGE_TYPES,
    content_segments=CONTENT,
    brand_suffix=" | Example",
    # No page title exceeds the usual 60 characters, many exceed this.
    max_title_length=40,
)
OTHER_ORIGIN = "https://blog.example.com"
WINDOW = (date(2024, 1, 5), date(2024, 1, 24))
RUN_DATE = date(2024, 2, 1)
#: Day of a fetch whose window of 28 days leaves out the newest events.
AS_OF = date(2024, 1, 27)

#: Path prefix by ``page_id % 11``.
PREFIXES = (
    "/guides/", "/en/guides/", "/en/glossary/keyword/", "/glossary/keyword/",
    "/press/", "/labs/", "/en/labs/", "/notes/", "/events-", "/en/events/", "/shop/",
)
#: Pages whose whole path is special.
SPECIAL_PATHS = {10: "/", 21: "/en", 32: "/en/"}

#: JSON-LD by ``page_id % 8``; the last one is two blocks.
JSON_LD = (
    None,
    '{"@type":"Article","datePublished":"2024-01-01","dateModified":"2024-01-02"}',
    '{"@type":"Article","datePublished":null}',
    '{"@type":["Article","LearningResource"]}',
    '{"@type":"Course"}',
    "{bad",
    '{"@type":"Article","x":1e400}',
    '{"@type":"Course"}</script><script type="application/ld+json">'
    '[{"@type":"Article","datePublished":"2024-01-01"},7]',
)


#: Columns used of the driver's tables.
TABLES = {
    "events": "ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "pages": "page_id bigint, html string",
    "benchmark": "item_id bigint, text string",
    "documents": "doc_id bigint, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def landed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``pages`` table, ready for parsing."""
    return table(spark, sf_dir, "pages")


_PREFIX = "element_at(array(" + ", ".join(f"'{p}'" for p in PREFIXES) + f"), int(page_id % {len(PREFIXES)}) + 1)"
_SPECIAL = " ".join(f"WHEN {i} THEN '{path}'" for i, path in SPECIAL_PATHS.items())

#: SQL over ``page_id``.
PATH = f"CASE page_id {_SPECIAL} ELSE {_PREFIX} || page_id END"
PAGE = f"CASE WHEN page_id % 13 = 0 THEN '{OTHER_ORIGIN}' ELSE '{SITE.origin}' END || {PATH}"


def search_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One impression per event: day, query, page and its metrics."""
    items = table(spark, sf_dir, "benchmark")
    n_pages = table(spark, sf_dir, "pages").count()
    n_items = items.count()
    log = table(spark, sf_dir, "events").selectExpr(
        "date(ts) AS run_date", "user_id", "event_type", "value",
        """try_cast(regexp_extract(props, '"k": *([0-9]+)', 1) AS bigint) AS k""",
    ).selectExpr(
        "run_date", "value",
        f"(user_id * 7 + k) % {n_pages} AS page_id",
        f"k % {n_items} AS item_id",
        "bigint(event_type = 'click' AND k % 5 = 0) AS clicks",
    )
    queries = items.selectExpr("item_id", "lower(text) AS query")
    return log.join(queries, "item_id").selectExpr(
        "run_date", "page_id", "query", f"{PAGE} AS page", "clicks",
        "bigint(1) AS impressions", "double(clicks) AS ctr",
        "double((page_id % 30) * 2 + floor(value) % 4) AS position",
    )


class SearchFacts:
    """Search facts of both grains from one pass over the log.

    The log is summed by query and page and written; everything else reads that.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        log = search_log(spark, sf_dir)
        self._sums = materialize(facts.sum_facts(log, ["query", "page"]), "search_sums")
        self.query_page = facts.as_metrics(self._sums)

    @cached_property
    def page(self) -> DataFrame:
        """Page grain; written too, for the median and the ranking both read it."""
        return materialize(facts.roll_up(self._sums, ["page"]), "search_pages")

    def zero_click(self) -> DataFrame:
        """Zero-click rows for a single reader."""
        return facts.zero_click_rows(self.query_page, SITE).drop("page")

    def landed_zero_click(self) -> DataFrame:
        """The zero-click table as later steps see it: written once, read by several."""
        return materialize(self.zero_click(), "zero_click")

    def ranking(self) -> DataFrame:
        return facts.ranking_rows(self.page, SITE)

    def scored(self, zero: DataFrame) -> DataFrame:
        counted = ranking.attach_counts(self.ranking(), ranking.query_counts(zero))
        return ranking.score_pages(counted, SITE)

    def ranked(self, zero: DataFrame) -> DataFrame:
        return ranking.priority_ranking(self.ranking(), zero, SITE)


def ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    search = SearchFacts(spark, sf_dir)
    return search.ranked(search.zero_click())


def fetch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed pages as they are: some not found, some failed, some fetched twice.

    A page that was not found at first and has an even id is there the second time.
    """
    return landed_pages(spark, sf_dir).selectExpr(
        "page_id", "html",
        "explode(CASE WHEN page_id % 34 = 0 THEN array(0, 1) ELSE array(0) END) AS attempt",
    ).selectExpr(
        "*",
        """CASE WHEN attempt = 1 THEN 200 WHEN page_id % 17 = 0 THEN 404
           WHEN page_id % 19 = 0 THEN 0 ELSE 200 END AS status""",
    ).selectExpr(
        "page_id", f"{PATH} AS path", "status", "html",
        "(page_id % 100) / 8 + attempt AS elapsed_s",
        "CASE WHEN status = 0 THEN 'timeout on ' || page_id END AS error",
        "timestamp_seconds(1704067200 + page_id * 60 + attempt * 3600) AS fetched_at",
    )


def _tag(before: str, value: str, after: str) -> str:
    """SQL of a tag around a text that is escaped as an HTML attribute."""
    escaped = f"replace(replace(replace({value}, '&', '&amp;'), '\"', '&quot;'), '<', '&lt;')"
    return f"'{before}' || {escaped} || '{after}'"


def _tag_if(condition: str, before: str, value: str, after: str = '">') -> str:
    return f"CASE WHEN {condition} THEN {_tag(before, value, after)} END"


#: Description and keywords of a page, from its own text without marks of its mark-up.
OWN_TEXT = "replace(replace(replace(regexp_replace(html, '<[^>]*>', ' '), '&', ' '), '<', ' '), '>', ' ')"
_DESCRIPTION = f"""CASE WHEN page_id % 7 = 0 THEN 'Explore ' ELSE '' END
  || repeat('page ' || page_id || ' ', int(1 + page_id % 20)) || {OWN_TEXT}"""
_URL = f"'{SITE.base_url}' || path"
_BLOCK = "element_at(array(" + ", ".join(
    "NULL" if b is None else f"'{b}'" for b in JSON_LD) + f"), int(page_id % {len(JSON_LD)}) + 1)"
#: Tags that carry their own name and the page's number, each left out on some pages.
NUMBERED = {
    "robots": ("name", 4), "author": ("name", 5), "og:description": ("property", 3), "og:url": ("property", 4),
    "og:type": ("property", 6), "og:image": ("property", 5), "og:site_name": ("property", 2),
    "og:image:width": ("property", 7), "og:image:height": ("property", 8), "twitter:title": ("name", 3),
    "twitter:description": ("name", 4), "twitter:image": ("name", 5), "twitter:site": ("name", 2),
}

#: SQL of the tags written into a page's head; NULL leaves a tag out.
TAGS = (
    _tag('<meta name="description" content="', _DESCRIPTION, '">'),
    "'<meta name=\"description\" content=\"never read\">'",
    _tag_if("page_id % 4 <> 3", '<meta name="keywords" content="',
            f"CASE WHEN page_id % 4 = 1 THEN {OWN_TEXT} ELSE 'page, ' || page_id END", '"/>'),
    _tag_if("page_id % 3 = 0", '<meta property="og:title" content="', "('OG \"page\" & ' || page_id)"),
    *(_tag_if(f"page_id % {n} = 1", f'<meta {kind}="{name}" content="', f"('{name} ' || page_id)")
      for name, (kind, n) in NUMBERED.items()),
    f"""CASE WHEN page_id % 4 = 0 THEN '<link href="' || {_URL} || '" rel="canonical nofollow">' END""",
    f"""CASE WHEN page_id % 5 = 0 THEN '<link rel=alternate hreflang=en href="' || {_URL} || '">' END""",
    """CASE WHEN page_id % 5 = 0 THEN '<link rel="alternate" hreflang="de">' END""",
    """CASE WHEN page_id % 9 = 0 THEN '<meta name="twitter:card" content="summary">' END""",
    """CASE WHEN page_id % 9 = 1 THEN '<meta name="Twitter:Card" content="wrong case">' END""",
    f"""'<script type="application/ld+json">' || {_BLOCK} || '</script>'""",
)


def tagged_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fetch log with metadata tags written into every page's head, from its own row.

    Some pages lose their head, which turns it into plain content.
    """
    return fetch_log(spark, sf_dir).selectExpr(
        "page_id", "path", "status", "elapsed_s", "error", "fetched_at",
        "split(html, '</title>', 2) AS parts",
        f"concat_ws('', {', '.join(TAGS)}) AS tags",
    ).selectExpr(
        "* EXCEPT (parts, tags)",
        """CASE WHEN page_id % 5 = 0 THEN replace(parts[0], '<title>', '<title>中文标题 ') ELSE parts[0] END
           || '</title>' || tags || parts[1] AS html""",
    ).withColumn("html", F.expr(
        "CASE WHEN page_id % 23 = 7 THEN replace(replace(html, '<head>', ''), '</head>', '') ELSE html END"))


def page_meta(spark: SparkSession, sf_dir: str, only: DataFrame | None = None) -> DataFrame:
    """Extracted metadata, one row per path; ``only`` names the paths to parse.

    HTML is parsed where it is read: a bitmap of the wanted paths tells which, and the
    exact join comes after, on rows without HTML.
    """
    pages = tagged_pages(spark, sf_dir)
    if only is None:
        return extract.latest_per_path(extract.extract_metadata(pages))
    parsed = extract.extract_metadata(narrow.maybe_in(pages, only, "path"))
    return extract.latest_per_path(parsed.join(only.select("path"), "path", "left_semi"))


def audited(spark: SparkSession, sf_dir: str) -> DataFrame:
    search = SearchFacts(spark, sf_dir)
    zero = search.landed_zero_click()
    pages = page_meta(spark, sf_dir)
    return audit.audit_pages(audit.with_context(pages, zero, search.ranked(zero)), SITE)


def rewritten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rewritten texts per page, from all ``documents``: dealt out to the pages by id.

    The title is a page's last document, the description all of them in turn.
    """
    n_pages = table(spark, sf_dir, "pages").count()
    texts = table(spark, sf_dir, "documents").where("text IS NOT NULL") \
        .groupBy(F.expr(f"doc_id % {max(n_pages, 1)}").alias("page_id")) \
        .agg(F.array_sort(F.collect_list(F.struct("doc_id", "text"))).alias("docs"))
    return texts.selectExpr(
        "page_id", f"{PATH} AS path", "element_at(docs, -1).text AS last", "array_join(docs.text, ' ') AS text",
    ).selectExpr(
        "path",
        """CASE WHEN page_id % 2 = 1 THEN '学科标题，' ELSE '' END
           || last AS title""",
        """CASE WHEN page_id % 3 = 1 THEN '说明文字。' ELSE '' END
           || text AS description""",
        "CASE WHEN page_id % 4 <> 0 THEN 'term ' || page_id END AS keywords",
        "'Term ' || page_id AS term_name",
        "'Subject ' || (page_id % 5) AS subject",
    )
