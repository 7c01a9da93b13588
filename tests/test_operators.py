"""Relational operators against brute force on small fixtures, and their plans."""

import random
import statistics
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from serplens import schemas
from serplens.operators import audit, crawl, facts, narrow, ranking, update
from serplens.params import Site
from serplens.plans import derived
from serplens.plans.queries import REGISTRY

TYPES = (("Course", ("/course/",)),)
CONTENT = (("keyword", "/course/keyword/"), ("course_article", "/course/"))
SITE = Site("sc-domain:example.com", "https://www.example.com/", TYPES, CONTENT, brand_suffix=" | B")
WWW = "https://www.example.com"


def plan(df):
    """Physical plan, the final one where adaptive execution already ran."""
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def search_rows():
    """Facts with ties, where one page owns a third of all rows."""
    rng = random.Random(7)
    rows = []
    for i in range(900):
        page = "/course/hot" if i % 3 == 0 else f"/course/{rng.randrange(40)}"
        clicks = 1 if page.endswith("7") and rng.random() < 0.3 else 0
        rows.append((f"q{i:03d}", WWW + page, clicks, rng.randrange(1, 9), 0.0, float(rng.randrange(1, 60))))
    return rows


@pytest.fixture(scope="module")
def search(spark, search_rows):
    return spark.createDataFrame(search_rows, schemas.SEARCH_QUERY_PAGE)


def brute_zero_click(rows, n):
    by_page = defaultdict(list)
    for query, page, clicks, impressions, _, position in rows:
        by_page[page].append((query, clicks, impressions, position))
    out = []
    for page, group in by_page.items():
        if sum(g[1] for g in group) == 0:
            total = sum(g[2] for g in group)
            best = sorted(group, key=lambda g: (-g[2], g[0]))[:n]
            out += [(page.removeprefix(WWW), q, i, p, total, 0) for q, _, i, p in best]
    return out


@pytest.mark.parametrize("n", [1, 3, 10])
def test_zero_click(search, search_rows, n):
    got = [tuple(r) for r in facts.zero_click_report(search, SITE, n).collect()]
    assert sorted(got) == sorted(brute_zero_click(search_rows, n))
    assert [(-r[4], -r[2]) for r in got] == sorted((-r[4], -r[2]) for r in got)


def test_top_queries_are_cut_before_the_shuffle(search):
    text = plan(facts.zero_click_rows(search, SITE))
    assert text.count("WindowGroupLimit") >= 2
    assert "row_number(), 10, Partial" in text


def test_filters_come_before_totals(spark):
    rows = [("a", WWW + "/Keep/1", 1, 5, 0.0, 1.0), ("b", WWW + "/keep/2", 0, 5, 0.0, 1.0),
            ("c", WWW + "/keep/skip", 0, 5, 0.0, 1.0), ("d", WWW + "/other", 0, 5, 0.0, 1.0)]
    site = Site(WWW, WWW, TYPES, CONTENT, page_filter="/KEEP/", exclude_patterns=("sk.p", "nothing"))
    df = spark.createDataFrame(rows, schemas.SEARCH_QUERY_PAGE)
    assert [r["path"] for r in facts.zero_click_report(df, site).collect()] == ["/keep/2"]


def test_roll_up_weights_positions_and_composes(spark):
    rows = [("a", "p", 1, 3, 0.3, 2.0), ("a", "p", 0, 1, 0.0, 6.0), ("b", "p", 0, 4, 0.0, 1.0), ("c", "z", 0, 0, 0.0, 9.0)]
    df = spark.createDataFrame(rows, schemas.SEARCH_QUERY_PAGE)
    fine = facts.sum_facts(df, ["query", "page"])
    assert {tuple(r) for r in facts.as_metrics(fine).collect()} == {
        ("a", "p", 1, 4, 0.25, 3.0), ("b", "p", 0, 4, 0.0, 1.0), ("c", "z", 0, 0, 0.0, 0.0)}
    coarse = {("p", 1, 8, 0.125, 2.0), ("z", 0, 0, 0.0, 0.0)}
    assert {tuple(r) for r in facts.roll_up(df, ["page"]).collect()} == coarse
    assert {tuple(r) for r in facts.roll_up(fine, ["page"]).collect()} == coarse


def test_segments_use_the_interpolated_median(spark):
    rows = [(WWW + f"/{i}", c, i, 0.0, 1.0) for i, c in ((1, 1), (2, 1), (4, 0), (5, 1))]
    df = spark.createDataFrame(rows, schemas.SEARCH_PAGE)
    assert facts.median_of(df, "impressions") == 3.0
    got = {r["path"]: r["segment"] for r in facts.ranking_report(df, SITE).collect()}
    assert got == {"/1": "无需求", "/2": "无需求", "/4": "有需求无转化", "/5": "有需求有转化"}
    odd = spark.createDataFrame(rows[:3], schemas.SEARCH_PAGE)
    got = {r["path"]: r["segment"] for r in facts.ranking_report(odd, SITE).collect()}
    assert got["/2"] == "无需求"  # the median itself is no demand, clicks or not


def test_selection_finds_every_place(spark, monkeypatch):
    monkeypatch.setattr(facts, "SELECTION_RANGES", 5)
    rng = random.Random(6)
    for values in ([], [4], [4, 9], [7] * 30, [-3, 10**15, 0, 0, 5], [rng.randrange(-50, 900) for _ in range(301)] + [12] * 150):
        df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v bigint").repartition(3)
        assert facts.median_of(df, "v") == (statistics.median(values) if values else None)
        if values:
            places = sorted({0, len(values) // 3, len(values) - 1})
            assert facts.values_at(df, "v", places, min(values), max(values)) == [sorted(values)[p] for p in places]


def test_ranking_of_nothing(spark):
    empty = spark.createDataFrame([], schemas.SEARCH_PAGE)
    ranked = ranking.priority_ranking(
        facts.ranking_rows(empty, SITE), spark.createDataFrame([], schemas.ZERO_CLICK), SITE
    )
    assert ranked.count() == 0
    assert ranking.ranking_summary(facts.ranking_rows(empty, SITE), ranked).first().asDict() == {
        "total_pages": 0, "ranked_pages": 0, "top_score": 0.0}


@pytest.mark.parametrize("parts", [1, 5])
def test_global_rank_is_the_sort_order(spark, parts):
    rng = random.Random(3)
    # A third of the rows share one score, so ties have to be split by path.
    rows = [(f"/p{i:04d}", 1.0 if i % 3 == 0 else float(rng.randrange(50))) for i in range(2000)]
    df = spark.createDataFrame(rows, "path string, priority_score double").repartition(7)
    ranked = ranking.with_global_rank(df, [F.desc("priority_score"), F.asc("path")], partitions=parts)
    got = [r["path"] for r in sorted(ranked.collect(), key=lambda r: r["priority_rank"])]
    assert got == [p for p, _ in sorted(rows, key=lambda r: (-r[1], r[0]))]
    assert sorted(r["priority_rank"] for r in ranked.collect()) == list(range(1, 2001))
    assert "Window" not in plan(ranked) and "SinglePartition" not in plan(ranked)


def test_rank_and_top_agree(spark, tiny):
    search = derived.SearchFacts(spark, tiny)
    zero = search.zero_click()
    ranked = {r["path"]: r["priority_rank"] for r in search.ranked(zero).collect()}
    top = ranking.top_pages(search.scored(zero), 5)
    assert [(r["path"], r["priority_rank"]) for r in top.collect()] == \
        sorted(ranked.items(), key=lambda kv: kv[1])[:5]
    assert "TakeOrderedAndProject" in plan(top)


def test_score_is_unclicked_impressions(spark, tiny):
    merged = derived.SearchFacts(spark, tiny).ranking()
    off = merged.where(F.abs(ranking.labels.opportunity_score(F.col("impressions"), F.col("ctr"))
                             - (F.col("impressions") - F.col("clicks"))) > 1e-9)
    assert off.count() == 0


def test_path_queries_count_all_but_list_few(spark):
    rows = [("/a", f"q{i % 15:02d}", i, float(i), 1, 0) for i in range(30)] + [("/b", "null", 1, 1.0, 1, 0)]
    got = {r["path"]: r for r in ranking.path_queries(spark.createDataFrame(rows, schemas.ZERO_CLICK), 4).collect()}
    assert got["/a"]["query_count"] == 15
    assert [q["impressions"] for q in got["/a"]["top_queries"]] == [29, 28, 27, 26]
    rough = ranking.query_counts(spark.createDataFrame(rows, schemas.ZERO_CLICK), approximate=True)
    assert {r["path"]: r["query_count"] for r in rough.collect()} == {"/a": 15, "/b": 1}
    assert got["/b"]["query_count"] == 1 and got["/b"]["top_queries"][0]["query"] == "null"


def test_parse_range():
    assert [ranking.parse_range(s) for s in (30, "50", "31-60")] == [(1, 30), (1, 50), (31, 60)]


def test_batches_count_from_the_first_target(spark):
    ranked = spark.range(1, 100).toDF("priority_rank")
    rows = ranking.rank_range(ranked, 31, 55, 10).collect()
    assert [r["batch_id"] for r in sorted(rows)] == [0] * 10 + [1] * 10 + [2] * 5


META = "path string, title string, meta_description string, meta_keywords string, schema_json_ld array<string>, queries array<string>, priority_rank bigint"


def test_audit_order_and_texts(spark):
    rows = [
        ("/course/late", "t", "Explore " + "x" * 200, None, None, ["absent words"], None),
        ("/course/first", "中" * 61, "文", None, ['{"@type":"Course"}'], ["中"], 1),
        ("/en/course/x", "t", "", "absent words", ['{"@type":"Course"}'], ["absent words"], 1200),
    ]
    report = audit.audit_report(audit.audit_pages(spark.createDataFrame(rows, META), SITE)).collect()
    assert [(r["path"], r["priority_rank"]) for r in report] == [
        ("/course/first", 1), ("/en/course/x", 1200), ("/course/late", 999)]
    late = report[2].asDict()
    assert late["issues"] == ("desc_too_long, generic_opening, language_mismatch, missing_keywords, "
                              "schema:no_schema")
    assert (late["issues_count"], late["generic_opener"], late["language_mismatch"]) == (5, "Explore", "yes")
    assert report[0]["title_issue"] == "too_long" and report[0]["title_length"] == 61
    assert report[1]["issues"] == ""


def test_summary_of_no_pages(spark):
    audited = audit.audit_pages(spark.createDataFrame([], META), SITE)
    assert audit.audit_summary(audited).first()["desc_avg_length"] == 0.0
    empty = spark.createDataFrame([], schemas.PAGE_META)
    assert crawl.coverage(empty).first()["title_pct"] == 0.0


def test_coverage_ignores_empty_values(spark):
    rows = [{"path": "/a", "title": "", "h1": [], "canonical": "c"}, {"path": "/b", "title": "t", "h1": ["x"], "error": ""}]
    df = spark.createDataFrame(rows, schemas.PAGE_META)
    got = crawl.coverage(df).first()
    assert (got["title"], got["h1"], got["canonical"], got["errors"], got["total_pages"]) == (1, 1, 1, 1, 2)


def test_python_runs_only_for_extraction(spark, tiny):
    assert plan(derived.audited(spark, tiny)).count("MapInArrow") >= 1
    search = derived.SearchFacts(spark, tiny)
    zero = search.zero_click()
    for df in (facts.zero_click_rows(search.query_page, SITE), search.ranked(zero),
               audit.coverage_queries(zero), update.rewrite_queries(zero)):
        assert "Python" not in plan(df) and "MapIn" not in plan(df)


def nodes(plan):
    """All nodes of a physical plan as it was first made."""
    if plan.nodeName() == "AdaptiveSparkPlan":
        return nodes(plan.initialPlan())
    children = plan.children()
    return [plan] + [n for i in range(children.size()) for n in nodes(children.apply(i))]


@pytest.mark.parametrize("key", [
    "crawl_report", "rewrite_context", "rewrite_skipped", "metadata_update", "schema_enrichment",
    "metadata_merge", "metadata_backup", "update_stats", "update_acceptance"])
def test_html_is_never_shuffled(spark, tiny, monkeypatch, key):
    """Without broadcasts by size, no exchange of what a query parses, or of what is parsed, holds HTML."""
    parsed = []
    extract_metadata = derived.extract.extract_metadata

    def seen(pages, *more):
        parsed.append(extract_metadata(pages, *more))
        return parsed[-1]

    monkeypatch.setattr(derived.extract, "extract_metadata", seen)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        result = REGISTRY[key](spark, tiny)
        plans = [nodes(df._jdf.queryExecution().executedPlan()) for df in (*parsed, result)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert parsed and any("Exchange" in n.nodeName() for p in plans for n in p)
    for node in (n for p in plans for n in p if "Exchange" in n.nodeName()):
        assert "html" not in node.output().mkString(" ")


def test_bitmap_keeps_every_wanted_row(spark):
    rows = spark.range(5000).selectExpr("id", "CASE WHEN id % 9 > 0 THEN 'p' || id END AS path", "repeat('x', 50) AS html")
    wanted = spark.range(0, 5000, 7).selectExpr("'p' || id AS path", "1 AS page")
    kept = {r["id"] for r in narrow.maybe_in(rows, wanted, "path", pages=1).collect()}
    needed = {i for i in range(0, 5000, 7) if i % 9}
    assert needed <= kept and len(kept) < len(needed) + 200
    assert narrow.maybe_in(rows, wanted.where("false"), "path").count() == 0
    assert narrow.maybe_in(rows, wanted, "path").columns == rows.columns


def test_acceptance_wants_queries_in_the_description(spark):
    updated = meta_frame(spark, [("/en/a", {"title": "red wine | B", "meta_description": "all about red", "meta_keywords": "wine"}),
                                 ("/en/b", {"title": "t | B", "meta_description": "Best RED wine list"}), ("/en/c", {"title": "t"})])
    zero = spark.createDataFrame([("/en/a", "red wine", 5, 1.0, 5, 0), ("/en/b", "red wine shop", 5, 1.0, 5, 0)], schemas.ZERO_CLICK)
    got = {r["path"]: r["covers_queries"] for r in update.acceptance(updated, SITE, zero).collect()}
    assert got == {"/en/a": False, "/en/b": True, "/en/c": True}


def test_date_window_prunes_partitions(spark, tiny, tmp_path):
    from serplens.sources.landing import in_window

    derived.search_log(spark, tiny).write.partitionBy("run_date").parquet(str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    df = facts.roll_up(in_window(log, derived.WINDOW), ["page"])
    scan = next(line for line in plan(df).splitlines() if "FileScan" in line)
    assert "run_date" in scan.split("PartitionFilters:")[1].split("PushedFilters:")[0]
    assert "query" not in scan.split("ReadSchema:")[1]


def meta_frame(spark, rows):
    return spark.createDataFrame([{"path": p, **values} for p, values in rows], schemas.PAGE_META)


def test_merge_prefers_the_current_run_and_is_idempotent(spark):
    previous = meta_frame(spark, [("/a", {"title": "old a"}), ("/b", {"title": "old b"})])
    current = meta_frame(spark, [("/b", {"title": "new b"}), ("/c", {"title": "new c"})])
    once = update.merge_metadata(previous, current)
    twice = update.merge_metadata(once, current)
    expected = [("/a", "old a"), ("/b", "new b"), ("/c", "new c")]
    for merged in (once, twice):
        assert sorted((r["path"], r["title"]) for r in merged.collect()) == expected


def test_rewrites(spark):
    context = meta_frame(spark, [
        ("/course/a", {"title": "old", "og_image": "img", "og_type": "website", "twitter_card": "summary",
                       "schema_json_ld": ['{"@type":"Article","datePublished":"2020","extra":{"n":1.50}}', '{"@type":"Person"}']}),
        ("/en/course/keyword/b", {"canonical": "https://c/b"}),
    ]).withColumns({
        "seo_page_type": F.when(F.col("path").contains("keyword"), "keyword").otherwise("course_article"),
        "top_queries": F.array(*(F.struct(F.lit(q).alias("query"), F.lit(1).cast("bigint").alias("impressions"))
                                 for q in ("q1", "q2"))),
    })
    rewritten = spark.createDataFrame([
        ("/course/a", "  New title  ", "说明。" + "长" * 200, " ", "Term", "Subject"),
        ("/en/course/keyword/b", "B title | B", "short", "k1, k2", "Entropy", "Physics"),
    ], schemas.REWRITTEN)
    got = {r["path"]: r for r in update.apply_rewrites(context, rewritten, SITE, F.lit("2026-01-01")).collect()}
    a, b = got["/course/a"], got["/en/course/keyword/b"]
    assert (a["title"], a["og_title"], a["twitter_title"]) == ("New title | B",) * 3
    assert (a["meta_description"], a["og_description"]) == ("说明。",) * 2
    assert (a["meta_keywords"], b["meta_keywords"]) == ("q1, q2", "k1, k2")
    assert (a["og_image"], a["og_type"], a["twitter_card"]) == ("img", "website", "summary")
    assert (a["og_url"], b["og_url"]) == (WWW + "/course/a", "https://c/b")
    import json

    article, person = map(json.loads, a["schema_json_ld"])
    assert person == {"@type": "Person"}
    assert article == {
        "@type": ["Article", "LearningResource"], "datePublished": "2020", "dateModified": "2026-01-01",
        "headline": "New title", "description": "说明。", "extra": {"n": 1.5},
        "isPartOf": {"@type": "Course", "name": "Subject"},
    }
    (fresh,) = map(json.loads, b["schema_json_ld"])
    assert fresh["about"] == {"@type": "DefinedTerm", "name": "Entropy", "inDefinedTermSet": "Physics"}
    assert fresh["@context"] == "https://schema.org" and fresh["headline"] == "B title"
