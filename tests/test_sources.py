"""Readers, writers, snapshots and the chained steps."""

import codecs
import csv
import json
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from serplens import schemas
from serplens.operators import facts
from serplens.plans import derived, steps
from serplens.sources import buckets, landing, reports, snapshots, splits, storage


def test_responses(spark, tmp_path):
    lines = [
        {"rows": [{"keys": ["q", "p"], "clicks": 1, "impressions": 2, "ctr": 0.5, "position": 3.5}, {"keys": ["q"]}, {}]},
        {}, {"rows": []},
    ]
    file = tmp_path / "r.json"
    file.write_text("\n".join(map(json.dumps, lines)))
    df = landing.flatten_responses(landing.read_responses(spark, str(file)), ["query", "page"])
    assert sorted(map(tuple, df.collect())) == [
        ("", "", 0, 0, 0.0, 0.0), ("q", "", 0, 0, 0.0, 0.0), ("q", "p", 1, 2, 0.5, 3.5)]
    assert df.schema.names == schemas.SEARCH_QUERY_PAGE.names


def test_no_responses_keep_the_schema(spark, tmp_path):
    (tmp_path / "r.json").write_text("{}")
    df = landing.flatten_responses(landing.read_responses(spark, str(tmp_path)), ["page"])
    assert df.count() == 0 and df.columns == schemas.SEARCH_PAGE.names


def test_csv_of_other_tools(spark, tmp_path):
    text = '路径,查询词,展示,排名,页面总展示,页面总点击\r\n/a,"say ""hi"", ok",12,1.5,12.0,0\r\n/b,null,1,2.0,1,0\r\n/c,"two\nlines",1,2.0,1,0\r\n/d,"",1,2,1,0\r\n'
    (tmp_path / "z.csv").write_bytes(codecs.BOM_UTF8 + text.encode())
    schema = reports.without_report_headers(schemas.ZERO_CLICK)
    df = reports.read_csv(spark, str(tmp_path / "z.csv"), schema, multi_line=True, escaped=False) \
        .toDF(*schemas.ZERO_CLICK.names)
    assert [tuple(r) for r in df.orderBy("path").collect()] == [
        ("/a", 'say "hi", ok', 12, 1.5, 12, 0), ("/b", "null", 1, 2.0, 1, 0),
        ("/c", "two\nlines", 1, 2.0, 1, 0), ("/d", "", 1, 2.0, 1, 0)]


def test_report_headers(spark):
    zero = spark.createDataFrame([], schemas.ZERO_CLICK)
    assert reports.with_report_headers(zero).columns == ["路径", "查询词", "展示", "排名", "页面总展示", "页面总点击"]
    pages = spark.createDataFrame([], schemas.RANKING)
    assert reports.with_report_headers(pages).columns == [
        "路径", "平均排名", "排名段", "优先级", "点击", "展示", "CTR", "完整URL", "页面类型", "分群"]


def test_csv_keeps_texts_and_large_integers(spark, tmp_path):
    texts = ["two\nlines", "a\\nb", "\\", "\r\n", "\\\n", 'say "x", y', "", "\0", "a\0b", " a\t", " ", "\\0", "\\\\\0\n"]
    rows = [(t, 9007199254740993 - i) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "t string, n bigint")
    reports.write_csv(df, str(tmp_path / "c"))
    back = reports.read_csv(spark, str(tmp_path / "c"), df.schema)
    assert sorted(map(tuple, back.collect())) == sorted(rows)


@pytest.mark.parametrize("text", ["x1", "1.5", "12 000"])
def test_csv_refuses_malformed_integers(spark, tmp_path, text):
    (tmp_path / "n.csv").write_text(f"n\n1\n{text}\n")
    with pytest.raises(Exception, match="n is no integer"):
        reports.read_csv(spark, str(tmp_path / "n.csv"), spark.range(0).withColumnRenamed("id", "n").schema).collect()


@pytest.mark.parametrize("indent", [2, None])
def test_keyed_metadata_file(spark, tmp_path, indent):
    file = tmp_path / "m.json"
    pages = {
        "/a": {"title": "é \"x\"\n  },\n", "alternates": [{"href": "/x", "hreflang": None}], "h1": ["h"]},
        "/none": {},
        "/b": {"error": "HTTP 404"},
        "/c": {"schema_json_ld": ["{}", "[{\"a\": {}}]"]},
    }
    file.write_text(json.dumps(pages, ensure_ascii=False, indent=indent))
    rows = {r["path"]: r for r in reports.import_keyed_json(spark, str(file), schemas.META_VALUES).collect()}
    assert sorted(rows) == sorted(pages)
    assert rows["/a"]["title"] == pages["/a"]["title"] and rows["/a"]["alternates"][0]["href"] == "/x"
    assert rows["/b"]["error"] == "HTTP 404" and rows["/b"]["h1"] is None
    assert rows["/c"]["schema_json_ld"] == pages["/c"]["schema_json_ld"]
    file.write_text(json.dumps({}, indent=indent))
    assert reports.import_keyed_json(spark, str(file), schemas.META_VALUES).count() == 0


@pytest.fixture
def small_splits(spark):
    """Files of a few KB are read by many tasks."""
    sizes = {"spark.sql.files.maxPartitionBytes": "2k", "spark.sql.files.openCostInBytes": "1"}
    for key, value in sizes.items():
        spark.conf.set(key, value)
    yield
    for key in sizes:
        spark.conf.unset(key)


def texts_of(pieces, n, longest, seed):
    pick = random.Random(seed)
    return ["".join(pick.choices(pieces, k=pick.randint(0, longest))) for _ in range(n)]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_quoted_breaks_over_many_splits(spark, tmp_path, small_splits, end):
    pieces = ["a", '"', ",", "\n", "\r", "\r\n", " ", "é", "中", "\\", '""', "x y", "\n\n"]
    texts = texts_of(pieces, 400, 30, 5) + ["\n".join(["x"] * 4000)]
    with open(tmp_path / "q.csv", "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f, lineterminator=end, quoting=csv.QUOTE_ALL)
        out.writerows([("t", "n"), *((t, i) for i, t in enumerate(texts))])
    back = reports.read_csv(spark, str(tmp_path / "q.csv"), spark.createDataFrame([], "t string, n bigint").schema,
                            multi_line=True, escaped=False)
    assert splits.pieces(spark, str(tmp_path / "q.csv"), "\n").rdd.getNumPartitions() > 8
    assert [r["t"] for r in sorted(back.collect(), key=lambda r: r["n"])] == texts


def test_quoted_breaks_in_several_files(spark, tmp_path):
    for name, rows in (("a", 'x\n"1\n1"\n'), ("b", "x\n"), ("c", 'x\n2\n\n"3\n"'), ("d", "")):
        (tmp_path / f"{name}.csv").write_text(rows)
    back = reports.read_csv(spark, str(tmp_path), spark.createDataFrame([], "x string").schema, multi_line=True)
    assert sorted(r["x"] for r in back.collect()) == ["1\n1", "2", "3\n"]


@pytest.mark.parametrize("layout", [{"indent": 2}, {"indent": 1}, {}, {"separators": (",", ":")}])
def test_keyed_metadata_of_any_layout_over_many_splits(spark, tmp_path, small_splits, layout):
    pieces = ['"', "\\", "}", "{", "é", ",", "\n", "[", "\\u007d"]
    keys, titles = texts_of(pieces, 300, 4, 1), texts_of(pieces, 300, 9, 2)
    pages = {f"/{i}{k}": {"title": t, "alternates": [{"href": f"/}}{i}", "hreflang": None}] * (i % 3), "h1": ["h{"]}
             for i, (k, t) in enumerate(zip(keys, titles))}
    pages["/long"] = {"title": '}"{' * 3000, "alternates": [], "h1": []}
    (tmp_path / "m.json").write_text(json.dumps(pages, ensure_ascii=False, **layout) + "\n")
    file = str(tmp_path / "m.json")
    assert splits.pieces(spark, file, "}").rdd.getNumPartitions() > 8
    rows = reports.import_keyed_json(spark, file, schemas.META_VALUES, indented=False).collect()
    assert {r["path"]: (r["title"], [a["href"] for a in r["alternates"]], r["h1"]) for r in rows} == {
        k: (v["title"], [a["href"] for a in v["alternates"]], v["h1"]) for k, v in pages.items()}


@pytest.mark.parametrize("text, paths", [
    ("", []), ("{}", []), (" { } \n", []), ('{"a":{}}', ["a"]), ('{"a":null,"b":{}}', ["a", "b"]),
    ('{"a":{"title":"x"', None), ('{"a":{},"b":1', None), ('{"a":{}} x', None), ('{"a":{}}{"b":{}}', None)])
def test_keyed_metadata_that_does_not_close(spark, tmp_path, text, paths):
    (tmp_path / "m.json").write_text(text)
    rows = reports.import_keyed_json(spark, str(tmp_path / "m.json"), schemas.META_VALUES, indented=False)
    if paths is None:
        with pytest.raises(Exception, match="object|MALFORMED"):
            rows.collect()
    else:
        assert sorted(r["path"] for r in rows.collect()) == paths


def test_snapshots(spark, tmp_path):
    base, empty = str(tmp_path), spark.createDataFrame([], "x int")
    days = [date(2026, 1, 9), date(2026, 1, 10)]
    assert snapshots.write_snapshot(spark.range(3), base, "a", "all", days[0]) == 3
    assert snapshots.write_snapshot(empty, base, "a", "all", days[1]) == 0
    snapshots.write_snapshot(spark.range(2), base, "a", "zzz/*", date(2026, 1, 1))
    snapshots.write_snapshot(spark.range(1), base, "b", "all", days[0])
    # An empty run is still the latest, and another tag never wins by its name.
    assert snapshots.latest_run(spark, base, "a", "all") == days[1]
    assert snapshots.read_snapshot(spark, base, "a", "all", days[1], empty.schema).count() == 0
    assert snapshots.read_snapshot(spark, base, "a", "zzz/*", date(2026, 1, 1), spark.range(1).schema).count() == 2
    with pytest.raises(snapshots.SnapshotMismatch):
        snapshots.common_run(spark, base, ["a", "b"], "all")
    with pytest.raises(FileNotFoundError):
        snapshots.latest_run(spark, base, "c", "all")
    with pytest.raises(FileNotFoundError):
        snapshots.latest_run(spark, base + "/none", "a", "all")


def test_a_failed_run_leaves_the_old_one(spark, tmp_path):
    base, day, schema = str(tmp_path), date(2026, 1, 9), spark.range(1).schema
    snapshots.write_snapshot(spark.range(3), base, "a", "all", day)
    before = snapshots.read_snapshot(spark, base, "a", "all", day, schema)
    bad = spark.range(100).where("id < 7 OR raise_error('lost') IS NULL")
    with pytest.raises(Exception, match="lost"):
        snapshots.write_snapshot(bad, base, "a", "all", day)
    assert snapshots.read_snapshot(spark, base, "a", "all", day, schema).count() == before.count() == 3
    snapshots.write_snapshot(spark.range(5), base, "a", "all", day)
    # A reader that began before keeps its rows, one that begins now has the new ones.
    assert before.count() == 3
    assert snapshots.read_snapshot(spark, base, "a", "all", day, schema).count() == 5
    with pytest.raises(FileNotFoundError):
        snapshots.read_snapshot(spark, base, "a", "all", date(2026, 1, 10), schema)


def test_merge_rewrites_touched_buckets_only(spark, tmp_path):
    base = str(tmp_path)

    def rows(ids, value):
        return spark.createDataFrame([(f"/p{i}", value) for i in ids], "path string, v string")

    def files():
        return {str(f): f.stat().st_mtime_ns for f in tmp_path.rglob("*.parquet")}

    def table():
        return {r["path"]: r["v"] for r in buckets.read_merged(spark, base, "t", "all", rows([], "").schema).collect()}

    assert table() == {}
    assert buckets.merge_rows(rows(range(500), "old"), base, "t", "all", "path", 100) == 500
    before, all_files = table(), files()
    assert buckets.merge_rows(rows(range(495, 505), "new"), base, "t", "all", "path", 7) == 505
    assert all_files.items() <= files().items() and len(files()) <= len(all_files) + 10
    expected = before | {f"/p{i}": "new" for i in range(495, 505)}
    assert table() == expected
    assert buckets.merge_rows(rows([], ""), base, "t", "all", "path") == 505
    failing = rows(range(3), "bad").withColumn("v", F.expr("raise_error('lost')").cast("string"))
    with pytest.raises(Exception, match="lost"):
        buckets.merge_rows(failing, base, "t", "all", "path")
    assert table() == expected


def test_shared_folder_is_the_named_one(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert storage.shared_dir(spark) == (named or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def test_steps_end_to_end(spark, tiny, tmp_path):
    base, site = str(tmp_path), derived.SITE
    search = derived.SearchFacts(spark, tiny)
    fetched = steps.fetch(site, base, search.query_page, search.page, derived.RUN_DATE)
    assert fetched["ranking_rows"] == search.page.count() and fetched["zero_click_rows"] > 0

    ranked = steps.rank(spark, site, base)
    assert ranked["total_pages"] == fetched["ranking_rows"]
    assert ranked["rows"] == ranked["ranked_pages"] == sum(t["pages"] for t in ranked["types"])

    crawled = steps.crawl_pages(site, base, derived.tagged_pages(spark, tiny), "fetched_at")
    assert crawled["total_pages"] == ranked["rows"]
    assert crawled["without_title_total"] == crawled["total_pages"] - crawled["title"]
    assert len(crawled["without_title"]) == min(10, crawled["without_title_total"])
    for table in ("crawl_report", "audit_report"):
        if table == "audit_report":
            audited = steps.audit_metadata(spark, site, base)
        path = next((tmp_path / table).glob("*/*/*"))
        report = spark.read.parquet(str(path)).orderBy("report_rank").collect()
        assert [r["report_rank"] for r in report] == list(range(1, ranked["rows"] + 1))
        assert [(r["priority_rank"], r["path"]) for r in report] == sorted((r["priority_rank"], r["path"]) for r in report)

    assert audited["total_pages"] == audited["pages_with_issues"] + audited["pages_clean"]
    assert sum(audited["issue_breakdown"].values()) >= audited["pages_with_issues"]
    assert snapshots.latest_run(spark, base, "audit_summary", "all") == derived.RUN_DATE

    context, skipped = steps.prepare_rewrite(spark, site, base, "1-1000")
    assert context.count() + skipped.count() == ranked["rows"]
    assert skipped.count() == crawled["errors"]

    steps.write_batches(context, base + "/batches")
    batches = spark.read.json(base + "/batches")
    assert batches.count() == context.count()
    assert batches.groupBy("batch_id").count().agg(F.max("count")).first()[0] <= 10

    rewritten = derived.rewritten(spark, tiny)
    first = steps.finish_rewrite(site, base, rewritten, "1-2")
    second = steps.finish_rewrite(site, base, rewritten, "2-4")
    assert first["processed"] + first["skipped"] == 2
    assert second["total"] >= first["total"] and second["title_chars_after"] > 0
    merged = buckets.read_merged(spark, base, "optimized_metadata", "all", schemas.PAGE_META)
    assert merged.count() == merged.select("path").distinct().count() == second["total"]
    assert merged.where(~F.col("title").endswith(site.brand_suffix)).count() == 0


def test_steps_without_zero_click_pages(spark, tmp_path):
    rows = [("q", "https://www.example.com/guides/x", 1, 2, 0.5, 1.0)]
    query_page = spark.createDataFrame(rows, schemas.SEARCH_QUERY_PAGE)
    steps.fetch(derived.SITE, str(tmp_path), query_page, facts.roll_up(query_page, ["page"]), date(2026, 1, 1))
    summary = steps.rank(spark, derived.SITE, str(tmp_path))
    assert (summary["total_pages"], summary["ranked_pages"], summary["top_score"]) == (1, 0, 0.0)
