"""Scalar rules on hand-derived rows."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from serplens import params
from serplens.functions import jsonld, labels, text
from serplens.functions.numbers import round_exact
from serplens.sources.landing import date_window

NAN = float("nan")


def apply(spark, schema, rows, expression):
    """Values of one expression over literal rows, in row order."""
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + schema)
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_rank_bin(spark):
    positions = [(p,) for p in (0.0, 2.99, 3.0, 4.99, 5.0, 10.0, 20.0, 50.0, 998.9, 1000.0, -1.0, NAN, None)]
    assert apply(spark, "p double", positions, labels.rank_bin(F.col("p"))) == [
        "1-3 (首页顶部)", "1-3 (首页顶部)", "4-5", "4-5", "6-10 (首页底部)", "11-20 (第2页)", "21-50",
        "50+", "50+", "50+", "50+", "50+", "50+",
    ]


def test_priority_label(spark):
    positions = [(p,) for p in (3.99, 4.0, 10.0, 20.0, NAN)]
    got = apply(spark, "p double", positions, labels.priority_label(F.col("p")))
    assert [label[0] for label in got] == ["A", "B", "C", "D", "D"]


#: Of the rules below, a prefix without a closing slash matches longer words too.
RULES = (("Atlas", ("/atlas/", "/en/atlas/")), ("Start", ("/start",)), ("Parts", ("/parts/",)), ("Diary", ("/diary/",)))
SEGMENTS = (("lab", "/lab/"), ("keyword", "/unit/keyword/"), ("course_article", "/unit/"))


def test_page_type(spark):
    paths = ["/", "", "/en", "/en/", "/diary", "/diary/x", "/started", "/start", "/en/atlas", "/atlases", "/parts/a"]
    got = apply(spark, "p string", [(p,) for p in paths], labels.page_type(F.col("p"), RULES))
    assert got == ["Homepage"] * 3 + ["Other", "Diary", "Diary", "Start", "Start", "Atlas", "Other", "Parts"]


def test_content_type(spark):
    paths = ["/en/unit/keyword/x", "/unit/x", "/en/unit/lab/x", "/x/lab/unit/", "/en/x", "/en/en/unit/"]
    got = apply(spark, "p string", [(p,) for p in paths], labels.content_type(F.col("p"), SEGMENTS))
    assert got == ["keyword", "course_article", "lab", "lab", "other", "course_article"]


def test_language(spark):
    got = apply(spark, "p string", [("/en/x",), ("/en",), ("/x",)], labels.language_of(F.col("p")))
    assert got == ["en", "zh", "zh"]


def test_path_of_removes_every_origin(spark):
    pages = [("https://a.b/x",), ("https://a.bhttps://a.b/x",), ("https://c.d/x",), ("https://aXb/x",)]
    got = apply(spark, "p string", pages, labels.path_of(F.col("p"), "https://a.b"))
    assert got == ["/x", "/x", "https://c.d/x", "https://aXb/x"]


def test_url_path(spark):
    urls = [("https://a.b/x/y?q=1",), ("/x",), ("http//odd",)]
    assert apply(spark, "u string", urls, labels.url_path(F.col("u"))) == ["/x/y", "/x", "http//odd"]


@pytest.mark.parametrize("site_url, origin", [
    ("sc-domain:example.com", "https://www.example.com"),
    ("https://example.com/", "https://example.com"),
    ("https://example.com", "https://example.com"),
])
def test_origin(site_url, origin):
    assert params.origin_of(site_url) == origin


def test_filter_tag():
    assert [params.filter_tag(f) for f in (None, "", "/a/b/", "blog")] == ["all", "all", "a_b", "blog"]


def test_date_window():
    today = date(2026, 3, 31)
    assert date_window("7d", today) == (date(2026, 3, 21), date(2026, 3, 28))
    assert date_window("3m", today) == (date(2025, 12, 28), date(2026, 3, 28))
    assert date_window("2026-01-01, 2026-03-01", today) == (date(2026, 1, 1), date(2026, 3, 1))
    with pytest.raises(ValueError):
        date_window("soon", today)


def test_filters_are_case_insensitive_patterns(spark):
    paths = [("/Ünï/a",), ("/ünÏ/b",), ("/x",), ("/a.b",), ("/acb",)]
    p = F.col("p")
    assert apply(spark, "p string", paths, labels.matches_any(p, ["ÜNÏ"])) == [True, True, False, False, False]
    assert apply(spark, "p string", paths, labels.matches_any(p, ["a.B", "^/X$"])) == [
        False, False, True, True, True]


def test_patterns_refer_to_their_own_groups(spark):
    paths = [("/xx/1",), ("/ab",), ("/xy",)]
    assert apply(spark, "p string", paths, labels.matches_any(F.col("p"), ["(a)b", r"(x)\1"])) == [True, True, False]


def test_generic_opener(spark):
    rows = [("Explore x",), ("explore x",), ("Explorer",), ("探索x",), ("Dive into it",), ("",), (None,)]
    got = apply(spark, "d string", rows, text.generic_opener(F.col("d")))
    assert got == ["Explore", None, None, "探索", "Dive into", None, None]


def test_language_mismatch(spark):
    rows = [("/x", "abc", ""), ("/en/x", "abc", ""), ("/x", "中", ""), ("/x", "a", "文"), ("/x", None, None),
            ("/x", "。", "！")]
    got = apply(spark, "p string, t string, d string", rows,
                text.language_mismatch(F.col("p"), F.col("t"), F.col("d")))
    assert got == [True, False, False, False, True, True]


def test_keyword_coverage(spark):
    rows = [
        (["gene editing", "gene crop yield", " "], "Gene editing basics", None, None),
        (["a b c d e", "x y　z", "ED  it\tnow", "\x1cgene\x1dgene nothing"], "a b c edit gene", "y", "z"),
        ([], "t", "d", "k"),
        (["中文 查询", "İX"], None, "中文", "i̇x"),
    ]
    got = apply(spark, "q array<string>, t string, d string, k string", rows, text.uncovered_queries(
        F.col("t"), F.col("d"), F.col("k"), F.col("q")))
    # Covered words: gene editing 2/2, gene crop yield 1/3; a b c d e 5/5, x y z 2/3 with an
    # ideographic space, ED it now 2/3, gene gene nothing 2/3; 中文 查询 1/2, İX 1/1.
    assert got == [["gene crop yield"], [], [], ["中文 查询"]]


ARTICLE = '{"@type":"Article","datePublished":"x","dateModified":"y"}'
BARE = '{"@type":"Article"}'
COURSE_ISSUE = "course_missing_LearningResource"


@pytest.mark.parametrize("blocks, expected", [
    (None, ["no_schema"]),
    ([], ["no_schema"]),
    ([ARTICLE], [COURSE_ISSUE]),
    (['{"@type":"Article","datePublished":null}'], ["missing_dateModified", COURSE_ISSUE]),
    (['{"@type":["Article","LearningResource"]}'], ["missing_datePublished", "missing_dateModified"]),
    (['{"@type":"Course"}'], []),
    (['{"@type":["Course"]}'], [COURSE_ISSUE]),
    (['{"@type":"LearningResource"}', ARTICLE], []),
    ([BARE, BARE], ["missing_datePublished", "missing_dateModified"] * 2 + [COURSE_ISSUE]),
    ([f"[{BARE}, 5, {ARTICLE}]"], ["missing_datePublished", "missing_dateModified", COURSE_ISSUE]),
    (['{"name":"no type"}'], [COURSE_ISSUE]),
    (['{"@type":7}'], [COURSE_ISSUE]),
    (['{"@graph":[{"@type":"LearningResource"}]}'], [COURSE_ISSUE]),
])
def test_structured_data(spark, blocks, expected):
    got = apply(spark, "p string, b array<string>", [("/x", blocks), ("/keyword/x", blocks)],
                jsonld.completeness_issues(F.col("p"), F.col("b")))
    assert got == [expected, [i for i in expected if i != COURSE_ISSUE]]


def test_clamp(spark):
    rows = [("short",), ("one two three four",), ("unbrokenlongtext",), ("中文。很长，文字内容",), ("中文字没有标点的内容很长",),
            ("two  spaces here",), (" lead",), ("aaaa bbb ccc",)]
    assert apply(spark, "t string", rows, text.clamp(F.col("t"), 8)) == [
        "short", "one two", "unbroken", "中文。很长，", "中文字没有标点的", "two", " lead", "aaaa bbb"]


def test_branded_title(spark):
    rows = [("Plain title",), ("Already | B",), ("A title that goes on and on | B",), ("",)]
    got = apply(spark, "t string", rows, text.branded_title(F.col("t"), " | B", 20))
    assert got == ["Plain title | B", "Already | B", "A title that | B", " | B"]
    assert all(len(t) <= 20 for t in got)
    with pytest.raises(ValueError):
        text.branded_title(F.col("t"), " | a very long brand", 10)


def test_clamped_text_is_a_fitting_prefix(spark):
    rng = random.Random(11)
    texts = ["".join(rng.choice("ab  c。，；！中文é\n") for _ in range(rng.randrange(0, 60))) for _ in range(400)]
    got = apply(spark, "t string", [(t,) for t in texts], F.struct("t", text.clamp(F.col("t"), 20).alias("c")))
    for t, c in got:
        assert len(c) <= 20 and t.startswith(c)
        assert c == t or len(t) > 20
        if len(t) > 20 and any("一" <= ch <= "鿿" for ch in t):
            ends = [i for i, ch in enumerate(t[:20]) if ch in "。！？；，"]
            assert c == (t[:ends[-1] + 1] if ends else t[:20])


def test_coverage_properties(spark):
    """A page that quotes a query covers it; a page without its words covers none of it."""
    rng = random.Random(5)
    vocabulary = ["gene", "Edit", "cell", "中文", "É", "x-y"]
    queries = [[" \u3000".join(rng.choices(vocabulary, k=rng.randrange(1, 6))) for _ in range(3)] for _ in range(60)]
    rows = [(q, " ".join(q), None, None) for q in queries] + [(q, "0 1 2", "", None) for q in queries]
    got = apply(spark, "q array<string>, t string, d string, k string", rows, text.uncovered_queries(
        F.col("t"), F.col("d"), F.col("k"), F.col("q")))
    assert got == [[]] * 60 + queries


@pytest.mark.parametrize("digits", [1, 2])
def test_rounding_equals_pythons(spark, digits):
    rng = random.Random(9)
    values = [k / 20 for k in range(0, 4000, 1)] + [k / 200 for k in range(1, 4000, 2)] + [k / 8 for k in range(400)]
    values += [rng.uniform(0, 10**rng.randrange(-6, 9)) for _ in range(3000)] + [2.675, 1e-9, 0.0, -0.25, -0.35]
    got = apply(spark, "v double", [(v,) for v in values], round_exact(F.col("v"), digits))
    assert got == [round(v, digits) for v in values]
