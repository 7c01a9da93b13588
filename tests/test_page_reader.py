"""Metadata extraction on literal documents."""

import random
import time

import pyarrow as pa
import pytest

from serplens import schemas
from serplens.operators import extract, page_reader
from serplens.operators.page_reader import NO_HEAD, read_page


def head(inner, body=""):
    return read_page(f"<html><head>{inner}</head><body>{body}</body></html>")


def test_no_head():
    assert read_page("<html><title>x</title></html>") == {"error": NO_HEAD}
    assert read_page("") == {"error": NO_HEAD}


@pytest.mark.parametrize("inner, title", [
    ("", None),
    ("<title></title>", ""),
    ("<title>  a  </title><title>b</title>", "a"),
    ("<title> a <b> x </b> c</title>", "axc"),
    ("<title>a<!-- no --> b</title>", "ab"),
    ("<title>Q&amp;A &quot;x&quot; &#65;&#x42; &copy; &nosuch; &amp</title>", 'Q&A "x" AB © &nosuch &'),
    ("<svg><title>first</title></svg><title>second</title>", "first"),
    ("<TITLE>upper</TITLE>", "upper"),
    ("<title/><title>late</title>", ""),
])
def test_title(inner, title):
    assert head(inner)["title"] == title


def test_title_outside_head_is_ignored():
    assert head("", "<title>x</title>")["title"] is None


def test_first_named_meta_wins_even_when_empty():
    found = head('<meta name="description" content=""><meta name="description" content="x">'
                 '<meta name="keywords" content="a, b"><meta content="noindex" name=robots>')
    assert found["meta_description"] is None
    assert (found["meta_keywords"], found["meta_robots"], found["meta_author"]) == ("a, b", "noindex", None)


def test_meta_values_match_exactly():
    found = head('<META NAME="Description" CONTENT="x"><meta property="description" content="y">'
                 '<meta name="og:title" content="z"><meta property="og:image:width" content="10">'
                 '<meta name="twitter:card" content="summary">')
    assert found["meta_description"] is None and found["og_title"] is None
    assert (found["og_image_width"], found["twitter_card"]) == ("10", "summary")


def test_attributes_are_decoded():
    found = head('<meta name="description" content="a &gt; b > c &amp;&quot; d"/>')
    assert found["meta_description"] == 'a > b > c &" d'


def test_repeated_attribute_keeps_the_last():
    assert head('<meta name="x" name="description" content="a" content="b">')["meta_description"] == "b"


def test_links():
    found = head('<link rel="alternate"><link rel="alternate nofollow" href="/a" hreflang="de">'
                 '<link rel="alternate" href="/b"><link rel="canonical  alternate" href="/c">'
                 '<link rel="canonical" href="/d"><link rel="Canonical" href="/e">')
    assert found["canonical"] == "/c"
    assert found["alternates"] == [{"href": "/a", "hreflang": "de"}, {"href": "/b", "hreflang": None},
                                   {"href": "/c", "hreflang": None}]
    assert head('<link rel="canonical" href=""><link rel="canonical" href="/x">')["canonical"] is None


def test_structured_data_anywhere():
    block = '<script type="application/ld+json">%s</script>'
    found = head(block % '{"a": 1}', block % "[2]" + block % "{bad" + block % "" + block % " "
                 + '<script type="application/LD+json">{}</script><script>{"b": 1}</script>'
                 + block % '{"t": "</b>&amp;", "n": NaN, "t": "é"}')
    assert found["schema_json_ld"] == ['{"a": 1}', "[2]", '{"t": "é", "n": null}']
    assert head("")["schema_json_ld"] is None
    assert head("", block % '"\\ud800"')["schema_json_ld"] == ['"\\ud800"']


@pytest.mark.parametrize("body, h1", [
    ("<h1> a <span> b</span></h1><h1> </h1><h1>c</h1>", ["ab", "c"]),
    ("<h1>x<script>var y</script><style>z</style></h1>", ["x"]),
    ("<template><h1>x</h1></template>", []),
    ("<h1>out<h1>in</h1></h1>", ["outin", "in"]),
    ("<h1>open<p>more", ["openmore"]),
    ("<div><h1>a</div>b<h1>c</h1>", ["a", "c"]),
    ("<h1>a<br>b<br/>c</h1>", ["abc"]),
    ("<h1>a</p>b</h1>", ["ab"]),
    ("<!-- <h1>no</h1> --><script>'<h1>no</h1>'</script>", []),
])
def test_headings(body, h1):
    assert head("", body)["h1"] == h1


def test_unclosed_head_reaches_its_parents_end():
    found = read_page("<html><head><title>t</title><body><meta name=author content=a></body>"
                      "<meta name=robots content=r></html><meta name=keywords content=k>")
    assert (found["meta_author"], found["meta_robots"], found["meta_keywords"]) == ("a", "r", None)


def test_second_head_is_ignored():
    assert read_page("<head></head><head><title>x</title></head>")["title"] is None


def test_status_gate_and_failures(spark):
    rows = [
        ("/ok", 200, "<head><title>t</title></head>", None),
        ("/gone", 404, "<head><title>t</title></head>", None),
        ("/down", 0, None, "timeout"),
        ("/empty", 200, None, None),
        ("/broken", 200, "<head></head><![weird[", None),
    ]
    raw = spark.createDataFrame(rows, "path string, status int, html string, error string")
    got = {r["path"]: r for r in extract.extract_metadata(raw).collect()}
    assert (got["/ok"]["title"], got["/ok"]["error"], got["/ok"]["h1"]) == ("t", None, [])
    assert (got["/gone"]["title"], got["/gone"]["error"], got["/gone"]["h1"]) == (None, "HTTP 404", None)
    assert (got["/down"]["status"], got["/down"]["error"]) == (0, "timeout")
    assert got["/empty"]["error"] == NO_HEAD
    assert got["/broken"]["status"] == 0 and got["/broken"]["error"]
    assert "html" not in extract.extract_metadata(raw).columns


def test_what_is_found_is_handed_back_a_few_pages_at_a_time():
    text = "x" * 40_000
    rows = [{"path": str(i), "status": 404 if i % 7 == 0 else 200, "error": "HTTP 404" if i % 7 == 0 else None,
             "html": None if i % 7 == 0 else f"<head><title>{i}</title></head>{text if i < 300 else ''}"} for i in range(1000)]
    batch = pa.RecordBatch.from_pylist(rows, schema=pa.schema(
        [("path", pa.string()), ("status", pa.int32()), ("html", pa.string()), ("error", pa.string())]))
    found = list(extract._batch_parser(extract._ARROW_META)(iter([batch, batch.slice(0, 0), batch])))
    assert max(f.num_rows for f in found) <= extract.SLICE_PAGES
    assert all(f.num_rows < 50 for f in found[:8])  # long pages go back sooner
    got = [r for f in found for r in f.to_pylist()]
    assert [(r["path"], r["status"], r["error"], r["title"]) for r in got] == 2 * [
        (r["path"], r["status"], r["error"], None if r["error"] else r["path"]) for r in rows]


def test_columns_follow_the_schema(spark):
    raw = spark.createDataFrame([("/x", 200, "<head></head>", None)], "path string, status int, html string, error string")
    df = extract.extract_metadata(raw)
    assert [f for f in df.schema.fields if f.name in schemas.META_VALUES.names] == schemas.META_VALUES.fields


def test_latest_per_path(spark):
    rows = [("/a", 1, 200, "x"), ("/a", 3, 404, None), ("/a", 3, 200, "z"), ("/a", 2, 200, "y"), ("/b", 1, 200, "w")]
    df = spark.createDataFrame(rows, "path string, fetched_at int, status int, title string")
    assert sorted(r["title"] for r in extract.latest_per_path(df).collect()) == ["w", "z"]
    ties = spark.createDataFrame([("/a", 1, 200, str(i)) for i in range(50)], df.schema)
    picked = {extract.latest_per_path(ties.repartition(n)).first()["title"] for n in (1, 3, 7)}
    assert len(picked) == 1


def test_tag_soup_never_loses_a_page(spark):
    rng = random.Random(2)
    parts = ["<head>", "</head>", "<title>", "</title>", "<h1>", "</h1>", "<p", ">", "text", "&amp;", "&#", "&x", "<!--", "-->",
             "<script>", "</script>", '<script type="application/ld+json">', '{"a":1}', "<br/>", "</p>", "<![CDATA[x]]>",
             "<meta name=description content=d>", '"', "<link rel=canonical href=/c>", "<?pi", "<!doctype html>", "</", "<"]
    soup = [(str(i), 200, "".join(rng.choice(parts) for _ in range(40)), None) for i in range(500)]
    raw = spark.createDataFrame(soup, "path string, status int, html string, error string")
    got = {r["path"]: r for r in extract.extract_metadata(raw).collect()}
    assert set(got) == {p for p, *_ in soup}
    for path, _, text, _ in soup:
        row = got[path]
        assert (row["error"] is None) == (row["h1"] is not None)
        if "<head" not in text:
            assert row["error"] is not None


def test_numbers_that_stricter_readers_refuse(spark):
    from pyspark.sql import functions as F

    deep = "[" * 900 + "]" * 900
    texts = ['{"x":1e400}', '{"x":-1e400,"y":NaN}', '{"x":' + "9" * 60 + "}", '{"x":' + "9" * 6000 + "}",
             '{"x":' + deep + "}", '{"x":1.5,"x":2}']
    blocks = [page_reader.valid_json(t) for t in texts]
    assert blocks[:2] == ['{"x": null}', '{"x": null, "y": null}'] and blocks[-1] == '{"x": 2}'
    df = spark.createDataFrame([(b,) for b in blocks], "b string")
    assert df.where(F.try_parse_json("b").isNull()).count() == 0


def test_blocks_of_any_depth_are_kept():
    n = 100_000
    for opened, closed, kept in (("[", "]", "["), ('{"a":', "}", '{"a": ')):
        block = page_reader.valid_json('{"@type":"Article","x":' + opened * n + "1" + closed * n + ',"y":"]}\\"["}')
        assert block.startswith('{"@type": "Article", "x": ' + kept) and block.endswith('"y": "]}\\"["}')
        assert block.count(kept.strip()) < 2 * page_reader.MAX_DEPTH
    for broken in ("[" * n, "[" * n + "]" * (n - 1) + "}", "[" * n + "}" * n, "[" * n + "]" * n + "x"):
        assert page_reader.valid_json(broken) is None


def test_unclosed_tags_take_linear_time():
    def seconds(n):
        text = "<html><head></head><body>" + "<div>a</i>" * n
        start = time.process_time()
        page_reader.read_page(text)
        return time.process_time() - start

    seconds(1000)
    assert seconds(80_000) < 30 * max(seconds(8_000), 0.01)
