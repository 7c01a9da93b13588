"""Fixed table schemas. No reader in this package infers one."""

from __future__ import annotations

from pyspark.sql import types as T

from serplens.operators.page_reader import NAMED_META, OG_META, TWITTER_META

METRIC_FIELDS = [
    T.StructField("clicks", T.LongType()),
    T.StructField("impressions", T.LongType()),
    T.StructField("ctr", T.DoubleType()),
    T.StructField("position", T.DoubleType()),
]


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


#: One landed search-analytics response.
RESPONSE = T.StructType([
    T.StructField("rows", T.ArrayType(T.StructType(
        [T.StructField("keys", T.ArrayType(T.StringType())), *METRIC_FIELDS]
    ))),
])

SEARCH_QUERY_PAGE = T.StructType(_strings("query", "page") + METRIC_FIELDS)
SEARCH_PAGE = T.StructType(_strings("page") + METRIC_FIELDS)

ZERO_CLICK = T.StructType([
    *_strings("path", "query"),
    T.StructField("impressions", T.LongType()),
    T.StructField("position", T.DoubleType()),
    T.StructField("page_impressions", T.LongType()),
    T.StructField("page_clicks", T.LongType()),
])

RANKING = T.StructType([
    *_strings("path"),
    T.StructField("position", T.DoubleType()),
    *_strings("rank_bin", "priority_label"),
    T.StructField("clicks", T.LongType()),
    T.StructField("impressions", T.LongType()),
    T.StructField("ctr", T.DoubleType()),
    *_strings("page", "page_type", "segment"),
])

PRIORITY_RANKED = T.StructType([
    T.StructField("priority_rank", T.LongType()),
    *_strings("path", "seo_page_type", "language"),
    T.StructField("priority_score", T.DoubleType()),
    T.StructField("impressions", T.LongType()),
    T.StructField("ctr", T.DoubleType()),
    T.StructField("position", T.DoubleType()),
    *_strings("priority_label"),
    T.StructField("query_count", T.LongType()),
])

META_STRINGS = (
    "title",
    *(c for c, _ in NAMED_META),
    *(c for c, _ in OG_META),
    *(c for c, _ in TWITTER_META),
    "canonical",
)

ALTERNATES = T.ArrayType(T.StructType(_strings("href", "hreflang")))

#: Extracted values of one page, without its key.
META_VALUES = T.StructType([
    *_strings(*META_STRINGS),
    T.StructField("alternates", ALTERNATES),
    T.StructField("schema_json_ld", T.ArrayType(T.StringType())),
    T.StructField("h1", T.ArrayType(T.StringType())),
    *_strings("error"),
])

PAGE_META = T.StructType([*_strings("path"), *META_VALUES.fields])

REWRITTEN = T.StructType(
    _strings("path", "title", "description", "keywords", "term_name", "subject")
)

#: Report headers as people know them, for CSV exports.
REPORT_HEADERS = {
    "path": "路径",
    "page": "完整URL",
    "page_type": "页面类型",
    "clicks": "点击",
    "impressions": "展示",
    "ctr": "CTR",
    "rank_bin": "排名段",
    "priority_label": "优先级",
    "segment": "分群",
    "query": "查询词",
    "page_impressions": "页面总展示",
    "page_clicks": "页面总点击",
}
#: The position header depends on the grain of the report.
POSITION_HEADERS = {"query": "排名", "page": "平均排名"}
