"""Labels derived from a URL, a path or a position."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from serplens import params


def path_of(page: Column, origin: str) -> Column:
    """Path of a page URL; URLs of other hosts stay whole."""
    return F.replace(page, F.lit(origin), F.lit(""))


def url_path(value: Column) -> Column:
    """Path component of a full URL; anything else is already a path."""
    return F.when(value.startswith("http"), F.coalesce(F.try_parse_url(value, F.lit("PATH")), value)) \
        .otherwise(value)


def full_url(base_url: str, path: Column) -> Column:
    return F.concat(F.lit(base_url.rstrip("/")), path)


def _first_match(rules: Sequence[tuple[Column, object]], default: object) -> Column:
    cases = reduce(lambda acc, rule: acc.when(rule[0], F.lit(rule[1])), rules, F)
    return F.lit(default) if cases is F else cases.otherwise(F.lit(default))


def page_type(path: Column, rules: Sequence) -> Column:
    """Section of the site, by ordered prefix rules.

    A prefix also names its own page without the closing slash (``/blog``).
    """
    cases = [(path.isin(*params.HOMEPAGE_PATHS), "Homepage")]
    for label, prefixes in rules:
        hits = [path.startswith(p) | (path == p.rstrip("/")) for p in prefixes]
        cases.append((reduce(Column.__or__, hits), label))
    return _first_match(cases, "Other")


def rank_bin(position: Column) -> Column:
    """Result-page band; NULL, NaN and out-of-range positions fall in the last."""
    cases = [((position >= low) & (position < high), label) for low, high, label in params.RANK_BINS]
    return _first_match(cases, params.RANK_BIN_OTHER)


def priority_label(position: Column) -> Column:
    cases = [(position < bound, label) for bound, label in params.PRIORITY_LABELS]
    return _first_match(cases, params.PRIORITY_LABEL_OTHER)


def content_type(path: Column, segments: Sequence) -> Column:
    """Kind of content, by ordered path segments, ignoring the language prefix."""
    bare = F.regexp_replace(path, "^/en/", "/")
    return _first_match([(bare.contains(part), label) for label, part in segments], "other")


def language_of(path: Column) -> Column:
    return F.when(path.startswith("/en/"), F.lit("en")).otherwise(F.lit("zh"))


def demand_segment(impressions: Column, clicks: Column, median: Column) -> Column:
    return (
        F.when(impressions <= median, F.lit(params.SEGMENT_NO_DEMAND))
        .when(clicks > 0, F.lit(params.SEGMENT_CONVERTING))
        .otherwise(F.lit(params.SEGMENT_NOT_CONVERTING))
    )


def opportunity_score(impressions: Column, ctr: Column) -> Column:
    """Impressions that did not lead to a click."""
    return impressions * (F.lit(1) - ctr)


def matches_any(path: Column, patterns: Sequence[str]) -> Column:
    """Case-insensitive regular-expression search for any of the patterns.

    Each pattern is tried by itself: joined into one, their groups would be numbered anew.
    """
    return reduce(Column.__or__, (path.rlike("(?iu)" + p) for p in patterns))
