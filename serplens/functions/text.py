"""Text rules over titles, descriptions and queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from serplens import params

CJK = "[一-鿿]"
# Java's Unicode white space plus the four separators Python also splits on.
_SPACE = r"[\s\x{1c}-\x{1f}]"


def or_empty(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def n_chars(value: Column) -> Column:
    return F.length(or_empty(value)).cast("long")


def too_long(value: Column, limit: int) -> Column:
    return n_chars(value) > limit


def generic_opener(description: Column, openers: Sequence[str] = params.GENERIC_OPENERS) -> Column:
    """First opener that starts the description, stripped; NULL when none does."""
    return F.coalesce(*(
        F.when(description.startswith(o), F.lit(o.strip())) for o in openers
    ))


def has_cjk(value: Column) -> Column:
    return or_empty(value).rlike(CJK)


def language_mismatch(path: Column, title: Column, description: Column) -> Column:
    """A Chinese page (no ``/en/`` prefix) without a single Chinese character."""
    return ~path.startswith("/en/") & ~has_cjk(title) & ~has_cjk(description)


def words(value: Column) -> Column:
    """Lower-cased words, split on any Unicode white space."""
    parts = F.split(F.lower(or_empty(value)), "(?U)" + _SPACE + "+")
    return F.filter(parts, lambda w: w != "")


def uncovered_queries(
    title: Column,
    description: Column,
    keywords: Column,
    queries: Column,
    threshold: float = params.COVERAGE_THRESHOLD,
) -> Column:
    """Queries of which too few words occur in the page's texts, in input order.

    A word is covered when it is a substring of the lower-cased texts; repeated
    words count each time, and queries without words are left out.
    """
    text = F.lower(F.concat_ws(" ", or_empty(title), or_empty(description), or_empty(keywords)))

    def is_uncovered(query: Column) -> Column:
        total = F.size(words(query))
        covered = F.size(F.filter(words(query), lambda w: F.contains(text, w)))
        return (total > 0) & (covered / total < threshold)

    return F.filter(queries, is_uncovered)


def clamp(value: Column, limit: int) -> Column:
    """Shorten to at most ``limit`` characters at a natural boundary.

    Chinese text ends after its last sentence or clause mark inside the limit,
    other text before its last space; without either it is cut hard.
    """
    head = F.substring(value, 1, limit)
    clause = F.regexp_extract(head, "(?s)^(.*[。！？；，])", 1)
    # A space just after the limit ends a word that fits.
    phrase = F.regexp_extract(F.substring(value, 1, limit + 1), "(?s)^(.*[^ ]) ", 1)
    boundary = F.when(has_cjk(value), clause).otherwise(phrase)
    return (
        F.when(F.length(value) <= limit, value)
        .when(boundary != "", boundary)
        .otherwise(head)
    )


def without_suffix(title: Column, suffix: str) -> Column:
    if not suffix:
        return title
    return F.when(title.endswith(suffix), F.left(title, F.length(title) - len(suffix))).otherwise(title)


def branded_title(title: Column, suffix: str, limit: int) -> Column:
    """Title that ends in the brand suffix and still fits the limit."""
    if len(suffix) > limit:
        raise ValueError(f"the suffix {suffix!r} is longer than {limit} characters")
    return F.concat(clamp(without_suffix(title, suffix), limit - len(suffix)), F.lit(suffix))
