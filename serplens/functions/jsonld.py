"""Structured-data (JSON-LD) rules over an array of JSON texts.

Blocks have an open schema, so they are handled as ``map<string, variant>``:
only the keys a rule asks for are looked at, everything else passes through.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_OBJECT = "map<string,variant>"


def _as_object(value: Column) -> Column:
    return F.try_variant_get(value, "$", _OBJECT)


def objects(blocks: Column) -> Column:
    """Objects of all blocks; a top-level array counts as its elements."""
    def elements(text: Column) -> Column:
        parsed = F.try_parse_json(text)
        return F.coalesce(F.try_variant_get(parsed, "$", "array<variant>"), F.array(parsed))

    flat = F.flatten(F.transform(F.coalesce(blocks, F.array().cast("array<string>")), elements))
    return F.filter(F.transform(flat, _as_object), lambda o: o.isNotNull())


def _type_list(obj: Column) -> Column:
    return F.try_variant_get(obj["@type"], "$", "array<string>")


def _type_name(obj: Column) -> Column:
    """Scalar type; NULL for a list, which would otherwise be read as its text."""
    return F.when(_type_list(obj).isNull(), F.try_variant_get(obj["@type"], "$", "string"))


def has_type(obj: Column, name: str) -> Column:
    return F.coalesce(
        F.array_contains(_type_list(obj), name), _type_name(obj) == name, F.lit(False)
    )


def _is_learning_resource(obj: Column) -> Column:
    # A lone Course counts, a Course inside a type list does not.
    return has_type(obj, "LearningResource") | F.coalesce(_type_name(obj) == "Course", F.lit(False))


def completeness_issues(path: Column, blocks: Column) -> Column:
    """Issue labels of a page's structured data, one per occurrence, in order."""
    found = objects(blocks)

    def missing_dates(obj: Column) -> Column:
        return F.array_compact(F.array(*(
            F.when(has_type(obj, "Article") & ~F.map_contains_key(obj, key), F.lit("missing_" + key))
            for key in ("datePublished", "dateModified")
        )))

    lacks_resource = ~F.contains(path, F.lit("/keyword/")) & ~F.exists(found, _is_learning_resource)
    resource_issue = F.when(lacks_resource, F.array(F.lit("course_missing_LearningResource"))) \
        .otherwise(F.array().cast("array<string>"))
    return F.when(
        F.coalesce(F.size(blocks), F.lit(0)) <= 0, F.array(F.lit("no_schema"))
    ).otherwise(F.concat(F.flatten(F.transform(found, missing_dates)), resource_issue))


def _variant(value: Column) -> Column:
    """Variant of a string column, through its JSON form."""
    wrapped = F.parse_json(F.to_json(F.struct(value.alias("v"))))
    return F.variant_get(wrapped, "$.v", "variant")


def _variant_object(**fields: Column) -> Column:
    named = F.struct(*(value.alias(name.replace("at_", "@")) for name, value in fields.items()))
    return F.parse_json(F.to_json(named))


def _put(obj: Column, key: str, value: Column) -> Column:
    rest = F.map_filter(obj, lambda k, _: k != key)
    return F.map_concat(rest, F.create_map(F.lit(key), value))


def _put_if_absent(obj: Column, key: str, value: Column) -> Column:
    return F.when(F.map_contains_key(obj, key), obj).otherwise(_put(obj, key, value))


def enrich_article(
    obj: Column,
    *,
    headline: Column,
    description: Column,
    date: Column,
    content: Column,
    term_name: Column,
    subject: Column,
) -> Column:
    """Article block brought in line with the rewritten page.

    Texts always follow the page; dates and relations are only added where the
    block has none, so existing values survive.
    """
    names = F.coalesce(_type_list(obj), F.array(_type_name(obj)))
    with_resource = F.array_union(names, F.array(F.lit("LearningResource")))
    out = _put(obj, "headline", _variant(headline))
    out = _put(out, "description", _variant(description))
    out = _put_if_absent(out, "datePublished", _variant(date))
    out = _put_if_absent(out, "dateModified", _variant(date))
    course = _put(out, "@type", F.parse_json(F.to_json(with_resource)))
    course = _put_if_absent(
        course, "isPartOf", _variant_object(at_type=F.lit("Course"), name=subject)
    )
    keyword = _put(out, "about", _variant_object(
        at_type=F.lit("DefinedTerm"), name=term_name, inDefinedTermSet=subject,
    ))
    return F.when(content == "course_article", course).when(content == "keyword", keyword).otherwise(out)


def enrich(blocks: Column, **page: Column) -> Column:
    """All blocks with every Article enriched; a page without one gains one."""
    found = objects(blocks)
    fresh = F.create_map(F.lit("@context"), _variant(F.lit("https://schema.org")),
                         F.lit("@type"), _variant(F.lit("Article")))
    seeded = F.when(F.exists(found, lambda o: has_type(o, "Article")), found) \
        .otherwise(F.concat(found, F.array(fresh)))
    done = F.transform(
        seeded, lambda o: F.when(has_type(o, "Article"), enrich_article(o, **page)).otherwise(o)
    )
    return F.transform(done, lambda o: F.to_json(o))
