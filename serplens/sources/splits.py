"""Records of text files whose ends only the text before them tells, cut by many tasks.

A quoted line break in CSV and a bracket in JSON without line breaks mean something
else inside a text than outside, so a reader has to know all that comes before. Here
a file is read in its splits, as pieces between separators. What a split does to the
state is summed up for every state it may begin in; the sums of the splits before it,
one row each, then tell the state it does begin in. Only records of several pieces are
put together in a further shuffle, and a task sees one split or one record, never a file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from serplens.sources.storage import materialize

_SPLIT = ("file", "block")


def pieces(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """(file, block, piece, value): ``piece`` grows with the place inside a split of the file."""
    return spark.read.option("lineSep", separator).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("piece"), "value")


def _within(value: Column, last: int = 0) -> Column:
    """Sum over the pieces of a split up to this one, or to ``last`` from it."""
    return _sum(value, Window.partitionBy(*_SPLIT).orderBy("piece"), last)


def _across(value: Column) -> Column:
    """Sum over the splits of a file before this one."""
    return _sum(value, Window.partitionBy("file").orderBy("block"), -1)


def _sum(value: Column, window: WindowSpec, last: int) -> Column:
    return F.coalesce(F.sum(value).over(window.rowsBetween(Window.unboundedPreceding, last)), F.lit(0))


def _quotes(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit('"')))


def _by_state(odd: Column, even: str, other: str) -> Column:
    return F.when(odd == 0, F.col(even)).otherwise(F.col(other))


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, record, value): the records of CSV files in which quotes stand around fields and are doubled inside.

    Records are numbered from 1 in each file. A line break counts if the quotes
    before it are even in number. A file with an odd number of them ends in one long record.
    """
    odd = F.col("odd")
    lines = pieces(spark, path, "\n").withColumn("odd", _quotes(F.col("value")) % 2)
    # As if the split began outside quotes: whether a line does, and how many did up to it.
    lines = lines.withColumn("inside", _within(odd, -1) % 2)
    lines = lines.withColumn("opened", _within(1 - F.col("inside"))) \
        .withColumn("opened_else", _within(F.col("inside")))
    lines = materialize(lines, "csv_lines")

    splits = lines.groupBy(*_SPLIT).agg(
        F.sum("odd").alias("odd"), F.max("opened").alias("opened"), F.max("opened_else").alias("opened_else"))
    splits = splits.withColumn("carry", _across(odd) % 2)
    splits = splits.withColumn("records", _across(_by_state(F.col("carry"), "opened", "opened_else")))

    placed = lines.join(splits.select(*_SPLIT, "carry", "records"), list(_SPLIT)).select(
        *_SPLIT, "piece", "value", "odd", ((F.col("inside") + F.col("carry")) % 2).alias("inside"),
        (F.col("records") + _by_state(F.col("carry"), "opened", "opened_else")).alias("record"))
    whole = (F.col("inside") == 0) & (odd == 0)
    joined = placed.where(~whole).groupBy("file", "record").agg(_in_order("\n").alias("value"))
    return placed.where(whole).select("file", "record", "value").unionByName(joined)


def _in_order(separator: str) -> Column:
    ordered = F.array_sort(F.collect_list(F.struct("block", "piece", "value")))
    return F.array_join(F.transform(ordered, lambda p: p["value"]), separator)


def json_entries(spark: SparkSession, path: str) -> DataFrame:
    """(file, value): the entries ``"key": {...}`` of files that hold one object of objects, in any layout.

    A bracket counts if the quotes before it are even in number. A file that does not
    close, or that has something behind its last entry, fails the job.
    """
    # A split text never parts a backslash from what it escapes: no bracket is escaped.
    bare = F.regexp_replace("value", r"(?s)\\.", "")
    texts = r'"[^"]*("|\z)'
    outside = F.regexp_replace(bare, texts, "")
    outside_else = F.regexp_replace(F.regexp_replace(bare, r'^[^"]*("|\z)', ""), texts, "")

    def opening(text: Column) -> Column:
        return F.length(text) - F.length(F.replace(text, F.lit("{")))

    parts = pieces(spark, path, "}").withColumn("odd", _quotes(bare) % 2) \
        .withColumn("opening", opening(outside)).withColumn("opening_else", opening(outside_else))
    # As if the split began outside a text: the state of a part, and what it and its closing bracket add.
    parts = parts.withColumn("inside", _within(F.col("odd"), -1) % 2)
    after = (F.col("inside") + F.col("odd")) % 2
    parts = parts.select(
        *_SPLIT, "piece", "value", after.alias("after"),
        (_by_state(F.col("inside"), "opening", "opening_else") - (1 - after)).alias("depth"),
        (_by_state(1 - F.col("inside"), "opening", "opening_else") - after).alias("depth_else"), "odd")
    parts = materialize(parts, "json_parts")

    splits = parts.groupBy(*_SPLIT).agg(*(F.sum(c).alias(c) for c in ("odd", "depth", "depth_else")))
    splits = splits.withColumn("carry", _across(F.col("odd")) % 2)
    depth = _by_state(F.col("carry"), "depth", "depth_else")
    splits = splits.withColumn("above", _across(depth)) \
        .withColumn("left_open", F.sum(depth).over(Window.partitionBy("file")))

    parts = parts.join(splits.select(*_SPLIT, "carry", "above", "left_open"), list(_SPLIT))
    parts = parts.select(*_SPLIT, "piece", "value", "left_open",
                         ((F.col("after") + F.col("carry")) % 2).alias("inside"),
                         (F.col("above") + _within(_by_state(F.col("carry"), "depth", "depth_else"))).alias("depth"))
    ends = ((F.col("depth") == 1) & (F.col("inside") == 0)).cast("int")
    parts = materialize(parts.withColumn("ends", ends).withColumn("ended", _within(ends, -1)), "json_entries")
    before = parts.groupBy(*_SPLIT).agg(F.sum("ends").alias("ends"))
    before = before.select(*_SPLIT, _across(F.col("ends")).alias("entries"))

    fault = F.when(F.col("left_open") > 0, F.raise_error(F.concat(F.lit("object is not closed: "), "file"))) \
        .when((F.col("depth") < 1) & ~F.col("value").rlike(r"^[\s{]*\z"),
              F.raise_error(F.concat(F.lit("no entry of an object: "), F.left("value", F.lit(80)))))
    checked = F.coalesce(fault, F.col("value"))
    placed = parts.join(before, list(_SPLIT)).select(
        *_SPLIT, "piece", checked.alias("value"), "depth", "ends", (F.col("entries") + F.col("ended")).alias("entry"))
    entries = placed.where((F.col("depth") >= 1) | F.col("value").isNull()).groupBy("file", "entry") \
        .agg(_in_order("}").alias("value"))
    # Only the first entry has the bracket that opens the object before it, the others a comma.
    lead = F.when(F.col("entry") == 0, r"^\s*\{").otherwise(r"^\s*,")
    return entries.select("file", F.concat(F.regexp_replace("value", lead, F.lit("")), F.lit("}")).alias("value"))
