"""Line dedup by distinct-site spread.

A line that occurs on many sites is boilerplate wherever it stands. Per line hash
a HyperLogLog sketch of the sites is kept; sketches merge in the aggregation, so a
line of any frequency costs one small sketch per task. The estimate decides for
lines clearly above or below the threshold. For lines within ``BAND`` standard
errors of it the distinct sites are counted exactly, and that count decides.

Lines are compared trimmed, lower-cased and with single spaces, by 64-bit hash.
Everything is built-in expressions: no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from serplens.llm.tables import join_rows, keyed
from serplens.sources.storage import materialize

#: Sites from which on a line is boilerplate.
MIN_SITES = 8
#: log2 of the sketch's size, and its relative standard error.
SKETCH_BITS = 8
ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)
BAND = 4


def normal(line: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(line, r"[\x20\x09-\x0D]+", " ")))


def line_sites(docs: DataFrame, site: str) -> DataFrame:
    """(doc_id, text_hash, site, place, hash) of every line with a word; a null site is one site."""
    # Sketches skip empty strings, so a null site is a dash; others begin with an equals sign.
    # Outer, so that the optimizer does not split every text once more to filter on its lines' number.
    lines = keyed(docs, F.coalesce(F.concat(F.lit("="), F.col(site).cast("string")), F.lit("-")).alias("site")) \
        .select("doc_id", "text_hash", "site", F.posexplode_outer(F.split("text", "\n", -1)).alias("place", "line"))
    return lines.withColumn("line", normal(F.col("line"))).where("line <> ''") \
        .select("doc_id", "text_hash", "site", "place", F.xxhash64("line").alias("hash"))


def spread_lines(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """(hash, sites, exact): lines of at least ``min_sites`` sites, by estimate or by count."""
    sketched = materialize(
        lines.groupBy("hash").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", SKETCH_BITS)).alias("sites"))
        .where(F.col("sites") >= min_sites * (1 - BAND * ERROR)), "spread")
    sure = sketched.where(F.col("sites") > min_sites * (1 + BAND * ERROR)).withColumn("exact", F.lit(False))
    near = sketched.where(F.col("sites") <= min_sites * (1 + BAND * ERROR)).select("hash")
    # Distinct pairs first: a line's sites are then counted from one row each.
    counted = lines.select("hash", "site").join(near, "hash", "left_semi").distinct() \
        .groupBy("hash").agg(F.count(F.lit(1)).alias("sites")).where(F.col("sites") >= min_sites)
    return sure.unionByName(counted.withColumn("exact", F.lit(True)))


def remove_boilerplate(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, site): doc_id, n_lines, n_removed, removed, text.

    ``removed`` holds the numbers of the boilerplate lines, from 0, and ``text`` the
    other lines, blank ones included. A null text stays null and has no lines; an
    empty text is one blank line. Rows are told by id and text; equal rows get
    equal results, and all rows count for their sites. An empty table gives no
    rows; other columns are ignored.
    """
    # Written once, as narrow rows: texts are split and lines normalised a single time.
    lines = materialize(line_sites(docs, site), "lines")
    spread = materialize(spread_lines(lines, min_sites).select("hash"), "boilerplate")
    found = lines.join(spread, "hash", "left_semi").groupBy("doc_id", "text_hash") \
        .agg(F.array_sort(F.collect_set("place")).alias("removed"))
    none = F.array().cast("array<int>")
    # Pairs of line and number are filtered in one walk, so that no text is split per line.
    kept = F.filter(F.split("text", "\n", -1), lambda line, i: ~F.array_contains("removed", i))
    return join_rows(keyed(docs), found, "left").withColumn("removed", F.coalesce("removed", none)).select(
        "doc_id", F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0)).cast("long").alias("n_lines"),
        F.size("removed").cast("long").alias("n_removed"), "removed",
        F.when(F.size("removed") == 0, F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"))
