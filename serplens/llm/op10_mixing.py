"""Mixing of sources to target weights.

Every document gets a hash-random key, so that any prefix of a source in key
order is a random sample of it. Keys are cut into equal ranges; a source is
sorted range by range and a document's words before it are the words of all
earlier ranges plus those before it in its own. A source is then cut at its
exact budget: whole epochs of all its documents, and of one more epoch the
documents before the cut, the last one in part.

No task holds a source: a hot one spreads over ``RANGES`` ranges. One row per
source and range is summed across ranges, one row per source across sources.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
#: What stands between words. Cutting there takes less time than counting matches.
BETWEEN = r"[\x20\x09-\x0D]+"
#: Three hexadecimal digits of the key; more digits for more rows per source.
RANGE_DIGITS = 3
WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
SEED = "mix"


def word_count(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.array_size(F.array_remove(F.split(text, BETWEEN), "")).cast("long"), F.lit(0).cast("long"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(src, source_size, target) from (src, source, source_size), one row per source.

    Sources in code point order, null last, weigh ``weights`` in turn and share
    the words of all. No target exceeds ``max_epochs`` times its source; what a
    source cannot take goes to the others by weight. In order of size per weight
    a source is capped exactly if the share left by those before it reaches its cap.
    """
    everything = Window.partitionBy(F.lit(0))
    by_name = everything.orderBy(F.asc_nulls_last("source"))
    by_room = everything.orderBy((F.col("cap") / F.col("weight")).asc(), "src")
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    onwards = by_room.rowsBetween(0, Window.unboundedFollowing)
    turn = ((F.row_number().over(by_name) - 1) % len(weights)).cast("int")
    wide = "decimal(38,0)"
    return (
        sizes
        .withColumn("weight", F.get(F.array(*[F.lit(w).cast("long") for w in weights]), turn))
        .withColumn("cap", F.col("source_size") * max_epochs)
        .withColumns({
            "total": F.sum("source_size").over(everything),
            "caps_before": F.coalesce(F.sum("cap").over(before), F.lit(0)),
            "weight_left": F.sum("weight").over(onwards),
        })
        .withColumn("capped", F.expr(
            f"CAST(cap AS {wide}) * weight_left <= CAST(total - caps_before AS {wide}) * weight"))
        .withColumns({
            "rest": F.col("total") - F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(everything), F.lit(0)),
            "shares": F.sum(F.when(~F.col("capped"), F.col("weight"))).over(everything),
        })
        .select("src", "source_size", F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(
            (F.col("rest") * F.col("weight")).cast("double") / F.col("shares")).alias("target"))
    )


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS,
        seed: str = SEED) -> DataFrame:
    """``docs`` (doc_id, source, size, any other columns) with source_size, target and taken.

    ``taken`` is the number of words that the mix takes of a document, repeats
    counted: a multiple of its size, plus a part of it if the source's cut falls
    inside. Keys depend on doc_id and ``seed`` only, so reruns agree; equal keys
    (repeated ids, null ids) go by size. Null sources form one source. A source
    without words has target 0; an empty table gives no rows. Columns named like
    the added ones, or ``_src``, ``_key``, ``_range``, ``_offset``, ``_epochs``,
    ``_cut`` or ``_before``, are replaced.
    """
    working = ("_src", "_key", "_range", "_offset", "_epochs", "_cut", "_before")
    keyed = docs.drop("source_size", "target", "taken", *working).withColumns({
        "_src": F.coalesce(F.concat(F.lit("="), "source"), F.lit("")),
        "_key": F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))),
    }).withColumn("_range", F.substring("_key", 1, RANGE_DIGITS))
    ranges = keyed.groupBy("_src", "_range").agg(
        F.sum("size").alias("range_size"), F.first("source").alias("source"))
    targets = source_targets(
        ranges.groupBy(F.col("_src").alias("src")).agg(
            F.first("source").alias("source"), F.sum("range_size").alias("source_size")),
        weights, max_epochs)
    earlier = Window.partitionBy("_src").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    budget = F.floor("target")
    size = F.greatest("source_size", F.lit(1))
    plan = ranges.withColumn("offset", F.coalesce(F.sum("range_size").over(earlier), F.lit(0))) \
        .join(targets, F.col("_src") == F.col("src")).select(
            "_src", "_range", F.col("offset").alias("_offset"), "source_size", "target",
            F.floor(budget / size).alias("_epochs"), (budget % size).alias("_cut"))
    inside = Window.partitionBy("_src", "_range").orderBy("_key", "size") \
        .rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("_offset") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    return keyed.join(plan, ["_src", "_range"]).withColumn("_before", before).withColumn(
        "taken", F.col("_epochs") * F.col("size")
        + F.greatest(F.lit(0), F.least(F.col("size"), F.col("_cut") - F.col("_before")))
    ).drop(*working)


def repeat_taken(mixed: DataFrame) -> DataFrame:
    """The rows of a mix, each as often as it was taken, the last time cut to the words taken.

    A part keeps the white space between its words; its n_chars follows if there is such a column.
    """
    whole = F.floor(F.col("taken") / F.greatest("size", F.lit(1))).cast("int")
    part = (F.col("taken") - whole * F.col("size")).cast("int")
    copies = F.concat(F.array_repeat(F.lit(0), whole), F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<int>")))
    cut = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(rf"[\x20\x09-\x0D]*{WORD}"), F.lit(0)), F.lit(1), F.col("_cut")), "")
    out = mixed.withColumn("_cut", F.explode(copies)) \
        .withColumn("text", F.when(F.col("_cut") > 0, cut).otherwise(F.col("text")))
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.when(F.col("_cut") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.drop("_cut", "size", "source_size", "target", "taken")
