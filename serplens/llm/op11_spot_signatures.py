"""Fingerprints by spot signatures: chains of content words that follow common words.

Common words stand evenly in running text and hardly ever in navigation, tables or
lists, so the chains behind them describe a text's prose. The common words, the
anchors, are the words found in most documents of the corpus. Every anchor gives one
signature: itself and the next ``chain`` content words, every ``spacing``-th one. The
beginning of a text is an anchor too, so that any text with a content word has a
signature. The distinct signatures, sorted, are the fingerprint.

Two fingerprints are compared by Jaccard similarity. It is at most the ratio of their
sizes, so fingerprints are partitioned by size, at bounds that grow by ``1 / least``:
two of a similarity of ``least`` lie in the same partition or in neighbouring ones,
and pairs whose sizes rule that out are pruned before their sets are looked at.

Everything is built-in expressions: no Python runs on the executors. The ``j``-th
anchor at place ``i`` has ``i - j`` content words before it, so chains are read off
the list of content words by index, in time linear in the text.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from serplens.llm.tables import keyed
from serplens.sources.storage import materialize

#: How many of the most frequent words are anchors, and at most which share of all distinct words.
ANCHORS, ANCHOR_SHARE = 256, 8
#: Longer words are no anchors, however frequent.
ANCHOR_CHARS = 24
CHAIN, SPACING = 3, 1
#: Hexadecimal digits of a signature.
DIGITS = 10
#: Similarity from which texts count as near, in ``similar``.
NEAR = 0.75
#: Ranges of ids per shuffle partition, so that hashing ranges to partitions deals evenly.
RANGES = 8

#: Letters that are lower-cased: ASCII and Latin-1.
UPPER = string.ascii_uppercase + "".join(map(chr, [*range(0xC0, 0xD7), *range(0xD8, 0xDF)]))
LOWER = string.ascii_lowercase + "".join(map(chr, [*range(0xE0, 0xF7), *range(0xF8, 0xFF)]))
#: A run of letters and digits; of scripts without spaces, one character.
WORD = (r"[\x{3040}-\x{30FF}\x{3400}-\x{9FFF}]"
        r"|[a-z0-9\x{C0}-\x{1FFF}\x{2C00}-\x{2DFF}\x{A000}-\x{D7FF}]+")


def words(text: Column) -> Column:
    """Lower-cased words of a text; null has none."""
    found = F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


def common_words(docs: DataFrame, n: int = ANCHORS) -> list[str]:
    """The ``n`` words of most documents, at most one in ``ANCHOR_SHARE``; equal ones by their code points."""
    # Outer, so that the optimizer does not filter on the list's size by building it twice.
    found = docs.select(F.explode_outer(F.array_distinct(words(F.col("text")))).alias("word"))
    counted = found.where(f"word IS NOT NULL AND length(word) <= {ANCHOR_CHARS}").groupBy("word") \
        .agg(F.count(F.lit(1)).alias("n"))
    seen = Observation()
    top = counted.observe(seen, F.count(F.lit(1)).alias("words")).orderBy(F.desc("n"), "word").limit(n).collect()
    return [r["word"] for r in top[:seen.get["words"] // ANCHOR_SHARE]]


def with_signatures(rows: DataFrame, text: str, name: str, anchors: list[str],
                    chain: int = CHAIN, spacing: int = SPACING) -> DataFrame:
    """``rows`` with ``name``, the sorted signatures of the column ``text``."""
    def is_anchor(word):
        return word.isin(anchors) if anchors else F.lit(False)

    def signature(anchor, at):
        links = [F.get(F.col("_content"), at + k * spacing) for k in range(chain)]
        return F.when(links[0].isNotNull(), F.substring(F.md5(F.concat_ws(" ", anchor, *links).cast("binary")), 1, DIGITS))

    placed = F.filter(F.transform(F.col("_words"), lambda w, i: F.when(
        is_anchor(w), F.struct(w.alias("word"), i.alias("at")))), lambda s: s.isNotNull())
    chains = F.transform(F.col("_anchors"), lambda s, j: signature(s["word"], s["at"] - j))
    every = F.concat(F.array(signature(F.lit(""), F.lit(0))), chains)
    # Steps of their own: an expression inside a lambda would be evaluated again for every element.
    return (
        rows.withColumn("_words", words(F.col(text)))
        .withColumns({"_content": F.filter("_words", lambda w: ~is_anchor(w)), "_anchors": placed})
        .withColumn("_chains", every)
        .withColumn(name, F.sort_array(F.array_distinct(F.filter("_chains", lambda s: s.isNotNull()))))
        .drop("_words", "_content", "_anchors", "_chains")
    )


def likeness(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard similarity of two fingerprints, two empty ones are equal.

    Below ``least`` it may be given as 0: sizes that rule out ``least`` are not compared.
    """
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    both = F.size(F.array_intersect(a, b))
    exact = both / (F.size(a) + F.size(b) - both)
    return F.when(large == 0, 1.0).when((small == 0) | (small < F.lit(least) * large), 0.0).otherwise(exact)


def size_class(fingerprint: Column, least: float = NEAR) -> Column:
    """Partition of a fingerprint's size: classes ``c`` apart differ in size by a factor beyond ``least ** -(c - 1)``."""
    return F.floor(F.log(F.greatest(F.size(fingerprint), F.lit(1))) / -math.log(least)).cast("int")


def fingerprints(docs: DataFrame, anchors: list[str] | None = None, chain: int = CHAIN,
                 spacing: int = SPACING) -> DataFrame:
    """(doc_id, text_hash, text, fingerprint) per row of ``docs`` (doc_id, text).

    ``anchors`` are those of ``common_words`` over ``docs`` if not given. A null or
    empty text, or one without a word, has an empty fingerprint. Equal texts have
    equal ones. Other columns are ignored.
    """
    anchors = common_words(docs) if anchors is None else anchors
    return with_signatures(keyed(docs), "text", "fingerprint", anchors, chain, spacing)


def similar(queries: DataFrame, prints: DataFrame, least: float = NEAR) -> DataFrame:
    """(query_id, doc_id, likeness) of all pairs at or above ``least``, but for empty fingerprints.

    Both sides hold (doc_id, fingerprint). Signatures are ordered rare first, by their
    number of fingerprints among the queries. Two similar sets share one of the first
    ``n - ceil(least * n) + 1`` of either, so these are joined, within a partition of
    sizes and its neighbours; pairs found are compared whole. Rows without such a pair
    do not come. Rows that repeat an id are compared one by one; a pair of ids comes
    once for each pair of different fingerprints.
    """
    def distinct(rows: DataFrame, name: str) -> DataFrame:
        return rows.where("size(fingerprint) > 0").select(F.col("doc_id").alias(name), "fingerprint").distinct()

    asked = materialize(distinct(queries, "query_id"), "asked")
    known = distinct(prints, "doc_id").withColumn("row", F.xxhash64("doc_id", "fingerprint"))
    frequency = asked.select(F.explode("fingerprint").alias("signature")).groupBy("signature") \
        .agg(F.count(F.lit(1)).alias("f"))

    def prefix(rows: DataFrame, keys: list[str]) -> DataFrame:
        # A signature that no query has comes first and need not be posted.
        taken = f"size(fingerprint) - int(ceil({least} * size(fingerprint))) + 1"
        spread = rows.select(*keys, F.size("fingerprint").alias("n"), F.expr(taken).alias("taken"),
                             F.explode("fingerprint").alias("signature")).join(frequency, "signature")
        grouped = spread.groupBy(*keys, "n", "taken").agg(
            F.sort_array(F.collect_list(F.struct("f", "signature"))).alias("s"))
        first = grouped.withColumn("s", F.expr("slice(s, 1, greatest(0, taken - (n - size(s))))"))
        return first.select(*keys, F.explode("s.signature").alias("signature"))

    left = asked.withColumn("q", F.xxhash64("query_id", "fingerprint"))
    left = left.withColumn("part", size_class(F.col("fingerprint"), least))
    right = known.withColumn("part", size_class(F.col("fingerprint"), least))
    left = left.withColumn("at", F.explode(F.array(*[F.col("part") + d for d in (-1, 0, 1)])))
    candidates = prefix(left, ["q", "at"]).withColumnRenamed("at", "part") \
        .join(prefix(right, ["row", "part"]), ["part", "signature"]).select("q", "row").distinct()
    whole = candidates.join(left.drop("at").distinct().withColumnRenamed("fingerprint", "a").drop("part"), "q") \
        .join(right.withColumnRenamed("fingerprint", "b").drop("part"), "row")
    return whole.select("query_id", "doc_id", likeness(F.col("a"), F.col("b"), least).alias("likeness")) \
        .where(F.col("likeness") >= least)


#: Sorts null ids, which come last, as the lowest.
_KEY = "coalesce(doc_id, -9223372036854775808L)"
#: Numbers of a range that its highest id may take apart from the others.
_SPLITS = 1 << 20


def _range_of(docs: DataFrame, count: int) -> Column:
    """Number of the range that a row lies in, ascending by doc_id and descending by text_hash.

    Ranges end at equally many rows. An id that fills several of them is split by
    text_hash. The place of an id among sorted bounds is found first among coarse, then
    among fine ones, so that a row costs twice the root of the number of ranges.
    """
    fractions = [i / count for i in range(1, count)]
    found = docs.agg(F.percentile_approx(F.expr(_KEY), fractions, 100 * count).alias("b")).first()["b"] if fractions else None
    bounds = sorted(set(found or []))
    filled = {b: found.count(b) for b in bounds if found.count(b) > 1}
    step = max(1, math.isqrt(len(bounds)))
    parts = [bounds[i:i + step] for i in range(0, len(bounds), step)] or [[]]
    offsets = [sum(map(len, parts[:i])) for i in range(len(parts))]
    key = F.expr(_KEY)

    def longs(values: list[int]) -> Column:
        return F.lit(values).cast("array<bigint>") if values else F.array().cast("array<bigint>")

    def below(sorted_bounds: Column) -> Column:
        return F.array_position(F.sort_array(F.array_append(sorted_bounds, key)), key) - 1

    block = below(longs([p[0] for p in parts[1:]])).cast("int")
    number = (F.get(longs(offsets), block) + below(F.get(F.array(*map(longs, parts)), block))) * (2 * _SPLITS)
    if not filled:
        return number
    times = F.get(longs(list(filled.values())), (F.array_position(longs(list(filled)), key) - 1).cast("int"))
    upper = F.greatest(F.lit(0), F.floor((F.lit(0.5) - F.col("text_hash") / F.lit(2.0 ** 64)) * times))
    return number + F.coalesce(_SPLITS + F.least(times - 1, upper), F.lit(0))


def packed(fingerprint: Column) -> Column:
    """A fingerprint as bytes, which shuffle in less than half the space of text."""
    return F.unhex(F.array_join(fingerprint, ""))


def unpacked(value: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.hex(value)), F.lit(f".{{{DIGITS}}}"), F.lit(0))


def with_next(docs: DataFrame, anchors: list[str], chain: int = CHAIN, spacing: int = SPACING) -> DataFrame:
    """``fingerprints`` of ``docs`` with next_text and next_fingerprint, those of the next row.

    The order is by doc_id descending, then text_hash; the last row's next is the first.
    Ranges of rows are ordered apart, so texts are shuffled once. Behind a range's last
    row comes a copy of the first row of the next range; there is one such copy per range.
    """
    ranges = RANGES * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = keyed(docs)
    ids = rows.select("doc_id", "text_hash")
    number = _range_of(ids, ranges)
    # One row per range here and below.
    highest = ids.withColumn("_range", number).groupBy("_range").agg(
        F.min(F.struct(F.expr(f"{_KEY} * -1BD").alias("place"), "text_hash", "doc_id")).alias("top"))
    everything = Window.orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    firsts = highest.select(
        F.col("top.doc_id").alias("_id"), F.col("top.text_hash").alias("_hash"),
        F.coalesce(F.lag("_range").over(Window.orderBy(F.desc("_range"))), F.last("_range").over(everything)).alias("_range"))
    heads = rows.join(F.broadcast(firsts), F.expr("doc_id <=> _id AND text_hash = _hash")).drop("_id", "_hash")

    def printed(texts: DataFrame, copy: bool) -> DataFrame:
        found = with_signatures(texts, "text", "fingerprint", anchors, chain, spacing)
        return found.withColumns({"fingerprint": packed(F.col("fingerprint")), "_copy": F.lit(copy)})

    in_range = Window.partitionBy("_range").orderBy("_copy", F.desc_nulls_last("doc_id"), F.asc("text_hash"))
    placed = printed(rows.withColumn("_range", number), False).unionByName(printed(heads, True))
    return placed.withColumns({"next_text": F.lead("text").over(in_range), "next_fingerprint": F.lead("fingerprint").over(in_range)}) \
        .where("NOT _copy").drop("_range", "_copy") \
        .withColumns({c: unpacked(F.col(c)) for c in ("fingerprint", "next_fingerprint")})


def compared_with_edits(docs: DataFrame, anchors: list[str] | None = None, chain: int = CHAIN,
                        spacing: int = SPACING) -> DataFrame:
    """Each row of ``docs`` (doc_id, text) next to an edited copy of itself and to the next row.

    In the edited text the last half of the code points, rounded down, is replaced by
    the first as many, or all, of the next row's text. Returns doc_id, n_chars, edited
    (text), fingerprint and edited_fingerprint (sorted signatures), near_edited and
    near_next (Jaccard similarity). A null text is empty; two texts without a word are
    alike. Next is the row with the next lower doc_id, of equal ids the one with the
    next text hash, null ids come last, and the last row's next is the first. A
    single row is its own next. Other columns are ignored; an empty table gives no rows.
    """
    anchors = common_words(docs) if anchors is None else anchors
    filled = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    led = with_next(filled, anchors, chain, spacing)
    edited = led.withColumn("n_chars", F.length("text").cast("long")).withColumn("edited", F.expr(
        "concat(substring(text, 1, int(n_chars - n_chars div 2)), substring(next_text, 1, int(n_chars div 2)))"))
    return with_signatures(edited, "edited", "edited_fingerprint", anchors, chain, spacing).select(
        "doc_id", "n_chars", "edited", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))


def with_digest(compared: DataFrame) -> DataFrame:
    """Fingerprints as text, and the digest of the edited text."""
    return compared.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        F.array_join("fingerprint", ",").alias("fingerprint"),
        F.array_join("edited_fingerprint", ",").alias("edited_fingerprint"), "near_edited", "near_next")
