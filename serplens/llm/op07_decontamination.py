"""Benchmark decontamination by winnowing.

Words are hashed, every ``k`` consecutive words make a k-gram hash, and of every
``window - k + 1`` consecutive k-grams the least hash is kept as a fingerprint.
A run of ``window`` words that a document shares with a benchmark item holds the
same k-grams in both, so both keep its least one: joining fingerprints finds
every such run. Only documents with a common fingerprint go on; their hits are
extended to all windows that the item has too, compared by 128-bit digest. One
pass over the words counts them and looks their fingerprints up.

Items of fewer words than a window are one window as a whole. The lengths that
occur, nine at most, are fingerprinted for all documents as plain k-grams.

Everything is built-in expressions: no Python runs on the executors. Arrays made
by lambdas are exploded with ``explode_outer``: ``explode`` has the optimizer filter
on their size below the projections, which would build them again per element.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from serplens.llm.tables import join_rows, keyed
from serplens.sources.storage import materialize

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: What stands between words. Cutting there took a quarter of the time of listing matches.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
K = 5


def words(text: Column) -> Column:
    """Lower-cased words of a text; null has none."""
    lowered = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.coalesce(F.array_remove(F.split(lowered, BETWEEN), ""), F.array().cast("array<string>"))


def _each_start(n: str, length: int, body: str) -> str:
    """SQL of ``body`` over i for every start of a run of ``length`` among ``n``."""
    return (f"CASE WHEN {n} >= {length} THEN transform(sequence(0, {n} - {length}), i -> {body}) "
            f"ELSE array() END")


def _hash(at: list[int]) -> Column:
    return F.xxhash64(*[F.get(F.col("h"), F.col("i") + j) for j in at])


def fingerprints(texts: DataFrame, window: int, k: int, short: list[int]) -> DataFrame:
    """``texts`` without ``text``, a row per start of a window and short run: n_words, head, whole, print.

    A text's first row is its head and is there for every text. Rows that are not
    ``whole`` reach beyond the text. Each start is a row of plain columns, so that
    its hashes are compiled code, not lambdas; nothing in them is conditional, as
    words used in several k-grams are then read once.
    """
    n, i = F.size("h"), F.col("i")
    hashed = texts.withColumn("h", F.transform(words(F.col("text")), lambda w: F.xxhash64(w))).drop("text")
    last = F.greatest(n - min([*short, window]), F.lit(0))
    rows = hashed.withColumn("i", F.explode_outer(F.sequence(F.lit(0), last)))
    grams = [_hash(list(range(j, j + k))) for j in range(window - k + 1)]
    least = F.least(*grams) if len(grams) > 1 else grams[0]
    if short:
        runs = [F.struct(F.lit(r).alias("run"), _hash(list(range(r))).alias("print")) for r in short]
        rows = rows.select("*", F.posexplode_outer(
            F.array(F.struct(F.lit(window).alias("run"), least.alias("print")), *runs)).alias("slot", "of")) \
            .select("*", "of.*").drop("of")
    else:
        rows = rows.withColumns({"slot": F.lit(0), "run": F.lit(window), "print": least})
    return rows.withColumns({"n_words": n, "head": (i == 0) & (F.col("slot") == 0), "whole": i <= n - F.col("run")}) \
        .drop("h", "i", "slot", "run")


def windows(texts: DataFrame, lengths: list[int]) -> DataFrame:
    """A row (length, start, digest) for every run of one of ``lengths`` words; ``text`` is dropped."""
    runs = ", ".join(
        _each_start("size(w)", n, f"named_struct('length', {n}, 'start', i, "
                                  f"'digest', md5(concat_ws(' ', slice(w, i + 1, {n}))))")
        for n in lengths)
    return texts.withColumn("w", words(F.col("text"))).drop("text") \
        .withColumn("run", F.explode_outer(F.expr(f"concat({runs})"))).drop("w").select("*", "run.*").drop("run")


#: Words covered by (start, length) runs in ascending order of start.
_COVERED = """aggregate(array_sort(runs), named_struct('until', 0, 'n', 0),
  (a, r) -> named_struct('until', greatest(a.until, r.start + r.length),
                         'n', a.n + greatest(0, r.start + r.length - greatest(a.until, r.start))),
  a -> bigint(a.n))"""


def screen(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, k: int = K) -> tuple[DataFrame, DataFrame]:
    """What every document's words tell in one pass, and the benchmark's windows.

    The first has a row (doc_id, text_hash, n_words, copies, suspect) for each document,
    ``copies`` the rows that are equal to it; the second (length, digest, items).
    """
    items = benchmark.select("item_id", "text").withColumn("n", F.size(words(F.col("text")))).where("n > 0")
    short = [r["n"] for r in items.where(F.col("n") < window).select("n").distinct().orderBy("n").collect()]
    # Written first: its size then tells Spark whether to broadcast it.
    wanted = materialize(
        fingerprints(items.select("text", "n"), window, k, short)
        # A short item is known by its whole run only, which is one of its prints.
        .where("whole").select(F.col("print").alias("wanted")).distinct(), "prints")
    seen = fingerprints(keyed(docs), window, k, short)
    screened = materialize(
        seen.join(wanted, F.col("print") == F.col("wanted"), "left").groupBy("doc_id", "text_hash").agg(
            F.max("n_words").cast("long").alias("n_words"), F.count_if("head").alias("copies"),
            F.max(F.col("wanted").isNotNull()).alias("suspect")), "screened")
    runs = materialize(
        windows(items, [*short, window]).where(F.col("length") == F.least("n", F.lit(window)))
        .groupBy("length", "digest").agg(F.array_sort(F.collect_set("item_id")).alias("items")), "item_windows")
    return screened, runs


def hits(docs: DataFrame, screened: DataFrame, runs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text_hash, n_hit, items) of the documents that share a window with an item.

    A window brings the list of its items once, however often it occurs in a document.
    """
    lengths = [r["length"] for r in runs.select("length").distinct().orderBy("length").collect()] or [window]
    # Written by themselves: their size, not that of all documents, decides how texts are joined.
    suspects = materialize(screened.where("suspect").select("doc_id", "text_hash"), "suspects")
    found = windows(join_rows(keyed(docs), suspects, "left_semi"), lengths).join(runs, ["length", "digest"])
    return found.groupBy("doc_id", "text_hash").agg(
        F.collect_set(F.struct("start", "length")).alias("runs"), F.collect_set("items").alias("lists")
    ).select("doc_id", "text_hash", F.expr(_COVERED).alias("n_hit"),
             F.array_distinct(F.flatten("lists")).alias("items"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, k: int = K) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, items (ids of items found), contaminated.

    A null text has no words. Ids may repeat: a row is told by its id and text,
    and equal rows get equal results. Items without words match nothing; items
    that repeat an id count once; a null item_id is matched but not listed. An
    empty benchmark leaves every document clean, an empty ``docs`` gives no rows.
    Other columns are ignored.
    """
    screened, runs = screen(docs, benchmark, window, k)
    each = screened.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return join_rows(each, hits(docs, screened, runs, window), "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast(f"array<{dict(benchmark.dtypes)['item_id']}>")).alias("items"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))


def with_item_digest(found: DataFrame) -> DataFrame:
    """Item ids as their number and one digest: sorted as strings, comma-joined, SHA-256."""
    listed = F.array_join(F.array_sort(F.col("items").cast("array<string>")), ",")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(listed, 256).alias("items_sha256"), "contaminated")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, k: int = K) -> DataFrame:
    """Rows of ``docs`` that share no window with the benchmark; all columns stay."""
    screened, runs = screen(docs, benchmark, window, k)
    found = hits(docs, screened, runs, window).select(
        F.col("doc_id").alias("found_id"), F.col("text_hash").alias("found_hash"))
    same = docs["doc_id"].eqNullSafe(found["found_id"]) & (F.xxhash64(docs["text"]) == found["found_hash"])
    return docs.join(found, same, "left_anti")
