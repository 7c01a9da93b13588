"""Substring dedup by hashing the parts of lines or paragraphs.

A text is cut into units: paragraphs, lines, or the sentences of its lines. Units
are normalised and hashed; over all documents, the occurrence with the smallest
(doc_id, place) is kept and any other is a repeat. Passages are pasted inside lines
too, and short sentences repeat by chance: so units are sentences, and repeats are
removed where they stand in a row of at least ``MIN_WORDS`` words.

Original offsets are kept throughout, in code points of the original text.
"""

from __future__ import annotations

import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from serplens.llm.tables import join_rows, keyed
from serplens.sources.storage import materialize

#: Words in a row that must repeat.
MIN_WORDS = 30
UNITS = {
    "paragraph": re.compile(r"(?:(?!\n[\x20\t\r]*\n)[\s\S])+"),
    "line": re.compile(r"[^\n]+"),
    # Up to a full stop, question or exclamation mark before white space, or the line's end.
    "sentence": re.compile(r"[^\n.?!]*+(?:[.?!]++(?![\x20\t\r\n])[^\n.?!]*+)*+[.?!]*+[\x20\t\r]*+"),
}


def units(text: str, unit: str) -> list[tuple[int, int, int, int]]:
    """(start, stop, words, digest) of the units with a word, in order."""
    found = []
    for m in UNITS[unit].finditer(text):
        words = m[0].encode().lower().split()
        if words:
            digest = xxhash.xxh3_64_intdigest(b" ".join(words)) - (1 << 63)
            found.append((m.start(), m.end(), len(words), digest))
    return found


def text_units(docs: DataFrame, unit: str) -> DataFrame:
    """(doc_id, text_hash, place, start, stop, words, digest) of every unit of every row."""
    names = ["doc_id", "text_hash", "place", "start", "stop", "words", "digest"]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64()]

    def run(batches):
        for batch in batches:
            rows = []
            for doc, text_hash, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                rows += [(doc, text_hash, i, *u) for i, u in enumerate(units(text or "", unit))]
                if len(rows) > 1 << 16:
                    yield _batch(rows, names, types)
                    rows = []
            if rows:
                yield _batch(rows, names, types)

    return keyed(docs).mapInArrow(run, "doc_id bigint, text_hash bigint, place int, start int, stop int, words int, digest bigint")


def _batch(rows, names, types):
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def repeats(found: DataFrame) -> DataFrame:
    """The units of ``found`` that are not the first of their digest, with their columns.

    Ranks are compared, not rows: rows that repeat both id and text are one
    document, and a null id comes after all others. The first occurrences are written,
    so that both sides of the join are plain shuffles, of which Spark deals a hot digest
    to several tasks; their aggregation combines it before it moves.
    """
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "place", "text_hash")
    first = found.groupBy("digest").agg(F.min(rank).alias("first"), F.max(rank).alias("last")) \
        .where("first < last").select("digest", "first")
    first = materialize(first, "first_units")
    return found.join(first, "digest").where(rank > F.col("first")).drop("first")


def repeated_runs(again: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, text_hash, removed): per document the runs of repeated units to remove, in order.

    ``removed`` is a list of struct (start, stop, units, words). Units whose places
    follow on one another make a run.
    """
    unit = F.struct("place", "start", "stop", "words")
    # The units of a document, walked in order: a run grows while places follow.
    runs = F.aggregate(
        F.array_sort(F.collect_set(unit)),
        F.array().cast("array<struct<start:int,stop:int,units:int,words:int,place:int>>"),
        lambda done, u: F.when(
            F.try_element_at(done, F.lit(-1))["place"] == u["place"] - 1,
            F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(F.struct(
                F.try_element_at(done, F.lit(-1))["start"].alias("start"), u["stop"].alias("stop"),
                (F.try_element_at(done, F.lit(-1))["units"] + 1).alias("units"),
                (F.try_element_at(done, F.lit(-1))["words"] + u["words"]).alias("words"), u["place"].alias("place"))))
        ).otherwise(F.concat(done, F.array(F.struct(
            u["start"].alias("start"), u["stop"].alias("stop"), F.lit(1).alias("units"), u["words"].alias("words"),
            u["place"].alias("place"))))))
    return again.groupBy("doc_id", "text_hash").agg(runs.alias("runs")).select(
        "doc_id", "text_hash", F.transform(F.filter("runs", lambda r: r["words"] >= min_words), lambda r: F.struct(
            r["start"].alias("start"), r["stop"].alias("stop"), r["units"].alias("units"), r["words"].alias("words"))
        ).alias("removed")).where(F.size("removed") > 0)


def dedup(docs: DataFrame, unit: str = "sentence", min_words: int = MIN_WORDS) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_removed, removed_words, removed, text.

    ``removed`` lists the removed stretches with their original offsets; ``text``
    is what is left. A null text stays null. Repeats inside one text go as well.
    Rows are told by id and text and equal rows get equal results. An empty table
    gives no rows; other columns are ignored.
    """
    found = materialize(text_units(docs, unit), "units")
    runs = materialize(repeated_runs(repeats(found), min_words), "repeats")

    def cut(batches):
        for batch in batches:
            texts = []
            for text, removed in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                at, kept = 0, []
                for r in removed or ():
                    kept.append(text[at:r["start"]])
                    at = r["stop"]
                texts.append(text if not removed else "".join(kept) + text[at:])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(texts, pa.string())],
                                             names=["doc_id", "removed", "text"])

    kind = "array<struct<start:int,stop:int,units:int,words:int>>"
    return join_rows(keyed(docs), runs, "left").select("doc_id", "text", F.coalesce("removed", F.array().cast(kind)).alias("removed")) \
        .mapInArrow(cut, f"doc_id bigint, removed {kind}, text string").select(
        "doc_id", F.size("removed").cast("long").alias("n_removed"),
        F.expr("aggregate(removed, 0L, (a, r) -> a + r.words)").alias("removed_words"), "removed", "text")
