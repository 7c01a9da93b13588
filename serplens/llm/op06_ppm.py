"""Language-model scores by prediction by partial matching (PPM), pretrained on the corpus.

The model is a trie of byte contexts up to ``ORDER`` bytes. A byte is coded in its
longest context; if that has not seen the byte, an escape (method C: as likely as
the context's number of distinct bytes) leads to the context one byte shorter, in
which the bytes already ruled out are excluded. Below order 0 all bytes not yet
excluded are equally likely. Texts are lower-cased (A-Z), preceded by a start byte
and closed by an end byte that UTF-8 does not use.

Every count follows from the counts of ``ORDER + 1`` byte strings, and a byte's
probability from the string that ends with it. So the corpus is cut into chunks of
texts; each chunk lists its distinct strings and words with their training counts;
these lists, summed, are the model, and joined with it they return to their chunk,
where every byte's and word's score is one look-up. Lists grow with the input;
nothing of them passes through the driver or a broadcast. Contexts of up to one
byte are bounded tables.

Words are told by 64-bit hashes: among ``v`` distinct words, two fall together
with a chance of about ``v**2 / 4e19``.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from serplens.llm import wordhash
from serplens.sources.storage import materialize

ORDER = 3
START, END = 0xFE, 0xFF
#: Bytes of text per chunk.
CHUNK_BYTES = 8 << 20
#: Documents whose crc32 of the id, as text, leaves this remainder are not learnt from.
FOLDS, HELD_OUT_FOLD = 7, 2

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def held_out(doc_id) -> bool:
    """Whether a document is kept from training; a null id counts as an empty text."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS == HELD_OUT_FOLD


class Strings:
    """The strings of ``ORDER + 1`` bytes of some texts: one per byte and per end of text."""

    def __init__(self, texts: pa.Array):
        parts, lengths = [], []
        for _, raw, at in wordhash.slices(texts):
            for a, b in zip(at, at[1:]):
                parts += (np.full(ORDER, START, np.uint8), _LOWER[raw[a:b]], np.array([END], np.uint8))
                lengths.append(int(b - a) + 1)
        line = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
        # Of each text, the start bytes have no string of their own.
        ends = np.ones(len(line), dtype=bool)
        firsts = np.cumsum([0, *(n + ORDER for n in lengths)])[:-1]
        for j in range(ORDER):
            ends[firsts + j] = False
        codes = np.zeros(len(line), np.uint32)
        for j in range(ORDER + 1):
            codes[j:] |= line[:len(line) - j].astype(np.uint32) << np.uint32(8 * j)
        codes = codes[ends]
        #: Distinct strings; per byte the index of its string; first byte of each text.
        self.distinct, self.of_byte = _dense_unique(codes)
        self.bounds = np.cumsum([0, *lengths])


def _dense_unique(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``np.unique`` with inverse, by marking instead of sorting: three bytes, then the fourth."""
    low = codes & np.uint32(0xFFFFFF)
    mark = np.zeros(1 << 24, dtype=bool)
    mark[low] = True
    lows = np.flatnonzero(mark)
    rank = np.zeros(1 << 24, dtype=np.int32)
    rank[lows] = np.arange(len(lows), dtype=np.int32)
    top = (codes >> np.uint32(24)).astype(np.uint8)
    high = np.flatnonzero(np.bincount(top, minlength=256))
    place_of = np.zeros(256, dtype=np.int64)
    place_of[high] = np.arange(len(high))
    pair = rank[low].astype(np.int64) * len(high) + place_of[top]
    seen = np.zeros(len(lows) * len(high), dtype=bool)
    seen[pair] = True
    pairs = np.flatnonzero(seen)
    place = np.zeros(len(seen), dtype=np.int32)
    place[pairs] = np.arange(len(pairs), dtype=np.int32)
    distinct = high[pairs % max(len(high), 1)].astype(np.int64) << 24 | lows[pairs // max(len(high), 1)]
    return distinct, place[pair]


def _text_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of some texts, and where each text's begin (one more at the end)."""
    hashes, bounds, done = [], [np.zeros(1, np.int64)], 0
    for _, raw, at in wordhash.slices(texts):
        words, starts = wordhash.word_hashes(raw, at)
        hashes.append(words)
        bounds.append(starts[1:] + done)
        done += len(words)
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)).view(np.int64), np.concatenate(bounds)


def _one(column: pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)


LISTED = "chunk bigint, kind int, item bigint, n bigint"


def _listing(table: pa.Table) -> pa.Table:
    """Distinct strings (kind 0) and words (kind 1) of a chunk with their training counts."""
    chunk, texts = table["chunk"][0].as_py(), _one(table["text"])
    learnt = np.array([not held_out(d) for d in table["doc_id"].to_pylist()], dtype=bool)
    strings = Strings(texts)
    words, bounds = _text_words(texts)
    distinct, of_word = np.unique(words, return_inverse=True)
    out = []
    for kind, items, index, starts in ((0, strings.distinct, strings.of_byte, strings.bounds),
                                       (1, distinct, of_word, bounds)):
        counted = index[np.repeat(learnt, np.diff(starts))]
        out.append((np.full(len(items), kind, np.int32), items, np.bincount(counted, minlength=len(items))))
    kinds, items, counts = (np.concatenate(c) for c in zip(*out))
    return pa.table({"chunk": pa.array(np.full(len(items), chunk, np.int64)), "kind": kinds, "item": items, "n": counts})


def _levels(strings: DataFrame) -> dict[int, DataFrame]:
    """Per length, the trained strings (g, c): the bytes' counts after one byte less of context."""
    levels, longest = {}, strings.where("c > 0").select(F.col("item").alias("g"), "c")
    for length in range(ORDER + 1, 0, -1):
        levels[length] = longest
        mask = (1 << 8 * (length - 1)) - 1
        longest = longest.groupBy(F.col("g").bitwiseAND(F.lit(mask)).alias("g")).agg(F.sum("c").alias("c"))
    return levels


def _contexts(levels: dict[int, DataFrame], order: int) -> DataFrame:
    """(ctx, t, d, x) of every context of ``order`` bytes: its total, its distinct bytes, and
    the total that these same bytes have in the context one byte shorter."""
    strings = levels[order + 1]
    if order:
        shorter = levels[order].select(F.col("g").alias("s"), F.col("c").alias("below"))
        strings = strings.withColumn("s", F.col("g").bitwiseAND(F.lit((1 << 8 * order) - 1))).join(shorter, "s")
    else:
        strings = strings.withColumn("below", F.lit(1))
    return strings.groupBy(F.shiftrightunsigned("g", 8).alias("ctx")).agg(
        F.sum("c").alias(f"t{order}"), F.count(F.lit(1)).alias(f"d{order}"), F.sum("below").alias(f"x{order}"))


def string_scores(strings: DataFrame) -> DataFrame:
    """(item, value): log10 probability of the last byte of every string (item, c: training count).

    Escapes multiply; a context that has not been seen is passed over. When a seen
    context is left, its bytes are excluded below: their share of the shorter
    context's total, ``x``, and their number, ``d``, are taken off there.
    """
    levels = _levels(strings)
    rows = strings.select("item", F.col("c").alias(f"c{ORDER}"))
    for order in range(ORDER, -1, -1):
        context = F.shiftrightunsigned(F.col("item").bitwiseAND(F.lit((1 << 8 * (order + 1)) - 1)), 8)
        table = _contexts(levels, order)
        rows = rows.withColumn("ctx", context)
        rows = rows.join(F.broadcast(table) if order < 2 else table, "ctx", "left").drop("ctx")
        if order < ORDER:
            counts = levels[order + 1].select(F.col("g").alias("tail"), F.col("c").alias(f"c{order}"))
            rows = rows.withColumn("tail", F.col("item").bitwiseAND(F.lit((1 << 8 * (order + 1)) - 1)))
            # Strings of up to two bytes: at most 65,792 rows.
            rows = rows.join(F.broadcast(counts) if order < 2 else counts, "tail", "left").drop("tail")
    columns = [f"{n}{k}" for k in range(ORDER + 1) for n in ("c", "t", "d", "x")]
    rows = rows.select("item", *[F.coalesce(c, F.lit(0)).cast("double").alias(c) for c in columns])
    score, escape, lost_t, lost_d = F.lit(None).cast("double"), F.lit(0.0), F.lit(0.0), F.lit(0.0)
    for k in range(ORDER, -1, -1):
        c, t, d, x = (F.col(f"{n}{k}") for n in ("c", "t", "d", "x"))
        total = (t - lost_t) + (d - lost_d)
        found = score.isNull() & (c > 0)
        score = F.when(found, escape + F.log10(c / total)).otherwise(score)
        escape = F.when((d > lost_d) & (total > 0), escape + F.log10((d - lost_d) / total)).otherwise(escape)
        lost_t, lost_d = F.when(d > 0, x).otherwise(F.lit(0.0)), F.when(d > 0, d).otherwise(F.lit(0.0))
        rows = rows.withColumns({f"score{k}": score, f"escape{k}": escape, f"lost_t{k}": lost_t, f"lost_d{k}": lost_d})
        score, escape, lost_t, lost_d = (F.col(f"{n}{k}") for n in ("score", "escape", "lost_t", "lost_d"))
    # All bytes and the end byte, but those excluded.
    last = escape - F.log10(F.greatest(F.lit(1.0), F.lit(257.0) - lost_d))
    return rows.select("item", F.coalesce(score, last).alias("value"))


SCORED = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
          "base_score double, score double")


def _scorer(train_tokens: int, train_words: int, train_docs: int):
    vocabulary = train_words + (train_docs > 0)
    room = train_tokens + vocabulary + 1

    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        texts, ids = _one(table["text"]), table["doc_id"].to_pylist()
        kinds, items, values = (answers[c].to_numpy() for c in ("kind", "item", "value"))
        strings = Strings(texts)
        words, bounds = _text_words(texts)
        found = []
        for kind, distinct in ((0, strings.distinct), (1, None)):
            of_kind = kinds == kind
            order = np.argsort(items[of_kind])
            found.append((items[of_kind][order], values[of_kind][order]))
        per_string = found[0][1][np.searchsorted(found[0][0], strings.distinct)]
        score = np.add.reduceat(per_string[strings.of_byte], strings.bounds[:-1])
        counts = found[1][1][np.searchsorted(found[1][0], words)] if len(words) else np.zeros(0)
        sums = np.concatenate(([0.0], np.cumsum(np.log10((counts + 1) / room))))
        known = np.concatenate(([0], np.cumsum(counts > 0)))
        end = np.log10((train_docs + 1) / room)
        return pa.table({
            "doc_id": pa.array(ids, pa.int64()),
            "held_out": pa.array([held_out(d) for d in ids], pa.bool_()),
            "n_tokens": np.diff(bounds) + 1,
            "n_known": known[bounds[1:]] - known[bounds[:-1]] + (train_docs > 0),
            "train_tokens": np.full(len(ids), train_tokens, np.int64),
            "base_score": sums[bounds[1:]] - sums[bounds[:-1]] + end,
            "score": score,
        })

    return run


def ppm_scores(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row of ``SCORED`` per row of ``docs`` (doc_id, text).

    ``score`` is the model's log10 probability of the lower-cased text and its end;
    ``base_score`` that of its words and one end token under add-one smoothing. A
    null text is empty: its end alone is scored. A null doc_id hashes as an empty
    text. Rows that repeat are learnt from and scored each. Without training
    documents all bytes are equally likely. An empty table gives no rows; other
    columns are ignored.
    """
    size = docs.agg(F.sum(F.octet_length("text")).alias("n"), F.count(F.lit(1)).alias("rows")).first()
    chunks = max(1, -(-(size["n"] or 0) // chunk_bytes), -(-size["rows"] // 65536))
    chunked = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).alias("chunk"))
    listed = materialize(chunked.groupBy("chunk").applyInArrow(_listing, LISTED), "chunk_items")
    totals = materialize(listed.groupBy("kind", "item").agg(F.sum("n").alias("c")), "item_counts")
    words = totals.where("kind = 1 AND c > 0").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("c"), F.lit(0)).alias("tokens")).first()
    # Every learnt document ends once.
    end_of_text = totals.where(f"kind = 0 AND (item & 255) = {END}").agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    scores = string_scores(totals.where("kind = 0").select("item", "c")).select(F.lit(0).alias("kind"), "item", "value")
    counts = totals.where("kind = 1").select("kind", "item", F.col("c").cast("double").alias("value"))
    answers = listed.select("chunk", "kind", "item").join(scores.unionByName(counts), ["kind", "item"]) \
        .select("chunk", "kind", "item", "value")
    run = _scorer(words["tokens"] + end_of_text, words["n"], end_of_text)
    return chunked.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(run, SCORED)
