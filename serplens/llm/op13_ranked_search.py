"""Ranked lexical search: exact top documents per item, by per-term geometric blocks.

A document's score is the sum of its impacts for an item's terms, each times the
term's weight. The search runs in three passes over sparse vectors of the documents:

1. Floor. Every item's rarest terms, up to ``SEED_DOCUMENTS`` documents of them, give
   documents that are scored exactly; the item's floor is the score of the last one
   that would be returned. No document below it can be.
2. Order. Vectors are range-partitioned by similarity: nearest and second nearest of
   ``CENTROIDS`` documents, then least term hash. So similar documents, near copies
   above all, stand next to each other in the posting lists of a task.
3. Search. In every task a term's posting list is cut into blocks of neighbouring
   documents. A block's summary is the largest impact of each coordinate in it, so
   summary times weights bounds the score of all its documents. A block is skipped
   only if that bound lies below the floor, and its documents are scored otherwise.
   A whole list is skipped for an item by the same rule: the terms of least weight
   times largest impact, while their sum lies below the floor, cannot lift a document
   to it on their own, and with another term it stands in that term's list.

Tasks return their best rows per item, a window picks the best of all. All quantities
are integers below 2**53, so sums in floating point are exact and skipping loses nothing.

Items are taken in blocks of at most about ``BLOCK_PAIRS`` pairs of item and term; only
these pairs, and numbers per term in them, reach the driver and the tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from serplens.llm import wordhash
from serplens.llm.tables import keyed
from serplens.sources.storage import materialize

TOP = 50
K1_PARTS, BASE, SLOPE = 20, 50, 50
UNIT = 1_000_000_000
#: Documents of an item's rarest terms that are scored for its floor, at least, if it has as many.
SEED_DOCUMENTS = 1000
BLOCK_PAIRS = 1 << 16
#: Documents that the order is made of, and places of their hashed vectors.
CENTROIDS, PROJECTED = 64, 1024
#: Documents in a block of a posting list.
BLOCK_DOCUMENTS = 16
#: Cells of a task's matrix of documents and terms.
CHUNK_CELLS = 1 << 23

_LETTERS = np.zeros(256, dtype=bool)
_LETTERS[48:58] = _LETTERS[65:91] = _LETTERS[97:123] = _LETTERS[128:] = True
_TABLE = wordhash.byte_table(_LETTERS)


def _lists(lengths: np.ndarray, flat: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(lengths))), pa.int32()), pa.array(flat))


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, item_key, term) of every distinct term of ``items`` (item_id, text); terms are 64-bit hashes."""
    kind = dict(items.dtypes)["item_id"]

    def run(batches):
        for batch in batches:
            for first, raw, at in wordhash.slices(batch.column(2)):
                words, bounds = wordhash.word_hashes(raw, at, table=_TABLE)
                found = [np.unique(words[a:b]) for a, b in zip(bounds, bounds[1:])]
                rows = pa.array(np.repeat(np.arange(len(found)) + first, [len(x) for x in found]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), batch.column(1).take(rows),
                     pa.array(np.concatenate(found).view(np.int64))], names=["item_id", "item_key", "term"])

    keys = items.select("item_id", F.xxhash64("item_id", "text").alias("item_key"), "text")
    return keys.mapInArrow(run, f"item_id {kind}, item_key bigint, term bigint").distinct()


def vectors(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """(doc_id, n, terms, tfs) per row of ``docs``.

    ``n`` counts all terms of the text, ``terms`` are places in the sorted ``vocabulary``.
    """
    vocabulary = np.sort(vocabulary.view(np.uint64))

    def run(batches):
        for batch in batches:
            for first, raw, at in wordhash.slices(batch.column(1)):
                words, bounds = wordhash.word_hashes(raw, at, table=_TABLE)
                place = np.minimum(np.searchsorted(vocabulary, words), len(vocabulary) - 1)
                known = np.flatnonzero(vocabulary[place] == words)
                row = np.searchsorted(bounds, known, side="right") - 1
                cells, tfs = np.unique(row * len(vocabulary) + place[known], return_counts=True)
                lengths = np.bincount(cells // len(vocabulary), minlength=len(at) - 1)
                terms = (cells % len(vocabulary)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(at) - 1), pa.array(np.diff(bounds)),
                     _lists(lengths, terms), _lists(lengths, tfs)], names=["doc_id", "n", "terms", "tfs"])

    return keyed(docs).select("doc_id", "text") \
        .mapInArrow(run, "doc_id bigint, n bigint, terms array<int>, tfs array<bigint>")


def impact(tf: str, length: str, count: int, total: int) -> str:
    """SQL of a term's impact in a document of ``length`` terms, of ``count`` with ``total`` terms."""
    m = f"({100 - BASE} + ({SLOPE} * {length} * {count}L) div {max(total, 1)}L)"
    return f"(({UNIT}L * {tf}) div (1000L * {tf} + {K1_PARTS}L * {m}))"


class Items:
    """A block of items over a vocabulary, with weights and floors."""

    def __init__(self, pairs: np.ndarray, vocabulary: np.ndarray, weights: np.ndarray, frequency: np.ndarray,
                 largest: np.ndarray):
        """``pairs``: item and term, both as places, in order of items."""
        self.weights, self.frequency, self.largest = weights, frequency, largest
        self.n, self.n_terms = int(pairs[:, 0].max(initial=-1)) + 1, len(vocabulary)
        cuts = np.flatnonzero(np.diff(pairs[:, 0])) + 1
        self.terms = np.split(pairs[:, 1], cuts) if len(pairs) else []
        self.floors = np.ones(self.n)

    def seeds(self, documents: int) -> list[tuple[int, np.ndarray]]:
        """(term, items) that start the search: each item's rarest terms, up to ``documents`` postings."""
        by_term: dict[int, list[int]] = {}
        for item, terms in enumerate(self.terms):
            rare = terms[np.argsort(self.frequency[terms], kind="stable")]
            rare = rare[self.frequency[rare] > 0]
            before = np.cumsum(self.frequency[rare]) - self.frequency[rare]
            for term in rare[before < documents].tolist():
                by_term.setdefault(term, []).append(item)
        return [(t, np.array(i)) for t, i in sorted(by_term.items())]

    def essential(self) -> list[tuple[int, np.ndarray]]:
        """(term, items) whose lists are searched: without these terms no document reaches the floor."""
        by_term: dict[int, list[int]] = {}
        for item, terms in enumerate(self.terms):
            most = self.weights[terms] * self.largest[terms]
            order = np.argsort(most, kind="stable")
            for term in terms[order][np.cumsum(most[order]) >= self.floors[item]].tolist():
                by_term.setdefault(term, []).append(item)
        return [(t, np.array(i)) for t, i in sorted(by_term.items())]

    def scores(self, item: int, matrix: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Exact scores of ``rows`` of a matrix of impacts."""
        terms = self.terms[item]
        return matrix[np.ix_(rows, terms)].astype(np.float64) @ self.weights[terms]


class Best:
    """The best rows per item so far, and floors that rise with them."""

    def __init__(self, items: Items, top: int):
        self.items, self.top = items, top
        self.floors = items.floors.copy()
        self.held: dict[int, list[tuple[float, int | None]]] = {}

    def add(self, item: int, scores: np.ndarray, docs: list) -> None:
        keep = np.flatnonzero(scores >= self.floors[item]).tolist()
        if not keep:
            return
        held = self.held.setdefault(item, [])
        held += [(scores[i], docs[i]) for i in keep]
        if len(held) > 4 * self.top:
            self._cut(item)

    def _cut(self, item: int) -> None:
        # Equal scores by ascending id, null ids last, as in the final order.
        held = sorted(self.held[item], key=lambda r: (-r[0], r[1] is None, r[1] or 0))[:self.top]
        self.held[item] = held
        if len(held) == self.top:
            self.floors[item] = max(self.floors[item], held[-1][0])

    def batch(self) -> pa.RecordBatch:
        for item in self.held:
            self._cut(item)
        rows = [(i, d, int(s)) for i, held in self.held.items() for s, d in held]
        columns = list(zip(*rows)) or [(), (), ()]
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())],
            names=["item", "doc_id", "score"])


def _chunks(batches: Iterator[pa.RecordBatch], n_terms: int):
    """(ids, matrix of impacts, rows, terms, clusters) of consecutive documents, bounded by ``CHUNK_CELLS``.

    Batches hold doc_id, terms, impacts and cluster.
    """
    most = max(1, CHUNK_CELLS // max(1, n_terms))

    def chunk(part: list[pa.RecordBatch]):
        table = pa.Table.from_batches(part).combine_chunks()
        terms = table.column(1).combine_chunks()
        lengths = np.diff(np.asarray(terms.offsets))
        rows = np.repeat(np.arange(len(terms)), lengths)
        at, values = np.asarray(terms.flatten()), np.asarray(table.column(2).combine_chunks().flatten())
        matrix = np.zeros((len(terms), n_terms), np.float32)
        matrix[rows, at] = values
        return table.column(0).to_pylist(), matrix, rows, at, np.asarray(table.column(3))

    held, size = [], 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, most - size)
            held.append(part)
            size, batch = size + part.num_rows, batch.slice(part.num_rows)
            if size == most:
                yield chunk(held)
                held, size = [], 0
    if held:
        yield chunk(held)


def _postings(rows: np.ndarray, terms: np.ndarray, n_terms: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows by term, and where each term's list begins; lists keep the order of rows."""
    order = np.argsort(terms, kind="stable")
    return rows[order], np.searchsorted(terms[order], np.arange(n_terms + 1))


RANKED = "item int, doc_id bigint, score bigint"


def _seed_scores(placed: DataFrame, items: Items, top: int) -> DataFrame:
    """Best exact scores per item among the documents of its rarest terms."""
    seeds = items.seeds(SEED_DOCUMENTS)

    def run(batches):
        best = Best(items, top)
        for ids, matrix, rows, terms, _ in _chunks(batches, items.n_terms):
            lists, starts = _postings(rows, terms, items.n_terms)
            wanted = np.zeros((len(ids), items.n), dtype=bool)
            for term, of in seeds:
                wanted[np.ix_(lists[starts[term]:starts[term + 1]], of)] = True
            _score(best, matrix, wanted, ids)
        yield best.batch()

    return placed.mapInArrow(run, RANKED)


def _score(best: Best, matrix: np.ndarray, wanted: np.ndarray, ids: list) -> None:
    for item in np.flatnonzero(wanted.any(axis=0)).tolist():
        rows = np.flatnonzero(wanted[:, item])
        best.add(item, best.items.scores(item, matrix, rows), [ids[r] for r in rows.tolist()])


def blocks_of(rows: np.ndarray, clusters: np.ndarray) -> np.ndarray:
    """Where the blocks of a posting list begin: at a new cluster, and after ``BLOCK_DOCUMENTS`` documents."""
    new = np.flatnonzero(np.diff(clusters[rows], prepend=clusters[rows[0]] - 1))
    place = np.arange(len(rows)) - np.repeat(new, np.diff(new, append=len(rows)))
    return np.flatnonzero(place % BLOCK_DOCUMENTS == 0)


def _search(placed: DataFrame, items: Items, top: int) -> DataFrame:
    """Best rows per item and task, by blocks of posting lists."""
    essential = [(term, of, np.unique(np.concatenate([items.terms[i] for i in of]))) for term, of in items.essential()]

    def run(batches):
        weights = []
        for _, of, coordinates in essential:
            w = np.zeros((len(coordinates), len(of)))
            for j, item in enumerate(of.tolist()):
                at = np.searchsorted(coordinates, items.terms[item])
                w[at, j] = items.weights[items.terms[item]]
            weights.append(w)
        best = Best(items, top)
        for ids, matrix, rows, terms, clusters in _chunks(batches, items.n_terms):
            lists, starts = _postings(rows, terms, items.n_terms)
            wanted = np.zeros((len(ids), items.n), dtype=bool)
            for (term, of, coordinates), w in zip(essential, weights):
                own = lists[starts[term]:starts[term + 1]]
                if len(own) == 0:
                    continue
                begins = blocks_of(own, clusters)
                summary = np.maximum.reduceat(matrix[np.ix_(own, coordinates)], begins, axis=0)
                reached = summary.astype(np.float64) @ w >= best.floors[of]
                if reached.any():
                    block, item = np.nonzero(np.repeat(reached, np.diff(begins, append=len(own)), axis=0))
                    wanted[own[block], of[item]] = True
            _score(best, matrix, wanted, ids)
        yield best.batch()

    return placed.mapInArrow(run, RANKED)


def _projection(rows: np.ndarray, terms: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Unit vectors of ``n`` documents, their terms hashed to ``PROJECTED`` places."""
    cells = rows * PROJECTED + (terms * 40503 % PROJECTED)
    flat = np.bincount(cells, weights=values, minlength=n * PROJECTED).reshape(n, PROJECTED).astype(np.float32)
    return flat / np.maximum(np.linalg.norm(flat, axis=1, keepdims=True), 1e-9)


def by_similarity(weighed: DataFrame, weights: np.ndarray) -> DataFrame:
    """``weighed`` (doc_id, terms, impacts) with ``cluster``, in order of similarity within and across partitions.

    The clusters grow around ``CENTROIDS`` distinct vectors, a bounded sample of least hash.
    """
    sample = weighed.select("terms", "impacts").orderBy(F.xxhash64("terms"), F.xxhash64("impacts")) \
        .limit(4 * CENTROIDS).distinct().orderBy(F.xxhash64("terms"), F.xxhash64("impacts")).limit(CENTROIDS).collect()
    centres = [_projection(np.zeros(len(r["terms"]), np.int64), np.array(r["terms"], np.int64),
                           np.array(r["impacts"]) * weights[r["terms"]], 1) for r in sample]
    centres = np.concatenate(centres) if centres else np.zeros((1, PROJECTED), np.float32)

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                part = batch.slice(i, 1024)
                lists = part.column(1)
                lengths = np.diff(np.asarray(lists.offsets))
                rows, terms = np.repeat(np.arange(len(lists)), lengths), np.asarray(lists.flatten()).astype(np.int64)
                values = np.asarray(part.column(2).flatten()) * weights[terms]
                near = _projection(rows, terms, values, len(lists)) @ centres.T
                first = near.argmax(axis=1)
                near[np.arange(len(near)), first] = -1
                starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
                least = np.minimum.reduceat(wordhash.mix(terms.astype(np.uint64)) >> np.uint64(24), starts)
                place = (near.argmax(axis=1).astype(np.int64) << 40) + least.astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(first.astype(np.int32)), pa.array(place)],
                    names=["doc_id", "terms", "impacts", "cluster", "place"])

    # Documents without a term of any item have been left out: no list is empty.
    order = ["cluster", "place", "doc_id"]
    return weighed.mapInArrow(run, "doc_id bigint, terms array<int>, impacts array<bigint>, cluster int, place bigint") \
        .repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "terms", "impacts", "cluster")


def _first_rows(found: DataFrame, top: int) -> DataFrame:
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(best)).where(f"rank <= {top}")


def _rank_block(docs: DataFrame, pairs: np.ndarray, vocabulary: np.ndarray, top: int) -> DataFrame:
    """(item, rank, doc_id, score) for one block; ``pairs`` of item and term by their places."""
    rows = materialize(vectors(docs, vocabulary), "vectors")
    count, total = rows.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    weighed = rows.where("size(terms) > 0").withColumn("impacts", F.expr(
        f"transform(tfs, t -> {impact('t', 'n', count, total)})")).select("doc_id", "terms", "impacts")
    frequency, largest = np.zeros(len(vocabulary), np.int64), np.zeros(len(vocabulary))
    # One row per term of the block's items.
    for r in weighed.select(F.explode_outer(F.arrays_zip("terms", "impacts")).alias("p")).groupBy("p.terms") \
            .agg(F.count(F.lit(1)).alias("df"), F.max("p.impacts").alias("most")).collect():
        frequency[r["terms"]], largest[r["terms"]] = r["df"], r["most"]
    weights = np.array([math.floor(1000 * math.log((2 * count + 2) / (2 * df + 1))) for df in frequency.tolist()], np.float64)
    items = Items(pairs, vocabulary, weights, frequency, largest)
    last = _first_rows(_seed_scores(weighed.withColumn("cluster", F.lit(0)), items, top), top)
    for r in last.where(f"rank = {top}").collect():
        items.floors[r["item"]] = r["score"]
    return _first_rows(_search(by_similarity(weighed, weights), items, top), top)


def _blocks(terms: DataFrame, limit: int) -> Iterator[DataFrame]:
    """The rows of ``terms`` in blocks of whole items, of about ``limit`` rows each."""
    n = -(-terms.count() // limit)
    for i in range(n):
        yield terms.where(F.pmod(F.col("item_key"), F.lit(n)) == i)


def ranked_search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of every item with a score above 0.

    ``docs`` (doc_id, text), ``items`` (item_id, text). A null text has no terms and is in
    no result. Equal scores come by ascending doc_id, null ids last; rows that repeat an
    id are ranked one by one. Items that repeat id and text count once, the same id with
    another text is ranked by itself. An item without a term, or of terms in no document,
    has no rows, and neither have empty tables. Texts are read whole, other columns ignored.
    """
    spark = docs.sparkSession
    kind = dict(items.dtypes)["item_id"]
    terms = materialize(item_terms(items), "item_terms")
    found = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id bigint, score bigint")
    for block in _blocks(terms, BLOCK_PAIRS):
        rows = block.orderBy("item_key", "item_id", "term").toPandas()
        if len(rows):
            found = found.unionByName(_ranked_items(spark, docs, rows, kind, top))
    return found


def _ranked_items(spark: SparkSession, docs: DataFrame, rows, kind: str, top: int) -> DataFrame:
    """Ranked documents of the items in ``rows`` (item_id, item_key, term)."""
    new = rows["item_key"].ne(rows["item_key"].shift()).to_numpy()
    vocabulary, place = np.unique(rows["term"].to_numpy(np.int64).view(np.uint64), return_inverse=True)
    pairs = np.column_stack((np.cumsum(new) - 1, place))
    ids = rows["item_id"][new].tolist()
    names = spark.createDataFrame([(i, None if x != x else x) for i, x in enumerate(ids)], f"item int, item_id {kind}")
    ranked = materialize(_rank_block(docs, pairs, vocabulary.view(np.int64), top), "ranked")
    # One row per item of the block.
    return ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
