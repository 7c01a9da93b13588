"""N-gram Jaccard join with adaptive multi-match prefixes.

Two texts link when ``den * |A & B| >= num * |A | B|`` for their sets of ``k``-word
shingles. The join finds every component of linked texts without listing the
pairs inside a group of copies:

1. Texts with equal sets are one *node*.
2. Screen. A linked node has at least ``num/den`` of its shingles in common with
   another. Among the shingles with a small hash (the same share of them for all
   texts), those found in one node only are counted; too many exclude the node.
   Most texts end here, on one shuffle of part of their hashes.
3. Prefixes. Shingles of the remaining nodes are ordered rare first. Two linked
   nodes share at least ``l`` shingles of their prefixes of length
   ``n - ceil(n * num/den) + l``, for the smaller ``l`` of both. Each node takes
   the ``l`` with the least estimated cost: prefix entries to scan, plus the
   candidates that can hold ``l`` matches times the cost of verifying one; ``l``
   is at most the least overlap ``ceil(n * num/den)``.
   Shingles that no other node has come first and need not be posted; their
   number also bounds the overlap with any partner.
4. Stars. The most typical node of each posting list is its hub. Nodes are
   verified against their best hubs and the links found are contracted.
5. Remainder. All pairs across different components are formed that share a
   shingle early enough to be the first match of a link; of these, the pairs with
   ``l`` matches in their lengthened prefixes are verified. So no link between
   components is lost.

Node ids are 64-bit hashes of whole sets: among ``d`` distinct texts two of them
fall together with a chance of about ``d**2 / 4e19``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from serplens.llm import wordhash
from serplens.llm.components import connected_components
from serplens.llm.tables import join_rows, keyed
from serplens.sources.storage import let_go, materialize, release

#: Share of all shingle hashes that the screen looks at; it must exceed ``1 - num/den``.
#: At 0.4 a node stays if three in eight of them occur in another.
SCREEN_SHARE = 0.4
MAX_MATCHES = 8
HUBS_PER_NODE = 3
#: Verifying a candidate costs about this many posting entries per shingle of the node.
VERIFY_COST = 0.05
#: Pages of 4 KB in the bitmap that keeps most texts out of a shuffle.
BITMAP_PAGES = 2048
#: What a posting says of its node.
POSTED = ("node", "n", "u", "pos")


def node_of(shingles: np.ndarray) -> int:
    """Signed 64-bit id of a sorted set of hashes."""
    return xxhash.xxh3_64_intdigest(shingles.tobytes(), seed=len(shingles)) - (1 << 63)


def _ragged(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)], dtype=np.int32)
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def _batches(rows: Iterator[tuple], names: list[str], types: list, weigh: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """Record batches of rows whose last value is an array, closed at ``weigh`` elements."""
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += len(row[-1]) + 16
        if weight >= weigh:
            yield _batch(held, names, types)
            held, weight = [], 0
    if held:
        yield _batch(held, names, types)


def _batch(held: list[tuple], names: list[str], types: list) -> pa.RecordBatch:
    *plain, arrays = zip(*held)
    columns = [pa.array(c, t) for c, t in zip(plain, types)]
    return pa.RecordBatch.from_arrays([*columns, _ragged(list(arrays))], names=names)


def signatures(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, text_hash, node, n) per row."""
    def run(batches):
        for batch in batches:
            found = [(node_of(s), len(s)) for _, s in wordhash.shingle_sets(batch.column(2), k)]
            nodes, sizes = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int32())],
                names=["doc_id", "text_hash", "node", "n"])

    return keyed(docs).mapInArrow(run, "doc_id bigint, text_hash bigint, node bigint, n int")


def _screened(docs: DataFrame, k: int, share: float) -> DataFrame:
    """(token, node) of every shingle whose hash is among the smallest ``share`` of all."""
    bound = np.uint64(int(share * (1 << 64)))

    def run(batches):
        for batch in batches:
            tokens, nodes, held = [], [], 0
            for row, s in wordhash.shingle_sets(batch.column(0), k):
                tokens.append(s[:int(np.searchsorted(s, bound))].view(np.int64))
                nodes.append(np.full(len(tokens[-1]), node_of(s), np.int64))
                held += len(tokens[-1])
                if held >= 1 << 19 or row == batch.num_rows - 1:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(tokens)), pa.array(np.concatenate(nodes))], names=["token", "node"])
                    tokens, nodes, held = [], [], 0

    return docs.select("text").mapInArrow(run, "token bigint, node bigint")


def _survivors(docs: DataFrame, signed: DataFrame, k: int, num: int, den: int, share: float) -> DataFrame:
    """(node, doc_id, text_hash): one row of each node that may link with another."""
    alone = (
        _screened(docs, k, share)
        .groupBy("token").agg(F.min("node").alias("node"), F.max("node").alias("other"))
        .where("node = other").groupBy("node").agg(F.count(F.lit(1)).alias("alone"))
    )
    nodes = signed.where("n > 0").groupBy("node").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("row"), F.first("n").alias("n"))
    return nodes.join(alone, "node", "left").where(
        f"{den} * (n - coalesce(alone, 0)) >= {num} * n").select("node", "row.*")


def _in_bitmap(rows: DataFrame, wanted: DataFrame, column: str) -> DataFrame:
    """The ``rows`` whose ``column``, a hash, may be in ``wanted``, told before they are shuffled.

    A bitmap of ``BITMAP_PAGES`` pages of 32,768 bits each, 4 KB, so its size is
    fixed and it may be broadcast. The fuller it is, the more rows pass in vain.
    """
    bit = F.expr(f"pmod({column}, {BITMAP_PAGES * 32768}L)")
    pages = wanted.select(bit.alias("bit")).groupBy(F.expr("bit div 32768").alias("page")) \
        .agg(F.bitmap_construct_agg(F.expr("bit % 32768")).alias("bits"))
    octet = F.expr("int(conv(hex(substring(bits, int(bit % 32768 div 8) + 1, 1)), 16, 10))")
    return rows.withColumn("bit", bit).withColumn("page", F.expr("bit div 32768")) \
        .join(F.broadcast(pages), "page") \
        .where(F.getbit(octet, F.expr("int(bit % 8)")) == 1).drop("bit", "page", "bits")


def _rows_of(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """The ``rows`` (doc_id, text_hash, ...) that stand for ``nodes``, of which each names another row.

    An inner join: the optimizer would push a semi-join below the bitmap, and shuffle all texts.
    """
    return join_rows(_in_bitmap(rows, nodes, "text_hash"), nodes.select("doc_id", "text_hash"), "inner")


def _sets(docs: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """(node, n, shingles) of ``nodes``, read from their whole texts.

    Rows that repeat both id and text give the same node again.
    """
    def run(batches):
        for batch in batches:
            rows = ((node_of(s), len(s), s.view(np.int64)) for _, s in wordhash.shingle_sets(batch.column(0), k))
            yield from _batches(rows, ["node", "n", "shingles"], [pa.int64(), pa.int32()])

    return _rows_of(keyed(docs), nodes).select("text").mapInArrow(run, "node bigint, n int, shingles array<bigint>")


def choose_matches(dfs: np.ndarray, n: int, unique: int, num: int, den: int) -> tuple[int, int]:
    """(matches required, shared shingles to post) for one node.

    ``dfs`` are the frequencies of its shingles that other nodes have, rare first;
    ``unique`` more shingles come before them. The first ``base + MAX_MATCHES`` of them do.
    """
    least = -(-num * n // den)
    base = n - least - unique
    if base < 0:
        # Fewer shared shingles than any link takes: no partner can be found, at no cost.
        return 1, 0
    best = None
    # Any link takes ``least`` shared shingles, so up to that many matches may be
    # required, and there are always as many to post.
    for matches in range(1, min(MAX_MATCHES, least) + 1):
        posted = base + matches
        scanned = float(dfs[:posted].sum())
        cost = scanned + scanned / matches * VERIFY_COST * n
        if best is None or cost < best[0]:
            best = (cost, matches, posted)
    return best[1], best[2]


def _rare_first(sets: DataFrame, num: int, den: int) -> DataFrame:
    """(node, n, u, df, token) of the nodes that may still link: of their ``u`` shared shingles the rarest.

    These are as many as a prefix may hold, about a quarter of the set, so that batches
    for Python stay small.
    """
    tokens = sets.select("node", "n", F.explode("shingles").alias("token"))
    shared = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    longest = f"int(size(s) - ({num}L * n + {den - 1}) div {den} + {MAX_MATCHES})"
    return _in_bitmap(tokens, shared, "token").join(shared, "token").groupBy("node").agg(
        F.first("n").alias("n"), F.sort_array(F.collect_set(F.struct("df", "token"))).alias("s")
    ).where(f"{den} * size(s) >= {num} * n") \
        .selectExpr("node", "n", "size(s) AS u", f"slice(s, 1, {longest}) AS s") \
        .select("node", "n", "u", "s.df", "s.token")


def _profiles(sets: DataFrame, num: int, den: int) -> DataFrame:
    """(node, n, u, l, prefix) of the nodes that may still link.

    ``u`` shingles are shared, ``l`` matches are required; the ``n - u`` unshared
    ones come before the prefix to post. A node that is there twice counts twice in
    frequencies: these only order shingles, and set bounds that may be too wide.
    """
    def run(batches):
        for batch in batches:
            dfs, tokens = batch.column(3), batch.column(4)

            def rows():
                for i, (node, n, u) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(3)))):
                    matches, posted = choose_matches(np.asarray(dfs[i].values), n, n - u, num, den)
                    yield node, n, u, matches, np.asarray(tokens[i].values)[:posted]

            yield from _batches(rows(), ["node", "n", "u", "l", "prefix"],
                                [pa.int64(), pa.int32(), pa.int32(), pa.int32()])

    return _rare_first(sets, num, den).mapInArrow(run, "node bigint, n int, u int, l int, prefix array<bigint>")


def _postings(profiles: DataFrame) -> DataFrame:
    """One row per posted shingle, with its place in the node's whole order."""
    return profiles.select("node", "n", "u", F.posexplode("prefix").alias("pos", "token")) \
        .withColumn("pos", F.col("pos") + F.col("n") - F.col("u"))


def _fits(a: str, b: str, num: int, den: int) -> str:
    """Whether a match of two nodes may be the first of a link.

    A link takes an overlap of ``o`` shingles, known from both sizes. Then ``l``
    matches lie in the prefixes of lengths ``n - o + l`` already, for every ``l``,
    the first of them for ``l = 1``. These are shorter than the posted prefixes,
    most of all for texts of equal size.
    """
    overlap = _overlap(a, b, num, den)
    return (f"{den} * least({a}n, {b}n) >= {num} * greatest({a}n, {b}n) AND "
            f"least({a}u, {b}u) >= {overlap} AND "
            f"{a}pos <= {a}n - {overlap} AND {b}pos <= {b}n - {overlap}")


def _overlap(a: str, b: str, num: int, den: int) -> str:
    """Shingles that two nodes must share to link."""
    return f"(({num} * ({a}n + {b}n) + {num + den - 1}) div {num + den})"


def _enough_matches(pairs: DataFrame, profiles: DataFrame, num: int, den: int) -> DataFrame:
    """The (a, b) that share the smaller ``l`` of both in prefixes lengthened for it."""
    def side(c):
        return profiles.select(F.col("node").alias(c), *[
            F.col(x).alias(f"{c}_{x}") for x in ("n", "u", "l", "prefix")])

    both = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")
    reach = f"{_overlap('a_', 'b_', num, den)} - least(a_l, b_l)"
    return both.where(F.expr(
        f"size(array_intersect(slice(a_prefix, 1, greatest(0, a_u - ({reach}))), "
        f"slice(b_prefix, 1, greatest(0, b_u - ({reach}))))) >= least(a_l, b_l)")).select("a", "b")


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The (a, b) of ``pairs`` whose sets link."""
    def side(c):
        return _in_bitmap(sets.select(F.col("node").alias(c), F.col("shingles").alias(f"s{c}")), pairs, c)

    def run(batches):
        for batch in batches:
            sa, sb = batch.column(2), batch.column(3)
            keep = []
            for i in range(batch.num_rows):
                x, y = np.asarray(sa[i].values), np.asarray(sb[i].values)
                both = len(x) + len(y) - len(np.unique(np.concatenate((x, y))))
                keep.append(den * both >= num * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b") \
        .select("a", "b", "sa", "sb").mapInArrow(run, "a bigint, b bigint")


def _star_pairs(postings: DataFrame, num: int, den: int) -> DataFrame:
    """Each node with the hubs that it shares most prefix shingles with."""
    hubs = postings.groupBy("token").agg(
        F.max(F.struct((F.col("u") / F.col("n")).alias("typical"), *POSTED)).alias("h"),
        F.count(F.lit(1)).alias("c"),
    ).where("c > 1").select("token", "h")
    best = Window.partitionBy("a").orderBy(F.desc("c"), "b")
    return postings.join(hubs, "token").where(f"node <> h.node AND {_fits('', 'h.', num, den)}") \
        .groupBy(F.col("node").alias("a"), F.col("h.node").alias("b")).agg(F.count(F.lit(1)).alias("c")) \
        .withColumn("r", F.row_number().over(best)).where(f"r <= {HUBS_PER_NODE}").select("a", "b")


def _remaining_pairs(postings: DataFrame, labels: DataFrame, num: int, den: int) -> DataFrame:
    """All candidate pairs between different components.

    In each posting list the nodes outside its most frequent component meet all
    nodes of other components; pairs inside a component are never formed.
    """
    placed = postings.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    placed = materialize(placed, "postings")
    parts = placed.groupBy("token", "label").agg(F.count(F.lit(1)).alias("c")) \
        .groupBy("token").agg(F.max(F.struct("c", "label")).alias("top"), F.count(F.lit(1)).alias("parts")) \
        .where("parts > 1").select("token", F.col("top.label").alias("main"))
    mixed = placed.join(parts, "token")
    few = mixed.where("label <> main").select(
        "token", *[F.col(c).alias(f"a_{c}") for c in (*POSTED, "label")])
    everyone = mixed.select("token", "main", *[F.col(c).alias(f"b_{c}") for c in (*POSTED, "label")])
    return few.join(everyone, "token").where(
        "a_label <> b_label AND (b_label = main OR a_node < b_node) AND " + _fits("a_", "b_", num, den)
    ).select(F.col("a_node").alias("a"), F.col("b_node").alias("b")).distinct()


def jaccard_classes(docs: DataFrame, k: int = 5, num: int = 75, den: int = 100) -> DataFrame:
    """(doc_id, n_shingles, node, component_id) for every row of ``docs`` (doc_id, text).

    ``component_id`` is the smallest doc_id reachable by links. A null, empty or
    white-space text has no shingles, links with nothing and is its own component
    (two such rows as well); a text of fewer than ``k`` words has one shingle, the
    whole. Equal texts, and rows that repeat an id, share a node and get a row
    each. A null doc_id takes part and never wins as the smallest. Other columns
    are ignored, an empty table gives no rows.
    """
    share = max(SCREEN_SHARE, min(0.99, 1.5 * (1 - num / den)))
    signed = materialize(signatures(docs, k), "signatures")
    survivors = materialize(_survivors(docs, signed, k, num, den, share), "survivors")
    sets = materialize(_sets(docs, survivors, k), "shingle_sets")
    release(survivors)
    let_go(docs.sparkSession)
    profiles = materialize(_profiles(sets, num, den), "prefixes")
    let_go(docs.sparkSession)
    postings = _postings(profiles)

    def links(pairs):
        found = materialize(_verified(pairs, sets, num, den), "links")
        release(pairs)
        let_go(docs.sparkSession)
        return found

    near = links(materialize(_star_pairs(postings, num, den), "star_pairs"))
    contracted = connected_components(near)
    other = materialize(_remaining_pairs(postings, contracted, num, den), "other_pairs")
    far = links(materialize(_enough_matches(other, profiles, num, den), "other_pairs"))
    release(other, profiles, sets)
    labels = connected_components(contracted.selectExpr("node AS a", "label AS b").unionByName(far))

    classes = signed.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("class_id"))
    labelled = classes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    lowest = labelled.groupBy("label").agg(F.min("class_id").alias("component_id"))
    found = labelled.join(lowest, "label").select("node", "class_id", "component_id")
    return signed.select("doc_id", F.col("n").cast("long").alias("n_shingles"), "node").join(
        found, "node", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(F.col("n_shingles") > 0, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
    )


def keep_one(docs: DataFrame, k: int = 5, num: int = 75, den: int = 100) -> DataFrame:
    """Rows of ``docs`` without those whose component has a smaller doc_id; all columns stay.

    Rows that repeat the kept id stay all; rows without an id stay.
    """
    dropped = jaccard_classes(docs, k, num, den).where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti")
