"""Spot signatures, fill-in-middle and ranked search, against brute force and awkward tables."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from oracle_check import compare, connect
from pyspark.sql import functions as F
from rows import EDGES

from serplens.llm import op11_spot_signatures as op11
from serplens.llm import op12_fill_in_middle as op12
from serplens.llm import op13_ranked_search as op13
from serplens.llm import registry

TINY = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", ["op11_spot_signatures", "op12_fill_in_middle", "op13_ranked_search"])
def test_matches_sql(spark, key):
    assert compare(spark, connect(TINY), TINY, registry.QUERIES[key], registry.ORACLES[key]) == ""


# --- 11: spot signatures ------------------------------------------------------

WORD = re.compile("[぀-ヿ㐀-鿿]|[a-z0-9À-῿Ⰰ-ⷿꀀ-퟿]+")
FOLD = str.maketrans(op11.UPPER, op11.LOWER)


def plain_words(text):
    return WORD.findall((text or "").translate(FOLD))


def plain_anchors(texts):
    seen = Counter(w for t in texts for w in set(plain_words(t)))
    known = [w for w in seen if len(w) <= op11.ANCHOR_CHARS]
    best = sorted(known, key=lambda w: (-seen[w], w.encode()))
    return set(best[:min(op11.ANCHORS, len(known) // op11.ANCHOR_SHARE)])


def plain_prints(text, anchors, chain=3, spacing=1):
    words = plain_words(text)
    found, behind = set(), []
    for i, word in [(-1, ""), *enumerate(words)]:
        if i < 0 or word in anchors:
            behind = [w for w in words[i + 1:] if w not in anchors][::spacing][:chain]
            if behind:
                found.add(hashlib.md5(" ".join([word, *behind]).encode()).hexdigest()[:op11.DIGITS])
    return sorted(found)


def plain_likeness(a, b):
    a, b = set(a), set(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints_of_edges(spark, edges, nothing):
    texts = [t for _, t, _ in EDGES]
    anchors = plain_anchors(texts)
    assert set(op11.common_words(edges)) == anchors
    few = {"the", "of", "two", "word5", "和"}
    for chain, spacing in ((3, 1), (2, 2)):
        got = {(r["text"], tuple(r["fingerprint"])) for r in op11.fingerprints(edges, sorted(few), chain, spacing).collect()}
        short = [t for t in texts if t is None or len(t) < 1000]
        assert {(t, tuple(plain_prints(t, few, chain, spacing))) for t in short} <= got
        assert {t for t, _ in got} == set(texts)
    assert op11.common_words(nothing) == []
    assert op11.compared_with_edits(nothing).count() == 0


def test_next_rows_and_edits_of_edges(edges):
    got = Counter((r["doc_id"], r["n_chars"], r["edited"]) for r in op11.compared_with_edits(edges).collect())
    hashes = {r["text"]: r["h"] for r in edges.select(
        F.coalesce("text", F.lit("")).alias("text"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()}
    rows = sorted(((d, t or "") for d, t, _ in EDGES), key=lambda r: (r[0] is None, -(r[0] or 0), hashes[r[1]]))
    want = Counter()
    for i, (doc, text) in enumerate(rows):
        half = len(text) // 2
        want[doc, len(text), text[:len(text) - half] + rows[(i + 1) % len(rows)][1][:half]] += 1
    assert got == want


def test_a_hot_id_is_split_between_ranges(spark):
    docs = spark.createDataFrame([(None if i % 3 == 0 else 5 if i % 3 == 1 else i, f"text {i} the of common")
                                  for i in range(1500)], "doc_id bigint, text string").repartition(7)
    found = op11.with_next(docs, ["the", "of"]).select("doc_id", "text", "text_hash", "next_text").collect()
    rows = sorted(found, key=lambda r: (r["doc_id"] is None, -(r["doc_id"] or 0), r["text_hash"]))
    assert [r["next_text"] for r in rows] == [r["text"] for r in rows[1:] + rows[:1]]
    numbered = docs.select("doc_id", F.xxhash64("text").alias("text_hash"))
    sizes = numbered.groupBy(op11._range_of(numbered, 64)).count().toPandas()["count"]
    assert sizes.max() < 150


def test_one_row_is_its_own_next(edges):
    row = op11.compared_with_edits(edges.where("doc_id = 7")).collect()
    assert [(r["doc_id"], r["n_chars"], r["edited"], r["near_next"]) for r in row] == [(7, 10, "shortshort", 1.0)]


def test_similar_finds_every_pair(spark):
    rng = np.random.default_rng(11)
    rows = []
    for base in range(12):
        words = [f"w{rng.integers(60)}" for _ in range(40 + 30 * base)]
        for copy in range(8):
            edited = list(words)
            for _ in range(copy):
                edited[rng.integers(len(edited))] = f"w{rng.integers(60)}"
            rows.append((len(rows), " ".join(edited)))
    rows += [(200, ""), (201, None), (300, rows[3][1]), (400, rows[3][1])]
    prints = op11.fingerprints(spark.createDataFrame(rows, "doc_id bigint, text string"),
                               [f"w{i}" for i in range(12)]).select("doc_id", "fingerprint").cache()
    queries = prints.where("doc_id % 10 = 0")
    sets = {r["doc_id"]: r["fingerprint"] for r in prints.collect()}
    for least in (0.75, 0.5):
        got = {(r["query_id"], r["doc_id"]): r["likeness"] for r in op11.similar(queries, prints, least).collect()}
        want = {(q, d): plain_likeness(sets[q], sets[d]) for q in sets if q % 10 == 0 for d in sets
                if sets[q] and sets[d] and plain_likeness(sets[q], sets[d]) >= least}
        assert got == want and len(want) > 30


def test_sizes_beyond_the_bound_are_pruned(spark):
    rows = spark.createDataFrame([([1, 2, 3, 4], [1, 2, 3]), ([1, 2, 3, 4], [1, 2]), ([], []), ([], [1])], "a array<int>, b array<int>")
    assert [r[0] for r in rows.select(op11.likeness(F.col("a"), F.col("b"), 0.75)).collect()] == [0.75, 0, 1, 0]
    assert [r[0] for r in rows.select(op11.likeness(F.col("a"), F.col("b"))).collect()] == [0.75, 0.5, 1, 0]


# --- 12: fill-in-middle -------------------------------------------------------

def test_wavelet_matrix_counts_and_finds():
    rng = np.random.default_rng(12)
    for n in (0, 1, 63, 64, 65, 1000):
        classes = rng.integers(0, 8, n).astype(np.uint8)
        index = op12.WaveletMatrix(classes)
        at = np.arange(n + 1)
        for kind in range(8):
            assert index.rank(kind, at).tolist() == [int((classes[:i] == kind).sum()) for i in at]
        kinds = (0, 5)
        ends = np.flatnonzero(np.isin(classes, kinds)) + 1
        wanted = np.arange(1, len(ends) + 2)
        found = index.reach(kinds, wanted, np.zeros(len(wanted), np.int64), np.full(len(wanted), n))
        assert found.tolist() == [*ends.tolist(), n]


UNITS = {"line": "[^\n]*\n|[^\n]+", "sentence": "[^\n.!?。！？]*[\n.!?。！？]|[^\n.!?。！？]+",
         "word": "[^ \t-\r]*[ \t-\r]|[^ \t-\r]+", "character": "(?s)."}


def plain_middle(doc, text, unit, rate, spm_rate):
    text = text or ""
    digest = hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    units = re.findall(UNITS[unit], text)
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return doc, len(units), "plain", None, None, text
    if h[3] % 100 < spm_rate:
        return doc, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("unit", sorted(UNITS))
def test_fill_in_middle_of_edges(spark, edges, nothing, unit):
    more = [(20, "a <P> b\nc"), (21, "x<S\n<S"), (22, "<M\n>\n"), (23, "\n\n\n"), (24, "one\r\ntwo\r\n"), (25, "a。b！c")]
    docs = edges.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id bigint, text string"))
    made = op12.fill_in_middle(docs, unit, rate=80, spm_rate=40)
    texts = [(d, t) for d, t, _ in EDGES] + more
    got = Counter(tuple(r) for r in made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output").collect())
    assert got == Counter(plain_middle(d, t, unit, 80, 40) for d, t in texts)
    rebuilt = Counter((r[0], r[1]) for r in made.select("doc_id", op12.restored(F.col("output"), F.col("form"))).collect())
    assert rebuilt == Counter((d, t or "") for d, t in texts)
    assert op12.fill_in_middle(nothing, unit).count() == 0


# --- 13: ranked search --------------------------------------------------------

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def plain_terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_search(docs, items, top):
    counted = [(d, Counter(plain_terms(t))) for d, t in docs]
    n_docs, total = sum(bool(c) for _, c in counted), sum(c.total() for _, c in counted)
    lists = defaultdict(list)
    for i, (_, c) in enumerate(counted):
        for term, tf in c.items():
            m = 100 - 50 + (50 * c.total() * n_docs) // total
            lists[term].append((i, (1_000_000_000 * tf) // (1000 * tf + 20 * m)))
    found = Counter()
    for item, text in set(items):
        scores = Counter()
        for term in set(plain_terms(text)):
            if lists[term]:
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * len(lists[term]) + 1)))
                for i, x in lists[term]:
                    scores[i] += w * x
        best = sorted(((-s, docs[i][0] is None, docs[i][0] or 0) for i, s in scores.items() if s > 0))[:top]
        found.update((item, r + 1, None if null else d, -s) for r, (s, null, d) in enumerate(best))
    return found


def check_search(spark, docs, rows, items, top):
    listed = spark.createDataFrame(items, "item_id string, text string") if items else \
        spark.createDataFrame([], "item_id string, text string")
    found = op13.ranked_search(docs, listed.withColumn("term", F.lit(1)), top)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(tuple(r) for r in found.collect()) == plain_search(rows, items, top)


def test_search_of_edges(spark, edges, nothing):
    rows = [(d, t) for d, t, _ in EDGES]
    items = [("a", "ONE two three, seven"), ("a", "ONE two three, seven"), ("a", "short id"), (None, "passage3 common words"),
             ("b", None), ("c", "..."), ("d", "nowhere-to-be-found"), ("e", LONG_ITEM), ("f", "中文 текст naïve")]
    check_search(spark, edges, rows, items, 3)
    check_search(spark, edges, rows, [], 5)
    check_search(spark, nothing, [], items, 5)


LONG_ITEM = " ".join(f"word{i}" for i in range(900)) + " the"


def test_search_with_small_blocks_and_groups_of_copies(spark, monkeypatch):
    """Chunks, blocks and item blocks of a few rows, terms in every document, equal scores."""
    for name, value in (("CHUNK_CELLS", 4000), ("BLOCK_DOCUMENTS", 3), ("BLOCK_PAIRS", 90), ("SEED_DOCUMENTS", 5), ("CENTROIDS", 4)):
        monkeypatch.setattr(op13, name, value)
    rng = np.random.default_rng(13)
    vocabulary = [f"t{i}" for i in range(150)]
    shares = 1 / np.arange(1, 151)
    texts = [" ".join(rng.choice(vocabulary, rng.integers(1, 60), p=shares / shares.sum())) for _ in range(250)]
    texts += [texts[0]] * 120 + [f"{texts[1]} extra{i % 9}" for i in range(120)]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    items = [(f"q{i}", " ".join(rng.choice(vocabulary, 8))) for i in range(20)] + [("copies", texts[0]), ("near", texts[1])]
    check_search(spark, docs, rows, items, 30)


def test_blocks_end_with_clusters():
    clusters = np.array([0] * 20 + [1] * 3 + [4] * 40)
    rows = np.array([0, 1, 2, 18, 19, 20, 22, *range(23, 60)])
    begins = op13.blocks_of(rows, clusters)
    assert begins[0] == 0
    for block in np.split(rows, begins[1:]):
        assert len(block) <= op13.BLOCK_DOCUMENTS and len(set(clusters[block])) == 1
