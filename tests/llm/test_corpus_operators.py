"""Operators over whole corpora, against brute force, round trips and awkward tables."""

import math
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from rows import EDGES

from serplens.llm import op03_jaccard_join as op3
from serplens.llm import op05_token_blocks as op5
from serplens.llm import op06_ppm as op6
from serplens.llm import op07_decontamination as op7
from serplens.llm import op10_mixing as mixing
from serplens.llm import registry, wordhash
from serplens.llm.components import connected_components

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
TINY = "/root/testdata/sf0.001"


def words_of(text):
    return (text or "").encode().translate(LOWER).split()


# --- word hashes --------------------------------------------------------------

def test_word_hashes_tell_words_apart():
    texts = ["Ab aB", None, "", " \t", "ab", "x\x0by\x0cz", "é É", "a" * 100_000, "ab ba"]
    seen = defaultdict(set)
    for first, raw, at in wordhash.slices(pa.array(texts), limit=16):
        hashes, bounds = wordhash.word_hashes(raw, at)
        for i in range(len(at) - 1):
            words = words_of(texts[first + i])
            found = hashes[bounds[i]:bounds[i + 1]].tolist()
            assert len(found) == len(words)
            for w, h in zip(words, found):
                seen[w].add(h)
    assert all(len(h) == 1 for h in seen.values()) and len({min(h) for h in seen.values()}) == len(seen)


# --- 3: Jaccard join ----------------------------------------------------------

def plain_classes(rows, k=5, num=75, den=100):
    sets = []
    for _, text in rows:
        w = words_of(text)
        sets.append(frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k
                    else frozenset([tuple(w)]) if w else frozenset())
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and den * both >= num * len(sets[i] | sets[j]):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {}
    for g, (doc, _), s in zip(group, rows, sets):
        if doc is not None and s:
            least[g] = min(doc, least.get(g, doc))
    return Counter((doc, len(s), least.get(g) if s else doc) for g, (doc, _), s in zip(group, rows, sets))


def check_classes(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in op3.jaccard_classes(docs).collect())
    assert got == plain_classes(rows)


def test_classes_of_edges(edges, nothing):
    check_classes(edges)
    assert op3.jaccard_classes(nothing).count() == 0
    assert op3.keep_one(edges).columns == edges.columns


def test_classes_near_the_threshold(spark):
    """Edited copies of a few texts: chains of links, near misses and a group of equal texts."""
    rng = np.random.default_rng(4)
    rows = []
    for base in range(4):
        words = [f"w{rng.integers(300)}" for _ in range(60 + 20 * base)]
        for _ in range(25):
            edited = list(words)
            for _ in range(rng.integers(0, 5)):
                edited[rng.integers(len(edited))] = f"w{rng.integers(300)}"
            rows.append((len(rows) + 7, " ".join(edited)))
    rows += [(500 + i, "Five words make one shingle") for i in range(30)] + [(600, "five words"), (601, "FIVE  words")]
    check_classes(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7))


def test_prefixes_lengthen_where_candidates_are_dear():
    rare, frequent = np.full(40, 2), np.full(40, 4000)
    assert op3.choose_matches(frequent, 40, 0, 75, 100)[0] >= op3.choose_matches(rare, 40, 0, 75, 100)[0]
    for dfs in (rare, frequent):
        matches, posted = op3.choose_matches(dfs, 40, 0, 75, 100)
        assert posted == 40 - 30 + matches


def test_python_sees_only_what_prefixes_may_hold(spark):
    many = 400
    rows = [(i, many + 10 * i, list(range(many)) + [1000 * (i + 1) + j for j in range(10 * i)]) for i in range(6)]
    sets = spark.createDataFrame(rows, "node bigint, n int, shingles array<bigint>")
    times = Counter(t for *_, s in rows for t in s)
    seen = {r["node"]: r for r in op3._rare_first(sets, 75, 100).collect()}
    profiles = {r["node"]: r for r in op3._profiles(sets, 75, 100).collect()}
    assert set(seen) == set(profiles) == set(range(6))
    for node, n, s in rows:
        shared = sorted((times[t], t) for t in s if times[t] > 1)
        r = seen[node]
        assert r["u"] == len(shared)
        assert len(r["token"]) <= n // 4 + op3.MAX_MATCHES  # of 400 or more
        whole = op3.choose_matches(np.array([d for d, _ in shared]), n, n - len(shared), 75, 100)
        assert (profiles[node]["u"], profiles[node]["l"]) == (len(shared), whole[0])
        assert profiles[node]["prefix"] == [t for _, t in shared[:whole[1]]]


def test_prefixes_of_short_texts_are_posted():
    """Every node with enough shared shingles for a link posts at least as many as it requires."""
    for n in range(1, 41):
        least = -(-75 * n // 100)
        for shared in range(n + 1):
            matches, posted = op3.choose_matches(np.full(shared, 2), n, n - shared, 75, 100)
            if shared < least:
                assert posted == 0
            else:
                assert 1 <= matches <= least and posted == shared - least + matches


def test_classes_of_short_edited_texts(spark):
    """Texts of 5 to 15 words with words of their own changed, added or dropped, mostly at an end."""
    rng = np.random.default_rng(5)
    rows = []
    for length in range(5, 16):
        for base in range(4):
            words = [f"s{length}x{base}x{i}" for i in range(length)]
            rows.append((len(rows), " ".join(words)))
            own = f"own{len(rows)}"
            edits = (words[:-1] + [own], words + [own], [own] + words[1:], words[1:], [own] + words + [own + "b"])
            for i in rng.permutation(len(edits))[:1 + base]:
                rows.append((len(rows), " ".join(edits[i])))
    check_classes(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5))


def test_components(spark):
    links = [(1, 2), (2, 3), (5, 4), (6, 6), (None, 1), (9, 8), (8, 7), (7, 9)] + [(100 + i, 101 + i) for i in range(40)]
    got = dict(connected_components(spark.createDataFrame(links, "a bigint, b bigint")).distinct().collect())
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 7: 7, 8: 7, 9: 7} | {100 + i: 100 for i in range(41)}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_components_that_are_stars_take_no_round(spark):
    """Of links that are stars already only the surroundings are looked at; a path takes rounds until it is one."""
    def found(links):
        spark.sparkContext.setJobGroup(f"components of {len(links)}", "")
        got = connected_components(spark.createDataFrame(links, "a bigint, b bigint"))
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"components of {len(links)}"))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return jobs, sorted(map(tuple, got.collect()))

    stars = [(i, 7 * j) for j in range(1, 5) for i in range(100 * j, 100 * j + 20)]
    few, labels = found(stars + stars)
    assert labels == sorted([(7 * j, 7 * j) for j in range(1, 5)] + stars)
    more, labels = found([(i, i + 1) for i in range(30)] + [(40, 42), (41, 42), (40, 41)])
    assert labels == [(i, 0) for i in range(31)] + [(i, 40) for i in (40, 41, 42)]
    assert 0 < few <= 6 < more


def test_components_against_union_by_search(spark):
    rng = np.random.default_rng(3)
    links = [tuple(map(int, rng.integers(-200, 200, 2))) for _ in range(220)]
    label = {n: n for x in links for n in x if x[0] != x[1]}
    for _ in label:
        for a, b in links:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    got = connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    assert len(got) == len(label) and dict(map(tuple, got)) == label


def test_jaccard_join_goes_on_from_the_components_of_its_hubs(spark, monkeypatch):
    """The second search takes a link from each node to its label, not the first one's links again."""
    seen = []

    def noted(links):
        seen.append({tuple(r) for r in links.where("a <> b").collect()})
        return connected_components(links)

    monkeypatch.setattr(op3, "connected_components", noted)
    words = [f"w{i}" for i in range(120)]
    docs = [(i, " ".join([*words, *[f"x{i}y{j}" for j in range(i % 4)]])) for i in range(1, 13)]
    got = op3.jaccard_classes(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    assert [r["component_id"] for r in got] == [1] * 12
    first, second = seen
    # Ten sets, as 4, 8 and 12 have the same one.
    nodes = {n for link in first for n in link}
    assert len(nodes) == 10 and second == {(n, min(nodes)) for n in nodes if n != min(nodes)} != first


# --- 5: token blocks ----------------------------------------------------------

@pytest.mark.parametrize("counts, max_bits", [
    ([5], 16), ([1, 1], 16), ([2 ** i for i in range(30)], 16), ([2 ** i for i in range(30)], 6), ([7] * 256, 8), ([1] * 300, 4)])
def test_code_is_complete_and_short_enough(counts, max_bits):
    lengths = op5.code_lengths(np.array(counts), max_bits)
    limit = max(max_bits, (len(counts) - 1).bit_length())
    assert lengths.max() <= limit and lengths.min() >= 1
    assert len(counts) == 1 or sum(2.0 ** -lengths) == 1
    order = np.argsort(counts, kind="stable")
    assert all(np.diff(lengths[order]) <= 0)


def test_code_is_optimal_without_a_limit():
    import heapq
    rng = np.random.default_rng(1)
    counts = rng.integers(1, 1000, 50)
    heap, cost = [(int(c), i) for i, c in enumerate(counts)], 0
    heapq.heapify(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        cost += a[0] + b[0]
        heapq.heappush(heap, (a[0] + b[0], len(heap) + 100))
    assert int((op5.code_lengths(counts, 40) * counts).sum()) == cost


@pytest.mark.parametrize("n", [1, 2, 255, 256, 257, 5000])
def test_blocks_round_trip(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.geometric(0.01, n), 700)
    kinds, counts = np.unique(ids, return_counts=True)
    code = op5.Code(kinds, op5.code_lengths(counts, 12))
    payload, checkpoints = code.encode(ids)
    assert len(checkpoints) == -(-n // op5.INTERVAL)
    assert code.decode(payload, checkpoints, n).tolist() == ids.tolist()


def test_words_get_the_tokenizers_ids():
    from tokenizers import Tokenizer
    path = registry.tokenizer_file()
    whole, own = Tokenizer.from_file(path), op5.word_tokenizer(path, "<u4")
    texts = ["", "It's ISN'T we'LL 'S ''s don't--x", "<|endoftext|> Hi", "a<|endoftext|>b", "İstanbul ΑΣ ÀÖØÞ ×÷ ß ﬁ ² ½ é́x",
             " y z​", "中文 日本語 😀 a😀b", "t\tn\nv\x0bf\x0cr\rx\x1cg\x1d\x1f\x85", "$$$ a_b-c 12345 v1.2", "\x00a\x7f"]
    for text in texts:
        assert np.frombuffer(own.ids(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids
    assert own.by_words


def test_slices_of_texts_get_the_tokenizers_ids(monkeypatch):
    """Over several slices, with a memory that overflows, and without one for a file of other rules."""
    import public_tokenizers
    from tokenizers import Tokenizer
    monkeypatch.setattr(op5, "REMEMBERED", 40)
    rng = np.random.default_rng(8)
    letters = list("abAB'1 ²é中😀.$\n\t ")
    texts = [None, "", " ", "<|endoftext|>", "a<|b"] + ["".join(rng.choice(letters, rng.integers(0, 60))) for _ in range(300)]
    for name, by_words in (("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)):
        path = public_tokenizers.path(name)
        whole, own = Tokenizer.from_file(path), op5.word_tokenizer(path, "<u4")
        assert own.by_words == by_words
        with monkeypatch.context() as patch:
            patch.setattr(wordhash.slices, "__defaults__", (500,))
            got = [x for _, part in own.slices(pa.array(texts), 7) for x in part.to_pylist()]
        assert [np.frombuffer(x, "<u4").tolist() for x in got] == [
            whole.encode(t or "", add_special_tokens=False).ids + [7] for t in texts]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_files_give_the_documents_back(spark, sample, edges, nothing, tmp_path, name):
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path(name)
    whole = Tokenizer.from_file(path)
    docs = sample.select("doc_id", "text").unionByName(edges.select("doc_id", "text"))
    op5.write_tokens(docs, str(tmp_path / "t"), path, block_ids=5000)
    got = op5.read_tokens(spark, str(tmp_path / "t")).withColumn("crc", F.crc32("ids")).collect()
    want = Counter()
    for doc, text in docs.collect():
        ids = whole.encode(text or "", add_special_tokens=False).ids + [op5.END_ID]
        want[doc, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["crc"]) for r in got) == want
    got.sort(key=lambda r: r["start"])
    assert [r["start"] for r in got] == np.cumsum([0, *(r["n_tokens"] for r in got)])[:-1].tolist()
    order = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in got]
    assert order == sorted(order)
    assert op5.encoded_roundtrip(nothing, path).count() == 0


# --- 6: language model --------------------------------------------------------

def test_scores_against_brute_force(spark, sample, edges):
    docs = sample.select("doc_id", "text").where("doc_id < 60").unionByName(
        edges.where("length(text) < 1000 OR text IS NULL").select("doc_id", "text"))
    rows = docs.collect()
    words, strings, k = Counter(), [defaultdict(Counter) for _ in range(op6.ORDER + 1)], op6.ORDER

    def line(text):
        return [op6.START] * k + list((text or "").encode().translate(LOWER)) + [op6.END]

    for doc, text in rows:
        if not op6.held_out(doc):
            words.update(words_of(text))
            words["end"] += 1
            y = line(text)
            for i in range(k, len(y)):
                for order in range(k + 1):
                    strings[order][tuple(y[i - order:i])][y[i]] += 1
    total, kinds = sum(words.values()), len(words)

    def score(text):
        y, out = line(text), 0.0
        for i in range(k, len(y)):
            excluded, found = set(), False
            for order in range(k, -1, -1):
                seen = strings[order].get(tuple(y[i - order:i]))
                if not seen:
                    continue
                left = {s: c for s, c in seen.items() if s not in excluded}
                if y[i] in left:
                    out += math.log10(left[y[i]] / (sum(left.values()) + len(left)))
                    found = True
                    break
                if left:
                    out += math.log10(len(left) / (sum(left.values()) + len(left)))
                excluded = set(seen)
            if not found:
                out -= math.log10(257 - len(excluded))
        return out

    want = Counter()
    for doc, text in rows:
        tokens = [*words_of(text), "end"]
        base = sum(math.log10((words[w] + 1) / (total + kinds + 1)) for w in tokens)
        want[doc, op6.held_out(doc), len(tokens), sum(words[w] > 0 for w in tokens), total, round(base, 5), round(score(text), 5)] += 1
    got = op6.ppm_scores(docs, chunk_bytes=20_000).collect()
    assert Counter((*r[:5], round(r["base_score"], 5), round(r["score"], 5)) for r in got) == want


def test_scores_of_edges(edges, nothing, spark):
    assert op6.ppm_scores(nothing).count() == 0
    assert op6.ppm_scores(edges).count() == len(EDGES)
    none = spark.createDataFrame([(3, "abc"), (3, None)], "doc_id bigint, text string")
    only = [d for d in range(200) if op6.held_out(d)][0]
    got = {r["n_tokens"]: r for r in op6.ppm_scores(none.withColumn("doc_id", F.lit(only).cast("bigint"))).collect()}
    # Nothing to learn from: 257 equally likely bytes.
    assert got[2]["score"] == pytest.approx(-4 * math.log10(257)) and got[1]["score"] == pytest.approx(-math.log10(257))
    assert got[2]["train_tokens"] == 0 and got[2]["n_known"] == 0


def test_held_out_texts_of_the_corpus_beat_noise(spark, sample):
    import random
    rng = random.Random(1)
    noise = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(400)) for _ in range(40)]
    extra = spark.createDataFrame([(10_000 + i, t) for i, t in enumerate(noise)], "doc_id bigint, text string")
    scored = op6.ppm_scores(sample.select("doc_id", "text").unionByName(extra)).where("held_out").collect()
    size = {r["doc_id"]: len(r["text"]) + 1 for r in sample.collect()} | {10_000 + i: 401 for i in range(40)}
    per_byte = {r["doc_id"]: r["score"] / size[r["doc_id"]] for r in scored}
    assert max(v for d, v in per_byte.items() if d >= 10_000) < np.median([v for d, v in per_byte.items() if d < 10_000])


# --- 7: decontamination -------------------------------------------------------

PATTERN = re.compile(op7.WORD)


def plain_hits(docs, items):
    def words(text):
        return PATTERN.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))

    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        n = min(len(w), 10)
        for i in range(len(w) - n + 1):
            if n:
                windows[tuple(w[i:i + n])].add(item)
    lengths = {len(w) for w in windows}
    out = Counter()
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if (items_here := windows.get(tuple(w[i:i + n]))):
                    hit.update(range(i, i + n))
                    found |= items_here
        out[doc, len(w), len(hit), tuple(sorted(i for i in found if i is not None)), bool(hit)] += 1
    return out


@pytest.mark.parametrize("short", [False, True])
def test_hits_against_brute_force(spark, sample, edges, short):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{TINY}/benchmark.parquet").collect()]
    items += [(900, "THREE four, five six seven eight nine ten eleven twelve thirteen"), (900, "Gamma delta passage0 of"),
              (901, None), (902, "--"), (None, "Alpha beta passage0 of common words passage1 of common words")]
    if short:
        items += [(903, "short text"), (904, "naïve"), (905, "one two three four five six seven")]
    else:
        items = [i for i in items if i[1] != "Gamma delta passage0 of"]
    docs = sample.select("doc_id", "text").unionByName(edges.select("doc_id", "text"))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = op7.contamination(docs, bench).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(sorted(r["items"])), r["contaminated"]) for r in got) \
        == plain_hits(docs.collect(), items)
    kept = op7.drop_contaminated(docs, bench)
    assert kept.count() == sum(not r["contaminated"] for r in got)


def test_common_passages_bring_their_items_once(spark):
    """A passage of many items, many times in one text, and rows that repeat."""
    passage = " ".join(f"p{i}" for i in range(12))
    items = [(i, f"{passage} own{i}") for i in range(60)] + [(i, f"head{i} {passage}") for i in range(50, 90)]
    text = " and then ".join([passage] * 200)
    docs = [(1, text), (1, text), (2, "nothing of it " * 20), (2, passage), (None, passage), (3, None)]
    got = op7.contamination(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3),
                            spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(sorted(r["items"])), r["contaminated"]) for r in got) \
        == plain_hits(docs, items)


def test_long_texts_are_cut_in_linear_time(spark):
    """Two million words in one text, as op 7 and op 10 cut them."""
    docs = spark.range(1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("some Words here\n"), 700_000).alias("text"))
    begun = time.monotonic()
    row = docs.select(F.size(op7.words(F.col("text"))).alias("a"), mixing.word_count(F.col("text")).alias("b")).first()
    assert (row["a"], row["b"]) == (2_100_000, 2_100_000)
    assert time.monotonic() - begun < 60


def test_every_long_shared_span_is_found(spark):
    """Spans of exactly a window at every offset, in texts that share nothing else."""
    item = [f"b{i}" for i in range(40)]
    docs = [(i, " ".join([f"x{j}" for j in range(i)] + item[i:i + 10] + [f"y{j}" for j in range(5)])) for i in range(31)]
    docs += [(100 + i, " ".join(item[i:i + 9])) for i in range(31)]
    got = op7.contamination(spark.createDataFrame(docs, "doc_id bigint, text string"),
                            spark.createDataFrame([(1, " ".join(item))], "item_id bigint, text string")).collect()
    assert {r["doc_id"]: r["n_hit"] for r in got} == {i: 10 for i in range(31)} | {100 + i: 0 for i in range(31)}


def test_decontamination_edges(spark, edges, nothing):
    bench = spark.createDataFrame([], "item_id bigint, text string")
    assert not any(r["contaminated"] for r in op7.with_item_digest(op7.contamination(edges, bench)).collect())
    assert op7.contamination(nothing, spark.read.parquet(f"{TINY}/benchmark.parquet")).count() == 0
    assert op7.drop_contaminated(edges, bench).count() == len(EDGES)


# --- 10: mixing ---------------------------------------------------------------

def test_targets_are_filled_up_by_weight(spark):
    sizes = {"a": 1000, "b": 10, "c": 500, "d": 0, None: 2000}
    rows = spark.createDataFrame([(str(k), k, v) for k, v in sizes.items()], "src string, source string, source_size bigint")
    got = {r["src"]: r["target"] for r in mixing.source_targets(rows).collect()}
    weights = {"a": 1, "b": 2, "c": 3, "d": 1, "None": 2}
    capped: set[str] = set()
    while True:
        rest = sum(sizes.values()) - sum(3 * (sizes[k if k != "None" else None]) for k in capped)
        free = sum(w for k, w in weights.items() if k not in capped)
        targets = {k: 3 * sizes[k if k != "None" else None] if k in capped else rest * w / free for k, w in weights.items()}
        over = {k for k in targets if k not in capped and targets[k] > 3 * sizes[k if k != "None" else None]}
        if not over:
            break
        capped |= over
    assert got == pytest.approx(targets)


def test_mix_is_exact_and_repeats(edges, nothing, sample):
    for docs in (edges, sample):
        sized = docs.withColumn("size", mixing.word_count(F.col("text")))
        rows = mixing.mix(sized).collect()
        assert len(rows) == docs.count()
        by_source = defaultdict(lambda: [0, 0, None])
        for r in rows:
            assert r["size"] == len(words_of(r["text"])) and 0 <= r["taken"] <= 3 * r["size"]
            entry = by_source[r["source"]]
            entry[0] += r["taken"]
            entry[1] += r["size"]
            entry[2] = r["target"]
        for taken, size, target in by_source.values():
            assert taken == math.floor(target) and target <= 3 * size
        again = Counter((r["doc_id"], r["taken"]) for r in mixing.mix(sized.repartition(5)).collect())
        assert again == Counter((r["doc_id"], r["taken"]) for r in rows)
        mixed = mixing.repeat_taken(mixing.mix(sized))
        total = sum(len(words_of(r["text"])) for r in mixed.select("text").collect())
        assert total == sum(r["taken"] for r in rows)
    assert mixing.mix(nothing.withColumn("size", F.lit(1).cast("long"))).count() == 0


def test_part_of_a_document_keeps_its_white_space(spark):
    row = spark.createDataFrame([(1, " a\tb  c\nd ", "s", 10, 4, 4, 6.0, 6)],
                                "doc_id bigint, text string, source string, n_chars bigint, size bigint, source_size bigint, target double, taken bigint")
    got = sorted((r["text"], r["n_chars"]) for r in mixing.repeat_taken(row).collect())
    assert got == [(" a\tb", 4), (" a\tb  c\nd ", 10)]


# --- oracles and pipeline -----------------------------------------------------

@pytest.mark.parametrize("key", sorted(registry.ORACLES))
def test_matches_oracle(spark, tiny, key):
    from oracle_check import compare, connect
    assert compare(spark, connect(tiny), tiny, registry.QUERIES[key], registry.ORACLES[key]) == ""


def test_pipeline_stage_by_stage(spark):
    import corpus_pipeline
    from serplens.sources.storage import materialize

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, stages = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        stages.append(materialize(stage(spark, stages[-1], folder), "stage"))
    raw, good, single, clean, mixed, encoded = stages
    assert all(s.columns == columns for s in stages[:-1])
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in good.collect()}
    assert all(labels.get(d, 1) == 1 for d in kept)
    # One of each class, by brute force; no window of the benchmark; words as the mix says.
    rows = [(r["doc_id"], r["text"]) for r in good.collect()]
    assert Counter(d for d, _ in (r[:2] for r in single.collect())) == Counter(
        {d: n for (d, _, c), n in plain_classes(rows).items() if d == c})
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    hit = {d for (d, _, _, _, bad), _ in plain_hits([(r["doc_id"], r["text"]) for r in single.collect()], items).items() if bad}
    assert {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in single.collect()} - hit
    sizes = sum(len(words_of(r["text"])) for r in clean.collect())
    sources = clean.select("source").distinct().count()
    assert sizes - sources <= sum(len(words_of(r["text"])) for r in mixed.collect()) <= sizes
    assert encoded.count() == mixed.count()
