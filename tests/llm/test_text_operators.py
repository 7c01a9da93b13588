"""Operators on single texts and on lines, against brute force, and on awkward tables."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from serplens.llm import op01_substring_dedup as op1
from serplens.llm import op02_disclosure as op2
from serplens.llm import op04_secret_scan as op4
from serplens.llm import op08_site_spread as op8
from serplens.llm import op09_line_labels as op9

from rows import EDGES, PASSAGE

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_text(df):
    """Rows by (doc_id, text): results of equal rows must be equal."""
    return {(r["doc_id"], r["text"]): r for r in df.collect()}


# --- 1: substring dedup -------------------------------------------------------

def test_repeated_passage_goes_and_offsets_stay(edges):
    got = {r["doc_id"]: r for r in op1.dedup(edges).where("doc_id IN (9, 10)").collect()}
    assert got[9]["n_removed"] == 0
    (run,) = got[10]["removed"]
    text = dict((d, t) for d, t, _ in EDGES if d)[10]
    assert text[run["start"]:run["stop"]].strip() == PASSAGE and run["words"] == len(PASSAGE.split())
    assert got[10]["text"] == "Gamma delta. " + text[run["stop"]:]


def test_dedup_edges(edges, nothing):
    assert op1.dedup(nothing).count() == 0
    rows = op1.dedup(edges).collect()
    assert len(rows) == len(EDGES)
    assert sum(r["text"] is None for r in rows) == 2
    # Rows 1 and 1 repeat id and text, both stay; document 2 has too few words in a row.
    assert all(r["n_removed"] == 0 for r in rows if r["doc_id"] in (1, 2))


def test_dedup_against_brute_force(sample):
    rows = [(r["doc_id"], r["text"]) for r in sample.collect()]
    first, found = {}, {i: op1.units(t, "sentence") for i, t in sorted(rows)}
    for i in found:
        for j, u in enumerate(found[i]):
            first.setdefault(u[3], (i, j))
    got = {r["doc_id"]: r for r in op1.dedup(sample).collect()}
    for i, text in rows:
        again = [first[u[3]] != (i, j) for j, u in enumerate(found[i])]
        words = Counter()
        run = 0
        for j, u in enumerate(found[i]):
            run += j > 0 and again[j] and not again[j - 1]
            words[run] += u[2] * again[j]
        assert got[i]["removed_words"] == sum(w for w in words.values() if w >= op1.MIN_WORDS)


@pytest.mark.parametrize("unit, expected", [
    ("line", ["a b. c d", "e"]), ("paragraph", ["a b. c d", "e"]), ("sentence", ["a b.", "c d", "e"])])
def test_units(unit, expected):
    text = "a b. c d\n \ne"
    assert [text[s:e].strip() for s, e, _, _ in op1.units(text, unit)] == expected


# --- 2: personal data ---------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_entities(text):
    """The patterns as they stand, each match tested afterwards."""
    found = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            odd = [int(d) for d in digits[::-1][0::2]]
            even = [sum(divmod(2 * int(d), 10)) for d in digits[::-1][1::2]]
            if {"email": True, "ip": all(len(p.lstrip("0")) < 4 and int(p[-4:]) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                    "card": 13 <= len(digits) <= 19 and (sum(odd) + sum(even)) % 10 == 0,
                    "phone": 9 <= len(digits) <= 15}[kind]:
                found.append((list(PATTERNS).index(kind), *m.span()))
    return found


@pytest.mark.parametrize("text", [
    "a@b.c_d@e.f a@b.c@d.e x@y @z.q a.b@-.-", "1.2.3.4.5 256.1.1.1 1.2.3 01.002.3.255 1.2.3.999 9.9.9.9",
    "4111 1111 1111 1111, 4111-1111-1111-1112 5410008907924160 1 2 3", "+1 (437) 555-0689 ++49 30 1234567 +12",
    "+1 437 555 0689 me@x.org 10.0.0.1", "é@b.c 中a@b.cd é1.2.3.4", "", "@", "+", "1" * 5000 + ".1.1.1"])
def test_entities_are_those_of_the_plain_patterns(text):
    assert [e[:3] for e in op2.entities(text)] == plain_entities(text)


def test_terms_that_disclose_an_entity(spark):
    texts = [f"report {i} by Zyx Quux at zyx.quux@corp.org about item{i} of the month" for i in range(4)]
    texts += [f"the report of the month about something by someone number {i}" for i in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = op2.scan(docs)
    got = {r["doc_id"]: r for r in found.where("doc_id < 5").collect()}
    for i in range(4):
        flagged = {texts[i][s["start"]:s["stop"]]: s["action"] for s in got[i]["terms"]}
        assert flagged.get("Zyx") == flagged.get("Quux") == "remove" and "the" not in flagged and "month" not in flagged
    assert got[4]["terms"] == []
    clean = {r["doc_id"]: r["text"] for r in op2.sanitise(docs, found).collect()}
    assert "quux" not in clean[0].lower() and "[EMAIL]" in clean[0] and clean[50] == texts[50]


def test_terms_are_treated_wherever_they_stand(spark):
    texts = [f"Quuxley wrote to quux@corp.org about the matter of the day {i}" for i in range(6)]
    texts += ["the matter of the day goes on and on for a while here and there, said Quuxley in the end",
              "é中😀 Quuxley\u00e9 or Quuxley", *(f"the matter of the day was about number {i}" for i in range(300))]
    # Copies add no text, so they change no share.
    docs = spark.createDataFrame(list(enumerate(texts)) + [(9000 + i, texts[0]) for i in range(50)], "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in op2.scan(docs).collect()}
    for i in (0, 5, 6, 7, 9001):
        text = texts[i] if i < 9000 else texts[0]
        assert "Quuxley" in {text[t["start"]:t["stop"]] for t in got[i]["terms"]}, i
    assert [t["start"] for t in got[7]["terms"]] == [texts[7].rindex("Quuxley")]
    assert got[8]["terms"] == [] and len(got) == len(texts) + 50


def test_shares_against_brute_force(spark):
    pick = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)] + ["the"] * 40
    texts = []
    for i in range(160):
        words = pick.choices(vocabulary, k=pick.randint(5, 30))
        if i % 4 == 0:
            who = pick.randrange(8)
            at = pick.randrange(len(words) + 1)
            words[at:at] = [f"name{who}", f"mail{who}@corp.org", f"unit{who // 2}"]
        if i % 11 == 0:
            words.append(f"name{pick.randrange(8)}")
        texts.append(" ".join(words))
    texts += texts[:30]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = op2.materialize(op2.find_entities(docs), "found")
    pairs = op2.materialize(op2.candidate_pairs(found, docs), "pairs")
    uses = op2.materialize(op2.occurrences(docs, pairs), "uses")
    got = {(r["entity"], r["term"]): r["share"] for r in op2.disclosing_terms(found, pairs, uses).collect()}

    distinct = sorted(set(texts))
    held = {t: ({f"email:{w}" for w in t.split() if "@" in w}, {w for w in t.split() if "@" not in w}) for t in distinct}
    near = set()
    for t in distinct:
        words = t.split()
        for i, w in enumerate(words):
            if "@" in w:
                near |= {(f"email:{w}", v) for v in words[max(0, i - op2.NEAR):i + 1 + op2.NEAR] if "@" not in v}
    expected = {}
    for entity, term in near:
        n_e = sum(entity in e for e, _ in held.values())
        n_t = sum(term in w for _, w in held.values())
        both = sum(entity in e and term in w for e, w in held.values())
        p, z2 = both / n_t, op2.Z ** 2
        low = (p + z2 / (2 * n_t) - op2.Z * math.sqrt(p * (1 - p) / n_t + z2 / (4 * n_t ** 2))) / (1 + z2 / n_t)
        if low >= op2.CERTAIN:
            share = 1 + math.log2(low) / math.log2(len(distinct) / n_e)
            if share >= op2.GENERALISE:
                expected[entity, term] = share
    assert expected and got.keys() == expected.keys()
    assert all(math.isclose(got[k], v, rel_tol=1e-9) for k, v in expected.items())


def test_disclosure_edges(edges, nothing):
    assert op2.with_span_digest(op2.scan(nothing)).count() == 0
    rows = op2.with_span_digest(op2.scan(edges)).collect()
    assert len(rows) == len(EDGES)
    assert sum(r["n_email"] for r in rows) == 1
    assert sum(r["spans"] == "" for r in rows) == len(EDGES) - 1
    assert all(r["base_sha256"] == hashlib.sha256(b"").hexdigest() for r in rows if r["spans"] == "")


def test_sanitised_texts_of_repeated_ids(spark, edges, nothing):
    assert op2.sanitised_scan(nothing).count() == 0
    texts = ["write to a.b@corp.org or call", "nothing here", "call +49 123 456 789 now", "", None]
    rows = [(1, texts[0]), (1, texts[0]), (1, texts[1]), (2, texts[0]), (1, texts[2]), (None, texts[2]), (3, ""), (4, None)]
    others = [(100 + i, f"now or here is something to write {i}") for i in range(30)]
    docs = spark.createDataFrame(rows + others, "doc_id bigint, text string")
    got = op2.sanitised_scan(docs.withColumn("terms", F.lit(1))).collect()
    assert len(got) == len(rows) + 30
    clean = [r["sanitised"] for r in got if r["sanitised"] is not None]
    assert sorted(c.count("[EMAIL]") for c in clean) == [0, 0, 1, 1, 1] and sum("[PHONE]" in c for c in clean) == 2
    assert not any("corp.org" in c or "123" in c for c in clean)
    assert all(r["sanitised"] is None for r in got if not r["spans"])
    assert len(op2.sanitised_scan(edges).collect()) == len(EDGES)


# --- 4: secrets ---------------------------------------------------------------

def test_base_spans_against_plain_patterns(spark, sample, edges):
    texts = ['token=abc secret=token:abcdef API-key x api_key: "A1+/_.=-z" PassWD = \'qwertyuiop\'',
             "AKIA" + "Z" * 15 + " AKIA" + "Z" * 16 + "x 中AKIAAKIA" + "9" * 20, "g" + "0a" * 12 + "h " + "f" * 23,
             "password=éabcdef secret:abcdef", "😀 token = 123456 😀 token = 1234567"]
    docs = sample.select("doc_id", "text").unionByName(
        spark.createDataFrame([(10_000 + i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    ).unionByName(edges.where("doc_id IS NOT NULL AND doc_id NOT IN (1, 8)").selectExpr("doc_id + 20000 AS doc_id", "text"))
    got = {r["doc_id"]: r for r in op4.with_span_digest(op4.scan(docs)).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    assign = re.compile(op4.ASSIGN.removeprefix("(?i)"), re.I | re.A)
    for doc, text in rows:
        text = text or ""
        spans = [(m.start(), 0, "assign", m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
        spans += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        spans += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        kinds = Counter(s[2] for s in spans)
        joined = ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(spans))
        r = got[doc]
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == (kinds["assign"], kinds["access"], kinds["hex"])
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert all(f"{k}:{a}:{b}" in r["spans"] for a, _, k, b in spans)


def test_random_strings_pass_and_texts_fail(spark):
    digest = [hashlib.sha256(str(i).encode()).hexdigest() for i in range(300)]
    texts = [(i, f"see {d} for it") for i, d in enumerate(digest)]
    texts += [(1000 + i, f"see aaaaaaaa{i:08d}bbbbbbbb{i:016d} for it") for i in range(300)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    found = op4.random_strings(docs.withColumn("text_hash", F.xxhash64("text"))).select("doc_id", "value").collect()
    flagged = {r["doc_id"] for r in found}
    # A tenth of random strings may fall below a cut; hardly any text may pass.
    assert len([i for i in flagged if i < 1000]) >= 270 and len([i for i in flagged if i >= 1000]) <= 15


def test_tests_of_randomness(spark):
    import math
    rows = [(1, "h", 0, 32, hashlib.md5(b"1").hexdigest()), (2, "h", 0, 32, "0123456789abcdef" * 2)]
    found = spark.createDataFrame(rows, "doc_id bigint, text_hash string, start int, stop int, value string")
    got = {r["doc_id"]: r for r in op4.tested(found).collect()}
    for i, _, _, _, value in rows:
        x = [int(c, 16) for c in value]
        n, k = len(x), 16
        chi2 = sum(c * c for c in Counter(x).values()) * k / n - n
        z = (chi2 - (k - 1)) / math.sqrt(2 * (k - 1) * (n - 1) / n)
        assert got[i]["p_chi2"] == pytest.approx(max(1e-12, 0.5 * math.erfc(z / math.sqrt(2))), abs=1e-6)
        assert got[i]["encoding"] == "hex"
    assert got[2]["p"] < 0.01 < got[1]["p"]


def test_random_letters_and_parts_of_paths(spark, sample):
    """Keys without a digit and keys behind a prefix pass, long words of the corpus and paths of words do not."""
    import random
    rng = random.Random(7)
    letters = "abcdefghijklmnopqrstuvwxyz"

    def key(symbols, n=24):
        return "".join(rng.choice(symbols) for _ in range(n))

    whole = [key(symbols) for symbols in (letters, letters.upper(), letters + letters.upper()) for _ in range(100)]
    inner = [key(letters + letters.upper() + "0123456789") for _ in range(100)]
    texts = [(i, f"see {k} for it") for i, k in enumerate(whole)]
    texts += [(1000 + i, f"see /api/v1/users/{k} for it" if i % 2 else f"see live-production-{k} for it") for i, k in enumerate(inner)]
    words = sorted({w for (t,) in sample.select("text").collect() for w in re.findall("[a-z]{6,12}", t or "")})
    texts += [(2000 + i, f"see {rng.choice(words)}{rng.choice(words)}{rng.choice(words)} for it") for i in range(200)]
    texts += [(3000 + i, f"see /{'/'.join(rng.choice(words) for _ in range(3))} for it") for i in range(200)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").unionByName(
        sample.selectExpr("doc_id + 100000 AS doc_id", "text"))
    spans = {r["doc_id"]: {(s["start"], s["stop"]) for s in r["random"]} for r in op4.scan(docs).where("doc_id < 100000").collect()}
    text = dict(texts)
    found = [any(text[i][a:b] == k for a, b in spans[i]) for i, k in enumerate(whole)]
    for kind in range(3):
        assert sum(found[100 * kind:100 * kind + 100]) >= 85
    assert sum(any(k in text[1000 + i][a:b] for a, b in spans[1000 + i]) for i, k in enumerate(inner)) >= 85
    assert sum(bool(spans[i]) for i in spans if i >= 2000) <= 20


def test_scan_edges(edges, nothing):
    assert op4.with_span_digest(op4.scan(nothing)).count() == 0
    assert op4.scan(edges).count() == len(EDGES)


# --- 8: distinct sites --------------------------------------------------------

def test_spread_against_brute_force(sample):
    rows = sample.select("doc_id", "text", "source").collect()
    sites = defaultdict(set)

    def normal(line):
        return re.sub("[\x20\x09-\x0D]+", " ", line).strip(" ").lower()

    for _, text, source in rows:
        for line in text.split("\n"):
            sites[normal(line)].add(source)
    got = {r["doc_id"]: r for r in op8.remove_boilerplate(sample, min_sites=4).collect()}
    removed = 0
    for doc, text, _ in rows:
        lines = text.split("\n")
        gone = [i for i, line in enumerate(lines) if normal(line) and len(sites[normal(line)]) >= 4]
        assert got[doc]["removed"] == gone and got[doc]["n_lines"] == len(lines)
        assert got[doc]["text"] == "\n".join(x for i, x in enumerate(lines) if i not in gone)
        removed += len(gone)
    assert removed > 0


def test_sketches_decide_far_from_the_threshold(spark):
    rows = [(i, "Shared line\nown %d" % i, f"site{i}") for i in range(200)]
    rows += [(1000 + i, "Near line", f"site{i}") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    found = op8.spread_lines(op8.line_sites(docs, "source"), min_sites=50).collect()
    assert sorted((r["exact"], r["sites"] >= 50) for r in found) == [(False, True), (True, True)]


def test_spread_edges(edges, nothing):
    assert op8.remove_boilerplate(nothing).count() == 0
    rows = op8.remove_boilerplate(edges, min_sites=2).collect()
    assert len(rows) == len(EDGES)
    assert sum(r["text"] is None and r["n_lines"] == 0 for r in rows) == 2
    # Document 6 has no source, 7 has one: two sites share their line.
    assert {r["text"] for r in rows if r["doc_id"] in (6, 7)} == {""}


# --- 9: line labels -----------------------------------------------------------

def plain_counts(text):
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    hit = {j for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for j in range(i, i + 5)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit),
            len(words) < 10 or 100 * len(hit) > 20 * len(words))


def test_counts_against_brute_force(sample, edges):
    docs = sample.select("doc_id", "text").unionByName(edges.select("doc_id", "text"))
    rows = op9.quality(docs, op9.NO_FIELD).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert tuple(r[c] for c in op9._NAMES[:6]) == plain_counts(r["text"] or "")
        assert r["kept"] == (not r["base_failed"])


def test_viterbi_against_all_labellings():
    import itertools

    import numpy as np
    rng = np.random.default_rng(3)
    for _ in range(20):
        field = op9.Field(rng.normal(size=(op9.N_FEATURES, 2)), rng.normal(size=2), rng.normal(size=(2, 2)) * 2)
        lines = b"\n".join(rng.choice([b"a b c", b"X! Y!", b"# | #", b"1 2 3", b"a b c d e f g h i j k"], 6))
        features, _, _ = op9.document_lines(lines)
        emit = field.scores(features)

        def score(labels):
            return field.first[labels[0]] + sum(emit[i, x] for i, x in enumerate(labels)) + sum(
                field.change[a, b] for a, b in zip(labels, labels[1:]))

        best = max(itertools.product((0, 1), repeat=len(features)), key=score)
        assert tuple(field.viterbi(features)) == best


def test_neighbours_change_a_label(spark):
    """A field fitted on the tables calls a line content or boilerplate by the lines around it."""
    import numpy as np
    folder = "/root/testdata/sf0.01"
    field = op9.fit_field(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
    assert field.change[0, 0] > field.change[0, 1] and field.change[1, 1] > field.change[1, 0]
    scores = field.emit.copy()
    # The line that says least, between lines that say most.
    margin = scores[:, 1] - scores[:, 0]
    pull = [field.change[y, y] * 2 - field.change[1 - y, y] - field.change[y, 1 - y] for y in (0, 1)]
    assert min(pull) > 0.5
    weak = np.zeros((1, len(op9.FEATURES)), np.int64) + int(np.abs(margin).argmin())
    strong = [np.zeros((1, len(op9.FEATURES)), np.int64) + int(i) for i in (margin.argmin(), margin.argmax())]
    for label, around in enumerate(strong):
        assert field.viterbi(np.concatenate((around, around, weak, around, around)))[2] == label


def test_all_lines_of_labelled_documents_are_learnt(spark):
    """What tells the labels apart stands behind hundreds of lines; repeated ids bring one row each."""
    same = ["a plain line of text here"] * 300
    rows = [(i, "\n".join([*same, *(["BUY!! NOW!! # | #"] * 40 if i % 2 else ["1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12."] * 40)])) for i in range(12)]
    docs = spark.createDataFrame(rows * 3 + [(1, None)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(12)], "doc_id bigint, quality int")
    lines = op9.training_lines(docs, labels)
    assert len(lines) == 12 and {len(f) for f, _ in lines} == {340}
    field = op9.fit(lines)
    found = [field.viterbi(f)[-40:].mean() for f, _ in lines]
    assert [round(x) for x in found] == [y for _, y in lines]


def test_held_out_labels(spark):
    """Fitted on documents with an even id, judged on the others."""
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    field = op9.fit_field(docs, labels.where("doc_id % 2 = 0"))
    judged = op9.quality(docs.select("doc_id", "text"), field).join(labels.where("doc_id % 2 = 1"), "doc_id") \
        .where("NOT base_failed")
    right = judged.where("kept = (quality = 1)").count()
    assert right >= 0.95 * judged.count()


def test_verdicts_go_back_in_slices(spark, monkeypatch):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, run, schema: run)
    run = op9.quality(docs, op9.NO_FIELD)
    texts = [None if i % 9 == 0 else f"line {i} of words\n" * (20 * i) for i in range(300)]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(300), pa.int64()), "text": pa.array(texts, pa.string())})
    found = list(run(iter([batch, batch.slice(0, 0)])))
    assert len(found) > 4
    got = [r for f in found for r in f.to_pylist()]
    assert [(r["doc_id"], r["text"], r["n_words"]) for r in got] == [(i, t, len((t or "").split())) for i, t in enumerate(texts)]


def test_quality_keeps_columns(edges, nothing):
    assert op9.quality(nothing, op9.NO_FIELD).count() == 0
    kept = op9.keep_good(edges, op9.NO_FIELD)
    assert kept.columns == edges.columns
    rows = kept.collect()
    assert {r["doc_id"] for r in rows} == {1, 2, None, 8, 9, 10} and all(r["kept"] == "kept" for r in rows)


def test_fit_without_both_labels(spark, edges):
    labels = spark.createDataFrame([(1, 1), (2, 1), (None, 0), (3, None)], "doc_id bigint, quality int")
    assert op9.fit_field(edges, labels) is op9.NO_FIELD
    assert op9.fit_field(edges, labels.where("false")) is op9.NO_FIELD
