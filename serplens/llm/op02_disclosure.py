"""Personal data: patterns for entities, co-occurrence for the terms that give them away.

Entities (e-mail, IP, card, phone) are matched left to right without overlap. A
term is a lower-cased word that stands near an entity somewhere. Over the distinct
texts of the whole corpus, its pointwise mutual information with the entity, relative
to the entity's own information, says how far the term alone discloses the entity:

    share = log2(N * p / n(e)) / log2(N / n(e))

with N distinct texts, n(e) of them with the entity, and p the lower confidence bound
(Wilson, ``Z`` standard errors) of n(e, t) / n(t), the part of the texts with the term
anywhere that hold the entity anywhere. A term seen in few texts thus needs no floor:
its bound is low. Terms with p of at least ``CERTAIN`` and a share above ``GENERALISE``
are generalised to their kind of word, above ``REMOVE`` they are removed, and that
wherever they stand: far from the entity and in texts without it, too.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from serplens.llm import wordhash
from serplens.llm.tables import join_rows, keyed
from serplens.operators.narrow import maybe_in
from serplens.sources.storage import materialize

KINDS = ("email", "ip", "card", "phone")
#: Words on either side of an entity that may be terms.
NEAR = 8
Z, CERTAIN = 1.2816, 0.25
GENERALISE, REMOVE = 0.6, 0.9
#: Bits of a table that tells which hashes are wanted; its size is fixed at 2 MB.
TERM_BITS = 1 << 24

# Possessive runs: a run that is not followed by the rest is passed as a whole,
# which finds what the plain pattern finds, in linear time.
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]++(@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)?")
_IP = re.compile(r"[0-9]++((?:\.[0-9]+){3})?")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_DIGIT = re.compile(r"[0-9]")
_FOLD = {c: c + 32 for c in range(65, 91)}


def luhn(digits: str) -> bool:
    """Whether the check digit of a card number fits."""
    doubled = "0246813579"
    return sum(int(doubled[int(d)]) if i % 2 else int(d) for i, d in enumerate(reversed(digits))) % 10 == 0


def entities(text: str) -> list[tuple[int, int, int, str]]:
    """(kind, start, end, value) of all entities, by kind as listed, then start."""
    found = []
    if "@" in text:
        found += [(0, *m.span(), m[0].translate(_FOLD)) for m in _EMAIL.finditer(text) if m[1]]
    if _DIGIT.search(text):
        if "." in text:
            found += [(1, *m.span(), m[0]) for m in _IP.finditer(text)
                      if m[1] and all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append((2, *m.span(), digits))
        if "+" in text:
            for m in _PHONE.finditer(text):
                digits = "".join(_DIGIT.findall(m[0]))
                if 9 <= len(digits) <= 15:
                    found.append((3, *m.span(), digits))
    return found


def neighbours(text: str, found: list[tuple[int, int, int, str]]) -> Iterator[tuple[str, list[str]]]:
    """(entity, terms) per entity: terms are its nearest words outside all entities."""
    words = [(m.start(), m.end(), m[0].translate(_FOLD)) for m in _WORD.finditer(text)]
    starts = np.array([w[0] for w in words])
    within = _overlaps(found)
    for kind, a, b, value in found:
        first, last = int(np.searchsorted(starts, a, side="right")) - 1, int(np.searchsorted(starts, b))
        near = words[max(0, first - NEAR):first + 1] + words[max(last, first + 1):last + NEAR]
        yield f"{KINDS[kind]}:{value}", [w for s, e, w in near if not within(s, e)]


def _overlaps(found: list[tuple[int, int, int, str]]):
    """Whether a stretch meets any of the entities."""
    taken = sorted((a, b) for _, a, b, _ in found)
    begins, ends = np.array([t[0] for t in taken]), np.maximum.accumulate([t[1] for t in taken])

    def within(start, stop):
        # The last entity to begin before the stretch's end must have ended before it, as all earlier ones.
        i = int(np.searchsorted(begins, stop)) - 1
        return i >= 0 and ends[i] > start

    return within


_SPAN = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("stop", pa.int32())])
_MENTION = pa.struct([("entity", pa.string()), ("terms", pa.list_(pa.string()))])
FOUND = ("doc_id bigint, text_hash bigint, base array<struct<kind:int,start:int,stop:int>>, "
         "mentions array<struct<entity:string,terms:array<string>>>")


def find_entities(docs: DataFrame) -> DataFrame:
    """One row of ``FOUND`` per row of ``docs`` (doc_id, text)."""
    def run(batches):
        for batch in batches:
            base, mentions = [], []
            for text in batch.column(2).to_pylist():
                found = entities(text) if text else []
                base.append([{"kind": k, "start": a, "stop": b} for k, a, b, _ in found])
                near: dict[str, set] = {}
                for entity, terms in neighbours(text, found) if found else ():
                    near.setdefault(entity, set()).update(terms)
                mentions.append([{"entity": e, "terms": sorted(t)} for e, t in near.items()])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(base, pa.list_(_SPAN)), pa.array(mentions, pa.list_(_MENTION))],
                names=["doc_id", "text_hash", "base", "mentions"])

    return keyed(docs).mapInArrow(run, FOUND)


def term_hash(term: str) -> int:
    """Signed hash of a lower-cased word, the same that ``term_texts`` computes from texts."""
    raw = np.frombuffer(term.encode(), np.uint8)
    return int(wordhash.word_hashes(raw, np.array([0, len(raw)]))[0].view(np.int64)[0])


def _hashed(terms: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            hashes = pa.array([term_hash(t) for t in batch.column(0).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), hashes], names=["term", "hash"])

    return terms.select("term").distinct().mapInArrow(run, "term string, hash bigint")


def _bit_table(hashes: DataFrame) -> np.ndarray:
    """Which values of ``hash`` modulo ``TERM_BITS`` occur, as a table of that fixed size."""
    bit = F.pmod("hash", F.lit(TERM_BITS))
    pages = hashes.select(bit.alias("bit")).groupBy(F.expr("bit div 32768").alias("page")) \
        .agg(F.bitmap_construct_agg(F.expr("bit % 32768")).alias("bits")).collect()
    table = np.zeros(TERM_BITS // 8, np.uint8)
    for page in pages:
        table[page["page"] * 4096:(page["page"] + 1) * 4096] = np.frombuffer(page["bits"], np.uint8)
    return table


def _wanted(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which unsigned hashes have their bit set."""
    place = hashes & np.uint64(TERM_BITS - 1)
    return (table[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def term_texts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(hash, texts): in how many distinct texts of ``docs`` each of ``terms`` (hash) occurs.

    Every word of every text is hashed; the bit table only spares the shuffle words
    that are no terms. A second table tells the texts that may have copies: only
    those are moved, to be counted once.
    """
    table, rows = _bit_table(terms), keyed(docs)
    bit = F.pmod("text_hash", F.lit(TERM_BITS))
    crowded = materialize(rows.groupBy(bit.alias("hash")).count().where("count > 1").select("hash"), "crowded")
    copied = _bit_table(crowded)

    def count(alone: bool):
        def run(batches):
            for batch in batches:
                may_repeat = _wanted(copied, batch.column(0).to_numpy().view(np.uint64))
                texts = batch.column(1).filter(pa.array(may_repeat != alone))
                for _, raw, at in wordhash.slices(texts):
                    words, bounds = wordhash.word_hashes(raw, at)
                    hit = np.flatnonzero(_wanted(table, words))
                    if len(hit) == 0:
                        continue
                    owner = np.searchsorted(bounds, hit, side="right")
                    pairs = np.unique(np.stack((words[hit].view(np.int64), owner)), axis=1)
                    hashes, counts = np.unique(pairs[0], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(counts)], names=["hash", "n"])
        return run

    texts = rows.select("text_hash", "text")
    may_repeat = maybe_in(texts.withColumn("hash", bit), crowded, "hash").drop("hash").dropDuplicates(["text_hash"])
    counted = texts.mapInArrow(count(True), "hash bigint, n bigint") \
        .unionByName(may_repeat.mapInArrow(count(False), "hash bigint, n bigint"))
    return counted.groupBy("hash").agg(F.sum("n").alias("texts")).join(terms.select("hash"), "hash", "left_semi")


def occurrences(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(doc_id, text_hash, hash, start, stop) of ``terms`` (hash) in every text, outside its entities; code points."""
    table = _bit_table(terms)
    kinds = {"doc_id": pa.int64(), "text_hash": pa.int64(), "hash": pa.int64(), "start": pa.int32(), "stop": pa.int32()}

    def run(batches):
        for batch in batches:
            for first, raw, at in wordhash.slices(batch.column(2)):
                words, bounds = wordhash.word_hashes(raw, at)
                hit = np.flatnonzero(_wanted(table, words))
                if len(hit) == 0:
                    continue
                begins = wordhash.word_starts(raw, at)[hit]
                owner = np.searchsorted(bounds, hit, side="right") - 1
                gaps = np.append(np.flatnonzero(~wordhash.in_words(raw)), len(raw))
                ends = np.minimum(gaps[np.searchsorted(gaps, begins)], at[owner + 1])
                points = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
                begins, ends = (points[x] - points[at[owner]] for x in (begins, ends))
                keep = np.ones(len(hit), bool)
                for row in np.unique(owner):
                    found = entities(batch.column(2)[int(first + row)].as_py())
                    if found:
                        within, mine = _overlaps(found), np.flatnonzero(owner == row)
                        keep[mine] = [not within(s, e) for s, e in zip(begins[mine], ends[mine])]
                at_row = pa.array(first + owner[keep])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at_row), batch.column(1).take(at_row), pa.array(words[hit][keep].view(np.int64)),
                     pa.array(begins[keep], pa.int32()), pa.array(ends[keep], pa.int32())], names=list(kinds))

    found = keyed(docs).mapInArrow(run, "doc_id bigint, text_hash bigint, hash bigint, start int, stop int")
    return found.join(terms.select("hash").distinct(), "hash", "left_semi")


def bounded_part(part, whole):
    """Lower confidence bound of ``part`` in ``whole`` counts, as columns."""
    p, z2 = part / whole, Z * Z
    spread = F.sqrt(p * (1 - p) / whole + z2 / (4 * whole * whole))
    return (p + z2 / (2 * whole) - Z * spread) / (1 + z2 / whole)


def candidate_pairs(found: DataFrame, docs: DataFrame) -> DataFrame:
    """(entity, term, hash, n_e, n_t) of terms near an entity that may disclose it.

    Left out are only pairs that could not reach ``CERTAIN`` if every text with the
    rarer of the two held both.
    """
    seen = found.select("text_hash", F.explode("mentions").alias("m")).select("text_hash", "m.*")
    alone = seen.select("text_hash", "entity").distinct().groupBy("entity").agg(F.count(F.lit(1)).alias("n_e"))
    near = materialize(seen.select("entity", F.explode("terms").alias("term")).distinct(), "entity_terms")
    hashed = materialize(_hashed(near), "terms")
    frequent = materialize(hashed.join(term_texts(docs, hashed), "hash"), "term_texts")
    pairs = near.join(frequent, "term").join(alone, "entity").withColumnRenamed("texts", "n_t")
    return pairs.where(bounded_part(F.least("n_e", "n_t"), F.col("n_t")) >= CERTAIN) \
        .select("entity", "term", "hash", "n_e", "n_t")


def disclosing_terms(found: DataFrame, pairs: DataFrame, uses: DataFrame, generalise: float = GENERALISE) -> DataFrame:
    """(entity, term, hash, share) of the ``pairs`` whose share of disclosure is at least ``generalise``.

    ``uses`` is what ``occurrences`` finds for their terms.
    """
    holds = found.select("text_hash", F.explode("mentions.entity").alias("entity")).distinct()
    both = uses.select("text_hash", "hash").distinct().join(pairs.select("entity", "hash"), "hash") \
        .join(holds, ["text_hash", "entity"], "left_semi").groupBy("entity", "hash").agg(F.count(F.lit(1)).alias("both"))
    n = float(max(1, found.select("text_hash").distinct().count()))
    own = F.log2(F.lit(n) / F.col("n_e"))
    part = bounded_part(F.col("both"), F.greatest("n_t", "both"))
    return pairs.join(both, ["entity", "hash"]).where((part >= CERTAIN) & (own > 0)) \
        .withColumn("share", 1 + F.log2(part) / own).where(F.col("share") >= generalise) \
        .select("entity", "term", "hash", "share")


def scan(docs: DataFrame, generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, text_hash, base and terms, two lists of spans.

    ``base`` has struct (kind: index in ``KINDS``, start, stop), ``terms`` struct
    (start, stop, action: generalise or remove). A null or empty text has none. Rows
    are told by id and text and equal rows get equal results; an empty table gives
    no rows; other columns are ignored.
    """
    found = materialize(find_entities(docs), "entities")
    pairs = materialize(candidate_pairs(found, docs), "term_pairs")
    uses = materialize(occurrences(docs, pairs), "term_uses")
    action = F.when(F.max("share") >= remove, "remove").otherwise("generalise")
    actions = disclosing_terms(found, pairs, uses, generalise).groupBy("hash").agg(action.alias("action"))
    spans = uses.join(actions, "hash").groupBy("doc_id", "text_hash") \
        .agg(F.array_sort(F.collect_set(F.struct("start", "stop", "action"))).alias("terms"))
    return join_rows(found.select("doc_id", "text_hash", "base"), spans, "left").withColumn(
        "terms", F.coalesce("terms", F.array().cast("array<struct<start:int,stop:int,action:string>>")))


def sanitise(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(doc_id, text_hash, text): entities become [EMAIL] and so on, generalised terms [NAME], [NUMBER] or [WORD].

    Where spans overlap, the one that starts first, then the longest, is replaced
    as a whole. ``found`` is the result of ``scan``, or some rows of it; ``text_hash``
    is that of the original text, and rows that repeat id and text are one.
    """
    def shape(word):
        return "[NUMBER]" if _DIGIT.search(word) else "[NAME]" if word[:1].isupper() else "[WORD]"

    def clean(text, base, terms):
        spans = [(s["start"], -s["stop"], f"[{KINDS[s['kind']].upper()}]") for s in base]
        spans += [(s["start"], -s["stop"], "" if s["action"] == "remove" else None) for s in terms]
        out, at = [], 0
        for start, stop, new in sorted(spans, key=lambda s: s[:2]):
            if start >= at:
                out += [text[at:start], shape(text[start:-stop]) if new is None else new]
                at = -stop
        return "".join(out) + text[at:]

    def run(batches):
        for batch in batches:
            texts = [clean(t, b, s) if t else t for t, b, s in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())],
                                             names=["doc_id", "text_hash", "text"])

    # Texts without a span are passed over before any is moved.
    rows = maybe_in(keyed(docs), found.select("text_hash"), "text_hash").dropDuplicates(["doc_id", "text_hash"])
    return join_rows(rows, found.dropDuplicates(["doc_id", "text_hash"]), "inner") \
        .select("doc_id", "text_hash", "text", "base", "terms").mapInArrow(run, "doc_id bigint, text_hash bigint, text string")


def sanitised_scan(docs: DataFrame) -> DataFrame:
    """``with_span_digest`` of all rows, and ``sanitised``: the text where something was replaced, else null."""
    found = materialize(scan(docs), "disclosure")
    treated = found.where((F.size("base") > 0) | (F.size("terms") > 0))
    clean = sanitise(docs, treated).withColumnRenamed("text", "sanitised")
    return with_span_digest(join_rows(found, clean, "left"), "sanitised")


def with_span_digest(found: DataFrame, *more: str) -> DataFrame:
    """Counts per kind, the digest of the base spans, all spans by kind, then start, and what becomes of the terms.

    ``actions`` has action:start:end of every treated term, comma-joined.
    """
    names = F.array(*[F.lit(k) for k in KINDS])
    base = F.transform("base", lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["stop"]))
    terms = F.transform("terms", lambda s: F.concat_ws(":", F.lit("term"), s["start"], s["stop"]))

    actions = F.transform("terms", lambda s: F.concat_ws(":", s["action"], s["start"], s["stop"]))

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
                        F.array_join(F.concat(base, terms), ",").alias("spans"), F.array_join(actions, ",").alias("actions"), *more)
