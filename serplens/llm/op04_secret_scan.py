"""Secret scan: known forms by pattern, unknown ones by a battery of randomness tests.

Known forms are matched left to right without overlap. For the rest, every run of
16 or more key characters with a letter is a candidate, and so is every part of 16
or more between its separators, as a key may stand in a path or behind a prefix. Its
encoding is inferred (hexadecimal, base 32, alphanumeric, base 64, each of these
without digits) and three tests ask whether its symbols could be uniform draws from
that alphabet:

* chi-squared: symbol counts against a flat alphabet,
* runs: changes between lower and upper half of the alphabet,
* serial correlation of neighbouring symbols.

Long words look much like draws of letters to these. So candidates without a digit
have encodings of their own and a fourth test, which asks whether neighbouring
letters follow one another as in the words of the corpus.

Their p-values are combined by Fisher's method. A random string has a uniform p;
text has a p near zero, the more surely the longer it is. So each class of
encoding and length gets its own cut: the number of random strings in the class is
estimated from the upper half of its p-values, and the lowest cut is taken at
which at most ``FALSE_SHARE`` of the candidates above it are expected to be text.
The cut table has at most one row per encoding and length class. Of candidates
inside one another that pass, the outer one is reported.

Everything is built-in expressions: no Python runs on the executors.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from serplens.llm.tables import join_rows, keyed
from serplens.sources.storage import materialize

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"
#: A whole run, tried at its first character only, with a letter.
CANDIDATE = r"(?<![A-Za-z0-9+/_-])(?=[0-9+/_-]*[A-Za-z])[A-Za-z0-9+/_-]{16,}={0,2}"
#: What separates the parts of a run: a key may have some of these characters itself.
SEPARATORS = ("/", "/-", "+/_-")
#: Words whose pairs of letters are counted; longer ones may be candidates.
WORD = "[a-z]{4,15}"

#: Expected share of text among flagged candidates of a class.
FALSE_SHARE = 0.05
#: Cuts are sought among this many equal steps of p.
STEPS = 50
#: Upper bounds of the length classes.
LENGTHS = (20, 28, 40, 64, 128)

_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Encodings in the order they are tried: (name, pattern of the whole, alphabet).
ENCODINGS = (
    ("hex", "[0-9a-f]+", _DIGITS + "abcdef"),
    ("HEX", "[0-9A-F]+", _DIGITS + "ABCDEF"),
    ("lower", "[a-z]+", _LOWER),
    ("upper", "[A-Z]+", _UPPER),
    ("letters", "[A-Za-z]+", _UPPER + _LOWER),
    ("letters64", "[A-Za-z+/]+", _UPPER + _LOWER + "+/"),
    ("letters64url", "[A-Za-z_-]+", _UPPER + _LOWER + "-_"),
    ("lettersmixed", "[A-Za-z+/_-]+", _UPPER + _LOWER + "+/-_"),
    ("base32", "[A-Z2-7]+", _UPPER + "234567"),
    ("alnum", "[A-Za-z0-9]+", _UPPER + _LOWER + _DIGITS),
    ("base64", "[A-Za-z0-9+/]+", _UPPER + _LOWER + _DIGITS + "+/"),
    ("base64url", "[A-Za-z0-9_-]+", _UPPER + _LOWER + _DIGITS + "-_"),
    ("mixed", "[A-Za-z0-9+/_-]+", _UPPER + _LOWER + _DIGITS + "+/-_"),
)


def _bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def matches(text: Column, pattern: str, groups: tuple[int, ...] = (0,)) -> Column:
    """array<struct<start, stop, g0, ...>> of all matches in order, in code points.

    The pieces between matches come from ``split``. Pieces and matches are paired
    and walked once, every match starting where the last one stopped plus its piece.
    A list that grows step by step is copied at every step, so pairs are walked in as
    many stretches as a stretch has pairs: each starts from the sum of lengths before it.
    """
    names = [f"g{g}" for g in groups]
    paired = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), *[
        F.regexp_extract_all(text, F.lit(pattern), F.lit(g)).alias(n) for g, n in zip(groups, names)])
    entry = "struct<start:int,stop:int," + ",".join(f"{n}:string" for n in names) + ">"
    nothing = F.array().cast(f"array<{entry}>")

    def walk(done, pair, base):
        pair = [pair[n] for n in ("gap", *names)]
        start = F.coalesce(F.try_element_at(done, F.lit(-1))["stop"], base) + F.length(pair[0])
        here = F.struct(start.alias("start"), (start + F.length(pair[1])).alias("stop"),
                        *[p.alias(n) for p, n in zip(pair[1:], names)])
        # The piece after the last match stands alone.
        return F.when(pair[1].isNull(), done).otherwise(F.concat(done, F.array(here)))

    def walked(pairs):
        step = F.ceil(F.sqrt(F.size(pairs))).cast("int")
        starts = F.sequence(F.lit(1), F.size(pairs), step)
        sums = F.transform(starts, lambda s: F.aggregate(
            F.slice(pairs, s, step), F.lit(0),
            lambda a, p: a + F.length(p["gap"]) + F.coalesce(F.length(p["g0"]), F.lit(0))))
        before = F.aggregate(sums, F.array(F.lit(0)), lambda a, n: F.concat(a, F.array(F.element_at(a, -1) + n)))
        return _bound(before, lambda bases: F.flatten(F.transform(starts, lambda s, k: F.aggregate(
            F.slice(pairs, s, step), nothing, lambda done, pair: walk(done, pair, F.get(bases, k))))))

    # Texts without a match, nearly all, are only scanned once.
    return F.when(F.rlike(text, F.lit(pattern)), _bound(paired, walked)).otherwise(nothing)


def base_spans(docs: DataFrame) -> DataFrame:
    """``docs`` (keyed) without text, with assign, access and hex: lists of spans by start."""
    return docs.select(
        "doc_id", "text_hash",
        F.filter(matches(F.col("text"), ASSIGN, (0, 2)), lambda m: F.length(m["g2"]) >= 6).alias("assign"),
        F.when(F.contains("text", F.lit("AKIA")),
               F.filter(matches(F.col("text"), ACCESS), lambda m: F.length(m["g0"]) >= 20)).alias("access"),
        matches(F.col("text"), HEX).alias("hex"))


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, start, stop, value) of every candidate run of ``docs`` (keyed), and of its parts."""
    # Outer, so that the optimizer does not filter on the list's size by building it twice.
    found = docs.select("doc_id", "text_hash", F.explode_outer(matches(F.col("text"), CANDIDATE)).alias("m"))
    runs = found.select("doc_id", "text_hash", "m.start", "m.stop", F.col("m.g0").alias("value")).where("value IS NOT NULL")

    def span(start, stop, value):
        return F.struct(start.alias("start"), stop.alias("stop"), value.alias("value"))

    parts = [F.transform(matches(F.col("value"), f"[^{marks}]{{16,}}"), lambda m: span(
        F.col("start") + m["start"], F.col("start") + m["stop"], m["g0"])) for marks in SEPARATORS]
    whole = F.array(span(F.col("start"), F.col("stop"), F.col("value")))
    every = F.when(F.rlike("value", F.lit("[+/_-]")), F.array_distinct(F.concat(whole, *parts))).otherwise(whole)
    # A part may owe its length to the padding.
    return runs.select("doc_id", "text_hash", F.explode_outer(every).alias("m")).select("doc_id", "text_hash", "m.*") \
        .where(F.rlike("value", F.lit("[A-Za-z]")) & F.rlike("value", F.lit("^[^=]{16}")))


def letter_pairs(docs: DataFrame) -> np.ndarray:
    """How often each letter follows another in the words of ``docs``, 26 x 26, one added to each."""
    words = docs.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0))).alias("word")) \
        .groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    pairs = words.select("n", F.explode(F.expr(
        "transform(sequence(1, length(word) - 1), i -> substring(word, i, 2))")).alias("pair"))
    counts = np.ones((26, 26))
    # At most one row per pair of letters.
    for pair, n in pairs.groupBy("pair").agg(F.sum("n").alias("n")).collect():
        counts[ord(pair[0]) - 97, ord(pair[1]) - 97] += n
    return counts


def _word_test(pairs: np.ndarray) -> tuple[Column, str]:
    """Scores of the pairs of letters, and z of the sum ``told`` of ``told_of`` scores under uniform draws."""
    scores = np.log(pairs / pairs.mean())
    # Neighbouring pairs have a letter in common.
    common = ((scores.mean(0) - scores.mean()) * (scores.mean(1) - scores.mean())).mean()
    spread = f"(told_of * {scores.var()}D + 2 * greatest(0, told_of - 1) * {common}D)"
    return F.lit(scores.ravel().tolist()), (
        f"CASE WHEN {spread} > 0 THEN (told - told_of * {scores.mean()}D) / sqrt({spread}) ELSE 0D END")


#: Upper tail of the normal distribution, by a rational approximation with an error below 1e-7.
_TAIL = """(CASE WHEN {z} < 0 THEN 1 - {t} ELSE {t} END)"""


def _upper_tail(z: str) -> str:
    x = f"(abs({z}) / sqrt(2D))"
    t = f"(1 / (1 + 0.3275911D * {x}))"
    poly = (f"({t} * (0.254829592D + {t} * (-0.284496736D + {t} * (1.421413741D + {t} * "
            f"(-1.453152027D + {t} * 1.061405429D)))))")
    return _TAIL.format(z=z, t=f"(0.5D * {poly} * exp(-{x} * {x}))")


def _two_sided(z: str) -> str:
    return f"(2 * {_upper_tail(f'abs({z})')})"


def tested(found: DataFrame, pairs: np.ndarray | None = None) -> DataFrame:
    """Candidates with encoding, length class, the p-values and their combination p.

    ``pairs`` are those of ``letter_pairs``; without any, no pair is more usual than others.
    """
    scores, z_words = _word_test(np.ones((26, 26)) if pairs is None else pairs)
    bare = F.regexp_replace("value", "=+$", "")
    name, alphabet = F.lit(None), F.lit(None)
    for encoding, pattern, symbols in reversed(ENCODINGS):
        fits = F.rlike("bare", F.lit(f"^{pattern}$"))
        name, alphabet = F.when(fits, encoding).otherwise(name), F.when(fits, symbols).otherwise(alphabet)
    length_class = F.lit(len(LENGTHS))
    for i, bound in reversed(list(enumerate(LENGTHS))):
        length_class = F.when(F.col("n") < bound, i).otherwise(length_class)
    return (
        found.withColumn("bare", bare)
        .withColumns({"encoding": name, "alphabet": alphabet, "n": F.length("bare")})
        .withColumns({
            "length_class": length_class, "k": F.length("alphabet"),
            "x": F.expr("transform(split(bare, ''), c -> instr(alphabet, c) - 1)"),
            "letters": ~F.rlike("bare", F.lit("[0-9]")), "scores": scores,
            "y": F.expr(f"transform(split(lower(bare), ''), c -> instr('{_LOWER}', c) - 1)"),
        })
        .withColumns({
            "told": F.expr("CASE WHEN letters THEN aggregate(sequence(1, n - 1), 0D, (a, i) -> a + CASE WHEN get(y, i - 1) >= 0 "
                           "AND get(y, i) >= 0 THEN get(scores, 26 * get(y, i - 1) + get(y, i)) ELSE 0D END) END"),
            "told_of": F.expr("CASE WHEN letters THEN size(filter(sequence(1, n - 1), "
                              "i -> get(y, i - 1) >= 0 AND get(y, i) >= 0)) END"),
        })
        .withColumn("z_words", F.expr(z_words))
        .withColumn("counts", F.expr(
            "transform(sequence(0, k - 1), s -> bigint(size(filter(x, v -> v = s))))"))
        .withColumns({
            "chi2": F.expr("aggregate(counts, 0D, (a, c) -> a + c * c) * k / n - n"),
            "upper": F.expr("size(filter(x, v -> v * 2 >= k))"),
            "runs": F.expr("1 + aggregate(sequence(1, n - 1), 0, (a, i) -> a + "
                           "int((get(x, i) * 2 >= k) <> (get(x, i - 1) * 2 >= k)))"),
            "s1": F.expr("aggregate(x, 0D, (a, v) -> a + v)"),
            "s2": F.expr("aggregate(x, 0D, (a, v) -> a + v * v)"),
            "s12": F.expr("aggregate(sequence(0, n - 1), 0D, (a, i) -> a + get(x, i) * get(x, (i + 1) % n))"),
        })
        .withColumns({
            "z_chi2": F.expr("(chi2 - (k - 1)) / sqrt(2D * (k - 1) * (n - 1) / n)"),
            "mean_runs": F.expr("1 + 2D * upper * (n - upper) / n"),
            "var_runs": F.expr("2D * upper * (n - upper) * (2D * upper * (n - upper) - n) / (double(n) * n * (n - 1))"),
            "spread": F.expr("n * s2 - s1 * s1"),
        })
        .withColumns({
            # Runs and order say nothing about a string of one half or of one symbol.
            "z_runs": F.expr("CASE WHEN var_runs > 0 THEN (runs - mean_runs) / sqrt(var_runs) ELSE 9D END"),
            "z_serial": F.expr("CASE WHEN spread > 0 THEN ((n * s12 - s1 * s1) / spread + 1D / (n - 1)) * sqrt(n) ELSE 9D END"),
        })
        .withColumns({
            "p_chi2": F.expr(f"greatest(1e-12D, {_upper_tail('z_chi2')})"),
            "p_runs": F.expr(f"greatest(1e-12D, {_two_sided('z_runs')})"),
            "p_serial": F.expr(f"greatest(1e-12D, {_two_sided('z_serial')})"),
        })
        .withColumn("p_words", F.when(F.col("letters"), F.expr(f"greatest(1e-12D, {_upper_tail('z_words')})")))
        # Fisher: -2 ln of the product has a chi-squared distribution with six degrees, eight for four tests.
        .withColumn("half", F.expr("-ln(p_chi2 * p_runs * p_serial * coalesce(p_words, 1D))"))
        .withColumn("p", F.expr("least(1D, exp(-half) * (1 + half + half * half / 2 + "
                                "CASE WHEN letters THEN half * half * half / 6 ELSE 0D END))"))
        .select("doc_id", "text_hash", "start", "stop", "value", "encoding", "length_class",
                "p_chi2", "p_runs", "p_serial", "p_words", "p", F.expr(f"least({STEPS - 1}, int(p * {STEPS}))").alias("step"))
    )


def cuts(scored: DataFrame, false_share: float = FALSE_SHARE) -> DataFrame:
    """(encoding, length_class, cut): candidates of the class whose step is at least ``cut`` are secrets.

    One is added to the upper half's count, as is usual in estimates of this share.
    """
    classes = ["encoding", "length_class"]
    steps = scored.groupBy(*classes, "step").agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy(*classes)
    above = whole.orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, 0)
    half = STEPS // 2
    random = (F.sum(F.when(F.col("step") >= half, F.col("n")).otherwise(0)).over(whole) + 1) * 2
    kept = F.sum("n").over(above)
    text = kept - random * (1 - F.col("step") / STEPS)
    return steps.withColumn("ok", text <= false_share * kept).where("ok") \
        .groupBy(*classes).agg(F.min("step").alias("cut"))


def random_strings(docs: DataFrame, false_share: float = FALSE_SHARE) -> DataFrame:
    """The candidates of ``docs`` (keyed) that pass for random, with their test results."""
    scored = materialize(tested(candidates(docs), letter_pairs(docs)), "candidates")
    before = Window.partitionBy("doc_id", "text_hash").orderBy("start", F.desc("stop")) \
        .rowsBetween(Window.unboundedPreceding, -1)
    # At most one row per encoding and length class.
    return scored.join(F.broadcast(cuts(scored, false_share)), ["encoding", "length_class"]) \
        .where("step >= cut").drop("step", "cut").withColumn("reached", F.coalesce(F.max("stop").over(before), F.lit(-1))) \
        .where("stop > reached").drop("reached")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def _of_kind(column: str, order: int) -> Column:
    return F.transform(F.coalesce(F.col(column), F.array()), lambda m: F.struct(
        m["start"].alias("start"), F.lit(order).alias("order"), F.lit(column).alias("kind"), m["stop"].alias("stop")))


def scan(docs: DataFrame, false_share: float = FALSE_SHARE) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): the spans of each kind.

    Returns doc_id, assign, access, hex (lists of struct start, stop, text) and
    random (list of struct start, stop). A null or empty text has no spans. Rows
    are told by id and text; equal rows get equal results. An empty table gives
    no rows; other columns are ignored.
    """
    rows = keyed(docs)
    found = random_strings(rows, false_share).groupBy("doc_id", "text_hash").agg(
        F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("random"))
    none = F.array().cast("array<struct<start:int,stop:int>>")
    nothing = F.array().cast("array<struct<start:int,stop:int,g0:string>>")
    return join_rows(base_spans(rows), found, "left").select(
        "doc_id", F.coalesce("assign", F.array().cast("array<struct<start:int,stop:int,g0:string,g2:string>>")).alias("assign"),
        F.coalesce("access", nothing).alias("access"), F.coalesce("hex", nothing).alias("hex"),
        F.coalesce("random", none).alias("random"))


def with_span_digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, the digest of their spans, and all spans, each joined by start, then kind."""
    base = F.concat(_of_kind("assign", 0), _of_kind("access", 1), _of_kind("hex", 2))
    return found.select(
        "doc_id", *[F.size(c).cast("long").alias(f"n_{c}") for c in ("assign", "access", "hex")],
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.concat(base, _of_kind("random", 3))).alias("spans"))
