"""Fill-in-middle: texts cut at unit ends into prefix, middle and suffix, and written in another order.

The characters of a batch of texts become a sequence of character classes (line
break, other white space, end of sentence, ...), held as a wavelet matrix: one bit
vector per bit of the class, each stably sorted by the bits above, with the ones
before every 64th place counted. ``rank`` of a class takes one look-up per level, and
the ranks of the classes that end a unit add up to a count of unit ends. A cut after
the k-th unit is the first place where that count reaches k, found by bisection on
ranks, for all texts of a batch at once.

Which units are cut is drawn from a hash of the document's id, so every run and every
worker draws the same.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEED = 7
#: Percentage of documents that are rearranged, and of these the ones with the suffix first.
RATE, SPM_RATE = 100, 50
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Code points that are indexed at once; a longer text is indexed alone.
SLICE_CHARS = 1 << 20

BREAK, SPACE, STOP, LOWER, UPPER, DIGIT, MARK, OTHER = range(8)
CLASS_BITS = 3
#: Classes that end a unit; a rest without such an end is a unit too.
UNITS = {"line": (BREAK,), "sentence": (BREAK, STOP), "word": (BREAK, SPACE), "character": tuple(range(8))}

_ASCII = np.full(128, MARK, dtype=np.uint8)
_ASCII[[9, 11, 12, 13, 32]] = SPACE
_ASCII[10] = BREAK
_ASCII[[ord(c) for c in ".!?"]] = STOP
_ASCII[97:123], _ASCII[65:91], _ASCII[48:58] = LOWER, UPPER, DIGIT
_WIDE_STOPS = [ord(c) for c in "。！？"]


def character_classes(codes: np.ndarray) -> np.ndarray:
    """Class of every code point."""
    classes = _ASCII[np.minimum(codes, 127)]
    wide = codes > 127
    if wide.any():
        classes[wide] = np.where(np.isin(codes[wide], _WIDE_STOPS), STOP, OTHER)
    return classes


class BitVector:
    """Bits with the number of ones before every 64th."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, dtype="<u8")
        self.words.view(np.uint8)[:len(packed)] = packed
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))
        self.zeros = len(bits) - int(self.before[-1])

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Ones among the first ``at`` bits."""
        word, rest = at >> 6, (at & 63).astype(np.uint64)
        below = self.words[word] & ((np.uint64(1) << rest) - np.uint64(1))
        return self.before[word] + np.bitwise_count(below)


class WaveletMatrix:
    """Ranks over a sequence of classes."""

    def __init__(self, classes: np.ndarray, bits: int = CLASS_BITS):
        self.levels = []
        for bit in reversed(range(bits)):
            ones = (classes >> bit & 1).astype(bool)
            self.levels.append((bit, BitVector(ones)))
            classes = np.concatenate((classes[~ones], classes[ones]))

    def rank(self, kind: int, at: np.ndarray) -> np.ndarray:
        """How many of the first ``at`` characters are of class ``kind``."""
        first, last = np.zeros(1, np.int64), np.asarray(at, np.int64)
        for bit, vector in self.levels:
            if kind >> bit & 1:
                first, last = vector.zeros + vector.ones(first), vector.zeros + vector.ones(last)
            else:
                first, last = first - vector.ones(first), last - vector.ones(last)
        return last - first

    def count(self, kinds: tuple[int, ...], at: np.ndarray) -> np.ndarray:
        """How many of the first ``at`` characters are of one of ``kinds``."""
        return sum(self.rank(kind, at) for kind in kinds)

    def reach(self, kinds: tuple[int, ...], wanted: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The smallest place between ``low`` and ``high`` with ``wanted`` of ``kinds`` before it, else ``high``."""
        low, high = low.copy(), high.copy()
        while (open_ := low < high).any():
            middle = (low + high) >> 1
            enough = self.count(kinds, middle) >= wanted
            high = np.where(open_ & enough, middle, high)
            low = np.where(open_ & ~enough, middle + 1, low)
        return high


def unit_cuts(texts: list[str], draws: np.ndarray, unit: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(units, end of prefix, end of middle) per text, in code points.

    ``draws`` has two numbers per text; taken modulo the number of units plus one,
    the smaller is the length of the prefix in units, the larger where the middle ends.
    """
    kinds = UNITS[unit]
    ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
    starts = np.concatenate(([0], ends[:-1])).astype(np.int64)
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), dtype="<u4")
    classes = character_classes(codes)
    index = WaveletMatrix(classes)
    before = index.count(kinds, starts)
    closed = index.count(kinds, ends) - before
    full = ends > starts
    open_end = full.copy()
    open_end[full] = ~np.isin(classes[ends[full] - 1], kinds)
    units = closed + open_end
    picked = np.sort(draws % (units + 1)[:, None], axis=1)
    cuts = [index.reach(kinds, before + picked[:, j], starts, ends) - starts for j in (0, 1)]
    # Ranks end at the last closed unit; the open rest reaches to the end of its text.
    cuts = [np.where(picked[:, j] > closed, ends - starts, cuts[j]) for j in (0, 1)]
    return units, cuts[0], cuts[1]


def _slices(texts: list[str], limit: int):
    """(first, last) of consecutive texts of at most ``limit`` code points, at least one text each."""
    first, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > limit:
            yield first, i
            first, held = i, 0
        held += len(text)
    if texts:
        yield first, len(texts)


def rearrange(text: str, form: str, prefix: int, middle: int) -> str:
    """``text`` in one of the forms plain, psm and spm, cut at two places."""
    before, between, after = text[:prefix], text[prefix:middle], text[middle:]
    if form == "psm":
        return f"{PREFIX}{before}{SUFFIX}{after}{MIDDLE}{between}"
    if form == "spm":
        return f"{SUFFIX}{after}{PREFIX}{before}{MIDDLE}{between}"
    return text


RESULT = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


def fill_in_middle(docs: DataFrame, unit: str = "line", seed: int = SEED, rate: int = RATE,
                   spm_rate: int = SPM_RATE) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) per row of ``docs`` (doc_id, text).

    ``n`` counts the units. A null text is empty; an empty text, and one that holds a
    sentinel already, stays plain, with null lengths. Texts are indexed and cut whole,
    however long. Rows that repeat an id draw the same numbers; a null id draws those
    of an empty one. Other columns are ignored; an empty table gives no rows.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    drawn = [F.conv(F.substring("digest", 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
                       digest.alias("digest")).select("doc_id", "text", *drawn)
    names = [c.split()[0] for c in RESULT.split(", ")]

    def run(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            draws = np.column_stack([batch.column(i).to_numpy() for i in (2, 3)])
            h3, h4 = (batch.column(i).to_numpy() for i in (4, 5))
            for first, last in _slices(texts, SLICE_CHARS):
                part = texts[first:last]
                units, prefix, middle = unit_cuts(part, draws[first:last], unit)
                forms = ["plain" if not t or PREFIX in t or SUFFIX in t or MIDDLE in t or x % 100 >= rate
                         else "spm" if y % 100 < spm_rate else "psm"
                         for t, x, y in zip(part, h3[first:last].tolist(), h4[first:last].tolist())]
                plain = np.array([f == "plain" for f in forms], dtype=bool)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, last - first), pa.array(units), pa.array(forms, pa.string()),
                    pa.array(prefix, mask=plain), pa.array(middle - prefix, mask=plain),
                    pa.array(map(rearrange, part, forms, prefix.tolist(), middle.tolist()), pa.string()),
                ], names=names)

    return rows.mapInArrow(run, RESULT)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)

    def joined(*order: int) -> Column:
        return F.concat(*[F.get(parts, F.lit(i)) for i in order])

    return F.when(form == "psm", joined(1, 3, 2)).when(form == "spm", joined(2, 3, 1)).otherwise(output)


def with_digests(made: DataFrame) -> DataFrame:
    """Digests of the outputs and of the texts rebuilt from them, in place of the outputs."""
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
