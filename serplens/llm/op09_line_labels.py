"""Quality rules by labelling lines: a linear-chain conditional random field.

Every line with a word becomes a set of discrete features (how much of it is
letters, capitals, symbols, bars, repeats, how long it is). A chain over the lines
of a document scores labels and their changes; Viterbi decoding marks each line as
content or boilerplate, and the share of words in content lines decides whether
the document stays.

The field is fitted on at most ``TRAIN_ROWS`` labelled documents, those with the
smallest hash of their id, and on all lines of these. Lines take the label of their
document. Lines that look like the rest of the corpus occur mostly in good documents, so
they are learnt as content wherever they stand. How labels follow one another is
learnt from seeds: a first fit of single lines labels every line by itself, and pairs of
neighbours are counted. (Documents' labels would say that labels never change.)
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from serplens.llm import wordhash

#: Bound of the fitting sample.
TRAIN_ROWS = 4000
#: Lines of a chain in the fit: longer documents are fitted as several chains.
CHAIN_LINES = 128
#: A document stays if at least this share of its words is in content lines.
CONTENT_SHARE = 0.5
#: The base rule: fewer words than this, or more than this percentage of repeats.
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
REPEAT_WINDOW = 5

_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
_CLASSES = (("symbols", b"#*$%&|<>", (0.0, 0.02, 0.08)), ("bangs", b"!?", (0.0, 0.05)),
            ("digits", b"0123456789", (0.0, 0.1, 0.3)), ("ends", b".,;:", (0.0, 0.05)))
_UPPER = bytes(range(65, 91))
_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256))


def _share(line: bytes, members: bytes, of: int) -> float:
    """Bytes of ``line`` among ``members``, as a share of ``of``."""
    return (len(line) - len(line.translate(None, members))) / of


def _level(share: float, bounds: tuple[float, ...]) -> int:
    return sum(share > b for b in bounds)


#: (name, number of values) of a line's features, in the order of ``line_features``.
FEATURES = tuple((name, len(bounds) + 1) for name, _, bounds in _CLASSES) + (
    ("capitals", 4), ("words", 4), ("distinct", 3), ("repeat", 2), ("place", 3))
N_FEATURES = sum(n for _, n in FEATURES)


def line_features(line: bytes, words: list[bytes], seen: bool, place: int) -> list[int]:
    """Index of the active feature of each kind. ``seen``: the line occurred before in its text."""
    size = sum(map(len, words))
    values = []
    for _, members, bounds in _CLASSES:
        values.append(_level(_share(line, members, size), bounds))
    values.append(_level(_share(line, _UPPER, _share(line, _LETTERS, 1) or 1), (0.15, 0.4, 0.8)))
    values.append(_level(len(words), (1, 4, 10)))
    values.append(_level(1 - len(set(words)) / len(words), (0.7, 0.9)))
    values.append(int(seen))
    values.append(place)
    at, out = 0, []
    for (_, n), v in zip(FEATURES, values):
        out.append(at + v)
        at += n
    return out


def document_lines(text: bytes) -> tuple[np.ndarray, np.ndarray, int]:
    """(features per line, words per line) of the lines with a word, and how many repeat an earlier one."""
    rows, counts, seen = [], [], set()
    lines = [(line, words) for line in text.split(b"\n") if (words := line.split())]
    for i, (line, words) in enumerate(lines):
        rows.append(line_features(line, words, line in seen, 0 if i == 0 else 2 if i == len(lines) - 1 else 1))
        counts.append(len(words))
        seen.add(line)
    return np.array(rows, dtype=np.int64).reshape(len(rows), len(FEATURES)), np.array(counts, dtype=np.int64), len(lines) - len(seen)


@dataclass(frozen=True)
class Field:
    """Scores of labels 0 (boilerplate) and 1 (content): per feature, first line, and change."""

    emit: np.ndarray
    first: np.ndarray
    change: np.ndarray

    def scores(self, features: np.ndarray) -> np.ndarray:
        return self.emit[features].sum(axis=1)

    def viterbi(self, features: np.ndarray) -> np.ndarray:
        """The likeliest labels of a document's lines; a tie goes to content."""
        if len(features) == 0:
            return np.zeros(0, np.int64)
        emit, ((a, b), (c, d)) = self.scores(features).tolist(), self.change.tolist()
        bad, good = emit[0][0] + self.first[0], emit[0][1] + self.first[1]
        back = []
        for eb, eg in emit[1:]:
            from_good = (good + c >= bad + a, good + d >= bad + b)
            back.append(from_good)
            bad, good = max(bad + a, good + c) + eb, max(bad + b, good + d) + eg
        label = int(good >= bad)
        labels = [label]
        for to_bad, to_good in reversed(back):
            label = int(to_good if label else to_bad)
            labels.append(label)
        return np.array(labels[::-1], dtype=np.int64)


#: Without labelled documents every line counts as content.
NO_FIELD = Field(np.zeros((N_FEATURES, 2)), np.zeros(2), np.zeros((2, 2)))


class _Chains:
    """Chains of about equal length, padded to the longest, with their lines' features."""

    def __init__(self, chains: list[tuple[np.ndarray, int, float, bool]]):
        """``chains``: features, label, weight of a line, whether it begins a document."""
        lengths = np.array([len(f) for f, *_ in chains])
        self.real = np.arange(lengths.max())[None, :] < lengths[:, None]
        self.flat = np.concatenate([f for f, *_ in chains])
        self.labels = np.array([y for _, y, *_ in chains])
        self.weight = np.array([w for _, _, w, _ in chains])
        self.begins = np.array([b for *_, b in chains], dtype=float)
        self.of = np.repeat(np.arange(len(chains)), lengths)
        self.gold = np.zeros((len(chains), 2))
        self.gold[np.arange(len(chains)), self.labels] = 1

    def expected(self, field: Field) -> np.ndarray:
        """Probability of each label at every place, given the whole chain."""
        real, change = self.real, field.change
        n, longest = real.shape
        line = np.zeros((n, longest, 2))
        line[real] = field.scores(self.flat)
        ahead, behind = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
        ahead[:, 0] = line[:, 0] + self.begins[:, None] * field.first
        for t in range(1, longest):
            into = np.logaddexp(ahead[:, t - 1, :1] + change[0], ahead[:, t - 1, 1:] + change[1]) + line[:, t]
            ahead[:, t] = np.where(real[:, t, None], into, ahead[:, t - 1])
            back = longest - 1 - t
            after = line[:, back + 1] + behind[:, back + 1]
            out = np.logaddexp(after[:, :1] + change[:, 0], after[:, 1:] + change[:, 1])
            behind[:, back] = np.where(real[:, back + 1, None], out, 0)
        total = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])
        return np.exp(ahead + behind - total[:, None, None])


def _chains(documents: list[tuple[np.ndarray, int]]) -> list[_Chains]:
    """All lines in chains, those of a length up to the same power of two together.

    Both labels weigh the same in total, and within a label every document.
    """
    n = [sum(y == label for _, y in documents) for label in (0, 1)]
    by_size: dict[int, list] = {}
    for f, y in documents:
        for i in range(0, len(f), CHAIN_LINES):
            part = f[i:i + CHAIN_LINES]
            by_size.setdefault(int(len(part) - 1).bit_length(), []).append((part, y, 0.5 / n[y] / len(f), i == 0))
    return [_Chains(by_size[size]) for size in sorted(by_size)]


def _fitted(groups: list[_Chains], change: np.ndarray, rounds: int, rate: float, decay: float) -> Field:
    """Scores of features and of first lines, for given scores of changes, by adaptive steps of likelihood."""
    field = Field(np.zeros((N_FEATURES, 2)), np.zeros(2), change)
    params = (field.emit, field.first)
    squares = [np.zeros_like(p) for p in params]
    for _ in range(rounds):
        grads = [-decay * p for p in params]
        for g in groups:
            here = g.expected(field)
            off = (g.gold[g.of] - here[g.real]) * g.weight[g.of, None]
            for label in (0, 1):
                grads[0][:, label] += np.bincount(g.flat.ravel(), np.repeat(off[:, label], g.flat.shape[1]), N_FEATURES)
            grads[1] += ((g.gold - here[:, 0]) * (g.weight * g.begins)[:, None]).sum(axis=0)
        for p, g, s in zip(params, grads, squares):
            s += g * g
            p += rate * g / np.sqrt(s + 1e-12)
    return field


def changes(documents: list[tuple[np.ndarray, int]], seeds: Field) -> np.ndarray:
    """Scores of pairs of labels, from how often neighbours have equal ones when lines are labelled one by one.

    A quarter of the log odds ratio of the four counts, for or against; what is left of a pair's score favours one
    label, and that is for the features to learn. Documents of both labels weigh the
    same in total; a document of one label throughout counts as well.
    """
    pairs = np.zeros((2, 2))
    n = [sum(y == label for _, y in documents) for label in (0, 1)]
    for features, y in documents:
        scores = seeds.scores(features)
        labels = (scores[:, 1] >= scores[:, 0]).astype(int)
        if len(labels) > 1:
            np.add.at(pairs, (labels[:-1], labels[1:]), 1 / n[y] / (len(labels) - 1))
    pairs = pairs / max(pairs.sum(), 1e-9) + 0.01
    same = np.log(pairs[0, 0] * pairs[1, 1] / (pairs[0, 1] * pairs[1, 0])) / 4
    return np.array([[same, -same], [-same, same]])


def fit(documents: list[tuple[np.ndarray, int]], rounds: int = 60, rate: float = 0.2, decay: float = 1e-4) -> Field:
    """A field of maximum likelihood, where every line of a document has its label.

    First each line is a chain of its own; the labels it gives its lines are the seeds of
    the scores of changes. With these, features are fitted again, by forward and
    backward sums over whole chains. All lines take part; documents are cut into chains
    of at most ``CHAIN_LINES``, so memory follows the number of lines.
    """
    documents = [(f, y) for f, y in documents if len(f)]
    if len({y for _, y in documents}) < 2:
        return NO_FIELD
    groups = _chains(documents)
    alone = _fitted(groups, np.zeros((2, 2)), rounds, rate, decay)
    return _fitted(groups, changes(documents, alone), rounds, rate, decay)


def training_lines(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> list[tuple[np.ndarray, int]]:
    """Features of all lines, and the label, of at most ``rows`` labelled documents, the same ones in every run.

    Of rows that repeat a labelled id the one with the least text counts.
    """
    chosen = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)") \
        .groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality")) \
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)

    def run(batches):
        for batch in batches:
            features = [document_lines((t or "").encode())[0].astype("<i2").tobytes()
                        for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(features, pa.binary()), batch.column(2)],
                                             names=["doc_id", "features", "quality"])

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(chosen, "doc_id") \
        .groupBy("doc_id").agg(F.min("text").alias("text"), F.first("quality").alias("quality")) \
        .mapInArrow(run, "doc_id bigint, features binary, quality int").toPandas().sort_values("doc_id")
    return [(np.frombuffer(f, "<i2").astype(np.int64).reshape(-1, len(FEATURES)), int(q))
            for f, q in zip(found["features"], found["quality"])]


def fit_field(docs: DataFrame, labels: DataFrame) -> Field:
    return fit(training_lines(docs, labels))


def repeated_words(windows: np.ndarray, k: int) -> int:
    """Words inside windows of ``k`` words that occur twice or more among ``windows``."""
    if len(windows) < 2:
        return 0
    _, which, times = np.unique(windows, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(times[which] > 1)
    if len(starts) == 0:
        return 0
    return int(np.minimum(np.diff(starts, append=starts[-1] + k), k).sum())


VERDICT = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
           "base_failed boolean, content_words bigint, kept boolean")
_NAMES = [c.split()[0] for c in VERDICT.split(", ")]


def _verdicts(texts: pa.Array, field: Field, share: float) -> list[list]:
    columns: list[list] = [[] for _ in _NAMES]
    for _, raw, at in wordhash.slices(texts):
        words, bounds = wordhash.word_hashes(raw, at, fold=False)
        windows = wordhash.window_hashes(words, REPEAT_WINDOW)
        letters = np.concatenate(([0], np.cumsum(wordhash.in_words(raw) & ((raw & 0xC0) != 0x80))))
        symbols = np.concatenate(([0], np.cumsum(_SYMBOLS[raw])))
        for i in range(len(at) - 1):
            a, b = int(bounds[i]), int(bounds[i + 1])
            features, counts, repeated = document_lines(raw[at[i]:at[i + 1]].tobytes())
            n = b - a
            repeats = repeated_words(windows[a:max(a, b - REPEAT_WINDOW + 1)], REPEAT_WINDOW)
            failed = n < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * n
            content = int(counts[field.viterbi(features) == 1].sum())
            for column, value in zip(columns, (
                    n, int(letters[at[i + 1]] - letters[at[i]]), int(symbols[at[i + 1]] - symbols[at[i]]),
                    repeated, repeats, failed, content, not failed and content >= share * n)):
                column.append(value)
    return columns


def quality(docs: DataFrame, field: Field, share: float = CONTENT_SHARE) -> DataFrame:
    """``docs`` (text, any other columns) with the columns of ``VERDICT``.

    A null, empty or white-space text has no words, fails the base rule and is
    not kept. Long texts are read whole. Equal rows get equal verdicts; columns
    named like the added ones are replaced; an empty table gives no rows.
    """
    rest = [c for c in docs.columns if c not in _NAMES]
    types = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = ", ".join(f"`{c}` {types[c]}" for c in rest) + ", " + VERDICT

    def run(batches):
        for batch in batches:
            # Whole rows go back, so they go in slices: a batch is not held a second time.
            for first, _, at in wordhash.slices(batch.column(rest.index("text"))):
                rows = batch.slice(first, len(at) - 1)
                found = [pa.array(c, pa.bool_() if n in ("base_failed", "kept") else pa.int64())
                         for c, n in zip(_verdicts(rows.column(rest.index("text")), field, share), _NAMES)]
                yield pa.RecordBatch.from_arrays([*rows.columns, *found], names=[*rest, *_NAMES])

    return docs.select(*rest).mapInArrow(run, schema)


def keep_good(docs: DataFrame, field: Field, share: float = CONTENT_SHARE) -> DataFrame:
    """Rows of ``docs`` that are kept, with their own columns."""
    mine = [c for c in docs.columns if c in _NAMES]
    held = docs.withColumnsRenamed({c: f"_own_{c}" for c in mine})
    return quality(held, field, share).where("kept").drop(*_NAMES) \
        .withColumnsRenamed({f"_own_{c}": c for c in mine}).select(*docs.columns)
