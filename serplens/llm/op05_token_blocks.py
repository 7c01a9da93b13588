"""Token ids in canonical, length-limited Huffman codes, in independently decodable blocks.

Files hold one row per block: whole documents in ascending doc_id order, the
bits of all their ids, and the bit offset of every ``INTERVAL``-th id. The code
is made of the ids' counts in all documents and is stored beside the blocks as
(id, bits): codes of equal length are consecutive in id order, so lengths are
all a reader needs. A block is decoded by one table look-up per id, for all its
checkpoints at once.

Where the tokenizer's file says that white space is dropped, texts are cut there and
workers remember the ids of distinct words, by a 64-bit hash of their bytes: a slice of
texts is hashed, looked up and gathered as arrays. Any other file's tokenizer is given
whole texts.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from serplens.llm import wordhash
from serplens.sources.storage import discard_at_exit, materialize, scratch_path

END_ID = 1
MAX_BITS = 16
BLOCK_IDS = 1 << 18
INTERVAL = 256
#: Rules of a file by which words may be tokenised one by one: fixed values.
WORD_NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
WORD_PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
     "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
_WHITE = b" \t\n\r\x0b\x0c"
#: Distinct words that a worker remembers before it starts anew, 30 bytes each, and pieces of words.
REMEMBERED, REMEMBERED_PIECES = 2_000_000, 300_000
#: New words are merged into the others when they are more than one in this many.
MERGED_BELOW = 4
_tokenizers: dict[str, WordTokenizer] = {}


def _byte_letters() -> list[str]:
    """The character that stands for each byte: itself if it prints, else the next one from 256 on."""
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b if b in prints else next(spare)) for b in range(256)]


class _Memory(dict):
    """Values of ``make`` by key, each made once."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        value = self[key] = self.make(key)
        return value


@dataclass(frozen=True)
class _WordTable:
    """Sorted hashes of words, where each one's ids begin, and how many they are."""

    hashes: np.ndarray
    places: np.ndarray
    counts: np.ndarray

    @classmethod
    def empty(cls) -> _WordTable:
        return cls(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32))

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of every word, and whether it is there."""
        if len(self.hashes) == 0:
            return np.zeros(len(words), np.int64), np.zeros(len(words), bool)
        place = np.minimum(np.searchsorted(self.hashes, words), len(self.hashes) - 1)
        return place, self.hashes[place] == words

    def merged(self, other: _WordTable) -> _WordTable:
        order = np.argsort(np.concatenate((self.hashes, other.hashes)), kind="stable")
        return _WordTable(*(np.concatenate(pair)[order] for pair in (
            (self.hashes, other.hashes), (self.places, other.places), (self.counts, other.counts))))


class WordTokenizer:
    """A tokenizer file with a memory.

    ``by_words`` tells whether the file's rules are those that this class knows. If so,
    words in ASCII and the Latin-1 letters are lower-cased and cut into pieces here
    and each distinct piece is looked up once in the file's model; any other word
    goes through the whole tokenizer. Both give the tokenizer's own ids.
    """

    SIMPLE = re.compile("[\x21-\x7e\u00c0-\u00ff]+")
    LETTERS = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+")
    PIECE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u00ff]+")
    #: Added tokens hold this; texts with it are left to the tokenizer.
    ADDED = "<|"

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        self.by_words = (
            rules["normalizer"] == WORD_NORMALIZER and rules["pre_tokenizer"] == WORD_PRE_TOKENIZER
            and rules["post_processor"] is None and all(self.ADDED in t["content"] for t in rules["added_tokens"]))
        self.kind = "<u4"
        self.pieces: dict[str, bytes] = {}
        self.letters = dict(enumerate(_byte_letters()))
        self.forget()

    def forget(self) -> None:
        """Start anew: no words are known."""
        self.words = _Memory(self._word)
        self.flat = np.zeros(1 << 16, self.kind)
        self.used = 0
        self.tables = [_WordTable.empty(), _WordTable.empty()]

    def _piece(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            mapped = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
            ids = self.pieces[piece] = np.array([t.id for t in self.whole.model.tokenize(mapped)], dtype=self.kind).tobytes()
        return ids

    def _library(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype=self.kind).tobytes()

    def _word(self, word: bytes) -> bytes:
        text = word.decode()
        if self.LETTERS.fullmatch(text):
            return self._piece(text)
        if not self.SIMPLE.fullmatch(text):
            return self._library(text)
        return b"".join(map(self._piece, self.PIECE.findall(text.lower())))

    def ids(self, text: str | None) -> bytes:
        """Ids of a text as integers of ``kind``; null is empty."""
        if not text:
            return b""
        if self.ADDED in text or not self.by_words:
            return self._library(text)
        if len(self.words) > REMEMBERED_PIECES:
            self.words.clear()
        if len(self.pieces) > REMEMBERED_PIECES:
            self.pieces.clear()
        # The tokenizer lower-cases too; done first, it leaves fewer distinct words.
        return b"".join(map(self.words.__getitem__, text.encode().lower().split()))


    def _learn(self, words: np.ndarray, where: np.ndarray, raw: np.ndarray, at: np.ndarray) -> None:
        """Remember the words at the places ``where`` of a slice; ``words`` are the hashes of all."""
        if len(self.pieces) > REMEMBERED_PIECES:
            self.pieces.clear()
        hashes, first = np.unique(words[where], return_index=True)
        starts = wordhash.word_starts(raw, at)
        stops, where = np.append(starts[1:], len(raw)), where[first]
        ids = [self._word(raw[a:b].tobytes().rstrip(_WHITE).lower())
               for a, b in zip(starts[where].tolist(), stops[where].tolist())]
        flat = np.frombuffer(b"".join(ids), self.kind)
        counts = np.array([len(x) for x in ids], np.int32) // flat.itemsize
        while self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate((self.flat, np.zeros_like(self.flat)))
        self.flat[self.used:self.used + len(flat)] = flat
        places = self.used + np.cumsum(counts, dtype=np.int64) - counts
        self.used += len(flat)
        large, small = self.tables
        small = small.merged(_WordTable(hashes, places, counts))
        if len(small.hashes) * MERGED_BELOW > len(large.hashes):
            large, small = large.merged(small), _WordTable.empty()
        self.tables = [large, small]

    def _found(self, words: np.ndarray, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each word stand in ``flat``, and how many they are."""
        if sum(len(t.hashes) for t in self.tables) > REMEMBERED:
            self.forget()
        places, counts = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        missing = np.arange(len(words))
        for turn in range(2):
            for table in self.tables:
                place, known = table.find(words[missing])
                places[missing[known]], counts[missing[known]] = table.places[place[known]], table.counts[place[known]]
                missing = missing[~known]
            if len(missing) == 0 or turn:
                break
            self._learn(words, missing, raw, at)
        return places, counts

    def slices(self, texts: pa.Array, end_id: int) -> Iterator[tuple[int, pa.Array]]:
        """(first row, ids of each text, closed by ``end_id``) of consecutive slices of texts."""
        end = np.array([end_id], self.kind)
        for first, raw, at in wordhash.slices(texts):
            n = len(at) - 1
            if not self.by_words or self.ADDED.encode() in raw.tobytes():
                yield first, pa.array([self.ids(t) + end.tobytes() for t in texts.slice(first, n).to_pylist()], pa.binary())
                continue
            words, bounds = wordhash.word_hashes(raw, at)
            places, counts = self._found(words, raw, at)
            stops = np.cumsum(counts)
            total = int(stops[-1]) if len(stops) else 0
            from_flat = np.arange(total) + np.repeat(places - (stops - counts), counts)
            # An end after the last word of each text.
            ends = np.concatenate(([0], stops))[bounds[1:]] if n else np.zeros(0, np.int64)
            ids = np.insert(self.flat[from_flat], ends, end)
            offsets = (np.concatenate(([0], ends + np.arange(1, n + 1))) * ids.itemsize).astype(np.int32)
            yield first, pa.BinaryArray.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(ids.tobytes())])


def word_tokenizer(path: str, kind: str) -> WordTokenizer:
    """The tokenizer of a file, kept for the worker's life."""
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    tokenizer = _tokenizers[path]
    if tokenizer.kind != kind:
        tokenizer.kind = kind
        tokenizer.pieces.clear()
        tokenizer.forget()
    return tokenizer


def id_type(path: str, end_id: int) -> str:
    """Integers that hold every id: two bytes for vocabularies of up to 65,536."""
    from tokenizers import Tokenizer
    return "<u2" if max(Tokenizer.from_file(path).get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"


def token_ids(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """(doc_id, ids) per row; ids as little-endian integers, closed by ``end_id``."""
    kind = id_type(path, end_id)

    def run(batches):
        tokenizer = word_tokenizer(path, kind)
        for batch in batches:
            for first, ids in tokenizer.slices(batch.column(1), end_id):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(ids)), ids], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text") \
        .mapInArrow(run, "doc_id bigint, ids binary")


def id_counts(tokens: DataFrame, kind: str) -> DataFrame:
    """(id, n) over all documents; every task sends one row per id it has seen."""
    def run(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            seen = np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), kind), minlength=len(total))
            seen[:len(total)] += total
            total = seen
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["id", "n"])

    return tokens.select("ids").mapInArrow(run, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Bits per symbol of an optimal prefix code of at most ``max_bits``, by package-merge.

    A package is its weight and how many times each symbol takes part in it. The
    cheapest ``2n - 2`` packages of the last level are, level by level, a prefix of
    the sorted symbols plus a prefix of the packages below; so only the number of
    symbols per level is followed down.
    """
    n = len(counts)
    if n == 0:
        return np.zeros(0, np.int64)
    if n == 1:
        return np.ones(1, np.int64)
    max_bits = max(max_bits, int(n - 1).bit_length())
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.int64)
    levels, packages = [], np.zeros(0, np.int64)
    for _ in range(max_bits):
        merged = np.concatenate((leaves, packages))
        by_weight = np.argsort(merged, kind="stable")
        levels.append(by_weight < n)
        merged = merged[by_weight]
        even = len(merged) // 2 * 2
        packages = merged[:even:2] + merged[1:even:2]
    bits = np.zeros(n, np.int64)
    take = 2 * n - 2
    for is_leaf in reversed(levels):
        symbols = int(is_leaf[:take].sum())
        bits[:symbols] += 1
        take = 2 * (take - symbols)
    lengths = np.empty(n, np.int64)
    lengths[order] = bits
    return lengths


class Code:
    """A canonical code: ``ids`` in ascending order and their lengths in bits."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray):
        self.ids, self.lengths = np.asarray(ids, np.int64), np.asarray(lengths, np.int64)
        self.max_bits = int(self.lengths.max(initial=1))
        order = np.lexsort((self.ids, self.lengths))
        ordered = self.lengths[order]
        # In units of the longest code every code starts where the one before it ends.
        room = np.int64(1) << (self.max_bits - ordered)
        starts = np.concatenate(([0], np.cumsum(room)))[:-1] if len(room) else room
        size = int(self.ids.max(initial=0)) + 1
        self.bits_of, self.code_of = np.zeros(size, np.int64), np.zeros(size, np.uint64)
        self.bits_of[self.ids[order]] = ordered
        self.code_of[self.ids[order]] = (starts >> (self.max_bits - ordered)).astype(np.uint64)
        self.table = np.zeros(1 << self.max_bits, np.int64)
        filled = np.repeat(self.ids[order] << 6 | ordered, room)
        self.table[:len(filled)] = filled

    def encode(self, ids: np.ndarray, interval: int = INTERVAL) -> tuple[bytes, np.ndarray]:
        """(payload, bit offset of every ``interval``-th id)."""
        bits = self.bits_of[ids]
        ends = np.cumsum(bits)
        at = ends - bits
        word = at >> 5
        shifted = self.code_of[ids] << (64 - bits - (at & 31)).astype(np.uint64)
        first = np.flatnonzero(np.diff(word, prepend=-1))
        # No code is longer than a word, so every word has codes that start in it.
        out = np.zeros(int(word[-1]) + 2, np.uint64)
        out[:-1] = np.add.reduceat(shifted >> np.uint64(32), first)
        out[1:] += np.add.reduceat(shifted & np.uint64(0xFFFFFFFF), first)
        size = (int(ends[-1]) + 7) // 8
        return out.astype(">u4").tobytes()[:size], at[::interval]

    def decode(self, payload: bytes, offsets: np.ndarray, n: int, interval: int = INTERVAL) -> np.ndarray:
        """The ``n`` ids of a block; all stretches between checkpoints advance together."""
        raw = np.frombuffer(payload + bytes(8), np.uint8).astype(np.int64)
        view = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
        at, last = np.array(offsets, dtype=np.int64), len(raw) - 4
        found = np.zeros((interval, len(at)), np.int64)
        mask, spare = (1 << self.max_bits) - 1, 32 - self.max_bits
        for step in range(min(interval, n)):
            # The last stretch may be shorter; what it reads past its end is cut below.
            entry = self.table[view[np.minimum(at >> 3, last)] >> (spare - (at & 7)) & mask]
            found[step] = entry >> 6
            at += entry & 63
        return found.T.reshape(-1)[:n].astype("<u4")


BLOCKS = ("part int, block int, block_start bigint, n_ids bigint, doc_ids array<bigint>, "
          "doc_lengths array<bigint>, checkpoints array<bigint>, payload binary")


def _blocks(batches: Iterator[pa.RecordBatch], code: Code, kind: str, block_ids: int) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    names = [c.split()[0] for c in BLOCKS.split(", ")]
    start = number = 0
    held: list[tuple] = []

    def flush():
        ids = np.concatenate([x for _, x in held])
        payload, checkpoints = code.encode(ids)
        return pa.RecordBatch.from_arrays([
            pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([start]), pa.array([len(ids)]),
            pa.array([[d for d, _ in held]], pa.list_(pa.int64())),
            pa.array([[len(x) for _, x in held]], pa.list_(pa.int64())),
            pa.array([checkpoints], pa.list_(pa.int64())), pa.array([payload], pa.binary()),
        ], names=names), len(ids)

    weight = 0
    for batch in batches:
        for doc, ids in zip(batch.column(0).to_pylist(), batch.column(1)):
            held.append((doc, np.frombuffer(ids.as_py(), kind).astype(np.int64)))
            weight += len(held[-1][1])
            if weight >= block_ids:
                block, n = flush()
                yield block
                start, number, weight = start + n, number + 1, 0
                held.clear()
    if held:
        yield flush()[0]


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID,
                 max_bits: int = MAX_BITS, block_ids: int = BLOCK_IDS) -> None:
    """Encode every text of ``docs`` (doc_id, text) into ``folder``: ``blocks`` and ``code``.

    Documents are range-partitioned by doc_id; file ``part`` holds the ``part``-th
    range. A null text is the end id alone. Rows that repeat an id are ordered by
    their ids' bytes, null ids come first. The counts that reach the driver are at
    most one per id of the vocabulary.
    """
    tokens = materialize(token_ids(docs, tokenizer, end_id), "token_ids")
    kind = id_type(tokenizer, end_id)
    counted = id_counts(tokens, kind).orderBy("id").toPandas()
    ids, counts = counted["id"].to_numpy(np.int64), counted["n"].to_numpy(np.int64)
    code = Code(ids, code_lengths(counts, max_bits))
    tokens.sparkSession.createDataFrame(
        list(zip(code.ids.tolist(), code.lengths.tolist())), "id bigint, bits bigint"
    ).coalesce(1).write.parquet(f"{folder}/code")
    # The first ids as well, so that rows that repeat an id are dealt out too.
    tokens.repartitionByRange("doc_id", F.substring("ids", 1, 64)).sortWithinPartitions("doc_id", "ids") \
        .mapInArrow(lambda batches: _blocks(batches, code, kind, block_ids), BLOCKS) \
        .write.parquet(f"{folder}/blocks")


def read_code(spark: SparkSession, folder: str) -> Code:
    rows = spark.read.parquet(f"{folder}/code").orderBy("id").toPandas()
    return Code(rows["id"].to_numpy(np.int64), rows["bits"].to_numpy(np.int64))


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document in a folder; blocks are decoded apart.

    ``start`` is the number of ids of all documents before it, over all files.
    """
    blocks = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")
    files = blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        F.col("part").alias("file"),
        F.coalesce(F.sum("n").over(
            Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    code = read_code(spark, folder)

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                ids = code.decode(row["payload"], row["checkpoints"], row["n_ids"])
                ends = np.cumsum([0, *row["doc_lengths"]])
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["part"]] * len(row["doc_ids"]), pa.int32()),
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(ends[:-1] + row["block_start"]),
                    pa.array(row["doc_lengths"], pa.int64()),
                    pa.array([ids[a:b].tobytes() for a, b in zip(ends, ends[1:])], pa.binary()),
                ], names=["part", "doc_id", "within", "n_tokens", "ids"])

    decoded = blocks.mapInArrow(run, "part int, doc_id bigint, within bigint, n_tokens bigint, ids binary")
    # One row per file, of which there are at most ``spark.sql.shuffle.partitions``.
    return decoded.join(F.broadcast(files), F.col("part") == F.col("file")).select(
        "doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids")


def encoded_roundtrip(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from its encoded files."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "token_blocks")
    write_tokens(docs, folder, tokenizer, end_id)
    discard_at_exit(spark, folder)
    return read_tokens(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
