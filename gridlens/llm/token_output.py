"""Token-id output: canonical length-limited Huffman blocks.

``tokenize`` turns texts into ids with a tokenizers-library vocabulary whose
pieces never span white space: each distinct word is encoded once per
worker and the ids are gathered per text. ``write_tokens`` counts ids over the whole
table, builds a length-limited code (package-merge, at most ``MAX_BITS``),
range-partitions the documents by doc_id and writes them as blocks;
``read_tokens`` reads the files back.

File format: ``<path>/codes`` (id int, bits int) and ``<path>/blocks``, both
Parquet. Codes are canonical: ordered by (bits, id), the first is zero. A
block is a row (part, block, before, n_tokens, doc_ids, doc_tokens,
checkpoints, payload): whole documents in ascending doc_id order, ``payload``
big-endian 64-bit words with the codes' high bits first, and the bit offset
of every ``STEP``-th token in ``checkpoints``. Blocks are independent, and
all stretches of a block are decoded side by side through one table of
2^(longest code) entries. ``part`` and ``block`` order the blocks; ``before``
counts the ids of the same part in earlier blocks. Between the steps ids are
16 bits wide if the vocabulary allows it, else 32.

Defined cases: a null or empty text is the end id alone; a null doc_id comes
first; rows with equal doc_id are ordered by their ids; an empty table writes
no blocks; a code of a single id has one bit; other columns are not written.
"""

from __future__ import annotations

import functools
import itertools
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlens.llm.common import (BLOCK_BYTES, flat_text, materialize, n_parts, ragged_arange, span_hashes, sub_batches, word_spans)

MAX_BITS = 20
STEP = 64
BLOCK_TOKENS = 1 << 17
#: Words a worker keeps encoded before it starts afresh.
CACHE_WORDS = 1 << 22


class WordEncoder:
    """Encodes texts word by word and remembers the words it has seen, in
    arrays ordered by the word's 64-bit hash (about 36 bytes a word): a large
    set, and a small one of the latest that is merged in from time to time."""

    SMALL = 1 << 17

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.dtype = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self.forget()

    def forget(self) -> None:
        none = (np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.uint32))
        self.sets = [none, none]  # (hash, first id, number of ids) of the large and the small set
        self.ids = np.zeros(0, self.dtype)

    def _merge(self, into: int, more: tuple) -> None:
        at = np.searchsorted(self.sets[into][0], more[0])
        self.sets[into] = tuple(np.insert(a, at, b) for a, b in zip(self.sets[into], more))

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        """Take in words with ascending, unknown hashes."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        count = np.fromiter(map(len, found), np.uint32, len(found))
        first = (len(self.ids) + np.cumsum(count, dtype=np.int64) - count).astype(np.uint32)
        self.ids = np.concatenate([self.ids, np.fromiter(itertools.chain.from_iterable(found), self.dtype, int(count.sum()))])
        self._merge(1, (hashes, first, count))
        if len(self.sets[1][0]) > self.SMALL:
            self._merge(0, self.sets[1])
            self.sets[1] = tuple(a[:0] for a in self.sets[1])

    def _find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First id and number of ids of each word, and which are known."""
        first, count, known = np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        for h, f, c in self.sets:
            if len(h):
                at = np.minimum(np.searchsorted(h, hashes), len(h) - 1)
                hit = h[at] == hashes
                first[hit], count[hit] = f[at[hit]], c[at[hit]]
                known |= hit
        return first, count, known

    def encode(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts and the n+1 offsets."""
        data, off = flat_text(col)
        starts, ends, woff = word_spans(data, off)
        distinct, at, back = np.unique(span_hashes(data, starts, ends, lower=False), return_index=True, return_inverse=True)
        if len(self.sets[0][0]) > CACHE_WORDS:
            self.forget()
        first, count, known = self._find(distinct)
        if not known.all():
            raw, new = data.tobytes(), at[~known]
            self._learn(distinct[~known], [raw[a:z].decode("utf-8", "replace") for a, z in zip(starts[new], ends[new])])
            first, count, known = self._find(distinct)
        n = count[back]
        ids = self.ids[np.repeat(first[back], n) + ragged_arange(n)]
        return ids, np.concatenate([[0], np.cumsum(n)])[woff]


@functools.lru_cache(maxsize=1)
def encoder(vocabulary: str) -> WordEncoder:
    """One encoder per Python worker: later tasks profit from its words."""
    return WordEncoder(vocabulary)


def _binary(ids: np.ndarray, off: np.ndarray) -> pa.Array:
    """Rows of a binary column; ``off`` counts ids."""
    return pa.Array.from_buffers(pa.binary(), len(off) - 1, [
        None, pa.py_buffer((off * ids.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(ids))])


def _ids(col: pa.Array, width: int) -> np.ndarray:
    return flat_text(col)[0].view(f"<u{width}") if len(col) else np.zeros(0, f"<u{width}")


def id_width(vocabulary: str) -> int:
    """Bytes of an id between the steps."""
    return encoder(vocabulary).dtype().itemsize


def tokenize(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """(doc_id, n_tokens, ids): little-endian ids, the end id last."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(vocabulary)
        for whole in batches:
            for b in sub_batches(whole, "text", BLOCK_BYTES // 2):
                ids, off = words.encode(b.column("text"))
                ids, off = np.insert(ids, off[1:], end_id), off + np.arange(len(off))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), pa.array(np.diff(off)), _binary(ids, off)], ["doc_id", "n_tokens", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids binary")


def count_ids(tokens: DataFrame, width: int) -> dict[int, int]:
    """Global count of each id: summed in each task first, so at most one row
    per id and task is shuffled; the result is bounded by the vocabulary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for b in batches:
            if b.num_rows:
                c = np.bincount(_ids(b.column("ids"), width), minlength=len(total))
                c[:len(total)] += total
                total = c
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at].astype(np.int64))], ["id", "n"])

    rows = tokens.select("ids").mapInArrow(run, "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))
    return {r["id"]: r["n"] for r in rows.collect()}


def code_lengths(counts: dict[int, int], max_bits: int = MAX_BITS) -> dict[int, int]:
    """Optimal code lengths of at most ``max_bits`` (package-merge)."""
    if len(counts) <= 1:
        return dict.fromkeys(counts, 1)
    if len(counts) > 1 << max_bits:
        raise ValueError(f"{len(counts)} ids need more than {max_bits} bits")
    order = sorted(counts, key=lambda i: (counts[i], i))
    leaf = np.array([counts[i] for i in order], np.int64)
    is_leaf = []
    packages = np.zeros(0, np.int64)
    for _ in range(max_bits):
        merged = np.concatenate([leaf, packages])
        by = np.argsort(merged, kind="stable")
        is_leaf.append(by < len(leaf))
        merged = merged[by]
        packages = merged[0:len(merged) - 1:2] + merged[1::2]
    bits, take = np.zeros(len(leaf), np.int64), 2 * len(leaf) - 2
    for level in reversed(is_leaf):
        leaves = int(level[:take].sum())
        bits[:leaves] += 1
        take = 2 * (take - leaves)
    return dict(zip(order, bits.tolist()))


def canonical_codes(bits: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Code and length per id (length 0: the id has no code)."""
    size = max(bits, default=-1) + 1
    code, length = np.zeros(size, np.uint64), np.zeros(size, np.int64)
    value = last = 0
    for n, i in sorted((n, i) for i, n in bits.items()):
        value <<= n - last
        code[i], length[i] = value, n
        value, last = value + 1, n
    return code, length


def pack(ids: np.ndarray, code: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Big-endian words of the ids' codes, and the bit offset of every STEP-th id."""
    n = length[ids]
    off = np.cumsum(n)
    words = np.zeros((int(off[-1]) >> 6 if len(off) else 0) + 2, np.uint64)
    off -= n
    if len(ids):
        c, word, shift = code[ids], off >> 6, 64 - (off & 63) - n
        over = np.flatnonzero(shift < 0)  # codes that go on in the next word
        high = c << np.maximum(shift, 0).astype(np.uint64)
        high[over] = c[over] >> (-shift[over]).astype(np.uint64)
        first = np.concatenate([[0], np.flatnonzero(word[1:] != word[:-1]) + 1])
        words[word[first]] = np.add.reduceat(high, first)
        words[word[over] + 1] |= c[over] << (64 + shift[over]).astype(np.uint64)
    return words.astype(">u8"), off[::STEP]


class Decoder:
    def __init__(self, code: np.ndarray, length: np.ndarray):
        self.bits = int(length.max()) if len(length) else 1
        self.id, self.length = np.zeros(1 << self.bits, np.uint32), np.zeros(1 << self.bits, np.int64)
        for i in np.flatnonzero(length):
            a = int(code[i]) << (self.bits - int(length[i]))
            b = a + (1 << (self.bits - int(length[i])))
            self.id[a:b], self.length[a:b] = i, length[i]

    def unpack(self, payload: bytes, checkpoints: np.ndarray, n: int) -> np.ndarray:
        words = np.frombuffer(payload, ">u8").astype(np.uint64)
        out = np.zeros((len(checkpoints), STEP), np.uint32)
        pos = checkpoints.astype(np.int64).copy()
        rest = np.uint64(64 - self.bits)
        for k in range(STEP):
            if k == (n - 1) % STEP + 1:  # the last stretch ends here
                pos = pos[:-1]
            word, bit = pos >> 6, (pos & 63).astype(np.uint64)
            peek = (words[word] << bit) | ((words[word + 1] >> np.uint64(1)) >> (np.uint64(63) - bit))
            entry = (peek >> rest).astype(np.int64)
            out[:len(pos), k] = self.id[entry]
            pos = pos + self.length[entry]
        return out.reshape(-1)[:n]


_BLOCK = ("part int, block int, before long, n_tokens long, doc_ids array<bigint>, doc_tokens array<bigint>, "
          "checkpoints array<bigint>, payload binary")


def write_tokens(tokens: DataFrame, path: str, width: int) -> None:
    """Write (doc_id, n_tokens, ids) in ascending doc_id order. ``tokens`` is
    read three times (counts, range bounds, blocks): pass a written table."""
    spark = tokens.sparkSession
    bits = code_lengths(count_ids(tokens, width))
    spark.createDataFrame(list(bits.items()), "id int, bits int").coalesce(1).write.parquet(f"{path}/codes")
    shared = spark.sparkContext.broadcast(canonical_codes(bits))  # bounded by the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, length = shared.value
        part, block, before = TaskContext.get().partitionId(), 0, 0
        for whole in batches:
            for b in sub_batches(whole, "ids", width * BLOCK_TOKENS):
                ids = _ids(b.column("ids"), width)
                words, marks = pack(ids, code, length)
                yield pa.RecordBatch.from_arrays([
                    pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([before]), pa.array([len(ids)]),
                    pa.array([b.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                    pa.array([b.column("n_tokens").to_pylist()], pa.list_(pa.int64())),
                    pa.array([marks], pa.list_(pa.int64())), pa.array([words.tobytes()], pa.binary())],
                    [x.split()[0] for x in _BLOCK.split(", ")])
                block, before = block + 1, before + len(ids)

    ordered = (tokens.repartitionByRange(n_parts(spark), F.col("doc_id").asc_nulls_first())
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "ids"))
    ordered.select("doc_id", "n_tokens", "ids").mapInArrow(run, _BLOCK).write.option(
        "compression", "uncompressed").parquet(f"{path}/blocks")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) decoded from the files; ``start`` counts
    the ids of all documents before, ``ids`` are little-endian uint32."""
    bits = {r["id"]: r["bits"] for r in spark.read.parquet(f"{path}/codes").collect()}  # bounded by the vocabulary
    shared = spark.sparkContext.broadcast(canonical_codes(bits))
    blocks = spark.read.schema(_BLOCK).parquet(f"{path}/blocks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = None
        for b in batches:
            for r in range(b.num_rows):
                decoder = decoder or Decoder(*shared.value)
                part, _, before, n = (b.column(i)[r].as_py() for i in range(4))
                counts = b.column("doc_tokens")[r].values
                marks = b.column("checkpoints")[r].values.to_numpy(zero_copy_only=False)
                ids = decoder.unpack(b.column("payload")[r].as_py(), marks, n)
                off = np.concatenate([[0], np.cumsum(counts.to_numpy(zero_copy_only=False))])
                yield pa.RecordBatch.from_arrays([
                    b.column("doc_ids")[r].values, pa.array(np.full(len(counts), part, np.int32)),
                    pa.array(before + off[:-1]), counts, _binary(ids.astype("<u4"), off)],
                    ["doc_id", "part", "within", "n_tokens", "ids"])

    docs = blocks.mapInArrow(run, "doc_id long, part int, within long, n_tokens long, ids binary")
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()  # one row per partition
    first = list(zip([r["part"] for r in parts], itertools.accumulate([0] + [r["n"] for r in parts])))
    firsts = spark.createDataFrame(first, "part int, _first long")
    return docs.join(F.broadcast(firsts), "part").select(
        "doc_id", (F.col("_first") + F.col("within")).alias("start"), "n_tokens", "ids")


def ids_crc32(tokens: DataFrame) -> DataFrame:
    """Replace ``ids`` by the unsigned crc32 of its bytes."""
    return tokens.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def token_table(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    return materialize(tokenize(docs, vocabulary, end_id), "token-ids")
