"""Byte-level BPE encoding and decoding with a tokenizers-library vocabulary.

Texts are cut before white space (blank, tab, line feed, carriage return) that
follows no white space: the pre-tokenizer of such vocabularies always splits
there, whatever surrounds it, so these *units* can be encoded alone. Each
distinct unit is encoded once per worker.

A unit of more than ``LEAF`` bytes is *long unsplit text*. Its pre-tokens are
found first; one of more than ``LEAF`` bytes is halved down to leaves, which
other tasks encode in parallel, and a tree joins them again (``FAN_IN`` nodes a
group and round, two by two). Joining re-encodes a window of the last tokens
of the left and the first of the right half and doubles it on the sides that
do not agree yet. A side agrees when the window's outermost token and its
neighbour outside, encoded as one string, give just these two tokens: BPE output
is exact if and only if that holds for every two tokens in a row.

A text with a long pre-token is finished by one task that streams its parts in
order; nothing but the digests, or the ids, of one part is held at a time.

Defined cases: a null or empty text has no ids; a null doc_id stays null;
repeated rows each get a row; an empty table gives no rows; the strings of
added tokens become their ids, as in the library; other columns are not read.
Vocabularies that are no plain byte-level BPE (normalizer, prefix space,
stripping or white space in added tokens) raise ValueError.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlens.llm.common import flat_text, materialize, ragged_arange, span_hashes, sub_batches
from gridlens.llm.token_output import WordEncoder

#: Bytes of a leaf; unsplit text beyond is encoded by several tasks.
LEAF = 1 << 16
FAN_IN = 64
#: Bytes of text whose ids are held as arrays at a time.
RANGE_BYTES = 1 << 20
#: Ids a worker keeps of the units it has seen before it starts afresh.
CACHE_IDS = 1 << 23

_DONE, _IDS, _LEAF = 0, 1, 2
_PARTS = ("doc_id long, row long, seq int, leaf int, kind int, n_tokens long, ids_sha256 string, decoded_sha256 string, "
          "payload binary")

# bytes that may come before a cut: no white space, nor the end of a longer white space character
_CUT = np.zeros(256, bool)
_CUT[[9, 10, 13, 32]] = True
_BLANK = np.zeros(256, bool)
_BLANK[[*range(9, 14), *range(28, 33)]] = True
_LEAD3, _MID3 = np.zeros(256, bool), np.zeros(256, bool)
_LEAD3[[0xE1, 0xE2, 0xE3]] = True
_MID3[[0x80, 0x81, 0x9A, 0xA0]] = True


def byte_letters() -> dict[str, int]:
    """Byte of each letter that byte-level vocabularies write for it: printable
    Latin-1 for itself, the others from U+0100 on in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBpe(WordEncoder):
    """Encoder of units, with the pieces for joining and decoding."""

    def __init__(self, vocabulary: str):
        super().__init__(vocabulary)
        from tokenizers import Tokenizer

        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(vocabulary, encoding="utf-8") as f:
            spec = json.load(f)
        pre, added = spec.get("pre_tokenizer") or {}, spec.get("added_tokens", [])
        if (spec["model"].get("type") != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec.get("normalizer")
                or not pre.get("use_regex", True) or any(a["lstrip"] or a["rstrip"] or a["single_word"] or re.search(r"\s", a["content"]) for a in added)):
            raise ValueError(f"{vocabulary} is no plain byte-level BPE")
        self.model = Tokenizer(self.tokenizer.model)  # merges alone, on letters of bytes
        self.added = {a["content"]: a["id"] for a in added}
        self.added_re = re.compile("|".join(re.escape(a) for a in sorted(self.added, key=len, reverse=True))) if added else None
        letters = byte_letters()
        self.letter = {b: c for c, b in letters.items()}
        size = 1 + max(self.tokenizer.get_vocab().values())
        self.names = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        spelt = [bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode() for t in self.names]
        self.spelt = self._flat(spelt)
        self.decimal = self._flat([b",%d" % i for i in range(size)])

    @staticmethod
    def _flat(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n = np.array([len(w) for w in words], np.int64)
        return np.frombuffer(b"".join(words), np.uint8), np.cumsum(n) - n, n

    def merge(self, letters: str) -> np.ndarray:
        """Ids of a string of byte letters as a single pre-token."""
        return np.array(self.model.encode(letters, add_special_tokens=False).ids, self.dtype)

    def encode_units(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the units and the number of ids of each."""
        hashes = span_hashes(data, starts, ends, lower=False)
        distinct, at, back = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.ids) > CACHE_IDS:
            self.forget()
        first, count, known = self._find(distinct)
        if not known.all():
            raw, new = data.tobytes(), at[~known]
            self._learn(distinct[~known], [raw[a:z].decode("utf-8") for a, z in zip(starts[new], ends[new])])
            first, count, known = self._find(distinct)
        n = count[back]
        return self.ids[np.repeat(first[back], n) + ragged_arange(n)], n

    # ---------------------------------------------------- tree concatenation
    def pair_agrees(self, x: int, y: int) -> bool:
        return self.merge(self.names[x] + self.names[y]).tolist() == [x, y]

    def join(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ids of the joined strings from the ids of both."""
        if not len(left) or not len(right):
            return left if len(left) else right
        a, b = 1, 1
        while True:
            a, b = min(a, len(left)), min(b, len(right))
            window = self.merge("".join(self.names[i] for i in [*left[len(left) - a:], *right[:b]]))
            agree_left = a == len(left) or self.pair_agrees(int(left[-a - 1]), int(window[0]))
            agree_right = b == len(right) or self.pair_agrees(int(window[-1]), int(right[b]))
            if agree_left and agree_right:
                return np.concatenate([left[:len(left) - a], window, right[b:]])
            a, b = (a if agree_left else 2 * a), (b if agree_right else 2 * b)

    def join_all(self, nodes: list[np.ndarray]) -> np.ndarray:
        while len(nodes) > 1:
            nodes = [self.join(*nodes[i:i + 2]) if i + 1 < len(nodes) else nodes[i] for i in range(0, len(nodes), 2)]
        return nodes[0]

    def pre_tokens(self, text: str) -> Iterator[np.ndarray | str]:
        """The pre-tokens of a text as byte letters, added tokens as ids."""
        at = 0
        for m in self.added_re.finditer(text) if self.added_re else ():
            yield from (t for t, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(text[at:m.start()]))
            yield np.array([self.added[m.group()]], self.dtype)
            at = m.end()
        yield from (t for t, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(text[at:]))

    # ------------------------------------------------------------- ids out
    def write_out(self, ids: np.ndarray, table: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all ids by a table, and the n+1 offsets."""
        flat, start, size = table
        n = size[ids]
        return flat[np.repeat(start[ids], n) + ragged_arange(n)], np.concatenate([[0], np.cumsum(n)])


@functools.lru_cache(maxsize=1)
def bpe(vocabulary: str) -> ByteBpe:
    """One encoder per Python worker: later tasks profit from its units."""
    return ByteBpe(vocabulary)


def unit_starts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """First byte of every unit of the texts."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    cut = _CUT[data]
    cut[1:] &= ~_BLANK[data[:-1]]
    cut[2:] &= ~((data[:-2] == 0xC2) & ((data[1:-1] == 0x85) | (data[1:-1] == 0xA0)))
    cut[3:] &= ~(_LEAD3[data[:-3]] & _MID3[data[1:-2]])
    cut[off[:-1][np.diff(off) > 0]] = True
    return np.flatnonzero(cut)


class _Digest:
    """Running digests of one text's ids and of its decoded bytes."""

    def __init__(self):
        self.n, self.ids, self.text = 0, hashlib.sha256(), hashlib.sha256()

    def add(self, n: int, decimal: np.ndarray, spelt: np.ndarray) -> None:
        """``n`` more ids: ",id" of each, and their bytes (whole characters)."""
        self.ids.update(decimal[1:] if n and not self.n else decimal)
        self.text.update(spelt.tobytes().decode("utf-8", "replace").encode())
        self.n += n

    def row(self) -> tuple[int, str, str]:
        return self.n, self.ids.hexdigest(), self.text.hexdigest()


def _ranges(starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int]]:
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + RANGE_BYTES, "right")))
        yield i, j
        i = j


def _ids_of(enc: ByteBpe, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    a = starts[0]
    return enc.encode_units(data[a:ends[-1]], starts - a, ends - a)


def _long_parts(enc: ByteBpe, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, most: int) -> Iterator[tuple[int, int, int, bytes]]:
    """(seq, leaf, kind, payload) of a text with long units."""
    seq, long = 0, ends - starts > most
    edge = [0, *(np.flatnonzero(long[1:] | long[:-1]) + 1).tolist(), len(starts)]  # long units stand alone
    for x, y in zip(edge[:-1], edge[1:]):
        if not long[x]:
            for i, j in _ranges(starts[x:y], ends[x:y]):
                ids, _ = _ids_of(enc, data, starts[x + i:x + j], ends[x + i:x + j])
                yield seq, 0, _IDS, ids.tobytes()
                seq += 1
            continue
        held: list[np.ndarray] = []
        for t in enc.pre_tokens(data[starts[x]:ends[x]].tobytes().decode("utf-8")):
            if isinstance(t, str) and len(t) > most:
                for part in ([np.concatenate(held)] if held else []):
                    yield seq, 0, _IDS, part.tobytes()
                    seq += 1
                held = []
                halves = 1 << int(-(-len(t) // most) - 1).bit_length()  # leaves of equal size
                cuts = [len(t) * k // halves for k in range(halves + 1)]
                for k, (a, z) in enumerate(zip(cuts[:-1], cuts[1:])):
                    yield seq, k, _LEAF, t[a:z].encode("utf-8")
                seq += 1
            else:
                held.append(enc.merge(t) if isinstance(t, str) else t)
        if held:
            yield seq, 0, _IDS, np.concatenate(held).tobytes()
            seq += 1


def _parts(docs: DataFrame, vocabulary: str, most: int) -> DataFrame:
    """A finished row per text, or the parts of a text with long pre-tokens."""
    def block(enc: ByteBpe, b: pa.RecordBatch, first_row: int) -> Iterator[pa.RecordBatch]:
        data, off = flat_text(b.column("text"))
        starts = unit_starts(data, off)
        ends = np.append(starts[1:], len(data))
        owner = np.searchsorted(off, starts, "right") - 1
        late = np.unique(owner[ends - starts > most])
        digests = [_Digest() for _ in range(b.num_rows)]
        normal = ~np.isin(owner, late)
        s, e, o = starts[normal], ends[normal], owner[normal]
        for i, j in _ranges(s, e):
            ids, n = _ids_of(enc, data, s[i:j], e[i:j])
            decimal, dat = enc.write_out(ids, enc.decimal)
            spelt, sat = enc.write_out(ids, enc.spelt)
            at = np.concatenate([[0], np.cumsum(n)])
            edge = np.concatenate([[0], np.flatnonzero(np.diff(o[i:j])) + 1, [j - i]])
            for x, y in zip(edge[:-1], edge[1:]):
                t, u = at[x], at[y]
                digests[o[i + x]].add(int(u - t), decimal[dat[t]:dat[u]], spelt[sat[t]:sat[u]])
        ids = b.column("doc_id")
        out = [(r, None, None, None, _DONE, *digests[r].row(), None) for r in np.setdiff1d(np.arange(b.num_rows), late)]
        yield _batch(ids, out, first_row)
        for r in late:
            mine = owner == r
            yield _batch(ids, [(r, r, -1, 0, _IDS, None, None, None, b"")], first_row)
            for seq, leaf, kind, payload in _long_parts(enc, data, starts[mine], ends[mine], most):
                yield _batch(ids, [(r, r, seq, leaf, kind, None, None, None, payload)], first_row)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, row = bpe(vocabulary), TaskContext.get().partitionId() << 40
        for whole in batches:
            for b in sub_batches(whole, "text", RANGE_BYTES):
                yield from block(enc, b, row)
                row += b.num_rows

    return materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _PARTS), "bpe-parts")


def _batch(doc_ids: pa.Array, rows: list[tuple], first_row: int) -> pa.RecordBatch:
    at, row, *rest = zip(*rows) if rows else [()] * 9
    cols = [doc_ids.take(pa.array(at, pa.int64())), pa.array([None if r is None else first_row + int(r) for r in row], pa.int64())]
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.binary())
    return pa.RecordBatch.from_arrays(cols + [pa.array(c, k) for c, k in zip(rest, kinds)], [c.split()[0] for c in _PARTS.split(", ")])


def _one_by_one(b: pa.RecordBatch) -> Iterator[dict]:
    for i in range(b.num_rows):
        yield b.slice(i, 1).to_pylist()[0]


def _joined_leaves(parts: DataFrame, vocabulary: str, last_leaf: int, fan_in: int) -> DataFrame:
    """(row, seq, payload ids) of the long pre-tokens: leaves encoded in
    parallel, then joined in rounds."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = bpe(vocabulary)
        for b in batches:
            for r in _one_by_one(b):
                ids = enc.merge(r["payload"].decode("utf-8"))
                yield pa.RecordBatch.from_pylist([r | {"payload": ids.tobytes()}], b.schema)

    def meet(t: pa.Table) -> pa.Table:
        enc = bpe(vocabulary)
        t = t.sort_by("leaf")
        ids = enc.join_all([np.frombuffer(x.as_py(), enc.dtype) for x in t["payload"]])
        head = t.slice(0, 1).to_pylist()[0]
        return pa.Table.from_pylist([head | {"leaf": head["leaf"] // fan_in, "payload": ids.tobytes()}], t.schema)

    schema = "row long, seq int, leaf int, payload binary"
    nodes = parts.where(F.col("kind") == _LEAF).select("row", "seq", "leaf", "payload").repartition("row", "seq", "leaf").mapInArrow(encode, schema)
    nodes = materialize(nodes, "bpe-leaves")
    while last_leaf:
        grouped = nodes.groupBy("row", "seq", F.floor(F.col("leaf") / fan_in).alias("node"))
        nodes, last_leaf = materialize(grouped.applyInArrow(meet, schema), "bpe-nodes"), last_leaf // fan_in
    return nodes.select("row", "seq", "payload")


def encode_decode(docs: DataFrame, vocabulary: str, leaf_bytes: int = LEAF, fan_in: int = FAN_IN) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) per row of ``docs``
    (doc_id, text): digests of the ids as decimals joined by commas, and of
    the bytes those ids decode to."""
    parts = _parts(docs, vocabulary, leaf_bytes)
    columns = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    done = parts.where(F.col("kind") == _DONE).select(*columns)
    late = parts.where(F.col("kind") != _DONE)
    found = late.agg(F.count("*").alias("n"), F.max(F.when(F.col("kind") == _LEAF, F.col("leaf"))).alias("leaf")).first()
    if not found["n"]:
        return done
    whole = late.where(F.col("kind") == _IDS).select("doc_id", "row", "seq", "payload")
    if found["leaf"] is not None:
        joined = _joined_leaves(parts, vocabulary, found["leaf"], fan_in)
        whole = whole.unionByName(joined.withColumn("doc_id", F.lit(None).cast("long")))

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, row, doc_id, digest = bpe(vocabulary), None, None, None

        def finished() -> pa.RecordBatch:
            n, ids, text = digest.row()
            return pa.RecordBatch.from_arrays([pa.array([doc_id], pa.int64()), pa.array([n], pa.int64()),
                                               pa.array([ids]), pa.array([text])], columns)

        for b in batches:
            for r in _one_by_one(b):
                if r["row"] != row:
                    if digest is not None:
                        yield finished()
                    row, doc_id, digest = r["row"], r["doc_id"], _Digest()  # the first part (-1) has the doc_id
                ids = np.frombuffer(r["payload"], enc.dtype)
                digest.add(len(ids), enc.write_out(ids, enc.decimal)[0], enc.write_out(ids, enc.spelt)[0])
        if digest is not None:
            yield finished()

    ordered = whole.repartition("row").sortWithinPartitions("row", "seq")
    return done.union(ordered.mapInArrow(stream, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"))
