"""Text chunks and key exchange: corpus-wide facts about hashed keys without
one shuffled row per key.

``chunk_table`` packs documents into rows of about ``CHUNK_BYTES`` of text,
written once; nothing is shuffled for it. ``exchange_keys`` lets every chunk
send its distinct keys (sorted 64-bit hashes with one number each) to the
bucket that owns that range of hashes; the bucket combines the numbers of
equal keys and answers each chunk in the order it asked. A key sits in a
bucket once per chunk at most, so a hot key costs one entry a chunk. Keys
travel as packed arrays, so the shuffle holds a few bytes a key.
``with_answers`` brings a chunk and its answers together again.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlens.llm.common import flat_text, materialize, sub_batches

CHUNK_BYTES = 4 << 20
BUCKET_BYTES = 8 << 20

_CHUNK = "chunk long, lane int, ids array<bigint>, lens array<int>, n_bytes long, data binary"
_ANSWER = "chunk long, kind int, bucket int, payload binary, s1 long, s2 long"


@dataclass
class Chunk:
    """Texts of a chunk as one byte array; ``off`` has n+1 offsets."""

    chunk: int
    lane: int
    ids: np.ndarray
    data: np.ndarray
    off: np.ndarray


def squeeze(x: np.ndarray, level: int = 1) -> bytes:
    return zstandard.ZstdCompressor(level=level).compress(np.ascontiguousarray(x).tobytes())


def unsqueeze(x: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(x), dtype)


def chunk_table(docs: DataFrame, id_col: Column, lane: Column, name: str) -> DataFrame:
    """Chunks of the rows of ``docs`` (``text``, null as empty), one lane
    each. A long text makes a long chunk; no text is cut."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, held = TaskContext.get().partitionId(), 0, {}

        def pack(lane):
            nonlocal made
            ids, lens, data = (list(x) for x in zip(*held.pop(lane)))
            data, lens = np.concatenate(data), np.concatenate(lens)
            row = pa.RecordBatch.from_arrays([
                pa.array([(part << 32) | made], pa.int64()), pa.array([lane], pa.int32()),
                pa.array([pa.concat_arrays(ids).to_pylist()], pa.list_(pa.int64())), pa.array([lens], pa.list_(pa.int32())),
                pa.array([len(data)], pa.int64()), pa.array([squeeze(data)], pa.binary())],
                [c.split()[0] for c in _CHUNK.split(", ")])
            made += 1
            return row

        for whole in batches:
            for b in sub_batches(whole, "text"):
                lanes = b.column("lane").to_numpy(zero_copy_only=False)
                for v in np.unique(lanes):
                    own = b if (lanes == v).all() else b.filter(pa.array(lanes == v))
                    data, off = flat_text(own.column("text"))
                    ids = own.column("id")
                    held.setdefault(int(v), []).append((ids, np.diff(off).astype(np.int32), data.copy()))
                    if sum(len(d) for _, _, d in held[int(v)]) >= CHUNK_BYTES:
                        yield pack(int(v))
        for v in list(held):
            yield pack(v)

    rows = docs.select(id_col.cast("long").alias("id"), lane.cast("int").alias("lane"), "text")
    return materialize(rows.mapInArrow(run, _CHUNK), name, codec="uncompressed")


def chunks_of(table: pa.Table | pa.RecordBatch) -> Iterator[Chunk]:
    for r in table.to_pylist():
        off = np.concatenate([[0], np.cumsum(np.array(r["lens"], np.int64))])
        ids = np.array([-(1 << 63) if i is None else i for i in r["ids"]], np.int64)
        yield Chunk(r["chunk"], r["lane"], ids, unsqueeze(r["data"], np.uint8), off)


def doc_blocks(off: np.ndarray, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes, one text at least: bounds
    the arrays that hold several numbers a byte."""
    i, n = 0, len(off) - 1
    while i < n:
        j = min(n, max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1))
        yield i, j
        i = j


def distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ascending distinct values, the place of each element, their counts."""
    order = np.argsort(x, kind="stable")
    ranked = x[order]
    new = np.ones(len(x), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    at = np.flatnonzero(new)
    inverse = np.empty(len(x), np.int64)
    inverse[order] = np.cumsum(new) - 1
    return ranked[at], inverse, np.diff(np.append(at, len(x)))


def n_buckets(chunks: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> int:
    total = chunks.agg(F.sum("n_bytes")).first()[0] or 0
    return max(8, math.ceil(total / bucket_bytes))


def bucket_edges(keys: np.ndarray, buckets: int) -> np.ndarray:
    """First entry of each bucket (and the end) among ascending keys; the
    upper 32 bits say which bucket owns a key."""
    own = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    return np.searchsorted(own, np.arange(buckets + 1, dtype=np.uint64))


def _bucket_start(bucket: int, buckets: int) -> int:
    return -(-(bucket << 32) // buckets) << 32


def exchange_keys(
    chunks: DataFrame,
    keys_of: Callable[[Chunk], list[tuple[np.ndarray, np.ndarray]]],
    widths: list[int],
    combine: Callable[[int, np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, int, int]],
    buckets: int,
    name: str,
) -> DataFrame:
    """Answers (chunk, kind, bucket, payload) as a written table, plus a row
    per (kind, bucket) with chunk null and two sums.

    ``keys_of(chunk)``: per kind, ascending distinct uint64 keys and uint32
    values. ``widths``: bytes of a key kept per kind, beyond what the bucket
    tells. ``combine(kind, order, first, values)``: ``order`` sorts all values
    of the bucket by key, ``first`` are the positions in that order where a
    new key begins; gives a uint32 per distinct key and two sums.
    """
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in chunks_of(b):
                cols = {n: [] for n in ("chunk", "kind", "bucket", "keys", "payload")}
                for kind, (keys, values) in enumerate(keys_of(c)):
                    edge, w = bucket_edges(keys, buckets), widths[kind]
                    for k in np.flatnonzero(np.diff(edge)):
                        a, z = edge[k], edge[k + 1]
                        rest = keys[a:z] - np.uint64(_bucket_start(int(k), buckets))
                        if w < 8:
                            spare = max(0, 64 - 8 * w - max(0, buckets.bit_length() - 1))
                            rest = rest >> np.uint64(spare)
                        packed = rest.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :w]
                        for n, v in zip(cols, (c.chunk, kind, int(k), packed.tobytes(), squeeze(values[a:z].astype(np.uint32)))):
                            cols[n].append(v)
                yield pa.RecordBatch.from_arrays([
                    pa.array(cols["chunk"], pa.int64()), pa.array(cols["kind"], pa.int32()),
                    pa.array(cols["bucket"], pa.int32()), pa.array(cols["keys"], pa.binary()),
                    pa.array(cols["payload"], pa.binary())], list(cols))

    def answer(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        kind, bucket = rows[0]["kind"], rows[0]["bucket"]
        w, keys = widths[kind], []
        for r in rows:
            raw = np.frombuffer(r["keys"], np.uint8).reshape(-1, w)
            full = np.zeros((len(raw), 8), np.uint8)
            full[:, :w] = raw
            keys.append(full.reshape(-1).view("<u8"))
        values = [unsqueeze(r["payload"], np.uint32) for r in rows]
        sizes = [len(v) for v in values]
        keys, values = np.concatenate(keys), np.concatenate(values)
        order = np.argsort(keys, kind="stable")
        ranked = keys[order]
        first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
        result, s1, s2 = combine(kind, order, first, values)
        back = np.empty(len(keys), np.uint32)
        back[order] = np.repeat(result.astype(np.uint32), np.diff(np.append(first, len(keys))))
        parts = np.split(back, np.cumsum(sizes)[:-1])
        return pa.table({
            "chunk": pa.array([r["chunk"] for r in rows] + [None], pa.int64()),
            "kind": pa.array([kind] * (len(rows) + 1), pa.int32()),
            "bucket": pa.array([bucket] * (len(rows) + 1), pa.int32()),
            "payload": pa.array([squeeze(p) for p in parts] + [None], pa.binary()),
            "s1": pa.array([None] * len(rows) + [int(s1)], pa.int64()),
            "s2": pa.array([None] * len(rows) + [int(s2)], pa.int64())})

    sent = chunks.select("chunk", "lane", "ids", "lens", "data").mapInArrow(
        send, "chunk long, kind int, bucket int, keys binary, payload binary")
    return materialize(sent.groupBy("kind", "bucket").applyInArrow(answer, _ANSWER), name, codec="uncompressed")


def with_answers(
    chunks: DataFrame, answers: DataFrame, fn: Callable[[Chunk, dict[int, np.ndarray]], pa.Table], schema: str,
    dtypes: dict[int, type] | None = None,
) -> DataFrame:
    """``fn(chunk, answers per kind in key order)`` for every chunk. Answers
    are uint32 unless ``dtypes`` says otherwise."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        got: dict[int, list] = {}
        for r in sorted(right.to_pylist(), key=lambda r: (r["kind"], r["bucket"])):
            got.setdefault(r["kind"], []).append(unsqueeze(r["payload"], (dtypes or {}).get(r["kind"], np.uint32)))
        found = {k: np.concatenate(v) for k, v in got.items()}
        return pa.concat_tables([fn(c, found) for c in chunks_of(left)])

    asked = answers.where("chunk is not null").select("chunk", "kind", "bucket", "payload")
    return (chunks.select("chunk", "lane", "ids", "lens", "data").groupBy("chunk")
            .cogroup(asked.groupBy("chunk")).applyInArrow(run, schema))
