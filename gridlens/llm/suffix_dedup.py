"""Suffix-array deduplication of repeated substrings.

Every byte covered by a string of ``WINDOW`` bytes that also starts in a
document with a smaller doc_id is removed. Strings are judged on the input.

The suffixes that are sorted start at *anchors*: in each 50-byte string, the
anchor is the place whose next ``LEAD`` bytes have the smallest hash. Equal
strings have their anchor at the same place, so it is enough to compare the
strings that share an anchor's suffix. Three passes over text chunks:

1. The anchors' lead hashes are exchanged (``chunks.exchange_keys``): an
   anchor whose lead no second document holds owns no repeated string.
2. The suffixes of the other anchors, each with the strings it owns (about 65
   bytes), are merged where equal within a chunk, range-partitioned by their
   leading bytes with splitters sampled from the anchors, and sorted in each
   bucket by multikey quicksort, eight bytes a step, only what still ties
   going on to the next. A splitter is a whole lead, so equal strings never
   lie on two sides of a boundary. A lead seen over ``HOT_LEADS`` times is
   dealt out string by string instead, by its hash, to buckets of its own.
   Per string a bucket answers one bit: does a smaller document hold it?
3. Each chunk turns the bits into removed bytes and spans.

Nothing is lost by 1: it drops only strings no other document holds (a false
hash match just keeps a candidate). A string sits in a bucket once per chunk.

Defined cases: a null or empty text has no bytes; a text under 50 bytes is
kept whole; rows with equal doc_id do not remove each other's bytes; a null
doc_id is the smallest; an empty table gives no rows; other columns are not
returned.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlens.llm import chunks as CH
from gridlens.llm.common import materialize, mix64, ragged_arange, span_hashes

WINDOW, LEAD = 50, 16
#: Strings an anchor may own, and the bytes they span.
MOST = WINDOW - LEAD + 1
SPAN = MOST + WINDOW - 1
HOT_LEADS = 20_000
BUCKET_BYTES = 4 << 20
#: Bounds the splitter table that tasks get (16 bytes each).
MAX_BUCKETS = 1 << 18
SAMPLES = 16

_POS = np.uint64(0xFFFFFFFF)


def _load(data: np.ndarray, at: int, n: int) -> np.ndarray:
    return np.ndarray((n,), "<u8", data, at, (1,))


def _lead_hashes(data: np.ndarray) -> np.ndarray:
    pad = np.concatenate([data, np.zeros(LEAD, np.uint8)])
    a = mix64(_load(pad, 0, len(data)) * np.uint64(0x9E3779B97F4A7C15))
    return mix64(a ^ _load(pad, 8, len(data)))


def anchors(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, ...]:
    """Per anchor: its place, the first string it owns, how many, its lead's
    hash and its text. The strings of an anchor follow each other."""
    out = []
    for i, j in CH.doc_blocks(off):
        base, part = off[i], data[off[i]:off[j]]
        n = len(part) - WINDOW + 1
        if n <= 0:
            continue
        h = _lead_hashes(part)
        least, step = (h & ~_POS) | np.arange(len(part), dtype=np.uint64), 1
        while 2 * step <= MOST:
            least = np.minimum(least[:-step], least[step:])
            step *= 2
        if step < MOST:
            least = np.minimum(least[:len(least) - (MOST - step)], least[MOST - step:])
        place = (least[:n] & _POS).astype(np.int64)
        doc = np.repeat(np.arange(i, j, dtype=np.int32), np.diff(off[i:j + 1]))
        valid = doc[:n] == doc[WINDOW - 1:]
        new = valid.copy()
        new[1:] &= (place[1:] != place[:-1]) | ~valid[:-1]
        first = np.flatnonzero(new)
        upto = np.concatenate([[0], np.cumsum(valid)])
        owned = upto[np.append(first[1:], n)] - upto[first] if len(first) else first
        out.append((place[first] + base, first + base, owned, h[place[first]], doc[first].astype(np.int64)))
    if not out:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.int64))
    return tuple(np.concatenate(x) for x in zip(*out))


def _lead_bytes(data: np.ndarray, place: np.ndarray) -> np.ndarray:
    return np.ndarray((max(0, len(data) - LEAD + 1),), f"S{LEAD}", np.ascontiguousarray(data), 0, (1,))[place]


def _lead_keys(c: CH.Chunk) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct leads; value: twice the occurrences, plus 1 if in two texts."""
    _, _, _, h, doc = anchors(c.data, c.off)
    order = np.argsort(h, kind="stable")
    h, doc = h[order], doc[order]
    at = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
    if not len(at):
        return [(h, np.zeros(0, np.uint32))]
    n = np.diff(np.append(at, len(h)))
    two = np.maximum.reduceat(doc, at) != np.minimum.reduceat(doc, at)
    return [(h[at], 2 * np.minimum(n, 1 << 28) + two)]


def _shared(kind, order, first, values):
    """Occurrences of a lead that two texts hold, else 0."""
    v = values[order].astype(np.int64)
    n = np.add.reduceat(v >> 1, first)
    two = (np.add.reduceat(v & 1, first) > 0) | (np.diff(np.append(first, len(v))) > 1)
    return np.where(two, np.minimum(n, 1 << 31), 0), int(two.sum()), 0


class Candidates:
    """The strings of a chunk that another text may hold: runs (first string,
    number) with the entry each belongs to; entries are the chunk's distinct
    run contents in the order they are sent."""

    def __init__(self, c: CH.Chunk, seen: np.ndarray, splitters: np.ndarray, n_hot: int):
        place, first, owned, h, doc = anchors(c.data, c.off)
        _, inverse, _ = CH.distinct(h)
        count = seen[inverse] if len(h) else np.zeros(0, np.uint32)
        keep = count > 0
        place, first, owned, doc, hot = place[keep], first[keep], owned[keep], doc[keep], count[keep] > HOT_LEADS
        if hot.any():  # one run per string
            times = np.where(hot, owned, 1)
            row = np.repeat(np.arange(len(first)), times)
            first = first[row] + ragged_arange(times)
            owned, place, doc, hot = np.where(hot[row], 1, owned[row]), place[row], doc[row], hot[row]
        self.first, self.owned, self.doc = first, owned, doc
        content = np.zeros(len(first), np.uint64)
        for i, j in CH.doc_blocks(c.off):
            a, z = np.searchsorted(doc, [i, j])
            base = c.off[i]
            content[a:z] = span_hashes(c.data[base:c.off[j]], first[a:z] - base, first[a:z] + owned[a:z] + WINDOW - 1 - base, False)
        distinct, inverse, _ = CH.distinct(content)
        at = np.zeros(len(distinct), np.int64)
        at[inverse[::-1]] = np.arange(len(first))[::-1]  # first run of each content
        self.least = np.full(len(distinct), np.iinfo(np.int64).max)
        np.minimum.at(self.least, inverse, c.ids[doc])
        lead = _lead_bytes(c.data, place[at])
        bucket = np.searchsorted(splitters, lead, "right")
        bucket = np.where(hot[at], len(splitters) + 1 + (distinct % np.uint64(n_hot)).astype(np.int64), bucket)
        order = np.lexsort((distinct, lead, bucket))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.entry = rank[inverse] if len(first) else inverse
        self.at, self.bucket, self.least, self.place = at[order], bucket[order], self.least[order], place[at][order]


def multikey_order(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows of a matrix of 64-bit characters, and the group of
    equal rows each sorted row is in: quicksort by one character, then only
    the ties by the next."""
    n = len(words)
    order = np.argsort(words[:, 0], kind="stable")
    group = np.zeros(n, np.int64)
    if n:
        col = words[order, 0]
        group[1:] = np.cumsum(col[1:] != col[:-1])
    for d in range(1, words.shape[1]):
        tied = np.zeros(n, bool)
        same = group[1:] == group[:-1]
        tied[1:] |= same
        tied[:-1] |= same
        at = np.flatnonzero(tied)
        if not len(at):
            break
        col = words[order[at], d]
        by = np.lexsort((col, group[at]))
        order[at] = order[at][by]
        col, own = col[by], group[at]
        new = np.zeros(n, np.int64)
        new[at[1:]] = (own[1:] == own[:-1]) & (col[1:] != col[:-1])
        new[1:] |= group[1:] != group[:-1]
        group = np.cumsum(new)
    return order, group


def _words(raw: np.ndarray, start: np.ndarray, length: np.ndarray, width: int) -> np.ndarray:
    """Rows of ``width`` bytes (zero beyond each length) as big-endian words."""
    pad = np.concatenate([raw, np.zeros(width, np.uint8)])
    rows = np.lib.stride_tricks.sliding_window_view(pad, width)[start]
    rows = np.where(np.arange(width) < length[:, None], rows, 0).astype(np.uint8)
    return rows.view(">u8").astype(np.uint64)


def _least_by(group: np.ndarray, order: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Smallest value of each row's group, in the rows' own order."""
    least = np.full(int(group[-1]) + 1 if len(group) else 0, np.iinfo(np.int64).max)
    np.minimum.at(least, group, value[order])
    out = np.empty(len(order), np.int64)
    out[order] = least[group]
    return out


def smaller_holders(raw: np.ndarray, owned: np.ndarray, rel: np.ndarray, least: np.ndarray) -> np.ndarray:
    """One bit per string of the entries: is it in a text smaller than the
    entry's smallest? Entries: concatenated contents, strings owned, place of
    the anchor in the content, smallest doc_id."""
    size = owned + WINDOW - 1
    start = np.cumsum(size) - size
    right, left = 8 * -(-WINDOW // 8), 8 * -(-MOST // 8)
    words = np.hstack([
        _words(raw, start + rel, size - rel, right), _words(raw, start, rel, left),
        (rel * 256 + owned).astype(np.uint64)[:, None]])
    order, group = multikey_order(words)  # the anchored suffixes
    known = _least_by(group, order, least)
    # contents whose lead has no other content own their strings alone
    one = np.concatenate([[True], group[1:] != group[:-1]])
    ranked = words[order]
    new_lead = np.ones(len(order), bool)
    new_lead[1:] = (ranked[1:, :LEAD // 8] != ranked[:-1, :LEAD // 8]).any(axis=1)
    lead = np.cumsum(new_lead) - 1
    contents = np.bincount(lead[one])
    n_bits = int(owned.sum())
    bit = np.repeat(known < least, owned)
    head = order[one & (contents[lead] > 1)]  # one entry of each content still to compare
    if len(head):
        w_entry = np.repeat(head, owned[head])
        w_start = start[w_entry] + ragged_arange(owned[head])
        w_order, w_group = multikey_order(_words(raw, w_start, np.full(len(w_start), WINDOW), right))
        holder = _least_by(w_group, w_order, known[w_entry])
        first_of = np.full(int(group[-1]) + 1, -1)
        content = np.empty(len(order), np.int64)
        content[order] = group
        first_of[content[head]] = np.cumsum(owned[head]) - owned[head]
        again = first_of[content] >= 0
        at = np.repeat(np.where(again, first_of[content], 0), owned) + ragged_arange(owned)
        bit = np.where(np.repeat(again, owned), holder[at] < np.repeat(least, owned), bit)
    assert len(bit) == n_bits
    return bit


def _answer(table: pa.Table) -> pa.Table:
    rows = table.to_pylist()
    raw = [CH.unsqueeze(r["raw"], np.uint8) for r in rows]
    owned = [np.frombuffer(r["owned"], np.uint8).astype(np.int64) for r in rows]
    rel = [np.frombuffer(r["rel"], np.uint8).astype(np.int64) for r in rows]
    least = [CH.unsqueeze(r["least"], np.int64) for r in rows]
    bits = smaller_holders(*(np.concatenate(x) for x in (raw, owned, rel, least)))
    parts = np.split(bits, np.cumsum([int(o.sum()) for o in owned])[:-1])
    return pa.table({
        "chunk": pa.array([r["chunk"] for r in rows], pa.int64()), "kind": pa.array([1] * len(rows), pa.int32()),
        "bucket": pa.array([r["bucket"] for r in rows], pa.int32()),
        "payload": pa.array([CH.squeeze(p.astype(np.uint8)) for p in parts], pa.binary())})


def _splitters(chunks: DataFrame, buckets: int) -> np.ndarray:
    """``buckets`` - 1 leads that part the anchors about evenly, from a sample
    of at most SAMPLES * MAX_BUCKETS leads taken from every chunk."""
    n = chunks.count()
    each, rate = max(1, math.ceil(SAMPLES * buckets / max(1, n))), min(1.0, SAMPLES * buckets / max(1, n))

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for c in CH.chunks_of(b):
                rng = np.random.default_rng(c.chunk)
                if not len(c.data) or rng.random() >= rate:
                    continue
                a = int(rng.integers(max(1, len(c.data) - (64 << 10))))
                part = c.data[a:a + (64 << 10)]
                place = anchors(part, np.array([0, len(part)]))[0]
                pick = place[rng.permutation(len(place))[:each]]
                found += [part[p:p + LEAD].tobytes() for p in pick]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], ["lead"])

    rows = chunks.select("chunk", "lane", "ids", "lens", "data").mapInArrow(sample, "lead binary").collect()
    leads = np.sort(np.array([bytes(r["lead"]) for r in rows], f"S{LEAD}"))
    return np.unique(leads[(np.arange(1, buckets) * len(leads)) // buckets]) if len(leads) else leads


def remove_repeats(docs: DataFrame, keep_bytes: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) per row of ``docs``
    (doc_id, text); with ``keep_bytes`` also ``kept``, the bytes left."""
    spark = docs.sparkSession
    chunks = CH.chunk_table(docs, F.col("doc_id"), F.lit(0), "suffix-chunks")
    seen = CH.exchange_keys(chunks, _lead_keys, [4], _shared, CH.n_buckets(chunks), "suffix-leads")
    buckets = min(MAX_BUCKETS, CH.n_buckets(chunks, BUCKET_BYTES))
    n_hot = buckets
    shared = spark.sparkContext.broadcast(_splitters(chunks, buckets))

    def send(c: CH.Chunk, got: dict[int, np.ndarray]) -> pa.Table:
        cand = Candidates(c, got.get(0, np.zeros(0, np.uint32)), shared.value, n_hot)
        first, owned = cand.first[cand.at], cand.owned[cand.at]
        edge = np.flatnonzero(np.diff(cand.bucket, prepend=-1))
        cols = {k: [] for k in ("chunk", "bucket", "raw", "owned", "rel", "least")}
        for a, z in zip(edge, np.append(edge[1:], len(first))):
            size = owned[a:z] + WINDOW - 1
            raw = c.data[np.repeat(first[a:z], size) + ragged_arange(size)]
            rel = cand.place[a:z] - first[a:z]
            for k, v in zip(cols, (c.chunk, int(cand.bucket[a]), CH.squeeze(raw, 3), owned[a:z].astype(np.uint8).tobytes(),
                                   rel.astype(np.uint8).tobytes(), CH.squeeze(cand.least[a:z]))):
                cols[k].append(v)
        types = (pa.int64(), pa.int32(), *[pa.binary()] * 4)
        return pa.table({k: pa.array(v, t) for (k, v), t in zip(cols.items(), types)})

    sent = CH.with_answers(chunks, seen, send, "chunk long, bucket int, raw binary, owned binary, rel binary, least binary")
    bits = materialize(sent.groupBy("bucket").applyInArrow(_answer, "chunk long, kind int, bucket int, payload binary"),
                       "suffix-bits", codec="uncompressed")

    def cut(c: CH.Chunk, got: dict[int, np.ndarray]) -> pa.Table:
        cand = Candidates(c, got.get(0, np.zeros(0, np.uint32)), shared.value, n_hot)
        bit = got.get(1, np.zeros(0, np.uint8)).astype(bool)
        sent_owned = cand.owned[cand.at]
        offset = np.cumsum(sent_owned) - sent_owned
        row = np.repeat(np.arange(len(cand.first)), cand.owned)
        step = ragged_arange(cand.owned)
        entry = cand.entry[row]
        gone = (c.ids[cand.doc[row]] > cand.least[entry]) | bit[offset[entry] + step]
        begin = (cand.first[row] + step)[gone]
        edge = np.zeros(len(c.data) + 1, np.int32)
        np.add.at(edge, begin, 1)
        np.add.at(edge, begin + WINDOW, -1)
        covered = np.cumsum(edge[:-1]) > 0
        opens = covered.copy()
        opens[1:] &= ~covered[:-1]
        inner = c.off[:-1][np.diff(c.off) > 0]
        opens[inner] = covered[inner]  # a span ends with its text
        n_removed = np.concatenate([[0], np.cumsum(covered)])[c.off]
        n_spans = np.concatenate([[0], np.cumsum(opens)])[c.off]
        kept = [c.data[a:z][~covered[a:z]].tobytes() if gone_ else c.data[a:z].tobytes()
                for a, z, gone_ in zip(c.off[:-1], c.off[1:], np.diff(n_removed))]
        table = pa.table({
            "doc_id": pa.array(c.ids, pa.int64(), mask=c.ids == -(1 << 63)), "n_bytes": pa.array(np.diff(c.off)),
            "n_removed": pa.array(np.diff(n_removed).astype(np.int64)), "n_spans": pa.array(np.diff(n_spans).astype(np.int64)),
            "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())})
        return table.append_column("kept", pa.array(kept, pa.binary())) if keep_bytes else table

    facts = seen.where("chunk is not null").select("chunk", "kind", "bucket", "payload")
    return CH.with_answers(chunks, facts.unionByName(bits), cut,
                           "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
                           + ", kept binary" * keep_bytes,
                           dtypes={1: np.uint8})
