"""Benchmark decontamination by latent semantic retrieval.

Texts are cut into passages of two neighbouring ``BLOCK``-word blocks, every
block starting one. A passage is its TF-IDF vector over the benchmark's words and 2^bits
buckets of all other words; document frequencies are counted over all
documents, for the benchmark's words exactly (by 64-bit hash), and the smooth
IDF never is 0: an item that many rows hold is searched like any other. A randomised SVD of the
benchmark's passages and the passages of all documents, run as Spark jobs, gives the latent basis, over the words of
the benchmark: Gaussian range finder with power iterations over the benchmark,
then one pass over both and the eigenvectors of the Nystroem form. A document
weighs ``corpus_weight``, or less where there are more than ``corpus_docs``: all of
them together as much as so many. Every
passage x of every document is projected and compared to the projection of
all benchmark passages b: it is a candidate when its cosine, the norm of x
taken over all its words but as that of b at most, is ``cosine`` of what b
itself would get: a short item in a window of other words needs the same share
of its weight as a long one. The benchmark is a stated query set of bounded size, held by each task and
searched in blocks.

A candidate (document, item) is confirmed on words: the longest common
subsequence (LCS) of the item and the part of the text around the candidate
passages must cover ``near`` of the item, or ``loose`` of it if its answer
also is there. Signatures of words and the words both have, with their repeats, first
drop the stretches too poor for any such LCS. The answer is the item's last sentence, or its last five words
if that is shorter or the whole item.

Words are runs of letters and digits (any byte over 127 counts as a letter)
with A-Z lowered, so punctuation and case never hide a copy.

Defined cases: null or empty texts and items match nothing; items under
``min_words`` words have no passages and are found as the exact sequence of
their words; items without a word match nothing; repeated rows are each searched;
a null doc_id is returned as null; empty tables give no rows; other columns
are not returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlens.llm.common import _IS_SPACE, combine, flat_text, span_hashes, sub_batches

BLOCK = 16
#: Most benchmark items: their vectors and words are held by each task.
MAX_ITEMS = 200_000
#: Bits of the signature of a set of words.
SIGN_BITS = 1024
#: Rows of tables summed by counts, not word by word: those of the most frequent words.
FREQUENT = 64
#: Text bytes whose word vectors a task holds at a time.
STEP_BYTES = 1 << 18


@dataclass(frozen=True)
class LsaParams:
    bits: int = 15
    rank: int = 128
    oversample: int = 10
    power: int = 2
    corpus_docs: int = 6_000
    corpus_weight: float = 0.01
    cosine: float = 0.4
    near: float = 0.8
    loose: float = 0.6
    answer: float = 0.8
    min_words: int = 8


_FOLD = np.full(256, 32, np.uint8)
_FOLD[48:58] = np.arange(48, 58)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def words(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of all texts, and the n+1 word offsets."""
    data, off = flat_text(col)
    data = _FOLD[data]
    word = ~_IS_SPACE[data]
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(off), np.int64)
    cut = np.zeros(len(data) + 1, bool)
    cut[off] = True
    begin, last = word.copy(), word.copy()
    begin[1:] &= ~word[:-1] | cut[1:-1]
    last[:-1] &= ~word[1:] | cut[1:-1]
    starts = np.flatnonzero(begin)
    return span_hashes(data, starts, np.flatnonzero(last) + 1, False), np.searchsorted(starts, off)


def passages(off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Blocks (first word of each) and passages (first block, one past the
    last block, text) of texts with the given word offsets."""
    n = -(-np.diff(off) // BLOCK)
    text = np.repeat(np.arange(len(n)), n)
    first = np.cumsum(n) - n
    block = off[text] + BLOCK * (np.arange(len(text)) - first[text])
    a = np.arange(len(text))
    end = first[text] + n[text]
    whole = (a + 1 < end) | (a == first[text])  # the last block of several is part of the one before
    return block, a[whole], np.minimum(a + 2, end)[whole], text[whole]


def _bucket(h: np.ndarray, bits: int) -> np.ndarray:
    return (h >> np.uint64(64 - bits)).astype(np.int64)


@dataclass
class Weights:
    """``norm``: TF-IDF weight of each bucket of words, 1 or more. ``keys``:
    the benchmark's words, ascending; ``start``: the first of each bucket.
    ``row``: the row of tables that each of them has, its own unless there are
    more than 2^bits. ``used``: weight of each row, the rarest word's; rows
    ascend by it."""

    norm: np.ndarray
    keys: np.ndarray
    start: np.ndarray
    row: np.ndarray
    used: np.ndarray

    def of(self, h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Row of tables (-1: none) and weight of each word."""
        key = find_keys(h, self.keys, self.start, bits)
        row, weight = np.full(len(h), -1, np.int32), self.norm[_bucket(h, bits)]
        at = np.flatnonzero(key >= 0)
        row[at] = self.row[key[at]]
        weight[at] = self.used[row[at]]
        return row, weight


def word_keys(items: list[str], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct words of the items, ascending, and the first of each bucket."""
    keys = np.unique(words(pa.array(items, pa.large_string()))[0])
    return keys, np.searchsorted(_bucket(keys, bits), np.arange((1 << bits) + 1)).astype(np.int32)


def find_keys(h: np.ndarray, keys: np.ndarray, start: np.ndarray, bits: int) -> np.ndarray:
    """Place of each word in ``keys``, or -1."""
    out, b = np.full(len(h), -1, np.int32), _bucket(h, bits)
    live, at = np.arange(len(h)), start[b]
    end = start[1:][b]
    while len(live):
        more = at < end
        live, at, end = live[more], at[more], end[more]
        same = keys[at] == h[live]
        out[live[same]] = at[same]
        live, at, end = live[~same], at[~same] + 1, end[~same]
    return out


def _frequent_counts(w, of, n_blocks, few) -> np.ndarray:
    """How often each block has each of the first ``few`` rows."""
    often = np.flatnonzero((w >= 0) & (w < few))
    return np.bincount(of[often] * few + w[often], minlength=n_blocks * few).reshape(n_blocks, few).astype(np.float32)


def _block_sums(w, block, table) -> np.ndarray:
    """Sum of the table's rows ``w`` over the words of each block that have one."""
    of = np.repeat(np.arange(len(block)), np.diff(block, append=len(w)))
    few = min(FREQUENT, len(table))
    out = _frequent_counts(w, of, len(block), few) @ table[:few]
    at = np.flatnonzero(w >= FREQUENT)
    first = np.flatnonzero(np.diff(of[at], prepend=-1))
    left = np.diff(first, append=len(at))
    while len(first):  # the blocks' first such words, then their second ones, ...: faster than reduceat
        out[of[at[first]]] += table[w[at[first]]]
        first, left = first[left > 1] + 1, left[left > 1] - 1
    return out


def _add_to_rows(total, w, block, values) -> None:
    """Adds each block's values to the row ``w`` of each of its words that has one."""
    of = np.repeat(np.arange(len(block)), np.diff(block, append=len(w)))
    few = min(FREQUENT, len(total))
    total[:few] += _frequent_counts(w, of, len(block), few).T @ values
    at = np.flatnonzero(w >= FREQUENT)
    if len(at):
        at = at[np.argsort(w[at], kind="stable")]
        first = np.flatnonzero(np.diff(w[at], prepend=-1))
        total[w[at[first]]] += np.add.reduceat(values[of[at]], first, axis=0)


def _paired(v: np.ndarray, a: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Block sums to passage sums."""
    out = v[a]
    two = z - a > 1
    out[two] += v[a[two] + 1]
    return out


def passage_vectors(h: np.ndarray, off: np.ndarray, table: np.ndarray, weights: Weights, bits: int):
    """Projected passages, their TF-IDF norms over all words, and where they are."""
    block, a, z, text = passages(off)
    if not len(block):
        return np.zeros((0, table.shape[1]), table.dtype), np.zeros(0), a, z, text, block
    row, weight = weights.of(h, bits)
    squares = np.add.reduceat(weight ** 2, block)
    v = _paired(_block_sums(row, block, table), a, z)
    return v, np.sqrt(_paired(squares, a, z)), a, z, text, block


def document_frequency(docs: DataFrame, keys: np.ndarray, start: np.ndarray, p: LsaParams) -> np.ndarray:
    """Documents with each bucket of words that are not in ``keys``, with each
    word of ``keys``, and the number of documents; each task sums its
    documents first."""
    buckets, size = 1 << p.bits, (1 << p.bits) + len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + 1, np.int64)
        for whole in batches:
            for b in sub_batches(whole, "text"):
                h, off = words(b.column("text"))
                key = find_keys(h, keys, start, p.bits)
                doc = np.repeat(np.arange(b.num_rows, dtype=np.int64), np.diff(off))
                seen = np.unique(doc * size + np.where(key >= 0, buckets + key, _bucket(h, p.bits))) % size
                total[:-1] += np.bincount(seen, minlength=size)
                total[-1] += b.num_rows
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["w", "n"])

    n = np.zeros(size + 1)
    got = docs.select("text").mapInArrow(run, "w int, n long").groupBy("w").agg(F.sum("n").alias("n")).toArrow()
    n[got["w"].to_numpy()] = got["n"].to_numpy()  # at most 2^bits + 1 rows and the benchmark's words
    return n


def tf_idf(frequency: np.ndarray, keys: np.ndarray, start: np.ndarray, p: LsaParams) -> Weights:
    n, exact, total = frequency[:1 << p.bits], frequency[1 << p.bits:-1], frequency[-1]
    bucket = _bucket(keys, p.bits)
    n = np.minimum(total, n + np.bincount(bucket, exact, 1 << p.bits))
    row = np.unique(bucket if len(keys) > 1 << p.bits else keys, return_inverse=True)[1].astype(np.int32)
    used = np.zeros(row.max(initial=-1) + 1, np.float32)
    np.maximum.at(used, row, (np.log((1 + total) / (1 + exact)) + 1).astype(np.float32))
    order = np.argsort(used, kind="stable")
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order))
    return Weights((np.log((1 + total) / (1 + n)) + 1).astype(np.float32), keys, start, place[row], used[order])


def gram_product(texts: DataFrame, weights: Weights, q: np.ndarray, p: LsaParams) -> np.ndarray:
    """A'A q, A the weighted passages of all ``texts`` (text, row_weight): each
    task sums its passages, then slabs of rows are summed over the tasks. The
    sums of a task are as large as q, so there are no more tasks than the
    session runs in a few rounds."""
    spark, (size, width), used = texts.sparkSession, q.shape, weights.used[:, None]
    shared = spark.sparkContext.broadcast((np.ascontiguousarray(q * used, np.float32), weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, weights = shared.value
        total = np.zeros((size, width))
        for whole in batches:
            for b in sub_batches(whole, "text", STEP_BYTES):
                h, off = words(b.column("text"))
                block, a, z, text = passages(off)
                if not len(block):
                    continue
                row = weights.of(h, p.bits)[0]
                y = _paired(_block_sums(row, block, table), a, z)
                y *= (b.column("row_weight").to_numpy()[text][:, None] ** 2).astype(np.float32)
                per_block, two = np.zeros((len(block), width), np.float32), z - a > 1
                per_block[a] = y
                per_block[a[two] + 1] += y[two]
                _add_to_rows(total, row, block, per_block)
        parts = np.array_split(total * weights.used[:, None], min(16, size))
        yield pa.RecordBatch.from_arrays([
            pa.array(range(len(parts)), pa.int32()), pa.array([x.tobytes() for x in parts], pa.binary())], ["slab", "sums"])

    def add(t: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.float64) for x in t["sums"].to_pylist())
        return pa.table({"slab": t["slab"].slice(0, 1), "sums": pa.array([total.tobytes()], pa.binary())})

    got = (texts.select("text", "row_weight").coalesce(4 * spark.sparkContext.defaultParallelism)
           .mapInArrow(run, "slab int, sums binary").groupBy("slab")
           .applyInArrow(add, "slab int, sums binary").collect())  # rows of the benchmark's words: bounded with it
    shared.unpersist()
    if not got:
        return np.zeros((size, width))
    return np.concatenate([np.frombuffer(r["sums"], np.float64).reshape(-1, width) for r in sorted(got)])


def latent_basis(benchmark: DataFrame, docs: DataFrame, weights: Weights, p: LsaParams) -> np.ndarray:
    """A row per used bucket: TF-IDF weight times right singular vectors, from
    a randomised SVD of the passages of both (text, row_weight): power
    iterations over the benchmark find where its passages lie, one pass over
    the benchmark and all documents weighs them."""
    size = len(weights.used)
    if not size:
        return np.zeros((0, 1), np.float32)
    q = np.random.default_rng(5).normal(size=(size, min(p.rank + p.oversample, size)))
    for _ in range(p.power):
        q, _ = np.linalg.qr(gram_product(benchmark, weights, q, p))
    y = gram_product(docs.union(benchmark), weights, q, p)
    inner = q.T @ y
    values, vectors = np.linalg.eigh((inner + inner.T) / 2)
    held = values > 1e-9 * max(values.max(), 1e-300)  # A'A is about y inner^-1 y'
    best = np.linalg.svd(y @ (vectors[:, held] / np.sqrt(values[held])), full_matrices=False)[0][:, :p.rank]
    return (best * weights.used[:, None]).astype(np.float32)


def lcs(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence: one bit per element of a."""
    at: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        at[x] = at.get(x, 0) | (1 << i)
    full = (1 << len(a)) - 1
    v = full
    for x in b.tolist():
        m = at.get(x)
        if m is not None:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def _answer_words(text: str) -> int:
    """Number of the item's last words that are its answer."""
    n = np.diff(words(pa.array([text, *[s for s in text.split(".") if s.strip()][-1:]], pa.large_string()))[1])
    last = int(n[1]) if len(n) > 1 else 0
    return last if 5 <= last < n[0] else 5


def signatures(h: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    """A bit for each word of the n sets, ``of`` the set of each."""
    out = np.zeros((n, SIGN_BITS // 64), np.uint64)
    for k in range(0, n, 8192):
        a, z = np.searchsorted(of, [k, k + 8192])
        bits = np.zeros((min(8192, n - k), SIGN_BITS), bool)
        bits[of[a:z] - k, (h[a:z] & np.uint64(SIGN_BITS - 1)).astype(np.int64)] = True
        out[k:k + 8192] = np.packbits(bits, axis=1).view(np.uint64)
    return out


def _sequences(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each word on that has so many."""
    m = max(0, len(h) - n + 1)
    return combine(*[h[k:k + m] for k in range(n)])


def short_matches(h: np.ndarray, off: np.ndarray, bench: "Benchmark") -> list[tuple]:
    """Like ``confirm``, of the items under ``min_words`` words."""
    out = []
    for n, (keys, of) in bench.short.items():
        every = _sequences(h, n)
        text = np.searchsorted(off, np.arange(len(every)), "right") - 1
        first, last = np.searchsorted(keys, every), np.searchsorted(keys, every, "right")
        at = np.flatnonzero((last > first) & (np.arange(len(every)) + n <= off[text + 1]))
        for t, a, z in np.unique(np.stack([text[at], first[at], last[at]], axis=1), axis=0).tolist():
            out += [(t, int(bench.ids[i]), 1.0, 1.0, 1.0) for i in of[a:z]]
    return out


class Benchmark:
    """Words, answers and latent passage vectors of the items."""

    def __init__(self, items: list[tuple[int, str]], table: np.ndarray, weights: Weights, p: LsaParams):
        h, off = words(pa.array([t for _, t in items], pa.large_string()))
        self.ids = np.array([i for i, _ in items], np.int64)
        self.words = [h[a:z] for a, z in zip(off[:-1], off[1:])]
        self.distinct = [np.unique(w, return_counts=True) for w in self.words]
        self.short: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for n in range(1, p.min_words):
            of = np.flatnonzero(np.diff(off) == n)
            if len(of):
                key = _sequences(np.concatenate([self.words[i] for i in of]), n)[::n]
                order = np.argsort(key)
                self.short[n] = key[order], of[order]
        self.answers = [w[-_answer_words(t):] for w, (_, t) in zip(self.words, items)]
        v, norm, _, _, self.item, _ = passage_vectors(h, off, table, weights, p.bits)
        latent = np.linalg.norm(v, axis=1)
        keep = (np.diff(off)[self.item] >= p.min_words) & (latent > 0) if len(self.item) else np.zeros(0, bool)
        self.item = self.item[keep]
        # x . b >= cosine min(|x|, |b|) |b'|^2 / |b|, b' the projection: scaled so that the bound is min(|x|, |b|)
        self.vectors = v[keep] * (norm[keep] / (p.cosine * latent[keep] ** 2))[:, None]
        self.norm = norm[keep].astype(np.float32)
        self.least = float((p.cosine * latent[keep] / norm[keep]).min()) if keep.any() else 1.0
        self.least_length = float((p.cosine * latent[keep]).min()) if keep.any() else np.inf
        self.length = np.diff(off)
        self.signs = signatures(h, np.repeat(np.arange(len(items)), self.length), len(items))


def candidates(h: np.ndarray, off: np.ndarray, table: np.ndarray, weights: Weights, bench: Benchmark, p: LsaParams):
    """(text, item, first word, cosine as a share of the item's own) of the
    passages that pass."""
    v, norm, a, _, text, block = passage_vectors(h, off, table, weights, p.bits)
    length = np.linalg.norm(v, axis=1)
    able = np.flatnonzero((length >= np.minimum(bench.least * norm, bench.least_length)) & (norm > 0))  # others pass no bound
    out = [np.zeros((0, 4))]
    for k in range(0, len(bench.item), 4096):
        for m in range(0, len(able), 16_384):
            x = able[m:m + 16_384]
            dot = v[x] @ bench.vectors[k:k + 4096].T
            i, j = np.nonzero(dot >= np.minimum(norm[x][:, None].astype(np.float32), bench.norm[k:k + 4096]))
            x = x[i]
            out.append(np.stack([text[x], bench.item[k + j], block[a[x]], p.cosine * dot[i, j] / norm[x]], axis=1))
    return np.concatenate(out)


def _stretches(off: np.ndarray, found: np.ndarray, bench: Benchmark) -> tuple[np.ndarray, ...]:
    """(text, item, first word, one past the last, best cosine) of the
    stretches around the candidate passages of a (text, item)."""
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    text, item, start = found[:, :3].T.astype(np.int64)
    new = np.ones(len(found), bool)  # the next block's passage goes on with the stretch
    new[1:] = (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (start[1:] > start[:-1] + BLOCK)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(found)) - 1
    text, item, reach = text[first], item[first], bench.length[item[first]]
    return (text, item, np.maximum(off[text], start[first] - reach),
            np.minimum(off[text + 1], start[last] + 2 * BLOCK + reach), np.maximum.reduceat(found[:, 3], first))


def _possible(h, off, item, a, z, bench: Benchmark, p: LsaParams) -> np.ndarray:
    """Stretches with so many of the item's distinct words that an LCS can be
    long enough: each one missing costs a word at least."""
    block = passages(off)[0]
    signs = signatures(h, np.repeat(np.arange(len(block)), np.diff(block, append=len(h))), len(block))
    signs = np.concatenate([signs, np.zeros((1, signs.shape[1]), np.uint64)])
    out = np.zeros(len(item), bool)
    for k in range(0, len(item), 16_384):
        i = item[k:k + 16_384]
        edge = np.stack([np.searchsorted(block, a[k:k + 16_384], "right") - 1, np.searchsorted(block, z[k:k + 16_384])], axis=1)
        held = np.bitwise_or.reduceat(signs, edge.ravel(), axis=0)[::2]
        lacks = np.bitwise_count(bench.signs[i] & ~held).sum(axis=1)
        out[k:k + 16_384] = bench.length[i] - lacks >= p.loose * bench.length[i]
    return out


def confirm(h: np.ndarray, off: np.ndarray, found: np.ndarray, bench: Benchmark, p: LsaParams) -> list[tuple]:
    """(text, item, cosine, LCS share, answer share) of the confirmed leaks:
    the best of the stretches around the candidate passages of a (text, item)."""
    if not len(found):
        return []
    text, item, a, z, cosine = _stretches(off, found, bench)
    best: dict[tuple[int, int], tuple] = {}
    for k in np.flatnonzero(_possible(h, off, item, a, z, bench, p)):
        t, i, part = int(text[k]), int(item[k]), h[a[k]:z[k]]
        need, (distinct, count) = bench.words[i], bench.distinct[i]
        place = np.minimum(np.searchsorted(distinct, part), len(distinct) - 1)
        of_item = distinct[place] == part
        both = np.minimum(np.bincount(place[of_item], minlength=len(distinct)), count).sum()
        if both < p.loose * len(need):  # no LCS is longer
            continue
        part = part[of_item]
        share = lcs(need, part) / len(need)
        if share >= p.loose and ((t, i) not in best or share > best[t, i][3]):
            answer = lcs(bench.answers[i], part) / len(bench.answers[i])
            if share >= p.near or answer >= p.answer:
                best[t, i] = (t, int(bench.ids[i]), float(cosine[k]), share, answer)
    return list(best.values())


def fit(docs: DataFrame, benchmark: DataFrame, p: LsaParams = LsaParams()) -> tuple[np.ndarray, Weights, Benchmark]:
    """Latent table, weights and benchmark. ``benchmark``: item_id, text."""
    items = benchmark.where("text is not null").select("item_id", "text").limit(MAX_ITEMS + 1).collect()
    if len(items) > MAX_ITEMS:
        raise ValueError(f"more than {MAX_ITEMS} benchmark items; search them in parts")
    keys, start = word_keys([r["text"] for r in items], p.bits)
    frequency = document_frequency(docs, keys, start, p)
    weights = tf_idf(frequency, keys, start, p)
    each = p.corpus_weight * min(1.0, p.corpus_docs / max(1.0, frequency[-1])) ** 0.5  # passages count by its square
    table = latent_basis(benchmark.where("text is not null").select("text", F.lit(1.0).alias("row_weight")),
                         docs.where("text is not null").select("text", F.lit(each).alias("row_weight")), weights, p)
    return table, weights, Benchmark(sorted((r["item_id"], r["text"]) for r in items), table, weights, p)


def _search(batches: Iterator[pa.RecordBatch], model, p: LsaParams) -> Iterator[tuple[pa.RecordBatch, list[tuple]]]:
    """Slices of the rows, each with its confirmed leaks."""
    for whole in batches:
        for b in sub_batches(whole, "text", STEP_BYTES):
            h, off = words(b.column("text"))
            yield b, confirm(h, off, candidates(h, off, *model, p), model[2], p) + short_matches(h, off, model[2])


def find_leaks(docs: DataFrame, benchmark: DataFrame, params: LsaParams = LsaParams()) -> DataFrame:
    """(doc_id, item_id, cosine, lcs, answer) of each document and item it holds."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, benchmark, params))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, rows in _search(batches, shared.value, params):
            ids = b.column("doc_id").take(pa.array([r[0] for r in rows], pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([r[1] for r in rows], pa.int64())]
                + [pa.array([r[i] for r in rows], pa.float64()) for i in (2, 3, 4)],
                ["doc_id", "item_id", "cosine", "lcs", "answer"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, item_id long, cosine double, lcs double, answer double")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, params: LsaParams = LsaParams()) -> DataFrame:
    """The rows of ``docs`` that hold no item, all columns as they are; rows
    are not shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, benchmark, params))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, rows in _search(batches, shared.value, params):
            clean = np.ones(b.num_rows, bool)
            clean[[r[0] for r in rows]] = False
            yield b.filter(pa.array(clean))

    return docs.mapInArrow(run, docs.schema)
