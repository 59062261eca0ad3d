"""Language-model scoring by deleted interpolation.

Word 1- and 2-gram counts of the whole training set are gathered by
``chunks.exchange_keys``. The probability of a token w after v mixes the
maximum-likelihood estimates f(w|v), f(w) and 1 / (V + 1), with weights that
depend on how often v was seen (powers of two). The weights are learned by
expectation-maximisation on held-out counts: the tokens of every training
document of the held-out lane, each estimate with that document's own counts
taken off. For that the tokens' estimates are binned on a log scale
(``BINS_PER_DECADE``), a table of bounded size. The mix sums to one over the
vocabulary and one unknown word.

A token is a word with A-Z lowered, then one end per text; the first token
follows a start mark, which is no token. Hashes are 64 bits for words and 48
bits above the bucket's own for pairs.

Defined cases: a null or empty text is the end alone; a null doc_id is scored
like any other; repeated rows are each learned from and scored; without
training rows the counts are 0 and only the unknown word is left; an empty
table gives no rows; other columns are not returned.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlens.llm import chunks as CH
from gridlens.llm.common import combine, span_hashes, word_spans

BINS_PER_DECADE = 20
DECADES = 16
CONTEXT_BUCKETS = 24
ROUNDS = 60
END, START = np.uint64(0x5D8C0A2F9B3E7A11), np.uint64(0x8A1F63C24E97D505)

#: Lanes: learned from, learned from and used for the weights, only scored.
TRAIN, WEIGHTS, SCORED = 0, 1, 2


def _tokens(c: CH.Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes with ends, hashes of the token before, n+1 offsets."""
    parts, counts = [np.zeros(0, np.uint64)], []
    for i, j in CH.doc_blocks(c.off):
        data, at = c.data[c.off[i]:c.off[j]], c.off[i:j + 1] - c.off[i]
        starts, ends, woff = word_spans(data, at)
        parts.append(np.insert(span_hashes(data, starts, ends, lower=True), woff[1:], END))
        counts.append(np.diff(woff) + 1)
    tokens, off = np.concatenate(parts), np.concatenate([[0], np.cumsum(np.concatenate(counts))])
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[off[:-1]] = START
    return tokens, before, off


def _pairs(tokens: np.ndarray, before: np.ndarray) -> np.ndarray:
    return combine(before, tokens)


def _keys(c: CH.Chunk) -> list[tuple[np.ndarray, np.ndarray]]:
    tokens, before, off = _tokens(c)
    learned = c.lane != SCORED
    # the start mark rides along as a word, to count the texts
    words, _, n1 = CH.distinct(np.append(tokens, START))
    n1[words == START] = len(off) - 1
    pairs, _, n2 = CH.distinct(_pairs(tokens, before))
    return [(words, n1 * learned), (pairs, n2 * learned)]


def _sum_counts(kind, order, first, values):
    total = np.add.reduceat(values[order].astype(np.int64), first)
    if total.max(initial=0) >= 1 << 32:
        raise OverflowError("an n-gram count passes 32 bits")
    return total, int((total > 0).sum()) if kind == 0 else 0, int(total.sum()) if kind == 0 else 0


def _own(doc: np.ndarray, place: np.ndarray, weights=None) -> np.ndarray:
    """How often each element's (document, place) occurs in its document."""
    key = doc.astype(np.int64) * (int(place.max(initial=0)) + 1) + place
    _, inverse, n = CH.distinct(key.astype(np.uint64))
    return n[inverse]


def _estimates(c: CH.Chunk, answers: dict[int, np.ndarray], deleted: bool):
    """Per token: counts of the word, its context and the pair; offsets."""
    tokens, before, off = _tokens(c)
    words, at, _ = CH.distinct(np.append(tokens, START))
    c1_of = answers[0].astype(np.int64)
    at_before = np.empty(len(tokens), np.int64)
    at_before[1:] = at[:-2]
    at_before[off[:-1]] = at[-1]
    _, at2, _ = CH.distinct(_pairs(tokens, before))
    c1, cv, c2 = c1_of[at[:-1]], c1_of[at_before], answers[1].astype(np.int64)[at2]
    if deleted:
        doc = np.repeat(np.arange(len(off) - 1), np.diff(off))
        c1, cv, c2 = c1 - _own(doc, at[:-1]), cv - _own(doc, at_before), c2 - _own(doc, at2)
    return tokens, c1, cv, c2, off


def _context(cv: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(cv + 1).astype(np.int64), CONTEXT_BUCKETS - 1)


def _bin(p: np.ndarray) -> np.ndarray:
    """0 for probability 0, else 1 + its place on the log scale."""
    with np.errstate(divide="ignore"):
        q = np.rint(-np.log10(p) * BINS_PER_DECADE)
    return np.where(p > 0, 1 + np.minimum(q, DECADES * BINS_PER_DECADE), 0).astype(np.int64)


def _value(q: np.ndarray) -> np.ndarray:
    return np.where(q > 0, 10.0 ** (-(q - 1) / BINS_PER_DECADE), 0.0)


def learn_weights(hist: list[tuple[int, int, int, int]], vocabulary: int) -> np.ndarray:
    """Weights (pair, word, uniform) per context bucket by EM over
    (context, bin of f(w|v), bin of f(w), tokens)."""
    weights = np.tile([0.3, 0.5, 0.2], (CONTEXT_BUCKETS, 1))
    weights[0] = [0.0, 0.8, 0.2]
    h = np.array(hist, np.int64).reshape(-1, 4)
    p = np.stack([_value(h[:, 1]), _value(h[:, 2]), np.full(len(h), 1.0 / (vocabulary + 1))], axis=1)
    for b in np.unique(h[:, 0]):
        own, n = p[h[:, 0] == b], h[h[:, 0] == b, 3]
        w = weights[b]
        for _ in range(ROUNDS):
            joint = own * w
            w = (n[:, None] * joint / joint.sum(axis=1, keepdims=True)).sum(axis=0) / n.sum()
        w = np.maximum(w, [0.0, 1e-9, 1e-9])  # every word keeps some probability
        weights[b] = w / w.sum()
    return weights


def score_texts(docs: DataFrame, lane: Column) -> DataFrame:
    """(doc_id, lane, n_tokens, n_known, train_tokens, vocabulary,
    base_score, score) per row; ``lane`` says what a row is for."""
    texts = CH.chunk_table(docs, F.col("doc_id"), lane, "lm-chunks")
    answers = CH.exchange_keys(texts, _keys, [8, 6], _sum_counts, CH.n_buckets(texts), "lm-counts")
    # the start mark was summed as a word: its count is the number of texts learned from
    sums = answers.where("chunk is null").agg(F.sum("s1"), F.sum("s2")).first()
    n_texts = texts.where(F.col("lane") != SCORED).agg(F.sum(F.size("lens"))).first()[0] or 0
    vocabulary, total = (sums[0] or 0) - (n_texts > 0), (sums[1] or 0) - n_texts

    def binned(c: CH.Chunk, got: dict[int, np.ndarray]) -> pa.Table:
        _, c1, cv, c2, off = _estimates(c, got, deleted=True)
        rest = np.repeat(total - np.diff(off), np.diff(off))
        f1, f2 = c1 / np.maximum(1, rest), c2 / np.maximum(1, cv)
        size = DECADES * BINS_PER_DECADE + 2
        key = (_context(cv) * size + _bin(f2)) * size + _bin(f1)
        u, n = np.unique(key, return_counts=True)
        return pa.table({"ctx": pa.array(u // (size * size), pa.int32()), "q2": pa.array(u // size % size, pa.int32()),
                         "q1": pa.array(u % size, pa.int32()), "n": pa.array(n, pa.int64())})

    held = texts.where(F.col("lane") == WEIGHTS)
    hist = (CH.with_answers(held, answers.join(held.select("chunk"), "chunk", "left_semi"), binned,
                            "ctx int, q2 int, q1 int, n long")
            .groupBy("ctx", "q2", "q1").agg(F.sum("n").alias("n")).collect())  # bounded by the bins
    weights = learn_weights([tuple(r) for r in sorted(hist)], vocabulary)

    def scored(c: CH.Chunk, got: dict[int, np.ndarray]) -> pa.Table:
        tokens, c1, cv, c2, off = _estimates(c, got, deleted=False)
        w = weights[_context(cv)]
        p = w[:, 0] * (c2 / np.maximum(1, cv)) + w[:, 1] * (c1 / max(1, total)) + w[:, 2] / (vocabulary + 1)
        per = functools.partial(np.add.reduceat, indices=off[:-1])
        n = len(off) - 1
        return pa.table({
            "doc_id": pa.array(c.ids, pa.int64(), mask=c.ids == -(1 << 63)), "lane": pa.array(np.full(n, c.lane, np.int32)),
            "n_tokens": pa.array(np.diff(off)), "n_known": pa.array(per((c1 > 0).astype(np.int64))),
            "train_tokens": pa.array(np.full(n, total, np.int64)), "vocabulary": pa.array(np.full(n, vocabulary, np.int64)),
            "base_score": pa.array(per(np.log10((c1 + 1) / (total + vocabulary + 1)))),
            "score": pa.array(per(np.log10(np.maximum(p, 1e-300))))})

    return CH.with_answers(texts, answers, scored, "doc_id long, lane int, n_tokens long, n_known long, train_tokens long, "
                           "vocabulary long, base_score double, score double")
