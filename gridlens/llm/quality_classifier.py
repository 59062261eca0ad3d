"""Quality classifier: logistic regression on hashed word 1- and 2-grams,
trained with follow-the-regularised-leader (FTRL-proximal) updates.

The n-grams are taken over the words as written and over their shapes (kind
of the first and the last two bytes; a word equal to the one before it has a
shape of its own, so repetition shows). A feature's value is 1 + ln(count);
the values of a text have length 1 together, so the length of a text does
not drive its score. A bias is added. Training takes at most ``max_rows`` labels,
those with the smallest hash of their id (a documented bound on the fit
alone). ``shards`` tasks run FTRL over a share of them each; the model is the
mean of their weights, one float per hash bucket, so what is broadcast has a
fixed size. Scoring is one sparse dot product per whole text.

Defined cases: rows without id, text or label are not learned from; a null or
empty text is scored by the bias alone; without any labelled row every score
is 0.5; conflicting labels of one id are all learned from; other columns pass
through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlens.llm.common import combine, flat_text, mix64, span_hashes, sub_batches, word_spans


@dataclass(frozen=True)
class FtrlParams:
    bits: int = 18
    max_rows: int = 12_000
    shards: int = 6
    epochs: int = 4
    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 0.001
    l2: float = 0.01


_KIND = np.arange(256, dtype=np.uint64)  # punctuation stands for itself
_KIND[48:58], _KIND[65:91], _KIND[97:123], _KIND[128:] = 48, 65, 97, 97
_AGAIN = np.uint64(0x3C6EF372FE94F82B)


def features(col: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct feature buckets of each text and their values, concatenated,
    and n+1 offsets."""
    data, off = flat_text(col)
    starts, ends, off = word_spans(data, off)
    h, n = span_hashes(data, starts, ends, lower=False), len(off) - 1
    doc = np.repeat(np.arange(n, dtype=np.int64), np.diff(off))
    shape = mix64((_KIND[data[starts]] << np.uint64(16)) | (_KIND[data[ends - 1]] << np.uint64(8))
                  | _KIND[data[np.maximum(starts, ends - 2)]])
    if len(h) > 1:
        shape[1:][(h[1:] == h[:-1]) & (doc[1:] == doc[:-1])] = _AGAIN
    pair = np.flatnonzero(doc[:-1] == doc[1:])
    grams = [(doc, h), (doc, shape), (doc[pair], combine(h[pair], h[pair + 1])), (doc[pair], combine(shape[pair], shape[pair + 1]))]
    mask = np.uint64((1 << bits) - 1)
    key, count = np.unique(np.concatenate([(d << bits) | (x & mask).astype(np.int64) for d, x in grams]), return_counts=True)
    at, value = np.searchsorted(key >> bits, np.arange(n + 1)), 1 + np.log(count)
    square = np.concatenate([[0.0], np.cumsum(value * value)])
    norm = np.sqrt(np.maximum(square[at[1:]] - square[at[:-1]], 1e-12))
    return key & ((1 << bits) - 1), value / np.repeat(norm, np.diff(at)), at


def ftrl(samples: list[tuple[np.ndarray, np.ndarray, float]], p: FtrlParams, seed: int) -> np.ndarray:
    """Weights (bias last) after ``epochs`` passes over the samples."""
    size = (1 << p.bits) + 1
    z, n = np.zeros(size), np.zeros(size)
    order = np.random.default_rng(seed)

    def weights(idx):
        zi = z[idx]
        return np.where(np.abs(zi) <= p.l1, 0.0, -(zi - np.sign(zi) * p.l1) / ((p.beta + np.sqrt(n[idx])) / p.alpha + p.l2))

    for _ in range(p.epochs):
        for k in order.permutation(len(samples)):
            f, x, y = samples[k]
            idx, x = np.append(f, size - 1), np.append(x, 1.0)
            w = weights(idx)
            g = (1.0 / (1.0 + np.exp(-np.clip(w @ x, -35, 35))) - y) * x
            sigma = (np.sqrt(n[idx] + g * g) - np.sqrt(n[idx])) / p.alpha
            z[idx] += g - sigma * w
            n[idx] += g * g
    return weights(np.arange(size))


def fit(labels: DataFrame, docs: DataFrame, params: FtrlParams = FtrlParams(), label_col: str = "label") -> np.ndarray:
    """Mean of the shards' weights. ``labels``: doc_id and a 0/1 label;
    ``docs``: doc_id and text. The labels learned from are chosen before the
    texts are read, so at most ``max_rows`` small rows are broadcast and only
    their texts are shuffled."""
    chosen = (labels.where(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull())
              .select("doc_id", F.col(label_col).cast("double").alias("y"), F.xxhash64("doc_id").alias("k"))
              .orderBy("k", "y").limit(params.max_rows))
    rows = (docs.where(F.col("text").isNotNull()).select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
            .select("y", "k", "text", F.pmod(F.col("k"), F.lit(params.shards)).cast("int").alias("shard")))

    def train(pdf: pd.DataFrame) -> pd.DataFrame:
        samples, pdf = [], pdf.sort_values(["k", "y", "text"])
        for a in range(0, len(pdf), 200):
            part = pdf.iloc[a:a + 200]
            f, x, off = features(pa.array(part["text"], pa.large_string()), params.bits)
            samples += [(f[i:j], x[i:j], y) for i, j, y in zip(off[:-1], off[1:], part["y"])]
        w = ftrl(samples, params, int(pdf["shard"].iloc[0])).astype(np.float32)
        return pd.DataFrame({"n": [len(pdf)], "w": [w.tobytes()]})

    parts = rows.groupBy("shard").applyInPandas(train, "n long, w binary").collect()  # `shards` rows of fixed size
    if not parts:
        return np.zeros((1 << params.bits) + 1, np.float32)
    return np.mean([np.frombuffer(r["w"], np.float32) for r in parts], axis=0)


def dot_products(col: pa.Array, w: np.ndarray, bits: int) -> np.ndarray:
    f, x, off = features(col, bits)
    total = np.concatenate([[0.0], np.cumsum(w[f] * x)])
    return total[off[1:]] - total[off[:-1]] + float(w[-1])


def score(docs: DataFrame, w: np.ndarray, params: FtrlParams = FtrlParams(), out_col: str = "score") -> DataFrame:
    """All columns of ``docs`` but the text, and the probability of label 1."""
    kept = [f for f in docs.schema.fields if f.name not in ("text", out_col)]
    names, bits = [f.name for f in kept], params.bits
    shared = docs.sparkSession.sparkContext.broadcast(np.ascontiguousarray(w, np.float32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in sub_batches(whole, "text"):
                s = 1.0 / (1.0 + np.exp(-np.clip(dot_products(b.column("text"), shared.value, bits), -35, 35)))
                yield pa.RecordBatch.from_arrays([b.column(n) for n in names] + [pa.array(s)], names + [out_col])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"`{out_col}` double"])
    return docs.select(*[F.col(f"`{n}`") for n in names], "text").mapInArrow(run, schema)
