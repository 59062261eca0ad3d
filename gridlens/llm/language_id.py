"""Language identification: averaged hashed subword embeddings and a linear
softmax, trained by mini-batch stochastic gradient descent in numpy, with a
temperature calibrated on rows kept out of the descent.

Subwords are the byte 1- to 4-grams of a text with A-Z lowered and white
space as one mark, hashed to ``2^bits`` buckets; a text is the mean of its
subwords' embeddings. As embedding and softmax are both linear, scoring uses
their product, a table of 2^bits x languages of fixed size that is broadcast.
Training takes the rows with a language whose id has one of the ``max_rows``
smallest hashes (a documented bound on the fit alone), and of
each such row its subwords over the whole text.

The best language is always given for a text with letters; ``und`` if the
text is null or has no letter. ``confident`` rejects an answer whose
calibrated probability is under the threshold at which the rows kept out
reach ``precision``.

Defined cases: null languages are not learned; without training rows all is
``und`` with score 0; repeated rows are scored alike; an empty table gives no
rows; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlens.llm.common import _IS_SPACE, flat_text, mix64, sub_batches

UNDETERMINED = "und"
#: A letter of any script.
LETTER = r"\p{L}"


@dataclass(frozen=True)
class LangParams:
    bits: int = 16
    dims: int = 16
    orders: tuple[int, ...] = (1, 2, 3, 4)
    max_rows: int = 6_000
    epochs: int = 6
    batch: int = 32
    rate: float = 0.5
    precision: float = 0.99


@dataclass
class LangModel:
    labels: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0
    params: LangParams = field(default_factory=LangParams)


_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[_IS_SPACE] = 32


def subwords(data: np.ndarray, p: LangParams) -> Iterator[tuple[int, np.ndarray]]:
    """(order, bucket of the n-gram starting at each byte), texts joined."""
    low = _FOLD[data].astype(np.uint32)
    for n in p.orders:
        if len(low) < n:
            continue
        code = low[:len(low) - n + 1].copy()
        for k in range(1, n):
            code |= low[k:len(low) - n + 1 + k] << np.uint32(8 * k)
        code = (code ^ np.uint32(n * 0x27D4EB2F)) * np.uint32(0x9E3779B1)
        yield n, (code ^ (code >> np.uint32(15))) * np.uint32(0x85EBCA6B) >> np.uint32(32 - p.bits)


def mean_rows(col: pa.Array, table: np.ndarray, p: LangParams) -> np.ndarray:
    """Mean of ``table``'s rows over each text's subwords (none: zeros)."""
    data, off = flat_text(col)
    total, count = np.zeros((len(off) - 1, table.shape[1])), np.zeros(len(off) - 1)
    for n, code in subwords(data, p):
        a, b = off[:-1], np.maximum(off[:-1], off[1:] - n + 1)
        a, b = np.minimum(a, len(code)), np.minimum(b, len(code))
        for j in range(table.shape[1]):
            run = np.cumsum(table[:, j][code], dtype=np.float64)
            run = np.concatenate([[0.0], run])
            total[:, j] += run[b] - run[a]
        count += b - a
    return total / np.maximum(count, 1)[:, None]


def _counts(col: pa.Array, p: LangParams) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct subword buckets of each text and their relative frequency."""
    data, off = flat_text(col)
    grams = dict(subwords(data, p))
    out = []
    for a, b in zip(off[:-1], off[1:]):
        every = np.concatenate([g[a:max(a, b - n + 1)] for n, g in grams.items()] or [np.zeros(0, np.uint32)])
        idx, c = np.unique(every, return_counts=True)
        out.append((idx.astype(np.int64), (c / max(1, len(every))).astype(np.float32)))
    return out


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def descend(texts: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, n_labels: int, p: LangParams) -> tuple[np.ndarray, np.ndarray]:
    """(2^bits x labels table, bias) from SGD over embeddings and softmax."""
    rng = np.random.default_rng(11)
    emb = rng.normal(0, 0.1, (1 << p.bits, p.dims)).astype(np.float32)
    out, bias = rng.normal(0, 0.1, (p.dims, n_labels)).astype(np.float32), np.zeros(n_labels, np.float32)
    steps = max(1, p.epochs * -(-len(texts) // p.batch))
    step = 0
    for _ in range(p.epochs):
        order = rng.permutation(len(texts))
        for a in range(0, len(order), p.batch):
            rate = p.rate * (1 - step / steps)
            step += 1
            rows = order[a:a + p.batch]
            mean = np.stack([texts[i][1] @ emb[texts[i][0]] for i in rows])
            err = _softmax(mean @ out + bias)
            err[np.arange(len(rows)), y[rows]] -= 1
            back = err @ out.T
            out -= rate * mean.T @ err / len(rows)
            bias -= rate * err.mean(axis=0)
            for r, i in enumerate(rows):  # mean of subwords: each row's gradient is scaled up to its share
                emb[texts[i][0]] -= (10 * rate) * texts[i][1][:, None] * back[r]
    return emb @ out, bias


def _calibrate(logits: np.ndarray, y: np.ndarray, precision: float) -> tuple[float, float]:
    """Temperature of least log loss, and the threshold of the precision."""
    grid = np.geomspace(0.02, 5, 40)
    loss = [-np.log(np.maximum(_softmax(logits / t)[np.arange(len(y)), y], 1e-12)).mean() for t in grid]
    t = float(grid[int(np.argmin(loss))])
    prob = _softmax(logits / t)
    top, right = prob.max(axis=1), prob.argmax(axis=1) == y
    order = np.argsort(-top)
    ok = np.cumsum(right[order]) >= precision * np.arange(1, len(y) + 1)
    return t, float(top[order][np.flatnonzero(ok)[-1]]) if ok.any() else 1.0


def fit(labelled: DataFrame, params: LangParams = LangParams(), id_col: str = "doc_id", label_col: str = "lang") -> LangModel:
    known = labelled.where(F.col(label_col).isNotNull()).withColumn("k", F.xxhash64(id_col))
    # the texts are read only once the ids are chosen
    upto = known.select("k").orderBy("k").limit(params.max_rows).agg(F.max("k")).first()[0]
    rows = (known.where((F.col("k") <= F.lit(upto)) & F.col("text").rlike(LETTER))
            .select(F.col(label_col).cast("string").alias("y"), "k", "text", F.lit(0).alias("g")))

    def train(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["k", "y", "text"]).head(params.max_rows)  # rows repeating an id tie
        labels = sorted(set(pdf["y"]))
        y = pdf["y"].map({v: i for i, v in enumerate(labels)}).to_numpy()
        texts = []
        for a in range(0, len(pdf), 100):
            texts += _counts(pa.array(pdf["text"].iloc[a:a + 100], pa.large_string()), params)
        held = np.arange(len(y)) % 8 == 7
        table, bias = descend([t for t, h in zip(texts, held) if not h], y[~held], len(labels), params)
        t, threshold = 1.0, 0.0
        if held.any():
            logits = np.stack([texts[i][1] @ table[texts[i][0]] + bias for i in np.flatnonzero(held)])
            t, threshold = _calibrate(logits, y[held], params.precision)
        return pd.DataFrame({"labels": [labels], "table": [table.astype(np.float32).tobytes()],
                             "bias": [bias.astype(np.float32).tobytes()], "t": [t], "threshold": [threshold]})

    got = rows.groupBy("g").applyInPandas(
        train, "labels array<string>, table binary, bias binary, t double, threshold double").collect()  # one model of fixed size
    if not got:
        return LangModel([], np.zeros((1 << params.bits, 0), np.float32), np.zeros(0, np.float32), params=params)
    r = got[0]
    n = len(r["labels"])
    return LangModel(list(r["labels"]), np.frombuffer(r["table"], np.float32).reshape(-1, n),
                     np.frombuffer(r["bias"], np.float32), r["t"], r["threshold"], params)


def predict(docs: DataFrame, model: LangModel) -> DataFrame:
    """All columns of ``docs`` but the text, with lang_pred, score (the
    calibrated probability) and confident."""
    new = ("lang_pred", "score", "confident")
    kept = [f for f in docs.schema.fields if f.name not in ("text", *new)]
    names = [f.name for f in kept]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        table = np.asfortranarray(m.table)
        for whole in batches:
            for b in sub_batches(whole, "text"):
                letters = np.array(pc.fill_null(pc.match_substring_regex(b.column("text"), LETTER), False))
                if m.labels:
                    prob = _softmax((mean_rows(b.column("text"), table, m.params) + m.bias) / m.temperature)
                    top, best = prob.max(axis=1), prob.argmax(axis=1)
                    lang = np.where(letters, np.array(m.labels, object)[best], UNDETERMINED)
                    top = np.where(letters, top, 0.0)
                else:
                    lang, top = np.full(b.num_rows, UNDETERMINED, object), np.zeros(b.num_rows)
                sure = letters & (top >= m.threshold) & bool(m.labels)
                yield pa.RecordBatch.from_arrays(
                    [b.column(n) for n in names] + [pa.array(lang, pa.string()), pa.array(top), pa.array(sure)], names + list(new))

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept]
                       + ["lang_pred string", "score double", "confident boolean"])
    return docs.select(*[F.col(f"`{n}`") for n in names], "text").mapInArrow(run, schema)
