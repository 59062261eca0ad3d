"""Isolation forest as Spark jobs.

Algorithm: Liu, Ting, Zhou, "Isolation Forest" (ICDM 2008). Parameters as
in the reference: 200 trees, subsample size min(256, n) drawn without
replacement, all 13 features, seed 42, height limit ceil(log2(psi)).

* Sample (M1): every draw derives from ``md5`` of the row key, the seed and a
  counter, never from ``rand()`` or partition order, so the sample and the
  grown trees do not depend on how the data is partitioned, and any engine
  with md5 draws the same rows. One rule holds at every size: each (row, tree)
  pair is drawn on its own, by geometric skipping.
* Fit (M2): ``groupBy(tree_id).applyInPandas`` grows one tree per group
  of at most 256 rows; feature and threshold of a node come from ``md5`` of
  seed, tree and node. The model is an ordinary table with at most
  ``trees * (2 * 256 - 1)`` rows.
* Score (U1/M3): the node table (size bounded by the model parameters,
  not by the data) is broadcast; an iterator pandas UDF walks all trees
  for a whole Arrow batch at once. Narrow, no shuffle.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridlens.schemas import FEATURE_COLS, FOREST_NODE_SCHEMA, KEY_COLS

# Fixed values of the reference's model.
N_TREES = 200
MAX_SAMPLES = 256
SEED = 42
EULER_GAMMA = 0.5772156649015329

# A feature whose values in a node lie within this range is taken as constant
# there: what is left is rounding (the sine of pi, a mean of equal values).
MIN_RANGE = 1e-9

# Rows scored at a time: SCORE_ROWS x trees arrays, small enough for the cache.
SCORE_ROWS = 256

# Oversampling margin of the hash draw: each tree gets about
# margin * psi candidates, of which the psi lowest-ranked are kept.
DRAW_MARGIN = 1.5


def average_path_length(n):
    """c(n): mean path length of an unsuccessful BST search over n points;
    c(0) = c(1) = 0, c(2) = 1."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    two = n == 2
    big = n > 2
    out[two] = 1.0
    nb = n[big]
    out[big] = 2.0 * (np.log(nb - 1.0) + EULER_GAMMA) - 2.0 * (nb - 1.0) / nb
    return out


def _draw(seed: int, *parts) -> F.Column:
    """md5 of the row key, the seed and ``parts``, as hex."""
    stamp = F.date_format(F.col(KEY_COLS[1]), "yyyyMMddHHmmssSSSSSS")
    return F.md5(F.concat_ws("|", F.col(KEY_COLS[0]), stamp, F.lit(str(seed)),
                             *[p if isinstance(p, str) else p.cast("string") for p in parts]).cast("binary"))


def _unit(digest: F.Column) -> F.Column:
    """The first 52 bits of a digest as a double inside (0, 1)."""
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(2 ** 52))


def forest_sample(features: DataFrame, n_rows: int | None = None, n_trees: int = N_TREES,
                  max_samples: int = MAX_SAMPLES, seed: int = SEED,
                  feature_cols=FEATURE_COLS, margin: float = DRAW_MARGIN) -> tuple[DataFrame, int]:
    """M1: per-tree subsamples without replacement, ``psi = min(256, n)``.

    Returns ``(rows with tree_id and _rank, psi)``. A row joins each tree with
    probability ``margin * psi / n`` (at most one), independently, so it may
    be in several. The trees of a row are found by skipping: the gap before
    the next one is geometric, ``floor(ln(u) / ln(1 - p))``. The first gap
    already rejects nearly all rows of a large table with one hash; further
    gaps are drawn for the kept rows alone. Each tree then keeps the psi rows
    with the smallest rank hash (window over one tree: ~1.5 psi rows).
    """
    n = features.count() if n_rows is None else n_rows
    if n == 0:
        raise ValueError("no training rows")
    psi = min(max_samples, n)
    log_miss = math.log1p(-min(margin * psi / n, 1 - 2.0 ** -52))  # p = 1 is met to the last bit

    def gap(k) -> F.Column:
        u = _unit(_draw(seed, F.lit("gap"), k))
        return F.least(F.floor(F.log(u) / F.lit(log_miss)), F.lit(n_trees)).cast("int")

    first = features.select(*KEY_COLS, *feature_cols).withColumn("_first", gap(F.lit(0))).filter(F.col("_first") < n_trees)
    trees = F.aggregate(
        F.sequence(F.lit(1), F.lit(n_trees)),
        F.struct(F.array("_first").alias("hits"), F.col("_first").alias("at")),
        lambda a, k: F.when(a["at"] >= n_trees, a).otherwise(_next_tree(a, gap(k), n_trees)),
        lambda a: a["hits"])
    drawn = first.withColumn("tree_id", F.explode(trees)).drop("_first")
    drawn = drawn.withColumn("_rank", _draw(seed, F.lit("rank"), F.col("tree_id")))
    w = Window.partitionBy("tree_id").orderBy("_rank", *KEY_COLS)
    sample = (drawn.withColumn("_pos", F.row_number().over(w))
                   .filter(F.col("_pos") <= psi).drop("_pos"))
    return sample, psi


def _next_tree(state: F.Column, gap: F.Column, n_trees: int) -> F.Column:
    at = state["at"] + 1 + gap
    hits = F.when(at < n_trees, F.concat(state["hits"], F.array(at))).otherwise(state["hits"])
    return F.struct(hits.alias("hits"), at.alias("at"))


def split_draw(seed: int, tree_id: int, node_id: int) -> tuple[float, float]:
    """Two uniforms inside (0, 1) for a node: the first and the next 52 bits of
    the md5 of ``seed|tree|node``."""
    digest = hashlib.md5(f"{seed}|{tree_id}|{node_id}".encode()).hexdigest()
    return tuple((int(digest[a:a + 13], 16) + 0.5) / 2.0 ** 52 for a in (0, 13))


def _grow_tree(X: np.ndarray, seed: int, tree_id: int, limit: int, min_range: float = MIN_RANGE) -> list[tuple]:
    """Grow one isolation tree; returns node tuples
    (node_id, feature, threshold, left, right, n_rows, path_len).

    Node ids are heap positions (root 0, children 2i + 1 and 2i + 2). The
    feature is drawn among those whose values span more than ``min_range``,
    the threshold uniformly between their ends, both from ``split_draw``."""
    nodes: list[tuple] = []
    todo = [(X, 0, 0)]
    while todo:
        sub, depth, nid = todo.pop()
        m = len(sub)
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        free = np.flatnonzero(hi - lo > min_range)
        if depth >= limit or free.size == 0:  # one row or equal rows: nothing to split
            nodes.append((nid, -1, 0.0, -1, -1, m, depth + float(average_path_length([m])[0])))
            continue
        pick, place = split_draw(seed, tree_id, nid)
        q = int(free[int(pick * free.size)])
        thr = float(lo[q] + (hi[q] - lo[q]) * place)
        if thr <= lo[q]:
            thr = float(np.nextafter(lo[q], hi[q]))
        go_left = sub[:, q] < thr
        left, right = 2 * nid + 1, 2 * nid + 2
        nodes.append((nid, q, thr, left, right, m, float(depth)))
        todo += [(sub[~go_left], depth + 1, right), (sub[go_left], depth + 1, left)]
    return nodes


def forest_fit(sample: DataFrame, psi: int, seed: int = SEED,
               feature_cols=FEATURE_COLS, n_trees: int = N_TREES,
               tree_tasks: int | None = None) -> DataFrame:
    """M2: one tree per ``tree_id`` group, grown in pandas on <= 256 rows.

    A node's draws depend on (seed, tree, node) alone and its split on the
    ends of its values, so the node table is the same for any order and
    partitioning of the input, and any engine with md5 grows the same one.
    """
    limit = int(math.ceil(math.log2(max(psi, 2))))
    feats = list(feature_cols)

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree_id = int(pdf["tree_id"].iloc[0])
        rows = _grow_tree(pdf[feats].to_numpy(dtype=float), seed, tree_id, limit)
        out = pd.DataFrame(rows, columns=["node_id", "feature", "threshold", "left",
                                          "right", "n_rows", "path_len"])
        out.insert(0, "tree_id", tree_id)
        return out.astype({"tree_id": "int32", "node_id": "int32", "feature": "int32",
                           "left": "int32", "right": "int32", "n_rows": "int32"})

    # The groups are small in bytes but costly in Python, so AQE would
    # coalesce them into a few tasks; a fixed hash partitioning on tree_id
    # spreads the trees (groupBy reuses it, no second shuffle).
    tasks = tree_tasks or max(1, min(n_trees, 2 * sample.sparkSession.sparkContext.defaultParallelism))
    return (sample.repartition(tasks, "tree_id")
                  .groupBy("tree_id").applyInPandas(grow, FOREST_NODE_SCHEMA))


class ForestModel:
    """Node table as one array per level (trees x 2^level) for vectorised descent.

    The children of place q of a level are 2q and 2q + 1 of the next; a leaf
    above the last level passes its rows on to the right, whatever their values."""

    def __init__(self, nodes: pd.DataFrame, psi: int, n_features: int = len(FEATURE_COLS)):
        nodes = nodes.sort_values(["tree_id", "node_id"])
        trees = np.sort(nodes["tree_id"].unique())
        t_index = {t: i for i, t in enumerate(trees)}
        width = int(nodes["node_id"].max()) + 1
        shape = (len(trees), width)
        self.feature = np.full(shape, -1, dtype=np.int32)
        self.threshold = np.zeros(shape)
        self.left = np.zeros(shape, dtype=np.int32)
        self.right = np.zeros(shape, dtype=np.int32)
        self.path_len = np.zeros(shape)
        ti = nodes["tree_id"].map(t_index).to_numpy()
        ni = nodes["node_id"].to_numpy()
        self.feature[ti, ni] = nodes["feature"].to_numpy()
        self.threshold[ti, ni] = nodes["threshold"].to_numpy()
        self.left[ti, ni] = nodes["left"].to_numpy()
        self.right[ti, ni] = nodes["right"].to_numpy()
        self.path_len[ti, ni] = nodes["path_len"].to_numpy()
        self.n_trees = len(trees)
        self.psi = int(psi)
        self.depth = int(math.ceil(math.log2(max(self.psi, 2))))
        self.n_features = n_features
        self._levels, at, tree = [], np.zeros((self.n_trees, 1), np.intp), np.arange(self.n_trees)[:, None]
        for _ in range(self.depth):
            inner = self.feature[tree, at] >= 0
            self._levels.append((np.where(inner, self.feature[tree, at], 0).ravel().astype(np.intp),
                                 np.where(inner, self.threshold[tree, at], -np.inf).ravel()))
            at = np.stack([np.where(inner, self.left[tree, at], at),
                           np.where(inner, self.right[tree, at], at)], axis=2).reshape(self.n_trees, -1)
        self._path = self.path_len[tree, at].ravel()

    def score(self, X: np.ndarray) -> np.ndarray:
        """Negated anomaly score of each row: -2^(-E[h(x)] / c(psi));
        lower = more anomalous, range [-1, 0).

        All trees descend together, one level per step, ``SCORE_ROWS`` rows at
        a time, which keeps the rows x trees arrays in the processor's cache.
        """
        parts = [self._score(X[a:a + SCORE_ROWS]) for a in range(0, len(X), SCORE_ROWS)]
        return np.concatenate(parts) if parts else np.zeros(0)

    def _score(self, X: np.ndarray) -> np.ndarray:
        flat = np.ascontiguousarray(X, dtype=float).ravel()
        row = (np.arange(len(X), dtype=np.intp) * X.shape[1])[:, None]
        cur = np.repeat(np.arange(self.n_trees, dtype=np.intp)[None, :], len(X), axis=0)
        at, value, threshold, right = np.empty_like(cur), np.empty(cur.shape), np.empty(cur.shape), np.empty(cur.shape, bool)
        for feature, thresholds in self._levels:
            np.take(feature, cur, out=at, mode="clip")  # with clip, take writes to ``out`` directly
            at += row
            np.take(flat, at, out=value, mode="clip")
            np.take(thresholds, cur, out=threshold, mode="clip")
            np.logical_not(np.less(value, threshold, out=right), out=right)  # NaN goes right
            cur += cur
            cur += right
        mean_path = self._path[cur].mean(axis=1)
        return -np.power(2.0, -mean_path / float(average_path_length([self.psi])[0]))


def load_model(nodes: DataFrame, psi: int, n_trees: int = N_TREES) -> ForestModel:
    """Collect the node table (at most n_trees * (2 * psi - 1) rows, a bound
    fixed by the saved model's parameters) into arrays."""
    limit = n_trees * (2 * psi - 1)
    pdf = nodes.limit(limit + 1).toPandas()
    if len(pdf) > limit:
        raise ValueError("node table larger than the model bound")
    return ForestModel(pdf, psi)


def score_column(spark: SparkSession, model: ForestModel, feature_cols=FEATURE_COLS):
    """An iterator pandas UDF over a struct of the features, with the
    model broadcast once per executor. NULL features must be imputed
    before (D12); NaN goes right at every split."""
    bc = spark.sparkContext.broadcast(model)
    names = list(feature_cols)

    @F.pandas_udf("double")
    def forest_score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        m = bc.value
        for pdf in batches:
            X = pdf[names].to_numpy(dtype=float)
            yield pd.Series(m.score(X))

    return forest_score(F.struct(*[F.col(c) for c in names]))


def score_readings(spark: SparkSession, df: DataFrame, model: ForestModel,
                   out_col: str = "anomaly_score", feature_cols=FEATURE_COLS) -> DataFrame:
    """Add ``anomaly_score``; only the 13 features cross into Python."""
    return df.withColumn(out_col, score_column(spark, model, feature_cols))


def train(spark: SparkSession, features: DataFrame, n_trees: int = N_TREES,
          max_samples: int = MAX_SAMPLES, seed: int = SEED, margin: float = DRAW_MARGIN):
    """M1 + M2: returns ``(node DataFrame, psi, n_rows)``; the node table
    is checkpointed so scoring and saving do not regrow it."""
    from gridlens.session import shared_dir
    shared_dir(spark)  # checkpoint folder of the session (set in local mode)
    n = features.count()
    for _ in range(4):
        sample, psi = forest_sample(features, n, n_trees, max_samples, seed, margin=margin)
        nodes = forest_fit(sample, psi, seed, n_trees=n_trees).checkpoint(eager=True)
        # Every tree must hold exactly psi rows; a short draw (vanishingly
        # rare at margin 1.5) is redrawn with a wider margin.
        roots = nodes.filter(F.col("node_id") == 0)
        if roots.filter(F.col("n_rows") < psi).isEmpty() and roots.count() == n_trees:
            return nodes, psi, n
        margin *= 2
    raise RuntimeError("could not draw full subsamples for every tree")
