"""After-scoring operators: flags and severity (D13, D14), anomaly filter
(F8), score statistics (A10), label evaluation (A11), run summary (A12)
and the contamination offset (M4)."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlens.functions import derive as D

CONTAMINATION = 0.02  # fixed value: expected share of anomalies
_MAGNITUDE = np.int64(0x7FFFFFFFFFFFFFFF)


def flag_and_grade(df: DataFrame, mode: str = "offset", offset: float | None = None,
                   threshold: float = D.ANOMALY_THRESHOLD,
                   score: str = "anomaly_score") -> DataFrame:
    """D13 + D14.

    ``mode="raw"``: the reference rule, ``score < -0.15`` with cut-offs
    -0.30 / -0.20. Isolation-forest scores are at most about -0.27 for
    256-row trees, so this flags every row; it is kept for fidelity.
    ``mode="offset"`` (default): decision = score - offset (offset from
    M4), flag when decision < 0, severity HIGH < -0.15, MEDIUM < -0.05,
    LOW < 0, so the share flagged follows the contamination.
    """
    if mode == "raw":
        return (df.withColumn("is_anomaly", D.flag_anomaly(score, threshold))
                  .withColumn("anomaly_severity", D.severity(score, threshold)))
    if offset is None:
        raise ValueError("offset mode needs the contamination offset")
    dec = F.col(score) - F.lit(float(offset))
    return (df.withColumn("anomaly_decision", dec)
              .withColumn("is_anomaly", D.flag_anomaly("anomaly_decision", 0.0))
              .withColumn("anomaly_severity",
                          D.severity("anomaly_decision", 0.0, D.OFFSET_SEVERITY_CUTS)))


def filter_anomalies(scored: DataFrame) -> DataFrame:
    """F8: flagged rows only (a NULL flag is not flagged)."""
    return scored.filter(F.col("is_anomaly"))


def score_stats(scored: DataFrame, score: str = "anomaly_score") -> DataFrame:
    """A10: mean, population std, min, max of scores."""
    s = F.col(score)
    return scored.agg(F.avg(s).alias("score_mean"), F.stddev_pop(s).alias("score_std"),
                      F.min(s).alias("score_min"), F.max(s).alias("score_max"))


def evaluate_scores(scored: DataFrame, label: str = "is_true_anomaly",
                    flag: str = "is_anomaly", threshold: float | None = D.ANOMALY_THRESHOLD,
                    contamination: float = CONTAMINATION) -> DataFrame:
    """Precision, recall and F1 (4 places; 0 on zero division) and
    the counts, from TP/FP/FN counted in one pass."""
    y = F.col(label) == 1
    p = F.coalesce(F.col(flag), F.lit(False))
    c = scored.agg(F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
                   F.count_if(y & ~p).alias("fn"), F.count(F.lit(1)).alias("n"))

    def ratio(a, b):
        return F.round(F.coalesce(F.try_divide(a.cast("double"), b.cast("double")),
                                  F.lit(0.0)), 4)

    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return c.select(
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(F.lit(2) * tp, F.lit(2) * tp + fp + fn).alias("f1_score"),
        F.lit(threshold).cast("double").alias("threshold"),
        F.lit(float(contamination)).alias("contamination"),
        F.col("n").alias("n_val_samples"),
        (tp + fp).alias("n_anomalies_detected"),
        (tp + fn).alias("n_true_anomalies"))


def scoring_summary(scored: DataFrame, flag: str = "is_anomaly") -> DataFrame:
    """Rows scored, rows flagged and the rate in percent, one pass."""
    c = scored.agg(F.count(F.lit(1)).alias("total_scored"),
                   F.count_if(F.coalesce(F.col(flag), F.lit(False))).alias("total_anomalies"))
    return c.withColumn("anomaly_rate_pct", F.round(
        F.col("total_anomalies") / F.greatest(F.col("total_scored"), F.lit(1)) * F.lit(100.0), 2))


@F.pandas_udf(T.LongType())
def _order_key(x: pd.Series) -> pd.Series:
    """The bits of a double as a long of the same order; -0.0 counts as 0.0."""
    bits = (x.to_numpy(dtype=np.float64) + 0.0).view(np.int64)
    return pd.Series(np.where(bits < 0, bits ^ _MAGNITUDE, bits))


def _value_of(key: int) -> float:
    bits = np.int64(key)
    return float((bits ^ _MAGNITUDE if bits < 0 else bits).view(np.float64))


def exact_quantile(df: DataFrame, col: str, q: float, persist: bool = True) -> float | None:
    """Exact linear-interpolation quantile (as ``percentile`` / DuckDB's
    ``quantile_cont``) without gathering the column in one place.

    Four rounds, whatever the values: each counts, by the next 16 bits of the
    doubles' order-preserving keys, the rows that share the bits found so far
    with a wanted rank (the two neighbouring ranks, so at most 2 * 65,536
    counts reach the driver). NULL and NaN are ignored; ties, infinities and
    denormals are values like any other. ``persist=False`` if ``df`` is
    persisted already.
    """
    x = df.select(F.col(col).cast("double").alias("x")).filter(
        F.col("x").isNotNull() & ~F.isnan("x"))
    keys = x.select(_order_key("x").alias("key"))
    if persist:
        keys = keys.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        ranks, frac, found = [], 0.0, []  # found: per rank, the leading bits and the rank among rows that share them
        for shift in (48, 32, 16, 0):
            rows = keys.select(F.shiftright("key", shift).alias("lead"))
            if ranks:
                rows = rows.filter(F.shiftright("lead", 16).isin([lead for lead, _ in found]))
            counts = sorted((r["lead"], r["count"]) for r in rows.groupBy("lead").count().collect())
            if not ranks:
                n = sum(c for _, c in counts)
                if n == 0:
                    return None
                k = math.floor(q * (n - 1))
                frac = q * (n - 1) - k
                ranks = [k, min(k + 1, n - 1)]
                found = [_lead_at(counts, r) for r in ranks]
            else:
                found = [_lead_at([c for c in counts if c[0] >> 16 == lead], r) for lead, r in found]
        lo, hi = (_value_of(key) for key, _ in found)
        return lo if frac == 0 or lo == hi else lo + (hi - lo) * frac
    finally:
        if persist:
            keys.unpersist()


def _lead_at(counts: list[tuple[int, int]], rank: int) -> tuple[int, int]:
    """The lead that holds 0-based ``rank`` in ascending counts, and the rank inside it."""
    for lead, n in counts:
        if rank < n:
            return lead, rank
        rank -= n
    raise ValueError("the rows changed between two rounds")


def contamination_offset(train_scores: DataFrame, contamination: float = CONTAMINATION,
                         score: str = "anomaly_score", persist: bool = True) -> float | None:
    """M4: the score below which ``contamination`` of training rows lie."""
    return exact_quantile(train_scores, score, contamination, persist=persist)
