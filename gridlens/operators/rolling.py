"""Per-meter rolling statistics over the last N readings.

Spark's sliding ROWS frame sums all its rows again for every row. Here each
series is cut into blocks as long as the frame, and running windows give every
row two sets of moments (count, sum, squared deviations): of its block up to
the row, and of its block from the row on. The frame that ends at a row is the
first set of that row merged with the second set of the row where the frame
begins, in the block before: a fixed number of steps per row, whatever the
frame. The windows share the one shuffle by meter. Deviations are merged
pairwise around the parts' means, so a large level does not cancel them.

``rolling_stats`` processes a meter's series in one task.
``gridlens.operators.rolling_split`` computes the same frame on
range partitions of (meter, time) for series too long for one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# 7 days of hourly readings = 168 rows for training; the
# scoring code's frame (-168, 0) holds 169 rows.
TRAIN_FRAME_ROWS = 168
SCORE_FRAME_ROWS = 169

MEAN_COL = "rolling_7d_mean_kwh"
STD_COL = "rolling_7d_std_kwh"


def _running(keys: list[str], block: str, order: Column):
    return Window.partitionBy(*keys, block).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _moments(value: Column, w) -> Column:
    n = F.count(value).over(w)
    return F.struct(n.alias("n"), F.sum(value).over(w).alias("sum"),
                    (F.var_pop(value).over(w) * n).alias("dev2"),
                    F.min(value).over(w).alias("lo"), F.max(value).over(w).alias("hi"))


def frame_stats(df: DataFrame, frame_rows: int, value: str, keys: list[str], order: str,
                mean_col: str, std_col: str, start: Column | None = None) -> DataFrame:
    """Mean and sample std of ``value`` over the last ``frame_rows`` rows of
    each ``keys`` series in ``order``. NULL values are not counted: the mean of
    a frame of NULLs and the std of fewer than two values are NULL. A frame of
    equal values has std exactly 0; one with NaN or an infinity has std NaN.
    Rows that tie in ``order`` get one (unspecified) order for both columns.
    ``start``: position of the first row of ``df``'s part of a longer series;
    blocks are counted from the series' first row, so parts give the same bits."""
    x = F.col(value).cast("double")
    df = df.withColumn("_pos", F.row_number().over(Window.partitionBy(*keys).orderBy(order)) - 1
                       + (F.lit(0) if start is None else start))
    df = df.withColumn("_block", F.expr(f"_pos div {frame_rows}"))
    df = df.withColumn("_from", _moments(x, _running(keys, "_block", F.col("_pos").desc())))
    df = df.withColumn("_upto", _moments(x, _running(keys, "_block", F.col("_pos"))))
    # Ordered like the running window above, so no further sort. The last row
    # of a block needs nothing of the block before.
    before = F.lag("_from", frame_rows - 1).over(Window.partitionBy(*keys).orderBy("_block", "_pos"))
    df = df.withColumn("_before", F.when(F.col("_pos") % frame_rows != frame_rows - 1, before))
    part = lambda side, field: F.coalesce(F.col(f"{side}.{field}"), F.lit(0.0))
    n1, n0 = part("_upto", "n"), part("_before", "n")
    n, total = n0 + n1, part("_before", "sum") + part("_upto", "sum")
    mean = lambda total, count: total / F.nullif(count, F.lit(0.0))
    gap = mean(part("_before", "sum"), n0) - mean(part("_upto", "sum"), n1)
    dev2 = (part("_before", "dev2") + part("_upto", "dev2")
            + F.when((n0 > 0) & (n1 > 0), gap * gap * mean(n0 * n1, n)).otherwise(0.0))
    level = F.greatest("_before.hi", "_upto.hi") - F.least("_before.lo", "_upto.lo") == 0
    return (df.withColumn(mean_col, mean(total, n))
            .withColumn(std_col, F.when(n > 1, F.when(level, 0.0).otherwise(F.sqrt(mean(dev2, n - 1)))))
            .drop("_pos", "_block", "_from", "_upto", "_before"))


def series_position(df: DataFrame, key: str = "meter_id", order: str = "reading_timestamp",
                    out_col: str = "series_pos") -> DataFrame:
    """O1: 1-based position of each reading in its meter's time-ordered
    series (the order the rolling frames run in; no global sort)."""
    return df.withColumn(out_col, F.row_number().over(
        Window.partitionBy(key).orderBy(order)))


def rolling_stats(df: DataFrame, frame_rows: int = TRAIN_FRAME_ROWS,
                  std_null_to_zero: bool = True, value: str = "kwh_consumed",
                  key: str = "meter_id", order: str = "reading_timestamp",
                  mean_col: str = MEAN_COL, std_col: str = STD_COL) -> DataFrame:
    """W1/W2 (training: 168 rows, one-row std -> 0) and W3 (scoring:
    ``frame_rows=169, std_null_to_zero=False``).

    Mean and sample std ignore NULL values, like the pandas rolling
    functions with ``min_periods=1``.
    """
    out = frame_stats(df, frame_rows, value, [key], order, mean_col, std_col)
    return out.withColumn(std_col, F.coalesce(std_col, F.lit(0.0))) if std_null_to_zero else out
