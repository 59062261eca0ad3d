"""Rolling ROWS frames that stay exact when one meter holds a large share
of all rows.

``Window.partitionBy(meter)`` sends a meter's whole series to one task. A
meter with more than ``rows_per_task`` rows is "hot" and takes another
path:

1. hot rows are range-partitioned on (meter, time) and sorted, so a hot
   series spans many partitions of bounded size (materialised with
   ``checkpoint()`` so partition ids stay fixed). Partitions hold
   ``rows_per_task`` rows, or more where that would make more partitions
   than the session shuffles to: every partition costs the driver a task
   and its samples, so their number must not follow the rows;
2. one narrow ``mapInPandas`` pass emits, per partition, the last
   ``frame_rows - 1`` rows of its last meter (the "tail") with the
   partition's first meter and that meter's row count;
3. each partition receives as halo the tail of the partition before it
   when that ended with the same meter (or, if that partition is shorter
   than the frame and holds only that meter, the tails of up to
   ``frame_rows - 1`` partitions back, trimmed to the newest rows);
4. the ordinary frames run per (partition, meter) over own rows plus
   halo; halo rows are dropped.

Step 4 covers the same rows in the same order as the one-task frames, with
blocks counted from the series' first row, so results are identical. Everything except the
hot rows goes through the plain window. Metadata (tails, per-partition
summaries) grows with the number of partitions, never with a meter's
length.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlens.operators import rolling

DEFAULT_ROWS_PER_TASK = 2_000_000


def _hot_keys(df: DataFrame, key: str, rows_per_task: int, key_counts: DataFrame | None = None) -> DataFrame:
    """Keys with more than ``rows_per_task`` rows (``key, _n``): a table, as
    their number grows with the data. ``key_counts`` (columns ``key, _n``) may
    supply the counts from a smaller table (e.g. the daily rollup's reading
    counts) instead of a pass over ``df``.
    """
    counts = key_counts if key_counts is not None else \
        df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return counts.filter(F.col("_n") > rows_per_task)


def _tails_fn(key: str, order: str, value: str, frame_rows: int):
    keep = frame_rows - 1

    def tails(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pid = None
        first_key = None
        last_key = None
        n_last = 0
        buf = None
        for pdf in batches:
            if pdf.empty:
                continue
            if pid is None:
                pid = int(pdf["_pid"].iloc[0])
                first_key = pdf[key].iloc[0]
            k = pdf[key].iloc[-1]
            part = pdf[pdf[key] == k][[key, order, value]]
            if k == last_key:
                n_last += len(part)
                buf = pd.concat([buf, part]).tail(keep)
            else:
                last_key = k
                n_last = len(part)
                buf = part.tail(keep)
        if pid is None or keep <= 0:
            return
        out = buf.copy()
        out.insert(0, "_pid", pid)
        out["_first_key"] = first_key
        out["_n_last"] = n_last
        yield out

    return tails


def number_partitions(base: DataFrame) -> DataFrame:
    """Add ``_seq`` = 1, 2, ... over the non-empty partition ids ``_pid``
    of a per-partition summary (contiguous ids: arithmetic; a gap: a
    window over the summary's rows)."""
    shape = base.agg(F.count(F.lit(1)).alias("n"), F.min("_pid").alias("lo"),
                     F.max("_pid").alias("hi")).first()
    if shape["n"] == 0 or shape["n"] == shape["hi"] - shape["lo"] + 1:
        return base.withColumn("_seq", F.col("_pid") - F.lit(shape["lo"] or 0) + 1)
    return base.withColumn("_seq", F.row_number().over(Window.orderBy("_pid")))


def _ranged(hot: DataFrame, n_hot: int, key: str, order: str, rows_per_task: int) -> DataFrame:
    """Hot rows on range partitions of (key, order), with the partition's id."""
    from gridlens.session import shared_dir
    shared_dir(hot.sparkSession)
    most = int(hot.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, min(math.ceil(n_hot / rows_per_task), max(most, math.ceil(n_hot / DEFAULT_ROWS_PER_TASK))))
    return (hot.repartitionByRange(parts, key, order).sortWithinPartitions(key, order)
               .withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True))


def _hot_and_cold(df: DataFrame, key: str, hot_keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of the hot keys and all others (NULL keys too). The key table is
    joined as it is: Spark broadcasts it when it is small enough."""
    return df.join(hot_keys.select(key), key, "left_semi"), df.join(hot_keys.select(key), key, "left_anti")


def _rows_before(ranged: DataFrame, key: str) -> DataFrame:
    """Per (key, partition): the key's rows in all partitions before."""
    before = Window.partitionBy(key).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    return ranged.groupBy(key, "_pid").agg(F.count(F.lit(1)).alias("_n")).select(
        key, "_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before_rows"))


def _hot_path(hot: DataFrame, n_hot: int, frame_rows: int, std_null_to_zero: bool,
              value: str, key: str, order: str, rows_per_task: int) -> DataFrame:
    L = frame_rows - 1
    ranged = _ranged(hot, n_hot, key, order, rows_per_task)
    fields = ranged.schema
    tail_schema = T.StructType([
        T.StructField("_pid", T.IntegerType()), fields[key], fields[order], fields[value],
        T.StructField("_first_key", fields[key].dataType),
        T.StructField("_n_last", T.LongType())])
    tails = ranged.select("_pid", key, order, value).mapInPandas(
        _tails_fn(key, order, value, frame_rows), tail_schema).checkpoint(eager=True)

    # One row per non-empty partition (metadata: grows with the number of
    # partitions, not with any meter). ``_seq`` numbers the non-empty
    # partitions so each links to its true predecessor. Range partitions
    # bounded by sampled keys are non-empty, so ids are normally
    # contiguous and the predecessor is a self-join on id - 1; only if a
    # gap shows up is the numbering done by a window over this summary.
    base = tails.groupBy("_pid").agg(
        F.first("_first_key").alias("first_key"), F.first(key).alias("last_key"),
        F.first("_n_last").alias("n_last"))
    numbered = number_partitions(base)
    prev = numbered.select((F.col("_seq") + 1).alias("_seq"),
                           F.col("first_key").alias("prev_first"),
                           F.col("last_key").alias("prev_last"),
                           F.col("n_last").alias("prev_n"))
    summary = numbered.join(prev, "_seq", "left")
    seq_pid = summary.select(F.col("_seq").alias("_src_seq"), F.col("_pid").alias("_src_pid"))
    targets = (summary.filter(F.col("prev_last") == F.col("first_key"))
               .withColumn("span", F.when((F.col("prev_first") == F.col("first_key"))
                                          & (F.col("prev_n") < L), F.lit(L)).otherwise(F.lit(1)))
               .select(F.col("_pid").alias("_target"), F.col("first_key").alias(key),
                       F.explode(F.sequence(F.greatest(F.col("_seq") - F.col("span"), F.lit(1)),
                                            F.col("_seq") - 1)).alias("_src_seq"))
               .join(seq_pid, "_src_seq").select("_target", key, F.col("_src_pid").alias("_pid")))
    halo = (targets.join(tails.select("_pid", key, order, value), ["_pid", key], "inner")
            .withColumn("_r", F.row_number().over(
                Window.partitionBy("_target").orderBy(F.col(order).desc())))
            .filter(F.col("_r") <= L)
            .select(F.col("_target").alias("_pid"), key, order, value,
                    F.lit(True).alias("_halo")))
    own = ranged.withColumn("_halo", F.lit(False))
    both = own.unionByName(halo, allowMissingColumns=True).join(_rows_before(ranged, key), [key, "_pid"])
    out = rolling.frame_stats(both, frame_rows, value, ["_pid", key], order, rolling.MEAN_COL, rolling.STD_COL,
                              start=F.greatest(F.col("_before_rows") - L, F.lit(0)))
    if std_null_to_zero:
        out = out.withColumn(rolling.STD_COL, F.coalesce(rolling.STD_COL, F.lit(0.0)))
    out = out.filter(~F.col("_halo")).drop("_halo", "_pid", "_before_rows")
    return out


def rolling_stats_split(df: DataFrame, frame_rows: int = rolling.TRAIN_FRAME_ROWS,
                        std_null_to_zero: bool = True, value: str = "kwh_consumed",
                        key: str = "meter_id", order: str = "reading_timestamp",
                        rows_per_task: int | None = None,
                        key_counts: DataFrame | None = None) -> DataFrame:
    """W1-W3 with hot-meter splitting; same columns and values as
    :func:`gridlens.operators.rolling.rolling_stats`. ``key_counts``: see
    :func:`_hot_keys` (rows per key of ``df``, from a smaller table)."""
    rows_per_task = int(rows_per_task or DEFAULT_ROWS_PER_TASK)
    hot_keys = _hot_keys(df, key, rows_per_task, key_counts)
    n_hot = hot_keys.agg(F.sum("_n")).first()[0]
    plain = lambda d: rolling.rolling_stats(d, frame_rows, std_null_to_zero, value, key, order)
    if not n_hot:
        return plain(df)
    hot, cold = _hot_and_cold(df, key, hot_keys)
    cols = plain(cold).columns
    hot_out = _hot_path(hot, n_hot, frame_rows, std_null_to_zero, value, key, order,
                        rows_per_task)
    return plain(cold).unionByName(hot_out.select(*cols))


def series_position_split(df: DataFrame, key: str = "meter_id", order: str = "reading_timestamp",
                          out_col: str = "series_pos", rows_per_task: int | None = None) -> DataFrame:
    """O1 with hot-meter splitting: a row's position is its position among
    the meter's rows of its range partition, plus the meter's rows in all
    partitions before. Same values as :func:`rolling.series_position`."""
    rows_per_task = int(rows_per_task or DEFAULT_ROWS_PER_TASK)
    hot_keys = _hot_keys(df, key, rows_per_task)
    n_hot = hot_keys.agg(F.sum("_n")).first()[0]
    if not n_hot:
        return rolling.series_position(df, key, order, out_col)
    hot, cold = _hot_and_cold(df, key, hot_keys)
    ranged = _ranged(hot, n_hot, key, order, rows_per_task)
    first = _rows_before(ranged, key)
    here = F.row_number().over(Window.partitionBy("_pid", key).orderBy(order))
    hot_out = ranged.withColumn("_here", here).join(first, [key, "_pid"]).withColumn(
        out_col, (F.col("_here") + F.col("_before_rows")).cast("int"))
    plain = rolling.series_position(cold, key, order, out_col)
    return plain.unionByName(hot_out.select(*plain.columns))
