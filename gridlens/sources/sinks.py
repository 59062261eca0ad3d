"""Writers (K1-K8): Hive-partitioned Parquet, idempotent per day.

A re-run replaces whole days in one step: rows, zones or types that the new
run lacks are gone, a day that lost all rows ends empty, other days stay, and
a reader sees all old or all new days (``days``). ``load_table(mode="append")``
adds rows like a bulk COPY.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlens.schemas import FOREST_NODE_SCHEMA, SCORED_COLS
from gridlens.sources.days import (CommitLog, DayDirs, StagedDays, as_date, date_dirs, publish_together, read_days,
                                   read_table, with_day_parts, ymd_dirs)


def write_clustered(df: DataFrame, path: str, partition_cols, num_partitions: int | None = None,
                    mode: str = "overwrite") -> str:
    """K1: cluster rows by the partition columns, then write them
    Hive-partitioned, Snappy.

    The reference's ``repartition(n, cols)`` sends each partition value to
    one task (three customer types -> three writers, one of them huge).
    The ``rebalance`` hint clusters by the same columns but lets AQE split
    oversized partitions, so a hot value is written by several tasks.
    "overwrite" replaces the whole of ``path``.
    """
    cols = list(partition_cols)
    args = ([num_partitions] if num_partitions else []) + cols
    (df.hint("rebalance", *args).write.mode(mode)
       .option("partitionOverwriteMode", "static")
       .option("compression", "snappy")
       .partitionBy(*cols).parquet(path))
    return path


def stage_days(df: DataFrame, root: str, partition_cols, dirs: DayDirs,
               num_partitions: int | None = None) -> StagedDays:
    """Write rows where no reader looks yet."""
    staged = StagedDays(df.sparkSession, root, dirs)
    write_clustered(df, staged.path, partition_cols, num_partitions)
    return staged


def _span(df: DataFrame, date_col: str, first_day, last_day):
    """The days given, or those from the first to the last that ``df`` holds
    (None: it holds none), and the rows of ``df`` in them."""
    if first_day is None:
        span = df.agg(F.min(date_col).alias("a"), F.max(date_col).alias("b")).first()
        if span["a"] is None:
            return None, None, df
        first_day, last_day = span["a"], span["b"]
    first_day, last_day = as_date(first_day), as_date(last_day or first_day)
    return first_day, last_day, df.filter(F.col(date_col).between(F.lit(first_day), F.lit(last_day)))


def _replace_days(df: DataFrame, root: str, date_col: str, partition_cols, dirs: DayDirs, first_day, last_day,
                  num_partitions: int | None) -> str:
    """Write ``df`` in place of the days [first_day, last_day]; without them,
    of the days from the first to the last that it holds. Rows of other days
    are not written."""
    first_day, last_day, rows = _span(df, date_col, first_day, last_day)
    if first_day is not None:
        stage_days(rows, root, partition_cols, dirs, num_partitions).publish(first_day, last_day)
    return root


def table_of_days(spark: SparkSession, root: str, schema: T.StructType, date_col: str | None = None) -> DataFrame:
    """All days of a table written here: laid out by ``date_col``, or by
    year, month and day."""
    return read_table(spark, root, schema, date_dirs(date_col) if date_col else ymd_dirs)


CLEAN_PARTS = ["year", "month", "day", "utility_zone", "customer_type"]


def write_clean_readings(clean: DataFrame, root: str, first_day=None, last_day=None,
                         num_partitions: int | None = None) -> str:
    """K2: cleaned rows under year/month/day, clustered by zone and type."""
    return _replace_days(with_day_parts(clean), root, "reading_date", CLEAN_PARTS, ymd_dirs, first_day, last_day,
                         num_partitions)


HOURLY_PARTS, DAILY_PARTS = ["reading_date", "utility_zone"], ["reading_date", "customer_type"]


def stage_hourly(hourly: DataFrame, root: str) -> StagedDays:
    return stage_days(hourly, root, HOURLY_PARTS, date_dirs("reading_date"))


def stage_daily(daily: DataFrame, root: str) -> StagedDays:
    return stage_days(daily, root, DAILY_PARTS, date_dirs("reading_date"))


def write_hourly(hourly: DataFrame, root: str, first_day=None, last_day=None,
                 num_partitions: int | None = None) -> str:
    """K3: hourly rollup by date and zone."""
    return _replace_days(hourly, root, "reading_date", HOURLY_PARTS, date_dirs("reading_date"),
                         first_day, last_day, num_partitions)


def write_daily(daily: DataFrame, root: str, first_day=None, last_day=None,
                num_partitions: int | None = None) -> str:
    """K4: daily rollup by date and customer type."""
    return _replace_days(daily, root, "reading_date", DAILY_PARTS, date_dirs("reading_date"),
                         first_day, last_day, num_partitions)


def write_scored(scored: DataFrame, root: str, scoring_date=None, last_day=None,
                 num_partitions: int | None = None) -> str:
    """K5: the 11 scored columns plus ``scoring_date``: the day given, or the
    reading date when scoring a range (``last_day``) or when none is given."""
    one_day = scoring_date is not None and last_day is None
    sd = F.lit(as_date(scoring_date)) if one_day else F.to_date("reading_timestamp")
    out = scored.select(*SCORED_COLS).withColumn("scoring_date", sd)
    return _replace_days(out, root, "scoring_date", ["scoring_date"], date_dirs("scoring_date"), scoring_date,
                         last_day, num_partitions)


def align_to(df: DataFrame, target: T.StructType) -> DataFrame:
    """Columns of ``target`` in its order; absent ones are NULL (FILLRECORD)."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType)
                       .alias(f.name) for f in target.fields])


def stage_load(spark: SparkSession, src_root: str, table_root: str, target: T.StructType, date_col: str,
               first_day, last_day=None) -> StagedDays:
    """Rows of one day (or a range) of files, aligned to ``target`` and staged
    for a date-partitioned table."""
    dirs = date_dirs(date_col)
    rows = align_to(read_days(spark, src_root, target, first_day, last_day or first_day, dirs), target)
    return stage_days(rows, table_root, [date_col], dirs)


def load_table(spark: SparkSession, src_root: str, table_root: str, target: T.StructType,
               date_col: str, first_day, last_day=None, mode: str = "overwrite") -> DataFrame:
    """K6/K7: load one day (or a range) of files into a date-partitioned
    table; returns the table's rows of those days. ``overwrite`` replaces the
    days, also by nothing; ``append`` adds rows like a bulk COPY. Files that
    lack a column of ``target`` give NULL for it."""
    last_day = last_day or first_day
    staged = stage_load(spark, src_root, table_root, target, date_col, first_day, last_day)
    publish_together([staged], first_day, last_day, append=mode == "append")
    return read_days(spark, table_root, target, first_day, last_day, date_dirs(date_col))


def save_model(spark: SparkSession, nodes: DataFrame, metrics: dict, root: str) -> str:
    """K8: node table as Parquet and the metrics row as JSON (no pickle), both
    in a folder of their own; the root's commit log names the folder to use and
    is switched last by a numbered file that replaces no other, so a crash at
    any step leaves the old model and never pairs new trees with old metrics."""
    version = f"version-{uuid.uuid4().hex}"
    nodes.coalesce(1).write.parquet(f"{root}/{version}/nodes")
    spark.createDataFrame([(json.dumps(metrics, default=str),)], "metrics string") \
        .coalesce(1).write.text(f"{root}/{version}/metrics")
    CommitLog(spark, root).commit(lambda tables: tables.update(model={"current": [version]}))
    return root


def load_model_tables(spark: SparkSession, root: str) -> tuple[DataFrame, dict]:
    current = CommitLog(spark, root).latest()[1].get("model", {}).get("current")
    # models saved before there was a log name their folder in a text file
    at = f"{root}/{current[0] if current else spark.read.text(f'{root}/current').first()['value']}"
    nodes = spark.read.schema(FOREST_NODE_SCHEMA).parquet(f"{at}/nodes")
    metrics = json.loads(spark.read.text(f"{at}/metrics").first()["value"])
    return nodes, metrics
