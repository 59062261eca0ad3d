"""Scans of the raw and processed layouts.

Every reader opens only the day directories it is asked for, with an explicit
schema (``days.read_days``); a missing day is an empty result rather than a
failed read. The exact date filter is a timestamp range, which reaches the
Parquet reader as ``PushedFilters``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlens.functions.derive import day_range
from gridlens.schemas import clean_schema, raw_schema
from gridlens.sources.days import as_date as _as_date
from gridlens.sources.days import read_days, ymd_dirs
from gridlens.sources.drift import scan_drifted

DAY_PARTS = [T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType()),
             T.StructField("day", T.IntegerType())]


def scan_day_partitions(spark: SparkSession, root: str, process_date, lookback_days: int = 0,
                        end_date=None, ts_type: T.DataType | None = None) -> DataFrame:
    """S1 + S2: raw rows of directory days ``D - lookback .. D`` (or up to
    ``end_date`` for a range), read with the fixed 13-field schema; the
    ``year, month, day`` directory columns are kept."""
    d0 = _as_date(process_date)
    d1 = _as_date(end_date) if end_date else d0
    schema = T.StructType(raw_schema(ts_type).fields + DAY_PARTS)
    return read_days(spark, root, schema, d0 - dt.timedelta(days=lookback_days), d1, ymd_dirs)


def filter_exact_date(df: DataFrame, process_date, end_date=None,
                      ts_col: str = "reading_timestamp") -> DataFrame:
    """S3: rows whose event date is ``D`` (or within [D, end_date])."""
    d0 = _as_date(process_date)
    d1 = _as_date(end_date) if end_date else d0
    ts_type = df.schema[ts_col].dataType.simpleString()
    return df.filter(day_range(ts_col, d0, d1 + dt.timedelta(days=1), ts_type))


def read_raw(spark: SparkSession, root: str, process_date, lookback_days: int = 0,
             end_date=None, ts_type: T.DataType | None = None) -> DataFrame:
    """S1 + S3: the raw rows of day ``D``. Lookback directories only
    contribute rows of D that landed in an earlier directory."""
    df = scan_day_partitions(spark, root, process_date, lookback_days, end_date, ts_type)
    return filter_exact_date(df, process_date, end_date).drop("year", "month", "day")


def read_raw_drifted(spark: SparkSession, root: str, process_date, lookback_days: int = 0,
                     end_date=None, ts_type: T.DataType | None = None) -> tuple[DataFrame, DataFrame]:
    """S1-S3 over files whose column types may differ from the declared ones:
    the raw rows, and the files that were not read (``process_date, path,
    reason``; a file of a lookback directory counts to the first day). See
    ``drift``."""
    d0 = _as_date(process_date)
    d1 = _as_date(end_date) if end_date else d0
    schema = T.StructType(raw_schema(ts_type).fields + DAY_PARTS)
    rows, misfits = scan_drifted(spark, root, schema, d0 - dt.timedelta(days=lookback_days), d1, ymd_dirs)
    part = lambda name: F.regexp_extract("path", f"/{name}=([0-9]+)/", 1).cast("int")
    day = F.greatest(F.make_date(part("year"), part("month"), part("day")), F.lit(d0))
    return (filter_exact_date(rows, process_date, end_date).drop("year", "month", "day"),
            misfits.select(day.alias("process_date"), "path", "reason"))


def clean_read_schema(ts_type) -> T.StructType:
    """Cleaned rows as laid out: the directory columns come last."""
    fields = [f for f in clean_schema(ts_type).fields
              if f.name not in ("utility_zone", "customer_type")]
    return T.StructType(fields + DAY_PARTS + [
        T.StructField("utility_zone", T.StringType()),
        T.StructField("customer_type", T.StringType())])


def scan_processed_days(spark: SparkSession, root: str, first_day, last_day,
                        ts_type: T.DataType | None = None) -> DataFrame:
    """S4/S5 core: cleaned rows of directory days [first_day, last_day];
    ``utility_zone`` and ``customer_type`` come back from the directory
    names as strings (explicit schema: no partition-type inference)."""
    return read_days(spark, root, clean_read_schema(ts_type), first_day, last_day, ymd_dirs).drop(
        "year", "month", "day")


def scan_processed_day(spark: SparkSession, root: str, process_date,
                       ts_type: T.DataType | None = None) -> DataFrame:
    """The cleaned readings of one day."""
    return scan_processed_days(spark, root, process_date, process_date, ts_type)


def scan_training_window(spark: SparkSession, root: str, process_date, lookback_days: int = 30,
                         ts_type: T.DataType | None = None) -> DataFrame:
    """Cleaned days ``D - lookback .. D - 1`` (D excluded). Missing days
    are simply absent; no day at all raises."""
    d = _as_date(process_date)
    df = scan_processed_days(spark, root, d - dt.timedelta(days=lookback_days),
                             d - dt.timedelta(days=1), ts_type)
    if df.isEmpty():
        raise ValueError(f"no cleaned readings in the {lookback_days} days before {d}")
    return df


def union_days(frames: list[DataFrame]) -> DataFrame:
    """O2: rows of several day frames whose columns may differ (a field that
    was added later, or dropped): matched by name, NULL where absent, in the
    order of first appearance."""
    if not frames:
        raise ValueError("no day frames to unite")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
