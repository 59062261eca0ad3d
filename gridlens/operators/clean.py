"""Cleaning (F1-F7) and the derived columns of a cleaned reading."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlens.functions import derive as D
from gridlens.schemas import FEATURE_COLS, KEY_COLS

# Plausible voltage range 90..280 V and power factor 0..1,
# both inclusive.
VOLTAGE_RANGE = (90, 280)
PF_RANGE = (0.0, 1.0)


def drop_null_keys(df: DataFrame) -> DataFrame:
    """rows need a meter id and a timestamp."""
    return df.filter(F.col("meter_id").isNotNull() & F.col("reading_timestamp").isNotNull())


def nonneg_kwh(df: DataFrame) -> DataFrame:
    """``kwh_consumed >= 0``; NULL drops, NaN passes (NaN sorts last)."""
    return df.filter(F.col("kwh_consumed") >= 0)


def voltage_in_range(df: DataFrame) -> DataFrame:
    """90 <= voltage <= 280; NULL and NaN drop."""
    return df.filter(F.col("voltage").between(*VOLTAGE_RANGE))


def pf_in_range(df: DataFrame) -> DataFrame:
    """0 <= power_factor <= 1."""
    return df.filter(F.col("power_factor").between(*PF_RANGE))


def dedup_readings(df: DataFrame, keys=KEY_COLS) -> DataFrame:
    """one row per ``(meter_id, reading_timestamp)``.

    The survivor is the smallest row in the order of the remaining columns
    (NULLs first), so every run and every action picks the same row.
    Written as an aggregate, not a window: the partial aggregate collapses
    copies on the map side, so even a key whose copies are a third of all
    rows reaches the shuffle as one row per map task.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    picked = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"))
    return picked.select(*keys, "_row.*").select(*df.columns)


def with_reading_columns(df: DataFrame, as_of: dt.datetime | None = None) -> DataFrame:
    """Hour, date, peak flags, apparent power, processing stamp."""
    stamp = F.lit(as_of).cast("timestamp") if as_of else F.current_timestamp()
    return (df
            .withColumn("reading_hour", D.reading_hour("reading_timestamp"))
            .withColumn("reading_date", D.reading_date("reading_timestamp"))
            .withColumn("is_peak_hour", D.is_peak_hour("reading_hour"))
            .withColumn("is_off_peak", D.is_off_peak("reading_hour"))
            .withColumn("apparent_power_kva", D.apparent_power())
            .withColumn("_processed_at", stamp))


def clean_readings(df: DataFrame, as_of: dt.datetime | None = None) -> DataFrame:
    """F1-F5 then D1-D6.

    The four row filters are plain comparisons on scan columns, so Catalyst
    pushes them into the Parquet reader; the one shuffle is the dedup.
    """
    df = pf_in_range(voltage_in_range(nonneg_kwh(drop_null_keys(df))))
    return with_reading_columns(dedup_readings(df), as_of)


def drop_null_features(df: DataFrame, features=FEATURE_COLS) -> DataFrame:
    """drop rows with NULL or NaN in any model feature."""
    return df.na.drop(how="any", subset=list(features))
