"""Hourly (A1) and daily (A2) rollups per meter.

Plain hash aggregates: Spark runs a partial aggregate before the shuffle,
so the exchange carries one row per group and map task, not the readings.
A NULL zone or customer type is a group of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlens.functions.derive import bool_count

HOURLY_KEY = ["meter_id", "reading_date", "reading_hour", "utility_zone", "customer_type"]
DAILY_KEY = ["meter_id", "reading_date", "utility_zone", "customer_type"]


def hourly_rollup(clean: DataFrame) -> DataFrame:
    """A1: 13 measures per meter-hour."""
    kwh, v = F.col("kwh_consumed"), F.col("voltage")
    return clean.groupBy(*HOURLY_KEY).agg(
        F.sum(kwh).alias("total_kwh"),
        F.avg(kwh).alias("avg_kwh"),
        F.max(kwh).alias("max_kwh"),
        F.min(kwh).alias("min_kwh"),
        F.stddev_samp(kwh).alias("std_kwh"),
        F.avg(v).alias("avg_voltage"),
        F.min(v).alias("min_voltage"),
        F.max(v).alias("max_voltage"),
        F.avg("power_factor").alias("avg_power_factor"),
        F.avg("current_amps").alias("avg_current"),
        F.avg("temperature_celsius").alias("avg_temp_c"),
        F.count(F.lit(1)).alias("reading_count"),
        bool_count("is_peak_hour").alias("peak_hour_readings"),
    )


def daily_rollup(clean: DataFrame) -> DataFrame:
    """A2: 8 measures per meter-day; ``avg_hourly_kwh`` is the mean of the
    readings, not of hourly sums (as in the reference)."""
    kwh = F.col("kwh_consumed")
    return clean.groupBy(*DAILY_KEY).agg(
        F.sum(kwh).alias("daily_kwh"),
        F.avg(kwh).alias("avg_hourly_kwh"),
        F.max(kwh).alias("peak_kwh"),
        F.avg("voltage").alias("avg_voltage"),
        F.avg("power_factor").alias("avg_power_factor"),
        F.count(F.lit(1)).alias("total_readings"),
        bool_count("is_peak_hour").alias("peak_readings"),
        bool_count("is_off_peak").alias("off_peak_readings"),
    )
