"""Fixed schemas of the datasets (raw, cleaned, rollups, features, scores)."""

from __future__ import annotations

from pyspark.sql import types as T

KEY_COLS = ["meter_id", "reading_timestamp"]

# Measured columns of a raw reading, in file order after the two keys (fixed
# values: the data contract).
RAW_VALUE_COLS = [
    "kwh_consumed", "voltage", "current_amps", "power_factor",
    "reactive_power_kvar", "temperature_celsius", "meter_status",
    "utility_zone", "customer_type", "lat", "lon",
]
RAW_COLS = KEY_COLS + RAW_VALUE_COLS

# The 13 model features, in model column order (fixed values: must equal
# the reference's feature list and order).
FEATURE_COLS = [
    "kwh_consumed",
    "voltage",
    "current_amps",
    "power_factor",
    "reactive_power_kvar",
    "apparent_power_kva",
    "reading_hour_sin",
    "reading_hour_cos",
    "day_of_week_sin",
    "day_of_week_cos",
    "rolling_7d_mean_kwh",
    "rolling_7d_std_kwh",
    "kwh_z_score",
]

# The columns of the scored table, in order.
SCORED_COLS = [
    "meter_id", "reading_timestamp", "kwh_consumed", "voltage",
    "power_factor", "utility_zone", "customer_type",
    "anomaly_score", "is_anomaly", "anomaly_severity", "scored_at",
]


def raw_schema(ts_type: T.DataType | None = None) -> T.StructType:
    """The fixed 13-field raw schema.

    ``ts_type`` defaults to ``TimestampType``; data written without a zone
    (``timestamp_ntz``) is read with ``TimestampNTZType``. The two key
    fields are declared non-null, though Parquet reads return them
    nullable; the cleaning filters are the real guard.
    """
    ts = ts_type or T.TimestampType()
    d, s = T.DoubleType(), T.StringType()
    return T.StructType([
        T.StructField("meter_id", s, False),
        T.StructField("reading_timestamp", ts, False),
        T.StructField("kwh_consumed", d, True),
        T.StructField("voltage", d, True),
        T.StructField("current_amps", d, True),
        T.StructField("power_factor", d, True),
        T.StructField("reactive_power_kvar", d, True),
        T.StructField("temperature_celsius", d, True),
        T.StructField("meter_status", s, True),
        T.StructField("utility_zone", s, True),
        T.StructField("customer_type", s, True),
        T.StructField("lat", d, True),
        T.StructField("lon", d, True),
    ])


def clean_schema(ts_type: T.DataType | None = None) -> T.StructType:
    ts = ts_type or T.TimestampType()
    return T.StructType(raw_schema(ts).fields + [
        T.StructField("reading_hour", T.IntegerType(), True),
        T.StructField("reading_date", T.DateType(), True),
        T.StructField("is_peak_hour", T.BooleanType(), True),
        T.StructField("is_off_peak", T.BooleanType(), True),
        T.StructField("apparent_power_kva", T.DoubleType(), True),
        T.StructField("_processed_at", T.TimestampType(), True),
    ])


FOREST_NODE_SCHEMA = T.StructType([
    T.StructField("tree_id", T.IntegerType(), False),
    T.StructField("node_id", T.IntegerType(), False),
    T.StructField("feature", T.IntegerType(), False),
    T.StructField("threshold", T.DoubleType(), False),
    T.StructField("left", T.IntegerType(), False),
    T.StructField("right", T.IntegerType(), False),
    T.StructField("n_rows", T.IntegerType(), False),
    T.StructField("path_len", T.DoubleType(), False),
])


_SIMPLE = {"string": T.StringType(), "date": T.DateType(), "int": T.IntegerType(),
           "bigint": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType()}


def _fields(spec: str) -> T.StructType:
    """``"name type, ..."`` with simple types (no session needed)."""
    pairs = [p.split() for p in spec.split(",")]
    return T.StructType([T.StructField(n, _SIMPLE[t], True) for n, t in pairs])


HOURLY_SCHEMA = _fields(
    "meter_id string, reading_date date, reading_hour int, utility_zone string, "
    "customer_type string, total_kwh double, avg_kwh double, max_kwh double, min_kwh double, "
    "std_kwh double, avg_voltage double, min_voltage double, max_voltage double, "
    "avg_power_factor double, avg_current double, avg_temp_c double, reading_count bigint, "
    "peak_hour_readings bigint")

DAILY_SCHEMA = _fields(
    "meter_id string, reading_date date, utility_zone string, customer_type string, "
    "daily_kwh double, avg_hourly_kwh double, peak_kwh double, avg_voltage double, "
    "avg_power_factor double, total_readings bigint, peak_readings bigint, "
    "off_peak_readings bigint")


def scored_schema(ts_type: T.DataType | None = None) -> T.StructType:
    ts = ts_type or T.TimestampType()
    return T.StructType([
        T.StructField("meter_id", T.StringType()),
        T.StructField("reading_timestamp", ts),
        T.StructField("kwh_consumed", T.DoubleType()),
        T.StructField("voltage", T.DoubleType()),
        T.StructField("power_factor", T.DoubleType()),
        T.StructField("utility_zone", T.StringType()),
        T.StructField("customer_type", T.StringType()),
        T.StructField("anomaly_score", T.DoubleType()),
        T.StructField("is_anomaly", T.BooleanType()),
        T.StructField("anomaly_severity", T.StringType()),
        T.StructField("scored_at", T.TimestampType()),
        T.StructField("scoring_date", T.DateType()),
    ])
