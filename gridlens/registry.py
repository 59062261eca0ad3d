"""Registered queries: one Spark callable per operator key and the DuckDB
SQL that computes the same rows.

Every query reads the driver's ``events`` table through the readings
adapter (``gridlens.fixtures``), over the whole table. Double outputs are
rounded to 6 places on both sides with one binary formula (see
``round_doubles``) so the two engines' last-bit summation differences do
not count as mismatches; time stamps of processing
(``_processed_at``, ``scored_at``) are left out of the compared columns.
"""

from __future__ import annotations

import datetime as dt
import math
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlens import fixtures
from gridlens.fixtures import ADAPTER_SQL
from gridlens.functions import derive as D
from gridlens.operators import clean as C
from gridlens.operators import features as FE
from gridlens.operators import forest as FO
from gridlens.operators import quality as Q
from gridlens.operators import rolling as W
from gridlens.operators import rolling_split as WS
from gridlens.operators import rollup as R
from gridlens.operators import scoring as S
from gridlens.plans import jobs as J
from gridlens.schemas import (DAILY_SCHEMA, FEATURE_COLS, HOURLY_SCHEMA, RAW_COLS,
                              clean_schema, scored_schema)
from gridlens.session import table_path
from gridlens.sources import scans as SC
from gridlens.sources import sinks as SK

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            SQL[key] = sql
        return fn
    return deco


def round_doubles(df: DataFrame, places: int = 6) -> DataFrame:
    """Round every double column for the cross-engine comparison.

    Both sides use the same binary formula, half away from zero:
    ``sign(x) * floor(|x| * 10^p + 0.5) / 10^p`` (the SQL wrapper ``r6``
    writes the same expression). ``F.round`` rounds the shortest decimal
    string while DuckDB's ``round`` works on the binary value, so the two
    disagree on exact ties such as a mean of 32 power factors in steps of
    0.05; with one formula, equal doubles always round alike.
    """
    scale = F.lit(float(10 ** places))
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DoubleType):
            c = F.col(f.name)
            half_up = F.signum(c) * F.floor(F.abs(c) * scale + F.lit(0.5)) / scale
            # + 0.0 turns a rounded -0.0 into 0.0 on both engines
            out.append(F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), c)
                       .otherwise(half_up + F.lit(0.0)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.readings(spark, sf_dir)


# --------------------------------------------------------------------------
# SQL building blocks (DuckDB dialect)
# --------------------------------------------------------------------------
_RAW_LIST = ", ".join(RAW_COLS)
_TIEBREAK = ", ".join(f"{c} ASC NULLS FIRST" for c in RAW_COLS[2:])

BASE_CTES = f"""
adapted AS ({ADAPTER_SQL}),
raw AS (SELECT {_RAW_LIST} FROM adapted),
filtered AS (
  SELECT * FROM raw
  WHERE meter_id IS NOT NULL AND reading_timestamp IS NOT NULL
    AND kwh_consumed >= 0 AND voltage BETWEEN 90 AND 280
    AND power_factor BETWEEN 0 AND 1),
dedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY meter_id, reading_timestamp
                                 ORDER BY {_TIEBREAK}) AS rn
    FROM filtered) WHERE rn = 1),
clean AS (
  SELECT *,
         CAST(hour(reading_timestamp) AS INTEGER) AS reading_hour,
         CAST(reading_timestamp AS DATE) AS reading_date,
         coalesce(hour(reading_timestamp) BETWEEN 17 AND 21, false) AS is_peak_hour,
         coalesce(hour(reading_timestamp) BETWEEN 0 AND 6, false) AS is_off_peak,
         CASE WHEN power_factor > 0 THEN kwh_consumed / power_factor END AS apparent_power_kva
  FROM dedup)
"""


def with_ctes(body: str, *extra: str) -> str:
    ctes = BASE_CTES.strip()
    for e in extra:
        ctes += ",\n" + e.strip()
    return f"WITH {ctes}\n{body}"


def r6(sql: str, cols) -> str:
    """Wrap a query so the listed double columns are rounded to 6 places."""
    if not cols:
        return sql
    rep = ", ".join(
        f"CASE WHEN isnan({c}) OR isinf({c}) THEN {c} "
        f"ELSE sign({c}) * floor(abs({c}) * 1e6 + 0.5) / 1e6 + 0.0 END AS {c}" for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM ({sql}) q"


RAW_DOUBLES = ["kwh_consumed", "voltage", "current_amps", "power_factor",
               "reactive_power_kvar", "temperature_celsius", "lat", "lon"]
CLEAN_DOUBLES = RAW_DOUBLES + ["apparent_power_kva"]


# --------------------------------------------------------------------------
# F: filters and dedup
# --------------------------------------------------------------------------


@register("clean_not_null", r6(with_ctes(
    "SELECT * FROM raw WHERE meter_id IS NOT NULL AND reading_timestamp IS NOT NULL"),
    RAW_DOUBLES))
def q_clean_not_null(spark, sf_dir):
    return round_doubles(C.drop_null_keys(_raw(spark, sf_dir)))


@register("clean_nonneg_kwh", r6(with_ctes(
    "SELECT * FROM raw WHERE kwh_consumed >= 0"), RAW_DOUBLES))
def q_clean_nonneg_kwh(spark, sf_dir):
    return round_doubles(C.nonneg_kwh(_raw(spark, sf_dir)))


@register("clean_voltage_range", r6(with_ctes(
    "SELECT * FROM raw WHERE voltage BETWEEN 90 AND 280"), RAW_DOUBLES))
def q_clean_voltage_range(spark, sf_dir):
    return round_doubles(C.voltage_in_range(_raw(spark, sf_dir)))


@register("clean_pf_range", r6(with_ctes(
    "SELECT * FROM raw WHERE power_factor BETWEEN 0 AND 1"), RAW_DOUBLES))
def q_clean_pf_range(spark, sf_dir):
    return round_doubles(C.pf_in_range(_raw(spark, sf_dir)))


@register("clean_dedup", r6(with_ctes(
    f"""SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (PARTITION BY meter_id, reading_timestamp
                                       ORDER BY {_TIEBREAK}) AS rn FROM raw)
        WHERE rn = 1"""), RAW_DOUBLES))
def q_clean_dedup(spark, sf_dir):
    return round_doubles(C.dedup_readings(_raw(spark, sf_dir)))


@register("clean_readings", r6(with_ctes("SELECT * FROM clean"), CLEAN_DOUBLES))
def q_clean_readings(spark, sf_dir):
    return round_doubles(C.clean_readings(_raw(spark, sf_dir)).drop("_processed_at"))


# --------------------------------------------------------------------------
# D: derived columns
# --------------------------------------------------------------------------
@register("derive_hour", with_ctes(
    "SELECT meter_id, reading_timestamp, CAST(hour(reading_timestamp) AS INTEGER) AS reading_hour FROM raw"))
def q_derive_hour(spark, sf_dir):
    return _raw(spark, sf_dir).select("meter_id", "reading_timestamp",
                                      D.reading_hour().alias("reading_hour"))


@register("derive_date", with_ctes(
    "SELECT meter_id, reading_timestamp, CAST(reading_timestamp AS DATE) AS reading_date FROM raw"))
def q_derive_date(spark, sf_dir):
    return _raw(spark, sf_dir).select("meter_id", "reading_timestamp",
                                      D.reading_date().alias("reading_date"))


@register("flag_peak", with_ctes(
    """SELECT meter_id, reading_timestamp,
              coalesce(hour(reading_timestamp) BETWEEN 17 AND 21, false) AS is_peak_hour FROM raw"""))
def q_flag_peak(spark, sf_dir):
    return _raw(spark, sf_dir).select("meter_id", "reading_timestamp",
                                      D.is_peak_hour(D.reading_hour()).alias("is_peak_hour"))


@register("flag_off_peak", with_ctes(
    """SELECT meter_id, reading_timestamp,
              coalesce(hour(reading_timestamp) BETWEEN 0 AND 6, false) AS is_off_peak FROM raw"""))
def q_flag_off_peak(spark, sf_dir):
    return _raw(spark, sf_dir).select("meter_id", "reading_timestamp",
                                      D.is_off_peak(D.reading_hour()).alias("is_off_peak"))


@register("apparent_power", r6(with_ctes(
    """SELECT meter_id, reading_timestamp, kwh_consumed, power_factor,
              CASE WHEN power_factor > 0 THEN kwh_consumed / power_factor END AS apparent_power_kva
       FROM raw"""), ["kwh_consumed", "power_factor", "apparent_power_kva"]))
def q_apparent_power(spark, sf_dir):
    return round_doubles(_raw(spark, sf_dir).select(
        "meter_id", "reading_timestamp", "kwh_consumed", "power_factor",
        D.apparent_power().alias("apparent_power_kva")))


@register("bool_to_count", with_ctes(
    """SELECT reading_date,
              CAST(sum(CAST(is_peak_hour AS INTEGER)) AS BIGINT) AS peak_readings,
              CAST(sum(CAST(is_off_peak AS INTEGER)) AS BIGINT) AS off_peak_readings
       FROM clean GROUP BY reading_date"""))
def q_bool_to_count(spark, sf_dir):
    c = C.clean_readings(_raw(spark, sf_dir))
    return c.groupBy("reading_date").agg(D.bool_count("is_peak_hour").alias("peak_readings"),
                                         D.bool_count("is_off_peak").alias("off_peak_readings"))


# --------------------------------------------------------------------------
# A1, A2: rollups
# --------------------------------------------------------------------------
HOURLY_DOUBLES = ["total_kwh", "avg_kwh", "max_kwh", "min_kwh", "std_kwh", "avg_voltage",
                  "min_voltage", "max_voltage", "avg_power_factor", "avg_current", "avg_temp_c"]
DAILY_DOUBLES = ["daily_kwh", "avg_hourly_kwh", "peak_kwh", "avg_voltage", "avg_power_factor"]

HOURLY_SQL = """
  SELECT meter_id, reading_date, reading_hour, utility_zone, customer_type,
         sum(kwh_consumed) AS total_kwh, avg(kwh_consumed) AS avg_kwh,
         max(kwh_consumed) AS max_kwh, min(kwh_consumed) AS min_kwh,
         stddev_samp(kwh_consumed) AS std_kwh,
         avg(voltage) AS avg_voltage, min(voltage) AS min_voltage, max(voltage) AS max_voltage,
         avg(power_factor) AS avg_power_factor, avg(current_amps) AS avg_current,
         avg(temperature_celsius) AS avg_temp_c,
         count(*) AS reading_count,
         CAST(sum(CAST(is_peak_hour AS INTEGER)) AS BIGINT) AS peak_hour_readings
  FROM clean GROUP BY meter_id, reading_date, reading_hour, utility_zone, customer_type"""

DAILY_SQL = """
  SELECT meter_id, reading_date, utility_zone, customer_type,
         sum(kwh_consumed) AS daily_kwh, avg(kwh_consumed) AS avg_hourly_kwh,
         max(kwh_consumed) AS peak_kwh, avg(voltage) AS avg_voltage,
         avg(power_factor) AS avg_power_factor, count(*) AS total_readings,
         CAST(sum(CAST(is_peak_hour AS INTEGER)) AS BIGINT) AS peak_readings,
         CAST(sum(CAST(is_off_peak AS INTEGER)) AS BIGINT) AS off_peak_readings
  FROM clean GROUP BY meter_id, reading_date, utility_zone, customer_type"""


@register("hourly_rollup", r6(with_ctes(HOURLY_SQL), HOURLY_DOUBLES))
def q_hourly_rollup(spark, sf_dir):
    return round_doubles(R.hourly_rollup(C.clean_readings(_raw(spark, sf_dir))))


@register("daily_rollup", r6(with_ctes(DAILY_SQL), DAILY_DOUBLES))
def q_daily_rollup(spark, sf_dir):
    return round_doubles(R.daily_rollup(C.clean_readings(_raw(spark, sf_dir))))


# --------------------------------------------------------------------------
# Quality reports and gates
# --------------------------------------------------------------------------

QUALITY_SQL = """
  SELECT coalesce(rc.reading_date, cc.reading_date) AS reading_date,
         coalesce(raw_count, 0) AS raw_count, coalesce(clean_count, 0) AS clean_count,
         round((1.0 - coalesce(clean_count, 0) / greatest(coalesce(raw_count, 0), 1)) * 100.0, 2)
           AS dropped_pct
  FROM (SELECT CAST(reading_timestamp AS DATE) AS reading_date, count(*) AS raw_count
        FROM raw GROUP BY 1) rc
  FULL OUTER JOIN (SELECT reading_date, count(*) AS clean_count FROM clean GROUP BY 1) cc
    ON rc.reading_date = cc.reading_date"""

_STATUS = ("CASE WHEN dropped_pct > 10 THEN 'FAIL' WHEN dropped_pct > 5 THEN 'WARN' "
           "ELSE 'OK' END AS status")


def _quality_by_day(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return Q.quality_report(raw, C.clean_readings(raw), by="reading_date")


@register("quality_report", with_ctes(f"SELECT *, {_STATUS} FROM ({QUALITY_SQL}) q"))
def q_quality_report(spark, sf_dir):
    return _quality_by_day(spark, sf_dir)


@register("quality_gate", with_ctes(
    f"SELECT *, {_STATUS}, dropped_pct <= 10.0 AS passed FROM ({QUALITY_SQL}) q"))
def q_quality_gate(spark, sf_dir):
    return Q.with_gate(_quality_by_day(spark, sf_dir))


@register("null_profile", with_ctes(
    """SELECT CAST(reading_timestamp AS DATE) AS reading_date,
              count(*) FILTER (WHERE kwh_consumed IS NULL) AS null_kwh_consumed,
              count(*) FILTER (WHERE voltage IS NULL) AS null_voltage,
              count(*) FILTER (WHERE meter_id IS NULL) AS null_meter_id,
              count(*) FILTER (WHERE current_amps IS NULL) AS null_current_amps,
              count(*) FILTER (WHERE utility_zone IS NULL) AS null_utility_zone
       FROM raw GROUP BY 1"""))
def q_null_profile(spark, sf_dir):
    raw = _raw(spark, sf_dir).withColumn("reading_date", D.reading_date())
    return Q.null_profile(raw, ["kwh_consumed", "voltage", "meter_id", "current_amps",
                                "utility_zone"], by="reading_date")


@register("load_row_count", with_ctes(
    f"SELECT reading_date, count(*) AS row_count FROM ({HOURLY_SQL}) h GROUP BY reading_date"))
def q_load_row_count(spark, sf_dir):
    hourly = R.hourly_rollup(C.clean_readings(_raw(spark, sf_dir)))
    return Q.load_row_count(hourly)


# A table loaded twice for the first ten days (an appended re-run).
_RELOADED_SQL = f"""
  SELECT * FROM ({HOURLY_SQL}) h1
  UNION ALL
  SELECT * FROM ({HOURLY_SQL}) h2
  WHERE reading_date <= (SELECT CAST(min(reading_timestamp) AS DATE) + 9 FROM raw)"""


def _reloaded_hourly(spark, sf_dir):
    hourly = R.hourly_rollup(C.clean_readings(_raw(spark, sf_dir)))
    last = fixtures.fixture_days(spark, sf_dir)[0] + dt.timedelta(days=9)
    return hourly.unionByName(hourly.filter(F.col("reading_date") <= F.lit(last)))


@register("duplicate_keys", with_ctes(
    f"""SELECT reading_date, count(*) FILTER (WHERE n > 1) AS duplicate_keys FROM (
          SELECT meter_id, reading_date, reading_hour, count(*) AS n
          FROM ({_RELOADED_SQL}) t GROUP BY 1, 2, 3) k
        GROUP BY reading_date"""))
def q_duplicate_keys(spark, sf_dir):
    return Q.duplicate_keys(_reloaded_hourly(spark, sf_dir))


# Given scores (FIXTURES.md s.3) on the raw readings, reference cut-offs.
GIVEN_SCORED_CTE = """
given AS (
  SELECT meter_id, reading_timestamp, kwh_consumed, voltage, power_factor,
         utility_zone, customer_type, is_true_anomaly,
         -0.05 - (kwh_consumed - floor(kwh_consumed)) * 0.45 AS anomaly_score,
         CAST(reading_timestamp AS DATE) AS scoring_date
  FROM adapted),
given_scored AS (
  SELECT *, anomaly_score < -0.15 AS is_anomaly,
         CASE WHEN anomaly_score < -0.30 THEN 'HIGH'
              WHEN anomaly_score < -0.20 THEN 'MEDIUM'
              WHEN anomaly_score < -0.15 THEN 'LOW' ELSE 'NORMAL' END AS anomaly_severity
  FROM given)
"""


def _given_scored(spark, sf_dir):
    a = fixtures.readings(spark, sf_dir, with_label=True).select(
        "meter_id", "reading_timestamp", "kwh_consumed", "voltage", "power_factor",
        "utility_zone", "customer_type", "is_true_anomaly")
    a = fixtures.given_scores(a).withColumn("scoring_date", D.reading_date())
    return S.flag_and_grade(a, mode="raw")


RATE_SQL = """
  SELECT scoring_date, count(*) AS total,
         CAST(sum(CASE WHEN is_anomaly THEN 1 ELSE 0 END) AS BIGINT) AS anomalies,
         round(100.0E0 * sum(CASE WHEN is_anomaly THEN 1 ELSE 0 END)
               / nullif(count(*), 0), 2) AS anomaly_rate_pct
  FROM given_scored GROUP BY scoring_date"""


@register("anomaly_rate", with_ctes(RATE_SQL, GIVEN_SCORED_CTE))
def q_anomaly_rate(spark, sf_dir):
    return Q.anomaly_rate(_given_scored(spark, sf_dir))


@register("anomaly_rate_gate", with_ctes(
    f"SELECT *, coalesce(anomaly_rate_pct > 5.0, false) AS alert FROM ({RATE_SQL}) r",
    GIVEN_SCORED_CTE))
def q_anomaly_rate_gate(spark, sf_dir):
    return Q.with_rate_alert(Q.anomaly_rate(_given_scored(spark, sf_dir)))


# --------------------------------------------------------------------------
# W1-W3 rolling frames, D7-D12 and D17 features, F7, A13
# --------------------------------------------------------------------------


#: Rows of a meter beyond which its series is split over tasks in W1-W3 and
#: O1: small enough that meters of the test tables are split.
ROWS_PER_TASK = 300


def _frame(rows: int) -> str:
    return (f"OVER (PARTITION BY meter_id ORDER BY reading_timestamp "
            f"ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)")


@register("rolling_mean", r6(with_ctes(
    f"""SELECT meter_id, reading_timestamp, kwh_consumed,
               avg(kwh_consumed) {_frame(168)} AS rolling_7d_mean_kwh FROM clean"""),
    ["kwh_consumed", "rolling_7d_mean_kwh"]))
def q_rolling_mean(spark, sf_dir):
    c = C.clean_readings(_raw(spark, sf_dir)).select("meter_id", "reading_timestamp", "kwh_consumed")
    return round_doubles(WS.rolling_stats_split(c, rows_per_task=ROWS_PER_TASK).drop(W.STD_COL))


@register("rolling_std", r6(with_ctes(
    f"""SELECT meter_id, reading_timestamp, kwh_consumed,
               coalesce(stddev_samp(kwh_consumed) {_frame(168)}, 0.0) AS rolling_7d_std_kwh
        FROM clean"""), ["kwh_consumed", "rolling_7d_std_kwh"]))
def q_rolling_std(spark, sf_dir):
    c = C.clean_readings(_raw(spark, sf_dir)).select("meter_id", "reading_timestamp", "kwh_consumed")
    return round_doubles(WS.rolling_stats_split(c, rows_per_task=ROWS_PER_TASK).drop(W.MEAN_COL))


@register("rolling_scoring_frame", r6(with_ctes(
    f"""SELECT meter_id, reading_timestamp, kwh_consumed,
               avg(kwh_consumed) {_frame(169)} AS rolling_7d_mean_kwh,
               stddev_samp(kwh_consumed) {_frame(169)} AS rolling_7d_std_kwh
        FROM clean"""), ["kwh_consumed", "rolling_7d_mean_kwh", "rolling_7d_std_kwh"]))
def q_rolling_scoring_frame(spark, sf_dir):
    c = C.clean_readings(_raw(spark, sf_dir)).select("meter_id", "reading_timestamp", "kwh_consumed")
    return round_doubles(WS.rolling_stats_split(c, frame_rows=W.SCORE_FRAME_ROWS, std_null_to_zero=False,
                                                rows_per_task=ROWS_PER_TASK))


@register("derive_weekday", with_ctes(
    "SELECT meter_id, reading_timestamp, CAST(isodow(reading_timestamp) - 1 AS INTEGER) AS day_of_week FROM raw"))
def q_derive_weekday(spark, sf_dir):
    return _raw(spark, sf_dir).select("meter_id", "reading_timestamp", D.weekday().alias("day_of_week"))


@register("cyclic_hour", r6(with_ctes(
    """SELECT meter_id, reading_timestamp,
              sin(2 * pi() * hour(reading_timestamp) / 24) AS reading_hour_sin,
              cos(2 * pi() * hour(reading_timestamp) / 24) AS reading_hour_cos FROM raw"""),
    ["reading_hour_sin", "reading_hour_cos"]))
def q_cyclic_hour(spark, sf_dir):
    h = D.reading_hour()
    return round_doubles(_raw(spark, sf_dir).select(
        "meter_id", "reading_timestamp", D.cyclic_sin(h, 24).alias("reading_hour_sin"),
        D.cyclic_cos(h, 24).alias("reading_hour_cos")))


@register("cyclic_weekday", r6(with_ctes(
    """SELECT meter_id, reading_timestamp,
              sin(2 * pi() * (isodow(reading_timestamp) - 1) / 7) AS day_of_week_sin,
              cos(2 * pi() * (isodow(reading_timestamp) - 1) / 7) AS day_of_week_cos FROM raw"""),
    ["day_of_week_sin", "day_of_week_cos"]))
def q_cyclic_weekday(spark, sf_dir):
    d = D.weekday()
    return round_doubles(_raw(spark, sf_dir).select(
        "meter_id", "reading_timestamp", D.cyclic_sin(d, 7).alias("day_of_week_sin"),
        D.cyclic_cos(d, 7).alias("day_of_week_cos")))


_TRAIN_STATS = f"""
train_stats AS (
  SELECT *, avg(kwh_consumed) {_frame(168)} AS rolling_7d_mean_kwh,
         coalesce(stddev_samp(kwh_consumed) {_frame(168)}, 0.0) AS rolling_7d_std_kwh
  FROM clean),
score_stats AS (
  SELECT *, avg(kwh_consumed) {_frame(169)} AS rolling_7d_mean_kwh,
         stddev_samp(kwh_consumed) {_frame(169)} AS rolling_7d_std_kwh
  FROM clean),
feats AS (
  SELECT meter_id, reading_timestamp, kwh_consumed, voltage, current_amps, power_factor,
         reactive_power_kvar, apparent_power_kva,
         sin(2 * pi() * reading_hour / 24) AS reading_hour_sin,
         cos(2 * pi() * reading_hour / 24) AS reading_hour_cos,
         sin(2 * pi() * (isodow(reading_timestamp) - 1) / 7) AS day_of_week_sin,
         cos(2 * pi() * (isodow(reading_timestamp) - 1) / 7) AS day_of_week_cos,
         rolling_7d_mean_kwh, rolling_7d_std_kwh,
         (kwh_consumed - rolling_7d_mean_kwh)
           / CASE WHEN rolling_7d_std_kwh = 0 THEN 1.0 ELSE rolling_7d_std_kwh END AS kwh_z_score
  FROM train_stats)
"""


@register("kwh_z_score", r6(with_ctes(
    """SELECT meter_id, reading_timestamp, kwh_z_score FROM feats""", _TRAIN_STATS),
    ["kwh_z_score"]))
def q_kwh_z_score(spark, sf_dir):
    f = FE.engineer_features(C.clean_readings(_raw(spark, sf_dir)))
    return round_doubles(f.select("meter_id", "reading_timestamp", "kwh_z_score"))


@register("kwh_z_score_floor", r6(with_ctes(
    """SELECT meter_id, reading_timestamp,
              (kwh_consumed - rolling_7d_mean_kwh) / greatest(rolling_7d_std_kwh, 1e-9) AS kwh_z_score
       FROM score_stats""", _TRAIN_STATS), ["kwh_z_score"]))
def q_kwh_z_score_floor(spark, sf_dir):
    f = FE.engineer_features(C.clean_readings(_raw(spark, sf_dir)),
                             frame_rows=W.SCORE_FRAME_ROWS, scoring_variant=True)
    return round_doubles(f.select("meter_id", "reading_timestamp", "kwh_z_score"))


@register("impute_zero", r6(with_ctes(
    """SELECT meter_id, reading_timestamp, coalesce(current_amps, 0.0) AS current_amps,
              coalesce(kwh_consumed, 0.0) AS kwh_consumed FROM raw"""),
    ["current_amps", "kwh_consumed"]))
def q_impute_zero(spark, sf_dir):
    r = _raw(spark, sf_dir).select("meter_id", "reading_timestamp", "current_amps", "kwh_consumed")
    return round_doubles(FE.impute_features(r, ["current_amps", "kwh_consumed"]))


@register("engineer_features", r6(with_ctes("SELECT * FROM feats", _TRAIN_STATS), FEATURE_COLS))
def q_engineer_features(spark, sf_dir):
    f = FE.engineer_features(C.clean_readings(_raw(spark, sf_dir)))
    return round_doubles(f.select("meter_id", "reading_timestamp", *FEATURE_COLS))


_NOT_NULL_FEATS = " AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in FEATURE_COLS)


@register("drop_null_features", r6(with_ctes(
    f"SELECT * FROM feats WHERE {_NOT_NULL_FEATS}", _TRAIN_STATS), FEATURE_COLS))
def q_drop_null_features(spark, sf_dir):
    f = FE.engineer_features(C.clean_readings(_raw(spark, sf_dir)))
    return round_doubles(C.drop_null_features(f.select("meter_id", "reading_timestamp", *FEATURE_COLS)))


_STATS_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {i} AS ordinal, avg({c}) AS mean, stddev_pop({c}) AS std FROM ok"
    for i, c in enumerate(FEATURE_COLS))


_SCALED_SQL = " UNION ALL ".join(
    f"SELECT f.meter_id, f.reading_timestamp, s.feature, s.mean, s.std, "
    f"(f.{c} - s.mean) / CASE WHEN s.std = 0 THEN 1 ELSE s.std END AS scaled FROM ok f JOIN stats s ON s.feature = '{c}'"
    for c in ("kwh_consumed", "voltage", "kwh_z_score"))


@register("feature_scaler", r6(with_ctes(
    _SCALED_SQL, _TRAIN_STATS, f"ok AS (SELECT * FROM feats WHERE {_NOT_NULL_FEATS})", f"stats AS ({_STATS_SQL})"),
    ["mean", "std", "scaled"]))
def q_feature_scaler(spark, sf_dir):
    """The statistics of three features and the features scaled by them."""
    f = C.drop_null_features(FE.engineer_features(C.clean_readings(_raw(spark, sf_dir))))
    stats = FE.feature_stats(f)
    some = ["kwh_consumed", "voltage", "kwh_z_score"]
    scaled = FE.scale_features(f.select("meter_id", "reading_timestamp", *some), stats.collect(), some)
    pairs = ", ".join(f"'{c}', {c}" for c in some)
    long = scaled.selectExpr("meter_id", "reading_timestamp", f"stack({len(some)}, {pairs}) AS (feature, scaled)")
    return round_doubles(long.join(stats.drop("ordinal"), "feature"))


# --------------------------------------------------------------------------
# D13, D14, F8, A10-A12, M4 on given scores
# --------------------------------------------------------------------------

_GIVEN_OUT = ("meter_id, reading_timestamp, kwh_consumed, voltage, power_factor, utility_zone, "
              "customer_type, anomaly_score, is_anomaly, anomaly_severity, scoring_date")
_GIVEN_DOUBLES = ["kwh_consumed", "voltage", "power_factor", "anomaly_score"]


def _given_out(df):
    return round_doubles(df.select(*[c.strip() for c in _GIVEN_OUT.split(",")]))


@register("flag_anomaly", r6(with_ctes(
    "SELECT meter_id, reading_timestamp, anomaly_score, is_anomaly FROM given_scored",
    GIVEN_SCORED_CTE), ["anomaly_score"]))
def q_flag_anomaly(spark, sf_dir):
    return round_doubles(_given_scored(spark, sf_dir).select(
        "meter_id", "reading_timestamp", "anomaly_score", "is_anomaly"))


@register("severity_ladder", with_ctes(
    """SELECT scoring_date, anomaly_severity, count(*) AS n_readings
       FROM given_scored GROUP BY 1, 2""", GIVEN_SCORED_CTE))
def q_severity_ladder(spark, sf_dir):
    return (_given_scored(spark, sf_dir).groupBy("scoring_date", "anomaly_severity")
            .agg(F.count(F.lit(1)).alias("n_readings")))


@register("filter_anomalies", r6(with_ctes(
    f"SELECT {_GIVEN_OUT} FROM given_scored WHERE is_anomaly", GIVEN_SCORED_CTE), _GIVEN_DOUBLES))
def q_filter_anomalies(spark, sf_dir):
    return _given_out(S.filter_anomalies(_given_scored(spark, sf_dir)))


@register("score_stats", r6(with_ctes(
    """SELECT avg(anomaly_score) AS score_mean, stddev_pop(anomaly_score) AS score_std,
              min(anomaly_score) AS score_min, max(anomaly_score) AS score_max
       FROM given_scored""", GIVEN_SCORED_CTE),
    ["score_mean", "score_std", "score_min", "score_max"]))
def q_score_stats(spark, sf_dir):
    return round_doubles(S.score_stats(_given_scored(spark, sf_dir)))


@register("evaluate_scores", with_ctes(
    """SELECT round(coalesce(tp / nullif(tp + fp, 0), 0.0), 4) AS precision,
              round(coalesce(tp / nullif(tp + fn, 0), 0.0), 4) AS recall,
              round(coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0.0), 4) AS f1_score,
              -0.15E0 AS threshold, 0.02E0 AS contamination,
              n AS n_val_samples, tp + fp AS n_anomalies_detected, tp + fn AS n_true_anomalies
       FROM (SELECT count(*) FILTER (WHERE is_true_anomaly = 1 AND coalesce(is_anomaly, false)) AS tp,
                    count(*) FILTER (WHERE is_true_anomaly <> 1 AND coalesce(is_anomaly, false)) AS fp,
                    count(*) FILTER (WHERE is_true_anomaly = 1 AND NOT coalesce(is_anomaly, false)) AS fn,
                    count(*) AS n FROM given_scored) c""", GIVEN_SCORED_CTE))
def q_evaluate_scores(spark, sf_dir):
    return S.evaluate_scores(_given_scored(spark, sf_dir))


@register("scoring_summary", with_ctes(
    """SELECT count(*) AS total_scored,
              count(*) FILTER (WHERE coalesce(is_anomaly, false)) AS total_anomalies,
              round(count(*) FILTER (WHERE coalesce(is_anomaly, false))
                    / greatest(count(*), 1) * 100.0, 2) AS anomaly_rate_pct
       FROM given_scored""", GIVEN_SCORED_CTE))
def q_scoring_summary(spark, sf_dir):
    return S.scoring_summary(_given_scored(spark, sf_dir))


@register("contamination_offset", r6(with_ctes(
    "SELECT quantile_cont(anomaly_score, 0.02) AS offset_score FROM given_scored",
    GIVEN_SCORED_CTE), ["offset_score"]))
def q_contamination_offset(spark, sf_dir):
    v = S.contamination_offset(_given_scored(spark, sf_dir))
    return round_doubles(spark.createDataFrame([(v,)], "offset_score double"))


# --------------------------------------------------------------------------
# Scans of the partitioned layouts
# --------------------------------------------------------------------------


TS = fixtures.FIXTURE_TS
_days = fixtures.fixture_days
_FIRST = "(SELECT CAST(min(reading_timestamp) AS DATE) FROM raw)"
_LAST = "(SELECT CAST(max(reading_timestamp) AS DATE) FROM raw)"
_DIR_DATE = ("CASE WHEN minute(reading_timestamp) % 20 = 0 THEN CAST(reading_timestamp AS DATE) - 1 "
             "ELSE CAST(reading_timestamp AS DATE) END")
LAYOUT_CTE = f"""
layout AS (
  SELECT *, CAST(year(dir) AS INTEGER) AS year, CAST(month(dir) AS INTEGER) AS month,
         CAST(day(dir) AS INTEGER) AS day
  FROM (SELECT *, {_DIR_DATE} AS dir FROM raw) x)
"""
_LAYOUT_COLS = _RAW_LIST + ", year, month, day"
_CLEAN_OUT = [f.name for f in clean_schema().fields if f.name != "_processed_at"]


@register("scan_day_partitions", r6(with_ctes(
    f"SELECT {_LAYOUT_COLS} FROM layout WHERE dir BETWEEN {_FIRST} - 1 AND {_LAST}",
    LAYOUT_CTE), RAW_DOUBLES))
def q_scan_day_partitions(spark, sf_dir):
    root = fixtures.raw_layout(spark, sf_dir)
    first, last = _days(spark, sf_dir)
    return round_doubles(SC.scan_day_partitions(spark, root, last, (last - first).days + 1, ts_type=TS))


@register("scan_fixed_schema", r6(with_ctes("SELECT * FROM raw"), RAW_DOUBLES))
def q_scan_fixed_schema(spark, sf_dir):
    root = fixtures.raw_layout(spark, sf_dir)
    first, last = _days(spark, sf_dir)
    return round_doubles(SC.scan_day_partitions(spark, root, last, (last - first).days + 1, ts_type=TS)
                         .select(*RAW_COLS))


@register("filter_exact_date", r6(with_ctes(
    f"""SELECT {_RAW_LIST} FROM layout
        WHERE dir BETWEEN {_FIRST} AND {_LAST}
          AND reading_timestamp >= CAST({_FIRST} + 1 AS TIMESTAMP)
          AND reading_timestamp < CAST({_LAST} + 1 AS TIMESTAMP)""", LAYOUT_CTE), RAW_DOUBLES))
def q_filter_exact_date(spark, sf_dir):
    root = fixtures.raw_layout(spark, sf_dir)
    first, last = _days(spark, sf_dir)
    return round_doubles(SC.read_raw(spark, root, first + dt.timedelta(days=1), 1, last, ts_type=TS))


def _clean_readback(df):
    return round_doubles(df.select(*_CLEAN_OUT))


@register("scan_processed_day", r6(with_ctes(
    f"SELECT {', '.join(_CLEAN_OUT)} FROM clean"), CLEAN_DOUBLES))
def q_scan_processed_day(spark, sf_dir):
    root = fixtures.processed_layout(spark, sf_dir)
    return _clean_readback(SC.scan_processed_days(spark, f"{root}/readings", *_days(spark, sf_dir), ts_type=TS))


@register("scan_training_window", r6(with_ctes(
    f"SELECT {', '.join(_CLEAN_OUT)} FROM clean"), CLEAN_DOUBLES))
def q_scan_training_window(spark, sf_dir):
    root = fixtures.processed_layout(spark, sf_dir)
    return _clean_readback(SC.scan_training_window(spark, f"{root}/readings",
                                                   *fixtures.training_window(spark, sf_dir), ts_type=TS))


@register("union_days", r6(with_ctes(
    f"""SELECT {_RAW_LIST}, CAST(NULL AS VARCHAR) AS firmware FROM raw WHERE day(reading_timestamp) % 3 = 0
        UNION ALL SELECT {_RAW_LIST.replace('reactive_power_kvar', 'CAST(NULL AS DOUBLE) AS reactive_power_kvar')},
                         meter_status AS firmware FROM raw WHERE day(reading_timestamp) % 3 = 1
        UNION ALL SELECT {_RAW_LIST}, CAST(NULL AS VARCHAR) FROM raw WHERE day(reading_timestamp) % 3 = 2"""),
    RAW_DOUBLES))
def q_union_days(spark, sf_dir):
    """Day frames of three layouts: as raw, one that lacks a column and has a
    new one, and one with its columns in another order."""
    r = _raw(spark, sf_dir)
    third = F.dayofmonth("reading_timestamp") % 3
    frames = [r.filter(third == 0),
              r.filter(third == 1).drop("reactive_power_kvar").withColumn("firmware", F.col("meter_status")),
              r.filter(third == 2).select(*reversed(RAW_COLS))]
    return round_doubles(SC.union_days([f.select(*[c for c in f.columns if c in (*RAW_COLS, "firmware")])
                                        for f in frames]))


# --------------------------------------------------------------------------
# K1-K8: writes, read back
# --------------------------------------------------------------------------
def _run_dir(spark, sf_dir, key):
    """A folder of its own for each call."""
    return table_path(spark, "runs", f"{fixtures._tag(sf_dir)}-{uuid.uuid4().hex}", key)


def _twice(write, rows, **kw):
    """Write a wider version first (a zone, a type and rows that the real one
    lacks), then the real one, which must be all that is left."""
    def other(c):
        return F.lit("GONE").alias(c) if c in ("utility_zone", "customer_type", "meter_id") else F.col(c)
    write(rows.unionByName(rows.select(*[other(c) for c in rows.columns])), **kw)
    return write(rows, **kw)


@register("sink_clustered_parquet", r6(with_ctes(
    f"SELECT {', '.join(_CLEAN_OUT)} FROM clean"), CLEAN_DOUBLES))
def q_sink_clustered_parquet(spark, sf_dir):
    path = _run_dir(spark, sf_dir, "clustered")
    c = C.clean_readings(_raw(spark, sf_dir), fixtures.FIXTURE_AS_OF)
    _twice(lambda d: SK.write_clustered(d, path, ["utility_zone", "customer_type"]), c)
    s = clean_schema(TS)
    fields = [f for f in s.fields if f.name not in ("utility_zone", "customer_type")]
    back = spark.read.schema(T.StructType(fields + [s["utility_zone"], s["customer_type"]])).parquet(path)
    return _clean_readback(back)


@register("sink_clean_readings", r6(with_ctes(
    f"SELECT {', '.join(_CLEAN_OUT)} FROM clean"), CLEAN_DOUBLES))
def q_sink_clean_readings(spark, sf_dir):
    path = _run_dir(spark, sf_dir, "readings")
    _twice(lambda d: SK.write_clean_readings(d, path), C.clean_readings(_raw(spark, sf_dir), fixtures.FIXTURE_AS_OF))
    return _clean_readback(SC.scan_processed_days(spark, path, *_days(spark, sf_dir), TS))


def _hourly_written(spark, sf_dir):
    path = _run_dir(spark, sf_dir, "hourly")
    _twice(lambda d: SK.write_hourly(d, path), R.hourly_rollup(C.clean_readings(_raw(spark, sf_dir))))
    return path


@register("sink_hourly", r6(with_ctes(HOURLY_SQL), HOURLY_DOUBLES))
def q_sink_hourly(spark, sf_dir):
    path = _hourly_written(spark, sf_dir)
    return round_doubles(SK.table_of_days(spark, path, HOURLY_SCHEMA, "reading_date").select(*HOURLY_SCHEMA.names))


@register("sink_daily", r6(with_ctes(DAILY_SQL), DAILY_DOUBLES))
def q_sink_daily(spark, sf_dir):
    path = _run_dir(spark, sf_dir, "daily")
    _twice(lambda d: SK.write_daily(d, path), R.daily_rollup(C.clean_readings(_raw(spark, sf_dir))))
    return round_doubles(SK.table_of_days(spark, path, DAILY_SCHEMA, "reading_date").select(*DAILY_SCHEMA.names))


def _scored_written(spark, sf_dir):
    path = _run_dir(spark, sf_dir, "anomaly_scores")
    g = _given_scored(spark, sf_dir).withColumn("scored_at", F.lit(fixtures.FIXTURE_AS_OF).cast("timestamp"))
    _twice(lambda d: SK.write_scored(d, path), g)
    return path


_SCORED_BACK = [f.name for f in scored_schema().fields if f.name != "scored_at"]


@register("sink_scored", r6(with_ctes(
    f"SELECT {', '.join(_SCORED_BACK)} FROM given_scored", GIVEN_SCORED_CTE), _GIVEN_DOUBLES))
def q_sink_scored(spark, sf_dir):
    path = _scored_written(spark, sf_dir)
    return round_doubles(SK.table_of_days(spark, path, scored_schema(TS), "scoring_date").select(*_SCORED_BACK))


@register("load_hourly_table", r6(with_ctes(HOURLY_SQL), HOURLY_DOUBLES))
def q_load_hourly_table(spark, sf_dir):
    src = _hourly_written(spark, sf_dir)
    wh = _run_dir(spark, sf_dir, "warehouse/hourly_readings")
    wide = _run_dir(spark, sf_dir, "hourly-wide")
    h = SK.table_of_days(spark, src, HOURLY_SCHEMA, "reading_date")
    SK.write_hourly(h.unionByName(h.withColumn("meter_id", F.lit("GONE"))), wide)
    for root in (wide, src):  # a re-run replaces the days, it does not add rows
        t = SK.load_table(spark, root, wh, HOURLY_SCHEMA, "reading_date", *_days(spark, sf_dir))
    return round_doubles(t.select(*HOURLY_SCHEMA.names))


@register("load_scored_table", r6(with_ctes(
    f"SELECT {', '.join(_SCORED_BACK)} FROM given_scored", GIVEN_SCORED_CTE), _GIVEN_DOUBLES))
def q_load_scored_table(spark, sf_dir):
    src = _scored_written(spark, sf_dir)
    wh = _run_dir(spark, sf_dir, "warehouse/anomaly_scores")
    wide = _run_dir(spark, sf_dir, "scores-wide")
    g = SK.table_of_days(spark, src, scored_schema(TS), "scoring_date")
    SK.write_scored(g.unionByName(g.withColumn("meter_id", F.lit("GONE"))), wide)
    for root in (wide, src):
        t = SK.load_table(spark, root, wh, scored_schema(TS), "scoring_date", *_days(spark, sf_dir))
    return round_doubles(t.select(*_SCORED_BACK))


# --------------------------------------------------------------------------
# The sample's rows, the trees and scores of a forest that SQL
# grows by the same draws, and scores of a small forest given as a literal
# --------------------------------------------------------------------------


def _train_features(spark, sf_dir):
    return spark.read.parquet(fixtures.train_features_layout(spark, sf_dir))


_SAMPLE_SQL = f"""
k AS (SELECT meter_id, reading_timestamp, strftime(reading_timestamp, '%Y%m%d%H%M%S%f') AS st
      FROM feats WHERE {_NOT_NULL_FEATS}),
par AS (SELECT least({FO.MAX_SAMPLES}, count(*)) AS psi,
               ln(1 - least({FO.DRAW_MARGIN} * least({FO.MAX_SAMPLES}, count(*)) / count(*), 1 - pow(2, -52))) AS log_miss FROM k),
gaps AS (SELECT k.*, i, least(floor(ln((CAST('0x' || substr(md5(concat_ws('|', meter_id, st, '{FO.SEED}', 'gap', i)), 1, 13) AS BIGINT)
                  + 0.5) / pow(2, 52)) / log_miss), {FO.N_TREES}) AS gap, psi
         FROM k, par, range(0, {FO.N_TREES} + 1) r(i)),
hits AS (SELECT *, CAST(sum(gap + 1) OVER (PARTITION BY meter_id, reading_timestamp ORDER BY i) - 1 AS INTEGER) AS tree_id FROM gaps),
drawn AS (SELECT *, row_number() OVER (PARTITION BY tree_id ORDER BY md5(concat_ws('|', meter_id, st, '{FO.SEED}', 'rank', tree_id)),
                 meter_id, reading_timestamp) AS pos FROM hits WHERE tree_id < {FO.N_TREES})
"""


@register("forest_sample", with_ctes(
    "SELECT tree_id, meter_id, reading_timestamp FROM drawn WHERE pos <= psi", _TRAIN_STATS, _SAMPLE_SQL))
def q_forest_sample(spark, sf_dir):
    sample, _ = FO.forest_sample(_train_features(spark, sf_dir))
    return sample.select("tree_id", "meter_id", "reading_timestamp")


def recursive_ctes(body: str, *extra: str) -> str:
    return with_ctes(body, *extra).replace("WITH", "WITH RECURSIVE", 1)


_PSI = "(SELECT psi FROM par)"
_WIDTH = len(FEATURE_COLS)


def _node_draw(start: int) -> str:
    """``forest.split_draw`` in SQL: 13 hex digits of the node's md5 from ``start``."""
    return (f"((CAST('0x' || substr(md5(concat_ws('|', '{FO.SEED}', tree_id, node_id)), {start}, 13) AS BIGINT)"
            " + CAST(0.5 AS DOUBLE)) / pow(2, 52))")


def _with_split(rows: str) -> str:
    """Rows of nodes with their node's size, feature (-1: a leaf) and threshold."""
    ends = {f: ", ".join(f"{f}(xs[{i}]) OVER node" for i in range(1, _WIDTH + 1)) for f in ("min", "max")}
    return f"""
  SELECT tree_id, node_id, depth, xs, m, feature,
         CASE WHEN feature >= 0 THEN lo[feature + 1] + (hi[feature + 1] - lo[feature + 1]) * {_node_draw(14)} ELSE 0 END AS threshold
  FROM (SELECT *, CAST(CASE WHEN depth < ceil(log2(greatest({_PSI}, 2))) AND len(free) > 0
                            THEN free[1 + CAST(floor({_node_draw(1)} * len(free)) AS INTEGER)] ELSE -1 END AS INTEGER) AS feature
        FROM (SELECT *, list_filter(range(0, {_WIDTH}), lambda i: hi[i + 1] - lo[i + 1] > {FO.MIN_RANGE!r}) AS free
              FROM (SELECT *, count(*) OVER node AS m, [{ends["min"]}] AS lo, [{ends["max"]}] AS hi
                    FROM ({rows}) r WINDOW node AS (PARTITION BY tree_id, node_id)) e) f) g"""


def _c(m: str) -> str:
    """``forest.average_path_length`` in SQL."""
    return (f"CASE WHEN {m} <= 1 THEN 0 WHEN {m} = 2 THEN 1 "
            f"ELSE 2 * (ln({m} - 1) + {FO.EULER_GAMMA!r}) - 2 * ({m} - 1) / {m} END")


def _below(rows: str, x: str) -> str:
    """One level down: the child where the split of ``rows`` sends ``x``."""
    return f"2 * {rows}.node_id + CASE WHEN {x} < {rows}.threshold THEN 1 ELSE 2 END"


# The forest grown by recursion over levels: rows move to the child their
# value chooses until no node splits.
_FOREST_SQL = f"""
grown AS ({_with_split(f"SELECT tree_id, 0 AS node_id, 0 AS depth, [{', '.join(FEATURE_COLS)}] AS xs "
                       "FROM drawn JOIN feats USING (meter_id, reading_timestamp) WHERE pos <= psi")}
  UNION ALL {_with_split(f"SELECT tree_id, {_below('grown', 'xs[feature + 1]')} AS node_id, depth + 1 AS depth, xs "
                         "FROM grown WHERE feature >= 0")}),
nodes AS MATERIALIZED (
  SELECT DISTINCT tree_id, node_id, feature, threshold,
         CASE WHEN feature >= 0 THEN 2 * node_id + 1 ELSE -1 END AS "left",
         CASE WHEN feature >= 0 THEN 2 * node_id + 2 ELSE -1 END AS "right",
         CAST(m AS INTEGER) AS n_rows,
         CAST(depth + CASE WHEN feature >= 0 THEN 0 ELSE {_c("m")} END AS DOUBLE) AS path_len
  FROM grown)
"""


def _forest_scores(name: str, rows: str) -> str:
    """Mean path of each row through all trees, as CTE ``name``; ``rows`` gives
    the features, NULL ones count as 0. A leaf keeps its rows at every level."""
    walk = f"""SELECT meter_id, reading_timestamp, xs, n.* FROM
        (SELECT meter_id, reading_timestamp, [{', '.join(f'coalesce({c}, 0)' for c in FEATURE_COLS)}] AS xs FROM ({rows}) q) x
        JOIN nodes n ON n.node_id = 0"""
    for _ in range(math.ceil(math.log2(FO.MAX_SAMPLES))):
        walk = f"""SELECT w.meter_id, w.reading_timestamp, w.xs, n.* FROM (
        SELECT *, CASE WHEN feature < 0 THEN v.node_id ELSE {_below('v', 'xs[feature + 1]')} END AS go FROM ({walk}) v) w
        JOIN nodes n ON n.tree_id = w.tree_id AND n.node_id = w.go"""
    return f"""
{name} AS MATERIALIZED (
  SELECT meter_id, reading_timestamp, -pow(2, -avg(path_len) / ({_c(_PSI)})) AS anomaly_score
  FROM ({walk}) w GROUP BY meter_id, reading_timestamp)"""


_TRAIN_SCORES = _forest_scores("train_scores", f"SELECT * FROM feats WHERE {_NOT_NULL_FEATS}")


@register("forest_fit", r6(recursive_ctes("SELECT * FROM nodes", _TRAIN_STATS, _SAMPLE_SQL, _FOREST_SQL),
                           ["threshold", "path_len"]))
def q_forest_fit(spark, sf_dir):
    """The node table of all trees."""
    sample, psi = FO.forest_sample(_train_features(spark, sf_dir))
    return round_doubles(FO.forest_fit(sample, psi))


def _saved_model(spark, sf_dir):
    return SK.load_model_tables(spark, fixtures.model_layout(spark, sf_dir))


@register("model_save_load", f"SELECT CAST({FO.N_TREES} AS BIGINT) AS n_trees, CAST(0 AS BIGINT) AS changed_nodes, true AS same_metrics")
def q_model_save_load(spark, sf_dir):
    """A model saved over another one and read back: trees, nodes that are
    not as saved, and whether the metrics are."""
    nodes, metrics = _saved_model(spark, sf_dir)
    root = _run_dir(spark, sf_dir, "model")
    SK.save_model(spark, nodes.filter("tree_id < 3"), {"offset": 0.0}, root)
    SK.save_model(spark, nodes, metrics, root)
    back, again = SK.load_model_tables(spark, root)
    changed = nodes.exceptAll(back).union(back.exceptAll(nodes)).agg(F.count(F.lit(1)).alias("changed_nodes"))
    return (back.agg(F.countDistinct("tree_id").alias("n_trees")).crossJoin(F.broadcast(changed))
            .withColumn("same_metrics", F.lit(again == metrics)))


# Two trees over kWh, voltage and power factor; psi 8, so c(psi) is as below.
_LITERAL_PSI = 8
_LITERAL_NODES = [  # tree, node, feature, threshold, left, right, rows, path length
    (0, 0, 0, 5.0, 1, 2, 8, 0.0), (0, 1, -1, 0.0, -1, -1, 3, 2.0), (0, 2, 1, 220.0, 3, 4, 5, 1.0),
    (0, 3, -1, 0.0, -1, -1, 1, 2.0), (0, 4, -1, 0.0, -1, -1, 4, 3.5),
    (1, 0, 3, 0.5, 1, 2, 8, 0.0), (1, 1, 4, 20.0, 3, 4, 6, 1.0), (1, 2, -1, 0.0, -1, -1, 2, 2.0),
    (1, 3, -1, 0.0, -1, -1, 5, 4.25), (1, 4, -1, 0.0, -1, -1, 1, 2.0)]
_LITERAL_OFFSET = -0.45
_LITERAL_SQL = f"""
scored AS (
  SELECT meter_id, reading_timestamp, -pow(2, -((CASE WHEN kwh_consumed < 5 THEN 2 WHEN voltage < 220 THEN 2 ELSE 3.5 END)
         + (CASE WHEN power_factor >= 0.5 THEN 2 WHEN reactive_power_kvar < 20 THEN 4.25 ELSE 2 END)) / 2
         / {float(FO.average_path_length([_LITERAL_PSI])[0])!r}) AS anomaly_score
  FROM feats WHERE {_NOT_NULL_FEATS})
"""


def _literal_scores(spark, sf_dir):
    nodes = spark.createDataFrame(_LITERAL_NODES, FO.FOREST_NODE_SCHEMA)
    feats = FE.impute_features(_train_features(spark, sf_dir))
    return FO.score_readings(spark, feats, FO.load_model(nodes, _LITERAL_PSI, 2)).select(
        "meter_id", "reading_timestamp", "anomaly_score")


@register("score_readings", r6(with_ctes("SELECT * FROM scored", _TRAIN_STATS, _LITERAL_SQL), ["anomaly_score"]))
def q_score_readings(spark, sf_dir):
    return round_doubles(_literal_scores(spark, sf_dir))


@register("forest_score", r6(recursive_ctes(
    f"""SELECT *, anomaly_score - ({_LITERAL_OFFSET}) AS anomaly_decision, anomaly_score - ({_LITERAL_OFFSET}) < 0 AS is_anomaly,
               CASE WHEN anomaly_score - ({_LITERAL_OFFSET}) < {D.OFFSET_SEVERITY_CUTS[0]} THEN 'HIGH'
                    WHEN anomaly_score - ({_LITERAL_OFFSET}) < {D.OFFSET_SEVERITY_CUTS[1]} THEN 'MEDIUM'
                    WHEN anomaly_score - ({_LITERAL_OFFSET}) < 0 THEN 'LOW' ELSE 'NORMAL' END AS anomaly_severity
        FROM train_scores""", _TRAIN_STATS, _SAMPLE_SQL, _FOREST_SQL, _TRAIN_SCORES), ["anomaly_score", "anomaly_decision"]))
def q_forest_score(spark, sf_dir):
    """Every training row by the trained forest, flagged at a fixed offset."""
    nodes, metrics = _saved_model(spark, sf_dir)
    model = FO.load_model(nodes, int(metrics["max_samples"]), int(metrics["n_trees"]))
    scored = FO.score_readings(spark, FE.impute_features(_train_features(spark, sf_dir)), model)
    return round_doubles(S.flag_and_grade(scored.select("meter_id", "reading_timestamp", "anomaly_score"),
                                          mode="offset", offset=_LITERAL_OFFSET))


_METRICS_SQL = r6(recursive_ctes(
    f"""SELECT CAST({_LAST} + 1 AS VARCHAR) AS train_date, CAST({_LAST} - {_FIRST} + 1 AS INTEGER) AS lookback_days,
               count(*) AS n_train_samples, CAST({_WIDTH} AS INTEGER) AS feature_count,
               avg(anomaly_score) AS anomaly_score_mean, stddev_pop(anomaly_score) AS anomaly_score_std,
               CAST({D.ANOMALY_THRESHOLD} AS DOUBLE) AS anomaly_score_threshold,
               CAST({S.CONTAMINATION} AS DOUBLE) AS contamination,
               quantile_cont(anomaly_score, {S.CONTAMINATION}) AS "offset", CAST({_PSI} AS INTEGER) AS max_samples,
               CAST({FO.N_TREES} AS INTEGER) AS n_trees
        FROM train_scores""", _TRAIN_STATS, _SAMPLE_SQL, _FOREST_SQL, _TRAIN_SCORES),
    ["anomaly_score_mean", "anomaly_score_std", "anomaly_score_threshold", "contamination", '"offset"'])


def _sql_metrics(metrics: DataFrame) -> DataFrame:
    """The metrics without the free-text note."""
    return round_doubles(metrics.drop("note"))


@register("training_metrics", _METRICS_SQL)
def q_training_metrics(spark, sf_dir):
    return _sql_metrics(J.training_metrics_frame(spark, _saved_model(spark, sf_dir)[1]))


# --------------------------------------------------------------------------
# Composed jobs
# --------------------------------------------------------------------------
@register("process_day", with_ctes(
    f"""SELECT q.reading_date AS process_date, raw_count AS raw_rows, clean_count AS clean_rows,
               dropped_pct AS drop_pct, {_STATUS},
               coalesce(n.null_kwh_consumed, 0) AS null_kwh_consumed,
               coalesce(n.null_voltage, 0) AS null_voltage,
               coalesce(n.null_meter_id, 0) AS null_meter_id
        FROM ({QUALITY_SQL}) q
        LEFT JOIN (SELECT reading_date,
                          count(*) FILTER (WHERE kwh_consumed IS NULL) AS null_kwh_consumed,
                          count(*) FILTER (WHERE voltage IS NULL) AS null_voltage,
                          count(*) FILTER (WHERE meter_id IS NULL) AS null_meter_id
                   FROM clean GROUP BY reading_date) n ON n.reading_date = q.reading_date"""))
def q_process_day(spark, sf_dir):
    out = _run_dir(spark, sf_dir, "p1")
    return J.process_days(spark, fixtures.raw_layout(spark, sf_dir), out, *_days(spark, sf_dir),
                          lookback_days=1, enforce=False, as_of=fixtures.FIXTURE_AS_OF, ts_type=TS)


@register("train_model", _METRICS_SQL)
def q_train_model(spark, sf_dir):
    out = _run_dir(spark, sf_dir, "p2")
    return _sql_metrics(J.train_model(spark, fixtures.processed_layout(spark, sf_dir), out,
                                      *fixtures.training_window(spark, sf_dir), TS))


@register("score_day", recursive_ctes(
    f"""SELECT {_FIRST} AS process_date, count(*) AS total_scored,
               count(*) FILTER (WHERE anomaly_score < (SELECT quantile_cont(anomaly_score, {S.CONTAMINATION}) FROM train_scores))
                 AS total_anomalies
        FROM day_scores""", _TRAIN_STATS, _SAMPLE_SQL, _FOREST_SQL, _TRAIN_SCORES,
    _forest_scores("day_scores", "SELECT * FROM feats")))
def q_score_day(spark, sf_dir):
    out = _run_dir(spark, sf_dir, "p3")
    return J.score_days(spark, fixtures.processed_layout(spark, sf_dir),
                        fixtures.model_layout(spark, sf_dir), out, *_days(spark, sf_dir),
                        history_days=0, as_of=fixtures.FIXTURE_AS_OF, ts_type=TS).select(
                            "process_date", "total_scored", "total_anomalies")


@register("validate_day", r6(with_ctes(
    f"""SELECT h.reading_date, h.row_count, h.duplicate_keys, r.total, r.anomalies,
               r.anomaly_rate_pct, coalesce(r.anomaly_rate_pct > 5.0, false) AS alert
        FROM (SELECT reading_date, count(*) AS row_count,
                     count(*) - count(DISTINCT (meter_id, reading_hour)) AS duplicate_keys
              FROM ({HOURLY_SQL}) x GROUP BY reading_date) h
        LEFT JOIN ({RATE_SQL}) r ON r.scoring_date = h.reading_date""", GIVEN_SCORED_CTE),
    ["anomaly_rate_pct"]))
def q_validate_day(spark, sf_dir):
    out = _run_dir(spark, sf_dir, "p4")
    SK.write_hourly(R.hourly_rollup(C.clean_readings(_raw(spark, sf_dir))), f"{out}/hourly")
    g = _given_scored(spark, sf_dir).withColumn("scored_at", F.lit(fixtures.FIXTURE_AS_OF).cast("timestamp"))
    SK.write_scored(g, f"{out}/anomaly_scores")
    return round_doubles(J.validate_days(spark, out, f"{out}/warehouse", *_days(spark, sf_dir),
                                         enforce=False, ts_type=TS))


# --------------------------------------------------------------------------
# Processing stamp and the native replacement of the
# reference's struct-returning pandas UDF
# --------------------------------------------------------------------------
@register("stamp_processing_time", with_ctes(
    """SELECT meter_id, reading_timestamp, TIMESTAMP '2024-02-01 00:00:00' AS _processed_at
       FROM clean"""))
def q_stamp_processing_time(spark, sf_dir):
    c = C.clean_readings(_raw(spark, sf_dir), as_of=fixtures.FIXTURE_AS_OF)
    return c.select("meter_id", "reading_timestamp",
                    F.col("_processed_at").cast("timestamp_ntz").alias("_processed_at"))


_CYCLIC_SQL = """
  SELECT meter_id, reading_timestamp,
         sin(2 * pi() * hour(reading_timestamp) / 24) AS reading_hour_sin,
         cos(2 * pi() * hour(reading_timestamp) / 24) AS reading_hour_cos,
         sin(2 * pi() * (isodow(reading_timestamp) - 1) / 7) AS day_of_week_sin,
         cos(2 * pi() * (isodow(reading_timestamp) - 1) / 7) AS day_of_week_cos,
         CASE WHEN power_factor > 0 THEN kwh_consumed / power_factor END AS apparent_power_kva
  FROM raw"""
_CYCLIC_DOUBLES = ["reading_hour_sin", "reading_hour_cos", "day_of_week_sin",
                   "day_of_week_cos", "apparent_power_kva"]


def _cyclic_struct(df):
    h, d = D.reading_hour(), D.weekday()
    return F.struct(D.cyclic_sin(h, 24).alias("reading_hour_sin"),
                    D.cyclic_cos(h, 24).alias("reading_hour_cos"),
                    D.cyclic_sin(d, 7).alias("day_of_week_sin"),
                    D.cyclic_cos(d, 7).alias("day_of_week_cos"),
                    D.apparent_power().alias("apparent_power_kva"))


@register("cyclic_features_udf", r6(with_ctes(_CYCLIC_SQL), _CYCLIC_DOUBLES))
def q_cyclic_features_udf(spark, sf_dir):
    r = _raw(spark, sf_dir)
    return round_doubles(r.select("meter_id", "reading_timestamp",
                                  D.cyclic_sin(D.reading_hour(), 24).alias("reading_hour_sin"),
                                  D.cyclic_cos(D.reading_hour(), 24).alias("reading_hour_cos"),
                                  D.cyclic_sin(D.weekday(), 7).alias("day_of_week_sin"),
                                  D.cyclic_cos(D.weekday(), 7).alias("day_of_week_cos"),
                                  D.apparent_power().alias("apparent_power_kva")))


@register("unpack_struct", r6(with_ctes(_CYCLIC_SQL), _CYCLIC_DOUBLES))
def q_unpack_struct(spark, sf_dir):
    r = _raw(spark, sf_dir)
    return round_doubles(r.select("meter_id", "reading_timestamp", _cyclic_struct(r).alias("s"))
                         .select("meter_id", "reading_timestamp", "s.*"))


@register("sort_series", r6(with_ctes(
    """SELECT meter_id, reading_timestamp, kwh_consumed,
              CAST(row_number() OVER (PARTITION BY meter_id ORDER BY reading_timestamp)
                   AS INTEGER) AS series_pos
       FROM clean"""), ["kwh_consumed"]))
def q_sort_series(spark, sf_dir):
    c = C.clean_readings(_raw(spark, sf_dir)).select("meter_id", "reading_timestamp", "kwh_consumed")
    return round_doubles(WS.series_position_split(c, rows_per_task=ROWS_PER_TASK))
