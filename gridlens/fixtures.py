"""Readings derived from the driver's ``events`` table (FIXTURES.md s.2).

The reference ships no data, so every registered query derives meter
readings from ``events``: meter = user_id / 8, readings keep the event
timestamp, and fixed modular rules plant duplicates, nulls, out-of-range
values and outliers. The DataFrame below and ``ADAPTER_SQL`` are the same
rules, so DuckDB can check any operator on the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlens.schemas import RAW_COLS

# Fixed values of the adapter (FIXTURES.md): multipliers for kWh.
KWH_NORMAL = 0.0971317340953
KWH_OUTLIER = 2.0713173409531
# Step of the power factor: no round decimal, so that no mean of steps is a
# rounding tie of the comparison.
POWER_FACTOR_STEP = 0.0499137158371


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def readings_from_events(events: DataFrame, with_label: bool = True) -> DataFrame:
    """13 raw reading columns (+ ``is_true_anomaly``) from ``events``."""
    e = F.col("event_id")
    base = events.select(
        "event_id", "ts", "event_type", "value",
        F.floor(F.col("user_id") / F.lit(8.0)).cast("bigint").alias("m"))
    day = F.dayofmonth("ts")
    copies = base.filter(((day <= 10) & (e % 50 == 0))
                         | (day.between(11, 20) & (e % 5 == 0)))
    b = base.unionByName(copies)
    m, v = F.col("m"), F.col("value")
    out = b.select(
        F.concat(F.lit("M"), m.cast("string")).alias("meter_id"),
        F.col("ts").alias("reading_timestamp"),
        F.when(e % 101 == 0, F.lit(None).cast("double"))
         .when(e % 89 == 0, F.lit(-1.0))
         .when(e % 53 == 0, v * F.lit(KWH_OUTLIER))
         .otherwise(v * F.lit(KWH_NORMAL)).alias("kwh_consumed"),
        F.when(e % 97 == 0, F.lit(300.0))
         .otherwise((F.lit(200) + e % 41).cast("double")).alias("voltage"),
        F.when(e % 13 == 0, F.lit(None).cast("double"))
         .otherwise(v / F.lit(2.0)).alias("current_amps"),
        F.when(e % 83 == 0, F.lit(1.2))
         .otherwise((e % 21).cast("double") * F.lit(POWER_FACTOR_STEP)).alias("power_factor"),
        (v / F.lit(30.0)).alias("reactive_power_kvar"),
        (F.lit(10) + e % 25).cast("double").alias("temperature_celsius"),
        F.col("event_type").alias("meter_status"),
        F.when(m % 17 == 16, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("Z"), (m % 4).cast("string"))).alias("utility_zone"),
        F.when(m % 3 == 0, F.lit("RESIDENTIAL"))
         .when(m % 3 == 1, F.lit("COMMERCIAL"))
         .otherwise(F.lit("INDUSTRIAL")).alias("customer_type"),
        (F.lit(40.0) + m.cast("double") / F.lit(100.0)).alias("lat"),
        (F.lit(-74.0) - m.cast("double") / F.lit(100.0)).alias("lon"),
        F.when(e % 53 == 0, F.lit(1)).otherwise(F.lit(0)).alias("is_true_anomaly"),
    )
    return out if with_label else out.select(*RAW_COLS)


def readings(spark: SparkSession, sf_dir: str, with_label: bool = False) -> DataFrame:
    return readings_from_events(load_table(spark, sf_dir, "events"), with_label)


def given_scores(df: DataFrame, score_col: str = "anomaly_score") -> DataFrame:
    """Deterministic stand-in scores (FIXTURES.md s.3) for checking the
    post-scoring operators without a model: -0.05 - frac(kwh) * 0.45."""
    k = F.col("kwh_consumed")
    return df.withColumn(score_col, F.lit(-0.05) - (k - F.floor(k)) * F.lit(0.45))


def misplaced_day(ts="reading_timestamp"):
    """Directory date of a reading in the raw-layout fixture: rows whose
    minute is a multiple of 20 land one day early."""
    t = F.col(ts)
    d = F.to_date(t)
    return F.when(F.minute(t) % 20 == 0, F.date_sub(d, 1)).otherwise(d)


# The adapter as SQL text; runs unchanged in Spark SQL and DuckDB.
ADAPTER_SQL = """
WITH b AS (
  SELECT event_id, ts, event_type, value, CAST(floor(user_id / 8.0) AS BIGINT) AS m FROM events
  UNION ALL
  SELECT event_id, ts, event_type, value, CAST(floor(user_id / 8.0) AS BIGINT) AS m FROM events
  WHERE (day(ts) <= 10 AND event_id % 50 = 0) OR (day(ts) BETWEEN 11 AND 20 AND event_id % 5 = 0)
)
SELECT concat('M', CAST(m AS VARCHAR(20))) AS meter_id,
       ts AS reading_timestamp,
       CASE WHEN event_id % 101 = 0 THEN NULL
            WHEN event_id % 89 = 0 THEN -1.0E0
            WHEN event_id % 53 = 0 THEN value * 2.0713173409531E0
            ELSE value * 0.0971317340953E0 END AS kwh_consumed,
       CASE WHEN event_id % 97 = 0 THEN 300.0E0 ELSE CAST(200 + event_id % 41 AS DOUBLE) END AS voltage,
       CASE WHEN event_id % 13 = 0 THEN NULL ELSE value / 2.0E0 END AS current_amps,
       CASE WHEN event_id % 83 = 0 THEN 1.2E0 ELSE CAST(event_id % 21 AS DOUBLE) * 0.0499137158371E0 END AS power_factor,
       value / 30.0E0 AS reactive_power_kvar,
       CAST(10 + event_id % 25 AS DOUBLE) AS temperature_celsius,
       event_type AS meter_status,
       CASE WHEN m % 17 = 16 THEN NULL ELSE concat('Z', CAST(m % 4 AS VARCHAR(20))) END AS utility_zone,
       CASE m % 3 WHEN 0 THEN 'RESIDENTIAL' WHEN 1 THEN 'COMMERCIAL' ELSE 'INDUSTRIAL' END AS customer_type,
       40.0E0 + CAST(m AS DOUBLE) / 100.0E0 AS lat,
       -74.0E0 - CAST(m AS DOUBLE) / 100.0E0 AS lon,
       CASE WHEN event_id % 53 = 0 THEN 1 ELSE 0 END AS is_true_anomaly
FROM b
"""


# --------------------------------------------------------------------------
# Derived fixture layouts, materialised once in the session's shared folder
# --------------------------------------------------------------------------
import datetime as _dt  # noqa: E402
import hashlib  # noqa: E402

from pyspark.sql import types as _T  # noqa: E402

FIXTURE_TS = _T.TimestampNTZType()
FIXTURE_AS_OF = _dt.datetime(2024, 2, 1, 0, 0, 0)


def _tag(sf_dir: str) -> str:
    return hashlib.sha1(sf_dir.rstrip("/").encode()).hexdigest()[:12]


def fixture_days(spark: SparkSession, sf_dir: str) -> tuple[_dt.date, _dt.date]:
    """First and last day of the ``events`` table."""
    d = load_table(spark, sf_dir, "events").agg(F.to_date(F.min("ts")).alias("a"), F.to_date(F.max("ts")).alias("b")).first()
    return d["a"], d["b"]


def fixture_root(spark: SparkSession, sf_dir: str, *parts: str) -> str:
    from gridlens.session import table_path
    return table_path(spark, "fixtures", _tag(sf_dir), *parts)


def raw_layout(spark: SparkSession, sf_dir: str) -> str:
    """Adapter rows under ``year=/month=/day=`` of their directory date
    (FIXTURES.md s.3: every reading with minute % 20 = 0 one day early)."""
    from gridlens.session import is_done, mark_done
    from gridlens.sources.days import with_day_parts
    from gridlens.sources.sinks import write_clustered
    root = fixture_root(spark, sf_dir, "raw_readings")
    if not is_done(spark, root):
        d = with_day_parts(readings(spark, sf_dir).withColumn("_dir", misplaced_day()), "_dir").drop("_dir")
        write_clustered(d, root, ["year", "month", "day"])
        mark_done(spark, root)
    return root


def processed_layout(spark: SparkSession, sf_dir: str) -> str:
    """P1 over every fixture day (gate reported, not enforced)."""
    from gridlens.plans import jobs
    from gridlens.session import is_done, mark_done
    root = fixture_root(spark, sf_dir, "processed")
    if not is_done(spark, root):
        jobs.process_days(spark, raw_layout(spark, sf_dir), root, *fixture_days(spark, sf_dir),
                           lookback_days=1, enforce=False,
                           as_of=FIXTURE_AS_OF, ts_type=FIXTURE_TS)
        mark_done(spark, root)
    return root


def training_window(spark: SparkSession, sf_dir: str) -> tuple[_dt.date, int]:
    """Process date and lookback whose training window is the whole fixture."""
    first, last = fixture_days(spark, sf_dir)
    return last + _dt.timedelta(days=1), (last - first).days + 1


def model_layout(spark: SparkSession, sf_dir: str) -> str:
    """P2 for the day after the fixture's last, over all its days."""
    from gridlens.plans import jobs
    from gridlens.session import is_done, mark_done
    root = fixture_root(spark, sf_dir, "model")
    if not is_done(spark, root):
        jobs.train_model(spark, processed_layout(spark, sf_dir), root, *training_window(spark, sf_dir), FIXTURE_TS)
        mark_done(spark, root)
    return root


def train_features_layout(spark: SparkSession, sf_dir: str) -> str:
    """Model features of the 30-day training window (S5 -> D17 -> F7),
    written once so the model queries do not rebuild them."""
    from gridlens.operators import clean, features
    from gridlens.schemas import FEATURE_COLS
    from gridlens.session import is_done, mark_done
    from gridlens.sources import scans
    root = fixture_root(spark, sf_dir, "train_features")
    if not is_done(spark, root):
        w = scans.scan_training_window(spark, f"{processed_layout(spark, sf_dir)}/readings",
                                       *training_window(spark, sf_dir), FIXTURE_TS)
        f = clean.drop_null_features(features.engineer_features(w))
        f.select("meter_id", "reading_timestamp", *FEATURE_COLS).write.mode("overwrite").parquet(root)
        mark_done(spark, root)
    return root
