"""Scalar derivations D1-D15 as native column expressions.

Each function returns a ``Column``; nothing here runs Python per row, so
all of it stays inside whole-stage codegen.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "PEAK_HOURS", "OFF_PEAK_HOURS", "ANOMALY_THRESHOLD", "SEVERITY_CUTS",
    "OFFSET_SEVERITY_CUTS", "Z_FLOOR", "col", "reading_hour", "reading_date",
    "is_peak_hour", "is_off_peak", "apparent_power", "weekday", "cyclic_sin",
    "cyclic_cos", "z_score", "z_score_floor", "impute_zero", "flag_anomaly",
    "severity", "bool_count", "day_range",
]

# Fixed values (must equal the reference's rules):
#   peak hours 17..21 inclusive, off-peak hours 0..6 inclusive,
#   anomaly threshold -0.15, severity cut-offs HIGH < -0.30, MEDIUM < -0.20,
#   LOW < threshold, otherwise NORMAL; z-score floor 1e-9 in scoring.
PEAK_HOURS = (17, 21)
OFF_PEAK_HOURS = (0, 6)
ANOMALY_THRESHOLD = -0.15
SEVERITY_CUTS = (-0.30, -0.20)
Z_FLOOR = 1e-9
# Cut-offs relative to the contamination offset (decision = score - offset);
# they keep the reference's spacing from its threshold.
OFFSET_SEVERITY_CUTS = (-0.15, -0.05)


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def reading_hour(ts="reading_timestamp") -> Column:
    """Hour of day 0-23 (session zone; UTC by default)."""
    return F.hour(col(ts))


def reading_date(ts="reading_timestamp") -> Column:
    """Calendar date of the reading."""
    return F.to_date(col(ts))


def _in_hours(hour, bounds) -> Column:
    return F.coalesce(col(hour).between(*bounds), F.lit(False))


def is_peak_hour(hour="reading_hour") -> Column:
    """D3: true for hours 17..21, false otherwise (also for a null hour)."""
    return _in_hours(hour, PEAK_HOURS)


def is_off_peak(hour="reading_hour") -> Column:
    """True for hours 0..6, false otherwise."""
    return _in_hours(hour, OFF_PEAK_HOURS)


def apparent_power(kwh="kwh_consumed", pf="power_factor") -> Column:
    """Kwh / power factor; NULL when the factor is 0 or NULL.

    The guard is required: ANSI mode raises on division by zero.
    """
    return F.when(col(pf) > 0, col(kwh) / col(pf))


def weekday(ts="reading_timestamp") -> Column:
    """Monday=0 .. Sunday=6 (``dayofweek`` would give Monday=2)."""
    return F.weekday(col(ts))


def cyclic_sin(x, period: float) -> Column:
    """sin(2*pi*x/period)."""
    return F.sin(F.lit(2.0 * math.pi) * col(x).cast("double") / F.lit(float(period)))


def cyclic_cos(x, period: float) -> Column:
    return F.cos(F.lit(2.0 * math.pi) * col(x).cast("double") / F.lit(float(period)))


def z_score(kwh="kwh_consumed", mean="rolling_7d_mean_kwh",
            std="rolling_7d_std_kwh") -> Column:
    """(kwh - mean) / std, a zero std divides by 1 instead."""
    s = col(std)
    return (col(kwh) - col(mean)) / F.when(s == 0, F.lit(1.0)).otherwise(s)


def z_score_floor(kwh="kwh_consumed", mean="rolling_7d_mean_kwh",
                  std="rolling_7d_std_kwh", floor: float = Z_FLOOR) -> Column:
    """Scoring variant, denominator greatest(std, 1e-9); a NULL std
    gives the floor (greatest skips NULLs)."""
    return (col(kwh) - col(mean)) / F.greatest(col(std), F.lit(float(floor)))


def impute_zero(c) -> Column:
    """NULL feature -> 0.0 (NaN stays NaN, as in the reference)."""
    return F.coalesce(col(c), F.lit(0.0))


def flag_anomaly(score="anomaly_score", threshold: float = ANOMALY_THRESHOLD) -> Column:
    """Strict ``score < threshold``; NULL score gives NULL."""
    return col(score) < F.lit(float(threshold))


def severity(score="anomaly_score", threshold: float = ANOMALY_THRESHOLD,
             cuts=SEVERITY_CUTS) -> Column:
    """HIGH / MEDIUM / LOW / NORMAL ladder, strict comparisons;
    a NULL score falls through to NORMAL."""
    high, medium = cuts
    s = col(score)
    return (F.when(s < F.lit(float(high)), F.lit("HIGH"))
            .when(s < F.lit(float(medium)), F.lit("MEDIUM"))
            .when(s < F.lit(float(threshold)), F.lit("LOW"))
            .otherwise(F.lit("NORMAL")))


def bool_count(flag) -> Column:
    """Number of true values, as sum of the flag cast to int."""
    return F.sum(col(flag).cast("int"))


def day_range(ts, first_day, end_day, ts_type: str = "timestamp") -> Column:
    """Half-open range ``first_day <= ts < end_day`` on day boundaries.

    Written as a range on the raw column (not ``to_date(ts) = d``) so the
    predicate reaches the Parquet reader as a pushed filter. ``ts_type``
    is the column's own type (``timestamp`` or ``timestamp_ntz``), so the
    literal is cast, never the column.
    """
    t = col(ts)
    lo = F.lit(f"{first_day} 00:00:00").cast(ts_type)
    hi = F.lit(f"{end_day} 00:00:00").cast(ts_type)
    return (t >= lo) & (t < hi)
