"""Data-quality reports and gates.

Reports are DataFrames (one row per day, or one row without a grouping);
gates collect that bounded summary, never the data, and raise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Dropped share above 5 % warns, above 10 % fails; an
# anomaly rate above 5 % alerts.
WARN_DROP_PCT = 5.0
FAIL_DROP_PCT = 10.0
MAX_ANOMALY_RATE_PCT = 5.0


class QualityError(RuntimeError):
    """Raised by a gate."""


def _by(by) -> list[str]:
    if by is None:
        return []
    return [by] if isinstance(by, str) else list(by)


def _counts(df: DataFrame, by: list[str], name: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(name))


def drop_status(pct) -> F.Column:
    p = F.col(pct) if isinstance(pct, str) else pct
    return (F.when(p > F.lit(FAIL_DROP_PCT), F.lit("FAIL"))
            .when(p > F.lit(WARN_DROP_PCT), F.lit("WARN"))
            .otherwise(F.lit("OK")))


def quality_report(raw: DataFrame, clean: DataFrame, by: str | Sequence[str] | None = None,
                   day_col: str = "reading_date", null_cols: Sequence[str] = ()) -> DataFrame:
    """A3: raw and clean counts, dropped %, status.

    ``dropped_pct = round((1 - clean / max(raw, 1)) * 100, 2)``; status is
    WARN above 5 %, FAIL above 10 % (the reference raises there), else OK.
    With ``by`` (e.g. ``reading_date``) there is one row per group. Both
    inputs are tagged and stacked, then counted in one aggregate (partial
    aggregation, no join); a group present on one side only counts 0 on
    the other. ``raw`` gets ``day_col`` derived from its timestamp if absent.
    The NULLs of ``null_cols`` among the clean rows are counted in the same
    aggregate, as ``null_<column>``.
    """
    keys = _by(by)
    if day_col in keys and day_col not in raw.columns:
        raw = raw.withColumn(day_col, F.to_date("reading_timestamp"))
    nulls = [f"null_{c}" for c in null_cols]
    tagged = (raw.select(*keys, F.lit(1).alias("_raw"), *[F.lit(False).alias(n) for n in nulls])
                 .unionByName(clean.select(*keys, F.lit(0).alias("_raw"),
                                           *[F.col(c).isNull().alias(n) for c, n in zip(null_cols, nulls)])))
    rep = tagged.groupBy(*keys).agg(
        F.count_if(F.col("_raw") == 1).alias("raw_count"),
        F.count_if(F.col("_raw") == 0).alias("clean_count"),
        *[F.count_if(n).alias(n) for n in nulls])
    if not keys:  # an empty input still yields its one report row
        rep = rep.fillna(0, subset=["raw_count", "clean_count", *nulls])
    rep = rep.withColumn("dropped_pct", F.round(
        (F.lit(1.0) - F.col("clean_count") / F.greatest(F.col("raw_count"), F.lit(1)))
        * F.lit(100.0), 2))
    return rep.withColumn("status", drop_status("dropped_pct")).select(
        *keys, "raw_count", "clean_count", "dropped_pct", "status", *nulls)


def null_profile(df: DataFrame, cols: Sequence[str] = ("kwh_consumed", "voltage", "meter_id"),
                 by: str | Sequence[str] | None = None) -> DataFrame:
    """A4: NULL count per column, all columns in one pass."""
    keys = _by(by)
    return df.groupBy(*keys).agg(*[
        F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in cols])


def quality_gate(report: DataFrame, fail_pct: float = FAIL_DROP_PCT) -> list[dict]:
    """A5: raise if any report row dropped more than ``fail_pct`` percent.

    An empty raw day has raw_count 0 and so 100 % dropped: it fails too.
    Returns the report rows (bounded: one per day) when all pass.
    """
    rows = [r.asDict() for r in report.collect()]
    bad = [r for r in rows if r["dropped_pct"] is not None and r["dropped_pct"] > fail_pct]
    if bad:
        raise QualityError(f"cleaning removed {bad[0]['dropped_pct']} % of the raw rows in {len(bad)} group(s); "
                           f"at most {fail_pct} % may go")
    if not rows:
        raise QualityError("the quality report is empty: nothing was processed")
    return rows


def with_gate(report: DataFrame, fail_pct: float = FAIL_DROP_PCT) -> DataFrame:
    """A5 as a column: ``passed`` is false where the gate would raise."""
    return report.withColumn("passed", F.col("dropped_pct") <= F.lit(float(fail_pct)))


def load_row_count(table: DataFrame, date_col: str = "reading_date",
                   by_date: bool = True) -> DataFrame:
    """Rows per load date (or one total)."""
    return _counts(table, [date_col] if by_date else [], "row_count")


def row_count_gate(counts: DataFrame) -> None:
    """A6 gate over per-day counts (``reading_date, row_count``; bounded: one
    row per day): a day without loaded rows raises."""
    for r in counts.filter(F.col("row_count") == 0).collect():
        raise QualityError(f"the load of {r['reading_date']} brought no rows")


def duplicate_keys(table: DataFrame,
                   keys: Sequence[str] = ("meter_id", "reading_date", "reading_hour"),
                   by: str | Sequence[str] | None = "reading_date") -> DataFrame:
    """Number of key groups that occur more than once.

    Two partial aggregates: key counts, then the count of keys with
    count > 1 per ``by`` group (0 where there are none).
    """
    per_key = table.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.groupBy(*_by(by)).agg(
        F.count_if(F.col("_n") > 1).alias("duplicate_keys"))


def duplicate_gate(duplicates: DataFrame) -> None:
    """A7 gate over per-day counts (``reading_date, duplicate_keys``; bounded:
    one row per day): a meter-hour held more than once raises."""
    for r in duplicates.filter(F.col("duplicate_keys") > 0).collect():
        raise QualityError(f"{r['duplicate_keys']} meter-hours of {r['reading_date']} were loaded more than once")


def anomaly_rate(scored: DataFrame, by: str | Sequence[str] | None = "scoring_date",
                 flag: str = "is_anomaly") -> DataFrame:
    """Total, flagged and ``round(100 * flagged / nullif(total, 0), 2)``."""
    keys = _by(by)
    agg = scored.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total"),
        F.sum(F.when(F.col(flag), F.lit(1)).otherwise(F.lit(0))).alias("anomalies"))
    return agg.withColumn("anomaly_rate_pct", F.round(
        F.try_divide(F.lit(100.0) * F.col("anomalies"), F.nullif(F.col("total"), F.lit(0))), 2))


def with_rate_alert(rates: DataFrame, max_pct: float = MAX_ANOMALY_RATE_PCT) -> DataFrame:
    """A9 as a column: strict ``rate > 5.0``; a NULL rate does not alert."""
    return rates.withColumn("alert", F.coalesce(
        F.col("anomaly_rate_pct") > F.lit(float(max_pct)), F.lit(False)))


def anomaly_rate_gate(rates: DataFrame, max_pct: float = MAX_ANOMALY_RATE_PCT) -> list[dict]:
    """Raise when a rate exceeds ``max_pct`` (bounded rows: one per date)."""
    rows = [r.asDict() for r in with_rate_alert(rates, max_pct).collect()]
    hot = [r for r in rows if r["alert"]]
    if hot:
        r = hot[0]
        raise QualityError(f"{r['anomalies']} of {r['total']} readings are flagged "
                           f"({r['anomaly_rate_pct']} %); more than {max_pct} % asks for a look")
    return rows
