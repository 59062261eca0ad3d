"""The daily jobs: process (P1), train (P2), score (P3), validate (P4) and
evaluate.

Each job is a function over DataFrames with thin arguments (dates, table
roots). What several actions use is written once as Parquet (the staged
readings, the training features) and read back column by column, so a lost
executor never forces the scan and dedup to rerun and every action sees the
same rows.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark import InheritableThread, StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlens.functions.derive import ANOMALY_THRESHOLD
from gridlens.operators import clean as C
from gridlens.operators import features as FE
from gridlens.operators import forest as FO
from gridlens.operators import quality as Q
from gridlens.operators import rollup as R
from gridlens.operators import scoring as S
from gridlens.schemas import (DAILY_SCHEMA, FEATURE_COLS, HOURLY_SCHEMA, SCORED_COLS,
                              scored_schema)
from gridlens.session import require_utc, table_path
from gridlens.sources import scans, sinks
from gridlens.sources.days import as_date as _d
from gridlens.sources.days import date_dirs, publish_together, read_days, with_day_parts, ymd_dirs


def run_concurrently(*actions) -> list:
    """Run Spark actions from parallel driver threads (Spark schedules
    concurrent jobs); re-raises the first failure after all finish."""
    results: list = [None] * len(actions)
    errors: list = [None] * len(actions)

    def runner(i, fn):
        try:
            results[i] = fn()
        except BaseException as exc:  # noqa: BLE001 - re-raised below
            errors[i] = exc

    threads = [InheritableThread(target=runner, args=(i, fn)) for i, fn in enumerate(actions)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    for e in errors:
        if e is not None:
            raise e
    return results


def meter_counts(spark: SparkSession, processed_root: str, readings: DataFrame, first_day, last_day) -> DataFrame:
    """Cleaned rows per meter over [first_day, last_day]: summed from P1's
    daily rollup (one row per meter-day); where no day of it is there,
    counted from the readings."""
    daily = read_days(spark, f"{processed_root}/daily", DAILY_SCHEMA, first_day, last_day, date_dirs("reading_date"))
    if not daily.inputFiles():
        return readings.groupBy("meter_id").agg(F.count(F.lit(1)).alias("_n"))
    return daily.groupBy("meter_id").agg(F.sum("total_readings").alias("_n"))


def process_days(spark: SparkSession, raw_root: str, out_root: str, first_day,
                 last_day=None, lookback_days: int = 0, enforce: bool = True,
                 as_of: dt.datetime | None = None, ts_type: T.DataType | None = None,
                 quarantine: bool = False) -> DataFrame:
    """Raw -> clean -> quality gate -> hourly, daily -> three writes.

    Processes one day (the reference) or a range of days in one job. The
    cleaned rows are written once, to a folder no reader opens; report and
    rollups read them back. After the gate passed and the rollups are written
    as well, one commit switches the days of all three tables; until then, and
    if anything fails, readers see the old days of all three. Rows staged for
    a switch that failed are kept. Returns one summary row per day: process_date, raw_rows,
    clean_rows, drop_pct, status (the quality status; with ``enforce`` a day
    above 10 % raises and no table changes) and the NULL counts of
    kwh_consumed, voltage and meter_id among the cleaned rows.

    With ``quarantine``, files whose column types drifted do not stop the job:
    those that convert are read, the others are listed in the table
    ``quarantine`` (``path, reason`` by process_date), which is switched with
    the other three (see ``sources.drift``).
    """
    require_utc(spark, ts_type)
    d0 = _d(first_day)
    d1 = _d(last_day) if last_day else d0
    misfits = None
    if quarantine:
        raw, misfits = scans.read_raw_drifted(spark, raw_root, d0, lookback_days, d1, ts_type)
    else:
        raw = scans.read_raw(spark, raw_root, d0, lookback_days, d1, ts_type)
    staged = [sinks.stage_days(with_day_parts(C.clean_readings(raw, as_of)), f"{out_root}/readings",
                               sinks.CLEAN_PARTS, ymd_dirs)]
    try:
        if misfits is not None:
            staged.append(sinks.stage_days(misfits, f"{out_root}/quarantine", ["process_date"], date_dirs("process_date")))
        cleaned = staged[0].rows(scans.clean_read_schema(ts_type), d0, d1).drop("year", "month", "day")
        # Every day of the range gets a row: a day without raw rows counts as
        # 100 % dropped (FAIL), as an empty single-day run does.
        days = spark.range(1).select(F.explode(F.sequence(F.lit(d0), F.lit(d1))).alias("reading_date"))
        nulls = ("kwh_consumed", "voltage", "meter_id")
        report = (days.join(Q.quality_report(raw, cleaned, by="reading_date", null_cols=nulls), "reading_date", "left")
                  .fillna(0, subset=["raw_count", "clean_count", *[f"null_{c}" for c in nulls]])
                  .withColumn("dropped_pct", F.coalesce(F.col("dropped_pct"), F.lit(100.0)))
                  .withColumn("status", F.coalesce(F.col("status"), F.lit("FAIL"))))
        rows = report.collect()  # one row per processed day
        report = spark.createDataFrame(rows, report.schema)
        if enforce:
            Q.quality_gate(report)
        # Two independent rollups of the same staged rows: submitted
        # together, so small or skewed stages of one overlap with the other.
        run_concurrently(
            lambda: staged.append(sinks.stage_hourly(R.hourly_rollup(cleaned), f"{out_root}/hourly")),
            lambda: staged.append(sinks.stage_daily(R.daily_rollup(cleaned), f"{out_root}/daily")))
    except BaseException:
        for s in staged:
            s.drop()
        raise
    publish_together(staged, d0, d1)
    return report.select(F.col("reading_date").alias("process_date"),
                         F.col("raw_count").alias("raw_rows"),
                         F.col("clean_count").alias("clean_rows"),
                         F.col("dropped_pct").alias("drop_pct"), "status",
                         "null_kwh_consumed", "null_voltage", "null_meter_id")


def train_model(spark: SparkSession, processed_root: str, model_root: str, process_date,
                lookback_days: int = 30, ts_type: T.DataType | None = None,
                split_long_series: bool = True) -> DataFrame:
    """Training window -> features -> drop incomplete rows -> forest
    -> training scores -> offset and metrics -> saved model.

    Returns the one-row metrics table (M5)."""
    require_utc(spark, ts_type)
    d = _d(process_date)
    window = scans.scan_training_window(spark, f"{processed_root}/readings", d,
                                        lookback_days, ts_type)
    counts = meter_counts(spark, processed_root, window, d - dt.timedelta(days=lookback_days),
                          d - dt.timedelta(days=1)) if split_long_series else None
    feats = C.drop_null_features(FE.engineer_features(
        window, split_long_series=split_long_series, meter_counts=counts)).select(
            "meter_id", "reading_timestamp", *FEATURE_COLS)
    path = table_path(spark, "runs", f"features-{uuid.uuid4().hex}")
    feats.write.parquet(path)
    feats = spark.read.schema(feats.schema).parquet(path)
    nodes, psi, n = FO.train(spark, feats)
    model = FO.load_model(nodes, psi, FO.N_TREES)
    # Reused by the stats and the quantile rounds only; a lost block is
    # rescored from the written features, not rescanned.
    train_scores = FO.score_readings(spark, feats, model).select("anomaly_score") \
        .persist(StorageLevel.MEMORY_AND_DISK)
    try:
        st = S.score_stats(train_scores).first().asDict()
        offset = S.contamination_offset(train_scores, persist=False)
    finally:
        train_scores.unpersist()
    metrics = {
        "train_date": d.isoformat(), "lookback_days": lookback_days,
        "n_train_samples": n, "feature_count": len(FEATURE_COLS),
        "anomaly_score_mean": st["score_mean"], "anomaly_score_std": st["score_std"],
        "anomaly_score_threshold": ANOMALY_THRESHOLD, "contamination": S.CONTAMINATION,
        "offset": offset, "max_samples": psi, "n_trees": FO.N_TREES,
        "note": "trained without labels; the evaluate job measures precision and recall on labelled rows",
    }
    sinks.save_model(spark, nodes, metrics, model_root)
    return training_metrics_frame(spark, metrics)


def training_metrics_frame(spark: SparkSession, m: dict) -> DataFrame:
    """M5 as a one-row DataFrame."""
    schema = ("train_date string, lookback_days int, n_train_samples bigint, feature_count int, "
              "anomaly_score_mean double, anomaly_score_std double, "
              "anomaly_score_threshold double, contamination double, offset double, "
              "max_samples int, n_trees int, note string")
    cols = [c.split()[0] for c in schema.split(", ")]
    return spark.createDataFrame([tuple(m[c] for c in cols)], schema)


def score_days(spark: SparkSession, processed_root: str, model_root: str, out_root: str,
               process_date, last_day=None, history_days: int = 7, mode: str = "offset",
               reference_scoring: bool = False, as_of: dt.datetime | None = None,
               ts_type: T.DataType | None = None, split_long_series: bool = True) -> DataFrame:
    """Saved model + cleaned day(s) -> features -> impute -> score ->
    flag/severity -> write; returns the A12 summary row.

    ``history_days`` earlier days are read so the rolling features of the
    scored day see their own past (the reference reads the day alone,
    ``history_days=0``). ``reference_scoring`` selects the reference's
    scoring-path features (169-row frame, z floor).
    """
    require_utc(spark, ts_type)
    d0 = _d(process_date)
    d1 = _d(last_day) if last_day else d0
    nodes, metrics = sinks.load_model_tables(spark, model_root)
    model = FO.load_model(nodes, int(metrics["max_samples"]), int(metrics["n_trees"]))
    days = scans.scan_processed_days(spark, f"{processed_root}/readings",
                                     d0 - dt.timedelta(days=history_days), d1, ts_type)
    kw = dict(frame_rows=169, scoring_variant=True) if reference_scoring else {}
    counts = meter_counts(spark, processed_root, days, d0 - dt.timedelta(days=history_days),
                          d1) if split_long_series else None
    feats = FE.engineer_features(days, split_long_series=split_long_series,
                                 meter_counts=counts, **kw)
    feats = feats.filter(F.col("reading_date").between(F.lit(str(d0)).cast("date"),
                                                        F.lit(str(d1)).cast("date")))
    feats = FE.impute_features(feats)
    scored = FO.score_readings(spark, feats, model)
    scored = S.flag_and_grade(scored, mode=mode, offset=metrics.get("offset"))
    stamp = F.lit(as_of).cast("timestamp") if as_of else F.current_timestamp()
    scored = scored.withColumn("scored_at", stamp).select(*SCORED_COLS)
    # The written table is the lineage cut: rows are scored once, during
    # the write, and the summary reads back only the days just written.
    path = sinks.write_scored(scored, f"{out_root}/anomaly_scores", d0, last_day)
    written = read_days(spark, path, scored_schema(ts_type), d0, d1, date_dirs("scoring_date"))
    return (S.scoring_summary(written).withColumn("process_date", F.lit(d0))
            .withColumn("output_path", F.lit(path)))


def evaluate_model(spark: SparkSession, model_root: str, labelled: DataFrame, mode: str = "offset") -> DataFrame:
    """Saved model + labelled rows (the 13 features and ``is_true_anomaly``)
    -> scores -> precision, recall, F1 (A11)."""
    nodes, metrics = sinks.load_model_tables(spark, model_root)
    model = FO.load_model(nodes, int(metrics["max_samples"]), int(metrics["n_trees"]))
    scored = FO.score_readings(spark, FE.impute_features(labelled), model)
    return S.evaluate_scores(S.flag_and_grade(scored, mode=mode, offset=metrics.get("offset")))


def validate_days(spark: SparkSession, out_root: str, warehouse_root: str, first_day,
                  last_day=None, mode: str = "overwrite", enforce: bool = True,
                  ts_type: T.DataType | None = None, scores_root: str | None = None) -> DataFrame:
    """Write, audit, publish. Hourly files (``out_root/hourly``, written by
    P1) and scored files (``scores_root/anomaly_scores``, written by P3;
    defaults to ``out_root``) are staged for the warehouse tables (K6, K7);
    row count (A6), duplicate meter-hours (A7) and anomaly rate (A8) per day
    are taken from the rows the tables would have, and with ``enforce`` the
    gates raise in that order. Both tables are switched by one commit after
    the gates passed: a day that fails leaves the warehouse as it was."""
    require_utc(spark, ts_type)
    d0 = _d(first_day)
    d1 = _d(last_day) if last_day else d0
    scores_root = scores_root or out_root
    append = mode == "append"
    loads = [(f"{out_root}/hourly", "hourly_readings", HOURLY_SCHEMA, "reading_date"),
             (f"{scores_root}/anomaly_scores", "anomaly_scores", scored_schema(ts_type), "scoring_date")]
    staged, after = [], []
    try:
        for src, table, schema, date_col in loads:
            new = sinks.stage_load(spark, src, f"{warehouse_root}/{table}", schema, date_col, d0, d1)
            staged.append(new)
            rows = new.rows(schema, d0, d1)
            if append:
                rows = read_days(spark, f"{warehouse_root}/{table}", schema, d0, d1, date_dirs(date_col)).unionByName(rows)
            after.append(rows)
        out = _audit(spark, *after, d0, d1)
        out = spark.createDataFrame(out.collect(), out.schema)  # one row per validated day
        if enforce:
            Q.row_count_gate(out)
            Q.duplicate_gate(out)
            Q.anomaly_rate_gate(out)
    except BaseException:
        for s in staged:
            s.drop()
        raise
    publish_together(staged, d0, d1, append)
    return out


def _audit(spark: SparkSession, hourly: DataFrame, scored: DataFrame, d0: dt.date, d1: dt.date) -> DataFrame:
    """Per day: row count, duplicate meter-hours, anomaly rate and its alert."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(d0), F.lit(d1))).alias("reading_date"))
    rates = Q.with_rate_alert(Q.anomaly_rate(scored)).withColumnRenamed("scoring_date", "reading_date")
    return (days.join(Q.load_row_count(hourly), "reading_date", "left")
            .join(Q.duplicate_keys(hourly), "reading_date", "left").join(rates, "reading_date", "left")
            .fillna(0, subset=["row_count", "duplicate_keys"])
            .withColumn("alert", F.coalesce(F.col("alert"), F.lit(False))))
