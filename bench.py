"""Benchmark of the headline operators on one scale factor.

Runs on ``local[$BENCH_CPUS]`` against ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) and prints one JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query is forced to completion with the ``noop`` sink (all columns
computed, nothing collected), after one warm-up job.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from gridlens import fixtures  # noqa: E402
from gridlens.operators import clean as C  # noqa: E402
from gridlens.operators import features as FE  # noqa: E402
from gridlens.operators import forest as FO  # noqa: E402
from gridlens.operators import quality as Q  # noqa: E402
from gridlens.operators import rolling_split as RS  # noqa: E402
from gridlens.operators import rollup as R  # noqa: E402
from gridlens.plans import jobs as J  # noqa: E402
from gridlens.schemas import FEATURE_COLS  # noqa: E402
from gridlens.session import get_session, table_path  # noqa: E402


def _noop(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session("gridlens-bench", master=f"local[{cpus}]",
                        shuffle_partitions=int(cpus) * 2,
                        extra={"spark.driver.memory": "16g"})
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    raw = fixtures.readings(spark, sf_dir)
    # Warm-up on the smallest fixture: JIT, shuffle service, Arrow workers.
    small = fixtures.readings(spark, "/root/testdata/sf0.001")
    _noop(R.hourly_rollup(C.clean_readings(small)))
    _noop(FE.engineer_features(C.clean_readings(small), split_long_series=False))
    wf = C.drop_null_features(FE.engineer_features(C.clean_readings(small))).select(
        "meter_id", "reading_timestamp", *FEATURE_COLS)
    ws, wpsi = FO.forest_sample(wf, n_trees=16)
    wm = FO.load_model(FO.forest_fit(ws, wpsi, n_trees=16), wpsi)
    _noop(FO.score_readings(spark, wf, wm))
    _noop(raw)

    timed("clean_readings", lambda: _noop(C.clean_readings(raw)))
    timed("hourly_rollup", lambda: _noop(R.hourly_rollup(C.clean_readings(raw))))
    timed("daily_rollup", lambda: _noop(R.daily_rollup(C.clean_readings(raw))))
    timed("quality_report", lambda: _noop(Q.quality_report(raw, C.clean_readings(raw),
                                                           by="reading_date")))
    timed("engineer_features", lambda: _noop(FE.engineer_features(C.clean_readings(raw))))

    # Skew: a third of the cleaned rows reassigned to one meter; with
    # 10,000 rows per task that meter runs through the range-partition +
    # halo path, the other meters through the ordinary window.
    hot_id = F.when(F.xxhash64("reading_timestamp") % 3 == 0, F.lit("MHOT")) \
        .otherwise(F.col("meter_id"))
    skewed = C.clean_readings(raw).withColumn("meter_id", hot_id) \
        .select("meter_id", "reading_timestamp", "kwh_consumed").checkpoint(eager=True)
    timed("rolling_hot_meter", lambda: _noop(RS.rolling_stats_split(skewed, rows_per_task=10_000)))

    feats = C.drop_null_features(FE.engineer_features(C.clean_readings(raw))).select(
        "meter_id", "reading_timestamp", *FEATURE_COLS).checkpoint(eager=True)

    def fit():
        sample, psi = FO.forest_sample(feats)
        return FO.forest_fit(sample, psi).checkpoint(eager=True), psi
    nodes, psi = timed("forest_fit", fit)
    model = FO.load_model(nodes, psi)
    timed("score_readings", lambda: _noop(FO.score_readings(spark, feats, model)))

    raw_root = timed("write_raw_layout", lambda: fixtures.raw_layout(spark, sf_dir))
    out = table_path(spark, "bench", re.sub(r"\W", "_", sf_dir))
    days, window = fixtures.fixture_days(spark, sf_dir), fixtures.training_window(spark, sf_dir)
    timed("process_days", lambda: J.process_days(
        spark, raw_root, out, *days, lookback_days=1, enforce=False,
        ts_type=fixtures.FIXTURE_TS).count())

    model_root = f"{out}/model"
    timed("train_model", lambda: J.train_model(
        spark, out, model_root, *window, fixtures.FIXTURE_TS).count())
    timed("score_days", lambda: J.score_days(
        spark, out, model_root, out, *days, history_days=0,
        ts_type=fixtures.FIXTURE_TS).count())

    total = round(sum(v for k, v in times.items() if k != "write_raw_layout"), 3)
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_sec", "value": total, "unit": "sec",
                      "queries": times, "sf": float(sf.group(1)) if sf else sf_dir,
                      "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
