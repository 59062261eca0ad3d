"""Command line for the daily jobs (thin arguments over ``plans.jobs``).

    spark-submit -m gridlens.plans.cli process --date 2024-01-15 \\
        --raw-root s3://.../raw/meter_readings --out-root s3://.../processed
    ... train    --date 2024-01-15 --lookback-days 30 --out-root ... --model-root ...
    ... score    --date 2024-01-15 --out-root ... --model-root ... --scores-root ...
    ... validate --date 2024-01-15 --out-root ... --scores-root ... --warehouse-root ...
    ... evaluate --model-root ... --labelled s3://.../holdout

``--date`` defaults to today; ``--lookback-days`` to 0 for ``process``
and 30 for ``train``. Each command prints its one-row (or per-day)
summary as JSON lines.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from gridlens.plans import jobs
from gridlens.session import get_session


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="gridlens")
    sub = p.add_subparsers(dest="cmd", required=True)

    def common(sp):
        sp.add_argument("--date", default=dt.date.today().isoformat(), help="YYYY-MM-DD")
        sp.add_argument("--end-date", default=None, help="process a range up to this day")

    sp = sub.add_parser("process", help="P1: clean, gate, roll up, write")
    common(sp)
    sp.add_argument("--lookback-days", type=int, default=0)
    sp.add_argument("--raw-root", required=True)
    sp.add_argument("--out-root", required=True)
    sp.add_argument("--no-gate", action="store_true", help="report the gate, do not raise")

    sp = sub.add_parser("train", help="P2: fit the isolation forest")
    common(sp)
    sp.add_argument("--lookback-days", type=int, default=30)
    sp.add_argument("--out-root", required=True, help="root written by 'process'")
    sp.add_argument("--model-root", required=True)

    sp = sub.add_parser("score", help="P3: score cleaned readings")
    common(sp)
    sp.add_argument("--history-days", type=int, default=7)
    sp.add_argument("--mode", choices=["offset", "raw"], default="offset")
    sp.add_argument("--reference-scoring", action="store_true")
    sp.add_argument("--out-root", required=True, help="root written by 'process'")
    sp.add_argument("--model-root", required=True)
    sp.add_argument("--scores-root", required=True)

    sp = sub.add_parser("validate", help="P4: load tables and run the checks")
    common(sp)
    sp.add_argument("--out-root", required=True, help="root written by 'process'")
    sp.add_argument("--scores-root", required=True, help="root written by 'score'")
    sp.add_argument("--warehouse-root", required=True)
    sp.add_argument("--append", action="store_true", help="append instead of overwrite")

    sp = sub.add_parser("evaluate", help="precision, recall and F1 of a saved model on labelled rows")
    sp.add_argument("--model-root", required=True)
    sp.add_argument("--labelled", required=True, help="Parquet with the 13 features and is_true_anomaly")
    sp.add_argument("--mode", choices=["offset", "raw"], default="offset")
    return p


def main(argv=None) -> None:
    a = _parser().parse_args(argv)
    spark = get_session(f"gridlens-{a.cmd}")
    if a.cmd == "process":
        out = jobs.process_days(spark, a.raw_root, a.out_root, a.date, a.end_date,
                                a.lookback_days, enforce=not a.no_gate)
    elif a.cmd == "train":
        out = jobs.train_model(spark, a.out_root, a.model_root, a.date, a.lookback_days)
    elif a.cmd == "score":
        out = jobs.score_days(spark, a.out_root, a.model_root, a.scores_root, a.date,
                              a.end_date, a.history_days, a.mode, a.reference_scoring)
    elif a.cmd == "evaluate":
        out = jobs.evaluate_model(spark, a.model_root, spark.read.parquet(a.labelled), a.mode)
    else:
        out = jobs.validate_days(spark, a.out_root, a.warehouse_root, a.date, a.end_date,
                                 mode="append" if a.append else "overwrite",
                                 scores_root=a.scores_root)
    for row in out.toJSON().collect():  # one row per processed day
        print(json.dumps(json.loads(row)))


if __name__ == "__main__":
    main()
