import datetime as dt

import pytest

from gridlens.operators import clean as C
from gridlens.operators import quality as Q
from gridlens.operators import rollup as R
from gridlens.schemas import raw_schema as _fixed_schema
from pyspark.sql import functions as F
from pyspark.sql import types as T


def raw_schema():
    # nullable keys so the tests can feed rows the cleaning must drop
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in _fixed_schema().fields])

T0 = dt.datetime(2024, 1, 15, 17, 0, 0)


def _row(meter="M1", ts=T0, kwh=1.0, zone="Z1"):
    return (meter, ts, kwh, 230.0, 1.0, 0.9, 0.1, 20.0, "ok", zone, "RESIDENTIAL", 40.0, -74.0)


def _clean(spark, rows):
    return C.clean_readings(spark.createDataFrame(rows, raw_schema()))


def test_hourly_one_row_std_and_null_zone(spark):
    rows = [_row(), _row(ts=T0 + dt.timedelta(minutes=5), kwh=3.0),
            _row(meter="M2", zone=None)]
    h = {r["meter_id"]: r for r in R.hourly_rollup(_clean(spark, rows)).collect()}
    assert h["M1"]["std_kwh"] == pytest.approx(2 ** 0.5)
    assert h["M1"]["reading_count"] == 2 and h["M1"]["peak_hour_readings"] == 2
    assert h["M2"]["std_kwh"] is None and h["M2"]["utility_zone"] is None


def test_daily_avg_is_mean_of_readings(spark):
    rows = [_row(), _row(ts=T0 + dt.timedelta(minutes=5), kwh=3.0),
            _row(ts=T0 - dt.timedelta(hours=12), kwh=8.0)]
    d = R.daily_rollup(_clean(spark, rows)).first()
    assert d["daily_kwh"] == 12.0 and d["avg_hourly_kwh"] == 4.0
    assert (d["peak_readings"], d["off_peak_readings"]) == (2, 1)


def _report(spark, raw_n, clean_n):
    df = spark.createDataFrame([(i,) for i in range(raw_n)], "x int")
    return Q.quality_report(df, df.limit(clean_n)).first()


def test_drop_pct_boundaries(spark):
    assert _report(spark, 100, 95)["status"] == "OK"        # exactly 5.0 -> OK
    assert _report(spark, 100, 94)["status"] == "WARN"
    assert _report(spark, 100, 90)["status"] == "WARN"      # exactly 10.0 -> not FAIL
    assert _report(spark, 100, 89)["status"] == "FAIL"
    assert _report(spark, 3, 2)["dropped_pct"] == 33.33


def test_gate_raises_and_empty_day(spark):
    df = spark.createDataFrame([(i,) for i in range(100)], "x int")
    Q.quality_gate(Q.quality_report(df, df.limit(90)))
    with pytest.raises(Q.QualityError):
        Q.quality_gate(Q.quality_report(df, df.limit(89)))
    empty = df.limit(0)
    rep = Q.quality_report(empty, empty).first()
    assert rep["dropped_pct"] == 100.0
    with pytest.raises(Q.QualityError):
        Q.quality_gate(Q.quality_report(empty, empty))


def test_fixture_status_by_day(spark):
    from gridlens import fixtures
    raw = fixtures.readings(spark, "/root/testdata/sf0.01")
    rep = {r["reading_date"].day: r["status"] for r in
           Q.quality_report(raw, C.clean_readings(raw), by="reading_date").collect()}
    assert {rep[d] for d in range(1, 11)} == {"WARN"}
    assert {rep[d] for d in range(11, 21)} == {"FAIL"}
    assert {rep[d] for d in range(21, 31)} == {"OK"}


def test_duplicate_keys_meter_in_two_zones(spark):
    rows = [_row(), _row(ts=T0 + dt.timedelta(minutes=1), zone="Z2"),
            _row(meter="M2")]
    h = R.hourly_rollup(_clean(spark, rows))
    assert Q.duplicate_keys(h, by=None).first()["duplicate_keys"] == 1
    with pytest.raises(Q.QualityError):
        Q.duplicate_gate(Q.duplicate_keys(h))


def test_anomaly_rate_gate(spark):
    def rates(total, flagged):
        rows = [(dt.date(2024, 1, 15), i < flagged) for i in range(total)]
        return Q.anomaly_rate(spark.createDataFrame(rows, "scoring_date date, is_anomaly boolean"))
    assert rates(100, 5).first()["anomaly_rate_pct"] == 5.0
    Q.anomaly_rate_gate(rates(100, 5))                      # 5.0 is not > 5.0
    with pytest.raises(Q.QualityError):
        Q.anomaly_rate_gate(rates(100, 6))
    null_rate = spark.createDataFrame([(None, 0, 0, None)],
                                      "scoring_date date, total long, anomalies long, anomaly_rate_pct double")
    assert Q.with_rate_alert(null_rate).first()["alert"] is False


def test_row_count_gate(spark):
    h = R.hourly_rollup(_clean(spark, [_row()]))
    counts = Q.load_row_count(h)
    Q.row_count_gate(counts)
    with pytest.raises(Q.QualityError):
        Q.row_count_gate(counts.withColumn("row_count", F.lit(0)))
