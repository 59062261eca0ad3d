import datetime as dt

from pyspark.sql import functions as F

from gridlens.operators import clean as C
from gridlens.schemas import RAW_COLS, raw_schema as _fixed_schema
from pyspark.sql import types as T


def raw_schema():
    # nullable keys so the tests can feed rows the cleaning must drop
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in _fixed_schema().fields])

T0 = dt.datetime(2024, 1, 15, 0, 0, 0)


def _row(meter="M1", ts=T0, kwh=1.0, v=230.0, amps=1.0, pf=0.9, zone="Z1", ctype="RESIDENTIAL"):
    return (meter, ts, kwh, v, amps, pf, 0.1, 20.0, "ok", zone, ctype, 40.0, -74.0)


def _df(spark, rows):
    return spark.createDataFrame(rows, raw_schema())


def test_filters_boundaries(spark):
    rows = [
        _row(ts=T0 + dt.timedelta(minutes=i), v=v) for i, v in enumerate([89.99, 90.0, 280.0, 280.01])
    ] + [
        _row(ts=T0 + dt.timedelta(hours=1, minutes=i), pf=p) for i, p in enumerate([0.0, 1.0, 1.2, -0.1])
    ] + [
        _row(ts=T0 + dt.timedelta(hours=2, minutes=i), kwh=k)
        for i, k in enumerate([None, -1.0, 0.0, float("nan")])
    ] + [_row(meter=None), _row(ts=None)]
    out = C.clean_readings(_df(spark, rows)).collect()
    volts = sorted(r["voltage"] for r in out if r["reading_timestamp"].hour == 0)
    assert volts == [90.0, 280.0]
    pfs = sorted(r["power_factor"] for r in out if r["reading_timestamp"].hour == 1)
    assert pfs == [0.0, 1.0]
    kwhs = [r["kwh_consumed"] for r in out if r["reading_timestamp"].hour == 2]
    assert 0.0 in kwhs and any(k != k for k in kwhs) and len(kwhs) == 2  # NaN passes
    assert all(r["meter_id"] is not None and r["reading_timestamp"] is not None for r in out)


def test_dedup_is_deterministic(spark):
    rows = [_row(kwh=3.0), _row(kwh=2.0), _row(kwh=2.0, v=100.0), _row(kwh=2.0, v=100.0)]
    for n in (1, 3):
        df = _df(spark, rows).repartition(n)
        out = C.dedup_readings(df).collect()
        assert len(out) == 1
        assert (out[0]["kwh_consumed"], out[0]["voltage"]) == (2.0, 100.0)
    assert C.dedup_readings(_df(spark, rows)).columns == RAW_COLS


def test_derived_columns(spark):
    hours = [0, 6, 7, 16, 17, 21, 22, 23]
    rows = [_row(ts=T0 + dt.timedelta(hours=h), pf=(0.0 if h == 0 else 0.5), kwh=2.0) for h in hours]
    out = {r["reading_hour"]: r for r in C.clean_readings(_df(spark, rows)).collect()}
    assert [h for h in hours if out[h]["is_peak_hour"]] == [17, 21]
    assert [h for h in hours if out[h]["is_off_peak"]] == [0, 6]
    assert out[0]["apparent_power_kva"] is None  # pf 0 -> NULL, no division error
    assert out[7]["apparent_power_kva"] == 4.0
    assert out[7]["reading_date"] == dt.date(2024, 1, 15)


def test_as_of_stamp(spark):
    stamp = dt.datetime(2024, 2, 1)
    out = C.clean_readings(_df(spark, [_row()]), as_of=stamp).first()
    assert out["_processed_at"] == stamp


def test_fixture_counts(spark):
    from gridlens import fixtures
    raw = fixtures.readings(spark, "/root/testdata/sf0.01")
    assert raw.count() == 10742
    assert C.clean_readings(raw).count() == 9571
    assert C.clean_readings(raw).select("meter_id").distinct().count() == 19


def test_filters_reach_parquet(spark):
    from gridlens import fixtures
    from gridlens.sources import scans
    root = fixtures.raw_layout(spark, "/root/testdata/sf0.001")
    raw = scans.read_raw(spark, root, "2024-01-15", 1, ts_type=fixtures.FIXTURE_TS)
    df = C.clean_readings(raw)
    plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert "PushedFilters" in plan  # the days are chosen by their directories
    assert "GreaterThanOrEqual(voltage,90.0)" in plan
    assert "GreaterThanOrEqual(reading_timestamp" in plan
