"""Files whose stored column types differ from the declared ones."""

import datetime as dt
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import types as T

from gridlens import schemas
from gridlens.plans import jobs as J
from gridlens.session import table_path
from gridlens.sources import scans
from gridlens.sources.days import date_dirs, read_days

DAY = "2024-01-15"
N = 20


def _columns(meter: str, n: int = N) -> dict:
    t0 = dt.datetime(2024, 1, 15)
    number = pa.array([0.5] * n, pa.float64())
    text = pa.array(["x"] * n)
    return {
        "meter_id": pa.array([meter] * n), "reading_timestamp": pa.array([t0 + dt.timedelta(minutes=60 * i) for i in range(n)], pa.timestamp("us")),
        "kwh_consumed": pa.array([1.25] * n), "voltage": pa.array([230.0] * n), "current_amps": number, "power_factor": number,
        "reactive_power_kvar": number, "temperature_celsius": number, "meter_status": text, "utility_zone": text,
        "customer_type": text, "lat": number, "lon": number}


def _write(root: str, name: str, cols: dict) -> str:
    folder = f"{root}/year=2024/month=01/day=15"
    os.makedirs(folder, exist_ok=True)
    pq.write_table(pa.table(cols), f"{folder}/{name}.parquet", coerce_timestamps=None)
    return f"{folder}/{name}.parquet"


@pytest.fixture
def drifted(tmp_path):
    """One file as declared, five that convert, four that do not."""
    root, n = f"{tmp_path}/raw", N
    _write(root, "clean", _columns("M0"))
    _write(root, "int-voltage", _columns("M1") | {"voltage": pa.array([231] * n, pa.int64())})
    _write(root, "narrow", _columns("M2") | {"kwh_consumed": pa.array([1.5] * n, pa.float32()),
                                             "voltage": pa.array([232] * n, pa.uint32())})
    _write(root, "meter-number", _columns("M3") | {"meter_id": pa.array([77] * n, pa.int32())})
    zoned = _columns("M4")
    _write(root, "zoned", zoned | {"reading_timestamp": zoned["reading_timestamp"].cast(pa.timestamp("ms", "UTC"))})
    short = _columns("M5") | {"extra": pa.array([True] * n), "lat": pa.nulls(n)}
    del short["lon"]
    _write(root, "absent", short)
    bad = {_write(root, "text-voltage", _columns("B1") | {"voltage": pa.array(["230 V"] * n)}): "voltage: string for double",
           _write(root, "date", _columns("B2") | {"reading_timestamp": pa.array([dt.date(2024, 1, 15)] * n)}): "reading_timestamp: date32",
           _write(root, "nested", _columns("B3") | {"lat": pa.array([{"a": 1.0}] * n)}): "lat: struct"}
    cut = f"{root}/year=2024/month=01/day=15/cut.parquet"
    with open(cut, "wb") as f:
        f.write(b"PAR1 no footer")
    return root, bad | {cut: "unreadable footer"}


NTZ = T.TimestampNTZType()


def test_drifted_files_are_read_or_quarantined(spark, drifted):
    root, bad = drifted
    rows, misfits = scans.read_raw_drifted(spark, root, DAY, ts_type=NTZ)
    assert [(f.name, f.dataType) for f in rows.schema] == [(f.name, f.dataType) for f in schemas.raw_schema(NTZ)]
    got = {r["meter_id"]: r for r in rows.collect()}
    assert rows.count() == 6 * N and set(got) == {"M0", "M1", "M2", "77", "M4", "M5"}
    assert (got["M1"]["voltage"], got["M2"]["voltage"], got["M2"]["kwh_consumed"]) == (231.0, 232.0, 1.5)
    assert {r["reading_timestamp"] for r in rows.where("meter_id = 'M4'").collect()} == \
        {r["reading_timestamp"] for r in rows.where("meter_id = 'M0'").collect()}
    assert got["M5"]["lat"] is None and got["M5"]["lon"] is None
    listed = {r["path"].removeprefix("file:"): (r["process_date"], r["reason"]) for r in misfits.collect()}
    assert set(listed) == set(bad)
    for path, reason in bad.items():
        assert listed[path][0] == dt.date(2024, 1, 15) and listed[path][1].startswith(reason)


def test_files_as_declared_keep_their_pushdown(spark, tmp_path):
    root = f"{tmp_path}/raw"
    _write(root, "a", _columns("M0"))
    _write(root, "b", _columns("M1"))
    scan = lambda df: [line.strip() for line in df.where("voltage > 90").select("meter_id", "voltage")._jdf.queryExecution()
                       .executedPlan().toString().split("\n") if "FileScan" in line]
    pushed = lambda lines: [line[line.index("PushedFilters"):] for line in lines]
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")  # whole filters in the plan's text
    try:
        drift = scan(scans.read_raw_drifted(spark, root, DAY, ts_type=NTZ)[0])
        plain = scan(scans.read_raw(spark, root, DAY, ts_type=NTZ))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert len(drift) == 1 and pushed(drift) == pushed(plain)
    assert "GreaterThan(voltage,90.0)" in drift[0]


def test_no_files_and_only_misfits(spark, tmp_path):
    rows, misfits = scans.read_raw_drifted(spark, f"{tmp_path}/none", DAY, ts_type=NTZ)
    assert rows.count() == 0 and misfits.count() == 0
    _write(f"{tmp_path}/raw", "bad", _columns("B") | {"lon": pa.array(["east"] * N)})
    rows, misfits = scans.read_raw_drifted(spark, f"{tmp_path}/raw", DAY, ts_type=NTZ)
    assert rows.count() == 0 and misfits.count() == 1


def test_a_day_with_drifted_files_is_processed(spark, drifted):
    root, bad = drifted
    out = table_path(spark, "test-drift")
    with pytest.raises(Exception):
        J.process_days(spark, root, out, DAY, ts_type=NTZ)
    done = J.process_days(spark, root, out, DAY, ts_type=NTZ, quarantine=True).first()
    assert (done["raw_rows"], done["clean_rows"], done["status"]) == (6 * N, 6 * N, "OK")
    schema = T.StructType.fromDDL("path string, reason string, process_date date")
    assert read_days(spark, f"{out}/quarantine", schema, DAY, DAY, date_dirs("process_date")).count() == len(bad)
