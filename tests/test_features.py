import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from gridlens import fixtures
from gridlens.operators import clean as C
from gridlens.operators import features as FE
from gridlens.operators import rolling as W
from gridlens.operators import rolling_split as RS
from gridlens.schemas import FEATURE_COLS


def _series(spark, kwhs, meter="M1"):
    t0 = dt.datetime(2024, 1, 1)  # a Monday
    rows = [(meter, t0 + dt.timedelta(hours=i), k, 0.5) for i, k in enumerate(kwhs)]
    return spark.createDataFrame(
        rows, "meter_id string, reading_timestamp timestamp, kwh_consumed double, power_factor double")


def test_rolling_train_and_score_frames(spark):
    df = _series(spark, [float(i) for i in range(200)])
    tr = {r["reading_timestamp"]: r for r in W.rolling_stats(df).collect()}
    sc = {r["reading_timestamp"]: r for r in W.rolling_stats(df, 169, False).collect()}
    first = min(tr)
    assert tr[first]["rolling_7d_std_kwh"] == 0.0          # one row -> 0 (training)
    assert sc[first]["rolling_7d_std_kwh"] is None         # kept NULL (scoring)
    last = max(tr)
    assert tr[last]["rolling_7d_mean_kwh"] == pytest.approx(sum(range(32, 200)) / 168)
    assert sc[last]["rolling_7d_mean_kwh"] == pytest.approx(sum(range(31, 200)) / 169)


def test_weekday_cyclic_and_z(spark):
    df = _series(spark, [2.0, 2.0, 5.0])
    f = FE.engineer_features(df).orderBy("reading_timestamp").collect()
    assert f[0]["day_of_week"] == 0                          # Monday = 0
    assert f[0]["reading_hour_sin"] == pytest.approx(0.0)
    assert f[0]["reading_hour_cos"] == pytest.approx(1.0)
    assert f[1]["kwh_z_score"] == 0.0                        # std 0 -> divide by 1
    assert f[2]["kwh_z_score"] == pytest.approx((5.0 - 3.0) / math.sqrt(3.0))
    s = FE.engineer_features(df, frame_rows=169, scoring_variant=True) \
        .orderBy("reading_timestamp").collect()
    assert s[0]["kwh_z_score"] == 0.0 and s[0]["rolling_7d_std_kwh"] is None
    assert s[1]["kwh_z_score"] == 0.0                        # 0 / 1e-9


def test_drop_null_features_drops_nan(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "kwh_consumed double")
    assert C.drop_null_features(df, ["kwh_consumed"]).count() == 1


def test_impute_zero_keeps_nan(spark):
    df = spark.createDataFrame([(None,), (float("nan"),)], "current_amps double")
    vals = [r[0] for r in FE.impute_features(df, ["current_amps"]).collect()]
    assert vals[0] == 0.0 and math.isnan(vals[1])


@pytest.mark.parametrize("rows_per_task", [60, 170, 500])
def test_split_path_equals_one_task_window(spark, rows_per_task):
    c = C.clean_readings(fixtures.readings(spark, "/root/testdata/sf0.001")) \
        .select("meter_id", "reading_timestamp", "kwh_consumed")
    for frame, keep_null in [(168, False), (169, True)]:
        a = W.rolling_stats(c, frame, not keep_null)
        b = RS.rolling_stats_split(c, frame, not keep_null, rows_per_task=rows_per_task)
        assert b.count() == a.count()
        assert a.exceptAll(b.select(*a.columns)).count() == 0


@pytest.mark.parametrize("most", [4, 64])
def test_split_path_makes_no_more_partitions_than_the_session(spark, monkeypatch, most):
    """The number of range partitions does not follow the rows; with many of
    them allowed, pieces are far shorter than a frame."""
    c = C.clean_readings(fixtures.readings(spark, "/root/testdata/sf0.001")) \
        .select("meter_id", "reading_timestamp", "kwh_consumed")
    made, ranged = [], RS._ranged
    monkeypatch.setattr(RS, "_ranged", lambda *args: made.append(ranged(*args)) or made[-1])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(most))
    try:
        b = RS.rolling_stats_split(c, 169, False, rows_per_task=10)
        assert W.rolling_stats(c, 169, False).exceptAll(b).count() == 0 and b.count() == c.count()
        p = RS.series_position_split(c, rows_per_task=10)
        assert W.series_position(c).exceptAll(p).count() == 0 and p.count() == c.count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(made) == 2 and all(most / 2 < m.rdd.getNumPartitions() <= most for m in made)


def test_feature_stats_population_std(spark):
    df = spark.createDataFrame([(1.0,), (3.0,)], "kwh_consumed double")
    st = FE.feature_stats(df, ["kwh_consumed"]).first()
    assert (st["mean"], st["std"]) == (2.0, 1.0)
    scaled = FE.scale_features(df, [st], ["kwh_consumed"]).collect()
    assert [r[0] for r in scaled] == [-1.0, 1.0]


def test_train_and_score_paths_agree(spark):
    c = C.clean_readings(fixtures.readings(spark, "/root/testdata/sf0.001"))
    a = FE.engineer_features(c).select("meter_id", "reading_timestamp", *FEATURE_COLS)
    b = FE.engineer_features(c, split_long_series=False).select(
        "meter_id", "reading_timestamp", *FEATURE_COLS)
    assert a.exceptAll(b).count() == 0


def test_split_path_mixed_hot_and_cold(spark):
    c = C.clean_readings(fixtures.readings(spark, "/root/testdata/sf0.01")) \
        .select("meter_id", "reading_timestamp", "kwh_consumed")
    hot = RS._hot_keys(c, "meter_id", 520)
    assert 0 < hot.count() < c.select("meter_id").distinct().count()
    a = W.rolling_stats(c)
    b = RS.rolling_stats_split(c, rows_per_task=520)
    assert b.count() == a.count() and a.exceptAll(b.select(*a.columns)).count() == 0


@pytest.mark.parametrize("frame", [1, 2, 7, 168])
def test_frames_at_a_large_level_equal_sql(spark, frame):
    """kWh of 1e9 plus small noise, runs of equal values, NULL, NaN and
    infinity in the series: mean and std at 6 places as DuckDB has them."""
    import duckdb
    import numpy as np
    rng = np.random.default_rng(3)
    kwhs = [1e9 + float(k) / 1024 for k in rng.integers(0, 2048, 400)]
    kwhs[100:300] = [1e9 + 0.5] * 200
    odd = [0.1] * 40 + [None] * 9 + [0.1] * 9 + [None, 3.0]
    df = _series(spark, kwhs).unionByName(_series(spark, odd, "M2"))
    con = duckdb.connect()
    con.register("t", df.select("meter_id", "reading_timestamp", "kwh_consumed").toArrow())
    over = (f"OVER (PARTITION BY meter_id ORDER BY reading_timestamp "
            f"ROWS BETWEEN {frame - 1} PRECEDING AND CURRENT ROW)")
    want = con.sql(f"SELECT meter_id, reading_timestamp::timestamp ts, avg(kwh_consumed) {over} m, "
                   f"stddev_samp(kwh_consumed) {over} s FROM t ORDER BY 1, 2").fetchall()
    got = W.rolling_stats(df, frame, False).orderBy("meter_id", "reading_timestamp").collect()
    assert len(got) == len(want) == 400 + len(odd)
    for g, (_, _, m, s) in zip(got, want):
        assert (g[W.MEAN_COL] is None) == (m is None) and (g[W.STD_COL] is None) == (s is None)
        assert m is None or g[W.MEAN_COL] == pytest.approx(m, abs=1e-6, rel=1e-15)
        assert s is None or g[W.STD_COL] == pytest.approx(s, abs=1e-6)
    if 1 < frame <= 168:
        flat = [g[W.STD_COL] for g in got[100 + frame - 1:300]]
        assert set(flat) == {0.0}


def test_frames_with_nan_and_infinity(spark):
    df = _series(spark, [1.0, 2.0, float("nan"), 3.0, 4.0, 5.0, float("inf"), float("inf"), 1.0, 2.0, 3.0])
    got = [(r[W.MEAN_COL], r[W.STD_COL]) for r in W.rolling_stats(df, 3, False).orderBy("reading_timestamp").collect()]
    assert all(math.isnan(m) and math.isnan(s) for m, s in got[2:5])
    assert got[5] == (4.0, 1.0)
    assert all(m == math.inf and math.isnan(s) for m, s in got[6:10])
    assert got[10] == (2.0, 1.0)


def test_frames_take_one_shuffle_and_no_sliding_sum(spark):
    plan = W.rolling_stats(_series(spark, [1.0, 2.0]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "RowFrame, -167, currentrow" not in plan
