import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "total_kwh" in df.columns


def test_registry_keys(spark):
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs)
    for key in ["clean_readings", "hourly_rollup", "daily_rollup", "quality_report",
                "rolling_mean", "engineer_features", "forest_fit", "score_readings",
                "process_day", "validate_day"]:
        assert key in qs
