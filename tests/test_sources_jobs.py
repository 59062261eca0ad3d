import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridlens import fixtures
from gridlens.operators import quality as Q
from gridlens.plans import jobs as J
from gridlens.schemas import HOURLY_SCHEMA
from gridlens.session import table_path
from gridlens.sources import scans, sinks

SF = "/root/testdata/sf0.001"
TS = fixtures.FIXTURE_TS


def _day_rows(df, day):
    return df.filter(F.to_date("reading_timestamp") == F.lit(day).cast("date"))


def test_lookback_catches_misplaced_rows(spark):
    root = fixtures.raw_layout(spark, SF)
    want = _day_rows(fixtures.readings(spark, SF), "2024-01-15").count()
    got0 = scans.read_raw(spark, root, "2024-01-15", 0, ts_type=TS).count()
    got1 = scans.read_raw(spark, root, "2024-01-15", 1, ts_type=TS).count()
    assert got1 == want and got0 < want                      # minute % 20 rows sit a day early
    assert scans.scan_day_partitions(spark, root, "2024-01-15", 1, ts_type=TS) \
        .select("day").distinct().count() == 2


def test_missing_day_is_empty_not_error(spark):
    root = fixtures.raw_layout(spark, SF)
    assert scans.read_raw(spark, root, "2023-06-01", 0, ts_type=TS).count() == 0


def test_training_window_raises_without_data(spark):
    root = fixtures.processed_layout(spark, SF)
    with pytest.raises(ValueError):
        scans.scan_training_window(spark, f"{root}/readings", "2023-06-01", 30, TS)
    w = scans.scan_training_window(spark, f"{root}/readings", "2024-01-11", 10, TS)
    days = {r[0] for r in w.select("reading_date").distinct().collect()}
    assert days == {dt.date(2024, 1, d) for d in range(1, 11)}   # D itself excluded


def test_processed_layout_keeps_string_partitions(spark):
    root = fixtures.processed_layout(spark, SF)
    df = scans.scan_processed_day(spark, f"{root}/readings", "2024-01-21", TS)
    assert dict(df.dtypes)["utility_zone"] == "string"
    assert df.filter(F.col("utility_zone").isNull()).count() >= 0


def test_process_days_gate(spark):
    raw_root = fixtures.raw_layout(spark, fixtures_sf := "/root/testdata/sf0.01")
    out = table_path(spark, "test-p1")
    ok = J.process_days(spark, raw_root, out, "2024-01-25", lookback_days=1, ts_type=TS).first()
    assert ok["status"] == "OK" and ok["clean_rows"] > 0
    with pytest.raises(Q.QualityError):                       # days 11-20 drop > 10 %
        J.process_days(spark, raw_root, table_path(spark, "test-p1-fail"), "2024-01-15",
                       lookback_days=1, ts_type=TS)
    assert fixtures_sf


def test_load_is_idempotent_and_append_duplicates(spark):
    root = fixtures.processed_layout(spark, SF)
    wh = table_path(spark, "test-wh")
    for _ in range(2):
        t = sinks.load_table(spark, f"{root}/hourly", f"{wh}/h", HOURLY_SCHEMA, "reading_date",
                             "2024-01-20")
    one = sinks.load_table(spark, f"{root}/hourly", f"{wh}/h", HOURLY_SCHEMA, "reading_date",
                           "2024-01-21")
    assert {r[0] for r in one.select("reading_date").distinct().collect()} == {dt.date(2024, 1, 21)}
    table = sinks.table_of_days(spark, f"{wh}/h", HOURLY_SCHEMA, "reading_date")
    n20 = table.filter(F.col("reading_date") == F.lit("2024-01-20").cast("date")).count()
    src20 = sinks.table_of_days(spark, f"{root}/hourly", HOURLY_SCHEMA, "reading_date") \
        .filter(F.col("reading_date") == F.lit("2024-01-20").cast("date")).count()
    assert n20 == src20                                       # other day untouched, no doubles
    Q.duplicate_gate(Q.duplicate_keys(table))
    sinks.load_table(spark, f"{root}/hourly", f"{wh}/h", HOURLY_SCHEMA, "reading_date",
                     "2024-01-20", mode="append")
    again = sinks.table_of_days(spark, f"{wh}/h", HOURLY_SCHEMA, "reading_date")
    with pytest.raises(Q.QualityError):
        Q.duplicate_gate(Q.duplicate_keys(again))
    del t


def test_align_fills_missing_columns(spark):
    df = spark.createDataFrame([("M1",)], "meter_id string")
    out = sinks.align_to(df, HOURLY_SCHEMA)
    assert out.columns == HOURLY_SCHEMA.names and out.first()["total_kwh"] is None


def test_train_score_validate_chain(spark):
    processed = fixtures.processed_layout(spark, "/root/testdata/sf0.01")
    model_root = table_path(spark, "test-model")
    m = J.train_model(spark, processed, model_root, "2024-01-31", 30, TS).first()
    assert m["n_train_samples"] > 0 and m["feature_count"] == 13 and m["offset"] < -0.3
    nodes, metrics = sinks.load_model_tables(spark, model_root)
    assert nodes.count() > 0 and metrics["max_samples"] == 256
    out = table_path(spark, "test-out")
    s = J.score_days(spark, processed, model_root, out, "2024-01-25", history_days=7,
                     ts_type=TS).first()
    assert s["total_scored"] > 0 and s["anomaly_rate_pct"] < 5.0
    v = J.validate_days(spark, processed, table_path(spark, "test-wh2"), "2024-01-25",
                        ts_type=TS, scores_root=out).first()
    assert v["row_count"] > 0 and v["duplicate_keys"] == 0 and v["alert"] is False


def test_write_clustered_with_partition_count(spark):
    df = spark.createDataFrame([(i % 3, f"Z{i % 2}", float(i)) for i in range(60)],
                               "d int, zone string, v double")
    path = table_path(spark, "test-k1")
    sinks.write_clustered(df, path, ["d", "zone"], num_partitions=5)
    back = spark.read.parquet(path)
    assert back.count() == 60
    assert back.groupBy("d", "zone").count().count() == 6
    sinks.write_clustered(df.filter("d = 0"), path, ["d", "zone"])   # replaces all of it
    assert spark.read.parquet(path).count() == 20


def test_cli_process(spark, capsys):
    from gridlens.plans import cli
    raw_root = fixtures.raw_layout(spark, SF)
    out = table_path(spark, "test-cli")
    cli.main(["process", "--date", "2024-01-25", "--lookback-days", "1", "--no-gate",
              "--raw-root", raw_root, "--out-root", out])
    printed = capsys.readouterr().out
    assert '"process_date": "2024-01-25"' in printed


def test_run_concurrently_reraises(spark):
    ok = J.run_concurrently(lambda: spark.range(10).count(), lambda: 2)
    assert ok == [10, 2]
    with pytest.raises(ZeroDivisionError):
        J.run_concurrently(lambda: spark.range(3).count(), lambda: 1 / 0)


def test_empty_day_in_range_fails(spark):
    raw_root = fixtures.raw_layout(spark, SF)
    rep = J.process_days(spark, raw_root, table_path(spark, "test-p1-empty"), "2024-01-29",
                         "2024-02-02", lookback_days=0, enforce=False, ts_type=TS)
    by_day = {r["process_date"].isoformat(): r for r in rep.collect()}
    assert len(by_day) == 5
    assert by_day["2024-02-01"]["raw_rows"] == 0 and by_day["2024-02-01"]["status"] == "FAIL"
    with pytest.raises(Q.QualityError):
        J.process_days(spark, raw_root, table_path(spark, "test-p1-empty2"), "2024-02-01",
                       lookback_days=0, ts_type=TS)


def test_reference_scoring_flags_everything(spark):
    processed = fixtures.processed_layout(spark, "/root/testdata/sf0.01")
    model_root = fixtures.model_layout(spark, "/root/testdata/sf0.01")
    out = table_path(spark, "test-ref-score")
    s = J.score_days(spark, processed, model_root, out, "2024-01-25", history_days=0,
                     mode="raw", reference_scoring=True, ts_type=TS).first()
    assert s["total_scored"] > 0 and s["anomaly_rate_pct"] == 100.0    # SURVEY Q1
    with pytest.raises(Q.QualityError):
        J.validate_days(spark, processed, table_path(spark, "test-ref-wh"), "2024-01-25",
                        ts_type=TS, scores_root=out)


def test_cli_evaluate(spark, capsys):
    from gridlens.plans import cli
    from gridlens.schemas import FEATURE_COLS
    rows = spark.read.parquet(fixtures.train_features_layout(spark, "/root/testdata/sf0.01"))
    path = table_path(spark, "test-labelled")
    rows.select((F.col("kwh_z_score") > 4).cast("int").alias("is_true_anomaly"), *FEATURE_COLS).write.parquet(path)
    cli.main(["evaluate", "--model-root", fixtures.model_layout(spark, "/root/testdata/sf0.01"), "--labelled", path])
    assert '"precision"' in capsys.readouterr().out


def test_cli_train_score_validate(spark, capsys):
    from gridlens.plans import cli
    raw_root = fixtures.raw_layout(spark, "/root/testdata/sf0.01")
    out = table_path(spark, "test-cli-chain")
    cli.main(["process", "--date", "2024-01-21", "--end-date", "2024-01-30",
              "--lookback-days", "1", "--raw-root", raw_root, "--out-root", out])
    cli.main(["train", "--date", "2024-01-30", "--lookback-days", "9", "--out-root", out,
              "--model-root", f"{out}/model"])
    cli.main(["score", "--date", "2024-01-30", "--history-days", "7", "--out-root", out,
              "--model-root", f"{out}/model", "--scores-root", f"{out}/scores"])
    cli.main(["validate", "--date", "2024-01-30", "--out-root", out,
              "--scores-root", f"{out}/scores", "--warehouse-root", f"{out}/wh"])
    printed = capsys.readouterr().out
    assert '"n_train_samples"' in printed and '"total_scored"' in printed
    assert '"alert": false' in printed


def _cleaned(spark):
    from gridlens.operators import clean
    return clean.clean_readings(fixtures.readings(spark, SF))


def test_rerun_replaces_whole_days_and_leaves_others(spark):
    from gridlens.operators import rollup
    h = rollup.hourly_rollup(_cleaned(spark))
    root = table_path(spark, "test-rerun-hourly")
    sinks.write_hourly(h, root, "2024-01-24", "2024-01-26")
    other = sinks.read_days(spark, root, HOURLY_SCHEMA, "2024-01-26", "2024-01-26", sinks.date_dirs("reading_date")).count()
    day = h.filter(F.col("reading_date") == F.lit("2024-01-25").cast("date"))
    fewer = day.filter("utility_zone = 'Z1'")
    sinks.write_hourly(fewer, root, "2024-01-25")                    # zones gone in the re-run
    back = sinks.table_of_days(spark, root, HOURLY_SCHEMA, "reading_date")
    assert back.filter("reading_date = '2024-01-25'").count() == fewer.count() < day.count()
    assert back.filter("reading_date = '2024-01-26'").count() == other > 0
    sinks.write_hourly(day.limit(0), root, "2024-01-25")             # the day lost all rows
    back = sinks.table_of_days(spark, root, HOURLY_SCHEMA, "reading_date")
    assert back.filter("reading_date = '2024-01-25'").count() == 0
    assert back.filter("reading_date = '2024-01-26'").count() == other


def test_rerun_over_unpadded_folders(spark):
    clean = _cleaned(spark).filter(F.to_date("reading_timestamp") == F.lit("2024-01-05").cast("date"))
    root = table_path(spark, "test-unpadded")
    old = (clean.withColumn("year", F.lit(2024)).withColumn("month", F.lit(1)).withColumn("day", F.lit(5)))
    sinks.write_clustered(old, root, sinks.CLEAN_PARTS)              # month=1/day=5
    n = scans.scan_processed_day(spark, root, "2024-01-05", TS).count()
    assert n == clean.count() > 0
    sinks.write_clean_readings(clean, root)                          # month=01/day=05 takes its place
    assert scans.scan_processed_day(spark, root, "2024-01-05", TS).count() == n
    assert sinks.table_of_days(spark, root, scans.clean_read_schema(TS)).count() == n


def test_emptied_day_reaches_the_warehouse_gate(spark):
    from gridlens.operators import rollup
    h = rollup.hourly_rollup(_cleaned(spark))
    src, wh = table_path(spark, "test-emptied"), table_path(spark, "test-emptied-wh")
    sinks.write_hourly(h, f"{src}/hourly", "2024-01-25")
    J.validate_days(spark, src, wh, "2024-01-25", ts_type=TS)
    sinks.write_hourly(h.limit(0), f"{src}/hourly", "2024-01-25")
    with pytest.raises(Q.QualityError):
        J.validate_days(spark, src, wh, "2024-01-25", ts_type=TS)


def test_one_day_read_lists_that_day_alone(spark):
    root = fixtures.raw_layout(spark, SF)
    files = scans.scan_day_partitions(spark, root, "2024-01-15", ts_type=TS).inputFiles()
    assert files and all("/year=2024/month=01/day=15/" in f for f in files)
    processed = fixtures.processed_layout(spark, SF)
    files = scans.scan_processed_day(spark, f"{processed}/readings", "2024-01-25", TS).inputFiles()
    assert files and all("/month=01/day=25/" in f for f in files)


def test_failed_gate_changes_no_table(spark):
    raw_root, out = fixtures.raw_layout(spark, "/root/testdata/sf0.01"), table_path(spark, "test-gate-first")
    with pytest.raises(Q.QualityError):
        J.process_days(spark, raw_root, out, "2024-01-15", lookback_days=1, ts_type=TS)
    assert scans.scan_processed_day(spark, f"{out}/readings", "2024-01-15", TS).count() == 0


def test_training_without_the_daily_rollup(spark):
    processed = fixtures.processed_layout(spark, SF)
    root = table_path(spark, "test-no-daily")
    rows = scans.scan_processed_days(spark, f"{processed}/readings", "2024-01-21", "2024-01-30", TS)
    sinks.write_clean_readings(rows, f"{root}/readings")
    m = J.train_model(spark, root, f"{root}/model", "2024-01-31", 10, TS).first()
    assert m["n_train_samples"] > 0


def test_interrupted_save_keeps_the_old_model(spark):
    processed = fixtures.model_layout(spark, SF)
    nodes, metrics = sinks.load_model_tables(spark, processed)
    root = table_path(spark, "test-save")
    sinks.save_model(spark, nodes, metrics, root)
    nodes.limit(1).write.parquet(f"{root}/version-broken/nodes")     # a save that never got to its end
    back, again = sinks.load_model_tables(spark, root)
    assert back.count() == nodes.count() and again == metrics


def test_evaluate_job(spark):
    from gridlens.schemas import FEATURE_COLS
    model_root = fixtures.model_layout(spark, "/root/testdata/sf0.01")
    labels = fixtures.readings(spark, "/root/testdata/sf0.01", with_label=True).select(
        "meter_id", "reading_timestamp", "is_true_anomaly").dropDuplicates(["meter_id", "reading_timestamp"])
    rows = spark.read.parquet(fixtures.train_features_layout(spark, "/root/testdata/sf0.01")).join(
        labels, ["meter_id", "reading_timestamp"])
    r = J.evaluate_model(spark, model_root, rows.select("is_true_anomaly", *FEATURE_COLS)).first()
    assert r["n_val_samples"] == rows.count() and 0 < r["recall"] <= 1 and 0 < r["precision"] <= 1


def test_union_of_differing_days(spark):
    a = spark.createDataFrame([(1, "x")], "id int, old string")
    b = spark.createDataFrame([("y", 2)], "new string, id int")
    out = scans.union_days([a, b])
    assert out.columns == ["id", "old", "new"]
    assert sorted(map(tuple, out.collect())) == [(1, "x", None), (2, None, "y")]
    with pytest.raises(ValueError):
        scans.union_days([])


def test_jobs_ask_for_utc(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        with pytest.raises(RuntimeError):
            J.train_model(spark, "nowhere", "nowhere", "2024-01-31")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
