"""Switching days: all old or all new in every table, whatever fails."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridlens import fixtures
from gridlens.operators import clean as C
from gridlens.operators import quality as Q
from gridlens.operators import rollup as R
from gridlens.plans import jobs as J
from gridlens.schemas import DAILY_SCHEMA, HOURLY_SCHEMA, scored_schema
from gridlens.session import table_path
from gridlens.sources import days, scans, sinks

SF, TS, DAY = "/root/testdata/sf0.001", fixtures.FIXTURE_TS, "2024-01-15"


def _tables(spark, out):
    """Fingerprint of the day in readings, hourly and daily, by the job's readers."""
    by_date = sinks.date_dirs("reading_date")
    frames = (scans.scan_processed_day(spark, f"{out}/readings", DAY, TS).drop("_processed_at"),
              days.read_days(spark, f"{out}/hourly", HOURLY_SCHEMA, DAY, DAY, by_date),
              days.read_days(spark, f"{out}/daily", DAILY_SCHEMA, DAY, DAY, by_date))
    return [f.agg(F.count("*"), F.sum(F.xxhash64(*f.columns).cast("decimal(38,0)"))).first() for f in frames]


def _staged(spark, out):
    return {t: [n for n, _ in days.Folders(spark, f"{out}/{t}").names("_days")] for t in ("readings", "hourly", "daily")}


def _process(spark, raw, out, lookback):
    return J.process_days(spark, raw, out, DAY, lookback_days=lookback, enforce=False, ts_type=TS)


STEPS = ["stage_days", "stage_hourly", "stage_daily", "exists", "write_new", "switch", "killed after staging"]


@pytest.mark.parametrize("step", STEPS)
def test_a_failure_at_any_step_leaves_all_old_days(spark, monkeypatch, step):
    raw, out = fixtures.raw_layout(spark, SF), table_path(spark, f"test-steps-{step.replace(' ', '-')}")
    _process(spark, raw, out, 0)
    old, files = _tables(spark, out), _staged(spark, out)

    def fail(*_, **__):
        raise OSError("injected")

    with monkeypatch.context() as m:
        if step in ("stage_days", "stage_hourly", "stage_daily"):
            m.setattr(sinks, step, fail)
        elif step == "exists":
            publish = J.publish_together

            def failing(staged, *a):  # the first call to the file system while switching
                m.setattr(days.Folders, "exists", fail)
                return publish(staged, *a)
            m.setattr(J, "publish_together", failing)
        elif step == "write_new":
            m.setattr(days.Folders, "write_new", fail)
        elif step == "switch":
            m.setattr(days.CommitLog, "_switch", fail)
        else:  # the driver is gone: no handler runs
            m.setattr(J, "publish_together", fail)
        with pytest.raises(OSError, match="injected"):
            _process(spark, raw, out, 1)
    assert _tables(spark, out) == old
    kept = {t: len(v) - len(files[t]) for t, v in _staged(spark, out).items()}
    late = step in STEPS[3:]
    assert kept == dict.fromkeys(files, int(late))  # rows staged for a failed switch survive
    if late:  # and can be published by a second try, without reading the raw rows again
        found = []
        for t, dirs in (("readings", days.ymd_dirs), ("hourly", days.date_dirs("reading_date")), ("daily", days.date_dirs("reading_date"))):
            s = days.StagedDays(spark, f"{out}/{t}", dirs)
            s.name, = (f"_days/{n}" for n in set(_staged(spark, out)[t]) - set(files[t]))
            s.version = s.name.split("=")[1]
            found.append(s)
        days.publish_together(found, DAY, DAY)
    else:
        _process(spark, raw, out, 1)
    new, fresh = _tables(spark, out), table_path(spark, f"test-steps-fresh-{STEPS.index(step)}")
    _process(spark, raw, fresh, 1)
    assert new == _tables(spark, fresh) and all(a != b for a, b in zip(new, old))


def test_readers_hold_their_days_while_others_publish(spark):
    raw, out = fixtures.raw_layout(spark, SF), table_path(spark, "test-held")
    _process(spark, raw, out, 0)
    reader = scans.scan_processed_day(spark, f"{out}/readings", DAY, TS)
    n = reader.count()
    _process(spark, raw, out, 1)
    assert reader.count() == n < scans.scan_processed_day(spark, f"{out}/readings", DAY, TS).count()
    assert days.vacuum(spark, f"{out}/readings") == []               # young, and still named by a kept commit
    orphan = sinks.stage_days(reader.limit(1).withColumn("year", F.lit("2024")).withColumn("month", F.lit("01")).withColumn(
        "day", F.lit("15")), f"{out}/readings", sinks.CLEAN_PARTS, days.ymd_dirs)
    assert days.vacuum(spark, f"{out}/readings", older_than_hours=0) == [orphan.version]
    assert reader.count() == n


def test_two_writers_lose_no_commit(spark):
    log = days.CommitLog(spark, table_path(spark, "test-race"))
    first = log.commit(lambda t: t.setdefault("a", {}).update(d=["1"]))
    other = days.CommitLog(spark, table_path(spark, "test-race"))
    raced = []

    def change(tables):  # another writer takes the number between reading and switching
        if not raced:
            raced.append(other.commit(lambda t: t.setdefault("b", {}).update(d=["2"])))
        tables.setdefault("a", {}).update(d=["3"])

    last = log.commit(change)
    assert (first, raced, last) == (1, [2], 3)
    assert log.latest() == (3, {"a": {"d": ["3"]}, "b": {"d": ["2"]}})
    for i in range(log.KEPT + 5):
        log.commit(lambda t, i=i: t.setdefault("c", {}).update(d=[str(i)]))
    assert len(log._numbers()) == log.KEPT and log.latest()[1]["a"] == {"d": ["3"]}


def test_tables_of_several_databases_are_refused(spark):
    a, b = (days.StagedDays(spark, table_path(spark, f"test-db{i}", "t"), days.ymd_dirs) for i in (1, 2))
    with pytest.raises(ValueError):
        days.publish_together([a, b], DAY, DAY)


def test_plain_days_and_versions_are_read_together(spark):
    root = table_path(spark, "test-mixed", "hourly")
    h = R.hourly_rollup(C.clean_readings(fixtures.readings(spark, SF)))
    n = {r["reading_date"].isoformat(): r["count"] for r in h.groupBy("reading_date").count().collect()}
    sinks.write_clustered(h, root, sinks.HOURLY_PARTS)               # an older, plain layout of all days
    dirs = days.date_dirs("reading_date")
    sinks.write_hourly(h.filter("meter_id < 'M5'"), root, "2024-01-24", "2024-01-25")
    back = sinks.table_of_days(spark, root, HOURLY_SCHEMA, "reading_date")
    fewer = h.filter("meter_id < 'M5' and reading_date between '2024-01-24' and '2024-01-25'").count()
    assert back.count() == sum(n.values()) - n["2024-01-24"] - n["2024-01-25"] + fewer
    read = days.read_days(spark, root, HOURLY_SCHEMA, "2024-01-25", "2024-01-26", dirs)
    assert {r[0] for r in read.select("reading_date").distinct().collect()} <= {dt.date(2024, 1, 25), dt.date(2024, 1, 26)}
    # appending to a plain day keeps its rows
    sinks.write_clustered(h.filter("reading_date = '2024-01-26'"), src := table_path(spark, "test-mixed-src", "hourly"), sinks.HOURLY_PARTS)
    t = sinks.load_table(spark, src, root, HOURLY_SCHEMA, "reading_date", "2024-01-26", mode="append")
    assert t.count() == 2 * n["2024-01-26"]


def _warehouse(spark, wh):
    by = (("hourly_readings", HOURLY_SCHEMA, "reading_date"), ("anomaly_scores", scored_schema(TS), "scoring_date"))
    return [sorted(map(str, sinks.table_of_days(spark, f"{wh}/{t}", s, c).collect())) for t, s, c in by]


@pytest.mark.parametrize("gate", ["row count", "duplicates", "anomaly rate"])
def test_a_day_that_fails_a_gate_leaves_the_warehouse(spark, gate):
    processed = fixtures.processed_layout(spark, SF)
    out, wh = (table_path(spark, f"test-gate-{gate.replace(' ', '-')}", x) for x in ("out", "wh"))
    hourly = days.read_days(spark, f"{processed}/hourly", HOURLY_SCHEMA, DAY, DAY, sinks.date_dirs("reading_date"))
    rows = scans.scan_processed_day(spark, f"{processed}/readings", DAY, TS)
    scored = rows.select("*", F.lit(-0.1).alias("anomaly_score"), F.lit(False).alias("is_anomaly"),
                         F.lit("NORMAL").alias("anomaly_severity"), F.current_timestamp().alias("scored_at"))
    sinks.write_hourly(hourly, f"{out}/hourly", DAY)
    sinks.write_scored(scored, f"{out}/anomaly_scores", DAY)
    good = J.validate_days(spark, out, wh, DAY, ts_type=TS).first()
    assert good["row_count"] == hourly.count() > 0 and good["alert"] is False
    before = _warehouse(spark, wh)
    if gate == "row count":
        sinks.write_hourly(hourly.limit(0), f"{out}/hourly", DAY)
    elif gate == "duplicates":
        sinks.write_hourly(hourly.unionByName(hourly), f"{out}/hourly", DAY)
    else:
        sinks.write_scored(scored.withColumn("is_anomaly", F.lit(True)), f"{out}/anomaly_scores", DAY)
    for mode in ("overwrite",) if gate == "row count" else ("overwrite", "append"):
        with pytest.raises(Q.QualityError):
            J.validate_days(spark, out, wh, DAY, ts_type=TS, mode=mode)
        assert _warehouse(spark, wh) == before
    if gate == "row count":
        return
    J.validate_days(spark, out, wh, DAY, ts_type=TS, enforce=False)      # reported, not enforced
    assert _warehouse(spark, wh) != before


def test_a_model_save_that_stops_leaves_the_old_model(spark, monkeypatch):
    nodes, metrics = sinks.load_model_tables(spark, fixtures.model_layout(spark, SF))
    root = table_path(spark, "test-model-steps")
    sinks.save_model(spark, nodes, metrics, root)

    def fail(*_):
        raise OSError("injected")

    for cls, name in ((days.Folders, "write_new"), (days.CommitLog, "_switch")):
        with monkeypatch.context() as m:
            m.setattr(cls, name, fail)
            with pytest.raises(OSError):
                sinks.save_model(spark, nodes.limit(1), {"max_samples": 1}, root)
        back, again = sinks.load_model_tables(spark, root)
        assert back.count() == nodes.count() and again == metrics
    sinks.save_model(spark, nodes.limit(1), {"max_samples": 1}, root)
    back, again = sinks.load_model_tables(spark, root)
    assert back.count() == 1 and again == {"max_samples": 1}
