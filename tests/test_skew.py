"""Hot groups: a third of all rows in one key or one group of copies."""

from pyspark.sql import functions as F

from gridlens import fixtures
from gridlens.operators import clean as C
from gridlens.operators import rolling as W
from gridlens.operators import rolling_split as RS


def test_dedup_with_a_third_of_rows_as_copies(spark):
    base = fixtures.readings(spark, "/root/testdata/sf0.001")
    n = base.count()
    one = base.limit(1).withColumn("meter_id", F.lit("MHOT"))
    copies = one.withColumn("_k", F.explode(F.sequence(F.lit(1), F.lit(n // 2)))).drop("_k")
    df = base.unionByName(copies)                     # copies are a third of all rows
    out = C.dedup_readings(df)
    assert out.filter(F.col("meter_id") == "MHOT").count() == 1
    assert out.count() == base.select("meter_id", "reading_timestamp").distinct().count() + 1


def test_rolling_with_one_meter_holding_a_third(spark):
    c = C.clean_readings(fixtures.readings(spark, "/root/testdata/sf0.01")) \
        .select("meter_id", "reading_timestamp", "kwh_consumed")
    hot_id = F.when(F.xxhash64("reading_timestamp") % 3 == 0, F.lit("MHOT")).otherwise(F.col("meter_id"))
    skewed = c.withColumn("meter_id", hot_id).checkpoint(eager=True)
    n_hot = skewed.filter(F.col("meter_id") == "MHOT").count()
    assert n_hot > skewed.count() / 4
    assert [tuple(r) for r in RS._hot_keys(skewed, "meter_id", 1000).collect()] == [("MHOT", n_hot)]
    a = W.rolling_stats(skewed)
    b = RS.rolling_stats_split(skewed, rows_per_task=1000)
    assert b.count() == a.count()
    assert a.exceptAll(b.select(*a.columns)).count() == 0


def test_positions_with_one_meter_holding_a_third(spark):
    c = C.clean_readings(fixtures.readings(spark, "/root/testdata/sf0.01")).select("meter_id", "reading_timestamp")
    hot_id = F.when(F.xxhash64("reading_timestamp") % 3 == 0, F.lit("MHOT")).otherwise(F.col("meter_id"))
    skewed = c.withColumn("meter_id", hot_id).dropDuplicates().checkpoint(eager=True)
    a = W.series_position(skewed)
    b = RS.series_position_split(skewed, rows_per_task=500)
    assert b.count() == a.count() and a.exceptAll(b.select(*a.columns)).count() == 0


def test_meter_counts_from_daily_match_readings(spark):
    from gridlens.plans import jobs as J
    from gridlens.sources import scans
    root = fixtures.processed_layout(spark, "/root/testdata/sf0.01")
    got = {r["meter_id"]: r["_n"] for r in
           J.meter_counts(spark, root, None, "2024-01-03", "2024-01-12").collect()}
    rows = scans.scan_processed_days(spark, f"{root}/readings", "2024-01-03", "2024-01-12",
                                     fixtures.FIXTURE_TS)
    counted = J.meter_counts(spark, f"{root}-none", rows, "2024-01-03", "2024-01-12").collect()
    assert {r["meter_id"]: r["_n"] for r in counted} == got   # no daily rollup: the readings are counted
    want = {r["meter_id"]: r["count"] for r in rows.groupBy("meter_id").count().collect()}
    assert got == want


def test_partition_numbering_with_and_without_gaps(spark):
    full = spark.createDataFrame([(0,), (1,), (2,)], "_pid int")
    assert [r["_seq"] for r in RS.number_partitions(full).orderBy("_pid").collect()] == [1, 2, 3]
    gap = spark.createDataFrame([(0,), (1,), (3,)], "_pid int")
    assert [r["_seq"] for r in RS.number_partitions(gap).orderBy("_pid").collect()] == [1, 2, 3]
