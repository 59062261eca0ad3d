"""Physical-plan properties the design relies on at scale."""

import re

from gridlens import fixtures
from gridlens.operators import clean as C
from gridlens.operators import features as FE
from gridlens.operators import forest as FO
from gridlens.operators import quality as Q
from gridlens.operators import rollup as R
from gridlens.schemas import FEATURE_COLS

SF = "/root/testdata/sf0.001"


def _plan(spark, df) -> str:
    return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def _ops(plan: str) -> list[str]:
    """Operator names of the tree part of a formatted plan, top to bottom."""
    tree = plan.split("\n\n")[0]
    return re.findall(r"[+-]*\s*([A-Za-z]+)(?: \(\d+\))", tree)


def test_dedup_combines_before_its_shuffle(spark):
    plan = _plan(spark, C.clean_readings(fixtures.readings(spark, SF)))
    ops = _ops(plan)
    ex = ops.index("Exchange")
    assert ops[ex - 2] == "SortAggregate" and "SortAggregate" in ops[ex + 1:]   # final above, partial below
    assert "partial_min" in plan


def test_rollups_are_partial_then_final(spark):
    c = C.clean_readings(fixtures.readings(spark, SF))
    for df in (R.hourly_rollup(c), R.daily_rollup(c)):
        plan = _plan(spark, df)
        assert _ops(plan).count("Exchange") == 2      # dedup + rollup, nothing more
        assert "partial_sum(kwh_consumed" in plan


def test_quality_report_has_no_join(spark):
    raw = fixtures.readings(spark, SF)
    plan = _plan(spark, Q.quality_report(raw, C.clean_readings(raw), by="reading_date"))
    assert "Join" not in plan and "CartesianProduct" not in plan
    plan1 = _plan(spark, Q.quality_report(raw, C.clean_readings(raw)))
    assert "Join" not in plan1 and "CartesianProduct" not in plan1


def test_features_stay_in_the_jvm(spark):
    c = C.clean_readings(fixtures.readings(spark, SF))
    plan = _plan(spark, FE.engineer_features(c, split_long_series=False))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "WholeStageCodegen" in plan or "Window" in plan


def test_scoring_ships_only_features_to_python(spark):
    c = C.clean_readings(fixtures.readings(spark, SF))
    f = FE.impute_features(FE.engineer_features(c, split_long_series=False))
    nodes, psi, _ = FO.train(spark, C.drop_null_features(f).select(
        "meter_id", "reading_timestamp", *FEATURE_COLS))
    scored = FO.score_readings(spark, f, FO.load_model(nodes, psi))
    plan = _plan(spark, scored)
    udf_line = [ln for ln in plan.splitlines() if ln.startswith("Arguments:") and "forest_score" in ln]
    assert "ArrowEvalPython" in plan and "BatchEvalPython" not in plan
    assert udf_line and all(c in udf_line[0] for c in FEATURE_COLS)
    assert "meter_status" not in udf_line[0] and "lat" not in udf_line[0].split("forest_score")[1]
