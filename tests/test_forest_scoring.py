import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridlens import fixtures
from gridlens.operators import clean as C
from gridlens.operators import features as FE
from gridlens.operators import forest as FO
from gridlens.operators import scoring as S
from gridlens.schemas import FEATURE_COLS


@pytest.fixture(scope="module")
def feats(spark):
    raw = fixtures.readings(spark, "/root/testdata/sf0.01", with_label=True)
    f = C.drop_null_features(FE.engineer_features(C.clean_readings(raw)))
    return f.select("meter_id", "reading_timestamp", "is_true_anomaly", *FEATURE_COLS) \
            .checkpoint(eager=True)


@pytest.fixture(scope="module")
def trained(spark, feats):
    return FO.train(spark, feats.select("meter_id", "reading_timestamp", *FEATURE_COLS))


def test_average_path_length():
    assert list(FO.average_path_length([0, 1, 2])) == [0.0, 0.0, 1.0]
    assert FO.average_path_length([256])[0] == pytest.approx(10.2448, abs=1e-3)


def test_sample_sizes(spark, feats):
    sample, psi = FO.forest_sample(feats)
    sizes = {r["tree_id"]: r["n"] for r in sample.groupBy("tree_id").agg(F.count("*").alias("n")).collect()}
    assert psi == 256 and len(sizes) == 200 and set(sizes.values()) == {256}
    dup = sample.groupBy("tree_id", "meter_id", "reading_timestamp").count().filter("count > 1")
    assert dup.count() == 0                                  # without replacement


def test_a_row_can_be_in_several_trees_at_every_size(spark, feats):
    """One rule: the same draw below and above trees * psi * margin rows."""
    for n_trees, most in ((200, 256), (10, 64)):             # 8,411 rows: below 76,800, above 960
        sample, psi = FO.forest_sample(feats, n_trees=n_trees, max_samples=most)
        assert {r[0] for r in sample.groupBy("tree_id").count().select("count").collect()} == {psi}
        shared = sample.groupBy("meter_id", "reading_timestamp").count().filter("count > 1").count()
        assert shared > 0


def test_large_table_draws_rows_for_several_trees(spark):
    from pyspark.sql import types as T
    base = spark.range(100_000).select(
        F.concat(F.lit("M"), F.col("id") % 50).alias("meter_id"),
        (F.timestamp_seconds(F.col("id") * 60)).alias("reading_timestamp"),
        *[F.rand(i).alias(c) for i, c in enumerate(FEATURE_COLS)])
    assert base.schema["reading_timestamp"].dataType == T.TimestampType()
    sample, psi = FO.forest_sample(base, 100_000)
    sizes = [r[0] for r in sample.groupBy("tree_id").count().select("count").collect()]
    assert len(sizes) == 200 and set(sizes) == {256} == {psi}
    rows = sample.groupBy("meter_id", "reading_timestamp").count()
    # 51,200 draws from 100,000 rows: about a fifth of the drawn rows are in two trees or more
    assert rows.filter("count > 1").count() > 0.15 * rows.count()


def test_few_rows_are_in_every_tree(spark, feats):
    sample, psi = FO.forest_sample(feats.limit(40), n_trees=7)
    assert psi == 40 and sample.count() == 7 * 40


def test_model_bound_follows_the_saved_parameters(spark, feats):
    sample, psi = FO.forest_sample(feats, n_trees=3, max_samples=600)
    nodes = FO.forest_fit(sample, psi, n_trees=3).checkpoint(eager=True)
    assert FO.load_model(nodes, psi, 3).n_trees == 3          # 600 rows a tree, more than the default 256
    with pytest.raises(ValueError):
        FO.load_model(nodes, 20, 3)


def test_tree_structure(trained):
    nodes, psi, _ = trained
    pdf = nodes.toPandas()
    inner = pdf[pdf.feature >= 0]
    idx = pdf.set_index(["tree_id", "node_id"])
    left = idx.loc[list(zip(inner.tree_id, inner.left)), "n_rows"].to_numpy()
    right = idx.loc[list(zip(inner.tree_id, inner.right)), "n_rows"].to_numpy()
    assert (left + right == inner.n_rows.to_numpy()).all()
    assert (left > 0).all() and (right > 0).all()
    roots = pdf[pdf.node_id == 0]
    assert (roots.n_rows == psi).all()
    assert len(pdf) <= 200 * (2 * 256 - 1)


def test_fit_independent_of_partitioning(spark, feats):
    base = feats.select("meter_id", "reading_timestamp", *FEATURE_COLS)
    a_s, psi = FO.forest_sample(base, n_trees=20)
    b_s, _ = FO.forest_sample(base.repartition(7), n_trees=20)
    a = FO.forest_fit(a_s, psi).toPandas().sort_values(["tree_id", "node_id"]).reset_index(drop=True)
    b = FO.forest_fit(b_s, psi).toPandas().sort_values(["tree_id", "node_id"]).reset_index(drop=True)
    assert a.equals(b)


def test_growth_depends_on_values_alone():
    """Rows in another order grow the same tree; values apart by rounding only do
    not split; each child holds the rows its parent's split sends there."""
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.normal(size=64), np.full(64, 0.1) + rng.integers(0, 2, 64) * 1e-16, rng.integers(0, 3, 64)])
    a = sorted(FO._grow_tree(x, 42, 5, 6))
    assert a == sorted(FO._grow_tree(x[rng.permutation(64)], 42, 5, 6)) != sorted(FO._grow_tree(x, 42, 6, 6))
    assert 1 not in {n[1] for n in a}
    by_id = {n[0]: n for n in a}
    for i, feature, threshold, left, right, n, _ in a:
        if feature >= 0:
            assert (left, right) == (2 * i + 1, 2 * i + 2) and by_id[left][5] + by_id[right][5] == n
    root = by_id[0]
    assert by_id[1][5] == (x[:, root[1]] < root[2]).sum()
    assert FO._grow_tree(np.zeros((4, 2)), 42, 0, 2) == [(0, -1, 0.0, -1, -1, 4, FO.average_path_length([4])[0])]
    u = [v for i in range(500) for v in FO.split_draw(42, 0, i)]
    assert 0 < min(u) and max(u) < 1 and abs(np.mean(u) - 0.5) < 0.03


def test_scores_equal_a_walk_node_by_node():
    """Leaves at every depth, ids that are no heap places, NaN and infinities;
    the rows x trees arrays of a step fit the cache."""
    rng = np.random.default_rng(7)
    nodes = []
    for t in range(9):
        x = rng.integers(0, 5, (64, 13)).astype(float) if t % 2 else rng.normal(size=(64, 13))
        grown = FO._grow_tree(x[:64 if t else 1], 42, t, 6)
        name = dict(zip([n[0] for n in grown], [0, *rng.permutation(len(grown) - 1) + 1]))
        nodes += [(t, int(name[i]), f, thr, int(name.get(a, -1)), int(name.get(b, -1)), m, path) for i, f, thr, a, b, m, path in grown]
    table = pd.DataFrame(nodes, columns=["tree_id", "node_id", "feature", "threshold", "left", "right", "n_rows", "path_len"])
    X = np.concatenate([rng.normal(size=(600, 13)), rng.integers(0, 5, (60, 13))])
    X[:40][rng.random((40, 13)) < 0.3] = np.nan
    X[40:60][rng.random((20, 13)) < 0.3] = np.inf
    X[60:80][rng.random((20, 13)) < 0.3] = -np.inf
    by_id = {(t, n): rest for t, n, *rest in nodes}

    def path(t, x):
        at = by_id[t, 0]
        while at[0] >= 0:
            at = by_id[t, at[2] if x[at[0]] < at[1] else at[3]]
        return at[5]
    mean = np.array([[path(t, x) for t in range(9)] for x in X]).mean(axis=1)
    want = -np.power(2.0, -mean / float(FO.average_path_length([64])[0]))
    assert np.array_equal(FO.ForestModel(table, 64).score(X), want)
    assert FO.SCORE_ROWS * FO.N_TREES * 8 <= 1 << 19


def test_scores_and_outliers(spark, feats, trained):
    nodes, psi, _ = trained
    model = FO.load_model(nodes, psi)
    scored = FO.score_readings(spark, FE.impute_features(feats), model).cache()
    pdf = scored.select("anomaly_score", "is_true_anomaly").toPandas()
    s = pdf.anomaly_score.to_numpy()
    assert s.min() >= -1.0 and s.max() < -0.26               # Q1: never above ~-0.266
    y = pdf.is_true_anomaly.to_numpy() == 1
    ranks = (-s).argsort().argsort()                          # higher = more anomalous
    pos, neg = ranks[y], ranks[~y]
    auc = (pos[:, None] > neg[None, :]).mean()
    assert auc > 0.85
    offset = S.contamination_offset(scored)
    assert offset == pytest.approx(float(np.quantile(s, 0.02)))
    flagged = S.flag_and_grade(scored, "offset", offset).filter("is_anomaly").count()
    assert abs(flagged / len(s) - 0.02) < 0.005
    assert S.flag_and_grade(scored, "raw").filter("is_anomaly").count() == len(s)  # Q1


def test_identical_rows_identical_scores(spark, trained):
    nodes, psi, _ = trained
    model = FO.load_model(nodes, psi)
    x = np.random.default_rng(1).normal(size=(5, len(FEATURE_COLS)))
    s1 = model.score(np.vstack([x, x]))
    assert np.array_equal(s1[:5], s1[5:])


def test_severity_ladder_and_nulls(spark):
    df = spark.createDataFrame([(v,) for v in [-0.31, -0.30, -0.21, -0.20, -0.16, -0.15, None]],
                               "anomaly_score double")
    out = [(r[0], r[1], r[2]) for r in S.flag_and_grade(df, "raw").collect()]
    sev = [o[2] for o in out]
    assert sev == ["HIGH", "MEDIUM", "MEDIUM", "LOW", "LOW", "NORMAL", "NORMAL"]
    assert out[-1][1] is None                                # NULL score -> NULL flag
    assert S.filter_anomalies(S.flag_and_grade(df, "raw")).count() == 5


def test_evaluate_zero_division(spark):
    df = spark.createDataFrame([(0, False), (0, False)], "is_true_anomaly int, is_anomaly boolean")
    r = S.evaluate_scores(df).first()
    assert (r["precision"], r["recall"], r["f1_score"]) == (0.0, 0.0, 0.0)
    df = spark.createDataFrame([(1, True), (1, False), (0, True), (0, False)],
                               "is_true_anomaly int, is_anomaly boolean")
    r = S.evaluate_scores(df).first()
    assert (r["precision"], r["recall"], r["f1_score"]) == (0.5, 0.5, 0.5)


def test_quantile_takes_the_same_jobs_whatever_the_values(spark):
    tiny = [5e-324 * i for i in range(-40, 41)]
    sets = [[0.5] * 300 + [1.0], tiny, [-float("inf")] * 3 + tiny + [float("inf")] * 3, [-0.0, 0.0, -1e308, 1e308],
            np.random.default_rng(2).normal(size=3000).tolist()]
    jobs = set()
    for i, vals in enumerate(sets):
        df = spark.createDataFrame([(v,) for v in vals] + [(None,), (float("nan"),)], "x double")
        for q in (0.02, 0.25, 0.5):
            group = f"quantile-{i}-{q}"
            spark.sparkContext.setJobGroup(group, group)
            got = S.exact_quantile(df, "x", q, persist=False)
            jobs.add(len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)))
            at = q * (len(vals) - 1)
            lo, hi = sorted(vals)[int(at)], sorted(vals)[min(int(at) + 1, len(vals) - 1)]
            assert got == (lo if lo == hi or at == int(at) else lo + (hi - lo) * (at - int(at)))
    spark.sparkContext.setJobGroup("", "")
    assert len(jobs) == 1
    assert S.exact_quantile(spark.createDataFrame([(None,)], "x double"), "x", 0.5) is None


@pytest.mark.parametrize("q", [0.0, 0.02, 0.5, 0.999, 1.0])
def test_exact_quantile_brackets(spark, q):
    vals = np.random.default_rng(7).normal(size=5000).round(3)  # with ties
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    got = S.exact_quantile(df, "x", q)
    assert got == pytest.approx(float(np.quantile(vals, q)))


def test_exact_quantile_constant_and_empty(spark):
    df = spark.createDataFrame([(2.5,)] * 3000 + [(None,)], "x double")
    assert S.exact_quantile(df, "x", 0.02) == 2.5
    assert S.exact_quantile(df.filter("x < 0"), "x", 0.5) is None
    two = spark.createDataFrame([(1.0,)] * 1500 + [(2.0,)] * 1500, "x double")
    assert S.exact_quantile(two, "x", 0.5) == pytest.approx(1.5)


def test_short_draw_is_redrawn(spark, feats):
    base = feats.select("meter_id", "reading_timestamp", *FEATURE_COLS)
    thin, psi = FO.forest_sample(base, n_trees=50, margin=0.5)      # too few candidates
    sizes = [r[0] for r in thin.groupBy("tree_id").count().select("count").collect()]
    assert min(sizes) < psi
    nodes, psi, _ = FO.train(spark, base, n_trees=50, margin=0.5)    # redraws
    roots = nodes.filter("node_id = 0").collect()
    assert len(roots) == 50 and all(r["n_rows"] == psi for r in roots)


def test_scorer_matches_brute_force_traversal(spark):
    small = fixtures.readings(spark, "/root/testdata/sf0.001")
    f = C.drop_null_features(FE.engineer_features(C.clean_readings(small))).select(
        "meter_id", "reading_timestamp", *FEATURE_COLS).checkpoint(eager=True)
    nodes, psi, _ = FO.train(spark, f, n_trees=25)
    table = {(r["tree_id"], r["node_id"]): r for r in nodes.collect()}
    trees = sorted({t for t, _ in table})

    def path_len(tree, x, node=0):
        r = table[(tree, node)]
        if r["feature"] < 0:
            return r["path_len"]
        nxt = r["left"] if x[r["feature"]] < r["threshold"] else r["right"]
        return path_len(tree, x, nxt)

    c_psi = float(FO.average_path_length([psi])[0])
    rows = f.orderBy("meter_id", "reading_timestamp").collect()
    brute = [-2.0 ** (-np.mean([path_len(t, [r[c] for c in FEATURE_COLS]) for t in trees]) / c_psi)
             for r in rows]
    model = FO.load_model(nodes, psi)
    fast = model.score(np.array([[r[c] for c in FEATURE_COLS] for r in rows], dtype=float))
    assert np.allclose(brute, fast, rtol=0, atol=1e-12)
    via_spark = [r["anomaly_score"] for r in FO.score_readings(spark, f, model)
                 .orderBy("meter_id", "reading_timestamp").collect()]
    assert np.allclose(brute, via_spark, rtol=0, atol=1e-12)


def test_model_save_load_round_trip(spark, trained):
    from gridlens.session import table_path
    from gridlens.sources import sinks
    nodes, psi, n = trained
    metrics = {"max_samples": psi, "n_train_samples": n, "offset": -0.61, "note": "x"}
    root = table_path(spark, "test-k8")
    sinks.save_model(spark, nodes, metrics, root)
    back, m2 = sinks.load_model_tables(spark, root)
    assert m2 == metrics
    assert back.count() == nodes.count()
    assert nodes.exceptAll(back).count() == 0 and back.exceptAll(nodes).count() == 0


def test_quantile_of_few_values_many_times(spark):
    df = spark.createDataFrame([(float(i % 7) + (0.5 if i % 11 else 0.25),) for i in range(900)], "s double")
    v = sorted(r[0] for r in df.collect())
    for q in (0.0, 0.02, 0.5, 0.93, 1.0):
        pos = q * 899
        k, f = int(pos), pos - int(pos)
        want = v[k] if f == 0 else v[k] + (v[k + 1] - v[k]) * f
        assert S.exact_quantile(df, "s", q) == pytest.approx(want)
