"""Work that must not grow faster than the tables: passes of fits, partitions, joins of steps."""

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import functions as F


def _table(spark, n=400, seed=3):
    draw = np.random.default_rng(seed)
    x = draw.normal(size=(n, 2))
    y = (x[:, 0] * x[:, 1] + draw.normal(size=n) * 0.5 > 0).astype(float)
    return spark.createDataFrame([(i, float(a), float(b), float(c)) for i, ((a, b), c) in enumerate(zip(x, y))],
                                 "id long, a double, b double, y double")


def _jobs(spark, name, run):
    sc = spark.sparkContext
    sc.setJobGroup(name, name)
    try:
        out = run()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    return out, len(sc.statusTracker().getJobIdsForGroup(name))


def test_boosting_over_rows_needs_one_job_a_level(spark):
    from crease.operators.boost import Spec, boost
    df = _table(spark)
    few, many = (_jobs(spark, f"boost-{r}", lambda r=r: boost(df, ["a", "b"], "y", [Spec(rounds=r, depth=2)], "id", in_task=0))[1] for r in (2, 6))
    assert many - few <= 4 * 2


def test_boosting_over_rows_in_narrow_passes_and_across_checkpoints(spark, monkeypatch):
    from crease.operators import boost as B
    df, spec = _table(spark), B.Spec(rounds=5, depth=4, rate=0.3, rows=0.8)
    near = B.boost(df, ["a", "b"], "y", [spec], "id")[0][0]
    monkeypatch.setattr(B, "PASS_MB", 0.005)  # two nodes a pass
    monkeypatch.setattr(B, "CUT_ROUNDS", 2)
    far = B.boost(df, ["a", "b"], "y", [spec], "id", in_task=0)[0][0]
    assert all(np.array_equal(u, v) for s, t in zip(near.trees, far.trees) for x, z in zip(s, t) for p, q in zip(x, z) for u, v in zip(p, q))


def test_a_level_of_small_histograms_needs_one_stage(spark, monkeypatch):
    from crease.operators import boost as B
    df, sc = _table(spark), spark.sparkContext

    def stages(rounds):
        sc.setJobGroup(f"stages-{rounds}", "")
        try:
            model = B.boost(df, ["a", "b"], "y", [B.Spec(rounds=rounds, depth=2)], "id", in_task=0)[0][0]
        finally:
            sc.setLocalProperty("spark.jobGroup.id", None)
        tracker = sc.statusTracker()
        seen = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(f"stages-{rounds}") for s in tracker.getJobInfo(j).stageIds]
        return model, sum(1 for s in seen if s is not None and s.numCompletedTasks)  # without those skipped

    (_, few), (model, many) = stages(2), stages(6)
    assert many - few <= 4 * 2
    monkeypatch.setattr(B, "GATHER_MB", 0)  # added up by a shuffle
    shuffled = B.boost(df, ["a", "b"], "y", [B.Spec(rounds=6, depth=2)], "id", in_task=0)[0][0]
    assert all(np.array_equal(u, v) for s, t in zip(model.trees, shuffled.trees) for x, z in zip(s, t) for p, q in zip(x, z) for u, v in zip(p, q))


def test_rows_step_down_by_rows_and_by_features():
    from crease.operators.boost import step_down
    draw = np.random.default_rng(4)
    bins = draw.integers(0, 64, (500, 3)).astype(np.uint8)
    feature, cut = np.array([2, -1, 0, 1]), np.array([30, 0, 63, 10])
    for share in (0.1, 0.9):  # few or most rows are in a node
        at = np.where(draw.random(500) < share, draw.integers(0, 4, 500), -1)
        place = {0: 0, 2: 2, 3: 4}
        want = [place[a] + int(b[feature[a]] > cut[a]) if a in place else -1 for a, b in zip(at.tolist(), bins)]
        assert step_down(bins, at, feature, cut).tolist() == want == step_down(np.ascontiguousarray(bins.T).T, at, feature, cut).tolist()


@pytest.mark.parametrize("kind", [RandomForestClassifier, RandomForestRegressor])
def test_a_forest_of_many_draws_is_fitted_in_groups(spark, monkeypatch, kind):
    from crease.operators import models as M
    est = kind(numTrees=6, maxDepth=4, seed=1)
    df = _table(spark)
    monkeypatch.setattr(M, "FOREST_DRAWS", 1000)  # two trees of 400 rows
    model = M.fit_pipeline(df, ["a", "b"], "y", est)
    assert model.trees == [2, 2, 2]
    out = model.transform(df).collect()
    each = [p.transform(df).collect() for p in model.parts]
    for i in (0, 7, 99):
        if kind is RandomForestClassifier:
            want = np.mean([rows[i].probability.toArray() for rows in each], axis=0)
            assert out[i].probability == pytest.approx(list(want)) and out[i].prediction == float(want.argmax())
        else:
            assert out[i].prediction == pytest.approx(np.mean([rows[i].prediction for rows in each]))
    shares = {r.feature: r.importance for r in M.feature_importance(model, ["a", "b"]).collect()}
    assert sum(shares.values()) == pytest.approx(1)


def test_depth_sweep_scores_the_trees_of_every_depth_by_one_fit(spark):
    from crease.operators.models import depth_sweep, fit_pipeline
    df = _table(spark)
    train, test = df.filter("id % 4 > 0"), df.filter("id % 4 = 0")
    ev = MulticlassClassificationEvaluator(labelCol="y", metricName="accuracy")
    out, jobs = _jobs(spark, "sweep", lambda: depth_sweep(train, test, ["a", "b"], "y", range(1, 8)))
    got = {r.depth: (r.train_accuracy, r.test_accuracy) for r in out.collect()}
    for d in (1, 2, 4, 7):
        m = fit_pipeline(train, ["a", "b"], "y", DecisionTreeClassifier(maxDepth=d, seed=42))
        assert got[d] == pytest.approx((ev.evaluate(m.transform(train)), ev.evaluate(m.transform(test))))
    assert jobs < 7 * 7


def test_learning_curve_of_least_squares_from_sums_equals_its_fits(spark):
    from crease.operators.models import learning_curve
    df = _table(spark).withColumn("t", F.col("a") * 2 - F.col("b") + F.col("y"))
    run = lambda est: {round(r.size, 3): (r.train_score, r.val_score) for r in
                       learning_curve(df, ["a", "b"], "t", est, "id", sizes=[0.1, 0.5, 1.0], folds=3).collect()}
    sums, jobs = _jobs(spark, "curve", lambda: run(LinearRegression(solver="normal")))
    fits = run(LinearRegression(solver="normal", regParam=1e-13))
    assert sums.keys() == fits.keys() and all(sums[k] == pytest.approx(fits[k], abs=1e-6) for k in fits)
    assert jobs < 40


def test_adaboost_weights_in_leaves_are_those_of_the_rows(spark):
    from pyspark.ml.feature import VectorAssembler
    from crease.operators.models import _leaf_weights
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(_table(spark)).withColumn("w", F.col("id") / 10 + 1)
    tree = DecisionTreeClassifier(maxDepth=2, labelCol="y", weightCol="w").fit(df)
    wrong, whole = tree.transform(df).agg(F.sum(F.when(F.col("prediction") != F.col("y"), F.col("w"))), F.sum("w")).first()
    assert _leaf_weights(tree._call_java("rootNode")) == pytest.approx((wrong, whole))


def test_nearest_centres_are_exact_with_ties():
    from crease.operators.cluster import _nearest
    draw = np.random.default_rng(0)
    x = np.concatenate([draw.integers(0, 4, (300, 3)).astype(float), draw.normal(size=(300, 3)) + 1e6])
    centres = np.concatenate([x[:5], x[:2], x[-3:]])
    far = np.stack([((x - c) ** 2).sum(axis=1) for c in centres], axis=1)
    to, cost = _nearest(x, centres)
    assert np.array_equal(to, far.argmin(axis=1)) and np.array_equal(cost, far.min(axis=1))


def test_steps_of_a_match_need_no_window_or_join_of_steps(spark):
    from crease.operators.history import sequence_features
    log = spark.createDataFrame([(1, 1, 0, 4, None), (1, 1, 2, 3, "out"), (1, 1, 2, 1, None), (1, 2, 0, 9, None), (1, 1, 30, 7, "out"),
                                 (2, 1, 1, None, "out"), (3, 2, 0, 5, None), (None, 1, 0, 2, None)],
                                "match_id long, innings int, over_no int, runs int, dismissal string")
    matches = spark.createDataFrame([(1, 15), (2, 0), (3, 5)], "match_id long, team1_runs int")
    out = sequence_features(log, matches, seq_len=4)
    got = {r.match_id: [[round(v, 5) for v in s] for s in r.seq] for r in out.collect()}
    assert got.keys() == {1, 2}
    runs, outs = [4, 4, 8, 8], [0, 0, 1, 1]
    assert got[1] == [[pytest.approx(v, abs=1e-5) for v in (o / 19, r / 300, w / 10, r / (o + 1) / 15, 1 - w / 10)]
                      for o, (r, w) in enumerate(zip(runs, outs))]
    assert [s[2] for s in got[2]] == pytest.approx([0, 0.1, 0.1, 0.1]) and all(s[1] == 0 for s in got[2])
    assert "Window" not in out._jdf.queryExecution().optimizedPlan().toString()
