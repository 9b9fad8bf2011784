"""Forests whose trees grow side by side, each in a task: their trees, draws and importances."""

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F


def _rows(n=400, seed=3):
    draw = np.random.default_rng(seed)
    x = draw.normal(size=(n, 4))
    return x, (x[:, 0] * x[:, 1] + draw.normal(size=n) * 0.5 > 0).astype(float)


def _table(spark, n=400, seed=3):
    x, y = _rows(n, seed)
    return spark.createDataFrame([(i, *map(float, v), float(c)) for i, (v, c) in enumerate(zip(x, y))],
                                 "id long, a double, b double, c double, d double, y double")


COLUMNS = ["a", "b", "c", "d"]


@pytest.fixture(autouse=True)
def _all_in_tasks(monkeypatch):
    from crease.operators import models as M
    monkeypatch.setattr(M, "TASK_DRAWS", 0)


def _same(one, two):
    return len(one) == len(two) and all(len(s) == len(t) and all(np.array_equal(u, v) for p, q in zip(s, t) for u, v in zip(p, q))
                                        for x, z in zip(one, two) for s, t in zip(x, z))


@pytest.mark.parametrize("loss, columns", [("share", 1.0), ("share", 0.0), ("mean", 0.4)])
def test_levels_of_small_nodes_split_as_histograms_do(monkeypatch, loss, columns):
    from crease.operators import boost as B
    draw = np.random.default_rng(5)
    bins = draw.integers(0, 64, (5, 2000)).astype(np.uint8)
    y = (draw.random(2000) < 0.4).astype(float) if loss == "share" else draw.normal(size=2000).round(3) * 100
    args = bins, y, np.arange(2000), np.full(2000, -1), B.Spec(rounds=3, depth=20, loss=loss, columns=columns, l2=0.0), np.zeros(1), []
    monkeypatch.setattr(B, "SPARSE", 0)
    whole, _, gains = B.grow_all(*args)
    monkeypatch.setattr(B, "SPARSE", 64)
    monkeypatch.setattr(B, "best_splits", lambda h, *a, own=B.best_splits: own(h, *a) if h.shape[1] <= 64 else pytest.fail("a histogram of small nodes"))
    sorted_, _, again = B.grow_all(*args)
    assert max(len(level[0]) for tree in whole for level in tree[0]) > 64
    assert _same(whole, sorted_) and gains == pytest.approx(again)


@pytest.mark.parametrize("kind", [RandomForestClassifier, RandomForestRegressor])
def test_trees_of_a_forest_are_dealt_over_tasks(spark, monkeypatch, kind):
    from crease.operators import boost as B
    from crease.operators import models as M
    df = _table(spark)
    est = kind(numTrees=40, maxDepth=30, featureSubsetStrategy="all", seed=9, **M.DEEP)
    tasks = []
    monkeypatch.setattr(B, "_over_rows", lambda *a: tasks.append(a))  # not taken
    model = M.fit_pipeline(df, COLUMNS, "y", est)
    assert isinstance(model, B.Boosted) and len(model.trees) == 40 and not tasks
    assert max(len(t[0]) for t in model.trees) > 5 and model.spec.depth == 30
    assert len({str(t[0][0][0]) + str(t[0][1]) for t in model.trees}) > 20  # the trees differ
    out = model.transform(df).select("y", "prediction").collect()
    assert np.mean([abs(r.y - r.prediction) for r in out]) < 0.25


def test_a_tree_of_a_forest_equals_an_exhaustive_builder(spark):
    from crease.operators import models as M
    from crease.operators.boost import binned
    x, y = _rows(120, 7)
    df = _table(spark, 120, 7)
    model = M.fit_pipeline(df, COLUMNS, "y", RandomForestClassifier(numTrees=1, maxDepth=30, featureSubsetStrategy="all", seed=4))
    bins = binned(list(x.T), model.edges)
    rid = np.array([r[0] for r in df.select(F.xxhash64(*COLUMNS, "y")).collect()], np.int64)
    from crease.operators.boost import times_drawn
    times = times_drawn(rid, model.spec, 0)
    gains = np.zeros(4)

    def grow(held):
        w = times[held]
        mean = (w * y[held]).sum() / w.sum()
        loss = w.sum() * mean * (1 - mean)
        best, found = 1e-6, None
        for k in range(4):
            for cut in sorted(set(bins[held, k].tolist()))[:-1]:
                left, right = held[bins[held, k] <= cut], held[bins[held, k] > cut]
                below = sum((times[p] * y[p]).sum() * (1 - (times[p] * y[p]).sum() / times[p].sum()) for p in (left, right))
                if loss - below > best + 1e-12:
                    best, found = loss - below, (k, cut, left, right)
        if found is None:
            return {int(i): mean for i in held}
        gains[found[0]] += best
        return grow(found[2]) | grow(found[3])

    want = grow(np.flatnonzero(times > 0))
    got = [r.p for r in model.transform(df).orderBy("id").select(F.col("probability")[1].alias("p")).collect()]
    assert {i: got[i] for i in want} == pytest.approx(want, abs=1e-6)
    shares = {r.feature: r.importance for r in M.feature_importance(model, COLUMNS).collect()}
    assert shares == pytest.approx(dict(zip(COLUMNS, gains / gains.sum())))


def test_equal_rows_are_drawn_apart(spark, monkeypatch):
    from crease.operators import models as M
    df = spark.createDataFrame([(float(i % 2), float(i % 2 if i % 10 else 1 - i % 2)) for i in range(400)], "a double, y double")
    model = M.fit_pipeline(df, ["a"], "y", RandomForestClassifier(numTrees=60, maxDepth=3, seed=2))
    roots = np.array([t[0][0][2][0] for t in model.trees]) * 60  # the share of ones of every tree
    assert 0.01 < roots.std() < 0.05  # of 400 single draws 0.025; rows drawn by their values would give far more


def test_other_forests_are_fitted_by_spark(spark, monkeypatch):
    from crease.operators import models as M
    from pyspark.ml import PipelineModel
    df = _table(spark).withColumn("z", F.col("y") + (F.col("a") > 1).cast("double"))
    assert isinstance(M.fit_pipeline(df, COLUMNS, "z", RandomForestClassifier(numTrees=2, maxDepth=2)), PipelineModel)  # three classes
    with pytest.raises(Exception, match="NaN"):  # as ever
        M.fit_pipeline(df.withColumn("a", F.when(F.col("id") > 3, F.col("a"))), COLUMNS, "y", RandomForestClassifier(numTrees=2, maxDepth=2))
    monkeypatch.setattr(M, "TASK_DRAWS", 20_000_000)  # small enough for Spark
    assert isinstance(M.fit_pipeline(df, COLUMNS, "y", RandomForestClassifier(numTrees=2, maxDepth=2)), PipelineModel)
    monkeypatch.setattr(M, "TASK_DRAWS", 0)
    monkeypatch.setattr(M, "IN_TASK", 10)  # more rows than a task holds
    assert isinstance(M.fit_pipeline(df, COLUMNS, "y", RandomForestClassifier(numTrees=2, maxDepth=2)), PipelineModel)


def test_a_forest_has_the_bins_that_it_asks_for(spark):
    from crease.operators import models as M
    df = _table(spark, 1000).withColumn("b", F.floor(F.col("id") / 980).cast("double") + F.when(F.col("id") % 2 == 0, 5.0).otherwise(0.0))
    model = M.fit_pipeline(df, COLUMNS, "y", RandomForestClassifier(numTrees=2, maxDepth=3, maxBins=8))
    assert [len(e) for e in model.edges] == [7, 3, 7, 7]
    assert model.edges[1] == [0.0, 1.0, 5.0]  # four values, of which two are rare
