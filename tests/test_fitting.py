"""Fitted models against brute force on small tables: trees, forests, boosting both
ways, searches, AdaBoost.R2, linear models from sums, stacking, and DBSCAN."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F


def _table(spark, n=300, seed=1):
    draw = np.random.default_rng(seed)
    x = draw.normal(size=(n, 3))
    x[::29, 2] = np.nan
    y = (x[:, 0] * x[:, 1] + np.nan_to_num(x[:, 2]) + draw.normal(size=n) * 0.3 > 0).astype(float)
    rows = [(i, *map(float, x[i]), float(y[i]), float(int(x[i, 0] > 0) + int(x[i, 1] > 0.5)), i % 3) for i in range(n)]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, y double, z double, fold int").replace(float("nan"), None)


def _same(one, two):
    return all(len(a.trees) == len(b.trees) and all(np.array_equal(u, v) for ta, tb in zip(a.trees, b.trees) for x, z in zip(ta, tb)
                                                    for la, lb in zip(x, z) for u, v in zip(la, lb)) for a, b in zip(one, two))


@pytest.mark.parametrize("label, loss", [("y", {}), ("z", {"loss": "softmax", "classes": 3}), ("a", {"loss": "squared"}),
                                         ("y", {"loss": "share", "columns": 0.0, "l2": 0.0})])
def test_rows_apart_and_rows_in_a_task_grow_the_same_trees(spark, label, loss):
    from crease.operators.boost import Spec, boost
    df = _table(spark)
    more = {} if "columns" in loss else {"columns": 0.6}
    specs = [Spec(rounds=3, depth=3, rows=0.7, fold=0, **more, **loss), Spec(rounds=2, depth=4, rate=0.3, **loss),
             Spec(rounds=2, depth=2, second="share" == loss.get("loss"), least=5, fold=2, **loss)]
    near, scores = boost(df, ["a", "b", "c"], label, specs, "id", "fold")
    far, again = boost(df, ["a", "b", "c"], label, specs, "id", "fold", in_task=0)
    assert _same(near, far) and scores[1] is None
    assert scores == pytest.approx(again) if None not in scores else [s for s in scores if s is not None] == pytest.approx([s for s in again if s is not None])
    out = near[0].transform(df).select("fold", F.col(label).alias("label"), "prediction").filter("fold = 0").collect()
    value = np.mean([(r.prediction - r.label) ** 2 if loss.get("loss") == "squared" else r.prediction == r.label for r in out])
    assert value == pytest.approx(scores[0])  # the model's own predictions give its score


def test_a_boosted_tree_equals_an_exhaustive_builder(spark):
    from crease.operators.boost import Spec, boost
    df = _table(spark, 90, 5).dropna()
    spec = Spec(rounds=1, depth=2, rate=0.5, l2=1.0, least=1.0)
    model = boost(df, ["a", "b"], "y", [spec], "id")[0][0]
    rows = df.select("a", "b", "y").collect()
    bins = [[sum(v > e for e in edges) for v in (r[k] for r in rows)] for k, edges in enumerate(model.edges)]
    share = np.mean([r.y for r in rows])
    g, h = [share - r.y for r in rows], [share * (1 - share)] * len(rows)

    def grow(held, depth):
        sg, sh = sum(g[i] for i in held), sum(h[i] for i in held)
        best, parts = sg ** 2 / (sh + 1) + 1e-6, None
        for k in range(2) if depth else ():
            for cut in sorted({bins[k][i] for i in held}):
                left = [i for i in held if bins[k][i] <= cut]
                right = [i for i in held if bins[k][i] > cut]
                hl, hr = sum(h[i] for i in left), sum(h[i] for i in right)
                if hl >= 1 and hr >= 1:
                    gain = sum(g[i] for i in left) ** 2 / (hl + 1) + sum(g[i] for i in right) ** 2 / (hr + 1)
                    if gain > best + 1e-12:
                        best, parts = gain, (left, right)
        if parts is None:
            return {i: -0.5 * sg / (sh + 1) for i in held}
        return grow(parts[0], depth - 1) | grow(parts[1], depth - 1)

    want = grow(list(range(len(rows))), 2)
    assert len(set(want.values())) > 2
    got = model.transform(df).select("probability").collect()
    base = math.log(share / (1 - share))
    for i, r in enumerate(got):
        assert r.probability[1] == pytest.approx(1 / (1 + math.exp(-base - want[i])), abs=1e-5)


def test_boosting_learns_and_takes_nulls(spark):
    from crease.operators.models import classifiers, fit_pipeline, multiclass_classifiers
    df = _table(spark, 600)
    for label, spec in [("y", classifiers(1)["gb"]), ("y", classifiers(1)["xgb"]), ("z", multiclass_classifiers(1, 3)["gb"]),
                        ("z", multiclass_classifiers(1, 3)["xgb"])]:
        model = fit_pipeline(df.filter("fold > 0"), ["a", "b", "c"], label, spec)
        test = model.transform(df.filter("fold = 0"))
        assert test.filter(F.col("prediction") == F.col(label)).count() / test.count() > 0.8
        p = test.first()["probability"]
        assert sum(p) == pytest.approx(1) and len(p) == (2 if label == "y" else 3)
    with pytest.raises(ValueError, match="no row has a label"):
        fit_pipeline(df.withColumn("y", F.lit(None).cast("double")), ["a"], "y", classifiers(1)["gb"])


def test_many_models_are_dealt_over_tasks_and_shorter_ones_are_prefixes(spark, monkeypatch):
    from crease.operators import boost as B
    df, columns = _table(spark), ["a", "b", "c"]
    specs = [B.Spec(rounds=r, depth=d, rate=0.3, rows=0.8, fold=k) for r in (2, 5, 3) for d in (2, 4) for k in (0, 2)] \
        + [B.Spec(rounds=2, depth=d, rate=0.1, fold=k) for d in (1, 2, 3) for k in (None, 0, 1)]
    assert [[specs[k].rounds for k in c] for c in B._chains(specs)] == [[2, 3, 5]] * 4 + [[2]] * 9
    far = [B.boost(df, columns, "y", [s], "id", "fold", in_task=0) for s in specs[::4]]
    monkeypatch.setattr(B, "_over_rows", None)  # 300 rows, a task holds 100, five times as many for 13 chains on 8 cores
    models, scores = B.boost(df, columns, "y", specs, "id", "fold", in_task=100)
    assert _same(models[::4], [m[0][0] for m in far]) and [len(m.trees) for m in models] == [s.rounds for s in specs]
    assert scores[::4] == [m[1][0] for m in far] and [s is None for s in scores] == [s.fold is None for s in specs]
    with pytest.raises(TypeError):
        B.boost(df, columns, "y", specs[:2], "id", "fold", in_task=100)


def test_attribution_walks_a_tree_once(spark, monkeypatch):
    from crease.operators import boost as B
    df, columns = _table(spark), ["a", "b", "c"]
    model = B.boost(df, columns, "y", [B.Spec(rounds=4, depth=4, rate=0.3)], "id")[0][0]
    rows = df.toPandas()
    bins = B.binned([rows[c].to_numpy(float) for c in columns], model.edges)
    want, margin, steps = np.zeros((len(rows), 3)), np.full(len(rows), model.base[0]), []
    for (tree,) in model.trees:  # row by row: the change of value at every split
        for i, b in enumerate(bins):
            at = 0
            for level, (feature, cut, value) in enumerate(tree):
                if feature[at] < 0:
                    margin[i] += value[at]
                    break
                to = 2 * int((feature[:at] >= 0).sum()) + int(b[feature[at]] > cut[at])
                want[i, feature[at]] += tree[level + 1][2][to] - value[at]
                at = to
    step, shares, got = B.step_down, np.zeros((len(rows), 3)), np.full(len(rows), model.base[0])
    monkeypatch.setattr(B, "step_down", lambda *a: steps.append(1) or step(*a))
    for (tree,) in model.trees:
        add, value = B.path_table(tree, 3)
        node = B.landed(bins, tree)
        shares, got = shares + add[node], got + value[node]
    assert len(steps) == sum(len(tree) - 1 for (tree,) in model.trees)
    assert np.allclose(shares, want) and np.allclose(got, margin)
    spread = B.attributions(model, df, ["id"]).orderBy("id").collect()
    assert np.allclose([r.shares for r in spread], want) and np.allclose([r.margin for r in spread], margin)
    assert np.allclose([r.bias + sum(r.shares) for r in spread], margin)


def test_random_search_runs_its_draws_over_all_folds(spark):
    from crease.operators.boost import Spec, boost
    from crease.operators.models import SEED, boosted_search
    from crease.operators.prepare import kfold_assign
    from crease.plans.model_q import BOOST_GRID
    assert math.prod(map(len, BOOST_GRID.values())) == 108
    df, grid = _table(spark), {"rounds": [3, 5], "depth": [2, 3], "rate": [0.1, 0.3], "rows": [0.6, 1.0]}
    out = boosted_search(df, ["a", "b", "c"], "y", grid, "id", folds=4, sample=6).collect()
    assert len(out) == 6 == len({r[:4] for r in out}) and sum(r.best for r in out) == 1
    assert max(r.mean_score for r in out) == next(r.mean_score for r in out if r.best)
    f, r = kfold_assign(df, "id", 4, label="y"), out[2]
    each = [boost(f, ["a", "b", "c"], "y", [Spec(r.rounds, r.depth, r.rate, r.rows, fold=k)], "id", "fold")[1][0] for k in range(4)]
    assert r.mean_score == pytest.approx(np.mean(each)) and SEED == 42


def test_grid_search_of_all_five_classifiers(spark):
    from crease.operators.models import CLASSIFIER_GRIDS, search_classifiers
    assert {k: math.prod(map(len, v.values())) for k, v in CLASSIFIER_GRIDS.items()} == {"lr": 4, "knn": 7, "svm": 8, "dt": 10, "rf": 6}
    df = _table(spark, 240).withColumn("c", F.coalesce("c", F.lit(0.0)))
    grids = {"lr": {"C": [1.0]}, "knn": {"n_neighbors": [1, 5]}, "svm": {"C": [1.0], "gamma": ["scale"]},
             "dt": {"max_depth": [3, None], "criterion": ["gini"]}, "rf": {"n_estimators": [20], "max_depth": [5, None]}}
    out = search_classifiers(df, ["a", "b", "c"], "y", "id", folds=3, grids=grids).collect()
    assert {(r.estimator, r.params) for r in out} >= {("knn", "n_neighbors=5"), ("dt", "max_depth=None, criterion=gini")} and len(out) == 8
    assert all(0.4 < r.mean_score <= 1 for r in out) and sum(r.best for r in out) == 5
    from crease.operators.prepare import kfold_assign, scale_standard
    z = scale_standard(kfold_assign(df, "id", 3, label="y"), ["a", "b", "c"]).collect()
    right = []
    for k in range(3):
        train = [r for r in z if r.fold != k]
        votes = [(r.y, sorted((math.dist((r.a, r.b, r.c), (t.a, t.b, t.c)), t.id, t.y) for t in train)[:5]) for r in z if r.fold == k]
        right.append(np.mean([y == float(sum(t[2] for t in near) > 2.5) for y, near in votes]))
    assert next(r.mean_score for r in out if r.params == "n_neighbors=5") == pytest.approx(np.mean(right))


def test_svm_points_of_one_gamma_are_fitted_once(spark, monkeypatch):
    from crease.operators import models as M
    df, fits, fit = _table(spark, 120).withColumn("c", F.lit(1.0)), [], M.svm_rbf
    monkeypatch.setattr(M, "svm_rbf", lambda *a, **k: fits.append(k) or fit(*a, **k))
    grids = {"svm": {"C": [1.0], "gamma": ["scale", "auto"]}}
    out = M.search_classifiers(df, ["a", "b"], "y", "id", folds=2, grids=grids).collect()
    assert len(fits) == 2 and len(out) == 2 and out[0].mean_score == out[1].mean_score
    fits.clear()  # with a constant column the two differ
    M.search_classifiers(df, ["a", "b", "c"], "y", "id", folds=2, grids=grids)
    assert len(fits) == 4 and len({f["gamma"] for f in fits}) == 2


def _weighted_tree(x, y, w, depth):
    """Exhaustive regression tree: a function row -> value."""
    mean = np.sum(w * y) / np.sum(w)
    best, cut = 1e-12, None
    for k in range(x.shape[1]) if depth else ():
        values = np.unique(x[:, k])
        for low, high in zip(values, values[1:]):
            left = x[:, k] <= (low + high) / 2
            part = lambda m: np.sum(w[m] * (y[m] - np.sum(w[m] * y[m]) / np.sum(w[m])) ** 2)
            gain = np.sum(w * (y - mean) ** 2) - part(left) - part(~left)
            if gain > best * (1 + 1e-9):
                best, cut = gain, (k, (low + high) / 2, left)
    if cut is None:
        return lambda row: mean
    k, at, left = cut
    one, two = _weighted_tree(x[left], y[left], w[left], depth - 1), _weighted_tree(x[~left], y[~left], w[~left], depth - 1)
    return lambda row: one(row) if row[k] <= at else two(row)


def test_adaboost_r2_equals_a_loop(spark):
    from crease.operators.models import adaboost_r2
    draw = np.random.default_rng(4)
    x = draw.normal(size=(50, 2))
    y = np.sin(2 * x[:, 0]) + x[:, 1] + draw.normal(size=50) * 0.1
    df = spark.createDataFrame([(i, *map(float, x[i]), float(y[i])) for i in range(50)], "id int, a double, b double, y double")
    w, stages = np.ones(50), []
    for _ in range(6):
        tree = _weighted_tree(x, y, w, 2)
        e = np.abs(np.array([tree(r) for r in x]) - y)
        e /= e.max()
        error = np.sum(w * e) / np.sum(w)
        if error >= 0.5:
            break
        beta = error / (1 - error)
        stages.append((tree, math.log(1 / beta)))
        w = w / w.sum() * beta ** (1 - e)
    want = []
    for r in x:
        held = sorted((tree(r), weight) for tree, weight in stages)
        want.append(next(v for k, (v, _) in enumerate(held) if sum(t[1] for t in held[:k + 1]) >= sum(t[1] for t in held) / 2))
    model = adaboost_r2(df.unionAll(df.limit(1).withColumn("y", F.lit(None).cast("double"))), ["a", "b"], "y", n_estimators=6, depth=2, checkpoint_every=2)
    got = [r.prediction for r in model.transform(df).orderBy("id").collect()]
    assert len(model.stages) == len(stages) and np.allclose(got, want)


def test_linear_models_from_sums(spark):
    from crease.operators.linear import fold_moments, merge, solve
    draw = np.random.default_rng(2)
    x = draw.normal(size=(200, 3)) * [1, 50, 1e-3] + [0, 1e4, 5]
    y = x @ [1.5, -0.2, 300] + draw.normal(size=200)
    df = spark.createDataFrame([(*map(float, x[i]), 7.0, float(y[i]), i % 4) for i in range(200)] + [(None, 1.0, 1.0, 7.0, 1.0, 0)],
                               "a double, b double, c double, k double, y double, fold int")
    parts = fold_moments(df, ["a", "b", "c", "k"], "y", "fold")
    whole = merge(list(parts.values()))
    assert whole.n == 200 and np.allclose(whole.mean[:3], x.mean(axis=0))
    z, t = x - x.mean(axis=0), y - y.mean()
    for alpha in (0.0, 3.0):
        fit = solve(whole, ["a", "b", "c", "k"], "ridge", alpha)
        want = np.linalg.solve(z.T @ z + alpha * np.eye(3), z.T @ t)
        assert np.allclose(fit.weights[:3], want, rtol=1e-6) and fit.weights[3] == 0
        assert fit.squared_error(whole) == pytest.approx(np.sum((t - z @ want) ** 2), rel=1e-6)
    part = merge([p for k, p in parts.items() if k != 1])
    seen = np.arange(200) % 4 != 1
    assert np.allclose(solve(part, list("abck")).weights[:3], np.linalg.lstsq(x[seen] - x[seen].mean(axis=0), y[seen] - y[seen].mean(), rcond=None)[0], rtol=1e-6)
    lasso = solve(whole, list("abck"), "lasso", 0.3)
    slope = z.T @ (t - z @ lasso.weights[:3]) / 200  # conditions of the optimum
    assert all(abs(s) <= 0.3 + 1e-6 if w == 0 else s == pytest.approx(0.3 * np.sign(w), abs=1e-6) for s, w in zip(slope, lasso.weights[:3]))
    got = [r.prediction for r in solve(whole, list("abck")).transform(df).limit(3).collect()]
    assert len(got) == 3


def test_stacking_of_three_classes(spark):
    from crease.operators.models import stacking
    df = _table(spark, 240).withColumn("c", F.coalesce("c", F.lit(0.0)))
    model = stacking(df.filter("fold > 0"), ["a", "b", "c"], "z", "id", folds=3)
    out = model.transform(df.filter("fold = 0"))
    assert out.filter("prediction = z").count() / out.count() > 0.75 and len(out.first()["probability"]) == 3


def test_dbscan_in_many_dimensions_vs_brute_force(spark, monkeypatch):
    from crease.operators import cluster as K
    monkeypatch.setattr(K, "PER_PIVOT", 20)
    monkeypatch.setattr(K, "SIDE", 16)
    draw = np.random.default_rng(6)
    pts = np.vstack([draw.normal(0, 0.4, (60, 6)), draw.normal(3, 0.5, (50, 6)), draw.uniform(-3, 6, (20, 6)), np.ones((12, 6)) * 9])
    cols = [f"f{k}" for k in range(6)]
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(pts)] + [(500, None, *[0.0] * 5)],
                               "id long, " + ", ".join(f"{c} double" for c in cols))
    eps, least = 1.2, 5
    near = ((pts[:, None] - pts[None]) ** 2).sum(axis=2) <= eps * eps
    core = near.sum(axis=1) >= least
    label = np.where(core, np.arange(len(pts)), 10 ** 6)
    for _ in range(len(pts)):
        label = np.where(core, np.where(near & core[None], label[None], 10 ** 6).min(axis=1), label)
    code = {v: k for k, v in enumerate(sorted(set(label[core].tolist())))}
    want = {i: (code[label[i]] if core[i] else min((code[label[j]] for j in np.flatnonzero(near[i] & core)), default=-1), bool(core[i]))
            for i in range(len(pts))} | {500: (-1, False)}
    got = {r.id: (r.dbscan_cluster, r.is_core) for r in K.dbscan(df, "id", cols, eps, least).collect()}
    assert got == want and len(code) >= 3


def test_dbscan_sends_points_of_a_side_once_and_holds_few_distances(spark, monkeypatch):
    from crease.operators import cluster as K
    draw = np.random.default_rng(8)
    cols = [f"f{k}" for k in range(5)]
    df = spark.createDataFrame([(i, 1, *map(float, p)) for i, p in enumerate(draw.normal(size=(6000, 5)))],
                               "id long, w long, " + ", ".join(f"{c} double" for c in cols))
    assert K._metric_sides(df, cols, 50.0, ["id"]).count() == 2 * 6000  # no point is out of reach
    few = df.filter("id < 400").drop("w")
    whole = sorted(tuple(r) for r in K.dbscan(few, "id", cols, 0.8, 4).collect())
    assert len({r[1] for r in whole}) >= 3
    for name, size in (("PER_PIVOT", 50), ("SIDE", 40), ("CHUNK", 7)):
        monkeypatch.setattr(K, name, size)
    assert sorted(tuple(r) for r in K.dbscan(few, "id", cols, 0.8, 4).collect()) == whole


def test_search_prefers_the_better_penalty(spark):
    from crease.operators.models import regularised_cv
    draw = random.Random(1)
    df = spark.createDataFrame([(i, draw.gauss(0, 1), draw.gauss(0, 1), 0.0) for i in range(120)], "id long, a double, b double, y double") \
        .withColumn("y", F.col("a") * 2 - F.col("b"))
    for kind, best in (("ridge", 0.01), ("lasso", 0.001)):
        alpha, model = regularised_cv(df, ["a", "b"], "y", "id", kind)
        assert alpha == best and model.weights == pytest.approx([2, -1], abs=0.01)


def test_artefact_keeps_its_contract(spark, tmp_path):
    from pyspark.ml.classification import LogisticRegression

    from crease.operators.artefact import Artefact
    from crease.operators.models import classifiers, fit_pipeline
    df = _table(spark, 120).withColumn("c", F.coalesce("c", F.lit(0.0)))
    for name, est in (("tree", classifiers(1)["gb"]), ("line", LogisticRegression())):
        model = fit_pipeline(df, ["a", "b"], "y", est)
        Artefact(model, ["a", "b"], ["no", "yes"]).save(spark, f"{tmp_path}/{name}")
        back = Artefact.load(spark, f"{tmp_path}/{name}")
        assert (back.features, back.labels) == (["a", "b"], ["no", "yes"])
        out = {r.id: r for r in back.score(df, ["id"]).collect()}
        want = {r.id: r.prediction for r in model.transform(df).collect()}
        assert all(r.prediction == want[i] and r.label == ("no", "yes")[int(r.prediction)] and len(r.probability) == 2 for i, r in out.items())
        with pytest.raises(ValueError, match="reads b, which the table lacks"):
            back.score(df.drop("b"), ["id"])
        with pytest.raises(ValueError, match="b is string"):
            back.score(df.withColumn("b", F.lit("x")), ["id"])
    codes = Artefact(fit_pipeline(df.withColumn("a", F.lit(1)), ["a"], "y", classifiers(1)["gb"]), ["a"], [], {"a": {"x": 1}}, 7)
    assert codes.score(df.withColumn("a", F.lit("x")), ["id"]).count() == 120


def test_attributions_add_up_to_the_margin(spark):
    from crease.operators.boost import Spec, attributions, boost
    df = _table(spark, 200)
    model = boost(df, ["a", "b", "c"], "y", [Spec(rounds=5, depth=3)], "id")[0][0]
    rows = attributions(model, df, ["id"]).collect()
    p = {r.id: r.probability[1] for r in model.transform(df).collect()}
    for r in rows:
        assert r.bias + sum(r.shares) == pytest.approx(r.margin, abs=1e-9)
        assert 1 / (1 + math.exp(-r.margin)) == pytest.approx(p[r.id], abs=1e-9)
    only = boost(df.withColumn("d", F.lit(1.0)), ["d", "a"], "y", [Spec(rounds=3, depth=2)], "id")[0][0]
    assert all(r.shares[0] == 0 for r in attributions(only, df.withColumn("d", F.lit(1.0)), ["id"]).collect())


def test_last_known_with_a_hot_key(spark):
    from crease.operators.scan import last_known
    draw = random.Random(3)
    rows = [(i, "hot" if draw.random() < 0.7 else draw.choice("ab"), draw.choice([None, None, float(i)])) for i in range(400)]
    rows[5] = (5, None, 1.5)
    df = spark.createDataFrame(rows, "t long, k string, v double")
    for blocks in (1, 9):
        got = {r.t: r.last for r in last_known(df, ["k"], ["t"], {"last": F.col("v")}, n_blocks=blocks).collect()}
        seen, want = {}, {}
        for t, k, v in rows:
            want[t] = seen.get(k)
            seen[k] = v if v is not None else seen.get(k)
        assert got == want


def test_lloyd_equals_a_loop(spark):
    from crease.operators.cluster import _starts, _vectors, kmeans, lloyd
    draw = np.random.default_rng(9)
    pts = np.vstack([draw.normal(c, 0.5, (40, 2)) for c in (0, 3, 6)])
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(pts)] + [(900, None, 1.0)], "id long, a double, b double")
    points = _vectors(df, "id", ["a", "b"]).checkpoint()
    starts = [_starts(points, k, 42, 2) for k in (2, 3, 5)]
    centres, costs = lloyd(points, starts)
    for start, got, cost in zip(starts, centres, costs):
        c = start.copy()
        for _ in range(300):
            to = ((pts[:, None] - c[None]) ** 2).sum(axis=2).argmin(axis=1)
            c = np.array([pts[to == j].mean(axis=0) for j in range(len(c)) if (to == j).any()])
        assert np.allclose(got, c) and cost == pytest.approx(((pts - c[((pts[:, None] - c[None]) ** 2).sum(axis=2).argmin(axis=1)]) ** 2).sum())
    out, _ = kmeans(df, "id", ["a", "b"], k=3)
    label = {r.id: r.kmeans_cluster for r in out.collect()}
    assert label[900] is None and [label[0], label[40], label[80]] == [0, 1, 2] and all(label[i] == label[i // 40 * 40] for i in range(120))
