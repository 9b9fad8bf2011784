"""Exact quantiles, modes, splits and running totals on hard inputs, against plain Python."""

import random
import statistics
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from crease.operators.scan import modes, order_bounds, quantiles, running_totals


def test_quantiles_of_groups_with_hot_values_ties_and_nulls(spark):
    draw = random.Random(3)
    rows = [(g, None if draw.random() < 0.1 else (7.0 if draw.random() < 0.4 else draw.gauss(0, 50)), draw.randint(0, 3))
            for g in ["a"] * 700 + ["b"] * 30 + [None] * 20 + ["one"] for _ in range(1)] + [("empty", None, None)]
    df = spark.createDataFrame(rows, "g string, x double, y int")
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {r["g"]: r for r in quantiles(df, {"qx": (F.col("x"), probs), "qy": (F.col("y"), [0.5])}, ["g"]).collect()}
    for g in ("a", "b", None, "one"):
        values = [x for h, x, _ in rows if h == g and x is not None]
        if values:
            assert got[g]["qx"] == pytest.approx(np.quantile(values, probs).tolist())
        assert got[g]["qy"] == [pytest.approx(np.median([y for h, _, y in rows if h == g]))]
    assert "empty" not in got
    whole = quantiles(df, {"q": (F.col("x"), [0.25])}).collect()
    assert len(whole) == 1 and whole[0]["q"] == [pytest.approx(np.quantile([x for _, x, _ in rows if x is not None], 0.25))]
    assert quantiles(df.limit(0), {"q": (F.col("x"), [0.5])}).first()["q"] is None


def test_mode_prefers_the_smallest_of_the_most_frequent(spark):
    df = spark.createDataFrame([(3, "b"), (3, "a"), (1, "a"), (1, "b"), (2, None)], "x int, s string")
    assert modes(df, {"x": F.col("x"), "s": F.col("s")}) == {"x": 1, "s": "a"}
    assert modes(df.limit(0), {"x": F.col("x")}) == {"x": None}


def test_no_operator_holds_a_column_in_one_buffer():
    import pathlib
    import re
    import crease.operators
    for path in pathlib.Path(crease.operators.__file__).parent.glob("*.py"):
        assert not re.search(r"F\.(percentile|median|mode)\(", path.read_text()), path


def test_string_keys_of_one_prefix_spread_over_all_blocks(spark):
    names = [f"Customer#{k:09d}" for k in range(5_000)]
    df = spark.createDataFrame([(n,) for n in names], "k string")
    bounds = order_bounds(df, "k", 8)
    assert len(bounds) == 7
    held = Counter(sum(n >= b for b in bounds) for n in names)
    assert len(held) == 8 and max(held.values()) < 3 * min(held.values())
    got = {r["k"]: r["at"] for r in running_totals(df, [], ["k"], {"at": F.lit(1)}).collect()}
    assert [got[n] for n in names] == list(range(5_000))


def test_null_order_values_are_cut_by_the_next_column(spark):
    rows = [(None if k % 3 else k, k, k % 2) for k in range(900)]
    df = spark.createDataFrame(rows, "t int, k int, g int")
    got = {r["k"]: r["before"] for r in running_totals(df, ["g"], ["t", "k"], {"before": F.col("k")}).collect()}
    sums = defaultdict(int)
    for t, k, g in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        assert got[k] == sums[g]
        sums[g] += k


def test_stratified_split_keeps_null_labels(spark):
    from crease.operators.prepare import train_test_split
    df = spark.createDataFrame([(k, [None, "x", "y"][k % 3]) for k in range(30)], "id int, label string")
    out = train_test_split(df, "id", label="label").collect()
    assert Counter((r["label"], r["split"]) for r in out) == {(v, s): n for v in (None, "x", "y") for s, n in (("test", 2), ("train", 8))}


def test_group_reports_skip_null_keys(spark):
    from crease.operators.reports import batting_career, best_figures, bowling_career, pair_record
    log = spark.createDataFrame([(None, 1, 4, "w", 1), ("p", 1, 6, None, 2), ("p", None, 1, "w", 3)],
                                "batter string, match_id int, runs int, dismissal string, seq int")
    assert [r["batter"] for r in batting_career(log).collect()] == ["p"]
    as_bowler = log.withColumnRenamed("batter", "bowler")
    assert [r["bowler"] for r in bowling_career(as_bowler).collect()] == ["p"]
    assert [tuple(r) for r in best_figures(as_bowler).collect()] == [("p", "0/6")]
    pairs = spark.createDataFrame([("a", "b", "a"), ("a", None, "a"), (None, None, None)], "side_a string, side_b string, winner string")
    assert [tuple(r)[:3] for r in pair_record(pairs).collect()] == [("a", "b", 1)]


def test_categories_are_never_capped_by_default(spark):
    from crease.operators import bivariate as B
    rows = [(f"c{k % 40}", f"d{k % 37}", float(k % 11)) for k in range(2_000)]
    df = spark.createDataFrame(rows, "c string, d string, v double")
    assert B.group_stats(df, "c", "v").count() == 40
    assert B.anova_oneway(df, "c", "v", with_p=False).first()["n"] == 2_000
    assert B.crosstab(df, "c", "d").filter("not margin").count() == len({r[:2] for r in rows})
    got = B.chi_square(df, "c", "d", with_p=False).first()
    cells, cs, ds = Counter(r[:2] for r in rows), Counter(r[0] for r in rows), Counter(r[1] for r in rows)
    chi = sum((cells[c, d] - cs[c] * ds[d] / 2_000) ** 2 / (cs[c] * ds[d] / 2_000) for c in cs for d in ds)
    assert got["chi2"] == pytest.approx(chi) and got["dof"] == 39 * 36


def test_spearman_of_a_hot_value(spark):
    from crease.operators.bivariate import spearman
    draw = random.Random(9)
    rows = [(1.0 if draw.random() < 0.4 else draw.random(), draw.random()) for _ in range(400)]

    def ranks(values):
        order = sorted(values)
        return [statistics.mean((order.index(v) + 1, order.index(v) + order.count(v))) for v in values]

    expected = np.corrcoef(ranks([a for a, _ in rows]), ranks([b for _, b in rows]))[0, 1]
    assert spearman(spark.createDataFrame(rows, "x double, y double"), "x", "y", with_p=False).first()["rho"] == pytest.approx(expected)


def test_decision_grid_fills_other_features_with_their_means(spark):
    from pyspark.ml.regression import LinearRegression
    from crease.operators.models import decision_grid, fit_pipeline
    df = spark.createDataFrame([(float(a), float(a % 3), float(a % 5), 2.0 * a) for a in range(30)], "a double, b double, c double, y double")
    model = fit_pipeline(df, ["a", "b", "c"], "y", LinearRegression())
    out = decision_grid(model, df, "a", "b", steps=4).collect()
    assert len(out) == 16 and {round(r["c"], 9) for r in out} == {2.0}


def _nearest(train, test, k):
    out = {}
    for t, q in test:
        if all(v is not None for v in q):
            far = sorted((np.sqrt(sum((a - b) ** 2 for a, b in zip(q, p))), r) for r, p in train if all(v is not None for v in p))
            out[t] = [r for _, r in far[:k]]
    return {t: v for t, v in out.items() if v}


@pytest.mark.parametrize("dims", [1, 3, 64])
def test_knn_ends_and_is_exact(spark, dims):
    """A third of the rows on one point, a far test row, null features, ties, blocks smaller than a cell."""
    from crease.operators.cluster import knn_neighbours
    draw = np.random.default_rng(dims)
    train = [(i, draw.normal(size=dims).round(3).tolist()) for i in range(200)] + [(i, [0.5] * dims) for i in range(200, 300)] + \
        [(300, [None] + [0.0] * (dims - 1))]
    test = [(1000 + i, draw.normal(size=dims).round(3).tolist()) for i in range(30)] + \
        [(2000, [1e6] * dims), (2001, [None] * dims), (2002, [0.5] * dims)]
    names = [f"x{i}" for i in range(dims)]
    frame = lambda rows: spark.createDataFrame([(i, *p) for i, p in rows],
                                               "id long, " + ", ".join(f"{c} double" for c in names))
    got = defaultdict(list)
    for r in sorted(knn_neighbours(frame(train), frame(test), "id", names, k=7, pivots=12, block=16).collect(),
                    key=lambda r: (r["test_id"], r["rank"])):
        got[r["test_id"]].append(r["train_id"])
    assert got == _nearest(train, test, 7)
    assert knn_neighbours(frame(train[:0]), frame(test), "id", names).count() == 0
    assert knn_neighbours(frame(train), frame(test[:0]), "id", names).count() == 0
    assert knn_neighbours(frame(train[:3]), frame(test[:1]), "id", names, k=7).count() == 3


def test_dbscan_takes_null_features_as_noise(spark):
    from crease.operators.cluster import dbscan
    rows = [(i, 0.01 * i, 0.0) for i in range(6)] + [(6, None, 0.0), (7, 9.0, 9.0)]
    got = {r["id"]: (r["dbscan_cluster"], r["is_core"]) for r in dbscan(spark.createDataFrame(rows, "id int, x double, y double"),
                                                                        "id", ["x", "y"], 0.5, 5).collect()}
    assert got == {**{i: (0, True) for i in range(6)}, 6: (-1, False), 7: (-1, False)}


def test_dbscan_of_many_equal_points(spark):
    """Equal points count as often as they stand, in three and in five dimensions."""
    from crease.operators.cluster import dbscan
    for dims in (3, 5):
        names = [f"x{i}" for i in range(dims)]
        rows = [(i, *[1.0] * dims) for i in range(50, 450)] + [(i, *[0.2 * i] * dims) for i in range(4)] + [(900, *[50.0] * dims)]
        df = spark.createDataFrame(rows, "id int, " + ", ".join(f"{c} double" for c in names))
        got = {r["id"]: (r["dbscan_cluster"], r["is_core"]) for r in dbscan(df, "id", names, eps=0.3, min_samples=5).collect()}
        assert len(got) == len(rows) and {got[i] for i in range(50, 450)} == {(0, True)}
        assert {got[i] for i in range(4)} == {(-1, False)} and got[900] == (-1, False)


def test_stump_votes_equal_the_models(spark):
    from crease.operators.models import _stump, adaboost
    draw = np.random.default_rng(2)
    rows = [(float(a), float(b), float(a + 0.3 * b > 0)) for a, b in draw.normal(size=(200, 2))]
    df = spark.createDataFrame(rows, "a double, b double, y double")
    model = adaboost(df, ["a", "b"], "y", n_estimators=4)
    from pyspark.ml.feature import VectorAssembler
    wide = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    for stump in model.stumps:
        out = stump.transform(wide).withColumn("own", _stump(stump, ["a", "b"]))
        assert out.filter("prediction <> own").count() == 0
    assert model.transform(df).filter("prediction = y").count() > 150


def test_multiclass_comparison(spark):
    from crease.operators.models import fit_many_compare
    draw = np.random.default_rng(4)
    rows = [(float(a), float(b), float(int(a > 0) + int(b > 0)), k % 4) for k, (a, b) in enumerate(draw.normal(size=(400, 2)))]
    df = spark.createDataFrame(rows, "a double, b double, y double, k int")
    table, models = fit_many_compare(df.filter("k > 0"), df.filter("k = 0"), ["a", "b"], "y", "multiclass", ["dt", "gb"])
    got = {r["model"]: r for r in table.collect()}
    assert set(got) == set(models) == {"dt", "gb"} and sum(r["best"] for r in got.values()) == 1
    for r in got.values():
        assert r["n"] == 100 and r["accuracy"] > 0.8 and 0.7 < r["macro_f1"] <= 1 and 0.8 < r["macro_auc"] <= 1
    pred = models["dt"].transform(df.filter("k = 0")).select("y", "prediction").collect()
    assert got["dt"]["accuracy"] == pytest.approx(np.mean([r["y"] == r["prediction"] for r in pred]))


def test_one_hot_of_many_levels_is_a_sparse_vector(spark):
    from crease.operators.prepare import one_hot
    rows = [(k, f"v{k % 12:02d}" if k % 13 else None) for k in range(60)]
    df = spark.createDataFrame(rows, "k int, c string")
    levels = sorted({v or "Missing" for _, v in rows})
    out = {r["k"]: r["c_onehot"] for r in one_hot(df, "c", shape="vector").collect()}
    assert all(out[k].size == len(levels) and out[k].indices.tolist() == [levels.index(v or "Missing")] for k, v in rows)
    assert "c_v01" in one_hot(df, "c").columns  # the shape is the caller's, whatever the number of levels
    with pytest.raises(ValueError, match="more than 5 levels"):
        one_hot(df, "c", max_levels=5)
