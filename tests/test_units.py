"""Unit cases: literal examples, zero guards, closed forms and brute-force
cross-checks on small inputs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from crease.functions import columns as P
from crease.functions import dist
from crease.operators import bivariate as B
from crease.operators import clean as C
from crease.operators import evaluate as E
from crease.operators import history as H
from crease.operators import prepare as PR
from crease.operators import profile as Q
from crease.operators import reports as A
from crease.operators.scan import average_rank, running_totals


def test_normalise_season(spark):
    df = spark.createDataFrame([("2007/08",), ("2009/10",), ("2016",), ("1999/00",), ("2016.0",), ("x",)], "s string")
    got = [r[0] for r in df.select(P.normalise_season("s")).collect()]
    assert got == [2008, 2010, 2016, 2000, 2016, None]


def test_parse_win_margin(spark):
    df = spark.createDataFrame([("Won by 45 runs",), ("Won by 7 wickets",), ("Tied",), (None,)], "s string")
    r, w = P.parse_win_margin("s")
    assert [tuple(x) for x in df.select(r, w).collect()] == [(45, 0), (0, 7), (0, 0), (0, 0)]


def test_clean_text_and_aliases(spark):
    df = spark.createDataFrame([("  Bat ",), ("nan",), ("None",), ("",), (None,)], "s string")
    assert [r[0] for r in df.select(P.clean_text("s")).collect()] == ["bat", None, None, None, None]
    df2 = spark.createDataFrame([("Delhi Daredevils",), ("Other",)], "t string")
    assert [r[0] for r in df2.select(P.alias_map("t")).collect()] == ["Delhi Capitals", "Other"]


def test_elo_constants(spark):
    t = {r["n"]: r["rating"] for r in H.elo_table(spark, 10).collect()}
    assert t[1] == pytest.approx(1516.0)
    assert t[2] == pytest.approx(1531.263693, abs=1e-6)
    assert t[10] == pytest.approx(1631.21598, abs=1e-5)


def test_elo_table_two_levels_match_direct_fold(spark):
    # many chunks: the two-level expansion must equal the plain recurrence
    t = {r["n"]: r["rating"] for r in H.elo_table(spark, 5000).collect()}
    r = 1500.0
    for n in range(1, 5001):
        r = r + 32 * (1 - 1 / (1 + 10 ** ((1500 - r) / 400)))
        if n in (1, 64, 65, 1000, 4999, 5000):
            assert t[n] == pytest.approx(r, rel=1e-12)
    assert len(t) == 5000


def test_mode_smallest_among_ties(spark):
    df = spark.createDataFrame([(3,), (3,), (1,), (1,), (2,), (None,)], "v int")
    out = C.impute(df, {"v": "mode"}).collect()
    assert sorted(r[0] for r in out) == [1, 1, 1, 2, 3, 3]


def test_average_rank(spark):
    df = spark.createDataFrame([(1, 3.0), (2, 3.0), (3, 1.0)], "id int, v double")
    got = {r["id"]: r["avg_rank"] for r in average_rank(df, "v").collect()}
    assert got == {1: 2.5, 2: 2.5, 3: 1.0}


def test_quality_score_formula(spark):
    # 100 rows; rows 90..99 repeat rows 0..9 except row 0 (planted nulls differ): 9 duplicates;
    # const and c are constant (Problem; c has one value besides nulls), b has a few nulls (Warning)
    rows = [(i % 90, "k", None if i % 50 == 0 else i % 90, None if i % 40 == 0 else "a") for i in range(100)]
    df = spark.createDataFrame(rows, "a int, const string, b int, c string")
    s = Q.quality_score(df).first()
    assert s["duplicate_rows"] == 9
    assert (s["problems"], s["warnings"]) == (2, 1)
    expected = max(5, int(100 - 9 / 100 * 15 - 5 * 2 - 2.5 * 1))
    assert expected == 86
    assert s["quality_score"] == expected
    assert 5 <= s["quality_score"] <= 100


def test_roles(spark):
    df = spark.createDataFrame([("a", 700, 30), ("b", 500, 20), ("c", 300, 0), ("d", 10, 1), ("e", 0, 0)],
                               "p string, r int, w int")
    got = [r[0] for r in df.select(P.assign_role("p", "r", "w")).collect()]
    assert got == ["All-Rounder", "Bowler", "Batter", "Bowler", "Batter"]


def test_best_figures(spark):
    log = spark.createDataFrame(
        [(1, 1, "out", 20), (1, 1, "out", 0), (1, 1, "out", 0), (1, 2, "out", 25), (1, 2, "out", 0),
         (1, 2, "out", 0), (1, 3, "out", 5), (1, 3, "out", 0)], "bowler long, match_id long, dismissal string, runs int")
    assert A.best_figures(log).first()["best_bowling"] == "3/20"


def test_clamp_forecast_and_zero_guards(spark):
    df = spark.createDataFrame([(71.6, 80)], "p double, r int")
    assert df.select(H.clamp_forecast(F.col("p"), F.col("r"))).first()[0] == 80
    bowl = spark.createDataFrame([(1, 1, 42.0)] * 60, "bowler int, w int, r double")
    f = A.bowler_form(bowl, wicket_flag=F.lit(0), runs=F.col("r") / 60).first()
    assert f["average"] == pytest.approx(42.0)
    const = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    assert [r[0] for r in PR.scale_standard(const, ["x"]).collect()] == [0.0, 0.0]
    assert [r[0] for r in PR.scale_minmax(const, ["x"]).collect()] == [0.0, 0.0]


def test_distribution_tails_textbook():
    # two-sided t: t=2.228, df=10 -> 0.05 ; F(3, 20) = 3.10 -> 0.05 ; chi2(1) = 3.841 -> 0.05
    assert dist.t_two_sided_p(2.228, 10) == pytest.approx(0.05, abs=2e-4)
    assert dist.f_upper_p(3.10, 3, 20) == pytest.approx(0.05, abs=5e-4)
    assert dist.chi2_upper_p(3.841, 1) == pytest.approx(0.05, abs=2e-4)
    assert dist.chi2_upper_p(18.307, 10) == pytest.approx(0.05, abs=2e-4)


def test_chi_square_yates_2x2(spark):
    rows = [("a", "x")] * 10 + [("a", "y")] * 20 + [("b", "x")] * 30 + [("b", "y")] * 40
    df = spark.createDataFrame(rows, "p string, q string")
    r = B.chi_square(df, "p", "q").first()
    # hand computation with Yates: expected 12, 18, 28, 42
    exp = {("a", "x"): 12, ("a", "y"): 18, ("b", "x"): 28, ("b", "y"): 42}
    obs = {("a", "x"): 10, ("a", "y"): 20, ("b", "x"): 30, ("b", "y"): 40}
    chi = sum((abs(obs[k] - exp[k]) - 0.5) ** 2 / exp[k] for k in exp)
    assert r["dof"] == 1 and r["chi2"] == pytest.approx(chi)
    assert r["p_value"] == pytest.approx(dist.chi2_upper_p(chi, 1))


def test_pearson_p_value(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=200)
    y = 0.3 * x + rng.normal(size=200)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    r = B.pearson(df, "x", "y").first()
    rn = float(np.corrcoef(x, y)[0, 1])
    t = rn * math.sqrt(198 / (1 - rn * rn))
    assert r["r"] == pytest.approx(rn)
    assert r["p_value"] == pytest.approx(dist.t_two_sided_p(t, 198))


def test_running_totals_hot_key_matches_brute_force(spark):
    # one key holds most rows: blocks must split it and still give exact prefix sums
    rows = [(0 if i % 10 < 7 else i % 10, i, i % 3) for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, t long, v int")
    got = {r["t"]: r["s"] for r in running_totals(df, ["k"], ["t"], {"s": F.col("v")}, n_blocks=16).collect()}
    acc = {}
    for k, t, v in rows:
        assert got[t] == acc.get(k, 0)
        acc[k] = acc.get(k, 0) + v


def test_h2h_no_look_ahead_brute_force(spark):
    rows = [(i, i // 2, i % 4, (i * 7) % 4, (i * 3) % 4) for i in range(200)]
    df = spark.createDataFrame(rows, "match_id long, ts long, side_a int, side_b int, winner int") \
              .filter(F.col("side_a") != F.col("side_b"))
    data = sorted(df.collect(), key=lambda r: (r["ts"], r["match_id"]))
    got = {r["match_id"]: r["h2h_prior_wins"] for r in H.h2h_prior_wins(df).collect()}
    for i, r in enumerate(data):
        pair = {r["side_a"], r["side_b"]}
        exp = sum(1 for p in data[:i] if {p["side_a"], p["side_b"]} == pair and p["winner"] == r["side_a"])
        assert got[r["match_id"]] == exp


def test_split_sizes_exact_and_disjoint(spark):
    df = spark.range(1003).withColumnRenamed("id", "rid")
    s = PR.train_test_split(df, "rid", 0.2)
    c = {r["split"]: r["count"] for r in s.groupBy("split").count().collect()}
    assert c == {"test": 200, "train": 803}
    s2 = PR.train_test_split(df, "rid", 0.2, rounding="ceil")
    assert s2.filter("split = 'test'").count() == 201


def test_crosstab_percents_sum_to_100(spark):
    rows = [("a", "x")] * 3 + [("a", "y")] + [("b", "y")] * 2
    ct = B.crosstab(spark.createDataFrame(rows, "p string, q string"), "p", "q")
    inner = ct.filter("row_pct IS NOT NULL")
    assert inner.agg(F.sum("total_pct")).first()[0] == pytest.approx(100.0)
    assert ct.filter("p = 'Total' AND q = 'Total'").first()["count"] == 6


def test_pca_explained_closed_form(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 2)) @ np.array([[2.0, 0.0], [1.0, 0.5]])
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "id long, a double, b double")
    from crease.operators.select import pca
    proj, ratios = pca(df, 2, id_col="id", cols=["a", "b"])
    ev = np.linalg.eigvalsh(np.cov(x.T))[::-1]
    got = [r["explained"] for r in ratios.orderBy("component").collect()]
    assert got == pytest.approx(list(ev / ev.sum()), rel=1e-6)
    assert proj.count() == 300


def test_silhouette_closed_form_vs_pairs(spark):
    rng = np.random.default_rng(3)
    pts = np.vstack([rng.normal(0, 1, (40, 2)), rng.normal(5, 1, (30, 2))])
    lab = [0] * 40 + [1] * 30
    df = spark.createDataFrame([(float(a), float(b), int(c)) for (a, b), c in zip(pts, lab)], "x double, y double, c int")
    got = E.silhouette_sq(df, ["x", "y"], "c").first()[0]
    d = ((pts[:, None, :] - pts[None, :, :]) ** 2).sum(-1)
    lab = np.array(lab)
    s = []
    for i in range(len(pts)):
        own = lab == lab[i]
        a = d[i, own].sum() / (own.sum() - 1)
        b = d[i, ~own].mean()
        s.append((b - a) / max(a, b))
    assert got == pytest.approx(float(np.mean(s)))


def test_dbscan_vs_brute_force(spark):
    from crease.operators.cluster import dbscan
    rng = np.random.default_rng(5)
    pts = np.vstack([rng.normal(0, 0.3, (60, 2)), rng.normal(3, 0.3, (50, 2)), rng.uniform(-2, 5, (20, 2))])
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(pts)], "id long, x double, y double")
    got = {r["id"]: (r["dbscan_cluster"], r["is_core"]) for r in dbscan(df, "id", ["x", "y"], 0.5, 5).collect()}
    d = np.sqrt(((pts[:, None, :] - pts[None, :, :]) ** 2).sum(-1))
    nb = d <= 0.5
    core = nb.sum(1) >= 5
    # components of core points
    lbl = {}
    for i in np.where(core)[0]:
        if i in lbl:
            continue
        stack, comp = [i], []
        lbl[i] = None
        while stack:
            j = stack.pop()
            comp.append(j)
            for k in np.where(nb[j] & core)[0]:
                if k not in lbl:
                    lbl[k] = None
                    stack.append(k)
        m = min(comp)
        for j in comp:
            lbl[j] = m
    order = sorted(set(lbl.values()))
    code = {v: i for i, v in enumerate(order)}
    for i in range(len(pts)):
        if core[i]:
            exp = code[lbl[i]]
        else:
            cs = [code[lbl[k]] for k in np.where(nb[i] & core)[0]]
            exp = min(cs) if cs else -1
        assert got[i] == (exp, bool(core[i]))


def test_knn_exact_vs_brute_force(spark):
    from crease.operators.cluster import knn_neighbours
    rng = np.random.default_rng(9)
    tr = rng.normal(size=(150, 2))
    te = np.vstack([rng.normal(size=(20, 2)), [[25.0, 25.0]]])  # one far-away point forces ring growth
    trd = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(tr)], "id long, x double, y double")
    ted = spark.createDataFrame([(1000 + i, float(a), float(b)) for i, (a, b) in enumerate(te)], "id long, x double, y double")
    got = {}
    for r in knn_neighbours(trd, ted, "id", ["x", "y"], k=5).collect():
        got.setdefault(r["test_id"], []).append((r["rank"], r["train_id"]))
    for i, p in enumerate(te):
        dd = np.sqrt(((tr - p) ** 2).sum(1))
        exp = [int(j) for j in np.lexsort((np.arange(len(tr)), dd))[:5]]
        assert [t for _, t in sorted(got[1000 + i])] == exp


def test_outlier_handling(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 5, 100]] + [(None,)], "x double")
    s = C.outliers_summary(df, "x").first()
    assert s["outlier_count"] == 1
    assert s["outlier_percentage"] == pytest.approx(round(100 / 7, 2))
    capped = [r[0] for r in C.handle_outliers(df, "x", "cap").collect()]
    assert capped[-1] is None and max(v for v in capped if v is not None) == pytest.approx(s["upper_bound"])
    assert C.handle_outliers(df, "x", "remove").count() == 6


@pytest.mark.parametrize("dims", [2, 3])
def test_dbscan_dense_cells_vs_all_pairs(spark, dims):
    """The dense-cell grid (no pairs inside a cell holding >= min_samples
    points) equals DBSCAN from all neighbour pairs, with one hot blob holding
    a third of the points, touching blobs, sparse bridges and noise."""
    from crease.operators.cluster import _dbscan_metric, dbscan
    rng = np.random.default_rng(11)
    pts = np.vstack([rng.normal(0, 0.05, (150, dims)), rng.normal(0.6, 0.15, (120, dims)),
                     rng.normal(2.5, 0.25, (100, dims)), np.linspace(0.6, 2.5, 12)[:, None] * np.ones((1, dims)),
                     rng.uniform(-1.5, 4, (68, dims))])
    rows = [(i, *map(float, p)) for i, p in enumerate(pts)]
    cols = [f"f{j}" for j in range(dims)]
    df = spark.createDataFrame(rows, "id long, " + ", ".join(f"{c} double" for c in cols))
    for eps, ms in [(0.3, 5), (0.2, 8)]:
        got = sorted(tuple(r) for r in dbscan(df, "id", cols, eps, ms).collect())
        want = sorted(tuple(r) for r in _dbscan_metric(df.withColumn("w", F.lit(1)), cols, eps, ms).collect())
        assert got == want
        assert len({c for _, c, _ in got if c >= 0}) >= 2

