"""Registered model, tuning and clustering queries (L-series, E8-E15).

Clustering and neighbour queries have brute-force DuckDB oracles; fitted-model
queries return metric tables and are checked by rows (their numbers cannot equal
another library's solvers)."""

from __future__ import annotations

from pyspark.sql import functions as F

from crease.operators import cluster as K
from crease.operators import models as M
from crease.operators.history import elo_rating
from crease.operators.prepare import scale_standard, train_test_split
from crease.plans.eval_q import DIMENSIONS, _square, embedding_dims
from crease.plans.history_q import FEATURE_COLS, FEATURES_SQL, STEP_BODY, STEP_CTES, match_feature_table, step_table
from crease.plans.linear_sql import solve_ctes, value
from crease.plans.registry import register, with_ctes
from crease.session import checkpoint_dir
from crease.sources.fixtures import contests

R6 = 6
STEP_FEATURES = ["over", "cum_runs", "cum_wickets", "run_rate", "venue_enc", "overs_limit", "season_idx"]
DIMS = [f"e{i}" for i in range(DIMENSIONS)]


#: Rows of a partition of a training table; the fits hold theirs in memory, widened.
PART_ROWS = 500_000


def _spread(df, rows: int):
    """``df`` dealt over enough partitions for its ``rows``; a small table stays as it is."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // PART_ROWS))) if rows > PART_ROWS else df


def _reg_split(spark, sf):
    """Step-feature training table with its split, lineage cut by a reliable
    checkpoint (the fit loops below run many jobs over it)."""
    checkpoint_dir(spark)
    s = step_table(spark, sf).withColumn("row_id", F.col("match_id") * 10 + F.col("over"))
    s = s.withColumn("final_score", F.col("final_score").cast("double")).checkpoint()
    return _spread(train_test_split(s, "row_id", 0.2, rounding="ceil"), s.count()).checkpoint()


def _cls_split(spark, sf):
    """Match-feature training table (stratified split), checkpointed."""
    checkpoint_dir(spark)
    f = match_feature_table(spark, sf).withColumn("a_won", F.col("a_won").cast("double")).checkpoint()
    return _spread(train_test_split(f, "match_id", 0.2, rounding="ceil", label="a_won"), f.count()).checkpoint()


def _fit_one(kind: str, name: str):
    def q(spark, sf):
        d = _reg_split(spark, sf) if kind == "regression" else _cls_split(spark, sf)
        feats, label = (STEP_FEATURES, "final_score") if kind == "regression" else (FEATURE_COLS, "a_won")
        tr, te = d.filter(F.col("split") == "train"), d.filter(F.col("split") == "test")
        metrics, _ = M.fit_many_compare(tr, te, feats, label, kind, [name])
        return metrics
    return q


# The step table, its split, and the position of the training rows in hash order.
_STEP_SPLIT = [*STEP_CTES, f"""steps AS (SELECT match_id * 10 + over AS row_id, CAST(final_score AS DOUBLE) AS y,
  {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in STEP_FEATURES)} FROM ({STEP_BODY}))""",
               """hashed AS (SELECT *, ((row_id % 1000003 + 42) * 2654435761) % 1000003 AS h, COUNT(*) OVER () AS total FROM steps)""",
               """sp AS (SELECT *, CASE WHEN ROW_NUMBER() OVER (ORDER BY h, row_id) - 1 < CEIL(total * 0.2) THEN 'test' ELSE 'train' END AS split
  FROM hashed)""",
               """tr AS (SELECT *, (ROW_NUMBER() OVER (ORDER BY h, row_id) - 1) % 5 AS fold FROM sp WHERE split = 'train')"""]


def _linear_metrics_sql(name: str, alpha: str) -> str:
    p = len(STEP_FEATURES)
    return with_ctes(*_STEP_SPLIT, *solve_ctes("fit", "tr", STEP_FEATURES, "y", alpha=alpha),
                     f"e AS (SELECT {value(STEP_FEATURES)} - y AS e, y FROM sp, fit WHERE split = 'test')",
                     "s AS (SELECT COUNT(*) AS n, AVG(ABS(e)) AS mae, AVG(e * e) AS mse, 1 - SUM(e * e) / (VAR_POP(y) * COUNT(*)) AS r2 FROM e)",
                     body=f"""SELECT '{name}' AS model, ROUND(mae, 6) AS mae, ROUND(mse, 6) AS mse, ROUND(SQRT(mse), 6) AS rmse,
  ROUND(r2, 6) AS r2, ROUND(1 - (1 - r2) * (n - 1) / (n - {p} - 1), 6) AS adj_r2, TRUE AS best FROM s""")


def _q_linear(name: str):
    def q(spark, sf):
        out = _fit_one("regression", name)(spark, sf)
        return out.select("model", *[F.round(c, R6).alias(c) for c in ("mae", "mse", "rmse", "r2", "adj_r2")], "best")
    return q


register("linear_regression", _linear_metrics_sql("linear", "0.0"))(_q_linear("linear"))
register("ridge", _linear_metrics_sql("ridge", "1.0"))(_q_linear("ridge"))

for _name, _key in [("lasso", "lasso"), ("dt_regressor", "dt"), ("random_forest_regressor", "rf"),
                    ("gradient_boosting_regressor", "gb"), ("xgboost_like_regressor", "xgb"), ("adaboost_regressor", "ada")]:
    register(_name)(_fit_one("regression", _key))

for _name, _key in [("logistic", "logistic"), ("dt_classifier", "dt"), ("bagging", "bag"),
                    ("random_forest", "rf"), ("gradient_boosting", "gb"), ("xgboost_like", "xgb")]:
    register(_name)(_fit_one("classification", _key))


def _gaussian_nb_sql():
    """Gaussian naive Bayes in closed form: class priors, per-class means and
    population variances on the train split, variances smoothed by 1e-9 x the
    largest feature variance, arg-max of the log joint on the test split."""
    h = "((match_id % 1000003 + 42) * 2654435761) % 1000003"
    fs = FEATURE_COLS
    stats = ",\n    ".join(f"AVG(CAST({c} AS DOUBLE)) AS m_{c}, VAR_POP(CAST({c} AS DOUBLE)) AS v_{c}" for c in fs)
    ll = "\n      ".join(f"- 0.5 * LN(2 * PI() * (st.v_{c} + e.eps)) - POW(t.{c} - st.m_{c}, 2) / (2 * (st.v_{c} + e.eps))"
                          for c in fs)
    return f"""
WITH feat AS ({FEATURES_SQL}),
sp AS (SELECT *, CASE WHEN ROW_NUMBER() OVER (PARTITION BY a_won ORDER BY {h}, match_id) - 1
                          < CEIL(COUNT(*) OVER (PARTITION BY a_won) * 0.2) THEN 'test' ELSE 'train' END AS split
       FROM feat),
st AS (SELECT a_won AS cls, COUNT(*) * 1.0 / SUM(COUNT(*)) OVER () AS prior,
    {stats}
  FROM sp WHERE split = 'train' GROUP BY a_won),
e AS (SELECT 1e-9 * GREATEST({", ".join(f"VAR_POP(CAST({c} AS DOUBLE))" for c in fs)}) AS eps
      FROM sp WHERE split = 'train'),
ll AS (SELECT t.match_id, t.a_won, st.cls, LN(st.prior)
      {ll} AS ll
  FROM sp t CROSS JOIN st CROSS JOIN e WHERE t.split = 'test'),
pred AS (SELECT match_id, a_won, ARG_MAX(cls, ll) AS p FROM ll GROUP BY match_id, a_won),
c AS (SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE a_won = p) AS ok,
        COUNT(*) FILTER (WHERE a_won = 1 AND p = 1) AS tp, COUNT(*) FILTER (WHERE a_won <> 1 AND p = 1) AS fp,
        COUNT(*) FILTER (WHERE a_won = 1 AND p <> 1) AS fn FROM pred),
r AS (SELECT n, ok * 1.0 / n AS accuracy,
        CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp * 1.0 / (tp + fp) END AS precision,
        CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp * 1.0 / (tp + fn) END AS recall FROM c)
SELECT 'nb' AS model, accuracy, precision, recall,
  CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM r"""


@register("gaussian_nb", _gaussian_nb_sql())
def q_gaussian_nb(spark, sf):
    return _fit_one("classification", "nb")(spark, sf).select("model", "accuracy", "precision", "recall", "f1")


@register("fit_many_compare")
def q_fit_many_compare(spark, sf):
    d = _reg_split(spark, sf)
    tr, te = d.filter(F.col("split") == "train"), d.filter(F.col("split") == "test")
    metrics, _ = M.fit_many_compare(tr, te, STEP_FEATURES, "final_score", "regression")
    return metrics


@register("fit_many_classification")
def q_fit_many_classification(spark, sf):
    """Which side wins: the comparison table of the two-class models."""
    d = _cls_split(spark, sf)
    tr, te = d.filter(F.col("split") == "train"), d.filter(F.col("split") == "test")
    metrics, _ = M.fit_many_compare(tr, te, FEATURE_COLS, "a_won", "classification")
    return metrics


@register("fit_many_multiclass")
def q_fit_many_multiclass(spark, sf):
    """Which of all sides wins: the comparison table with macro metrics."""
    d = _cls_split(spark, sf).filter(F.col("winner").isNotNull()).withColumn("won_by", F.col("winner").cast("double"))
    tr, te = d.filter(F.col("split") == "train"), d.filter(F.col("split") == "test")
    metrics, _ = M.fit_many_compare(tr, te, FEATURE_COLS, "won_by", "multiclass")
    return metrics


@register("svm_rbf")
def q_svm_rbf(spark, sf):
    from crease.operators.evaluate import binary_metrics
    d = _cls_split(spark, sf)
    tr, te = d.filter(F.col("split") == "train"), d.filter(F.col("split") == "test")
    m = M.svm_rbf(tr, FEATURE_COLS, "a_won")
    return binary_metrics(m.transform(te), "a_won", "prediction", positive=1.0)


@register("adaboost")
def q_adaboost(spark, sf):
    from crease.operators.evaluate import binary_metrics
    d = _cls_split(spark, sf)
    tr, te = d.filter(F.col("split") == "train"), d.filter(F.col("split") == "test")
    m = M.adaboost(tr, FEATURE_COLS, "a_won", n_estimators=100, learning_rate=0.1)
    return binary_metrics(m.transform(te), "a_won", "prediction", positive=1.0)


@register("stacking")
def q_stacking(spark, sf):
    from crease.operators.evaluate import binary_metrics
    d = _cls_split(spark, sf)
    tr, te = d.filter(F.col("split") == "train"), d.filter(F.col("split") == "test")
    m = M.stacking(tr, FEATURE_COLS, "a_won", "match_id")
    return binary_metrics(m.transform(te), "a_won", "prediction", positive=1.0)


@register("batch_score")
def q_batch_score(spark, sf):
    d = _reg_split(spark, sf)
    tr, te = d.filter(F.col("split") == "train"), d.filter(F.col("split") == "test")
    _, models = M.fit_many_compare(tr, te, STEP_FEATURES, "final_score", "regression")
    return M.batch_score(models, te, ["row_id", "final_score"])


def _coefficients_sql(digits: int = 5, more: str = "") -> str:
    rows = [f"SELECT '{c}' AS feature, ROUND(w{i}, {digits}) + 0.0 AS coefficient{more} FROM fit" for i, c in enumerate(STEP_FEATURES)]
    return " UNION ALL ".join([*rows, f"SELECT '(intercept)', ROUND(intercept, {digits}) + 0.0{more} FROM fit"])


def _rounded(coefficients, digits: int = 5):
    return coefficients.withColumn("coefficient", F.round("coefficient", digits) + F.lit(0.0))


@register("batch_score_classes")
def q_batch_score_classes(spark, sf):
    """Cases scored by every two-class model, with class names and all probabilities."""
    d = _cls_split(spark, sf)
    tr, te = d.filter(F.col("split") == "train"), d.filter(F.col("split") == "test")
    _, models = M.fit_many_compare(tr, te, FEATURE_COLS, "a_won", "classification")
    return M.batch_score(models, te, ["match_id", "a_won"], ["side b or none", "side a"])


@register("model_persist", with_ctes(*_STEP_SPLIT, *solve_ctes("fit", "tr", STEP_FEATURES, "y"), body=_coefficients_sql()))
def q_model_persist(spark, sf):
    import uuid
    d = _reg_split(spark, sf)
    tr = d.filter(F.col("split") == "train")
    model = M.fit_pipeline(tr, STEP_FEATURES, "final_score", M.regressors(1)["linear"])
    path = f"{checkpoint_dir(spark).rstrip('/')}/model-{uuid.uuid4().hex}"
    back = M.model_persist(model, path)
    return _rounded(M.coefficients(back, STEP_FEATURES))


@register("model_artefact")
def q_model_artefact(spark, sf):
    """Boosted classifier saved with its contract, loaded back, and the test cases scored by name."""
    import uuid

    from crease.operators.artefact import Artefact
    d = _cls_split(spark, sf)
    model = M.fit_pipeline(d.filter(F.col("split") == "train"), FEATURE_COLS, "a_won", M.classifiers(1)["gb"])
    path = f"{checkpoint_dir(spark).rstrip('/')}/artefact-{uuid.uuid4().hex}"
    Artefact(model, FEATURE_COLS, ["side b or none", "side a"]).save(spark, path)
    return Artefact.load(spark, path).score(d.filter(F.col("split") == "test"), ["match_id"]) \
        .select("match_id", "label", F.col("probability")[1].alias("probability_a"))


@register("coefficients")
def q_coefficients(spark, sf):
    d = _reg_split(spark, sf)
    tr = d.filter(F.col("split") == "train")
    model = M.fit_pipeline(tr, STEP_FEATURES, "final_score", M.regressors(tr.count())["lasso"])
    c = M.coefficients(model, STEP_FEATURES)
    return c.withColumn("zeroed", F.abs("coefficient") < 1e-10)


@register("cross_validate")
def q_cross_validate(spark, sf):
    f = _cls_split(spark, sf).filter(F.col("split") == "train")
    return M.cross_validate(f, FEATURE_COLS, "a_won", M.classifiers(1)["dt"], "match_id", folds=5)


@register("grid_search")
def q_grid_search(spark, sf):
    f = _cls_split(spark, sf).filter(F.col("split") == "train")
    return M.search_classifiers(f, FEATURE_COLS, "a_won", "match_id", folds=5)


# The grid of the random search.
BOOST_GRID = {"rounds": [100, 200, 300, 400], "depth": [3, 5, 7], "rate": [0.01, 0.05, 0.1], "rows": [0.6, 0.8, 1.0]}


@register("random_search")
def q_random_search(spark, sf):
    f = _cls_split(spark, sf).filter(F.col("split") == "train")
    return M.boosted_search(f, FEATURE_COLS, "a_won", BOOST_GRID, "match_id", folds=5, sample=50)


def _cv_linear(kind):
    def q(spark, sf):
        d = _reg_split(spark, sf)
        tr = d.filter(F.col("split") == "train")
        alpha, model = M.regularised_cv(tr, STEP_FEATURES, "final_score", "row_id", kind)
        return _rounded(M.coefficients(model, STEP_FEATURES)).withColumn("alpha", F.lit(float(alpha)))
    return q


RIDGE_CV_SQL = with_ctes(
    *_STEP_SPLIT, "alphas AS (SELECT UNNEST([0.01, 0.1, 1.0, 10.0, 100.0])::DOUBLE AS alpha)",
    "jobs AS (SELECT tr.*, alpha, held FROM tr, alphas, range(5) AS f(held) WHERE fold <> held)",
    *solve_ctes("cv", "jobs", STEP_FEATURES, "y", ["alpha", "held"], "alpha"),
    f"""r2 AS (SELECT alpha, held, 1 - SUM(({value(STEP_FEATURES)} - y) ^ 2) / (VAR_POP(y) * COUNT(*)) AS r2
  FROM tr JOIN cv ON cv.held = tr.fold GROUP BY alpha, held)""",
    "best AS (SELECT alpha FROM r2 GROUP BY alpha ORDER BY AVG(r2) DESC, alpha LIMIT 1)",
    "chosen AS (SELECT tr.*, alpha FROM tr, best)",
    *solve_ctes("fit", "chosen", STEP_FEATURES, "y", ["alpha"], "alpha"), body=_coefficients_sql(more=", alpha"))
register("ridge_cv", RIDGE_CV_SQL)(_cv_linear("ridge"))
register("lasso_cv")(_cv_linear("lasso"))


@register("tree_rules")
def q_tree_rules(spark, sf):
    d = _cls_split(spark, sf)
    m = M.fit_pipeline(d.filter(F.col("split") == "train"), FEATURE_COLS, "a_won", M.classifiers(1)["dt"])
    return M.tree_rules(m, FEATURE_COLS, max_depth=3)


@register("learning_curve")
def q_learning_curve(spark, sf):
    d = _reg_split(spark, sf)
    return M.learning_curve(d, STEP_FEATURES, "final_score", M.regressors(1)["linear"], "row_id", folds=5)


@register("depth_sweep")
def q_depth_sweep(spark, sf):
    d = _cls_split(spark, sf)
    return M.depth_sweep(d.filter(F.col("split") == "train"), d.filter(F.col("split") == "test"), FEATURE_COLS, "a_won")


@register("feature_importance")
def q_feature_importance(spark, sf):
    d = _cls_split(spark, sf)
    m = M.fit_pipeline(d.filter(F.col("split") == "train"), FEATURE_COLS, "a_won", M.classifiers(1)["rf"])
    return M.feature_importance(m, FEATURE_COLS)


@register("permutation_importance")
def q_permutation_importance(spark, sf):
    d = _cls_split(spark, sf)
    tr, te = d.filter(F.col("split") == "train"), d.filter(F.col("split") == "test")
    m = M.fit_pipeline(tr, FEATURE_COLS, "a_won", M.classifiers(1)["dt"])
    return M.permutation_importance(m, te, FEATURE_COLS, "a_won", "match_id")


ATTRIBUTION_SQL = with_ctes(
    *_STEP_SPLIT, *solve_ctes("fit", "tr", STEP_FEATURES, "y"),
    "mean AS (SELECT " + ", ".join(f"AVG({c}) AS mean_{c}" for c in STEP_FEATURES) + " FROM sp)",
    body=" UNION ALL ".join(f"SELECT row_id, '{c}' AS feature, ROUND({c}, 6) AS value, ROUND(w{i} * ({c} - mean_{c}), 4) + 0.0 AS attribution "
                            "FROM sp, fit, mean" for i, c in enumerate(STEP_FEATURES)))


@register("attribution_dependence", ATTRIBUTION_SQL)
def q_attribution_dependence(spark, sf):
    d = _reg_split(spark, sf)
    m = M.fit_pipeline(d.filter(F.col("split") == "train"), STEP_FEATURES, "final_score", M.regressors(1)["linear"])
    return M.linear_attribution(m, d, STEP_FEATURES, ["row_id"]).withColumn("value", F.round("value", R6)) \
        .withColumn("attribution", F.round("attribution", 4) + F.lit(0.0))


def _attributed(spark, sf):
    from crease.operators.boost import attributions
    d = _reg_split(spark, sf)
    m = M.fit_pipeline(d.filter(F.col("split") == "train"), STEP_FEATURES, "final_score", M.regressors(1)["gb"])
    return attributions(m, d, ["row_id"])


@register("tree_attribution")
def q_tree_attribution(spark, sf):
    """Features of the boosted model by their mean absolute share of its predictions."""
    a = _attributed(spark, sf)
    means = a.agg(*[F.avg(F.abs(F.col("shares")[k])).alias(c) for k, c in enumerate(STEP_FEATURES)])  # one row
    return means.unpivot([], STEP_FEATURES, "feature", "mean_share").filter(F.col("mean_share").isNotNull())


@register("tree_attribution_sum", with_ctes(*_STEP_SPLIT, body="SELECT row_id, 0.0 AS gap FROM sp"))
def q_tree_attribution_sum(spark, sf):
    """By how much the shares and the bias of a row miss its prediction: by nothing."""
    total = F.aggregate("shares", F.col("bias"), lambda a, x: a + x)
    return _attributed(spark, sf).select("row_id", (F.round(total - F.col("margin"), R6) + F.lit(0.0)).alias("gap"))


@register("decision_grid")
def q_decision_grid(spark, sf):
    d = _cls_split(spark, sf)
    two = ["side_a_strength", "side_b_strength"]
    m = M.fit_pipeline(d.filter(F.col("split") == "train"), two, "a_won", M.classifiers(1)["dt"])
    return M.decision_grid(m, d, two[0], two[1]).select(*two, "prediction")


# ---------------------------------------------------------------------------
# clustering
# ---------------------------------------------------------------------------

# Neighbours of the vectors: no two of them are much nearer.
DBSCAN_EPS = 9.25


def _emb_scaled(spark, sf, dims=DIMS):
    """The scaled vectors, cut from their lineage: their readers run many jobs."""
    checkpoint_dir(spark)
    return scale_standard(embedding_dims(spark, sf, len(dims)), dims).checkpoint()


def _emb_z(n):
    each = lambda f: ", ".join(f(i) for i in range(n))
    return [f"e0 AS (SELECT vec_id, CAST(label AS VARCHAR) AS label, {each(lambda i: f'CAST(embedding[{i + 1}] AS DOUBLE) AS v{i}')} "
            "FROM embeddings)",
            f"st AS (SELECT {each(lambda i: f'AVG(v{i}) m{i}, STDDEV_POP(v{i}) s{i}')} FROM e0)",
            f"e AS (SELECT vec_id AS id, label, {each(lambda i: f'(v{i} - m{i}) / s{i} AS x{i}')} FROM e0, st)"]


_EMB_Z = _emb_z(len(DIMS))
DBSCAN_SQL = "WITH RECURSIVE " + ",\n".join(_EMB_Z + [
    f"""pr AS (SELECT p.id AS a, q.id AS b FROM e p, e q WHERE {_square('p.x', 'q.x')} <= {DBSCAN_EPS * DBSCAN_EPS})""",
    """core AS (SELECT a AS id FROM pr GROUP BY a HAVING COUNT(*) >= 5)""",
    """ce AS (SELECT pr.a, pr.b FROM pr JOIN core c1 ON c1.id = pr.a JOIN core c2 ON c2.id = pr.b)""",
    """reach(id, r) AS (SELECT id, id FROM core UNION SELECT reach.id, ce.b FROM reach JOIN ce ON ce.a = reach.r)""",
    """comp AS (SELECT id, MIN(r) AS lbl FROM reach GROUP BY id)""",
    """codes AS (SELECT lbl, CAST(DENSE_RANK() OVER (ORDER BY lbl) - 1 AS INT) AS code FROM (SELECT DISTINCT lbl FROM comp) x)""",
    """cl AS (SELECT comp.id, codes.code FROM comp JOIN codes USING (lbl))""",
    """border AS (SELECT pr.a AS id, MIN(cl.code) AS code FROM pr JOIN cl ON cl.id = pr.b
  WHERE pr.a NOT IN (SELECT id FROM core) GROUP BY pr.a)"""]) + """
SELECT e.id AS vec_id, CAST(COALESCE(cl.code, border.code, -1) AS INT) AS dbscan_cluster, cl.id IS NOT NULL AS is_core
FROM e LEFT JOIN cl ON cl.id = e.id LEFT JOIN border ON border.id = e.id"""


@register("dbscan", DBSCAN_SQL)
def q_dbscan(spark, sf):
    return K.dbscan(_emb_scaled(spark, sf), "vec_id", DIMS, eps=DBSCAN_EPS, min_samples=5)


_SPLIT = """sp AS (SELECT *, ROW_NUMBER() OVER (ORDER BY ((id % 1000003 + 42) * 2654435761) % 1000003, id) - 1 AS pos,
  CEIL(COUNT(*) OVER () * 0.2) AS ntest FROM e)"""

KNN_SQL = with_ctes(*_EMB_Z, _SPLIT, """tr AS (SELECT * FROM sp WHERE pos >= ntest)""", """te AS (SELECT * FROM sp WHERE pos < ntest)""",
                    """nb AS (SELECT * FROM (SELECT t.id AS tid, r.id AS rid, r.label,
  ROW_NUMBER() OVER (PARTITION BY t.id ORDER BY SQRT(""" + _square("t.x", "r.x") + """), r.id) AS rk
  FROM te t, tr r) z WHERE rk <= 7)""", """v AS (SELECT tid, label, COUNT(*) AS n FROM nb GROUP BY tid, label)""", body="""
SELECT tid AS vec_id, CAST(FIRST(label ORDER BY n DESC, CAST(label AS DOUBLE)) AS DOUBLE) AS prediction,
  ROUND(MAX(n) / 7.0, 6) AS vote_share FROM v GROUP BY tid""")


@register("knn_classify", KNN_SQL)
def q_knn_classify(spark, sf):
    d = train_test_split(_emb_scaled(spark, sf).withColumn("label", F.col("label").cast("double")),
                         "vec_id", 0.2, rounding="ceil")
    tr, te = d.filter(F.col("split") == "train"), d.filter(F.col("split") == "test")
    k = K.knn_classify(tr, te, "vec_id", DIMS, "label", k=7)
    return k.select("vec_id", F.col("prediction").cast("double"), F.round("vote_share", R6).alias("vote_share"))


SIMILAR_SQL = with_ctes(*_EMB_Z, """q AS (SELECT label, MIN(id) AS qid FROM e GROUP BY label)""", body="""
SELECT query_id, similar_id, ROUND(dist, 6) AS dist, CAST(rk AS INT) AS rank FROM (
  SELECT q.qid AS query_id, m.id AS similar_id,
    SQRT(""" + _square("a.x", "m.x") + """) AS dist,
    ROW_NUMBER() OVER (PARTITION BY q.qid ORDER BY SQRT(""" + _square("a.x", "m.x") + """), m.id) AS rk
  FROM q JOIN e a ON a.id = q.qid JOIN e m ON m.label = a.label AND m.id <> a.id) t WHERE rk <= 5""")


@register("similar_entities", SIMILAR_SQL)
def q_similar_entities(spark, sf):
    z = _emb_scaled(spark, sf)
    queries = z.groupBy("label").agg(F.min("vec_id").alias("vec_id")).select("vec_id")
    s = K.similar_entities(z, "vec_id", DIMS, "label", queries, n=5)
    return s.withColumn("dist", F.round("dist", R6))


def _lloyd_ctes(models: str, turns: int) -> list[str]:
    """CTEs that end with ``last`` (k, seed, c, ctr): the centres of every model (k, seed) after ``turns`` steps."""
    xs = ", ".join(f"x{i}" for i in range(len(DIMS)))
    means = ", ".join(f"AVG(x[{i + 1}])" for i in range(len(DIMS)))
    return [f"p AS MATERIALIZED (SELECT id, [{xs}] AS x FROM e)", f"models AS (SELECT * FROM ({models}) AS t(k, seed))",
            """steps AS (SELECT 0 AS it, k, seed, c, x AS ctr FROM (
  SELECT models.*, p.x, ROW_NUMBER() OVER (PARTITION BY k, seed ORDER BY ((id % 1000003 + seed) * 2654435761) % 1000003, id) - 1 AS c
  FROM models, p) WHERE c < k
  UNION ALL SELECT it + 1, k, seed, c, [""" + means + f"""] FROM (
    SELECT it, k, seed, id, ANY_VALUE(x) AS x, ARG_MIN(c, list_distance(x, ctr)) AS c FROM steps, p GROUP BY it, k, seed, id)
  GROUP BY it, k, seed, c HAVING it < {turns})""", f"last AS (SELECT k, seed, c, ctr FROM steps WHERE it = {turns})",
            """dealt AS (SELECT k, seed, id, ARG_MIN(c, list_distance(x, ctr)) AS c, MIN(list_distance(x, ctr)) ^ 2 AS cost
  FROM last, p GROUP BY k, seed, id)"""]


KMEANS_SQL = "WITH RECURSIVE " + ",\n".join([*_EMB_Z, *_lloyd_ctes("SELECT 4, 42 + r FROM range(10) AS r(r)", 100),
    "best AS (SELECT seed FROM dealt GROUP BY seed ORDER BY ROUND(SUM(cost), 6), seed LIMIT 1)",
    "codes AS (SELECT c, ROW_NUMBER() OVER (ORDER BY MIN(id)) - 1 AS code FROM dealt JOIN best USING (seed) GROUP BY c)"]) + """
SELECT id AS vec_id, code::INT AS kmeans_cluster FROM dealt JOIN best USING (seed) JOIN codes USING (c)"""
ELBOW_SQL = "WITH RECURSIVE " + ",\n".join([*_EMB_Z, *_lloyd_ctes("SELECT k, 42 FROM range(2, 11) AS r(k)", 100)]) + """
SELECT k::INT AS k, ROUND(SUM(cost), 6) AS inertia FROM dealt GROUP BY k"""


@register("kmeans", KMEANS_SQL)
def q_kmeans(spark, sf):
    res, _ = K.kmeans(_emb_scaled(spark, sf), "vec_id", DIMS, k=4, restarts=10)
    return res.select("vec_id", "kmeans_cluster")


@register("elbow", ELBOW_SQL)
def q_elbow(spark, sf):
    return K.elbow(_emb_scaled(spark, sf), "vec_id", DIMS).withColumn("inertia", F.round("inertia", R6))


@register("cluster_batch")
def q_cluster_batch(spark, sf):
    return K.cluster_batch(elo_rating(contests(spark, sf)))


@register("group_mean_clusters")
def q_group_mean_clusters(spark, sf):
    from crease.operators.reports import group_mean_profile
    cb = K.cluster_batch(elo_rating(contests(spark, sf)))
    return group_mean_profile(cb, "kmeans_cluster", ["elo_rating", "match_count", "pom_count", "win_rate"])
