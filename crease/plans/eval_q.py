"""Registered evaluation (E-series) and feature-selection (F-series) queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from crease.operators import evaluate as E
from crease.operators import select as S
from crease.plans.history_q import step_table
from crease.plans.registry import register, with_ctes
from crease.sources.fixtures import CONTESTS_SQL, DIRTY_ORDERS_SQL, contests, dirty_orders, table

R6 = 6


def _r(c):
    return F.round(c, R6).alias(c)


def _docs_labels(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "n_chars")
    return table(spark, sf, "labels").join(d, "doc_id").select(
        "doc_id", "quality", "n_chars", F.when(F.col("n_chars") > 2000, 1).otherwise(0).alias("pred"))


_DL = """dl AS (SELECT l.doc_id, l.quality, d.n_chars, CASE WHEN d.n_chars > 2000 THEN 1 ELSE 0 END AS pred
  FROM labels l JOIN documents d ON d.doc_id = l.doc_id)"""


#: Entries of an embedding.
DIMENSIONS = 64


def embedding_dims(spark, sf, dims=DIMENSIONS):
    e = table(spark, sf, "embeddings")
    return e.select("vec_id", F.col("label").cast("string").alias("label"),
                    *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(dims)])


_ALL = range(DIMENSIONS)
_EMB = "e AS (SELECT vec_id, CAST(label AS VARCHAR) AS c, " + \
    ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS x{i}" for i in _ALL) + " FROM embeddings)"


def _square(a, b):
    """Squared distance of two points or centroids, by their column prefixes."""
    return " + ".join(f"({a}{i} - {b}{i}) ^ 2" for i in _ALL)


def _screen_sql(column, numeric):
    missing = f"(COUNT(*) - COUNT({column})) * 100.0 / COUNT(*)"
    if numeric:
        tests = f"WHEN {missing} > 40 THEN 'missing' WHEN VAR_SAMP({column}) IS NULL OR VAR_SAMP({column}) < 0.001 THEN 'flat'"
    else:
        tests = (f"WHEN {missing} > 40 THEN 'missing' WHEN COUNT(DISTINCT {column}) <= 1 THEN 'constant' "
                 f"WHEN '{column}' LIKE '%id%' AND COUNT(DISTINCT {column}) = COUNT(*) THEN 'identifier'")
    variance = f"ROUND(VAR_SAMP({column}), 1)" if numeric else "NULL"
    return f"""SELECT feature, CASE WHEN reason = 'ok' THEN 'Select' ELSE 'Remove' END AS status, reason, variance, missing_percentage
FROM (SELECT '{column}' AS feature, CASE {tests} ELSE 'ok' END AS reason, {variance} AS variance,
  ROUND({missing}, 2) AS missing_percentage FROM dirty_orders)"""


@register("feature_screen", with_ctes(DIRTY_ORDERS_SQL, body="\nUNION ALL\n".join(
    _screen_sql(c, n) for c, n in (("o_orderkey", True), ("amount", True), ("priority", False), ("sparse", True), ("league", False)))))
def q_feature_screen(spark, sf):
    # variances near 1e10 agree across engines to ~15 digits: compare at 1 dp
    return S.feature_screen(dirty_orders(spark, sf), target="o_orderstatus").withColumn(
        "variance", F.round("variance", 1))


@register("mutual_information", """
WITH q AS (SELECT QUANTILE_CONT(o_totalprice, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS cuts FROM orders
  WHERE o_orderstatus IS NOT NULL),
coded AS (SELECT o_orderstatus AS y, CAST(LEN(LIST_FILTER(cuts, lambda c: c < o_totalprice)) AS VARCHAR) AS f_price,
  COALESCE(o_orderpriority, 'Missing_Val') AS f_priority FROM orders, q WHERE o_orderstatus IS NOT NULL),
long AS (SELECT 'o_totalprice' AS feature, f_price AS x, y FROM coded
  UNION ALL SELECT 'o_orderpriority', f_priority, y FROM coded),
j AS (SELECT feature, x, y, COUNT(*) AS nxy FROM long GROUP BY ALL),
t AS (SELECT j.*, SUM(nxy) OVER (PARTITION BY feature, x) AS nx, SUM(nxy) OVER (PARTITION BY feature, y) AS ny,
  SUM(nxy) OVER (PARTITION BY feature) AS n FROM j)
SELECT feature, ROUND(SUM(nxy / n * LN(nxy * n / (nx * ny))), 6) AS mutual_info,
  CASE WHEN SUM(nxy / n * LN(nxy * n / (nx * ny))) < 0.005 THEN 'Remove' ELSE 'Select' END AS status
FROM t GROUP BY feature""")
def q_mutual_information(spark, sf):
    m = S.mutual_information(table(spark, sf, "orders"), ["o_totalprice", "o_orderpriority"], "o_orderstatus")
    return m.select("feature", _r("mutual_info"), "status")


@register("target_correlation", """
SELECT 'l_quantity' AS feature, COALESCE(ROUND(CORR(l_quantity, l_extendedprice), 3), 0.0) AS correlation FROM lineitem
UNION ALL SELECT 'l_discount', COALESCE(ROUND(CORR(l_discount, l_extendedprice), 3), 0.0) FROM lineitem
UNION ALL SELECT 'l_tax', COALESCE(ROUND(CORR(l_tax, l_extendedprice), 3), 0.0) FROM lineitem""")
def q_target_correlation(spark, sf):
    return S.target_correlation(table(spark, sf, "lineitem"), ["l_quantity", "l_discount", "l_tax"], "l_extendedprice")


@register("pca")
def q_pca(spark, sf):
    proj, _ = S.pca(embedding_dims(spark, sf), k=3, id_col="vec_id", cols=[f"e{i}" for i in _ALL])
    return proj


@register("pca_explained")
def q_pca_explained(spark, sf):
    _, ratios = S.pca(embedding_dims(spark, sf), k=3, id_col="vec_id", cols=[f"e{i}" for i in _ALL])
    return ratios


@register("pca_2d_scaled")
def q_pca_2d_scaled(spark, sf):
    proj, _ = S.pca_2d_scaled(embedding_dims(spark, sf), [f"e{i}" for i in _ALL], id_col="vec_id")
    return proj


_STEPS = """steps AS (
  SELECT s.match_id, s.ov, SUM(d.runs) / (s.ov + 1) AS run_rate, MAX(m.team1_runs) AS final_score
  FROM (SELECT m.match_id, o.ov FROM mt m, range(0, 7) o(ov)) s
  JOIN deliveries d ON d.match_id = s.match_id AND d.innings = 1 AND d.over_no <= s.ov
  JOIN mt m ON m.match_id = s.match_id GROUP BY s.match_id, s.ov)"""


def _regression_sql():
    from crease.plans.history_q import _MT
    from crease.sources.fixtures import DELIVERIES_SQL
    return with_ctes(DELIVERIES_SQL, _MT, _STEPS, """p AS (SELECT final_score AS y, run_rate * 7 AS yhat FROM steps)""",
                     body="""
SELECT COUNT(*) AS n, ROUND(AVG(ABS(yhat - y)), 6) AS mae, ROUND(AVG((yhat - y) ^ 2), 4) AS mse,
  ROUND(SQRT(AVG((yhat - y) ^ 2)), 6) AS rmse, ROUND(1 - SUM((yhat - y) ^ 2) / (VAR_POP(y) * COUNT(*)), 6) AS r2,
  ROUND(1 - (SUM((yhat - y) ^ 2) / (VAR_POP(y) * COUNT(*))) * (COUNT(*) - 1) / (COUNT(*) - 2), 6) AS adj_r2
FROM p""")


@register("regression_metrics", _regression_sql())
def q_regression_metrics(spark, sf):
    s = step_table(spark, sf).withColumn("yhat", F.col("run_rate") * F.col("overs_limit"))
    m = E.regression_metrics(s, "final_score", "yhat", n_features=1)
    return m.select("n", _r("mae"), F.round("mse", 4).alias("mse"), _r("rmse"), _r("r2"), _r("adj_r2"))


@register("binary_metrics", with_ctes(_DL, body="""
SELECT COUNT(*) AS n, ROUND(AVG(CASE WHEN quality = pred THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
  ROUND(COALESCE(SUM(CASE WHEN quality = 1 AND pred = 1 THEN 1 ELSE 0 END) * 1.0 / NULLIF(SUM(pred), 0), 0), 6) AS precision,
  ROUND(COALESCE(SUM(CASE WHEN quality = 1 AND pred = 1 THEN 1 ELSE 0 END) * 1.0 / NULLIF(SUM(quality), 0), 0), 6) AS recall,
  ROUND(COALESCE(2.0 * SUM(CASE WHEN quality = 1 AND pred = 1 THEN 1 ELSE 0 END) / NULLIF(SUM(pred) + SUM(quality), 0), 0), 6) AS f1
FROM dl"""))
def q_binary_metrics(spark, sf):
    m = E.binary_metrics(_docs_labels(spark, sf), "quality", "pred")
    return m.select("n", *[_r(c) for c in ("accuracy", "precision", "recall", "f1")])


_REPORT = ["""cls AS (SELECT CAST(winner AS VARCHAR) AS c FROM contests WHERE winner IS NOT NULL
  UNION SELECT CAST(toss_winner AS VARCHAR) FROM contests WHERE toss_winner IS NOT NULL)""", """pc AS (
  SELECT c, (SELECT COUNT(*) FROM contests WHERE CAST(winner AS VARCHAR) = c) AS support,
    (SELECT COUNT(*) FROM contests WHERE CAST(toss_winner AS VARCHAR) = c) AS predicted,
    (SELECT COUNT(*) FROM contests WHERE CAST(winner AS VARCHAR) = c AND winner = toss_winner) AS tp FROM cls)""",
           """per AS (SELECT c, CASE WHEN predicted > 0 THEN tp * 1.0 / predicted ELSE 0.0 END AS p,
  CASE WHEN support > 0 THEN tp * 1.0 / support ELSE 0.0 END AS r, support FROM pc)""",
           """per2 AS (SELECT c, p, r, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END AS f, support FROM per)"""]


@register("macro_metrics", with_ctes(CONTESTS_SQL, *_REPORT, body="""
SELECT ROUND(AVG(p), 6) AS macro_precision, ROUND(AVG(r), 6) AS macro_recall, ROUND(AVG(f), 6) AS macro_f1 FROM per2"""))
def q_macro_metrics(spark, sf):
    m = E.macro_metrics(contests(spark, sf), "winner", "toss_winner")
    return m.select(*[_r(c) for c in ("macro_precision", "macro_recall", "macro_f1")])


@register("classification_report", with_ctes(CONTESTS_SQL, *_REPORT, body="""
SELECT c AS "row", ROUND(p, 6) AS precision, ROUND(r, 6) AS recall, ROUND(f, 6) AS f1, support FROM per2
UNION ALL SELECT 'accuracy', NULL, NULL,
  ROUND((SELECT COUNT(*) FROM contests WHERE winner = toss_winner) * 1.0 / (SELECT COUNT(*) FROM contests), 6),
  (SELECT COUNT(*) FROM contests)
UNION ALL SELECT 'macro avg', ROUND(AVG(p), 6), ROUND(AVG(r), 6), ROUND(AVG(f), 6), CAST(SUM(support) AS BIGINT) FROM per2
UNION ALL SELECT 'weighted avg', ROUND(SUM(p * support) / SUM(support), 6), ROUND(SUM(r * support) / SUM(support), 6),
  ROUND(SUM(f * support) / SUM(support), 6), CAST(SUM(support) AS BIGINT) FROM per2"""))
def q_classification_report(spark, sf):
    r = E.classification_report(contests(spark, sf), "winner", "toss_winner")
    return r.select("row", *[_r(c) for c in ("precision", "recall", "f1")], "support")


@register("roc_auc", with_ctes(_DL, """rk AS (SELECT quality,
  RANK() OVER (ORDER BY CAST(n_chars AS DOUBLE)) + (COUNT(*) OVER (PARTITION BY n_chars) - 1) / 2.0 AS r FROM dl
  WHERE n_chars IS NOT NULL AND quality IS NOT NULL)""", body="""
SELECT ROUND((SUM(CASE WHEN quality = 1 THEN r END) - SUM(quality) * (SUM(quality) + 1) / 2.0)
  / (SUM(quality) * (COUNT(*) - SUM(quality))), 6) AS auc, CAST(SUM(quality) AS BIGINT) AS n_pos,
  CAST(COUNT(*) - SUM(quality) AS BIGINT) AS n_neg FROM rk"""))
def q_roc_auc(spark, sf):
    a = E.roc_auc(_docs_labels(spark, sf), "quality", "n_chars")
    return a.select(_r("auc"), "n_pos", "n_neg")


_OVR_CLASSES = (("F", 997), ("O", 787), ("P", 613))
_OVR_SQL = with_ctes(*[f"""s{c} AS (SELECT CASE WHEN o_orderstatus = '{c}' THEN 1 ELSE 0 END AS pos,
  RANK() OVER (ORDER BY s) + (COUNT(*) OVER (PARTITION BY s) - 1) / 2.0 AS r
  FROM (SELECT o_orderstatus, CAST(o_orderkey * {m} % 1009 AS DOUBLE) AS s FROM orders) x)""" for c, m in _OVR_CLASSES],
                     *[f"""a{c} AS (SELECT (SUM(CASE WHEN pos = 1 THEN r END) - SUM(pos) * (SUM(pos) + 1) / 2.0)
  / (SUM(pos) * (COUNT(*) - SUM(pos))) AS auc FROM s{c})""" for c, _ in _OVR_CLASSES], body="""
SELECT ROUND((aF.auc + aO.auc + aP.auc) / 3, 6) AS macro_auc FROM aF, aO, aP""")


@register("roc_auc_ovr", _OVR_SQL)
def q_roc_auc_ovr(spark, sf):
    o = table(spark, sf, "orders").select("o_orderstatus", *[
        (F.col("o_orderkey") * m % 1009).cast("double").alias(f"s{c}") for c, m in _OVR_CLASSES])
    return E.roc_auc_ovr(o, "o_orderstatus", {c: f"s{c}" for c, _ in _OVR_CLASSES}).select(_r("macro_auc"))


@register("roc_curve", with_ctes(_DL, """g AS (SELECT CAST(n_chars AS DOUBLE) AS t, SUM(quality) AS p, COUNT(*) AS c FROM dl
  WHERE n_chars IS NOT NULL GROUP BY 1)""", body="""
SELECT t AS threshold, ROUND(SUM(c - p) OVER (ORDER BY t DESC) * 1.0 / (SELECT SUM(c - p) FROM g), 6) AS fpr,
  ROUND(SUM(p) OVER (ORDER BY t DESC) * 1.0 / (SELECT SUM(p) FROM g), 6) AS tpr FROM g"""))
def q_roc_curve(spark, sf):
    c = E.roc_curve(_docs_labels(spark, sf), "quality", "n_chars")
    return c.select("threshold", _r("fpr"), _r("tpr"))


@register("confusion_matrix", with_ctes(CONTESTS_SQL, """lv AS (SELECT CAST(winner AS VARCHAR) AS v FROM contests
  WHERE winner IS NOT NULL UNION SELECT CAST(toss_winner AS VARCHAR) FROM contests WHERE toss_winner IS NOT NULL)""",
                                        body="""
SELECT a.v AS actual, p.v AS predicted,
  (SELECT COUNT(*) FROM contests WHERE CAST(winner AS VARCHAR) = a.v AND CAST(toss_winner AS VARCHAR) = p.v) AS count
FROM lv a, lv p"""))
def q_confusion_matrix(spark, sf):
    return E.confusion_matrix(contests(spark, sf), "winner", "toss_winner")


@register("silhouette_sq", with_ctes(_EMB, """pr AS (SELECT a.vec_id, a.c, b.c AS c2,
  """ + _square("a.x", "b.x") + """ AS d FROM e a JOIN e b ON a.vec_id <> b.vec_id)""",
                                     """per AS (SELECT vec_id, c, c2, AVG(d) AS md FROM pr GROUP BY 1, 2, 3)""",
                                     """pt AS (SELECT vec_id, MAX(CASE WHEN c = c2 THEN md END) AS a,
  MIN(CASE WHEN c <> c2 THEN md END) AS b FROM per GROUP BY vec_id)""", body="""
SELECT ROUND(AVG(CASE WHEN a IS NULL THEN 0.0 ELSE (b - a) / GREATEST(a, b) END), 6) AS silhouette_sq FROM pt"""))
def q_silhouette_sq(spark, sf):
    s = E.silhouette_sq(embedding_dims(spark, sf), [f"e{i}" for i in _ALL], "label")
    return s.select(_r("silhouette_sq"))


@register("davies_bouldin", with_ctes(_EMB, "cent AS (SELECT c, " + ", ".join(f"AVG(x{i}) m{i}" for i in _ALL) + " FROM e GROUP BY c)",
                                      """s AS (SELECT e.c, AVG(SQRT(""" + _square("x", "m") + """)) AS s
  FROM e JOIN cent USING (c) GROUP BY e.c)""", """cs AS (SELECT * FROM cent JOIN s USING (c))""", body="""
SELECT ROUND(AVG(r), 6) AS davies_bouldin FROM (
  SELECT a.c, MAX((a.s + b.s) / SQRT(""" + _square("a.m", "b.m") + """)) AS r
  FROM cs a JOIN cs b ON a.c <> b.c GROUP BY a.c) t"""))
def q_davies_bouldin(spark, sf):
    d = E.davies_bouldin(embedding_dims(spark, sf), [f"e{i}" for i in _ALL], "label")
    return d.select(_r("davies_bouldin"))


def _pairs_sql():
    from crease.plans.history_q import _MT
    from crease.sources.fixtures import DELIVERIES_SQL
    return with_ctes(DELIVERIES_SQL, _MT, _STEPS, """p AS (SELECT match_id * 10 + ov AS row_id, final_score, run_rate * 7 AS yhat
  FROM steps)""", body="""
SELECT row_id, CAST(final_score AS DOUBLE) AS final_score, ROUND(yhat, 6) AS yhat,
  (SELECT CAST(LEAST(MIN(final_score), MIN(yhat)) AS DOUBLE) FROM p) AS lo,
  (SELECT ROUND(GREATEST(MAX(final_score), MAX(yhat)), 6) FROM p) AS hi
FROM p ORDER BY ((row_id % 1000003 + 42) * 2654435761) % 1000003, row_id LIMIT 500""")


@register("pred_vs_actual", _pairs_sql())
def q_pred_vs_actual(spark, sf):
    s = step_table(spark, sf).withColumn("yhat", F.col("run_rate") * F.col("overs_limit")) \
                            .withColumn("row_id", F.col("match_id") * 10 + F.col("over"))
    pts, bounds = E.pred_vs_actual(s, "final_score", "yhat", "row_id")
    return pts.crossJoin(bounds).select("row_id", F.col("final_score").cast("double"), _r("yhat"),  # one row of bounds
                                        F.round(F.col("lo").cast("double"), 6).alias("lo"), F.round("hi", 6).alias("hi"))
