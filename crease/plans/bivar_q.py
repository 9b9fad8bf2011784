"""Registered bivariate queries (B-series).  p-values are not in the oracle
comparison (DuckDB has no t/F/chi-square CDF); they are unit-tested instead."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crease.operators import bivariate as B
from crease.plans.registry import register, with_ctes
from crease.sources.fixtures import table

R6 = 6
LI_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber", "l_net"]
_LI_SQL = "(SELECT *, l_extendedprice * (1 - l_discount) AS l_net FROM lineitem) li"


def _lineitem(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.withColumn("l_net", F.col("l_extendedprice") * (1 - F.col("l_discount")))


def _r(c):
    return F.round(c, R6).alias(c)


def _price_balance(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_totalprice")
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_acctbal")
    return o.join(c, "o_custkey")


_PB = """p AS (SELECT o.o_totalprice AS x, c.c_acctbal AS y FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
  WHERE o.o_totalprice IS NOT NULL AND c.c_acctbal IS NOT NULL)"""
_STRENGTH = """CASE WHEN ABS(r) >= 0.7 THEN 'Strong' WHEN ABS(r) >= 0.4 THEN 'Moderate' WHEN ABS(r) >= 0.2 THEN 'Weak'
  ELSE 'Very Weak / Negligible' END"""
_DIRECTION = """CASE WHEN r > 0.05 THEN 'Positive' WHEN r < -0.05 THEN 'Negative' ELSE 'Neutral / No Linear Direction' END"""


@register("pearson", with_ctes(_PB, """s AS (SELECT COUNT(*) AS n, CORR(x, y) AS r FROM p)""", body=f"""
SELECT n, ROUND(r, 6) AS r, ROUND(r * r, 6) AS r_squared, {_STRENGTH} AS strength, {_DIRECTION} AS direction,
  n >= 3 AS valid FROM s"""))
def q_pearson(spark, sf):
    p = B.pearson(_price_balance(spark, sf), "o_totalprice", "c_acctbal", with_p=False)
    return p.select("n", _r("r"), _r("r_squared"), "strength", "direction", "valid")


@register("spearman", with_ctes(_PB, """rk AS (
  SELECT RANK() OVER (ORDER BY x) + (COUNT(*) OVER (PARTITION BY x) - 1) / 2.0 AS rx,
         RANK() OVER (ORDER BY y) + (COUNT(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry FROM p)""", body="""
SELECT COUNT(*) AS n, ROUND(CORR(rx, ry), 6) AS rho FROM rk"""))
def q_spearman(spark, sf):
    s = B.spearman(_price_balance(spark, sf), "o_totalprice", "c_acctbal", with_p=False)
    return s.select("n", _r("rho"))


@register("covariance", with_ctes(_PB, body="SELECT ROUND(COVAR_SAMP(x, y), 4) AS covariance FROM p"))
def q_covariance(spark, sf):
    return B.covariance(_price_balance(spark, sf), "o_totalprice", "c_acctbal").select(
        F.round("covariance", 4).alias("covariance"))


@register("ols_line", with_ctes(_PB, body="""
SELECT ROUND(REGR_SLOPE(y, x), 9) AS slope, ROUND(REGR_INTERCEPT(y, x), 6) AS intercept,
  ROUND(REGR_R2(y, x), 6) AS r_squared, printf('y = %.4fx + %.4f', REGR_SLOPE(y, x), REGR_INTERCEPT(y, x)) AS equation
FROM p"""))
def q_ols_line(spark, sf):
    stats, _ = B.ols_line(_price_balance(spark, sf), "o_totalprice", "c_acctbal")
    return stats.select(F.round("slope", 9).alias("slope"), _r("intercept"), _r("r_squared"), "equation")


@register("ols_trend", with_ctes(_PB, """s AS (SELECT REGR_SLOPE(y, x) AS b, REGR_INTERCEPT(y, x) AS a, MIN(x) AS lo,
  MAX(x) AS hi FROM p)""", body="""
SELECT CAST(i AS INT) AS i, ROUND(lo + i * (hi - lo) / 99, 6) AS x, ROUND(a + b * (lo + i * (hi - lo) / 99), 6) AS y
FROM s, range(0, 100) t(i)"""))
def q_ols_trend(spark, sf):
    _, line = B.ols_line(_price_balance(spark, sf), "o_totalprice", "c_acctbal")
    return line.select(F.col("i").cast("int"), _r("x"), _r("y"))


def _corr_sql():
    parts = []
    for a in LI_COLS:
        for b in LI_COLS:
            if a == b:
                parts.append(f"SELECT '{a}' AS x, '{a}' AS y, CASE WHEN STDDEV_POP({a}) > 0 THEN 1.0 END AS r FROM {_LI_SQL}")
            else:
                parts.append(f"SELECT '{a}' AS x, '{b}' AS y, ROUND(CORR({a}, {b}), 6) AS r FROM {_LI_SQL}")
    return "\nUNION ALL\n".join(parts)


CORR_SQL = _corr_sql()


@register("correlation_matrix", CORR_SQL)
def q_correlation_matrix(spark, sf):
    m = B.correlation_matrix(_lineitem(spark, sf), LI_COLS)
    return m.select("x", "y", _r("r"))


@register("correlated_pairs", with_ctes(f"m AS ({CORR_SQL})", """u AS (SELECT x, y, ROUND(r, 3) AS r3, ABS(r) AS a
  FROM m WHERE x < y AND r IS NOT NULL)""", body="""
SELECT * FROM (SELECT 'positive' AS kind, x, y, r3 FROM u WHERE r3 > 0.1 ORDER BY r3 DESC, x, y LIMIT 5)
UNION ALL SELECT * FROM (SELECT 'negative', x, y, r3 FROM u WHERE r3 < -0.1 ORDER BY r3, x, y LIMIT 5)
UNION ALL SELECT 'collinear', x, y, r3 FROM u WHERE a > 0.8"""))
def q_correlated_pairs(spark, sf):
    m = B.correlation_matrix(_lineitem(spark, sf), LI_COLS).withColumn("r", F.round("r", R6))
    return B.correlated_pairs(m)


_OP = """d AS (SELECT o_orderpriority AS g, o_totalprice AS v FROM orders WHERE o_orderpriority IS NOT NULL
  AND o_totalprice IS NOT NULL)"""


@register("group_stats", with_ctes(_OP, body="""
SELECT g AS o_orderpriority, COUNT(v) AS count, ROUND(AVG(v), 6) AS mean, ROUND(MEDIAN(v), 6) AS median,
  ROUND(CASE WHEN COUNT(v) > 1 THEN STDDEV_SAMP(v) ELSE 0.0 END, 6) AS std, ROUND(MIN(v), 6) AS min,
  ROUND(MAX(v), 6) AS max, ROUND(QUANTILE_CONT(v, 0.25), 6) AS q1, ROUND(QUANTILE_CONT(v, 0.75), 6) AS q3
FROM d WHERE g IN (SELECT g FROM d GROUP BY g ORDER BY COUNT(*) DESC, g LIMIT 25) GROUP BY g"""))
def q_group_stats(spark, sf):
    g = B.group_stats(table(spark, sf, "orders"), "o_orderpriority", "o_totalprice")
    return g.select("o_orderpriority", "count", *[_r(c) for c in ("mean", "median", "std", "min", "max", "q1", "q3")])


@register("anova_oneway", with_ctes(_OP, """g AS (SELECT g, COUNT(v) AS n, AVG(v) AS m, VAR_POP(v) AS vp FROM d GROUP BY g)""",
                                    """t AS (SELECT SUM(n) AS nn, COUNT(*) AS k, SUM(n * m) / SUM(n) AS gm FROM g)""", body="""
SELECT k AS groups, nn AS n,
  ROUND((SUM(n * (m - gm) * (m - gm)) / (k - 1)) / (SUM(n * vp) / (nn - k)), 6) AS f_stat
FROM g, t GROUP BY k, nn"""))
def q_anova_oneway(spark, sf):
    a = B.anova_oneway(table(spark, sf, "orders"), "o_orderpriority", "o_totalprice", with_p=False)
    return a.select("groups", F.col("n").cast("long"), _r("f_stat"))


@register("kruskal_wallis", with_ctes(_OP, """r AS (
  SELECT g, v, RANK() OVER (ORDER BY v) + (COUNT(*) OVER (PARTITION BY v) - 1) / 2.0 AS rk FROM d)""",
                                      """rs AS (SELECT g, SUM(rk) AS rsum, COUNT(*) AS n FROM r GROUP BY g)""",
                                      """tt AS (SELECT SUM(CAST(c AS DOUBLE) ^ 3 - c) AS t FROM (SELECT COUNT(*) AS c FROM d GROUP BY v) x)""",
                                      body="""
SELECT COUNT(*) AS groups, SUM(n) AS n,
  ROUND((12.0 / (SUM(n) * (SUM(n) + 1)) * SUM(rsum * rsum / n) - 3 * (SUM(n) + 1))
        / (1 - MAX(tt.t) / (CAST(SUM(n) AS DOUBLE) ^ 3 - SUM(n))), 6) AS h_stat
FROM rs, tt"""))
def q_kruskal_wallis(spark, sf):
    k = B.kruskal_wallis(table(spark, sf, "orders"), "o_orderpriority", "o_totalprice", with_p=False)
    return k.select("groups", F.col("n").cast("long"), _r("h_stat"))


_PS = """d AS (SELECT o_orderpriority AS x, o_orderstatus AS y FROM orders WHERE o_orderpriority IS NOT NULL
  AND o_orderstatus IS NOT NULL)"""


def _with_total(orders):
    """Orders with a level that is named like a margin."""
    return orders.withColumn("o_orderpriority", F.when(F.col("o_orderkey") % 50 == 0, "Total").otherwise(F.col("o_orderpriority")))


@register("crosstab", with_ctes("""d AS (SELECT CASE WHEN o_orderkey % 50 = 0 THEN 'Total' ELSE o_orderpriority END AS x,
  o_orderstatus AS y FROM orders WHERE o_orderstatus IS NOT NULL AND (o_orderpriority IS NOT NULL OR o_orderkey % 50 = 0))""", """c AS (SELECT x, y, COUNT(*) AS cnt FROM d GROUP BY x, y)""", body="""
SELECT x AS o_orderpriority, y AS o_orderstatus, cnt AS count,
  ROUND(cnt * 100.0 / SUM(cnt) OVER (PARTITION BY x), 6) AS row_pct,
  ROUND(cnt * 100.0 / SUM(cnt) OVER (PARTITION BY y), 6) AS col_pct,
  ROUND(cnt * 100.0 / SUM(cnt) OVER (), 6) AS total_pct, FALSE AS margin FROM c
UNION ALL SELECT x, 'Total', SUM(cnt), NULL, NULL, NULL, TRUE FROM c GROUP BY x
UNION ALL SELECT 'Total', y, SUM(cnt), NULL, NULL, NULL, TRUE FROM c GROUP BY y
UNION ALL SELECT 'Total', 'Total', SUM(cnt), NULL, NULL, NULL, TRUE FROM c"""))
def q_crosstab(spark, sf):
    c = B.crosstab(_with_total(table(spark, sf, "orders")), "o_orderpriority", "o_orderstatus")
    return c.select("o_orderpriority", "o_orderstatus", "count", _r("row_pct"), _r("col_pct"), _r("total_pct"), "margin")


def _chi_sql(src: str, yates: bool) -> str:
    adj = ("ABS(COALESCE(o, 0) - e) - LEAST(0.5, ABS(COALESCE(o, 0) - e))" if yates else "ABS(COALESCE(o, 0) - e)")
    return with_ctes(src, """obs AS (SELECT x, y, COUNT(*) AS o FROM d GROUP BY x, y)""",
                     """rx AS (SELECT x, SUM(o) AS rx FROM obs GROUP BY x)""",
                     """cy AS (SELECT y, SUM(o) AS cy FROM obs GROUP BY y)""",
                     """t AS (SELECT SUM(o) AS n, COUNT(DISTINCT x) AS r, COUNT(DISTINCT y) AS c FROM obs)""",
                     f"""cells AS (SELECT rx.x, cy.y, obs.o, rx.rx * cy.cy / t.n AS e FROM rx CROSS JOIN cy
  LEFT JOIN obs ON obs.x = rx.x AND obs.y = cy.y CROSS JOIN t)""",
                     f"""s AS (SELECT SUM(({adj}) * ({adj}) / e) AS chi2 FROM cells)""", body="""
SELECT ROUND(chi2, 6) AS chi2, CAST((r - 1) * (c - 1) AS BIGINT) AS dof, n,
  ROUND(LEAST(1.0, GREATEST(0.0, SQRT(chi2 / (n * (LEAST(r, c) - 1))))), 6) AS cramers_v,
  CASE WHEN SQRT(chi2 / (n * (LEAST(r, c) - 1))) >= 0.5 THEN 'Very Strong Association'
       WHEN SQRT(chi2 / (n * (LEAST(r, c) - 1))) >= 0.3 THEN 'Strong Association'
       WHEN SQRT(chi2 / (n * (LEAST(r, c) - 1))) >= 0.15 THEN 'Moderate Association'
       WHEN SQRT(chi2 / (n * (LEAST(r, c) - 1))) >= 0.05 THEN 'Weak Association'
       ELSE 'Little to No Association' END AS strength
FROM s, t""")


@register("chi_square", _chi_sql(_PS, yates=False))
def q_chi_square(spark, sf):
    c = B.chi_square(table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus", with_p=False)
    return c.select(_r("chi2"), "dof", "n", _r("cramers_v"), "strength")


@register("chi_square_yates", _chi_sql("""d AS (SELECT CAST(quality AS VARCHAR) AS x, CAST(toxic AS VARCHAR) AS y
  FROM labels WHERE quality IS NOT NULL AND toxic IS NOT NULL)""", yates=True))
def q_chi_square_yates(spark, sf):
    c = B.chi_square(table(spark, sf, "labels"), "quality", "toxic", with_p=False)
    return c.select(_r("chi2"), "dof", "n", _r("cramers_v"), "strength")


@register("cramers_v", _chi_sql(_PS, yates=False).replace(
    "SELECT ROUND(chi2, 6) AS chi2, CAST((r - 1) * (c - 1) AS BIGINT) AS dof, n,\n  ", "SELECT "))
def q_cramers_v(spark, sf):
    c = B.chi_square(table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus", with_p=False)
    return c.select(_r("cramers_v"), "strength")


@register("top_combination", with_ctes(_PS, body="""
SELECT x AS o_orderpriority, y AS o_orderstatus, COUNT(*) AS count FROM d GROUP BY x, y
ORDER BY count DESC, x, y LIMIT 1"""))
def q_top_combination(spark, sf):
    return B.top_combination(table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus")


@register("box_by_category", with_ctes(_OP, """q AS (
  SELECT g, COUNT(v) AS n, MIN(v) AS min, QUANTILE_CONT(v, 0.25) AS q1, MEDIAN(v) AS median,
    QUANTILE_CONT(v, 0.75) AS q3, MAX(v) AS max FROM d GROUP BY g)""", body="""
SELECT g AS o_orderpriority, n, ROUND(min, 6) AS min, ROUND(q1, 6) AS q1, ROUND(median, 6) AS median,
  ROUND(q3, 6) AS q3, ROUND(max, 6) AS max,
  (SELECT COUNT(*) FROM d WHERE d.g = q.g AND (d.v < q.q1 - 1.5 * (q.q3 - q.q1) OR d.v > q.q3 + 1.5 * (q.q3 - q.q1)))
    AS n_outliers
FROM q"""))
def q_box_by_category(spark, sf):
    b = B.box_by_category(table(spark, sf, "orders"), "o_orderpriority", "o_totalprice")
    return b.select("o_orderpriority", "n", *[_r(c) for c in ("min", "q1", "median", "q3", "max")], "n_outliers")


@register("density_by_category", with_ctes(_OP, """s AS (SELECT g, MIN(v) AS lo, (MAX(v) - MIN(v)) / 20 AS w, COUNT(v) AS n FROM d WHERE g IS NOT NULL AND v IS NOT NULL GROUP BY g)""",
                                           """b AS (SELECT g, CAST(CASE WHEN w > 0 THEN LEAST(FLOOR((v - lo) / w), 19) ELSE 0 END AS INT) AS bin, lo, w, n
  FROM d JOIN s USING (g) WHERE v IS NOT NULL)""", body="""
SELECT g AS o_orderpriority, bin, ROUND(lo + bin * w, 6) AS low, ROUND(lo + bin * w + w, 6) AS high, COUNT(*) AS count,
  ROUND(CASE WHEN w > 0 THEN COUNT(*) / (n * w) END, 9) AS density FROM b GROUP BY g, bin, lo, w, n"""))
def q_density_by_category(spark, sf):
    b = B.density_by_category(table(spark, sf, "orders"), "o_orderpriority", "o_totalprice")
    return b.select("o_orderpriority", "bin", _r("low"), _r("high"), "count", F.round("density", 9).alias("density"))


@register("bivariate_auto")
def q_bivariate_auto(spark, sf):
    """All three branches of the dispatch, every result as (pair, result, row as JSON)."""
    orders = table(spark, sf, "orders").withColumn("cents", F.col("o_totalprice") % 1000)
    parts = []
    for x, y in (("o_totalprice", "cents"), ("o_orderpriority", "o_totalprice"), ("o_orderpriority", "o_orderstatus")):
        for name, out in B.bivariate_auto(orders, x, y).items():
            parts.append(out.select(F.lit(f"{x} / {y}").alias("pair"), F.lit(name).alias("result"),
                                    F.to_json(F.struct(*[F.col(c) for c in out.columns])).alias("row")))
    return reduce(DataFrame.unionAll, parts)
