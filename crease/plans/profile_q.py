"""Registered profiling and cleaning queries (Q- and C1-C5) on the planted-defect
view ``dirty_orders`` and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from crease.operators import clean as C
from crease.operators import profile as P
from crease.plans.registry import register, with_ctes
from crease.sources.fixtures import CONTESTS_SQL, DIRTY_ORDERS_SQL, contests, dirty_orders

# dirty_orders columns: (name, numeric?)
DIRTY_COLS = [("o_orderkey", True), ("amount", True), ("priority", False), ("sparse", True),
              ("league", False), ("o_orderstatus", False)]
NUM = [c for c, n in DIRTY_COLS if n]
R6 = 6


def _r(c):
    return F.round(c, R6).alias(c)


def _union(parts):
    return "\nUNION ALL\n".join(parts)


# ---------------------------------------------------------------------------

# Spark type names of DuckDB's storage types, for the dtype column.
_DTYPE_SQL = """CASE typeof(MIN({c})) WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'SMALLINT' THEN 'smallint'
    WHEN 'DOUBLE' THEN 'double' WHEN 'FLOAT' THEN 'float' WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean'
    WHEN 'DATE' THEN 'date' ELSE lower(typeof(MIN({c}))) END"""


def _classify_sql(c, n):
    """Boolean when at most two distinct values, all in the boolean domain;
    otherwise by storage type (no dirty_orders string column has a date name)."""
    domain = "CAST({c} AS DOUBLE) NOT IN (0, 1)" if n else "{c} NOT IN ('True', 'False', 'yes', 'no', 'Y', 'N')"
    out = f"COUNT(*) FILTER (WHERE {c} IS NOT NULL AND {domain.format(c=c)})"
    return f"""SELECT '{c}' AS "column",
  CASE WHEN COUNT(DISTINCT {c}) <= 2 AND {out} = 0 THEN 'boolean' ELSE '{"numerical" if n else "categorical"}' END AS class,
  {_DTYPE_SQL.format(c=c)} AS dtype
FROM dirty_orders"""


CLASSIFY_BODY = _union([_classify_sql(c, n) for c, n in DIRTY_COLS])
CLASSIFY_SQL = with_ctes(DIRTY_ORDERS_SQL, body=CLASSIFY_BODY)
DTYPE_SQL = with_ctes(DIRTY_ORDERS_SQL, f"cls AS ({CLASSIFY_BODY})", body="""
SELECT "column", class, dtype, COUNT(*) OVER (PARTITION BY class) AS class_count FROM cls""")


@register("classify_columns", CLASSIFY_SQL)
def q_classify_columns(spark, sf):
    return P.classify_columns(dirty_orders(spark, sf))


@register("dtype_table", DTYPE_SQL)
def q_dtype_table(spark, sf):
    return P.dtype_table(dirty_orders(spark, sf))


OVERVIEW_SQL = with_ctes(DIRTY_ORDERS_SQL, body=_union([
    f"""SELECT '{c}' AS "column", COUNT(*) AS count, COUNT({c}) AS non_null_count,
  COUNT(*) - COUNT({c}) AS missing_count, COUNT(DISTINCT {c}) AS unique_count,
  {f"ROUND(AVG({c}), 6)" if n else "CAST(NULL AS DOUBLE)"} AS mean,
  {f"ROUND(CASE WHEN COUNT({c}) > 1 THEN STDDEV_SAMP({c}) WHEN COUNT({c}) = 1 THEN 0.0 END, 6)" if n else "CAST(NULL AS DOUBLE)"} AS std,
  {f"ROUND(CAST(MIN({c}) AS DOUBLE), 6)" if n else "CAST(NULL AS DOUBLE)"} AS min,
  {f"ROUND(CAST(MAX({c}) AS DOUBLE), 6)" if n else "CAST(NULL AS DOUBLE)"} AS max
FROM dirty_orders""" for c, n in DIRTY_COLS]))


@register("overview", OVERVIEW_SQL)
def q_overview(spark, sf):
    o = P.overview(dirty_orders(spark, sf))
    return o.select("column", "count", "non_null_count", "missing_count", "unique_count",
                    _r("mean"), _r("std"), _r("min"), _r("max"))


MISSING_SQL = with_ctes(DIRTY_ORDERS_SQL, body=_union([
    f"""SELECT '{c}' AS "column", COUNT(*) - COUNT({c}) AS missing_count,
  ROUND((COUNT(*) - COUNT({c})) * 100.0 / COUNT(*), 2) AS missing_percentage,
  CASE WHEN COUNT(*) = COUNT({c}) THEN 'none'
       WHEN (COUNT(*) - COUNT({c})) * 100.0 / COUNT(*) > 50 THEN 'drop_column'
       ELSE '{"median" if n else "mode"}' END AS recommended_strategy
FROM dirty_orders""" for c, n in DIRTY_COLS]))


@register("missing_summary", MISSING_SQL)
def q_missing_summary(spark, sf):
    return P.missing_summary(dirty_orders(spark, sf)).drop("data_type")


MISSING_RANK_SQL = with_ctes(DIRTY_ORDERS_SQL, body="SELECT * FROM (" + _union([
    f"""SELECT '{c}' AS "column", COUNT(*) - COUNT({c}) AS missing_count FROM dirty_orders"""
    for c, _ in DIRTY_COLS]) + ") t WHERE missing_count > 0")


@register("missing_ranking", MISSING_RANK_SQL)
def q_missing_ranking(spark, sf):
    return P.missing_ranking(dirty_orders(spark, sf))


DUP_SQL = with_ctes(DIRTY_ORDERS_SQL, body="""
SELECT COUNT(*) AS total_rows, COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM dirty_orders) d) AS duplicate_rows,
  (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM dirty_orders) d) AS unique_rows
FROM dirty_orders""")


@register("duplicate_summary", DUP_SQL)
def q_duplicate_summary(spark, sf):
    return P.duplicate_summary(dirty_orders(spark, sf))


# Classes of the dirty_orders columns under the classification rules:
# numerical for the three numeric columns, categorical for the strings
# (league has one value that is not in the boolean domain).
def _audit_sql(c, n, categorical, table="dirty_orders"):
    m = f"(COUNT(*) - COUNT({c}))"
    pct = f"({m} * 100.0 / COUNT(*))"
    d = f"COUNT(DISTINCT {c})"
    hc = f"({'TRUE' if categorical else 'FALSE'} AND {d} > 50)"
    idname = any(h in c.lower() for h in ("id", "name"))
    hc_reason = "'many ids'" if idname else "'many levels'"
    return f"""SELECT '{c}' AS feature, {m} AS missing_count, ROUND({pct}, 2) AS missing_percentage,
  {d} AS unique_values,
  CASE WHEN {d} <= 1 THEN 'Problem' WHEN {pct} > 20 THEN 'Problem' WHEN {pct} > 0 THEN 'Warning'
       WHEN {hc} THEN 'Warning' ELSE 'Good' END AS status,
  CASE WHEN {d} <= 1 THEN 'constant' WHEN {pct} > 20 THEN 'missing' WHEN {pct} > 0 THEN 'gaps'
       WHEN {hc} THEN {hc_reason} ELSE 'ok' END AS reason
FROM {table}"""


AUDIT_BODY = _union([_audit_sql(c, n, not n) for c, n in DIRTY_COLS])
AUDIT_SQL = with_ctes(DIRTY_ORDERS_SQL, body=AUDIT_BODY)


@register("quality_audit", AUDIT_SQL)
def q_quality_audit(spark, sf):
    return P.quality_audit(dirty_orders(spark, sf)).drop("data_type")


SCORE_SQL = with_ctes(DIRTY_ORDERS_SQL, f"audit AS ({AUDIT_BODY})", """dup AS (
  SELECT COUNT(*) AS total_rows,
    COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM dirty_orders) d) AS duplicate_rows FROM dirty_orders)""",
                      body="""
SELECT total_rows, CAST(6 AS BIGINT) AS total_columns, duplicate_rows,
  (SELECT COUNT(*) FROM audit WHERE reason = 'constant') AS constant_columns,
  CAST(3 AS BIGINT) AS numerical_features_count, CAST(3 AS BIGINT) AS categorical_features_count,
  CAST(0 AS BIGINT) AS date_features_count, CAST(0 AS BIGINT) AS boolean_features_count,
  (SELECT COUNT(*) FROM audit WHERE status = 'Problem') AS problems,
  (SELECT COUNT(*) FROM audit WHERE status = 'Warning') AS warnings,
  CAST(GREATEST(5, FLOOR(100.0 - duplicate_rows * 15.0 / total_rows
       - 5.0 * (SELECT COUNT(*) FROM audit WHERE status = 'Problem')
       - 2.5 * (SELECT COUNT(*) FROM audit WHERE status = 'Warning'))) AS BIGINT) AS quality_score
FROM dup""")


@register("quality_score", SCORE_SQL)
def q_quality_score(spark, sf):
    return P.quality_score(dirty_orders(spark, sf))


UNI_SQL = with_ctes(DIRTY_ORDERS_SQL, body=_union([
    f"""SELECT '{c}' AS "column", ROUND(AVG({c}), 6) AS mean, ROUND(MEDIAN({c}), 6) AS median,
  ROUND(STDDEV_SAMP({c}), 6) AS std, ROUND(CAST(MIN({c}) AS DOUBLE), 6) AS min, ROUND(CAST(MAX({c}) AS DOUBLE), 6) AS max,
  ROUND(QUANTILE_CONT({c}, 0.25), 6) AS q1, ROUND(QUANTILE_CONT({c}, 0.75), 6) AS q3,
  ROUND(SKEWNESS({c}), 6) AS skewness, ROUND(KURTOSIS({c}), 6) AS kurtosis,
  COUNT({c}) AS non_null_count, COUNT(*) - COUNT({c}) AS missing_count
FROM dirty_orders""" for c in NUM]))


@register("univariate_numeric", UNI_SQL)
def q_univariate_numeric(spark, sf):
    u = P.univariate_numeric(dirty_orders(spark, sf), NUM)
    return u.select("column", *[_r(m) for m in ("mean", "median", "std", "min", "max", "q1", "q3",
                                                "skewness", "kurtosis")], "non_null_count", "missing_count")


UNICAT_SQL = with_ctes(DIRTY_ORDERS_SQL, """vc AS (
  SELECT priority AS value, COUNT(*) AS count FROM dirty_orders WHERE priority IS NOT NULL GROUP BY priority)""", body="""
SELECT 'priority' AS "column", value, count,
  ROUND(count * 100.0 / (SELECT COUNT(priority) FROM dirty_orders), 2) AS percentage,
  (SELECT COUNT(*) FROM vc) AS unique_count,
  (SELECT value FROM vc ORDER BY count DESC, value LIMIT 1) AS top_value,
  (SELECT MAX(count) FROM vc) AS top_frequency,
  (SELECT COUNT(priority) FROM dirty_orders) AS non_null_count,
  (SELECT COUNT(*) - COUNT(priority) FROM dirty_orders) AS missing_count
FROM vc""")


@register("univariate_categorical", UNICAT_SQL)
def q_univariate_categorical(spark, sf):
    return P.univariate_categorical(dirty_orders(spark, sf), "priority")


SHAPE_SQL = with_ctes(DIRTY_ORDERS_SQL, body=_union([
    f"""SELECT '{c}' AS "column", ROUND(AVG({c}), 2) AS mean, ROUND(MEDIAN({c}), 2) AS median,
  ROUND(SKEWNESS({c}), 2) AS skewness, ROUND(KURTOSIS({c}), 2) AS kurtosis,
  CASE WHEN ABS(SKEWNESS({c})) < 0.5 THEN 'symmetric'
       WHEN SKEWNESS({c}) >= 0.5 THEN 'right' ELSE 'left' END AS shape
FROM dirty_orders HAVING COUNT({c}) >= 3""" for c in NUM]))


@register("distribution_shape", SHAPE_SQL)
def q_distribution_shape(spark, sf):
    return P.distribution_shape(dirty_orders(spark, sf))


TOPK_SQL = with_ctes(DIRTY_ORDERS_SQL, """vc AS (
  SELECT CAST(sparse AS VARCHAR) AS value, COUNT(*) AS count FROM dirty_orders WHERE sparse IS NOT NULL GROUP BY 1)""",
                     """top AS (SELECT value, count FROM vc ORDER BY count DESC, value LIMIT 15)""", body="""
SELECT value, count FROM top
UNION ALL
SELECT 'Other', CAST(SUM(count) AS BIGINT) FROM vc WHERE value NOT IN (SELECT value FROM top) HAVING SUM(count) > 0""")


@register("top_k_with_other", TOPK_SQL)
def q_top_k_with_other(spark, sf):
    return P.top_k_with_other(dirty_orders(spark, sf), "sparse", 15)


HIST_SQL = with_ctes(DIRTY_ORDERS_SQL, """s AS (SELECT MIN(amount) AS lo, MAX(amount) AS hi, COUNT(amount) AS n,
  (MAX(amount) - MIN(amount)) / 40 AS w FROM dirty_orders)""", """c AS (
  SELECT LEAST(CAST(FLOOR((amount - lo) / w) AS INT) + 1, 40) AS bin, COUNT(*) AS cnt
  FROM dirty_orders, s WHERE amount IS NOT NULL GROUP BY 1)""", body="""
SELECT CAST(b.bin AS INT) AS bin, ROUND(lo + (b.bin - 1) * w, 6) AS lower, ROUND(lo + b.bin * w, 6) AS upper,
  COALESCE(c.cnt, 0) AS count, ROUND(COALESCE(c.cnt, 0) / (n * w), 12) AS density
FROM s, range(1, 41) b(bin) LEFT JOIN c ON c.bin = b.bin""")


@register("histogram", HIST_SQL)
def q_histogram(spark, sf):
    h = P.histogram(dirty_orders(spark, sf), "amount", 40)
    return h.select("bin", _r("lower"), _r("upper"), "count", F.round("density", 12).alias("density"))


BOX_SQL = with_ctes(DIRTY_ORDERS_SQL, """q AS (
  SELECT priority, COUNT(amount) AS n, MIN(amount) AS min, QUANTILE_CONT(amount, 0.25) AS q1,
    MEDIAN(amount) AS median, QUANTILE_CONT(amount, 0.75) AS q3, MAX(amount) AS max
  FROM dirty_orders WHERE amount IS NOT NULL AND priority IS NOT NULL GROUP BY priority)""", body="""
SELECT q.priority, n, ROUND(min, 6) AS min, ROUND(q1, 6) AS q1, ROUND(median, 6) AS median, ROUND(q3, 6) AS q3,
  ROUND(max, 6) AS max, ROUND(q1 - 1.5 * (q3 - q1), 6) AS lower_fence, ROUND(q3 + 1.5 * (q3 - q1), 6) AS upper_fence,
  (SELECT COUNT(*) FROM dirty_orders d WHERE d.priority = q.priority AND d.amount IS NOT NULL
     AND (d.amount < q1 - 1.5 * (q3 - q1) OR d.amount > q3 + 1.5 * (q3 - q1))) AS n_outliers
FROM q""")


@register("box_summary", BOX_SQL)
def q_box_summary(spark, sf):
    b = P.box_summary(dirty_orders(spark, sf), "amount", ["priority"])
    return b.select("priority", "n", *[_r(c) for c in ("min", "q1", "median", "q3", "max", "lower_fence",
                                                         "upper_fence")], "n_outliers")


def _stage_summary_sql(stage, table, applied=""):
    audit = _union([_audit_sql(c, n, not n, table) for c, n in DIRTY_COLS])
    missing = " + ".join(f"(COUNT(*) - COUNT({c}))" for c, _ in DIRTY_COLS)
    numeric = [c for c, n in DIRTY_COLS if n]
    close = " + ".join(f"CASE WHEN isfinite(CORR({a}, {b})) AND ABS(CORR({a}, {b})) > 0.8 THEN 1 ELSE 0 END"
                       for i, a in enumerate(numeric) for b in numeric[i + 1:])
    return f"""SELECT '{stage}' AS stage, t.total_rows, CAST({len(DIRTY_COLS)} AS BIGINT) AS total_columns,
  t.missing_cells, t.duplicate_rows,
  CAST(GREATEST(5, FLOOR(100.0 - t.duplicate_rows * 15.0 / t.total_rows
       - 5.0 * (SELECT COUNT(*) FROM ({audit}) a WHERE status = 'Problem')
       - 2.5 * (SELECT COUNT(*) FROM ({audit}) a WHERE status = 'Warning'))) AS BIGINT) AS quality_score,
  (SELECT CAST({close} AS BIGINT) FROM {table}) AS collinear_pairs, '{applied}' AS applied_stages
FROM (SELECT COUNT(*) AS total_rows, CAST({missing} AS BIGINT) AS missing_cells,
        COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM {table}) d) AS duplicate_rows FROM {table}) t"""


BEFORE_AFTER_SQL = with_ctes(DIRTY_ORDERS_SQL, "deduped AS (SELECT DISTINCT * FROM dirty_orders)",
                             body=_union([_stage_summary_sql("original", "dirty_orders"),
                                          _stage_summary_sql("latest", "deduped", "drop_duplicates")]))


@register("before_after_summary", BEFORE_AFTER_SQL)
def q_before_after_summary(spark, sf):
    d = dirty_orders(spark, sf)
    return P.before_after_summary(d, C.drop_duplicates(d), ["drop_duplicates"])


META_SQL = with_ctes(DIRTY_ORDERS_SQL, body="""
SELECT 'amount' AS feature, 'numeric' AS kind, CAST(NULL AS VARCHAR) AS option, ROUND(MIN(amount), 6) AS min,
  ROUND(MAX(amount), 6) AS max, ROUND(AVG(amount), 6) AS mean FROM dirty_orders
UNION ALL
SELECT DISTINCT 'priority', 'categorical', priority, CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE)
FROM dirty_orders WHERE priority IS NOT NULL""")


@register("feature_metadata", META_SQL)
def q_feature_metadata(spark, sf):
    m = P.feature_metadata(dirty_orders(spark, sf), ["amount", "priority"])
    return m.select("feature", "kind", "option", _r("min"), _r("max"), _r("mean"))


COUNTS_SQL = with_ctes(CONTESTS_SQL, body="""
SELECT COUNT(*) AS rows, COUNT(DISTINCT season) AS distinct_season, COUNT(DISTINCT venue) AS distinct_venue,
  COUNT(DISTINCT award) AS distinct_award FROM contests""")


@register("dataset_counts", COUNTS_SQL)
def q_dataset_counts(spark, sf):
    return P.dataset_counts(contests(spark, sf), ["season", "venue", "award"])


# ---------------------------------------------------------------------------
# C1-C5
# ---------------------------------------------------------------------------

IMPUTE_SQL = with_ctes(DIRTY_ORDERS_SQL, """s1 AS (
  SELECT o_orderkey, amount,
    COALESCE(priority, (SELECT MIN(priority) FROM (SELECT priority, COUNT(*) c FROM dirty_orders
        WHERE priority IS NOT NULL GROUP BY priority QUALIFY c = MAX(c) OVER ()) m)) AS priority,
    sparse, league, o_orderstatus FROM dirty_orders)""", """s2 AS (SELECT * FROM s1 WHERE amount IS NOT NULL)""", body="""
SELECT o_orderkey, ROUND(amount, 6) AS amount, priority,
  ROUND(COALESCE(CAST(sparse AS DOUBLE), (SELECT AVG(sparse) FROM s2)), 6) AS sparse, league, o_orderstatus FROM s2""")


@register("impute", IMPUTE_SQL)
def q_impute(spark, sf):
    out = C.impute(dirty_orders(spark, sf), {"priority": "mode", "amount": "drop_rows", "sparse": "mean",
                                             "league": "median"})
    return out.select("o_orderkey", _r("amount"), "priority", F.round(F.col("sparse").cast("double"), R6).alias("sparse"),
                      "league", "o_orderstatus")


DEDUP_SQL = with_ctes(DIRTY_ORDERS_SQL, body="SELECT DISTINCT * FROM dirty_orders")


@register("drop_duplicates", DEDUP_SQL)
def q_drop_duplicates(spark, sf):
    return C.drop_duplicates(dirty_orders(spark, sf))


_IQR = """st AS (SELECT QUANTILE_CONT(amount, 0.25) AS q1, QUANTILE_CONT(amount, 0.75) AS q3, COUNT(*) AS total
  FROM dirty_orders)"""

IQR_SQL = with_ctes(DIRTY_ORDERS_SQL, _IQR, body="""
SELECT 'amount' AS "column", 'iqr' AS method, ROUND(q1, 6) AS q1, ROUND(q3, 6) AS q3, ROUND(q3 - q1, 6) AS iqr,
  ROUND(q1 - 1.5 * (q3 - q1), 6) AS lower_bound, ROUND(q3 + 1.5 * (q3 - q1), 6) AS upper_bound,
  (SELECT COUNT(*) FROM dirty_orders WHERE amount < q1 - 1.5 * (q3 - q1) OR amount > q3 + 1.5 * (q3 - q1)) AS outlier_count,
  ROUND((SELECT COUNT(*) FROM dirty_orders WHERE amount < q1 - 1.5 * (q3 - q1) OR amount > q3 + 1.5 * (q3 - q1))
        * 100.0 / total, 2) AS outlier_percentage
FROM st""")


@register("outliers_iqr", IQR_SQL)
def q_outliers_iqr(spark, sf):
    s = C.outliers_summary(dirty_orders(spark, sf), "amount", "iqr")
    return s.select("column", "method", *[_r(c) for c in ("q1", "q3", "iqr", "lower_bound", "upper_bound")],
                    "outlier_count", "outlier_percentage")


IQR_ROWS_SQL = with_ctes(DIRTY_ORDERS_SQL, _IQR, body="""
SELECT o_orderkey, amount AS value FROM dirty_orders, st
WHERE amount < q1 - 1.5 * (q3 - q1) OR amount > q3 + 1.5 * (q3 - q1)""")


@register("outlier_rows_iqr", IQR_ROWS_SQL)
def q_outlier_rows_iqr(spark, sf):
    return C.outlier_rows(dirty_orders(spark, sf), "amount", "iqr", id_col="o_orderkey")


_Z = """zs AS (SELECT AVG(amount) AS mean, CASE WHEN COALESCE(STDDEV_SAMP(amount), 0) = 0 THEN 1e-9
  ELSE STDDEV_SAMP(amount) END AS std, COUNT(*) AS total FROM dirty_orders)"""

Z_SQL = with_ctes(DIRTY_ORDERS_SQL, _Z, body="""
SELECT 'amount' AS "column", 'zscore' AS method, ROUND(mean, 6) AS mean, ROUND(std, 6) AS std,
  ROUND(mean - 3 * std, 6) AS lower_bound, ROUND(mean + 3 * std, 6) AS upper_bound,
  (SELECT COUNT(*) FROM dirty_orders WHERE ABS((amount - mean) / std) > 3) AS outlier_count,
  ROUND((SELECT COUNT(*) FROM dirty_orders WHERE ABS((amount - mean) / std) > 3) * 100.0 / total, 2) AS outlier_percentage
FROM zs""")


@register("outliers_zscore", Z_SQL)
def q_outliers_zscore(spark, sf):
    s = C.outliers_summary(dirty_orders(spark, sf), "amount", "zscore")
    return s.select("column", "method", *[_r(c) for c in ("mean", "std", "lower_bound", "upper_bound")],
                    "outlier_count", "outlier_percentage")


CAP_SQL = with_ctes(DIRTY_ORDERS_SQL, _IQR, body="""
SELECT o_orderkey, CASE WHEN amount IS NOT NULL THEN
    ROUND(LEAST(GREATEST(amount, q1 - 1.5 * (q3 - q1)), q3 + 1.5 * (q3 - q1)), 6) END AS amount,
  priority, sparse, league, o_orderstatus FROM dirty_orders, st""")


@register("handle_outliers_cap", CAP_SQL)
def q_handle_outliers_cap(spark, sf):
    h = C.handle_outliers(dirty_orders(spark, sf), "amount", "cap")
    return h.withColumn("amount", F.round("amount", R6))


REMOVE_SQL = with_ctes(DIRTY_ORDERS_SQL, _IQR, body="""
SELECT o_orderkey, amount, priority, sparse, league, o_orderstatus FROM dirty_orders, st
WHERE amount IS NULL OR NOT (amount < q1 - 1.5 * (q3 - q1) OR amount > q3 + 1.5 * (q3 - q1))""")


@register("handle_outliers_remove", REMOVE_SQL)
def q_handle_outliers_remove(spark, sf):
    return C.handle_outliers(dirty_orders(spark, sf), "amount", "remove")
