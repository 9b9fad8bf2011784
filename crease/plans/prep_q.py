"""Registered preparation queries (C6-C16): encoders, scalers, splits, samples,
folds and recommendations, with DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from crease.operators import prepare as PR
from crease.plans.registry import register, with_ctes
from crease.sources.fixtures import DIRTY_ORDERS_SQL, dirty_orders, table

R6 = 6
HASH_SQL = "((o_orderkey % 1000003 + 42) * 2654435761) % 1000003"


@register("label_encode", with_ctes(DIRTY_ORDERS_SQL, """v AS (SELECT DISTINCT COALESCE(priority, 'Missing') AS p FROM dirty_orders)""",
                                    """c AS (SELECT p, CAST(ROW_NUMBER() OVER (ORDER BY p) - 1 AS INT) AS code FROM v)""", body="""
SELECT d.o_orderkey, c.code AS priority FROM dirty_orders d JOIN c ON c.p = COALESCE(d.priority, 'Missing')"""))
def q_label_encode(spark, sf):
    enc, _ = PR.label_encode(dirty_orders(spark, sf), "priority")
    return enc.select("o_orderkey", "priority")


@register("label_encode_unseen", with_ctes(DIRTY_ORDERS_SQL, """v AS (SELECT DISTINCT o_orderpriority AS p FROM orders
  WHERE o_orderpriority IS NOT NULL UNION SELECT '<unknown>')""",
                                           """c AS (SELECT p, CAST(ROW_NUMBER() OVER (ORDER BY p) - 1 AS INT) AS code FROM v)""",
                                           body="""
SELECT d.o_orderkey, COALESCE(c.code, (SELECT code FROM c WHERE p = '<unknown>')) AS priority
FROM dirty_orders d LEFT JOIN c ON c.p = CASE WHEN d.o_orderkey % 19 = 0 THEN 'a new level' ELSE d.priority END"""))
def q_label_encode_unseen(spark, sf):
    some = F.when(F.col("o_orderkey") % 19 == 0, "a new level").otherwise(F.col("priority"))  # values that the dictionary lacks
    enc, _ = PR.label_encode_unseen(table(spark, sf, "orders").withColumnRenamed("o_orderpriority", "priority"),
                                    dirty_orders(spark, sf).withColumn("priority", some), "priority")
    return enc.select("o_orderkey", "priority")


_PRIORITY_LEVELS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", "Missing"]


@register("one_hot", with_ctes(DIRTY_ORDERS_SQL, body="SELECT o_orderkey, " + ", ".join(
    f"""CAST(COALESCE(priority, 'Missing') = '{v}' AS INT) AS "priority_{v}\"""" for v in _PRIORITY_LEVELS) +
    " FROM dirty_orders"))
def q_one_hot(spark, sf):
    d = dirty_orders(spark, sf).select("o_orderkey", "priority")
    return PR.one_hot(d, "priority")


def _scaler_sql(method: str) -> str:
    filled = """f AS (SELECT o_orderkey, COALESCE(amount, (SELECT MEDIAN(amount) FROM dirty_orders)) AS amount,
  COALESCE(CAST(sparse AS DOUBLE), (SELECT MEDIAN(sparse) FROM dirty_orders)) AS sparse FROM dirty_orders)"""
    if method == "standard":
        st = "SELECT AVG(amount) a1, STDDEV_POP(amount) b1, AVG(sparse) a2, STDDEV_POP(sparse) b2 FROM f"
        body = """SELECT o_orderkey, ROUND((amount - a1) / CASE WHEN b1 = 0 THEN 1 ELSE b1 END, 6) AS amount,
  ROUND((sparse - a2) / CASE WHEN b2 = 0 THEN 1 ELSE b2 END, 6) AS sparse FROM f, st"""
    elif method == "minmax":
        st = "SELECT MIN(amount) a1, MAX(amount) b1, MIN(sparse) a2, MAX(sparse) b2 FROM f"
        body = """SELECT o_orderkey, ROUND((amount - a1) / CASE WHEN b1 - a1 = 0 THEN 1 ELSE b1 - a1 END, 6) AS amount,
  ROUND((sparse - a2) / CASE WHEN b2 - a2 = 0 THEN 1 ELSE b2 - a2 END, 6) AS sparse FROM f, st"""
    else:
        st = """SELECT MEDIAN(amount) a1, QUANTILE_CONT(amount, 0.75) - QUANTILE_CONT(amount, 0.25) b1,
  MEDIAN(sparse) a2, QUANTILE_CONT(sparse, 0.75) - QUANTILE_CONT(sparse, 0.25) b2 FROM f"""
        body = """SELECT o_orderkey, ROUND((amount - a1) / CASE WHEN b1 = 0 THEN 1 ELSE b1 END, 6) AS amount,
  ROUND((sparse - a2) / CASE WHEN b2 = 0 THEN 1 ELSE b2 END, 6) AS sparse FROM f, st"""
    return with_ctes(DIRTY_ORDERS_SQL, filled, f"st AS ({st})", body=body)


def _scaled(spark, sf, fn):
    d = dirty_orders(spark, sf).select("o_orderkey", "amount", "sparse")
    out = fn(d, ["amount", "sparse"])
    return out.select("o_orderkey", F.round("amount", R6).alias("amount"), F.round("sparse", R6).alias("sparse"))


@register("scale_standard", _scaler_sql("standard"))
def q_scale_standard(spark, sf):
    return _scaled(spark, sf, PR.scale_standard)


@register("scale_minmax", _scaler_sql("minmax"))
def q_scale_minmax(spark, sf):
    return _scaled(spark, sf, PR.scale_minmax)


@register("scale_robust", _scaler_sql("robust"))
def q_scale_robust(spark, sf):
    return _scaled(spark, sf, PR.scale_robust)


@register("train_test_split", f"""
SELECT o_orderkey, CASE WHEN ROW_NUMBER() OVER (ORDER BY {HASH_SQL}, o_orderkey) - 1 < FLOOR(COUNT(*) OVER () * 0.2)
  THEN 'test' ELSE 'train' END AS split FROM orders""")
def q_train_test_split(spark, sf):
    s = PR.train_test_split(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 0.2)
    return s.select("o_orderkey", "split")


@register("stratified_split", f"""
SELECT o_orderkey, o_orderstatus,
  CASE WHEN ROW_NUMBER() OVER (PARTITION BY o_orderstatus ORDER BY {HASH_SQL}, o_orderkey) - 1
            < CEIL(COUNT(*) OVER (PARTITION BY o_orderstatus) * 0.2) THEN 'test' ELSE 'train' END AS split
FROM orders""")
def q_stratified_split(spark, sf):
    s = PR.train_test_split(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "o_orderkey", 0.2,
                            rounding="ceil", label="o_orderstatus")
    return s.select("o_orderkey", "o_orderstatus", "split")


@register("cap_sample", f"""SELECT o_orderkey, o_totalprice FROM orders ORDER BY {HASH_SQL}, o_orderkey LIMIT 500""")
def q_cap_sample(spark, sf):
    return PR.cap_sample(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 500)


@register("kfold_assign", f"""
SELECT o_orderkey, o_orderstatus,
  CAST((ROW_NUMBER() OVER (PARTITION BY o_orderstatus ORDER BY {HASH_SQL}, o_orderkey) - 1) % 5 AS INT) AS fold
FROM orders""")
def q_kfold_assign(spark, sf):
    k = PR.kfold_assign(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "o_orderkey", 5,
                        label="o_orderstatus")
    return k.select("o_orderkey", "o_orderstatus", "fold")


@register("recommend_encoding", with_ctes(DIRTY_ORDERS_SQL, body="""
SELECT 'priority' AS "column", COUNT(DISTINCT priority) AS n_distinct,
  CASE WHEN COUNT(DISTINCT priority) > 2 THEN 'onehot' ELSE 'label' END AS encoding FROM dirty_orders
UNION ALL SELECT 'o_orderstatus', COUNT(DISTINCT o_orderstatus),
  CASE WHEN COUNT(DISTINCT o_orderstatus) > 2 THEN 'onehot' ELSE 'label' END FROM dirty_orders
UNION ALL SELECT 'league', COUNT(DISTINCT league),
  CASE WHEN COUNT(DISTINCT league) > 2 THEN 'onehot' ELSE 'label' END FROM dirty_orders"""))
def q_recommend_encoding(spark, sf):
    return PR.recommend_encoding(dirty_orders(spark, sf), ["priority", "o_orderstatus", "league"])


@register("recommend_scaler", with_ctes(DIRTY_ORDERS_SQL, """q AS (SELECT QUANTILE_CONT(amount, 0.25) a1,
  QUANTILE_CONT(amount, 0.75) b1, QUANTILE_CONT(sparse, 0.25) a2, QUANTILE_CONT(sparse, 0.75) b2 FROM dirty_orders)""",
                                        """n AS (SELECT
  COUNT(*) FILTER (WHERE amount < a1 - 1.5 * (b1 - a1) OR amount > b1 + 1.5 * (b1 - a1)) AS n_amount,
  COUNT(*) FILTER (WHERE sparse < a2 - 1.5 * (b2 - a2) OR sparse > b2 + 1.5 * (b2 - a2)) AS n_sparse
  FROM dirty_orders, q)""", body="""
SELECT 'amount' AS "column", n_amount AS n_outliers,
  CASE WHEN n_amount > 5 THEN 'robust' ELSE 'standard' END AS scaler FROM n
UNION ALL SELECT 'sparse', n_sparse, CASE WHEN n_sparse > 5 THEN 'robust' ELSE 'standard' END FROM n"""))
def q_recommend_scaler(spark, sf):
    return PR.recommend_scaler(dirty_orders(spark, sf), ["amount", "sparse"])
