"""Driver tables and the derived views that play the reference's data roles.

The reference works on a ball-by-ball cricket log and a match table; those files
are not available, so the operators are column-parameterised and exercised on
views derived from the driver tables.  Each view has a DataFrame form (used by
the Spark queries) and a SQL text form (used by the DuckDB oracles); both
describe exactly the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crease.session import ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _side_b(user_id: Column, event_id: Column) -> Column:
    return ((user_id % 10 + 1 + event_id % 9) % 10).cast("int")


def contests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-sided contests (the match table role).  Order key: (ts, match_id)."""
    e = table(spark, sf_dir, "events")
    a = (F.col("user_id") % 10).cast("int")
    b = _side_b(F.col("user_id"), F.col("event_id"))
    return e.select(
        F.col("event_id").alias("match_id"),
        "ts",
        a.alias("side_a"),
        b.alias("side_b"),
        F.col("event_type").alias("venue"),
        F.when(F.col("event_id") % 2 == 0, a).otherwise(b).alias("toss_winner"),
        F.when(F.col("value") > 10, F.lit("bat")).otherwise(F.lit("field")).alias("toss_decision"),
        F.when(F.col("event_id") % 11 == 0, F.lit(None).cast("int"))
         .when(F.col("event_id") % 3 == 0, b).otherwise(a).alias("winner"),
        F.when(F.col("event_id") % 17 == 0, F.lit(None).cast("long"))
         .otherwise(F.col("user_id")).alias("award"),
        F.when(F.dayofmonth("ts") <= 10, 2021).when(F.dayofmonth("ts") <= 20, 2022)
         .otherwise(2023).alias("season"),
    )


# Total order of the event log: the view's key plus tie-breakers that make it
# unique at every scale.
DELIVERY_ORDER = ["match_id", "innings", "over_no", "seq", "bowler", "price", "shipped"]


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ball-by-ball event log (the raw-log role)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("match_id"),
        (1 + F.col("l_suppkey") % 2).cast("int").alias("innings"),
        (F.col("l_linenumber") - 1).alias("over_no"),
        F.col("l_partkey").alias("seq"),
        (F.col("l_partkey") % 200).cast("int").alias("batter"),
        F.col("l_suppkey").alias("bowler"),
        (F.col("l_quantity").cast("int") % 7).alias("runs"),
        F.when(F.col("l_returnflag") == "R", F.lit("out")).alias("dismissal"),
        F.col("l_linestatus").alias("venue"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_shipdate").alias("shipped"),
    )


def dirty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with planted nulls, outliers, a constant column and duplicates."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    b = o.select(
        k,
        F.when(k % 13 == 0, F.lit(None).cast("double"))
         .when(k % 997 == 0, F.col("o_totalprice") * 10)
         .otherwise(F.col("o_totalprice")).alias("amount"),
        F.when(k % 7 == 0, F.lit(None).cast("string")).otherwise(F.col("o_orderpriority")).alias("priority"),
        F.when(k % 5 < 3, F.lit(None).cast("long")).otherwise(F.col("o_custkey")).alias("sparse"),
        F.lit("X").alias("league"),
        "o_orderstatus",
    )
    return b.unionAll(b.filter(k % 500 == 0))


# ---------------------------------------------------------------------------
# SQL text of the same views, for the DuckDB oracles (inlined as CTEs).
# ---------------------------------------------------------------------------

CONTESTS_SQL = """contests AS (
  SELECT event_id AS match_id, ts,
    CAST(user_id % 10 AS INT) AS side_a,
    CAST((user_id % 10 + 1 + event_id % 9) % 10 AS INT) AS side_b,
    event_type AS venue,
    CASE WHEN event_id % 2 = 0 THEN CAST(user_id % 10 AS INT)
         ELSE CAST((user_id % 10 + 1 + event_id % 9) % 10 AS INT) END AS toss_winner,
    CASE WHEN value > 10 THEN 'bat' ELSE 'field' END AS toss_decision,
    CASE WHEN event_id % 11 = 0 THEN NULL
         WHEN event_id % 3 = 0 THEN CAST((user_id % 10 + 1 + event_id % 9) % 10 AS INT)
         ELSE CAST(user_id % 10 AS INT) END AS winner,
    CASE WHEN event_id % 17 = 0 THEN NULL ELSE user_id END AS award,
    CASE WHEN DAY(ts) <= 10 THEN 2021 WHEN DAY(ts) <= 20 THEN 2022 ELSE 2023 END AS season
  FROM events)"""

DELIVERIES_SQL = """deliveries AS (
  SELECT l_orderkey AS match_id, CAST(1 + l_suppkey % 2 AS INT) AS innings,
    l_linenumber - 1 AS over_no, l_partkey AS seq, CAST(l_partkey % 200 AS INT) AS batter,
    l_suppkey AS bowler, CAST(FLOOR(l_quantity) AS INT) % 7 AS runs,
    CASE WHEN l_returnflag = 'R' THEN 'out' ELSE NULL END AS dismissal,
    l_linestatus AS venue, l_extendedprice AS price, l_shipdate AS shipped
  FROM lineitem)"""

DIRTY_ORDERS_SQL = """dirty_b AS (
  SELECT o_orderkey,
    CASE WHEN o_orderkey % 13 = 0 THEN NULL
         WHEN o_orderkey % 997 = 0 THEN o_totalprice * 10 ELSE o_totalprice END AS amount,
    CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderpriority END AS priority,
    CASE WHEN o_orderkey % 5 < 3 THEN NULL ELSE o_custkey END AS sparse,
    'X' AS league, o_orderstatus
  FROM orders),
dirty_orders AS (SELECT * FROM dirty_b UNION ALL SELECT * FROM dirty_b WHERE o_orderkey % 500 = 0)"""
