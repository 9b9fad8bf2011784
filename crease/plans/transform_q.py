"""Registered column-function (P-series) and source/sink (S-series) queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from crease.functions import columns as P
from crease.operators import reports as A
from crease.plans.registry import register, with_ctes
from crease.session import checkpoint_dir
from crease.sources import files as S
from crease.sources.fixtures import (CONTESTS_SQL, DELIVERIES_SQL, DIRTY_ORDERS_SQL, contests, deliveries,
                                     dirty_orders, table)
from crease.sources.synthetic import synthetic_matches, u_sql

# Text columns derived from the driver tables in both engines.
_SEASON_TEXT_SQL = ("CASE WHEN match_id % 2 = 0 THEN CAST(season AS VARCHAR) "
                    "ELSE CAST(season - 1 AS VARCHAR) || '/' || RIGHT(CAST(season AS VARCHAR), 2) END")
_OUTCOME_SQL = ("CASE WHEN event_id % 11 = 0 THEN NULL "
                "WHEN event_id % 3 = 0 THEN 'Won by ' || CAST(CAST(FLOOR(value) AS INT) AS VARCHAR) || ' runs' "
                "WHEN event_id % 3 = 1 THEN 'WON BY ' || CAST(event_id % 10 AS VARCHAR) || ' Wickets' "
                "ELSE 'Match Tied' END")


def _season_text(c):
    return F.when(F.col("match_id") % 2 == 0, F.col("season").cast("string")).otherwise(
        F.concat((F.col("season") - 1).cast("string"), F.lit("/"), F.substring(F.col("season").cast("string"), 3, 2)))


def _outcome(e):
    return (F.when(F.col("event_id") % 11 == 0, F.lit(None).cast("string"))
            .when(F.col("event_id") % 3 == 0,
                  F.concat(F.lit("Won by "), F.floor("value").cast("int").cast("string"), F.lit(" runs")))
            .when(F.col("event_id") % 3 == 1,
                  F.concat(F.lit("WON BY "), (F.col("event_id") % 10).cast("string"), F.lit(" Wickets")))
            .otherwise(F.lit("Match Tied")))


@register("normalise_season", with_ctes(CONTESTS_SQL, """t AS (SELECT match_id, """ + _SEASON_TEXT_SQL +
                                        """ AS season_text FROM contests)""", body="""
SELECT match_id, season_text,
  CASE WHEN regexp_matches(season_text, '^\\d{4}/\\d{2}') THEN
    CASE WHEN CAST(FLOOR(CAST(SUBSTR(season_text, 1, 4) AS INT) / 100) AS INT) * 100 + CAST(SUBSTR(season_text, 6, 2) AS INT)
              < CAST(SUBSTR(season_text, 1, 4) AS INT)
         THEN CAST(FLOOR(CAST(SUBSTR(season_text, 1, 4) AS INT) / 100) AS INT) * 100 + CAST(SUBSTR(season_text, 6, 2) AS INT) + 100
         ELSE CAST(FLOOR(CAST(SUBSTR(season_text, 1, 4) AS INT) / 100) AS INT) * 100 + CAST(SUBSTR(season_text, 6, 2) AS INT) END
  ELSE CAST(TRUNC(TRY_CAST(season_text AS DOUBLE)) AS INT) END AS season
FROM t"""))
def q_normalise_season(spark, sf):
    c = contests(spark, sf).select("match_id", _season_text(None).alias("season_text"))
    return c.select("match_id", "season_text", P.normalise_season("season_text").alias("season"))


PRIORITY_ALIASES = {"1-URGENT": "urgent", "2-HIGH": "high"}


@register("alias_map", """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'urgent' WHEN '2-HIGH' THEN 'high'
  ELSE o_orderpriority END AS priority FROM orders""")
def q_alias_map(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", P.alias_map("o_orderpriority", PRIORITY_ALIASES).alias("priority"))


@register("parse_win_margin", f"""SELECT event_id, {_OUTCOME_SQL} AS outcome,
  COALESCE(TRY_CAST(NULLIF(regexp_extract(LOWER({_OUTCOME_SQL}), '(\\d+)\\s*run', 1), '') AS INT), 0) AS win_by_runs,
  COALESCE(TRY_CAST(NULLIF(regexp_extract(LOWER({_OUTCOME_SQL}), '(\\d+)\\s*wicket', 1), '') AS INT), 0) AS win_by_wickets
FROM events""")
def q_parse_win_margin(spark, sf):
    e = table(spark, sf, "events").select("event_id", _outcome(None).alias("outcome"))
    r, w = P.parse_win_margin("outcome")
    return e.select("event_id", "outcome", r.alias("win_by_runs"), w.alias("win_by_wickets"))


_RAW_TEXT_SQL = ("CASE WHEN o_orderkey % 5 = 0 THEN '  ' || UPPER(o_orderstatus) || ' ' WHEN o_orderkey % 5 = 1 THEN 'nan' "
                 "WHEN o_orderkey % 5 = 2 THEN ' None' WHEN o_orderkey % 5 = 3 THEN '' ELSE o_orderpriority END")


def _raw_text():
    k = F.col("o_orderkey")
    return (F.when(k % 5 == 0, F.concat(F.lit("  "), F.upper("o_orderstatus"), F.lit(" ")))
            .when(k % 5 == 1, F.lit("nan")).when(k % 5 == 2, F.lit(" None")).when(k % 5 == 3, F.lit(""))
            .otherwise(F.col("o_orderpriority")))


@register("clean_text", f"""SELECT o_orderkey, CASE WHEN LOWER(TRIM({_RAW_TEXT_SQL})) IN ('', 'nan', 'none') THEN NULL
  ELSE LOWER(TRIM({_RAW_TEXT_SQL})) END AS text FROM orders""")
def q_clean_text(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", P.clean_text(_raw_text()).alias("text"))


@register("parse_date", """SELECT o_orderkey, CAST(TRY_CAST(CASE WHEN o_orderkey % 9 = 0 THEN 'not a date'
  ELSE strftime(o_orderdate, '%Y-%m-%d') END AS DATE) AS VARCHAR) AS order_date FROM orders""")
def q_parse_date(spark, sf):
    o = table(spark, sf, "orders")
    txt = F.when(F.col("o_orderkey") % 9 == 0, F.lit("not a date")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return o.select("o_orderkey", P.parse_date(txt).cast("string").alias("order_date"))


_NUM_TEXT_SQL = ("CASE WHEN event_id % 7 = 0 THEN 'k=' || CAST(event_id AS VARCHAR) "
                 "ELSE TRIM(REPLACE(SPLIT_PART(props, ':', 2), '}', '')) END")


@register("to_number_coerce", f"""SELECT event_id, COALESCE(TRY_CAST({_NUM_TEXT_SQL} AS DOUBLE), 1.0) AS k FROM events""")
def q_to_number_coerce(spark, sf):
    e = table(spark, sf, "events")
    txt = F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("k="), F.col("event_id").cast("string"))).otherwise(
        F.trim(F.regexp_replace(F.split_part("props", F.lit(":"), F.lit(2)), "}", "")))
    return e.select("event_id", P.to_number_coerce(txt, 1).alias("k"))


@register("boolean_flags", with_ctes(CONTESTS_SQL, body="""
SELECT match_id, CASE WHEN winner = side_a THEN 1 ELSE 0 END AS a_won,
  CASE WHEN toss_decision = 'bat' THEN 1 ELSE 0 END AS toss_bat_first,
  CASE WHEN toss_winner = side_a THEN 1 ELSE 0 END AS toss_winner_is_a,
  CASE WHEN venue IN ('click', 'view') THEN 1 ELSE 0 END AS browse_venue,
  CAST(COALESCE(CONTAINS(venue, 'ur'), FALSE) AS INT) AS venue_has_ur
FROM contests"""))
def q_boolean_flags(spark, sf):
    c = contests(spark, sf)
    return c.select("match_id", P.eq_flag("winner", "side_a").alias("a_won"),
                    P.eq_flag("toss_decision", F.lit("bat")).alias("toss_bat_first"),
                    P.eq_flag("toss_winner", "side_a").alias("toss_winner_is_a"),
                    P.in_flag("venue", ["click", "view"]).alias("browse_venue"),
                    P.contains_flag("venue", "ur").alias("venue_has_ur"))


@register("season_index", with_ctes(CONTESTS_SQL, """t AS (SELECT match_id, season, """ + _SEASON_TEXT_SQL +
                                    """ AS season_text FROM contests)""", body="""
SELECT match_id, season - 2008 AS season_idx,
  COALESCE(GREATEST(TRY_CAST(NULLIF(regexp_extract(season_text, '^\\s*(\\d+)', 1), '') AS INT) - 2008, 0), 0) AS serving_idx
FROM t"""))
def q_season_index(spark, sf):
    c = contests(spark, sf).select("match_id", "season", _season_text(None).alias("season_text"))
    return c.select("match_id", P.season_index("season").alias("season_idx"),
                    P.season_index("season_text", serving=True).alias("serving_idx"))


_RESULT_SQL = "CASE WHEN match_id % 13 = 0 THEN 'no result' WHEN match_id % 29 = 0 THEN ' Tie' ELSE NULL END"


@register("exclude_rows", with_ctes(CONTESTS_SQL, f"""t AS (SELECT c.match_id, c.winner, {_RESULT_SQL} AS result_type,
  e.outcome FROM contests c JOIN (SELECT event_id, {_OUTCOME_SQL} AS outcome FROM events) e ON e.event_id = c.match_id)""",
                                  body="""
SELECT match_id, winner FROM t
WHERE NOT (COALESCE(LOWER(TRIM(result_type)) IN ('no result', 'tie'), FALSE)
           OR COALESCE(CONTAINS(LOWER(outcome), 'tie'), FALSE))
  AND winner IS NOT NULL"""))
def q_exclude_rows(spark, sf):
    c = contests(spark, sf)
    e = table(spark, sf, "events").select(F.col("event_id").alias("match_id"), _outcome(None).alias("outcome"))
    rt = (F.when(F.col("match_id") % 13 == 0, F.lit("no result")).when(F.col("match_id") % 29 == 0, F.lit(" Tie")))
    t = c.join(e, "match_id").select("match_id", "winner", rt.alias("result_type"), "outcome")
    return P.exclude_rows(t.withColumn("winner", F.col("winner").cast("string")), "result_type", "outcome", "winner") \
        .select("match_id", F.col("winner").cast("int").alias("winner"))


@register("filter_in", with_ctes(CONTESTS_SQL, body="""
SELECT match_id, venue, winner FROM contests WHERE venue IN ('click', 'view')"""))
def q_filter_in(spark, sf):
    return P.filter_in(contests(spark, sf), "venue", ["click", "view"], order_desc="ts").select(
        "match_id", "venue", "winner")


@register("derive_batting_first", with_ctes(CONTESTS_SQL, body="""
SELECT match_id,
  CASE WHEN LOWER(toss_decision) IN ('bat', 'batting') THEN toss_winner
       WHEN toss_winner = side_a THEN side_b ELSE side_a END AS bat_first,
  CASE WHEN winner = (CASE WHEN LOWER(toss_decision) IN ('bat', 'batting') THEN toss_winner
       WHEN toss_winner = side_a THEN side_b ELSE side_a END) THEN 1 ELSE 0 END AS defended
FROM contests"""))
def q_derive_batting_first(spark, sf):
    c = contests(spark, sf)
    bf = P.batting_first("toss_winner", "toss_decision", "side_a", "side_b")
    return c.select("match_id", bf.alias("bat_first"), P.defended_flag(bf, "winner").alias("defended"))


@register("fifty_flag", with_ctes(DELIVERIES_SQL, body="""
SELECT match_id, batter, CAST(SUM(runs) AS BIGINT) AS runs, CASE WHEN SUM(runs) >= 50 THEN 1 ELSE 0 END AS fifty,
  FIRST(venue ORDER BY innings, over_no, seq, bowler, price, shipped) AS venue
FROM deliveries GROUP BY match_id, batter"""))
def q_fifty_flag(spark, sf):
    from crease.operators.history import fifty_flag
    return fifty_flag(deliveries(spark, sf), ["match_id", "batter"], "runs", ["venue"],
                      ["innings", "over_no", "seq", "bowler", "price", "shipped"])


@register("assign_role", with_ctes(DELIVERIES_SQL, """bat AS (SELECT batter, SUM(runs) AS runs FROM deliveries GROUP BY batter)""",
                                   """bowl AS (SELECT bowler, COUNT(dismissal) AS wickets FROM deliveries GROUP BY bowler)""",
                                   body="""
SELECT COALESCE(batter, bowler) AS player, CAST(COALESCE(runs, 0) AS BIGINT) AS runs, COALESCE(wickets, 0) AS wickets,
  CASE WHEN COALESCE(batter, bowler) IN (3, 11, 64) THEN 'Wicketkeeper'
       WHEN COALESCE(runs, 0) >= 600 AND COALESCE(wickets, 0) >= 25 THEN 'All-Rounder'
       WHEN COALESCE(wickets, 0) >= 20 AND COALESCE(runs, 0) < COALESCE(wickets, 0) * 30 THEN 'Bowler'
       WHEN COALESCE(runs, 0) >= 300 THEN 'Batter' WHEN COALESCE(wickets, 0) > 0 THEN 'Bowler' ELSE 'Batter' END AS role
FROM bat FULL OUTER JOIN bowl ON batter = bowler"""))
def q_assign_role(spark, sf):
    d = deliveries(spark, sf)
    bat = d.groupBy("batter").agg(F.sum("runs").cast("long").alias("runs"))
    bowl = d.groupBy("bowler").agg(F.count("dismissal").alias("wickets"))
    p = A.outer_merge_coalesce(bat, bowl, key="player")
    return p.select("player", "runs", "wickets", P.assign_role("player", "runs", "wickets", keepers=[3, 11, 64]).alias("role"))


@register("drop_null_rows", with_ctes(DIRTY_ORDERS_SQL, body="""
SELECT * FROM dirty_orders WHERE amount IS NOT NULL AND priority IS NOT NULL"""))
def q_drop_null_rows(spark, sf):
    return P.drop_null_rows(dirty_orders(spark, sf), ["amount", "priority"])


@register("archetype_label", with_ctes(CONTESTS_SQL, body="""
SELECT match_id, CASE season WHEN 2021 THEN 'Opening' WHEN 2022 THEN 'Middle' ELSE 'Unknown' END AS label
FROM contests"""))
def q_archetype_label(spark, sf):
    c = contests(spark, sf)
    return c.select("match_id", P.archetype_label("season", {2021: "Opening", 2022: "Middle"}).alias("label"))


@register("format_number", """SELECT o_orderkey, format('{:,.2f}', o_totalprice) AS price,
  format('{:,.1f}', o_totalprice / 1000.0) || '%' AS price_k_pct FROM orders""")
def q_format_number(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", P.format_number("o_totalprice", 2).alias("price"),
                    P.format_number(F.col("o_totalprice") / 1000.0, 1, percent=True).alias("price_k_pct"))


@register("sanitize_non_finite", """SELECT o_orderkey,
  CASE WHEN o_orderkey % 11 = 0 OR o_orderkey % 13 = 0 OR o_orderkey % 17 = 0 THEN NULL ELSE o_totalprice END AS price
FROM orders""")
def q_sanitize_non_finite(spark, sf):
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey")
    raw = (F.when(k % 11 == 0, F.lit(float("nan"))).when(k % 13 == 0, F.lit(float("inf")))
           .when(k % 17 == 0, F.lit(float("-inf"))).otherwise(F.col("o_totalprice")))
    return P.sanitize_non_finite(o.select("o_orderkey", raw.alias("price")))


# ---------------------------------------------------------------------------
# Sources and sinks
# ---------------------------------------------------------------------------

def _scratch(spark, name):
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@register("scan_parquet", "SELECT * FROM customer")
def q_scan_parquet(spark, sf):
    return S.scan_parquet(spark, f"{sf.rstrip('/')}/customer.parquet")


@register("scan_csv", """SELECT c_custkey, TRIM(c_name) AS c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""")
def q_scan_csv(spark, sf):
    """Customer written as CSV with padded header names, read back with inference."""
    path = _scratch(spark, "csv")
    c = table(spark, sf, "customer")
    c.toDF(*[f" {x} " for x in c.columns]).write.option("header", True).csv(path)
    back = S.scan_csv(spark, path)
    return back.select(F.col("c_custkey").cast("long"), F.trim("c_name").alias("c_name"),
                       F.col("c_nationkey").cast("int"), F.col("c_acctbal").cast("double"), "c_mktsegment")


@register("drop_stray_index_columns", "SELECT * FROM nation")
def q_drop_stray_index_columns(spark, sf):
    n = table(spark, sf, "nation")
    return S.drop_stray_index_columns(n.withColumn("Unnamed: 0", F.col("n_nationkey")))


@register("resolve_column", with_ctes(DELIVERIES_SQL, body="""
SELECT match_id, runs AS target, price AS hinted, bowler AS last_number, venue AS last_text FROM deliveries"""))
def q_resolve_column(spark, sf):
    """All ways: a candidate, a hint in the name, the last numeric and the last other column."""
    d = deliveries(spark, sf)
    c = S.resolve_column(d, ["total_runs", "runs_off_bat", "runs", "runs_scored"])
    hinted = S.resolve_column(d, ["absent"], hints=("pri",))
    some = d.select("match_id", "dismissal", "bowler", "venue")
    number, text = S.resolve_column(some, ["absent"]), S.resolve_column(some, ["absent"], numeric=False)
    return d.select("match_id", F.col(c).alias("target"), F.col(hinted).alias("hinted"), F.col(number).alias("last_number"),
                    F.col(text).alias("last_text"))


@register("stage_latest", with_ctes(DIRTY_ORDERS_SQL, body="SELECT DISTINCT * FROM dirty_orders"))
def q_stage_latest(spark, sf):
    base = _scratch(spark, "stages")
    d = dirty_orders(spark, sf)
    S.stage_save(d, base, "s1", "original")
    S.stage_save(d.dropDuplicates(), base, "s1", "cleaned")
    stage, df = S.stage_latest(spark, base, "s1")
    assert stage == "cleaned"
    return df


@register("sink_csv", "SELECT r_regionkey, r_name FROM region")
def q_sink_csv(spark, sf):
    path = _scratch(spark, "sink")
    S.sink_csv(table(spark, sf, "region"), path)
    return spark.read.option("header", True).schema("r_regionkey int, r_name string").csv(path)


@register("sink_parquet", "SELECT * FROM supplier")
def q_sink_parquet(spark, sf):
    path = _scratch(spark, "sinkpq")
    S.sink_parquet(table(spark, sf, "supplier"), path, ["s_nationkey"])
    return spark.read.parquet(path).select("s_suppkey", "s_name", F.col("s_nationkey").cast("int"), "s_acctbal")


@register("preview", """SELECT * FROM (SELECT * FROM orders ORDER BY o_orderkey LIMIT 10)
UNION ALL SELECT * FROM (SELECT * FROM orders ORDER BY o_orderkey DESC LIMIT 10)""")
def q_preview(spark, sf):
    o = table(spark, sf, "orders")
    return S.preview(o, ["o_orderkey"], 10).unionAll(S.preview(o, ["o_orderkey"], 10, tail=True))


@register("table_metadata", """SELECT COUNT(*) AS rows, CAST(6 AS BIGINT) AS columns, CAST(3 AS BIGINT) AS numeric_columns,
  CAST(3 AS BIGINT) AS other_columns, 'o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority'
  AS column_names FROM orders""")
def q_table_metadata(spark, sf):
    return S.table_metadata(table(spark, sf, "orders"))


def _synthetic_sql():
    u = lambda field, mod: u_sql("event_id", 42, field, mod)
    return with_ctes(
        f"""parts AS (SELECT event_id, {u(1, 8)} AS t1, ({u(1, 8)} + 1 + {u(2, 7)}) % 8 AS t2,
  (120 + {u(3, 100)}) * CASE WHEN {u(4, 100)} = 0 THEN 3 ELSE 1 END AS runs,
  CASE WHEN {u(6, 100)} < 2 THEN NULL ELSE CAST(15 + {u(5, 6)} AS DOUBLE) END AS overs FROM events)""",
        f"""base AS (SELECT event_id AS match_id, CAST(2008 + {u(9, 17)} AS INT) AS season,
  strftime(DATE '2008-04-01' + CAST({u(10, 6000)} AS INT), '%Y-%m-%d') AS date, 'Venue ' || ({u(11, 10)} + 1) AS venue,
  'Team ' || (t1 + 1) AS team1, 'Team ' || (t2 + 1) AS team2,
  'Team ' || (CASE WHEN {u(7, 2)} = 0 THEN t1 ELSE t2 END + 1) AS toss_winner,
  CASE WHEN {u(12, 2)} = 0 THEN 'bat' ELSE 'field' END AS toss_decision,
  CASE WHEN {u(13, 100)} < 4 THEN NULL ELSE 'Team ' || (CASE WHEN {u(8, 2)} = 0 THEN t1 ELSE t2 END + 1) END AS winner,
  CAST(runs AS INT) AS runs_scored, CAST({u(14, 11)} AS INT) AS wickets_lost, overs, runs / overs AS strike_rate,
  CASE WHEN {u(15, 100)} < 6 THEN NULL ELSE 'Player ' || {u(16, 300)} END AS player_of_match,
  CASE WHEN {u(17, 100)} < 8 THEN NULL ELSE CAST({u(18, 80)} AS DOUBLE) END AS margin, {u(19, 10)} = 0 AS is_playoff,
  'Premier' AS league FROM parts)""",
        body=f"SELECT * FROM base UNION ALL SELECT * FROM base WHERE {u_sql('match_id', 42, 20, 64)} = 0")


@register("synthetic_matches", _synthetic_sql())
def q_synthetic_matches(spark, sf):
    return synthetic_matches(table(spark, sf, "events").select("event_id"), "event_id")
