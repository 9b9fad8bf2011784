"""Registered report queries (A-series) over the contests and deliveries views."""

from __future__ import annotations

from pyspark.sql import functions as F

from crease.operators import reports as A
from crease.plans.registry import register, with_ctes
from crease.sources.fixtures import (CONTESTS_SQL, DELIVERIES_SQL, DIRTY_ORDERS_SQL, contests, deliveries,
                                     dirty_orders)

R6 = 6

_PLAYERS = ["""bat AS (
  SELECT batter, CAST(SUM(runs) AS BIGINT) AS runs, COUNT(seq) AS balls,
    COUNT(*) FILTER (WHERE runs = 4) AS fours, COUNT(*) FILTER (WHERE runs = 6) AS sixes
  FROM deliveries GROUP BY batter)""", """lvl AS (
  SELECT batter, CAST(MAX(r) AS BIGINT) AS high_score, COUNT(*) FILTER (WHERE r >= 50 AND r < 100) AS fifties,
    COUNT(*) FILTER (WHERE r >= 100) AS hundreds
  FROM (SELECT batter, match_id, SUM(runs) AS r FROM deliveries GROUP BY batter, match_id) t GROUP BY batter)""",
            """bowl AS (
  SELECT bowler, COUNT(dismissal) AS wickets, COUNT(seq) AS balls_bowled, CAST(SUM(runs) AS BIGINT) AS runs_conceded,
    CASE WHEN COUNT(seq) > 0 THEN SUM(runs) / COUNT(seq) * 6.0 ELSE 0.0 END AS econ
  FROM deliveries GROUP BY bowler)""", """best AS (
  SELECT bowler, FIRST(CAST(w AS VARCHAR) || '/' || CAST(r AS VARCHAR) ORDER BY w * 100 - r DESC, match_id) AS best_bowling
  FROM (SELECT bowler, match_id, COUNT(dismissal) AS w, SUM(runs) AS r FROM deliveries GROUP BY bowler, match_id) t
  GROUP BY bowler)""", """players AS (
  SELECT COALESCE(b.batter, w.bowler) AS player_name,
    COALESCE(b.runs, 0) AS runs, COALESCE(b.balls, 0) AS balls, COALESCE(b.fours, 0) AS fours,
    COALESCE(b.sixes, 0) AS sixes, COALESCE(l.high_score, 0) AS high_score, COALESCE(l.fifties, 0) AS fifties,
    COALESCE(l.hundreds, 0) AS hundreds, COALESCE(w.wickets, 0) AS wickets,
    COALESCE(w.balls_bowled, 0) AS balls_bowled, COALESCE(w.runs_conceded, 0) AS runs_conceded,
    COALESCE(w.econ, 0.0) AS econ, x.best_bowling
  FROM (bat b LEFT JOIN lvl l ON l.batter = b.batter)
  FULL OUTER JOIN (bowl w LEFT JOIN best x ON x.bowler = w.bowler) ON b.batter = w.bowler)""", """roles AS (
  SELECT *, CASE WHEN balls > 0 THEN runs / balls * 100.0 ELSE 0.0 END AS sr,
    CASE WHEN runs >= 600 AND wickets >= 25 THEN 'All-Rounder'
         WHEN wickets >= 20 AND runs < wickets * 30 THEN 'Bowler'
         WHEN runs >= 300 THEN 'Batter' WHEN wickets > 0 THEN 'Bowler' ELSE 'Batter' END AS role
  FROM players)"""]


def _players(spark, sf):
    return A.player_table(deliveries(spark, sf))


# ---------------------------------------------------------------------------

@register("group_count", with_ctes(CONTESTS_SQL, body="""
SELECT season, COUNT(*) AS count FROM contests WHERE season IS NOT NULL GROUP BY season"""))
def q_group_count(spark, sf):
    return A.group_count(contests(spark, sf), "season")


@register("top_k_counts", with_ctes(CONTESTS_SQL, body="""
SELECT award, COUNT(*) AS count FROM contests WHERE award IS NOT NULL GROUP BY award
ORDER BY count DESC, award LIMIT 10"""))
def q_top_k_counts(spark, sf):
    return A.top_k_counts(contests(spark, sf), "award", 10)


@register("top_per_group", with_ctes(CONTESTS_SQL, body="""
SELECT season, winner, wins FROM (
  SELECT season, winner, COUNT(*) AS wins,
    ROW_NUMBER() OVER (PARTITION BY season ORDER BY COUNT(*) DESC, winner) AS rn
  FROM contests WHERE season IS NOT NULL AND winner IS NOT NULL GROUP BY season, winner) t WHERE rn = 1"""))
def q_top_per_group(spark, sf):
    return A.top_per_group(contests(spark, sf), "season", "winner")


@register("side_union_standings", with_ctes(CONTESTS_SQL, body="""
SELECT team, COUNT(*) AS played, CAST(SUM(CASE WHEN winner = team THEN 1 ELSE 0 END) AS BIGINT) AS won,
  COUNT(*) - SUM(CASE WHEN winner = team THEN 1 ELSE 0 END) AS lost,
  ROUND(SUM(CASE WHEN winner = team THEN 1 ELSE 0 END) * 100.0 / COUNT(*), 1) AS win_pct
FROM (SELECT side_a AS team, winner FROM contests UNION ALL SELECT side_b, winner FROM contests) s
WHERE team IS NOT NULL GROUP BY team"""))
def q_side_union_standings(spark, sf):
    return A.side_union_standings(contests(spark, sf)).withColumn("lost", F.col("lost").cast("long"))


@register("rate_by_group", with_ctes(CONTESTS_SQL, body="""
SELECT toss_decision, ROUND(AVG(CASE WHEN toss_winner = winner THEN 1.0 ELSE 0.0 END) * 100, 1) AS win_pct,
  COUNT(*) AS matches
FROM contests WHERE toss_decision IS NOT NULL GROUP BY toss_decision"""))
def q_rate_by_group(spark, sf):
    c = contests(spark, sf)
    return A.rate_by_group(c, "toss_decision", F.when(F.col("toss_winner") == F.col("winner"), 1).otherwise(0))


@register("win_matrix", with_ctes(CONTESTS_SQL, """sides AS (
  SELECT side_a AS team, venue, winner FROM contests UNION ALL SELECT side_b, venue, winner FROM contests)""",
"""tt AS (SELECT team FROM sides WHERE team IS NOT NULL GROUP BY team ORDER BY COUNT(*) DESC, team LIMIT 10)""",
"""tv AS (SELECT venue FROM contests WHERE venue IS NOT NULL GROUP BY venue ORDER BY COUNT(*) DESC, venue LIMIT 10)""",
body="""
SELECT tt.team, tv.venue,
  CASE WHEN (SELECT COUNT(*) FROM sides s WHERE s.team = tt.team AND s.venue = tv.venue) > 0
       THEN ROUND((SELECT COUNT(*) FROM contests c WHERE c.winner = tt.team AND c.venue = tv.venue) * 100.0
                  / (SELECT COUNT(*) FROM sides s WHERE s.team = tt.team AND s.venue = tv.venue), 1)
       ELSE 0.0 END AS win_pct,
  (SELECT COUNT(*) FROM sides s WHERE s.team = tt.team AND s.venue = tv.venue) AS total
FROM tt, tv"""))
def q_win_matrix(spark, sf):
    return A.win_matrix(contests(spark, sf))


@register("pair_record", with_ctes(CONTESTS_SQL, body="""
SELECT LEAST(side_a, side_b) AS team_a, GREATEST(side_a, side_b) AS team_b, COUNT(*) AS total,
  CAST(SUM(CASE WHEN winner = LEAST(side_a, side_b) THEN 1 ELSE 0 END) AS BIGINT) AS a_wins,
  CAST(SUM(CASE WHEN winner = GREATEST(side_a, side_b) THEN 1 ELSE 0 END) AS BIGINT) AS b_wins,
  CAST(COUNT(*) - SUM(CASE WHEN winner = LEAST(side_a, side_b) THEN 1 ELSE 0 END)
     - SUM(CASE WHEN winner = GREATEST(side_a, side_b) THEN 1 ELSE 0 END) AS BIGINT) AS other
FROM contests GROUP BY 1, 2"""))
def q_pair_record(spark, sf):
    return A.pair_record(contests(spark, sf))


@register("pair_history", with_ctes(CONTESTS_SQL, body="""
SELECT match_id, side_a, side_b, winner FROM contests
WHERE (side_a = 1 AND side_b = 2) OR (side_a = 2 AND side_b = 1)"""))
def q_pair_history(spark, sf):
    return A.pair_history(contests(spark, sf), 1, 2).select("match_id", "side_a", "side_b", "winner")


@register("batting_career", with_ctes(DELIVERIES_SQL, _PLAYERS[0], body="SELECT * FROM bat"))
def q_batting_career(spark, sf):
    return A.batting_career(deliveries(spark, sf))


@register("two_level_aggregate", with_ctes(DELIVERIES_SQL, _PLAYERS[1], body="SELECT * FROM lvl"))
def q_two_level_aggregate(spark, sf):
    return A.two_level_aggregate(deliveries(spark, sf))


@register("bowling_career", with_ctes(DELIVERIES_SQL, _PLAYERS[2], body="""
SELECT bowler, wickets, balls_bowled, runs_conceded, ROUND(econ, 6) AS econ FROM bowl"""))
def q_bowling_career(spark, sf):
    return A.bowling_career(deliveries(spark, sf)).withColumn("econ", F.round("econ", R6))


@register("best_figures", with_ctes(DELIVERIES_SQL, _PLAYERS[3], body="SELECT * FROM best"))
def q_best_figures(spark, sf):
    return A.best_figures(deliveries(spark, sf))


@register("left_merge", with_ctes(DELIVERIES_SQL, _PLAYERS[0], _PLAYERS[1], body="""
SELECT b.*, l.high_score, l.fifties, l.hundreds FROM bat b LEFT JOIN lvl l ON l.batter = b.batter"""))
def q_left_merge(spark, sf):
    d = deliveries(spark, sf)
    return A.left_merge(A.batting_career(d), A.two_level_aggregate(d), "batter")


@register("outer_merge_coalesce", with_ctes(DELIVERIES_SQL, *_PLAYERS, body="""
SELECT player_name, runs, balls, fours, sixes, high_score, fifties, hundreds, wickets, balls_bowled,
  runs_conceded, ROUND(econ, 6) AS econ, best_bowling, ROUND(sr, 6) AS sr, role FROM roles"""))
def q_outer_merge_coalesce(spark, sf):
    p = _players(spark, sf)
    return p.select("player_name", "runs", "balls", "fours", "sixes", "high_score", "fifties", "hundreds",
                    "wickets", "balls_bowled", "runs_conceded", F.round("econ", R6).alias("econ"), "best_bowling",
                    F.round("sr", R6).alias("sr"), "role")


_PT = """pt AS (SELECT DISTINCT player, team FROM (
  SELECT batter AS player, venue AS team FROM deliveries UNION ALL SELECT bowler, venue FROM deliveries) u
  WHERE player IS NOT NULL AND team IS NOT NULL)"""


def _player_teams(spark, sf):
    return A.union_distinct(deliveries(spark, sf), [("batter", "venue"), ("bowler", "venue")])


@register("union_distinct", with_ctes(DELIVERIES_SQL, _PT, body="SELECT * FROM pt"))
def q_union_distinct(spark, sf):
    return _player_teams(spark, sf)


@register("inner_merge", with_ctes(DELIVERIES_SQL, *_PLAYERS, _PT, body="""
SELECT r.player_name, r.runs, r.wickets, r.role, pt.team FROM roles r JOIN pt ON pt.player = r.player_name"""))
def q_inner_merge(spark, sf):
    p = _players(spark, sf).select("player_name", "runs", "wickets", "role")
    return A.inner_merge(p, _player_teams(spark, sf).withColumnRenamed("player", "player_name"), "player_name")


_TOPBAT = """topbat AS (SELECT batter FROM deliveries GROUP BY batter ORDER BY SUM(runs) DESC, batter LIMIT 10)"""


@register("in_list_semi", with_ctes(DELIVERIES_SQL, _TOPBAT, body="""
SELECT match_id, seq, batter, runs FROM deliveries WHERE batter IN (SELECT batter FROM topbat)"""))
def q_in_list_semi(spark, sf):
    d = deliveries(spark, sf)
    top = A.batting_career(d).orderBy(F.desc("runs"), "batter").limit(10).select("batter")
    return A.in_list_semi(d, top, "batter").select("match_id", "seq", "batter", "runs")


@register("in_list_anti", with_ctes(DELIVERIES_SQL, _TOPBAT, body="""
SELECT match_id, seq, batter, runs FROM deliveries WHERE batter NOT IN (SELECT batter FROM topbat)"""))
def q_in_list_anti(spark, sf):
    d = deliveries(spark, sf)
    top = A.batting_career(d).orderBy(F.desc("runs"), "batter").limit(10).select("batter")
    return A.in_list_semi(d, top, "batter", anti=True).select("match_id", "seq", "batter", "runs")


@register("batter_form", with_ctes(DELIVERIES_SQL, body="""
SELECT batter, CAST(SUM(runs) AS BIGINT) AS runs, COUNT(*) FILTER (WHERE seq % 10 <> 0) AS balls,
  COUNT(*) FILTER (WHERE runs = 4) AS fours, COUNT(*) FILTER (WHERE runs = 6) AS sixes,
  ROUND(SUM(runs) * 100.0 / COUNT(*) FILTER (WHERE seq % 10 <> 0), 6) AS strike_rate,
  ROUND((COUNT(*) FILTER (WHERE runs = 4) + COUNT(*) FILTER (WHERE runs = 6)) * 100.0
        / COUNT(*) FILTER (WHERE seq % 10 <> 0), 6) AS boundary_pct
FROM deliveries GROUP BY batter HAVING COUNT(*) FILTER (WHERE seq % 10 <> 0) >= 100"""))
def q_batter_form(spark, sf):
    d = deliveries(spark, sf).withColumn("extra_type", F.when(F.col("seq") % 10 == 0, F.lit("wides")))
    b = A.batter_form(d)
    return b.select("batter", "runs", "balls", "fours", "sixes", F.round("strike_rate", R6).alias("strike_rate"),
                    F.round("boundary_pct", R6).alias("boundary_pct"))


@register("bowler_form", with_ctes(DELIVERIES_SQL, """b AS (
  SELECT bowler, CAST(SUM(CASE WHEN dismissal IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS wickets,
    CAST(SUM(COALESCE(CASE WHEN seq % 10 = 0 THEN 0 WHEN seq % 13 = 0 THEN NULL ELSE 1 END, 1)) AS BIGINT) AS balls,
    CAST(SUM(runs) AS DOUBLE) AS runs
  FROM deliveries GROUP BY bowler)""", body="""
SELECT bowler, wickets, balls, runs, ROUND(runs / balls * 6.0, 6) AS economy,
  ROUND(CASE WHEN wickets > 0 THEN runs / wickets ELSE runs END, 6) AS average
FROM b WHERE balls >= 60"""))
def q_bowler_form(spark, sf):
    d = deliveries(spark, sf)
    vb = F.when(F.col("seq") % 10 == 0, 0).when(F.col("seq") % 13 == 0, F.lit(None)).otherwise(1)
    b = A.bowler_form(d, wicket_flag=F.when(F.col("dismissal").isNotNull(), 1).otherwise(0), valid_ball=vb,
                      runs=F.col("runs"))
    return b.select("bowler", "wickets", "balls", "runs", F.round("economy", R6).alias("economy"),
                    F.round("average", R6).alias("average"))


QUOTAS = {"Wicketkeeper": 1, "Batter": 4, "All-Rounder": 2, "Bowler": 4}

_POOL = """pool AS (
  SELECT player, role, rating, team FROM (
    SELECT player, role, rating, team,
      ROW_NUMBER() OVER (PARTITION BY player ORDER BY rating DESC, role DESC, team DESC) AS k
    FROM (SELECT r.player_name AS player, r.role, CAST(r.runs + 20 * r.wickets AS DOUBLE) AS rating, pt.team
          FROM roles r JOIN pt ON pt.player = r.player_name) x) y WHERE k = 1)"""
_LINEUP = """lineup AS (
  SELECT * FROM (SELECT p.*, ROW_NUMBER() OVER (PARTITION BY role ORDER BY rating DESC, player) AS rank FROM pool p) z
  WHERE (role = 'Wicketkeeper' AND rank <= 1) OR (role = 'Batter' AND rank <= 4)
     OR (role = 'All-Rounder' AND rank <= 2) OR (role = 'Bowler' AND rank <= 4))"""


def _lineup(spark, sf):
    p = _players(spark, sf).select(F.col("player_name").alias("player"), "role",
                                   (F.col("runs") + 20 * F.col("wickets")).cast("double").alias("rating"))
    pool = p.join(_player_teams(spark, sf), "player")
    return A.role_quota_top_k(pool, QUOTAS)


@register("role_quota_top_k", with_ctes(DELIVERIES_SQL, *_PLAYERS, _PT, _POOL, _LINEUP, body="""
SELECT player, role, rating, team, rank FROM lineup"""))
def q_role_quota_top_k(spark, sf):
    return _lineup(spark, sf).select("player", "role", "rating", "team", F.col("rank").cast("long").alias("rank"))


@register("lineup_summary", with_ctes(DELIVERIES_SQL, *_PLAYERS, _PT, _POOL, _LINEUP, body="""
SELECT team, COUNT(*) AS members, SUM(rating) AS total_rating, ROUND(AVG(rating), 6) AS avg_rating
FROM lineup GROUP BY team"""))
def q_lineup_summary(spark, sf):
    s = A.lineup_summary(_lineup(spark, sf))
    return s.withColumn("avg_rating", F.round("avg_rating", R6))


@register("leaderboard", with_ctes(DELIVERIES_SQL, *_PLAYERS, body="""
SELECT player_name, runs, ROW_NUMBER() OVER (ORDER BY runs DESC, player_name) AS rank
FROM roles ORDER BY runs DESC, player_name LIMIT 30"""))
def q_leaderboard(spark, sf):
    lb = A.leaderboard(_players(spark, sf).select("player_name", "runs"), "runs", 30, key="player_name")
    return lb.withColumn("rank", F.col("rank").cast("long"))


@register("profile_compare", with_ctes(DELIVERIES_SQL, *_PLAYERS, body="""
SELECT player_name, metric, value FROM (
  SELECT player_name, 'runs' AS metric, CAST(runs AS DOUBLE) AS value FROM roles
  UNION ALL SELECT player_name, 'wickets', CAST(wickets AS DOUBLE) FROM roles
  UNION ALL SELECT player_name, 'sr', ROUND(sr, 6) FROM roles) t WHERE player_name IN (7, 42)"""))
def q_profile_compare(spark, sf):
    p = _players(spark, sf).withColumn("sr", F.round("sr", R6))
    return A.profile_compare(p, "player_name", [7, 42], ["runs", "wickets", "sr"])


@register("distinct_values", with_ctes(CONTESTS_SQL, body="""
SELECT DISTINCT value FROM (SELECT side_a AS value FROM contests UNION ALL SELECT side_b FROM contests) t
WHERE value IS NOT NULL"""))
def q_distinct_values(spark, sf):
    return A.distinct_values(contests(spark, sf), ["side_a", "side_b"])


@register("group_mean_profile", with_ctes(DELIVERIES_SQL, *_PLAYERS, body="""
SELECT role, COUNT(*) AS members, ROUND(AVG(runs), 3) AS avg_runs, ROUND(AVG(wickets), 3) AS avg_wickets,
  CASE role WHEN 'Batter' THEN 'Top order' WHEN 'Bowler' THEN 'Attack' ELSE 'Unknown' END AS label
FROM roles GROUP BY role"""))
def q_group_mean_profile(spark, sf):
    return A.group_mean_profile(_players(spark, sf), "role", ["runs", "wickets"],
                                labels={"Batter": "Top order", "Bowler": "Attack"})


@register("category_aggregate", with_ctes(DIRTY_ORDERS_SQL, """d AS (
  SELECT * FROM dirty_orders WHERE priority IS NOT NULL AND amount IS NOT NULL)""", """k AS (
  SELECT priority FROM d GROUP BY priority ORDER BY COUNT(*) DESC, priority LIMIT 20)""", body="""
SELECT priority, ROUND(AVG(amount), 6) AS mean_amount FROM d WHERE priority IN (SELECT priority FROM k)
GROUP BY priority"""))
def q_category_aggregate(spark, sf):
    c = A.category_aggregate(dirty_orders(spark, sf), "priority", "amount", "mean")
    return c.withColumn("mean_amount", F.round("mean_amount", R6))
