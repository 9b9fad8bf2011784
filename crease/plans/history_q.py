"""Registered contest-history queries (M-series) and their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from crease.operators import history as H
from crease.plans.registry import register, with_ctes
from crease.sources.fixtures import (CONTESTS_SQL, DELIVERIES_SQL, DELIVERY_ORDER, contests,
                                     deliveries)

R6 = 6
DELIVERY_OVERS = 7  # over_no is 0..6 in the deliveries view

_ELO_REC = """elo(n, rating) AS (
  SELECT 0, CAST(1500.0 AS DOUBLE)
  UNION ALL
  SELECT n + 1, rating + 32.0 * (1.0 - 1.0 / (1.0 + POWER(10.0, (1500.0 - rating) / 400.0)))
  FROM elo WHERE n < (SELECT MAX(n) FROM award_counts))"""
_AWARD_COUNTS = """award_counts AS (
  SELECT award, COUNT(*) AS n FROM contests WHERE award IS NOT NULL AND winner IS NOT NULL GROUP BY award)"""
_HIST = """hist AS (
  SELECT a.match_id, a.ts, a.award, a.k AS award_no, e.rating AS rating_after
  FROM (SELECT match_id, ts, award,
               ROW_NUMBER() OVER (PARTITION BY award ORDER BY ts, match_id) AS k
        FROM contests WHERE award IS NOT NULL AND winner IS NOT NULL) a
  JOIN elo e ON e.n = a.k)"""


def _recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


# ---------------------------------------------------------------------------

H2H_SQL = with_ctes(CONTESTS_SQL, body="""
SELECT c.match_id, c.side_a, c.side_b, c.winner,
  CAST((SELECT COUNT(*) FROM contests p
        WHERE LEAST(p.side_a, p.side_b) = LEAST(c.side_a, c.side_b)
          AND GREATEST(p.side_a, p.side_b) = GREATEST(c.side_a, c.side_b)
          AND (p.ts < c.ts OR (p.ts = c.ts AND p.match_id < c.match_id))
          AND p.winner = c.side_a) AS BIGINT) AS h2h_prior_wins
FROM contests c""")


@register("h2h_prior_wins", H2H_SQL)
def q_h2h_prior_wins(spark, sf):
    return H.h2h_prior_wins(contests(spark, sf)).select("match_id", "side_a", "side_b", "winner",
                                                       "h2h_prior_wins")


VENUE_SQL = with_ctes(CONTESTS_SQL, body="""
SELECT c.match_id,
  CAST((SELECT COUNT(*) FROM contests p
        WHERE p.venue = c.venue AND p.side_a = c.side_a
          AND (p.ts < c.ts OR (p.ts = c.ts AND p.match_id < c.match_id))
          AND p.winner = c.side_a) AS BIGINT) AS venue_prior_wins
FROM contests c""")


@register("venue_prior_wins", VENUE_SQL)
def q_venue_prior_wins(spark, sf):
    return H.venue_prior_wins(contests(spark, sf)).select("match_id", "venue_prior_wins")


ROLLUP_SQL = with_ctes(DELIVERIES_SQL, body="""
SELECT match_id,
  CAST(SUM(CASE WHEN innings = 1 THEN runs END) AS BIGINT) AS team1_runs,
  COUNT(CASE WHEN innings = 1 THEN dismissal END) AS team1_wickets,
  CAST(COALESCE(SUM(CASE WHEN innings = 2 THEN runs END), 0) AS BIGINT) AS team2_runs,
  COUNT(CASE WHEN innings = 2 THEN dismissal END) AS team2_wickets,
  FIRST(venue ORDER BY innings, over_no, seq, bowler, price, shipped) AS venue
FROM deliveries GROUP BY match_id
HAVING COUNT(CASE WHEN innings = 1 THEN 1 END) > 0""")


def _rollup(spark, sf):
    return H.match_rollup(deliveries(spark, sf), order=DELIVERY_ORDER[1:], carry=["venue"])


@register("match_rollup", ROLLUP_SQL)
def q_match_rollup(spark, sf):
    return _rollup(spark, sf)


FIT_SQL = with_ctes(DELIVERIES_SQL, body="""
SELECT venue, CAST(SUM(runs) AS BIGINT) AS first_innings_runs
FROM deliveries WHERE innings = 1 GROUP BY match_id, venue""")


@register("first_innings_total", FIT_SQL)
def q_first_innings_total(spark, sf):
    return H.first_innings_total(deliveries(spark, sf), by=["venue"])


ELO_SQL = _recursive(with_ctes(CONTESTS_SQL, _AWARD_COUNTS, _ELO_REC, body="""
SELECT a.award AS player_name, ROUND(e.rating, 2) AS elo_rating, a.n AS match_count,
  a.n AS pom_count, a.n AS win_count, ROUND(a.n / a.n, 4) AS win_rate
FROM award_counts a JOIN elo e ON e.n = a.n"""))


@register("elo_rating", ELO_SQL)
def q_elo_rating(spark, sf):
    return H.elo_rating(contests(spark, sf))


ELO_HIST_SQL = _recursive(with_ctes(CONTESTS_SQL, _AWARD_COUNTS, _ELO_REC, _HIST, body="""
SELECT match_id, award, award_no, ROUND(rating_after, 6) AS rating_after FROM hist"""))


@register("elo_history", ELO_HIST_SQL)
def q_elo_history(spark, sf):
    h = H.elo_history(contests(spark, sf))
    return h.select("match_id", "award", F.col("award_no").cast("long").alias("award_no"),
                    F.round("rating_after", R6).alias("rating_after"))


STRENGTH_SQL = _recursive(with_ctes(CONTESTS_SQL, _AWARD_COUNTS, _ELO_REC, _HIST, """rated AS (
  SELECT c.*, h.rating_after FROM contests c LEFT JOIN hist h USING (match_id))""", body="""
SELECT m.match_id,
  ROUND(COALESCE((SELECT AVG(p.rating_after) FROM rated p
                  WHERE p.winner = m.side_a AND p.rating_after IS NOT NULL
                    AND (p.ts < m.ts OR (p.ts = m.ts AND p.match_id < m.match_id))), 1500.0), 6) AS side_a_strength,
  ROUND(COALESCE((SELECT AVG(p.rating_after) FROM rated p
                  WHERE p.winner = m.side_b AND p.rating_after IS NOT NULL
                    AND (p.ts < m.ts OR (p.ts = m.ts AND p.match_id < m.match_id))), 1500.0), 6) AS side_b_strength
FROM contests m"""))


@register("team_strength_running", STRENGTH_SQL)
def q_team_strength(spark, sf):
    t = H.team_strength_running(contests(spark, sf))
    return t.select("match_id", F.round("side_a_strength", R6).alias("side_a_strength"),
                    F.round("side_b_strength", R6).alias("side_b_strength"))


FEATURES_SQL = _recursive(with_ctes(CONTESTS_SQL, _AWARD_COUNTS, _ELO_REC, _HIST, """rated AS (
  SELECT c.*, h.rating_after FROM contests c LEFT JOIN hist h USING (match_id))""",
"""teams AS (SELECT DISTINCT v FROM (SELECT side_a AS v FROM contests UNION ALL SELECT side_b FROM contests
              UNION ALL SELECT toss_winner FROM contests) t WHERE v IS NOT NULL)""",
"""team_codes AS (SELECT v, CAST(ROW_NUMBER() OVER (ORDER BY v) - 1 AS INT) AS code FROM teams)""",
"""venue_codes AS (SELECT v, CAST(ROW_NUMBER() OVER (ORDER BY v) - 1 AS INT) AS code
                FROM (SELECT DISTINCT venue AS v FROM contests WHERE venue IS NOT NULL) x)""", body="""
SELECT m.match_id,
  COALESCE(ta.code, 0) AS side_a_enc, COALESCE(tb.code, 0) AS side_b_enc,
  COALESCE(tt.code, 0) AS toss_winner_enc, COALESCE(vc.code, 0) AS venue_enc,
  CASE WHEN m.toss_decision = 'bat' THEN 1 ELSE 0 END AS toss_bat_first,
  CASE WHEN m.toss_winner = m.side_a THEN 1 ELSE 0 END AS toss_winner_is_a,
  m.season - 2008 AS season_idx,
  CAST((SELECT COUNT(*) FROM contests p
        WHERE LEAST(p.side_a, p.side_b) = LEAST(m.side_a, m.side_b)
          AND GREATEST(p.side_a, p.side_b) = GREATEST(m.side_a, m.side_b)
          AND (p.ts < m.ts OR (p.ts = m.ts AND p.match_id < m.match_id))
          AND p.winner = m.side_a) AS BIGINT) AS a_h2h_wins,
  CAST((SELECT COUNT(*) FROM contests p
        WHERE p.venue = m.venue AND p.side_a = m.side_a
          AND (p.ts < m.ts OR (p.ts = m.ts AND p.match_id < m.match_id))
          AND p.winner = m.side_a) AS BIGINT) AS venue_a_wins,
  ROUND(COALESCE((SELECT AVG(p.rating_after) FROM rated p
                  WHERE p.winner = m.side_a AND p.rating_after IS NOT NULL
                    AND (p.ts < m.ts OR (p.ts = m.ts AND p.match_id < m.match_id))), 1500.0), 6) AS side_a_strength,
  ROUND(COALESCE((SELECT AVG(p.rating_after) FROM rated p
                  WHERE p.winner = m.side_b AND p.rating_after IS NOT NULL
                    AND (p.ts < m.ts OR (p.ts = m.ts AND p.match_id < m.match_id))), 1500.0), 6) AS side_b_strength,
  CASE WHEN m.winner = m.side_a THEN 1 ELSE 0 END AS a_won
FROM contests m
LEFT JOIN team_codes ta ON ta.v = m.side_a
LEFT JOIN team_codes tb ON tb.v = m.side_b
LEFT JOIN team_codes tt ON tt.v = m.toss_winner
LEFT JOIN venue_codes vc ON vc.v = m.venue"""))

FEATURE_COLS = ["side_a_enc", "side_b_enc", "toss_winner_enc", "venue_enc", "toss_bat_first",
                "toss_winner_is_a", "season_idx", "a_h2h_wins", "venue_a_wins",
                "side_a_strength", "side_b_strength"]


def match_feature_table(spark, sf):
    return H.match_features(contests(spark, sf))


@register("match_features", FEATURES_SQL)
def q_match_features(spark, sf):
    f = match_feature_table(spark, sf)
    return f.select("match_id", "side_a_enc", "side_b_enc", "toss_winner_enc", "venue_enc",
                    "toss_bat_first", "toss_winner_is_a", "season_idx", "a_h2h_wins", "venue_a_wins",
                    F.round("side_a_strength", R6).alias("side_a_strength"),
                    F.round("side_b_strength", R6).alias("side_b_strength"), "a_won")


_MT = """mt AS (
  SELECT match_id, CAST(SUM(CASE WHEN innings = 1 THEN runs END) AS BIGINT) AS team1_runs,
    FIRST(venue ORDER BY innings, over_no, seq, bowler, price, shipped) AS venue
  FROM deliveries GROUP BY match_id HAVING COUNT(CASE WHEN innings = 1 THEN 1 END) > 0)"""
# The season of a match: the year of its first ball.
_MT_SEASONS = """seasons AS (
  SELECT match_id, CAST(YEAR(FIRST(shipped ORDER BY innings, over_no, seq, bowler, price, shipped)) - 2008 AS INT) AS season_idx
  FROM deliveries GROUP BY match_id)"""
_MT_VENUES = """mt_venues AS (SELECT v, CAST(ROW_NUMBER() OVER (ORDER BY v) - 1 AS INT) AS code
  FROM (SELECT DISTINCT venue AS v FROM mt WHERE venue IS NOT NULL) x)"""

STEP_CTES = [DELIVERIES_SQL, _MT, _MT_SEASONS, _MT_VENUES]
STEP_BODY = f"""
SELECT s.match_id, CAST(s.ov AS INT) AS over, CAST(SUM(d.runs) AS BIGINT) AS cum_runs,
  CAST(LEAST(COUNT(d.dismissal), 10) AS BIGINT) AS cum_wickets,
  SUM(d.runs) / (s.ov + 1) AS run_rate, COALESCE(MAX(v.code), 0) AS venue_enc,
  {DELIVERY_OVERS} AS overs_limit, MAX(seasons.season_idx) AS season_idx, MAX(s.team1_runs) AS final_score
FROM (SELECT m.match_id, m.team1_runs, m.venue, o.ov FROM mt m, range(0, {DELIVERY_OVERS}) o(ov)) s
JOIN deliveries d ON d.match_id = s.match_id AND d.innings = 1 AND d.over_no <= s.ov
LEFT JOIN mt_venues v ON v.v = s.venue
LEFT JOIN seasons ON seasons.match_id = s.match_id
GROUP BY s.match_id, s.ov"""
STEP_SQL = with_ctes(*STEP_CTES, body=f"SELECT * REPLACE (ROUND(run_rate, 6) AS run_rate) FROM ({STEP_BODY})")


def step_table(spark, sf):
    log = deliveries(spark, sf)
    matches = H.match_rollup(log, order=DELIVERY_ORDER[1:], carry=["venue", "shipped"]).withColumn("season", F.year("shipped"))
    return H.step_features(log, matches, overs_limit=DELIVERY_OVERS, season="season")


@register("step_features", STEP_SQL)
def q_step_features(spark, sf):
    s = step_table(spark, sf)
    return s.select("match_id", "over", "cum_runs", "cum_wickets", F.round("run_rate", R6).alias("run_rate"),
                    "venue_enc", "overs_limit", "season_idx", "final_score")


SEQ_SQL = with_ctes(DELIVERIES_SQL, _MT, body="""
SELECT s.match_id, CAST(s.ov AS INT) AS step,
  ROUND(CAST(CAST(s.ov / 19.0 AS FLOAT) AS DOUBLE), 5) AS over_norm,
  ROUND(CAST(CAST(LEAST(COALESCE(SUM(d.runs), 0) / 300.0, 1.0) AS FLOAT) AS DOUBLE), 5) AS runs_norm,
  ROUND(CAST(CAST(LEAST(COUNT(d.dismissal) / 10.0, 1.0) AS FLOAT) AS DOUBLE), 5) AS wickets_norm,
  ROUND(CAST(CAST(LEAST(COALESCE(SUM(d.runs), 0) / (s.ov + 1) / 15.0, 1.0) AS FLOAT) AS DOUBLE), 5) AS rate_norm,
  ROUND(CAST(CAST(GREATEST((10.0 - COUNT(d.dismissal)) / 10.0, 0.0) AS FLOAT) AS DOUBLE), 5) AS wickets_left_norm,
  ROUND(CAST(MAX(s.team1_runs) AS DOUBLE), 5) AS y_score
FROM (SELECT m.match_id, m.team1_runs, o.ov FROM mt m, range(0, 20) o(ov)) s
LEFT JOIN deliveries d ON d.match_id = s.match_id AND d.innings = 1 AND d.over_no <= s.ov
GROUP BY s.match_id, s.ov""")


@register("sequence_features", SEQ_SQL)
def q_sequence_features(spark, sf):
    seq = H.sequence_features(deliveries(spark, sf), _rollup(spark, sf), seq_len=20)
    ex = seq.select("match_id", "y_score", F.posexplode("seq").alias("step", "v"))
    names = ["over_norm", "runs_norm", "wickets_norm", "rate_norm", "wickets_left_norm"]
    return ex.select("match_id", F.col("step").cast("int").alias("step"),
                     *[F.round(F.col("v")[i].cast("double"), 5).alias(n) for i, n in enumerate(names)],
                     F.round(F.col("y_score").cast("double"), 5).alias("y_score"))


PFM_SQL = _recursive(with_ctes(CONTESTS_SQL, _AWARD_COUNTS, _ELO_REC, """r AS (
  SELECT a.award AS player_name, ROUND(e.rating, 2) AS elo_rating, CAST(a.n AS DOUBLE) AS match_count,
    CAST(a.n AS DOUBLE) AS pom_count, ROUND(a.n / a.n, 4) AS win_rate
  FROM award_counts a JOIN elo e ON e.n = a.n)""", """s AS (
  SELECT MIN(elo_rating) a1, MAX(elo_rating) b1, MIN(match_count) a2, MAX(match_count) b2,
         MIN(pom_count) a3, MAX(pom_count) b3, MIN(win_rate) a4, MAX(win_rate) b4 FROM r)""", body="""
SELECT player_name,
  ROUND((elo_rating - a1) / CASE WHEN b1 = a1 THEN 1.0 ELSE b1 - a1 END, 6) AS elo_rating,
  ROUND((match_count - a2) / CASE WHEN b2 = a2 THEN 1.0 ELSE b2 - a2 END, 6) AS match_count,
  ROUND((pom_count - a3) / CASE WHEN b3 = a3 THEN 1.0 ELSE b3 - a3 END, 6) AS pom_count,
  ROUND((win_rate - a4) / CASE WHEN b4 = a4 THEN 1.0 ELSE b4 - a4 END, 6) AS win_rate
FROM r, s"""))


@register("player_feature_matrix", PFM_SQL)
def q_player_feature_matrix(spark, sf):
    m = H.player_feature_matrix(H.elo_rating(contests(spark, sf)))
    return m.select("player_name", *[F.round(c, R6).alias(c) for c in
                                     ("elo_rating", "match_count", "pom_count", "win_rate")])


_STRENGTH_CTES = [CONTESTS_SQL, _AWARD_COUNTS, _ELO_REC, _HIST, """rated AS (
  SELECT c.*, h.rating_after FROM contests c LEFT JOIN hist h USING (match_id))""", """st AS (
  SELECT m.match_id, m.ts, m.side_a, m.side_b,
    COALESCE((SELECT AVG(p.rating_after) FROM rated p WHERE p.winner = m.side_a AND p.rating_after IS NOT NULL
              AND (p.ts < m.ts OR (p.ts = m.ts AND p.match_id < m.match_id))), 1500.0) AS sa,
    COALESCE((SELECT AVG(p.rating_after) FROM rated p WHERE p.winner = m.side_b AND p.rating_after IS NOT NULL
              AND (p.ts < m.ts OR (p.ts = m.ts AND p.match_id < m.match_id))), 1500.0) AS sb
  FROM contests m)"""]
LATEST_SQL = _recursive(with_ctes(*_STRENGTH_CTES, """ra AS (SELECT side_a AS team, arg_max(sa, (ts, match_id)) AS r FROM st GROUP BY side_a)""",
"""rb AS (SELECT side_b AS team, arg_max(sb, (ts, match_id)) AS r FROM st GROUP BY side_b)""", body="""
SELECT COALESCE(ra.team, rb.team) AS team, ROUND(COALESCE(ra.r, rb.r, 1500.0), 6) AS rating
FROM ra FULL OUTER JOIN rb ON ra.team = rb.team"""))


@register("latest_team_rating", LATEST_SQL)
def q_latest_team_rating(spark, sf):
    st = H.team_strength_running(contests(spark, sf))
    return H.latest_team_rating(st).select("team", F.round("rating", R6).alias("rating"))


_EARLIER = "OVER (PARTITION BY team ORDER BY ts, match_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
AS_OF_SQL = _recursive(with_ctes(*_STRENGTH_CTES, """sides AS (SELECT match_id, ts, 'a' AS side, side_a AS team, sa AS ra, NULL::DOUBLE AS rb FROM st
  UNION ALL SELECT match_id, ts, 'b', side_b, NULL::DOUBLE, sb FROM st)""",
                                 f"""known AS (SELECT *, COALESCE(LAST_VALUE(ra IGNORE NULLS) {_EARLIER}, LAST_VALUE(rb IGNORE NULLS) {_EARLIER}, 1500.0) AS r
  FROM sides)""", body="""
SELECT match_id, ROUND(MAX(CASE WHEN side = 'a' THEN r END), 6) AS a_latest, ROUND(MAX(CASE WHEN side = 'b' THEN r END), 6) AS b_latest
FROM known GROUP BY match_id"""))


@register("team_rating_as_of", AS_OF_SQL)
def q_team_rating_as_of(spark, sf):
    st = H.team_rating_as_of(H.team_strength_running(contests(spark, sf)))
    return st.select("match_id", F.round("a_latest", R6).alias("a_latest"), F.round("b_latest", R6).alias("b_latest"))


H2H_TOTAL_SQL = with_ctes(CONTESTS_SQL, body="""
SELECT LEAST(side_a, side_b) AS team_lo, GREATEST(side_a, side_b) AS team_hi, COUNT(*) AS played,
  CAST(SUM(CASE WHEN winner = LEAST(side_a, side_b) THEN 1 ELSE 0 END) AS BIGINT) AS lo_wins,
  CAST(SUM(CASE WHEN winner = GREATEST(side_a, side_b) THEN 1 ELSE 0 END) AS BIGINT) AS hi_wins
FROM contests GROUP BY 1, 2""")


@register("h2h_total", H2H_TOTAL_SQL)
def q_h2h_total(spark, sf):
    return H.h2h_total(contests(spark, sf))


VENUE_TOTAL_SQL = with_ctes(CONTESTS_SQL, body="""
SELECT venue, team, COUNT(*) AS played, CAST(SUM(CASE WHEN winner = team THEN 1 ELSE 0 END) AS BIGINT) AS wins
FROM (SELECT venue, side_a AS team, winner FROM contests UNION ALL SELECT venue, side_b, winner FROM contests) s
GROUP BY venue, team""")


@register("venue_total", VENUE_TOTAL_SQL)
def q_venue_total(spark, sf):
    return H.venue_total(contests(spark, sf))


# Innings state after the last ball of innings 1 for every match, projected to 20
# overs by the clamped run-rate forecast.
_STATE = """steps AS (
  SELECT s.match_id, s.ov, SUM(d.runs) AS cum_runs, SUM(d.runs) / (s.ov + 1) AS run_rate
  FROM (SELECT m.match_id, o.ov FROM mt m, range(0, 7) o(ov)) s
  JOIN deliveries d ON d.match_id = s.match_id AND d.innings = 1 AND d.over_no <= s.ov
  GROUP BY s.match_id, s.ov)""", """state AS (
  SELECT match_id, CAST(ov + 1 AS INT) AS overs_done, cum_runs, run_rate,
    CAST(GREATEST(ROUND(run_rate * 20), CAST(cum_runs AS DOUBLE)) AS BIGINT) AS predicted
  FROM steps WHERE ov = 6)"""

TRAJ_SQL = with_ctes(DELIVERIES_SQL, _MT, *_STATE, body="""
SELECT match_id, CAST(o.ov AS INT) AS over, 'actual' AS path, CAST(ROUND(run_rate * o.ov) AS BIGINT) AS runs
FROM state, range(1, 21) o(ov) WHERE o.ov <= overs_done
UNION ALL
SELECT match_id, CAST(o.ov AS INT) AS over, 'projected' AS path,
  CAST(cum_runs + ROUND((predicted - cum_runs) / GREATEST(1, 20 - overs_done) * (o.ov - overs_done)) AS BIGINT) AS runs
FROM state, range(0, 21) o(ov) WHERE o.ov >= overs_done""")


def innings_states(spark, sf):
    s = step_table(spark, sf).filter(F.col("over") == DELIVERY_OVERS - 1)
    return s.select("match_id", (F.col("over") + 1).alias("overs_done"), "cum_runs", "run_rate",
                    H.clamp_forecast(F.col("run_rate") * 20, F.col("cum_runs")).alias("predicted"))


@register("trajectory", TRAJ_SQL)
def q_trajectory(spark, sf):
    return H.trajectory(innings_states(spark, sf), ["match_id"], "overs_done", "cum_runs", "run_rate",
                        "predicted").select("match_id", F.col("over").cast("int").alias("over"), "path", "runs")


CLAMP_SQL = with_ctes(DELIVERIES_SQL, _MT, *_STATE, body="""
SELECT match_id, predicted AS forecast, ROUND(predicted / 20.0, 6) AS projected_rate,
  CAST(predicted - cum_runs AS BIGINT) AS runs_to_add FROM state""")


@register("clamp_forecast", CLAMP_SQL)
def q_clamp_forecast(spark, sf):
    forecast = F.col("predicted")
    return innings_states(spark, sf).select("match_id", forecast.alias("forecast"), F.round(H.projected_rate(forecast), R6).alias("projected_rate"),
                                            H.runs_to_add(forecast, F.col("cum_runs")).alias("runs_to_add"))


STACKED_SQL = _recursive(with_ctes(*_STRENGTH_CTES, body="""
SELECT match_id, CASE WHEN 1 / (1 + 10 ^ ((sb - sa) / 400)) >= 0.5 THEN side_a ELSE side_b END AS predicted_winner FROM st"""))


@register("stacked_winner", STACKED_SQL)
def q_stacked_winner(spark, sf):
    """The winner that the sides' running strengths make likelier."""
    st = H.team_strength_running(contests(spark, sf))
    p = 1 / (1 + F.pow(F.lit(10.0), (F.col("side_b_strength") - F.col("side_a_strength")) / 400))
    return st.select("match_id", H.stacked_winner(p, F.col("side_a"), F.col("side_b")).alias("predicted_winner"))


CONSENSUS_SQL = with_ctes(DELIVERIES_SQL, _MT, _STATE[0], """preds AS (
  SELECT match_id, ov, run_rate * 7 AS prediction FROM steps
  UNION ALL SELECT match_id, ov, cum_runs + 8.0 * (6 - ov) FROM steps
  UNION ALL SELECT match_id, ov, CAST(cum_runs AS DOUBLE) FROM steps)""", body="""
SELECT match_id, CAST(ov AS INT) AS over, ROUND(AVG(prediction), 6) AS mean_pred,
  ROUND(STDDEV_POP(prediction), 6) AS std_pred, ROUND(MIN(prediction), 6) AS min_pred,
  ROUND(MAX(prediction), 6) AS max_pred, COUNT(prediction) AS n_models
FROM preds GROUP BY match_id, ov""")


@register("ensemble_consensus", CONSENSUS_SQL)
def q_ensemble_consensus(spark, sf):
    s = step_table(spark, sf)
    preds = (s.select("match_id", "over", (F.col("run_rate") * DELIVERY_OVERS).alias("prediction"))
             .unionAll(s.select("match_id", "over",
                                (F.col("cum_runs") + 8.0 * (DELIVERY_OVERS - 1 - F.col("over"))).alias("prediction")))
             .unionAll(s.select("match_id", "over", F.col("cum_runs").cast("double").alias("prediction"))))
    c = H.ensemble_consensus(preds, ["match_id", "over"])
    return c.select("match_id", "over", *[F.round(x, R6).alias(x) for x in
                                          ("mean_pred", "std_pred", "min_pred", "max_pred")], "n_models")
