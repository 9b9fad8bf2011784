"""Report queries: counts, top-k, standings, rates, matrices, career tables,
line-ups and leaderboards (aggregation, join, set, sort and window operators).

Per-key aggregates use ``groupBy`` (map-side partial aggregation absorbs hot
keys); "best row per group" uses ``min_by``/``max_by`` aggregates rather than a
``row_number`` window, so a hot group is combined before the shuffle.  Top-k
uses ``orderBy().limit(k)`` (per-partition top-k, then a k-row merge).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crease.functions.columns import assign_role
from crease.operators.scan import quantiles


def _flag(cond: Column) -> Column:
    return F.when(cond, 1).otherwise(0)


def group_count(df: DataFrame, key: str, out: str = "count") -> DataFrame:
    """Rows per non-null key, sorted by key."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(out)).orderBy(key)


def top_k_counts(df: DataFrame, key: str, k: int = 10, out: str = "count") -> DataFrame:
    """The k most frequent non-null values (ties -> smaller value)."""
    return (df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(out))
              .orderBy(F.desc(out), key).limit(k))


def top_per_group(df: DataFrame, group: str, value: str, out: str = "wins") -> DataFrame:
    """Per group, the most frequent value and its count (ties -> smallest value)."""
    counts = (df.filter(F.col(group).isNotNull() & F.col(value).isNotNull())
                .groupBy(group, value).agg(F.count(F.lit(1)).alias(out)))
    best = F.min_by(F.struct(F.col(value).alias("v"), F.col(out).alias("n")),
                    F.struct((-F.col(out)).alias("neg"), F.col(value).alias("v")))
    return counts.groupBy(group).agg(best.alias("__b")).select(
        group, F.col("__b.v").alias(value), F.col("__b.n").alias(out))


def side_union_standings(df: DataFrame, a: str = "side_a", b: str = "side_b", winner: str = "winner") -> DataFrame:
    """Per team: played (either side), won, lost = played - won, win_pct (1 dp)."""
    sides = df.select(F.col(a).alias("team"), winner).unionAll(df.select(F.col(b).alias("team"), winner))
    s = (sides.filter(F.col("team").isNotNull()).groupBy("team")
              .agg(F.count(F.lit(1)).alias("played"), F.sum(_flag(F.col(winner) == F.col("team"))).cast("long").alias("won")))
    return s.select("team", "played", "won", (F.col("played") - F.col("won")).alias("lost"),
                    F.round(F.col("won") / F.col("played") * 100.0, 1).alias("win_pct")).orderBy(F.desc("won"), "team")


def rate_by_group(df: DataFrame, key: str, flag: Column, out: str = "win_pct") -> DataFrame:
    """mean(flag) x 100 (1 dp) and the row count per key."""
    return (df.filter(F.col(key).isNotNull()).groupBy(key)
              .agg(F.round(F.avg(flag.cast("double")) * 100.0, 1).alias(out), F.count(F.lit(1)).alias("matches")))


def win_matrix(df: DataFrame, a: str = "side_a", b: str = "side_b", winner: str = "winner",
               venue: str = "venue", k: int = 10) -> DataFrame:
    """Top-k teams (appearances) x top-k venues (matches): win % = wins at the
    venue / appearances at the venue (1 dp), 0 when never played; long form with
    the full k x k spine (pivot it for a heat map)."""
    sides = df.select(F.col(a).alias("team"), venue, winner).unionAll(df.select(F.col(b).alias("team"), venue, winner))
    teams = top_k_counts(sides, "team", k).select("team")
    venues = top_k_counts(df, venue, k).select(venue)
    spine = teams.crossJoin(venues)  # at most k x k rows
    played = sides.join(teams, "team", "left_semi").join(venues, venue, "left_semi") \
                  .groupBy("team", venue).agg(F.count(F.lit(1)).alias("total"))
    wins = df.filter(F.col(winner).isNotNull()).select(F.col(winner).alias("team"), venue) \
             .join(teams, "team", "left_semi").join(venues, venue, "left_semi") \
             .groupBy("team", venue).agg(F.count(F.lit(1)).alias("wins"))
    j = spine.join(played, ["team", venue], "left").join(wins, ["team", venue], "left")
    tot = F.coalesce("total", F.lit(0))
    return j.select("team", venue, F.when(tot > 0, F.round(F.coalesce("wins", F.lit(0)) / tot * 100.0, 1))
                    .otherwise(F.lit(0.0)).alias("win_pct"), tot.alias("total"))


def pair_record(df: DataFrame, a: str = "side_a", b: str = "side_b", winner: str = "winner") -> DataFrame:
    """All pairs at once: matches in either order, wins of each side, other results."""
    lo, hi = F.least(a, b), F.greatest(a, b)
    return (df.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(lo.alias("team_a"), hi.alias("team_b"))
              .agg(F.count(F.lit(1)).alias("total"),
                   F.sum(_flag(F.col(winner) == lo)).cast("long").alias("a_wins"),
                   F.sum(_flag(F.col(winner) == hi)).cast("long").alias("b_wins"))
              .withColumn("other", F.col("total") - F.col("a_wins") - F.col("b_wins")))


def pair_history(df: DataFrame, team_a, team_b, a: str = "side_a", b: str = "side_b",
                 order_desc: str = "ts") -> DataFrame:
    """The matches of one pair in either order, newest first."""
    cond = ((F.col(a) == team_a) & (F.col(b) == team_b)) | ((F.col(a) == team_b) & (F.col(b) == team_a))
    return df.filter(cond).orderBy(F.desc(order_desc))


def batting_career(log: DataFrame, batter: str = "batter", runs: str = "runs", ball: str = "seq") -> DataFrame:
    """Per batter: runs, balls (non-null ball ids), fours, sixes."""
    return log.filter(F.col(batter).isNotNull()).groupBy(batter).agg(F.sum(runs).cast("long").alias("runs"), F.count(ball).alias("balls"),
                                   F.count_if(F.col(runs) == 4).alias("fours"),
                                   F.count_if(F.col(runs) == 6).alias("sixes"))


def two_level_aggregate(log: DataFrame, batter: str = "batter", match: str = "match_id",
                        runs: str = "runs", fifty: int = 50, hundred: int = 100) -> DataFrame:
    """Per (batter, match) runs, then per batter: high score, #50-99, #>=100."""
    per = log.filter(F.col(batter).isNotNull() & F.col(match).isNotNull()).groupBy(batter, match).agg(F.sum(runs).alias("__r"))
    return per.groupBy(batter).agg(F.max("__r").cast("long").alias("high_score"),
                                   F.count_if((F.col("__r") >= fifty) & (F.col("__r") < hundred)).alias("fifties"),
                                   F.count_if(F.col("__r") >= hundred).alias("hundreds"))


def bowling_career(log: DataFrame, bowler: str = "bowler", wicket: str = "dismissal", runs: str = "runs",
                   ball: str = "seq") -> DataFrame:
    """Per bowler: dismissals (non-null), balls, runs conceded, economy = runs / balls x 6."""
    s = log.filter(F.col(bowler).isNotNull()).groupBy(bowler).agg(F.count(wicket).alias("wickets"), F.count(ball).alias("balls_bowled"),
                                F.sum(runs).cast("long").alias("runs_conceded"))
    return s.withColumn("econ", F.when(F.col("balls_bowled") > 0,
                                       F.col("runs_conceded") / F.col("balls_bowled") * 6.0).otherwise(F.lit(0.0)))


def best_figures(log: DataFrame, bowler: str = "bowler", match: str = "match_id", wicket: str = "dismissal",
                 runs: str = "runs") -> DataFrame:
    """Per bowler the match maximising 100 x wickets - runs, as text 'w/r'
    (ties -> smaller match id)."""
    per = log.filter(F.col(bowler).isNotNull() & F.col(match).isNotNull()) \
        .groupBy(bowler, match).agg(F.count(wicket).alias("w"), F.sum(runs).alias("r"))
    key = F.struct((F.col("w") * 100 - F.col("r")).alias("s"), (-F.col(match)).alias("m"))
    best = per.groupBy(bowler).agg(F.max_by(F.struct("w", "r"), key).alias("__b"))
    return best.select(bowler, F.concat_ws("/", F.col("__b.w").cast("string"), F.col("__b.r").cast("string"))
                       .alias("best_bowling"))


def left_merge(left: DataFrame, right: DataFrame, on: list[str] | str) -> DataFrame:
    return left.join(right, on, "left")


def outer_merge_coalesce(bat: DataFrame, bowl: DataFrame, bat_key: str = "batter", bowl_key: str = "bowler",
                         key: str = "player_name") -> DataFrame:
    """Full outer join on the player; key = coalesce; numbers null -> 0 (text
    stays null); strike rate and economy guarded against zero balls."""
    b = bat.withColumnRenamed(bat_key, "__bk")
    w = bowl.withColumnRenamed(bowl_key, "__wk")
    j = b.join(w, F.col("__bk") == F.col("__wk"), "full")
    j = j.withColumn(key, F.coalesce(F.col("__bk"), F.col("__wk"))).drop("__bk", "__wk")
    nums = [f.name for f in j.schema.fields if f.dataType.typeName() in ("long", "integer", "double")
            and f.name != key]
    j = j.na.fill(0, subset=nums)
    if "balls" in j.columns and "runs" in j.columns:
        j = j.withColumn("sr", F.when(F.col("balls") > 0, F.col("runs") / F.col("balls") * 100.0).otherwise(F.lit(0.0)))
    return j


def player_table(log: DataFrame, keepers: list | None = None) -> DataFrame:
    """Career table of every player: batting, high scores, bowling, best figures,
    outer-merged, with the role rule applied."""
    bat = batting_career(log).join(two_level_aggregate(log), "batter", "left")
    bowl = bowling_career(log).join(best_figures(log), "bowler", "left")
    p = outer_merge_coalesce(bat, bowl)
    return p.withColumn("role", assign_role("player_name", "runs", "wickets", keepers))


def inner_merge(left: DataFrame, right: DataFrame, on: list[str] | str) -> DataFrame:
    return left.join(right, on, "inner")


def union_distinct(log: DataFrame, pairs: list[tuple[str, str]], names: tuple[str, str] = ("player", "team")) -> DataFrame:
    """Distinct (player, team) over several column pairs, nulls dropped."""
    parts = [log.select(F.col(p).alias(names[0]), F.col(t).alias(names[1])) for p, t in pairs]
    return reduce(DataFrame.unionAll, parts).na.drop().distinct()


def in_list_semi(df: DataFrame, keys: DataFrame, on: str, anti: bool = False) -> DataFrame:
    """Rows whose key is (not) in a computed set."""
    return df.join(keys, on, "left_anti" if anti else "left_semi")


def batter_form(log: DataFrame, batter: str = "batter", runs: str = "runs", extra: str = "extra_type",
                min_balls: int = 100) -> DataFrame:
    """Per batter: runs, balls faced (wides excluded), fours, sixes; batters with
    >= min_balls; strike rate and boundary %."""
    not_wide = ~F.coalesce(F.col(extra).contains("wides"), F.lit(False))
    s = (log.filter(F.col(batter).isNotNull()).groupBy(batter).agg(F.sum(runs).cast("long").alias("runs"), F.count_if(not_wide).alias("balls"),
                                 F.count_if(F.col(runs) == 4).alias("fours"), F.count_if(F.col(runs) == 6).alias("sixes"))
            .filter(F.col("balls") >= min_balls))
    return s.select("*", (F.col("runs") / F.col("balls") * 100.0).alias("strike_rate"),
                    ((F.col("fours") + F.col("sixes")) / F.col("balls") * 100.0).alias("boundary_pct"))


def bowler_form(log: DataFrame, bowler: str = "bowler", wicket_flag: Column | None = None,
                valid_ball: Column | None = None, runs: Column | None = None, min_balls: int = 60) -> DataFrame:
    """Per bowler: credited wickets, valid balls (null -> 1), runs; bowlers with
    >= min_balls; economy = runs / balls x 6, average = runs / wickets (0 wickets -> runs)."""
    wf = wicket_flag if wicket_flag is not None else F.lit(0)
    vb = valid_ball if valid_ball is not None else F.lit(1)
    rr = runs if runs is not None else F.lit(0)
    s = (log.filter(F.col(bowler).isNotNull()).groupBy(bowler).agg(F.sum(F.coalesce(wf, F.lit(0))).cast("long").alias("wickets"),
                                 F.sum(F.coalesce(vb, F.lit(1))).cast("long").alias("balls"),
                                 F.sum(F.coalesce(rr, F.lit(0))).cast("double").alias("runs"))
            .filter(F.col("balls") >= min_balls))
    return s.select("*", (F.col("runs") / F.col("balls") * 6.0).alias("economy"),
                    F.when(F.col("wickets") > 0, F.col("runs") / F.col("wickets")).otherwise(F.col("runs")).alias("average"))


def role_quota_top_k(pool: DataFrame, quotas: dict[str, int], rating: str = "rating", player: str = "player",
                     role: str = "role", teams: list | None = None, team: str = "team") -> DataFrame:
    """Best line-up: per role the top-n players by rating (ties -> name), each
    player once (their best row).  The ranking window is partitioned by role over
    the de-duplicated pool; a quota table bounds the output."""
    p = pool.filter(F.col(team).isin(*teams)) if teams else pool
    p = p.filter(F.col(role).isin(*quotas.keys()))
    best = p.groupBy(player, role).agg(F.max_by(F.struct(rating, team), F.struct(rating, F.col(team))).alias("__b"))
    best = best.select(player, role, F.col(f"__b.{rating}").alias(rating), F.col(f"__b.{team}").alias(team))
    # one row per player: the role whose rating is highest (ties -> role name)
    best = best.groupBy(player).agg(F.max_by(F.struct(role, rating, team), F.struct(rating, F.col(role))).alias("__p")) \
               .select(player, "__p.*")
    from crease.operators.scan import top_n
    q = pool.sparkSession.createDataFrame(list(quotas.items()), f"{role} string, __quota int")
    # a role may hold most players: salted two-phase top-n up to the largest quota
    ranked = top_n(best.join(F.broadcast(q), role), [role], [F.desc(rating), F.col(player)],
                   max(quotas.values()), salt_by=[player])
    return ranked.filter(F.col("rank") <= F.col("__quota")).drop("__quota")


def lineup_summary(lineup: DataFrame, rating: str = "rating", by: str = "team") -> DataFrame:
    """Members and total / average rating per ``by`` value."""
    return lineup.groupBy(by).agg(F.count(F.lit(1)).alias("members"), F.sum(rating).alias("total_rating"),
                                  F.avg(rating).alias("avg_rating"))


def leaderboard(df: DataFrame, rating: str, k: int = 30, key: str | None = None) -> DataFrame:
    """Top k by rating (ties -> key) with rank 1..k.  The rank is assigned after
    the k-row limit, so the window sees only k rows."""
    order = [F.desc(rating)] + ([F.col(key)] if key else [])
    top = df.orderBy(*order).limit(k)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def profile_compare(df: DataFrame, key: str, entities: list, metrics: list[str]) -> DataFrame:
    """Metrics of the chosen entities in long form (entity, metric, value)."""
    sub = df.filter(F.col(key).isin(*entities)).select(key, *[F.col(m).cast("double").alias(m) for m in metrics])
    return sub.unpivot([key], metrics, "metric", "value")


def distinct_values(df: DataFrame, cols: list[str], out: str = "value") -> DataFrame:
    """Sorted distinct non-null values over several columns."""
    parts = [df.select(F.col(c).alias(out)) for c in cols]
    return reduce(DataFrame.unionAll, parts).filter(F.col(out).isNotNull()).distinct().orderBy(out)


def group_mean_profile(df: DataFrame, group: str, metrics: list[str], labels: dict | None = None) -> DataFrame:
    """Per group: members and metric means (3 dp), plus a label when given."""
    from crease.functions.columns import archetype_label
    s = df.groupBy(group).agg(F.count(F.lit(1)).alias("members"),
                              *[F.round(F.avg(m), 3).alias(f"avg_{m}") for m in metrics])
    return s.withColumn("label", archetype_label(group, labels)) if labels else s


def category_aggregate(df: DataFrame, cat: str, num: str, how: str = "mean", top: int | None = None) -> DataFrame:
    """Mean or median of ``num`` per category, of all or (for a chart) of the
    ``top`` most frequent ones."""
    d = df.filter(F.col(cat).isNotNull() & F.col(num).isNotNull())
    if top is not None:
        d = d.join(top_k_counts(d, cat, top).select(cat), cat, "left_semi")
    if how == "mean":
        out = d.groupBy(cat).agg(F.avg(num).alias(f"{how}_{num}"))
    else:
        out = quantiles(d, {"__q": (F.col(num), [0.5])}, [cat]).select(cat, F.col("__q")[0].alias(f"{how}_{num}"))
    return out.orderBy(F.desc(f"{how}_{num}"))
