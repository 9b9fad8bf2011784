"""Contest-history features without look-ahead (match roll-up, prior wins,
ratings, step and sequence features).

The reference computes these with row loops over a growing prefix (quadratic in
the number of matches).  Here every "count over earlier rows" is a running total
(``crease.operators.scan.running_totals``) partitioned by the group key and split
into range blocks, so a hot team or pair does not land in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crease.functions.columns import season_index
from crease.operators.scan import last_known, order_bounds, running_totals

# Fixed values of the rating system (must equal the reference's for equal results):
ELO_K = 32.0
ELO_R0 = 1500.0
ELO_OPPONENT = 1500.0
ELO_SCALE = 400.0
# A dictionary of at most this many values is broadcast.
BROADCAST_ROWS = 50_000


def _flag(cond: Column) -> Column:
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


# ---------------------------------------------------------------------------
# M1 / M2: event log -> match table
# ---------------------------------------------------------------------------

def match_rollup(log: DataFrame, match: str = "match_id", innings: str = "innings",
                 runs: str = "runs", wicket: str = "dismissal", order: list[str] | None = None,
                 carry: list[str] | None = None, team_runs: str | None = None) -> DataFrame:
    """One row per match from a ball-by-ball log.

    * ``team1_runs`` / ``team2_runs``: max of the cumulative ``team_runs`` column of
      innings 1 / 2 when given, else the sum of ``runs``; absent innings 2 -> 0.
    * ``team1_wickets`` / ``team2_wickets``: rows with a non-null ``wicket``.
    * ``carry`` columns: value on the match's first row in ``order``.
    * Matches without innings 1 are skipped.
    One ``groupBy(match)``: map-side partial aggregation, one shuffle on the match key.
    """
    order = order or [innings]
    carry = carry or []
    key = F.struct(*[F.col(c) for c in order])
    r = F.col(team_runs) if team_runs else F.col(runs)
    agg_runs = F.max if team_runs else F.sum

    def inn(i: int, expr: Column) -> Column:
        return F.when(F.col(innings) == i, expr)

    aggs = [
        F.count(inn(1, F.lit(1))).alias("__n1"),
        F.coalesce(agg_runs(inn(1, r)), F.lit(0)).cast("long").alias("team1_runs"),
        F.count(inn(1, F.col(wicket))).alias("team1_wickets"),
        F.coalesce(agg_runs(inn(2, r)), F.lit(0)).cast("long").alias("team2_runs"),
        F.count(inn(2, F.col(wicket))).alias("team2_wickets"),
    ] + [F.min_by(F.col(c), key).alias(c) for c in carry]
    return log.groupBy(match).agg(*aggs).filter(F.col("__n1") > 0).drop("__n1")


def first_innings_total(log: DataFrame, match: str = "match_id", innings: str = "innings",
                        runs: str = "runs", by: list[str] | None = None) -> DataFrame:
    """Innings-1 runs per (match, *by); the match id is dropped, null rows removed."""
    by = by or []
    out = (log.filter(F.col(innings) == 1).groupBy(match, *by)
              .agg(F.sum(runs).cast("long").alias("first_innings_runs")))
    return out.drop(match).na.drop()


# ---------------------------------------------------------------------------
# M3 / M4: prior wins without look-ahead
# ---------------------------------------------------------------------------

def h2h_prior_wins(matches: DataFrame, a: str = "side_a", b: str = "side_b",
                   winner: str = "winner", order: list[str] | None = None,
                   out: str = "h2h_prior_wins", bounds: list[float] | None = None) -> DataFrame:
    """Earlier matches of the same unordered pair won by this row's ``a`` side.

    Running wins of the low and of the high side per (least, greatest) pair,
    exclusive of the row itself; pick the one that is ``a``.
    """
    order = order or ["ts", "match_id"]
    lo, hi = F.least(a, b), F.greatest(a, b)
    df = matches.withColumn("__lo", lo).withColumn("__hi", hi)
    rt = running_totals(df, ["__lo", "__hi"], order, {
        "__lo_w": _flag(F.col(winner) == F.col("__lo")),
        "__hi_w": _flag(F.col(winner) == F.col("__hi")),
    }, bounds=bounds)
    res = F.when(F.col(a) == F.col("__lo"), F.col("__lo_w")).otherwise(F.col("__hi_w"))
    return rt.withColumn(out, res.cast("long")).drop("__lo", "__hi", "__lo_w", "__hi_w")


def venue_prior_wins(matches: DataFrame, a: str = "side_a", venue: str = "venue",
                     winner: str = "winner", order: list[str] | None = None,
                     out: str = "venue_prior_wins", bounds: list[float] | None = None) -> DataFrame:
    """Earlier matches at the same venue with the same ``a`` side that ``a`` won."""
    order = order or ["ts", "match_id"]
    rt = running_totals(matches, [venue, a], order, {"__w": _flag(F.col(winner) == F.col(a))}, bounds=bounds)
    return rt.withColumn(out, F.col("__w").cast("long")).drop("__w")


# ---------------------------------------------------------------------------
# M5 / M6: ratings
# ---------------------------------------------------------------------------

def _elo_step(r: Column, k: float = ELO_K) -> Column:
    expected = 1.0 / (1.0 + F.pow(F.lit(10.0), (F.lit(ELO_OPPONENT) - r) / ELO_SCALE))
    return r + F.lit(k) * (1.0 - expected)


def elo_table(spark: SparkSession, max_n: int, k: float = ELO_K, r0: float = ELO_R0) -> DataFrame:
    """Rating after n = 1..max_n awards: (n long, rating double).

    The update depends only on the award count, so one table serves every
    player.  The recurrence is sequential; it is split in two levels of about
    sqrt(max_n) steps: one JVM fold computes the rating at the start of every
    chunk, then each chunk is expanded in parallel.
    """
    max_n = max(int(max_n), 0)
    if max_n == 0:
        return spark.createDataFrame([], "n long, rating double")
    chunk = max(64, int(math.isqrt(max_n)) + 1)
    n_chunks = (max_n + chunk - 1) // chunk
    starts = spark.range(1).select(F.aggregate(
        F.sequence(F.lit(1), F.lit(n_chunks - 1)) if n_chunks > 1 else F.array().cast("array<int>"),
        F.array(F.lit(float(r0))),
        lambda acc, _c: F.concat(acc, F.array(F.aggregate(
            F.sequence(F.lit(1), F.lit(chunk)), F.element_at(acc, -1), lambda r, _x: _elo_step(r, k)))),
    ).alias("starts"))
    chunks = starts.select(F.posexplode("starts").alias("c", "r_start"))

    n_parts = max(1, min(n_chunks, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    walk = F.aggregate(F.sequence(F.lit(1), F.lit(chunk)), F.array("r_start"),
                       lambda acc, _x: F.concat(acc, F.array(_elo_step(F.element_at(acc, -1), k))))
    return chunks.repartition(n_parts, "c").select("c", F.posexplode(F.slice(walk, 2, chunk)).alias("i", "rating")) \
        .select((F.col("c") * chunk + F.col("i") + 1).cast("long").alias("n"), "rating").filter(F.col("n") <= max_n)


def _awards(matches: DataFrame, award: str, winner: str) -> DataFrame:
    return matches.filter(F.col(award).isNotNull() & F.col(winner).isNotNull())


def elo_rating(matches: DataFrame, award: str = "award", winner: str = "winner") -> DataFrame:
    """Final rating per award winner: player_name, elo_rating (2 dp), match_count,
    pom_count, win_count, win_rate (4 dp).  Award count per player (one
    partial-aggregated shuffle), then a join with the rating table on the count."""
    spark = matches.sparkSession
    counts = _awards(matches, award, winner).groupBy(award).agg(F.count(F.lit(1)).alias("n"))
    max_n = counts.agg(F.max("n")).first()[0] or 0
    table = elo_table(spark, max_n)
    return (counts.join(table, "n").select(
        F.col(award).alias("player_name"),
        F.round("rating", 2).alias("elo_rating"),
        F.col("n").alias("match_count"), F.col("n").alias("pom_count"), F.col("n").alias("win_count"),
        F.round(F.col("n") / F.col("n"), 4).alias("win_rate")))


def elo_history(matches: DataFrame, award: str = "award", winner: str = "winner",
                order: list[str] | None = None, bounds: list[float] | None = None) -> DataFrame:
    """Rating of the award winner right after each award (point in time):
    input rows with an award + ``award_no`` and ``rating_after``."""
    order = order or ["ts", "match_id"]
    spark = matches.sparkSession
    aw = _awards(matches, award, winner)
    numbered = running_totals(aw, [award], order, {"award_no": F.lit(1)}, exclusive=False, bounds=bounds)
    max_n = aw.groupBy(award).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    table = elo_table(spark, max_n).withColumnRenamed("n", "award_no")
    return numbered.join(table.withColumnRenamed("rating", "rating_after"), "award_no")


# ---------------------------------------------------------------------------
# M7: running team strength
# ---------------------------------------------------------------------------

def team_strength_running(matches: DataFrame, a: str = "side_a", b: str = "side_b",
                          winner: str = "winner", award: str = "award",
                          order: list[str] | None = None, as_published: bool = False,
                          default: float = ELO_R0, bounds: list[float] | None = None) -> DataFrame:
    """Before each match, each side's mean award-winner rating over the side's
    earlier wins (``a_strength``, ``b_strength``), ``default`` when none.

    Point in time by default (the rating right after that award);
    ``as_published=True`` uses final ratings, which leaks later results.
    """
    order = order or ["ts", "match_id"]
    keycols = [c for c in order]
    if as_published:
        ratings = elo_rating(matches, award, winner).select(
            F.col("player_name").alias(award), F.col("elo_rating").alias("__rating"))
        rated = matches.join(ratings, award, "left")
    else:
        if bounds is None:
            bounds = order_bounds(matches, order[0])
        hist = elo_history(matches, award, winner, order, bounds=bounds).select(
            *keycols, F.col("rating_after").alias("__rating"))
        rated = matches.join(hist, keycols, "left")
    sides = (rated.select(*keycols, F.lit("a").alias("__side"), F.col(a).alias("__team"), winner, "__rating")
             .unionAll(rated.select(*keycols, F.lit("b").alias("__side"), F.col(b).alias("__team"),
                                    winner, "__rating")))
    gain = F.when((F.col("__team") == F.col(winner)) & F.col("__rating").isNotNull(), F.col("__rating"))
    rt = running_totals(sides, ["__team"], order, {
        "__s": F.coalesce(gain, F.lit(0.0)),
        "__c": F.when(gain.isNotNull(), F.lit(1)).otherwise(F.lit(0)),
    }, bounds=bounds)
    strength = F.when(F.col("__c") > 0, F.col("__s") / F.col("__c")).otherwise(F.lit(float(default)))
    per_side = rt.select(*keycols, "__side", strength.alias("__str"))
    wide = per_side.groupBy(*keycols).agg(
        F.max(F.when(F.col("__side") == "a", F.col("__str"))).alias(f"{a}_strength"),
        F.max(F.when(F.col("__side") == "b", F.col("__str"))).alias(f"{b}_strength"))
    return matches.join(wide, keycols, "left")


# ---------------------------------------------------------------------------
# M8: assembled match features
# ---------------------------------------------------------------------------

def match_features(matches: DataFrame, a: str = "side_a", b: str = "side_b",
                   winner: str = "winner", venue: str = "venue", toss_winner: str = "toss_winner",
                   toss_decision: str = "toss_decision", season: str = "season",
                   award: str = "award", order: list[str] | None = None,
                   base_season: int = 2008) -> DataFrame:
    """The classifier's input table: encodings, toss flags, season index,
    prior h2h and venue wins, running strengths and the target ``a_won``."""
    from crease.operators.prepare import dictionary_codes
    from crease.session import checkpoint_dir

    order = order or ["ts", "match_id"]
    checkpoint_dir(matches.sparkSession)
    used = list(dict.fromkeys([*order, a, b, winner, venue, toss_winner, award]))
    base = matches.select(*used).checkpoint()  # the narrow table is read once; all below goes on from it
    bounds = order_bounds(base, order[0])
    rating = elo_history(base.select(*order, award, winner), award, winner, order, bounds=bounds) \
        .select(*order, F.col("rating_after").alias("__rating"))
    lo, hi = F.least(a, b), F.greatest(a, b)

    def entry(at: str, kind: str, k1: Column, k2: Column, v1: Column, v2: Column) -> Column:
        return F.struct(F.lit(at).alias("__at"), F.lit(kind).alias("__kind"), k1.cast("string").alias("__k1"),
                        k2.cast("string").alias("__k2"), v1.cast("double").alias("__v1"), v2.cast("double").alias("__v2"))

    def gained(side: str) -> tuple[Column, Column]:
        got = (F.col(side) == F.col(winner)) & F.col("__rating").isNotNull()
        return F.when(got, F.col("__rating")).otherwise(F.lit(0.0)), F.coalesce(_flag(got), F.lit(0))

    # every running feature is a running sum over (kind, key): one blocked scan of the long form
    none = F.lit("")
    long = base.join(rating, order, "left").select(*order, F.explode(F.array(
        entry("pair", "pair", lo, hi, _flag(F.col(winner) == lo), _flag(F.col(winner) == hi)),
        entry("venue", "venue", F.col(venue), F.col(a), _flag(F.col(winner) == F.col(a)), F.lit(0)),
        entry("a", "side", F.col(a), none, *gained(a)), entry("b", "side", F.col(b), none, *gained(b)))).alias("__e")) \
        .select(*order, "__e.*").checkpoint()
    sums = running_totals(long, ["__kind", "__k1", "__k2"], order, {"__s1": F.col("__v1"), "__s2": F.col("__v2")}, bounds=bounds)
    of = lambda at, c: F.max(F.when(F.col("__at") == at, F.col(c)))
    wide = sums.groupBy(*order).agg(of("pair", "__s1").alias("__lo_w"), of("pair", "__s2").alias("__hi_w"),
                                    of("venue", "__s1").cast("long").alias("venue_a_wins"),
                                    *[of(k, c).alias(f"__{k}{c}") for k in ("a", "b") for c in ("__s1", "__s2")])

    def strength(k: str) -> Column:
        return F.when(F.col(f"__{k}__s2") > 0, F.col(f"__{k}__s1") / F.col(f"__{k}__s2")).otherwise(F.lit(ELO_R0))

    df = matches.join(wide, order)
    df = df.select(*matches.columns, F.when(F.col(a) == lo, F.col("__lo_w")).otherwise(F.col("__hi_w")).cast("long").alias("a_h2h_wins"),
                   "venue_a_wins", strength("a").alias(f"{a}_strength"), strength("b").alias(f"{b}_strength"),
                   _flag(F.col(winner) == F.col(a)).alias("a_won"), _flag(F.col(toss_decision) == "bat").alias("toss_bat_first"),
                   _flag(F.col(toss_winner) == F.col(a)).alias("toss_winner_is_a"),
                   (F.col(season).cast("int") - base_season).alias("season_idx"))

    def codes_of(values: DataFrame) -> DataFrame:
        codes = dictionary_codes(values, "v").checkpoint()
        return F.broadcast(codes) if codes.count() <= BROADCAST_ROWS else codes

    team_codes = codes_of(base.select(F.explode(F.array(a, b, toss_winner)).alias("v")))
    venue_codes = codes_of(base.select(F.col(venue).alias("v")))
    for col, codes in ((a, team_codes), (b, team_codes), (toss_winner, team_codes), (venue, venue_codes)):
        df = df.join(codes.select(F.col("v").alias(col), F.col("code").alias(f"{col}_enc")),
                     col, "left").withColumn(f"{col}_enc", F.coalesce(f"{col}_enc", F.lit(0)))
    return df


# ---------------------------------------------------------------------------
# Per-over step features and fixed-length sequences
# ---------------------------------------------------------------------------

def _over_spine(log: DataFrame, match_tbl: DataFrame, match: str, innings: str, over: str,
                runs: str, wicket: str, n_steps_col: Column) -> DataFrame:
    """``match_tbl`` with ``__steps``, the cumulative runs and wickets of innings 1 after
    every over (an array: ``over``, ``cum_runs``, ``__cw``), and ``__first``, the first
    over with runs.  A match stays one row: its overs meet in one array, so
    neither the steps nor a join of them are sorted or shuffled."""
    x = F.col(over)
    per_over = (log.filter((F.col(innings) == 1) & (x >= 0) & (x == x.cast("int"))).groupBy(match, x.cast("int").alias("o"))
                   .agg(F.sum(runs).alias("r"), F.count(wicket).alias("w")))
    zero = F.lit(0).cast(per_over.schema["r"].dataType)
    held = per_over.groupBy(match).agg(F.sort_array(F.collect_list(F.struct("o", "r", "w"))).alias("__b"))
    add = lambda field, start, upto: F.coalesce(F.aggregate(
        F.filter("__b", lambda e: e["o"] <= upto), start,
        lambda have, e: (have + F.coalesce(e[field], start)).cast(per_over.schema[field].dataType)), start)
    steps = F.transform(F.sequence(F.lit(0), n_steps_col - 1), lambda s: F.struct(
        s.alias("over"), add("r", zero, s).alias("cum_runs"), add("w", F.lit(0).cast("long"), s).alias("__cw")))
    first = F.array_min(F.transform(F.filter("__b", lambda e: e["r"].isNotNull() & (e["o"] < n_steps_col)), lambda e: e["o"]))
    return match_tbl.join(held, match, "left").select(*match_tbl.columns, first.alias("__first"), steps.alias("__steps"))


def step_features(log: DataFrame, match_tbl: DataFrame, match: str = "match_id",
                  innings: str = "innings", over: str = "over_no", runs: str = "runs",
                  wicket: str = "dismissal", venue: str = "venue",
                  overs_limit: int | str = 20, final: str = "team1_runs", season: str | None = None) -> DataFrame:
    """One row per (match, over) for over 0..limit-1 of innings 1: cumulative runs and
    wickets (cap 10), run rate = runs / (over + 1), venue code, final score and, with
    the match table's ``season``, the season index.
    Overs before the first ball are skipped; after the last ball values carry.
    A match has at most ``limit`` overs, so the per-match window is bounded."""
    from crease.operators.prepare import dictionary_codes

    from crease.session import checkpoint_dir

    lim = F.col(overs_limit) if isinstance(overs_limit, str) else F.lit(int(overs_limit))
    # The match table feeds the spine, the venue dictionary and the final join:
    # materialise it once (one row per match, far smaller than the log) in the
    # shared checkpoint folder instead of re-deriving it from the log three times.
    checkpoint_dir(match_tbl.sparkSession)
    mt = match_tbl.select(match, venue, final, lim.alias("overs_limit"), *([season] if season else [])).checkpoint()
    # matches without innings-1 balls have no first over and drop out here
    steps = _over_spine(log, mt, match, innings, over, runs, wicket, F.col("overs_limit")).filter(F.col(match).isNotNull())
    codes = dictionary_codes(mt.select(F.col(venue).alias("v")), "v")
    out = steps.join(codes.select(F.col("v").alias(venue), F.col("code").alias("venue_enc")), venue, "left") \
        .select(*mt.columns, "venue_enc", "__first", F.explode("__steps").alias("__s")) \
        .select("*", "__s.*").filter(F.col("over") >= F.col("__first"))
    return out.select(
        match, "over", F.col("cum_runs").cast("long").alias("cum_runs"),
        F.least(F.col("__cw"), F.lit(10)).cast("long").alias("cum_wickets"),
        (F.col("cum_runs") / (F.col("over") + 1)).alias("run_rate"),
        F.coalesce("venue_enc", F.lit(0)).alias("venue_enc"),
        F.col("overs_limit").cast("int").alias("overs_limit"),
        *([season_index(season).alias("season_idx")] if season else []),
        F.col(final).cast("long").alias("final_score"))


def sequence_features(log: DataFrame, match_tbl: DataFrame, match: str = "match_id",
                      innings: str = "innings", over: str = "over_no", runs: str = "runs",
                      wicket: str = "dismissal", seq_len: int = 20, final: str = "team1_runs",
                      won: Column | None = None) -> DataFrame:
    """Per match an array of ``seq_len`` steps x 5 floats:
    over/19, min(cum_runs/300, 1), min(wkts/10, 1), min(rr/15, 1), max((10-wkts)/10, 0).
    Steps before the first ball have zero cumulative values.  Labels y_win, y_score."""
    mt = match_tbl.join(log.filter(F.col(innings) == 1).select(match).distinct(), match, "left_semi")
    mt = mt.select(match, F.col(final).cast("float").alias("y_score"),
                   (won if won is not None else F.lit(0)).cast("float").alias("y_win"))
    steps = _over_spine(log, mt, match, innings, over, runs, wicket, F.lit(seq_len))

    def vec(s: Column) -> Column:
        cw, cr = s["__cw"].cast("double"), s["cum_runs"].cast("double")
        return F.array(  # fixed values: the five divisors
            (s["over"] / 19.0).cast("float"),
            F.least(cr / 300.0, F.lit(1.0)).cast("float"),
            F.least(cw / 10.0, F.lit(1.0)).cast("float"),
            F.least(cr / (s["over"] + 1) / 15.0, F.lit(1.0)).cast("float"),
            F.greatest((10.0 - cw) / 10.0, F.lit(0.0)).cast("float"))

    return steps.select(match, F.transform("__steps", vec).alias("seq"), "y_win", "y_score")


# ---------------------------------------------------------------------------
# Player matrix, lookups, trajectories, consensus
# ---------------------------------------------------------------------------

def player_feature_matrix(ratings: DataFrame, key: str = "player_name",
                          cols: tuple = ("elo_rating", "match_count", "pom_count", "win_rate")) -> DataFrame:
    """The four rating columns (absent -> 0, null -> 0) min-max scaled to [0, 1];
    a constant column scales to 0."""
    df = ratings
    for c in cols:
        df = df.withColumn(c, F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in ratings.columns
                           else F.lit(0.0))
    stats = df.agg(*[F.min(c).alias(f"{c}__mn") for c in cols], *[F.max(c).alias(f"{c}__mx") for c in cols])
    j = df.crossJoin(F.broadcast(stats))  # one-row statistics table
    out = [key]
    for c in cols:
        rng = F.col(f"{c}__mx") - F.col(f"{c}__mn")
        out.append(((F.col(c) - F.col(f"{c}__mn")) / F.when(rng == 0, F.lit(1.0)).otherwise(rng)).alias(c))
    return j.select(*out)


def latest_team_rating(features: DataFrame, a: str = "side_a", b: str = "side_b",
                       a_rating: str = "side_a_strength", b_rating: str = "side_b_strength",
                       order: list[str] | None = None, default: float = ELO_R0) -> DataFrame:
    """Per team: rating on its last row as side a, else last as side b, else default."""
    order = order or ["ts", "match_id"]
    key = F.struct(*[F.col(c) for c in order])
    as_a = features.groupBy(F.col(a).alias("team")).agg(F.max_by(a_rating, key).alias("__ra"))
    as_b = features.groupBy(F.col(b).alias("team")).agg(F.max_by(b_rating, key).alias("__rb"))
    return (as_a.join(as_b, "team", "full")
                .select("team", F.coalesce("__ra", "__rb", F.lit(default)).alias("rating")))


def team_rating_as_of(features: DataFrame, a: str = "side_a", b: str = "side_b",
                      a_rating: str = "side_a_strength", b_rating: str = "side_b_strength",
                      order: list[str] | None = None, default: float = ELO_R0) -> DataFrame:
    """``latest_team_rating`` at every match: for both sides the rating on their last
    earlier row as side a, else as side b, else the default (``a_latest``, ``b_latest``)."""
    order = order or ["ts", "match_id"]
    rows = features.select(*order, F.lit("a").alias("__side"), F.col(a).alias("__team"), F.col(a_rating).alias("__ra"),
                           F.lit(None).cast("double").alias("__rb")) \
        .unionAll(features.select(*order, F.lit("b"), F.col(b), F.lit(None).cast("double"), F.col(b_rating)))
    known = last_known(rows, ["__team"], order, {"__as_a": F.col("__ra"), "__as_b": F.col("__rb")})
    latest = F.coalesce("__as_a", "__as_b", F.lit(float(default)))
    wide = known.groupBy(*order).agg(F.max(F.when(F.col("__side") == "a", latest)).alias("a_latest"),
                                     F.max(F.when(F.col("__side") == "b", latest)).alias("b_latest"))
    return features.join(wide, order, "left")


def h2h_total(matches: DataFrame, a: str = "side_a", b: str = "side_b", winner: str = "winner") -> DataFrame:
    """All-time record per unordered pair: matches, wins of the low and high side."""
    lo, hi = F.least(a, b), F.greatest(a, b)
    return (matches.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(lo.alias("team_lo"), hi.alias("team_hi"))
            .agg(F.count(F.lit(1)).alias("played"),
                 F.sum(_flag(F.col(winner) == lo)).cast("long").alias("lo_wins"),
                 F.sum(_flag(F.col(winner) == hi)).cast("long").alias("hi_wins")))


def venue_total(matches: DataFrame, a: str = "side_a", b: str = "side_b", winner: str = "winner",
                venue: str = "venue") -> DataFrame:
    """All-time wins per (venue, team) counting both roles."""
    sides = (matches.select(venue, F.col(a).alias("team"), winner)
             .unionAll(matches.select(venue, F.col(b).alias("team"), winner)))
    return (sides.filter(F.col(venue).isNotNull() & F.col("team").isNotNull()).groupBy(venue, "team")
            .agg(F.count(F.lit(1)).alias("played"),
                 F.sum(_flag(F.col(winner) == F.col("team"))).cast("long").alias("wins")))


def trajectory(states: DataFrame, key: list[str], overs_done: str, runs: str, run_rate: str,
               predicted: str, total_overs: int = 20) -> DataFrame:
    """Worm chart rows for a batch of innings states: the past path
    round(run_rate * over) for over 1..now, then the projection
    runs + round((pred - runs) / max(1, remaining) * (over - now)) for over now..total."""
    now = F.col(overs_done)
    past = states.select(*key, F.explode(F.sequence(F.lit(1), F.greatest(now, F.lit(1)))).alias("over"),
                         now.alias("__now"), F.col(run_rate).alias("__rr"))
    past = past.filter(F.col("over") <= F.col("__now")).select(
        *key, "over", F.lit("actual").alias("path"), F.round(F.col("__rr") * F.col("over")).cast("long").alias("runs"))
    fut = states.select(*key, now.alias("__now"), F.col(runs).alias("__runs"), F.col(predicted).alias("__p"),
                        F.explode(F.sequence(now, F.lit(total_overs))).alias("over"))
    rpo = (F.col("__p") - F.col("__runs")) / F.greatest(F.lit(1), F.lit(total_overs) - F.col("__now"))
    fut = fut.select(*key, "over", F.lit("projected").alias("path"),
                     (F.col("__runs") + F.round(rpo * (F.col("over") - F.col("__now")))).cast("long").alias("runs"))
    return past.unionByName(fut)


def clamp_forecast(pred: Column, runs_so_far: Column) -> Column:
    """max(round(prediction), runs so far)."""
    return F.greatest(F.round(pred), runs_so_far.cast("double")).cast("long")


def projected_rate(forecast: Column, overs: int = 20) -> Column:
    """Run rate of a whole innings that ends at the forecast."""
    return forecast / F.lit(float(overs))


def runs_to_add(forecast: Column, runs_so_far: Column) -> Column:
    """Runs between now and the forecast."""
    return (forecast - runs_so_far).cast("long")


def stacked_winner(probability: Column, a: Column, b: Column) -> Column:
    """Side a where its (stacked) probability is a half or more, else side b."""
    return F.when(probability >= 0.5, a).when(probability.isNotNull(), b)


def ensemble_consensus(preds: DataFrame, case: list[str], value: str = "prediction") -> DataFrame:
    """Mean, population std, min and max over the models' outputs per case."""
    return preds.groupBy(*case).agg(
        F.avg(value).alias("mean_pred"), F.stddev_pop(value).alias("std_pred"),
        F.min(value).alias("min_pred"), F.max(value).alias("max_pred"),
        F.count(value).alias("n_models"))


def fifty_flag(log: DataFrame, keys: list[str], runs: str = "runs", context: list[str] | None = None,
               order: list[str] | None = None, threshold: int = 50) -> DataFrame:
    """Per ``keys`` (e.g. match, batter): runs, a 0/1 flag runs >= threshold and the
    context columns of the group's first row in ``order`` -- one aggregate."""
    context = context or []
    key = F.struct(*[F.col(c) for c in (order or keys)])
    out = log.dropna(subset=keys).groupBy(*keys).agg(F.sum(runs).cast("long").alias(runs),
                                 *[F.min_by(F.col(c), key).alias(c) for c in context])
    return out.select(*keys, runs, _flag(F.col(runs) >= threshold).alias("fifty"), *context)
