"""Seeded synthetic match table with planted defects.

Rows are derived from an id column of a real table, so the output grows with
the input; every value is a hash of (id, seed, field) in plain integer arithmetic,
which any SQL engine repeats -- no driver-side random state, no single generating
task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

N_TEAMS = 8
N_VENUES = 10
# Planted null shares (per cent) of winner, player_of_match, margin and overs.
NULL_PCT = {"winner": 4, "player_of_match": 6, "margin": 8, "overs": 2}


_PRIME, _FACTOR, _STEP = 1000003, 2654435761, 7919


def _u(id_col: str, seed: int, field: int, mod: int):
    """A number below ``mod``: a scaled square modulo a prime."""
    x = F.pmod(F.pmod(F.col(id_col).cast("long"), F.lit(_PRIME)) + (seed + field * _STEP), F.lit(_PRIME))
    return F.pmod(F.pmod(F.pmod(x * x, F.lit(_PRIME)) * F.lit(_FACTOR), F.lit(_PRIME)), F.lit(mod))


def u_sql(id_col: str, seed: int, field: int, mod: int) -> str:
    """``_u`` as SQL (ids of 0 and more)."""
    x = f"(({id_col} % {_PRIME} + {seed + field * _STEP}) % {_PRIME})"
    return f"((({x} * {x}) % {_PRIME} * {_FACTOR}) % {_PRIME} % {mod})"


def synthetic_matches(ids: DataFrame, id_col: str, seed: int = 42, dup_every: int = 64) -> DataFrame:
    """One match per id plus a duplicate of every row whose hash bucket is 0 of
    ``dup_every``; nulls planted at NULL_PCT; runs outliers at 1 in 100."""
    t1 = _u(id_col, seed, 1, N_TEAMS)
    t2 = F.pmod(t1 + 1 + _u(id_col, seed, 2, N_TEAMS - 1), F.lit(N_TEAMS))
    team = lambda x: F.concat(F.lit("Team "), (x + 1).cast("string"))
    runs = 120 + _u(id_col, seed, 3, 100)
    runs = F.when(_u(id_col, seed, 4, 100) == 0, runs * 3).otherwise(runs)
    overs = (15 + _u(id_col, seed, 5, 6)).cast("double")
    overs = F.when(_u(id_col, seed, 6, 100) < NULL_PCT["overs"], F.lit(None).cast("double")).otherwise(overs)
    toss = F.when(_u(id_col, seed, 7, 2) == 0, team(t1)).otherwise(team(t2))
    win = F.when(_u(id_col, seed, 8, 2) == 0, team(t1)).otherwise(team(t2))
    base = ids.select(
        F.col(id_col).cast("long").alias("match_id"),
        (2008 + _u(id_col, seed, 9, 17)).cast("int").alias("season"),
        F.date_format(F.date_add(F.lit("2008-04-01").cast("date"), _u(id_col, seed, 10, 6000).cast("int")),
                      "yyyy-MM-dd").alias("date"),
        F.concat(F.lit("Venue "), (_u(id_col, seed, 11, N_VENUES) + 1).cast("string")).alias("venue"),
        team(t1).alias("team1"), team(t2).alias("team2"), toss.alias("toss_winner"),
        F.when(_u(id_col, seed, 12, 2) == 0, "bat").otherwise("field").alias("toss_decision"),
        F.when(_u(id_col, seed, 13, 100) < NULL_PCT["winner"], F.lit(None).cast("string")).otherwise(win).alias("winner"),
        runs.cast("int").alias("runs_scored"), _u(id_col, seed, 14, 11).cast("int").alias("wickets_lost"),
        overs.alias("overs"), F.when(overs.isNotNull(), runs / overs).alias("strike_rate"),
        F.when(_u(id_col, seed, 15, 100) < NULL_PCT["player_of_match"], F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("Player "), _u(id_col, seed, 16, 300).cast("string"))).alias("player_of_match"),
        F.when(_u(id_col, seed, 17, 100) < NULL_PCT["margin"], F.lit(None).cast("double"))
         .otherwise(_u(id_col, seed, 18, 80).cast("double")).alias("margin"),
        (_u(id_col, seed, 19, 10) == 0).alias("is_playoff"),
        F.lit("Premier").alias("league"),
    )
    dups = base.filter(_u("match_id", seed, 20, dup_every) == 0)
    return base.unionAll(dups)
