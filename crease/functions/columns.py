"""Column functions (projection, string, date and type helpers): each returns a
``Column`` built from JVM-side built-ins, so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values (must equal the reference's for equal results):
# franchise renames applied to team columns.
TEAM_ALIASES = {
    "Delhi Daredevils": "Delhi Capitals",
    "Kings XI Punjab": "Punjab Kings",
    "Royal Challengers Bangalore": "Royal Challengers Bengaluru",
    "Deccan Chargers": "Sunrisers Hyderabad",
    "Rising Pune Supergiants": "Rising Pune Supergiant",
}
# Text values that mean "missing" after trimming and lower-casing.
NULL_MARKERS = ["", "nan", "none"]
# Decisions that mean the toss winner bats first.
BAT_DECISIONS = ["bat", "batting"]
# Role labels.
ROLE_KEEPER, ROLE_ALL_ROUNDER, ROLE_BOWLER, ROLE_BATTER = "Wicketkeeper", "All-Rounder", "Bowler", "Batter"
BASE_SEASON = 2008


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def normalise_season(x: str | Column) -> Column:
    """'2007/08' -> 2008 (second year; +100 when it falls below the first),
    '2016' / 2016 / '2016.0' -> 2016; anything else -> null."""
    s = F.trim(_c(x).cast("string"))
    pair = F.regexp_extract(s, r"^(\d{4})/(\d{2})", 0) != ""
    base = F.regexp_extract(s, r"^(\d{4})/(\d{2})", 1).cast("int")
    suffix = F.regexp_extract(s, r"^(\d{4})/(\d{2})", 2).cast("int")
    second = F.floor(base / 100).cast("int") * 100 + suffix
    second = F.when(second < base, second + 100).otherwise(second)
    plain = s.try_cast("double").try_cast("int")  # int(float(s)): truncation
    return F.when(pair, second).otherwise(plain)


def alias_map(x: str | Column, mapping: dict[str, str] | None = None) -> Column:
    """Replace values found in ``mapping`` (a literal map; small by construction)."""
    mapping = TEAM_ALIASES if mapping is None else mapping
    if not mapping:
        return _c(x)
    m = F.create_map(*[F.lit(v) for v in chain.from_iterable(mapping.items())])
    return F.coalesce(m[_c(x)], _c(x))


def parse_win_margin(x: str | Column) -> tuple[Column, Column]:
    """(win_by_runs, win_by_wickets) from text like 'Won by 45 runs'; 0 when absent."""
    low = F.lower(_c(x).cast("string"))
    runs = F.regexp_extract(low, r"(\d+)\s*run", 1)
    wkts = F.regexp_extract(low, r"(\d+)\s*wicket", 1)
    to_int = lambda s: F.coalesce(F.when(s != "", s).try_cast("int"), F.lit(0))
    return to_int(runs), to_int(wkts)


def clean_text(x: str | Column, lower: bool = True) -> Column:
    """Trim (and lower-case); '', 'nan', 'none' -> null."""
    t = F.trim(_c(x).cast("string"))
    t = F.lower(t) if lower else t
    return F.when(F.lower(t).isin(*NULL_MARKERS) | t.isNull(), F.lit(None).cast("string")).otherwise(t)


def parse_date(x: str | Column, fmt: str | None = None) -> Column:
    """To date; unparseable -> null."""
    c = _c(x).cast("string")
    ts = F.try_to_timestamp(c, F.lit(fmt)) if fmt else F.try_to_timestamp(c)
    return F.to_date(ts)


def to_number_coerce(x: str | Column, default: float = 0) -> Column:
    """To number; unparseable -> ``default``."""
    return F.coalesce(_c(x).cast("string").try_cast("double"), F.lit(float(default)))


def eq_flag(a: str | Column, b: str | Column) -> Column:
    """1 when a equals b (null-safe: null never equals a value), else 0."""
    return F.when(_c(a) == _c(b), 1).otherwise(0)


def in_flag(x: str | Column, values: list) -> Column:
    return F.when(_c(x).isin(*values), 1).otherwise(0)


def contains_flag(x: str | Column, needle: str) -> Column:
    """Null-safe ``contains`` as 0/1."""
    return F.coalesce(_c(x).contains(needle), F.lit(False)).cast("int")


def season_index(season: str | Column, serving: bool = False) -> Column:
    """season - 2008.  ``serving=True``: the first year of a 'YYYY/YY' text, floored at 0."""
    if serving:
        first = F.regexp_extract(_c(season).cast("string"), r"^\s*(\d+)", 1).try_cast("int")
        return F.coalesce(F.greatest(first - BASE_SEASON, F.lit(0)), F.lit(0))
    return _c(season).cast("int") - BASE_SEASON


def exclude_rows(df: DataFrame, result_type: str, outcome: str, winner: str) -> DataFrame:
    """Drop results 'no result' / 'tie', outcomes containing 'tie', missing winners."""
    rt = F.lower(F.trim(F.col(result_type).cast("string")))
    bad = F.coalesce(rt.isin("no result", "tie"), F.lit(False)) | \
        F.coalesce(F.lower(F.col(outcome)).contains("tie"), F.lit(False))
    return df.filter(~bad & clean_text(winner, lower=False).isNotNull())


def filter_in(df: DataFrame, col: str, values: list | None, order_desc: str | None = None) -> DataFrame:
    """Rows whose ``col`` is in ``values`` (empty / None = no filter), newest first."""
    out = df.filter(F.col(col).isin(*values)) if values else df
    return out.orderBy(F.desc(order_desc)) if order_desc else out


def batting_first(toss_winner: str | Column, decision: str | Column, a: str | Column, b: str | Column) -> Column:
    """Side batting first: the toss winner when it chose to bat, else the other side."""
    tw = _c(toss_winner)
    other = F.when(tw == _c(a), _c(b)).otherwise(_c(a))
    return F.when(F.lower(_c(decision)).isin(*BAT_DECISIONS), tw).otherwise(other)


def defended_flag(bat_first: Column, winner: str | Column) -> Column:
    return eq_flag(bat_first, winner)


def assign_role(player: str | Column, runs: str | Column, wickets: str | Column,
                keepers: list | None = None) -> Column:
    """keeper list -> Wicketkeeper; runs >= 600 and wkts >= 25 -> All-Rounder;
    wkts >= 20 and runs < 30 * wkts -> Bowler; runs >= 300 -> Batter;
    wkts > 0 -> Bowler; else Batter."""
    r, w = _c(runs), _c(wickets)
    role = F.when((r >= 600) & (w >= 25), ROLE_ALL_ROUNDER) \
        .when((w >= 20) & (r < w * 30), ROLE_BOWLER).when(r >= 300, ROLE_BATTER) \
        .when(w > 0, ROLE_BOWLER).otherwise(ROLE_BATTER)
    if keepers:
        role = F.when(_c(player).isin(*keepers), ROLE_KEEPER).otherwise(role)
    return role


def drop_null_rows(df: DataFrame, subset: list[str]) -> DataFrame:
    return df.na.drop(subset=subset)


def archetype_label(code: str | Column, labels: dict, default: str = "Unknown") -> Column:
    """Code -> label by a small literal dictionary, default 'Unknown'."""
    m = F.create_map(*[F.lit(v) for v in chain.from_iterable(labels.items())])
    return F.coalesce(m[_c(code)], F.lit(default))


def format_number(x: str | Column, decimals: int = 0, percent: bool = False) -> Column:
    """Thousands separators and fixed decimals ('1,234.5'); percent appends '%'."""
    s = F.format_number(_c(x).cast("double"), decimals)
    return F.concat(s, F.lit("%")) if percent else s


def sanitize_non_finite(df: DataFrame) -> DataFrame:
    """NaN, +Inf, -Inf -> null in every floating column."""
    out = []
    for f in df.schema.fields:
        if f.dataType.typeName() in ("double", "float"):
            c = F.col(f.name)
            bad = F.isnan(c) | c.isin(float("inf"), float("-inf"))
            out.append(F.when(bad, F.lit(None).cast(f.dataType)).otherwise(c).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
