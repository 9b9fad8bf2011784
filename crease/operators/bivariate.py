"""Bivariate statistics: correlation (Pearson, Spearman), covariance, OLS line,
correlation matrix, group statistics, ANOVA, Kruskal-Wallis, cross tables,
chi-square with Yates, Cramer's V, top combination, automatic dispatch.

Statistics are aggregates; p-values are attached by a pandas UDF evaluated on
the one-row statistics table (lazy, no driver round trip).  Ranks come from
``rank_histogram`` (value histogram + blocked running count), never from a
window over the whole table.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crease.functions import dist
from crease.operators.profile import NUMERIC_TYPES, present
from crease.operators.reports import top_k_counts
from crease.operators.scan import quantiles, rank_histogram

# Fixed values (must equal the reference's): qualitative bands.
STRENGTH_BANDS = [(0.7, "Strong"), (0.4, "Moderate"), (0.2, "Weak")]
STRENGTH_NONE = "Very Weak / Negligible"
DIRECTION_EPS = 0.05
CRAMER_BANDS = [(0.5, "Very Strong Association"), (0.3, "Strong Association"),
                (0.15, "Moderate Association"), (0.05, "Weak Association")]
CRAMER_NONE = "Little to No Association"
# Aggregation-buffer fields per pass of the correlation matrix: Spark turns
# whole-stage codegen off above spark.sql.codegen.maxFields (100); corr keeps 6
# buffer fields, stddev 3.
CORR_FIELD_BUDGET = 96


def _p_corr(r: pd.Series, n: pd.Series) -> pd.Series:
    return pd.Series([dist.corr_p(a, int(b)) if not pd.isna(a) and not pd.isna(b) else None
                      for a, b in zip(r, n)], dtype="float64")


def _p_f(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return pd.Series([dist.f_upper_p(a, b, c) if not pd.isna(a) else None for a, b, c in zip(f, d1, d2)],
                     dtype="float64")


def _p_chi2(x: pd.Series, k: pd.Series) -> pd.Series:
    return pd.Series([dist.chi2_upper_p(a, b) if not pd.isna(a) else None for a, b in zip(x, k)], dtype="float64")


_UDFS: dict = {}


def _udf(fn):
    """Pandas UDFs are built on first use (building one needs an active session)."""
    if fn.__name__ not in _UDFS:
        _UDFS[fn.__name__] = F.pandas_udf(fn, "double")
    return _UDFS[fn.__name__]


def corr_p_udf(r: Column, n: Column) -> Column:
    return _udf(_p_corr)(r, n)


def f_p_udf(f: Column, d1: Column, d2: Column) -> Column:
    return _udf(_p_f)(f, d1, d2)


def chi2_p_udf(x: Column, k: Column) -> Column:
    return _udf(_p_chi2)(x, k)


def strength_label(r: Column) -> Column:
    a = F.abs(r)
    out = F.lit(STRENGTH_NONE)
    for thr, label in reversed(STRENGTH_BANDS):
        out = F.when(a >= thr, F.lit(label)).otherwise(out)
    return out


def direction_label(r: Column) -> Column:
    return (F.when(r > DIRECTION_EPS, "Positive").when(r < -DIRECTION_EPS, "Negative")
            .otherwise("Neutral / No Linear Direction"))


def _pairs(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.select(present(df, x).cast("double").alias("x"), present(df, y).cast("double").alias("y")) \
             .filter(F.col("x").isNotNull() & F.col("y").isNotNull())


def pearson(df: DataFrame, x: str, y: str, with_p: bool = True) -> DataFrame:
    """n, r, r_squared, strength, direction (and two-sided p) over complete pairs.
    Fewer than 3 pairs or a constant side -> r = 0 and label 'insufficient'."""
    p = _pairs(df, x, y).agg(F.count(F.lit(1)).alias("n"), F.corr("x", "y").alias("__r"),
                             F.var_pop("x").alias("__vx"), F.var_pop("y").alias("__vy"))
    ok = (F.col("n") >= 3) & (F.col("__vx") > 0) & (F.col("__vy") > 0)
    r = F.when(ok, F.coalesce(F.col("__r"), F.lit(0.0))).otherwise(F.lit(0.0))
    out = p.select("n", r.alias("r"), (r * r).alias("r_squared"), strength_label(r).alias("strength"),
                   direction_label(r).alias("direction"), ok.alias("valid"))
    if with_p:
        out = out.withColumn("p_value", F.when(F.col("valid"), corr_p_udf(F.col("r"), F.col("n"))))
    return out


def spearman(df: DataFrame, x: str, y: str, with_p: bool = True) -> DataFrame:
    """rho = Pearson correlation of the average ranks over complete pairs."""
    pairs = _pairs(df, x, y)
    rx = rank_histogram(pairs, "x").select("x", F.col("avg_rank").alias("rx"))
    ry = rank_histogram(pairs, "y").select("y", F.col("avg_rank").alias("ry"))
    # one row per distinct pair: a value that a third of the rows hold is not one hot join key
    held = pairs.groupBy("x", "y").agg(F.count(F.lit(1)).cast("double").alias("c")).join(rx, "x").join(ry, "y")
    s = held.agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.col("rx")).alias("a"), F.sum(F.col("c") * F.col("ry")).alias("b"),
                 F.sum(F.col("c") * F.col("rx") * F.col("rx")).alias("aa"), F.sum(F.col("c") * F.col("ry") * F.col("ry")).alias("bb"),
                 F.sum(F.col("c") * F.col("rx") * F.col("ry")).alias("ab"))
    spread = (F.col("aa") - F.col("a") * F.col("a") / F.col("n")) * (F.col("bb") - F.col("b") * F.col("b") / F.col("n"))
    rho = F.when(spread > 0, (F.col("ab") - F.col("a") * F.col("b") / F.col("n")) / F.sqrt(spread))
    out = s.select(F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n"), F.coalesce(rho, F.lit(0.0)).alias("rho"))
    if with_p:
        out = out.withColumn("p_value", F.when(F.col("n") >= 3, corr_p_udf(F.col("rho"), F.col("n"))))
    return out


def covariance(df: DataFrame, x: str, y: str) -> DataFrame:
    return _pairs(df, x, y).agg(F.covar_samp("x", "y").alias("covariance"))


def ols_line(df: DataFrame, x: str, y: str, points: int = 100) -> tuple[DataFrame, DataFrame]:
    """(slope, intercept, r_squared, equation) and the trend line sampled at
    ``points`` x values from min to max."""
    s = _pairs(df, x, y).agg(F.regr_slope("y", "x").alias("slope"), F.regr_intercept("y", "x").alias("intercept"),
                             F.regr_r2("y", "x").alias("r_squared"), F.min("x").alias("__lo"),
                             F.max("x").alias("__hi"))
    s = s.select(F.coalesce("slope", F.lit(0.0)).alias("slope"), F.coalesce("intercept", F.lit(0.0)).alias("intercept"),
                 "r_squared", "__lo", "__hi")
    stats = s.select("slope", "intercept", "r_squared",
                     F.format_string("y = %.4fx + %.4f", F.col("slope"), F.col("intercept")).alias("equation"))
    step = (F.col("__hi") - F.col("__lo")) / (points - 1)
    line = s.select(F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i"), "*") \
            .select("i", (F.col("__lo") + F.col("i") * step).alias("x")) \
            .crossJoin(s.select("slope", "intercept")) \
            .select("i", "x", (F.col("intercept") + F.col("slope") * F.col("x")).alias("y"))
    return stats, line


def correlation_matrix(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Pearson r for every ordered pair of numeric columns (pairwise-complete
    rows, NaN as missing), long form (x, y, r); diagonal 1 (null when the column
    is constant or empty).  One aggregate pass per chunk of pairs."""
    cols = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)]
    base = df.select(*[present(df, c).cast("double").alias(c) for c in cols])
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    items = [("sd", c, None) for c in cols] + [("corr", a, b) for a, b in pairs]
    passes, cur, used = [], [], 0
    for it in items:
        cost = 3 if it[0] == "sd" else 6
        if cur and used + cost > CORR_FIELD_BUDGET:
            passes.append(cur)
            cur, used = [], 0
        cur.append(it)
        used += cost
    if cur:
        passes.append(cur)
    parts = []
    for chunk in passes:
        aggs, cells = [], []
        for kind, a, b in chunk:
            if kind == "sd":
                aggs.append(F.stddev_pop(a).alias(f"{a}__sd"))
                cells.append(F.struct(F.lit(a).alias("x"), F.lit(a).alias("y"),
                                      F.when(F.col(f"`{a}__sd`") > 0, F.lit(1.0)).alias("r")))
            else:
                aggs.append(F.corr(a, b).alias(f"{a}__{b}"))
                r = F.col(f"`{a}__{b}`")
                cells += [F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), r.alias("r")),
                          F.struct(F.lit(b).alias("x"), F.lit(a).alias("y"), r.alias("r"))]
        # one aggregate row per pass -> its cells by a single explode
        parts.append(base.agg(*aggs).select(F.explode(F.array(*cells)).alias("c")).select("c.*"))
    return reduce(DataFrame.unionAll, parts)


def correlated_pairs(matrix: DataFrame, top: int = 5, pos: float = 0.1, neg: float = -0.1,
                     collinear: float = 0.8) -> DataFrame:
    """From the upper triangle: top-5 positive (> 0.1) and top-5 negative (< -0.1)
    by the 3-dp value, and every collinear pair (|r| > 0.8): (kind, x, y, r3)."""
    from crease.operators.scan import running_totals  # noqa: F401  (ranks below are on <= k^2 rows)
    upper = matrix.filter((F.col("x") < F.col("y")) & F.col("r").isNotNull()) \
                  .select("x", "y", F.round("r", 3).alias("r3"), F.abs("r").alias("__a"))
    p = upper.filter(F.col("r3") > pos).orderBy(F.desc("r3"), "x", "y").limit(top).withColumn("kind", F.lit("positive"))
    n = upper.filter(F.col("r3") < neg).orderBy("r3", "x", "y").limit(top).withColumn("kind", F.lit("negative"))
    c = upper.filter(F.col("__a") > collinear).withColumn("kind", F.lit("collinear"))
    return p.unionByName(n).unionByName(c).select("kind", "x", "y", "r3")


def _only_top(d: DataFrame, cat: str, k: int | None) -> DataFrame:
    """``d``, or its rows of the ``k`` most frequent categories where a chart asks for that."""
    return d if k is None else d.join(top_k_counts(d, cat, k).select(cat), cat, "left_semi")


def group_stats(df: DataFrame, cat: str, num: str, top: int | None = None) -> DataFrame:
    """Per category (all, or the ``top`` most frequent): count, mean, median, std
    (n-1; 0 for one value), min, max, q1, q3."""
    d = df.select(F.col(cat).cast("string").alias(cat), present(df, num).cast("double").alias(num)) \
          .filter(F.col(cat).isNotNull() & F.col(num).isNotNull())
    d = _only_top(d, cat, top)
    x = F.col(num)
    s = d.groupBy(cat).agg(
        F.count(x).alias("count"), F.avg(x).alias("mean"),
        F.when(F.count(x) > 1, F.stddev_samp(x)).otherwise(F.lit(0.0)).alias("std"), F.min(x).alias("min"), F.max(x).alias("max"))
    q = quantiles(d, {"__q": (x, [0.25, 0.5, 0.75])}, [cat])
    return s.join(q, cat).select(cat, "count", "mean", F.col("__q")[1].alias("median"), "std", "min", "max",
                                 F.col("__q")[0].alias("q1"), F.col("__q")[2].alias("q3")).orderBy(F.desc("count"), cat)


def _groups(df: DataFrame, cat: str, num: str, top: int | None) -> DataFrame:
    d = df.select(F.col(cat).cast("string").alias("g"), present(df, num).cast("double").alias("v")) \
          .filter(F.col("g").isNotNull() & F.col("v").isNotNull())
    return _only_top(d, "g", top)


def anova_oneway(df: DataFrame, cat: str, num: str, top: int | None = None, with_p: bool = True) -> DataFrame:
    """One-way ANOVA F from per-group (n, mean, population variance):
    SSB = sum n_i (m_i - m)^2, SSW = sum n_i var_i, F = (SSB/(k-1)) / (SSW/(N-k))."""
    g = _groups(df, cat, num, top).groupBy("g").agg(F.count("v").alias("n"), F.avg("v").alias("m"),
                                                    F.var_pop("v").alias("vp"))
    tot = g.agg(F.sum("n").alias("__total"), F.count(F.lit(1)).alias("k"),
                (F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("gm"))
    j = g.crossJoin(tot)  # one-row totals
    s = j.groupBy("__total", "k").agg(F.sum(F.col("n") * (F.col("m") - F.col("gm")) ** 2).alias("ssb"),
                                      F.sum(F.col("n") * F.col("vp")).alias("ssw"))
    big_n = F.col("__total")
    f = F.when((F.col("k") >= 2) & (big_n > F.col("k")) & (F.col("ssw") > 0),
               (F.col("ssb") / (F.col("k") - 1)) / (F.col("ssw") / (big_n - F.col("k"))))
    out = s.select(F.col("k").alias("groups"), big_n.alias("n"), f.alias("f_stat"))
    if with_p:
        out = out.withColumn("p_value", F.when(F.col("f_stat").isNotNull(),
                                               f_p_udf(F.col("f_stat"), F.col("groups") - 1, F.col("n") - F.col("groups"))))
    return out


def kruskal_wallis(df: DataFrame, cat: str, num: str, top: int | None = None, with_p: bool = True) -> DataFrame:
    """H = 12 / (N (N + 1)) sum R_i^2 / n_i - 3 (N + 1), divided by the tie
    correction 1 - sum(t^3 - t) / (N^3 - N); ranks averaged over ties."""
    d = _groups(df, cat, num, top)
    hist = rank_histogram(d, "v")  # (v, ties, avg_rank) over all groups
    per = d.groupBy("g", "v").agg(F.count(F.lit(1)).alias("c")).join(hist.select("v", "avg_rank"), "v")
    rs = per.groupBy("g").agg(F.sum(F.col("c") * F.col("avg_rank")).alias("R"), F.sum("c").alias("n"))
    a = rs.agg(F.sum(F.col("R") ** 2 / F.col("n")).alias("s"), F.sum("n").alias("__total"),
               F.count(F.lit(1)).alias("k"))
    ties = hist.agg(F.sum(F.col("ties").cast("double") ** 3 - F.col("ties")).alias("tt"))
    j = a.crossJoin(ties)  # both one row
    n = F.col("__total").cast("double")
    h = 12.0 / (n * (n + 1)) * F.col("s") - 3 * (n + 1)
    corr = 1 - F.col("tt") / (n ** 3 - n)
    hc = F.when((F.col("k") >= 2) & (corr > 0), h / corr)
    out = j.select(F.col("k").alias("groups"), F.col("__total").alias("n"), hc.alias("h_stat"))
    if with_p:
        out = out.withColumn("p_value", F.when(F.col("h_stat").isNotNull(),
                                               chi2_p_udf(F.col("h_stat"), F.col("groups") - 1)))
    return out


def _cat_pairs(df: DataFrame, x: str, y: str, top: int | None = None) -> DataFrame:
    d = df.select(F.col(x).cast("string").alias("x"), F.col(y).cast("string").alias("y")) \
          .filter(F.col("x").isNotNull() & F.col("y").isNotNull())
    return _only_top(_only_top(d, "x", top), "y", top)


def crosstab(df: DataFrame, x: str, y: str, top: int | None = None, total: str = "Total") -> DataFrame:
    """Long-form contingency table with ``Total`` margins: count, ``margin`` (which
    tells them from a level of that name) and, for inner cells, row %, column %
    and total %.  Margins come from ``cube``."""
    d = _cat_pairs(df, x, y, top)
    cube = d.cube("x", "y").agg(F.count(F.lit(1)).alias("count"), F.grouping_id().alias("__gid"))
    cells = cube.select(F.coalesce("x", F.lit(total)).alias(x), F.coalesce("y", F.lit(total)).alias(y), "count", "__gid",
                        (F.col("__gid") > 0).alias("margin"))
    inner = cells.filter(F.col("__gid") == 0)
    rows = cells.filter(F.col("__gid") == 1).select(F.col(x), F.col("count").alias("__row"))
    colsum = cells.filter(F.col("__gid") == 2).select(F.col(y), F.col("count").alias("__col"))
    n = cells.filter(F.col("__gid") == 3).select(F.col("count").alias("__n"))
    pct = inner.join(rows, x).join(colsum, y).crossJoin(n).select(  # n is one row
        x, y, "margin", (F.col("count") / F.col("__row") * 100.0).alias("row_pct"),
        (F.col("count") / F.col("__col") * 100.0).alias("col_pct"),
        (F.col("count") / F.col("__n") * 100.0).alias("total_pct"))
    return cells.drop("__gid").join(pct, [x, y, "margin"], "left")


def chi_square(df: DataFrame, x: str, y: str, top: int | None = None, with_p: bool = True) -> DataFrame:
    """Chi-square test of independence on the table without margins (zero cells
    included), Yates-corrected when dof = 1: statistic, dof, n, cramers_v, strength."""
    d = _cat_pairs(df, x, y, top)
    obs = d.groupBy("x", "y").agg(F.count(F.lit(1)).alias("o"))
    rx = obs.groupBy("x").agg(F.sum("o").alias("rx"))
    cy = obs.groupBy("y").agg(F.sum("o").alias("cy"))
    tot = obs.agg(F.sum("o").alias("n"), F.countDistinct("x").alias("r"), F.countDistinct("y").alias("c"))
    # Observed cells are enough: sum (o - e)^2 / e = n (sum o^2 / (row x column) - 1); in a
    # 2 x 2 table all |o - e| agree and sum 1 / e = n (sum 1 / row) (sum 1 / column).
    o = F.col("o").cast("double")
    seen = obs.join(rx, "x").join(cy, "y").agg(F.sum(o * o / F.col("rx") / F.col("cy")).alias("t"),
                                               F.min_by(F.struct("o", "rx", "cy"), F.struct("x", "y")).alias("one"))
    inverse = rx.agg(F.sum(1 / F.col("rx")).alias("ix")).crossJoin(cy.agg(F.sum(1 / F.col("cy")).alias("iy")))
    n = F.col("n")
    diff = F.abs(F.col("one.o") - F.col("one.rx") * F.col("one.cy") / n)
    less = diff - F.least(F.lit(0.5), diff)
    dof = (F.col("r") - 1) * (F.col("c") - 1)
    s = seen.crossJoin(tot).crossJoin(inverse).select(  # single rows
        "n", "r", "c", F.when(dof == 1, less * less * n * F.col("ix") * F.col("iy"))
        .otherwise(F.greatest(F.lit(0.0), n * (F.col("t") - 1))).alias("chi2"))
    md = F.least(F.col("r"), F.col("c")) - 1
    valid = (F.col("r") >= 2) & (F.col("c") >= 2)
    v = F.when(valid & (md > 0), F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.sqrt(F.col("chi2") / (F.col("n") * md))))) \
         .otherwise(F.lit(0.0))
    out = s.select(F.when(valid, F.col("chi2")).otherwise(F.lit(0.0)).alias("chi2"),
                   F.when(valid, (F.col("r") - 1) * (F.col("c") - 1)).otherwise(F.lit(0)).cast("long").alias("dof"),
                   "n", v.alias("cramers_v"))
    band = F.lit(CRAMER_NONE)
    for thr, label in reversed(CRAMER_BANDS):
        band = F.when(F.col("cramers_v") >= thr, F.lit(label)).otherwise(band)
    out = out.withColumn("strength", band)
    if with_p:
        out = out.withColumn("p_value", F.when(F.col("dof") > 0, chi2_p_udf(F.col("chi2"), F.col("dof"))).otherwise(1.0))
    return out


def top_combination(df: DataFrame, x: str, y: str, top: int | None = None) -> DataFrame:
    """Most frequent (x, y) pair (ties -> smallest x, then y)."""
    d = _cat_pairs(df, x, y, top)
    return d.groupBy("x", "y").agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "x", "y").limit(1) \
            .select(F.col("x").alias(x), F.col("y").alias(y), "count")


def box_by_category(df: DataFrame, cat: str, num: str, top: int | None = None) -> DataFrame:
    """Five numbers and fences per category (all, or the ``top`` most frequent)."""
    from crease.operators.profile import box_summary
    d = df.select(F.col(cat).cast("string").alias(cat), present(df, num).cast("double").alias(num)) \
          .filter(F.col(cat).isNotNull() & F.col(num).isNotNull())
    d = _only_top(d, cat, top)
    return box_summary(d, num, [cat])


def density_by_category(df: DataFrame, cat: str, num: str, bins: int = 20, top: int | None = None) -> DataFrame:
    """Per category (all, or the ``top`` most frequent) the density of ``num`` in
    ``bins`` equal bins between its least and largest value there: (category, bin,
    low, high, count, density); bins without a value are left out, a category of one
    value has one bin without width and no density."""
    d = df.select(F.col(cat).cast("string").alias(cat), present(df, num).cast("double").alias("__v")) \
          .filter(F.col(cat).isNotNull() & F.col("__v").isNotNull())
    d = _only_top(d, cat, top)
    spans = d.groupBy(cat).agg(F.min("__v").alias("__lo"), F.max("__v").alias("__hi"), F.count(F.lit(1)).alias("__n"))
    width = (F.col("__hi") - F.col("__lo")) / bins
    place = F.when(width > 0, F.least(F.floor((F.col("__v") - F.col("__lo")) / width), F.lit(bins - 1))).otherwise(0).cast("int")
    counts = d.join(spans, cat).groupBy(cat, "__lo", "__hi", "__n", place.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    low = F.col("__lo") + F.col("bin") * width
    return counts.select(cat, "bin", low.alias("low"), (low + width).alias("high"), "count",
                         F.when(width > 0, F.col("count") / (F.col("__n") * width)).alias("density"))


def bivariate_auto(df: DataFrame, x: str, y: str) -> dict[str, DataFrame]:
    """Dispatch on the column types: num x num -> Pearson, Spearman, covariance,
    OLS; cat x num -> group stats, ANOVA, Kruskal-Wallis; cat x cat -> cross
    table, chi-square, top pair.  Returns named lazy results."""
    nx = isinstance(df.schema[x].dataType, NUMERIC_TYPES)
    ny = isinstance(df.schema[y].dataType, NUMERIC_TYPES)
    if nx and ny:
        stats, line = ols_line(df, x, y)
        return {"pearson": pearson(df, x, y), "spearman": spearman(df, x, y), "covariance": covariance(df, x, y),
                "ols": stats, "trend": line}
    if nx != ny:
        cat, num = (y, x) if nx else (x, y)
        return {"group_stats": group_stats(df, cat, num), "anova": anova_oneway(df, cat, num),
                "kruskal": kruskal_wallis(df, cat, num)}
    return {"crosstab": crosstab(df, x, y), "chi_square": chi_square(df, x, y), "top_pair": top_combination(df, x, y)}
