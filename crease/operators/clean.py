"""Cleaning: imputation, duplicate removal, outlier detection and handling.

Statistics (mean, median, mode, quartiles) are single-row aggregates joined
back as a one-row table, so applying them is a narrow projection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crease.operators.profile import is_missing, is_numeric, present
from crease.operators.scan import modes, quantiles

STRATEGIES = ("mean", "median", "mode", "drop_rows", "drop_column", "none")


def _fill_values(df: DataFrame, plan: list[tuple[str, str]]) -> dict:
    means = [c for c, s in plan if s == "mean"]
    medians = {c: (present(df, c), [0.5]) for c, s in plan if s == "median"}
    out = df.agg(*[F.avg(present(df, c).cast("double")).alias(c) for c in means]).first().asDict() if means else {}
    if medians:
        out |= {c: v[0] if v else None for c, v in quantiles(df, medians).first().asDict().items()}
    return out | modes(df, {c: present(df, c) for c, s in plan if s == "mode"})


def impute(df: DataFrame, strategies: dict[str, str]) -> DataFrame:
    """Apply a column -> strategy map **in map order**: mean / median / mode fill,
    drop_rows (removes rows, so later statistics see fewer rows), drop_column
    (applied last), none.  Unknown columns and columns without missing values
    are skipped (the check is made on the data as it is at that step).

    Consecutive fill strategies share one aggregate pass; the fill values are
    scalars, so they are applied as literals.
    """
    cols_to_drop: list[str] = []
    pending: list[tuple[str, str]] = []
    cur = df

    def flush(cur_df, batch):
        if not batch:
            return cur_df
        miss = cur_df.agg(*[F.count_if(is_missing(cur_df, c)).alias(c) for c, _ in batch]).first().asDict()
        batch = [(c, s) for c, s in batch if miss[c] > 0]
        vals = _fill_values(cur_df, batch)
        out = []
        for name in cur_df.columns:
            hit = [s for c, s in batch if c == name]
            if hit and vals.get(name) is not None:
                fill = F.lit(vals[name])
                src = present(cur_df, name)
                if hit[0] in ("mean", "median") and not is_numeric(cur_df, name):
                    out.append(F.col(name))
                    continue
                out.append(F.coalesce(src, fill).alias(name))
            else:
                out.append(F.col(name))
        return cur_df.select(*out)

    for c, s in strategies.items():
        if s not in STRATEGIES:
            raise ValueError(f"unknown strategy {s}")
        if c not in cur.columns or s == "none":
            continue
        if s in ("mean", "median", "mode"):
            pending.append((c, s))
        elif s == "drop_rows":
            cur = flush(cur, pending)
            pending = []
            cur = cur.filter(~is_missing(cur, c))
        elif s == "drop_column":
            cur = flush(cur, pending)
            pending = []
            if cur.agg(F.count_if(is_missing(cur, c))).first()[0] > 0:
                cols_to_drop.append(c)
    cur = flush(cur, pending)
    return cur.drop(*cols_to_drop) if cols_to_drop else cur


def drop_duplicates(df: DataFrame) -> DataFrame:
    """Exact row de-duplication (map-side combined aggregate)."""
    return df.dropDuplicates()


def _iqr_stats(df: DataFrame, col: str) -> DataFrame:
    x = present(df, col).cast("double")
    q = quantiles(df, {"__q": (x, [0.25, 0.75])}).select(F.col("__q")[0].alias("q1"), F.col("__q")[1].alias("q3")) \
        .crossJoin(df.agg(F.count(F.lit(1)).alias("total_count"), F.count(x).alias("non_null_count")))  # single rows
    iqr = F.col("q3") - F.col("q1")
    return q.select("*", iqr.alias("iqr"), (F.col("q1") - 1.5 * iqr).alias("lower_bound"),
                    (F.col("q3") + 1.5 * iqr).alias("upper_bound"))


def _z_stats(df: DataFrame, col: str) -> DataFrame:
    x = present(df, col).cast("double")
    q = df.agg(F.avg(x).alias("mean"), F.stddev_samp(x).alias("__s"),
               F.count(F.lit(1)).alias("total_count"), F.count(x).alias("non_null_count"))
    std = F.when(F.col("__s").isNull() | (F.col("__s") == 0), F.lit(1e-9)).otherwise(F.col("__s"))
    return q.select("mean", std.alias("std"), "total_count", "non_null_count",
                    (F.col("mean") - 3 * std).alias("lower_bound"), (F.col("mean") + 3 * std).alias("upper_bound"))


def outlier_rows(df: DataFrame, col: str, method: str = "iqr", id_col: str | None = None,
                 stats: DataFrame | None = None) -> DataFrame:
    """Rows whose ``col`` is strictly outside the fences (IQR: q1/q3 -/+ 1.5 IQR;
    z-score: |x - mean| / std > 3), with ``id_col`` (the explicit row label) and value."""
    if stats is None:
        stats = _iqr_stats(df, col) if method == "iqr" else _z_stats(df, col)
    x = present(df, col).cast("double")
    j = df.select(*([id_col] if id_col else []), x.alias("value")).filter(F.col("value").isNotNull()) \
          .crossJoin(F.broadcast(stats))  # one-row statistics
    if method == "iqr":
        cond = (F.col("value") < F.col("lower_bound")) | (F.col("value") > F.col("upper_bound"))
    else:
        cond = F.abs((F.col("value") - F.col("mean")) / F.col("std")) > 3
    return j.filter(cond).select(*([id_col] if id_col else []), "value")


def outliers_summary(df: DataFrame, col: str, method: str = "iqr") -> DataFrame:
    """One row: the fences, outlier_count and outlier_percentage (of all rows,
    nulls included, 2 dp).  IQR adds q1, q3, iqr; z-score adds mean, std."""
    stats = _iqr_stats(df, col) if method == "iqr" else _z_stats(df, col)
    keep = ["q1", "q3", "iqr"] if method == "iqr" else ["mean", "std"]
    names = [*keep, "lower_bound", "upper_bound", "total_count"]
    x = F.col("__value")
    if method == "iqr":
        out = (x < F.col("lower_bound")) | (x > F.col("upper_bound"))
    else:
        out = F.abs((x - F.col("mean")) / F.col("std")) > 3
    # the one row of statistics goes along with the values, so it is planned once
    j = df.select(present(df, col).cast("double").alias("__value")).crossJoin(F.broadcast(stats)) \
        .agg(*[F.max(c).alias(c) for c in names], F.count(F.when(out, 1)).alias("outlier_count"))
    pct = F.when(F.col("total_count") > 0, F.round(F.col("outlier_count") / F.col("total_count") * 100.0, 2)) \
           .otherwise(F.lit(0.0))
    return j.select(F.lit(col).alias("column"), F.lit(method).alias("method"), *names[:-1], "outlier_count",
                    pct.alias("outlier_percentage"))


def outlier_counts(df: DataFrame, cols: list[str], method: str = "iqr") -> DataFrame:
    """(column, n_outliers) for several columns, whose fences come from one pass over all."""
    values = df.select(*[present(df, c).cast("double").alias(f"v{k}") for k, c in enumerate(cols)])
    v = [F.col(f"v{k}") for k in range(len(cols))]
    if method == "iqr":
        stats = quantiles(values, {f"s{k}": (x, [0.25, 0.75]) for k, x in enumerate(v)})
        iqr = [F.col(f"s{k}")[1] - F.col(f"s{k}")[0] for k in range(len(cols))]
        out = [(x < F.col(f"s{k}")[0] - 1.5 * iqr[k]) | (x > F.col(f"s{k}")[1] + 1.5 * iqr[k]) for k, x in enumerate(v)]
    else:
        stats = values.agg(*[F.avg(x).alias(f"a{k}") for k, x in enumerate(v)], *[F.stddev_samp(x).alias(f"s{k}") for k, x in enumerate(v)])
        out = [F.abs((x - F.col(f"a{k}")) / F.when(F.col(f"s{k}").isNull() | (F.col(f"s{k}") == 0), 1e-9).otherwise(F.col(f"s{k}"))) > 3
               for k, x in enumerate(v)]
    counts = values.crossJoin(F.broadcast(stats)).agg(*[F.count(F.when(o, 1)).alias(c) for o, c in zip(out, cols)])  # one-row statistics
    return counts.unpivot([], list(cols), "column", "n_outliers")


def handle_outliers(df: DataFrame, col: str, strategy: str, method: str = "iqr") -> DataFrame:
    """keep (unchanged) / cap (clip to the fences, nulls stay null) / remove
    (drop outlier rows, rows with null kept)."""
    if strategy == "keep" or not is_numeric(df, col):
        return df
    stats = (_iqr_stats(df, col) if method == "iqr" else _z_stats(df, col)).select(
        F.col("lower_bound").alias("__lo"), F.col("upper_bound").alias("__hi"))
    j = df.crossJoin(F.broadcast(stats))  # one-row statistics
    x = F.col(col)
    if strategy == "cap":
        capped = F.when(x.isNull(), x).otherwise(F.least(F.greatest(x.cast("double"), F.col("__lo")), F.col("__hi")))
        return j.select(*[capped.alias(c) if c == col else F.col(c) for c in df.columns])
    if strategy == "remove":
        out = x.isNotNull() & ((x < F.col("__lo")) | (x > F.col("__hi")))
        return j.filter(~out).select(*df.columns)
    raise ValueError(strategy)
