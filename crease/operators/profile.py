"""Profiling: column classes, overview, missing values, duplicates, quality
audit and score, univariate statistics, shapes, top-k, histograms, boxes.

Every operator is one (or a few) wide aggregate passes; results are returned
in long form (one row per column) by exploding the single aggregate row.  Nothing is looped over on
the driver except the schema (which is metadata).

Numeric conventions follow pandas: std with n-1, bias-corrected skewness (G1)
and kurtosis (G2), linear-interpolated quantiles, NaN counted as missing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crease.operators.scan import quantiles
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
                 T.DecimalType)

# Fixed values (must equal the reference's): boolean value domain and name hints.
BOOLEAN_STRINGS = ["True", "False", "yes", "no", "Y", "N"]
BOOLEAN_NUMBERS = [0, 1]
DATE_NAME_HINTS = ["date", "time", "year"]
ID_NAME_HINTS = ["id", "name"]


def is_numeric(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, NUMERIC_TYPES)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)]


def is_missing(df: DataFrame, c: str) -> Column:
    """Null, or NaN for floating columns (pandas ``isna``)."""
    col = F.col(c)
    if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def present(df: DataFrame, c: str) -> Column:
    """The value with NaN folded to null."""
    col = F.col(c)
    if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(col), col)
    return col


def _long(row_df: DataFrame, cols: list[str], metrics: list[str], types: dict[str, str]) -> DataFrame:
    """Turn a one-row ``{col}__{metric}`` table into rows (column, metric...) with a
    single explode, so the aggregate behind it runs once."""
    cells = [F.struct(F.lit(c).alias("column"),
                      *[F.col(f"`{c}__{m}`").cast(types[m]).alias(m) for m in metrics]) for c in cols]
    return row_df.select(F.explode(F.array(*cells)).alias("__c")).select("__c.*")


# ---------------------------------------------------------------------------
# Q1 classify_columns / Q17 dtype_table
# ---------------------------------------------------------------------------

def classify_columns(df: DataFrame) -> DataFrame:
    """(column, class, dtype) with class in numerical / categorical / date / boolean.

    date: date/timestamp type, or a string column whose name hints at a date and
    whose non-null values all parse as timestamps; boolean: boolean type, or at
    most two distinct values all in the boolean domain; numerical: numeric type;
    else categorical.  Numeric columns with date-like names stay numerical.
    """
    aggs, plan = [], {}
    for f in df.schema.fields:
        c, dt = f.name, f.dataType
        if isinstance(dt, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            plan[c] = "date"
            continue
        if isinstance(dt, T.BooleanType):
            plan[c] = "boolean"
            continue
        v = present(df, c)
        aggs.append(F.count_distinct(v).alias(f"{c}__nd"))
        if isinstance(dt, NUMERIC_TYPES):
            aggs.append(F.count_if(v.isNotNull() & ~v.cast("double").isin(*[float(x) for x in BOOLEAN_NUMBERS]))
                        .alias(f"{c}__out"))
        else:
            aggs.append(F.count_if(v.isNotNull() & ~v.cast("string").isin(*BOOLEAN_STRINGS)).alias(f"{c}__out"))
            if isinstance(dt, T.StringType) and any(h in c.lower() for h in DATE_NAME_HINTS):
                aggs.append(F.count_if(v.isNotNull() & F.try_to_timestamp(v).isNull()).alias(f"{c}__bad_date"))
                aggs.append(F.count(v).alias(f"{c}__nn"))
    row = df.agg(*aggs).first().asDict() if aggs else {}
    out = []
    for f in df.schema.fields:
        c, dt = f.name, f.dataType
        cls = plan.get(c)
        if cls is None and f"{c}__bad_date" in row and row[f"{c}__nn"] > 0 and row[f"{c}__bad_date"] == 0:
            cls = "date"
        if cls is None and row.get(f"{c}__nd", 99) <= 2 and row.get(f"{c}__out", 1) == 0:
            cls = "boolean"
        if cls is None:
            cls = "numerical" if isinstance(dt, NUMERIC_TYPES) else "categorical"
        out.append((c, cls, dt.simpleString()))
    return df.sparkSession.createDataFrame(out, "column string, class string, dtype string")


def classes_dict(df: DataFrame) -> dict[str, str]:
    return {r["column"]: r["class"] for r in classify_columns(df).collect()}


# ---------------------------------------------------------------------------
# Q2 overview, Q3/Q4 missing values
# ---------------------------------------------------------------------------

def overview(df: DataFrame) -> DataFrame:
    """Per column: count, non_null_count, missing_count, unique_count and, for
    numeric columns, mean / std (n-1; 0 when n <= 1) / min / max."""
    cols = df.columns
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for c in cols:
        v = present(df, c)
        aggs += [F.count(v).alias(f"{c}__non_null_count"), F.count_distinct(v).alias(f"{c}__unique_count")]
        if is_numeric(df, c):
            x = v.cast("double")
            aggs += [F.avg(x).alias(f"{c}__mean"),
                     F.when(F.count(x) > 1, F.stddev_samp(x)).when(F.count(x) == 1, F.lit(0.0)).alias(f"{c}__std"),
                     F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")]
        else:
            aggs += [F.lit(None).cast("double").alias(f"{c}__{m}") for m in ("mean", "std", "min", "max")]
    row = df.agg(*aggs)
    row = row.select("*", *[(F.col("__rows") - F.col(f"{c}__non_null_count")).alias(f"{c}__missing_count")
                            for c in cols], *[F.col("__rows").alias(f"{c}__count") for c in cols])
    metrics = ["count", "non_null_count", "missing_count", "unique_count", "mean", "std", "min", "max"]
    types = {m: "long" for m in metrics[:4]} | {m: "double" for m in metrics[4:]}
    return _long(row, cols, metrics, types)


def missing_summary(df: DataFrame) -> DataFrame:
    """Per column: missing_count, missing_percentage (2 dp), recommended_strategy
    (>50 % drop_column, numeric median, else mode; none without nulls), data_type."""
    cols = df.columns
    row = df.agg(F.count(F.lit(1)).alias("__rows"),
                 *[F.count_if(is_missing(df, c)).alias(f"{c}__missing_count") for c in cols])
    parts = []
    for c in cols:
        n, m = F.col("__rows"), F.col(f"`{c}__missing_count`")
        pct = F.when(n > 0, m / n * 100.0).otherwise(F.lit(0.0))
        strategy = (F.when(m == 0, "none").when(pct > 50.0, "drop_column")
                    .otherwise(F.lit("median" if is_numeric(df, c) else "mode")))
        parts.append(F.struct(F.lit(c).alias("column"), m.alias("missing_count"),
                              F.round(pct, 2).alias("missing_percentage"), strategy.alias("recommended_strategy"),
                              F.lit(df.schema[c].dataType.simpleString()).alias("data_type")))
    return row.select(F.explode(F.array(*parts)).alias("__c")).select("__c.*")


def missing_ranking(df: DataFrame) -> DataFrame:
    """Columns with missing values, most missing first."""
    return (missing_summary(df).filter(F.col("missing_count") > 0)
            .select("column", "missing_count").orderBy(F.desc("missing_count"), "column"))


# ---------------------------------------------------------------------------
# Q5 duplicates, Q6 audit, Q7 score
# ---------------------------------------------------------------------------

def duplicate_summary(df: DataFrame) -> DataFrame:
    """total_rows, duplicate_rows (every copy beyond the first; nulls equal),
    unique_rows.  One ``groupBy(all columns)`` with map-side combining, so a
    heavily duplicated row collapses before the shuffle."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
    return groups.agg(F.sum("__n").cast("long").alias("total_rows"),
                      F.sum(F.col("__n") - 1).cast("long").alias("duplicate_rows")) \
                 .select(F.coalesce("total_rows", F.lit(0)).alias("total_rows"),
                         F.coalesce("duplicate_rows", F.lit(0)).cast("long").alias("duplicate_rows")) \
                 .withColumn("unique_rows", F.col("total_rows") - F.col("duplicate_rows"))


def quality_audit(df: DataFrame, classes: dict[str, str] | None = None) -> DataFrame:
    """Per column status in the reference's order: unique <= 1 -> Problem
    (constant); missing > 20 % -> Problem; missing > 0 -> Warning; categorical
    with > 50 distinct -> Warning (id/name variant); else Good."""
    classes = classes or classes_dict(df)
    cols = df.columns
    row = df.agg(F.count(F.lit(1)).alias("__rows"),
                 *[F.count_if(is_missing(df, c)).alias(f"{c}__m") for c in cols],
                 *[F.count_distinct(present(df, c)).alias(f"{c}__d") for c in cols])
    parts = []
    for c in cols:
        n, m, d = F.col("__rows"), F.col(f"`{c}__m`"), F.col(f"`{c}__d`")
        pct = F.when(n > 0, m / n * 100.0).otherwise(F.lit(0.0))
        high_card = F.lit(classes.get(c) == "categorical") & (d > 50)
        is_id = any(h in c.lower() for h in ID_NAME_HINTS)
        status = (F.when(d <= 1, "Problem").when(pct > 20.0, "Problem").when(pct > 0.0, "Warning")
                  .when(high_card, "Warning").otherwise("Good"))
        reason = (F.when(d <= 1, "constant").when(pct > 20.0, "missing")
                  .when(pct > 0.0, "gaps").when(high_card, "many ids" if is_id else "many levels").otherwise("ok"))
        parts.append(F.struct(F.lit(c).alias("feature"), F.lit(df.schema[c].dataType.simpleString()).alias("data_type"),
                              m.alias("missing_count"), F.round(pct, 2).alias("missing_percentage"),
                              d.alias("unique_values"), status.alias("status"), reason.alias("reason")))
    return row.select(F.explode(F.array(*parts)).alias("__c")).select("__c.*")


def quality_score(df: DataFrame, classes: dict[str, str] | None = None) -> DataFrame:
    """One row: total_rows, total_columns, duplicate_rows, constant_columns,
    counts per class, problems, warnings and
    quality_score = max(5, int(100 - 15 * dup / rows - 5 * problems - 2.5 * warnings))."""
    classes = classes or classes_dict(df)
    audit = quality_audit(df, classes).agg(
        F.count_if(F.col("status") == "Problem").alias("problems"),
        F.count_if(F.col("status") == "Warning").alias("warnings"),
        F.count_if(F.col("reason") == "constant").alias("constant_columns"))
    dup = duplicate_summary(df)
    j = dup.crossJoin(audit)  # both sides are single rows
    counts = {k: sum(1 for v in classes.values() if v == k) for k in ("numerical", "categorical", "date", "boolean")}
    deduction = (F.when(F.col("total_rows") > 0, F.col("duplicate_rows") / F.col("total_rows") * 15.0)
                 .otherwise(F.lit(0.0)) + F.col("problems") * 5.0 + F.col("warnings") * 2.5)
    return j.select(
        "total_rows", F.lit(len(df.columns)).cast("long").alias("total_columns"), "duplicate_rows",
        "constant_columns", *[F.lit(v).cast("long").alias(f"{k}_features_count") for k, v in counts.items()],
        "problems", "warnings",
        F.greatest(F.lit(5), F.floor(F.lit(100.0) - deduction).cast("long")).cast("long").alias("quality_score"))


# ---------------------------------------------------------------------------
# Q8-Q10 univariate statistics and distribution shape
# ---------------------------------------------------------------------------

def _g1(x: Column) -> Column:
    n = F.count(x)
    return F.when(n > 2, F.skewness(x) * F.sqrt(n * (n - 1)) / (n - 2))


def _g2(x: Column) -> Column:
    n = F.count(x)
    return F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(x) + 6))


def univariate_numeric(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Per numeric column: mean, median, std (n-1), min, max, q1, q3, skewness
    (G1, 0 when n <= 2), kurtosis (G2, 0 when n <= 3), non_null_count, missing_count."""
    cols = cols or numeric_columns(df)
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for c in cols:
        x = present(df, c).cast("double")
        n = F.count(x)
        aggs += [F.avg(x).alias(f"{c}__mean"),
                 F.when(n > 1, F.stddev_samp(x)).when(n == 1, F.lit(0.0)).alias(f"{c}__std"),
                 F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max"),
                 F.when(n > 2, _g1(x)).when(n > 0, F.lit(0.0)).alias(f"{c}__skewness"),
                 F.when(n > 3, _g2(x)).when(n > 0, F.lit(0.0)).alias(f"{c}__kurtosis"),
                 n.alias(f"{c}__non_null_count")]
    fives = quantiles(df, {f"{c}__q": (present(df, c), [0.25, 0.5, 0.75]) for c in cols})
    row = df.agg(*aggs).crossJoin(fives)  # single rows
    row = row.select("*", *[F.col(f"`{c}__q`")[i].alias(f"{c}__{q}") for c in cols for i, q in enumerate(("q1", "median", "q3"))],
                     *[(F.col("__rows") - F.col(f"{c}__non_null_count")).alias(f"{c}__missing_count")
                            for c in cols])
    metrics = ["mean", "median", "std", "min", "max", "q1", "q3", "skewness", "kurtosis",
               "non_null_count", "missing_count"]
    types = {m: "double" for m in metrics[:9]} | {"non_null_count": "long", "missing_count": "long"}
    return _long(row, cols, metrics, types)


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """(value, count) over non-null values (``value`` as string)."""
    v = present(df, col)
    return (df.select(v.cast("string").alias("value")).filter(F.col("value").isNotNull())
              .groupBy("value").agg(F.count(F.lit(1)).alias("count")))


def univariate_categorical(df: DataFrame, col: str) -> DataFrame:
    """Frequency table (value, count, percentage of non-null, 2 dp) with the
    column summary repeated on each row: unique_count, top_value,
    top_frequency (ties -> smallest value), non_null_count, missing_count."""
    vc = value_counts(df, col)
    summ = df.agg(F.count(F.lit(1)).alias("__rows"), F.count(present(df, col)).alias("non_null_count"))
    top = vc.agg(F.count(F.lit(1)).alias("unique_count"),
                 F.min_by(F.struct(F.col("value")), F.struct(-F.col("count"), F.col("value")))["value"]
                 .alias("top_value"), F.max("count").alias("top_frequency"))
    s = summ.crossJoin(top).select("unique_count", "top_value", "top_frequency", "non_null_count",
                                   (F.col("__rows") - F.col("non_null_count")).alias("missing_count"))
    return vc.crossJoin(F.broadcast(s)).select(
        F.lit(col).alias("column"), "value", "count",
        F.round(F.col("count") / F.col("non_null_count") * 100.0, 2).alias("percentage"),
        "unique_count", "top_value", "top_frequency", "non_null_count", "missing_count")


def distribution_shape(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Numeric columns with at least 3 values: mean, median, skewness, kurtosis
    (2 dp) and shape (|skew| < 0.5 symmetric, >= 0.5 right, else left)."""
    if cols is None:
        cls = classes_dict(df)
        cols = [c for c in numeric_columns(df) if cls.get(c) == "numerical"]
    u = univariate_numeric(df, cols).filter(F.col("non_null_count") >= 3)
    shape = (F.when(F.abs("skewness") < 0.5, "symmetric")
             .when(F.col("skewness") >= 0.5, "right").otherwise("left"))
    return u.select("column", F.round("mean", 2).alias("mean"), F.round("median", 2).alias("median"),
                    F.round("skewness", 2).alias("skewness"), F.round("kurtosis", 2).alias("kurtosis"),
                    shape.alias("shape"))


# ---------------------------------------------------------------------------
# Q11-Q13 chart data
# ---------------------------------------------------------------------------

def top_k_with_other(df: DataFrame, col: str, k: int = 15, other: str = "Other") -> DataFrame:
    """The k most frequent values (ties -> smaller value first) plus one
    ``Other`` row with the remaining count when there is a remainder.  The
    top-k is ``orderBy.limit`` (per-partition top-k, then merge)."""
    vc = value_counts(df, col)
    top = vc.orderBy(F.desc("count"), "value").limit(k)
    rest = vc.join(top.select("value"), "value", "left_anti").agg(F.sum("count").cast("long").alias("count"))
    rest = rest.filter(F.col("count").isNotNull() & (F.col("count") > 0)).select(F.lit(other).alias("value"), "count")
    return top.unionByName(rest)


def histogram(df: DataFrame, col: str, bins: int = 40) -> DataFrame:
    """numpy-style equal-width histogram between min and max (last bin closed):
    bin (1..bins), lower, upper, count, density = count / (n * width).
    Empty bins are emitted from a ``sequence`` spine."""
    x = present(df, col).cast("double")
    stats = df.agg(F.min(x).alias("__lo"), F.max(x).alias("__hi"), F.count(x).alias("__n"))
    width = F.when(F.col("__hi") > F.col("__lo"), (F.col("__hi") - F.col("__lo")) / bins).otherwise(F.lit(1.0 / bins))
    lo = F.when(F.col("__hi") > F.col("__lo"), F.col("__lo")).otherwise(F.col("__lo") - 0.5)
    vals = df.select(x.alias("__x")).filter(F.col("__x").isNotNull()).crossJoin(F.broadcast(stats))
    b = F.least(F.floor((F.col("__x") - lo) / width).cast("int") + 1, F.lit(bins))
    counts = vals.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    spine = stats.select(F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"), "*")
    return (spine.join(counts, "bin", "left")
                 .select("bin", (lo + (F.col("bin") - 1) * width).alias("lower"), (lo + F.col("bin") * width).alias("upper"),
                         F.coalesce("count", F.lit(0)).cast("long").alias("count"),
                         (F.coalesce("count", F.lit(0)) / (F.col("__n") * width)).alias("density")))


def box_summary(df: DataFrame, col: str, by: list[str] | None = None) -> DataFrame:
    """Five numbers (+ IQR fences and outlier count) per group (nulls dropped from keys)."""
    by = by or []
    x = present(df, col).cast("double")
    d = df.select(*by, x.alias("__x")).filter(F.col("__x").isNotNull())
    for k in by:
        d = d.filter(F.col(k).isNotNull())
    q = d.groupBy(*by).agg(F.count("__x").alias("n"), F.min("__x").alias("min"), F.max("__x").alias("max"))
    fives = quantiles(d, {"__q": (F.col("__x"), [0.25, 0.5, 0.75])}, by)
    q = (q.join(fives, by) if by else q.crossJoin(fives)).select(
        *by, "n", "min", *[F.col("__q")[i].alias(c) for i, c in enumerate(("q1", "median", "q3"))], "max")
    q = q.withColumn("lower_fence", F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))) \
         .withColumn("upper_fence", F.col("q3") + 1.5 * (F.col("q3") - F.col("q1")))
    outl = d.join(q.select(*by, "lower_fence", "upper_fence"), by, "inner") if by else \
        d.crossJoin(F.broadcast(q.select("lower_fence", "upper_fence")))
    oc = outl.groupBy(*by).agg(F.count_if((F.col("__x") < F.col("lower_fence")) |
                                          (F.col("__x") > F.col("upper_fence"))).alias("n_outliers"))
    return q.join(oc, by, "left") if by else q.crossJoin(oc)


# ---------------------------------------------------------------------------
# Q14-Q16
# ---------------------------------------------------------------------------

# Fixed value: correlation beyond which two columns count as collinear.
COLLINEAR = 0.8


def collinear_pairs(df: DataFrame, threshold: float = COLLINEAR) -> DataFrame:
    """One row: the number of pairs of numeric columns whose correlation (over rows
    where both are present) is beyond ``threshold`` either way."""
    cols = [c for c in df.columns if is_numeric(df, c)]
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    x = {c: present(df, c).cast("double") for c in cols}
    close = [F.when(F.abs(F.corr(x[a], x[b])) > threshold, 1).otherwise(0) for a, b in pairs]
    return df.agg((reduce(lambda a, b: a + b, close) if close else F.lit(0)).cast("long").alias("collinear_pairs"))


def before_after_summary(before: DataFrame, after: DataFrame, stages: list[str] | None = None) -> DataFrame:
    """Two rows (stage original / latest): rows, columns, missing cells, duplicates,
    quality score, collinear pairs, and the names of the applied ``stages``."""
    def one(df, stage):
        miss = df.agg(reduce(lambda a, b: a + b, [F.count_if(is_missing(df, c)) for c in df.columns])
                      .cast("long").alias("missing_cells"))
        q = quality_score(df)
        return q.crossJoin(miss).crossJoin(collinear_pairs(df)).select(  # single rows
            F.lit(stage).alias("stage"), "total_rows", "total_columns", "missing_cells", "duplicate_rows", "quality_score",
            "collinear_pairs", F.lit(", ".join(stages or []) if stage == "latest" else "").alias("applied_stages"))
    return one(before, "original").unionByName(one(after, "latest"))


def feature_metadata(df: DataFrame, cols: list[str]) -> DataFrame:
    """Form metadata in long form: numeric feature -> (min, max, mean) row;
    other feature -> one row per distinct option (kept distributed, no list
    is collected into one group)."""
    num = [c for c in cols if is_numeric(df, c)]
    cat = [c for c in cols if c not in num]
    parts = []
    if num:
        row = df.agg(*[F.min(F.col(c).cast("double")).alias(f"{c}__min") for c in num],
                     *[F.max(F.col(c).cast("double")).alias(f"{c}__max") for c in num],
                     *[F.avg(F.col(c).cast("double")).alias(f"{c}__mean") for c in num])
        parts.append(_long(row, num, ["min", "max", "mean"], {"min": "double", "max": "double", "mean": "double"})
                     .select(F.col("column").alias("feature"), F.lit("numeric").alias("kind"),
                             F.lit(None).cast("string").alias("option"), "min", "max", "mean"))
    for c in cat:
        parts.append(df.select(F.col(c).cast("string").alias("option")).filter(F.col("option").isNotNull())
                     .distinct().select(F.lit(c).alias("feature"), F.lit("categorical").alias("kind"), "option",
                                        *[F.lit(None).cast("double").alias(m) for m in ("min", "max", "mean")]))
    return reduce(DataFrame.unionByName, parts)


def dataset_counts(df: DataFrame, distinct_cols: list[str]) -> DataFrame:
    """rows plus exact distinct counts of the given columns (one aggregate)."""
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  *[F.count_distinct(c).alias(f"distinct_{c}") for c in distinct_cols])


def dtype_table(df: DataFrame) -> DataFrame:
    """(column, class, dtype) plus the count of columns per class."""
    cls = classify_columns(df)
    counts = cls.groupBy("class").agg(F.count(F.lit(1)).alias("class_count"))
    return cls.join(counts, "class")
