"""Encoding, scaling, splitting and sampling (the preparation steps).

Statistics are computed in one aggregate pass and applied as column
expressions against a one-row statistics table (broadcast: its size is fixed
by the number of columns, not by the data).  Dictionaries are distributed
DataFrames of (value, code); codes come from a running count over the sorted
distinct values, never from a single-partition window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crease.operators.scan import quantiles, running_totals

# Names of the categories of missing and of unseen values.
MISSING = "Missing"
UNKNOWN = "<unknown>"
# Most distinct levels that become columns of their own.
ONE_HOT_MAX_LEVELS = 1000


def dictionary_codes(df: DataFrame, col: str, out: str = "code") -> DataFrame:
    """(value, code) for the distinct non-null values of ``col``: codes 0.. in
    ascending (binary) order -- sklearn ``LabelEncoder`` numbering."""
    distinct = df.select(col).filter(F.col(col).isNotNull()).distinct()
    rt = running_totals(distinct, [], [col], {out: F.lit(1)}, exclusive=True)
    return rt.select(col, F.col(out).cast("int").alias(out))


def label_encode(df: DataFrame, col: str, missing: str = MISSING) -> tuple[DataFrame, DataFrame]:
    """Replace ``col`` by its code; null -> ``Missing`` (a category like the
    others), values compared as strings.  Returns (encoded df, dictionary)."""
    as_text = F.coalesce(F.col(col).cast("string"), F.lit(missing))
    base = df.withColumn(col, as_text)
    codes = dictionary_codes(base, col)
    return base.join(codes.withColumnRenamed("code", "__code"), col, "left") \
               .withColumn(col, F.col("__code")).drop("__code"), codes


def label_encode_unseen(train: DataFrame, score: DataFrame, col: str,
                        unknown: str = UNKNOWN, unseen_to_zero: bool = False) -> tuple[DataFrame, DataFrame]:
    """Dictionary fitted on ``train`` plus an ``<unknown>`` class sorted with the
    rest; ``score`` values not in the dictionary map to ``<unknown>`` (or to
    class 0 with ``unseen_to_zero``).  Returns (encoded score, dictionary)."""
    vals = train.select(F.col(col).cast("string").alias(col)).filter(F.col(col).isNotNull())
    if not unseen_to_zero:
        vals = vals.unionAll(train.sparkSession.range(1).select(F.lit(unknown).alias(col)))
    codes = dictionary_codes(vals, col)
    s = score.withColumn("__v", F.col(col).cast("string"))
    j = s.join(codes.withColumnRenamed(col, "__v").withColumnRenamed("code", "__code"), "__v", "left")
    if unseen_to_zero:
        fill = F.lit(0)
    else:
        unk = codes.filter(F.col(col) == unknown).select(F.col("code").alias("__unk"))
        j = j.crossJoin(F.broadcast(unk))  # single row
        fill = F.col("__unk")
    out = j.withColumn(col, F.coalesce(F.col("__code"), fill)).drop("__v", "__code", "__unk")
    return out, codes


def one_hot(df: DataFrame, col: str, missing: str = MISSING, shape: str = "columns",
            max_levels: int = ONE_HOT_MAX_LEVELS) -> DataFrame:
    """The one-hot code of ``col`` (null -> Missing, no dropped level, source column
    removed).  ``shape="columns"``: one 0/1 column ``{col}_{value}`` per distinct
    value; these become the output schema, so they are fetched, and more than
    ``max_levels`` are an error.  ``shape="vector"``: one sparse vector column
    ``{col}_onehot`` for any number of levels."""
    if shape == "vector":
        return one_hot_vector(df, col, missing)
    if shape != "columns":
        raise ValueError(shape)
    as_text = F.coalesce(F.col(col).cast("string"), F.lit(missing))
    levels_df = df.select(as_text.alias("v")).distinct()
    levels = [r[0] for r in levels_df.orderBy("v").limit(max_levels + 1).collect()]
    if len(levels) > max_levels:
        raise ValueError(f"{col} has more than {max_levels} levels: raise max_levels, or take shape='vector'")
    rest = [F.col(c) for c in df.columns if c != col]
    return df.select(*rest, *[(as_text == F.lit(v)).cast("int").alias(f"{col}_{v}") for v in levels])


def one_hot_vector(df: DataFrame, col: str, missing: str = MISSING) -> DataFrame:
    """The one-hot code as a sparse vector ``{col}_onehot``: no level reaches the
    driver, codes are those of ``label_encode``."""
    from pyspark.ml.feature import OneHotEncoder

    coded, _ = label_encode(df, col, missing)
    encoder = OneHotEncoder(inputCol=col, outputCol=f"{col}_onehot", dropLast=False)
    return encoder.fit(coded).transform(coded).drop(col)


# ---------------------------------------------------------------------------
# Scalers (null -> median first, as the reference does)
# ---------------------------------------------------------------------------

def _scale(df: DataFrame, cols: list[str], method: str) -> DataFrame:
    if method not in ("standard", "minmax", "robust"):
        raise ValueError(method)
    # Pass 1: medians of the columns that have nulls, to fill these (as the reference, before fitting).
    may = [c for c in cols if df.schema[c].nullable]
    nulls = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in may]).first() if may else {}
    some = [c for c in may if nulls[c]]
    filled = df.select(*[F.col(c).cast("double").alias(c) if c in cols else F.col(c) for c in df.columns])
    if some:
        meds = quantiles(df, {f"{c}__med": (F.col(c), [0.5]) for c in some}) \
            .select(*[F.col(f"{c}__med")[0].alias(f"{c}__med") for c in some])
        filled = filled.crossJoin(F.broadcast(meds)).select(*[
            F.coalesce(F.col(c), F.col(f"{c}__med")).alias(c) if c in some else F.col(c) for c in df.columns])
    # Pass 2: the scaler's statistics on the filled column.
    aggs = []
    for c in cols:
        x = F.col(c)
        if method == "standard":
            aggs += [F.avg(x).alias(f"{c}__a"), F.stddev_pop(x).alias(f"{c}__b")]
        elif method == "minmax":
            aggs += [F.min(x).alias(f"{c}__a"), F.max(x).alias(f"{c}__b")]
    if method == "robust":
        fives = quantiles(filled, {c: (F.col(c), [0.25, 0.5, 0.75]) for c in cols})
        stats = fives.select(*[x for c in cols for x in (F.col(c)[1].alias(f"{c}__a"), (F.col(c)[2] - F.col(c)[0]).alias(f"{c}__b"))])
    else:
        stats = filled.agg(*aggs)
    j = filled.crossJoin(F.broadcast(stats))  # one-row statistics
    out = []
    for c in df.columns:
        if c not in cols:
            out.append(F.col(c))
            continue
        a, b = F.col(f"{c}__a"), F.col(f"{c}__b")
        if method == "minmax":
            center, scale = a, b - a
        else:
            center, scale = a, b
        out.append(((F.col(c) - center) / F.when(scale == 0, F.lit(1.0)).otherwise(scale)).alias(c))
    return j.select(*out)


def scale_standard(df: DataFrame, cols: list[str]) -> DataFrame:
    """(x - mean) / std_pop on the median-filled column; zero std -> divide by 1."""
    return _scale(df, cols, "standard")


def scale_minmax(df: DataFrame, cols: list[str]) -> DataFrame:
    """(x - min) / (max - min) on the median-filled column; zero range -> 1."""
    return _scale(df, cols, "minmax")


def scale_robust(df: DataFrame, cols: list[str]) -> DataFrame:
    """(x - median) / (q3 - q1), linear-interpolated quartiles; zero IQR -> 1."""
    return _scale(df, cols, "robust")


# ---------------------------------------------------------------------------
# Splits, samples, folds.  Randomness is portable integer arithmetic on an id so
# the same split is reproducible in any SQL engine.
# ---------------------------------------------------------------------------

HASH_MUL = 2654435761
HASH_MOD = 1000003


def portable_hash(id_col: Column, seed: int = 42) -> Column:
    """((id mod 1000003 + seed) * 2654435761) mod 1000003 -- a shuffle key both
    engines compute without 64-bit overflow."""
    return F.pmod((F.pmod(id_col.cast("long"), F.lit(HASH_MOD)) + F.lit(seed)) * F.lit(HASH_MUL),
                  F.lit(HASH_MOD))


def train_test_split(df: DataFrame, id_col: str, test_size: float = 0.2, seed: int = 42,
                     rounding: str = "floor", label: str | None = None) -> DataFrame:
    """Adds ``split`` in {train, test}: the ``test_count`` rows first in the hash
    order go to test, where test_count = floor(n * test_size) (``rounding='floor'``,
    the reference's own split) or ceil (sklearn).  With ``label`` the split is
    stratified: the same count rule applied inside each label.

    The position in hash order is a running count (range-blocked, no single
    partition window); the per-group sizes come from one aggregate.
    """
    keys = [label] if label else []
    h = portable_hash(F.col(id_col), seed)
    d = df.withColumn("__h", h)
    pos = running_totals(d, keys, ["__h", id_col], {"__pos": F.lit(1)}, exclusive=True)
    sizes = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    rnd = F.floor if rounding == "floor" else F.ceil
    sizes = sizes.withColumn("__test", rnd(F.col("__n") * F.lit(float(test_size))).cast("long"))
    if keys:  # a null label is a stratum like the others
        sizes = sizes.withColumnRenamed(label, "__label")
        j = pos.join(sizes, F.col(label).eqNullSafe(F.col("__label"))).drop("__label")
    else:
        j = pos.crossJoin(sizes)  # one row
    return j.withColumn("split", F.when(F.col("__pos") < F.col("__test"), "test").otherwise("train")) \
            .drop("__h", "__pos", "__n", "__test")


def cap_sample(df: DataFrame, id_col: str, n: int, seed: int = 42) -> DataFrame:
    """At most ``n`` rows, the first in hash order (a seeded sample; the limit is
    the feature).  ``orderBy(...).limit(n)`` plans as a per-partition top-n."""
    return df.orderBy(portable_hash(F.col(id_col), seed), F.col(id_col)).limit(n)


def kfold_assign(df: DataFrame, id_col: str, k: int = 5, seed: int = 42,
                 label: str | None = None) -> DataFrame:
    """``fold`` in 0..k-1: position in hash order (within the label when
    stratified) modulo k."""
    keys = [label] if label else []
    d = df.withColumn("__h", portable_hash(F.col(id_col), seed))
    pos = running_totals(d, keys, ["__h", id_col], {"__pos": F.lit(1)}, exclusive=True)
    return pos.withColumn("fold", (F.col("__pos") % k).cast("int")).drop("__h", "__pos")


def recommend_encoding(df: DataFrame, cols: list[str]) -> DataFrame:
    """distinct > 2 -> onehot, else label (distinct over the whole table)."""
    row = df.agg(*[F.count_distinct(c).alias(c) for c in cols])
    long = row.unpivot([], cols, "column", "n_distinct")
    return long.withColumn("encoding", F.when(F.col("n_distinct") > 2, "onehot").otherwise("label"))


def recommend_scaler(df: DataFrame, cols: list[str], threshold: int = 5) -> DataFrame:
    """More than ``threshold`` IQR outliers -> robust, else standard."""
    from crease.operators.clean import outlier_counts
    oc = outlier_counts(df, cols)
    return oc.withColumn("scaler", F.when(F.col("n_outliers") > threshold, "robust").otherwise("standard"))
