"""Feature screening, mutual information, target correlation and PCA (F-series)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crease.operators.profile import is_missing, is_numeric, present
from crease.operators.scan import quantiles

ID_COLUMNS = ["match_id", "id", "index"]
MI_BINS = 10
MI_REMOVE_BELOW = 0.005


def feature_screen(df: DataFrame, target: str | None = None) -> DataFrame:
    """Per column except the target, in the reference's order: missing > 40 % ->
    Remove; numeric with variance (n-1) < 0.001 or undefined -> Remove; other
    columns with <= 1 distinct value -> Remove; other columns whose name has 'id'
    and whose values are all distinct -> Remove; else Select.  ``reason`` is a code
    (missing, flat, constant, identifier, ok); the numbers behind it are columns."""
    cols = [c for c in df.columns if c != target]
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for c in cols:
        aggs.append(F.count_if(is_missing(df, c)).alias(f"{c}__m"))
        if is_numeric(df, c):
            aggs.append(F.var_samp(present(df, c).cast("double")).alias(f"{c}__v"))
        else:
            aggs.append(F.count_distinct(present(df, c)).alias(f"{c}__d"))
    row = df.agg(*aggs)
    cells = []
    for c in cols:
        n = F.col("__rows")
        pct = F.when(n > 0, F.col(f"`{c}__m`") / n * 100.0).otherwise(F.lit(0.0))
        if is_numeric(df, c):
            v = F.col(f"`{c}__v`")
            low = v.isNull() | F.isnan(v) | (v < 0.001)
            status = F.when(pct > 40.0, "Remove").when(low, "Remove").otherwise("Select")
            reason = F.when(pct > 40.0, "missing").when(low, "flat").otherwise("ok")
            var = F.round(F.coalesce(v, F.lit(float("nan"))), 4)
        else:
            d = F.col(f"`{c}__d`")
            is_id = "id" in c.lower()
            status = (F.when(pct > 40.0, "Remove").when(d <= 1, "Remove")
                      .when(F.lit(is_id) & (d == n), "Remove").otherwise("Select"))
            reason = (F.when(pct > 40.0, "missing").when(d <= 1, "constant")
                      .when(F.lit(is_id) & (d == n), "identifier").otherwise("ok"))
            var = F.lit(None).cast("double")
        cells.append(F.struct(F.lit(c).alias("feature"), status.alias("status"), reason.alias("reason"),
                              var.alias("variance"), F.round(pct, 2).alias("missing_percentage")))
    return row.select(F.explode(F.array(*cells)).alias("__c")).select("__c.*")


def mutual_information(df: DataFrame, features: list[str], target: str, bins: int = MI_BINS) -> DataFrame:
    """Mutual information (nats) between each feature and the target, from
    contingency counts: sum p(x,y) ln(p(x,y) / (p(x) p(y))).  Numeric features
    (and a numeric target) are discretised at exact quantiles (cut = number of
    decile points strictly below the value; null -> the median's bin); text
    nulls become 'Missing_Val'.  Rows with a null target are dropped.
    Deterministic re-aim of the reference's k-NN estimator (see README)."""
    d = df.filter(F.col(target).isNotNull())
    probs = [i / bins for i in range(1, bins)]
    numeric = [c for c in features + [target] if is_numeric(d, c)]
    j = d
    if numeric:
        cuts = quantiles(d, {f"{c}__q": (present(d, c), probs) for c in numeric} |
                         {f"{c}__med": (present(d, c), [0.5]) for c in numeric})
        j = d.crossJoin(F.broadcast(cuts))  # one row of cut points

    def code(c):
        if c in numeric:
            x = F.coalesce(present(d, c).cast("double"), F.col(f"{c}__med")[0])
            return F.size(F.filter(F.col(f"{c}__q"), lambda q: q < x)).cast("string")
        return F.coalesce(F.col(c).cast("string"), F.lit("Missing_Val"))

    coded = j.select(code(target).alias("__y"), *[code(c).alias(c) for c in features])
    long = coded.select("__y", F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("x"))
                                                  for c in features])).alias("__f")) \
                .select("__f.feature", "__f.x", "__y")
    joint = long.groupBy("feature", "x", "__y").agg(F.count(F.lit(1)).alias("nxy"))
    px = joint.groupBy("feature", "x").agg(F.sum("nxy").alias("nx"))
    py = joint.groupBy("feature", "__y").agg(F.sum("nxy").alias("ny"))
    n = joint.groupBy("feature").agg(F.sum("nxy").alias("n"))
    t = joint.join(px, ["feature", "x"]).join(py, ["feature", "__y"]).join(n, "feature")
    term = F.col("nxy") / F.col("n") * F.log(F.col("nxy") * F.col("n") / (F.col("nx") * F.col("ny")))
    mi = t.groupBy("feature").agg(F.sum(term).alias("mutual_info"))
    return mi.withColumn("status", F.when(F.col("mutual_info") < MI_REMOVE_BELOW, "Remove").otherwise("Select"))


def target_correlation(df: DataFrame, features: list[str], target: str) -> DataFrame:
    """Pearson r of each numeric feature with a numeric target (3 dp; null -> 0).
    One aggregate pass, pairwise-complete rows."""
    t = present(df, target).cast("double")
    row = df.agg(*[F.corr(present(df, c).cast("double"), t).alias(c) for c in features])
    cells = [F.struct(F.lit(c).alias("feature"), F.coalesce(F.round(F.col(c), 3), F.lit(0.0)).alias("correlation"))
             for c in features]
    return row.select(F.explode(F.array(*cells)).alias("__c")).select("__c.*")


def pca(df: DataFrame, k: int = 2, target: str | None = None, id_col: str | None = None,
        cols: list[str] | None = None):
    """PCA on the numeric columns (minus target and id-like names): nulls -> median,
    centred (not scaled), k clamped to [1, #columns].  Returns (projection with
    PC1..PCk (+ id, target), ratios (component, explained, cumulative)).
    Components are sign-normalised: the largest-|loading| entry is positive.

    Spark ML's PCA forms the covariance matrix with a distributed tree aggregate
    (k x k, independent of the row count) and decomposes it on the driver."""
    from pyspark.ml.feature import PCA, VectorAssembler
    from pyspark.ml.functions import vector_to_array

    if cols is None:
        cols = [c for c in df.columns if is_numeric(df, c) and c != target and c not in ID_COLUMNS and c != id_col]
    k = max(1, min(k, len(cols)))
    meds = {c: v[0] if v else None
            for c, v in quantiles(df, {c: (present(df, c), [0.5]) for c in cols}).first().asDict().items()}
    filled = df.select(*([id_col] if id_col else []), *([target] if target else []),
                       *[F.coalesce(present(df, c).cast("double"), F.lit(meds[c] if meds[c] is not None else 0.0))
                         .alias(c) for c in cols])
    means = filled.agg(*[F.avg(c).alias(c) for c in cols]).first().asDict()
    centred = filled.select(*([id_col] if id_col else []), *([target] if target else []),
                            *[(F.col(c) - F.lit(means[c])).alias(c) for c in cols])
    va = VectorAssembler(inputCols=cols, outputCol="__v")
    model = PCA(k=k, inputCol="__v", outputCol="__pc").fit(va.transform(centred))
    pcm = model.pc.toArray()  # d x k loadings (small)
    signs = []
    for j in range(k):
        col = pcm[:, j]
        signs.append(1.0 if col[abs(col).argmax()] >= 0 else -1.0)
    proj = model.transform(va.transform(centred)).select(
        *([id_col] if id_col else []), *([target] if target else []),
        *[(vector_to_array("__pc")[j] * signs[j]).alias(f"PC{j + 1}") for j in range(k)])
    ratios = [float(x) for x in model.explainedVariance.toArray()]
    cum, acc = [], 0.0
    for r in ratios:
        acc += r
        cum.append(acc)
    ratio_df = df.sparkSession.createDataFrame(
        [(f"PC{j + 1}", ratios[j], cum[j]) for j in range(k)], "component string, explained double, cumulative double")
    return proj, ratio_df


def pca_2d_scaled(df: DataFrame, cols: list[str], id_col: str | None = None):
    """Two components on standardised (population std) features."""
    from crease.operators.prepare import scale_standard
    scaled = scale_standard(df.select(*([id_col] if id_col else []), *cols), cols)
    return pca(scaled, 2, id_col=id_col, cols=cols)
