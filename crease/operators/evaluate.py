"""Evaluation on (label, prediction, score) tables: regression and
classification metrics, exact ROC AUC and curve, confusion matrix, report,
silhouette and Davies-Bouldin for clusterings.

Everything is an aggregate over the prediction table; global ranks and
cumulative sums use the blocked scans of ``crease.operators.scan``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crease.operators.scan import rank_histogram, running_totals


def _safe_div(a: Column, b: Column) -> Column:
    return F.when(b != 0, a / b).otherwise(F.lit(0.0))


def regression_metrics(df: DataFrame, label: str, pred: str, n_features: int = 1) -> DataFrame:
    """MAE, MSE, RMSE, R^2 and adjusted R^2 (null when n - p - 1 <= 0)."""
    e = F.col(pred).cast("double") - F.col(label).cast("double")
    s = df.agg(F.count(F.lit(1)).alias("n"), F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"),
               F.sum(e * e).alias("__sse"), F.var_pop(F.col(label).cast("double")).alias("__vy"))
    r2 = F.when(F.col("__vy") > 0, 1 - F.col("__sse") / (F.col("__vy") * F.col("n")))
    adj = F.when(F.col("n") - n_features - 1 > 0,
                 1 - (1 - r2) * (F.col("n") - 1) / (F.col("n") - n_features - 1))
    return s.select("n", "mae", "mse", F.sqrt("mse").alias("rmse"), r2.alias("r2"), adj.alias("adj_r2"))


def binary_metrics(df: DataFrame, label: str, pred: str, positive=1) -> DataFrame:
    """accuracy, precision, recall, F1 (0 on zero division) for the positive class."""
    y, p = F.col(label), F.col(pred)
    s = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(y == p).alias("__ok"),
               F.count_if((y == positive) & (p == positive)).alias("tp"),
               F.count_if((y != positive) & (p == positive)).alias("fp"),
               F.count_if((y == positive) & (p != positive)).alias("fn"))
    prec = _safe_div(F.col("tp"), F.col("tp") + F.col("fp"))
    rec = _safe_div(F.col("tp"), F.col("tp") + F.col("fn"))
    return s.select("n", _safe_div(F.col("__ok"), F.col("n")).alias("accuracy"), prec.alias("precision"),
                    rec.alias("recall"), _safe_div(2 * prec * rec, prec + rec).alias("f1"))


def per_class_counts(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Per class in labels U predictions: tp, fp, fn, support."""
    y = df.select(F.col(label).cast("string").alias("cls"), F.lit(1).alias("__y"), F.lit(0).alias("__p"),
                  (F.col(label) == F.col(pred)).cast("int").alias("__tp"))
    p = df.select(F.col(pred).cast("string").alias("cls"), F.lit(0).alias("__y"), F.lit(1).alias("__p"),
                  F.lit(0).alias("__tp"))
    u = y.unionAll(p).filter(F.col("cls").isNotNull())
    c = u.groupBy("cls").agg(F.sum("__y").alias("support"), F.sum("__p").alias("predicted"),
                             F.sum("__tp").alias("tp"))
    return c.select("cls", "support", "tp", (F.col("predicted") - F.col("tp")).alias("fp"),
                    (F.col("support") - F.col("tp")).alias("fn"))


def classification_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Per class precision / recall / f1 / support, then accuracy, macro avg and
    weighted avg rows (classes = labels U predictions)."""
    c = per_class_counts(df, label, pred)
    prec = _safe_div(F.col("tp"), F.col("tp") + F.col("fp"))
    rec = _safe_div(F.col("tp"), F.col("tp") + F.col("fn"))
    per = c.select(F.col("cls").alias("row"), prec.alias("precision"), rec.alias("recall"),
                   _safe_div(2 * prec * rec, prec + rec).alias("f1"), F.col("support").cast("long").alias("support"))
    tot = per.agg(F.sum("support").alias("__n"))
    acc = df.agg(F.count_if(F.col(label) == F.col(pred)).alias("__ok"), F.count(F.lit(1)).alias("__rows"))
    macro = per.agg(F.avg("precision").alias("precision"), F.avg("recall").alias("recall"), F.avg("f1").alias("f1"),
                    F.sum("support").cast("long").alias("support")).select(F.lit("macro avg").alias("row"), "*")
    w = per.crossJoin(tot).agg(
        (F.sum(F.col("precision") * F.col("support")) / F.first("__n")).alias("precision"),
        (F.sum(F.col("recall") * F.col("support")) / F.first("__n")).alias("recall"),
        (F.sum(F.col("f1") * F.col("support")) / F.first("__n")).alias("f1"),
        F.sum("support").cast("long").alias("support")).select(F.lit("weighted avg").alias("row"), "*")
    a = acc.select(F.lit("accuracy").alias("row"), F.lit(None).cast("double").alias("precision"),
                   F.lit(None).cast("double").alias("recall"), _safe_div(F.col("__ok"), F.col("__rows")).alias("f1"),
                   F.col("__rows").cast("long").alias("support"))
    return reduce(DataFrame.unionByName, [per, a, macro, w])


def macro_metrics(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Macro precision / recall / F1 over the classes in labels U predictions."""
    rep = classification_report(df, label, pred).filter(F.col("row") == "macro avg")
    return rep.select(F.col("precision").alias("macro_precision"), F.col("recall").alias("macro_recall"),
                      F.col("f1").alias("macro_f1"))


def roc_auc(df: DataFrame, label: str, score: str, positive=1) -> DataFrame:
    """Exact AUC by Mann-Whitney: (R_pos - n_pos (n_pos + 1) / 2) / (n_pos n_neg),
    ranks averaged over tied scores (value histogram, no global window)."""
    d = df.select(F.col(score).cast("double").alias("__s"), (F.col(label) == positive).cast("int").alias("__pos")) \
          .filter(F.col("__s").isNotNull() & F.col("__pos").isNotNull())
    hist = rank_histogram(d, "__s")
    per = d.groupBy("__s").agg(F.sum("__pos").alias("__np")).join(hist, "__s")
    s = per.agg(F.sum(F.col("__np") * F.col("avg_rank")).alias("__r"), F.sum("__np").alias("n_pos"),
                F.sum("ties").alias("__n"))
    npos, nneg = F.col("n_pos"), F.col("__n") - F.col("n_pos")
    auc = F.when((npos > 0) & (nneg > 0), (F.col("__r") - npos * (npos + 1) / 2.0) / (npos * nneg))
    return s.select(auc.alias("auc"), npos.cast("long").alias("n_pos"), nneg.cast("long").alias("n_neg"))


def roc_auc_ovr(df: DataFrame, label: str, class_scores: dict[str, str]) -> DataFrame:
    """One-vs-rest macro AUC: mean of per-class exact AUCs (class value -> score column)."""
    parts = [roc_auc(df, label, col, positive=cls).select(F.lit(str(cls)).alias("cls"), "auc")
             for cls, col in class_scores.items()]
    return reduce(DataFrame.unionAll, parts).agg(F.avg("auc").alias("macro_auc"))


def roc_curve(df: DataFrame, label: str, score: str, positive=1) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score, descending: cumulative
    positives / negatives at scores >= threshold (blocked running sums)."""
    d = df.select(F.col(score).cast("double").alias("threshold"), (F.col(label) == positive).cast("int").alias("__pos"))
    per = d.filter(F.col("threshold").isNotNull()).groupBy("threshold").agg(
        F.sum("__pos").alias("__p"), F.count(F.lit(1)).alias("__c"))
    per = per.withColumn("__neg_t", -F.col("threshold"))
    cum = running_totals(per, [], ["__neg_t"], {"tp": F.col("__p"), "fp": F.col("__c") - F.col("__p")},
                         exclusive=False)
    tot = per.agg(F.sum("__p").alias("__tot_pos"), (F.sum("__c") - F.sum("__p")).alias("__tot_neg"))
    return cum.crossJoin(tot).select(  # one-row totals
        "threshold", _safe_div(F.col("fp"), F.col("__tot_neg")).alias("fpr"),
        _safe_div(F.col("tp"), F.col("__tot_pos")).alias("tpr"))


def confusion_matrix(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Counts for every (actual, predicted) pair of levels, zeros included."""
    levels = df.select(F.col(label).cast("string").alias("v")).unionAll(df.select(F.col(pred).cast("string").alias("v"))) \
               .filter(F.col("v").isNotNull()).distinct()
    counts = df.groupBy(F.col(label).cast("string").alias("actual"), F.col(pred).cast("string").alias("predicted")) \
               .agg(F.count(F.lit(1)).alias("count"))
    spine = levels.withColumnRenamed("v", "actual").crossJoin(levels.withColumnRenamed("v", "predicted"))  # classes^2
    return spine.join(counts, ["actual", "predicted"], "left").select(
        "actual", "predicted", F.coalesce("count", F.lit(0)).cast("long").alias("count"))


def _vec_cols(df: DataFrame, features: list[str]) -> list[Column]:
    return [F.col(c).cast("double") for c in features]


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda u, v: u * v), F.lit(0.0), lambda acc, t: acc + t)


def silhouette_sq(df: DataFrame, features: list[str], cluster: str) -> DataFrame:
    """Mean silhouette with squared Euclidean distance in O(n k d), no point pairs.

    The mean squared distance from x to cluster C is |x|^2 - 2 x.S_C / n_C + Q_C / n_C
    (S = vector sum, Q = sum of squared norms of C); for the point's own cluster the
    mean excludes the point: scaled by n_A / (n_A - 1).  Singletons score 0; fewer
    than 2 clusters -> null.  The k cluster summaries form one row (size bound:
    number of clusters x dimensions), broadcast to a single narrow pass over points.
    """
    vec = F.array(*_vec_cols(df, features))
    base = df.select(F.col(cluster).cast("string").alias("__c"), vec.alias("__x")) \
             .withColumn("__q", _dot(F.col("__x"), F.col("__x")))
    d = len(features)
    stats = base.groupBy("__c").agg(F.count(F.lit(1)).alias("n"), F.sum("__q").alias("q"),
                                    *[F.sum(F.col("__x")[i]).alias(f"s{i}") for i in range(d)])
    summary = stats.agg(F.collect_list(F.struct(F.col("__c").alias("c"), F.col("n").cast("double").alias("n"),
                                                F.col("q").alias("q"),
                                                F.array(*[F.col(f"s{i}") for i in range(d)]).alias("s")))
                        .alias("__k"))
    j = base.crossJoin(F.broadcast(summary))  # one row
    md = F.transform("__k", lambda k: F.struct(
        k["c"].alias("c"), k["n"].alias("n"),
        (F.col("__q") - 2 * _dot(F.col("__x"), k["s"]) / k["n"] + k["q"] / k["n"]).alias("m")))
    own = F.filter(md, lambda m: m["c"] == F.col("__c"))[0]
    others = F.transform(F.filter(md, lambda m: m["c"] != F.col("__c")), lambda m: m["m"])
    a = own["m"] * own["n"] / (own["n"] - 1)
    b = F.array_min(others)
    sil = F.when(own["n"] <= 1, F.lit(0.0)).otherwise((b - a) / F.greatest(a, b))
    res = j.select(sil.alias("__s"), F.size("__k").alias("__kk")).agg(
        F.avg(F.coalesce("__s", F.lit(0.0))).alias("__m"), F.max("__kk").alias("__kk"))
    return res.select(F.when(F.col("__kk") >= 2, F.col("__m")).alias("silhouette_sq"))


def davies_bouldin(df: DataFrame, features: list[str], cluster: str) -> DataFrame:
    """mean over clusters of max_{j != i} (s_i + s_j) / d(c_i, c_j): s = mean
    Euclidean distance of members to their centroid.  The pairwise step is over
    centroids (k x k), not points."""
    xs = _vec_cols(df, features)
    base = df.select(F.col(cluster).alias("c"), *[x.alias(f"x{i}") for i, x in enumerate(xs)])
    cent = base.groupBy("c").agg(*[F.avg(f"x{i}").alias(f"m{i}") for i in range(len(xs))])
    d = base.join(cent, "c")
    dist = F.sqrt(reduce(lambda a, b: a + b, [(F.col(f"x{i}") - F.col(f"m{i}")) ** 2 for i in range(len(xs))]))
    s = d.groupBy("c").agg(F.avg(dist).alias("s"))
    cs = cent.join(s, "c")
    o = cs.select(*[F.col(c).alias(c + "_o") for c in cs.columns])
    pairs = cs.join(o, F.col("c") != F.col("c_o"))  # centroid pairs only: k (k - 1)
    dc = F.sqrt(reduce(lambda a, b: a + b, [(F.col(f"m{i}") - F.col(f"m{i}_o")) ** 2 for i in range(len(xs))]))
    r = pairs.groupBy("c").agg(F.max((F.col("s") + F.col("s_o")) / dc).alias("r"))
    return r.agg(F.avg("r").alias("davies_bouldin"))


def pred_vs_actual(df: DataFrame, label: str, pred: str, id_col: str, n: int = 500) -> tuple[DataFrame, DataFrame]:
    """Up to ``n`` (actual, predicted) pairs (seeded, hash order) and the 1:1 line bounds."""
    from crease.operators.prepare import cap_sample
    pts = cap_sample(df.select(id_col, label, pred), id_col, n)
    bounds = df.agg(F.least(F.min(label), F.min(pred)).alias("lo"), F.greatest(F.max(label), F.max(pred)).alias("hi"))
    return pts, bounds
