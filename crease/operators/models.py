"""Distributed model fitting, scoring, tuning and explanation (L- and E8-E15).

Every estimator is a Spark ML ``Pipeline`` (assembler -> optional scaler ->
model), so fitting is distributed over the rows and scoring is a
``transform``.  Loops that the reference runs (folds, grids, boosting rounds,
sizes, depths) are driver loops over Spark jobs on a cached, lineage-cut
training table; none of them collects data to the driver.

Parameter conversions from the reference's estimators:
* ridge and lasso are solved from one pass of sums (``crease.operators.linear``)
* logistic C   -> regParam = 1 / (n C),  standardised input
* boosted trees are ``boost.Spec`` models (``crease.operators.boost``)
"""

from __future__ import annotations

import math
import random
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import DecisionTreeClassifier, LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crease.operators.boost import BINS, IN_TASK, TREES, Boosted, Spec, boost
from crease.operators.linear import LinearFit, Penalised, fold_moments, merge, solve
from crease.operators.prepare import kfold_assign, portable_hash

SEED = 42
# Algorithms that get standardised input (as in the reference's pipeline).
SCALED = {"logistic", "knn", "svm_rbf", "ridge_cv", "lasso_cv"}
# Deep forests: keep each row's node id between levels (no re-walk of the
# trees per level; checkpointed every 10 levels) and grow more nodes per pass.
DEEP = {"cacheNodeIds": True, "maxMemoryInMB": 1024}


def _count(df: DataFrame) -> int:
    return df.count()


# The algorithms compared and their settings.
def regressors(n: int) -> dict:
    """The regression set."""
    return {
        # beside a constant column Spark iterates over the sums: to the end, not to 1e-6
        "linear": LinearRegression(regParam=0.0, solver="normal", tol=1e-12),
        "ridge": Penalised("ridge", 1.0),
        "lasso": Penalised("lasso", 0.1),
        "dt": DecisionTreeRegressor(maxDepth=8, maxBins=64, seed=SEED),
        "rf": RandomForestRegressor(numTrees=100, maxDepth=10, seed=SEED, **DEEP),
        "gb": Spec(rounds=100, depth=3, rate=0.1, loss="squared", second=False),
        "xgb": Spec(rounds=300, depth=6, rate=0.05, rows=0.8, columns=0.8, loss="squared"),
        "ada": "adaboost_r2",
    }


def classifiers(n: int) -> dict:
    """The classifier set (fixed values, as above)."""
    return {
        "logistic": LogisticRegression(maxIter=1000, regParam=1.0 / max(n, 1), elasticNetParam=0.0,
                                       standardization=False),
        "nb": "gaussian_nb",
        "dt": DecisionTreeClassifier(maxDepth=5, minInstancesPerNode=10, impurity="gini", seed=SEED),
        "bag": RandomForestClassifier(numTrees=200, featureSubsetStrategy="all", maxDepth=30, seed=SEED, **DEEP),
        "rf": RandomForestClassifier(numTrees=200, maxDepth=10, minInstancesPerNode=1, seed=SEED, **DEEP),
        "gb": Spec(rounds=200, depth=4, rate=0.05, l2=0.0, least=1e-3),
        "xgb": Spec(rounds=300, depth=6, rate=0.05, rows=0.8, columns=0.8),
    }


def assemble(features: list[str], scale: bool = False) -> list:
    stages = [VectorAssembler(inputCols=features, outputCol="features_raw" if scale else "features",
                              handleInvalid="keep")]
    if scale:
        # population std like the reference's scaler: withStd uses n-1; the
        # difference is a constant factor sqrt(n/(n-1)) absorbed by the model
        stages.append(StandardScaler(inputCol="features_raw", outputCol="features", withMean=True, withStd=True))
    return stages


def fit_pipeline(train: DataFrame, features: list[str], label: str, estimator, scale: bool = False):
    """A fitted pipeline, a ``boost.Boosted`` model of a ``boost.Spec``, or a
    ``linear.LinearFit`` of a ``linear.Penalised``."""
    if isinstance(estimator, Penalised):
        return solve(merge(list(fold_moments(train, features, label).values())), features, estimator.kind, estimator.alpha)
    if isinstance(estimator, Spec):
        return boost(train, features, label, [estimator])[0][0]
    est = estimator.copy() if hasattr(estimator, "copy") else estimator
    est = est.setFeaturesCol("features").setLabelCol(label)
    pipe = Pipeline(stages=assemble(features, scale) + [est])
    if (spec := _forest_spec(est, train, features, label)) is not None:
        return boost(train, features, label, [spec], bins=min(BINS, est.getMaxBins() + 1))[0][0]
    groups = _forest_groups(est, train) if isinstance(est, (RandomForestClassifier, RandomForestRegressor)) else []
    if len(groups) < 2:
        return pipe.fit(train)
    return Forest([pipe.fit(train, {est.numTrees: size, est.seed: est.getSeed() + k, est.cacheNodeIds: False,
                                    est.maxMemoryInMB: min(est.getMaxMemoryInMB(), 256)}) for k, size in enumerate(groups)], groups)


#: Drawn rows (rows x trees) of one forest fit.  Spark holds how often each tree drew each row
#: (4 bytes) while it fits, so more trees than this are fitted in groups, one after the other.
FOREST_DRAWS = 200_000_000
#: Drawn rows from which on a forest's trees grow in tasks.  Spark fits smaller forests.
TASK_DRAWS = 20_000_000


def _forest_spec(est, train: DataFrame, features: list[str], label: str) -> Spec | None:
    """The forest of an estimator as one whose trees grow side by side, each in a task that
    holds the binned rows; none where these are few or too many, or for other labels than 0 and 1."""
    kinds = {RandomForestClassifier: ("gini", "sqrt", "share"), RandomForestRegressor: ("variance", "onethird", "mean")}
    if type(est) not in kinds:
        return None
    impurity, auto, loss = kinds[type(est)]
    own = [est.getImpurity(), est.getSubsamplingRate(), est.getBootstrap(), est.getMinInfoGain(), est.getMinWeightFractionPerNode()]
    if own != [impurity, 1.0, True, 0.0, 0.0] or est.isSet("weightCol") or len(features) != len(set(features)):
        return None
    y = F.col(label).cast("double")
    numbers = F.array(y, *[F.col(c).cast("double") for c in features])
    odd = F.exists(numbers, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))  # which Spark's forest refuses
    n, most, other, refused = train.agg(F.count(F.lit(1)), F.max(y), F.count_if(~y.isin(0.0, 1.0)), F.count_if(odd)).first()
    draws = n * est.getNumTrees()
    if refused or not 0 < n <= IN_TASK * TREES or not TASK_DRAWS <= draws <= 2 * FOREST_DRAWS or loss == "share" and (other or most != 1.0):
        return None
    kept = est.getFeatureSubsetStrategy()
    kept = ("all" if est.getNumTrees() == 1 else auto) if kept == "auto" else kept
    shares = {"all": 1.0, "sqrt": math.ceil(math.sqrt(len(features))) / len(features), "onethird": 1 / 3}
    if kept not in shares:
        return None
    return Spec(rounds=est.getNumTrees(), depth=est.getMaxDepth(), columns=shares[kept], loss=loss, l2=0.0,
                least=float(est.getMinInstancesPerNode()), seed=est.getSeed())


def _forest_groups(est, train: DataFrame) -> list[int]:
    """Trees of every group of a forest: one group where all their draws may be held at once."""
    trees = est.getNumTrees()
    size = max(1, min(trees, FOREST_DRAWS // max(1, train.count())))
    return [min(size, trees - at) for at in range(0, trees, size)]


class Forest:
    """A forest of fitted parts, each with some of its trees; what it predicts is the mean
    of all trees: of their values, or of their class shares."""

    def __init__(self, parts: list[PipelineModel], trees: list[int]):
        self.parts, self.trees = parts, trees

    @property
    def importances(self) -> list[float]:
        """Mean of the parts' importances, weighed by their trees."""
        sums = sum(p.stages[-1].featureImportances.toArray() * t for p, t in zip(self.parts, self.trees))
        return [float(v) for v in sums / sum(self.trees)]

    def transform(self, df: DataFrame) -> DataFrame:
        cur, shares, names = df, [], [f"__f{i}" for i in range(len(self.parts))]
        classes = hasattr(self.parts[0].stages[-1], "numClasses")
        for name, part, size in zip(names, self.parts, self.trees):
            scored = part.transform(cur)
            held = F.transform(vector_to_array("probability"), lambda p: p * (size / sum(self.trees))) if classes \
                else F.col("prediction") * (size / sum(self.trees))
            cur = scored.select(*cur.columns, held.alias(name))
        if not classes:
            return cur.select(*df.columns, reduce(lambda a, b: a + b, map(F.col, names)).alias("prediction"))
        total = reduce(lambda a, b: F.zip_with(a, b, lambda x, y: x + y), map(F.col, names))
        out = cur.select(*df.columns, total.alias("probability"))
        return out.withColumn("prediction", (F.array_position("probability", F.array_max("probability")) - 1).cast("double"))


# ---------------------------------------------------------------------------
# Gaussian naive Bayes (L8): class priors, means and variances are one
# aggregate; scoring is a column expression.
# ---------------------------------------------------------------------------

class GaussianNBModel:
    def __init__(self, stats: DataFrame, features: list[str], label: str, var_smoothing: float = 1e-9):
        self.stats, self.features, self.label, self.eps = stats, features, label, var_smoothing

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds prediction (arg-max class) and probability of each class (long form is
        avoided: one array column ``class_log_joint``)."""
        rows = self.stats.collect()  # one row per class: bounded by the number of classes
        eps = self.eps * max([r["__maxvar"] for r in rows] + [0.0])
        scores = []
        for r in rows:
            s = F.lit(math.log(r["__prior"]))
            for c in self.features:
                m, v = r[f"{c}__m"], (r[f"{c}__v"] or 0.0) + eps
                s = s - 0.5 * math.log(2 * math.pi * v) - (F.col(c).cast("double") - m) ** 2 / (2 * v)
            scores.append(F.struct(s.alias("ll"), F.lit(r[self.label]).alias("cls")))
        best = F.array_max(F.array(*scores))
        return df.withColumn("prediction", best["cls"].cast("double"))


def gaussian_nb(train: DataFrame, features: list[str], label: str) -> GaussianNBModel:
    n = F.count(F.lit(1))
    stats = train.groupBy(label).agg(
        n.alias("__n"), *[F.avg(F.col(c).cast("double")).alias(f"{c}__m") for c in features],
        *[F.var_pop(F.col(c).cast("double")).alias(f"{c}__v") for c in features])
    total = stats.agg(F.sum("__n").alias("__t"))
    mv = train.agg(F.greatest(*[F.var_pop(F.col(c).cast("double")) for c in features]).alias("__maxvar")) \
        if len(features) > 1 else train.agg(F.var_pop(F.col(features[0]).cast("double")).alias("__maxvar"))
    stats = stats.crossJoin(total).crossJoin(mv).withColumn("__prior", F.col("__n") / F.col("__t"))
    return GaussianNBModel(stats, features, label)


# ---------------------------------------------------------------------------
# RBF-kernel SVM (L7), approximated with random Fourier features
# (Rahimi & Recht, 2007): z(x) = sqrt(2/D) cos(w.x + b), w ~ N(0, 2 gamma I).
# The features are column expressions; a linear SVM is fitted on them and the
# margin is turned into a probability by a one-feature logistic fit.
# ---------------------------------------------------------------------------

def rff_weights(d: int, n_components: int = 100, gamma: float | None = None, seed: int = SEED):
    """Random Fourier feature parameters: w_j ~ N(0, 2 gamma I), b_j ~ U(0, 2 pi)."""
    gamma = gamma if gamma is not None else 1.0 / d
    rnd = random.Random(seed)
    ws = [[rnd.gauss(0.0, math.sqrt(2 * gamma)) for _ in range(d)] for _ in range(n_components)]
    bs = [rnd.uniform(0, 2 * math.pi) for _ in range(n_components)]
    return ws, bs


def rff_map(x: Column, ws: list[list[float]], bs: list[float]) -> Column:
    """z(x) = sqrt(2/D) cos(W x + b) as one array expression (JVM higher-order
    functions over a literal D x d matrix), instead of D wide column trees."""
    D = len(ws)
    w = F.array(*[F.array(*[F.lit(float(v)) for v in row]) for row in ws])
    b = F.array(*[F.lit(float(v)) for v in bs])
    dots = F.transform(w, lambda row: F.aggregate(F.zip_with(row, x, lambda p, q: p * q), F.lit(0.0),
                                                  lambda acc, t: acc + t))
    return F.zip_with(dots, b, lambda u, v: F.lit(math.sqrt(2.0 / D)) * F.cos(u + v))


class RbfSvmModel:
    def __init__(self, scaler_model, ws, bs, svm_model, platt_model):
        self.scaler_model, self.ws, self.bs, self.svm, self.platt = scaler_model, ws, bs, svm_model, platt_model

    def features(self, df: DataFrame) -> DataFrame:
        from pyspark.ml.functions import array_to_vector
        scaled = self.scaler_model.transform(df)
        z = rff_map(vector_to_array("features"), self.ws, self.bs)
        return scaled.withColumn("features", array_to_vector(z)).drop("features_raw")

    def transform(self, df: DataFrame) -> DataFrame:
        s = self.svm.transform(self.features(df)).withColumn("margin", vector_to_array("rawPrediction")[1])
        s = s.drop("prediction", "rawPrediction")
        m = VectorAssembler(inputCols=["margin"], outputCol="__m").transform(s).drop("features") \
            .withColumnRenamed("__m", "features")
        return self.platt.transform(m)


def svm_rbf(train: DataFrame, features: list[str], label: str, n_components: int = 100,
            c: float = 1.0, gamma: float | None = None) -> RbfSvmModel:
    """Linear SVM on random Fourier features of the standardised input, with a
    logistic (Platt) fit on the margin for probabilities.  ``c`` weighs the loss
    of all rows, Spark's regParam the mean loss: regParam = 1 / (c n)."""
    reg = 1.0 / (c * max(1, train.count()))
    scaler_model = Pipeline(stages=assemble(features, scale=True)).fit(train)
    ws, bs = rff_weights(len(features), n_components, gamma)
    model = RbfSvmModel(scaler_model, ws, bs, None, None)
    z = model.features(train).cache()
    model.svm = LinearSVC(featuresCol="features", labelCol=label, regParam=reg, maxIter=100).fit(z)
    m = model.svm.transform(z).withColumn("margin", vector_to_array("rawPrediction")[1])
    m = VectorAssembler(inputCols=["margin"], outputCol="__m").transform(m.drop("prediction", "rawPrediction")) \
        .drop("features").withColumnRenamed("__m", "features")
    model.platt = LogisticRegression(featuresCol="features", labelCol=label).fit(m)
    z.unpersist()
    return model


# ---------------------------------------------------------------------------
# AdaBoost (L14): SAMME with decision stumps, weights updated by DataFrame
# expressions; lineage is cut every few rounds with checkpoint().
# ---------------------------------------------------------------------------

class AdaBoostModel:
    def __init__(self, stumps: list, alphas: list[float], features: list[str], classes: list[float]):
        self.stumps, self.alphas, self.features, self.classes = stumps, alphas, features, classes

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with the class of most votes: every stump is one comparison, so
        all of them are one expression per class, not a stage each."""
        votes = [reduce(lambda a, b: a + b, [F.when(_stump(s, self.features) == F.lit(float(c)), F.lit(w)).otherwise(F.lit(0.0))
                                             for s, w in zip(self.stumps, self.alphas)], F.lit(0.0)) for c in self.classes]
        cur = df.withColumn("__votes", F.array(*votes))
        best = F.array_position("__votes", F.array_max("__votes"))
        return cur.withColumn("prediction", F.element_at(F.array(*[F.lit(float(c)) for c in self.classes]), best.cast("int")))


def _stump(model, features: list[str]) -> Column:
    """Prediction of a tree of one split, as an expression."""
    root = model._call_java("rootNode")
    if model.numNodes == 1:
        return F.lit(float(root.prediction()))
    split, left, right = root.split(), float(root.leftChild().prediction()), float(root.rightChild().prediction())
    x = F.col(features[split.featureIndex()]).cast("double")
    return F.when(x <= float(split.threshold()), F.lit(left)).otherwise(F.lit(right))


def adaboost(train: DataFrame, features: list[str], label: str, n_estimators: int = 100,
             learning_rate: float = 0.1, checkpoint_every: int = 10) -> AdaBoostModel:
    """One stump fit per round.  The weighted error comes from the class weights in the
    stump's leaves, without a pass.  Weights sum to 1, so the new total is (1 - err) +
    err * exp(alpha).  Each round's table (features, label and weight only) is cached
    (the stump fit reads it several times) and written to the checkpoint folder every
    ``checkpoint_every`` rounds."""
    from crease.session import checkpoint_dir
    checkpoint_dir(train.sparkSession)
    counts = train.groupBy(F.col(label).cast("double")).count().collect()  # class labels
    classes = sorted(r[0] for r in counts)
    K, n = len(classes), sum(r[1] for r in counts)
    # the number of classes in the label's metadata spares each fit a pass for it
    known = {"ml_attr": {"type": "nominal", "num_vals": int(max(classes)) + 1}} if classes else {}
    va = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep")
    cur = va.transform(train).select("features", F.col(label).cast("double").alias("__y", metadata=known), F.lit(1.0 / n).alias("__w")).checkpoint()
    stumps, alphas, cached, stale = [], [], None, None
    for m in range(n_estimators):
        stump = DecisionTreeClassifier(maxDepth=1, labelCol="__y", featuresCol="features", weightCol="__w",
                                       seed=SEED).fit(cur)
        if stale is not None:  # the fit above materialised ``cur``; its parent's cache can go
            stale.unpersist()
            stale = None
        wrong, whole = _leaf_weights(stump._call_java("rootNode"))
        err = wrong / (whole or 1.0)
        if err >= 1.0 - 1.0 / K:
            break
        alpha = learning_rate * (math.log((1 - err) / max(err, 1e-12)) + math.log(K - 1))
        stumps.append(stump)
        alphas.append(alpha)
        if err <= 0 or m == n_estimators - 1:
            break
        tot = (1.0 - err) + err * math.exp(alpha)  # new total / old total
        nxt = stump.transform(cur).select(
            "features", "__y", (F.when(F.col("prediction") != F.col("__y"), F.col("__w") * math.exp(alpha)).otherwise(F.col("__w"))
                                / F.lit(tot * whole)).alias("__w"))
        if (m + 1) % checkpoint_every == 0:
            nxt = nxt.checkpoint()  # materialised now: the parent's cache is no longer read
            if cached is not None:
                cached.unpersist()
            cached = None
        else:
            nxt = nxt.cache()
            stale, cached = cached, nxt
        cur = nxt
    for c in (stale, cached):
        if c is not None:
            c.unpersist()
    return AdaBoostModel(stumps, alphas, features, classes)


def _leaf_weights(node) -> tuple[float, float]:
    """Weights of the rows that a fitted tree gets wrong, and of all rows."""
    if node.subtreeDepth() == 0:
        held = [float(w) for w in node.impurityStats().stats()]
        return sum(held) - held[int(node.prediction())], sum(held)
    left, right = _leaf_weights(node.leftChild()), _leaf_weights(node.rightChild())
    return left[0] + right[0], left[1] + right[1]


def _tree_value(node, features: list[str]) -> Column:
    """Prediction of a small fitted tree, as an expression."""
    if node.subtreeDepth() == 0:
        return F.lit(float(node.prediction()))
    split = node.split()
    x = F.col(features[split.featureIndex()]).cast("double")
    return F.when(x <= float(split.threshold()), _tree_value(node.leftChild(), features)).otherwise(_tree_value(node.rightChild(), features))


class AdaBoostRegressor:
    """Stages of AdaBoost.R2; a prediction is the weighted median of theirs."""

    def __init__(self, stages: list, features: list[str]):
        self.stages, self.features = stages, features

    def transform(self, df: DataFrame) -> DataFrame:
        values = F.array_sort(F.array(*[F.struct(_tree_value(node, self.features).alias("v"), F.lit(w).alias("w")) for node, w in self.stages]))
        half = F.lit(0.5 * sum(w for _, w in self.stages))
        start = F.struct(F.lit(0.0).alias("s"), F.lit(None).cast("double").alias("v"))
        at = F.aggregate(values, start, lambda a, x: F.struct((a["s"] + x["w"]).alias("s"), F.when(
            a["v"].isNull() & (a["s"] + x["w"] >= half), x["v"]).otherwise(a["v"]).alias("v")))
        return df.withColumn("prediction", at["v"])


def adaboost_r2(train: DataFrame, features: list[str], label: str, n_estimators: int = 50, learning_rate: float = 1.0,
                depth: int = 3, checkpoint_every: int = 10) -> AdaBoostRegressor:
    """AdaBoost.R2 with linear loss: each round fits a tree of ``depth`` on the weighted
    rows, measures every row's error as a share of the largest, and weakens the rows
    that the tree gets right.  Two passes a round (fit, errors); rows without label
    take no part.  The weights stand in place of drawing rows by them."""
    from crease.session import checkpoint_dir
    checkpoint_dir(train.sparkSession)
    rows = train.filter(F.col(label).isNotNull())
    va = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep")
    cur = va.transform(rows.select(*dict.fromkeys([*features, label]))).withColumn("__w", F.lit(1.0)).checkpoint()
    stages = []
    for turn in range(n_estimators):
        tree = DecisionTreeRegressor(maxDepth=depth, maxBins=64, labelCol=label, featuresCol="features", weightCol="__w", seed=SEED).fit(cur)
        node = tree._call_java("rootNode")
        miss = cur.withColumn("__e", F.abs(_tree_value(node, features) - F.col(label).cast("double")))
        worst, total, lost = miss.agg(F.max("__e"), F.sum("__w"), F.sum(F.col("__w") * F.col("__e"))).first()
        if not worst:  # a perfect stage ends the rounds
            stages.append((node, 1.0))
            break
        error = lost / worst / total
        if error >= 0.5:
            if not stages:
                stages.append((node, 1.0))
            break
        beta = error / (1.0 - error)
        stages.append((node, learning_rate * math.log(1.0 / beta)))
        power = (1.0 - F.col("__e") / worst) * learning_rate
        cur = miss.withColumn("__w", F.col("__w") / total * F.pow(F.lit(beta), power)).drop("__e")
        cur = cur.checkpoint() if (turn + 1) % checkpoint_every == 0 else cur
    return AdaBoostRegressor(stages, features)


# ---------------------------------------------------------------------------
# Stacking (L15): out-of-fold probabilities of the base models feed a boosted
# meta model; bases are refitted on all rows for scoring.
# ---------------------------------------------------------------------------

class StackingModel:
    def __init__(self, bases: dict, meta, classes: int):
        self.bases, self.meta, self.classes = bases, meta, classes

    def transform(self, df: DataFrame) -> DataFrame:
        return self.meta.transform(_with_base(df, self.bases, self.classes))


def _base_columns(bases, classes: int) -> list[str]:
    return [f"__p_{name}_{k}" for name in bases for k in range(1, classes)]


def _with_base(df: DataFrame, models: dict, classes: int) -> DataFrame:
    """``df`` with every base model's probabilities of the classes 1.."""
    for name, m in models.items():
        scored = m.transform(df)
        p = _probabilities(scored)
        df = scored.select(*df.columns, *[F.coalesce(F.get(p, F.lit(k)), F.lit(0.0)).alias(f"__p_{name}_{k}") for k in range(1, classes)])
    return df


def stacking(train: DataFrame, features: list[str], label: str, id_col: str, folds: int = 5) -> StackingModel:
    """Logistic regression, a forest and boosted trees under a boosted meta model,
    for labels 0..; folds are stratified by the label.  Out-of-fold probabilities are
    written once (checkpoint) before the meta model reads them.  The folds' fits
    are independent jobs; the boosted ones grow together."""
    from crease.session import checkpoint_dir
    checkpoint_dir(train.sparkSession)
    n, top = train.agg(F.count(F.lit(1)), F.max(label)).first()
    classes = max(2, int(top or 0) + 1)
    many = {"loss": "softmax", "classes": classes} if classes > 2 else {}
    spark_bases = {"lr": (LogisticRegression(maxIter=1000, regParam=1.0 / max(n, 1)), True),
                   "rf": (RandomForestClassifier(numTrees=200, maxDepth=10, seed=SEED, **DEEP), False)}
    f = kfold_assign(train, id_col, folds, label=label).checkpoint()

    def fit(task):
        k, name = task
        est, scale = spark_bases[name]
        return fit_pipeline(f if k is None else f.filter(F.col("fold") != k), features, label, est, scale)

    tasks = [(k, name) for k in [*range(folds), None] for name in spark_bases]
    models = dict(zip(tasks, _at_once(fit, tasks)))
    specs = [Spec(rounds=200, depth=4, rate=0.05, l2=0.0, least=1e-3, fold=k, **many) for k in [*range(folds), None]]
    models |= {(s.fold, "gb"): m for s, m in zip(specs, boost(f, features, label, specs, id_col, "fold")[0])}
    bases = [*spark_bases, "gb"]
    meta_in = reduce(DataFrame.unionByName, [
        _with_base(f.filter(F.col("fold") == k), {name: models[k, name] for name in bases}, classes) for k in range(folds)]).checkpoint()
    meta = boost(meta_in, _base_columns(bases, classes), label, [Spec(rounds=100, depth=3, rate=0.1, l2=0.0, least=1e-3, **many)], id_col)[0][0]
    return StackingModel({name: models[None, name] for name in bases}, meta, classes)


# ---------------------------------------------------------------------------
# L16 fit many / L20 batch scoring / L22 persistence / L23 coefficients
# ---------------------------------------------------------------------------

def _probabilities(df: DataFrame, col: str = "probability") -> Column:
    """Probabilities as an array, whether a vector or an array holds them."""
    return F.col(col) if df.schema[col].dataType.typeName() == "array" else vector_to_array(col)


def _metrics_row(spark, name, pred: DataFrame, label: str, kind: str, n_features: int = 1) -> DataFrame:
    from crease.operators.evaluate import binary_metrics, regression_metrics, roc_auc
    if kind == "regression":
        m = regression_metrics(pred, label, "prediction", n_features)
        return m.select(F.lit(name).alias("model"), "mae", "mse", "rmse", "r2", "adj_r2")
    if kind == "multiclass":
        return _multiclass_row(name, pred, label)
    pred = pred.withColumn("__y", F.col(label).cast("double"))
    m = binary_metrics(pred, "__y", "prediction", positive=1.0)
    auc = roc_auc(pred.withColumn("__p", _probabilities(pred)[1]), "__y", "__p", positive=1.0).select("auc") \
        if "probability" in pred.columns else spark.range(1).select(F.lit(None).cast("double").alias("auc"))
    return m.crossJoin(auc).select(F.lit(name).alias("model"), "accuracy", "precision", "recall", "f1", "auc")  # single rows


def _multiclass_row(name: str, pred: DataFrame, label: str) -> DataFrame:
    """Accuracy, macro precision / recall / F1 and one-vs-rest AUC over the classes of ``label``."""
    from crease.operators.evaluate import macro_metrics, roc_auc_ovr
    scored = pred.withColumn("__y", F.col(label).cast("double")).withColumn("__p", _probabilities(
        pred, "probability" if "probability" in pred.columns else "rawPrediction"))
    size = scored.select(F.size("__p").alias("n")).first()["n"]  # classes of the model
    scored = scored.select("__y", F.col("prediction").cast("double").alias("prediction"),
                           *[F.col("__p")[i].alias(f"__p{i}") for i in range(size)]).checkpoint()
    seen = sorted(r[0] for r in scored.select("__y").distinct().collect() if r[0] is not None and r[0] < size)
    acc = scored.agg(F.count(F.lit(1)).alias("n"), F.avg((F.col("__y") == F.col("prediction")).cast("double")).alias("accuracy"))
    auc = roc_auc_ovr(scored, "__y", {c: f"__p{int(c)}" for c in seen})
    return acc.crossJoin(macro_metrics(scored, "__y", "prediction")).crossJoin(auc).select(  # single rows
        F.lit(name).alias("model"), "n", "accuracy", "macro_precision", "macro_recall", "macro_f1", F.col("macro_auc"))


def multiclass_classifiers(n: int, classes: int) -> dict:
    """Classifiers of more than two classes (labels 0..classes-1)."""
    pool = {k: v for k, v in classifiers(n).items() if k in ("logistic", "dt", "rf")}
    return pool | {"gb": Spec(rounds=100, depth=3, rate=0.1, l2=0.0, least=1e-3, loss="softmax", classes=classes),
                   "xgb": Spec(rounds=100, depth=6, rate=0.3, loss="softmax", classes=classes)}


def fit_many_compare(train: DataFrame, test: DataFrame, features: list[str], label: str, kind: str,
                     names: list[str] | None = None) -> tuple[DataFrame, dict]:
    """Fit the selected algorithms on one split; metrics table (one row per model,
    ``best`` marking the largest R2, F1 or macro F1) and the fitted models.  The
    split is cached for the fits.  ``kind``: regression, classification (labels 0
    and 1) or multiclass (labels 0..)."""
    n = train.count()
    if kind == "multiclass":
        pool = multiclass_classifiers(n, int(train.agg(F.max(label)).first()[0] or 0) + 1)
    else:
        pool = regressors(n) if kind == "regression" else classifiers(n)
    names = names or list(pool)
    train = train.cache()
    fitted, rows = {}, []
    for name in names:
        est = pool[name]
        if est == "gaussian_nb":
            model = gaussian_nb(train, features, label)
        elif est == "adaboost_r2":
            model = adaboost_r2(train, features, label)
        else:
            model = fit_pipeline(train, features, label, est, scale=name in SCALED)
        fitted[name] = model
        rows.append(_metrics_row(train.sparkSession, name, model.transform(test), label, kind, len(features)))
    table = reduce(DataFrame.unionByName, rows).checkpoint()  # one row per model
    train.unpersist()
    score = {"regression": "r2", "multiclass": "macro_f1"}.get(kind, "f1")
    top = table.agg(F.max_by("model", F.struct(score, "model")).alias("__top"))
    return table.crossJoin(top).withColumn("best", F.col("model") == F.col("__top")).drop("__top"), fitted


def batch_score(models: dict, df: DataFrame, keep: list[str], labels: list[str] | None = None) -> DataFrame:
    """Score a table of cases with every model; long form (model, keys..., prediction,
    probability of class 1 where the model has one).  With ``labels``, the names of
    the classes 0.., the predicted class's name (``label``) and the probabilities of
    all classes (``probabilities``; null where the model has none) come along."""
    parts = []
    for name, m in models.items():
        p = m.transform(df)
        known = _probabilities(p) if "probability" in p.columns else F.lit(None).cast("array<double>")
        more = [F.get(F.array(*map(F.lit, labels)), F.col("prediction").cast("int")).alias("label"), known.alias("probabilities")] if labels else []
        parts.append(p.select(F.lit(name).alias("model"), *keep, F.col("prediction").cast("double").alias("prediction"),
                              F.get(known, F.lit(1)).alias("probability"), *more))
    return reduce(DataFrame.unionByName, parts)


def model_persist(model: PipelineModel, path: str) -> PipelineModel:
    """Save (overwrite) and load back a fitted pipeline."""
    model.write().overwrite().save(path)
    return PipelineModel.load(path)


def coefficients(model: PipelineModel | LinearFit, features: list[str]) -> DataFrame:
    """(feature, coefficient) of the final linear stage plus the intercept."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    if isinstance(model, LinearFit):
        rows = [*zip(features, map(float, model.weights)), ("(intercept)", model.intercept)]
        return spark.createDataFrame(rows, "feature string, coefficient double")
    lm = model.stages[-1]
    rows = [(f, float(c)) for f, c in zip(features, lm.coefficients.toArray())] + [("(intercept)", float(lm.intercept))]
    return spark.createDataFrame(rows, "feature string, coefficient double")


# ---------------------------------------------------------------------------
# Cross validation, grid / random search, learning curve, depth sweep
# ---------------------------------------------------------------------------

def _evaluator(kind: str, label: str, metric: str | None = None):
    if kind == "regression":
        return RegressionEvaluator(labelCol=label, metricName=metric or "mae")
    return MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy")


# Fits of a loop that run at the same time (each is a Spark job of its own).
PARALLEL_FITS = 4


def _at_once(fn, tasks: list) -> list:
    """``fn`` of every task, in order, several jobs at a time."""
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=PARALLEL_FITS) as pool:
        return list(pool.map(fn, tasks))


def cross_validate(df: DataFrame, features: list[str], label: str, estimator, id_col: str, folds: int = 5,
                   kind: str = "classification", scale: bool = False, stratified: bool = True) -> DataFrame:
    """Per-fold validation score plus mean and std (population) rows."""
    f = kfold_assign(df, id_col, folds, label=label if (stratified and kind == "classification") else None).cache()
    ev = _evaluator(kind, label)

    def score(k: int) -> tuple[int, float]:
        m = fit_pipeline(f.filter(F.col("fold") != k), features, label, estimator, scale)
        return k, float(ev.evaluate(m.transform(f.filter(F.col("fold") == k))))

    rows = _at_once(score, list(range(folds)))
    f.unpersist()
    spark = df.sparkSession
    scores = spark.createDataFrame(rows, "fold int, score double")
    return scores.unionByName(scores.agg(F.lit(-1).alias("fold"), F.avg("score").alias("score"))) \
                 .unionByName(scores.agg(F.lit(-2).alias("fold"), F.stddev_pop("score").alias("score")))


def grid_search(df: DataFrame, features: list[str], label: str, estimator, grid: dict, id_col: str,
                folds: int = 5, kind: str = "classification", scale: bool = False, parallelism: int = 4,
                sample: int | None = None, seed: int = SEED, metric: str | None = None) -> DataFrame:
    """k-fold cross validation over a parameter grid (or a seeded sample of ``sample``
    points of it: random search), with folds stratified by a class label.
    Returns (params, mean score) per point."""
    est = estimator.copy().setFeaturesCol("features").setLabelCol(label)
    b = ParamGridBuilder()
    for p, values in grid.items():
        b = b.addGrid(est.getParam(p), values)
    maps = b.build()
    if sample is not None and sample < len(maps):
        maps = random.Random(seed).sample(maps, sample)
    from concurrent.futures import ThreadPoolExecutor

    from crease.session import checkpoint_dir
    checkpoint_dir(df.sparkSession)
    f = kfold_assign(df, id_col, folds, label=label if kind == "classification" else None).checkpoint()
    pipe = Pipeline(stages=assemble(features, scale) + [est])
    pmaps = [{est.getParam(k.name): v for k, v in m.items()} for m in maps]
    ev = _evaluator(kind, label, metric)

    # what CrossValidator computes (mean over folds of the validation metric), with
    # every (fold, point) fit an independent job, not only the points of one fold
    def score(task):
        k, i = task
        m = pipe.fit(f.filter(F.col("fold") != k), pmaps[i])
        return float(ev.evaluate(m.transform(f.filter(F.col("fold") == k))))

    tasks = [(k, i) for k in range(folds) for i in range(len(pmaps))]
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        scores = dict(zip(tasks, pool.map(score, tasks)))
    rows = [(", ".join(f"{k.name}={v}" for k, v in m.items()), sum(scores[(k, i)] for k in range(folds)) / folds)
            for i, m in enumerate(maps)]
    return df.sparkSession.createDataFrame(rows, "params string, mean_score double")


def boosted_search(df: DataFrame, features: list[str], label: str, grid: dict[str, list], id_col: str, folds: int = 5,
                   sample: int | None = None, seed: int = SEED, **fixed) -> DataFrame:
    """k-fold cross validation of boosted trees over a grid of ``boost.Spec`` fields
    (or a seeded sample of ``sample`` points), folds stratified by the label: (its
    fields, mean_score, best).  All folds and points grow together."""
    from itertools import product

    from crease.operators.boost import Spec, boost
    points = [dict(zip(grid, values)) for values in product(*grid.values())]
    if sample is not None and sample < len(points):
        points = random.Random(seed).sample(points, sample)
    f = kfold_assign(df, id_col, folds, label=label)
    specs = [Spec(**p, **fixed, fold=k) for p in points for k in range(folds)]
    _, scores = boost(f, features, label, specs, id_col, "fold", keep_trees=False)
    rows = [(*p.values(), sum(scores[i * folds:(i + 1) * folds]) / folds) for i, p in enumerate(points)]
    top = max(range(len(rows)), key=lambda i: (rows[i][-1], -i))
    names = [f"{name} {'int' if isinstance(grid[name][0], int) else 'double'}" for name in grid]
    return df.sparkSession.createDataFrame([(*r, i == top) for i, r in enumerate(rows)],
                                           ", ".join(names) + ", mean_score double, best boolean")


# The grids of the five classifiers.
CLASSIFIER_GRIDS = {
    "lr": {"C": [0.1, 1.0, 10.0, 100.0]},
    "knn": {"n_neighbors": [3, 5, 7, 9, 11, 13, 15]},
    "svm": {"C": [0.1, 1.0, 10.0, 100.0], "gamma": ["scale", "auto"]},
    "dt": {"max_depth": [3, 5, 7, 10, None], "criterion": ["gini", "entropy"]},
    "rf": {"n_estimators": [100, 200], "max_depth": [5, 10, None]},
}
#: Depth of a tree without a limit (Spark's largest).
DEEPEST = 30


def search_classifiers(df: DataFrame, features: list[str], label: str, id_col: str, folds: int = 5,
                       grids: dict | None = None) -> DataFrame:
    """Grid search of logistic regression, k-NN, SVM, tree and forest on labels 0 and
    1: (estimator, params, mean_score, best), the mean accuracy over stratified folds;
    ``best`` marks every estimator's best point (ties: the first).

    Logistic regression, k-NN and SVM see standardised features (of the whole table,
    as the reference scales before it searches).  All points of the forest grow
    together; one neighbour search per fold serves every number of neighbours.
    """
    from itertools import product

    from crease.operators.cluster import knn_neighbours
    from crease.operators.prepare import scale_standard
    from crease.session import checkpoint_dir
    checkpoint_dir(df.sparkSession)
    grids = grids or CLASSIFIER_GRIDS
    rows = df.filter(F.col(label).isNotNull()).select(id_col, F.col(label).cast("double").alias(label), *[F.col(c).cast("double").alias(c) for c in features])
    f = kfold_assign(rows, id_col, folds, label=label).checkpoint()
    scaled = scale_standard(f, features).checkpoint()
    n = f.count()
    seen = max(1.0, n * (folds - 1) / folds)
    variance = f.agg(*[F.var_pop(c).alias(c) for c in features]).first()  # of the scaled columns: 1, or 0 for a constant
    spread = sum(1.0 for c in features if variance[c]) / len(features)
    points = {name: [dict(zip(grid, v)) for v in product(*grid.values())] for name, grid in grids.items()}
    ev = _evaluator("classification", label)

    def accuracy(table: DataFrame, k: int, fit) -> float:
        return float(ev.evaluate(fit(table.filter(F.col("fold") != k)).transform(table.filter(F.col("fold") == k))))

    def gamma(p: dict) -> float:  # on scaled columns: 1 / (columns x variance), or 1 / columns
        return 1.0 / (len(features) * (max(spread, 1e-12) if p["gamma"] == "scale" else 1.0))

    def same(task: tuple) -> tuple:
        """What a task fits; without a constant column both kinds of gamma are one number."""
        name, p, k = task
        return name, str({**p, "gamma": gamma(p)} if name == "svm" else p), k

    def single(task: tuple) -> float:
        name, p, k = task
        if name == "lr":
            est = LogisticRegression(maxIter=1000, regParam=1.0 / (p["C"] * seen), elasticNetParam=0.0, standardization=False)
            return accuracy(scaled, k, lambda tr: fit_pipeline(tr, features, label, est))
        if name == "svm":
            return accuracy(scaled, k, lambda tr: svm_rbf(tr, features, label, c=p["C"], gamma=gamma(p)))
        est = DecisionTreeClassifier(maxDepth=p["max_depth"] or DEEPEST, impurity=p["criterion"], maxBins=64, seed=SEED)
        return accuracy(f, k, lambda tr: fit_pipeline(tr, features, label, est))

    tasks = [(name, p, k) for name in ("lr", "svm", "dt") if name in points for p in points[name] for k in range(folds)]
    scores: dict[tuple, list[float]] = {}
    once = {same(t): t for t in tasks}  # points that come to the same fit are fitted once
    found = dict(zip(once, _at_once(single, list(once.values()))))
    for t in tasks:
        scores.setdefault((t[0], str(t[1])), []).append(found[same(t)])
    if "rf" in points:
        specs = [Spec(rounds=p["n_estimators"], depth=p["max_depth"] or DEEPEST, loss="share", columns=0.0, l2=0.0, fold=k)
                 for p in points["rf"] for k in range(folds)]
        judged = boost(f, features, label, specs, id_col, "fold", keep_trees=False)[1]
        for i, p in enumerate(points["rf"]):
            scores["rf", str(p)] = judged[i * folds:(i + 1) * folds]
    if "knn" in points:
        most = max(p["n_neighbors"] for p in points["knn"])
        near = reduce(DataFrame.unionByName, [knn_neighbours(scaled.filter(F.col("fold") != k), scaled.filter(F.col("fold") == k), id_col, features, most)
                                              .withColumn("fold", F.lit(k)) for k in range(folds)])
        voted = near.join(f.select(F.col(id_col).alias("train_id"), F.col(label).alias("v")), "train_id") \
            .join(f.select(F.col(id_col).alias("test_id"), F.col(label).alias("y")), "test_id")
        votes = voted.groupBy("test_id", "fold", "y").agg(*[  # of equal votes the smaller class wins
            (F.sum(F.when(F.col("rank") <= p["n_neighbors"], F.col("v"))) * 2 > F.count(F.when(F.col("rank") <= p["n_neighbors"], 1)))
            .cast("double").alias(f"p{i}") for i, p in enumerate(points["knn"])])
        for r in votes.groupBy("fold").agg(*[F.avg((F.col(f"p{i}") == F.col("y")).cast("double")).alias(f"p{i}") for i in range(len(points["knn"]))]) \
                .orderBy("fold").collect():  # folds
            for i, p in enumerate(points["knn"]):
                scores.setdefault(("knn", str(p)), []).append(r[f"p{i}"])
    out = []
    for name, ps in points.items():
        means = [sum(scores[name, str(p)]) / len(scores[name, str(p)]) for p in ps]
        top = max(range(len(ps)), key=lambda i: (means[i], -i))
        out += [(name, ", ".join(f"{k}={v}" for k, v in p.items()), float(m), i == top) for i, (p, m) in enumerate(zip(ps, means))]
    return df.sparkSession.createDataFrame(out, "estimator string, params string, mean_score double, best boolean")


def regularised_cv(df: DataFrame, features: list[str], label: str, id_col: str, kind: str = "ridge",
                   alphas: list[float] | None = None, folds: int = 5) -> tuple[float, LinearFit]:
    """Ridge / lasso with the penalty chosen by k-fold CV (ridge: largest mean R2,
    lasso: least mean squared error; ties: the smaller penalty): (best alpha, model
    of all rows).  One pass over the rows gives what all fits and scores need."""
    parts = fold_moments(kfold_assign(df, id_col, folds), features, label, "fold")
    alphas = alphas or ([0.01, 0.1, 1, 10, 100] if kind == "ridge" else [0.001, 0.01, 0.1, 1, 10])

    def score(alpha: float) -> float:
        out = []
        for k, held in parts.items():
            model = solve(merge([p for f, p in parts.items() if f != k]), features, kind, alpha)
            error = model.squared_error(held)
            out.append(1 - error / held.co[-1, -1] if kind == "ridge" else -error / held.n)
        return sum(out) / len(out)

    best = max(sorted(alphas), key=score)
    return best, solve(merge(list(parts.values())), features, kind, best)


def tree_rules(model: PipelineModel, features: list[str], max_depth: int | None = None) -> DataFrame:
    """Text rules of a fitted decision tree, one line per row (feature indices
    replaced by names), optionally cut at a depth."""
    from pyspark.sql import SparkSession
    text = model.stages[-1].toDebugString
    lines = []
    for line in text.splitlines()[1:]:
        depth = len(line) - len(line.lstrip(" ")) - 2  # root rules are indented by 2, +1 per level
        for i in sorted(range(len(features)), reverse=True):
            line = line.replace(f"feature {i} ", f"{features[i]} ")
        lines.append((len(lines), depth, line.strip()))
    if max_depth is not None:
        lines = [t for t in lines if t[1] <= max_depth]
    return SparkSession.getActiveSession().createDataFrame(lines, "line int, depth int, rule string")


def learning_curve(df: DataFrame, features: list[str], label: str, estimator, id_col: str,
                   sizes: list[float] | None = None, folds: int = 5, kind: str = "regression",
                   scale: bool = False) -> DataFrame:
    """Train / validation score for training prefixes of each fold: the first
    floor(size x n) training rows in hash order.  Positions in every fold's training
    rows come from one blocked running count per fold.  Least squares is solved for
    all prefixes from one pass of sums, and scored in one more."""
    from crease.operators.scan import running_totals
    from crease.session import checkpoint_dir
    checkpoint_dir(df.sparkSession)
    sizes = sizes or [i / 10 for i in range(1, 11)]
    f = running_totals(kfold_assign(df, id_col, folds).withColumn("__h", portable_hash(F.col(id_col), 7)), [], ["__h", id_col],
                       {f"__c{k}": (F.col("fold") == k).cast("int") for k in range(folds)}, exclusive=True).drop("__h").checkpoint()
    held = {r["fold"]: r["count"] for r in f.groupBy("fold").count().collect()}  # folds
    n_tr = [sum(c for j, c in held.items() if j != k) for k in range(folds)]
    place = [reduce(lambda a, b: a + b, [F.col(f"__c{j}") for j in range(folds) if j != k], F.lit(0)) for k in range(folds)]
    plain = isinstance(estimator, LinearRegression) and kind == "regression" and not scale and \
        not any(estimator.getOrDefault(p) for p in ("regParam", "weightCol") if estimator.isDefined(p)) and estimator.getFitIntercept() \
        and f.filter(reduce(lambda a, b: a | b, [F.col(c).isNull() | F.isnan(F.col(c).cast("double")) for c in [*features, label]])).isEmpty()
    if plain:
        rows = _linear_curve(f, features, label, sizes, n_tr, place)
    else:
        ev = _evaluator(kind, label)

        def score(task: tuple[int, float]) -> tuple:
            k, frac = task
            part = f.filter((F.col("fold") != k) & (place[k] < math.floor(frac * n_tr[k])))
            m = fit_pipeline(part, features, label, estimator, scale)
            return (float(frac), k, float(ev.evaluate(m.transform(part))),
                    float(ev.evaluate(m.transform(f.filter(F.col("fold") == k)))))

        rows = _at_once(score, [(k, frac) for k in range(folds) for frac in sizes])
    out = df.sparkSession.createDataFrame(rows, "size double, fold int, train_score double, val_score double")
    agg = out.groupBy("size").agg(F.avg("train_score").alias("train_score"), F.avg("val_score").alias("val_score"))
    gap = F.col("train_score") - F.col("val_score") if kind != "regression" else F.col("val_score") - F.col("train_score")
    return agg.withColumn("overfit", gap > 0.1)


def _linear_curve(f: DataFrame, features: list[str], label: str, sizes: list[float], n_tr: list[int], place: list[Column]) -> list[tuple]:
    """(size, fold, train, validation) mean absolute errors of least squares on every prefix.
    Rows of one fold between the same ends of prefixes are a group; groups (at most
    folds x (sizes x folds + 1)) make up every prefix."""
    ends = [[math.floor(frac * n) for frac in sizes] for n in n_tr]
    group = F.concat_ws(",", F.col("fold"), *[reduce(lambda a, b: a + b, [(place[k] >= e).cast("int") for e in sorted(ends[k])])
                                              for k in range(len(n_tr))])
    rows = f.select(group.alias("__g"), *[F.col(c).cast("double").alias(c) for c in dict.fromkeys([*features, label])])
    parts = {tuple(map(int, g.split(","))): m for g, m in fold_moments(rows, features, label, "__g").items()}
    # a group lies in a prefix if fewer of the fold's ends are at or before it than at or before the prefix's own
    order = [[sorted(e).index(v) for v in e] for e in ends]
    tasks = [(k, i) for k in range(len(n_tr)) for i in range(len(sizes))]
    inside = {(k, i): [g for g in parts if g[0] != k and g[1 + k] <= order[k][i]] for k, i in tasks}
    models = [solve(merge([parts[g] for g in inside[t]]), features) if inside[t] else None for t in tasks]
    weights = np.array([np.append(m.weights, m.intercept) if m else np.full(len(features) + 1, np.nan) for m in models])

    def errors(batches):
        for batch in batches:
            x = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in features], axis=1)
            miss = np.abs(x @ weights[:, :-1].T + weights[:, -1] - batch.column(label).to_numpy(zero_copy_only=False)[:, None])
            names, code = np.unique(batch.column("__g").to_numpy(zero_copy_only=False).astype(str), return_inverse=True)
            sums = np.zeros((len(names), len(weights)))
            np.add.at(sums, code, miss)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(np.bincount(code, minlength=len(names)), pa.int64()),
                                              pa.array(list(sums), pa.list_(pa.float64()))], ["g", "n", "sums"])

    lost = {tuple(map(int, r["g"].split(","))): (r["n"], np.array(r["sums"])) for r in
            rows.dropna().mapInArrow(errors, "g string, n long, sums array<double>")
            .groupBy("g").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i]) for i in range(len(tasks))]).alias("sums")).collect()}

    def mean(groups: list[tuple], at: int) -> float:
        n = sum(lost[g][0] for g in groups)
        return float(sum(lost[g][1][at] for g in groups) / n) if n else float("nan")

    return [(float(sizes[i]), k, mean(inside[k, i], at), mean([g for g in parts if g[0] == k], at)) for at, (k, i) in enumerate(tasks)]


def _tree_levels(node, most: int) -> tuple[np.ndarray, ...]:
    """A fitted tree as arrays by node: feature (-1: a leaf), threshold, left and right child, prediction."""
    out, todo = [[-1, 0.0, 0, 0, float(node.prediction())]], [(0, node, 0)]
    while todo:
        at, node, depth = todo.pop()
        if depth < most and node.subtreeDepth() > 0:
            split, below = node.split(), (node.leftChild(), node.rightChild())
            out[at][:4] = [split.featureIndex(), float(split.threshold()), len(out), len(out) + 1]
            for child in below:
                out.append([-1, 0.0, 0, 0, float(child.prediction())])
                todo.append((len(out) - 1, child, depth + 1))
    feature, threshold, left, right, value = zip(*out)
    return np.array(feature), np.array(threshold), np.array(left), np.array(right), np.array(value)


def depth_sweep(train: DataFrame, test: DataFrame, features: list[str], label: str,
                depths: range = range(1, 16)) -> DataFrame:
    """Train / test accuracy of a decision tree for each depth.  Trees grow level by
    level and split all nodes by all features, so the tree of a depth is the upper part
    of the deepest: one fit, and one pass that scores the rows at every depth."""
    most = max(depths)
    model = fit_pipeline(train, features, label, DecisionTreeClassifier(maxDepth=most, seed=SEED))
    tree = train.sparkSession.sparkContext.broadcast(_tree_levels(model.stages[-1]._call_java("rootNode"), most))

    def hits(batches):
        feature, threshold, left, right, value = tree.value
        for batch in batches:
            x = np.stack([np.array(c.to_numpy(zero_copy_only=False), float) for c in batch.columns], axis=1)
            y, at, right_ones = x[:, -1], np.zeros(len(x), int), []
            for _ in range(most):
                inner = np.flatnonzero(feature[at] >= 0)
                node = at[inner]
                at[inner] = np.where(x[inner, feature[node]] <= threshold[node], left[node], right[node])
                right_ones.append(int((value[at] == y).sum()))
            yield pa.RecordBatch.from_arrays([pa.array([len(y)], pa.int64()), pa.array([right_ones], pa.list_(pa.int64()))], ["n", "hits"])

    def accuracy(df: DataFrame) -> list[float]:
        part = df.select(*[F.col(c).cast("double").alias(f"f{i}") for i, c in enumerate([*features, label])]) \
            .mapInArrow(hits, "n long, hits array<long>")
        got = part.agg(F.sum("n"), *[F.sum(F.col("hits")[i]) for i in range(most)]).first()
        return [float(got[d] / got[0]) if got[0] else 0.0 for d in range(1, most + 1)]

    on_train, on_test = accuracy(train), accuracy(test)
    return train.sparkSession.createDataFrame([(d, on_train[d - 1], on_test[d - 1]) for d in depths],
                                              "depth int, train_accuracy double, test_accuracy double")


# ---------------------------------------------------------------------------
# Importances, attributions, decision grid
# ---------------------------------------------------------------------------

def feature_importance(model: PipelineModel, features: list[str]) -> DataFrame:
    """Tree ensembles: ``featureImportances``; linear models: |coefficient|."""
    last = model.stages[-1] if not isinstance(model, (Forest, Boosted)) else None
    spark = __import__("pyspark").sql.SparkSession.getActiveSession()
    if last is None:
        vals = model.importances
    elif hasattr(last, "featureImportances"):
        vals = last.featureImportances.toArray()
    else:
        vals = [abs(x) for x in last.coefficients.toArray()]
    rows = sorted([(f, float(v)) for f, v in zip(features, vals)], key=lambda t: -t[1])
    return spark.createDataFrame(rows, "feature string, importance double")


def permutation_importance(model, df: DataFrame, features: list[str], label: str, id_col: str,
                           kind: str = "classification", seed: int = SEED) -> DataFrame:
    """Drop in score when one column is permuted.  Each row gets its position in id
    order and in hash order (blocked running counts); the permuted column of the
    row at hash position p is the value of the row at id position p -- a
    distributed equi-join, no driver shuffle."""
    from crease.operators.scan import running_totals
    ev = _evaluator(kind, label)
    base = float(ev.evaluate(model.transform(df)))
    pos = running_totals(df, [], [id_col], {"__pid": F.lit(1)})
    pos = running_totals(pos.withColumn("__h", portable_hash(F.col(id_col), seed)), [], ["__h", id_col],
                         {"__phash": F.lit(1)}).cache()
    rows = []
    for c in features:
        donors = pos.select(F.col("__pid").alias("__phash"), F.col(c).alias("__perm"))
        shuffled = pos.drop(c).join(donors, "__phash").withColumnRenamed("__perm", c)
        score = float(ev.evaluate(model.transform(shuffled)))
        rows.append((c, base - score if kind != "regression" else score - base))
    pos.unpersist()
    return df.sparkSession.createDataFrame(rows, "feature string, importance double")


def linear_attribution(model: PipelineModel, df: DataFrame, features: list[str], key: list[str]) -> DataFrame:
    """Exact attribution of a linear model: coef_j * (x_j - mean_j), long form
    (key..., feature, value, attribution); mean |attribution| ranks features."""
    coefs = model.stages[-1].coefficients.toArray()
    means = df.agg(*[F.avg(c).alias(c) for c in features])
    j = df.crossJoin(F.broadcast(means.select(*[F.col(c).alias(f"{c}__mean") for c in features])))  # one row
    cells = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"),
                      (F.lit(float(coefs[i])) * (F.col(c) - F.col(f"{c}__mean"))).alias("attribution"))
             for i, c in enumerate(features)]
    return j.select(*key, F.explode(F.array(*cells)).alias("__a")).select(*key, "__a.*")


def decision_grid(model, df: DataFrame, fx: str, fy: str, others: dict | None = None, steps: int = 60) -> DataFrame:
    """Model output on a steps x steps grid spanning [min - 1, max + 1] of two
    features (other features fixed at given values, default their means)."""
    inputs = model.stages[0].getInputCols() if hasattr(model, "stages") else []
    rest = [c for c in inputs if c not in (fx, fy) and c not in (others or {})]
    if rest:
        others = (others or {}) | df.agg(*[F.avg(c).alias(c) for c in rest]).first().asDict()
    b = df.agg(F.min(fx).alias("x0"), F.max(fx).alias("x1"), F.min(fy).alias("y0"), F.max(fy).alias("y1"))
    g = b.select(F.explode(F.sequence(F.lit(0), F.lit(steps - 1))).alias("i"), "*") \
         .select(F.explode(F.sequence(F.lit(0), F.lit(steps - 1))).alias("j"), "*") \
         .select((F.col("x0") - 1 + F.col("i") * (F.col("x1") - F.col("x0") + 2) / (steps - 1)).alias(fx),
                 (F.col("y0") - 1 + F.col("j") * (F.col("y1") - F.col("y0") + 2) / (steps - 1)).alias(fy))
    for c, v in (others or {}).items():
        g = g.withColumn(c, F.lit(v))
    return model.transform(g)
