"""Linear models from sums: one pass over the rows gives, per fold, the counts, means
and covariances of features and label; every complement of folds and every penalty
is then solved from these (L1-L3, E8).  The work after the pass depends on the
number of features and folds only."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class Moments:
    """Rows, means and co-moments (sums of products of deviations) of (features..., label)."""

    n: float
    mean: np.ndarray
    co: np.ndarray


def merge(parts: list[Moments]) -> Moments:
    """Moments of all parts together (pairwise updating, which keeps the digits)."""
    out = Moments(0.0, np.zeros_like(parts[0].mean), np.zeros_like(parts[0].co))
    for p in parts:
        if p.n:
            n, gap = out.n + p.n, p.mean - out.mean
            out = Moments(n, out.mean + gap * (p.n / n), out.co + p.co + np.outer(gap, gap) * (out.n * p.n / n))
    return out


def fold_moments(df: DataFrame, features: list[str], label: str, fold_col: str | None = None) -> dict:
    """fold -> Moments, by one aggregate; rows with a null in any column take no part."""
    z = [F.col(c).cast("double") for c in [*features, label]]
    rows = df.select((F.col(fold_col) if fold_col else F.lit(0)).alias("fold"), *[x.alias(f"z{i}") for i, x in enumerate(z)]).dropna()
    d = len(z)
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    found = rows.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), *[F.avg(f"z{i}").alias(f"m{i}") for i in range(d)],
                                     *[F.covar_pop(f"z{i}", f"z{j}").alias(f"c{i}_{j}") for i, j in pairs]).collect()  # folds
    out = {}
    for r in found:
        co = np.zeros((d, d))
        for i, j in pairs:
            co[i, j] = co[j, i] = r[f"c{i}_{j}"] * r["n"]
        out[r["fold"]] = Moments(float(r["n"]), np.array([r[f"m{i}"] for i in range(d)]), co)
    return out


@dataclass(frozen=True)
class Penalised:
    """A linear model to fit: its penalty's kind (ridge or lasso) and weight."""

    kind: str
    alpha: float


@dataclass
class LinearFit:
    """A fitted linear model; scoring is one expression."""

    features: list[str]
    weights: np.ndarray
    intercept: float

    def value(self) -> Column:
        out = F.lit(float(self.intercept))
        for c, w in zip(self.features, self.weights):
            out = out + F.lit(float(w)) * F.col(c).cast("double")
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("prediction", self.value())

    def squared_error(self, on: Moments) -> float:
        """Sum of squared errors on the rows that ``on`` describes."""
        v = np.append(-self.weights, 1.0)
        return float(v @ on.co @ v + on.n * (v @ on.mean - self.intercept) ** 2)


def solve(m: Moments, features: list[str], kind: str = "ridge", alpha: float = 0.0) -> LinearFit:
    """Least squares with the penalty ``alpha`` times the squared weights (ridge; 0: none), or
    half the mean squared error and ``alpha`` times the absolute weights (lasso, by
    coordinate descent).  The intercept is free; a constant feature weighs 0."""
    gram, xy = m.co[:-1, :-1], m.co[:-1, -1]
    live = np.diag(gram) > 1e-12 * max(1.0, m.n)
    w = np.zeros(len(xy))
    if kind == "ridge":
        held = np.flatnonzero(live)
        scale = np.sqrt(np.diag(gram)[held])  # equal diagonals: better digits
        a = gram[np.ix_(held, held)] / np.outer(scale, scale) + np.diag(alpha / scale ** 2)
        w[held] = np.linalg.lstsq(a, xy[held] / scale, rcond=1e-13)[0] / scale
    else:
        for _ in range(100_000):
            most = 0.0
            for j in np.flatnonzero(live):
                rest = xy[j] - gram[j] @ w + gram[j, j] * w[j]
                new = np.sign(rest) * max(0.0, abs(rest) - alpha * m.n) / gram[j, j]
                most = max(most, abs(new - w[j]) * np.sqrt(gram[j, j] / m.n))
                w[j] = new
            if most < 1e-10:
                break
    return LinearFit(features, w, float(m.mean[-1] - m.mean[:-1] @ w))
