"""Cross-validation from additive statistics: one scan gives the moments of every fold, and each fold's model is made of the others'.

The moments of a group are its rows, means and sums of squared deviations; groups are merged, never subtracted, so nothing is lost
to cancellation. No model is fitted to rows again.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urlsieve.operators.models import SEED, recall_by
from urlsieve.operators.splits import stratified_folds
from urlsieve.session import stage_table

#: Share of a feature's variance that is added to each class variance.
SMOOTHING = 1e-9


@dataclass(frozen=True)
class Moments:
    """Rows, means, sums of squared deviations, least and greatest values of some features."""

    n: int
    mean: np.ndarray
    squares: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def __add__(self, other: "Moments") -> "Moments":
        n = self.n + other.n
        if not self.n or not other.n:
            return self if self.n else other
        step = other.mean - self.mean
        return Moments(n, self.mean + step * (other.n / n), self.squares + other.squares + step ** 2 * (self.n * other.n / n),
                       np.minimum(self.low, other.low), np.maximum(self.high, other.high))

    @property
    def variance(self) -> np.ndarray:
        return self.squares / self.n


def moments_by(df: DataFrame, names: Sequence[str], *by: str) -> dict[tuple, Moments]:
    """Moments of the features per value of ``by``, in one scan with map-side sums. One row per group and feature comes back."""
    values = F.posexplode(F.array(*[F.col(n).cast("double") for n in names])).alias("j", "x")
    sums = df.select(*by, values).groupBy(*by, "j").agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("m"), F.var_pop("x").alias("v"), F.min("x").alias("low"), F.max("x").alias("high"))
    rows: dict[tuple, dict] = {}
    for r in sums.collect():
        rows.setdefault(tuple(r[b] for b in by), {})[r["j"]] = r
    out = {}
    for group, of in rows.items():
        mean, var, low, high = (np.array([of[j][c] for j in range(len(names))], float) for c in ("m", "v", "low", "high"))
        out[group] = Moments(of[0]["n"], mean, var * of[0]["n"], low, high)
    return out


@dataclass(frozen=True)
class GaussianModel:
    """Naive Bayes with a normal distribution per feature and class (0 and 1)."""

    names: tuple[str, ...]
    log_prior: tuple[float, float]
    mean: np.ndarray
    variance: np.ndarray

    def log_odds(self) -> Column:
        """Logarithm of the odds of class 1, as one column expression."""
        terms = [repr(self.log_prior[1] - self.log_prior[0])]
        for j, n in enumerate(self.names):
            (m0, m1), (v0, v1) = self.mean[:, j], self.variance[:, j]
            terms.append(f"({0.5 * math.log(v0 / v1)!r}D + pow(`{n}` - {float(m0)!r}D, 2) / {float(2 * v0)!r}D - pow(`{n}` - {float(m1)!r}D, 2) / {float(2 * v1)!r}D)")
        terms[0] += "D"
        return F.expr(" + ".join(terms))

    def score(self, df: DataFrame, name: str = "naive Bayes") -> DataFrame:
        """Rows of ``df`` with model, prediction and score (the log-odds)."""
        return df.select(F.lit(name).alias("model"), *df.columns, self.log_odds().alias("score")).withColumn("prediction", (F.col("score") > 0).cast("int"))


def gaussian_of(names: Sequence[str], per_class: dict[int, Moments]) -> GaussianModel:
    """The model of the given classes. Features count as scaled to one variance, constant ones keep theirs."""
    every = reduce(Moments.__add__, per_class.values())
    spread = np.where(every.high > every.low, every.variance, 1.0)
    both = [per_class[c] for c in (0, 1)]
    return GaussianModel(tuple(names), tuple(math.log(m.n / every.n) for m in both), np.array([m.mean for m in both]),
                         np.array([m.variance + SMOOTHING * spread for m in both]))


def fit_gaussian(train: DataFrame, names: Sequence[str]) -> GaussianModel:
    """Closed form, one scan. Both classes must be there."""
    return gaussian_of(names, {c: m for (c,), m in moments_by(train, names, "label").items()})


def without_fold(parts: dict[tuple, Moments], fold, classes: Iterable[int] = (0, 1)) -> dict[int, Moments]:
    """Per class the moments of all rows outside a fold, from those per (fold, class)."""
    return {c: reduce(Moments.__add__, (m for (f, k), m in parts.items() if f != fold and k == c)) for c in classes}


def cross_validate_gaussian(df: DataFrame, names: Sequence[str], folds: int = 5, seed: int = SEED) -> DataFrame:
    """fold, recall of naive Bayes over stratified folds: one scan for the moments, one for the scores of all folds."""
    table = stage_table(stratified_folds(df, folds=folds, seed=seed), "folds")
    parts = moments_by(table, names, "fold", "label")
    score = F.coalesce(*[F.when(F.col("fold") == f, gaussian_of(names, without_fold(parts, f)).log_odds()) for f in range(folds)])
    return recall_by(table.select("fold", "label", (score > 0).cast("int").alias("prediction")), "fold")
