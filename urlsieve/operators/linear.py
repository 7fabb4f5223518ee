"""Linear models fitted to their optimum by Newton steps, and certificates of that optimum.

Each step is one scan: tasks add up loss, gradient and Hessian of their rows (a matrix of features by features), and the driver
solves a system of that size. A handful of scans replaces the hundreds of a first-order method. Features are scaled to mean 0 and
deviation 1 of the training rows. Penalties are those of the published runs: strength 1 against the sum of losses; the logistic
intercept is free, that of the support vector machine is penalised as a weight.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urlsieve.operators.shape import feature_contract
from urlsieve.operators.standardise import fit_moments
from urlsieve.operators.sums import task_sums
from urlsieve.session import stage_table

LOGISTIC, SQUARED_HINGE = "logistic", "squared hinge"
#: A fit is at its optimum when no part of the gradient exceeds this share of the summed row weights.
TOLERANCE = 1e-11


@dataclass(frozen=True)
class LinearModel:
    kind: str
    names: tuple[str, ...]
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    intercept: float
    #: Weight of a row by its class.
    class_weight: tuple[float, float]
    rows: int
    scans: int

    def margin(self):
        """Decision value as one column expression; positive means class 1."""
        slope = self.weights / self.scale
        start = float(self.intercept - slope @ self.mean)
        return F.expr(" + ".join([f"{start!r}D", *[f"{float(c)!r}D * `{n}`" for n, c in zip(self.names, slope)]]))

    def score(self, df: DataFrame, name: str = "model") -> DataFrame:
        """Rows of ``df`` with model, prediction and score (probability of class 1, else the decision value)."""
        feature_contract(df, list(self.names))
        out = df.select(F.lit(name).alias("model"), *df.columns, self.margin().alias("_margin"))
        score = 1 / (1 + F.exp(-F.col("_margin"))) if self.kind == LOGISTIC else F.col("_margin")
        return out.withColumn("prediction", (F.col("_margin") > 0).cast("int")).withColumn("score", score).drop("_margin")


def _row_terms(kind: str, margin: np.ndarray, y: np.ndarray):
    """Loss, its slope and curvature in the margin, per row; y is 0 or 1."""
    sign = 2.0 * y - 1
    if kind == LOGISTIC:
        p = 1 / (1 + np.exp(-np.clip(margin, -700, 700)))
        return np.logaddexp(0, -sign * margin), p - y, p * (1 - p)
    short = np.maximum(0, 1 - sign * margin)
    return short ** 2, -2 * sign * short, 2.0 * (short > 0)


def _fit(train: DataFrame, names: Sequence[str], kind: str, balanced: bool, max_scans: int) -> LinearModel:
    names = tuple(names)
    feature_contract(train, list(names))
    rows = stage_table(train.select(*[F.col(n).cast("double").alias(n) for n in names], F.col("label").cast("double").alias("label")), "linear")
    counts = {int(r["label"]): r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if set(counts) != {0, 1}:
        raise ValueError(f"both classes must be there, found {sorted(counts)}")
    n, d = sum(counts.values()), len(names)
    of_class = tuple(n / (2 * counts[c]) if balanced else 1.0 for c in (0, 1))
    moments = fit_moments(rows, names)
    mean, scale = np.array([moments[m][0] for m in names]), np.array([moments[m][1] for m in names])
    penalty = np.append(np.ones(d), 1.0 if kind == SQUARED_HINGE else 0.0)

    def totals(theta: np.ndarray):
        def add(x: np.ndarray, other: dict) -> np.ndarray:
            z = np.column_stack(((x - mean) / scale, np.ones(len(x))))
            y = other["label"]
            w = np.where(y > 0, of_class[1], of_class[0])
            loss, slope, bend = _row_terms(kind, z @ theta, y)
            return np.concatenate(([w @ loss], z.T @ (w * slope), ((z * (w * bend)[:, None]).T @ z).ravel()))

        out = task_sums(rows, names, ["label"], 1 + (d + 1) + (d + 1) ** 2, add)
        return (out[0] + penalty @ theta ** 2 / 2, out[1:d + 2] + penalty * theta, out[d + 2:].reshape(d + 1, d + 1) + np.diag(penalty))

    theta, scans = np.zeros(d + 1), 1
    value, gradient, hessian = totals(theta)
    while np.abs(gradient).max() > TOLERANCE * n and scans < max_scans:
        step = np.linalg.lstsq(hessian, -gradient, rcond=None)[0]
        size = 1.0
        while True:
            scans += 1
            found = totals(theta + size * step)
            if found[0] <= value + 1e-4 * size * (gradient @ step) + 1e-12 * abs(value) or scans >= max_scans:
                break
            size /= 2
        theta, (value, gradient, hessian) = theta + size * step, found
    return LinearModel(kind, names, mean, scale, theta[:-1], float(theta[-1]), of_class, n, scans)


def fit_logistic(train: DataFrame, names: Sequence[str], balanced: bool = False, max_scans: int = 1000) -> LinearModel:
    """Logistic regression: half the squared weights plus the sum of log-losses, class-weighted if ``balanced``."""
    return _fit(train, names, LOGISTIC, balanced, max_scans)


def fit_squared_hinge(train: DataFrame, names: Sequence[str], balanced: bool = True, max_scans: int = 3000) -> LinearModel:
    """Linear support vector machine: half the squared weights and intercept plus the sum of squared hinges."""
    return _fit(train, names, SQUARED_HINGE, balanced, max_scans)


def moment_certificate(model: LinearModel, train: DataFrame) -> DataFrame:
    """feature, moment: sum of weighted probabilities times the scaled feature, plus the weight, by Spark aggregates.

    At the optimum of a logistic fit, and nowhere else, every moment equals the sum of weighted labels times the scaled feature; the
    row ``(intercept)`` has the sum of the weights of rows labelled 1. So the fit can be checked from the data alone.
    """
    w = F.when(F.col("label") == 1, model.class_weight[1]).otherwise(model.class_weight[0])
    rows = train.select(*model.names, (w / (1 + F.exp(-model.margin()))).alias("_p"))
    sums = rows.agg(F.sum("_p").alias("(intercept)"), *[
        (F.sum(F.col("_p") * ((F.col(n) - F.lit(float(m))) / F.lit(float(s)))) + F.lit(float(c))).alias(n)
        for n, m, s, c in zip(model.names, model.mean, model.scale, model.weights)])
    return sums.unpivot([], list(sums.columns), "feature", "moment")


def gradient_certificate(model: LinearModel, train: DataFrame) -> DataFrame:
    """feature, residual: the gradient of the penalised sum of squared hinges per weight, by Spark aggregates; zero at the optimum."""
    sign = 2 * F.col("label") - 1
    w = F.when(F.col("label") == 1, model.class_weight[1]).otherwise(model.class_weight[0])
    rows = train.select(*model.names, (-2 * w * sign * F.greatest(F.lit(0.0), 1 - sign * model.margin())).alias("_g"))
    sums = rows.agg((F.sum("_g") + F.lit(model.intercept)).alias("(intercept)"), *[
        (F.sum(F.col("_g") * ((F.col(n) - F.lit(float(m))) / F.lit(float(s)))) + F.lit(float(c))).alias(n)
        for n, m, s, c in zip(model.names, model.mean, model.scale, model.weights)])
    return sums.unpivot([], list(sums.columns), "feature", "residual")
