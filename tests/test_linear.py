"""Linear fits against brute-force solvers and their own certificates; fold statistics against refits."""

import numpy as np
import pytest
from urlsieve.operators import foldstats, linear
from urlsieve.operators.splits import stratified_folds

NAMES = ["a", "b", "flat"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 2)) * (3, 0.1) + (10, -1)
    y = (x[:, 0] - 10 + 20 * (x[:, 1] + 1) + rng.normal(size=600) * 2 > 1.5).astype(int)
    table = spark.createDataFrame([(i, f"u{i}", int(v), float(p), float(q), 7.0) for i, (v, (p, q)) in enumerate(zip(y, x))],
                                  "row_id long, url string, label int, a double, b double, flat double").repartition(5)
    return table, np.column_stack((x, np.full(600, 7.0))), y


def descend(x, y, w, kind):
    """Plain gradient descent with small steps on the same objective."""
    scale = np.where(x.std(0) > 0, x.std(0), 1)
    z = np.column_stack(((x - x.mean(0)) / scale, np.ones(len(x))))
    keep = np.array([1, 1, 1, 1.0 if kind == linear.SQUARED_HINGE else 0.0])
    rate = 1 / (np.linalg.eigvalsh((z * w[:, None]).T @ z).max() * (2 if kind == linear.SQUARED_HINGE else 0.25) + 1)
    theta, sign = np.zeros(4), 2 * y - 1
    for _ in range(60_000):
        m = z @ theta
        slope = 1 / (1 + np.exp(-m)) - y if kind == linear.LOGISTIC else -2 * sign * np.maximum(0, 1 - sign * m)
        step = z.T @ (w * slope) + keep * theta
        theta = theta - rate * step
        if np.abs(step).max() < 1e-7:
            break
    return theta


@pytest.mark.parametrize("balanced", [False, True])
@pytest.mark.parametrize("fit,kind", [(linear.fit_logistic, linear.LOGISTIC), (linear.fit_squared_hinge, linear.SQUARED_HINGE)])
def test_weights_equal_brute_force(rows, fit, kind, balanced):
    table, x, y = rows
    w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum())) if balanced else np.ones(len(y))
    model = fit(table, NAMES, balanced=balanced)
    assert np.abs(np.append(model.weights, model.intercept) - descend(x, y, w, kind)).max() < 1e-4
    assert model.scans < 30
    z = (x - model.mean) / model.scale
    margin = z @ model.weights + model.intercept
    got = {r.row_id: (r.prediction, r.score) for r in model.score(table, "m").collect()}
    assert len(got) == 600 and all(got[i][0] == int(m > 0) for i, m in enumerate(margin))
    want = 1 / (1 + np.exp(-margin)) if kind == linear.LOGISTIC else margin
    assert np.allclose([got[i][1] for i in range(600)], want, atol=1e-9)
    if kind == linear.LOGISTIC:
        cert = {r.feature: r.moment for r in linear.moment_certificate(model, table).collect()}
        assert np.allclose([cert[n] for n in (*NAMES, "(intercept)")], np.append((w * y) @ z, w @ y), atol=1e-5)
    else:
        assert all(abs(r.residual) < 1e-5 for r in linear.gradient_certificate(model, table).collect())


def test_certificate_fails_off_the_optimum(rows):
    table, x, y = rows
    model = linear.fit_logistic(table, NAMES, max_scans=2)
    cert = {r.feature: r.moment for r in linear.moment_certificate(model, table).collect()}
    assert abs(cert["a"] - y @ ((x - model.mean) / model.scale)[:, 0]) > 0.1


def test_one_class_is_an_error(rows):
    table, _, _ = rows
    with pytest.raises(ValueError, match="both classes"):
        linear.fit_logistic(table.where("label = 1"), NAMES)


def test_fold_models_equal_refits(rows):
    """The model made of the other folds' moments is the one fitted to their rows; moments survive a large offset."""
    table, _, _ = rows
    table = table.withColumn("a", table["a"] + 1e8)
    folds = stratified_folds(table, folds=5)
    parts = foldstats.moments_by(folds, NAMES, "fold", "label")
    assert len(parts) == 10 and sum(m.n for m in parts.values()) == 600
    recalls = {r.fold: r.recall for r in foldstats.cross_validate_gaussian(table, NAMES).collect()}
    for f in range(5):
        model = foldstats.gaussian_of(NAMES, foldstats.without_fold(parts, f))
        again = foldstats.fit_gaussian(folds.where(f"fold <> {f}"), NAMES)
        assert np.allclose(model.mean, again.mean, rtol=1e-12) and np.allclose(model.variance, again.variance, rtol=1e-6)
        held = again.score(folds.where(f"fold = {f} and label = 1"))
        assert recalls[f] == held.where("prediction = 1").count() / held.count()


def test_gaussian_equals_densities(rows):
    table, x, y = rows
    model = foldstats.fit_gaussian(table, NAMES)
    want = np.log(y.mean()) - np.log(1 - y.mean())
    for c, s in ((1, 1), (0, -1)):
        own, spread = x[y == c], np.where(x.var(0) > 0, x.var(0), 1)
        v = own.var(0) + 1e-9 * spread
        want = want + s * (-0.5 * np.log(v) - (x - own.mean(0)) ** 2 / (2 * v)).sum(1)
    got = {r.row_id: r.score for r in model.score(table).collect()}
    assert np.allclose([got[i] for i in range(600)], want, atol=1e-6)
