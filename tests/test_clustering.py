"""Many k-means fits at once against a plain one, silhouettes, axes and bundles."""

import hashlib

import numpy as np
import pytest
from urlsieve.operators import cluster as C
from urlsieve.operators import kmeans
from urlsieve.plans import clustering as P
from urlsieve.sources import bundles

NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(8)
    middle = rng.normal(0, 4, (4, 3))
    return np.concatenate([middle[i % 4] + rng.normal(0, 1, (1, 3)) for i in range(240)] + [np.zeros((6, 3))])


def frame(spark, x, parts):
    return spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "row_id long, a double, b double, c double").repartition(parts)


def plain(x, k, r, seed=42, max_iter=300):
    """One fit, row by row as the operator's rules say."""
    chosen = []
    for s in range(k):
        d = kmeans.squares(x, x[chosen]).min(1) if chosen else np.ones(len(x))
        u = np.array([(int(hashlib.md5(f"{seed}|{r}|{s}|{i}".encode()).hexdigest()[:13], 16) + 0.5) / 16 ** 13 for i in range(len(x))])
        with np.errstate(divide="ignore"):
            time = -np.log(u) / d
        chosen.append(int(time.argmin()) if np.isfinite(time).any() else chosen[0])
    c = x[chosen]
    for _ in range(max_iter):
        lab = kmeans.squares(x, c).argmin(1)
        new = np.array([x[lab == j].mean(0) if (lab == j).any() else c[j] for j in range(k)])
        moved, c = ((new - c) ** 2).sum(), new
        if moved <= 1e-4:
            break
    return c, kmeans.squares(x, c).min(1).sum()


@pytest.mark.parametrize("parts", [1, 7])
def test_many_fits_equal_single_ones(spark, data, parts):
    """Also over other partitions: starts, centres, inertia and the winning restart are the same."""
    fits, sil = kmeans.fit_many(frame(spark, data, parts), NAMES, [2, 4, 5], restarts=4)
    for k, fit in fits.items():
        each = [plain(data, k, r) for r in range(4)]
        best = min(range(4), key=lambda r: (round(each[r][1], 4), r))
        assert fit.restart == best and np.allclose(fit.centres, each[best][0], atol=1e-9) and fit.inertia == pytest.approx(each[best][1])
        lab = kmeans.squares(data, fit.centres).argmin(1)
        assert fit.sizes == tuple(np.bincount(lab, minlength=k))
        d = ((data[:, None] - data[None]) ** 2).sum(-1)
        s = []
        for i in range(len(data)):
            own = lab == lab[i]
            a = d[i][own].sum() / max(own.sum() - 1, 1)
            b = min(d[i][lab == o].mean() for o in set(lab) - {lab[i]})
            s.append((b - a) / max(a, b) if own.sum() > 1 else 0.0)
        assert sil[k] == pytest.approx(np.mean(s), abs=1e-9)
    got = C.assign(fits[4], frame(spark, data, 3), NAMES).collect()
    assert [r.cluster for r in sorted(got, key=lambda r: r.row_id)] == kmeans.squares(data, fits[4].centres).argmin(1).tolist()


def test_scans_do_not_grow_with_restarts(spark, data):
    """The search takes as many rounds as its slowest fit, not as all of them together."""
    z = frame(spark, data, 2)
    alone = [kmeans.fit_many(z, NAMES, [k], restarts=1)[0][k].rounds for k in (2, 3, 5)]
    together, _ = kmeans.fit_many(z, NAMES, [2, 3, 5], restarts=1)
    assert [together[k].rounds for k in (2, 3, 5)] == alone


def test_fewer_rows_than_clusters(spark):
    z = frame(spark, np.array([[1.0, 1, 1]] * 4 + [[2.0, 2, 2]]), 2)
    fit = C.kmeans_fit(z, NAMES, 4, n_init=2)
    assert fit.inertia == 0 and sorted(fit.sizes) == [0, 0, 1, 4]
    with pytest.raises(ValueError, match="no rows"):
        C.kmeans_fit(z.limit(0), NAMES, 2)
    with pytest.raises(ValueError, match="fitted on"):
        C.assign(fit, z, ["a", "b"])


def test_axes_equal_eigenvectors(spark, data):
    x = data - data.mean(0)
    axes, shares = C.pca_axes(frame(spark, x, 4), NAMES, 2)
    values, vectors = np.linalg.eigh(np.cov(x.T))
    for i, (axis, share) in enumerate(zip(axes, shares)):
        want = vectors[:, -1 - i]
        assert abs(axis @ want) == pytest.approx(1) and axis[np.abs(axis).argmax()] > 0 and share == pytest.approx(values[-1 - i] / values.sum())


def test_bundle_assigns_new_rows(spark, data, tmp_path):
    rows = frame(spark, data * (1, 100, 1) + (0, 7, 3), 3)
    found = P.cluster_class(rows, NAMES, [3, 4], n_init=3)
    bundles.save_clustering(found.bundle(), str(tmp_path / "clusters"))
    loaded = bundles.load_clustering(str(tmp_path / "clusters"))
    assert loaded.names == tuple(found.names) and loaded.told == found.bundle().told and np.array_equal(loaded.centres, found.model.centres)
    same = {r.row_id: r.cluster for r in found.assigned.collect()}
    out = loaded.assign(rows.withColumn("cluster", rows.row_id * 0 - 5))
    assert out.columns == ["row_id", *NAMES, "cluster"] and {r.row_id: r.cluster for r in out.collect()} == same
    with pytest.raises(FileNotFoundError, match="train and save"):
        bundles.load_clustering(str(tmp_path / "nothing"))
    with pytest.raises(ValueError):
        loaded.assign(rows.drop("b"))


def test_linear_bundle(spark, data, tmp_path):
    from urlsieve.operators import linear
    rows = frame(spark, data, 2).selectExpr("*", "cast(a + b > 0 as int) label")
    model = linear.fit_logistic(rows, NAMES, balanced=True)
    bundles.save_linear(model, str(tmp_path / "linear"))
    again = bundles.load_linear(str(tmp_path / "linear"))
    assert (again.kind, again.names, again.intercept, again.class_weight, again.rows, again.scans) == (
        model.kind, model.names, model.intercept, model.class_weight, model.rows, model.scans)
    for part in ("mean", "scale", "weights"):
        assert np.array_equal(getattr(again, part), getattr(model, part))


def test_second_pass_is_reported(spark):
    """A cluster of most rows is clustered again against its own average, and both passes are told in full."""
    rng = np.random.default_rng(0)
    x = np.concatenate((rng.normal(0, 0.1, (60, 2)), rng.normal(0, 0.1, (60, 2)) + (0, 1.5), rng.normal(0, 0.1, (30, 2)) + (60, 0)))
    rows = spark.createDataFrame([(i, float(a), float(b), 1.0, "phishing" if i % 3 else "malware") for i, (a, b) in enumerate(x)],
                                 "row_id long, a double, b double, c double, type string")
    first = P.cluster_class(rows, NAMES, [2], n_init=3)
    second = P.second_pass(rows, first, NAMES, [2], n_init=3)
    assert first.names == ["a", "b"] and sorted(first.model.sizes) == [30, 120] and sorted(second.model.sizes) == [60, 60]
    report = P.pass_report(rows, second, "second")
    assert set(report) == {"description", "profiles", "composition", "dominance"}
    assert all(r.level == "second" for t in report.values() for r in t.collect())
    assert sum(r.n for r in report["composition"].collect()) == 120 and not report["dominance"].first().second_pass


def test_half_grid_sums_of_copies_and_near_points(spark):
    """All pairs in cells of any size, with copies, points nearer than a product of matrices can tell, and a cluster far from the others."""
    from urlsieve.operators import blocks
    rng = np.random.default_rng(8)
    x = np.concatenate((rng.normal(0, 1, (90, 3)), rng.normal(0, 1e-7, (40, 3)) + 300.0, np.repeat(rng.normal(0, 1, (5, 3)), 12, axis=0)))
    g = np.arange(len(x)) % 3
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    w = 1 + np.arange(len(x)) % 2
    to_b, names_b, to_a, names_a = blocks.group_sums(x[:70], w[:70], g[:70], x[70:], w[70:], g[70:])
    for k, c in enumerate(names_b):
        assert to_b[:, k] == pytest.approx((d[:70, 70:] * w[70:])[:, g[70:] == c].sum(1), rel=1e-12)
    for k, c in enumerate(names_a):
        assert to_a[:, k] == pytest.approx((d[70:, :70] * w[:70])[:, g[:70] == c].sum(1), rel=1e-12)
    df = spark.createDataFrame([(i, int(c), *map(float, r)) for i, (c, r) in enumerate(zip(g, x))], "row_id long, cluster int, a double, b double, c double")
    before = blocks.reduce_half_grid.__defaults__
    blocks.reduce_half_grid.__defaults__ = (20,)
    try:
        got = {r.id: r.s for r in C.silhouette_points(df, ["a", "b", "c"]).collect()}
    finally:
        blocks.reduce_half_grid.__defaults__ = before
    for i in range(len(x)):
        own = g == g[i]
        a, b = d[i][own].sum() / (own.sum() - 1), min(d[i][g == o].mean() for o in set(g) - {g[i]})
        assert got[i] == pytest.approx((b - a) / max(a, b), abs=1e-12)


def test_silhouette_measures_copies_once(spark):
    """What the grid gets are the distinct points, and its cells follow from their number."""
    from urlsieve.operators import blocks
    seen, whole = [], C.reduce_half_grid
    C.reduce_half_grid = lambda points, carry, reduce, schema, rows: seen.append(rows) or whole(points, carry, reduce, schema, rows)
    try:
        df = spark.range(3000).selectExpr("id as row_id", "cast(id % 2 as int) cluster", "cast(id % 6 as double) x")
        assert C.silhouette_points(df, ["x"]).count() == 3000 and seen == [6]
    finally:
        C.reduce_half_grid = whole
