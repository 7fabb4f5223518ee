"""Leaf-wise boosting against a brute-force tree on the same bins, and invariants of the fit."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.registry import QUERIES
from urlsieve.operators import boosting as B
from urlsieve.sources import bundles


def brute_tree(bins, g, h, leaves, min_rows):
    """Leaves of growth by greatest gain, one split at a time: (rows of the leaf) in order of their making."""
    nodes, made = [np.arange(len(bins))], {}

    def best(rows):
        found = (-1.0, 0, 0)
        for j in range(bins.shape[1]):
            for b in np.unique(bins[rows, j]):
                low = rows[bins[rows, j] <= b]
                high = rows[bins[rows, j] > b]
                if min(len(low), len(high)) < min_rows or not h[low].sum() or not h[high].sum():
                    continue
                part = lambda r: g[r].sum() ** 2 / h[r].sum()
                gain = (part(low) + part(high) - part(rows)) / B.UNIT
                if gain > found[0] * (1 + 1e-12):
                    found = (gain, j, b)
        return found

    while len(nodes) < leaves:
        for i, rows in enumerate(nodes):
            made.setdefault(rows.tobytes(), best(rows))
        i = max(range(len(nodes)), key=lambda i: made[nodes[i].tobytes()][0])
        gain, j, b = made[nodes[i].tobytes()]
        if gain <= 1e-6:
            break
        rows = nodes.pop(i)
        nodes += [rows[bins[rows, j] <= b], rows[bins[rows, j] > b]]
    return nodes


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(4)
    x = np.column_stack((rng.integers(0, 6, 700), rng.normal(size=700).round(3), rng.integers(0, 900, 700) / 32, np.ones(700)))
    y = ((x[:, 0] > 3) ^ (x[:, 1] > 0.4) ^ (rng.random(700) < 0.1)).astype(int)
    rows = [(int(i), *map(float, r), int(c)) for i, (r, c) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "row_id long, a double, b double, c double, d double, label int").repartition(3), x, y


def test_trees_equal_brute_force(data):
    df, x, y = data
    model = B.fit_boosted(df, "abcd", rounds=2, leaves=9, min_rows=15, max_bins=40)
    bins = B.binned(x, model.bounds)
    assert [len(np.unique(bins[:, j])) for j in range(4)] == [6, 40, 40, 1]
    w = np.where(y > 0, 700 / 2 / y.sum(), 700 / 2 / (700 - y.sum()))
    margin = np.full(700, model.start)
    for t in model.trees:
        p = 1 / (1 + np.exp(-margin))
        g, h = np.rint(w * (p - y) * B.UNIT), np.rint(w * p * (1 - p) * B.UNIT)
        at = t.leaf_of(bins)
        mine = {tuple(np.flatnonzero(at == k)) for k in np.unique(at)}
        want = brute_tree(bins, g, h, 9, 15)
        assert mine == {tuple(np.sort(r)) for r in want} and t.leaves == len(want) == 9
        for r in want:
            assert np.allclose(t.value[at[r]], -0.1 * g[r].sum() / h[r].sum(), rtol=1e-12)
        margin = margin + t.value[at]


def test_same_model_for_any_partitions_and_margins_kept(data):
    df, x, y = data
    one, other = [B.fit_boosted(df.repartition(p), "abc", rounds=B.REFRESH + 2, leaves=5) for p in (1, 5)]
    for s, t in zip(one.trees, other.trees):
        assert all(np.array_equal(getattr(s, n), getattr(t, n)) for n in ("feature", "bin", "left", "right", "value"))
    scored = one.score(df.withColumn("b", F.when(F.col("row_id") > 5, F.col("b")))).orderBy("row_id").toPandas()
    assert list(scored.columns) == ["model", *df.columns, "prediction", "score"]
    x = x[:, :3].copy()
    x[:6, 1] = np.nan
    margin = B.margins(B.binned(x, one.bounds), np.full(700, one.start), one.trees)
    assert np.allclose(scored.score, 1 / (1 + np.exp(-margin))) and ((margin > 0) == scored.prediction).all()
    assert ((margin > 0) == y).mean() > 0.85


@pytest.mark.parametrize("share", (0.5, 0.03))
def test_held_rows_and_scans_make_the_same_trees(spark, monkeypatch, share):
    rng = np.random.default_rng(7)
    x = np.column_stack((rng.integers(0, 9, 900), rng.normal(size=900), rng.gamma(2, 30, 900), np.zeros(900)))
    y = (x[:, 1] + x[:, 0] / 9 + rng.normal(size=900) / 3 > np.quantile(x[:, 1] + x[:, 0] / 9, 1 - share)).astype(int)
    rows = [(*[None if rng.random() < 0.05 else float(v) for v in r], int(c)) for r, c in zip(x, y)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, label int").repartition(3)
    scans, real = [], B.node_sums
    monkeypatch.setattr(B, "node_sums", lambda *a: scans.append(len(a[3])) or real(*a))
    monkeypatch.setattr(B, "SLICE", 100)
    held = B.fit_boosted(df, "abcd", rounds=B.REFRESH + 2, leaves=12, min_rows=4)
    assert not scans
    monkeypatch.setattr(B, "HELD_CELLS", 0)
    scanned = B.fit_boosted(df, "abcd", rounds=B.REFRESH + 2, leaves=12, min_rows=4)
    assert len(scans) >= len(scanned.trees) and max(t.leaves for t in held.trees) > 6
    for s, t in zip(held.trees, scanned.trees, strict=True):
        assert all(np.array_equal(getattr(s, n), getattr(t, n)) for n in ("feature", "bin", "left", "right", "value", "gain")) and s.depth == t.depth


def test_query_has_all_rounds(spark, tmp_path, monkeypatch):
    pages = spark.range(30).select(F.col("id").alias("page_id"), F.concat(F.lit("https://m.site"), F.col("id") % 7, F.lit(".example.com/en/"), "id").alias("url"))
    pages.write.parquet(str(tmp_path / "pages.parquet"))
    seen, real = [], B.fit_boosted

    def spy(*a, **k):
        seen.append(real(*a, **k))
        return seen[-1]

    monkeypatch.setattr(B, "fit_boosted", spy)
    row, = QUERIES["train_booster"](spark, str(tmp_path)).collect()
    assert row.model == "gradient boosting" and [len(m.trees) for m in seen] == [300]


def test_edges(spark, data):
    df, _, _ = data
    stump = B.fit_boosted(df.withColumn("a", F.lit(1.0)), ["a"], rounds=1)
    assert stump.trees[0].leaves == 1 and stump.trees[0].depth == 0 and abs(stump.trees[0].value[0]) < 1e-6
    with pytest.raises(ValueError, match="both classes"):
        B.fit_boosted(df.where("label = 1"), "abc")
    with pytest.raises(ValueError, match="both classes"):
        B.fit_boosted(df.limit(0), "abc")
    model = B.fit_boosted(df, "abc", rounds=2, leaves=4)
    assert model.score(df.limit(0)).count() == 0
    assert model.split_counts(spark).agg(F.sum("importance")).first()[0] == 6
    assert model.nodes(spark).where("feature is null").count() == 8


def test_saved_and_loaded(data, tmp_path):
    df, x, _ = data
    model = B.fit_boosted(df, "abcd", rounds=2, leaves=6)
    bundles.save_boosted(model, str(tmp_path / "m"))
    again = bundles.load_boosted(str(tmp_path / "m"))
    bins = B.binned(x, again.bounds)
    assert again.names == model.names and again.start == model.start
    assert np.array_equal(B.margins(bins, np.zeros(700), again.trees), B.margins(bins, np.zeros(700), model.trees))
    with pytest.raises(FileNotFoundError):
        bundles.load_boosted(str(tmp_path / "none"))
