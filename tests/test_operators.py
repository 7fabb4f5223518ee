import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from urlsieve.operators import cluster as C
from urlsieve.operators import evaluate as E
from urlsieve.operators import shape as S
from urlsieve.operators import splits as P
from urlsieve.operators.score import explain_signals, trust_score, verdict
from urlsieve.sources import readers, writers


def test_split_is_exact_and_repeatable(spark):
    df = spark.range(1003).selectExpr("id AS row_id", "concat('u', id) AS url", "CAST(id % 5 = 0 AS INT) AS label")
    once = P.stratified_split(df)
    sizes = {(r.label, r.is_test): r["count"] for r in once.groupBy("label", "is_test").count().collect()}
    assert sizes == {(0, True): 160, (0, False): 642, (1, True): 40, (1, False): 161}
    again = P.stratified_split(df.repartition(7))
    assert once.exceptAll(again).count() == 0


def test_folds_and_samples(spark):
    df = spark.range(103).selectExpr("id AS row_id", "concat('u', id) AS url", "CAST(id % 3 = 0 AS INT) AS label")
    sizes = [r["count"] for r in P.stratified_folds(df).groupBy("label", "fold").count().collect()]
    assert len(sizes) == 10 and sum(sizes) == 103
    assert P.sample_n(df, 10).count() == 10 and P.sample_n(df, 500).count() == 103 and P.sample_n(df.limit(0), 5).count() == 0
    few = P.stratified_folds(df.where("row_id < 2"))
    assert few.count() == 2


def test_roc_auc_against_all_pairs(spark):
    rng = random.Random(1)
    rows = [("m", i, rng.randint(0, 1), round(rng.gauss(0, 3), 1)) for i in range(400)]
    df = spark.createDataFrame(rows, "model string, row_id long, label int, score double")
    pos, neg = [r[3] for r in rows if r[2] == 1], [r[3] for r in rows if r[2] == 0]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert E.roc_auc(df).first()["roc_auc"] == pytest.approx(want, abs=1e-12)
    assert E.roc_auc(df.where("label = 1")).first()["roc_auc"] is None


def test_zero_division_gives_zero(spark):
    df = spark.createDataFrame([("m", 1, 1, 0, 0.1), ("m", 2, 0, 0, 0.1)],
                               "model string, row_id long, label int, prediction int, score double")
    r = E.evaluate_binary(df).first()
    assert (r.precision, r.recall, r.f1, r.accuracy, r.roc_auc) == (0.0, 0.0, 0.0, 0.5, 0.5)


def brute_dbscan(x, eps, min_points):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)) <= eps
    core, label = d.sum(1) >= min_points, np.full(len(x), -1)
    n = 0
    for i in range(len(x)):
        if core[i] and label[i] < 0:
            stack, label[i] = [i], n
            while stack:
                j = stack.pop()
                for k in np.flatnonzero(d[j]):
                    if label[k] < 0:
                        label[k] = n
                        if core[k]:
                            stack.append(k)
            n += 1
    return core, label


def test_dbscan_against_brute_force(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(0, .4, (150, 3)), rng.normal(4, .4, (150, 3)), rng.uniform(-6, 8, (60, 3)),
                        np.tile([[1.0, 2.0, 3.0]], (90, 1))])       # the last ninety are copies of one row
    z = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "row_id long, a double, b double, c double")
    got = {r.row_id: (r.core, r.cluster) for r in C.dbscan(z, ["a", "b", "c"], 0.8, 8).collect()}
    core, label = brute_dbscan(x, 0.8, 8)
    assert len(got) == len(x)
    assert [got[i] for i in range(len(x))] == [(bool(c), int(l)) for c, l in zip(core, label)]


def test_dbscan_over_many_blocks(spark, monkeypatch):
    """Small blocks, so that clusters run through many of them."""
    from urlsieve.operators import blocks
    rng = np.random.default_rng(5)
    t = np.linspace(0, 12, 300)
    x = np.stack([t, np.sin(t)], axis=1) + rng.normal(0, .01, (300, 2))
    x = np.concatenate([x, x + [0, 5]])
    original = blocks.block_pairs
    monkeypatch.setattr(C, "block_pairs", lambda p, c, w=None: original(p, c, w, block_rows=25))
    z = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "row_id long, a double, b double")
    got = {r.row_id: r.cluster for r in C.dbscan(z, ["a", "b"], 0.2, 3).collect()}
    assert [got[i] for i in range(len(x))] == brute_dbscan(x, 0.2, 3)[1].tolist()


def test_silhouette_against_brute_force(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, (300, 2))
    g = (x[:, 0] > 0).astype(int) + 2 * (x[:, 1] > 1.5).astype(int)
    g[0] = 9                                                        # a cluster of one row
    rows = [(i, int(c), float(a), float(b)) for i, (c, (a, b)) in enumerate(zip(g, x))]
    df = spark.createDataFrame(rows, "row_id long, cluster int, a double, b double")
    got = {r.id: r.s for r in C.silhouette_points(df, ["a", "b"]).collect()}
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    for i in range(len(x)):
        own = g == g[i]
        if own.sum() == 1:
            want = 0.0
        else:
            a = d[i][own].sum() / (own.sum() - 1)
            b = min(d[i][g == o].mean() for o in set(g) - {g[i]})
            want = (b - a) / max(a, b)
        assert got[i] == pytest.approx(want, abs=1e-9)


def test_pick_k_rules(spark):
    def pick(rows):
        return C.pick_k(spark.createDataFrame(rows, "k int, silhouette double, min_share double")).first()["k"]

    assert pick([(2, .30, .2), (3, .315, .1), (4, .40, .001)]) == 2      # 4 is set aside, 2 is within 0.02 of 3
    assert pick([(2, .30, .2), (3, .35, .1), (4, .355, .05)]) == 3
    assert pick([(2, .30, .001), (3, .40, .002)]) == 3                   # nothing is usable: all are


def test_kmeans_inertia_falls(spark):
    rng = np.random.default_rng(2)
    z = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(rng.normal(0, 1, (200, 2)))],
                              "row_id long, a double, b double")
    costs = [C.kmeans_fit(z, ["a", "b"], k, n_init=3, max_iter=50).inertia for k in (2, 3, 5)]
    assert costs == sorted(costs, reverse=True)


def test_column_checks(spark):
    df = spark.range(2).selectExpr("id AS row_id", "'u' AS url", "1 AS a", "CAST(id AS INT) AS b")
    with pytest.raises(ValueError):
        S.require_columns(df, ["url", "label"])
    with pytest.raises(ValueError):
        S.feature_contract(df, ["a", "c"])
    with pytest.raises(ValueError):
        S.ablate_columns(["a", "b"])
    assert S.constant_columns(df, ["a", "b"]) == ["a"]
    assert S.feature_matrix(df, ["b", "a"]).columns == ["row_id", "b", "a"]


def test_verdict_uses_the_unrounded_score(spark):
    df = spark.createDataFrame([(0.30004,), (0.3,), (0.6001,), (0.6,)], "score double")
    got = [r.verdict for r in verdict(trust_score(df)).collect()]
    assert got == ["SUSPICIOUS", "SAFE", "DANGEROUS", "SUSPICIOUS"]


def test_signals_for_missing_features_are_skipped(spark):
    r = explain_signals(spark.createDataFrame([(1, 80, 1)], "nb_at int, url_length int, in_top_sites int")).first()
    assert len(r.warnings) == 2 and r.reassurances == ["Domain appears in a list of the most visited sites worldwide"]


def test_text_readers(spark, tmp_path):
    (tmp_path / "list.csv").write_bytes(b"rank,domain\n 1 , Google.com ,x\n2\n3,\nx,y.com\n4,a.org\n\xff5,b.org\n")
    assert [(r["rank"], r.domain) for r in readers.read_reference_list(spark, str(tmp_path / "list.csv")).orderBy("line").collect()] \
        == [(1, "google.com"), (4, "a.org")]
    (tmp_path / "urls.txt").write_bytes("  http://a.com \n\n\t\nb.com\nb.com\n\xa0c.com\n".encode())
    assert [r.url for r in readers.read_url_lines(spark, str(tmp_path / "urls.txt")).orderBy("line").collect()] \
        == ["http://a.com", "b.com", "b.com", "c.com"]
    assert [r.url for r in readers.read_live_list(spark, str(tmp_path / "urls.txt")).orderBy("line").collect()] \
        == ["http://a.com", "b.com", "c.com"]


def test_external_reader_flips_and_drops_the_mark(spark, tmp_path):
    (tmp_path / "x.csv").write_bytes('\ufeffURL,Title,label\n"http://a,b.com",t,1\nhttp://c.com,t,0\nhttp://c.com,t,1\n'.encode())
    got = {r.url: r.label for r in readers.read_external_labelled(spark, str(tmp_path / "x.csv")).collect()}
    assert got == {"http://a,b.com": 0, "http://c.com": 1}
    with pytest.raises(ValueError):
        readers.read_labelled_urls(spark, str(tmp_path / "x.csv"))


def test_first_line_wins_across_reads(spark, tmp_path):
    (tmp_path / "l.csv").write_text("url,type\nhttp://a.com,phishing\nhttp://b.com,benign\nhttp://a.com,benign\n")
    rows = S.dedupe_urls(readers.read_labelled_urls(spark, str(tmp_path / "l.csv")), order="line")
    assert {r.url: r.type for r in rows.collect()} == {"http://a.com": "phishing", "http://b.com": "benign"}
    writers.write_report(rows.groupBy("type").count(), str(tmp_path / "report"))
    assert spark.read.option("header", True).csv(str(tmp_path / "report")).count() == 2


def test_missing_model_is_a_clear_error(spark, tmp_path):
    from urlsieve.sources.bundles import load_model
    with pytest.raises(FileNotFoundError):
        load_model(str(tmp_path / "none"))
