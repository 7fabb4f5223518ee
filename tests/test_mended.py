import pytest
from pyspark.sql import functions as F

from urlsieve.functions.features import FEATURE_NAMES
from urlsieve.operators import aggregates as A
from urlsieve.operators import cluster as C
from urlsieve.operators import diagnostics as D
from urlsieve.operators import evaluate as E
from urlsieve.operators import shape as S
from urlsieve.sources import bundles, readers, writers


def test_csv_round_trip(spark, tmp_path):
    urls = ['http://a.com/"', "http://b.com/\\", " http://c.com/ ", "http://d.com/a,b", 'q"",\\"', "plain"]
    df = spark.createDataFrame([(i, u, "t", 1) for i, u in enumerate(urls)], "row_id long, url string, type string, label int")
    writers.write_feature_table(df, str(tmp_path / "t"), fmt="csv")
    back = readers.read_labelled_urls(spark, str(tmp_path / "t"))
    assert sorted(r.url for r in back.collect()) == sorted(urls)


def test_missing_types_and_labels(spark):
    df = spark.createDataFrame([("benign",), ("spam",), (None,)], "type string")
    assert [r.label for r in S.binary_label(df).collect()] == [0, 1, 1]
    df = spark.createDataFrame([(0,), (1,), (None,)], "label int")
    assert [r.label for r in S.flip_label(df).collect()] == [1, 0, 0]


def test_composition_of_any_type(spark):
    df = spark.createDataFrame([(0, "spam"), (0, "phishing"), (1, None), (1, None)], "cluster int, type string")
    got = {(r.cluster, r.type): (r.n, r.share, r.overall_share) for r in A.label_composition(df).collect()}
    assert got == {(0, "spam"): (1, 0.5, 0.25), (0, "phishing"): (1, 0.5, 0.25), (0, None): (0, 0, 0.5),
                   (1, "spam"): (0, 0, 0.25), (1, "phishing"): (0, 0, 0.25), (1, None): (2, 1, 0.5)}


def test_f1_without_malicious_rows(spark):
    df = spark.createDataFrame([("s", 0, 0), ("s", 0, 1)], "set string, label int, prediction int")
    row = D.external_metrics(df).first()
    assert row.recall is None and row.f1 is None and row.accuracy == 0.5


def test_auc_of_crowded_scores(spark):
    df = spark.range(4000).select(
        F.lit("m").alias("model"), (F.col("id") % 3 == 0).cast("int").alias("label"), F.lit(0).alias("prediction"),
        F.explode(F.array(*[F.lit(i) for i in range(2)])).alias("kind"), F.pmod(F.xxhash64("id"), F.lit(997)).alias("h"))
    for kind, score in ((0, F.pow(F.lit(10.0), -(F.col("h") / 10 + 6))), (1, F.col("h") - 500.0)):
        rows = df.where(F.col("kind") == kind).withColumn("score", score + F.col("label") * 0)
        got = E.evaluate_binary(rows).first().roc_auc
        held = rows.select("label", "score").toPandas()
        pos, neg = held[held.label == 1].score.to_numpy(), held[held.label == 0].score.to_numpy()
        want = sum((pos > x).sum() + (pos == x).sum() / 2 for x in neg) / len(pos) / len(neg)
        assert got == pytest.approx(want, abs=1e-12)


def test_no_cartesian_product_in_silhouette(spark):
    z = spark.range(600).selectExpr("id as row_id", "cast(id % 2 as int) cluster", "id * 0.1 as x")
    plan = C.silhouette_points(z, ["x"])._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_broken_model_is_not_called_missing(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        bundles.load_model(str(tmp_path / "none"))
    (tmp_path / "bad" / "metadata").mkdir(parents=True)
    (tmp_path / "bad" / "metadata" / "part-00000").write_text("{}")
    with pytest.raises(Exception) as err:
        bundles.load_model(str(tmp_path / "bad"))
    assert not isinstance(err.value, FileNotFoundError)


def test_checked_queries_take_all_features():
    from checks import cluster_queries, metric_queries, model_queries
    for names in (cluster_queries.NAMES, metric_queries._STD, metric_queries._CORR, metric_queries._PERM, model_queries.NB_NAMES):
        assert list(names) == list(FEATURE_NAMES)


def test_sampling_queries_sample_in_sql():
    from checks.registry import SQL
    first = "FROM (SELECT * FROM z ORDER BY md5('42|' || row_id), row_id LIMIT "
    assert first + "20000)" in SQL["silhouette_sample"] and first + "30000)" in SQL["dbscan_sweep"]
    assert first not in SQL["silhouette_points"] and first not in SQL["dbscan"]


@pytest.mark.parametrize("name", ["read_external_labelled", "read_external_sampled"])
def test_external_file_is_in_the_order_of_rows(spark, sf_dir, tmp_path, name):
    """The reader keeps an address's first line, so lines follow row_id however the pages' files are cut and ordered."""
    import duckdb
    from checks.compare import compare
    from checks.registry import QUERIES, SQL
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    pages = pages.unionByName(pages.withColumn("page_id", F.col("page_id") + 51))  # the same addresses, some with another type
    pages.repartitionByRange(6, F.desc("page_id")).sortWithinPartitions(F.desc("page_id")).write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    for t, at in (("nation", f"{sf_dir}/nation.parquet"), ("pages", f"{tmp_path}/pages.parquet/*.parquet")):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{at}'")
    assert compare(spark, con, name, QUERIES[name], SQL[name], str(tmp_path)).startswith("ok")
