"""Running numbers that don't depend on the split, the grid over all pairs, and flows over streams."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from urlsieve.operators.blocks import distances, reduce_grid
from urlsieve.operators.numbering import number_rows
from urlsieve.operators.reference import load_reference
from urlsieve.plans.feature_table import url_feature_table
from urlsieve.sources.readers import read_labelled_urls
from urlsieve.streaming import flows


@pytest.mark.parametrize("parts", [1, 5, 16])
def test_numbers_are_exact(spark, parts):
    """One group holds most rows; a null group and null keys count as well."""
    rng = random.Random(1)
    rows = [("hot" if rng.random() < 0.8 else rng.choice(["a", "b", None]), i if i else None, "x") for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, k int, place string").repartition(parts)
    got = {(r.g, r.k): r.n for r in number_rows(df, ["k"], ["g"], "n").collect()}
    want = {}
    for g in {r[0] for r in rows}:
        for i, k in enumerate(sorted((r[1] for r in rows if r[0] == g), key=lambda k: (k is not None, k or 0)), 1):
            want[g, k] = i
    assert got == want
    whole = number_rows(df, ["k"], name="n")
    assert whole.columns == ["g", "k", "place", "n"]
    assert [r.n for r in whole.orderBy(F.col("k").asc_nulls_first()).collect()] == list(range(1, 3001))
    assert number_rows(df.limit(0), ["k"], ["g"]).count() == 0


def test_no_window_over_all_rows(spark):
    """The window that numbers rows is cut by range; the one over ranges sees a row per task."""
    df = spark.range(20_000).repartition(8)
    plan = number_rows(df, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "_range" in plan and "SinglePartition" not in plan


@pytest.mark.parametrize("size", ["200", "1777", "1m"])
def test_line_numbers_do_not_depend_on_the_split(spark, tmp_path, size):
    lines = [f"http://h{i}.com/{'x' * (i % 40)},{'benign' if i % 3 else 'phishing'}" for i in range(700)]
    for part in range(2):
        (tmp_path / f"part-{part}.csv").write_text("\n".join(["url,type", *lines[part * 350:(part + 1) * 350]]) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        got = sorted((r.row_id, f"{r.url},{r.type}") for r in read_labelled_urls(spark, str(tmp_path)).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == list(enumerate(lines))


@pytest.mark.parametrize("cell_rows", [7, 64, 1000])
def test_grid_meets_every_pair_once(spark, cell_rows):
    x = np.random.default_rng(3).normal(size=(150, 3))
    df = spark.createDataFrame([(i, [float(v) for v in r], i % 4) for i, r in enumerate(x)], "id long, vec array<double>, g int").repartition(4)

    def sums(p):
        d = distances(p["vec_a"], len(p["id_a"]), p["vec_b"], len(p["id_b"]))
        return {"id": p["id_a"], "total": (d * (p["g_b"] == 1)).sum(1), "n": np.full(len(p["id_a"]), len(p["id_b"]))}

    out = reduce_grid(df, ["g"], sums, "id bigint, total double, n bigint", 150, cell_rows).groupBy("id").agg(F.sum("total").alias("t"), F.sum("n").alias("n"))
    got = {r.id: (r.t, r.n) for r in out.collect()}
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    assert all(got[i][0] == pytest.approx(d[i][np.arange(150) % 4 == 1].sum()) and got[i][1] == 150 for i in range(150))


@pytest.mark.parametrize("small", [True, False])
def test_streams_equal_batches(spark, tmp_path, small):
    """With a list, looked up by broadcast or by shuffle, over several micro-batches, stopped and gone on with."""
    from dataclasses import replace
    lines = spark.createDataFrame([(i, i, d) for i, d in enumerate(["google.com", "paypal.com", "microsoft.com", "bbc.co.uk", "amazon.de", "netflix.com"], 1)],
                                  "line int, rank bigint, domain string")
    reference = load_reference(lines)
    if not small:
        reference = replace(reference, ranks_small=False, tlds_small=False)
    urls = ["http://g00gle.com/a", "https://paypa1-secure.tk/login", "amazon.de", "", None, "http://x.bbc.co.uk/?q=1", "http://netflixx.com", "http://10.0.0.1/a%20b",
            "http://micros0ft.com.evil.xyz", "not a url", "http://paypal.com"]
    rows = spark.createDataFrame([(i, u) for i, u in enumerate(urls * 4)], "row_id long, url string")
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    scorer = lambda df: df.withColumn("score", F.col("phish_hints") / 10).withColumn("prediction", F.lit(0))
    for part in (rows.where("row_id < 20"), rows.where("row_id >= 20")):
        part.repartition(3).write.mode("append").parquet(source)
        stream = flows.arriving(spark, source, "row_id long, url string", files_per_batch=2)
        flows.write_stream(flows.feature_stream(stream, reference), out, str(tmp_path / "cp"), once=True).awaitTermination(120)
    want = url_feature_table(rows, reference)
    got = spark.read.schema(want.schema).parquet(out)
    assert got.count() == 44 and got.exceptAll(want).count() == 0
    stream = flows.arriving(spark, source, "row_id long, url string")
    flows.write_stream(flows.score_stream(stream, scorer, reference), str(tmp_path / "scored"), str(tmp_path / "cp2"), once=True).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "scored")).select("verdict").count() == 44
