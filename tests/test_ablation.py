"""The query leak_ablation: the published forests, addresses that the models have not seen, and the saved model."""

import pytest
from pyspark.sql import functions as F

from checks import model_queries as Q
from checks.corpus import url_corpus
from checks.registry import QUERIES
from urlsieve.operators.models import score_with


def test_whole_ablation(spark, tmp_path, monkeypatch):
    pages = spark.range(40).select(F.col("id").alias("page_id"), F.concat(F.lit("https://m.site"), F.col("id") % 7, F.lit(".example.com/en/"), "id").alias("url"))
    pages.unionByName(pages.limit(3)).write.parquet(str(tmp_path / "pages.parquet"))
    seen, real = [], Q.T.leak_ablation

    def spy(df, names, trainer, external=None, **other):
        seen.append((external, real(df, names, trainer, external, **other)))
        return seen[-1][1]

    monkeypatch.setattr(Q.T, "leak_ablation", spy)
    rows = {r.model: r for r in QUERIES["leak_ablation"](spark, str(tmp_path)).collect()}
    (external, out), = seen
    for model in (out.full, out.without):
        assert model.stages[-1].getNumTrees == 100 and model.stages[-1].getOrDefault("maxDepth") == 30
    assert sorted(r.url for r in external.collect()) == sorted(r.url for r in pages.collect())
    assert external.join(url_corpus(spark, str(tmp_path)), "url").count() == 0
    rate = [score_with(m, external).agg(F.avg("prediction")).first()[0] for m in (out.full, out.without)]
    got = rows["without"]
    assert [got.rate_full, got.rate_clean, got.rate_change] == pytest.approx([*rate, rate[1] - rate[0]])
    assert got.external_verdict in ("substantial improvement", "little change") and got.recall_change == got.recall - rows["full"].recall
    assert (rows["full"].n_features, got.n_features) == (42, 41) and rows["full"].rate_full is None
