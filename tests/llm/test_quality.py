from urlsieve.llm import quality, queries


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op6_quality_rules(spark, sf)
    assert got.count() == 1000
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = got.filter("held_out").join(labels, "doc_id").collect()
    right = sum(r.predicted == r.quality for r in rows) / len(rows)
    clean = [r.predicted for r in rows if r.quality == 1]
    assert right >= 0.95 and sum(clean) / len(clean) >= 0.97, (right, len(rows))


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (2, "", "x"), (3, "word " * 100_000, "x"), (None, "\x00\t", "x")], "doc_id long, text string, score string")
    rules = quality.Rules(0.5, (((("upper", True, 0.5), ("log_words", False, 2.0)), -3.0),))
    got = quality.score_quality(docs, rules).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    assert quality.score_quality(docs.limit(0), rules).count() == 0
    one = quality.text_stats(docs.drop("score")).selectExpr("stats", "1 as label")
    assert quality.fit_rules(one).rules == () and quality.fit_rules(one.limit(0)).intercept == 0
