import re

import corpus_pipeline
import pytest
from urlsieve.llm import jaccard

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_in_a_row(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    norm = lambda t: " ".join(re.findall(r"[^ \t-\r]+", t.lower()))
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        out = stage(spark, docs, sf_dir)
        after = {r.doc_id: r.text for r in out.collect()}
        assert set(after) <= set(before)
        if name == "near copies":
            groups = {(r.doc_id, r.component_id) for r in jaccard.similar_documents(docs).collect()}
            assert set(after) == {c for _, c in groups}
        if name == "decontamination":
            leaks = {d for d, t in before.items() if any(norm(i) in norm(t) for i in items)}
            assert set(before) - set(after) == leaks
        if name == "personal data":
            assert set(after) == set(before)
            assert not [t for t in after.values() if re.search(r"[a-z0-9]@[a-z-]+\.[a-z]", t)]
        if name == "tokens":
            assert after == before
        else:
            assert out.columns == docs.columns
        docs = out


@pytest.mark.parametrize("texts", [[], [(None, None, None, None, None), (1, None, "en", "s", 0), (1, None, "en", "s", 0), (2, "", "en", "s", 0)]])
def test_edges(spark, sf_dir, texts):
    docs = spark.createDataFrame(texts, COLUMNS)
    for _, stage in corpus_pipeline.STAGES[1:]:
        docs = stage(spark, docs, sf_dir)
    assert docs.count() == (3 if texts else 0)


def test_quality_stage_on_no_rows_and_clashing_names(spark, sf_dir):
    """No documents give none; columns called as the stages' own ones stay as they are."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert corpus_pipeline.keep_good(spark, docs.limit(0), sf_dir).count() == 0
    kept = corpus_pipeline.keep_good(spark, docs, sf_dir)
    more = docs.selectExpr("*", "'mine' stats", "7 score", "lang _row_key", "1 component_id")
    out = corpus_pipeline.keep_good(spark, more, sf_dir)
    assert out.columns == more.columns and out.drop("stats", "score", "_row_key", "component_id").exceptAll(kept).count() == 0
    assert out.filter("stats = 'mine' and score = 7 and _row_key = lang").count() == kept.count() > 50
    one = corpus_pipeline.keep_one_of_each(spark, out, sf_dir)
    assert one.columns == more.columns and one.count() == corpus_pipeline.keep_one_of_each(spark, kept, sf_dir).count()


def test_repeated_and_null_identifiers(spark, sf_dir):
    """Rows are judged each on its own: unlinked texts under one id stay, copies and leaks without an id go."""
    text = lambda s: " ".join(f"{s}{i}" for i in range(40))
    leak = spark.read.parquet(f"{sf_dir}/benchmark.parquet").filter("item_id is not null").orderBy("item_id").first().text
    rows = [(1, text("a")), (2, text("b")), (2, text("a")), (2, text("c")), (2, text("c")), (3, None), (3, None), (4, text("d")), (5, text("d") + " more"), (None, text("d")),
            *[(None, text("e"))] * 5, (None, text("f")), (None, leak), (6, leak), (6, text("g"))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], COLUMNS)
    got = corpus_pipeline.keep_one_of_each(spark, docs, sf_dir)
    assert got.columns == docs.columns
    want = [(1, text("a")), (2, text("b")), (2, text("c")), (3, None), (4, text("d")), (None, text("e")), (None, text("f")), (6, leak), (6, text("g"))]
    order = lambda pairs: sorted(pairs, key=str)
    assert order((r.doc_id, r.text) for r in got.collect()) == order(want)
    clean = corpus_pipeline.drop_leaks(spark, docs, sf_dir)
    assert clean.columns == docs.columns
    assert order((r.doc_id, r.text) for r in clean.collect()) == order(r for r in rows if r[1] != leak)


def test_run(spark, sf_dir):
    assert 0 < corpus_pipeline.run(spark, sf_dir).count() <= 200
