import random
import re

import numpy as np

from urlsieve.llm import decontaminate, queries


def plain(a, b):
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (2 if x == y else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
    return max(map(max, h))


def test_alignment_is_smith_waterman():
    rng = np.random.default_rng(1)
    for _ in range(40):
        item = rng.integers(1, 5, rng.integers(1, 12)).astype(np.uint64)
        lengths = rng.integers(1, 20, 4)
        rows = rng.integers(1, 5, (4, 20)).astype(np.uint64)
        got = decontaminate.align(item, rows, lengths)
        assert got.tolist() == [plain(item.tolist(), rows[i, :lengths[i]].tolist()) for i in range(4)]


def test_edits_and_edges(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcdefgh", k=4))
    item = [word() for _ in range(40)]
    edited = [w if i % 7 else word() for i, w in enumerate(item)]
    noise = lambda n: [word() for _ in range(n)]
    docs = [(1, " ".join(noise(50) + item + noise(20))), (2, " ".join(noise(9000) + edited)), (3, " ".join(noise(60))), (4, None), (5, ""),
            (6, " ".join(item).upper()), (6, " ".join(item)), (None, " ".join(item)), (7, " ".join(noise(10) + item[:12] + noise(10))), (8, "a b")]
    items = [(0, " ".join(item)), (0, " ".join(item)), (1, "a b"), (2, None), (3, ""), (None, " ".join(noise(20)))]
    docs = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, item_id string")
    items = spark.createDataFrame([(*i, "y") for i in items], "item_id long, text string, words string")
    got = decontaminate.leaked(docs, items).collect()
    assert sorted((str(r.doc_id), r.item_id) for r in got) == [("1", 0), ("2", 0), ("6", 0), ("None", 0)]
    assert all(r.align == 1 for r in got if r.doc_id != 2) and all(0.7 < r.align < 1 for r in got if r.doc_id == 2)
    assert decontaminate.leaked(docs.limit(0), items).count() == 0 and decontaminate.leaked(docs, items.limit(0)).count() == 0


def test_edited_version_in_many_documents(spark):
    """Fewer than half of the item's 4-grams stay intact, and they are as frequent as the leak."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    item = [word() for _ in range(42)]
    edited = " ".join(w if i % 7 != 6 else word() for i, w in enumerate(item))
    sparse = " ".join(w if i % 5 != 4 else word() for i, w in enumerate(item))
    items = spark.createDataFrame([(0, " ".join(item))], "item_id long, text string")
    for text in (edited, sparse):
        want = None
        for n in (8, 9, 1_000):
            docs = [(i, f"{word()} {word()} {text} {word()}") for i in range(n)] + [(n, " ".join(word() for _ in range(60))), (n + 1, " ".join(item[:6]))]
            got = decontaminate.leaked(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()
            assert sorted(r.doc_id for r in got) == list(range(n))
            rows = {(r.item_id, r.align, r.seeds) for r in got}
            assert len(rows) == 1 and rows == (want or rows)
            want = rows


def test_every_text_of_an_item_and_items_without_identifier(spark):
    rng = random.Random(8)
    texts = [" ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(30)) for _ in range(4)]
    items = spark.createDataFrame([(1, texts[0]), (1, texts[1]), (1, texts[1]), (None, texts[2]), (2, texts[2])], "item_id long, text string")
    docs = spark.createDataFrame([(i, f"xx {t} yy") for i, t in enumerate(texts)] + [(9, texts[0] + " " + texts[1])], "doc_id long, text string")
    got = sorted((r.doc_id, str(r.item_id), r.align) for r in decontaminate.leaked(docs, items).collect())
    assert got == [(0, "1", 1.0), (1, "1", 1.0), (2, "2", 1.0), (2, "None", 1.0), (9, "1", 1.0)]


def test_query_finds_what_holds_an_item(spark):
    sf = "/root/testdata/sf0.01"
    norm = lambda t: " ".join(re.findall(r"[^ \t-\r]+", t.lower()))
    items = [(r.item_id, norm(r.text)) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = {(d.doc_id, i) for d in spark.read.parquet(f"{sf}/documents.parquet").collect() for i, t in items if t in norm(d.text)}
    got = {(r.doc_id, r.item_id) for r in queries.op8_decontaminate(spark, sf).collect()}
    assert want and want == got
