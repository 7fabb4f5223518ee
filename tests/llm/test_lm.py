import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers

from urlsieve.llm import lm, queries

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + ["\n"]


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    held = {d.doc_id: zlib.crc32(str(d.doc_id).encode()) % 7 == 2 for d in docs}
    c = Counter(w for d in docs if not held[d.doc_id] for w in words(d.text))
    total = sum(c.values())
    got = {r.doc_id: r for r in queries.op9_language_model(spark, sf).collect()}
    mine = flat = tokens = 0
    enc = lm.encoder(PATH, public_tokenizers.PATTERN)
    pieces = Counter(i for d in docs if not held[d.doc_id] for i in [*enc.encode_ordinary(d.text or ""), enc.n_vocab])
    n = sum(pieces.values())
    for d in docs:
        r, w = got[d.doc_id], words(d.text)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[d.doc_id], len(w), sum(c[x] > 0 for x in w), total)
        assert math.isclose(r.base_score, sum(math.log10((c[x] + 1) / (total + len(c) + 1)) for x in w), rel_tol=1e-9)
        if r.held_out:
            ids = [*enc.encode_ordinary(d.text or ""), enc.n_vocab]
            mine += r.score
            flat += sum(math.log10((pieces[i] + 0.5) / (n + 0.5 * 50257)) for i in ids)
            tokens += len(ids)
    assert mine > flat * 0.97, (mine / tokens, flat / tokens)


def test_windows_score_each_token_once_and_sum_to_one():
    enc = lm.encoder(PATH, public_tokenizers.PATTERN)
    w = lm.start(np.random.default_rng(0).integers(0, 9, lm.SIDE ** 3))
    texts = [None, "", "one", "many words here " * 40]
    flat, begin = lm.sequences(texts, enc)
    inside, real, text = lm.windows(begin, lm.OVERLAP)
    seen = Counter((t, p) for row, ok, t in zip(inside[:, lm.OVERLAP:], real[:, lm.OVERLAP:], text) for p in row[ok])
    assert set(seen.values()) == {1} and len(seen) == len(flat) - len(texts)
    h = np.random.default_rng(1).standard_normal((1, lm.WIDTH)).astype(np.float32)
    every = lm.heads(w, np.repeat(h, lm.SIDE ** 3, axis=0), np.arange(lm.SIDE ** 3))[1]
    assert abs(np.exp(every).sum() - 1) < 1e-3
    assert lm.log10_scores(w, texts, enc)[0] == lm.log10_scores(w, texts, enc)[1]


def test_gradient():
    rng = np.random.default_rng(2)
    w = lm.start(rng.integers(1, 9, lm.SIDE ** 3))
    ids = rng.integers(0, 50_000, (4, lm.WINDOW + 1))
    real = np.ones((4, lm.WINDOW), bool)
    loss = lambda w: -lm.heads(w, lm.forward(w, ids[:, :-1], real)[-1].reshape(-1, lm.WIDTH), ids[:, 1:].ravel())[1].mean()
    for name in ("query", "key", "value", "mix", "out2"):
        moved = {n: x.copy() for n, x in w.items()}
        lm.descend(moved, ids[:, :-1], ids[:, 1:], real, 1.0)
        g = w[name] - moved[name]
        up = {n: x.astype(np.float64) for n, x in w.items()}
        up[name] = up[name] + 1e-3 * g / np.linalg.norm(g)
        down = {n: x.astype(np.float64) for n, x in w.items()}
        down[name] = down[name] - 1e-3 * g / np.linalg.norm(g)
        assert abs((loss(up) - loss(down)) / 2e-3 / np.linalg.norm(g) - 1) < 0.05, name


def test_edges(spark):
    docs = spark.createDataFrame([(None, None, "c"), (1, "", "c"), (1, "", "c"), (2, "a b", "c")], "doc_id long, text string, score string")
    got = lm.score_texts(docs, lm.F.col("doc_id") == 1, PATH, public_tokenizers.PATTERN).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens) for r in got) == [("1", 1, 1, 2), ("1", 1, 1, 2), ("2", 3, 1, 2), ("None", 1, 1, 2)]
    assert lm.score_texts(docs.limit(0), lm.F.lit(True), PATH, public_tokenizers.PATTERN).count() == 0
