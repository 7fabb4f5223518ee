import hashlib
import random
import re
import time
import zlib

import numpy as np
from urlsieve.llm import queries, runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words):
    """Every (start, length, smallest period) by trying all periods."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        at = 0
        while at + q < len(words):
            end = at
            while end + q < len(words) and words[end] == words[end + q]:
                end += 1
            if end - at >= q and end - at + q >= 12:
                found.setdefault((at, end + q), q)
            at = end + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def brute(doc_id, text):
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = brute_runs(words)
    lost = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(found), *best, best[0] if best[0] is None else 1000 * best[1] // best[2],
            sha("".join(f"{s},{length},{q}\n" for s, length, q in found)), sha(" ".join(w for i, w in enumerate(words) if i not in lost)))


def arrays(texts):
    """Word numbers as 64-bit values, and first words."""
    spread = np.random.default_rng(5).integers(1, 1 << 63, 1 << 12, dtype=np.uint64)
    words = np.array([w for t in texts for w in t], np.int64)
    return spread[words], np.cumsum([0] + [len(t) for t in texts])


def test_find_runs_equals_brute_force():
    rng = random.Random(3)
    fib, thue = [0, 1], [0]
    for _ in range(9):
        fib, thue = fib + fib[:len(fib) - (1 if len(fib) < 3 else 0)], thue + [1 - x for x in thue]
    a, b = [0], [0, 1]
    while len(b) < 400:
        a, b = b, b + a
    texts = [[], [0], [0] * 11, [0] * 12, [0] * 300, b, thue, fib[:300], [0, 1] * 6, [0, 1] * 5 + [0], [0, 0, 1] * 40 + [2] + [0, 0, 1] * 40,
             (list(range(100)) * 3)[:250], list(range(100)) * 2, list(range(100)) + list(range(99)), ([0] * 20 + [1]) * 9]
    for _ in range(300):
        base = [rng.randrange(rng.choice((1, 2, 3, 50))) for _ in range(rng.randrange(1, 60))]
        t = [rng.randrange(3) for _ in range(rng.randrange(20))] + base * rng.randrange(1, 6) + base[:rng.randrange(len(base))]
        for _ in range(rng.choice((0, 0, 1, 3))):
            t[rng.randrange(len(t))] = 7
        texts.append(t + [rng.randrange(4) for _ in range(rng.randrange(20))])
    words, first = arrays(texts)
    want = [(first[k] + s, length, q) for k, t in enumerate(texts) for s, length, q in brute_runs(t)]
    for stretch in (1, 37, 1 << 18):
        assert list(zip(*(x.tolist() for x in runs.find_runs(words, first, stretch=stretch)))) == want
    assert len(want) > 300


def test_long_texts_stay_fast():
    """A million words of one kind, of a long period, and random: about n log n steps."""
    n = 1_000_000
    rng = np.random.default_rng(1)
    some = rng.integers(1, 1 << 63, 70_001, dtype=np.uint64)
    start = time.time()
    for words, want in ((np.full(n, 7, np.uint64), [(0, n, 1)]), (np.resize(some, n), [(0, n, 70_001)]), (rng.integers(0, 1 << 63, n, dtype=np.uint64), [])):
        assert list(zip(*(x.tolist() for x in runs.find_runs(words, np.array([0, n]))))) == want
    assert time.time() - start < 60


def test_query_equals_brute_force(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    got = {r.doc_id: tuple(r) for r in queries.QUERIES["op13_periodic_runs"](spark, sf_dir).collect()}
    assert len(got) == len(docs) and sum(r[1] > 0 for r in got.values()) > 10
    assert got == {d: brute(d, t) for d, t in docs.items()}


def test_edges(spark, tmp_path):
    long = " ".join(f"w{i % 40_000}" for i in range(100_000))
    rows = [(1, None), (2, ""), (3, " \t\r\n"), (4, "a " * 12), (4, "a " * 12), (5, "A a " * 6), (None, "x y z " * 7), (None, None), (6, "é " * 30 + "b"), (7, long),
            (8, "a" * 100_000), (9, "b\x0bc " * 9), *[(i, "one two three " * (i % 7)) for i in range(10, 60)]]
    docs = spark.createDataFrame([(d, t, "c", 1) for d, t in rows], "doc_id long, text string, runs string, n_words int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in queries.QUERIES["op13_periodic_runs"](spark, str(tmp_path)).collect()), key=str)
    small = [(d, t) for d, t in rows if d != 7]
    assert [r for r in got if r[0] != 7] == sorted((brute(d, t) for d, t in small), key=str)
    assert [r[1:6] for r in got if r[0] == 7] == [(1, 0, 100_000, 40_000, 2500)]
    assert runs.periodic_runs(docs.limit(0)).count() == 0
    kept = {(r.doc_id, r.n_words, r.collapsed) for r in runs.periodic_runs(docs).filter("doc_id in (4, 6)").collect()}
    assert kept == {(4, 12, "a"), (6, 31, "é b")}
