import hashlib
import random
from collections import Counter

import numpy as np

from urlsieve.llm import queries, repeats


def brute(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(t[i:i + length] for t in raw for i in range(len(t) - length + 1))
    out = []
    for t in raw:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        spans = len([x for x in bytes(gone).split(b"\0") if x])
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((len(t), len(t) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_suffix_order_against_brute_force():
    rng = np.random.default_rng(4)
    for trial in range(60):
        strings = [bytes(rng.integers(0, 256 if trial % 10 == 0 else 3, rng.integers(0, 70)).astype(np.uint8)) for _ in range(rng.integers(1, 12))]
        if trial % 2:
            strings += strings[:2] + [s[3:] + s[:9] for s in strings[:3]]
        for length in (1, 4, 9, 16):
            seen = Counter(s[i:i + length] for s in strings for i in range(len(s) - length + 1))
            got = repeats.repeated_windows(strings, length)
            assert [g.tolist() for g in got] == [[seen[s[i:i + length]] > 1 for i in range(len(s) - length + 1)] for s in strings]


def corpus():
    rng = random.Random(9)
    text = lambda n: "".join(rng.choices("abcdé \n", k=n))
    shared = [text(n) for n in (300, 370, 399, 400, 401, 450, 900)]
    texts = [None, "", "x" * 399, "x" * 400, "y" * 401, "ab" * 3000, "ab" * 300, text(5000)]
    for i in range(160):
        texts.append(text(rng.randrange(600)) + rng.choice(shared) + text(rng.randrange(900)) + (rng.choice(shared) if i % 3 else ""))
    base = text(4000)
    for _ in range(100):
        at = rng.randrange(4000)
        texts.append(base[:at] + text(1) + base[at + 1:])
    texts += [base, texts[20], texts[20]]
    rng.shuffle(texts)
    return texts


def test_documents_against_brute_force(spark):
    texts = corpus()
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, key string, uid long")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in repeats.repeated_spans(docs.repartition(3)).collect()}
    want = brute(texts, 400)
    assert [i for i in range(len(texts)) if got[i] != want[i]] == []


def test_nulls_repeats_and_empty(spark):
    docs = spark.createDataFrame([(None, "q" + "z" * 10), (1, None), (2, "w" * 200 + "v" * 200), (2, "w" * 200 + "v" * 200)], "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans) for r in repeats.repeated_spans(docs).collect()), key=str)
    assert got == sorted([(None, 11, 0, 0), (1, 0, 0, 0), (2, 400, 400, 1), (2, 400, 400, 1)], key=str)
    assert repeats.repeated_spans(docs.limit(0)).count() == 0


def test_query(spark, sf_dir):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op2_repeated_strings(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    assert [got[d.doc_id] for d in docs] == brute([d.text for d in docs], 400)


def test_symbols_are_wide_and_exact():
    assert [repeats.symbol_bytes(n) for n in (1, 9, 16, 397, 400)] == [1, 1, 2, 1, 50]
    table, sizes, _ = repeats.columns_of([bytes(range(256)) * 4], repeats.symbol_bytes(400))
    assert table.shape == (50, 20) and sizes.max() == 20  # rounds of a text of 1,024 bytes; 128 with words of 8 bytes
    data = np.random.default_rng(2).integers(0, 3, 400).astype(np.uint8)
    for unit in (1, 3, 8, 13, 50):
        words = [data[i:i + unit].tobytes() for i in range(len(data) - unit + 1)]
        codes = repeats.symbol_codes(data, unit).tolist()
        assert len(codes) == len(words) and len(set(zip(codes, words))) == len(set(codes)) == len(set(words))
