import hashlib
import re

from urlsieve.llm import pii, queries

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def ok(kind, held):
    d = [int(c) for c in held if c.isdigit()]
    if kind == "ip":
        return all(int(p) <= 255 for p in held.split("."))
    if kind == "card":
        return 12 <= len(d) <= 19 and sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(reversed(d))) % 10 == 0
    return kind != "phone" or 9 <= len(d) <= 15


def brute(text):
    spans = [(m.start(), i, m.end()) for i, k in enumerate(pii.KINDS) for m in re.finditer(PLAIN[k], text or "") if ok(k, m[0])]
    return ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


EDGES = [None, "", "a@b.c_d@e.f x@.y a@b", "é🙂 mail joe@x.org, joe@x.org.", "1.2.3.4.5.6.7.8 999.1.1.1 0001.002.3.255 1.2.3", "4111 1111-1111 1111 4111111111111111 1 2 5",
         "+1 (555) 123-4567. +12 +44 20 7946 0958 () +1234567890123456", "9" * 30_000, "1 " * 20_000, "a" * 50_000 + "@", "x@y" + ".z" * 20_000, "4111 1111 1111 1111" * 50,
         "joe (at) site.org 555-123-4567 4111.1111.1111.1111 2001:db8:0:0:0:0:0:1"]


def test_base_equals_brute_force(spark):
    docs = spark.createDataFrame([(i, t, "c") for i, t in enumerate(EDGES + EDGES[:4])], "doc_id long, text string, spans string")
    got = pii.find_spans(docs).select("doc_id", "text", pii.written("base_spans").alias("s"), pii.written("spans").alias("a")).collect()
    assert len(got) == len(EDGES) + 4
    for r in got:
        assert r.s == brute(r.text) == r.a, (r.doc_id, r.s[:200], brute(r.text)[:200])
    assert pii.find_spans(docs.limit(0)).count() == 0


def test_added_spans_and_redaction(spark):
    all_in = pii.Trees((1.0,), (1.0,), 0.5)
    docs = spark.createDataFrame([("joe (at) site.org 555-123-4567, 4111.1111.1111.1111 2001:db8:0:0:0:0:0:1 a@b.co é",), (None,), ("plain",)], "text string")
    got = pii.redact(pii.find_spans(docs, all_in)).collect()
    assert [r.text for r in got] == ["<email> <phone>, <card> <ip> <email> é", None, "plain"]


def test_generators_beyond_failed_matches(spark):
    """What a greedy base match swallows, and formats beyond it, are proposed; the base spans stay as they are."""
    all_in = pii.Trees((1.0,), (1.0,), 0.5)
    held = ["4111 1111 1111 1111 12/27", "5500-0000-0000-0004 03/28", "7 4111111111111111 737", "3782.822463.10005", "2001:db8::1", "::1", "fe80::1:2", "999.10.0.0.7",
            "020 7946 0958", "01 23 45 67 89", "(0171) 123-4567", "+44 20 7946 0958 2024-01-01", "a" * 80 + " (at) site.org"]
    want = ["card:0:19", "card:0:19", "card:2:18", "card:0:17", "ip:0:11", "ip:0:3", "ip:0:9", "ip:4:12", "phone:0:13", "phone:0:14", "phone:0:15", "phone:0:16", "email:0:94"]
    docs = spark.createDataFrame([(i, f"x {t} y") for i, t in enumerate(held)], "doc_id long, text string")
    shift = lambda w: ":".join([w.split(":")[0], *(str(int(x) + 2) for x in w.split(":")[1:])])
    for r in pii.find_spans(docs, all_in).select("doc_id", "text", pii.written("base_spans").alias("b"), pii.written("spans").alias("s")).collect():
        assert r.b == brute(r.text) == "" and shift(want[r.doc_id]) in r.s.split(","), (r.text, r.s)
    text = "pay 4111 1111 1111 1111 12/27 or 5500-0000-0000-0004 03/28"
    got = pii.redact(pii.find_spans(spark.createDataFrame([(text,)], "text string"), all_in)).first().text
    assert "1111" not in got and "0004" not in got and "<card>" in got
    edges = spark.createDataFrame([(t,) for t in EDGES], "text string")
    assert all(set(map(tuple, r.base_spans)) <= set(map(tuple, r.spans)) for r in pii.find_spans(edges, all_in).collect())


def test_thresholds():
    assert pii.least_threshold([(81, 10, 10.0), (50, 10, 5.0), (90, 4, 4.0)], 0.9) == 0.81
    assert pii.least_threshold([(3, 5, 0.0)], 0.9) == 2.0 and pii.least_threshold([], 0.9) == 2.0
    assert pii.least_threshold([(9, 1, 0.0), (2, 99, 99.0)], 0.9) == 0.02


def card(i):
    body = f"4{i * 7919 % 10 ** 14:014d}"
    return next(body + str(d) for d in range(10) if ok("card", body + str(d)))


def test_fitted_trees_add_spans(spark):
    """Trees learnt from the texts take cards that a greedy base match swallows, and leave clean texts alone."""
    texts = []
    for i in range(400):
        n = card(i)
        grouped = " ".join(n[j:j + 4] for j in range(0, 16, 4))
        texts += [f"pay by card: {grouped} today", f"part no {i * 31 % 9973 + 10000} {i * 17 % 997 + 1000} {i + 100} x", f"nothing {i} to see here"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    trees = pii.fit_trees(docs)
    assert trees.trees and len(trees.by_kind) == 4
    asked = spark.createDataFrame([("card: 4111 1111 1111 1111 12/27",), ("nothing 5 to see here",), ("card: 4111.1111.1111.1111 ok",)], "text string")
    got = {r.text: (r.b, r.s) for r in pii.find_spans(asked, trees).select("text", pii.written("base_spans").alias("b"), pii.written("spans").alias("s")).collect()}
    assert got["card: 4111 1111 1111 1111 12/27"] == ("", "card:6:25")
    assert got["nothing 5 to see here"] == ("", "")


def test_query(spark, sf_dir):
    got = queries.op5_pii(spark, sf_dir).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert len(got) == len(texts)
    for r in got:
        base = brute(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest() and set(filter(None, base.split(","))) <= set(r.spans.split(","))
        assert r.n_email + r.n_ip + r.n_card + r.n_phone == (base.count(",") + 1 if base else 0)


def test_fit_sees_every_document(spark):
    """Examples that only documents with a great hash hold, so that no sample of those with the least hashes has one."""
    from pyspark.sql import functions as F
    plain = spark.range(9000).select(F.concat(F.lit("nothing "), "id").alias("text")).filter(F.xxhash64("text") < 0).limit(2500)
    told = []
    for i in range(1600):
        n = card(i)
        told += [f"pay by card: {' '.join(n[j:j + 4] for j in range(0, 16, 4))} today", f"part no {i * 31 % 9973 + 10000} {i * 17 % 997 + 1000} {i + 100} x"]
    told = spark.createDataFrame([(t,) for t in told], "text string").filter(F.xxhash64("text") > 0)
    assert pii.fit_trees(plain.union(told)).trees
