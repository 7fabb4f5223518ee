import random
import re

from urlsieve.llm import jaccard


def brute(texts, num=3, den=4):
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set())
    label = list(range(len(texts)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and den * both >= num * (len(sets[i]) + len(sets[j]) - both):
                x, y = sorted((root(i), root(j)))
                label[y] = x
    return [(len(s), root(i)) for i, s in enumerate(sets)]


def corpus():
    rng = random.Random(5)
    word = lambda: rng.choice("abcdefghij") + rng.choice("xyz")
    texts = [None, "", " \t\n", "One", "one", "one two", "one two three four", "a b c d e", "a b c d e f", "É é x y z", "é é x y z", "x " * 3000]
    shared = [word() for _ in range(60)]
    for size in (6, 7, 8, 9, 12, 20, 40, 80, 160, 300, 900):
        for _ in range(4):
            base = [word() for _ in range(size)]
            for edits in (0, 0, 1, 2, size // 30, size // 20, size // 12):
                copy = list(base)
                for _ in range(edits):
                    at = rng.randrange(len(copy))
                    copy[at:at + 1] = rng.choice([[], [word()], [word(), word()]])
                texts.append(" ".join(copy))
    for size in (5, 10, 20, 40, 200):
        texts += [" ".join([word() for _ in range(size)] + shared + [word() for _ in range(size // 2)]) for _ in range(12)]
    drift = [word() for _ in range(200)]
    for i in range(30):
        drift[i * 5:i * 5 + 5] = [word() for _ in range(5)]
        texts.append(" ".join(drift))
    rng.shuffle(texts)
    return texts


def test_equals_brute_force(spark):
    texts = corpus()
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(texts)], "doc_id long, text string, n long, set_id string")
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.similar_documents(docs.repartition(3)).collect())
    want = [(i, n, c) for i, (n, c) in enumerate(brute(texts))]
    assert got == want


def test_signatures_meet(spark):
    import numpy as np
    rng = np.random.default_rng(3)
    for trial in range(1500):
        n = int(rng.integers(1, 120))
        a = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        drop = int(rng.integers(0, len(a) // 4 + 1))
        b = np.unique(np.concatenate((a[drop:], rng.integers(0, 1 << 62, int(rng.integers(0, len(a) // 4 + 1))).astype(np.uint64))))
        common = np.sort(rng.permutation(a)[:int(rng.integers(0, len(a) + 1))])
        both = len(np.intersect1d(a, b))
        assert jaccard.differ(jaccard.sketch(a), jaccard.sketch(b)) <= len(a) + len(b) - 2 * both
        if 4 * both >= 3 * (len(a) + len(b) - both):
            assert len(np.intersect1d(jaccard.signatures(a, common, 3, 4), jaccard.signatures(b, common, 3, 4)))


def test_nulls_and_repeats(spark):
    docs = spark.createDataFrame([(None, "a b"), (None, None), (3, "a b"), (3, "a b"), (2, "A  b"), (4, None)], "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.similar_documents(docs).collect()), key=str)
    assert got == sorted([(None, 1, None), (None, 0, None), (3, 1, 2), (3, 1, 2), (2, 1, 2), (4, 0, 4)], key=str)
    assert jaccard.similar_documents(docs.limit(0)).count() == 0


def test_pairs_of_words_that_two_sets_show(spark):
    """Documents that share a passage with each of many others, and with their near copy only words that these two show."""
    base = [[f"g{g}w{i}" for i in range(1000)] for g in range(40)]
    texts = [" ".join(b) for b in base] + [" ".join("x" + w if i % 50 == 25 else w for i, w in enumerate(b)) for b in base]
    windows = [at + k for at in range(25, 1000, 50) for k in range(-4, 1)]
    texts += [" ".join(w for g, b in enumerate(base) for w in [*b[at:at + 5], *[f"g{g}p{at}a{i}" for i in range(20)]]) for at in windows]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.similar_documents(docs).collect())
    want = [(i, n, c) for i, (n, c) in enumerate(brute(texts))]
    assert sum(c != i for i, _, c in want) == 40
    assert got == want


def test_first_pairs_of_two_sets_are_all_taken(spark):
    rows = [(s, i, s, False) for s in range(6) for i in (s, 100)] + [(50 + s, i, 60 + s, True) for s in range(6) for i in (60 + s, 200, 201)]
    met = spark.createDataFrame(rows, "sig long, set_id long, least long, several boolean")
    got = sorted(map(tuple, jaccard.first_pairs(met).collect()))
    assert got == [(s, 100) for s in range(6)] + [(60 + s, i) for s in range(3) for i in (200, 201)]


def test_near_copies_that_do_not_link_make_few_pairs(spark, monkeypatch):
    """Copies of one text that are alike at 0.66 share most words; only those nearer by the long sketches are made pairs, trees of them first."""
    rng = random.Random(8)
    texts = []
    for group, copies in (("p", 120), ("q", 40)):
        base = [f"{group}{rng.randrange(10 ** 6)}" for _ in range(300)]
        for i in range(copies):
            edits = set(rng.sample(range(10, 290), 6))
            texts.append(" ".join(f"{w}x{i}" if at in edits else w for at, w in enumerate(base)))
    texts.append(" ".join(base))
    made, verify = [], jaccard.verify

    def counted(pairs, *rest):
        made.append(pairs.count())
        return verify(pairs, *rest)

    monkeypatch.setattr(jaccard, "verify", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.similar_documents(docs).collect())
    want = [(i, n, c) for i, (n, c) in enumerate(brute(texts))]
    assert got == want and sum(c != i for i, _, c in want) >= 40
    assert sum(made) < 10 * len(texts), made


def test_a_component_does_not_meet_itself_in_a_word(spark):
    """A word of 1,000 sets of one component and 10 others: only lists that hold a set of the others meet, and all sets are named."""
    open_ = spark.createDataFrame([(1, i, min(i // 1000 * i, i), 1010) for i in range(1010)], "sig long, set_id long, label long, n long")
    brief = spark.createDataFrame([(i, 40, b"\1" * 8) for i in range(1010)], "set_id long, n long, short binary")
    assert 9 <= jaccard.met_in_groups(open_, brief, "short").count() < 20
    assert sorted(map(tuple, jaccard.with_partner(open_, brief, 3, 4).collect())) == [(1, i) for i in range(1010)]


def test_merged_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    frame = lambda rows: spark.createDataFrame(rows, "a long, b long")
    got = jaccard.merged(jaccard.components(frame(edges[:120])), frame(edges[120:]))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, jaccard.components(frame(edges)).collect()))
