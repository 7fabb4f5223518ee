import numpy as np

from urlsieve.llm import neighbours, queries


def brute(ids, vectors, asked, k=5):
    out = {}
    v = np.array(vectors, float)
    norm = np.linalg.norm(v, axis=1)
    for i, a in enumerate(ids):
        if asked(a):
            s = v @ v[i] / (norm * norm[i])
            out[a] = [(x, y) for y, x in sorted((-s[j], ids[j]) for j in range(len(ids)) if ids[j] != a)[:k]]
    return out


def recall(got, want):
    hits = sum(len({g.vec_id for g in got if g.query_id == q} & {x for x, _ in w}) for q, w in want.items())
    return hits / sum(map(len, want.values()))


def test_query_recall(spark):
    sf = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    got = queries.op1_nearest_neighbours(spark, sf).collect()
    want = brute([r.vec_id for r in rows], [r.embedding for r in rows], lambda i: i % 50 == 0)
    assert len(got) == 5 * len(want)
    assert recall(got, want) >= 0.97
    assert all(sorted(g.rank for g in got if g.query_id == q) == [1, 2, 3, 4, 5] for q in want)


def test_many_cells_and_copies(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "CELL", 64)
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((30, 16))
    v = centres[rng.integers(0, 30, 1500)] + 0.3 * rng.standard_normal((1500, 16))
    v[200:700] = v[200]
    rows = [(i, [float(x) for x in np.float32(r)], "c") for i, r in enumerate(v)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    got = neighbours.nearest(df, neighbours.F.col("vec_id") % 50 == 0).collect()
    want = brute([r[0] for r in rows], [r[1] for r in rows], lambda i: i % 50 == 0)
    assert recall(got, want) >= 0.95
    same = [(g.query_id, g.rank, g.vec_id) for g in got if g.query_id == 250]
    assert sorted(same) == [(250, i + 1, 200 + i) for i in range(5)]


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [0.0, 1.0]), (50, [0.0, 0.0]), (100, [nan, 1.0]), (150, None), (None, [1.0, 1.0]),
            (3, [None, 1.0]), (4, [inf, 1.0]), (5, []), (6, [1.0, 1.0, 1.0]), (7, [-1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = [(r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in neighbours.nearest(df, neighbours.F.col("vec_id") % 50 == 0).collect()]
    assert sorted(got) == [(0, 1, 1, 1.0), (0, 2, 2, 0.0), (0, 3, 7, -1.0)]
    assert neighbours.nearest(df.limit(0), neighbours.F.col("vec_id") % 50 == 0).count() == 0


def test_lengths_are_spaces_of_their_own(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.standard_normal(3 if i % 5 == 0 else 4) * 10.0 ** (i % 7 * 50 - 150)]) for i in range(240)]
    got = neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), neighbours.F.col("vec_id") % 29 == 0).collect()
    for size in (3, 4):
        mine = [(i, np.array(v) / np.abs(v).max()) for i, v in rows if len(v) == size]
        want = brute([i for i, _ in mine], [v for _, v in mine], lambda i: i % 29 == 0)
        assert want and recall([g for g in got if g.query_id in want], want) >= 0.9
    assert len(got) == 5 * len({g.query_id for g in got}) == 5 * len([i for i, _ in rows if i % 29 == 0])
