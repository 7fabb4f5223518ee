"""Nearest neighbours by cosine: stable (Gaussian) projections to a few dimensions, indexed by kd-trees.

On unit vectors the squared projected distance of a true neighbour at distance d is d^2 times a chi-square variable. So
points are verified in the order of projected distance until the chance that a nearer one is still ahead, 1 - Psi(r^2 / d_k^2),
is small. A kd-tree over a bounded sample cuts the projected space into cells; each cell has a kd-tree of its own. A
query first searches its own cell; the d_k found there tells, by the same test, which other cells it must visit.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from urlsieve.session import stage_table

PROJECTED = 8
CELL = 8192
SAMPLE = 50_000
LEAF = 128
BATCH = 1024
_FOUND = "query long, class long, score double"


def psi(x: float, m: int = PROJECTED) -> float:
    """Chi-square distribution function for even m."""
    half = x / 2
    return 1 - math.exp(-half) * sum(half ** i / math.factorial(i) for i in range(m // 2))


def quantile(p: float, m: int = PROJECTED) -> float:
    low, high = 0.0, 1e4
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if psi(mid, m) < p else (low, mid)
    return high


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Vectors times powers of two (cosines stay exactly the same), so that no square leaves the range of doubles."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, keepdims=True))[1])


def unit(vectors: np.ndarray) -> np.ndarray:
    vectors = scaled(vectors)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def splits(points: np.ndarray, levels: int) -> list[tuple[int, float]]:
    """A complete kd-tree as a heap of (dimension, bound): medians along the widest dimension."""
    out, groups = [], [points]
    for _ in range(levels):
        after = []
        for g in groups:
            dim = int(np.argmax(np.ptp(g, axis=0))) if len(g) else 0
            bound = float(np.median(g[:, dim])) if len(g) else 0.0
            out.append((dim, bound))
            low = g[:, dim] <= bound
            after += [g[low], g[~low]]
        groups = after
    return out


def cells_of(points: np.ndarray, tree: list[tuple[int, float]]) -> np.ndarray:
    node = np.zeros(len(points), np.int64)
    if tree:
        dims, bounds = np.array([t[0] for t in tree]), np.array([t[1] for t in tree])
        for _ in range((len(tree) + 1).bit_length() - 1):
            node = 2 * node + 1 + (points[np.arange(len(points)), dims[node]] > bounds[node])
    return node - len(tree)


class Tree:
    """kd-tree whose leaves are runs of reordered points, with their boxes."""

    def __init__(self, points: np.ndarray):
        todo, leaves = [np.arange(len(points))], []
        while todo:
            rows = todo.pop()
            if len(rows) <= LEAF:
                leaves.append(rows)
                continue
            dim = int(np.argmax(np.ptp(points[rows], axis=0)))
            half = len(rows) // 2
            rows = rows[np.argpartition(points[rows, dim], half)]
            todo += [rows[:half], rows[half:]]
        self.points, self.leaves = points, leaves
        self.low = np.array([points[r].min(axis=0) for r in leaves])
        self.high = np.array([points[r].max(axis=0) for r in leaves])

    def search(self, projected: np.ndarray, verify, k: int, stop: float, known: float = np.inf) -> tuple[np.ndarray, np.ndarray]:
        """Rows and scores of up to k points: leaves by their distance, points in order of projected distance.

        ``known``: squared distance of the k-th neighbour found elsewhere; the test holds to the nearer one.
        """
        gap = np.maximum(np.maximum(self.low - projected, projected - self.high), 0)
        reach = (gap * gap).sum(axis=1)
        order = np.argsort(reach, kind="stable")
        rows, scores = np.zeros(0, np.int64), np.zeros(0)
        wait, far = np.zeros(0, np.int64), np.zeros(0)
        for i, leaf in enumerate(order):
            if reach[leaf] > stop * known:
                break
            mine = self.leaves[leaf]
            d = self.points[mine] - projected
            wait, far = np.concatenate((wait, mine)), np.concatenate((far, (d * d).sum(axis=1)))
            bound = reach[order[i + 1]] if i + 1 < len(order) else np.inf
            ready = far <= bound
            if ready.any():
                rows = np.concatenate((rows, wait[ready]))
                scores = np.concatenate((scores, verify(wait[ready])))
                wait, far = wait[~ready], far[~ready]
                if len(rows) > k:
                    best = np.argsort(-scores, kind="stable")[:k]
                    rows, scores = rows[best], scores[best]
            if len(rows) >= k:
                known = min(known, max(2 - 2 * scores.min(), 0))
        return rows, scores


def _search(points: pd.DataFrame, queries: pd.DataFrame, k: int, stop: float) -> pd.DataFrame:
    if not len(points) or not len(queries):
        return pd.DataFrame({"query": [], "class": [], "score": []})
    vectors, asked = np.array(points.vector.tolist(), float), np.array(queries.vector.tolist(), float)
    vectors, asked = scaled(vectors), scaled(asked)
    norms, own = np.linalg.norm(vectors, axis=1), np.linalg.norm(asked, axis=1)
    tree, projected = Tree(np.array(points.projected.tolist())), np.array(queries.projected.tolist())
    out, known = [], queries.d.astype(float).fillna(np.inf).to_numpy()
    for i, q in enumerate(queries["class"]):
        rows, scores = tree.search(projected[i], lambda r: vectors[r] @ asked[i] / (norms[r] * own[i]), k, stop, known[i])  # noqa: B023
        out.append(pd.DataFrame({"query": q, "class": points["class"].to_numpy()[rows], "score": scores}))
    return pd.concat(out)


def visit(points: DataFrame, queries: DataFrame, k: int, stop: float) -> DataFrame:
    """Search cells for the queries sent to them; a cell asked by many serves them in groups of about BATCH."""
    counts = queries.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BATCH).cast("int").alias("groups"))
    asked = queries.join(counts, "cell").withColumn("part", F.pmod(F.xxhash64("class"), F.col("groups"))).drop("groups")
    held = points.join(counts, "cell").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups").cast("long") - 1))).drop("groups")
    return held.groupBy("cell", "part").cogroup(asked.groupBy("cell", "part")).applyInPandas(
        lambda p, q: _search(p, q, k, stop), _FOUND)


def nearest(vectors: DataFrame, asks, k: int = 5, sure: float = 0.98, key: str = "vec_id", vector: str = "embedding", seed: int = 11) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found to each row that the condition ``asks`` picks.

    Score is the cosine in double precision on the original vectors; ties go to the smaller identifier. Rows with a null
    identifier, and vectors that are null, zero or hold null or non-finite numbers take no part. Vectors of different lengths have no
    cosine: each length is a space of its own, searched in turn. Equal vectors are searched once and keep their k + 1 least
    identifiers, which is all that any answer can need. Repeated rows count once. The cells come from a sample of at most
    SAMPLE rows; every row is indexed.
    """
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], f"query_id {dict(vectors.dtypes)[key]}, rank int, vec_id {dict(vectors.dtypes)[key]}, score double")
    rows = vectors.select(vectors[key].alias("id"), F.col(vector).cast("array<double>").alias("vector"), asks.alias("asks"))
    usable = F.forall("vector", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False))) & F.exists("vector", lambda x: x != 0)
    rows = rows.filter(F.col("id").isNotNull() & F.coalesce(usable, F.lit(False)))
    sizes = [r["size"] for r in rows.groupBy(F.size("vector").alias("size")).agg(F.max(F.coalesce("asks", F.lit(False))).alias("asks")).filter("asks").orderBy("size").collect()]
    return reduce(DataFrame.union, [_nearest(rows.filter(F.size("vector") == n), n, k, sure, seed) for n in sizes], empty)


def _nearest(rows: DataFrame, length: int, k: int, sure: float, seed: int) -> DataFrame:
    """The same for rows (id, vector, asks) whose vectors are all of one length."""
    rows = rows.withColumn("class", F.xxhash64("vector"))
    rng = np.random.default_rng(seed)
    axes = rng.standard_normal((length, PROJECTED))
    ids = stage_table(rows.select("class", "id", "asks"), "vector-ids").distinct()
    near = Window.partitionBy("class", F.pmod(F.xxhash64("id"), F.lit(256))).orderBy("id")
    least = ids.select("class", "id").distinct().withColumn("n", F.row_number().over(near)).filter(F.col("n") <= k + 1)
    least = least.withColumn("n", F.row_number().over(Window.partitionBy("class").orderBy("id"))).filter(F.col("n") <= k + 1).drop("n")

    def project(it):
        for p in it:
            if len(p):
                yield p.assign(projected=list(unit(np.array(p.vector.tolist(), float)) @ axes))

    classes = rows.groupBy("class").agg(F.first("vector").alias("vector"), F.max(F.coalesce("asks", F.lit(False))).alias("asks"))
    points = stage_table(classes.mapInPandas(project, "class long, vector array<double>, asks boolean, projected array<double>"), "projected")
    total = points.count()
    levels = max(0, math.ceil(math.log2(max(total, 1) / CELL)))
    sample = points.orderBy(F.xxhash64("class", F.lit(seed))).select("projected").limit(SAMPLE).toPandas()
    tree = splits(np.array(sample.projected.tolist()), levels)

    def assign(it):
        for p in it:
            if len(p):
                yield p.assign(cell=cells_of(np.array(p.projected.tolist()), tree))

    points = stage_table(points.mapInPandas(assign, "class long, vector array<double>, asks boolean, projected array<double>, cell long"), "cells")
    queries, points = stage_table(points.filter("asks").drop("asks"), "queries"), points.drop("asks")
    stop = quantile(sure)
    near = stage_table(visit(points, queries.withColumn("d", F.lit(None).cast("double")), k + 1, stop), "found")
    reached = near.groupBy(F.col("query").alias("class")).agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("worst"))
    reached = reached.withColumn("d", F.when(F.col("n") > k, F.greatest(2 - 2 * F.col("worst"), F.lit(0.0))))
    dims = range(PROJECTED)
    boxes = points.groupBy("cell").agg(F.array(*[F.min(F.col("projected")[i]) for i in dims]).alias("low"), F.array(*[F.max(F.col("projected")[i]) for i in dims]).alias("high"))
    boxes = boxes.collect()  # one row per cell of some CELL points; 16 numbers each
    low, high, name = np.array([b.low for b in boxes]), np.array([b.high for b in boxes]), np.array([b.cell for b in boxes])

    def spread(it):
        for p in it:
            if not len(p):
                continue
            at, d = np.array(p.projected.tolist()), p.d.to_numpy(float)
            for a in range(0, len(p), 256):
                gap = np.maximum(np.maximum(low[None] - at[a:a + 256, None], at[a:a + 256, None] - high[None]), 0)
                need = ~((gap * gap).sum(axis=2) >= stop * d[a:a + 256, None]) & (name[None] != p.cell.to_numpy()[a:a + 256, None])
                row, cell = np.nonzero(need)
                yield p.iloc[a + row][["class", "vector", "projected", "d"]].assign(cell=name[cell])

    more = queries.join(reached.select("class", "d"), "class", "left").mapInPandas(spread, "class long, vector array<double>, projected array<double>, d double, cell long")
    found = near.union(stage_table(visit(points, stage_table(more, "visits"), k + 1, stop), "found"))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    named = found.join(least, "class").withColumn("n", F.row_number().over(best)).filter(F.col("n") <= k + 1)
    own = ids.filter("asks").select(F.col("class").alias("query"), F.col("id").alias("query_id")).distinct()
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    answers = own.join(named.select("query", F.col("id").alias("vec_id"), "score"), "query").filter("vec_id <> query_id")
    return answers.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
