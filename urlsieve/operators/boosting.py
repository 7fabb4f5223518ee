"""Gradient boosting of trees that grow leaf by leaf, the leaf with the greatest gain first, from histograms.

Values fall into at most 255 bins per feature. A scan makes the histograms of all nodes that are asked for: tasks count their rows,
sums meet by (node, feature, bin) in a shuffle, and the driver gets at most 255 sums per feature and node, however many rows there
are. Growth by greatest gain asks for one split at a time; here the driver replays that order on the splits already known and asks
for the children of every node it met, so a tree takes about as many scans as it has levels and is the same tree. Of two children only
the one with fewer rows is counted; the other's sums are what is left of the parent's.

A scan costs some tenths of a second however few its rows are, thousands of times in a fit. Rows of up to ``HELD_CELLS`` values are
therefore held by one task, which grows the same trees without scans.

Gradients are summed as integers (units of 2 ** -20), so the model depends neither on partitions nor on the order of rows.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from urlsieve.operators.shape import feature_contract
from urlsieve.operators.sums import matrix
from urlsieve.session import stage_table

MAX_BINS = 255
UNIT = 1 << 20
#: Trees grown between two writings of the rows' margins.
REFRESH = 10
#: Rows times features up to which one task holds the rows and grows all trees; it needs some 4 bytes for each.
HELD_CELLS = 1 << 26
#: Rows that such a task counts at once.
SLICE = 1 << 12


@dataclass(frozen=True)
class Tree:
    """Nodes in the order they were made; a leaf has no children (left = right = itself). Rows of a bin up to ``bin`` go left."""

    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    depth: int

    def leaf_of(self, bins: np.ndarray) -> np.ndarray:
        """The node each row of bins ends in. A node's rows are parted once, so a row costs as much as its own path is long."""
        at, columns = np.zeros(len(bins), np.int64), bins.T
        held = [(0, np.arange(len(bins)))]
        while held:
            k, rows = held.pop()
            if self.left[k] == k:
                at[rows] = k
            elif len(rows):
                right = columns[self.feature[k]][rows] > self.bin[k]
                held += [(self.left[k], rows[~right]), (self.right[k], rows[right])]
        return at

    @property
    def leaves(self) -> int:
        return int((self.left == np.arange(len(self.left))).sum())


@dataclass(frozen=True)
class BoostedTrees:
    names: tuple[str, ...]
    #: Per feature the least value of each bin but the first.
    bounds: tuple[np.ndarray, ...]
    start: float
    trees: tuple[Tree, ...]

    def score(self, df: DataFrame, name: str = "model") -> DataFrame:
        """Rows of ``df`` with model, prediction and score (probability of class 1). Null and NaN count as greater than any value."""
        feature_contract(df, list(self.names))
        shared, columns = df.sparkSession.sparkContext.broadcast(self), list(df.columns)

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = shared.value
            for b in batches:
                bins = binned(matrix(b.select([f"_x{j}" for j in range(len(model.names))]), [f"_x{j}" for j in range(len(model.names))]), model.bounds)
                margin = margins(bins, np.full(b.num_rows, model.start), model.trees)
                yield pa.RecordBatch.from_arrays([*b.select(columns).columns, pa.array((margin > 0).astype(np.int32)), pa.array(1 / (1 + np.exp(-margin)))],
                                                 names=[*columns, "prediction", "score"])

        rows = df.select("*", *[_number(n).alias(f"_x{j}") for j, n in enumerate(self.names)])
        schema = df.select("*", F.lit(0).alias("prediction"), F.lit(0.0).alias("score")).schema
        return rows.mapInArrow(run, schema).select(F.lit(name).alias("model"), "*")

    def split_counts(self, spark: SparkSession, name: str = "model") -> DataFrame:
        """model, feature, importance: how many splits use the feature."""
        used = np.zeros(len(self.names))
        for t in self.trees:
            used += np.bincount(t.feature[t.left != np.arange(len(t.left))], minlength=len(used))
        return spark.createDataFrame([(name, n, float(u)) for n, u in zip(self.names, used)], "model string, feature string, importance double")

    def nodes(self, spark: SparkSession) -> DataFrame:
        """tree, node, feature, bound, left, right, value, gain: one row per node; leaves have no feature, bound or children."""
        rows = []
        for i, t in enumerate(self.trees):
            for k in range(len(t.left)):
                inner = t.left[k] != k
                rows.append((i, k, *((self.names[t.feature[k]], float(self.bounds[t.feature[k]][t.bin[k]]), int(t.left[k]), int(t.right[k])) if inner else (None,) * 4),
                             float(t.value[k]), float(t.gain[k])))
        return spark.createDataFrame(rows, "tree int, node int, feature string, bound double, left int, right int, value double, gain double")


def from_nodes(names: Sequence[str], bounds: Sequence[Sequence[float]], start: float, nodes: DataFrame) -> BoostedTrees:
    """The model whose ``nodes()`` these are."""
    names, bounds, trees = tuple(names), tuple(np.asarray(b, np.float64) for b in bounds), []
    for _, t in nodes.toPandas().sort_values(["tree", "node"]).groupby("tree"):
        own, inner = t.node.to_numpy(np.int64), t.left.notna().to_numpy()
        left, right = (np.where(inner, t[c].fillna(0).to_numpy(np.int64), own) for c in ("left", "right"))
        feature = np.array([names.index(f) if i else 0 for f, i in zip(t.feature, inner)])
        cut = np.array([int(np.searchsorted(bounds[f], x)) if i else 0 for f, x, i in zip(feature, t.bound, inner)])
        level = np.zeros(len(own), np.int64)
        for k in np.flatnonzero(inner):  # parents come before their children
            level[left[k]] = level[right[k]] = level[k] + 1
        trees.append(Tree(feature, cut, left, right, t.value.to_numpy(np.float64), t.gain.to_numpy(np.float64), int(level.max())))
    return BoostedTrees(names, bounds, float(start), tuple(trees))


def _number(name: str):
    return F.coalesce(F.col(f"`{name}`").cast("double"), F.lit(float("nan")))


def binned(x: np.ndarray, bounds: Sequence[np.ndarray]) -> np.ndarray:
    """The bin of every value, NaN in a feature's last one."""
    out = np.empty(x.shape, np.uint8)
    for j, b in enumerate(bounds):
        out[:, j] = np.searchsorted(b, x[:, j], side="right")
    return out


def _by_row(column: pa.Array, d: int) -> np.ndarray:
    """The stored bins as a matrix, rows by features."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), d)


def _by_feature(column: pa.Array, d: int) -> np.ndarray:
    """The same matrix, whose columns lie together."""
    return np.asfortranarray(_by_row(column, d))


def margins(bins: np.ndarray, margin: np.ndarray, trees: Sequence[Tree]) -> np.ndarray:
    for t in trees:
        margin = margin + t.value[t.leaf_of(bins)]
    return margin


def bin_bounds(train: DataFrame, names: Sequence[str], max_bins: int = MAX_BINS) -> tuple[np.ndarray, ...]:
    """Per feature the least values of all bins but the first.

    Values are cut down to nine binary digits, which bounds how many there are; if they are more than ``max_bins``, they are
    gathered into bins of about equal numbers of rows.
    """
    cells = train.select(F.posexplode(F.array(*[_number(n) for n in names])).alias("feature", "v")).filter("not isnan(v)")
    scale = F.when(F.col("v") == 0, 1.0).otherwise(F.pow(F.lit(2.0), 8 - F.floor(F.log2(F.abs("v")))))
    counts = cells.groupBy("feature", (F.floor(F.col("v") * scale) / scale).alias("low")).agg(F.count(F.lit(1)).alias("n"))
    of = Window.partitionBy("feature")
    before = F.sum("n").over(of.orderBy("low")) - F.col("n")
    place = F.row_number().over(of.orderBy("low")) - 1
    by_rows = F.floor(before * max_bins / F.sum("n").over(of))
    bins = counts.select("feature", "low", F.when(F.count(F.lit(1)).over(of) <= max_bins, place).otherwise(by_rows).alias("bin"))
    found = bins.groupBy("feature", "bin").agg(F.min("low").alias("low")).toPandas()  # at most max_bins per feature
    return tuple(np.sort(found.low[found.feature == j].to_numpy(np.float64))[1:] for j in range(len(names)))


def _slopes(y: np.ndarray, margin: np.ndarray, of_class: tuple[float, float]) -> tuple[np.ndarray, np.ndarray]:
    """Per row the gradient and curvature of the weighted loss, in whole units."""
    p = 1 / (1 + np.exp(-margin))
    w = np.where(y > 0, of_class[1], of_class[0])
    return np.rint(w * (p - y) * UNIT), np.rint(w * p * (1 - p) * UNIT)


def node_sums(rows: DataFrame, trees: Sequence[Tree], tree: Tree, wanted: Sequence[int], of_class: tuple[float, float], d: int) -> np.ndarray:
    """Per wanted node of the tree that grows: gradients, curvatures and rows by feature and bin, in one scan."""
    slot = np.full(len(tree.left), -1)
    slot[list(wanted)] = np.arange(len(wanted))
    shared = rows.sparkSession.sparkContext.broadcast((tuple(trees), tree, slot, len(wanted)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, now, slots, asked = shared.value
        total = np.zeros((3, asked * d, 256), np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            bins = _by_feature(b.column("bins"), d)
            at = slots[now.leaf_of(bins)]
            some = np.flatnonzero(at >= 0)
            if not len(some):
                continue
            bins, at, y = bins[some], at[some], b.column("label").to_numpy(zero_copy_only=False)[some]
            parts = _slopes(y, margins(bins, b.column("margin").to_numpy(zero_copy_only=False)[some], done), of_class)
            for j in range(d):
                place, here = at * 256 + bins[:, j], slice(j, asked * d, d)
                for k, part in enumerate((*parts, None)):
                    total[k, here] += np.bincount(place, part, asked * 256).astype(np.int64).reshape(-1, 256)
        total = total.reshape(3, -1)
        some = np.flatnonzero(total[2])
        yield pa.RecordBatch.from_arrays([pa.array(some), *[pa.array(t[some]) for t in total]], names=["place", "g", "h", "n"])

    sums = rows.mapInArrow(run, "place long, g long, h long, n long").groupBy("place").agg(*[F.sum(c).alias(c) for c in "ghn"])
    found = sums.toArrow()  # at most a row per wanted node, feature and bin
    place = found.column("place").to_numpy()
    total = np.zeros((3, len(wanted) * d * 256), np.int64)
    for k, c in enumerate("ghn"):
        total[k, place] = found.column(c).to_numpy()
    return total.reshape(3, len(wanted), d, 256).swapaxes(0, 1)


def _best(g: np.ndarray, h: np.ndarray, n: np.ndarray, min_rows: int) -> dict:
    """A node's best split from its sums by feature and bin: the greatest gain, ties to the first feature and bin."""
    gl, hl, nl = (t.cumsum(axis=1) for t in (g, h, n))
    all_g, all_h, all_n = gl[0, -1], hl[0, -1], nl[0, -1]
    # a bin without rows of the node parts them as the bin before does
    at = np.flatnonzero((n > 0) & (nl >= min_rows) & (all_n - nl >= min_rows) & (hl > 0) & (all_h > hl))
    part = lambda g, h: g.astype(np.float64) ** 2 / np.maximum(h, 1)
    low_g, low_h = gl.ravel()[at], hl.ravel()[at]
    gain = (part(low_g, low_h) + part(all_g - low_g, all_h - low_h) - part(all_g, all_h)) / UNIT
    k = gain.argmax() if len(at) else None
    j, b = (0, 0) if k is None else np.unravel_index(at[k], n.shape)
    return {"gain": -1.0 if k is None else float(gain[k]), "feature": int(j), "bin": int(b), "gl": int(gl[j, b]), "hl": int(hl[j, b]), "nl": int(nl[j, b]),
            "g": int(all_g), "h": int(all_h), "n": int(all_n)}


def _grow(splits, leaves: int, min_gain: float):
    """Replay growth by greatest gain on the known ``splits``: path -> split. Returns the tree, paths by node, and unknown nodes met."""
    paths, known = [()], [splits.get(())]
    feature, cut, left, right, gain = [0], [0], [0], [0], [0.0]
    heap, unknown, made = [], [], 1

    def offer(k: int) -> None:
        if known[k] is None:
            unknown.append(k)
        elif known[k]["gain"] > min_gain:
            heapq.heappush(heap, (-known[k]["gain"], k))

    offer(0)
    while heap and made < leaves:
        _, k = heapq.heappop(heap)
        feature[k], cut[k], gain[k] = known[k]["feature"], known[k]["bin"], known[k]["gain"]
        left[k], right[k] = len(paths), len(paths) + 1
        made += 1
        for side in (0, 1):
            i = len(paths)
            paths.append((*paths[k], side))
            known.append(splits.get(paths[i]))
            for a, v in ((feature, 0), (cut, 0), (left, i), (right, i), (gain, 0.0)):
                a.append(v)
        if made < leaves:
            for side in (left[k], right[k]):
                offer(side)
    return paths, Tree(*[np.array(a) for a in (feature, cut, left, right)], np.zeros(len(paths)), np.array(gain), max(map(len, paths))), unknown


def _child(split: dict, side: int) -> dict:
    """What a split says of the node on one side; no split of that node."""
    return {"gain": -1.0} | {c: split[c] - split[f"{c}l"] if side else split[f"{c}l"] for c in "ghn"}


def _valued(tree: Tree, paths: Sequence[tuple], splits: dict, rate: float) -> Tree:
    """The tree with the value of every node, from its own split or that of its parent."""
    known = [splits[p] if p in splits else _child(splits[p[:-1]], p[-1]) for p in paths]
    sums = np.array([(k["g"], k["h"]) for k in known], np.float64)
    return Tree(tree.feature, tree.bin, tree.left, tree.right, -rate * sums[:, 0] / np.maximum(sums[:, 1], 1), tree.gain, tree.depth)


def _scanned(rows: DataFrame, fresh: Sequence[Tree], of_class: tuple[float, float], d: int, leaves: int, min_rows: int, min_gain: float, rate: float) -> Tree:
    """The next tree, by scans of the rows."""
    splits: dict[tuple, dict] = {}
    held: dict[tuple, np.ndarray] = {}
    while True:
        paths, tree, unknown = _grow(splits, leaves, min_gain)
        if not unknown:
            return _valued(tree, paths, splits, rate)
        asked = [()] if not splits else []
        for up in {paths[k][:-1]: None for k in unknown if paths[k]}:  # both children of a split are met together
            sides = [_child(splits[up], side) for side in (0, 1)]
            splits |= {(*up, side): sides[side] for side in (0, 1)}
            small = int(sides[1]["n"] < sides[0]["n"])
            if sides[1 - small]["n"] >= 2 * min_rows:
                asked.append((*up, small))
        node = {p: k for k, p in enumerate(paths)}
        for p, sums in zip(asked, node_sums(rows, fresh, tree, [node[p] for p in asked], of_class, d) if asked else ()):
            held[p] = sums
            if p:
                held[(*p[:-1], 1 - p[-1])] = held.pop(p[:-1]) - sums
            for q in {p, (*p[:-1], 1 - p[-1]) if p else p}:
                splits[q] = _best(*held[q], min_rows)


class _Held(dict):
    """Splits by path of the rows that one task holds, found when growth asks for them. ``rows`` has those of every leaf."""

    def __init__(self, places: np.ndarray, g: np.ndarray, h: np.ndarray, d: int, min_rows: int):
        super().__init__()
        self.places, self.g, self.h, self.d, self.min_rows = places, g, h, d, min_rows
        self.rows = {(): np.arange(len(places))}
        self.sums = {(): self._count(self.rows[()])}

    def get(self, path: tuple) -> dict:
        if path not in self:
            if path not in self.rows:
                self._part(path[:-1])
            self[path] = _best(*self.sums[path], self.min_rows) if path in self.sums else _child(self[path[:-1]], path[-1])
        return self[path]

    def _part(self, up: tuple) -> None:
        split, rows, sums = self[up], self.rows.pop(up), self.sums.pop(up)
        right = self.places[rows, split["feature"]] > split["feature"] * 256 + split["bin"]
        sides = rows[~right], rows[right]
        self.rows |= {(*up, side): sides[side] for side in (0, 1)}
        small = int(len(sides[1]) < len(sides[0]))
        if len(sides[1 - small]) >= 2 * self.min_rows:
            self.sums[(*up, small)] = counted = self._count(sides[small])
            self.sums[(*up, 1 - small)] = sums - counted

    def _count(self, rows: np.ndarray) -> np.ndarray:
        total, size = np.zeros((3, self.d * 256)), self.d * 256
        for i in range(0, len(rows), SLICE):
            some = rows[i:i + SLICE]
            place = self.places[some].astype(np.intp).ravel()
            for k, part in enumerate((self.g, self.h)):
                total[k] += np.bincount(place, np.repeat(part[some], self.d), size)
            total[2] += np.bincount(place, minlength=size)
        return total.astype(np.int64).reshape(3, self.d, 256)


def _held_trees(rows: DataFrame, rounds: int, start: float, of_class: tuple[float, float], d: int, leaves: int, min_rows: int, min_gain: float, rate: float) -> list[Tree]:
    """All trees, by one task that holds the rows."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, kind = np.arange(d) * 256, np.min_scalar_type(d * 256)
        got = [(_by_row(b.column("bins"), d).astype(kind) + first.astype(kind), b.column("label").to_numpy(zero_copy_only=False)) for b in batches]
        places, y = (np.concatenate(part) for part in zip(*got))
        del got
        margin, trees = np.full(len(y), start), []
        for _ in range(rounds):
            splits = _Held(places, *_slopes(y, margin, of_class), d, min_rows)
            paths, tree, _ = _grow(splits, leaves, min_gain)
            trees.append(_valued(tree, paths, splits, rate))
            for k, path in enumerate(paths):
                if path in splits.rows:
                    margin[splits.rows[path]] += trees[-1].value[k]
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(trees)], pa.binary())], names=["trees"])

    return pickle.loads(rows.coalesce(1).mapInArrow(run, "trees binary").first().trees)


def fit_boosted(train: DataFrame, names: Sequence[str], rounds: int = 300, rate: float = 0.1, leaves: int = 63, balanced: bool = True,
                min_rows: int = 20, max_bins: int = MAX_BINS, min_gain: float = 1e-6) -> BoostedTrees:
    """Boosted trees for the log-loss of ``label`` (0 or 1), rows weighted so that both classes weigh the same if ``balanced``.

    A leaf holds at least ``min_rows`` rows. Both classes must be there.
    """
    names = tuple(names)
    feature_contract(train, list(names))
    counts = {int(r["label"]): r["n"] for r in train.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if set(counts) != {0, 1}:
        raise ValueError(f"both classes must be there, found {sorted(counts)}")
    n, d = sum(counts.values()), len(names)
    of_class = tuple(n / (2 * counts[c]) if balanced else 1.0 for c in (0, 1))
    start = float(np.log(of_class[1] * counts[1] / (of_class[0] * counts[0])))
    bounds = bin_bounds(train, names, max_bins)

    def to_bins(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = [f"_x{j}" for j in range(d)]
        for b in batches:
            bins = binned(matrix(b, columns), bounds)
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in bins], pa.binary()), b.column("label"), pa.array(np.full(b.num_rows, start))],
                                             names=["bins", "label", "margin"])

    kind = "bins binary, label double, margin double"
    rows = train.select(*[_number(c).alias(f"_x{j}") for j, c in enumerate(names)], F.col("label").cast("double").alias("label")).mapInArrow(to_bins, kind)
    rows = stage_table(rows, "binned")
    growth = of_class, d, leaves, min_rows, min_gain, rate
    if n * d <= HELD_CELLS:
        return BoostedTrees(names, bounds, start, tuple(_held_trees(rows, rounds, start, *growth)))
    trees, fresh = [], []
    for _ in range(rounds):
        tree = _scanned(rows, fresh, *growth)
        trees.append(tree)
        fresh.append(tree)
        if len(fresh) == REFRESH:
            rows, fresh = stage_table(_moved(rows, tuple(fresh), d), "margins"), []
    return BoostedTrees(names, bounds, start, tuple(trees))


def _moved(rows: DataFrame, fresh: tuple[Tree, ...], d: int) -> DataFrame:
    """The rows with the fresh trees' values added to their margins."""
    shared = rows.sparkSession.sparkContext.broadcast(fresh)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bins = _by_feature(b.column("bins"), d)
            margin = margins(bins, b.column("margin").to_numpy(zero_copy_only=False), shared.value)
            yield pa.RecordBatch.from_arrays([b.column("bins"), b.column("label"), pa.array(margin)], names=["bins", "label", "margin"])

    return rows.mapInArrow(run, "bins binary, label double, margin double")
