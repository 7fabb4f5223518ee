"""All-distances work over a bounded table, cut into block pairs, or into the cells of a grid where all pairs count.

Rows are grouped into blocks of a few hundred, blocks meet in an equi-join, and a task reduces the
distances of one block pair to sums, counts or labels per row. No pair of rows is ever emitted.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 256
PAIRS_PER_TASK = 128
#: Rows of either side in a cell of the grid over all pairs, and rows measured at a time.
CELL_ROWS = 4096
STRIPE_ROWS = 256
#: Rows of a slot of the half grid at most, and its least number of slots where there are rows enough.
HALF_CELL_ROWS = 16384
LEAST_SLOTS = 16
#: Squared distances below this share of both squared norms are measured from coordinate differences.
NEAR = 1e-3


def block_pairs(points: DataFrame, carry, width: float, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per ordered pair of blocks: a, b, vec_a, vec_b (flattened) and each carried column of both.

    ``points`` has id, vec and the ``carry`` columns. Only block pairs that may hold a pair within ``width`` are formed: rows
    are binned by the length of their vector, which differs by no more than their distance, so neighbours sit in the same or the
    next bin. A crowded bin is split by hash.
    """
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda acc, x: acc + x * x))
    bin_of = F.floor(norm / F.lit(width))
    binned = points.select("id", "vec", *carry, bin_of.alias("_bin"))
    sizes = binned.groupBy("_bin").agg(F.ceil(F.count(F.lit(1)) / block_rows).alias("_blocks"))
    placed = binned.join(sizes, "_bin").withColumn("_slot", F.pmod(F.xxhash64("id", F.lit(1)), F.col("_blocks")))
    rows = F.collect_list(F.struct("id", "vec", *carry))
    blocks = (placed.groupBy("_bin", "_slot").agg(rows.alias("r"))
              .select("_bin", F.concat_ws("/", "_bin", "_slot").alias("block"),
                      F.flatten("r.vec").alias("vec"), F.col("r.id").alias("id"),
                      *[F.col(f"r.{c}").alias(c) for c in carry]))
    cols = ["id", "vec", *carry]
    # pairs of block names come from the small table of bins; each side then meets its name in an equi-join
    counts = sizes.select("_bin", F.col("_blocks").cast("bigint").alias("_n"))
    others = F.array(*[F.col("_bin") + d for d in (-1, 0, 1)])
    near = (counts.select("_bin", "_n", F.explode(others).alias("_other"))
            .join(counts.select(F.col("_bin").alias("_other"), F.col("_n").alias("_m")), "_other"))
    named = near.select("_bin", "_other", "_m", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_n") - 1)).alias("_x"))
    named = named.select("_bin", "_other", "_x", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_m") - 1)).alias("_y"))
    named = named.select(F.concat_ws("/", "_bin", "_x").alias("a"), F.concat_ws("/", "_other", "_y").alias("b"))
    left = blocks.select(F.col("block").alias("a"), *[F.col(c).alias(f"{c}_a") for c in cols])
    right = blocks.select(F.col("block").alias("b"), *[F.col(c).alias(f"{c}_b") for c in cols])
    return named.join(left, "a").join(right, "b")


def distances(vec_a: np.ndarray, n_a: int, vec_b: np.ndarray, n_b: int) -> np.ndarray:
    """Euclidean distances from coordinate differences (exact for equal rows)."""
    a, b = vec_a.reshape(n_a, -1), vec_b.reshape(n_b, -1)
    out = np.empty((n_a, n_b))
    for i in range(n_a):
        out[i] = np.sqrt(((b - a[i]) ** 2).sum(axis=1))
    return out


def reduce_pairs(pairs: DataFrame, reduce: Callable[[dict], dict | None], schema: str,
                 max_rows: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Apply ``reduce`` to each block pair. It gets numpy arrays by column name and returns columns by name.

    ``max_rows`` bounds the points, hence the pairs; the pairs are dealt out so that a task holds few.
    """
    tasks = max(8, int((max_rows / block_rows + 1) ** 2 / PAIRS_PER_TASK))
    names = [c.split()[0] for c in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                pair = {n: (batch.column(n)[i].values.to_numpy(zero_copy_only=False)
                            if pa.types.is_list(batch.schema.field(n).type) else batch.column(n)[i].as_py())
                        for n in batch.schema.names}
                out = reduce(pair)
                if out is not None and len(out[names[0]]):
                    yield pa.RecordBatch.from_pydict({n: out[n] for n in names})

    return pairs.repartition(tasks, "a", "b").mapInArrow(run, schema)


def reduce_grid(points: DataFrame, carry, reduce: Callable[[dict], dict | None], schema: str, max_rows: int,
                cell_rows: int = CELL_ROWS) -> DataFrame:
    """Apply ``reduce`` to all pairs of rows, those of a row with itself among them; columns as in ``reduce_pairs``.

    Rows are dealt by hash to the slots of a square grid and sent to all cells of one grid row and one grid column. So a row moves
    twice the grid's side, which is ``max_rows / cell_rows``, and bytes moved don't follow the number of pairs. A cell
    holds its rows of both sides and hands them on a stripe at a time.
    """
    side = max(1, -(-max_rows // cell_rows))
    names = [c.split()[0] for c in schema.split(",")]
    slot = F.pmod(F.xxhash64("id"), F.lit(side)).cast("int")
    every = F.sequence(F.lit(0), F.lit(side - 1))
    cells = F.explode(F.concat(F.transform(every, lambda j: F.struct(slot.alias("i"), j.alias("j"), F.lit(True).alias("first"))),
                               F.transform(every, lambda i: F.struct(i.alias("i"), slot.alias("j"), F.lit(False).alias("first")))))
    dealt = points.select("id", "vec", *carry, cells.alias("c")).select("c.*", "id", "vec", *carry)

    def run(cell: pa.Table) -> pa.Table:
        side_a = cell.column("first").to_numpy()
        vec = cell.column("vec").combine_chunks().values.to_numpy(zero_copy_only=False).reshape(cell.num_rows, -1)
        held = {n: cell.column(n).to_numpy() for n in ("id", *carry)}
        rows_a, rows_b = np.flatnonzero(side_a), np.flatnonzero(~side_a)
        out = []
        for at in range(0, len(rows_a), STRIPE_ROWS):
            pair = {}
            for end, rows in (("a", rows_a[at:at + STRIPE_ROWS]), ("b", rows_b)):
                pair |= {f"{n}_{end}": v[rows] for n, v in held.items()} | {f"vec_{end}": vec[rows].ravel()}
            found = reduce(pair) if len(rows_b) else None
            if found is not None:
                out.append(pa.table({n: found[n] for n in names}))
        return pa.concat_tables(out) if out else pa.table({n: pa.array([], t) for n, t in zip(names, kinds)})

    kinds = [{"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64()}[c.split()[1]] for c in schema.split(",")]
    return dealt.groupBy("i", "j").applyInArrow(run, schema)


def reduce_half_grid(points: DataFrame, carry, reduce: Callable[[dict], dict | None], schema: str, rows: int,
                     cell_rows: int = HALF_CELL_ROWS) -> DataFrame:
    """``reduce_grid`` for what a pair says of both its rows: only the cells with i <= j are there.

    A cell off the diagonal holds two slots, and ``reduce`` answers for the rows of both; one on it has the same rows on
    both sides (``same``). Vectors come as a matrix, a whole cell at a time. ``rows`` is the number of points. A slot holds about ``cell_rows`` of
    them at most, so a cell's memory is bounded, and a row moves as often as the grid has slots.
    """
    side = max(-(-rows // cell_rows), min(LEAST_SLOTS, -(-rows // BLOCK_ROWS)), 1)
    names = [c.split()[0] for c in schema.split(",")]
    slot = F.pmod(F.xxhash64("id"), F.lit(side)).cast("int")
    every = F.sequence(F.lit(0), F.lit(side - 1))
    cells = F.explode(F.transform(every, lambda j: F.struct(F.least(slot, j).alias("i"), F.greatest(slot, j).alias("j"), (slot <= j).alias("first"))))
    dealt = points.select("id", "vec", *carry, cells.alias("c")).select("c.*", "id", "vec", *carry)

    def run(cell: pa.Table) -> pa.Table:
        side_a = cell.column("first").to_numpy()
        vec = cell.column("vec").combine_chunks().values.to_numpy(zero_copy_only=False).reshape(cell.num_rows, -1)
        held = {n: cell.column(n).to_numpy() for n in ("id", *carry)}
        same = cell.column("i")[0].as_py() == cell.column("j")[0].as_py()
        pair, of = {"same": same}, {"a": np.flatnonzero(side_a), "b": np.flatnonzero(side_a if same else ~side_a)}
        for end, at in of.items():
            pair |= {f"{n}_{end}": v[at] for n, v in held.items()} | {f"vec_{end}": vec[at]}
        found = reduce(pair) if len(of["a"]) and len(of["b"]) else None
        return pa.table({n: pa.array([] if found is None else found[n], t) for n, t in zip(names, kinds)})

    kinds = [{"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64()}[c.split()[1]] for c in schema.split(",")]
    return dealt.groupBy("i", "j").applyInArrow(run, schema)


def group_sums(vec_a: np.ndarray, weight_a: np.ndarray, group_a: np.ndarray, vec_b: np.ndarray, weight_b: np.ndarray, group_b: np.ndarray):
    """Weighted sums of Euclidean distances: (rows of a, groups of b) and (rows of b, groups of a), groups in sorted order.

    Squared distances are products of matrices, per group of b from that group's mean, so that only rows much nearer to each other
    than the group is wide lose digits; those are measured from coordinate differences, which gives exactly 0 for equal rows.
    """
    order = np.argsort(group_a, kind="stable")
    vec_a, weight_a, (names_a, start_a) = vec_a[order], weight_a[order], np.unique(group_a[order], return_index=True)
    names_b = np.unique(group_b)
    to_b, to_a = np.zeros((len(vec_a), len(names_b))), np.zeros((len(vec_b), len(names_a)))
    for k, name in enumerate(names_b):
        at = np.flatnonzero(group_b == name)
        centre = vec_b[at].mean(axis=0)
        for begin in range(0, len(at), STRIPE_ROWS):
            part = at[begin:begin + STRIPE_ROWS]
            b, w = vec_b[part] - centre, weight_b[part]
            norm_b = (b ** 2).sum(axis=1)
            held = []
            for first in range(0, len(vec_a), STRIPE_ROWS):
                a = vec_a[first:first + STRIPE_ROWS] - centre
                both = (a ** 2).sum(axis=1)[:, None] + norm_b
                d = a @ b.T
                d *= -2
                d += both
                both *= NEAR
                i, j = np.nonzero(d <= both)
                for at_once in range(0, len(i), 1 << 16):
                    x, y = i[at_once:at_once + (1 << 16)], j[at_once:at_once + (1 << 16)]
                    d[x, y] = ((vec_a[first + x] - vec_b[part[y]]) ** 2).sum(axis=1)
                np.sqrt(d, out=d)
                to_b[first:first + STRIPE_ROWS, k] += d @ w
                held.append((first, d))
            for g, (lo, hi) in enumerate(zip(start_a, [*start_a[1:], len(vec_a)])):
                for first, d in held:
                    x, y = max(lo, first), min(hi, first + len(d))
                    if x < y:
                        to_a[part, g] += weight_a[x:y] @ d[x - first:y - first]
    back = np.empty_like(to_b)
    back[order] = to_b
    return back, names_b, to_a, names_a
