"""K-means for several numbers of clusters and restarts at once.

All fits walk together: one scan per round measures every row against the centres of all fits that still move, and tasks send sums and
counts per centre. So a search over seven numbers of clusters with ten restarts takes as many scans as its slowest fit. The driver
holds the centres, whose number depends on the settings only. Starts are drawn with chance proportional to the squared distance from
the centres drawn before (k-means++), as a race of hashed exponential times: the result depends neither on partitioning nor on a
generator's state, and the first k starts of a restart serve every k.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urlsieve.operators.sums import matrix, task_sums
from urlsieve.session import stage_table

#: Squared distances are rounded to so many places, so that ties fall to the lower cluster however they were summed.
PLACES = 9
#: A fit stands still when its centres together moved by less than this, squared, in standard deviations.
TOLERANCE = 1e-4
_HASH_DIGITS = 13


@dataclass(frozen=True)
class KMeansFit:
    """Centres in the order they were started from; ``restart`` is the one that won, by inertia."""

    names: tuple[str, ...]
    centres: np.ndarray
    inertia: float
    sizes: tuple[int, ...]
    restart: int
    rounds: int

    @property
    def k(self) -> int:
        return len(self.centres)

    def cluster(self) -> Column:
        """The nearest centre's number as one column expression; the lowest of equally near ones."""
        return nearest(self.names, self.centres)


def nearest(names: Sequence[str], centres: np.ndarray) -> Column:
    far = ", ".join("round(" + " + ".join(f"pow(`{n}` - ({float(v)!r}D), 2)" for n, v in zip(names, c)) + f", {PLACES})" for c in centres)
    return F.expr(f"cast(array_position(array({far}), array_min(array({far}))) - 1 as int)")


def squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of rows to centres, rounded."""
    d = (x ** 2).sum(1)[:, None] - 2 * x @ centres.T + (centres ** 2).sum(1)[None, :]
    return np.round(np.maximum(d, 0), PLACES)


def _uniform(seed: int, restart: int, step: int) -> Column:
    """A number between 0 and 1 per row_id, from its hash."""
    h = F.md5(F.concat(F.lit(f"{seed}|{restart}|{step}|"), F.col("row_id").cast("string")))
    return (F.conv(F.substring(h, 1, _HASH_DIGITS), 16, 10).cast("double") + 0.5) / 16.0 ** _HASH_DIGITS


def starts(rows: DataFrame, names: Sequence[str], k: int, restarts: int, seed: int) -> np.ndarray:
    """(restarts, k, features): k scans, each drawing the next start of all restarts. Where rows run out, the first is repeated."""
    chosen: list[list[np.ndarray]] = [[] for _ in range(restarts)]
    for step in range(k):
        held = [np.array(c) for c in chosen]

        def draw(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if not b.num_rows:
                    continue
                x, ids = matrix(b, names), b.column("row_id").to_numpy(zero_copy_only=False)
                out = []
                for r in range(restarts):
                    d = squares(x, held[r]).min(axis=1) if step else np.ones(len(x))
                    with np.errstate(divide="ignore"):
                        time = -np.log(b.column(f"u{r}").to_numpy()) / d
                    i = np.lexsort((ids, time))[0]
                    if np.isfinite(time[i]):
                        out.append((r, float(time[i]), int(ids[i]), x[i].tolist()))
                yield pa.RecordBatch.from_pylist([dict(zip(("r", "time", "id", "x"), o)) for o in out], schema=pa.schema(
                    [("r", pa.int32()), ("time", pa.float64()), ("id", pa.int64()), ("x", pa.list_(pa.float64()))]))

        drawn = rows.select("row_id", *names, *[_uniform(seed, r, step).alias(f"u{r}") for r in range(restarts)])
        first = drawn.mapInArrow(draw, "r int, time double, id long, x array<double>").groupBy("r").agg(F.min_by("x", F.struct("time", "id")).alias("x"))
        found = {f["r"]: np.array(f["x"]) for f in first.collect()}
        if not found and not step:
            raise ValueError("no rows to cluster")
        for r in range(restarts):
            chosen[r].append(found.get(r, chosen[r][0] if step else None))
    return np.array(chosen)


def _stacked(centres: dict[tuple, np.ndarray]) -> tuple[np.ndarray, list[tuple[tuple, int, int]]]:
    spans, at = [], 0
    for key, c in centres.items():
        spans.append((key, at, at + len(c)))
        at += len(c)
    return np.concatenate(list(centres.values())), spans


def _totals(rows: DataFrame, names: Sequence[str], centres: dict[tuple, np.ndarray]) -> dict[tuple, tuple]:
    """Per fit: rows, sum of the rows, sum of their squared norms and of their squared distances, per centre. One scan."""
    every, spans = _stacked(centres)
    m, d = every.shape

    def add(x: np.ndarray, _) -> np.ndarray:
        far = squares(x, every)
        own, near = np.zeros((len(x), m)), np.zeros((len(x), m))
        for _, a, b in spans:
            lab = a + far[:, a:b].argmin(axis=1)
            own[np.arange(len(x)), lab] = 1
            near[np.arange(len(x)), lab] = far[np.arange(len(x)), lab]
        return np.concatenate((own.sum(0), (own.T @ x).ravel(), own.T @ (x ** 2).sum(1), near.sum(0)))

    out = task_sums(rows, names, [], m * (d + 3), add)
    n, total, norm, inertia = out[:m], out[m:m + m * d].reshape(m, d), out[m + m * d:m + m * d + m], out[-m:]
    return {key: (n[a:b], total[a:b], norm[a:b], inertia[a:b]) for key, a, b in spans}


def fit_many(z: DataFrame, names: Sequence[str], ks: Sequence[int], restarts: int = 10, max_iter: int = 300, seed: int = 42,
             tolerance: float = TOLERANCE) -> tuple[dict[int, KMeansFit], dict[int, float]]:
    """Per k the fit with the least inertia of ``restarts`` ones, and the mean silhouette of all rows by squared distances.

    ``z``: row_id and standardised features. A centre that loses all rows stays where it is. Ties between restarts go to the first.
    """
    names = list(names)
    rows = stage_table(z.select("row_id", *[F.col(n).cast("double").alias(n) for n in names]), "kmeans")
    drawn = starts(rows, names, max(ks), restarts, seed)
    centres = {(k, r): drawn[r, :k] for k in ks for r in range(restarts)}
    moving, rounds = dict(centres), {}
    for step in range(1, max_iter + 1):
        for key, (n, total, _, _) in _totals(rows, names, moving).items():
            old = moving[key]
            new = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], old)
            centres[key], rounds[key] = new, step
            if ((new - old) ** 2).sum() <= tolerance:
                del moving[key]
            else:
                moving[key] = new
        if not moving:
            break
    last = _totals(rows, names, centres)
    fits, stats = {}, {}
    for k in ks:
        r = min(range(restarts), key=lambda i: (round(float(last[k, i][3].sum()), 4), i))
        n, total, norm, inertia = last[k, r]
        fits[k] = KMeansFit(tuple(names), centres[k, r], float(inertia.sum()), tuple(int(v) for v in n), r, rounds[k, r])
        safe = np.maximum(n, 1)
        stats[k] = (n, total / safe[:, None], norm / safe)
    return fits, silhouettes(rows, names, fits, stats)


def silhouettes(rows: DataFrame, names: Sequence[str], fits: dict[int, KMeansFit], stats: dict[int, tuple]) -> dict[int, float]:
    """Mean silhouette per fit by mean squared distances, which follow from each cluster's rows, mean and mean norm. One scan."""
    order = sorted(fits)

    def add(x: np.ndarray, _) -> np.ndarray:
        out = np.zeros(len(order) + 1)
        at, size = np.arange(len(x)), (x ** 2).sum(1)
        for i, k in enumerate(order):
            n, mean, norm = stats[k]
            lab = squares(x, fits[k].centres).argmin(axis=1)
            far = np.maximum(size[:, None] - 2 * x @ mean.T + norm[None, :], 0)
            far[:, n == 0] = np.inf
            a = far[at, lab] * n[lab] / np.maximum(n[lab] - 1, 1)
            far[at, lab] = np.inf
            b = far.min(axis=1)
            top = np.maximum(a, b)
            s = np.where((n[lab] > 1) & (top > 0) & np.isfinite(b), (b - a) / np.where(top > 0, top, 1), 0.0)
            out[i] = np.where(np.isfinite(b), s, 0.0).sum()
        out[-1] = len(x)
        return out

    total = task_sums(rows, names, [], len(order) + 1, add)
    return {k: float(total[i] / max(total[-1], 1)) for i, k in enumerate(order)}
