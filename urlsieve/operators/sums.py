"""Sums over all rows of vectors of fixed length that NumPy makes of the feature matrix, a batch at a time.

Every task adds up its rows; the tasks' vectors are added by place in a shuffle. The driver gets one number per place, however many
rows and tasks there are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def matrix(batch: pa.RecordBatch, names: Sequence[str]) -> np.ndarray:
    """Rows by features, as doubles."""
    out = np.empty((batch.num_rows, len(names)))
    for j, n in enumerate(names):
        out[:, j] = batch.column(n).to_numpy(zero_copy_only=False)
    return out


def task_sums(df: DataFrame, names: Sequence[str], others: Sequence[str], size: int,
              add: Callable[[np.ndarray, dict[str, np.ndarray]], np.ndarray]) -> np.ndarray:
    """The sum over batches of ``add(matrix of names, {other: column})``, vectors of ``size`` numbers. Zeros for no rows."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for b in batches:
            total += add(matrix(b, names), {o: b.column(o).to_numpy(zero_copy_only=False) for o in others})
        place = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(place.astype(np.int32)), pa.array(total[place])], ["place", "value"])

    rows = df.select(*[F.col(n).cast("double").alias(n) for n in names], *others).mapInArrow(run, "place int, value double")
    out = np.zeros(size)
    for r in rows.groupBy("place").agg(F.sum("value").alias("value")).collect():
        out[r["place"]] = r["value"]
    return out
