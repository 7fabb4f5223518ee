"""Exact running numbers in a given order, without a window over all rows.

Rows are dealt to tasks by ranges of the order, each range is numbered on its own, and the rows of the ranges before it are added.
The numbers depend on the rows and their order only, not on how the table is split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from urlsieve.operators.joins import fits_broadcast
from urlsieve.session import stage_table


def number_rows(df: DataFrame, order: Sequence[str], by: Sequence[str] = (), name: str = "place") -> DataFrame:
    """Add ``name``, from 1, in the order of the columns ``order`` within each value of ``by``.

    ``order`` must tell the rows of a group apart for the numbers to be repeatable. Null values come first; a null ``by`` is a group.
    A group of any size is spread over the ranges. The table of ranges has a row per task and group.
    """
    spread = df.repartitionByRange(*by, *order) if len(by) + len(order) else df
    rows = stage_table(spread.withColumn("_range", F.spark_partition_id()), "numbered")
    counts = rows.groupBy(*by, "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    starts = stage_table(counts.select(*[F.col(b).alias(f"_by_{b}") for b in by], F.col("_range").alias("_of"), F.coalesce(before, F.lit(0)).alias("_before")), "ranges")
    inside = F.row_number().over(Window.partitionBy(*by, "_range").orderBy(*[F.col(o).asc_nulls_first() for o in order]))
    same = F.col("_range") == F.col("_of")
    for b in by:
        same = same & F.col(b).eqNullSafe(F.col(f"_by_{b}"))
    small = fits_broadcast(starts.count(), 0, 2 + len(by))
    joined = rows.withColumn("_inside", inside).join(F.broadcast(starts) if small else starts, same)
    return joined.select(*df.columns, (F.col("_inside") + F.col("_before")).alias(name))


def number_lines(df: DataFrame, line: str = "line", name: str = "row_id") -> DataFrame:
    """Add ``name``, from 0, to rows read from files that carry ``line``: path, offset of the split, position in the split.

    No row moves: the rows of every split are counted, and a row's number is that of the splits before its own and its position.
    Lines have the same numbers however the files are split, since the splits of a file follow each other.
    """
    at = [F.col(f"{line}.file"), F.col(f"{line}.block")]
    seen = df.groupBy(at[0].alias("_file"), at[1].alias("_block")).agg(F.count(F.lit(1)).alias("_n"), F.min(f"{line}.seq").alias("_first"))
    # A row per split of a file; the window is over those only.
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = seen.select("_file", "_block", (before - F.col("_first")).alias("_shift"))
    joined = df.join(starts, (at[0] == F.col("_file")) & (at[1] == F.col("_block")))
    return joined.select((F.col(f"{line}.seq") + F.col("_shift")).alias(name), *df.columns)
