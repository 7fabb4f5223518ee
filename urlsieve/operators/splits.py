"""Exact, repeatable splits, folds and samples.

Rows are ranked by a hash of their key, so the result does not depend on partitioning. Nothing is sorted
as a whole: hash prefixes are counted, the few prefixes that hold a wanted rank are found from the counts,
and only the rows under those prefixes are ranked. What comes out is a handful of cut points, against
which every row is then compared in place.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PREFIX_DIGITS = 4      # 65,536 hash prefixes


def hash_key(by: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col(by).cast("string")))


def _position(by: str, seed: int) -> Column:
    return F.struct(hash_key(by, seed).alias("h"), F.col(by).alias("by"))


def rank_cuts(df: DataFrame, by: str, seed: int, ranks: Callable[[Column], Column],
              stratum: Column) -> DataFrame:
    """_s, cuts: per stratum the hash positions of the wanted ranks. ``ranks`` maps a row count to them."""
    keyed = df.select(stratum.alias("_s"), F.col(by).alias("_by"), hash_key(by, seed).alias("_h"))
    keyed = keyed.withColumn("_b", F.substring("_h", 1, PREFIX_DIGITS))
    counts = keyed.groupBy("_s", "_b").agg(F.count(F.lit(1)).alias("_c"))
    whole = Window.partitionBy("_s")
    upto = F.sum("_c").over(whole.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0))
    located = counts.select("_s", "_b", "_c", upto.alias("_upto"), F.sum("_c").over(whole).alias("_n"))
    wanted = (located.select("_s", "_b", "_upto", (F.col("_upto") - F.col("_c")).alias("_before"),
                             F.posexplode(ranks(F.col("_n"))).alias("_j", "_rank"))
              .where((F.col("_rank") > F.col("_before")) & (F.col("_rank") <= F.col("_upto"))))
    # ``wanted`` has one row per stratum and wanted rank, so it is always small enough to broadcast.
    inside = keyed.join(F.broadcast(wanted), ["_s", "_b"])
    nth = F.row_number().over(Window.partitionBy("_s", "_j").orderBy("_h", "_by"))
    cut = (inside.withColumn("_nth", nth + F.col("_before")).where(F.col("_nth") == F.col("_rank"))
           .select("_s", F.struct(F.col("_h").alias("h"), F.col("_by").alias("by")).alias("_cut")))
    return cut.groupBy("_s").agg(F.collect_list("_cut").alias("_cuts"))


def _cuts_at_or_after(df: DataFrame, label: str, by: str, seed: int,
                      ranks: Callable[[Column], Column]) -> tuple[DataFrame, Column]:
    cuts = rank_cuts(df, by, seed, ranks, F.col(label)).withColumnRenamed("_s", label)
    joined = df.join(F.broadcast(cuts), label, "left")
    position = _position(by, seed)
    n = F.size(F.filter(F.coalesce("_cuts", F.array()), lambda c: position <= c))
    return joined, n


def stratified_split(df: DataFrame, label: str = "label", test_share: float = 0.2, seed: int = 42,
                     by: str = "url") -> DataFrame:
    """Add ``is_test``: exactly round(share * n) rows of each label value."""
    joined, n = _cuts_at_or_after(
        df, label, by, seed, lambda total: F.array(F.round(total * test_share).cast("bigint")))
    return joined.select(*df.columns, (n > 0).alias("is_test"))


def stratified_folds(df: DataFrame, label: str = "label", folds: int = 5, seed: int = 42,
                     by: str = "url") -> DataFrame:
    """Add ``fold`` 0..folds-1: per label value, fold sizes differ by at most one row."""
    joined, n = _cuts_at_or_after(
        df, label, by, seed,
        lambda total: F.array(*[F.floor(total * j / folds).cast("bigint") for j in range(1, folds)]))
    return joined.select(*df.columns, (F.lit(folds - 1) - n).cast("int").alias("fold"))


def sample_n(df: DataFrame, n: int, by: str = "row_id", seed: int = 42) -> DataFrame:
    """Exactly min(n, rows) rows, uniformly, without replacement."""
    cuts = rank_cuts(df, by, seed, lambda total: F.array(F.least(total, F.lit(n))), F.lit(0))
    return df.where(_position(by, seed) <= cuts.select(F.col("_cuts")[0]).scalar())
